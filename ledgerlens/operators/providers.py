"""Look-ups that a service answers elsewhere: here a table stands in for the service, or a function from names to such a table."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window, functions as F


class QuoteProvider(Protocol):
    """Quotes of the companies asked for: query (the name asked for), position, symbol, kind and name of each hit."""

    def quotes(self, names: DataFrame) -> DataFrame: ...


class TableProvider:
    """Answers from a table that has been fetched before."""

    def __init__(self, table: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda t: t) -> None:
        self.table = keep(table)

    def quotes(self, names: DataFrame) -> DataFrame:
        return self.table.join(names.select(F.lower("name").alias("query")).distinct(), "query", "left_semi")


def name_tokens(name: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("[a-z0-9]+"), 0))


def best_tickers(companies: DataFrame, provider: QuoteProvider, name: str = "company_name") -> DataFrame:
    """companies with ticker: of a name's quotes that of the highest score (5 for shares, 1 for each word in common), of equals the first.

    Each name is asked for once, whatever its case; companies without a hit, or without a name, have an empty ticker.
    """
    asked = companies.select(F.col(name).alias("name")).filter("trim(name) <> ''")
    hits = provider.quotes(asked).filter(F.trim("symbol") != "")
    score = F.when(F.lower("kind").isin("equity", "stock"), 5).otherwise(0) + F.size(F.array_intersect(name_tokens(F.col("query")), name_tokens(F.col("name"))))
    first = Window.partitionBy("query").orderBy(F.desc("__score"), "position")
    best = hits.withColumn("__score", score).withColumn("__n", F.row_number().over(first)).filter("__n = 1").select(F.col("query").alias("__key"), F.upper(F.trim("symbol")).alias("ticker"))
    return companies.withColumn("__key", F.lower(F.col(name))).join(best, "__key", "left").withColumn("ticker", F.coalesce("ticker", F.lit(""))).drop("__key")
