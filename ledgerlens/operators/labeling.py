"""Labels of mentions by an injected labeler: requests, retries and repairs on the executors, resuming from earlier results.

A labeler is any picklable function from a request (JSON text) to a response (JSON text). What it returns is checked as a whole: a
response that lacks a row, or holds an unknown label, counts as failed; the next attempt gets the error with the request.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..rules.mentions import LABELS

Labeler = Callable[[str], str]
RESULT = "row_index long, llm_label string, llm_product_type string, llm_owner_company_candidate string, mention_type_resolved string, ticker_match_company string"
_FIELDS = [f.split()[0] for f in RESULT.split(", ")[2:]]


def checked_labels(raw: str, wanted: list[int]) -> list[dict]:
    """One dict for each wanted row; ValueError if the response isn't such JSON, lacks a row or has an unknown label."""
    body = re.sub(r"^```(?:json)?\s*|\s*```$", "", raw.strip(), flags=re.I)
    found = json.loads(body)
    if not isinstance(found, dict) or not isinstance(found.get("labels"), list):
        raise ValueError("no array of labels")
    by_row = {x["row_index"]: x for x in found["labels"] if isinstance(x, dict) and type(x.get("row_index")) is int}
    if lacking := [i for i in wanted if i not in by_row]:
        raise ValueError(f"rows without a label: {lacking[:10]}")
    out = []
    for i in wanted:
        label = str(by_row[i].get("llm_label", "")).strip()
        if label not in LABELS:
            raise ValueError(f"row {i} has the unknown label {label!r}")
        out.append({"row_index": i, "llm_label": label} | {f: str(by_row[i].get(f) or "").strip() for f in _FIELDS})
    return out


def labelled_batch(labeler: Labeler, request: str, wanted: list[int], retries: int, repair: bool, wait: float) -> list[dict]:
    error = ""
    for attempt in range(retries):
        asks = [request] + [json.dumps({"error": None, "rows": wanted, "request": request})] * repair
        for k, ask in enumerate(asks):
            try:
                return checked_labels(labeler(ask if k == 0 else json.dumps({"error": error, "rows": wanted, "request": request})), wanted)
            except Exception as e:  # noqa: BLE001  a labeler may fail in any way; the last failure is raised below
                error = str(e)
        time.sleep(wait * (attempt + 1))
    raise RuntimeError(f"no labels after {retries} attempts: {error}")


def label_batches(requests: DataFrame, labeler: Labeler, retries: int = 3, repair: bool = True, wait: float = 1.5, most_calls: int | None = None) -> DataFrame:
    """requests: batch_no, request (as label_requests makes them). RESULT of every row of the batches; with most_calls, of the first batches."""
    if most_calls is not None:
        requests = requests.orderBy("batch_no").limit(most_calls)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for request in part["request"]:
                wanted = [int(x["row_index"]) for x in json.loads(request)["items"]]
                yield pd.DataFrame(labelled_batch(labeler, request, wanted, retries, repair, wait))

    return requests.select("request").mapInPandas(run, RESULT)


def resumed(rows: DataFrame, previous: DataFrame, index: str = "row_index") -> DataFrame:
    """rows with the label of the earlier result at the same index; without any if the tables differ in length. Blank labels don't count."""
    same = rows.agg(F.count("*").alias("__n")).join(previous.agg(F.count("*").alias("__m")), F.col("__n") == F.col("__m"))  # a row, or none
    kept = previous.select(index, F.nullif(F.trim("llm_label"), F.lit("")).alias("llm_label")).filter("llm_label is not null")
    return rows.join(kept.crossJoin(F.broadcast(same.select(F.lit(1).alias("__one")))).drop("__one"), index, "left")
