"""A deterministic relation of filings made from the driver tables: one SQL text for Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Templates by doc_id % 8: every cue group, a demotion, a fallback heading, near duplicates, no cue.
SQL = """
SELECT doc_id, concat('2024-0', CAST(1 + doc_id % 9 AS VARCHAR(2)), '-15__', company, '__', lpad(CAST(cik AS VARCHAR(12)), 10, '0'), '-24-', lpad(CAST(doc_id AS VARCHAR(12)), 6, '0'), '_business') AS stem,
       company, CAST(cik AS VARCHAR(12)) AS cik, 2023 + doc_id % 2 AS filing_year,
       concat('ITEM 1. BUSINESS', nl, 'We were founded in the U.S. and make goods, e.g. ', p_name, '.', nl, body, nl,
         CASE doc_id % 8
           WHEN 0 THEN concat('COMPETITION', nl, 'Our principal competitors include ', c_name, ', Inc. and ', s_name, '.', nl, 'Of these ', c_name, ' is the larger one.')
           WHEN 1 THEN concat('We operate in a highly competitive market.', nl, 'We compete with ', c_name, ' in Europe.')
           WHEN 2 THEN 'We operate in a highly competitive market for our customers.'
           WHEN 3 THEN 'Barriers to entry are low.'
           WHEN 4 THEN concat('Our customers include ', c_name, ', with whom rivals compete.')
           WHEN 5 THEN concat('Market Competition', nl, 'The field has many firms and none of them leads it by far, which has been so for years.')
           WHEN 6 THEN concat('We face competition from ', s_name, ' and from ', c_name, ' in the north region.', nl, 'We face competition from ', s_name, ' and from ', c_name, ' in the north regions.')
           ELSE 'Nothing more is to be said here about any of these matters at all.' END,
         nl, 'Our Customers', nl, 'We serve many segments.', nl, 'ITEM 1A. RISK FACTORS', nl, 'Risks are many.') AS text
FROM (SELECT d.doc_id, d.text AS body, concat(chr(10), chr(10)) AS nl, s.s_name, c.c_name, p.p_name, 1000 + s.s_suppkey AS cik,
        CASE d.doc_id % 5 WHEN 0 THEN concat('NORTH ', upper(p.p_brand), ' INC') WHEN 1 THEN concat('O', chr(39), 'REILLY ', upper(s.s_name)) WHEN 2 THEN concat('Index Fund of ', s.s_name)
          WHEN 3 THEN concat(s.s_name, ' Trust') ELSE concat('Acme ', c.c_name, ' Corp') END AS company
      FROM (SELECT doc_id, text, doc_id % (SELECT count(*) FROM supplier) AS sk, doc_id % (SELECT count(*) FROM customer) AS ck, doc_id % (SELECT count(*) FROM part) AS pk
            FROM documents WHERE text IS NOT NULL) d
      JOIN supplier s ON s.s_suppkey = d.sk
      JOIN customer c ON c.c_custkey = d.ck
      JOIN part p ON p.p_partkey = d.pk)
"""


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, stem, company, cik, filing_year, text of every document that has a text, whole and in any language."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "supplier", "customer", "part")}
    sql = SQL
    for name in tables:
        for word in ("FROM", "JOIN"):
            sql = sql.replace(f"{word} {name}", f"{word} {{{name}}}")
    return spark.sql(sql, **tables)
