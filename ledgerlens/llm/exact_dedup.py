"""Operator 5, exact deduplication by content sort.

1. Each input partition folds its own equal texts into one representative, so that a group with a third of all rows reaches
   the sort as one row per FOLD_BYTES of each partition at most.
2. Representatives are dealt by sampled splitters over the order (leading bytes, length, hash) and sorted externally by that order
   and the full normalised bytes. One pass over each range compares every text in full with its neighbour; of the group at hand it
   holds one text, and eight bytes a representative.
3. The verdict goes back to all rows by the number of their representative.

Defined results: a null text counts as empty; a null id is smaller than any other; rows that repeat an id and a text are
members of their group and just one of them is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import columns, map_arrow, read_table, record_batch, staged

#: Bytes that a worker holds of distinct texts, with Python's own, before it hands them on; copies beyond that meet in the sort.
FOLD_BYTES = 16 << 20
#: Bytes of texts in one batch that a worker gives, and what Python needs for a text and for a row beside the text.
BATCH_BYTES, TEXT_COST, ROW_COST = 4 << 20, 400, 100
#: Leading bytes in the splitters. Ties are dealt by length and hash, full bytes decide.
LEADING_BYTES = 48

FOLDED = "id long, rid long, rep long, n long, lead binary, size long, hash long, norm binary"
_FOLDED = pa.schema([("id", pa.int64()), ("rid", pa.int64()), ("rep", pa.int64()), ("n", pa.int64()), ("lead", pa.binary()), ("size", pa.int64()), ("hash", pa.int64()), ("norm", pa.binary())])
VERDICT = "rep long, keep_id long, keep_rid long, group_size long, sha string"
_VERDICT = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("keep_rid", pa.int64()), ("group_size", pa.int64()), ("sha", pa.string())])


def _normalised(text: str | None) -> bytes:
    return text.encode().lower() if text else b""  # bytes.lower() changes A-Z only


def _rank(doc: int | None) -> tuple[bool, int]:
    return doc is not None, doc or 0


def _order(norm: bytes) -> tuple[bytes, int, int]:
    return norm[:LEADING_BYTES], len(norm), xxhash.xxh64_intdigest(norm) - (1 << 63)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[bytes, int] = {}
    docs: list[int | None] = []
    group_of = array("q")
    base, held = TaskContext.get().partitionId() << 36, 0

    def flush() -> Iterator[pa.RecordBatch]:
        best, sizes, rows, taken = [-1] * len(groups), [0] * len(groups), [], 0
        for row, g in enumerate(group_of):
            sizes[g] += 1
            if best[g] < 0 or _rank(docs[row]) >= _rank(docs[best[g]]):
                best[g] = row
        norms = list(groups)
        for row, g in enumerate(group_of):
            if best[g] == row:
                rows.append((docs[row], base + row, base + row, sizes[g], *_order(norms[g]), norms[g]))
                taken += len(norms[g])
            else:
                rows.append((docs[row], base + row, base + best[g], None, None, None, None, None))
            if len(rows) >= 2000 or taken > BATCH_BYTES:
                yield record_batch(_FOLDED, *zip(*rows, strict=True))
                rows, taken = [], 0
        if rows:
            yield record_batch(_FOLDED, *zip(*rows, strict=True))

    for ids, texts in columns(batches, "id", "text"):
        for doc, text in zip(ids.to_pylist(), texts, strict=True):
            norm = _normalised(text.as_py())
            g = groups.setdefault(norm, len(groups))
            if g == len(groups) - 1:
                held += len(norm) + TEXT_COST
            docs.append(doc)
            group_of.append(g)
            held += ROW_COST
            if held > FOLD_BYTES:
                yield from flush()
                base += len(docs)
                groups, docs, group_of, held = {}, [], array("q"), 0
    yield from flush()


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by content, of equal texts the one to keep first: each is compared in full with the one before it."""
    last, winner, members, size = None, (None, 0), array("q"), 0

    def closed() -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha256(last).hexdigest()
        for at in range(0, len(members), 5000):
            part = members[at : at + 5000]
            yield record_batch(_VERDICT, part, *([x] * len(part) for x in (*winner, size, sha)))

    waiting: list[pa.RecordBatch] = []
    for reps, ids, counts, norms in columns(batches, "rep", "id", "n", "norm"):
        for rep, doc, n, text in zip(reps.to_pylist(), ids.to_pylist(), counts.to_pylist(), norms, strict=True):
            norm = text.as_py()
            if norm != last:
                if last is not None:
                    waiting += closed()
                last, winner, members, size = norm, (doc, rep), array("q"), 0
            members.append(rep)
            size += n
        if waiting:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting = []
    if last is not None:
        yield from closed()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, rid (the row's number), keep_id, keep_rid, group_size, kept, text_sha256."""
    folded = staged(map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), _fold, FOLDED), "folded")
    order = ("lead", "size", "hash")
    dealt = folded.filter("norm is not null").select("rep", "id", "n", *order, "norm").repartitionByRange(*order)
    ranges = dealt.sortWithinPartitions(*order, "norm", F.col("id").desc_nulls_last(), F.desc("rep"))
    verdict = map_arrow(ranges.select("rep", "id", "n", "norm"), _neighbours, VERDICT)
    return folded.select("id", "rid", "rep").join(verdict, "rep").select(
        F.col("id").alias("doc_id"), "rid", "keep_id", "keep_rid", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def _fold_rows(batches: Iterator[pa.RecordBatch], id_at: int, text_at: int) -> Iterator[pa.RecordBatch]:
    """Of each partition's rows the best of each text, within 2 * FOLD_BYTES, with the order of the sort in three columns more."""
    best: dict[bytes, tuple[tuple[bool, int], int, int]] = {}
    pending: list[pa.RecordBatch] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows: dict[int, list[tuple[int, bytes]]] = {}
        for norm, (_, k, row) in best.items():
            rows.setdefault(k, []).append((row, norm))
        for k, chosen in rows.items():
            part = pending[k].take(pa.array([row for row, _ in chosen]))
            leads, sizes, hashes = zip(*(_order(norm) for _, norm in chosen), strict=True)
            keys = [pa.array(leads, pa.binary()), pa.array(sizes, pa.int64()), pa.array(hashes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*part.columns, *keys], names=[*part.schema.names, "__lead", "__size", "__hash"])

    for batch in (b for b in batches if b.num_rows):
        pending.append(batch)
        held += batch.nbytes
        for row, (doc, text) in enumerate(zip(batch.column(id_at).to_pylist(), batch.column(text_at), strict=True)):
            norm, rank = _normalised(text.as_py()), _rank(doc)
            known = best.get(norm)
            if known is None:
                held += len(norm) + TEXT_COST
            if known is None or known[0] < rank:
                best[norm] = (rank, len(pending) - 1, row)
        if held > 2 * FOLD_BYTES:
            yield from flush()
            best, pending, held = {}, [], 0
    yield from flush()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_duplicates keeps, with all their columns. Texts go through one shuffle, copies don't."""
    from pyspark.sql import types as T

    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("__lead", T.BinaryType()), T.StructField("__size", T.LongType()), T.StructField("__hash", T.LongType())])
    order = ("__lead", "__size", "__hash")
    reps = map_arrow(docs, lambda batches: _fold_rows(batches, id_at, text_at), schema).repartitionByRange(*order)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    reps = reps.withColumn("__norm", F.translate(F.coalesce(text_col, F.lit("")), upper, upper.lower()))
    equal = Window.partitionBy(*order, "__norm").orderBy(F.col(id_col).desc_nulls_last())
    return reps.withColumn("__place", F.row_number().over(equal)).filter("__place = 1").select(*docs.columns)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
"""
