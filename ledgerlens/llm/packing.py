"""Operator 6, best-fit packing under conflicts.

A document of n words takes n + 1 places (words and an end) in sequences of a fixed capacity. Places beyond whole sequences
are packed by best fit, largest first: open bins are ordered by residual, each carries a bitmap of the duplicate clusters in
it and `source_slots` bitmaps of its sources (a source may come that often), and the successor search goes on from the
tightest bin that is large enough to the first without a conflict. Whole sequences of long documents fill bins of their own.

Documents are dealt by a hash of id and text into groups of about GROUP_ROWS, each packed on its own, so that a search never
passes more bins than a group has, whatever share of the rows a source or cluster holds; the loss is a few bins in a group.

Defined results: a null text counts as empty; a null source or cluster conflicts with nothing; null ids and repeated rows are
packed like others; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import columns, map_arrow, read_table, record_batch, staged

CAPACITY, SOURCE_SLOTS, GROUP_ROWS = 2048, 4, 2000
_SIZED = pa.schema([("id", pa.int64()), ("source", pa.string()), ("cluster", pa.int64()), ("size", pa.int64()), ("draw", pa.int64())])
_PLACED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int64()), ("first_token", pa.int64()), ("n_tokens", pa.int64()), ("bin_id", pa.int64()), ("bin_offset", pa.int64())])


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places that a document takes; its cluster, by the hash of its lower-cased words, unless one is given."""
    for ids, texts, sources, clusters in columns(batches, "id", "text", "source", "cluster"):
        rows = []
        for i, t, s, c in zip(ids.to_pylist(), texts.to_pylist(), sources.to_pylist(), clusters.to_pylist(), strict=True):
            words = t.encode().lower().split() if t else []
            h = xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63)
            rows.append((i, s, h if c is None else c, len(words) + 1, xxhash.xxh64_intdigest(f"{i}:{h}") >> 1))
        yield record_batch(_SIZED, *map(list, zip(*rows, strict=True)))


class Bins:
    """Open bins in order of residual. Labels are numbered as they come; a bitmap has a bit for each."""

    def __init__(self, capacity: int, source_slots: int) -> None:
        self.capacity, self.slots = capacity, source_slots
        self.order: list[tuple[int, int]] = []
        self.sources: list[list[int]] = []
        self.clusters: list[int] = []
        self.numbers: dict[object, int] = {}

    def _bit(self, label: object) -> int:
        return 0 if label is None else 1 << self.numbers.setdefault(label, len(self.numbers))

    def new(self, size: int, source: int, cluster: int) -> int:
        self.sources.append([source, *[0] * (self.slots - 1)])
        self.clusters.append(cluster)
        if size < self.capacity:
            insort(self.order, (self.capacity - size, len(self.clusters) - 1))
        return len(self.clusters) - 1

    def place(self, size: int, source: str | None, cluster: int | None) -> tuple[int, int]:
        """The bin and the offset in it."""
        s, c = self._bit(("source", source) if source is not None else None), self._bit(("cluster", cluster) if cluster is not None else None)
        for k in range(bisect_left(self.order, (size, -1)), len(self.order)):
            residual, b = self.order[k]
            if not self.clusters[b] & c and not self.sources[b][-1] & s:
                del self.order[k]
                self.clusters[b] |= c
                maps = self.sources[b]
                for j in range(self.slots):  # the first bitmap that lacks the source
                    if not maps[j] & s:
                        maps[j] |= s
                        break
                if residual > size:
                    insort(self.order, (residual - size, b))
                return b, self.capacity - residual
        return self.new(size, s, c), 0


def pack_group(rows: Iterable[tuple], capacity: int, source_slots: int) -> Iterator[tuple]:
    """rows: (id, source, cluster, size) of one group, by falling size of what is left after whole sequences."""
    bins = Bins(capacity, source_slots)
    for i, source, cluster, size in rows:
        whole, rest = divmod(size, capacity)
        for piece in range(whole):
            yield i, piece, piece * capacity, capacity, bins.new(capacity, 0, 0), 0
        if rest:
            b, offset = bins.place(rest, source, cluster)
            yield i, whole, whole * capacity, rest, b, offset


def pack(docs: DataFrame, capacity: int = CAPACITY, source_slots: int = SOURCE_SLOTS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, first_token and n_tokens of the document, bin_id and bin_offset."""
    if capacity < 1 or source_slots < 1:
        raise ValueError("capacity and source_slots are at least 1")
    cluster = F.col(cluster_col).cast("long") if cluster_col else F.lit(None).cast("long")
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source"), cluster.alias("cluster"))
    sized = staged(map_arrow(given, _sized, "id long, source string, cluster long, size long, draw long"), "sized")
    groups = max(1, -(-sized.count() // GROUP_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def packed() -> Iterator[pa.RecordBatch]:
            out = [(i, p, f, n, group << 24 | b, o) for i, p, f, n, b, o in pack_group(rows, capacity, source_slots)]
            for at in range(0, len(out), 5000):
                yield record_batch(_PLACED, *map(list, zip(*out[at : at + 5000], strict=True)))

        for number, ids, sources, clusters, sizes in columns(batches, "number", "id", "source", "cluster", "size"):
            for g, *row in zip(*(c.to_pylist() for c in (number, ids, sources, clusters, sizes)), strict=True):
                if g != group:
                    yield from packed()
                    group, rows = g, []
                rows.append(tuple(row))
        yield from packed()

    numbered = sized.withColumn("number", F.pmod("draw", F.lit(groups))).repartition("number")
    ordered = numbered.sortWithinPartitions("number", (F.col("size") % capacity).desc(), "id", "draw", "source")
    return map_arrow(ordered.select("number", "id", "source", "cluster", "size"), run, "doc_id long, piece long, first_token long, n_tokens long, bin_id long, bin_offset long")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
