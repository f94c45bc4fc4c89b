"""Operator 1, sharding by a K-d tree.

The tree is built level by level over all its nodes at once: per node the widest dimension (in parts of its range over all
rows) is split at the weighted median, found by distributed histograms that narrow until the cut is within TOLERANCE of the
wanted weight. Leaves are split until they reach the target bytes. Only histograms reach the driver, BINS numbers for a node at
most, of MAX_LEAVES nodes at most: a tree of more leaves is split to parts of MAX_LEAVES leaves first, and each part, staged in a
folder of its own, grows its own tree. Rows go down a level at a time, by looking their node up in arrays, and are staged there.

All dimensions describe the text (length, share of non-ASCII, share of blanks), with a hash of it to break ties, so equal
texts share a leaf. Texts whose copies together outweigh an eighth of a leaf's target (so at most eight per leaf) are hot:
their ties are broken by id, which lets a cut run through the group and keeps leaves near equal.

Everything is DataFrame expressions. Defined results: a null text has size 1 and the checksum of an empty text; a null id takes
part like any other (its slot comes first); repeated rows have slots of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import fresh_path, path_exists, read_table, staged

BINS, TOLERANCE, HOT_SHARE = 1024, 0.0005, 1 / 8
#: Rows numbered by one task, about, and leaves that one tree grows; larger trees are grown in parts.
ROWS_PER_SLOT_GROUP, MAX_LEAVES = 5000, 256
#: Hot texts that are broadcast at most; there are 1 / HOT_SHARE for a shard at most, so their number is bounded beforehand.
MAX_HOT = 100_000
_TIE = 1 << 32
DIMENSIONS = ("length", "non_ascii", "blanks")


@dataclass(eq=False)
class Node:
    leaves: int
    dim: int = -1
    cut: int = 0
    left: Node | None = None
    right: Node | None = None


def _look(values: list[int], at: Column) -> Column:
    return F.get(F.lit(values).cast("array<long>"), at)


def _step(rows: DataFrame, level: list[Node]) -> tuple[DataFrame, list[Node]]:
    """rows with the place of their node, from left to right, after one more level, staged; and that level."""
    after: list[Node] = []
    places = []
    for n in level:
        places.append((len(after), len(after) + (n.left is not None)))
        after += [n] if n.left is None else [n.left, n.right]
    at = F.col("node")
    own = F.get(F.array(*[F.col(f"c{k}") for k in range(len(DIMENSIONS))]), _look([max(n.dim, 0) for n in level], at).cast("int"))
    right = own >= _look([n.cut for n in level], at)
    place = _look([p for pair in places for p in pair], 2 * at + F.when(right, 1).otherwise(0))
    return staged(rows.withColumn("node", place.cast("int")), "level"), after


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, crc, h and the raw dimensions of each row, staged."""
    text = F.coalesce(F.col("text"), F.lit(""))
    chars = F.length(text)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).select(
        "id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        F.xxhash64(text).alias("h"),
        F.log2(F.octet_length(text) + F.lit(1.0)).alias("length"),
        ((F.octet_length(text) - chars) / F.greatest(chars, F.lit(1))).alias("non_ascii"),
        ((chars - F.length(F.replace(text, F.lit(" "), F.lit("")))) / F.greatest(chars, F.lit(1))).alias("blanks"),
    )
    return staged(rows, "measured")


def _coordinates(rows: DataFrame, target: float) -> DataFrame:
    """id, size, crc, h and c0, c1, ...: each dimension in 2^30 steps, with a tie-breaker below."""
    low_high = rows.agg(F.sum("size").alias("total"), *[f(d).alias(f"{f.__name__}_{d}") for d in DIMENSIONS for f in (F.min, F.max)]).first()
    hot = rows.groupBy("h").agg(F.sum("size").alias("w")).filter(F.col("w") > target * HOT_SHARE).select("h", F.lit(True).alias("hot"))
    rows = staged(rows.join(F.broadcast(hot) if target * HOT_SHARE * MAX_HOT > (low_high["total"] or 0) else hot, "h", "left"), "marked")
    tie = F.when(F.col("hot"), F.xxhash64("h", "id")).otherwise(F.xxhash64("h"))
    columns = []
    for k, d in enumerate(DIMENSIONS):
        low, high = low_high[f"min_{d}"] or 0.0, low_high[f"max_{d}"] or 0.0
        step = F.floor((F.col(d) - low) / (high - low or 1.0) * ((1 << 30) - 1)).cast("long")
        columns.append((step * _TIE + F.pmod(tie, F.lit(_TIE))).alias(f"c{k}"))
    return rows.select("id", "size", "crc", "h", *columns)


def _split(rows: DataFrame, leaves: list[Node], most: int) -> bool:
    """Split each of the leaves that has over `most` leaves to come; whether there was one. rows: size, c0, c1, ..., node."""
    coordinates = [F.col(f"c{k}") for k in range(len(DIMENSIONS))]
    open_nodes = {k: n for k, n in enumerate(leaves) if n.leaves > most}
    if not open_nodes:
        return False
    if len(open_nodes) < len(leaves):
        rows = rows.filter(_look([k in open_nodes for k in range(len(leaves))], F.col("node")) == 1)
    stats = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("w"), *[f(c).alias(f"{f.__name__}{k}") for k, c in enumerate(coordinates) for f in (F.min, F.max)]).collect()}
    search = {}
    for k, node in open_nodes.items():
        r = stats.get(k)
        node.left, node.right = Node(node.leaves // 2), Node(node.leaves - node.leaves // 2)
        node.dim = 0
        if r is None:
            continue
        node.dim = max(range(len(DIMENSIONS)), key=lambda d: r[f"max{d}"] // _TIE - r[f"min{d}"] // _TIE)
        # weight wanted below the cut, weight known to be below lo, and the bounds of the cut
        search[k] = [r["w"] * (node.leaves // 2) / node.leaves, 0, r[f"min{node.dim}"], r[f"max{node.dim}"] + 1, r["w"] * TOLERANCE]
    while search:
        known = lambda f: _look([f(search[k]) if k in search else 0 for k in range(len(leaves))], F.col("node"))  # noqa: E731, B023
        c = F.get(F.array(*coordinates), _look([max(n.dim, 0) for n in leaves], F.col("node")).cast("int"))
        inside = rows.select("node", "size", c.alias("c"), known(lambda s: s[2]).alias("lo"), known(lambda s: s[3]).alias("hi")).filter("c >= lo and c < hi")
        found: dict[int, dict[int, int]] = {}
        for r in inside.withColumn("bin", F.expr(f"int((c - lo) div ((hi - lo + {BINS - 1}) div {BINS}))")).groupBy("node", "bin").agg(F.sum("size").alias("w")).collect():
            found.setdefault(r["node"], {})[r["bin"]] = r["w"]
        for k, (wanted, below, lo, hi, slack) in list(search.items()):
            width = -(-(hi - lo) // BINS)
            for b in sorted(found.get(k, {})):
                if below + found[k][b] >= wanted:
                    break
                below += found[k][b]
            else:
                b = BINS - 1
            start, end = lo + b * width, lo + (b + 1) * width
            over = below + found.get(k, {}).get(b, 0) - wanted
            under = wanted - below
            if min(over, under) <= slack or width == 1:
                open_nodes[k].cut = start if under <= over else end
                del search[k]
            else:
                search[k] = [wanted, below, start, end, slack]
    return True


def _grown(rows: DataFrame, leaves: int, most: int = 1) -> tuple[DataFrame, list[Node]]:
    """rows with node, the place of their leaf, and the leaves."""
    rows, level = rows.withColumn("node", F.lit(0)), [Node(leaves)]
    while _split(rows, level, most):
        rows, level = _step(rows, level)
    return rows, level


def _placed(rows: DataFrame, shards: int) -> DataFrame:
    """rows (size, c0, c1, ...) with shard, 0 to shards - 1."""
    if shards <= MAX_LEAVES:
        return _grown(rows, shards)[0].withColumnRenamed("node", "shard")
    spark = rows.sparkSession
    dealt, parts = _grown(rows, shards, max(MAX_LEAVES, -(-shards // MAX_LEAVES)))
    path = fresh_path(spark, "parts")
    dealt.withColumnRenamed("node", "part").write.partitionBy("part").parquet(path)
    out, first = fresh_path(spark, "shards"), 0
    schema = rows.withColumn("shard", F.lit(0)).schema
    for k, part in enumerate(parts):
        if path_exists(spark, f"{path}/part={k}"):
            own = _placed(spark.read.schema(rows.schema).parquet(f"{path}/part={k}"), part.leaves)
            own.select(*rows.columns, (F.col("shard") + first).cast("int").alias("shard")).write.mode("append").parquet(out)
        first += part.leaves
    return spark.read.schema(schema).parquet(out) if path_exists(spark, out) else spark.createDataFrame([], schema)


def kd_shards(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot. Give the bytes that a shard should hold or the number of shards."""
    rows = measured(docs, id_col, text_col)
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    shards = shards or max(1, math.ceil(total / (target_bytes or 1)))
    groups = max(1, math.ceil(count / shards / ROWS_PER_SLOT_GROUP))
    placed = _placed(_coordinates(rows, total / shards), shards)
    placed = placed.select("id", "size", "crc", "h", "shard", F.pmod(F.xxhash64("id", "h"), F.lit(groups)).cast("int").alias("part"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("shard", "part").orderBy("id", "h")
    return placed.join(offsets, ["shard", "part"]).select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("offset") + F.row_number().over(own) - 1).alias("slot"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(read_table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
