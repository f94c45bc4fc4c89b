"""Operator 7, SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are taken over whole texts in Arrow batches. Equal fingerprints fold into one row first. For radius r, 2^(r+1)-1
structured masks keep of each fingerprint the bits i with <v, c(i)> = 1 over GF(2), c(i) being a fixed non-zero code of
r+1 bits: whichever r bits differ, some v is orthogonal to their codes, so every pair within the radius shares a masked value
in some table. Within a bucket no pairs are listed: each member stands for itself and the values one of its free bits away,
and two members are within two bits exactly if they share such a centre. One link per member and centre, to the centre's
smallest member, keeps all components whole at a cost linear in the bucket.

near_groups serves cleaning, at a similarity of 0.8 or more over five-word shingles. Candidates are texts that share a value under one
of the covering masks, of fingerprints over the distinct shingles, or one of BANDS keys, each of the smallest hashes of the
shingles under BAND_ROWS functions: at a similarity of 0.8, 64 bits differ by about ten, more than any covering radius that
a corpus can afford, while a pair of 0.8 shares no key with a probability of (1 - 0.8^9)^64 = 1e-4, whatever the edit. Candidates
are grouped, and each group is checked exactly; of the texts that links of 0.8 or more connect one stays.

A group of any size is checked in parts of PART_ROWS rows and PART_BYTES bytes: each part links its own texts, one text for each
set of linked ones goes on to the next round, and in the end the texts outside the group's largest set are held, block by block, against
all parts of the group. So no task gets a group whole, and no similar pair of a group is left out.

Defined results: null and empty texts have fingerprint zero and are linked like any other; a null id is a row of its own
whose component_id is the smallest non-null id of its component (null if there is none); repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import columns, join_unique, map_arrow, read_table, record_batch, staged
from .components import connected_components

BITS, RADIUS, WORDS, SEED = 64, 2, 3, 42
#: near_groups: words in a shingle; least similarity as a fraction.
COPY_WORDS, SIMILAR = 5, (4, 5)
_SCHEMA = pa.schema([("id", pa.int64()), ("fp", pa.int64())])
#: near_groups: keys of a text, and functions whose smallest hashes make a key; keys that a worker knows before it starts afresh.
BANDS, BAND_ROWS, KNOWN_KEYS = 64, 9, 200_000
#: near_groups: rows and bytes of text of a group that one task takes.
PART_ROWS, PART_BYTES = 128, 4 << 20
_BANDED = pa.schema([("rid", pa.int64()), ("keys", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))])
#: Bits of the filter that lets documents with near copies, and a few others, go on to the shuffle.
_FILTER_BITS = 1 << 23
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: Shingle hashes counted at once.
_BLOCK = 1 << 14


def _shingles(text: str | None, words: int) -> list[int]:
    """Hashes of all shingles in order, repeats included; of the whole sequence if it is shorter; none without a word."""
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return []
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return [digest(joined, SEED)]
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-words] + 1))
    return [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist(), strict=True)]


def _majority(hashes: list[int] | np.ndarray) -> int:
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = np.array(hashes[at : at + _BLOCK], np.uint64)
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if over half of the hashes of the shingles, repeats included, have it."""
    return _majority(_shingles(text, words))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in columns(batches, "id", "text"):
        values = np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64)
        yield record_batch(_SCHEMA, ids, values)


def shingle_set(text: str | None) -> np.ndarray:
    """Signed hashes of the distinct five-word shingles; texts without a word share the one set of the empty sequence."""
    found = np.unique(np.array(_shingles(text, COPY_WORDS) or [xxhash.xxh64_intdigest(b"", SEED)], np.uint64))
    return found.view(np.int64)


def _odd(count: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << bits, count, np.dtype(f"uint{bits}"), endpoint=False) | np.dtype(f"uint{bits}").type(1)


_TIMES, _PLUS = _odd(BANDS * BAND_ROWS, 32, 1)[:, None], _odd(BANDS * BAND_ROWS, 32, 2)[:, None]
_MIX = _odd(BANDS * BAND_ROWS, 64, 3).reshape(BANDS, BAND_ROWS)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """Signed keys of a set of shingle hashes, one a band: equal if all of the band's smallest hashes are."""
    halves = (shingles.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * BAND_ROWS, (1 << 32) - 1, np.uint32)
    for at in range(0, halves.size, 512):
        np.minimum(least, (halves[at : at + 512] * _TIMES + _PLUS).min(axis=1), out=least)
    keys = (least.reshape(BANDS, BAND_ROWS).astype(np.uint64) * _MIX).sum(axis=1, dtype=np.uint64)
    return ((keys ^ keys >> np.uint64(29)) * _MIX[:, 0]).view(np.int64)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks as signed 64-bit values, for a radius up to 5. Bit i has code 1 + i mod (2^(r+1) - 1)."""
    if not 0 <= radius <= 5:
        raise ValueError("64 bits have all codes for a radius of 0 to 5")
    codes = [1 + i % ((1 << radius + 1) - 1) for i in range(BITS)]
    masks = [sum(1 << i for i, c in enumerate(codes) if (c & v).bit_count() & 1) for v in range(1, 1 << radius + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def mask_keys(print_: int) -> np.ndarray:
    """Signed keys of a fingerprint, one for each covering mask: equal if the masked values are."""
    masks = np.array(covering_masks(), np.int64).view(np.uint64)
    values = (np.uint64(print_) & masks) * _MIX[0, 0] + np.arange(1, len(masks) + 1, dtype=np.uint64) * _MIX[0, 1]
    return ((values ^ values >> np.uint64(31)) * _MIX[0, 2]).view(np.int64)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that are new to this worker, and the rows that first had the others.

    So a key with a third of all rows reaches the shuffle once for KNOWN_KEYS keys, not once a row.
    """
    first: dict[int, int] = {}
    for rids, texts in columns(batches, "rid", "text"):
        fresh, links = [], []
        for rid, text in zip(rids.to_pylist(), texts, strict=True):
            if len(first) > KNOWN_KEYS:
                first = {}
            shingles = shingle_set(text.as_py())
            keys = [*mask_keys(_majority(shingles.view(np.uint64))).tolist(), *band_keys(shingles).tolist()]
            known = [first.setdefault(k, rid) for k in keys]
            fresh.append([k for k, r in zip(keys, known, strict=True) if r == rid])
            links.append(list({*known} - {rid}))
        yield record_batch(_BANDED, rids, fresh, links)


def near_links(fps: DataFrame) -> DataFrame:
    """fps: distinct fp (long). Links a, b that connect exactly what pairs within two bits connect."""
    masks = covering_masks()
    tables = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])).alias("x")).select("fp", "x.*")
    crowded = tables.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1").select("t", "key")
    members = tables.join(crowded, ["t", "key"], "left_semi")
    bit = [1 << i if i < 63 else -(1 << 63) for i in range(BITS)]
    free = F.array(F.lit(0).cast("long"), *[F.when(F.col("mask").bitwiseAND(F.lit(b)) == 0, F.lit(b)) for b in bit])
    flips = F.filter(free, lambda x: x.isNotNull())
    centres = members.select("fp", "t", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("z"))
    stars = centres.groupBy("t", "z").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("t", "z", "a")
    return centres.join(stars, ["t", "z"]).filter("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (long) and component_id, the smallest id among those reachable over links of two bits or fewer."""
    rows = staged(map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), _fingerprints, "id long, fp long"), "fingerprints")
    fps = staged(rows.groupBy("fp").agg(F.min("id").alias("low"), F.count("*").alias("n")), "distinct")
    roots = connected_components(near_links(fps.select("fp")))
    known = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root"))
    known = staged(known, "known")
    lowest = known.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("m"))
    named = join_unique(known, lowest, "root", "m").select("fp", "component_id", "n")
    return join_unique(rows, staged(named, "named"), "fp", "n").select(F.col("id").alias("doc_id"), "fp", "component_id")


def similar_links(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links (positions in sets) that connect exactly what pairs of similarity SIMILAR or more connect, one per set at most.

    Each set reached looks up, among those not reached yet, the holders of its rarest |A| - ceil(0.8 |A|) + 1 shingles; a similar
    set has one of any that many. The index is built anew whenever half of its sets are reached, so dense groups stay cheap.
    """
    top, bottom = SIMILAR
    sizes = np.array([x.size for x in sets], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    values, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    waiting, mine = np.ones(len(sets), bool), np.zeros(len(values), bool)
    indexed, left = 0, len(sets)
    for seed in range(len(sets)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        left -= 1
        reached = [seed]
        while reached and left:
            if not indexed or 2 * left < indexed:
                held = waiting[owner]
                order = np.argsort(tokens[held], kind="stable")
                holders = owner[held][order]
                counts = np.bincount(tokens[held], minlength=len(values))
                starts, indexed = np.cumsum(counts) - counts, left
            x = reached.pop()
            own = tokens[begins[x] : begins[x + 1]]
            probes = own[np.argsort(counts[own], kind="stable")[: own.size - -(-top * own.size // bottom) + 1]]
            found = np.concatenate([holders[starts[t] : starts[t] + counts[t]] for t in probes])
            found = np.unique(found[waiting[found]])
            found = found[(bottom * sizes[found] >= top * own.size) & (top * sizes[found] <= bottom * own.size)]
            if not found.size:
                continue
            mine[own] = True
            shared = np.add.reduceat(mine[np.concatenate([tokens[begins[y] : begins[y + 1]] for y in found])], np.cumsum(sizes[found]) - sizes[found], dtype=np.int64)
            mine[own] = False
            near = found[bottom * shared >= top * (own.size + sizes[found] - shared)]
            waiting[near] = False
            left -= near.size
            reached.extend(near.tolist())
            yield from ((x, y) for y in near.tolist())


def _linked(names: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    pairs = [(names[x], names[y]) for x, y in similar_links(sets)] if len(sets) > 1 else []
    if pairs:
        yield record_batch(_LINKS, *map(list, zip(*pairs, strict=True)))


def _part_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches come sorted by group and part. Holds the sets of the current part and yields links between rows."""
    now, names, sets = None, [], []
    for roots, parts, rids, texts in columns(batches, "root", "part", "rid", "text"):
        for *place, rid, text in zip(roots.to_pylist(), parts.to_pylist(), rids.to_pylist(), texts, strict=True):
            if place != now:
                yield from _linked(names, sets)
                now, names, sets = place, [], []
            names.append(rid)
            sets.append(shingle_set(text.as_py()))
    yield from _linked(names, sets)


def numbered(docs: DataFrame, name: str = "rid") -> DataFrame:
    """docs with a number of each row, staged: rows that repeat an id, or have none, are told apart by it."""
    return staged(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def _parts(members: DataFrame) -> DataFrame:
    """members (rid, root, size) with the part of each row, of as many as its group needs; the groups' sums are made by partial aggregates."""
    sums = members.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    wanted = sums.select("root", "n", F.ceil(F.greatest(F.col("n") / PART_ROWS, F.col("bytes") / PART_BYTES)).alias("parts"))
    return join_unique(members, staged(wanted, "parts"), "root", "n").select("rid", "root", "size", "parts", F.pmod(F.xxhash64("rid"), F.col("parts")).alias("part"))


def _components(members: DataFrame, links: DataFrame) -> DataFrame:
    """members (rid, root, ...) with comp, the smallest row that the links connect it with."""
    found = connected_components(links).select(F.col("node").alias("rid"), F.col("root").alias("reached"))
    return staged(members.join(found, "rid", "left").select(*members.columns, F.coalesce("reached", "rid").alias("comp")), "components")


def _checked(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Links within each root and part of rows (root, part, rid), staged."""
    with_text = rows.select("root", "part", "rid").join(texts, "rid").repartition("root", "part").sortWithinPartitions("root", "part", "rid")
    return staged(map_arrow(with_text.select("root", "part", "rid", "text"), _part_links, "a long, b long"), "links")


def similar_groups(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) that connect exactly what pairs of similarity SIMILAR or more within a group connect.

    texts: rid, text; members: rid, root, size of the rows to compare, root naming the group.
    """
    dealt = staged(_parts(members), "dealt")
    links = _checked(texts, dealt)
    split = dealt.filter("parts > 1")
    if split.isEmpty():
        return links
    inner = links.join(split.select(F.col("rid").alias("a")), "a", "left_semi").select("a", "b")  # links of groups in parts
    rest, left = split, split.count()
    while left:  # what the parts' links don't connect, one row of each set, until it fits one part or shrinks no more
        rest = staged(_parts(_components(rest.select("rid", "root", "size"), inner).filter("rid = comp").select("rid", "root", "size")), "dealt")
        inner = staged(inner.unionByName(_checked(texts, rest)), "links")
        rest = rest.filter("parts > 1")
        before, left = left, rest.count()
        if 2 * left > before:
            break
    comps = _components(split, inner)
    sets = comps.groupBy("root", "comp").agg(F.count("*").alias("k"))
    largest = sets.groupBy("root").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("n"))
    marked = staged(join_unique(comps, staged(largest, "largest"), "root", "n"), "marked")
    links = links.unionByName(inner)
    strays = marked.filter("comp <> main")
    return links if strays.isEmpty() else links.unionByName(_checked(texts, _met(marked, strays)))


def _met(marked: DataFrame, strays: DataFrame) -> DataFrame:
    """root, part, rid: each part of a group with each block of the group's strays."""
    blocks = staged(_parts(strays.select("rid", "root", "size")), "blocks").select("rid", "root", F.col("parts").alias("blocks"), F.col("part").alias("block"))
    sizes = marked.groupBy("root").agg(F.count("*").alias("rows"), F.max("parts").alias("width"))
    per_root = staged(sizes.join(blocks.groupBy("root").agg(F.max("blocks").alias("height")), "root"), "sizes")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    own = join_unique(marked.select("rid", "root", "part"), per_root, "root", "rows").select("root", "rid", "part", every("height").alias("block"))
    sent = join_unique(blocks.select("rid", "root", "block"), per_root, "root", "rows").select("root", "rid", every("width").alias("part"), "block")
    return own.unionByName(sent).select("root", F.concat_ws(":", "part", "block").alias("part"), "rid").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Documents to drop: rid (row_col, the rows' own numbers, if they have any), doc_id, keep_id; one row per row that goes.

    Documents whose five-word shingles are 0.8 or more similar are linked; of each set of documents that links connect, also over
    documents that go, the one with the smallest id stays as keep_id. Null ids come last; rows that repeat an id are told apart.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *([F.col(row_col).alias("rid")] if row_col else []))
    rows = rows if row_col else numbered(rows)
    texts = rows.select("rid", "text")
    banded = staged(map_arrow(texts, _banded, "rid long, keys array<long>, links array<long>"), "banded")
    bucket = Window.partitionBy("key").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stars = banded.select(F.col("rid").alias("b"), F.explode("keys").alias("key")).select(F.first("b").over(bucket).alias("a"), "b")
    seen = banded.select(F.explode("links").alias("a"), F.col("rid").alias("b"))
    roots = staged(connected_components(stars.unionByName(seen).filter("a <> b").distinct()), "roots")
    groups = staged(roots.union(roots.select("root", "root").distinct()).select(F.col("node").alias("rid"), "root"), "groups")
    held = staged(_members(texts, groups).join(groups, "rid"), "held")
    links = similar_groups(held.select("rid", "text"), held.select("rid", "root", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("size")))
    found = staged(connected_components(links), "found")
    sets = staged(found.union(found.select("root", "root").distinct()).select(F.col("node").alias("rid"), "root").join(rows.select("rid", "id"), "rid"), "sets")
    first = sets.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("keep"), F.count("*").alias("n"))
    return join_unique(sets, staged(first, "first"), "root", "n").filter("rid <> keep.rid").select("rid", F.col("id").alias("doc_id"), F.col("keep.id").alias("keep_id"))


def _members(texts: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of texts whose rid is in roots, and a few others: a bitmap of hashed numbers spares the shuffle most other texts."""
    slot = F.pmod(F.xxhash64("rid"), F.lit(_FILTER_BITS)) + 1
    bits = np.zeros(_FILTER_BITS, bool)
    width = 1 << 15  # of Spark's bitmaps
    for r in roots.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect():
        bits[(r["k"] - 1) * width : r["k"] * width] = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            if batch.num_rows:
                yield batch.select(["rid", "text"]).filter(pa.array(held[batch.column(2).to_numpy() - 1]))

    return map_arrow(texts.select("rid", "text", slot.alias("slot")), run, "rid long, text string")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
