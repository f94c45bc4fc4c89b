"""Operator 9, language identification by prediction by partial matching.

For each language a byte context tree of depth ORDER holds how often each byte followed each context. With the statistics
frozen, a byte costs -log2(count / (total + distinct)) in the longest context that has seen it, plus the escape cost
-log2(distinct / (total + distinct)) of every longer context that was seen without it; a context never seen costs nothing, and
a byte seen nowhere costs 8 bits more. All languages' trees are stored as one hash table per depth, from a context with its
byte to a row of code lengths, so a text is scored by whole-array look-ups. The language with the shortest exact code of the
whole text wins; its score is its posterior probability under equal priors.

The trees are a classifier's fit: they learn from at most about TRAIN_BYTES bytes of whole texts per language (all labelled
texts if there are fewer), picked by a hash of the id, whatever the order and number of rows. Every labelled language is learned, from
one text at least; with more than 64 languages, each learns from an equal share of ALL_BYTES.

Defined results: a null text or one without any letter is `und` with score 1; repeated rows are predicted alike; a null id
counts as the id text '' when training rows are chosen; with no labelled row every text is `und`; an empty table gives an
empty result. Ties go to the first language in code point order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import columns, map_arrow, read_table, record_batch

ORDER = 4
#: Training bytes per language, and of all languages together: with more than 64 languages each has a smaller share.
TRAIN_BYTES, ALL_BYTES = 1_000_000, 64_000_000
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_CHUNK = 1 << 20
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])


class Keys:
    """Open-addressing table from distinct uint64 keys to their positions, with whole-array look-ups."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.held = np.zeros(1 << bits, np.uint64)
        left, at, self.probes = np.arange(len(keys)), self._home(keys), 1
        while True:
            empty = self.slots[at] < 0
            first = np.unique(at[empty], return_index=True)[1]
            put = np.flatnonzero(empty)[first]
            self.slots[at[put]], self.held[at[put]] = left[put], keys[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            if not rest.any():
                break
            left, at = left[rest], (at[rest] + 1) & self.mask
            self.probes += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 if it isn't there."""
        at = self._home(keys)
        out = np.where(self.held[at] == keys, self.slots[at], -2)
        todo = np.flatnonzero((out == -2) & (self.slots[at] >= 0))
        for _ in range(self.probes):
            if not len(todo):
                break
            at_todo = (at[todo] + 1) & self.mask
            at[todo] = at_todo
            hit = (self.held[at_todo] == keys[todo]) & (self.slots[at_todo] >= 0)
            out[todo[hit]] = self.slots[at_todo[hit]]
            todo = todo[~hit & (self.slots[at_todo] >= 0)]
        out[(out == -2)] = -1
        return out


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each position the byte and the `order` bytes before it; positions before the text count as zero bytes."""
    out = data.astype(np.uint64)
    for k in range(1, order + 1):
        out[k:] |= data[:-k].astype(np.uint64) << np.uint64(8 * k)
    return out


class ContextTrees:
    """Frozen PPM statistics of several languages."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = ORDER) -> None:
        self.order, self.languages = order, sorted(texts)
        n = len(self.languages)
        self.tables: list[tuple[Keys, np.ndarray, np.ndarray]] = []
        counted = {}
        for j, language in enumerate(self.languages):
            parts = [np.frombuffer(t, np.uint8) for t in texts[language] if t]
            for o in range(order + 1):
                grams = np.concatenate([_grams(p, o)[o:] for p in parts]) if parts else np.zeros(0, np.uint64)
                counted[j, o] = np.unique(grams, return_counts=True)
        lower = None
        for o in range(order + 1):
            keys = np.unique(np.concatenate([counted[j, o][0] for j in range(n)])) if n else np.zeros(0, np.uint64)
            below = np.full((len(keys), n), 8.0) if o == 0 else lower(keys & np.uint64((1 << 8 * o) - 1))
            cost = below.astype(np.float64)
            for j in range(n):
                grams, counts = counted[j, o]
                context = grams >> np.uint64(8)
                # contexts are the grams without their last byte; those of one context stand together
                begins = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(grams) else np.zeros(0, np.int64)
                total = np.add.reduceat(counts, begins) if len(grams) else counts
                distinct = np.diff(np.concatenate((begins, [len(grams)])))
                mine = context[begins]
                at = np.minimum(np.searchsorted(mine, keys >> np.uint64(8)), max(len(mine) - 1, 0))
                if len(mine):
                    seen = mine[at] == keys >> np.uint64(8)
                    cost[seen, j] += -np.log2(distinct[at[seen]] / (total[at[seen]] + distinct[at[seen]]))
                    size = np.repeat(total + distinct, distinct)
                    cost[np.searchsorted(keys, grams), j] = -np.log2(counts / size)
            # what it costs to leave a context of o + 1 bytes: for the order above
            escape = np.zeros((len(keys), n), np.float32)
            if o < order:
                for j in range(n):
                    grams, counts = counted[j, o + 1]
                    if len(grams):
                        context = grams >> np.uint64(8)
                        begins = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
                        total, distinct = np.add.reduceat(counts, begins), np.diff(np.concatenate((begins, [len(grams)])))
                        at = np.searchsorted(keys, context[begins])
                        escape[at, j] = -np.log2(distinct / (total + distinct))
            self.tables.append((Keys(keys), cost.astype(np.float32), escape))
            lower = self._at(o)
        self.root_escape = np.zeros(n, np.float32)
        for j in range(n):
            counts = counted[j, 0][1]
            self.root_escape[j] = -math.log2(len(counts) / (counts.sum() + len(counts))) if len(counts) else 0

    def _at(self, order: int):
        return lambda grams: self.costs(grams, order)

    def costs(self, grams: np.ndarray, order: int | None = None) -> np.ndarray:
        """Bits that each gram's last byte costs in each language, with contexts of up to `order` bytes."""
        order = self.order if order is None else order
        keys, cost, _ = self.tables[order]
        row = keys.find(grams)
        missing = np.flatnonzero(row < 0)
        if not len(cost):
            return np.full((len(grams), len(self.languages)), 8.0, np.float32)
        out = cost[row]
        if len(missing):
            rest = grams[missing]
            if order == 0:
                out[missing] = 8.0 + self.root_escape
            else:
                context_keys, _, escape = self.tables[order - 1]
                found = context_keys.find(rest >> np.uint64(8))
                left = escape[found]
                left[found < 0] = 0
                out[missing] = left + self.costs(rest & np.uint64((1 << 8 * order) - 1), order - 1)
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        waiting: list[tuple[int, bytes]] = []
        held = 0

        def flush() -> None:
            grams = np.concatenate([_grams(np.frombuffer(t, np.uint8), self.order) for _, t in waiting])
            sizes = np.array([len(t) for _, t in waiting])
            sums = np.add.reduceat(self.costs(grams).astype(np.float64), np.cumsum(sizes) - sizes, axis=0)
            np.add.at(out, [i for i, _ in waiting], sums)

        for i, text in enumerate(texts):
            if not text:
                continue
            # a long text goes in overlapping pieces; the costs of the overlap count once
            for at in range(0, len(text), _CHUNK):
                if at:
                    piece = text[at - self.order : at + _CHUNK]
                    data = np.frombuffer(piece, np.uint8)
                    out[i] += self.costs(_grams(data, self.order)[self.order :]).sum(axis=0, dtype=np.float64)
                else:
                    waiting.append((i, text[:_CHUNK]))
                    held += len(waiting[-1][1])
            if held > _CHUNK // 4:
                flush()
                waiting, held = [], 0
        if waiting:
            flush()
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float | None]]:
        """Language, posterior and bits per byte of the best code for each text."""
        raw = [t.encode("utf-8", "surrogatepass") if t and _LETTER.search(t) else b"" for t in texts]
        if not self.languages:
            return [(UNKNOWN, 1.0, None)] * len(texts)
        bits = self.code_lengths(raw)
        best = bits.argmin(axis=1)
        low = bits[np.arange(len(raw)), best]
        share = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(axis=1)
        return [(self.languages[b], float(s), float(x) / len(r)) if r else (UNKNOWN, 1.0, None) for b, s, x, r in zip(best, share, low, raw, strict=True)]


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 4 == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ContextTrees:
    """Learn from labelled rows outside the held-out quarter; see TRAIN_BYTES and ALL_BYTES for the bounds."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size"), F.min(draw).alias("least")).orderBy(F.desc("size"), "lang").collect()
    if not sizes:
        return ContextTrees({})
    most = min(TRAIN_BYTES, ALL_BYTES // len(sizes))
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, most / max(1, r["size"])), r["least"]) for r in sizes], "lang string, share double, least double")
    texts: dict[str, list[bytes]] = {r["lang"]: [] for r in sizes}
    for r in rows.join(F.broadcast(shares), "lang").filter((draw < F.col("share")) | (draw == F.col("least"))).select("lang", "text").toLocalIterator():
        texts[r["lang"]].append(r["text"].encode("utf-8", "surrogatepass"))
    return ContextTrees(texts)


def identify(docs: DataFrame, trees: ContextTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, bits_per_byte of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by ALL_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in columns(batches, "id", "text"):
            found = shared.value.predict(texts.to_pylist())
            yield record_batch(_SCHEMA, ids, *map(list, zip(*found, strict=True)))

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, "doc_id long, lang_pred string, score double, bits_per_byte double")


def label(docs: DataFrame, trees: ContextTrees, most_bits: float, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs with the predicted language in lang_col; `und` rows and those coded with most_bits a byte or more go."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    text, lang = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = shared.value.predict(batch.column(text).to_pylist())
                new = pa.array([f[0] for f in found], pa.string())
                kept = pa.array([f[0] != UNKNOWN and f[2] < most_bits for f in found])
                yield pa.RecordBatch.from_arrays([new if k == lang else c for k, c in enumerate(batch.columns)], names=batch.schema.names).filter(kept)

    return map_arrow(docs, run, docs.schema)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")
