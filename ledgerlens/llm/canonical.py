"""Operator 4, canonical exact digests.

A text's canonical form is its NFKC form, case folded, NFKC again, with white space runs as one blank and none at the ends.
Its digest is the 128-bit xxhash of the canonical UTF-8 bytes. Texts with equal digests form a bucket; within a bucket
canonical bytes are compared, and a form that differs from the bucket's first (by bytes) gets a suffix with its number, so
that fingerprints are equal exactly if canonical forms are.

Only rows of crowded buckets send their texts to the comparison: a bitmap, built by partial aggregates, tells the rest apart before
the shuffle (16 bits for a crowded bucket, MOST_BITS at most; a full bitmap costs time, never a row). Forms that share their digests
are shipped to the workers up to MAX_SHIPPED, beyond that they are joined to the rows. Copies fold to one row
per batch and then per digest; the comparison runs over rows sorted by digest and bytes, as a stream, so it holds two forms
at a time however large a bucket is.

Defined results: a null text counts as empty; rows that repeat an id and text get the same fingerprint; a null id comes before
all others and rows of one id are ordered by their digest when the next document is sought; a single document is its own next;
an empty table gives an empty result. Edited texts are named by the buckets of the documents.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import columns, map_arrow, read_table, record_batch, staged

LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
#: Rows that one range of the next-document pass should hold, and the most ranges.
ROWS_PER_RANGE, MAX_RANGES = 4000, 1 << 16
#: Forms that share their digest with another are joined rather than shipped to all workers beyond this number.
MAX_SHIPPED = 10_000
_FIRST = -(1 << 63)


def canonical(text: str | None) -> bytes:
    if not text:
        return b""
    text = text.lower() if text.isascii() else unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(text.split()).encode("utf-8", "surrogatepass")


def digest(form: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(form)


_DIGESTS = pa.schema([("id", pa.int64()), ("digest", pa.string())])
_FORMS = pa.schema([("digest", pa.string()), ("form", pa.binary())])
_VARIANTS = pa.schema([("digest", pa.string()), ("sha", pa.string()), ("variant", pa.int64())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in columns(batches, "id", "text"):
        yield record_batch(_DIGESTS, ids, [digest(canonical(t)) for t in texts.to_pylist()])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by digest and form: neighbours are compared in full. One row for each form but a bucket's first."""
    unpack = zstandard.ZstdDecompressor()
    last, form, variant = None, b"", 0
    for digests, packed in columns(batches, "digest", "form"):
        rows = []
        for d, p in zip(digests.to_pylist(), packed.to_pylist(), strict=True):
            now = unpack.decompress(p)
            if d != last:
                last, form, variant = d, now, 0
            elif now != form:
                form, variant = now, variant + 1
                rows.append((d, hashlib.sha256(now).hexdigest(), variant))
        if rows:
            yield record_batch(_VARIANTS, *map(list, zip(*rows, strict=True)))


def collisions(texts: DataFrame, digests: DataFrame) -> DataFrame:
    """digest, sha and variant of each canonical form that shares its digest with a smaller, different form."""
    spark = texts.sparkSession
    crowded = staged(digests.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"), "crowded")
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * crowded.count()).bit_length()))
    crowded = crowded.select((F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % size).alias("p"))
    parts = crowded.groupBy((F.col("p") / 32768).cast("long").alias("part")).agg(F.bitmap_construct_agg(F.col("p") % 32768).alias("bits")).collect()
    bitmap = np.zeros(size // 8, np.uint8)
    for r in parts:
        bits = np.frombuffer(bytes(r["bits"]), np.uint8)
        bitmap[r["part"] * 4096 : r["part"] * 4096 + len(bits)] = bits
    shared = spark.sparkContext.broadcast(bitmap)

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for (column,) in columns(batches, "text"):
            found = {}
            for t in column.to_pylist():
                form = canonical(t)
                p = int((d := digest(form))[:8], 16) % size
                if shared.value[p >> 3] >> (p & 7) & 1:
                    found[d, form] = None
            if found:
                yield record_batch(_FORMS, [d for d, _ in found], [pack.compress(f) for _, f in found])

    # one compressor packs equal forms to equal bytes; different ones are told apart by the comparison
    packed = map_arrow(texts.select("text"), forms, "digest string, form binary").distinct()
    return map_arrow(packed.repartition("digest").sortWithinPartitions("digest", "form"), _variants, "digest string, sha string, variant long")


class Names:
    """Fingerprint of a canonical form: its digest, with a suffix if another form has the digest too.

    known is None where the suffixes are to be joined: then the name holds the form's digest by SHA-256 until `resolved`.
    """

    def __init__(self, known: dict[tuple[str, str], int] | None) -> None:
        self.known = known
        self.crowded = {d for d, _ in known or ()}

    def of(self, form: bytes, known_digest: str | None = None) -> str:
        d = known_digest or digest(form)
        if self.known is None:
            return f"{d}:{hashlib.sha256(form).hexdigest()}"
        if d in self.crowded and (v := self.known.get((d, hashlib.sha256(form).hexdigest()))):
            return f"{d}-{v}"
        return d


def named(variants: DataFrame) -> tuple[Names, DataFrame]:
    """variants as collisions() gives them, staged too: the names for workers, and what resolved() needs."""
    variants = staged(variants, "variants")
    if variants.count() > MAX_SHIPPED:
        return Names(None), variants
    return Names({(r["digest"], r["sha"]): r["variant"] for r in variants.collect()}), variants


def resolved(rows: DataFrame, names: Names, variants: DataFrame, *columns: str) -> DataFrame:
    """rows with whole fingerprints in the columns."""
    if names.known is not None:
        return rows
    for c in columns:
        suffix = variants.select(F.concat("digest", F.lit(":"), "sha").alias(c), "variant")
        rows = rows.join(suffix, c, "left").withColumn(c, F.concat(F.substring(c, 1, 32), F.coalesce(F.concat(F.lit("-"), F.col("variant").cast("string")), F.lit("")))).drop("variant")
    return rows


def _ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row."""
    texts = _ids(docs, id_col, text_col)
    names, variants = named(collisions(texts, staged(map_arrow(texts, _digests, "id long, digest string"), "digests")))
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, column in columns(batches, "id", "text"):
            yield record_batch(schema, ids, [names.of(canonical(t)) for t in column.to_pylist()])

    return resolved(map_arrow(texts, run, "doc_id long, fingerprint string"), names, variants, "fingerprint").select("doc_id", "fingerprint")


_NEXT = pa.schema([("range", pa.int32()), ("extra", pa.bool_()), ("key", pa.int64()), ("digest", pa.string()), ("id", pa.int64()), ("packed", pa.binary())])
_EDITED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def likeness(a: bytes, b: bytes) -> float:
    """Of the exact digests of two canonical forms: 1 if the forms are equal, byte by byte, else 0."""
    return float(a == b)


def fingerprints_of_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit: the last quarter replaced by the beginning of the next text by id.

    Texts move once, compressed, to ranges of ids; a range's first document is sent to the range before it too.
    """
    spark = docs.sparkSession
    texts = _ids(docs, id_col, text_col)
    digests = staged(map_arrow(texts, _digests, "id long, digest string"), "digests")
    names, variants = named(collisions(texts, digests))
    keys = digests.select(F.coalesce("id", F.lit(_FIRST)).alias("key"), "digest")
    total = keys.count()
    ranges = max(1, min(MAX_RANGES, -(-total // ROWS_PER_RANGE)))
    cuts = np.unique(np.array(keys.approxQuantile("key", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else [], np.float64)).astype(np.int64)
    in_range = spark.sparkContext.broadcast(cuts)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, d in columns(batches, "key", "digest"):
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(in_range.value, key.to_numpy(), "right").astype(np.int32)), key, d], names=["range", "key", "digest"])

    firsts = map_arrow(keys, numbered, "range int, key long, digest string").groupBy("range").agg(F.min(F.struct("key", "digest")).alias("first")).orderBy("range").collect()
    before = {tuple(r["first"]): firsts[i - 1]["range"] for i, r in enumerate(firsts)}  # of the first range: the last

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for ids, column in columns(batches, "id", "text"):
            rows = []
            for i, t in zip(ids.to_pylist(), column.to_pylist(), strict=True):
                key, d, packed = _FIRST if i is None else i, digest(canonical(t)), pack.compress((t or "").encode("utf-8", "surrogatepass"))
                rows.append((int(np.searchsorted(in_range.value, key, "right")), False, key, d, i, packed))
                if (key, d) in before:
                    rows.append((before[key, d], True, key, d, i, packed))
            yield record_batch(_NEXT, *map(list, zip(*rows, strict=True)))

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        last = None
        for rng, extra, ids, ds, packed in columns(batches, "range", "extra", "id", "digest", "packed"):
            out = []
            for r, x, i, d, p in zip(rng.to_pylist(), extra.to_pylist(), ids.to_pylist(), ds.to_pylist(), packed, strict=True):
                text = unpack.decompress(p.as_py()).decode("utf-8", "surrogatepass")
                form = canonical(text)
                now = (r, x, i, text, form, names.of(form, d))
                if last and last[0] == r and not last[1]:
                    mine, n = last[3], len(last[3])
                    edited = mine[: n - n // 4] + text[: n // 4]
                    edited_form = canonical(edited)
                    edited_name = names.of(edited_form)
                    out.append((last[2], n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), last[5], edited_name, likeness(last[4], edited_form), likeness(last[4], form)))
                last = now
            if out:
                yield record_batch(_EDITED, *map(list, zip(*out, strict=True)))

    dealt = map_arrow(texts, deal, "range int, extra boolean, key long, digest string, id long, packed binary")
    dealt = dealt.repartition("range").sortWithinPartitions("range", "extra", "key", "digest")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    edits = map_arrow(dealt, edit, schema)
    return resolved(edits, names, variants, "fingerprint", "edited_fingerprint").select(*edits.columns)


def op4_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_of_edits(read_table(spark, sf_dir, "documents"))
