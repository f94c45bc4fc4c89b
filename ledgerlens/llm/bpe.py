"""Operator 10, BPE encoding and decoding with a pair occurrence index.

The words of a block of whole texts are encoded together. An index maps each pair that occurs, by its rank, to all its
positions in the block; active ranks leave a heap in ascending order, all occurrences of a rank merge at once (left to right
where they overlap), and only the lists of the pairs at the merged positions' sides are updated. The vocabulary file is a
parameter; it is read on each worker from where it is installed.

Defined results: a null text counts as empty and has no tokens; strings of the file's added tokens in a text become their
ids; characters that the vocabulary lacks are left out; repeated rows are encoded alike; a row with a null id is returned too.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import columns, map_arrow, read_table, record_batch

#: White space as the tokenizer's patterns define it.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A block is encoded when it has so many different words or so many words.
BLOCK_DISTINCT, BLOCK_WORDS = 250_000, 6_000_000


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte: itself if printable, else the next from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class PairIndexBpe:
    """A tokenizer read from a tokenizers file of a byte-level BPE with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.strings: list[str] = [""] * self.size
        for token, i in vocab.items():
            self.strings[i] = token
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.added.items():
            self.strings[i] = token
        letters = byte_letters()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.final = np.array([vocab.get(c + self.suffix, -1) for c in letters], np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", _SPACE))
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without added tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.split.findall(text.lower())

    def pieces(self, text: str) -> Iterable[str | int]:
        """Words, and ids of added tokens."""
        if self.special is None or not self.special.search(text):
            return self.words(text)
        out: list[str | int] = []
        at = 0
        for m in self.special.finditer(text):
            out += self.words(text[at : m.start()])
            out.append(self.added[m[0]])
            at = m.end()
        return out + self.words(text[at:])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it never merges."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.order[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word begins (with the end of the last)."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):  # nothing but added tokens, say
            return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        last = np.cumsum(lengths) - 1
        ids = self.inner[data]
        ids[last] = self.final[data[last]]
        present = ids >= 0
        ids, owner = ids[present], owner[present]
        n = len(ids)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        edge = np.flatnonzero(owner[1:] != owner[:-1]) + 1
        after[edge - 1] = n
        before[edge] = -1
        if n:
            after[n - 1] = n
        alive = np.ones(n, bool)
        ids = np.append(ids, -1)  # what stands beyond a word's end
        pair = np.full(n + 1, -1, np.int64)
        pair[:n] = self._rank(ids[:n], ids[after])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(positions: np.ndarray) -> None:
            ranks = pair[positions]
            known = ranks >= 0
            positions, ranks = positions[known], ranks[known]
            if not len(positions):
                return
            by = np.argsort(ranks, kind="stable")
            positions, ranks = positions[by], ranks[by]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, group in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(positions, cuts), strict=True):
                lists = index.get(rank)
                if lists is None:
                    index[rank] = [group]
                    heapq.heappush(heap, rank)
                else:
                    lists.append(group)

        enter(np.arange(n))
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[alive[at] & (pair[at] == rank)]
            if not len(at):
                continue
            if (follows := after[at[:-1]] == at[1:]).any():  # the same letter thrice or more: every other one merges
                free, keep = True, np.ones(len(at), bool)
                for i, run in enumerate(follows.tolist(), 1):
                    free = not (run and free)
                    keep[i] = free
                at = at[keep]
            gone = after[at]
            ids[at] = self.merged[rank]
            alive[gone] = False
            pair[gone] = -1
            beyond = after[gone]
            after[at] = beyond
            inside = beyond < n
            before[beyond[inside]] = at[inside]
            left = before[at]
            touched = np.concatenate((left[left >= 0], at)) if len(at) < 2 else np.unique(np.concatenate((left[left >= 0], at)))
            pair[touched] = self._rank(ids[touched], ids[after[touched]])
            enter(touched)
        counts = np.bincount(owner[alive], minlength=len(words)) if n else np.zeros(len(words), np.int64)
        return ids[:n][alive], np.concatenate(([0], np.cumsum(counts)))

    def encode_many(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids (uint32) of each whole text, in order; texts are gathered in blocks of bounded size."""
        number, block, total = _Numbers(), [], 0
        for text in texts:
            block.append(np.array([number[w] for w in self.pieces(text)], np.int64))
            total += len(block[-1])
            if len(number) > BLOCK_DISTINCT or total > BLOCK_WORDS:
                yield from self._finish(number, block)
                number, block, total = _Numbers(), [], 0
        yield from self._finish(number, block)

    def _finish(self, number: _Numbers, block: list[np.ndarray]) -> Iterator[np.ndarray]:
        entries = list(number)
        flat, starts = self.encode_words([e if isinstance(e, str) else "" for e in entries]) if entries else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        special = {i: e for i, e in enumerate(entries) if not isinstance(e, str)}
        if special:
            flat = np.concatenate((flat, list(special.values())))
        begins, sizes = starts[:-1].copy(), np.diff(starts)
        for k, i in enumerate(special):
            begins[i], sizes[i] = starts[-1] + k, 1
        for words in block:
            n = sizes[words]
            offset = np.repeat(begins[words] - (np.cumsum(n) - n), n)
            yield flat[offset + np.arange(len(offset))].astype("<u4")

    def decode(self, ids: Iterable[int]) -> str:
        """The file names no decoder: tokens are joined by spaces; ids outside the vocabulary are left out."""
        return " ".join([self.strings[i] for i in ids if i < self.size])


class _Numbers(dict):
    def __missing__(self, word: str | int) -> int:
        n = self[word] = len(self)
        return n


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_loaded: dict[str, PairIndexBpe] = {}


def tokenizer(path: str) -> PairIndexBpe:
    """One per worker process."""
    if path not in _loaded:
        _loaded[path] = PairIndexBpe(path)
    return _loaded[path]


def _stream(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
    waiting: list[int | None] = []

    def texts() -> Iterator[str]:
        for ids, column in columns(batches, "id", "text"):
            for doc, text in zip(ids.to_pylist(), column, strict=True):
                waiting.append(doc)
                yield text.as_py() or ""

    for i, ids in enumerate(tokenizer(path).encode_many(texts())):
        yield waiting[i], ids
        waiting[i] = None


def _encoder(path: str, row: Callable, schema: pa.Schema, size: int = 500) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for doc, ids in _stream(path, batches):
            rows.append((doc, *row(tokenizer(path), ids)))
            held += len(ids)
            if len(rows) >= size or held > 1 << 20:
                yield record_batch(schema, *map(list, zip(*rows, strict=True)))
                rows, held = [], 0
        if rows:
            yield record_batch(schema, *map(list, zip(*rows, strict=True)))

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and decoded text of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
    run = _encoder(path, lambda t, ids: (ids.astype(np.int32), t.decode(ids.tolist())), schema)
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, "doc_id long, ids array<int>, decoded string")


def encoded_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Like encode, but with lengths and digests in place of ids and text, so that only these leave the worker."""
    run = _encoder(path, lambda t, ids: (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.decode(ids.tolist()).encode("utf-8", "surrogatepass")).hexdigest()), _SCHEMA, 2000)
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, SCHEMA)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
