"""Operator 2, scoring by a gated recurrent language model.

Counts of all training tokens come from every whole training document (crc32 of the id as text, mod 7, is not 2). The CORE most frequent words, with
the end, are predicted one by one; all others fall into suffix classes, within which a word's probability is its smoothed
share of the training tokens, (c + 1) / (N_class + V_class + 1), so known and unknown words of any number share one
distribution. The output softmax is factored into classes: frequency classes of core words and the suffix classes.

The network first warms up on whole training documents in the order of a hash, until they hold WARM_TOKENS tokens. Then each partition
trains over all of its training documents from there, with truncated backpropagation, and the weights are averaged by tokens:
blocks of weights are summed by key on the executors, and only the mean reaches the driver. Its size is fixed. So weights, and
scores, depend on how the table is cut into partitions; counts and base scores don't.

Words outside the HEAD most frequent ones (cut where a frequency step ends) meet their counts in a shuffled join, one row per document and word; a word's rows
there are few since HEAD words are more frequent.

Defined results: a null text counts as empty and has one token, the end; a null id counts as the id text ''; repeated rows are
scored alike; an empty table gives an empty result; without training documents all words are unknown.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import columns, map_arrow, read_table, record_batch, staged
from .recurrent import LANES, Adam, GatedModel, Lanes

CORE, CLASS_SLOTS, SUFFIX_CLASSES, HEAD = 1023, 32, 64, 200_000
HIDDEN, WARM_TOKENS, WARM_PASSES, WARM_RATE, RATE = 16, 400_000, 4, 0.02, 0.002
#: Tokens of one block of documents in lanes, words counted before they are handed on, and weights in one block of the average.
BLOCK_TOKENS, COUNTED_WORDS, WEIGHTS_PER_BLOCK = 3_000_000, 300_000, 4096
END, START = 0, CORE + 1 + SUFFIX_CLASSES


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.split() parts at the six white space characters of ASCII."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SUFFIX_CLASSES


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 7 == 2


_COUNT = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def rows() -> Iterator[pa.RecordBatch]:
        words = list(counts)
        for at in range(0, len(words), 20_000):
            yield record_batch(_COUNT, words[at : at + 20_000], [counts[w] for w in words[at : at + 20_000]])

    for (texts,) in columns(batches, "text"):
        for text in texts.to_pylist():
            counts.update(words_of(text))
        if len(counts) > COUNTED_WORDS:
            yield from rows()
            counts = Counter()
    yield from rows()


class Vocabulary:
    """The head words with their counts, and the totals of all."""

    def __init__(self, head: list[tuple[bytes, int]], documents: int, tokens: int, distinct: int, tail: dict[int, tuple[int, int]]) -> None:
        self.documents, self.tokens, self.distinct = documents, tokens, distinct
        core = head[:CORE]
        self.core = {w: k + 1 for k, (w, _) in enumerate(core)}  # 0 is the end
        self.known = dict(head)
        size = {k: sum(v) + 1 for k, v in tail.items()}  # tail: tokens and words of each suffix class
        self.log_size = np.array([math.log10(size.get(k, 1)) for k in range(SUFFIX_CLASSES)])
        n = len(core) + 1
        self.sizes = [min(CLASS_SLOTS, n - k) for k in range(0, n, CLASS_SLOTS)]
        self.classes = len(self.sizes) + SUFFIX_CLASSES
        every = np.arange(START)
        self.class_of = np.where(every > CORE, len(self.sizes) + every - CORE - 1, every // CLASS_SLOTS)
        self.slot_of = np.where(every > CORE, -1, every % CLASS_SLOTS)
        self.base_end = math.log10(documents + 1)
        self.base_size = math.log10(tokens + distinct + 1)

    def model(self) -> GatedModel:
        return GatedModel(START + 1, self.classes, self.sizes, HIDDEN)

    def symbol(self, word: bytes) -> int:
        """The network's number of a word: its own, or that of its suffix class."""
        n = self.core.get(word)
        return CORE + 1 + suffix_class(word) if n is None else n

    def targets(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and slot (-1 in suffix classes) of each symbol."""
        return self.class_of[symbols], self.slot_of[symbols]


class Encoder:
    """Turns words into numbers: those of the head by rank, all others -1, with one look-up a word."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.rank = {w: k for k, w in enumerate(vocabulary.known)}
        counts = np.fromiter(vocabulary.known.values(), np.float64, len(vocabulary.known))
        self.logs = np.log10(np.append(counts, 0) + 1)
        self.symbols = np.array([*[vocabulary.symbol(w) for w in vocabulary.known], -1], np.int32)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.rank.get, words, repeat(-1)), np.int64, len(words))

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols with the end, and ranks."""
        ranks = self.ranks(words)
        symbols = np.append(self.symbols[ranks], np.int32(END))
        for k in np.flatnonzero(ranks < 0).tolist():
            symbols[k] = CORE + 1 + suffix_class(words[k])
        return symbols, ranks


def train(model: GatedModel, vocabulary: Vocabulary, docs: list[np.ndarray], adam: Adam, lanes: int = LANES) -> None:
    """One pass of truncated backpropagation over whole documents, with the loss of every token."""
    block = Lanes(docs, START, lanes)
    h = np.zeros((len(block.lengths), model.hidden), np.float32)
    for x, y, fresh, _, live in block.windows():
        grads, h, _ = model.gradients(x, fresh, live, *vocabulary.targets(y), h[: x.shape[1]])
        adam.step(grads)


def score(model: GatedModel, vocabulary: Vocabulary, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each whole document's symbols, the state carried from window to window."""
    block = Lanes(docs, START)
    out = np.zeros(len(docs))
    h = np.zeros((len(block.lengths), model.hidden), np.float32)
    for x, y, fresh, owner, live in block.windows():
        with np.errstate(over="ignore"):
            states, _ = model.forward(x, fresh, h[: x.shape[1]], False)
        h = states[-1]
        if live.all():
            y, owner, states = y.ravel(), owner.ravel(), states.reshape(-1, model.hidden)
        else:
            y, owner, states = y[live], owner[live], states[live]
        out += np.bincount(owner, model.log_probabilities(states, *vocabulary.targets(y)), len(docs))
    return out


def _blocks(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[list[np.ndarray]]:
    docs, held = [], 0
    for (texts,) in columns(batches, "text"):
        for text in texts.to_pylist():
            docs.append(encoder.encode(words_of(text))[0])
            held += len(docs[-1])
            if held > BLOCK_TOKENS:
                yield docs
                docs, held = [], 0
    if docs:
        yield docs


def counted(texts: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """word, n of all training words (staged), and the vocabulary."""
    counts = staged(map_arrow(texts, _count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    documents = texts.count()
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    step = F.floor(F.log2("n") * 64)
    least, held = 1 << 30, 0
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("v")).orderBy(F.desc("step")).collect():  # some thousand rows
        if (held := held + r["v"]) > HEAD:
            break
        least = r["step"]
    head = sorted(((bytes(r["word"]), r["n"]) for r in counts.filter(step >= least).collect()), key=lambda r: (-r[1], r[0]))
    own = F.crc32(F.substring("word", -2, 2)) % SUFFIX_CLASSES
    tail = {r["k"]: [r["n"], r["v"]] for r in counts.groupBy(own.alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    for word, n in head[:CORE]:
        t = tail[suffix_class(word)]
        t[0], t[1] = t[0] - n, t[1] - 1
    return counts, Vocabulary(head, documents, (total or 0) + documents, distinct + (documents > 0), {k: (n, v) for k, (n, v) in tail.items()})


def fit(texts: DataFrame, vocabulary: Vocabulary) -> GatedModel:
    """texts: draw (0 to 1 by a hash of the id), text of all training documents."""
    spark = texts.sparkSession
    model = vocabulary.model()
    share = min(1.0, WARM_TOKENS / max(1, vocabulary.tokens))
    encoder = Encoder(vocabulary)
    warm, held = [], 0
    for r in texts.filter(F.col("draw") < 4 * share).orderBy("draw", "text").select("text").toLocalIterator():
        warm.append(encoder.encode(words_of(r["text"]))[0])
        if (held := held + len(warm[-1])) >= WARM_TOKENS:
            break
    if warm:
        adam = Adam(model, WARM_RATE)
        for k in range(WARM_PASSES):
            adam.rate = WARM_RATE / (1 + k)
            train(model, vocabulary, warm, adam, 48)
    shared = spark.sparkContext.broadcast((vocabulary, model))
    schema = pa.schema([("part", pa.int32()), ("tokens", pa.int64()), ("weights", pa.binary())])

    def tune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, start = shared.value
        own = words.model()
        own.load(start.flat())
        adam, tokens = Adam(own, RATE), 0
        for docs in _blocks(batches, Encoder(words)):
            train(own, words, docs, adam)
            tokens += sum(map(len, docs))
        if tokens:
            flat = own.flat()
            parts = [flat[k : k + WEIGHTS_PER_BLOCK] for k in range(0, len(flat), WEIGHTS_PER_BLOCK)]
            yield record_batch(schema, list(range(len(parts))), [tokens] * len(parts), [p.tobytes() for p in parts])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for parts, tokens, weights in columns(batches, "part", "tokens", "weights"):
            for part, n, w in zip(parts.to_pylist(), tokens.to_pylist(), weights.to_pylist(), strict=True):
                held = sums.setdefault(part, [0, 0.0])
                held[0] += n
                held[1] = held[1] + n * np.frombuffer(w, np.float32).astype(np.float64)
        if sums:
            yield record_batch(schema, list(sums), [n for n, _ in sums.values()], [(s / n).astype(np.float32).tobytes() for n, s in sums.values()])

    tuned = map_arrow(texts.select("text"), tune, "part int, tokens long, weights binary")
    parts = map_arrow(tuned.repartition("part"), mean, "part int, tokens long, weights binary").select("part", "weights").collect()
    if parts:
        model.load(np.concatenate([np.frombuffer(bytes(r["weights"]), np.float32) for r in sorted(parts, key=lambda r: r["part"])]))
    return model


SCORED = "rid long, id long, held_out boolean, n_tokens long, n_known long, base double, score double"
_SCORED = pa.schema([("rid", pa.int64()), ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))])


def scored(docs: DataFrame, vocabulary: Vocabulary, model: GatedModel) -> DataFrame:
    """docs: id, held_out, text. Sums over head words and the network's part; words and times: the others and how often they come."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, net = shared.value
        encoder = Encoder(v)
        rows, arrays, held, rid = [], [], 0, TaskContext.get().partitionId() << 36
        core, rare_from, size = len(v.core), CORE + 1, v.log_size

        def flush() -> Iterator[pa.RecordBatch]:
            if not rows:
                return
            found = score(net, v, arrays) / math.log(10)
            for at in range(0, len(rows), 1000):
                part = [(*r[:6], r[6] + f, *r[7:]) for r, f in zip(rows[at : at + 1000], found[at : at + 1000].tolist(), strict=True)]
                yield record_batch(_SCORED, *map(list, zip(*part, strict=True)))

        for ids, outs, texts in columns(batches, "id", "held_out", "text"):
            for i, out, text in zip(ids.to_pylist(), outs.to_pylist(), texts.to_pylist(), strict=True):
                words = words_of(text)
                symbols, ranks = encoder.encode(words)
                tail = Counter([words[k] for k in np.flatnonzero(ranks < 0).tolist()])
                logs, n = encoder.logs[ranks], len(symbols)
                rare = symbols[symbols >= rare_from] - rare_from
                within = float(logs[ranks >= core].sum()) - float(size[rare].sum())
                known = n - 1 - sum(tail.values()) + (v.documents > 0)
                rows.append((rid, i, out, n, known, float(logs.sum()) + v.base_end - n * v.base_size, within, list(tail), list(tail.values())))
                rid += 1
                arrays.append(symbols)
                held += n
                if held > BLOCK_TOKENS:
                    yield from flush()
                    rows, arrays, held = [], [], 0
        yield from flush()

    return map_arrow(docs, run, SCORED + ", words array<binary>, times array<int>")


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"), (F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)) / float(1 << 30)).alias("draw"), F.col(text_col).alias("text"))
    learned = rows.filter(~F.col("held_out")).select("draw", "text")
    counts, vocabulary = counted(learned.select("text"))
    model = fit(learned, vocabulary)
    found = staged(scored(rows.select("id", "held_out", "text"), vocabulary, model), "scored")
    tail = found.select("rid", F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("k"))).alias("x")).select("rid", "x.word", "x.k")
    sums = tail.join(counts, "word").groupBy("rid").agg(F.sum(F.col("k") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("k").alias("met"))
    more = F.coalesce("more", F.lit(0.0))
    return found.drop("words", "times").join(sums, "rid", "left").select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))
