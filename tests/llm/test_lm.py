import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgerlens.llm import lm_scoring
from ledgerlens.llm.lm_scoring import lm_scores, op2_lm_scoring
from ledgerlens.llm.recurrent import GatedModel, Lanes

from .cases import documents, empty


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    model = GatedModel(7, 4, [3, 2], hidden=5)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, c = rng.integers(0, 7, (6, 3)), rng.integers(0, 4, (6, 3))
    slots = np.where(c == 0, rng.integers(0, 3, c.shape), np.where(c == 1, rng.integers(0, 2, c.shape), -1))
    fresh, live = rng.random(x.shape) < 0.2, rng.random(x.shape) < 0.8
    h = np.tanh(rng.normal(size=(3, 5)))
    grads, _, loss = model.gradients(x, fresh, live, c, slots, h)
    for name, w in model.weights.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in w.shape)
            old, step = w[at], 2e-3
            values = []
            for d in (step, -step):
                w[at] = old + d
                values.append(model.gradients(x, fresh, live, c, slots, h)[2])
            w[at] = old
            assert abs((values[0] - values[1]) / (2 * step) - grads[name][at]) < 3e-3, name
    assert loss > 0


def test_windows_carry_the_state():
    rng = np.random.default_rng(1)
    v = lm_scoring.Vocabulary([(b"a", 5), (b"b", 3)], 2, 20, 6, {k: (2, 1) for k in range(lm_scoring.SUFFIX_CLASSES)})
    model = v.model()
    docs = [np.concatenate((rng.choice([1, 2, lm_scoring.CORE + 5], n), [0])).astype(np.int32) for n in (0, 1, 30, 200, 77, 3)]
    together = lm_scoring.score(model, v, docs)
    for d, got in zip(docs, together, strict=True):  # one document, one step at a time
        h, total = np.zeros((1, model.hidden), np.float32), 0.0
        for x, y in zip([lm_scoring.START, *d[:-1]], d, strict=True):
            states, _ = model.forward(np.array([[x]]), np.array([[False]]), h, False)
            h = states[-1]
            total += model.log_probabilities(states[0], *v.targets(np.array([y])))[0]
        assert abs(total - got) < 1e-3 * max(1, abs(total))
    assert Lanes([], 0).target.size == 0


def test_probabilities_sum_to_one():
    counts = {b"the": 9, b"of": 7, b"xa": 2, b"ya": 1, b"zz": 4}
    head = sorted(counts.items(), key=lambda r: -r[1])[:2]
    tail: dict[int, tuple[int, int]] = {}
    for w, n in counts.items():
        if w not in dict(head):
            k = lm_scoring.suffix_class(w)
            tail[k] = (tail.get(k, (0, 0))[0] + n, tail.get(k, (0, 0))[1] + 1)
    v = lm_scoring.Vocabulary(head, 3, 26, 6, tail)
    model = v.model()
    states = np.random.default_rng(2).normal(size=(1, model.hidden)).astype(np.float32)
    total = sum(math.exp(model.log_probabilities(states, *v.targets(np.array([s])))[0]) for s in range(3))
    for k in range(lm_scoring.SUFFIX_CLASSES):
        p = math.exp(model.log_probabilities(states, *v.targets(np.array([lm_scoring.CORE + 1 + k])))[0])
        mine = [n + 1 for w, n in counts.items() if w not in dict(head) and lm_scoring.suffix_class(w) == k]
        total += p * (sum(mine) + 1) / 10 ** v.log_size[k]  # all known words of the class and one unknown
    assert abs(total - 1) < 1e-5


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def test_scores_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HEAD", 3000)  # so that many words meet their counts in the join
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    train = {i for i in docs if zlib.crc32(str(i).encode()) % 7 != 2}
    counts = Counter(w for i in train for w in split(docs[i]))
    counts[None] = len(train)
    n, v = sum(counts.values()), len(counts)
    got = op2_lm_scoring(spark, sf).collect()
    assert len(got) == len(docs)
    gain = []
    for r in got:
        tokens = [*split(docs[r.doc_id]), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert r.held_out == (r.doc_id not in train) and r.train_tokens == n and r.n_tokens == len(tokens)
        assert r.n_known == sum(t in counts for t in tokens)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        if r.held_out:
            gain.append((r.score - r.base_score) / len(tokens))
    assert np.mean(gain) > 0.15, np.mean(gain)


def test_lm_awkward(spark):
    rows = lm_scores(documents(spark)).collect()
    assert len(rows) == 15 and all(r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 12)} == {1}
    assert lm_scores(empty(spark)).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    alone = lm_scores(documents(spark, [(i, "some words", "en", "s") for i in held])).collect()
    assert {(r.n_known, r.train_tokens) for r in alone} == {(0, 0)}


def test_every_token_gives_loss(spark, monkeypatch):
    taken, gradients, run = [], GatedModel.gradients, lm_scoring.map_arrow
    monkeypatch.setattr(GatedModel, "gradients", lambda self, x, fresh, live, *a: taken.append(int(live.sum())) or gradients(self, x, fresh, live, *a))
    texts = [" ".join(f"w{k % 50}" for k in range(n)) for n in (0, 1, 30, 200, 77, 3)]

    def here(frame, f, schema):
        if frame.columns == ["text"] and "weights" in schema:  # the pass over all documents, once more in this process
            assert list(f(iter([pa.record_batch({"text": texts})])))
        return run(frame, f, schema)

    monkeypatch.setattr(lm_scoring, "map_arrow", here)
    frame = spark.createDataFrame([(0.5, t) for t in texts], "draw double, text string")
    _, vocabulary = lm_scoring.counted(frame.select("text"))
    model = lm_scoring.fit(frame, vocabulary)
    tokens = sum(len(split(t)) + 1 for t in texts)
    assert sum(taken) == (lm_scoring.WARM_PASSES + 1) * tokens == (lm_scoring.WARM_PASSES + 1) * vocabulary.tokens
    assert model.hidden == 16 and lm_scoring.SUFFIX_CLASSES == 64
