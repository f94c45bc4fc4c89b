import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from ledgerlens.llm import packing, pii

from .cases import LONG, documents, empty


def slow_pack(rows, capacity, slots):
    """Best fit by looking at all bins."""
    bins, out = [], []
    for i, source, cluster, size in rows:
        whole, rest = divmod(size, capacity)
        for p in range(whole):
            bins.append([0, [], []])
            out.append((i, p, p * capacity, capacity, len(bins) - 1, 0))
        if rest:
            fits = [(b[0], k) for k, b in enumerate(bins) if b[0] >= rest and (cluster is None or cluster not in b[2]) and (source is None or b[1].count(source) < slots)]
            if fits:
                k = min(fits)[1]
            else:
                bins.append([capacity, [], []])
                k = len(bins) - 1
            out.append((i, whole, whole * capacity, rest, k, capacity - bins[k][0]))
            bins[k][0] -= rest
            bins[k][1].append(source)
            bins[k][2].append(cluster)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["a", "b", "c", None]), st.sampled_from([1, 2, 3, None]), st.integers(1, 30)), max_size=60), st.integers(1, 3))
def test_best_fit_is_exact(rows, slots):
    rows = sorted(rows, key=lambda r: -(r[3] % 10))
    assert list(packing.pack_group(rows, 10, slots)) == slow_pack(rows, 10, slots)


def check_packing(docs, got, capacity, slots):
    places, bins = defaultdict(list), defaultdict(list)
    for r in got:
        places[r.doc_id].append((r.first_token, r.n_tokens))
        bins[r.bin_id].append(r)
    for i, text, _ in docs:
        n = len((text or "").encode().split()) + 1
        assert sorted(places[i]) == [(k, min(capacity, n - k)) for k in range(0, n, capacity)]
    known = {i: (s, (t or "").encode().lower().split()) for i, t, s in docs}
    for rows in bins.values():
        spans = sorted((r.bin_offset, r.bin_offset + r.n_tokens) for r in rows)
        assert spans[0][0] == 0 and spans[-1][1] <= capacity and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert max(Counter(known[r.doc_id][0] for r in rows if known[r.doc_id][0] is not None).values(), default=0) <= slots
        texts = [tuple(known[r.doc_id][1]) for r in rows]
        assert len(texts) == len(set(texts))
    return sum(r.n_tokens for r in got) / capacity / len(bins)


def test_packing_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert check_packing(docs, packing.op6_packing(spark, sf).collect(), packing.CAPACITY, packing.SOURCE_SLOTS) > 0.9


def test_packing_awkward(spark):
    rows = [r for r in documents(spark).collect() if r.doc_id not in (11, None)]
    docs = documents(spark, [(r.doc_id, r.text, r.lang, r.source) for r in rows])
    check_packing([(r.doc_id, r.text, r.source) for r in rows], packing.pack(docs, 500).collect(), 500, 4)
    assert packing.pack(documents(spark)).count() > 15 and packing.pack(empty(spark)).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(d):
    odd = [int(c) for c in d[::-1]]
    return (sum(odd[::2]) + sum(sum(divmod(2 * c, 10)) for c in odd[1::2])) % 10 == 0


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and plain_luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(alphabet="ab1.@-+ _%é", max_size=40), st.text(alphabet="0123456789.+- ()", max_size=60), st.from_regex(r"(x )?([0-9]{1,3}\.){3,6}[0-9]{1,4} ?[+]?[0-9 -]{12,22}", fullmatch=True)))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_of_long_runs():
    for text in ("1" * 300_000, "1." * 100_000, "a" * 300_000 + "@", "a@" * 100_000, "+1 " * 100_000, "1 " * 100_000):
        assert isinstance(pii.base_spans(text), list)
        pii.proposals(text)


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = pii.Trees().fit(x[:1500], y[:1500])
    assert ((trees.margin(x[1500:]) > 0) == y[1500:]).mean() > 0.9
    starts, chances = pii.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert starts.tolist() == [1, 2, 4] and chances.tolist() == [0, 0.5, 1]


def test_pii_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = pii.op8_pii(spark, sf).collect()
    assert len(got) == len(texts)
    extra = 0
    for r in got:
        base = plain_spans(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(spans)
        extra += len(spans) - len(base)
    assert sum(len(plain_spans(t)) for t in texts.values()) > 20 and extra < 20


def test_additions_and_clean_text(spark):
    detector = pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    assert detector.thresholds
    odd = ["please write to jane.doe [at] mail [dot] example [dot] com today", "call (456) 555-2186 for it", "card 4532.0151.1283.0366 was used"]
    for text, (base, spans) in zip(odd, detector.spans(odd), strict=True):
        assert not base and len(spans) == 1, text
    clean = ["version 2.0.11 of 2024-01-15 10:30", "pi is 3.14159265358979", "order 1234567 and 99 more", "look at this. dot the i", "id 4532015112830367", LONG]
    assert [s for _, s in detector.spans(clean)] == [[]] * len(clean)


def test_additions_on_documents_kept_apart(spark):
    """Labelled spans of documents that neither trees nor thresholds have seen: variants by rule, and proposals off the base."""
    quality = pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).quality
    assert quality and all(precision >= 0.95 for precision, _ in quality.values())
    assert quality["email"][1] > 0.9 and quality["phone"][1] > 0.8 and quality["card"][1] > 0.8, quality


def test_known_forms_are_no_negatives():
    for kind, piece in (("phone", "(456) 555-2186"), ("phone", "456-555-2186"), ("email", "jane [at] mail"), ("card", "4532.0151.1283.0366")):
        assert pii.known_form(kind, piece)
    for kind, piece in (("phone", "4565552186"), ("ip", "1-2-3-4"), ("card", "4532.0151.1283.0367"), ("email", "look at this")):
        assert not pii.known_form(kind, piece)


def test_redaction_and_awkward(spark):
    docs = documents(spark)
    detector = pii.fit(docs)
    assert len(pii.find(docs, detector).collect()) == 15 and pii.find(empty(spark), detector).count() == 0
    rows = {r.doc_id: r.text for r in pii.redact(docs, detector).collect()}
    assert rows[3] is None and rows[7] == LONG and rows[13] == "[EMAIL] or [PHONE] x\x1cy [IP]"
    assert pii.redact_text("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a[IP]f"
    assert pii.fit(empty(spark)).spans(["a@b.c"]) == [([("email", 0, 5)], [("email", 0, 5)])]


def test_every_number_of_a_long_run_is_proposed():
    numbers = [f"555-{100 + k}-4567" for k in range(300)]
    for gap in (" ", "  "):
        text = gap.join(numbers)
        found = {text[a:b] for kind, a, b in pii.proposals(text) if kind == "phone"}
        assert found == set(numbers)
