import hashlib
import unicodedata
import zlib

import numpy as np
import pytest
import xxhash

from ledgerlens.llm import canonical
from ledgerlens.llm.bpe import PairIndexBpe, encode, op10_bpe
from ledgerlens.llm.language import ContextTrees, fit, identify, op9_language

from .cases import documents, empty

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")
ODD = ["", "  ", "aaaaaaa aaa <|endoftext|> x<|startoftext|>y", "ΣΑΣ ΟΔΟΣ İstanbul ﬁ \x1c\x85\xa0 x​z", "it's we'll 'TIS 123 ½ ²", "日本語 🎉🎉 힣", "!!!???...a's", "A\x00b\x1f", "mmmmmmmmmm ooooo hahahaha", "é é"]


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_white_space(library):
    mine = PairIndexBpe(PATH)
    odd = [*range(0, 33), 0x7F, 0x85, 0xA0, 0xAD, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}!{chr(c)}1" for c in odd]
    for text, ids in zip(texts, mine.encode_many(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_bpe_equals_library(library, spark, sf_dir):
    mine = PairIndexBpe(PATH)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + ODD
    for text, ids in zip(texts, mine.encode_many(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert mine.decode(want) == library.decode(want, skip_special_tokens=False)
    assert len(set(mine.merged.tolist())) == len(mine.merged)  # one merge makes each token, so ascending ranks are exact


def test_bpe_query(library, spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op10_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_block_of_added_tokens_only(library):
    for texts in (["<|endoftext|>"], ["<|endoftext|>", ""], ["<|startoftext|><|endoftext|>"] * 3):
        got = [ids.tolist() for ids in PairIndexBpe(PATH).encode_many(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe_awkward(spark, library):
    rows = encode(documents(spark), PATH).collect()
    assert len(rows) == 15 and {tuple(r.ids) for r in rows if r.doc_id in (3, 4, 12)} == {()}
    assert encode(empty(spark), PATH).count() == 0


def slow_canonical(text):
    return " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text or "").casefold()).split())


def test_canonical_against_brute_force(spark):
    rows = [r for r in documents(spark).collect() if r.doc_id is not None]
    extra = [(20 + i, t, "en", "s") for i, t in enumerate(ODD + ["x"])]
    docs = documents(spark, [(r.doc_id, r.text, r.lang, r.source) for r in rows] + extra)
    got = {}
    for r in canonical.fingerprints_of_edits(docs.repartition(4)).collect():
        got.setdefault(r.doc_id, []).append(r)
    ordered = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda x: x[0])
    assert sum(map(len, got.values())) == len(ordered)
    by_form = {}
    for k, (i, text) in enumerate(ordered):
        if i == 11:
            continue  # given twice
        following = ordered[(k + 1) % len(ordered)][1]
        n = len(text)
        edited = text[: n - n // 4] + following[: n // 4]
        (r,) = got[i]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == float(slow_canonical(edited) == slow_canonical(text))
        assert r.near_next == float(slow_canonical(following) == slow_canonical(text))
        assert by_form.setdefault(slow_canonical(text), r.fingerprint) == r.fingerprint
        assert r.fingerprint == xxhash.xxh3_128_hexdigest(slow_canonical(text).encode())
    assert len(set(by_form.values())) == len(by_form)


def test_canonical_ranges_and_empty(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = {tuple(r) for r in canonical.fingerprints_of_edits(docs).collect()}
    monkeypatch.setattr(canonical, "ROWS_PER_RANGE", 7)
    assert {tuple(r) for r in canonical.fingerprints_of_edits(docs).collect()} == one and len(one) == docs.count()
    assert canonical.fingerprints_of_edits(empty(spark)).count() == 0
    assert canonical.fingerprints(documents(spark)).count() == 15


def test_canonical_tells_equal_digests_apart(spark):
    texts = documents(spark, [(1, "a", "", ""), (2, "b", "", ""), (3, "A", "", "")])
    pack = canonical.zstandard.ZstdCompressor(level=1).compress
    batch = canonical.record_batch(canonical._FORMS, ["d", "d", "e"], [pack(b"a"), pack(b"b"), pack(b"a")])
    (out,) = canonical._variants(iter([batch]))
    assert out.to_pylist() == [{"digest": "d", "sha": hashlib.sha256(b"b").hexdigest(), "variant": 1}]
    names = canonical.Names({("d", hashlib.sha256(b"b").hexdigest()): 1})
    assert names.of(b"b", "d") == "d-1" and names.of(b"a", "d") == "d" and texts.count() == 3


def slow_bits(train, text, order):
    """Plain PPM code length, one byte at a time."""
    counts = {}
    for t in train:
        for o in range(order + 1):
            for i in range(o, len(t)):
                counts.setdefault(t[i - o : i], {}).setdefault(t[i], 0)
                counts[t[i - o : i]][t[i]] += 1
    padded, total = b"\0" * order + text, 0.0
    for i in range(order, len(padded)):
        for o in range(order, -1, -1):
            seen = counts.get(padded[i - o : i])
            if seen is None:
                continue
            size = sum(seen.values()) + len(seen)
            if padded[i] in seen:
                total -= np.log2(seen[padded[i]] / size)
                break
            total -= np.log2(len(seen) / size)
        else:
            total += 8
    return total


def test_code_lengths_against_plain_ppm():
    train = {"x": [b"the cat sat on the mat and the rat", b"then"], "y": [b"le chat est sur la table", b"zzz"]}
    trees = ContextTrees(train, 3)
    texts = [b"the hat", b"la chatte", b"qqq#!", b"t", b"", b"zz the le"]
    got = trees.code_lengths(texts)
    for t, row in zip(texts, got, strict=True):
        for language, bits in zip(trees.languages, row, strict=True):
            assert abs(bits - slow_bits(train[language], t, 3)) < 1e-3, (t, language)


def test_language_accuracy_and_awkward(spark):
    rows = [(r.doc_id, r.held_out, r.lang_pred, r.score) for r in op9_language(spark, "/root/testdata/sf0.01").collect()]
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [(truth[i], p) for i, h, p, _ in rows if h]
    assert len(rows) == len(truth) and sum(a == b for a, b in held) > 0.97 * len(held) > 0
    assert all(0 <= s <= 1 for *_, s in rows)
    docs = documents(spark)
    got = identify(docs, fit(docs)).collect()
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 10, 12)} == {"und"} and len(got) == 15
    assert identify(docs, fit(empty(spark))).filter("lang_pred <> 'und'").count() == 0
    assert identify(empty(spark), fit(docs)).count() == 0


def test_every_labelled_language_is_learned(spark):
    texts = [(100 * k + j, " ".join(f"{chr(0x4E00 + 40 * k + i)}" * 3 for i in range(12)), f"l{k:02}", "s") for k in range(80) for j in range(1 + k % 3)]
    rows = documents(spark, texts)
    learned = {r[2] for r in texts if zlib.crc32(str(r[0]).encode()) % 4 != 2}
    trees = fit(rows)
    assert len(learned) > 64 and set(trees.languages) == learned
    got = {r.doc_id: r.lang_pred for r in identify(rows, trees).collect()}
    assert all(got[i] == lang for i, _, lang, _ in texts if lang in learned)


def test_more_colliding_forms_than_are_shipped(spark, monkeypatch):
    monkeypatch.setattr(canonical, "MAX_SHIPPED", 1)
    monkeypatch.setattr(canonical.xxhash, "xxh3_128_hexdigest", lambda form: "0" * 31 + "ab"[len(form) % 2])
    rows = [(i, t, "en", "s") for i, t in enumerate(["a", "A", "b", "c c", "cc", "dd d", "", None, "B "])]
    docs = documents(spark, rows).coalesce(1)
    forms = {i: canonical.canonical(t) for i, t, *_ in rows}
    digests = {d: sorted({f for f in forms.values() if canonical.digest(f) == d}) for d in map(canonical.digest, forms.values())}
    texts = canonical._ids(docs, "doc_id", "text")
    variants = [(d, hashlib.sha256(f).hexdigest(), n) for d, fs in digests.items() for n, f in enumerate(fs) if n]
    names, table = canonical.named(spark.createDataFrame(variants, "digest string, sha string, variant long"))
    assert names.known is None and len(variants) > 2
    given = spark.createDataFrame([(i, names.of(f)) for i, f in forms.items()], "doc_id long, fingerprint string")
    got = {r.doc_id: r.fingerprint for r in canonical.resolved(given, names, table, "fingerprint").collect()}
    small = canonical.Names({(d, sha): n for d, sha, n in variants})
    assert got == {i: small.of(f) for i, f in forms.items()} and texts.count() == len(got)
    assert all((got[i] == got[j]) == (forms[i] == forms[j]) for i in forms for j in forms)
