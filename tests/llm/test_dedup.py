import hashlib
from collections import defaultdict
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import simhash
from ledgerlens.llm.components import connected_components
from ledgerlens.llm.exact_dedup import exact_duplicates
from ledgerlens.llm.simhash import covering_masks, fingerprint, near_duplicates, near_groups, near_links, op7_simhash

from .cases import documents, empty


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_against_brute_force(spark):
    docs = documents(spark)
    rows = [(r.doc_id, lower(r.text)) for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    got = exact_duplicates(docs.repartition(5)).collect()
    assert len(got) == len(rows)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_text[r.text_sha256]
        assert r.doc_id in ids and r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_hot_group_and_empty(spark):
    docs = documents(spark, [(i, "Same" if i % 3 else f"t{i}", "en", "s") for i in range(3000)])
    got = exact_duplicates(docs.repartition(7)).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id % 3} == {(2999, 2000)}
    assert exact_duplicates(empty(spark)).count() == 0


def slow_fingerprint(text):
    words = [w for w in lower(text).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {i: slow_fingerprint(t) for i, t in texts.items()}
    roots = components_of(texts, [(a, b) for a, b in combinations(sorted(texts), 2) if (want[a] ^ want[b]).bit_count() <= 2])
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in op7_simhash(spark, sf_dir).collect()}
    assert got == {i: (want[i], roots[i]) for i in texts}
    assert len(set(roots.values())) < len(texts)


def test_near_awkward(spark):
    docs = documents(spark)
    got = near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert {r.fp for r in got if r.doc_id in (3, 4, 12)} == {0}
    assert {r.component_id for r in got if r.doc_id in (3, 4, 12)} == {3}
    assert near_duplicates(empty(spark)).count() == 0
    assert fingerprint("One two") == xxhash.xxh64_intdigest(b"one two", 42)


def test_masks_cover_and_links_are_exact(spark):
    masks = [m & (1 << 64) - 1 for m in covering_masks()]
    for a, b in combinations(range(64), 2):
        assert any(not m >> a & 1 and not m >> b & 1 for m in masks)
    import random

    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    points = set(base)
    for x in base:  # chains and crowded buckets
        for _ in range(40):
            points.add(x ^ sum(1 << k for k in rng.sample(range(64), rng.choice((1, 2, 3, 5)))))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in points}
    want = components_of(sorted(signed.values()), [(signed[a], signed[b]) for a, b in combinations(points, 2) if (a ^ b).bit_count() <= 2])
    fps = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    links = near_links(fps)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in links.collect())
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {n: r for n, r in want.items() if n in got} and all(n == r for n, r in want.items() if n not in got)


def test_components_of_a_path_and_star(spark):
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, i) for i in range(1001, 1500)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(path + star + [(7, 7)], "a long, b long")).collect()}
    assert set(got[i] for i in range(1, 301)) == {0} and set(got[i] for i in range(1001, 1500)) == {1000}


def words_of(text):
    return [w for w in lower(text).translate({c: " " for c in range(9, 14)}).split(" ") if w]


def likeness(a, b):
    a, b = words_of(a), words_of(b)
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a, b))
    return len(x & y) / len(x | y)


def copies_of(texts):
    """Smallest id of each id's set, of the sets that pairs of similarity 0.8 or more connect."""
    sets, holders = {}, defaultdict(list)
    for i, t in texts.items():
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
        for x in sets[i]:
            holders[x].append(i)
    pairs = {(a, b) for h in holders.values() for a, b in combinations(sorted(h), 2)}
    return components_of(texts, [(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])])


def first_of_copies(texts):
    """Ids that stay."""
    return sorted(i for i, r in copies_of(texts).items() if i == r)


def edited(rng, words, count):
    words = list(words)
    for _ in range(count):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_groups_keep_one_of_each(spark):
    import random

    rng = random.Random(4)
    texts = {}
    for n in range(3):  # the original comes last: its copies are below 0.8 to one another
        words = [f"w{n}x{k}" for k in range(200)]
        texts |= {n * 1000 + k: edited(rng, words, 4) for k in range(100)}
        texts[n * 1000 + 500] = " ".join(words)
    texts |= {5000: "", 5001: None, 5002: " \t", 5003: "word", 5004: "WORD", 5005: "alone"}
    want = copies_of(texts)
    got = near_groups(documents(spark, [(i, t, "en", "s") for i, t in texts.items()]).repartition(5)).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got) == sorted((i, r) for i, r in want.items() if i != r)
    assert len(got) == 3 * 100 + 3
    assert near_groups(empty(spark)).count() == 0
    repeated = [(1, "a b c", "en", "s"), (2, "a b c", "en", "s"), (2, "d e f", "en", "s"), (3, "d e f", "en", "s"), (3, "g h i", "en", "s"), (None, "A b c", "en", "s"), (None, "j", "en", "s"), (None, "J", "en", "s")]
    got = near_groups(documents(spark, repeated)).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0) for r in got) == [(0, 0), (0, 1), (2, 1), (3, 2)] and len({r.rid for r in got}) == 4


def test_near_groups_in_parts(spark, monkeypatch):
    """Groups far larger than a part, with sets that only the meeting of strays and parts can tell apart or connect."""
    import random

    monkeypatch.setattr(simhash, "PART_ROWS", 6)
    rng = random.Random(9)
    texts, base = {}, [f"w{k}" for k in range(150)]
    for k in range(60):
        texts[k] = edited(rng, base, rng.choice((1, 2, 6, 9)))
    chain = list(base)
    for k in range(40):  # each step similar to the one before it, the ends are not
        chain[3 * k : 3 * k + 2] = [f"c{k}", f"d{k}"]
        texts[100 + k] = " ".join(chain)
    docs = documents(spark, [(i, t, "en", "s") for i, t in texts.items()])
    want = first_of_copies(texts)
    members = docs.select(F.col("doc_id").alias("rid"), F.lit(0).cast("long").alias("root"), F.length("text").cast("long").alias("size"))
    links = simhash.similar_groups(docs.select(F.col("doc_id").alias("rid"), "text"), members).collect()
    assert all(likeness(texts[r.a], texts[r.b]) >= 0.8 for r in links)
    root = components_of(sorted(texts), [(r.a, r.b) for r in links])
    assert sorted(i for i, r in root.items() if i == r) == want and len(want) > 3


def test_near_groups_after_added_and_lost_passages(spark):
    import random

    rng = random.Random(6)
    draw = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts = {}
    for n in range(120):
        words = draw(rng.choice((100, 250, 600)))
        size = len(words)
        texts[2 * n] = " ".join(words)
        texts[2 * n + 1] = " ".join([words + draw(size // 10), words + draw(size // 5), words[: -size // 10], words[size // 7 :], words[: size // 2] + draw(size // 10) + words[size // 2 :], draw(size // 6) + words][n % 6])
    alike = {n for n in range(120) if likeness(texts[2 * n], texts[2 * n + 1]) >= 0.8}
    assert len(alike) > 100
    got = near_groups(documents(spark, [(i, t, "en", "s") for i, t in texts.items()]).repartition(5)).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got) == sorted((2 * n + 1, 2 * n) for n in alike)
