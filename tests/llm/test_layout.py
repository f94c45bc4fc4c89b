import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerlens.llm import sharding, warc
from ledgerlens.llm.sharding import kd_shards, op1_sharding

from .cases import documents, empty


def test_shards_of_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = op1_sharding(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    weights, slots, places = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        data = (docs[r.doc_id] or "").encode()
        assert r["size"] == len(data) + 1 and r.text_crc32 == zlib.crc32(data) and r.law == "bytes" and r.grown_shard is None
        weights[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        places[docs[r.doc_id]].add(r.shard)
    assert sorted(weights) == list(range(16)) and max(weights.values()) < 1.1 * min(weights.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())


def test_shards_with_a_hot_text_and_awkward_rows(spark):
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i} " * (1 + i % 40), "en", "s") for i in range(3000)]
    got = kd_shards(documents(spark, rows), shards=16).collect()
    weights = Counter()
    for r in got:
        weights[r.shard] += r["size"]
    assert len(got) == 3000 and len(weights) == 16 and max(weights.values()) < 1.02 * sum(weights.values()) / 16
    odd = kd_shards(documents(spark), target_bytes=200_000).collect()
    assert len(odd) == 15 and {r["size"] for r in odd if r.doc_id in (3, 4)} == {1}
    assert kd_shards(empty(spark), shards=16).count() == 0


def plain_tree(points, leaves, most=1):
    """Shard of each point (weight, coordinates) by a K-d tree whose cuts are exact weighted medians."""
    if leaves <= most or not points:
        return {p: 0 for p in points}
    dim = max(range(len(sharding.DIMENSIONS)), key=lambda d: max(p[1][d] for p in points) // sharding._TIE - min(p[1][d] for p in points) // sharding._TIE)
    wanted, below = sum(p[0] for p in points) * (leaves // 2) / leaves, 0
    ordered, cut = sorted(points, key=lambda p: p[1][dim]), 0
    while cut < len(ordered) and below + ordered[cut][0] / 2 < wanted:
        below += ordered[cut][0]
        cut += 1
    left, right = plain_tree(ordered[:cut], leaves // 2), plain_tree(ordered[cut:], leaves - leaves // 2)
    return left | {p: k + leaves // 2 for p, k in right.items()}


@pytest.mark.parametrize("most", [256, 2])
def test_shards_against_a_plain_tree(spark, monkeypatch, most):
    """With no tolerance, cuts are those of a plain tree; with few leaves a tree, parts grow trees of their own, to like effect."""
    monkeypatch.setattr(sharding, "TOLERANCE", 0.0)
    monkeypatch.setattr(sharding, "MAX_LEAVES", most)
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab é") for _ in range(rng.randrange(1, 400))), "en", "s") for i in range(160)]
    measured = sharding.measured(documents(spark, rows))
    placed = sharding._coordinates(measured, measured.agg({"size": "sum"}).first()[0] / 5).collect()
    points = {(r["size"], (r.c0, r.c1, r.c2)): r.id for r in placed}
    got = {r.doc_id: r.shard for r in kd_shards(documents(spark, rows), shards=5).collect()}
    weights = Counter()
    for r in placed:
        weights[got[r.id]] += r["size"]
    assert sorted(weights) == list(range(5)) and max(weights.values()) - min(weights.values()) < 1200
    if most > 2:
        want = {points[p]: k for p, k in plain_tree(list(points), 5).items()}
        assert got == want


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, payload string, n long, sha string")


def test_warc_round_trip_and_revisits(spark):
    rng = random.Random(3)
    big = "x" * 1000
    rows = [(i, f"http://www.h{i % 5}.example.com/p/{i % 7}?b=1&a={i % 2}", rng.choice([big, "é" * 500, "short", None, "", big + "\r\n\r\n", "a\r\n\r\nWARC/1.0\r\n" * 90 + "\r\n", f"own {i} " * 200]), ) for i in range(400)]
    rows += [(400, None, "\r\n"), (401, "http://[bad", "\r\n\r\n"), (402, "https://a.example.com:8080/x\r\ny#f", big + "\n"), (None, "http://n.example.com", big)]
    path = warc.write_archives(pages(spark, rows).repartition(5))
    got = warc.capture_histories(spark, path).collect()
    best = {}
    for i, _, p in rows:
        data = (p or "").encode()
        if len(data) >= 1000:
            best[data] = max(best.get(data, -1), -1 if i is None else i)
    want = set()
    for i, _, p in rows:
        data = (p or "").encode()
        revisit = data in best and best[data] != i
        want.add((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", best[data] if revisit else None))
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want and len(got) == len(rows)
    assert [(r.url_key, r.captured) for r in got] == sorted((r.url_key, r.captured) for r in got)
    assert any(x[3] == "revisit" for x in want)


def test_warc_empty_and_null_pages(spark):
    assert warc.capture_histories(spark, warc.write_archives(pages(spark, []))).count() == 0
    (r,) = warc.capture_histories(spark, warc.write_archives(pages(spark, [(5, None, None)]))).collect()
    assert (r.page_id, r.payload_bytes, r.record_type, r.url_key) == (5, 0, "response", "")


def test_loser_tree():
    rng = random.Random(1)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted((rng.randrange(50), j, i) for i in range(rng.randrange(12))) for j in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_stream_rejects_damage():
    record = b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    stream = warc.Stream()
    assert [b for _, _, b in stream.feed(record * 2)] == [b"abc", b"abc"]
    stream.feed(b"WARC/1.0")
    with pytest.raises(ValueError):
        list(warc.Stream().feed(record.replace(b"3", b"2", 1)))
    cut = warc.Stream()
    list(cut.feed(record[:-5]))
    with pytest.raises(ValueError):
        cut.close()


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.com:80/A/?b=2&a=1#x") == "com,example)/a?a=1&b=2"
    assert warc.url_key(None) == ""
