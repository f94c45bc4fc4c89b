import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens import queries
from ledgerlens.operators import audit, cleaning, labeling, manifest, mentions, offsets, policy, windows
from ledgerlens.operators import sentences as S
from ledgerlens.plans.filings import filings
from ledgerlens.rules import cues as C
from ledgerlens.rules import filings as R
from ledgerlens.rules import mentions as M
from ledgerlens.sources import readers, trees, writers


def test_page_text():
    raw = """<DOCUMENT><TEXT><html><head><title>t</title></head><ix:nonnumeric>kept</ix:nonnumeric><div style="DISPLAY : none">gone</div><p hidden="hidden">gone</p>
    <xbrli:context>gone</xbrli:context><table><tr><td>a</td><th>b</th></tr></table><p>caf&eacute; &#8220;x&#8221; &amp;amp; ﬁne</p><img src="x"><span aria-hidden="true">gone</span>
    <p>an exam-
    ple ends here. Item 1. Business</p></html>"""
    text = cleaning.plain_text(raw)
    assert "gone" not in text and "t\n" not in text.split("kept")[0] and text.startswith("kept")
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    assert lines == ["kept", "a", "b", "café “x” & fine", "an example ends here.", "Item 1. Business"]
    assert cleaning.plain_text(None) is None and cleaning.plain_text("") == "" and cleaning.plain_text("a < b <") .startswith("a")
    assert cleaning.plain_text("<div><p hidden='true'>no</div>yes</p>") == "yes"


def test_every_start_is_tried():
    body = "word " * 200
    text = f"Item 1. Business ..... 4\n{body}\nItem 1. Business\n{body}x\nItem 1A. Risk\nItem 1. Business\n{body}longer\nItem 2. Properties"
    found = cleaning.find_section(text, R.BUSINESS_START, R.BUSINESS_LENGTH)
    assert found.endswith("longer") and found.startswith("Item 1. Business")
    assert cleaning.find_section("Item 1. Business\n" + "b" * 100, R.BUSINESS_START, R.HEADER_ONLY_LENGTH).endswith("b")
    for text in (None, "", "no headings"):
        assert cleaning.find_section(text, R.BUSINESS_START, R.BUSINESS_LENGTH) is None


def test_offsets(spark):
    for text in ("", "a", " a\u200b \n b\xa0\xa0c\u2060", "\u200b", "  "):
        clean, starts, ends = offsets.with_offsets(text)
        assert len(clean) == len(starts) == len(ends) and "  " not in clean
        for k, c in enumerate(clean):
            piece = "".join(x for x in text[starts[k] : ends[k]] if x not in M.ZERO_WIDTH)
            assert piece == c or (c == " " and piece.isspace())
    assert offsets.with_offsets(None) == ("", [], [])
    row = spark.createDataFrame([("x\u200by  z",)], "t string").withColumn("n", offsets.normalized_with_offsets("t"))
    spans = [offsets.original_span(F.col("n"), F.lit(a), F.lit(b)) for a, b in ((0, 2), (2, 3), (3, 4), (3, 3), (-1, 2), (2, 9))]
    got = row.select(*[s.alias(f"s{k}") for k, s in enumerate(spans)]).first()
    assert [tuple(x) if x else None for x in got] == [(0, 3), (3, 5), (5, 6), None, None, None]
    assert offsets.kept_labels(" org, LOC;product org") == ("ORG", "LOC", "PRODUCT") and offsets.kept_labels(None) == ()
    assert offsets.text_column(["a"]) == "window_text" and offsets.text_column(["org_mentions_union_filtered"]) == "org_mentions_union_filtered" and offsets.text_column([], "x") == "x"


def test_offsets_query_by_brute_force(spark, sf_dir):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text is not None}
    for r in queries.q_offsets(spark, sf_dir).collect():
        clean, starts, ends = offsets.with_offsets("a\u200b \n\t" + texts[r.doc_id])
        assert (r.n_chars, r.digest) == (len(clean), hashlib.md5(clean.encode()).hexdigest())
        assert (r.start, r.end) == ((starts[1], ends[2]) if len(clean) > 2 else (None, None))


def test_routes_by_a_plain_rule(spark, sf_dir):
    """Canonical routes of the relation by the same sections, found row by row."""
    import re

    got = {r.doc_id: r.route for r in queries.q_isolated(spark, sf_dir).collect()}
    for r in filings(spark, sf_dir).collect():
        heads = [any(re.search(p, r.text, re.I | re.M) for p in ps) for ps in (R.BUSINESS_START, R.COMPETITION_START)]
        found = [cleaning.find_section(r.text, *x) for x in ((R.BUSINESS_START, R.BUSINESS_LENGTH), (R.COMPETITION_START, R.COMPETITION_LENGTH))]
        if any(heads) and not any(found):
            assert got.pop(r.doc_id) == "isolated/business_header_only"
        elif not any(heads):
            assert got.pop(r.doc_id).startswith("isolated/")
    assert not got


def labels(rows, label="COMPANY"):
    return json.dumps({"labels": [{"row_index": r, "llm_label": label} for r in rows]})


def test_labels_are_checked_repaired_and_given_up():
    assert [x["row_index"] for x in labeling.checked_labels("```json\n" + labels([2, 1]) + "\n```", [1, 2])] == [1, 2]
    for raw in ("no", "[]", "{}", labels([1]), labels([1, 2], "Odd"), '{"labels": [{"row_index": "1"}]}'):
        with pytest.raises(ValueError):
            labeling.checked_labels(raw, [1, 2])
    asked = []

    def slow(request):
        asked.append(json.loads(request))
        return "no" if len(asked) < 4 else labels([1])

    assert labeling.labelled_batch(slow, '{"items": []}', [1], 3, True, 0)[0]["llm_label"] == "COMPANY"
    assert len(asked) == 4 and "error" in asked[1] and asked[3]["rows"] == [1]
    with pytest.raises(RuntimeError):
        labeling.labelled_batch(lambda r: "no", "{}", [1], 2, False, 0)


def test_label_batches_and_resuming(spark):
    rows = spark.range(10).select(F.col("id").alias("row_index"), F.lit("A Trust").alias("mention_org"))
    requests = writers.label_requests(rows, ["mention_org"], 4)
    assert labeling.label_batches(requests, queries.stub_labeler, wait=0.0, most_calls=2).count() == 8
    assert labeling.label_batches(requests.filter("false"), queries.stub_labeler).count() == 0
    before = spark.createDataFrame([(0, "COMPANY"), (1, " ")], "row_index long, llm_label string")
    assert {r.llm_label for r in labeling.resumed(rows, before).collect()} == {None}  # of another length
    assert {r.row_index: r.llm_label for r in labeling.resumed(rows.limit(2), before).collect()} == {0: "COMPANY", 1: None}


def test_counts_and_columns(spark):
    df = spark.createDataFrame([(" 12 ", "A:1 ; A:3 ; x ; B:z"), ("1.5", ""), (None, None), ("-3", "C: 2 ")], "n string, c string")
    got = df.select(policy.safe_int(F.col("n")).alias("n"), policy.parsed_counts(F.col("c")).alias("c")).collect()
    assert [r.n for r in got] == [12, None, None, -3] and [r.c for r in got] == [{"A": 3}, {}, {}, {"C": 2}]
    out = policy.clean_columns(spark.createDataFrame([("w", "a ; b ; ", "a", "X ; Y ; X", "X:1")], "window_id string, org_mentions_union string, org_mentions_union_filtered string, mention_types_union string, prefilter_keep_count_by_type string")).first()
    assert tuple(out.asDict()) == M.CLEAN_COLUMNS and (out.org_mentions_union_count, out.org_mentions_removed_count, out.org_mentions_removed_count_by_type) == ("2", "1", "X:1 ; Y:1")
    assert policy.with_columns(df, ["n", "z"]).columns == ["n", "c", "z"]
    assert len(M.DROP) == len(set(M.DROP)) == 202


def test_audit_report(spark, sf_dir):
    w = queries._windows(spark, sf_dir)
    f = filings(spark, sf_dir)
    text = audit.report(audit.counts(audit.keyed(w, F.lit("business"))), audit.summary(w, f, windows.drop_near_duplicates(w)), f.join(w, "doc_id", "left_anti"), f.limit(60), listed=3)
    assert "by demotion" in text and "strict_explicit" in text and "and 57 more" in text


def test_windows_are_made_once(spark, sf_dir):
    """One scan of the documents, one split into sentences, one evaluation of the cue patterns; the other array is that of the folded windows."""
    plan = windows.drop_near_duplicates(queries._windows(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("pricing") <= 3 and plan.count("posexplode(all#") == 1 and plan.count("posexplode(") == 2
    assert sum("Relation [doc_id#" in line for line in plan.splitlines()) == 1


def test_trees_and_sinks(spark, tmp_path):
    for n in ("2023_10K_cleaned", "2024_10k_cleaned", "x_10k_cleaned", "2024_other"):
        (tmp_path / n).mkdir()
    base = str(tmp_path)
    assert [p.rpartition("/")[2] for p in trees.cleaned_folders(spark, base)] == ["2023_10K_cleaned", "2024_10k_cleaned"]
    assert trees.cleaned_folders(spark, base, 2025) == [] and trees.business_folder(f"{base}/2024_10k_cleaned") == f"{base}/2024_10K_business"
    with pytest.raises(ValueError):
        trees.business_folder("a/b")
    with pytest.raises(FileNotFoundError):
        trees.folders(spark, f"{base}/none")
    (tmp_path / "t" / "u").mkdir(parents=True)
    (tmp_path / "t" / "a.csv").write_text("n,v\nAcme,1\nBeta,2\n")
    (tmp_path / "t" / "u" / "b.csv").write_text("n,v\nBeta,2\n")
    (tmp_path / "t" / "skip.csv").write_text("n\nAcme\n")
    names = spark.createDataFrame([("acme",)], "name string")
    assert [tuple(r) for r in trees.purge_tree(spark, f"{base}/t", names, skip=["skip.csv"]).collect()] == [("a.csv", 2, 1, 1)]
    assert (tmp_path / "t" / "a.csv").read_text() == "n,v\nBeta,2\n" and trees.purge_tree(spark, f"{base}/t", names, skip=["skip.csv"]).count() == 0
    df = spark.createDataFrame([(1, "isolated/x"), (2, "business")], "doc_id long, route string")
    assert writers.isolated_audit(df, f"{base}/iso").count() == 1
    out = writers.mention_files(df, df, df.limit(0), f"{base}/m", "2024")
    assert out["org_diff"].endswith("2024_org_diff") and readers.csv(spark, out["mentions_raw"]).count() == 2
    moved = writers.backup(spark, [f"{base}/m", f"{base}/none"], f"{base}/old", "s1")
    assert moved == [f"{base}/old/s1/m"] and not (tmp_path / "m").exists()
    writers.node_files(df, df, df.select("route"), f"{base}/nodes")
    writers.node_files(df, df.limit(0), df.select("route"), f"{base}/nodes")
    assert not (tmp_path / "nodes" / "parse_issues").exists() and (tmp_path / "nodes" / "excluded_companies").exists()
    writers.bundle(spark.createDataFrame([(0, "{}")], "batch_no long, request string"), f"{base}/b")
    assert readers.csv(spark, f"{base}/b").columns == ["items_json"]


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, block long, around string, __n long, idx long")
    assert windows.drop_near_duplicates(windows.candidate_windows(docs)).count() == 0
    one = spark.createDataFrame([(1, "We compete with Acme. Rivals are many.", 5, "x", 6, 7), (2, None, 1, "y", 1, 1)], docs.schema)
    assert {r.doc_id for r in windows.candidate_windows(one).collect()} == {1}
    assert cleaning.route(one).count() == 2 and cleaning.route(docs).count() == 0
    assert mentions.merge_spans(mentions.extract_spans(spark.createDataFrame([("w", None)], "window_id string, window_text string"))).count() == 0
    assert manifest.node_cik(spark.createDataFrame([("a__b", None)], "stem string, submitter_cik string"), spark.createDataFrame([], "stem string, cik string, seen long")).first().cik is None


def test_offsets_are_kept_as_breaks(spark):
    """Memory goes with the places where offsets jump: prose has none, and a text of odd characters only has one for each."""
    text = "plain words, " * 10_000
    n = spark.createDataFrame([(text,)], "t string").select(offsets.normalized_with_offsets("t").alias("n")).select("n.*").first()
    assert n.clean == text and sum(len(x) for x in n if isinstance(x, list)) == 3
    pieces, rng = ("a", "é", "😀", " ", "\n", "\xa0", "\u200b", "\xad", "\u3000", "\x1c"), random.Random(3)
    texts = [None, "", "\u200b"] + ["".join(rng.choices(pieces, k=rng.randrange(1, 12))) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").withColumn("n", offsets.normalized_with_offsets("t"))
    ends = [offsets.original_span(F.col("n"), F.lit(a), F.lit(a + 2)).alias(f"s{a}") for a in range(12)]
    for r in rows.select("k", "n.clean", *ends).collect():
        clean, starts, stops = offsets.with_offsets(texts[r.k])
        assert r.clean == clean, texts[r.k]
        assert [tuple(x) if x else None for x in r[2:]] == [(starts[a], stops[a + 1]) if a + 2 <= len(clean) else None for a in range(12)], texts[r.k]


def test_python_functions_run_once_and_on_small_batches(spark, sf_dir):
    """A filter on a section made a second set of Python workers find it again; batches held 10,000 texts."""
    for name, sets in (("q_sections", 1), ("q_isolated", 1), ("q_routes", 1), ("q_append_status", 1), ("q_clean_filing", 2)):
        for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
            spark.conf.unset(f"spark.sql.execution.arrow.{key}")
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == sets, name
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000, name
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "2m", name


def test_summary_makes_windows_once(spark, sf_dir):
    """Windows were made three times; the row stays the same, for an empty table too."""
    assert queries.q_audit_summary(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
    for f in (filings(spark, sf_dir), filings(spark, sf_dir).filter("doc_id < 0"), filings(spark, sf_dir).withColumn("text", F.concat("text", F.lit("\n\n"), "text", F.lit("\n\n"), "text"))):
        w = windows.candidate_windows(f)
        row = audit.summary_of_documents(windows.folded(w), f).first()
        assert row == audit.summary(w, f, windows.drop_near_duplicates(w)).first()


def test_pairs_of_windows_make_windows_once(spark, sf_dir):
    """Windows were made for either side of a join; the pairs are those of plain loops, on documents with many windows."""
    for name in ("q_bigram_overlap_pairs", "q_dedup_candidates"):
        assert queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1, name
    rng, lines = random.Random(5), ("We face competition from Acme.", "Our rivals are many.", "Barriers to entry are low.", "Nothing is said here.", "COMPETITION", "We compete with Bolt in Europe.", "The sea is wide.")
    docs = spark.createDataFrame([(k, "\n\n".join(rng.choices(lines, k=40))) for k in range(20)], "doc_id long, text string")
    w = windows.candidate_windows(docs).cache()
    rows = w.collect()
    sets = lambda t: {t[k : k + 2] for k in range(len(t) - 1)}
    want = {(a.doc_id, a.trigger_idx, a.hint, b.trigger_idx, b.hint, round(len(sets(a.window_text) & sets(b.window_text)) / len(sets(a.window_text) | sets(b.window_text)), 6))
            for a in rows for b in rows if a.doc_id == b.doc_id and b.trigger_idx > a.trigger_idx and 0 <= b.start_idx - a.end_idx <= 5}
    got = windows.near_pairs(w).select("doc_id", "trigger_idx", "hint", "other_idx", "other_hint", "overlap").collect()
    assert len(got) == len(want) > 500 and set(map(tuple, got)) == want
    for text in ("", "a", "ab", "aaa", "a😀b\n\té😀", "日本語日本"):
        assert set(spark.createDataFrame([(text,)], "t string").select(windows.bigrams(F.col("t"))).first()[0]) == sets(text), text


def test_sentences_are_split_in_one_pass(spark, sf_dir):
    """Nine patterns went over every text, one after another, and the words that guard cues lower-cased a sentence eleven times."""
    plan = lambda name: queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan("q_sentences").count("regexp_replace(") <= 1
    assert plan("q_strict_nearby").count("lower(") <= 4
    pieces, rng = ("e.g.", "i.e.", "g.", "U.S.", "ä.m.", "p.m", "Inc.", "Öst.", "est.", "no.", "A", "b", "É", ".", "!", "?", " ", "  ", "\n", "\n\n\n", "\t", "\xa0", " ", "\"", "x\x01 B"), random.Random(7)
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 15))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")

    def in_passes(text):
        t = F.regexp_replace(F.regexp_replace(text, r"[ \t]{2,}|\t", " "), r"\n{3,}", "\n\n")
        for a, b in C.DOTTED_ABBREVIATIONS:
            t = F.regexp_replace(t, rf"(?iU)\.(?<=\b{a}\.)({b})\.", "\x01$1\x01")
        t = F.regexp_replace(t, rf"(?iU)\.(?<=\b(?:{'|'.join(C.ABBREVIATIONS)})\.)", "\x01")
        parts = F.split(t, r"(?U)\s(?<=[.!?]\s)\s*(?=[A-Z\"])|\n(?<=[.!?]\n)\n*|\n{2,}")
        return F.filter(F.transform(parts, lambda s: F.btrim(F.translate(s, "\x01", "."), F.lit(S._BLANKS))), lambda s: s != "")

    for r in rows.select("t", S.sentence_array(F.col("t")).alias("now"), in_passes(F.col("t")).alias("then")).collect():
        assert r.now == r.then, r.t


def test_only_cues_carry_the_sentences_around(spark, sf_dir):
    """Every sentence carried five, and all of them were sorted again."""
    rows = windows.annotated(filings(spark, sf_dir)).select("doc_id", "idx", "sentence", "cue_group", "around").collect()
    said = {(r.doc_id, r.idx): r.sentence for r in rows}
    for r in rows:
        assert r.around == (None if r.cue_group is None else [said[r.doc_id, k] for k in range(r.idx - 2, r.idx + 3) if (r.doc_id, k) in said])


def test_mention_surplus_needs_no_python(spark, sf_dir):
    plan = queries.q_org_diff(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan
