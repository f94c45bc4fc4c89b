import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.patterns import title_case
from ledgerlens.operators import cleaning, explicit, manifest, mentions, policy, windows
from ledgerlens.operators.sentences import is_heading, sentence_array
from ledgerlens.rules import cues
from ledgerlens.rules import filings as R
from ledgerlens.sources import readers, writers
from ledgerlens.streaming.incremental import windows_of_arrivals


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'long'}" for k, v in values.items()) or "x string")
    return df.select(column.alias("r")).first().r


@pytest.mark.parametrize("mention,source,label,reason", [
    ("Inc.", None, "drop_obvious_junk", "exact_drop"), ("Charter", None, "drop_obvious_junk", "exact_drop"), ("com", None, "drop_obvious_junk", "exact_drop"),
    ("inhibitor", None, "drop_obvious_junk", "inhibitor_word"), ("FDA approval", None, "drop_obvious_junk", "fda_approval_phrase"), ("European", None, "drop_obvious_junk", "exact_drop"),
    ("Pfizer", None, "keep", "default_keep"), ("Pfizer", "Pfizer Inc.", "drop_obvious_junk", "self_source_full_match"), ("Acme", "Acme Pharmaceuticals, Inc.", "review", "self_source_fragment_review"),
    ("Charter Communications", None, "keep", "default_keep"), ("x", None, "keep", "whitelist"), ("AWS", None, "keep", "whitelist"), ("car", None, "review", "review_exact"), (".", None, "drop_obvious_junk", "punctuation_only"),
    ("1,234", None, "drop_obvious_junk", "pure_numeric"), ("Phase 2a", None, "drop_obvious_junk", "clinical_phase_prefix"), ("QQ", None, "review", "short_all_caps_2"), ("", None, "drop_obvious_junk", "empty_after_normalize"),
    ("“Globex”", "x", "keep", "default_keep"), ("• Initech", "x", "keep", "default_keep"), (None, "x", "drop_obvious_junk", "empty_after_normalize"),
])
def test_mention_policy(spark, mention, source, label, reason):
    r = one(spark, policy.label(F.col("m"), F.col("s")), m=mention, s=source)
    assert (r.label, r.reason) == (label, reason)


def test_title_case(spark):
    assert one(spark, title_case(F.col("n")), n="O'REILLY AT&T L3HARRIS U.S.") == "O'Reilly At&T L3Harris U.S."


def plain_sentences(text):
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text))
    words = "|".join([*cues.ABBREVIATIONS, *(rf"{a}\.{b}" for a, b in cues.DOTTED_ABBREVIATIONS)])
    text = re.sub(rf"\b(?:{words})\.", lambda m: m[0].replace(".", "\0"), text, flags=re.I)
    parts = re.split(r"(?<=[.!?])\s+(?=[A-Z\"])|(?<=[.!?])\n+|\n{2,}", text)
    return [s for s in (p.replace("\0", ".").strip() for p in parts) if s]


def test_sentences(spark):
    for text in ("We sell in the U.S. and U.K. Mr. Smith, e.g. Acme Inc. Leads. \"Yes.\" No?\nnext line\n\n\nEnd", "", "   ", "a", "A. B.C. d", "One.\nTwo! three? Four", "It is i.e. so.\n\nBy 5 p.m. it ends.  Next"):
        assert one(spark, sentence_array(F.col("t")), t=text) == plain_sentences(text), text


def test_every_cue_needs_a_word():
    for p in (*cues.STRICT, *cues.CONTEXTUAL, *cues.IMPLICIT):
        assert any(w in p for w in cues.CUE_WORDS), p
    assert all("compet" in p for p in cues.HEADINGS[0][1])


def test_heading_lines(spark):
    for text, want in (("COMPETITION", True), ("Our Market", True), ("This is a sentence.", False), ("x" * 121, False), ("Is it?", True), ("word a.Bc", False), ("A long heading that goes on and on beyond the eighty characters which are allowed here:", True)):
        assert one(spark, is_heading(F.col("t")), t=text) is want, text


def filing(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_window_table(spark):
    docs = filing(
        spark,
        "Intro here.\n\nCOMPETITION\n\nFirst words stand here.\n\nOur principal competitors include Acme.\n\nLast words stand here.",
        "Nothing is here. Barriers to entry are low. More is to come.",
        "Our customers include rivals of ours. The end is near.",
        "Market Competition\n\nPlain words without any of those cues stand in this line of text here, it is long.",
        "", None,
    )
    rows = {r.doc_id: r for r in windows.candidate_windows(docs).collect()}
    assert (rows[0].cue_group, rows[0].window_priority, rows[0].end_idx - rows[0].start_idx) == ("strict_explicit", 5, 2)
    assert (rows[1].cue_group, rows[1].window_priority, rows[1].start_idx) == ("implicit_or_broad", 1, rows[1].end_idx)
    assert 2 not in rows and rows[3].is_fallback and rows[3].window_priority == 0 and len(rows) == 4 - 1


def test_near_duplicates_are_greedy(spark):
    a = "We face competition from Alpha and Beta in the north region."
    docs = filing(spark, f"{a}\n\n{a[:-1]}s.\n\nWe compete with nobody else in those far away lands.")
    kept = windows.drop_near_duplicates(windows.candidate_windows(docs)).collect()
    assert len(kept) == 2 and [r.is_deduplicated for r in sorted(kept, key=lambda r: r.trigger_idx)] == [True, False]
    assert one(spark, F.size(windows.bigrams(F.col("t"))), t="a") == 0 and one(spark, windows.overlap(windows.bigrams(F.col("t")), windows.bigrams(F.col("t"))), t="a") == 1.0


def test_explicit_ids_have_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") % 300).alias("k"), F.lit("strict_explicit").alias("cue_group"), F.lit("strict").alias("export_bucket"))
    ids = [r.explicit_id for r in explicit.explicit_windows(df, ["k"]).orderBy("k").collect()]
    assert ids == [f"EXPW{n:07d}" for n in range(1, 301)]
    alias = spark.createDataFrame([(" ", "B", "x"), ("A", "B", None)], "a string, b string, c string")
    assert [tuple(r) for r in explicit.coalesce_columns(alias, {"n": ("a", "b"), "m": ("c", "zz")}).collect()] == [("B", "x"), ("A", "")]


def test_stems(spark):
    stems = ["2024-02-10__ACME_AND CO'S__0001166691-24-000011_business", "2024-13-10__X__0001166691-24-000011_business", "2024-01-01__only two", "junk"]
    rows = manifest.parse_stem(spark.createDataFrame([(s,) for s in stems], "stem string")).collect()
    assert (rows[0].company_name, rows[0].submitter_cik, rows[0].section_type, rows[0].parse_success) == ("Acme And Co'S", "1166691", "business", True)
    assert rows[1].filing_date is None and "no date" in rows[1].parse_notes and rows[2].accession is None and not rows[3].parse_success


def test_exclusions_and_purge(spark):
    names = ["Alpha Trust", "Nasdaq Global", "Beta Index Fund", "Trusted Partners Inc", "Gamma Corp"]
    got = [r.e for r in spark.createDataFrame([(n,) for n in names], "n string").select(manifest.is_excluded(F.col("n")).alias("e")).collect()]
    assert got == [True, True, True, False, False]
    df = spark.createDataFrame([("A  b ; C", "z"), ("x,Y", "z"), ("q", None)], "p string, o string")
    out = manifest.excluded_rows(df, spark.createDataFrame([("a B",), ("y",), (" ",)], "name string")).collect()
    assert {r.p: r.excluded for r in out} == {"A  b ; C": True, "x,Y": True, "q": False}


BODY = "We make goods of many kinds. " * 30


@pytest.mark.parametrize("text,mode,want", [
    ("plain words only", "canonical", "isolated/missing_both_no_competition_term"), ("we compete here", "canonical", "isolated/no_business_header_has_competition_term"), ("we compete here", "lenient", "none"),
    (f"Item 1. Business\n{BODY}\nItem 1A. Risk", "canonical", "no_outgoing_edges"), (f"Item 1. Business\n{BODY}\nItem 1A. Risk", "lenient", "business"), (f"Item 1. Business\n{BODY} We compete.\nItem 1A. Risk", "strict", "business"),
    ("Item 1. Business\nshort\nItem 1A. Risk", "canonical", "isolated/business_header_only"), (f"Competition\n{BODY}\nItem 1A. Risk", "canonical", "business"), (f"Competition\n{BODY}\nItem 1A. Risk", "strict", "isolated/no_business_header_has_competition_term"),
])
def test_routes(spark, text, mode, want):
    assert cleaning.route(filing(spark, text), mode).first().route == want


def test_sections(spark):
    toc = f"Item 1. Business ..... 5\nItem 1A. Risk ..... 9\n\nItem 1. Business\n{BODY}\nItem 1A. Risk Factors\nx"
    got = one(spark, cleaning.section(F.col("t"), R.BUSINESS_START, R.BUSINESS_LENGTH), t=toc)
    assert got.startswith("Item 1. Business\nWe make") and got.endswith("kinds.")
    assert one(spark, cleaning.section(F.col("t"), R.BUSINESS_START, (5000, 6000)), t=toc) is None
    assert one(spark, cleaning.section(F.col("t"), R.BUSINESS_START, R.BUSINESS_LENGTH), t="Item 1. Business\n" + BODY).endswith("kinds.")


def test_cleaning(spark):
    raw = "<DOCUMENT><TYPE>EX-99<TEXT>" + "long " * 50 + "</TEXT></DOCUMENT><DOCUMENT>\n<TYPE>10-K\n<TEXT><p>Item 1. Business</p><p>We sell<br>goods &amp; more.</p><script>x()</script><!-- c --><p>7</p></TEXT></DOCUMENT>"
    assert one(spark, cleaning.clean_filing(F.col("t")), t=raw) == "ITEM 1. BUSINESS\n\nWe sell goods & more."
    assert one(spark, cleaning.nfkc(F.col("t")), t="ﬁne") == "fine"
    df = spark.createDataFrame([(bytearray("é".encode()),), (bytearray(b"\xe9"),), (bytearray(b"\xef\xbb\xbfa"),), (None,)], "c binary")
    assert [r.r for r in df.select(cleaning.decode_text("c").alias("r")).collect()] == ["é", "é", "a", None]
    assert one(spark, cleaning.append_competition(F.col("b"), F.col("c")), b="text  ", c="c" * 200) == "text" + R.APPEND_MARK + "c" * 200
    assert one(spark, cleaning.append_competition(F.col("b"), F.col("c")), b="text  ", c="short") == "text  "


def test_mentions(spark):
    spans = F.array(*[F.struct(F.lit(t).alias("text"), F.lit(a).alias("start"), F.lit(b).alias("end")) for t, a, b in (("Bill.", 0, 5), ("com", 5, 8), ("x", 9, 10))])
    assert [tuple(r) for r in one(spark, policy.merge_dot_coms(spans), x="")] == [("Bill.com", 0, 8), ("x", 9, 10)]
    w = spark.createDataFrame([("w1", "Supplier#1 and Supplier#1 in Europe"), ("w2", "none")], "window_id string, window_text string")
    merged = mentions.merge_spans(mentions.extract_spans(w))
    raw = {r.window_id: r for r in mentions.mentions_raw(w, merged).collect()}
    unique = {r.window_id: r for r in mentions.mentions_unique(w, merged).collect()}
    assert raw["w1"].mentions == "Supplier#1 ; Supplier#1 ; Europe" and raw["w1"].starts == "0 ; 15 ; 29" and (raw["w2"].n_mentions, raw["w2"].mentions) == (0, "")
    assert unique["w1"].n_mentions == 2 and mentions.mention_surplus(merged).count() == raw["w1"].n_mentions - unique["w1"].n_mentions
    phrases = mentions.competitor_phrases(filing(spark, "Our competitors include large regional retailers, and we compete with large regional retailers. x"), "doc_id", "text").collect()
    assert [r.phrase for r in phrases] == ["large regional retailers"]


def test_phrases_by_clause_are_those_of_the_whole_text(spark):
    odd = [
        "Large regional retailers are our\ncompetitors. x", "Large regional retailers are competitors\r. x", "Large regional retailers are competitors", "Large regional retailers remain competitors\n",
        "a; Key COMPETITORS in some of the fields were many small regional stores! We compete with the many online stores, and more", "Vendors such as the many online stores; none", "", "...", None,
        "We compete\n with\nlarge regional retailers\nand others? Our competitors include large regional retailers",
    ]
    texts = spark.createDataFrame(list(enumerate(odd)), "doc_id int, text string")
    whole = F.concat(*[F.regexp_extract_all("text", F.lit("(?iU)" + p), 1) for p in mentions.R.PHRASES])
    want = {(r.doc_id, x.strip(" ").lower()) for r in texts.select("doc_id", whole.alias("found")).collect() for x in r.found or () if len(x.strip(" ")) >= 15}
    got = [(r.doc_id, r.phrase.lower()) for r in mentions.competitor_phrases(texts, "doc_id", "text").collect()]
    assert sorted(got) == sorted(want) and len(want) >= 6


def test_labels_and_votes(spark):
    assert one(spark, mentions.pipeline_role(F.col("l"), F.col("o")), l="PRODUCT_BRAND", o="") == "ignore_or_review"
    assert one(spark, mentions.parse_labels(F.col("t")), t="no json") is None
    rows = spark.createDataFrame([("a", "1", 3), ("a", "2", 1), ("a", "2", 5), ("b", "9", 2), ("b", "8", 1)], "k string, cik string, seen long")
    assert {r.k: r.cik for r in mentions.vote(rows, "k", "cik", "seen").collect()} == {"a": "2", "b": "8"}
    assert one(spark, mentions.name_key(F.col("n"), True), n="Acme Holdings, Inc.") == "acme"
    assert one(spark, manifest.rewrite_path(F.col("p"), "2023_x", "2023_y"), p="a/2023_x/b/2023_x1") == "a/2023_y/b/2023_x1"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "raw" / "0000123").mkdir(parents=True)
    (tmp_path / "raw" / "0000123" / "f_a.TXT").write_bytes("é".encode("cp1252"))
    (tmp_path / "raw" / "skip.bin").write_bytes(b"x")
    assert [(r.stem, r.text) for r in readers.file_tree(spark, str(tmp_path / "raw")).collect()] == [("f_a", "é")]
    assert [tuple(r) for r in readers.issuer_paths(spark, str(tmp_path / "raw")).collect()] == [("f_a", "0000123")]
    (tmp_path / "candidate_windows_strict.csv").write_text('\ufeffa,b\n"x\ny","q""z"\n', encoding="utf-8")
    paths = readers.discover(spark, str(tmp_path))
    assert [tuple(r) for r in readers.union_all(spark, paths).select("a", "b").collect()] == [("x\ny", 'q"z')]
    (tmp_path / "log.txt").write_text("Excluded companies (2)\n\nAcme\n")
    assert [r.name for r in readers.exclusions(spark, str(tmp_path / "log.txt")).collect()] == ["Acme"]
    (tmp_path / "m.json").write_text('[{"business_file": "x"}]')
    assert readers.manifest(spark, str(tmp_path / "m.json")).first().business_file == "x"
    df = spark.createDataFrame([(1, "business", "t"), (2, "none", "u")], "id long, route string, text string")
    writers.routed(df, str(tmp_path / "routed"))
    assert spark.read.parquet(str(tmp_path / "routed")).filter("route = 'business'").count() == 1
    writers.audit(df, str(tmp_path / "audit"), ["route"])
    df.write.parquet(str(tmp_path / "t"))
    writers.rewrite(spark.read.parquet(str(tmp_path / "t")).filter("id = 1"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    fresh = spark.createDataFrame([("k", "new")], "key string, v string")
    assert writers.merge_cache(spark.createDataFrame([("k", "old"), ("l", "old")], "key string, v string"), fresh, "key").orderBy("key").first().v == "new"
    assert writers.ordered_columns(["z", "a", "t", "l"], ["l"], ["t"]) == ["l", "a", "z", "t"]
    assert writers.label_requests(spark.range(5).select(F.col("id").alias("row_index"), F.lit("m").alias("mention")), ["mention"], 2).count() == 3


def test_streaming(spark, tmp_path):
    filing(spark, "We compete with Acme here. The end.").write.parquet(str(tmp_path / "in"))
    q = windows_of_arrivals(spark, str(tmp_path / "in"), "doc_id long, text string", str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_texts_are_split_once(spark, sf_dir):
    from ledgerlens.operators.sentences import sentences
    from ledgerlens.plans.filings import filings

    plan = sentences(filings(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_exploded_keeps_null_elements_and_drops_empty_arrays(spark):
    from ledgerlens.functions.rows import exploded

    rows = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "id int, xs array<string>")
    assert [tuple(r) for r in exploded(rows, ["id"], F.col("xs"), "x").collect()] == [(1, "a"), (1, None)]
