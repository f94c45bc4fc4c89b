"""One query per operator of the filing pipeline, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .functions.rows import exploded, in_small_batches, with_once
from .operators import audit, cleaning, explicit, labeling, manifest, mentions, offsets, policy, providers, windows
from .operators.sentences import sentences, with_cues, with_headings
from .plans.filings import filings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_SUFFIXES = ("", ", Inc.", " Trust", " Act", " Corp")
_JUNK = ("Inc.", "Charter", "com", "inhibitor", "FDA approval", "initial public offering", "supply chain services", "European", "Pfizer", "x", "AWS", "car", ".", "1,234", "Phase 2a", "QQ", "")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _windows(spark: SparkSession, sf: str) -> DataFrame:
    return windows.candidate_windows(filings(spark, sf))


def _identified(spark: SparkSession, sf: str) -> DataFrame:
    w = _windows(spark, sf)
    return w.withColumn("window_id", F.format_string("%d-%d-%d", "doc_id", "trigger_idx", F.col("is_fallback").cast("int")))


@query
def q_windows(spark, sf):
    return _windows(spark, sf).select("doc_id", "trigger_idx", "start_idx", "end_idx", "cue_group", "cue_tier", "cue_text", "window_priority", "heading_text", "heading_category", "window_text", "hint", "demotion_reason", "is_fallback")


@query
def q_sentences(spark, sf):
    return sentences(filings(spark, sf)).select("doc_id", "idx", "sentence")


@query
def q_cues(spark, sf):
    return with_cues(sentences(filings(spark, sf))).filter("cue_group is not null").select("doc_id", "idx", "cue_group", "cue_text", "cue_tier")


@query
def q_cue_top(spark, sf):
    return with_cues(sentences(filings(spark, sf))).filter("cue_group is not null").groupBy(F.lower("cue_text").alias("cue")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "cue").limit(20)


@query
def q_demotions(spark, sf):
    return with_cues(sentences(filings(spark, sf))).filter("demotion_reason is not null").select("doc_id", "idx", "demotion_reason")


@query
def q_headings(spark, sf):
    return with_headings(with_cues(sentences(filings(spark, sf)))).select("doc_id", "idx", "is_heading", "heading_text", "heading_category", "under_competition")


@query
def q_strict_nearby(spark, sf):
    return with_headings(with_cues(sentences(filings(spark, sf)))).filter("strict_nearby").select("doc_id", "idx")


@query
def q_heading_blocks(spark, sf):
    rows = with_headings(with_cues(sentences(filings(spark, sf)))).filter("block > 0")
    return rows.groupBy("doc_id", "block").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"))


@query
def q_fallback(spark, sf):
    return _windows(spark, sf).filter("is_fallback").select("doc_id", "trigger_idx", "heading_text", "window_text")


@query
def q_bigram_overlap_pairs(spark, sf):
    return windows.near_pairs(_windows(spark, sf)).select("doc_id", "trigger_idx", "other_idx", "overlap")


@query
def q_overlap_histogram(spark, sf):
    return q_bigram_overlap_pairs(spark, sf).groupBy(F.floor(F.col("overlap") * 10 + 1e-9).cast("bigint").alias("decile")).agg(F.count("*").alias("n"))


@query
def q_dedup(spark, sf):
    return windows.drop_near_duplicates(_windows(spark, sf)).select("doc_id", "trigger_idx", "is_fallback", "is_deduplicated", "window_priority")


@query
def q_buckets(spark, sf):
    return _windows(spark, sf).groupBy(windows.export_bucket(F.col("cue_group")).alias("export_bucket")).agg(F.count("*").alias("n"), F.round(F.avg(F.length("window_text")), 6).alias("mean_chars"))


@query
def q_audit_counts(spark, sf):
    return audit.counts(audit.keyed(_windows(spark, sf), F.lit("business")))


@query
def q_audit_summary(spark, sf):
    w = _windows(spark, sf).select("doc_id", "trigger_idx", "window_priority", "cue_tier", "is_fallback", "window_text")
    return audit.summary_of_documents(windows.folded(w), filings(spark, sf))


@query
def q_demotion_top(spark, sf):
    rows = with_cues(sentences(filings(spark, sf))).filter("demotion_reason is not null").groupBy("demotion_reason").agg(F.count("*").alias("n"))
    return manifest.first_rows(rows, 10, F.desc("n"), "demotion_reason")


@query
def q_dedup_candidates(spark, sf):
    pairs = windows.near_pairs(_windows(spark, sf))
    return windows.duplicate_candidates(pairs).select("doc_id", "trigger_idx", "other_idx", "overlap", "hint", "other_hint")


@query
def q_export_order(spark, sf):
    rows = _windows(spark, sf).join(filings(spark, sf).select("doc_id", "filing_year", "company"), "doc_id").select("filing_year", "company", "window_priority", "doc_id", "trigger_idx", "is_fallback")
    return explicit.numbered(rows, windows.export_order(), "W", "position").select("position", "doc_id", "trigger_idx", "is_fallback")


@query
def q_union_sample(spark, sf):
    w = _identified(spark, sf).select("window_id", "cue_group", "cue_text", "window_priority")
    both = w.filter("cue_group = 'strict_explicit'").unionByName(w.filter("cue_group in ('contextual_explicit', 'strict_explicit')"))
    once = manifest.first_by_key(both, ["window_id"], [F.desc("window_priority")])
    return manifest.sample_rows(once.filter("cue_text <> 'ecosystem'").select("window_id"), "window_id", 100, 42)


@query
def q_contains(spark, sf):
    return manifest.first_rows(filings(spark, sf).filter(F.contains(F.col("company"), F.lit("Trust"))).select("doc_id", "company"), 15, "doc_id")


@query
def q_rescued(spark, sf):
    return _windows(spark, sf).groupBy("doc_id").agg(F.bool_and("is_fallback").alias("r")).filter("r").select("doc_id")


@query
def q_zero_window_files(spark, sf):
    return filings(spark, sf).select("doc_id", "stem").join(_windows(spark, sf).select("doc_id"), "doc_id", "left_anti")


@query
def q_explicit(spark, sf):
    w = _windows(spark, sf).withColumn("export_bucket", windows.export_bucket(F.col("cue_group"))).select("doc_id", "cue_group", "cue_text", "window_text", "window_priority", "export_bucket")
    return explicit.explicit_windows(w, ["doc_id", "cue_text", "window_text", "cue_group", "window_priority", "export_bucket"]).select("explicit_id", "doc_id", "cue_group", "cue_text", "window_text")


@query
def q_section_type(spark, sf):
    rows = with_headings(with_cues(sentences(filings(spark, sf)))).groupBy("doc_id").agg(F.max("is_competition").alias("c"), F.max(F.col("sentence").rlike(r"(?i)\bbusiness\b") & F.col("is_heading")).alias("b"))
    return rows.select("doc_id", F.expr("case when c and b then 'both' when c then 'competition_only' when b then 'business_only' else 'neither' end").alias("section_type"))


def _manifest(spark, sf):
    f = manifest.content_stats(manifest.parse_stem(filings(spark, sf)))
    lookup = filings(spark, sf).select(F.regexp_extract("stem", r"(\d{10}-\d{2}-\d{6})", 1).alias("accession"), "cik", "doc_id")
    lookup = lookup.filter("doc_id % 7 <> 0").unionByName(lookup.filter("doc_id % 11 = 0").withColumn("cik", F.concat("cik", F.lit("9"))))
    return manifest.resolve_issuers(f, lookup.drop("doc_id"))


@query
def q_stem_parse(spark, sf):
    return manifest.parse_stem(filings(spark, sf)).select("doc_id", "filing_date", "company_name", "accession", "section_type", "submitter_cik", "parse_notes", "parse_success")


@query
def q_cik_resolution(spark, sf):
    return _manifest(spark, sf).select("doc_id", "source_cik", "source_cik_source")


@query
def q_manifest(spark, sf):
    return manifest.content_stats(filings(spark, sf), large=1000).select("doc_id", "text_char_count", "text_line_count", "is_large", "section_presence")


@query
def q_manifest_summary(spark, sf):
    m = _manifest(spark, sf)
    return m.groupBy("section_type").agg(F.count("*").alias("n"), F.count_if("parse_success").alias("parsed"), F.count_if(F.col("source_cik").isNull()).alias("unresolved"))


@query
def q_nodes(spark, sf):
    return manifest.company_nodes(_manifest(spark, sf))[0].select("company_name", "cik", "stem")


@query
def q_node_exclusions(spark, sf):
    return filings(spark, sf).filter(manifest.is_excluded(F.col("company"))).groupBy("company").agg(F.count("*").alias("n"))


@query
def q_enriched_nodes(spark, sf):
    extra = spark.read.parquet(f"{sf}/supplier.parquet").select((1000 + F.col("s_suppkey")).cast("string").alias("cik"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))).alias("ticker"), F.lit("Industrials").alias("gics_sector"), F.col("s_suppkey").alias("pos"))
    return manifest.enrich(manifest.company_nodes(_manifest(spark, sf))[0], extra, "pos").select("stem", "cik", "ticker", "gics_sector")


@query
def q_purge_report(spark, sf):
    rows = filings(spark, sf).select("doc_id", F.concat_ws(" ; ", "company", F.col("cik")).alias("names"), "filing_year")
    names = spark.read.parquet(f"{sf}/supplier.parquet").filter("s_suppkey % 3 = 0").select(F.concat(F.lit("  Index FUND  of "), "s_name").alias("name"))
    return manifest.excluded_rows(rows, names, columns=["names"]).groupBy("filing_year").agg(F.count("*").alias("input_rows"), F.count_if("excluded").alias("removed_rows"), F.count_if(~F.col("excluded")).alias("output_rows"))


def _mention_rows(spark, sf):
    suppliers = spark.read.parquet(f"{sf}/supplier.parquet")
    k = F.col("s_suppkey")
    suffix, junk = F.array(*map(F.lit, _SUFFIXES)), F.array(*map(F.lit, _JUNK))
    names = [F.concat("s_name", F.get(suffix, (k % 5).cast("int"))), F.get(junk, (k % len(_JUNK)).cast("int")), F.get(junk, ((k * 7 + 3) % len(_JUNK)).cast("int")), F.lit("Globex Corporation")]
    return suppliers.select(k.alias("row_id"), F.concat_ws(" ; ", *names).alias("org_mentions"), F.concat_ws(" ; ", F.lit("COMPANY"), F.lit("PRODUCT"), F.when(k % 2 == 0, "REGION")).alias("mention_types"), F.concat("s_name", F.lit(" Holdings, Inc.")).alias("source_company"))


@query
def q_label_mentions(spark, sf):
    rows = _mention_rows(spark, sf).select("row_id", "source_company", F.posexplode_outer(policy.split_list(F.col("org_mentions"))).alias("pos", "mention")).filter("pos is not null")
    return rows.withColumn("l", policy.label(F.col("mention"), F.col("source_company"))).select("row_id", "pos", "mention", "l.label", "l.reason")


@query
def q_label_counts(spark, sf):
    return q_label_mentions(spark, sf).groupBy("label", "reason").agg(F.count("*").alias("n"))


@query
def q_prefilter_lists(spark, sf):
    return policy.prefilter(_mention_rows(spark, sf)).select("row_id", "mentions_keep", "mentions_drop", "mentions_review", "drop_reasons", F.col("union_count").cast("bigint"), F.col("keep_count").cast("bigint"))


@query
def q_prefilter_clean(spark, sf):
    return policy.prefilter(_mention_rows(spark, sf)).select("row_id", "union_types", "keep_types", F.col("removed_count").cast("bigint"))


@query
def q_filtered_out(spark, sf):
    rows = policy.prefilter(_mention_rows(spark, sf))
    return mentions.filtered_out(rows, policy.split_list(F.col("org_mentions")), policy.split_list(F.col("mentions_keep"))).select("mention", "removed")


def _spans(spark, sf):
    w = _identified(spark, sf)
    return w, mentions.merge_spans(mentions.extract_spans(w))


@query
def q_span_merge(spark, sf):
    return _spans(spark, sf)[1]


@query
def q_mentions_raw(spark, sf):
    return mentions.mentions_raw(*_spans(spark, sf))


@query
def q_mentions_nonraw(spark, sf):
    return mentions.mentions_unique(*_spans(spark, sf))


@query
def q_org_diff(spark, sf):
    return mentions.mention_surplus(_spans(spark, sf)[1])


@query
def q_dotcom_merge(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    n = F.length("p_brand")
    spans = F.array(F.struct(F.concat("p_brand", F.lit(".")).alias("text"), F.lit(0).alias("start"), (n + 1).alias("end")), F.struct(F.when(F.col("p_partkey") % 2 == 0, "com").otherwise("Corp").alias("text"), (n + 1).alias("start"), (n + 5).alias("end")))
    return exploded(p, ["p_partkey"], policy.merge_dot_coms(spans), "s").select("p_partkey", "s.text", "s.start", "s.end")


@query
def q_competitor_phrases(spark, sf):
    return mentions.competitor_phrases(filings(spark, sf), "doc_id", "text")


@query
def q_html_text(spark, sf):
    p = spark.read.parquet(f"{sf}/pages.parquet")
    return p.select("page_id", cleaning.normalize_space(cleaning.html_to_text(cleaning.strip_blocks(F.col("html")))).alias("text")).select("page_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


@query
def q_page_lines(spark, sf):
    p = spark.read.parquet(f"{sf}/pages.parquet")
    lines = exploded(p, ["page_id"], F.split(cleaning.normalize_space(cleaning.html_to_text(F.col("html"))), "\n"), "line")
    return lines.withColumn("junk", cleaning.is_junk_line(F.col("line"))).groupBy("page_id").agg(F.count("*").alias("n_lines"), F.count_if("junk").alias("junk_lines"))


@query
def q_clean_filing(spark, sf):
    f = in_small_batches(filings(spark, sf))
    raw = F.concat(F.lit("<DOCUMENT>\n<TYPE>10-K\n<TEXT><html><ix:header>x</ix:header>"), F.regexp_replace("text", "\n\n", "<p>"), F.lit("</html></TEXT></DOCUMENT><DOCUMENT><TYPE>EX-99<TEXT>other</TEXT></DOCUMENT>"))
    return f.select("doc_id", cleaning.nfkc(cleaning.clean_filing(raw)).alias("cleaned"))


@query
def q_sections(spark, sf):
    f = in_small_batches(filings(spark, sf))
    from .rules import filings as R

    s = cleaning.section(F.col("text"), R.BUSINESS_START, R.BUSINESS_LENGTH)
    return with_once(f, "section_text", s).filter("section_text is not null").select("doc_id", F.length("section_text").cast("bigint").alias("n_chars"), F.md5("section_text").alias("digest"))


@query
def q_routes(spark, sf):
    modes = ("canonical", "strict", "lenient")
    rows = cleaning.route_features(filings(spark, sf)).select("doc_id", "has_business_header", "has_competition_header", "has_term", "sections")
    for mode in modes:  # the features are made once, each mode only decides
        rows = cleaning.route(rows, mode).withColumnRenamed("route", f"in_{mode}").drop("section_source", "section_text")
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), F.col(f"in_{m}").alias("route")) for m in modes]))
    return rows.select(pairs.alias("x")).groupBy("x.mode", "x.route").agg(F.count("*").alias("n"))


@query
def q_isolated(spark, sf):
    return cleaning.route(filings(spark, sf)).filter(F.startswith("route", F.lit("isolated/"))).select("doc_id", "stem", "route")


@query
def q_append_status(spark, sf):
    f = filings(spark, sf)
    own = F.concat(F.lit("Item 1. Business\n"), F.repeat(F.lit("We make goods. "), 60), F.lit("\nCompetition\n"), F.repeat(F.lit("Rivals are many. "), 30), F.lit("\nItem 1A. Risk"))
    cleaned = f.select("stem", F.when(F.col("doc_id") % 3 == 0, F.lit("No headings.")).otherwise(own).alias("text"))
    from .rules import filings as R

    files = f.filter("doc_id % 5 <> 0").select("stem", F.when(F.col("doc_id") % 4 == 0, F.lit("x" + R.APPEND_MARK + "y")).otherwise("x").alias("content"))
    return cleaning.append_status(cleaned, files).groupBy("status", "reason").agg(F.count("*").alias("n"))


@query
def q_content_fallback(spark, sf):
    f = filings(spark, sf)
    head = F.element_at(F.array(F.lit("Section: Risk\n"), F.lit("Item 1. Business\n"), F.lit("Item 1 our competition\n"), F.lit("")), (F.col("doc_id") % 4 + 1).cast("int"))
    return f.select("doc_id", manifest.content_section_type(F.concat(head, F.substring("company", 1, 20)), F.col("doc_id") % 9 == 0).alias("section_type"))


@query
def q_overlay(spark, sf):
    parsed = manifest.parse_stem(filings(spark, sf)).select("doc_id", "company_name", "submitter_cik")
    given = filings(spark, sf).select("doc_id", F.when(F.col("doc_id") % 3 == 0, "Given Name").when(F.col("doc_id") % 3 == 1, " ").alias("company_name"), F.when(F.col("doc_id") % 4 == 0, "77").alias("submitter_cik"))
    return manifest.overlay(parsed, given, "doc_id", ["company_name", "submitter_cik"])


@query
def q_first_present(spark, sf):
    rows = filings(spark, sf).select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("a\\b"), "cik")).otherwise("").alias("business_path"), F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.col("stem")).alias("source_file"))
    return rows.select("doc_id", manifest.first_present(rows.columns).alias("path")).filter("path is not null")


@query
def q_node_cik(spark, sf):
    files = manifest.parse_stem(filings(spark, sf)).select("doc_id", "stem", "submitter_cik")
    raw = filings(spark, sf).filter("doc_id % 3 = 0").select(F.upper(F.regexp_replace("stem", "_business$", "")).alias("stem"), F.concat(F.lit("00"), (F.col("doc_id") + 5000).cast("string")).alias("cik"), F.lit(1).alias("seen"))
    again = raw.withColumn("cik", F.lit("9")).withColumn("seen", F.lit(2))
    return manifest.node_cik(files, raw.unionByName(again)).select("doc_id", "cik", "from_raw")


@query
def q_unique_ciks(spark, sf):
    return manifest.company_nodes(_manifest(spark, sf))[0].agg(F.countDistinct("cik").alias("n"))


@query
def q_ticker_scores(spark, sf):
    p = spark.read.parquet(f"{sf}/supplier.parquet")
    k = F.col("s_suppkey")
    hits = [(0, "funds", "FUND", "Fund of "), (1, "EQUITY", "EQ", "Other "), (2, "stock", "ST", "Supplier "), (3, "equity", " ", "Supplier ")]
    every = F.explode(F.array(*[F.struct(F.lit(n).alias("position"), F.lit(kind).alias("kind"), (F.concat(F.lit(sym.lower()), k.cast("string")) if sym.strip() else F.lit(sym)).alias("symbol"), F.concat(F.lit(text), F.col("s_name")).alias("name")) for n, kind, sym, text in hits]))
    quotes = p.filter(k % 4 != 0).select(F.lower("s_name").alias("query"), every.alias("x")).select("query", "x.*")
    return providers.best_tickers(p.select(k.alias("row_id"), F.upper("s_name").alias("company_name")), providers.TableProvider(quotes)).select("row_id", "ticker")


@query
def q_removed_by_type(spark, sf):
    rows = policy.prefilter(_mention_rows(spark, sf))
    rows = rows.withColumn("org_mentions_union_raw", F.col("org_mentions")).withColumn("org_mentions_union_filtered", F.col("mentions_keep")).withColumn("mention_types_union", F.col("mention_types")).withColumn("prefilter_keep_count_by_type", F.lit("PRODUCT:1 ; bad ; X:y"))
    return policy.clean_columns(rows.withColumn("window_id", F.col("row_id").cast("string"))).select("window_id", "org_mentions_union", "org_mentions_union_count", "org_mentions_removed_count", "org_mentions_removed_count_by_type", "cue_phrase")


@query
def q_union_count(spark, sf):
    rows = _mention_rows(spark, sf).withColumn("org_mentions_count", F.when(F.col("row_id") % 2 == 0, F.concat(F.lit(" 1"), F.col("row_id").cast("string"))).otherwise("1.5"))
    return rows.select("row_id", policy.union_count(rows).alias("n"))


@query
def q_resume(spark, sf):
    rows = filings(spark, sf).select(F.col("doc_id").alias("row_index"), "company")
    before = rows.select("row_index", F.when(F.col("row_index") % 3 == 0, "COMPANY").when(F.col("row_index") % 3 == 1, " ").alias("llm_label"))
    return labeling.resumed(rows, before).select("row_index", "llm_label")


@query
def q_label_driver(spark, sf):
    from .sources import writers

    rows = filings(spark, sf).select(F.col("doc_id").alias("row_index"), F.col("company").alias("mention_org"))
    return labeling.label_batches(writers.label_requests(rows, ["mention_org"], 25), stub_labeler, wait=0.0).select("row_index", "llm_label", "llm_owner_company_candidate")


def stub_labeler(request: str) -> str:
    """Stands in for the service: names with Trust are agencies, others companies; its first answer to a request lacks a row."""
    import json

    asked = json.loads(request)
    items = json.loads(asked["request"])["items"] if "error" in asked else asked["items"][1:]
    label = lambda name: "Non coporate AGENCY" if "Trust" in name else "COMPANY"
    return "```json\n" + json.dumps({"labels": [{"row_index": x["row_index"], "llm_label": label(x["mention_org"]), "llm_owner_company_candidate": x["mention_org"]} for x in items]}) + "\n```"


@query
def q_offsets(spark, sf):
    texts = in_small_batches(spark.read.parquet(f"{sf}/documents.parquet")).filter("text is not null")
    rows = texts.select("doc_id", F.concat(F.lit("a\u200b \n\t"), "text").alias("text")).withColumn("n", offsets.normalized_with_offsets("text"))
    span = offsets.original_span(F.col("n"), F.lit(1), F.lit(3))
    return rows.select("doc_id", F.length("n.clean").cast("bigint").alias("n_chars"), F.md5("n.clean").alias("digest"), span["start"].cast("bigint").alias("start"), span["end"].cast("bigint").alias("end"))


@query
def q_span_sentence(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", F.concat(F.lit("First one. "), "p_name", F.lit(" stands here. Last.")).alias("text"))
    n = F.length("text")
    bounds = F.array(F.struct(F.lit(0).alias("start"), F.lit(10).alias("end")), F.struct(F.lit(11).alias("start"), (n - 6).alias("end")), F.struct((n - 5).alias("start"), n.alias("end")))
    at = F.element_at(F.array(F.lit(2), F.lit(12), n - 3, n + 5), (F.col("p_partkey") % 4 + 1).cast("int"))
    return p.select("p_partkey", offsets.sentence_of_span(F.col("text"), bounds, at, at + 2).alias("sentence"))


@query
def q_attributes(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    sets = [("ORG",), ("B-org", "I-LOC"), ("product", "MISC"), ("LOC", "PRODUCT"), ("MISC",)]
    labels = F.element_at(F.array(*[offsets.labels_of(x) for x in sets]), (F.col("p_partkey") % 5 + 1).cast("int"))
    name = F.when(F.col("p_partkey") % 7 == 0, " ABC ").when(F.col("p_partkey") % 7 == 1, "BRK.A").otherwise(F.col("p_brand"))
    rows = p.select("p_partkey", name.alias("name"), offsets.entity_attribute(labels).alias("attribute"))
    return rows.select("p_partkey", "attribute", offsets.typed(F.col("name"), F.col("attribute")).alias("type"))


@query
def q_span_scores(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").cast("string").alias("window_id"), F.col("p_partkey").alias("k"))
    gold = p.filter("k % 6 <> 5").select("window_id", F.lit(0).alias("start"), F.lit(8).alias("end"), F.lit("ORG").alias("type"))
    found = p.filter("k % 6 <> 4").select("window_id", F.when(F.col("k") % 6 == 1, 2).otherwise(0).alias("start"), F.lit(8).alias("end"), F.when(F.col("k") % 6 == 2, "LOC").otherwise("ORG").alias("type"))
    return offsets.span_scores(gold, found)


@query
def q_node_files(spark, sf):
    nodes, issues = manifest.company_nodes(_manifest(spark, sf))
    excluded = manifest.parse_stem(filings(spark, sf)).filter(manifest.is_excluded(F.col("company_name"))).select("company_name").distinct()
    counts = [d.agg(F.count("*").alias("n")).withColumn("file", F.lit(n)) for n, d in (("nodes", nodes), ("issues", issues), ("excluded", excluded))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def q_append(spark, sf):
    f = filings(spark, sf)
    c = F.when(F.col("doc_id") % 2 == 0, F.rpad(F.lit("Competition is strong. "), 250, "x ")).otherwise("short")
    once = cleaning.append_competition(F.col("text"), c)
    return f.select("doc_id", once.alias("a"), c.alias("c")).select("doc_id", F.length("a").cast("bigint").alias("n_chars"), (cleaning.append_competition(F.col("a"), F.col("c")) == F.col("a")).alias("idempotent"))


def _votes(spark, sf):
    return filings(spark, sf).select(F.col("company").alias("name"), "cik", F.col("doc_id").alias("seen"))


@query
def q_name_vote(spark, sf):
    return mentions.vote(_votes(spark, sf).withColumn("k", mentions.name_key(F.col("name"), True)), "k", "cik", "seen").select("k", "cik", "votes")


@query
def q_owner_cik(spark, sf):
    rows = filings(spark, sf).select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("company")).when(F.col("doc_id") % 3 == 1, F.concat("company", F.lit(" Group Holdings"))).otherwise("Nobody Ltd").alias("owner"))
    return mentions.owner_cik(rows, _votes(spark, sf)).select("doc_id", "owner_cik")


@query
def q_pipeline_role(spark, sf):
    from .rules.mentions import LABELS

    rows = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", F.get(F.array(*map(F.lit, LABELS)), (F.col("p_partkey") % 5).cast("int")).alias("llm_label"), F.when(F.col("p_partkey") % 2 == 0, "Owner").otherwise(" ").alias("owner"))
    return rows.select("p_partkey", mentions.pipeline_role(F.col("llm_label"), F.col("owner")).alias("role"))


@query
def q_parse_labels(spark, sf):
    rows = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", F.concat(F.lit('```json\n{"labels":[{"row_index":'), F.col("p_partkey").cast("string"), F.lit(',"llm_label":"'), F.when(F.col("p_partkey") % 2 == 0, "COMPANY").otherwise("Odd"), F.lit('","llm_owner_company_candidate":"A"}]}\n```')).alias("raw"))
    return exploded(rows, ["p_partkey"], mentions.parse_labels(F.col("raw")), "l").select("p_partkey", F.col("l.row_index").cast("bigint").alias("row_index"), "l.llm_label")


@query
def q_cache_misses(spark, sf):
    rows = filings(spark, sf).select("doc_id", "company", mentions.cache_key(F.col("company"), F.col("cik"), F.lit("s")).alias("key"))
    cache = rows.filter("doc_id % 4 = 0").select("key")
    return rows.join(cache, "key", "left_anti").select("key").distinct()


@query
def q_semi_move(spark, sf):
    listed = spark.read.parquet(f"{sf}/supplier.parquet").filter("s_suppkey % 2 = 0").select((1000 + F.col("s_suppkey")).cast("string").alias("cik"))
    return filings(spark, sf).select("doc_id", "stem", "cik").join(listed, "cik", "left_semi").select("doc_id", manifest.rewrite_path(F.concat(F.lit("out/2023_business/"), "stem"), "2023_business", "2023_no_outgoing_edges").alias("path"))


@query
def q_anti_cleanup(spark, sf):
    listed = spark.read.parquet(f"{sf}/supplier.parquet").filter("s_suppkey % 2 = 0").select((1000 + F.col("s_suppkey")).cast("string").alias("cik"))
    return filings(spark, sf).select("doc_id", "cik").join(listed, "cik", "left_anti").select("doc_id")


@query
def q_competition_only(spark, sf):
    only = cleaning.competition_only(F.expr("substring(text, CASE WHEN doc_id % 2 = 0 THEN 18 ELSE 1 END)"))
    f = filings(spark, sf).select("filing_year", only.alias("o"))
    return f.groupBy("filing_year").agg(F.count_if("o").alias("competition_only"), F.round(100 * F.count_if("o") / F.count("*"), 6).alias("share"))


@query
def q_sample(spark, sf):
    return manifest.sample_rows(filings(spark, sf).select("doc_id"), "doc_id", 25, 42)
