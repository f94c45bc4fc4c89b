"""DuckDB SQL for the queries: written apart from the DataFrame code, from the same rule tables."""

from __future__ import annotations

from .plans.filings import SQL as FILINGS
from .rules import cues as C
from .rules import filings as R
from .rules import mentions as M

ORACLES: dict[str, str] = {}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def has(text: str, patterns, flags: str = "(?i)") -> str:
    return f"regexp_matches({text}, {lit(flags + '|'.join(f'(?:{p})' for p in patterns))})"


def first(text: str, patterns) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({text}, {lit('(?i)' + p)}, 0), '')" for p in patterns) + ")"


def case(text: str, rules, flags: str = "(?i)") -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, {lit(flags + p)}) THEN {lit(r)}" for p, r in rules) + " END"


def _sentences() -> str:
    t = r"regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')"
    # RE2's \b knows ASCII words only: the end of a word such as `öst.` would pass for an abbreviation
    for a, b in C.DOTTED_ABBREVIATIONS:
        t = rf"regexp_replace({t}, '(^|[^\pL\pN_])({a})\.({b})\.', '\1\2' || chr(1) || '\3' || chr(1), 'gi')"
    t = rf"regexp_replace({t}, '(^|[^\pL\pN_])({'|'.join(C.ABBREVIATIONS)})\.', '\1\2' || chr(1), 'gi')"
    for p, r in ((r"([.!?])\s+([A-Z\"])", r"'\1' || chr(2) || '\2'"), (r"([.!?])\n+", r"'\1' || chr(2)"), (r"\n{2,}", "chr(2)")):
        t = f"regexp_replace({t}, '{p}', {r}, 'g')"
    parts = f"list_filter(list_transform(string_split({t}, chr(2)), lambda s: trim(replace(s, chr(1), '.'), ' ' || chr(10) || chr(9) || chr(13))), lambda s: s <> '')"
    return f"arrays AS (SELECT doc_id, {parts} AS every FROM filings), sents AS (SELECT doc_id, unnest(range(len(every))) AS idx, unnest(every) AS sentence, every FROM arrays)"


_HEADING = (
    r"length(sentence) BETWEEN 1 AND 120 AND NOT regexp_matches(sentence, '[a-z]\.[A-Z]') AND ((length(sentence) <= 80 AND sentence NOT LIKE '%.') OR (upper(sentence) = sentence AND lower(sentence) <> sentence AND length(sentence) >= 3) "
    r"OR (regexp_matches(sentence, '^[A-Z][^a-z]*(?:\s+[A-Z][^\s]*)*\s*:?\s*$') AND length(sentence) < 80) OR sentence LIKE '%:')"
)
_CATEGORY = "CASE " + " ".join(f"WHEN {has('sentence', p, '(?im)')} THEN '{n}'" for n, p in C.HEADINGS) + " ELSE 'general_business_heading' END"
_CUES = f"""cues AS (SELECT *, CASE WHEN s IS NOT NULL THEN 'strict_explicit' WHEN c IS NOT NULL THEN (CASE WHEN NOT coalesce(reason <> '{C.GENERIC_ADVANTAGE}', false) THEN 'contextual_explicit' END)
    WHEN i IS NOT NULL AND reason IS NULL THEN 'implicit_or_broad' END AS cue_group, coalesce(s, c, i) AS cue_text
  FROM (SELECT *, CASE WHEN coalesce(s, c, i) IS NOT NULL THEN d END AS reason FROM (SELECT *, {first('sentence', C.STRICT)} AS s, {first('sentence', C.CONTEXTUAL)} AS c, {first('sentence', C.IMPLICIT)} AS i, {case('sentence', C.DEMOTIONS)} AS d FROM sents)))"""
_HEADS = f"""heads AS (SELECT *, last_value(CASE WHEN is_heading THEN struct_pack(t := sentence, k := category) END IGNORE NULLS) OVER back AS near, max(is_competition) OVER back AS under_competition,
    coalesce(max(s IS NOT NULL) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), false) OR coalesce(max(s IS NOT NULL) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), false) AS strict_nearby,
    sum(CAST(is_heading AS INT)) OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS block
  FROM (SELECT *, {_HEADING} AS is_heading, {_CATEGORY} AS category, {has('sentence', C.HEADINGS[0][1], '(?im)')} AS is_competition FROM cues)
  WINDOW back AS (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)),
 named AS (SELECT *, coalesce(near.t, '') AS heading_text, coalesce(near.k, 'no_heading') AS heading_category FROM heads)"""
_HINT = (
    "CASE WHEN heading_category = 'competition_heading' THEN 'competition_market' WHEN heading_category = 'geography_channel_heading' THEN 'geography_channel' WHEN heading_category = 'customer_heading' THEN 'customer_use_case' "
    f"WHEN heading_category = 'product_service_heading' THEN 'products_services' WHEN {has('window_text', [C.GEOGRAPHY_WORDS])} THEN 'geography_channel' WHEN {has('window_text', [C.CUSTOMER_WORDS])} AND cue_group <> 'implicit_or_broad' THEN 'customer_use_case' "
    f"WHEN {has('window_text', [C.SEGMENT_WORDS])} THEN 'segment' WHEN {has('window_text', [C.PRODUCT_WORDS])} AND cue_group = 'implicit_or_broad' THEN 'products_services' WHEN cue_group <> 'implicit_or_broad' THEN 'competition_market' ELSE 'unknown' END"
)
_WINDOWS = f"""spans AS (SELECT *, greatest(0, idx - reach) AS start_idx, least(len(every) - 1, idx + reach) AS end_idx FROM (SELECT *,
    CASE cue_group WHEN 'strict_explicit' THEN (CASE WHEN under_competition THEN 1 ELSE 0 END) WHEN 'contextual_explicit' THEN (CASE WHEN under_competition OR strict_nearby THEN 2 ELSE 1 END) ELSE 0 END AS reach,
    CASE cue_group WHEN 'strict_explicit' THEN (CASE WHEN under_competition THEN 5 ELSE 4 END) WHEN 'contextual_explicit' THEN (CASE WHEN under_competition OR strict_nearby THEN 3 ELSE 2 END) ELSE 1 END AS window_priority,
    CASE cue_group WHEN 'strict_explicit' THEN 4 WHEN 'contextual_explicit' THEN 3 ELSE 2 END AS cue_tier FROM named WHERE cue_group IS NOT NULL)),
 regular AS (SELECT *, {_HINT} AS hint FROM (SELECT doc_id, idx AS trigger_idx, start_idx, end_idx, cue_group, cue_tier, cue_text, window_priority, heading_text, heading_category, array_to_string(list_slice(every, start_idx + 1, end_idx + 1), ' ') AS window_text, coalesce(reason, '') AS demotion_reason, false AS is_fallback FROM spans)),
 blocks AS (SELECT doc_id, block, arg_min(sentence, idx) AS heading_text, bool_or(cue_group IS NOT NULL AND NOT is_heading) AS cued, min(CASE WHEN NOT is_heading AND regexp_matches(sentence, '\\w') THEN idx END) AS place,
    arg_min(sentence, idx) FILTER (WHERE NOT is_heading AND regexp_matches(sentence, '\\w')) AS body FROM named WHERE block > 0 GROUP BY ALL),
 every_window AS (SELECT doc_id, trigger_idx, start_idx, end_idx, cue_group, cue_tier, cue_text, window_priority, heading_text, heading_category, window_text, hint, demotion_reason, is_fallback FROM regular
   UNION ALL SELECT doc_id, place, place, place, 'heading_fallback_broad', 1, heading_text, 0, heading_text, 'competition_heading', body, 'competition_market', '', true FROM blocks WHERE NOT cued AND place IS NOT NULL AND {has('heading_text', C.FALLBACK_HEADINGS)}),
 w AS (SELECT * FROM every_window QUALIFY row_number() OVER (PARTITION BY doc_id, start_idx, end_idx ORDER BY window_priority DESC, is_fallback, trigger_idx) = 1)"""

_F = f"WITH filings AS ({FILINGS})"
_S = f"{_F}, {_sentences()}"
_C = f"{_S}, {_CUES}"
_H = f"{_C}, {_HEADS}"
_W = f"{_H}, {_WINDOWS}"
_BUCKET = "CASE cue_group WHEN 'strict_explicit' THEN 'strict' WHEN 'contextual_explicit' THEN 'contextual' ELSE 'broad' END"
_BIGRAMS = "list_distinct(list_transform(range(1, length(window_text)), lambda i: window_text[i:i+1]))"
_PAIRS = f"""{_W}, g AS (SELECT doc_id, trigger_idx, start_idx, end_idx, {_BIGRAMS} AS bg FROM w), pairs AS (SELECT a.doc_id, a.trigger_idx, b.trigger_idx AS other_idx,
  round(CASE WHEN len(list_distinct(a.bg || b.bg)) = 0 THEN 1.0 ELSE len(list_intersect(a.bg, b.bg)) / len(list_distinct(a.bg || b.bg)) END, 6) AS overlap FROM g a JOIN g b ON a.doc_id = b.doc_id AND b.trigger_idx > a.trigger_idx AND b.start_idx - a.end_idx BETWEEN 0 AND 5)"""

ORACLES["q_windows"] = f"{_W} SELECT doc_id, trigger_idx, start_idx, end_idx, cue_group, cue_tier, cue_text, window_priority, heading_text, heading_category, window_text, hint, demotion_reason, is_fallback FROM w"
ORACLES["q_sentences"] = f"{_S} SELECT doc_id, idx, sentence FROM sents"
ORACLES["q_cues"] = f"{_C} SELECT doc_id, idx, cue_group, cue_text, CASE cue_group WHEN 'strict_explicit' THEN 4 WHEN 'contextual_explicit' THEN 3 ELSE 2 END AS cue_tier FROM cues WHERE cue_group IS NOT NULL"
ORACLES["q_cue_top"] = f"{_C} SELECT lower(cue_text) AS cue, count(*) AS n FROM cues WHERE cue_group IS NOT NULL GROUP BY 1 ORDER BY n DESC, cue LIMIT 20"
ORACLES["q_demotions"] = f"{_C} SELECT doc_id, idx, reason AS demotion_reason FROM cues WHERE reason IS NOT NULL"
ORACLES["q_headings"] = f"{_H} SELECT doc_id, idx, is_heading, heading_text, heading_category, under_competition FROM named"
ORACLES["q_strict_nearby"] = f"{_H} SELECT doc_id, idx FROM named WHERE strict_nearby"
ORACLES["q_heading_blocks"] = f"{_H} SELECT doc_id, CAST(block AS BIGINT) AS block, min(idx) AS first_idx, max(idx) AS last_idx FROM named WHERE block > 0 GROUP BY ALL"
ORACLES["q_fallback"] = f"{_W} SELECT doc_id, trigger_idx, heading_text, window_text FROM w WHERE is_fallback"
ORACLES["q_bigram_overlap_pairs"] = f"{_PAIRS} SELECT * FROM pairs"
ORACLES["q_overlap_histogram"] = f"{_PAIRS} SELECT CAST(floor(overlap * 10 + 1e-9) AS BIGINT) AS decile, count(*) AS n FROM pairs GROUP BY 1"
_DEDUP = f"""{_W}, g AS (SELECT doc_id, trigger_idx, is_fallback, window_priority, {_BIGRAMS} AS bg, row_number() OVER (PARTITION BY doc_id ORDER BY window_priority DESC, cue_tier DESC, is_fallback, trigger_idx) AS n FROM w),
 alike AS (SELECT a.doc_id, a.n, b.n AS m FROM g a JOIN g b ON a.doc_id = b.doc_id AND b.n < a.n WHERE len(list_intersect(a.bg, b.bg)) >= 0.75 * len(list_distinct(a.bg || b.bg))),
 lists AS (SELECT g.doc_id, g.n, coalesce(list(m ORDER BY m) FILTER (WHERE m IS NOT NULL), []) AS ms FROM g LEFT JOIN alike a ON g.doc_id = a.doc_id AND g.n = a.n GROUP BY ALL),
 folded AS (SELECT doc_id, list_reduce(list(struct_pack(kept := CAST([n] AS BIGINT[]), hit := CAST([] AS BIGINT[]), ms := CAST(ms AS BIGINT[])) ORDER BY n), lambda acc, x: CASE WHEN len(list_intersect(acc.kept, x.ms)) > 0
    THEN struct_pack(kept := acc.kept, hit := acc.hit || [list_min(list_intersect(acc.kept, x.ms))], ms := acc.ms) ELSE struct_pack(kept := acc.kept || x.kept, hit := acc.hit, ms := acc.ms) END) AS r FROM lists GROUP BY doc_id),
 kept AS (SELECT g.doc_id, g.trigger_idx, g.is_fallback, list_contains(r.hit, g.n) AS is_deduplicated, g.window_priority FROM g JOIN folded f ON g.doc_id = f.doc_id WHERE list_contains(r.kept, g.n))"""
ORACLES["q_dedup"] = f"{_DEDUP} SELECT * FROM kept"
ORACLES["q_audit_summary"] = f"""{_DEDUP}, k AS (SELECT w.* FROM w JOIN kept USING (doc_id, trigger_idx, is_fallback)), per AS (SELECT doc_id, bool_and(is_fallback) AS r FROM k GROUP BY 1)
 SELECT (SELECT count(*) FROM filings) AS files, (SELECT count(*) FROM per) AS files_with_windows, (SELECT count_if(r) FROM per) AS rescued_files, (SELECT count(*) FROM filings) - (SELECT count(*) FROM per) AS files_without_windows,
  (SELECT count(*) FROM w) AS windows_before, count(*) AS windows_after, count_if(is_fallback) AS fallback_windows, round(avg(length(window_text)), 6) AS mean_chars FROM k"""
ORACLES["q_buckets"] = f"{_W} SELECT {_BUCKET} AS export_bucket, count(*) AS n, round(avg(length(window_text)), 6) AS mean_chars FROM w GROUP BY 1"
_COUNTS = "(SELECT unnest([struct_pack(key := 'tier', value := CAST(cue_tier AS VARCHAR)), struct_pack(key := 'cue_group', value := cue_group), struct_pack(key := 'section', value := 'business'), struct_pack(key := 'hint', value := hint), struct_pack(key := 'priority', value := CAST(window_priority AS VARCHAR)), struct_pack(key := 'cue', value := lower(cue_text)), struct_pack(key := 'demotion', value := nullif(demotion_reason, ''))]) AS x FROM w)"
ORACLES["q_audit_counts"] = f"{_W} SELECT x.key AS key, x.value AS value, count(*) AS n FROM {_COUNTS} WHERE x.value IS NOT NULL GROUP BY ALL"
ORACLES["q_demotion_top"] = f"{_C} SELECT reason AS demotion_reason, count(*) AS n FROM cues WHERE reason IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10"
ORACLES["q_dedup_candidates"] = f"""{_W}, g AS (SELECT doc_id, trigger_idx, start_idx, end_idx, hint, {_BIGRAMS} AS bg FROM w), pairs AS (SELECT a.doc_id, a.trigger_idx, b.trigger_idx AS other_idx, a.hint, b.hint AS other_hint,
  round(CASE WHEN len(list_distinct(a.bg || b.bg)) = 0 THEN 1.0 ELSE len(list_intersect(a.bg, b.bg)) / len(list_distinct(a.bg || b.bg)) END, 6) AS overlap FROM g a JOIN g b ON a.doc_id = b.doc_id AND b.trigger_idx > a.trigger_idx AND b.start_idx - a.end_idx BETWEEN 0 AND 5)
 SELECT doc_id, trigger_idx, other_idx, overlap, hint, other_hint FROM pairs WHERE overlap >= 0.75 OR hint <> other_hint"""
ORACLES["q_export_order"] = f"{_W} SELECT printf('W%07d', row_number() OVER (ORDER BY filing_year, company, window_priority DESC, doc_id, trigger_idx, is_fallback)) AS position, doc_id, trigger_idx, is_fallback FROM w JOIN filings USING (doc_id)"
ORACLES["q_union_sample"] = f"{_W} SELECT id AS window_id FROM (SELECT printf('%d-%d-%d', doc_id, trigger_idx, CAST(is_fallback AS INT)) AS id, cue_text FROM w WHERE cue_group IN ('strict_explicit', 'contextual_explicit')) WHERE cue_text <> 'ecosystem' ORDER BY md5('42:' || id), id LIMIT 100"
ORACLES["q_contains"] = f"{_F} SELECT doc_id, company FROM filings WHERE company LIKE '%Trust%' ORDER BY doc_id LIMIT 15"
ORACLES["q_rescued"] = f"{_W} SELECT doc_id FROM w GROUP BY doc_id HAVING bool_and(is_fallback)"
ORACLES["q_zero_window_files"] = f"{_W} SELECT doc_id, stem FROM filings WHERE doc_id NOT IN (SELECT doc_id FROM w)"
ORACLES["q_explicit"] = f"{_W} SELECT printf('EXPW%07d', row_number() OVER (ORDER BY doc_id, cue_text, window_text, cue_group, window_priority, b)) AS explicit_id, doc_id, cue_group, cue_text, window_text FROM (SELECT DISTINCT doc_id, cue_group, cue_text, window_text, window_priority, {_BUCKET} AS b FROM w WHERE cue_group IN ('strict_explicit', 'contextual_explicit'))"
ORACLES["q_section_type"] = f"{_H} SELECT doc_id, CASE WHEN c AND b THEN 'both' WHEN c THEN 'competition_only' WHEN b THEN 'business_only' ELSE 'neither' END AS section_type FROM (SELECT doc_id, bool_or(is_competition) AS c, bool_or(regexp_matches(sentence, '(?i)\\bbusiness\\b') AND is_heading) AS b FROM named GROUP BY doc_id)"

_TITLE = "array_to_string(list_transform(regexp_extract_all(lower(c), '[a-z]+|[^a-z]+'), lambda x: upper(x[1:1]) || x[2:]), '')"
_STEM = rf"""parsed AS (SELECT *, '2024-0' || CAST(1 + doc_id % 9 AS VARCHAR) || '-15' AS filing_date, CASE WHEN upper(c) = c AND lower(c) <> c THEN {_TITLE} ELSE c END AS company_name, regexp_extract(stem, '(\d{{10}}-\d{{2}}-\d{{6}})', 1) AS accession,
  regexp_extract(stem, '\d{{10}}-\d{{2}}-\d{{6}}_(.*)$', 1) AS section_type, cik AS submitter_cik, '' AS parse_notes, true AS parse_success FROM (SELECT *, string_split(stem, '__')[2] AS c FROM filings))"""
_ISSUER = rf"""lookup AS (SELECT accession, cik FROM parsed WHERE doc_id % 7 <> 0 UNION ALL SELECT accession, cik || '9' FROM parsed WHERE doc_id % 11 = 0),
 votes AS (SELECT accession, count(DISTINCT cik) AS k, min(cik) AS c FROM lookup GROUP BY 1),
 resolved AS (SELECT p.*, CASE WHEN k = 1 THEN v.c END AS source_cik, CASE WHEN k = 1 THEN 'issuer_lookup' WHEN k > 1 THEN 'ambiguous' ELSE 'missing' END AS source_cik_source FROM parsed p LEFT JOIN votes v USING (accession))"""
_EXCLUDED = has("{}", R.EXCLUDED_NAMES)
_M = f"{_F}, {_STEM}, {_ISSUER}"
_NODES = f"nodes AS (SELECT company_name, coalesce(source_cik, submitter_cik) AS cik, stem FROM resolved WHERE NOT {_EXCLUDED.replace('{}', 'company_name')})"
ORACLES["q_stem_parse"] = f"{_M} SELECT doc_id, filing_date, company_name, accession, section_type, submitter_cik, parse_notes, parse_success FROM parsed"
ORACLES["q_cik_resolution"] = f"{_M} SELECT doc_id, source_cik, source_cik_source FROM resolved"
ORACLES["q_manifest"] = f"""{_F} SELECT doc_id, CAST(length(text) AS INT) AS text_char_count, CAST(len(string_split(text, chr(10))) - CASE WHEN text LIKE '%' || chr(10) THEN 1 ELSE 0 END AS INT) AS text_line_count, length(text) > 1000 AS is_large,
  CASE WHEN b AND c THEN 'both' WHEN b THEN 'business_only' WHEN c THEN 'competition_only' ELSE 'neither' END AS section_presence FROM (SELECT *, {has('text', R.BUSINESS_START, '(?im)')} AS b, {has('text', R.COMPETITION_START, '(?im)')} AS c FROM filings)"""
ORACLES["q_manifest_summary"] = f"{_M} SELECT section_type, count(*) AS n, count_if(parse_success) AS parsed, count_if(source_cik IS NULL) AS unresolved FROM resolved GROUP BY 1"
ORACLES["q_nodes"] = f"{_M}, {_NODES} SELECT * FROM nodes"
ORACLES["q_node_exclusions"] = f"{_F} SELECT company, count(*) AS n FROM filings WHERE {_EXCLUDED.replace('{}', 'company')} GROUP BY 1"
ORACLES["q_enriched_nodes"] = f"{_M}, {_NODES} SELECT stem, cik, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN 'S' || CAST(s_suppkey AS VARCHAR) END, '') AS ticker, CASE WHEN s_suppkey IS NULL THEN '' ELSE 'Industrials' END AS gics_sector FROM nodes LEFT JOIN supplier ON CAST(1000 + s_suppkey AS VARCHAR) = cik"
ORACLES["q_purge_report"] = f"{_F}, x AS (SELECT filing_year, company IN (SELECT 'Index Fund of ' || s_name FROM supplier WHERE s_suppkey % 3 = 0) AS e FROM filings) SELECT filing_year, count(*) AS input_rows, count_if(e) AS removed_rows, count_if(NOT e) AS output_rows FROM x GROUP BY 1"

_JUNK = "['Inc.', 'Charter', 'com', 'inhibitor', 'FDA approval', 'initial public offering', 'supply chain services', 'European', 'Pfizer', 'x', 'AWS', 'car', '.', '1,234', 'Phase 2a', 'QQ', '']"
_KEY = "trim(regexp_replace(regexp_replace(lower({}), '[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
_TAIL = "regexp_replace({}, '(\\s+(?:" + "|".join(M.LEGAL_TAIL) + "))+$', '')"
_in = lambda xs: "(" + ", ".join(map(lit, xs)) + ")"
_LABELED = f"""lists AS (SELECT s_suppkey AS row_id, s_name || ' Holdings, Inc.' AS source_company,
    list_filter([s_name || ['', ', Inc.', ' Trust', ' Act', ' Corp'][1 + s_suppkey % 5], {_JUNK}[1 + s_suppkey % 17], {_JUNK}[1 + (s_suppkey * 7 + 3) % 17], 'Globex Corporation'], lambda x: x <> '') AS names,
    CASE WHEN s_suppkey % 2 = 0 THEN ['COMPANY', 'PRODUCT', 'REGION'] ELSE ['COMPANY', 'PRODUCT'] END AS types FROM supplier),
 items AS (SELECT row_id, source_company, names, types, unnest(range(len(names))) AS pos, unnest(names) AS mention FROM lists),
 keyed AS (SELECT *, coalesce(types[pos + 1], 'COMPANY') AS kind, trim(mention, {lit(M.STRIPPED)}) AS m, {_TAIL.replace('{}', _KEY.replace('{}', "trim(mention, " + lit(M.STRIPPED) + ")"))} AS mine, {_TAIL.replace('{}', _KEY.replace('{}', 'source_company'))} AS own FROM items),
 reasons AS (SELECT *, CASE WHEN m = '' THEN 'empty_after_normalize' WHEN lower(m) IN {_in(M.KEEP)} THEN 'whitelist' WHEN lower(m) IN {_in(M.DROP)} THEN 'exact_drop' ELSE coalesce({case('m', M.DROP_PATTERNS, '')},
    CASE WHEN mine <> '' AND mine = own THEN 'self_source_full_match' WHEN mine <> '' AND own <> '' AND contains(' ' || own || ' ', ' ' || mine || ' ') THEN (CASE WHEN length(mine) >= 8 THEN 'self_source_fragment' ELSE 'self_source_fragment_review' END)
    WHEN length(m) = 1 THEN 'single_letter' WHEN lower(m) IN {_in(M.REVIEW)} THEN 'review_exact' WHEN regexp_matches(m, '^[A-Z]{{2}}$') THEN 'short_all_caps_2' ELSE 'default_keep' END) END AS reason FROM keyed),
 labeled AS (SELECT *, CASE WHEN reason IN ('whitelist', 'default_keep') THEN 'keep' WHEN reason IN ('review_exact', 'short_all_caps_2', 'self_source_fragment_review') THEN 'review' ELSE 'drop_obvious_junk' END AS label FROM reasons)"""
ORACLES["q_label_mentions"] = f"WITH {_LABELED} SELECT row_id, source_company, CAST(pos AS INT) AS pos, mention, label, reason FROM labeled".replace("row_id, source_company, CAST", "row_id, CAST")
ORACLES["q_label_counts"] = f"WITH {_LABELED} SELECT label, reason, count(*) AS n FROM labeled GROUP BY ALL"
_list = lambda what, cond: f"coalesce(string_agg({what}, ' ; ' ORDER BY pos) FILTER (WHERE {cond}), '')"
ORACLES["q_prefilter_lists"] = f"WITH {_LABELED} SELECT row_id, {_list('mention', chr(39).join(['label = ', 'keep', '']))} AS mentions_keep, {_list('mention', chr(39).join(['label = ', 'drop_obvious_junk', '']))} AS mentions_drop, {_list('mention', chr(39).join(['label = ', 'review', '']))} AS mentions_review, {_list('reason', chr(39).join(['label = ', 'drop_obvious_junk', '']))} AS drop_reasons, count(*) AS union_count, count_if(label = 'keep') AS keep_count FROM labeled GROUP BY row_id"
ORACLES["q_prefilter_clean"] = f"""WITH {_LABELED}, byk AS (SELECT row_id, kind, count(*) AS n, count_if(label = 'keep') AS k FROM labeled GROUP BY ALL)
 SELECT row_id, string_agg(kind || ':' || CAST(n AS VARCHAR), ' ; ' ORDER BY kind) AS union_types, coalesce(string_agg(kind || ':' || CAST(k AS VARCHAR), ' ; ' ORDER BY kind) FILTER (WHERE k > 0), '') AS keep_types, CAST(sum(n - k) AS BIGINT) AS removed_count FROM byk GROUP BY row_id"""
ORACLES["q_filtered_out"] = f"WITH {_LABELED} SELECT mention, count(*) AS removed FROM (SELECT mention FROM labeled EXCEPT ALL SELECT mention FROM labeled WHERE label = 'keep') GROUP BY 1"

_ID = "printf('%d-%d-%d', doc_id, trigger_idx, CAST(is_fallback AS INT))"


def _found(name: str, pattern: str) -> str:
    """Matches with offsets, walking over the text by the pieces between them."""
    m, p = f"regexp_extract_all(window_text, {lit(pattern)})", f"string_split_regex(window_text, {lit(pattern)})"
    return f"SELECT window_id, m[k + 1] AS text, list_sum(list_transform(p[1:k + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k], lambda x: length(x))), 0) AS start, '{name}' AS extractor FROM (SELECT window_id, m, p, unnest(range(len(m))) AS k FROM (SELECT {_ID} AS window_id, {m} AS m, {p} AS p FROM w))"


_SPANS = f"""{_W}, raw AS ({_found('pattern_a', chr(92) + 'b(?:Supplier|Customer)#' + chr(92) + 'd+')} UNION ALL {_found('pattern_b', chr(92) + 'b(?:Customer#' + chr(92) + 'd+(?:, Inc' + chr(92) + '.)?|Europe|U' + chr(92) + '.S' + chr(92) + '.)')}),
 merged AS (SELECT window_id, CAST(start AS INT) AS start, CAST(start + length(text) AS INT) AS "end", min(text) AS text, string_agg(DISTINCT extractor, '+' ORDER BY extractor) AS extractors FROM raw GROUP BY 1, 2, 3),
 typed AS (SELECT *, CASE WHEN regexp_matches(text, '^[A-Z]{{1,5}}$|^[A-Z]{{1,5}}\\.[A-Z]$') THEN 'TICKER' WHEN text IN ('Europe', 'U.S.') THEN 'REGION' ELSE 'ORGANIZATION' END AS type, row_number() OVER (PARTITION BY window_id, lower(text) ORDER BY start, "end") AS rn FROM merged)"""


def _aggregated(where: str) -> str:
    parts = ", ".join(f"coalesce(string_agg(CAST({c} AS VARCHAR), ' ; ' ORDER BY start, \"end\", extractors) FILTER (WHERE text IS NOT NULL), '') AS {n}" for c, n in (("text", "mentions"), ("start", "starts"), ("type", "types")))
    return f"{_SPANS} SELECT v.window_id, CAST(count(text) AS INT) AS n_mentions, {parts} FROM (SELECT {_ID} AS window_id FROM w) v LEFT JOIN (SELECT * FROM typed WHERE {where}) t ON v.window_id = t.window_id GROUP BY v.window_id"


ORACLES["q_span_merge"] = f'{_SPANS} SELECT window_id, start, "end", text, extractors FROM merged'
ORACLES["q_mentions_raw"] = _aggregated("true")
ORACLES["q_mentions_nonraw"] = _aggregated("rn = 1")
ORACLES["q_org_diff"] = f"{_SPANS} SELECT window_id, text AS raw_mention, start, \"end\", 'duplicate_in_window' AS diff_reason FROM typed WHERE rn > 1"
ORACLES["q_dotcom_merge"] = """SELECT p_partkey, p_brand || '.com' AS text, 0 AS start, CAST(length(p_brand) + 5 AS INT) AS "end" FROM part WHERE p_partkey % 2 = 0
 UNION ALL SELECT p_partkey, p_brand || '.', 0, CAST(length(p_brand) + 1 AS INT) FROM part WHERE p_partkey % 2 = 1 UNION ALL SELECT p_partkey, 'Corp', CAST(length(p_brand) + 1 AS INT), CAST(length(p_brand) + 5 AS INT) FROM part WHERE p_partkey % 2 = 1"""

_BLOCKLESS = "html"
for _tag in R.BLOCKS:
    _BLOCKLESS = f"regexp_replace({_BLOCKLESS}, '(?is)<{_tag}\\b.*?</{_tag}>', ' ', 'g')"
_BLOCKLESS = f"regexp_replace({_BLOCKLESS}, '(?is)<link:(?:schemaref|linkbaseref)\\b[^>]*?/?>', ' ', 'g')"


def _text_of(html: str) -> str:
    out = f"regexp_replace({html}, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in R.DROPPED_TAGS:
        if tag not in ("meta", "link", "img"):
            out = f"regexp_replace({out}, '(?is)<{tag}\\b.*?</{tag}\\s*>', ' ', 'g')"
    out = f"regexp_replace(regexp_replace({out}, '(?i)</?(?:{'|'.join(R.BLOCK_TAGS)})\\b[^>]*>', chr(10), 'g'), '(?s)<[^>]*>', ' ', 'g')"
    for entity, text in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{text}')"
    out = f"regexp_replace({out}, '([0-9A-Za-z_])-\\n([0-9A-Za-z_])', '\\1\\2', 'g')"
    return f"trim(regexp_replace(regexp_replace(regexp_replace({out}, '[ \\t]*\\n[ \\t]*', chr(10), 'g'), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))"


ORACLES["q_html_text"] = f"SELECT page_id, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS digest FROM (SELECT page_id, {_text_of(_BLOCKLESS)} AS t FROM pages)"
ORACLES["q_append"] = "WITH filings AS (" + FILINGS + ") SELECT doc_id, CAST(length(text) + CASE WHEN doc_id % 2 = 0 THEN 250 + " + str(len(R.APPEND_MARK)) + " ELSE 0 END AS BIGINT) AS n_chars, true AS idempotent FROM filings"

_WORDS = "array_to_string(regexp_extract_all(lower({}), '[a-z0-9]+'), ' ')"
_LOOSE = "trim(regexp_replace(" + _WORDS + ", '(?:(?:^|\\s+)(?:" + "|".join(M.LEGAL_SUFFIXES) + "))+$', ''))"


def _vote(key: str, name: str) -> str:
    return f"{name} AS (SELECT k, arg_max(cik, struct_pack(c := c, f := -f)) AS cik, CAST(sum(c) AS BIGINT) AS votes FROM (SELECT {key.replace('{}', 'company')} AS k, cik, count(*) AS c, min(doc_id) AS f FROM filings GROUP BY 1, 2) WHERE k <> '' GROUP BY k)"


ORACLES["q_name_vote"] = f"{_F}, {_vote(_LOOSE, 'v')} SELECT k, cik, votes FROM v"
ORACLES["q_owner_cik"] = f"""{_F}, {_vote(_WORDS, 'vs')}, {_vote(_LOOSE, 'vl')}, o AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN company WHEN 1 THEN company || ' Group Holdings' ELSE 'Nobody Ltd' END AS owner FROM filings)
 SELECT doc_id, coalesce(vs.cik, vl.cik, '') AS owner_cik FROM o LEFT JOIN vs ON vs.k = {_WORDS.replace('{}', 'owner')} LEFT JOIN vl ON vl.k = {_LOOSE.replace('{}', 'owner')}"""
ORACLES["q_pipeline_role"] = "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'explicit_company_candidate' WHEN 1 THEN (CASE WHEN p_partkey % 2 = 0 THEN 'explicit_support_via_product' ELSE 'ignore_or_review' END) WHEN 2 THEN 'implicit_only' ELSE 'ignore_or_review' END AS role FROM part"
ORACLES["q_parse_labels"] = "SELECT p_partkey, p_partkey AS row_index, CASE WHEN p_partkey % 2 = 0 THEN 'COMPANY' ELSE 'OTHER' END AS llm_label FROM part"
_CACHE = "sha256(concat_ws(chr(31), company, cik, 's'))"
ORACLES["q_cache_misses"] = f"{_F} SELECT DISTINCT {_CACHE} AS key FROM filings WHERE {_CACHE} NOT IN (SELECT {_CACHE} FROM filings WHERE doc_id % 4 = 0)"
ORACLES["q_semi_move"] = f"{_F} SELECT doc_id, 'out/2023_no_outgoing_edges/' || stem AS path FROM filings WHERE CAST(cik AS INT) % 2 = 0"
ORACLES["q_anti_cleanup"] = f"{_F} SELECT doc_id FROM filings WHERE CAST(cik AS INT) % 2 = 1"
_HEAD = "(SELECT *, substring(text, CASE WHEN doc_id % 2 = 0 THEN 18 ELSE 1 END, 8000) AS h FROM filings)"
_ONLY = f"(({has('h', [R.COMPETITION_HEAD])} AND NOT {has('h', [R.BUSINESS_HEAD])}) OR ({has('h', [R.COMPETITION_WORD])} AND NOT {has('h', [R.BUSINESS_HEAD])} AND NOT contains(lower(left(h, 300)), 'business')))"
ORACLES["q_competition_only"] = f"{_F} SELECT filing_year, count_if({_ONLY}) AS competition_only, round(100.0 * count_if({_ONLY}) / count(*), 6) AS share FROM {_HEAD} GROUP BY 1"
ORACLES["q_sample"] = f"{_F} SELECT doc_id FROM filings ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 25"

ORACLES["q_append_status"] = f"""{_F}, x AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'missing_section' WHEN doc_id % 5 = 0 THEN 'no_business_file' WHEN doc_id % 4 = 0 THEN 'already_appended' ELSE '' END AS reason FROM filings)
 SELECT CASE WHEN reason = '' THEN 'appended' ELSE 'skipped' END AS status, reason, count(*) AS n FROM x GROUP BY ALL"""
ORACLES["q_content_fallback"] = f"{_F} SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'business+competition' ELSE (CASE doc_id % 4 WHEN 0 THEN 'risk' WHEN 1 THEN 'business' WHEN 2 THEN 'competition' END) END AS section_type FROM filings"
ORACLES["q_overlay"] = f"{_M} SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Given Name' ELSE company_name END AS company_name, CASE WHEN doc_id % 4 = 0 THEN '77' ELSE submitter_cik END AS submitter_cik FROM parsed"
ORACLES["q_first_present"] = f"{_F} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'a/b' || cik ELSE stem END AS path FROM filings WHERE doc_id % 2 = 0 OR doc_id % 3 <> 0"
ORACLES["q_node_cik"] = f"{_F} SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id + 5000 AS VARCHAR) ELSE cik END AS cik, doc_id % 3 = 0 AS from_raw FROM filings"
ORACLES["q_unique_ciks"] = f"{_M}, {_NODES} SELECT count(DISTINCT cik) AS n FROM nodes"
ORACLES["q_ticker_scores"] = "SELECT s_suppkey AS row_id, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'EQ' || CAST(s_suppkey AS VARCHAR) END AS ticker FROM supplier"
ORACLES["q_removed_by_type"] = f"""WITH {_LABELED}, given AS (SELECT s_suppkey AS row_id, array_to_string([s_name || ['', ', Inc.', ' Trust', ' Act', ' Corp'][1 + s_suppkey % 5], {_JUNK}[1 + s_suppkey % 17], {_JUNK}[1 + (s_suppkey * 7 + 3) % 17], 'Globex Corporation'], ' ; ') AS listed FROM supplier),
 counted AS (SELECT s.row_id, s.names, s.types, (SELECT count(*) FROM labeled l WHERE l.row_id = s.row_id AND l.label = 'keep') AS kept FROM lists s)
 SELECT CAST(row_id AS VARCHAR) AS window_id, listed AS org_mentions_union, CAST(len(names) AS VARCHAR) AS org_mentions_union_count, CAST(len(names) - kept AS VARCHAR) AS org_mentions_removed_count,
  CASE WHEN len(types) = 3 THEN 'COMPANY:1 ; REGION:1' ELSE 'COMPANY:1' END AS org_mentions_removed_count_by_type, '' AS cue_phrase FROM counted JOIN given USING (row_id)"""
ORACLES["q_union_count"] = f"WITH {_LABELED} SELECT row_id, CASE WHEN row_id % 2 = 0 THEN CAST('1' || CAST(row_id AS VARCHAR) AS BIGINT) ELSE len(names) END AS n FROM lists"
ORACLES["q_resume"] = f"{_F} SELECT doc_id AS row_index, CASE WHEN doc_id % 3 = 0 THEN 'COMPANY' END AS llm_label FROM filings"
ORACLES["q_label_driver"] = f"{_F} SELECT doc_id AS row_index, CASE WHEN company LIKE '%Trust%' THEN 'Non coporate AGENCY' ELSE 'COMPANY' END AS llm_label, company AS llm_owner_company_candidate FROM filings"
ORACLES["q_span_sentence"] = "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'First one.' WHEN 1 THEN p_name || ' stands here.' WHEN 2 THEN 'Last.' ELSE '' END AS sentence FROM part"
ORACLES["q_attributes"] = """SELECT p_partkey, a AS attribute, CASE WHEN p_partkey % 7 < 2 THEN 'TICKER' WHEN a = 'LOC' THEN 'REGION' WHEN a = 'PRODUCT' THEN 'ComputingProduct' ELSE 'ORGANIZATION' END AS type
 FROM (SELECT *, CASE p_partkey % 5 WHEN 1 THEN 'LOC' WHEN 2 THEN 'PRODUCT' WHEN 3 THEN 'LOC' ELSE 'ORG' END AS a FROM part)"""
ORACLES["q_span_scores"] = """WITH c AS (SELECT count_if(p_partkey % 6 < 4) AS met, count_if(p_partkey % 6 IN (0, 3)) AS strict, count_if(p_partkey % 6 IN (0, 2, 3)) AS exact, count_if(p_partkey % 6 IN (0, 1, 3)) AS kind, count_if(p_partkey % 6 <> 5) AS gold, count_if(p_partkey % 6 <> 4) AS found FROM part),
 s AS (SELECT *, unnest([struct_pack(scheme := 'strict', correct := strict, partial := 0, incorrect := met - strict), struct_pack(scheme := 'exact', correct := exact, partial := 0, incorrect := met - exact), struct_pack(scheme := 'partial', correct := exact, partial := met - exact, incorrect := 0), struct_pack(scheme := 'type', correct := kind, partial := 0, incorrect := met - kind)]) AS x FROM c)
 SELECT x.scheme AS scheme, x.correct AS correct, x.incorrect AS incorrect, x.partial AS partial, gold - met AS missed, found - met AS spurious, round((x.correct + x.partial / 2) / found, 6) AS precision, round((x.correct + x.partial / 2) / gold, 6) AS recall FROM s"""
ORACLES["q_node_files"] = f"{_M}, {_NODES} SELECT 'nodes' AS file, count(*) AS n FROM nodes UNION ALL SELECT 'issues', 0 UNION ALL SELECT 'excluded', count(DISTINCT company_name) FROM parsed WHERE {_EXCLUDED.replace('{}', 'company_name')}"
