from collections import defaultdict

import corpus_pipeline as pipeline
from ledgerlens.llm import language, pii

from .cases import documents, empty
from .test_dedup import first_of_copies, lower
from .test_packing_pii import check_packing


def rows(df):
    return [tuple(r) for r in df.select(*pipeline.DOCUMENT_COLUMNS).collect()]


def test_stages_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found, stage = {}, docs
    for name, function in pipeline.STAGES:
        stage = found[name] = function(spark, stage, sf_dir).cache()
    first = rows(docs)
    predicted = {r.doc_id: r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()}
    assert sorted(rows(found["language_id"])) == sorted((i, t, predicted[i], s, n) for i, t, _, s, n in first if predicted[i] != "und")
    groups = defaultdict(list)
    for r in rows(found["language_id"]):
        groups[lower(r[1])].append(r)
    assert sorted(rows(found["exact_dedup"])) == sorted(max(g) for g in groups.values())
    kept = {r[0]: r for r in rows(found["exact_dedup"])}
    assert sorted(rows(found["near_dedup"])) == sorted(kept[i] for i in first_of_copies({i: r[1] for i, r in kept.items()}))
    before, after = {r[0]: r for r in rows(found["near_dedup"])}, {r[0]: r for r in rows(found["pii"])}
    assert set(before) == set(after)
    for i, (_, text, lang, source, n) in after.items():
        assert (lang, source, n) == (*before[i][2:4], len(text)) and pii.base_spans(text) == []
        assert text == before[i][1] or pii.base_spans(before[i][1]) or "[" in text
    check_packing([(i, r[1], r[3]) for i, r in after.items()], found["packing"].collect(), 2048, 4)


def test_run_equals_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in pipeline.STAGES:
        docs = function(spark, docs, sf_dir)
    assert sorted(map(tuple, pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_awkward_and_empty_tables(spark, sf_dir):
    for table in (documents(spark), empty(spark), documents(spark, [(None, None, None, None)] * 3)):
        for name, function in pipeline.STAGES:
            out = function(spark, table, sf_dir)
            out.collect()
            if name != "packing":
                assert tuple(out.columns) == pipeline.DOCUMENT_COLUMNS
    assert sorted(r.doc_id for r in pipeline.drop_exact_duplicates(spark, documents(spark), sf_dir).collect() if r.doc_id) == [2, 4, 5, 6, 8, 9, 10, 11, 12, 13]
