from ledgerlens import queries
from ledgerlens.plans.filings import filings


def test_filings_hold_whole_texts_of_all_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text is not None}
    got = {r.doc_id: r.text for r in filings(spark, sf_dir).select("doc_id", "text").collect()}
    assert set(got) == set(texts) and max(map(len, texts.values())) > 600
    assert all(texts[i] in t for i, t in got.items())


def test_competition_only_takes_the_rest_of_the_text(spark, monkeypatch):
    seen = []
    only = queries.cleaning.competition_only
    monkeypatch.setattr(queries.cleaning, "competition_only", lambda text: seen.append(text) or only(text))
    rows = spark.createDataFrame([(1, "x" * 2_000_000, 2024), (2, "y" * 2_000_000, 2024)], "doc_id long, text string, filing_year int")
    monkeypatch.setattr(queries, "filings", lambda spark, sf: rows)
    queries.q_competition_only(spark, "")
    assert sorted(len(r[0]) for r in rows.select(seen[0]).collect()) == [2_000_000 - 17, 2_000_000]
