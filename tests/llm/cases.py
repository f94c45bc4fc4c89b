"""Awkward documents that every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, fp string, rid long, id string, rep string"
LONG = " ".join(f"word{i % 977} and the other{i % 13}" for i in range(20_000))


def documents(spark, rows=None):
    """(doc_id, text, lang, source); extra columns clash with names the operators use inside."""
    if rows is None:
        rows = [
            (1, "The quick brown fox jumps over the lazy dog", "en", "a"),
            (2, "the QUICK brown fox jumps over the lazy dog", "en", "a"),
            (3, None, None, None),
            (4, "", "en", "b"),
            (5, "ÉTÉ à la plage", "fr", "b"),
            (6, "été à la plage", "fr", None),
            (7, LONG, "en", "a"),
            (8, LONG, "en", "a"),
            (9, LONG + " tail", "en", "a"),
            (10, "12345 --- !!!", None, "c"),
            (11, "Der schnelle braune Fuchs springt", "de", "c"),
            (11, "Der schnelle braune Fuchs springt", "de", "c"),
            (None, "row without id", "en", "a"),
            (12, " \t\n ", "en", "a"),
            (13, "a@b.example.com or +1 (555) 010-9999 x\x1cy 1.2.3.4", "en", "a"),
        ]
    return spark.createDataFrame([(*r, len(r[1] or ""), "k", "f", 5, "i", "r") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
