"""Small tables with the awkward rows every operator has to take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators use inside.
CLASHING = ["key", "size", "node", "label", "score", "spans", "copies", "target", "_row", "_text", "n", "a", "b"]


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def with_extra_columns(df):
    """The table with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(7) for c in CLASHING if c not in df.columns})


ODD_ROWS = [
    (1, None, None, None), (2, "", "en", "s"), (3, " \n\t", "en", "s"), (None, "text without an id, a few words long", "en", "s"),
    (4, "same text twice in the table, word for word", "en", "s"), (4, "same text twice in the table, word for word", "en", "s"),
    (5, "word " * 30_000, "en", "t"), (6, "Ünïcödé und 日本語 😀 mixed", None, "t"),
]
