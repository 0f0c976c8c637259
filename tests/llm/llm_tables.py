"""Tables for the tests of this folder."""

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=True):
    """A table of documents from texts or (doc_id, text) pairs, with columns whose names clash with results."""
    rows = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
    full = [(i, t, "xx", "s", len(t) if t is not None else None, "a", 1, 2.0, 3) for i, t in rows]
    df = spark.createDataFrame(full, DOCS + ", lang_pred string, row long, score double, component_id long")
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")
