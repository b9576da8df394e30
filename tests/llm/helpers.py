"""Fixture tables of the corpus operators' tests."""

import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "uid long, n int, score double, kept boolean, _uid string, comp string, w string")


def words(text):
    return SPACE.findall(text or "")


def make_docs(spark, rows):
    """(doc_id, text, source) rows with columns whose names the operators use too."""
    full = [(d, t, "en", s, len(t or ""), 7, 1, 0.5, True, "x", "y", "z") for d, t, s in rows]
    return spark.createDataFrame(full, DOCS)
