"""Tables for the tests of this folder."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, copies long, fp string, target int"


def documents(spark, rows):
    """Rows of (doc_id, text, source) with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, 2, "x", 3) for i, t, s in rows], DOCS)


AWKWARD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, "same words here", "b"),
    (4, "same words here", "b"),
    (4, "same words here", "b"),
    (5, "  \n\t ", None),
    (None, "no id at all", None),
    (6, "café naïve 漢字 \U0001f600 a'll 12", "c"),
    (7, "long " * 30_000, "b"),
    (8, "x" * 50_000, "c"),
]
