"""Rows that every operator has to take: nulls, empty and very long texts, ties, repeats,
and columns whose names the operators use themselves."""

from __future__ import annotations

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, row_id long, "
          "digest string, fp long, score double, position double, kept boolean, part int, html string")
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def documents(spark, rows=None):
    if rows is None:
        rows = [
            (1, "alpha beta gamma delta epsilon", "a"), (2, None, "a"), (3, "", None), (4, " \t\n ", None),
            (5, "alpha beta gamma delta epsilon", "b"), (5, "alpha beta gamma delta epsilon", "b"),
            (6, "Alpha  beta gamma\tdelta epsilon", "b"), (None, "a text without a number", "c"),
            (None, None, None), (7, LONG, "c"), (8, LONG + " end", "c"), (9, "x", "ü"), (10, "x", "z"),
            (11, "Été \U0001f600 naïve über", "z"),
        ]
    full = [(i, t, "en", s, 0, 1, 2, "d", 3, 0.5, 0.25, True, 7, "<p>h</p>") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "t") for r in rows],
                                 "page_id long, url string, html string, payload string, segment int, text string")
