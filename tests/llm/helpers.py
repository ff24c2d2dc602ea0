"""Small tables for the training-data operators: nulls, empty and long texts, ties, clashes."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, extra: bool = True):
    """rows: (doc_id, text) or (doc_id, text, lang, source); ``extra`` adds clashing columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        for name in ("block", "words", "score", "component_id", "fingerprint", "host", "size", "kept", "n_words", "line", "bucket"):
            df = df.withColumn(name, F.lit("x"))
    return df


LONG = "lorem ipsum, dolor sit amet consectetur " * 3000
ODD = [(1, "One two.\nThree four five."), (2, None), (3, ""), (4, " \n\t "), (5, "a" * 20000), (6, LONG),
       (7, "One two.\nThree four five."), (7, "One two.\nThree four five."), (8, "été naïve 中文字 ½ 'tis it's don't"), (None, "no id here"),
       (9, "x"), (10, None, None, None), (11, "\x00\x01 nul"), (12, "O" * 3 + "🙂" * 50)]


def odd(spark):
    return frame(spark, ODD)


def empty(spark):
    return frame(spark, [], extra=False)
