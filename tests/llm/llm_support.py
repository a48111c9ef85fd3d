"""Small documents with every odd case, and the words of the contracts in plain Python."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside, or give to their results
    T.StructField("_id", T.StringType()), T.StructField("_doc", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("_taken", T.StringType()), T.StructField("a.b", T.StringType()),
])
LONG = "the quick brown fox jumps over the lazy dog " * 6000


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", "y", "z", "q", "t", "u")


ODD = [
    row(1, None), row(2, ""), row(3, " \n\t"), row(4, "one"), row(5, "one two"), row(6, "One two"), row(7, LONG),
    row(8, LONG + "end"), row(9, "é ü ß 日本語 𓀀"), row(10, "one two three four", None, None), row(11, "a\x00b ▁ c"),
    row(12, "..., !!! 123"), row(None, "no id"), row(None, "one two"), row(13, "one two three four", "de", "t"),
    row(14, "twice the same row"), row(14, "twice the same row"), row(15, "same id, one text"), row(15, "same id, other text"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def odd(spark):
    return frame(spark, ODD).repartition(3)


def empty(spark):
    return frame(spark, [])


def plain(df, *columns):
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
