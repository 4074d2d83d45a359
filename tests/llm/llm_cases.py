"""Rows that every operator must take: nulls, blanks, ties, repeated rows, long texts, clashing columns."""

WORDS = "the quick brown fox jumps over a lazy dog and then runs home to sleep in its warm den".split()

ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n\x0b\f\r ", "fr", "b"),
    (5, "x", "en", "b"),
    (6, "Été à la plage: 漢字 😀 ²³ 'll it's", "fr", "a"),
    (7, " ".join(WORDS * 900), "en", "a"),
    (8, "y" * 20_000, "en", "a"),
    (9, "two  spaces   three\n\n\nlines \n x", "en", "a"),
    (10, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (10, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (None, "no id here", "en", "a"),
    (None, None, None, None),
    (11, "a\na\na\nb", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that operators use themselves.
CLASHING = ("shard", "slot", "size", "ids", "fingerprint", "component_id", "kept", "score", "predicted", "length", "start")


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(frame):
    from pyspark.sql import functions as F
    return frame.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
