import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; a table may have columns of these names.
CLASH = ("size", "class_id", "bands", "k1", "n_words", "row_id", "bad", "row", "copies", "score", "block", "kept", "uid", "shard",
         "payload", "es_key", "n_lines", "n_removed", "sequence_id", "held_out", "v", "id", "rank", "point", "u", "f", "n", "allowed")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = [f"{random.Random(i).choice('bcdfgmnprst')}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}e" for i in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


def documents(spark, rows, clash=False):
    """rows of (doc_id, text, source)."""
    df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit("x").alias(c) for c in CLASH])
    return df


def odd_rows():
    """Nulls, empty and blank texts, a very long text and line, repeated rows."""
    long = prose(1, 60000)
    return [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (None, prose(2, 40), "b"), (4, "one", "b"), (5, long, "c"),
            (6, prose(3, 80), "a"), (6, prose(3, 80), "a"), (None, None, None), (7, "ünïcode ﬁ   \U0001f600 x", "d"),
            (8, "a\n\nb\r\na\nb", "d"), (9, prose(3, 80), "c")]
