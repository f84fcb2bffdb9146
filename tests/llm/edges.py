"""Small tables of odd rows that every operator has to bear."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, n_lines string, __key string, __id string, word string, id string"
LONG = "x" * 200_000 + " " + "word " * 30_000


def rows():
    pad = ("en", "s", None, "k", "s", "n", "key", "id", "w", "i")
    return [(i, t, *pad) for i, t in [(1, "a b c d e f"), (2, None), (3, ""), (4, " \n\t "), (None, "null id"), (None, None), (1, "a b c d e f"), (1, "same id, other text"), (5, LONG), (6, "\n".join(["line of words"] * 40)), (7, "'s 1234 ... £5 日本語   tail")]]


def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brief(spark):
    """Without the very long text, where brute force needs it."""
    return spark.createDataFrame([r for r in rows() if r[1] != LONG], SCHEMA)
