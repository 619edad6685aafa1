"""Small tables with the rows that go wrong most easily."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
PROSE = "The river ran past the old mill and the people of the town went to it with their bread and their corn. "
ESSAY = (
    "When the first boats came up the river in spring, the people of the town went down to the old stone quay to see "
    "what they had brought. There was salt from the coast, cloth dyed in bright colours, and a few letters that had been "
    "on the way since autumn. Children ran between the carts, dogs barked at everyone, and the baker gave away bread "
    "that was a day old. By evening most of the goods were sold, and a fiddler played until the lamps burned low."
)


def sentence(i: int, words: int = 12) -> str:
    return " ".join(f"word{(i * 7919 + j * 104_729) % 99_991}x" for j in range(words))


ODD_TEXTS = [
    (0, None),
    (1, ""),
    (2, " \t\n "),
    (3, "é"),
    (4, "one"),
    (5, "one two"),
    (6, PROSE * 3),
    (7, PROSE * 3),
    (8, "a" * 5000),
    (9, "ab " * 4000),
    (10, "日本語のテキスト x " * 40),
    (11, "\n".join([PROSE] * 200)),
    (12, "### $$$ %%% &&& " * 40),
    (13, "a@b.co 1.2.3.4 4111 1111 1111 1111 +1 (555) 555-0100"),
    (14, sentence(1, 400)),
    (15, sentence(1, 390) + " " + sentence(2, 10)),
    (16, ESSAY),
    (None, "no id here " * 30),
    (None, None),
]


def documents(spark, rows=None, extra=None):
    """Rows of (doc_id, text) as a documents table, with one repeated row; extra adds clashing columns."""
    rows = ODD_TEXTS + [(6, PROSE * 3)] if rows is None else rows
    full = [(i, t, "en", None, None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for name in extra or ():
        df = df.selectExpr("*", f"'kept' AS `{name}`")
    return df


CLASHING = ("text_crc32", "shard", "k", "h", "f", "row", "spans", "kept", "print", "node", "range", "ids", "_part", "cut")
