"""A small table with every awkward case, for all operators."""

from pyspark.sql import functions as F
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
#: Names that operators use inside; here they are columns of the input.
CLASHING = ["secrets", "score", "slot", "shard", "lang_pred", "row", "component", "term", "windows", "held_out", "_hash"]

SHORT = "the quick brown fox"
PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ROWS = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", "en"), (4, SHORT, "en"), (5, SHORT, "en"), (6, PROSE, "en"),
    (6, PROSE, "en"), (7, PROSE + " fifteen", None), (8, "word " * 40_000, "en"), (9, "x" * 200_000, "de"),
    (10, "12345678901234567890" * 2000, "de"), (11, "Ünïcode ß Σίσυφος 中文 😀 é é", "fr"), (None, PROSE, "en"),
    (None, None, None), (12, "\x00\x1c\x1d!?%$ 😀😀", "fr"),
]


def documents(spark):
    rows = [(i, t, lang, "s", len(t) if t is not None else None) for i, t, lang in ROWS]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.withColumns({name: F.lit("clash") for name in CLASHING})


def empty(spark):
    return documents(spark).where("false")


def texts(spark, *texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
