"""Documents and other tables with every awkward case, shared by the operators' tests."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)
#: Names that operators use inside or return, beside a second text in another case.
CLASHES = ["Text", "n_words", "key", "id", "comp", "tx", "pos", "line", "h1", "s1", "hit", "items", "kept", "m", "removed", "length", "task"]


def docs(spark, rows):
    """documents from (doc_id, text[, lang])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """``df`` with extra columns whose names clash, one of them twice."""
    return df.select("*", *[F.lit("x").alias(c) for c in [*CLASHES, "key"]])


def as_rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)


ODD_ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, "one"),
    (5, "one"),
    (5, "one"),
    (6, "é ü 🙂 ß\u00a0x\n\ny"),
    (None, "a text of a row without any number, of some words and more words still."),
    (7, ("long words of a very long text, number %d of many. " * 10 % tuple(range(10))) * 400),
]
