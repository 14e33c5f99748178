"""Rows with every awkward case, shared by the operators' tests."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    # Names the operators use themselves.
    StructField("fp", StringType()), StructField("_k", StringType()), StructField("score", StringType()),
    StructField("h1", StringType()), StructField("_score", StringType()), StructField("ids", StringType()),
    StructField("copies", LongType()), StructField("_size", StringType()),
])
EXTRA = ("x", "y", "z", "h", "s", "i", 7, "q")
LONG = " ".join(f"word{i % 977} and{i % 31}." for i in range(30_000))


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    base = [
        (1, "one two three four five six seven eight nine ten.", "en", "a", 10),
        (1, "one two three four five six seven eight nine ten.", "en", "a", 10),
        (2, "", "en", "a", 0), (3, None, None, None, None), (None, "no key here at all.", "en", None, 5),
        (None, None, None, None, None), (4, LONG, "en", "b", len(LONG)), (5, " \t\n ", "de", "b", 4),
        (6, "short", "en", "c", 5), (6, "another text with the same key", "en", "c", 5), (7, LONG, "en", "b", len(LONG)),
        (8, "▁ odd \x00 \U0001F600 text", "en", "d", 9),
    ]
    return spark.createDataFrame([r + EXTRA for r in base], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, sf="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf}/documents.parquet")


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
