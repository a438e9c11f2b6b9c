"""Small tables with the awkward cases: nulls, empties, ties, repeats, clashing columns, very long texts."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"shared{i}" for i in range(90))
LINE = "this very line is the same in each of these documents"

ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi", "en", "a"),
    (2, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi", "en", "a"),
    (3, "", "en", "b"),
    (4, None, None, None),
    (None, "a text without an id " + PASSAGE, "en", "b"),
    (5, "\x1c   \t\n\x0b\x0c\r", "en", "c"),
    (6, "one two", "fr", "c"),
    (7, f"start of seven {PASSAGE} end of seven\n{LINE}\n# * $ % & | < >", "en", "a"),
    (8, f"eight begins {PASSAGE} and eight ends\n{LINE}\n\n{LINE}", "en", None),
    (8, f"a second row of id eight {PASSAGE}", "en", "a"),
    (9, "word " * 60_000, "en", "long"),
    (9, "word " * 60_000, "en", "long"),
    (10, "café naïve \U0001f600 straße 中文 " * 30, "de", "b"),
    (11, "x" * 50_000, "en", "long"),
    (12, "repeat this phrase of eight words right here " * 3 + "and then some more words that do not repeat at all in this text " * 2, "en", "a"),
]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])
CLASHING = ["words", "key", "host", "h", "n", "fp", "node", "component", "part", "seq", "data", "shard", "size", "target", "start", "end", "spans", "score", "u", "v", "a", "b", "__h", "line"]


def awkward(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.selectExpr("*", *[f"'x' as {c}" for c in CLASHING])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    """(doc_id, text or empty) of all rows."""
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
