import pytest
from pyspark.sql import functions as F

TABLES = "/root/testdata/sf0.001"

#: Columns of other names that the operators use inside; they must not get in the way.
CLASHING = ("id", "n", "h", "s", "a", "b", "piece", "fp", "rep", "key", "y", "hot", "shard", "score", "hits", "coded", "comp", "ranges")


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{TABLES}/{name}.parquet")


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (id, text) with clashing extra columns, over a few partitions."""

    def make(rows, names="doc_id long, text string"):
        docs = spark.createDataFrame(rows, names).repartition(3)
        return docs.withColumns({c: F.lit("x") for c in CLASHING if c not in docs.columns})

    return make


#: Null and empty texts, a null id, repeated rows, white space, non-ASCII, and a long text.
EDGES = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "one two three"),
    (4, "one two three"),
    (5, "one two three"),
    (None, "no id here"),
    (6, "  two  spaces \n\n and\tmore "),
    (7, "é ü   ñandú ﬁ 😀 ​ ▁x <s> \x00 end"),
    (8, "word " * 30_000),
    (9, "x" * 100_000),
]


@pytest.fixture(scope="session")
def edges(frame):
    return frame(EDGES)
