import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; the caller's columns of these names must not matter.
CLASHING = ["sha", "keep_id", "group_size", "cls", "n", "grp", "tree", "size", "keys", "sig", "text_key", "position",
            "positions", "epoch", "score", "held_out", "copies", "bucket", "row", "target", "items", "spans", "label", "p"]

BASE = "the quick brown fox jumps over the lazy dog while seven wizards boil a kettle of very strong green tea today"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))


def edge_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    return [
        (1, BASE, "en", "a", 10), (2, BASE, "en", "a", 10), (2, BASE, "en", "a", 10),
        (3, BASE + " Please", "en", "b", None), (4, None, None, None, None), (5, "", "en", None, 0),
        (6, "  \n\t ", None, "b", 4), (7, LONG, "en", "c", len(LONG)), (8, LONG + " end", "de", "c", 1),
        (9, "single", "de", "d", 6), (10, "SINGLE", "de", "d", 6), (11, "12345 +++ 67", "fr", "é", 12),
        (None, BASE, "en", "a", 1), (None, None, None, None, None), (None, "only without a name", "en", "a", 1),
        (None, "only without a name", "en", "a", 1),
        (12, "Größe über alles ist schön und daß der Fluß fließt", "de", "e", 1), (13, "日本語のテキスト 漢字 🙂 a", None, "f", 9),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows_of(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    got = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(got, key=lambda r: tuple((v is not None, v) for v in r))
