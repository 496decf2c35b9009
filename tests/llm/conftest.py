import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd(spark):
    """Small documents: null, empty and blank texts, repeated rows, ties, a long text, and clashing extra columns."""
    long_text = " ".join(f"word{i % 977} other{i % 31}" for i in range(9000))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "a b c"), (4, "a b c"), (5, "one two three four five six seven"),
            (6, "One two  three four five six SEVEN"), (7, long_text), (8, "Zoë! ### $$ 日本語 <|endoftext|> ok\n\nok\nok"),
            (None, "no id here at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # names that the operators use inside
    for c in ("n", "key", "words", "row", "kept", "score", "a", "b", "_k", "uid", "length", "component"):
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
