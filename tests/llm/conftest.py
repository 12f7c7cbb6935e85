import pytest



@pytest.fixture(scope="session")
def frame(spark):
    """Rows as a frame, with columns whose names clash with those that operators make."""

    def make(rows, schema, clash=True):
        df = spark.createDataFrame(rows, schema)
        if clash:
            from pyspark.sql import functions as F

            for name in ("row", "w", "c", "n", "token", "key", "class", "id", "words", "line"):
                if name not in df.columns:
                    df = df.withColumn(name, F.lit("clash"))
        return df

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


