import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with an extra column that has the name of an operator's own column."""

    def documents(rows, partitions=3):
        full = [(i, t, "en", "src", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, DOCS).repartition(partitions)
        from pyspark.sql import functions as F

        return df.withColumn("n_words", F.lit(-1)).withColumn("key", F.lit("x")).withColumn("score", F.lit(None).cast("double"))

    return documents


#: Null, empty, blank, one word, repeated rows and repeated ids.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (5, "é" * 40), (None, "no id")]
