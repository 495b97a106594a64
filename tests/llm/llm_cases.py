import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}" for i in range(60_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """Rows every operator must take: nulls, empty, blank and very long texts, repeated rows and
    ids, and columns named like the operators' own."""
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one"),
        (5, LONG),
        (6, LONG),
        (7, "the quick brown fox jumps over the lazy dog and runs away from all the other animals"),
        (7, "the quick brown fox jumps over the lazy dog and runs away from all the other animals"),
        (8, "Ünïcode ÄÖÜ 😀 текст 漢字"),
        (None, "the quick brown fox jumps over the lazy dog and runs away from all the others"),
        (None, None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["id", "a", "n", "word", "start", "text_hash", "group", "kind", "score", "copies"]
    for name in names:
        frame = frame.withColumn(name, F.lit("clash"))
    return frame.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text"))


@pytest.fixture(scope="session")
def no_docs(awkward):
    return awkward.where("false")
