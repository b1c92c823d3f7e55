import pytest
from pyspark.sql import functions as F


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text), with further columns whose names operators use themselves."""

    def make(*rows):
        frame = spark.createDataFrame(list(rows), "doc_id long, text string")
        return frame.withColumns({"block": F.lit("x"), "key": F.lit(1), "spans": F.lit("y"), "row": F.lit("z"), "score": F.lit(2)})

    return make


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
ODD = [
    (None, "a text without a number that is long enough for all the windows of every operator here"),
    (1, None),
    (2, ""),
    (3, LONG),
    (4, "ein zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn"),
    (5, "ein zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn"),
    (5, "ein zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn"),
    (6, "one"),
    (7, "   \n\n \t "),
]
