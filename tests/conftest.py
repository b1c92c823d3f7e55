import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from trenchbook.plans.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def frame(spark):
    """Frame from rows of text; ``seq`` is the row's place unless the columns name it."""

    def make(columns: str, *rows):
        names = columns.split()
        if "seq" not in names:
            names, rows = [*names, "seq"], [(*r, f"{i:06d}") for i, r in enumerate(rows)]
        return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))

    return make


@pytest.fixture
def cells():
    """Chosen columns of a frame as a sorted list of tuples."""

    def read(rows, *columns):
        columns = columns or tuple(rows.columns)
        picked = rows.select(*[f"`{c}`" if "." not in c else c for c in columns]).collect()
        return sorted((tuple(r) for r in picked), key=lambda t: tuple((c is not None, str(c)) for c in t))

    return read
