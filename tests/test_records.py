"""Records cut apart by many tasks, against the reader that takes a file whole."""

import random

import pytest
from pyspark.sql import functions as F

from trenchbook.sources import exports, records
from trenchbook.sources.schema import parse_schema

COLUMNS = ["Source", "Title", "Note"]
SCHEMA = parse_schema({"fields": [{"name": c} for c in COLUMNS]})


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "2KB")
    spark.conf.set(names[1], "0")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def read(spark, folder, out, schema=SCHEMA):
    """(rows, lines, spanning, surveyed), each step written as the rebuild writes it."""

    def kept(name, rows):
        rows.write.parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    lines = kept("lines", records.read_lines(spark, str(folder)))
    spanning = kept("spanning", records.spanning_lines(lines))
    whole = records.whole_records(lines, spanning)
    surveyed = kept("survey", exports.survey_records(whole))
    rows = exports.read_type(whole, surveyed, schema)
    return rows and kept("rows", rows), lines, spanning, surveyed


def cell(draw, breaks):
    """A value as an export may write it: plain, with a quote that opens nothing, or quoted."""
    text = "".join(draw.choices(["a", "é", " ", "bc", ",", '"', "\n"], k=draw.choice([0, 1, 4, 12])))
    if draw.random() < 0.5:
        plain = text.replace("\n", "")
        return plain.lstrip('"')
    if draw.random() < 0.004:
        text += "long\n" * 1500  # over several blocks
    kept = text if draw.random() < breaks else text.replace("\n", " ")
    return '"' + kept.replace('"', '""').replace(" ", draw.choice([" ", "\t"])) + '"'


@pytest.mark.parametrize("breaks", [0.0, 0.02, 1.0])
def test_same_rows_as_the_whole_file_reader(spark, tmp_path, small_blocks, breaks):
    draw = random.Random(int(breaks * 100))
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("Trench A Cuts.tab", "Trench B Cuts.tab"):
        rows = [[f"n{i}", *(cell(draw, breaks) for _ in COLUMNS[1:])] for i in range(1500)]
        text = "\n".join("\t".join(r) for r in [COLUMNS, *rows])
        (folder / name).write_text(text, encoding="utf8")
    rows, lines, spanning, _ = read(spark, folder, tmp_path / "out")
    assert lines.select("path", "block").distinct().count() > 20
    assert (spanning.count() > 0) == (breaks > 0)
    for path in sorted(folder.iterdir()):
        mine = rows.where(F.col("file_name") == path.name).orderBy("seq").collect()
        reference = exports.scan_exports(spark, [str(path)], COLUMNS).orderBy("seq").collect()
        assert len(mine) == 1500
        assert [(r.Title, r.Note) for r in mine] == [(r.Title, r.Note) for r in reference]
        numbered = exports.record_numbers(
            rows.where(F.col("file_name") == path.name).withColumn("row", F.col("seq")), rows
        )
        places = {r.record: r.place for r in numbered.select("record", F.col("seq.row").alias("place")).collect()}
        assert [places[i + 2] for i in range(1500)] == [r.seq["row"] for r in mine]


def test_one_stray_record_leaves_the_other_lines_where_they_are(spark, tmp_path, small_blocks):
    folder = tmp_path / "in"
    folder.mkdir()
    body = [f"?\tname {i}\tnote" for i in range(5000)]
    body[2500] = '?\tname 2500\t"two\nlines"'
    (folder / "Trench C Cuts.tab").write_text("\n".join(["\t".join(COLUMNS), *body]) + "\n")
    rows, lines, spanning, _ = read(spark, folder, tmp_path / "out")
    assert spanning.count() == 2 and lines.rdd.getNumPartitions() > 3
    assert [r.Title for r in rows.orderBy("seq").collect()] == [f"name {i}" for i in range(5000)]
    assert rows.where("Title = 'name 2500'").first()["Note"] == "two\nlines"
    whole = records.whole_records(lines, spanning)
    whole.collect()
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]


@pytest.mark.parametrize(
    "text, want",
    [
        ("", None),
        ("Source\tTitle\tNote", []),
        ("﻿Source\tTitle\tNote\r\na\tb\tc\r\n\r\nd\te\tf\r\n", [("b", "c"), ("e", "f")]),
        ("Source\tTitle\tNote\na\tb\n\t\t\na\tb\tc\td\n", [("b", None), (None, None), ("b", "c")]),
        ('Source\tTitle\tNote\na\t"open\nto the\nend', [("open\nto the\nend", None)]),
        ('"Source"\t"Title"\t"Note"\n"a"\t""\t""""\n', [(None, '"')]),
        ('Note\tTitle\tTitle\tSource\n5" pipe\tx\ty\tz\n', [("x", '5" pipe')]),
        ('Source\tTitle\n"a"\tb\n', None),
    ],
)
def test_odd_files(spark, tmp_path, text, want):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "Trench A Cuts.tab").write_text(text, encoding="utf8", newline="")
    rows, *_ = read(spark, folder, tmp_path / "out")
    assert (rows and [(r.Title, r.Note) for r in rows.orderBy("seq").collect()]) == want


def test_many_files_and_headers_are_one_scan(spark, tmp_path):
    """10,000 files with 500 headers; paths stay in tables, and the plan doesn't grow with headers."""
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(10_000):
        kind = i % 500
        names = [*(f"x{kind}_{j}" for j in range(kind % 7 + 1)), *COLUMNS]
        values = [*("-" for _ in range(kind % 7 + 1)), "?", f"t{i}", f"n{i}"]
        (folder / f"Trench {i} Cuts.tab").write_text("\t".join(names) + "\n" + "\t".join(values) + "\n")
    rows, _, _, surveyed = read(spark, folder, tmp_path / "out")
    assert surveyed.select("header").distinct().count() == 500
    assert {(r.Source, r.Title, r.Note) for r in rows.select("Source", "Title", "Note").collect()} == {
        (f"Trench {i} Cuts", f"t{i}", f"n{i}") for i in range(10_000)
    }
