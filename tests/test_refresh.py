"""Exports written to a folder, and the whole rebuild over them."""

import json

import pytest
from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.plans.refresh import current, refresh
from trenchbook.sources import exports, publish
from trenchbook.sources.schema import load_columns, load_routing, load_schema

COMMON = ["Source", "Type", "Identifier", "Title", "Description", "IdentifierUUID"]
RELATION = ["RelationBelongsTo", "RelationBelongsToUUID"]
SHAPE = ["CoveragePosition", "CoverageXYZ"]
SHEET = {
    "asu.json": [*COMMON, *SHAPE, *RELATION],
    "cut.json": [*COMMON, *SHAPE, *RELATION],
    "filldeposit.json": [*COMMON, "Sub-Type", *SHAPE],
    "structure.json": [*COMMON, "Sub-Type", *SHAPE],
    "surface.json": [*COMMON, *SHAPE],
    "samplebag.json": [*COMMON, *RELATION],
    "specialfind.json": [*COMMON, *RELATION],
    "pottery.json": [
        "Source", "ContextID", "Identifier", *config.NOTE_COLUMNS, *config.SUMMED_COLUMNS,
        "ShapeCountComment", "PotteryCountDiagnosticsBeforeMending", "CoverageTemporal",
        "IdentifierUUID", *RELATION,
    ],
    "potteryjoin.json": ["Source", "IdentifierUUID", "RelationIncludesUUID"],
    "photo.json": ["Source", "IdentifierUUID", *RELATION],
    "flotation.json": ["Source", "Identifier", "IdentifierUUID", *RELATION],
    "residue.json": COMMON,
    "micromorphology.json": COMMON,
    "allcontext.json": [*COMMON, "Sub-Type", *SHAPE, *RELATION],
}
KEYS = ["Context_UUID", "ASU_UUID"]
PUBLISHED = {
    "dbschema/db_allcontext.json": [*SHEET["allcontext.json"], *KEYS],
    "dbschema/db_photo.json": [*SHEET["photo.json"], "FirstKey"],
    "dbschema/db_pottery.json": [*SHEET["pottery.json"], *KEYS, "SampleBag_UUID"],
    "dbschema/db_samplebag.json": [*SHEET["samplebag.json"], *KEYS],
    "dbschema/db_specialfind.json": [*SHEET["specialfind.json"], *KEYS],
}
REPORTS = {name: ["Identifier", "IdentifierUUID"] for name in config.REPORTS.values()}


def declare(name, columns):
    fields = []
    for c in columns:
        f = {"name": c, "type": "number" if c in config.SUMMED_COLUMNS else "string", "title": c}
        if c == "IdentifierUUID":
            f["constraints"] = {"required": True, "unique": True}
        if name in REPORTS and c == "Identifier":
            f["title"] = "ContextID"
        fields.append(f)
    return {"tablename": name, "fields": fields, "missingValues": ["", "N/A"]}


@pytest.fixture(scope="module")
def schemas(tmp_path_factory):
    folder = tmp_path_factory.mktemp("schema")
    for sub in ("dbschema", "excavation_report"):
        (folder / sub).mkdir()
    for name, columns in {**SHEET, **PUBLISHED, **REPORTS}.items():
        (folder / name).write_text(json.dumps(declare(name, columns)))
    return folder


def write(path, schema, rows, extra=(), without=()):
    columns = [c for c in SHEET[schema] if c not in without] + list(extra)
    lines = ["\t".join(columns)]
    lines += ["\t".join('"' + str(r.get(c, "")).replace('"', '""') + '"' for c in columns) for r in rows]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf8")


def ring(depth, size):
    far = 10 + size
    return f"POLYGON Z ((10 10 {depth}, {far} 10 {depth}, {far} {far} {depth}, 10 10 {depth}))"


@pytest.fixture(scope="module")
def site(tmp_path_factory):
    folder = tmp_path_factory.mktemp("exports")
    a, b = folder / "a", folder / "b"
    record = lambda key, **more: {"Source": "?", "Type": "x", "Identifier": key.lower(), "IdentifierUUID": key, **more}
    shape = f"GEOMETRYCOLLECTION({ring(5, 4)}, {ring(2, 3)})"
    write(a / "Trench A Fill Deposits.tab", "filldeposit.json",
          [record("C1", Type="FillDeposit", CoverageXYZ=shape, CoveragePosition="1,2", Description='two\nlines "here"'),
           record("C2", Type="FillDeposit", CoverageXYZ="POINT (1 1)")], extra=["Colour"])
    write(b / "Trench B Fill Deposits.tab", "filldeposit.json", [record("C3", Type="FillDeposit")])
    write(a / "Trench A Cuts.tab", "cut.json", [record("K1", Type="Cut", RelationBelongsToUUID="C1"), record("K1", Type="Cut")])
    write(a / "Trench A ASUs.tab", "asu.json",
          [record("A1", Type="ASU", RelationBelongsToUUID="X\\nC1"), record("A2", Type="Partition")])
    write(b / "Trench B Sample Bags.tab", "samplebag.json",
          [record("S1", RelationBelongsToUUID="A1"), record("S2"), record("S3", RelationBelongsToUUID="X")])
    write(b / "Trench B Special Finds.tab", "specialfind.json",
          [record("F1", Title="Obsidian blade", RelationBelongsToUUID="C1\\nA1"), record("F2", Title="spool", RelationBelongsToUUID="A1")])
    bag = lambda key, parent, n, phase: {
        "Source": "?", "ContextID": "1", "Identifier": key.lower(), "IdentifierUUID": key, "CoverageTemporal": phase,
        "RelationBelongsToUUID": parent, "PotteryCountBeforeMending": n, "PotteryKastri": f"k{key}"}
    write(b / "Trench B Pottery.tab", "pottery.json",
          [bag("P1", "S1", "3", "Phase A"), bag("P2", "C1", "2.0", "Phase B"), bag("P3", "", "5", "Phase C"),
           bag("P4", "C1", "many", "N/A")])
    write(a / "Trench A Photos.tab", "photo.json",
          [{"Source": "?", "IdentifierUUID": "I1", "RelationBelongsToUUID": "C1\\nC2"}, {"Source": "?", "IdentifierUUID": "I2"}])
    write(b / "Trench B Pottery Joins.tab", "potteryjoin.json",
          [{"Source": "?", "IdentifierUUID": "J1", "RelationIncludesUUID": "P1\\nS1"}])
    write(b / "Trench B Surfaces.tab", "surface.json", [record("C9", Type="Surface")], without=["Title"])
    (b / "Trench B Plans.tab").write_text("Source\n1\n")
    return folder


@pytest.fixture(scope="module")
def built(spark, site, schemas, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    refresh(spark, str(site), str(schemas), str(out))
    made = current(spark, str(out))
    return lambda name: spark.read.parquet(f"{made}/{name}"), made


def test_schema_files(schemas, tmp_path):
    schema = load_schema(schemas / "pottery.json")
    assert schema.names == SHEET["pottery.json"] and schema.missing_values == ("", "N/A")
    assert schema.struct()["PotteryCountFine"].dataType.simpleString() == "double"
    (tmp_path / "r.txt").write_text("Cuts.tab:cut.json\n\nBags.tab:samplebag.json\n")
    assert load_routing(tmp_path / "r.txt") == {"Cuts.tab": "cut.json", "Bags.tab": "samplebag.json"}
    (tmp_path / "c.txt").write_text("One\t\nTwo\n")
    assert load_columns(tmp_path / "c.txt") == ["One", "Two"]


def test_scan_order_and_values(spark, site, cells):
    path = str(site / "a" / "Trench A Fill Deposits.tab")
    found = exports.survey_files(spark, [path]).first()
    assert found["header"] == [*SHEET["filldeposit.json"], "Colour"] and found["spans_lines"]
    rows = exports.scan_exports(spark, [path], found["header"])
    first = rows.orderBy("seq").first()
    assert first["Description"] == 'two\nlines "here"' and first["Title"] is None
    assert [r.IdentifierUUID for r in rows.orderBy("seq").collect()] == ["C1", "C2"]


def test_large_file_is_split_and_keeps_its_order(spark, tmp_path):
    """One file over many tasks: first line is the header, lines keep their numbers."""
    n = 20000
    path = tmp_path / "Trench C Cuts.tab"
    path.write_text("Source\tIdentifier\n" + "".join(f"?\tname {i}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32KB")
    try:
        found = exports.survey_files(spark, [str(path)]).collect()
        assert [(f["header"], f["spans_lines"]) for f in found] == [(["Source", "Identifier"], False)]
        rows = exports.scan_exports(spark, [str(path)], found[0]["header"], multi_line=False)
        assert rows.rdd.getNumPartitions() > 5
        picked = rows.filter("Identifier in ('name 0', 'name 9999', 'name 19999')")
        numbered = exports.record_numbers(picked.withColumn("row", F.col("seq")), rows)
        assert {r.Identifier: r.record for r in numbered.collect()} == {
            "name 0": 2, "name 9999": 10001, "name 19999": 20001,
        }
        ordered = [r.Identifier for r in rows.orderBy("seq").collect()]
        assert ordered == [f"name {i}" for i in range(n)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_strip_columns(spark, site, schemas):
    rows = spark.createDataFrame([("a", "b")], "Source string, Type string")
    with pytest.raises(ValueError, match="IdentifierUUID"):
        exports.strip_columns(rows, load_schema(schemas / "surface.json"))


def test_coverage_and_headers(built, cells):
    read, _ = built
    coverage = dict(cells(read("issues/file_coverage"), "file_name", "schema"))
    assert coverage["Trench B Plans.tab"] == "no schema"
    assert coverage["Trench B Sample Bags.tab"] == "samplebag.json" and len(coverage) == 11
    states = dict(cells(read("issues/file_coverage"), "file_name", "state"))
    assert states["Trench B Plans.tab"] == "no schema" and states["Trench B Surfaces.tab"] == "failed"
    assert sorted(states.values()).count("stripped") == 9
    assert ("no schema", "no schema", 1) in cells(read("issues/file_coverage_counts"))
    # A file without a column of its schema is left out and reported.
    assert cells(read("issues/headers"), "column", "code") == [("Title", "missing-header")]


def test_types(built, cells):
    read, _ = built
    assert cells(read("tables/types/FillDeposit"), "Source", "IdentifierUUID") == [
        ("Trench A Fill Deposits", "C1"), ("Trench A Fill Deposits", "C2"), ("Trench B Fill Deposits", "C3"),
    ]
    counts = dict(cells(read("issues/type_row_counts")))
    assert counts["FillDeposit"] == 3 and counts["Pottery"] == 4 and "Surface" not in counts


def test_violations(built, cells):
    read, _ = built
    got = cells(read("issues/violations"), "table", "source_file", "record", "column", "code")
    assert ("Cut", "Trench A Cuts.tab", 2, "IdentifierUUID", "unique-constraint") in got
    assert ("Cut", "Trench A Cuts.tab", 3, "IdentifierUUID", "unique-constraint") in got
    assert ("Pottery", "Trench B Pottery.tab", 5, "PotteryCountBeforeMending", "type-or-format-error") in got
    assert len(got) == 3
    assert cells(read("issues/pottery_violations_site"), "trench", "potbag", "record", "field_type") == [
        ("Trench B Pottery", "p4", 5, "number")]
    twice = cells(read("issues/all_context_violations"), "column", "value", "record", "code")
    assert [t for t in twice if t[1] == "K1"] == [("IdentifierUUID", "K1", r, "unique-constraint") for r in (2, 3)]


def test_keys_and_rollups(built, cells):
    read, _ = built
    assert cells(read("tables/all_context"), "IdentifierUUID", *KEYS) == sorted([
        ("A1", "C1", "A1"), ("A2", None, "A2"), ("C1", "C1", None), ("C2", "C2", None),
        ("C3", "C3", None), ("K1", "K1", None), ("K1", "K1", None)], key=str)
    # A cut keeps what it belongs to.
    assert ("K1", "C1") in cells(read("tables/all_context"), "IdentifierUUID", "RelationBelongsToUUID")
    assert cells(read("tables/pottery"), "IdentifierUUID", *KEYS, "SampleBag_UUID") == [
        ("P1", "C1", "A1", "S1"), ("P2", "C1", None, None), ("P3", None, None, None), ("P4", "C1", None, None)]
    assert cells(read("tables/pottery_by_context"), "Context_UUID", "PotteryCountBeforeMending") == [("C1", 5)]
    listed = read("tables/bag_ids_by_context").orderBy("key", "seq")
    assert [(r.key, r.n, r.Identifier) for r in listed.collect()] == [("C1", 0, "p1"), ("C1", 1, "p2"), ("C1", 2, "p4")]
    assert cells(read("issues/rollup_reconcile")) == [("context", 10, 5, 5), ("context_asu", 10, 5, 5)]
    assert cells(read("issues/bad_numbers"), "Identifier", "value") == [("p4", "many")]
    assert cells(read("issues/sample_bag_no_parent"), "IdentifierUUID") == [("S2",)]
    assert cells(read("issues/sample_bag_unknown_parent"), "IdentifierUUID", "parent") == [("S3", "X")]


def test_layers(built, cells):
    read, _ = built
    layer = read("layers/context_phase_pottery")
    assert cells(layer, "IdentifierUUID", "Phase A", "Phase B", "Period", "wkt") == [
        ("C1", "yes", "yes", "B", ring(2, 3))]
    notes = read("tables/bag_notes").filter("target = 'C1'").orderBy(F.desc("seq"))
    assert [(r.n, r.Kastri) for r in notes.collect()] == [(0, "kP4"), (1, "kP2"), (2, "kP1")]
    assert layer.schema["wkt"].metadata["crs"] == config.LAYER_CRS
    assert cells(read("layers/context_sf_summary"), "IdentifierUUID", "obsidian", "spool_whorl") == [("C1", 1, 1)]
    assert cells(read("layers/all_contexts"), "UUID", "kind") == [("C1", "close"), ("C1", "open")]


def test_published(spark, built, cells):
    read, out = built
    assert cells(read("database/cut"), "IdentifierUUID") == [("K1",)]
    assert cells(read("issues/rejects_cut"), "IdentifierUUID", "reason") == [("K1", "key loaded before")]
    photos = read("database/photo")
    assert cells(photos, "RelationBelongsToUUID", "FirstKey") == [(None, None), ("C1", "I1"), ("C2", "I1")]
    pottery = read("database/pottery")
    assert dict(pottery.dtypes)["PotteryCountBeforeMending"] == "double" and pottery.count() == 3
    assert cells(read("issues/rejects_pottery"), "IdentifierUUID", "reason", "column", "value") == [
        ("P4", "not a number", "PotteryCountBeforeMending", "many")]
    counts = {r.table: (r.loaded, r.failed) for r in read("issues/load_counts").collect()}
    assert counts["pottery"] == (3, 1) and counts["cut"] == (1, 1) and set(counts) == set(config.PUBLISHED_TABLES)
    assert cells(read("issues/file_totals")) == [(9, 7, 2)]  # one file lacks a column, one has no schema
    assert cells(read("issues/context_counts")) == [(5, 2, 7)]
    for name in config.PUBLISHED_TABLES:
        table = read(f"database/{name}")
        assert table.filter(F.col("IdentifierUUID").isNull()).count() == 0
    report = spark.read.option("header", True).csv(f"{out}/report/fill_deposit")
    assert report.columns == ["ContextID", "IdentifierUUID"] and report.count() == 3


def test_a_later_write_replaces_the_first(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 3):
        publish.write_table(spark.range(n).toDF("id"), path)
    assert spark.read.parquet(path).count() == 3


def test_names_with_brackets_are_literal(spark, tmp_path):
    for name in ("Trench [A] Cuts.tab", "Trench {B}* Cuts.tab"):
        (tmp_path / name).write_text("Source|Identifier\n?|one\n")
    paths = [str(p) for p in sorted(tmp_path.iterdir())]
    found = exports.survey_files(spark, paths, "|")
    assert [r.header for r in found.collect()] == [["Source", "Identifier"]] * 2
    rows = exports.scan_exports(spark, paths, ["Source", "Identifier"], "|")
    assert [r.Identifier for r in rows.collect()] == ["one"] * 2


def test_sorted_lists_are_sorted(spark, tmp_path):
    rows = spark.range(2000).selectExpr("cast(id * 7919 % 2000 as string) as a", "id as b").repartition(7)
    publish.write_sorted(rows, str(tmp_path / "list"), "a")
    values = [r.a for f in sorted((tmp_path / "list").glob("part-*")) for r in spark.read.parquet(str(f)).collect()]
    assert values == sorted(values) and len(values) == 2000


def test_an_unfinished_rebuild_is_not_read(spark, site, schemas, tmp_path, monkeypatch):
    first = refresh(spark, str(site), str(schemas), str(tmp_path)).out
    assert current(spark, str(tmp_path)) == first

    def fail(*_):
        raise OSError("no space left")

    monkeypatch.setattr(publish, "publish_reports", fail)
    with pytest.raises(OSError):
        refresh(spark, str(site), str(schemas), str(tmp_path))
    assert current(spark, str(tmp_path)) == first
