"""Hand-made rows for what the recorded data can look like."""

from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.operators import chronology, contexts, finds, geo, quality, relations, rollup
from trenchbook.sources import publish
from trenchbook.sources.schema import Field, TableSchema

CONTEXT = "Source Type Identifier IdentifierUUID RelationBelongsToUUID"


def master(frame):
    return contexts.master_context(
        frame(
            CONTEXT,
            ("T1", "FillDeposit", "1", "C1", None),
            ("T1", "Cut", "2", "C2", "C1"),
            ("T1", "ASU", "1.1", "A1", "C1"),
            ("T1", "Partition", "1.2", "A2", "X\\nC2\\nC1"),
            ("T1", "ASU", "1.3", "A3", None),
            ("T1", "ASU", "1.4", "A4", "A1"),
        )
    )


def test_align_keeps_values_and_fills_gaps(frame, cells):
    cut = frame("Type IdentifierUUID RelationBelongsToUUID", ("Cut", "C2", "C1"))
    fill = frame("Type IdentifierUUID Sub-Type Extra", ("FillDeposit", "C1", "soil", "x"))
    rows = contexts.align_contexts([cut, fill], ["Type", "Sub-Type", "IdentifierUUID", "RelationBelongsToUUID"])
    assert cells(rows.drop("seq")) == [("Cut", None, "C2", "C1"), ("FillDeposit", "soil", "C1", None)]


def test_master_context(frame, cells):
    rows = master(frame)
    assert cells(rows, "IdentifierUUID", "Context_UUID", "ASU_UUID") == [
        ("A1", "C1", "A1"), ("A2", "C2", "A2"), ("A3", None, "A3"), ("A4", None, "A4"),
        ("C1", "C1", None), ("C2", "C2", None),
    ]
    assert cells(contexts.asu_no_parent(rows), "IdentifierUUID", "reason") == [
        ("A3", "no parent given"), ("A4", "parent is not a context"),
    ]
    assert cells(contexts.context_counts(rows)) == [(2, 4, 6)]


def test_classify_parents(frame, cells):
    m = master(frame)
    index = contexts.key_index(m, frame("IdentifierUUID", ("W1",)), frame("IdentifierUUID", ("P1",), ("W1",)))
    children = frame(
        "IdentifierUUID RelationBelongsToUUID",
        ("S1", "C1\\nC2"), ("S2", "A1"), ("S3", None), ("S4", "A3"), ("S5", "W1\\nP1\\nX"),
        ("S6", "C1\\nX"), ("S7", "X\\nY"), ("S8", "A2\\nC1"),
    )
    rows = relations.classify_parents(children, index, m)
    assert cells(rows.drop("seq", "RelationBelongsToUUID")) == [
        ("S1", "C2", None, None, None),  # the last hit of a kind
        ("S2", "C1", "A1", None, None),  # context through the ASU
        ("S3", None, None, None, None),  # a blank takes nothing from the row before
        ("S4", None, "A3", None, None),
        ("S5", None, None, "W1", "P1"),
        ("S6", "C1", None, None, None),
        ("S7", None, None, None, None),
        ("S8", "C1", "A2", None, None),
    ]
    assert cells(relations.orphans_unresolved(children, index, "IdentifierUUID")) == [("S5", "X"), ("S7", "Y")]
    assert cells(relations.orphans_blank(children, "IdentifierUUID")) == [("S3",)]


def pottery(frame):
    keyed = "IdentifierUUID Context_UUID ASU_UUID"
    samples = frame(keyed, ("S1", "C1", "A1"), ("S2", None, None))
    found = frame(keyed, ("F1", "C2", None))
    bags = frame(
        "Source ContextID Identifier IdentifierUUID RelationBelongsToUUID",
        ("T1", "1", "p1", "P1", "S1"), ("T1", "1", "p2", "P2", "A1"), ("T1", "1", "p3", "P3", "C1"),
        ("T1", "2", "p4", "P4", "F1"), ("T1", "2", "p5", "P5", None), ("T1", "2", "p6", "P6", "S2\\nX\\nC2"),
        ("T1", "2", "p7", "P7", "X"), ("T1", "2", "p8", "P8", "A3"),
    )
    return relations.pottery_parents(bags, samples, master(frame), found)


def test_pottery_parents(frame, cells):
    rows = pottery(frame)
    assert cells(rows, "IdentifierUUID", "Context_UUID", "ASU_UUID", "SampleBag_UUID") == [
        ("P1", "C1", "A1", "S1"), ("P2", "C1", "A1", None), ("P3", "C1", None, None),
        ("P4", "C2", None, None), ("P5", None, None, None), ("P6", "C2", None, None),
        ("P7", None, None, None), ("P8", None, None, None),
    ]
    assert cells(relations.pottery_no_keys(rows, "Identifier")) == [("p5",), ("p7",), ("p8",)]


def test_explode_photos(frame, cells):
    photos = frame("IdentifierUUID RelationBelongsToUUID", ("I1", "C1\\nA1\\nC1"), ("I2", "C1"), ("I3", None))
    rows = relations.explode_photos(photos)
    got = cells(rows, "OriginalIdentifierUUID", "RelationBelongsToUUID")
    assert got == [(None, None), (None, "C1"), ("I1", "A1"), ("I1", "C1"), ("I1", "C1")]
    # The same parent named twice gives the same key, and loads once.
    assert rows.select("IdentifierUUID").distinct().count() == 4
    assert geo.dedupe_first(rows, "IdentifierUUID").count() == 4


def test_join_bag_links(frame, cells):
    bags = frame(
        "IdentifierUUID SampleBag_UUID ContextID Context_UUID ASU_UUID",
        ("P1", "S1", "1", "C1", None), ("P2", "S1", "2", "C2", "A2"),
    )
    joins = frame("IdentifierUUID RelationIncludesUUID", ("J1", "P1\\nS1\\nX"), ("J2", None))
    assert cells(relations.join_bag_links(joins, bags, "IdentifierUUID")) == [
        ("J1", 0, "P1", "1", "C1", None, True), ("J1", 1, "S1", "2", "C2", "A2", True),
        ("J1", 2, "X", None, None, None, False), ("J2", None, None, None, None, None, False),
    ]


BAG = "Source ContextID Identifier Context_UUID ASU_UUID n"


def bags(frame):
    return frame(
        BAG,
        ("T1", "1", "a", "C1", None, "3"), ("T1", "1", "b", "C1", "A1", "12.7"),
        ("T2", "9", "c", "C1", "A1", "-1.9"), ("T1", "1", "d", "C1", None, "n/a"),
        ("T1", "3", "e", None, None, "5"), ("T1", "4", "f", "C4", "A9", None),
    )


def test_rollups(frame, cells):
    rows, m = bags(frame), master(frame)
    by_asu = rollup.rollup_context_asu(rows, m, ["n"])
    assert set(cells(by_asu)) == {
        ("T1", "1", 3, "C1", None), ("T1", "1", 11, "C1", "A1"),
        ("T1", "4", 0, None, "A9"),  # an unknown ASU has no context
    }
    by_context = rollup.rollup_context(rows, ["n"])
    assert cells(by_context) == [
        ("T1", "1", 14, "C1", None), ("T1", "4", 0, "C4", None),
    ]
    listed = rollup.concat_ids(rows, rollup.context_key())
    assert cells(listed, "key", "Identifier") == [("C1", c) for c in "abcd"] + [("C4", "f")]
    assert cells(rollup.rollup_reconcile(rows, {"a": by_asu, "c": by_context}, "n")) == [
        ("a", 19, 14, 5), ("c", 19, 14, 5),
    ]
    assert cells(rollup.bad_numbers(rows, ["n"])) == [("T1", "1", "d", "n", "n/a")]
    assert cells(rollup.not_rolled_up(rows, "Identifier")) == [("context", "e"), ("context_asu", "e")]
    assert cells(rollup.distinct_keys(rows)) == [
        ("asu", "A1"), ("asu", "A9"), ("context", "C1"), ("context", "C4"), ("context without asu", "C1"),
    ]


def test_all_summed_columns_in_one_pass(spark, cells):
    columns = config.SUMMED_COLUMNS
    assert len(columns) == 51
    rows = spark.range(100).select(
        (F.col("id") % 2).cast("string").alias("key"),
        *[F.concat((F.col("id") + i).cast("string"), F.lit(".5")).alias(c) for i, c in enumerate(columns)],
    )
    sums = rollup.int_sums(rows, F.col("key"), columns)
    for row in sums.collect():
        ids = range(int(row["key"]), 100, 2)
        assert [row[c] for c in columns] == [sum(x + i for x in ids) for i in range(51)]


def test_phases(frame, cells):
    note = "PotteryKastri PotterySherdSizes PotteryWear PotteryBurning"
    rows = frame(
        f"Context_UUID ASU_UUID CoverageTemporal {note}",
        ("C1", "A1", "Phase A", "k1", "s1", "w1", None),
        ("C1", None, "Phase A?", "k2", None, "w2", "b2"),
        ("C1", None, "Mixed", "k3", "s3", "w3", "b3"),
        (None, None, "Phase B", "k4", "s4", "w4", "b4"),
    )
    m = geo.geo_contexts(
        master(frame).withColumns({"CoveragePosition": F.lit("1,2"), "CoverageXYZ": F.lit(None).cast("string")})
    )
    both = chronology.phases_context_asu(m, rows)
    assert cells(both.filter("IdentifierUUID in ('C1', 'A1', 'C2')"), "IdentifierUUID", "Phase A", "Other",
                 "Period") == [
        ("A1", "yes", "no", "A"),
        ("C1", "?", "Mixed", "Mixed"),
        ("C2", "no", "no", "no"),
    ]
    assert cells(chronology.phases_context(both), "IdentifierUUID", "Period") == [("C1", "Mixed"), ("C2", "no")]
    notes = chronology.bag_notes(chronology.bag_levels(rows)).filter("target = 'C1'").orderBy(F.desc("seq"))
    assert [(r.Kastri, r.PotteryBurning) for r in notes.collect()] == [("k3", "b3"), ("k2", "b2"), ("k1", "")]


def test_counts_match_their_own_level(frame, cells):
    phased = frame("Type IdentifierUUID Context_UUID ASU_UUID", ("Cut", "C1", "C1", None), ("ASU", "A1", "C1", "A1"))
    rolled = frame("Source Context_UUID ASU_UUID", ("T1", "C1", "A1"))
    got = chronology.counts_context_asu(phased, rolled)
    assert cells(got, "IdentifierUUID", "Pottery_Source") == [("A1", "T1")]
    assert cells(chronology.no_counts(phased, rolled, "IdentifierUUID")) == [("C1",)]


def test_finds(frame, cells):
    placed = frame("Type IdentifierUUID", ("Cut", "C1"), ("ASU", "A1"), ("Cut", "C2"))
    rows = frame(
        "Title Context_UUID ASU_UUID",
        ("spool", "C1", "A1"), ("Spindle whorl", "C1", None), ("worked stone", "C1", "C1"), ("bead", "C2", None),
    )
    classes = [*finds.CLASSES]
    assert cells(finds.finds_context_asu(placed, rows), "IdentifierUUID", *classes) == [
        ("A1", 0, 0, 0, 0, 0, 1), ("C1", 0, 0, 0, 0, 1, 2), ("C2", 0, 0, 0, 0, 0, 0),
    ]


def test_geo_and_issues(frame, cells):
    square = "GEOMETRYCOLLECTION(POLYGON Z ((0 0 5, 2 0 5, 2 2 5, 0 2 5, 0 0 5)))"
    rows = frame(
        f"{CONTEXT} Sub-Type CoveragePosition CoverageXYZ Context_UUID",
        ("T1", "Cut", "1", "C1", None, None, "1,2,3", square, "C1"),
        ("T2", "Cut", "1", "C1", None, None, "7", None, "C1"),
        ("T1", "ASU", "1.1", "A1", None, None, None, "POINT (1 1)", "C9"),
    )
    placed = geo.geo_contexts(rows)
    assert cells(placed, "Source", "IdentifierUUID", "X", "Y") == [("T1", "A1", None, None), ("T1", "C1", "1", "2")]
    assert cells(geo.polygon_issues(rows, "Source"), "Source", "reason") == [
        ("T1", "fewer than two polygons"), ("T1", "not a geometry collection"),
        ("T2", "key used before"), ("T2", "not a geometry collection"),
    ]
    assert cells(geo.asu_without_context_row(placed)) == [("T1", "ASU", "1.1", "C9")]
    assert cells(geo.polygon_features(placed), "UUID", "kind") == [("C1", "open")]
    assert cells(geo.null_geometry_counts(placed)) == [(1, 1)]
    layer = geo.layer(placed, ["IdentifierUUID"])
    assert layer.schema["wkt"].metadata["crs"] == config.LAYER_CRS


def test_bad_wkt(frame, cells):
    good = "POLYGON Z ((0 0 5, 2 0 5, 2 2 5, 0 0 5))"
    fine = "POLYGON ((0 0, 1.2E-5 1, 1 1, 0 0))"
    bad = ["POLYGON ((0 0, 1 1, 0 0))", "POLYGON ((0 0, a 1, 1 1, 0 0))",
           "POLYGON ((0 0, 3 0, 3 3, 0 0), (1 1, 2 1, 2 2, 1 1))",
           "POLYGON Z ((0 0 9, 8 X 9, 8 8 9, 0 0 9))", "POLYGON ((0 0, NaN 1, 1 1, 0 0))",
           "POLYGON ((0 0, 1d 1, 1 1, 0 0))", "POLYGON ((0 0, 1e999 1, 1 1, 0 0))",
           "POLYGON ((0 0, 3 0, 3 3, 0 1))", "POLYGON ((0 0, 3 0 1, 3 3, 0 0))", "POLYGON M ((0 0 1, 1 0 1, 1 1 1, 0 0 1))",
           "POLYGON EMPTY"]
    rows = frame("w", (f"GEOMETRYCOLLECTION({good}, {', '.join(bad[:6])}, {fine}, {', '.join(bad[6:])})",), (good,))
    got = [w.strip(", )") if "EMPTY" in w else w for (w,) in cells(geo.bad_wkt(rows, "w"))]
    assert sorted(got) == sorted(bad)
    measured = {r.wkt for r in geo.split_collection(rows.withColumn("CoverageXYZ", F.col("w"))).collect() if r.area is not None}
    holed = "POLYGON ((0 0, 3 0, 3 3, 0 0))"
    assert measured == {good, fine, holed, bad[0], "POLYGON ((0 0, 3 0, 3 3, 0 1))"}


SCHEMA = TableSchema(
    (
        Field("Source"), Field("Type", required=True), Field("Identifier", required=True, unique=True),
        Field("Title", enum=("bone", "shell")), Field("Count", type="number"),
        Field("Date", type="datetime", format="%Y"),
        Field("IdentifierUUID", required=True, unique=True),
    ),
    missing_values=("", "N/A"),
)


def test_violations(frame, cells):
    rows = frame(
        "Source Type Identifier Title Count Date IdentifierUUID file_name",
        ("T1", "Bag", "1", "bone", "3.5", "2018-07-01T10:00:00", "U1", "a"),
        ("T1", "Bag", "1", "Bone", "x", "soon", "U2", "a"),
        ("T1", "N/A", None, "", "", None, "U3", "a"),
        ("T2", "Bag", "1", "shell", None, None, "U1", "b"),
        ("T2", "Bag", "2", "shell", None, None, "U4", "c"),
    )
    found = quality.violations(rows, SCHEMA)
    assert cells(found, "source_file", "row", "column", "code") == [
        ("a", "000000", "Identifier", quality.UNIQUE), ("a", "000001", "Count", quality.TYPE),
        ("a", "000001", "Date", quality.TYPE), ("a", "000001", "Identifier", quality.UNIQUE),
        ("a", "000001", "Title", quality.ENUM), ("a", "000002", "Identifier", quality.REQUIRED),
        ("a", "000002", "Type", quality.REQUIRED),
    ]
    assert found.filter("row = '000001'").first()["item"] == "T1 - Bag - 1 - Bone"
    assert {r.column: r.field_format for r in found.collect()} == {
        "Identifier": "default", "Count": "default", "Date": "%Y", "Title": "default", "Type": "default"}
    assert quality.check_values(rows, TableSchema((Field("Source"),))).collect() == []
    site_wide = quality.check_unique(quality.missing_values(rows, SCHEMA), SCHEMA, site_wide=True)
    assert cells(site_wide.filter("column = 'IdentifierUUID'"), "row") == [("000000",), ("000003",)]
    counts = quality.violation_counts(rows, found)
    assert cells(counts) == [("a", 3, 7, True), ("b", 1, 0, False), ("c", 1, 0, False)]
    assert cells(quality.file_totals(counts)) == [(3, 2, 1)]


def test_number_cells(frame, cells):
    """Recorded rows and rows with nulls for missing values have the same problems; only number columns are laid out."""
    schema = TableSchema((Field("a", required=True), Field("n", type="number", required=True), Field("m", type="number")), missing_values=("", "-"))
    rows = frame("text a n m", ("t1", "x", "1", "-"), ("t2", "", "1d", ""), ("t3", "y", None, "2,5"), ("t4", "-", "-", "NaN"))
    shown = ("text", "row", "column", "code", "value", "field_type")
    found = [
        cells(quality.check_values(r, schema, "a", "seq", ("text",), recorded=recorded), *shown)
        for r, recorded in ((rows, True), (quality.missing_values(rows, schema), False))
    ]
    assert found[0] == found[1] and [(t, c, v) for t, _, c, _, v, _ in found[0]] == [
        ("t2", "a", None), ("t2", "n", "1d"), ("t3", "m", "2,5"), ("t3", "n", None),
        ("t4", "a", None), ("t4", "m", "NaN"), ("t4", "n", None),
    ]


def test_header(spark, cells):
    header = ["Source", "Type", "Identifier", "Title", "Count", "Date", "Colour"]
    files = spark.createDataFrame([("f", header), ("g", SCHEMA.names)], "source_file string, header array<string>")
    found = quality.check_header(files, SCHEMA)
    assert cells(found, "source_file") == [("f",), ("f",)]
    assert cells(found, "column", "code") == [
        ("Colour", quality.EXTRA_HEADER), ("IdentifierUUID", quality.MISSING_HEADER),
    ]


def test_publish(frame, cells):
    rows = frame(
        "Source Type Identifier Title Count Date IdentifierUUID",
        ("T1", "Bag", "1", "bone", "3.5", None, "U1"), ("T2", "Bag", "2", "bone", "x", None, "U1"),
        ("T3", "Bag", "3", "bone", None, None, None), ("T4", "Bag", "4", "bone", "7", None, "U4"),
    )
    loaded = publish.publish_table(rows, SCHEMA)
    assert cells(loaded, "Source", "Count", "IdentifierUUID") == [("T1", 3.5, "U1"), ("T4", 7.0, "U4")]
    assert cells(publish.publish_rejects(rows, SCHEMA, ["Source"]), "Source", "reason", "column", "value") == [
        ("T2", "not a number", "Count", "x"), ("T3", "no key", None, None),
    ]
    assert cells(publish.load_counts(rows, SCHEMA)) == [(2, 2)]


def test_a_copy_loads_where_the_first_row_does_not(frame, cells):
    rows = frame(
        "Source Type Identifier Title Count Date IdentifierUUID",
        ("T1", "Bag", "1", "bone", "1d", None, "U1"), ("T2", "Bag", "2", "bone", "2", None, "U1"),
        ("T3", "Bag", "3", "bone", "3", None, "U1"), ("T4", "Bag", "4", "bone", "NaN", None, "U2"),
    )
    assert cells(publish.publish_table(rows, SCHEMA), "Source", "Count") == [("T2", 2.0)]
    assert cells(publish.publish_rejects(rows, SCHEMA, ["Source"]), "Source", "reason") == [
        ("T1", "not a number"), ("T3", "key loaded before"), ("T4", "not a number")]
    assert cells(publish.load_counts(rows, SCHEMA)) == [(1, 3)]
