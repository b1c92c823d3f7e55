from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.functions import text, wkt


def test_relation_members(frame):
    rows = frame("r", ("a",), ("a\\nb",), ("",), (None,), (" a \\n\\nb",))
    got = [r.m for r in rows.orderBy("seq").select(text.relation_members("r").alias("m")).collect()]
    assert got == [["a"], ["a", "b"], [], None, ["a", "b"]]


def test_whole_number(frame):
    values = ["3", "3.0", "12.7", "-1.9", "", None, "n/a", " 4 ", "1e2", "1d", "0x1p3", "nan", "inf", "1e30"]
    rows = frame("x", *[(v,) for v in values]).orderBy("seq")
    got = [r.n for r in rows.select(text.whole_number(F.col("x")).alias("n")).collect()]
    assert got == [3, 3, 12, -1, None, None, None, 4, 100, None, None, None, None, None]
    bad = [r.b for r in rows.select(text.is_bad_number(F.col("x")).alias("b")).collect()]
    assert bad == [v in ("n/a", "1d", "0x1p3", "nan", "inf", "1e30") for v in values]


def test_routing(frame):
    names = ["Trench A ASUs.tab", "Trench B Sample Bags.tab", "Trench B Flotations.tab",
             "Trench B Plans.tab", "x", None]
    rows = frame("file_name", *[(n,) for n in names]).orderBy("seq")
    got = [r.s for r in rows.select(text.by_ending(F.col("file_name"), config.EXPORT_SCHEMAS).alias("s")).collect()]
    assert got == ["asu.json", "samplebag.json", "flotation.json", None, None, None]
    missing = rows.select(text.by_ending(F.lit("Stripped_T Human Bones.csv"), config.RECORD_TYPES).alias("s"))
    assert missing.first().s == "Human_Bone"


def test_file_stem(frame):
    rows = frame("f", ("Stripped_Trench A.2016.csv",), ("Trench B Cuts.tab",)).orderBy("seq")
    assert [r.s for r in rows.select(text.file_stem(F.col("f")).alias("s")).collect()] == [
        "Trench A", "Trench B Cuts",
    ]


def test_phase_spellings(frame):
    spellings = [*config.PHASE_SPELLINGS, "Phase A/B?", "Pre-Phase A?", "", None]
    rows = frame("p", *[(p,) for p in spellings]).orderBy("seq").select(
        text.phase_slot(F.col("p")).alias("slot"), text.phase_flag(F.col("p")).alias("flag")
    )
    got = [tuple(r) for r in rows.collect()]
    listed = len(config.PHASE_SPELLINGS)
    assert got[:listed] == list(config.PHASE_SPELLINGS.values())
    # Spellings outside the vocabulary stay what they are.
    assert got[listed:] == [("Other", "Phase A/B?"), ("Other", "Pre-Phase A?"), ("Other", ""), ("Other", "")]


def test_find_class(frame):
    titles = {
        "metals and metallurgical": "metallurgical", "Metal disc": "metallurgical", "OBSIDIAN": "obsidian",
        "Koufonisi pebble": "kouphonisi pebble", "Kouphonisi limestone pebble": "kouphonisi pebble",
        "stone disc": "stone disc", "worked stone": "worked stone", "spindle whorl": "spool_whorl",
        "spool": "spool_whorl", "bead": None, None: None,
    }
    rows = frame("t", *[(t,) for t in titles]).orderBy("seq")
    got = [r.c for r in rows.select(text.find_class(F.col("t")).alias("c")).collect()]
    assert got == list(titles.values())


SQUARE = "POLYGON Z ((0 0 5, 2 0 5, 2 2 5, 0 2 5, 0 0 5))"
FLAT = "POLYGON ((0 0, 3 0, 3 3, 0 3, 0 0))"
TWIN = "POLYGON Z ((10 10 1, 12 10 1, 12 12 1, 10 12 1, 10 10 1))"
DEEP = "POLYGON Z ((0 0 -4, 9 0 -4, 9 9 -4, 0 9 -4, 0 0 -4))"


def shapes(frame, *texts):
    rows = frame("w", *[(t,) for t in texts]).orderBy("seq")
    polygons = wkt.largest_two(wkt.measured_polygons(F.col("w")))
    return [tuple(r.s) for r in rows.select(wkt.opening_closing(polygons).alias("s")).collect()]


def test_opening_and_closing(frame):
    collection = lambda *p: "GEOMETRYCOLLECTION(" + ", ".join(p) + ")"
    assert shapes(
        frame,
        collection(SQUARE),
        collection(SQUARE, FLAT),
        collection(SQUARE, DEEP, "POINT Z (1 1 1)", FLAT),
        collection(SQUARE, TWIN),
        collection(FLAT, SQUARE, TWIN),
        "GEOMETRYCOLLECTION()",
        SQUARE,
        "POINT Z (1 1 1)",
        None,
    ) == [
        (SQUARE, None),
        (FLAT, SQUARE),
        (DEEP, FLAT),
        (SQUARE, None),  # equal areas count once
        (FLAT, SQUARE),  # the first of equal areas stays
        (None, None),
        (None, None),
        (None, None),
        (None, None),
    ]


def test_hole_keeps_outer_ring(frame):
    holed = "POLYGON Z ((0 0 5, 2 0 5, 2 2 5, 0 2 5, 0 0 5), (1 1 5, 1 2 5, 2 2 5, 1 1 5))"
    assert shapes(frame, f"GEOMETRYCOLLECTION({holed})") == [(SQUARE, None)]


def test_area_far_from_origin(frame):
    ring = "POLYGON ((4000000.5 4000000.5, 4000001.5 4000000.5, 4000001.5 4000001.5, 4000000.5 4000001.5, 4000000.5 4000000.5))"
    rows = frame("w", (f"GEOMETRYCOLLECTION({ring})",))
    assert rows.select(wkt.measured_polygons(F.col("w"))[0].area.alias("a")).first().a == 1.0


def test_ring_of_many_points(frame):
    """A long ring is measured and checked whole."""
    n = 40000
    edge = [f"{i} 0 1" for i in range(n)] + [f"{i} 2 1" for i in range(n - 1, -1, -1)] + ["0 0 1"]
    ring = f"POLYGON Z (({', '.join(edge)}))"
    row = frame("w", (f"GEOMETRYCOLLECTION({ring})",)).select(
        wkt.measured_polygons(F.col("w"))[0].alias("p")
    ).select("p.*", wkt.is_well_formed(F.col("p.wkt")).alias("good")).first()
    assert (row.area, row.low, row.good, row.wkt) == (2.0 * (n - 1), 0.0, True, ring)


def test_number_cells_follow_the_rule(frame):
    """Cells read together are what ``number`` and ``is_bad_number`` say of each."""
    texts = [
        "1", " 2 ", "-1.9", "1e2", "", " ", None, "many", "1d", "2F", "0x1p3", "NaN", "Infinity", "-inf", "9223372036854775807",
        "9223372036854775808", "-9223372036854775808", "-9.3e18", "4611686018427387904", "1e400", "0.1", "-0", "12345678901234567890",
    ]
    clean = [t for t in texts if not t or not set(t) & set("dDfFxX")]
    for some in (texts, clean):  # with and without letters that are spoilt
        rows = frame("text", *[(t,) for t in some])
        one = rows.select("seq", text.number(F.col("text")).alias("n"), text.is_bad_number(F.col("text")).alias("bad")).orderBy("seq").collect()
        recorded = F.transform(F.array_sort("a"), lambda x: x["text"])  # null texts are kept inside structs
        cells = rows.agg(F.array_agg(F.struct("seq", "text")).alias("a")).select(text.number_cells(recorded)).first()[0]
        assert len(cells) == len(some)
        for t, r, cell in zip(some, one, cells):
            assert (cell is not None and cell != cell) == bool(r.bad), t
            assert r.bad or cell == r.n, t
