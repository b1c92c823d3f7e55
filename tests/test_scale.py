"""What must hold whatever the size: plans, hot keys, and order of arrival."""

import os

import pytest
from collections import defaultdict

from pyspark.sql import functions as F

import __spark_entry__ as contract
from trenchbook import config
from trenchbook.functions.joins import left_join_spread
from trenchbook.functions import ordered
from trenchbook.operators import chronology, contexts, geo, quality, relations, rollup
from trenchbook.plans import fixtures, queries
from trenchbook.plans.queries import QUERIES as OWN
from trenchbook.plans.queries import Site, site
from trenchbook.sources import publish
from trenchbook.sources.schema import Field, TableSchema

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: contract.queries()[name] for name in OWN}


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairs_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition, REPARTITION"):
        assert node not in text


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_scans_read_only_what_is_used(spark):
    s = site(spark, SF_DIR)
    text = plan(relations.pottery_no_keys(s.pottery(), "Identifier"))
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in read.split(",")) == ["ASU_UUID", "Context_UUID", "Identifier"]
    assert "IsNull(Context_UUID)" in text.split("PushedFilters")[1]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_wide_tables_are_not_written_for_narrow_steps(spark):
    """Counts of bags and shapes of contexts are made where they are read; only keys and sorted lists are written."""
    s = Site(spark, f"{SF_DIR}/")  # with a folder of its own
    for name in ("period", "rollup_context_asu", "bag_notes", "polygon_features"):
        OWN[name](s)
    written = {c for table in s.stages._tables.values() for c in table.columns}
    assert "IdentifierUUID" in written and not written & {"PotteryCountFine", "CoverageXYZ", "opening"}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_bag_keys_need_no_index_of_bags(spark):
    """Only samples and finds that a bag names are classified, and only by contexts and ASUs."""
    s = Site(spark, f"{SF_DIR}/.")  # with a folder of its own
    keys = {r.IdentifierUUID: (r.Context_UUID, r.ASU_UUID, r.SampleBag_UUID) for r in s.make_pottery().collect()}
    assert "index" not in s.stages._tables
    assert 0 < s.make_named("find").count() < s.raw("find").count() / 2
    whole = relations.bag_candidates(s.make_samples(), s.master(), s.make_finds())
    rows = relations.left_join_spread(s.raw("bag"), relations.pottery_texts(s.raw("bag"), whole), relations.RELATION).collect()
    assert keys == {r.IdentifierUUID: (r.Context_UUID, r.ASU_UUID, r.SampleBag_UUID) for r in rows}


def test_bags_without_a_relation_text_are_not_moved(spark, tmp_path, cells):
    bags = spark.createDataFrame(
        [("B1", "C-1", "1"), ("B2", None, "2"), ("B3", "X", "3"), ("B4", None, "4")],
        "IdentifierUUID string, RelationBelongsToUUID string, seq string",
    )
    texts = str(tmp_path / "texts")
    spark.createDataFrame(
        [("C-1", "C-1", None, "S-1")],
        "RelationBelongsToUUID string, Context_UUID string, ASU_UUID string, SampleBag_UUID string",
    ).write.parquet(texts)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = relations.pottery_parents(bags, None, None, None, texts=spark.read.parquet(texts))
        moved, left = plan(rows).split("Filter isnull(RelationBelongsToUUID")
        assert "join_key" not in moved and moved.count("Filter isnotnull(RelationBelongsToUUID") >= 1
        assert moved.count("Exchange hashpartitioning(RelationBelongsToUUID") == 2 and "Exchange" not in left
        assert cells(rows, "IdentifierUUID", "Context_UUID", "SampleBag_UUID") == [
            ("B1", "C-1", "S-1"), ("B2", None, None), ("B3", None, None), ("B4", None, None),
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_finds_are_moved_once_for_the_bags(spark):
    """Named samples and finds are one written table; the bags' texts are made distinct once."""
    s = Site(spark, f"{SF_DIR}/./")  # with a folder of its own
    s.pottery_texts()
    assert {"bag_texts", "named_rows", "named"} <= set(s.stages._tables)
    texts = s.bag_texts()
    assert texts.count() == texts.distinct().count() > 0
    assert s.make_named("find").filter("RelationBelongsToUUID is null").count() == 0
    assert "lineitem" not in plan(s.make_named("find"))


def test_plain_tables_are_not_moved_for_their_number(spark, tmp_path, monkeypatch):
    """Files that split over the cores are read where they lie by steps that need keys alone, however many rows a task has."""
    spark.range(0, 60000, 1, 4).selectExpr(
        "id as l_orderkey", "id % 7 as l_partkey", "id % 5 as l_suppkey", "cast(id % 7 as int) as l_linenumber",
        "cast(id as double) as l_quantity", "cast(id as double) as l_extendedprice", "0.5D as l_discount",
        "'R' as l_returnflag", "'O' as l_linestatus",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(fixtures, "MOST_ROWS", 5000)
    keys = [
        fixtures.recording(spark, str(tmp_path), "bag", plain=p).select("IdentifierUUID", relations.RELATION) for p in (True, False)
    ]
    assert ["Exchange" in plan(rows) for rows in keys] == [False, True]
    assert keys[0].exceptAll(keys[1]).count() == 0 and keys[0].count() == 60000
    monkeypatch.setattr(fixtures, "MOST_ROWS", 2_000_000)
    one = str(tmp_path / "one")
    spark.read.parquet(f"{tmp_path}/lineitem.parquet").coalesce(1).write.parquet(f"{one}/lineitem.parquet")
    spread = fixtures.recording(spark, one, "bag", plain=True)  # one row group: the cores share it
    assert spread.withColumn("task", F.spark_partition_id()).select("task").distinct().count() == 4


def test_keys_that_nobody_names_are_not_in_the_index(spark, frame, cells):
    """One aggregate tells which keys are named; a key of several kinds, one without kind and a null are as before."""
    master = contexts.master_context(
        frame("Source Type IdentifierUUID RelationBelongsToUUID", ("T", "Cut", "C1", None), ("T", "Cut", "C2", None), ("T", "ASU", "A1", "C1"))
    )
    bags = frame("IdentifierUUID", ("P1",), ("P2",), ("C1",), ("P1",), (None,))
    members = spark.createDataFrame([("C1",), ("P1",), ("P1",), ("X",), (None,)], "parent string")
    whole = contexts.key_index(master, pottery=bags)
    assert cells(contexts.key_index(master, pottery=bags, members=members)) == [("C1", 0), ("P1", 3)]
    assert cells(whole) == [("A1", 1), ("C1", 0), ("C2", 0), ("P1", 3), ("P2", 3)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_finds_need_no_index_of_all_keys(spark, cells):
    s = Site(spark, f"{SF_DIR}/././")  # with a folder of its own
    for name, made in (("sample", s.make_samples()), ("find", s.make_finds())):
        assert "index" not in s.stages._tables
        assert made.columns == (whole := relations.classify_parents(s.raw(name), s.make_index(), s.master())).columns
        assert cells(made) == cells(whole)
    named = s.stages.get("find_index")
    assert 0 < named.count() < s.make_index().count() / 2
    joins = [line for line in plan(s.make_finds()).splitlines() if "REBALANCE" in line]
    assert len(joins) <= 2  # only what is placed, not the index


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["distinct_keys", "no_counts", "no_counts_context", "not_rolled_up", "period"])
def test_key_steps_read_plain_tables(spark, monkeypatch, name):
    """Steps that need neither geometry nor numbers don't deal the test rows to more tasks."""
    read = []

    def noted(spark, sf_dir, name, plain=False):
        read.append((name, plain))
        return fixtures.recording(spark, sf_dir, name, plain)

    monkeypatch.setattr(queries, "recording", noted)
    rows = OWN[name](Site(spark, f"{SF_DIR}//{'./' * len(name)}"))
    assert "context" in {n for n, _ in read} and all(plain for _, plain in read)
    assert "translate(" not in plan(rows)  # nor do they read numbers


def test_a_rollup_joins_each_bag_once(spark):
    """Sums and labels come from one aggregate, and numbers are read over arrays of cells."""
    columns = [f"n{i}" for i in range(20)]
    bags = spark.range(4).selectExpr(
        "'c' as Context_UUID", "cast(null as string) as ASU_UUID", "cast(4 - id as string) as seq",
        "'T' || id as Source", "'I' || id as ContextID", *[f"cast(id + {i} as string) as n{i}" for i in range(20)],
    )
    read = rollup.with_numbers(bags, columns)
    assert read.columns == bags.columns and plan(read).count("translate(") <= 3
    rolled = rollup.rollup_context(read, columns)
    assert "Join" not in plan(rolled)
    row = rolled.collect()[0]
    assert (row.Source, row.ContextID, row.n0, row.n19) == ("T3", "I3", 6, 82)


def test_number_checks_are_written_once(spark):
    """The rule for numbers stands in the plan once, however many number columns there are."""
    fields = [Field(f"n{i}", type="number") for i in range(40)]
    rows = spark.range(1).selectExpr("'f' as file_name", "id as seq", *[f"cast(id as string) as n{i}" for i in range(40)])
    found = quality.violations(rows, TableSchema(tuple(fields)))
    assert plan(found).count("translate(") <= 4


def test_rolled_rows_are_not_moved_to_their_phases(spark, frame, cells, small_partitions):
    """A keyed rollup is moved once, by its aggregate; the joins with ASUs and phases leave its rows where they are."""
    master = frame(
        "IdentifierUUID Type Context_UUID ASU_UUID",
        ("C1", "Cut", "C1", None), ("A1", "ASU", "C1", "A1"), ("A2", "ASU", None, "A2"), ("C2", "Cut", "C2", None),
        ("B", "Cut", "B", None), ("B", "ASU", "C1", "B"), (None, "Cut", None, None),
    )
    pottery = frame(
        "Source ContextID Context_UUID ASU_UUID n",
        ("T1", "1", "C1", None, "1"), ("T1", "1", "C1", "A1", "2"), ("T2", "2", None, "A2", "4"), ("T3", None, "B", None, "8"),
        ("T3", "3", "C1", "B", "16"), ("T4", "4", None, None, "32"), ("T5", "5", "C9", None, "64"),
    )
    phased = master.select("IdentifierUUID", "Type", F.lit("A").alias("Period"))
    found = {}
    for keyed in (False, True):
        rolled = rollup.rollup_context_asu(pottery, master, ["n"], keyed)
        assert rolled.columns[:5] == ["Source", "ContextID", "n", "Context_UUID", "ASU_UUID"] and len(rolled.columns) == 5 + 2 * keyed
        found[keyed] = chronology.counts_context_asu(phased, rolled)
    wide = [x for x in plan(found[True]).split("Exchange hashpartitioning(")[1:] if x.startswith("level_uuid")]
    assert len(wide) == 2  # of the sums and of the ASUs
    assert "hashpartitioning(IdentifierUUID" in plan(found[True])
    assert found[True].columns == found[False].columns
    assert cells(found[True]) == cells(found[False])
    assert cells(found[True], "IdentifierUUID", "Type", "n", "Pottery_Context_UUID", "Pottery_ASU_UUID") == [
        ("A1", "ASU", 2, "C1", "A1"), ("A2", "ASU", 4, None, "A2"), ("B", "ASU", 16, "C1", "B"), ("B", "Cut", 8, "B", None),
        ("C1", "Cut", 1, "C1", None),
    ]


def test_published_numbers_are_read_once(spark, frame, cells):
    """Numbers stand in the plan once for the check and the typed value, and only in rows of repeated keys for the copies."""
    fields = [Field(f"n{i}", type="number") for i in range(40)]
    schema = TableSchema((Field("IdentifierUUID"), *fields))
    rows = frame(
        " ".join(schema.names),
        *[(key, "0.5", *[n] * 39) for key, n in (("A", "1"), ("A", "2"), ("B", "x"), ("B", "3"), ("C", ""), ("C", None), (None, "1"))],
    )
    seen = publish.seen_keys(rows)
    assert "translate(" not in plan(seen) and cells(seen) == [("A",), ("B",), ("C",)]
    copies = publish.load_copies(rows, schema, seen=seen)
    assert cells(copies, "repeated_key") == cells(publish.load_copies(rows, schema), "repeated_key") == [("A",), ("C",)]
    loaded = publish.publish_table(rows, schema, copies=copies)
    assert plan(loaded).count("translate(") <= 2 * plan(copies).count("translate(") <= 4
    assert loaded.schema["n3"].metadata["type"] == "number" and dict(loaded.dtypes)["n3"] == "double"
    assert cells(loaded, "IdentifierUUID", "n0", "n39") == [("A", 0.5, 1.0), ("B", 0.5, 3.0), ("C", 0.5, None)]
    bare = TableSchema((Field("IdentifierUUID"),))  # without a number
    assert cells(publish.publish_table(rows, bare)) == [("A",), ("B",), ("C",)]


def test_numbers_read_before_are_summed_as_texts_are(frame, cells):
    bags = frame("Source PotteryCountFine", ("a", "3"), ("a", "-1.9"), ("a", "1d"), ("b", ""), ("b", None), (None, "7"))
    read = rollup.with_numbers(bags, ["PotteryCountFine"])
    sums = [cells(rollup.int_sums(rows, F.col("Source"), ["PotteryCountFine"])) for rows in (bags, read)]
    assert sums[0] == sums[1] == [("a", 2), ("b", 0)]


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which a few thousand rows count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def final_plan(rows) -> str:
    """The plan as it ran, with runtime sizes."""
    query = rows._jdf.queryExecution()
    query.executedPlan().executeCollect()
    return query.executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("copies", [0, 5])
def test_written_keys_spare_the_wide_rows_a_shuffle(spark, tmp_path, copies):
    """Rows far over the broadcast limit stay where they are when few keys or values repeat."""
    wide = str(tmp_path / "wide")
    spark.range(20000).selectExpr(
        f"concat('K', if(id < {copies}, id + 1000, id)) as IdentifierUUID", "uuid() as other", "'T' as file_name",
        "lpad(cast(id as string), 9, '0') as seq",
    ).write.parquet(wide)
    rows = spark.read.parquet(wide)
    schema = TableSchema((Field("IdentifierUUID", unique=True), Field("other")))
    written = {}
    for name, found in (
        ("keys", geo.repeated_keys(rows, "IdentifierUUID")), ("values", quality.repeated_values(rows, schema)),
    ):
        found.write.parquet(str(tmp_path / name))
        written[name] = spark.read.parquet(str(tmp_path / name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64KB")
    try:
        for rows_left, n in (
            (geo.dedupe_first(rows, "IdentifierUUID", written["keys"]), 20000 - copies),
            (geo.repeated_rows(rows, "IdentifierUUID", written["keys"]), copies),
            (quality.check_unique(rows, schema, repeated=written["values"]), 2 * copies),
        ):
            text = final_plan(rows_left)
            assert "Exchange hashpartitioning" not in text and "ShuffleQueryStage" not in text
            assert rows_left.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_survey_shuffles_no_text(spark, tmp_path):
    from trenchbook.sources import exports

    for i in range(3):
        (tmp_path / f"Trench {i} Cuts.tab").write_text("Source\tIdentifier\n" + "?\tone\n" * 1000)
    surveyed = exports.survey_files(spark, [str(f) for f in sorted(tmp_path.iterdir())])
    query = surveyed._jdf.queryExecution()
    assert len(query.executedPlan().executeCollect()) == 3
    text = query.executedPlan().toString().split("Initial Plan")[0]
    # one scan, combined before the only shuffle
    assert text.count("FileScan text") == 1 and text.count("Exchange hashpartitioning(path") == 1
    below = text.split("Exchange hashpartitioning(path")[1]
    assert "partial_min_by" in below or "partial_minby" in below.lower()


def hot_site(spark, n=30000):
    """One context that a third of all bags name, another third without a parent."""
    keys = spark.range(3000)
    master = contexts.master_context(
        keys.selectExpr(
            "'T' as Source", "'Cut' as Type", "cast(id as string) as Identifier",
            "concat('C', id) as IdentifierUUID", "cast(null as string) as RelationBelongsToUUID",
            "concat('C', id) as seq",
        )
    )
    none = master.limit(0)
    bags = spark.range(0, n, 1, 8).selectExpr(
        "'T' as Source", "cast(id as string) as ContextID", "cast(id as string) as Identifier",
        "concat('P', id) as IdentifierUUID",
        "case id % 3 when 0 then 'C7' when 1 then concat('C', id % 3000) end as RelationBelongsToUUID",
        "'1' as n", "lpad(cast(id as string), 9, '0') as seq",
    )
    return master, relations.pottery_parents(bags, none, master, none)


def test_hot_parent_is_split(spark, small_partitions):
    _, pottery = hot_site(spark)
    query = pottery._jdf.queryExecution()
    rows = query.executedPlan().executeCollect()
    assert len(rows) == 30000
    assert "skewed" in query.executedPlan().toString()


def test_hot_parent_rolls_up_whole(spark):
    _, pottery = hot_site(spark)
    rolled = rollup.rollup_context(pottery, ["n"])
    hot = rolled.filter("Context_UUID = 'C7'").first()
    assert hot["n"] == 10000 + 10 * (7 % 3 == 1)
    ids = rollup.concat_ids(pottery, rollup.context_key()).filter("key = 'C7'")
    whole = [int(r.Identifier) for r in ids.orderBy("seq").collect()]
    assert whole == sorted(whole) and len(whole) == hot["n"]


def test_lists_do_not_depend_on_partitions(spark, cells):
    _, pottery = hot_site(spark)
    levels = chronology.bag_levels(pottery.withColumns({c: F.col("Identifier") for c in config.NOTE_COLUMNS}))
    expected = None
    for partitions in ("1", "7", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = cells(rollup.concat_ids(pottery, rollup.context_key())), cells(chronology.bag_notes(levels))
        expected = expected or got
        assert got == expected
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_positions_of_a_hot_key(spark, tmp_path):
    """The same positions from any number of ranges, without gaps, with a third of all rows on one key."""
    rows = spark.range(0, 3000, 1, 5).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('k', id % 70) end as key",
        "struct(cast(3000 - id as string) as file, id as row) as seq", "id as Identifier",
    )
    expected = defaultdict(list)
    for r in sorted(rows.collect(), key=lambda r: tuple(r.seq), reverse=True):
        expected[r.key].append(r.Identifier)
    del expected[None]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for partitions in ("1", "7", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        path = f"{tmp_path}/{partitions}"
        ordered.sorted_rows(rows.where("key is not null"), "key", F.desc("seq")).write.parquet(path)
        written = spark.read.parquet(path)
        got = defaultdict(dict)
        for r in ordered.with_positions(written, "key").collect():
            got[r.key][r.n] = r.Identifier
        assert {k: [own[n] for n in range(len(own))] for k, own in got.items()} == expected
        ranges = written.where("key = 'hot'").select("part").distinct().count()
        assert ranges == 1 if partitions == "1" else ranges > 1
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rows_without_key_are_spread(spark):
    rows = spark.range(0, 20000, 1, 4).selectExpr("cast(null as string) as key", "cast(id as string) as seq")
    table = spark.range(10).selectExpr("cast(id as string) as key", "id as value")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left_join_spread(rows, table, "key").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("task").count().collect()]
        assert sum(sizes) == 20000 and len(sizes) == 4 and max(sizes) < 10000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_same_result_whatever_the_partitions_and_arrival(spark, cells):
    s = site(spark, SF_DIR)
    results = []
    for partitions, seed in (("1", 1), ("37", 2)):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        bags, again = (t.orderBy(F.rand(seed)) for t in (s.pottery(), s.again()))
        results.append(
            (
                cells(chronology.phases_context_asu(s.geo(), bags).drop("seq")),
                cells(rollup.rollup_context_asu(bags, s.master(), ["PotteryCountFine"])),
                cells(contexts.asu_contexts(again)),
            )
        )
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]
