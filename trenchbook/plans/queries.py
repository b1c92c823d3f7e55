"""Every operator as a query over the recording tables derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.functions import ordered
from trenchbook.functions.text import is_asu
from trenchbook.operators import chronology, contexts, finds, geo, quality, relations, rollup
from trenchbook.plans.fixtures import COUNTS, recording
from trenchbook.plans.stages import Stages, shared_folder
from trenchbook.sources import exports, publish
from trenchbook.sources.schema import Field, TableSchema

CONTEXT_SCHEMA = TableSchema(
    (
        Field("Source", title="Trench"),
        Field("Type", required=True),
        Field("Sub-Type", title="SubType", enum=("drain", "stairs")),
        Field("Identifier", title="ContextID", required=True, unique=True),
        Field("Title", required=True),
        Field("Description", title="ExcavationNote"),
        Field("DateEarliest", type="datetime"),
        Field("IdentifierUUID", required=True, unique=True),
        Field("RelationBelongsToUUID"),
        Field("CoverageXYZ"),
    ),
    missing_values=("", "5-LOW"),
)
SAMPLE_SCHEMA = TableSchema(
    (
        Field("Source"),
        Field("Type", required=True),
        Field("Identifier", title="SampleNumber", required=True, unique=True),
        Field("Title", title="SampleType", required=True, enum=tuple(config.SAMPLE_TITLES)),
        Field("IdentifierUUID", required=True, unique=True),
        Field("RelationBelongsToUUID"),
    )
)
BAG_SCHEMA = TableSchema(
    (
        Field("Source"),
        Field("ContextID", required=True),
        Field("Identifier", required=True),
        *[Field(c, type="number") for c in COUNTS],
        Field("IdentifierUUID", required=True, unique=True),
    )
)
REPORT_SCHEMA = TableSchema(
    (
        Field("Source", title="Trench"),
        Field("Identifier", title="ContextID"),
        Field("Sub-Type", title="SubType"),
        Field("Description", title="ExcavationNote"),
        Field("IdentifierUUID"),
    )
)

MASTER_KEYS = ["IdentifierUUID", "Type", "Context_UUID", "ASU_UUID", "seq"]

_sites: dict[tuple[str, str], "Site"] = {}


class Site:
    """Recording tables of one data folder and the tables the reference chain builds from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}
        folder = f"{shared_folder(spark)}/{md5(sf_dir.encode()).hexdigest()[:12]}"
        self.stages = Stages(spark, folder)

    def in_order(self, name: str, make: Callable[[], DataFrame], key: str, order: Column) -> DataFrame:
        """Rows with their position within the key; the sorted rows are a stage table."""
        written = self.stages.table(f"sorted_{name}", lambda: ordered.sorted_rows(make(), key, order))
        return ordered.with_positions(written, key)

    def raw(self, name: str) -> DataFrame:
        """A recording table. It isn't written: each step makes the columns it reads, where the test rows lie."""
        if name not in self._raw:
            self._raw[name] = recording(self.spark, self.sf_dir, name)
        return self._raw[name]

    def plain(self, name: str) -> DataFrame:
        """A recording table for steps that read keys and short texts; its rows aren't moved for their number."""
        if f"plain {name}" not in self._raw:
            self._raw[f"plain {name}"] = recording(self.spark, self.sf_dir, name, plain=True)
        return self._raw[f"plain {name}"]

    def written_bags(self) -> DataFrame:
        """The bags as a written table, for filters on many numbers: over a projection each would make its texts again."""
        return self.stages.table("bag", lambda: self.raw("bag"))

    def make_master(self, plain: bool = False) -> DataFrame:
        return contexts.master_context(self.plain("context") if plain else self.raw("context"))

    def master(self) -> DataFrame:
        """Keys of contexts and ASUs, without what the lookups don't read."""
        return self.stages.table("master", lambda: self.make_master(plain=True).select(*MASTER_KEYS))

    def make_index(self) -> DataFrame:
        return contexts.key_index(self.master(), self.plain("flotation"), self.plain("bag"))

    def index(self) -> DataFrame:
        return self.stages.table("index", self.make_index)

    def texts(self, name: str) -> DataFrame:
        """Distinct relation texts of samples, finds or bags."""
        return self.stages.table(f"{name}_texts", lambda: relations.distinct_texts(self.plain(name)))

    def classified(self, name: str) -> DataFrame:
        """Samples or finds with the keys they name; the index has only keys that one of them names."""
        texts = self.texts(name)
        index = self.stages.table(
            f"{name}_index",
            lambda: contexts.key_index(
                self.master(), self.plain("flotation"), self.plain("bag"), relations.members_of(texts)
            ),
        )
        return relations.classify_parents(self.plain(name), index, self.master(), texts)

    def make_samples(self) -> DataFrame:
        return self.classified("sample")

    def samples(self) -> DataFrame:
        return self.stages.table("samples", self.make_samples)

    def make_finds(self) -> DataFrame:
        return self.classified("find")

    def finds(self) -> DataFrame:
        return self.stages.table("finds", self.make_finds)

    def placed(self, rows: DataFrame) -> DataFrame:
        """Samples or finds for steps that read their context and ASU alone. Whether a key is a context or an ASU
        doesn't depend on other kinds, so the index has these two alone."""
        return relations.classify_parents(rows, contexts.key_index(self.master()), self.master())

    def bag_texts(self) -> DataFrame:
        """Distinct relation texts of the bags."""
        return self.texts("bag")

    def named(self) -> DataFrame:
        """Samples and finds that a bag names, with context and ASU; both are moved and placed together, and once."""
        columns = ["IdentifierUUID", relations.RELATION, "seq"]

        def rows() -> DataFrame:
            both = [self.plain(n).select(*columns).withColumn("table", F.lit(n)) for n in ("sample", "find")]
            return relations.named_rows(both[0].unionByName(both[1]), relations.members_of(self.bag_texts()))

        found = self.stages.table("named_rows", rows)
        return self.stages.table("named", lambda: self.placed(found))

    def make_named(self, name: str) -> DataFrame:
        """Samples or finds that a bag names, with context and ASU."""
        return self.named().filter(F.col("table") == name)

    def pottery_texts(self) -> DataFrame:
        """Keys of each relation text of a bag."""
        return self.stages.table(
            "pottery_texts",
            lambda: relations.pottery_texts(
                None,
                relations.bag_candidates(self.make_named("sample"), self.master(), self.make_named("find")),
                relations.members_of(self.bag_texts()),
            ),
        )

    def make_pottery(self, numbers: bool = False) -> DataFrame:
        """Bags with their keys, not written: a step moves the columns it reads. ``numbers`` has counts as whole numbers."""
        bags = rollup.with_numbers(self.raw("bag"), COUNTS) if numbers else self.plain("bag")
        return relations.pottery_parents(bags, None, None, None, texts=self.pottery_texts())

    def pottery(self) -> DataFrame:
        """All columns of the bags with their keys, written; for those who read them several times."""
        return self.stages.table("pottery", self.make_pottery)

    def again(self) -> DataFrame:
        """Master table in which some contexts are recorded twice and some have no key."""
        return self.stages.table(
            "again", lambda: contexts.master_context(self.raw("context_again"))
        )

    def again_keys(self) -> DataFrame:
        """Its keys on several rows."""
        return self.stages.table(
            "again_keys", lambda: geo.repeated_keys(self.again(), "IdentifierUUID")
        )

    def bag_keys(self) -> DataFrame:
        """Keys of several bags that would load."""
        seen = self.stages.table("bag_keys_seen", lambda: publish.seen_keys(self.plain("bag")))
        return self.stages.table(
            "bag_keys", lambda: publish.load_copies(self.raw("bag"), BAG_SCHEMA, seen=seen)
        )

    def repeated_values(self, name: str, schema: TableSchema, site_wide: bool = False) -> DataFrame:
        """Values that rows of a recording table share in a unique column."""
        return self.stages.table(
            f"{name}_values_site" if site_wide else f"{name}_values",
            lambda: quality.repeated_values(
                quality.missing_values(self.raw(name), schema), schema, "Source", site_wide
            ),
        )

    def make_geo(self, plain: bool = False) -> DataFrame:
        """The geo table; ``plain`` is for steps that read neither geometry nor other long columns of it."""
        repeated = self.stages.table(
            "master_keys", lambda: geo.repeated_keys(self.master(), "IdentifierUUID")
        )
        return geo.geo_contexts(self.make_master(plain), repeated)

    def geo(self) -> DataFrame:
        return self.stages.table("geo", self.make_geo)

    def make_rolled_asu(self, plain: bool = False, keyed: bool = False) -> DataFrame:
        """Bags rolled up; ``plain`` is for steps that read the keys of the rollup's rows alone."""
        return rollup.rollup_context_asu(self.make_pottery(numbers=not plain), self.master(), COUNTS, keyed)

    def rolled_asu(self) -> DataFrame:
        return self.stages.table("rolled_asu", self.make_rolled_asu)

    def make_rolled(self, plain: bool = False) -> DataFrame:
        return rollup.rollup_context(self.make_pottery(numbers=not plain), COUNTS)

    def rolled(self) -> DataFrame:
        return self.stages.table("rolled", self.make_rolled)

    def make_phased_asu(self) -> DataFrame:
        return chronology.phases_context_asu(self.make_geo(), self.make_pottery())

    def phased_asu(self) -> DataFrame:
        return self.stages.table("phased_asu", self.make_phased_asu)

    def make_phased(self) -> DataFrame:
        return chronology.phases_context(self.make_phased_asu())

    def phased(self) -> DataFrame:
        return self.stages.table("phased", self.make_phased)

    def violations(self) -> dict[str, DataFrame]:
        tables = {"pottery": ("bag", BAG_SCHEMA), "sample_bag": ("sample", SAMPLE_SCHEMA)}
        return {
            name: quality.violations(
                self.raw(raw), schema, "Source", repeated=self.repeated_values(raw, schema)
            )
            for name, (raw, schema) in tables.items()
        }


def site(spark: SparkSession, sf_dir: str) -> Site:
    """The site of a data folder; one per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _sites:
        _sites[key] = Site(spark, sf_dir)
    return _sites[key]


def _shape(s: Site) -> DataFrame:
    """Context types as they come: each lacks columns that others have."""
    table = s.raw("context")
    lacking = {
        "FillDeposit": ["RelationBelongsToUUID"],
        "Cut": ["Sub-Type"],
        "Structure": ["DateEarliest", "RelationBelongsToUUID"],
        "Surface": ["Sub-Type", "DateEarliest", "RelationBelongsToUUID"],
    }
    parts = [table.filter(F.col("Type") == t).drop(*gone) for t, gone in lacking.items()]
    parts.append(table.filter(is_asu()).drop("Sub-Type"))
    columns = [
        "Source", "Type", "Sub-Type", "Identifier", "Title", "DateEarliest", "Description",
        "CoveragePosition", "CoverageXYZ", "IdentifierUUID", "RelationBelongsToUUID",
    ]
    return contexts.align_contexts(parts, columns).drop("seq")


def _by_code(code: str, table: str, schema: TableSchema) -> Callable[[Site], DataFrame]:
    def check(s: Site) -> DataFrame:
        return quality.check_values(s.raw(table), schema, "Source", recorded=True).filter(F.col("code") == code).select(
            "source_file", "row", "column", "code", "value"
        )

    return check


def _missing(s: Site) -> DataFrame:
    return quality.missing_values(s.raw("context"), CONTEXT_SCHEMA).select(
        "IdentifierUUID", "Description"
    )


FOUND = ["source_file", "row", "column", "code", "value"]
SHOWN = ["Source", "Identifier", "IdentifierUUID"]

QUERIES: dict[str, Callable[[Site], DataFrame]] = {
    # Routing
    "route_type": lambda s: exports.route_type(
        exports.route_type(
            exports.route_type(s.raw("file"), config.EXPORT_SCHEMAS, "export_schema"),
            config.STRIPPED_SCHEMAS, "stripped_schema",
        ),
        config.RECORD_TYPES, "record_type",
    ).select("file_name", "export_schema", "stripped_schema", "record_type"),
    "source_from_file": lambda s: exports.source_from_file(s.raw("file")),
    # Projections and predicates
    "align_contexts": _shape,
    "report_rename": lambda s: publish.report_rename(s.raw("context"), REPORT_SCHEMA),
    "split_position": lambda s: geo.split_position(s.raw("context")).select(
        "IdentifierUUID", "CoveragePosition", "X", "Y"
    ),
    "is_asu": lambda s: s.raw("context").select("IdentifierUUID", is_asu().alias("is_asu")),
    "drop_null_geometry": lambda s: geo.null_geometry_counts(s.make_geo()),
    "contexts_only": lambda s: contexts.contexts_only(
        geo.geo_contexts(s.again(), s.again_keys())
    ).select("Source", "IdentifierUUID", "Title", "opening", "closing"),
    # Validation
    "check_required": _by_code(quality.REQUIRED, "sample", SAMPLE_SCHEMA),
    "check_enum": _by_code(quality.ENUM, "sample", SAMPLE_SCHEMA),
    "check_type": _by_code(quality.TYPE, "bag", BAG_SCHEMA),
    "check_type_datetime": _by_code(quality.TYPE, "context", CONTEXT_SCHEMA),
    "check_unique": lambda s: quality.check_unique(
        s.raw("sample"), SAMPLE_SCHEMA, "Source", repeated=s.repeated_values("sample", SAMPLE_SCHEMA)
    ).select(*FOUND),
    "check_unique_site": lambda s: quality.check_unique(
        s.raw("context_again"), CONTEXT_SCHEMA, "Source", site_wide=True,
        repeated=s.repeated_values("context_again", CONTEXT_SCHEMA, site_wide=True),
    ).select(*FOUND),
    "missing_values": _missing,
    "violation_report": lambda s: quality.violation_report(s.violations()["sample_bag"]),
    "violation_counts": lambda s: quality.violation_counts(
        s.raw("sample"), s.violations()["sample_bag"], "Source"
    ),
    "file_totals": lambda s: quality.file_totals(
        quality.violation_counts(s.raw("sample"), s.violations()["sample_bag"], "Source")
    ),
    "pottery_violations": lambda s: quality.pottery_violations(
        quality.violations(
            s.raw("bag"), BAG_SCHEMA, "Source", site_wide=True, carry=quality.POTTERY_CARRY,
            repeated=s.repeated_values("bag", BAG_SCHEMA, site_wide=True),
        ),
        site_wide=True,
    ),
    "pottery_violations_file": lambda s: quality.pottery_violations(s.violations()["pottery"]),
    "pottery_violations_all": lambda s: quality.all_violations(s.violations())
    .filter(F.col("table") == "pottery")
    .select("table", *FOUND),
    # Set operations
    "concat_type": lambda s: exports.concat_type(
        [
            s.raw("sample").select(
                F.concat("Source", F.lit(" Sample Bags.tab")).alias("file_name"),
                "Source", "Identifier", "IdentifierUUID",
            ),
            s.raw("find").select(
                "IdentifierUUID", "Identifier",
                F.concat(F.lit("Stripped_"), "Source", F.lit(" Finds.csv")).alias("file_name"),
                F.lit("?").alias("Source"),
            ),
        ]
    ),
    "type_row_counts": lambda s: exports.type_row_counts(s.raw("context")),
    "master_context": lambda s: s.make_master().drop("seq"),
    "distinct_keys": lambda s: rollup.distinct_keys(s.make_pottery()),
    # Relations
    "explode_relation": lambda s: relations.explode_relation(
        s.raw("photo"), "RelationBelongsToUUID", "IdentifierUUID"
    ),
    "guid_index": lambda s: s.make_index(),
    "asu_parent": lambda s: s.make_master()
    .filter(is_asu())
    .select("IdentifierUUID", "Context_UUID", "ASU_UUID"),
    "classify_parents": lambda s: s.make_samples().drop("seq"),
    "asu_fallback_context": lambda s: s.make_finds().select(
        "IdentifierUUID", "Context_UUID", "ASU_UUID", "FlotationBag_UUID", "PotteryBag_UUID"
    ),
    "pottery_parents": lambda s: s.make_pottery().select(
        "IdentifierUUID", "Context_UUID", "ASU_UUID", "SampleBag_UUID"
    ),
    "orphans_blank": lambda s: relations.orphans_blank(
        s.raw("sample"), "Source", "Type", "Identifier", "Title", "IdentifierUUID"
    ),
    "orphans_unresolved": lambda s: relations.orphans_unresolved(
        s.raw("sample"), s.index(), "Source", "IdentifierUUID"
    ),
    "asu_no_parent": lambda s: contexts.asu_no_parent(s.make_master()),
    "pottery_no_fk": lambda s: relations.pottery_no_keys(
        s.make_pottery(), "Source", "ContextID", "Identifier"
    ),
    "pottery_key_check": lambda s: relations.pottery_no_keys(
        s.make_pottery(), "Source", "ContextID", "Identifier", "RelationBelongsToUUID"
    ),
    "explode_photos": lambda s: relations.explode_photos(s.raw("photo")).drop("seq"),
    "join_bag_links": lambda s: relations.join_bag_links(
        s.raw("join"), s.make_pottery(), "IdentifierUUID"
    ),
    # Rollups
    "rollup_context_asu": Site.make_rolled_asu,
    "rollup_context": Site.make_rolled,
    "int_sum": lambda s: rollup.int_sums(s.raw("bag"), F.col("Source"), COUNTS),
    "concat_ids": lambda s: s.in_order(
        "bag_ids", lambda: rollup.concat_ids(s.make_pottery(), rollup.context_key()), "key", F.asc("seq")
    ),
    "first_labels": lambda s: rollup.first_labels(s.make_pottery(), rollup.context_key()),
    "bad_numbers": lambda s: rollup.bad_numbers(s.written_bags(), COUNTS),
    "rollup_reconcile": lambda s: rollup.rollup_reconcile(
        s.make_pottery(), {"context_asu": s.make_rolled_asu(), "context": s.make_rolled()}
    ),
    "not_rolled_up": lambda s: rollup.not_rolled_up(s.make_pottery(), "Source", "ContextID", "Identifier"),
    "context_counts": lambda s: contexts.context_counts(s.master()),
    # Chronology
    "phase_map": lambda s: chronology.phase_map(s.raw("bag"), "IdentifierUUID"),
    "phase_flags": lambda s: chronology.phase_flags(chronology.bag_levels(s.make_pottery())).drop("Period"),
    "period": lambda s: chronology.phase_flags(chronology.context_level(s.make_pottery())).select(
        "target", "Period"
    ),
    "bag_notes": lambda s: s.in_order(
        "bag_notes", lambda: chronology.bag_notes(chronology.bag_levels(s.make_pottery())), "target", F.desc("seq")
    ),
    "phases_context_asu": lambda s: s.make_phased_asu().drop("seq"),
    "phases_context": lambda s: s.make_phased().drop("seq"),
    "counts_context_asu": lambda s: chronology.counts_context_asu(
        s.make_phased_asu(), s.make_rolled_asu(keyed=True)
    ).select("IdentifierUUID", "Type", "Period", "ContextID", *COUNTS,
             "Pottery_Source", "Pottery_Context_UUID", "Pottery_ASU_UUID"),
    "counts_context": lambda s: chronology.counts_context(
        s.make_phased(), s.make_rolled()
    ).select("IdentifierUUID", "Type", "Period", "ContextID", *COUNTS,
             "Pottery_Source", "Pottery_Context_UUID"),
    "no_counts": lambda s: chronology.no_counts(
        s.make_geo(plain=True), s.make_rolled_asu(plain=True), "Source", "Identifier", "IdentifierUUID"
    ),
    "no_counts_context": lambda s: chronology.no_counts(
        contexts.contexts_only(s.make_geo(plain=True)), s.make_rolled(plain=True), "Source", "Identifier", "IdentifierUUID"
    ),
    # Finds
    "find_class": lambda s: finds.find_classes(s.raw("find"), "IdentifierUUID", "Title"),
    "finds_context_asu": lambda s: finds.finds_context_asu(s.make_geo(), s.placed(s.raw("find"))).select(
        "IdentifierUUID", "Type", *[f"`{c}`" for c in finds.CLASSES]
    ),
    "finds_context": lambda s: finds.finds_context(
        contexts.contexts_only(s.make_geo()), s.placed(s.raw("find"))
    ).select("IdentifierUUID", "Type", *[f"`{c}`" for c in finds.CLASSES]),
    # Geometry
    "split_collection": lambda s: geo.split_collection(s.raw("context"), "IdentifierUUID").select(
        "IdentifierUUID", "pos", "wkt"
    ),
    "polygon_area": lambda s: geo.split_collection(s.raw("context"), "IdentifierUUID").select(
        "IdentifierUUID", "pos", "area"
    ),
    "min_coordinate": lambda s: geo.split_collection(s.raw("context"), "IdentifierUUID").select(
        "IdentifierUUID", "pos", "low"
    ),
    "top2_polygons": lambda s: geo.top_polygons(s.raw("context"), "IdentifierUUID"),
    "open_close": lambda s: geo.open_close(s.raw("context")).select(
        "IdentifierUUID", "opening", "closing"
    ),
    "geo_contexts": lambda s: geo.geo_contexts(s.again(), s.again_keys()).drop("seq"),
    "polygon_issues": lambda s: geo.polygon_issues(
        s.again(), "Source", "Type", "Sub-Type", "Identifier", repeated=s.again_keys()
    ),
    "asu_without_context_row": lambda s: geo.asu_without_context_row(s.geo()),
    "polygon_features": lambda s: geo.polygon_features(s.make_geo()),
    "layer_phase_pottery": lambda s: geo.layer_phase_pottery(
        chronology.counts_context(s.make_phased(), s.make_rolled()),
        [*config.LAYER_COLUMNS, *chronology.SLOTS, "Period", "ContextID", *COUNTS, "Context_UUID"],
    ),
    "layer_sf_summary": lambda s: geo.layer_find_summary(
        finds.finds_context(contexts.contexts_only(s.make_geo()), s.placed(s.raw("find")))
    ),
    "bad_wkt": lambda s: geo.bad_wkt(s.make_geo(), "CoverageXYZ", "IdentifierUUID"),
    # Order
    "dedupe_first": lambda s: geo.dedupe_first(
        s.raw("context_again"), "IdentifierUUID", s.again_keys()
    ).select(*SHOWN, "Description"),
    "repeated_rows": lambda s: geo.repeated_rows(
        s.raw("context_again"), "IdentifierUUID", s.again_keys()
    ).select(*SHOWN, "Description"),
    "first_match": lambda s: relations.bag_candidates(
        s.make_samples(), s.master(), s.make_finds()
    ).select("parent", "keys.*"),
    "sorted_issues": lambda s: geo.polygon_issues(
        s.again(), "Source", "Type", "Sub-Type", "Identifier", repeated=s.again_keys()
    ).orderBy("reason", "Source", "Type", "Sub-Type", "Identifier"),
    # Publication
    "publish_table": lambda s: publish.publish_table(
        s.again(), CONTEXT_SCHEMA, copies=s.again_keys()
    ),
    "publish_numbers": lambda s: publish.publish_table(
        s.raw("bag"), BAG_SCHEMA, copies=s.bag_keys()
    ),
    "publish_rejects": lambda s: publish.publish_rejects(
        s.again(), CONTEXT_SCHEMA, SHOWN, copies=s.again_keys()
    ),
    "publish_number_rejects": lambda s: publish.publish_rejects(
        s.written_bags(), BAG_SCHEMA, SHOWN, copies=s.bag_keys()
    ),
    "publish_counts": lambda s: publish.load_counts(s.again(), CONTEXT_SCHEMA),
    "publish_number_counts": lambda s: publish.load_counts(s.written_bags(), BAG_SCHEMA),
}
