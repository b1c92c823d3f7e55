"""Full rebuild: exports in one folder become tables, layers, reports and issue lists in another.

Each rebuild writes to a folder of its own and becomes the current one when all of it is there, so
nothing of an earlier or unfinished rebuild is read. Steps share their tables as written parquet.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trenchbook import config
from trenchbook.functions import ordered
from trenchbook.operators import chronology, contexts, finds, geo, quality, relations, rollup
from trenchbook.plans.stages import Stages
from trenchbook.sources import exports, publish, records
from trenchbook.sources.schema import TableSchema, load_schema

CONTEXT_TYPES = ["ASU", "Cut", "FillDeposit", "Structure", "Surface"]

# Published table -> the table it is loaded from.
LOADED_FROM = {
    "all_context": "all_context", "asu": "ASU", "cut": "Cut", "fill_deposit": "FillDeposit",
    "flotation": "Flotation", "micromorphology": "Micromorphology", "photo": "photo",
    "pottery": "pottery", "pottery_join": "Pottery_Join", "residue": "Residue",
    "sample_bag": "sample_bag", "special_find": "special_find", "structure": "Structure",
    "surface": "Surface",
}
REPORTED_FROM = {
    "asu": "ASU", "cut": "Cut", "fill_deposit": "FillDeposit", "sample_bag": "SampleBag",
    "special_find": "SpecialFind", "structure": "Structure", "surface": "Surface",
}


# Lists that are read from top to bottom, and what they are sorted by.
SORTED_ISSUES = {"polygons": ["reason", "Source", "Type", "Sub-Type", "Identifier"]}


@dataclass
class Refresh:
    """One rebuild of a site."""

    spark: SparkSession
    exports_folder: str
    schema_folder: str
    folder: str
    summed_columns: list[str] = field(default_factory=lambda: list(config.SUMMED_COLUMNS))

    def __post_init__(self) -> None:
        self.run_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.out = f"{self.folder}/runs/{self.run_id}"
        self.tables = Stages(self.spark, f"{self.out}/tables")
        self.work = Stages(self.spark, f"{self.out}/work")
        self.issues: dict[str, DataFrame] = {}

    def schema(self, name: str) -> TableSchema:
        return load_schema(f"{self.schema_folder}/{name}")

    def run(self) -> None:
        """All steps in order."""
        self.assemble()
        self.flatten()
        self.map_and_publish()
        for name, rows in self.issues.items():
            if name in SORTED_ISSUES:
                publish.write_sorted(rows, f"{self.out}/issues/{name}", *SORTED_ISSUES[name])
            else:
                publish.write_table(rows, f"{self.out}/issues/{name}")
        finished = self.spark.range(1).select(
            F.lit(self.run_id).alias("run_id"), F.current_timestamp().alias("finished")
        )
        finished.write.mode("append").parquet(f"{self.folder}/finished")

    # Assemble: route, strip, unite, check.

    def assemble(self) -> None:
        files = exports.list_files(self.spark, self.exports_folder)
        routed = exports.route_type(files, config.EXPORT_SCHEMAS, "schema").withColumn(
            "type", exports.by_ending(F.regexp_replace("file_name", "tab$", "csv"), config.RECORD_TYPES)
        )
        declared = routed.filter(F.col("schema").isNotNull()).select("schema", "type").distinct().collect()
        lines = self.work.table(
            "lines",
            lambda: exports.route_type(
                records.read_lines(self.spark, self.exports_folder), config.EXPORT_SCHEMAS, "schema"
            ).where("schema is not null"),
            "schema",
        )
        self.types: dict[str, TableSchema] = {}
        headers, looked, checks, counts = [], [], {}, []
        for schema_name, type_name in sorted({(r.schema, r.type) for r in declared}):
            schema = self.schema(schema_name)
            own = lines.where(F.col("schema") == schema_name)
            spanning = self.work.table(f"spanning/{type_name}", lambda own=own: records.spanning_lines(own))
            whole = records.whole_records(own, spanning)
            surveyed = self.work.table(
                f"survey/{type_name}", lambda whole=whole: exports.survey_records(whole)
            )
            headers.append(exports.header_problems(surveyed, schema))
            looked.append(exports.missing_columns(surveyed, schema))
            rows = exports.read_type(whole, surveyed, schema)
            if rows is None:
                continue
            self.types[type_name] = schema
            rows = self.tables.table(f"types/{type_name}", lambda rows=rows: rows)
            found = self.violations(type_name, rows, schema)
            checks[type_name] = exports.record_numbers(found, rows)
            counts.append(quality.violation_counts(rows, found))
        if headers:
            self.issues["headers"] = reduce(DataFrame.unionByName, headers)
            self.issues["file_coverage"] = exports.file_coverage(
                routed, reduce(DataFrame.unionByName, looked), "schema"
            )
            self.issues["file_coverage_counts"] = exports.coverage_counts(
                self.issues["file_coverage"], "schema"
            )
        if checks:
            violations = self.tables.table("violations", lambda: quality.all_violations(checks))
            self.issues["violations"] = violations
            self.issues["pottery_violations"] = violations.filter(F.col("table") == "Pottery")
            per_file = self.work.table(
                "violation_counts", lambda: reduce(DataFrame.unionByName, counts)
            )
            self.issues["violation_counts"] = per_file
            self.issues["file_totals"] = quality.file_totals(per_file)
            types = [self.type_table(t).select(F.lit(t).alias("Type")) for t in self.types]
            self.issues["type_row_counts"] = exports.type_row_counts(
                reduce(DataFrame.unionByName, types)
            )
        if "Pottery" in self.types:
            self.issues["pottery_violations_site"] = quality.pottery_violations(
                self.violations(
                    "Pottery_site", self.type_table("Pottery"), self.types["Pottery"],
                    site_wide=True, carry=quality.POTTERY_CARRY,
                ),
                site_wide=True,
            )
            self.issues["pottery_violations_site"] = exports.record_numbers(
                self.issues["pottery_violations_site"], self.type_table("Pottery")
            )

    def write_list(self, name: str, rows: DataFrame, key: str, order: Column) -> None:
        """A table of ordered lists: each row with its position ``n``, the files sorted by key and position."""
        written = self.work.table(f"sorted/{name}", lambda: ordered.sorted_rows(rows, key, order))
        publish.write_sorted(ordered.with_positions(written, key), f"{self.out}/tables/{name}", key, "n")

    def violations(self, name: str, rows: DataFrame, schema: TableSchema, **how) -> DataFrame:
        """Violations of a table, its repeated values written first, so that they are joined with their size known."""
        repeated = None
        if any(f.unique for f in schema.fields):
            scope = {k: v for k, v in how.items() if k in ("source_file", "site_wide")}
            repeated = self.work.table(
                f"copies/values/{name}",
                lambda: quality.repeated_values(quality.missing_values(rows, schema), schema, **scope),
            )
        return quality.violations(rows, schema, repeated=repeated, **how)

    def type_table(self, name: str) -> DataFrame:
        """Site-wide table of a record type; empty when the site has none."""
        if name in self.types:
            return self.tables.get(f"types/{name}")
        schema_name = {
            config.RECORD_TYPES[end.replace(".tab", ".csv")]: target
            for end, target in config.EXPORT_SCHEMAS.items()
        }[name]
        columns = [T.StructField(n, T.StringType()) for n in self.schema(schema_name).names]
        seq = T.StructType(
            [T.StructField("file", T.StringType()), T.StructField("path", T.StringType()),
             T.StructField("block", T.LongType()), T.StructField("row", T.LongType())]
        )
        columns += [T.StructField("file_name", T.StringType()), T.StructField("seq", seq)]
        return self.spark.createDataFrame([], T.StructType(columns))

    # Flatten: one context table, foreign keys, rollups.

    def flatten(self) -> None:
        tables, wanted = self.tables, self.schema("allcontext.json").names
        master = tables.table(
            "all_context",
            lambda: contexts.master_context(
                contexts.align_contexts([self.type_table(t) for t in CONTEXT_TYPES], wanted)
            ),
        )
        self.issues["asu_no_parent"] = contexts.asu_no_parent(master)
        self.issues["context_counts"] = contexts.context_counts(master)
        found = self.violations(
            "all_context", master, self.schema(config.PUBLISHED_TABLES["all_context"]),
            source_file="Source", site_wide=True,
        )
        self.issues["all_context_violations"] = exports.record_numbers(found, master)
        index = tables.table(
            "key_index",
            lambda: contexts.key_index(
                master, self.type_table("Flotation"), self.type_table("Pottery")
            ),
        )
        children = {"sample_bag": "SampleBag", "special_find": "SpecialFind"}
        keyed = {}
        for name, type_name in children.items():
            rows = self.type_table(type_name)
            keyed[name] = tables.table(
                name, lambda rows=rows: relations.classify_parents(rows, index, master)
            )
            shown = ["Source", "Type", "Identifier", "Title", "Description", "IdentifierUUID"]
            self.issues[f"{name}_no_parent"] = relations.orphans_blank(rows, *shown)
            self.issues[f"{name}_unknown_parent"] = relations.orphans_unresolved(rows, index, *shown)
        pottery = tables.table(
            "pottery",
            lambda: relations.pottery_parents(
                self.type_table("Pottery"), keyed["sample_bag"], master, keyed["special_find"]
            ),
        )
        bag = ["Source", "ContextID", "Identifier", "RelationBelongsTo"]
        self.issues["pottery_no_keys"] = relations.pottery_no_keys(pottery, *bag)
        rolled_asu = tables.table(
            "pottery_by_context_asu",
            lambda: rollup.rollup_context_asu(pottery, master, self.summed_columns),
        )
        rolled = tables.table(
            "pottery_by_context",
            lambda: rollup.rollup_context(pottery, self.summed_columns),
        )
        self.issues["bad_numbers"] = rollup.bad_numbers(pottery, self.summed_columns)
        self.issues["not_rolled_up"] = rollup.not_rolled_up(pottery, *bag)
        self.issues["rollup_reconcile"] = rollup.rollup_reconcile(
            pottery, {"context_asu": rolled_asu, "context": rolled}
        )
        for name, key in (("context_asu", rollup.own_level_key()), ("context", rollup.context_key())):
            self.write_list(f"bag_ids_by_{name}", rollup.concat_ids(pottery, key), "key", F.asc("seq"))
        photo_schema = self.schema(config.PUBLISHED_TABLES["photo"])
        added = [n for n in photo_schema.names if n not in self.schema("photo.json").names]
        original = added[0] if added else "OriginalIdentifierUUID"
        tables.table(
            "photo", lambda: relations.explode_photos(self.type_table("Photo"), original)
        )
        tables.table(
            "bag_links",
            lambda: relations.join_bag_links(
                self.type_table("Pottery_Join"), pottery, "Source", "IdentifierUUID"
            ),
        )

    # Map and publish: polygons, phases, finds, layers, tables, reports.

    def map_and_publish(self) -> None:
        tables = self.tables
        master, pottery = tables.get("all_context"), tables.get("pottery")
        repeated = self.work.table(
            "copies/contexts", lambda: geo.repeated_keys(master, "IdentifierUUID")
        )
        placed = tables.table("geo", lambda: geo.geo_contexts(master, repeated))
        only = contexts.contexts_only(placed)
        self.issues["polygons"] = geo.polygon_issues(
            master, "Source", "Type", "Sub-Type", "Identifier", repeated=repeated
        )
        self.issues["asu_without_context_row"] = geo.asu_without_context_row(placed)
        self.issues["bad_wkt"] = geo.bad_wkt(placed, "CoverageXYZ", "Source", "Identifier")
        self.issues["layer_null_geometry"] = geo.null_geometry_counts(only)
        publish.write_table(geo.polygon_features(placed), f"{self.out}/layers/all_contexts")

        rolled_asu = tables.get("pottery_by_context_asu")
        rolled = tables.get("pottery_by_context")
        phased_asu = tables.table(
            "phases_context_asu", lambda: chronology.phases_context_asu(placed, pottery)
        )
        phased = tables.table(
            "phases_context", lambda: chronology.phases_context(phased_asu)
        )
        notes = chronology.bag_notes(chronology.bag_levels(pottery))
        self.write_list("bag_notes", notes, "target", F.desc("seq"))
        tables.table(
            "counts_context_asu", lambda: chronology.counts_context_asu(phased_asu, rolled_asu)
        )
        counted = tables.table("counts_context", lambda: chronology.counts_context(phased, rolled))
        shown = ["Source", "Identifier", "IdentifierUUID"]
        self.issues["no_counts_context_asu"] = chronology.no_counts(phased_asu, rolled_asu, *shown)
        self.issues["no_counts_context"] = chronology.no_counts(phased, rolled, *shown)
        found = tables.get("special_find")
        tables.table("finds_context_asu", lambda: finds.finds_context_asu(placed, found))
        summed = tables.table("finds_context", lambda: finds.finds_context(only, found))
        layers = {
            "context_phase_pottery": geo.layer_phase_pottery(counted),
            "context_sf_summary": geo.layer_find_summary(summed),
        }
        publish.publish_layers(layers, f"{self.out}/layers")

        counts = []
        for name, schema_name in config.PUBLISHED_TABLES.items():
            source = LOADED_FROM[name]
            rows = tables.get(source) if source == name else self.type_table(source)
            schema = self.schema(schema_name)
            copies = self.work.table(
                f"copies/{name}",
                lambda rows=rows, schema=schema: publish.load_copies(rows, schema),
            )
            loaded = publish.publish_table(rows, schema, copies=copies)
            publish.write_table(loaded, f"{self.out}/database/{name}")
            self.issues[f"rejects_{name}"] = publish.publish_rejects(
                rows, schema, ["Source", "IdentifierUUID"], copies=copies
            )
            counts.append(
                publish.load_counts(rows, schema).select(F.lit(name).alias("table"), "loaded", "failed")
            )
        self.issues["load_counts"] = reduce(DataFrame.unionByName, counts)
        publish.publish_reports(
            {name: self.type_table(source) for name, source in REPORTED_FROM.items()},
            {name: self.schema(s) for name, s in config.REPORTS.items()},
            f"{self.out}/report",
        )


def current(spark: SparkSession, out: str) -> str:
    """Folder of the last rebuild under ``out`` that was finished."""
    last = spark.read.parquet(f"{out}/finished").agg(F.max_by("run_id", "finished")).first()[0]
    return f"{out}/runs/{last}"


def refresh(
    spark: SparkSession, exports_folder: str, schema_folder: str, out: str, **settings
) -> Refresh:
    """Rebuild everything into a new folder under ``out``, which all executors must share; see ``current``."""
    job = Refresh(spark, exports_folder, schema_folder, out, **settings)
    job.run()
    return job
