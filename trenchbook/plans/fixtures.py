"""Recording tables derived from the star-schema test tables.

The same SELECT text runs in Spark and in DuckDB. Keys are unique unless a
comment says otherwise; orphans, blanks, bad numbers, several parents and odd
geometry are built in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trenchbook import config

CONTEXT = """
select 'T' || cast(o_custkey % 20 as string) as Source,
       case o_orderkey % 4 when 0 then 'FillDeposit' when 1 then 'Cut'
            when 2 then 'Structure' else 'Surface' end as Type,
       case when o_orderkey % 4 = 2 then case o_custkey % 3 when 0 then 'drain' when 1 then 'stairs'
            else 'Drain' end end as SubType,
       cast(o_orderkey as string) as Identifier,
       'context ' || cast(o_orderkey as string) as Title,
       o_orderpriority as Description,
       case o_custkey % 5 when 0 then 'yesterday' when 1 then null
            when 2 then case o_orderkey % 3 when 0 then '2018' when 1 then '2018-08' else '12:00' end
            else '2018-07-' || cast(10 + o_orderkey % 20 as string) || 'T08:00:00' end as DateEarliest,
       'C-' || cast(o_orderkey as string) as IdentifierUUID,
       cast(null as string) as RelationBelongsToUUID,
       case when o_orderkey % 13 = 0 then '4010'
            else cast(4000 + o_custkey % 100 as string) || ',' || cast(4000 + o_orderkey % 100 as string)
            end as CoveragePosition,
       case when o_orderkey % 11 = 0 then null
            when o_orderkey % 11 = 1 then 'POINT Z (1 1 1)'
            when o_orderkey % 11 = 3 and o_custkey % 4 = 0
              then 'GEOMETRYCOLLECTION(POLYGON Z ((0 0 9, 4 0 9, 4 1 9, 0 1 9, 0 0 9)), '
                || 'POLYGON ((0 0, 9 0, 9 2, 0 2, 0 0)), POINT Z (1 1 1), '
                || 'POLYGON Z ((1 1 5, 3 1 5, 3 6 4, 1 6 5, 1 1 5)))'
            when o_orderkey % 11 = 4 and o_custkey % 4 = 0
              then 'GEOMETRYCOLLECTION(POLYGON Z ((0 0 9, 8 0 9, 8 8 9, 0 8 9, 0 0 9), '
                || '(1 1 9, 2 1 9, 2 2 9, 1 1 9)), POLYGON Z ((1 1 2, 5 1 2, 5 4 2, 1 1 2)))'
            when o_orderkey % 11 = 5 and o_custkey % 4 = 0
              then 'GEOMETRYCOLLECTION(POLYGON Z ((0 0 9, 8 ' || case o_custkey % 5 when 0 then 'x' when 1 then 'X'
                when 2 then 'NaN' when 3 then '1.2E-5' else 'Infinity' end || ' 9, 8 8 9, 0 0 9)), '
                || 'POLYGON Z ((1 1 2, 5 1 2, 5 4 2, 1 1 2)))'
            when o_orderkey % 11 = 6 and o_custkey % 4 = 0
              then 'GEOMETRYCOLLECTION(POLYGON Z ((0 0 9, 8 0 9, 8 8 9, 1 1 9)), POLYGON Z ((1 1 2, 5 1 2, 5 4 2, 1 1 2)))'
            else 'GEOMETRYCOLLECTION(POLYGON Z ((0 0 9, ' || cast(1 + o_custkey % 5 as string) || ' 0 9, '
              || cast(1 + o_custkey % 5 as string) || ' 3 9, 0 3 9, 0 0 9))'
              || case when o_orderkey % 11 = 2 then ''
                      else replace(', POLYGON Z ((1 1 z, 5 1 z, 5 4 z, 1 4 z, 1 1 z))', 'z',
                        cast(case when o_orderkey % 2 = 0 then 2 else -1 - o_orderkey % 3 end as string)) end || ')'
            end as CoverageXYZ,
       'C-' || cast(o_orderkey as string) as seq
from {orders}
union all
select 'T' || cast(o_custkey % 20 as string), case when o_orderkey % 2 = 0 then 'ASU' else 'Partition' end,
       null, cast(o_orderkey as string) || '.1', null, null, '2018-08-01',
       'A-' || cast(o_orderkey as string),
       case o_orderkey % 50 when 0 then null when 1 then 'X-1'
            when 2 then 'X-1' || chr(92) || 'n' || 'C-' || cast(o_orderkey as string)
            else 'C-' || cast(o_orderkey as string) end,
       null, null,
       'A-' || cast(o_orderkey as string)
from {orders} where o_orderpriority in ('1-URGENT', '2-HIGH')
"""

# Some contexts recorded a second time, later, in another trench, and some without a key.
CONTEXT_AGAIN = """
select Source, Type, SubType, Identifier, Title, Description, DateEarliest, IdentifierUUID,
       RelationBelongsToUUID, CoveragePosition, CoverageXYZ, seq || '/1' as seq
from {context}
union all
select 'T99', Type, SubType, Identifier, Title, 'recorded again', DateEarliest, IdentifierUUID,
       RelationBelongsToUUID, CoveragePosition, CoverageXYZ, seq || '/2'
from {context} where length(IdentifierUUID) % 2 = 0
union all
select 'T99', Type, SubType, Identifier, Title, 'recorded without key', DateEarliest, null,
       RelationBelongsToUUID, CoveragePosition, CoverageXYZ, seq || '/3'
from {context} where Source = 'T7'
"""

SAMPLE = """
select 'T' || cast(o_custkey % 20 as string) as Source,
       'SampleBag' as Type,
       case when o_orderkey % 17 = 0 then null else cast(o_orderkey % 1000 as string) end as Identifier,
       case o_custkey % 6 when 0 then 'bone' when 1 then 'shell' when 2 then 'pottery'
            when 3 then 'seeds' when 4 then 'Bone' else 'residue' end as Title,
       'S-' || cast(o_orderkey as string) as IdentifierUUID,
       case o_orderkey % 10 when 0 then null when 1 then 'X-1'
            when 2 then 'C-' || cast(o_orderkey as string) || chr(92) || 'n' || 'A-' || cast(o_orderkey as string)
            when 4 then 'A-' || cast(o_orderkey as string)
            when 6 then 'W-' || cast(o_orderkey as string) || chr(92) || 'n' || 'X-2'
            when 7 then 'X-1' || chr(92) || 'n' || 'P-' || cast(o_orderkey as string)
            else 'C-' || cast(o_orderkey as string) end as RelationBelongsToUUID,
       'S-' || cast(o_orderkey as string) as seq
from {orders}
"""

FIND = """
select 'T' || cast(l_suppkey % 20 as string) as Source,
       'SpecialFind' as Type,
       cast(l_orderkey as string) || '.' || cast(l_linenumber as string) as Identifier,
       case l_partkey % 9 when 0 then 'metals and metallurgical' when 1 then 'obsidian'
            when 2 then 'Kouphonisi limestone pebble' when 3 then 'stone disc' when 4 then 'worked stone'
            when 5 then 'spindle whorl' when 6 then 'spool' when 7 then 'bead'
            else 'Metal disc' end as Title,
       'F-' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string)
            || '-' || cast(l_linenumber as string) as IdentifierUUID,
       case when l_linenumber = 7 then null when l_linenumber % 2 = 0 then 'A-' || cast(l_orderkey as string)
            else 'C-' || cast(l_orderkey as string) end as RelationBelongsToUUID,
       'F-' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string)
            || '-' || cast(l_linenumber as string) as seq
from {lineitem}
"""

# A few bag keys repeat; their seq still differs.
BAG = """
select 'T' || cast(l_suppkey % 20 as string) as Source,
       case when l_partkey % 41 = 0 then null else cast(l_orderkey as string) end as ContextID,
       cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string)
            || '-' || cast(l_linenumber as string) as Identifier,
       'P-' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string)
            || '-' || cast(l_linenumber as string) as IdentifierUUID,
       case l_linenumber when 1 then 'C-' || cast(l_orderkey as string)
            when 2 then 'A-' || cast(l_orderkey as string)
            when 3 then 'S-' || cast(l_orderkey as string)
            when 4 then 'X-1' || chr(92) || 'n' || 'C-' || cast(l_orderkey as string)
            when 5 then null
            when 6 then case when l_returnflag = 'R' then 'F-' || cast(l_orderkey as string) || '-' || cast(l_partkey as string)
                   || '-' || cast(l_suppkey as string) || '-' || cast(l_linenumber as string) else 'X-1' end
            else 'A-' || cast(l_orderkey as string) || chr(92) || 'n' || 'C-' || cast(l_orderkey as string) end
            as RelationBelongsToUUID,
       case l_partkey % 22 when 0 then 'Pre-Phase A' when 1 then 'Phase A' when 2 then 'Phase A ?' when 3 then 'Phase A?'
            when 4 then 'Phase A/B' when 5 then 'Phase A/B ?' when 6 then 'Phase B' when 7 then 'Phase B ?'
            when 8 then 'Phase B?' when 9 then 'Phase B/C' when 10 then 'Phase C' when 11 then 'Phase C (?)'
            when 12 then 'Phase C?' when 13 then 'A-C' when 14 then 'Phase A-C' when 15 then 'Phase A-C?'
            when 16 then 'Post-Phase C' when 17 then 'Post-Phase C?' when 18 then 'Phase A/B?'
            when 19 then 'Mixed' when 20 then '' else null end as CoverageTemporal,
       l_returnflag as PotteryKastri,
       case when l_suppkey % 3 = 0 then null else 'size ' || cast(l_suppkey % 3 as string) end as PotterySherdSizes,
       l_linestatus as PotteryWear,
       case when l_partkey % 2 = 0 then 'burnt' end as PotteryBurning,
       'shape ' || cast(l_linenumber as string) as ShapeCountComment,
       cast(l_linenumber as string) as PotteryCountDiagnosticsBeforeMending,
       case when l_partkey % 61 = 0 then 'many'
            when l_partkey % 59 = 0 then case l_suppkey % 4 when 0 then '1d' when 1 then '0x1p3' when 2 then 'NaN'
              else 'Infinity' end
            else cast(l_suppkey % 10 as string) end as PotteryCountFine,
       case when l_partkey % 67 = 0 then '' when l_partkey % 71 = 0 then '-1.9'
            else cast(l_partkey % 10 as string) end as PotteryCountMedium,
       cast(l_discount * 100 as string) as PotteryCountCoarse,
       case when l_suppkey % 5 > 0 then '1e2' end as PotteryWeightCoarse,
       case when l_partkey % 97 = 0 then 'n/a' when l_partkey % 53 = 0 then ''
            when l_partkey % 31 = 0 then null else cast(l_quantity as string) end as PotteryCountBeforeMending,
       cast(l_extendedprice as string) as PotteryWeightBeforeMending,
{more}       'P-' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string)
            || '-' || cast(l_linenumber as string) || '/' || cast(l_extendedprice as string) as seq
from {lineitem}
"""

PHOTO = """
select 'I-' || cast(event_id as string) as IdentifierUUID,
       'T' || cast(user_id % 20 as string) as Source,
       case event_id % 4 when 0 then null when 1 then 'C-' || cast(user_id as string)
            when 2 then 'C-' || cast(user_id as string) || chr(92) || 'n' || 'A-' || cast(user_id as string)
            else 'C-' || cast(user_id as string) || chr(92) || 'n' || 'A-' || cast(user_id as string)
                 || chr(92) || 'n' || 'C-' || cast(user_id + 1 as string) end as RelationBelongsToUUID,
       'I-' || cast(event_id as string) as seq
from {events}
"""

FLOTATION = """
select 'W-' || cast(o_orderkey as string) as IdentifierUUID,
       'S-' || cast(o_orderkey as string) as RelationBelongsToUUID,
       'W-' || cast(o_orderkey as string) as seq
from {orders}
"""

JOIN = """
select 'J-' || cast(event_id as string) as IdentifierUUID,
       case when event_id % 5 = 0 then null
            when event_id % 3 = 0 then 'S-' || cast(user_id as string)
            else 'S-' || cast(user_id as string) || chr(92) || 'n' || 'X-1' end as RelationIncludesUUID,
       'J-' || cast(event_id as string) as seq
from {events}
"""

# Export file names, one per context: with and without a schema, plain and stripped.
FILE = """
select case when o_custkey % 2 = 0 then 'Stripped_' else '' end || 'Trench ' || cast(o_custkey % 20 as string)
       || case o_orderkey % 9 when 0 then ' ASUs' when 1 then ' Cuts' when 2 then ' Fill Deposits'
            when 3 then ' Flotations' when 4 then ' Flotations2016' when 5 then ' Human Bones'
            when 6 then ' Plans' when 7 then ' Pottery2016' else ' Diary' end
       || '.' || case when o_custkey % 2 = 0 then 'csv' else 'tab' end as file_name
from {orders}
"""


# Every summed column; those that BAG doesn't spell out take digits of the part's key.
COUNTS = config.SUMMED_COLUMNS
_plain = [c for c in COUNTS if f" as {c}," not in BAG]
BAG = BAG.replace(
    "{more}", "".join(f"       cast((l_partkey + {i}) % 7 as string) as {c},\n" for i, c in enumerate(_plain))
)


def view_sql(name: str) -> str:
    """SELECT text of a recording table, its inputs in braces."""
    return {
        "context": CONTEXT, "context_again": CONTEXT_AGAIN, "sample": SAMPLE, "find": FIND,
        "bag": BAG, "photo": PHOTO, "flotation": FLOTATION, "join": JOIN, "file": FILE,
    }[name]


#: Rows of a test table in one task: contexts carry geometry, which is dear to make and to measure.
ROWS_A_TASK = {"context": 250_000, "context_again": 250_000}
MOST_ROWS = 2_000_000


def _spread(rows: DataFrame, most: int | None) -> DataFrame:
    """Narrow input rows dealt to tasks of at most about ``most``; left where they lie if their files split so already.

    A test table may be one row group, so that one task would make all the text. Counts come from the files' footers.
    Without ``most`` rows are moved only where the files leave cores idle, not for their number.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    largest, total = parts.agg(F.max("n"), F.sum("n")).first()
    if not total or largest <= 10_000 or (largest <= (most or largest) and largest * cores <= 2 * total):
        return rows
    return rows.repartition(max(cores, -(-total // (most or MOST_ROWS))), rows.columns[0])


def recording(spark: SparkSession, sf_dir: str, name: str, plain: bool = False) -> DataFrame:
    """A recording table over the parquet tables in ``sf_dir``. It is a projection of them: what isn't asked for isn't made.

    ``plain`` is for steps that read keys and short texts, which a task can make of any number of rows.
    """
    sql = view_sql(name)
    most = None if plain else ROWS_A_TASK.get(name, MOST_ROWS)

    def table(t: str) -> DataFrame:
        return _spread(spark.read.parquet(f"{sf_dir}/{t}.parquet"), most)

    inputs = {t: table(t) for t in ("orders", "lineitem", "events") if "{" + t + "}" in sql}
    if "{context}" in sql:
        inputs["context"] = spark.sql(view_sql("context"), orders=table("orders"))
    frame = spark.sql(sql, **inputs)
    return frame.withColumnRenamed("SubType", "Sub-Type") if name.startswith("context") else frame
