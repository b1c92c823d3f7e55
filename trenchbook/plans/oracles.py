"""The registered queries in SQL, for a side-by-side check.

The SQL goes its own way: row by row with window functions, where the
operators resolve texts, aggregate and join back.
"""

from __future__ import annotations

import re

from trenchbook import config
from trenchbook.plans.fixtures import COUNTS, view_sql

ASU = "Type in ('Partition', 'ASU')"
NUMBER = r"case when regexp_full_match({0}, '\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*') then try_cast({0} as double) end"
WHOLE = "cast(trunc(" + NUMBER + ") as bigint)"


def _view(name: str) -> str:
    sql = view_sql(name)
    for table in ("orders", "lineitem", "events"):
        sql = sql.replace("{" + table + "}", table)
    return sql.replace("{context}", "v_context")


def _named(view: str) -> str:
    return f'select * exclude (SubType), SubType as "Sub-Type" from {view}'


def _edges(table: str, column: str = "RelationBelongsToUUID") -> str:
    return f"""
    select seq, cast(generate_subscripts(m, 1) - 1 as integer) as pos, unnest(m) as parent
    from (select seq, string_split({column}, chr(92) || 'n') as m from {table} where {column} is not null)"""


def _master(table: str) -> str:
    return f"""
    select c.*, case when {ASU} then p.parent else IdentifierUUID end as Context_UUID,
           case when {ASU} then IdentifierUUID end as ASU_UUID
    from {table} c left join (
        select e.seq, arg_min(e.parent, e.pos) as parent
        from ({_edges(f"(select * from {table} where {ASU})")}) e
        where e.parent in (select IdentifierUUID from {table} where not {ASU} and IdentifierUUID is not null)
        group by e.seq) p using (seq)"""


def _classified(table: str) -> str:
    return f"""
    select r.*, coalesce(h.context, a.Context_UUID) as Context_UUID, h.asu as ASU_UUID,
           h.flotation as FlotationBag_UUID, h.pottery as PotteryBag_UUID, h.unknown
    from {table} r left join (
        select e.seq, arg_max(e.parent, pos) filter (kind = 0) as context,
               arg_max(e.parent, pos) filter (kind = 1) as asu,
               arg_max(e.parent, pos) filter (kind = 2) as flotation,
               arg_max(e.parent, pos) filter (kind = 3) as pottery,
               arg_max(e.parent, pos) filter (kind is null) as unknown
        from ({_edges(table)}) e left join key_list k on e.parent = k.uuid group by e.seq) h using (seq)
    left join (select * from master where {ASU}) a on h.asu = a.IdentifierUUID"""


def _case(pairs: list[tuple[str, str]], otherwise: str) -> str:
    arms = " ".join(f"when CoverageTemporal = '{k}' then '{v}'" for k, v in pairs)
    return f"case {arms} else {otherwise} end"


SLOT = _case([(k, slot) for k, (slot, _) in config.PHASE_SPELLINGS.items()], "'Other'")
FLAG = _case(
    [(k, flag) for k, (_, flag) in config.PHASE_SPELLINGS.items()],
    "coalesce(CoverageTemporal, '')",
)
SLOTS = [*config.PHASE_SLOTS, "Other"]
PERIOD = (
    "case "
    + " ".join(f"when \"{slot}\" = 'yes' then '{name}'" for slot, name in config.PERIOD_ORDER)
    + ' else "Other" end'
)
NOTES = list(config.NOTE_COLUMNS.items())
CLASS = """case when lower(Title) like '%metal%' then 'metallurgical'
    when lower(Title) like '%obsid%' then 'obsidian'
    when lower(Title) like '%koufo%' or lower(Title) like '%kouph%' then 'kouphonisi pebble'
    when lower(Title) like '%disc%' then 'stone disc'
    when lower(Title) like '%worked stone%' then 'worked stone'
    when lower(Title) like '%spindle%' or lower(Title) like '%spool%' then 'spool_whorl' end"""
CLASSES = list(config.FIND_CLASSES)


def _flags(levels: str) -> str:
    slots = ", ".join(
        f"coalesce(arg_max({FLAG}, seq) filter ({SLOT} = '{s}'), 'no') as \"{s}\"" for s in SLOTS
    )
    return f"select *, {PERIOD} as Period from (select target, {slots} from {levels} group by target)"


def _noted(levels: str) -> str:
    texts = ", ".join(f"coalesce({c}, '') as {n}" for c, n in NOTES)
    return f"select target, seq, {texts} from {levels}"


def _phases(geo: str, flags: str) -> str:
    flag_items = ", ".join(f"coalesce(f.\"{s}\", 'no') as \"{s}\"" for s in [*SLOTS, "Period"])
    return f"select g.*, {flag_items} from {geo} g left join {flags} f on g.IdentifierUUID = f.target"


def _finds(geo: str, levels: str) -> str:
    counts = ", ".join(f"count(*) filter ({CLASS} = '{c}') as \"{c}\"" for c in CLASSES)
    items = ", ".join(f'coalesce(f."{c}", 0) as "{c}"' for c in CLASSES)
    return f"""select g.*, {items} from {geo} g
    left join (select target, {counts} from {levels} group by target) f on g.IdentifierUUID = f.target"""


def _levels(table: str) -> str:
    return f"""select *, Context_UUID as target from {table} where Context_UUID is not null
    union all select *, ASU_UUID as target from {table}
    where ASU_UUID is not null and ASU_UUID is distinct from Context_UUID"""


def _rolled(key: str) -> str:
    sums = ", ".join(f"cast(coalesce(sum({WHOLE.format(c)}), 0) as bigint) as {c}" for c in COUNTS)
    return f"""select {key} as key, arg_min(coalesce(Source, chr(0)), seq) as Source,
        nullif(arg_min(coalesce(ContextID, chr(0)), seq), chr(0)) as ContextID, {sums}
    from pottery where {key} is not null group by 1"""


def _shape_columns(type_name: str, lacking: list[str]) -> str:
    names = [
        "Source", "Type", "Sub-Type", "Identifier", "Title", "DateEarliest", "Description",
        "CoveragePosition", "CoverageXYZ", "IdentifierUUID", "RelationBelongsToUUID",
    ]
    items = ", ".join(
        f'cast(null as varchar) as "{n}"' if n in lacking else f'"{n}"' for n in names
    )
    where = ASU if type_name == "ASU" else f"Type = '{type_name}'"
    return f"select {items} from t_context where {where}"


def _problems(table: str, checks: list[tuple[str, str, str, str, str]], carry: str = "") -> str:
    """Violations by (column, code, message, type, condition)."""
    return " union all ".join(
        f"""select Source as source_file, seq as row, '{column}' as "column", '{code}' as code,
            '{message}' as message, cast({column} as varchar) as value, '{declared}' as field_type,
            'default' as field_format {carry}
        from {table} where {condition}"""
        for column, code, message, declared, condition in checks
    )


REQUIRED = "required-constraint"
UNIQUE = "unique-constraint"
TYPE = "type-or-format-error"
SAMPLE_TITLES = ", ".join(f"'{t}'" for t in config.SAMPLE_TITLES)


def _required(*columns: str) -> list[tuple[str, str, str, str, str]]:
    return [(c, REQUIRED, f"{c} is required", "string", f"{c} is null") for c in columns]


def _repeated(table: str, column: str, per_file: bool = True) -> tuple[str, str, str, str, str]:
    scope = "(Source, {0})" if per_file else "{0}"
    chosen = scope.format(column)
    grouped = f"Source, {column}" if per_file else column
    return (
        column, UNIQUE, f"{column} must be unique", "string",
        f"{chosen} in (select {chosen} from {table} where {column} is not null "
        f"group by {grouped} having count(*) > 1)",
    )


def _not_numbers() -> list[tuple[str, str, str, str, str]]:
    return [
        (c, TYPE, f"{c} is not a number", "number",
         f"{c} is not null and {c} <> '' and {NUMBER.format(c)} is null")
        for c in COUNTS
    ]


SAMPLE_CHECKS = [
    *_required("Type", "Identifier", "Title", "IdentifierUUID"),
    ("Title", "enumerable-constraint", "Title is not one of the listed values", "string",
     f"Title not in ({SAMPLE_TITLES})"),
    _repeated("t_sample", "Identifier"),
    _repeated("t_sample", "IdentifierUUID"),
]


def _bag_checks(per_file: bool) -> list[tuple[str, str, str, str, str]]:
    return [
        *_required("ContextID", "Identifier", "IdentifierUUID"),
        *_not_numbers(),
        _repeated("t_bag", "IdentifierUUID", per_file),
    ]


MISSING_TYPED = """select Source as source_file, seq as row, 'DateEarliest' as "column",
    'type-or-format-error' as code, DateEarliest as value from t_context
    where DateEarliest is not null
    and (length(DateEarliest) < 16 or substr(DateEarliest, 11, 1) <> 'T' or try_cast(DateEarliest as timestamp) is null)"""

FOUND = 'source_file, row, "column", code, value'

# Building blocks, used by name in the queries and in each other.
PARTS = {
    "v_context": _view("context"),
    "v_context_again": _view("context_again"),
    "t_context": _named("v_context"),
    "t_context_again": _named("v_context_again"),
    "t_sample": _view("sample"),
    "t_find": _view("find"),
    "t_bag": _view("bag"),
    "t_photo": _view("photo"),
    "t_flotation": _view("flotation"),
    "t_join": _view("join"),
    "t_file": _view("file"),
    "master": _master("t_context"),
    "again": _master("t_context_again"),
    "key_list": f"""select uuid, min(kind) as kind from (
        select IdentifierUUID as uuid, case when {ASU} then 1 else 0 end as kind from master
        union all select IdentifierUUID, 2 from t_flotation
        union all select IdentifierUUID, 3 from t_bag) group by uuid""",
    "samples": _classified("t_sample"),
    "finds": _classified("t_find"),
    "candidates": """select * from (
        select *, row_number() over (partition by parent order by priority, seq) as rn from (
            select IdentifierUUID as parent, 0 as priority, seq, Context_UUID, ASU_UUID,
                   IdentifierUUID as SampleBag_UUID from samples
            union all select IdentifierUUID, 1, seq, Context_UUID, ASU_UUID, null from master
            union all select IdentifierUUID, 2, seq, Context_UUID, ASU_UUID, null from finds)
        where Context_UUID is not null) where rn = 1""",
    "pottery": f"""select b.*, h.Context_UUID, h.ASU_UUID, h.SampleBag_UUID
        from t_bag b left join (
            select e.seq, c.Context_UUID, c.ASU_UUID, c.SampleBag_UUID,
                   row_number() over (partition by e.seq order by pos) as rn
            from ({_edges("t_bag")}) e join candidates c on e.parent = c.parent) h
        on b.seq = h.seq and h.rn = 1""",
    "levels": _levels("pottery"),
    "context_levels": "select *, Context_UUID as target from pottery where Context_UUID is not null",
    "flags": _flags("levels"),
    "context_flags": _flags("context_levels"),
    "notes": _noted("levels"),
    "rolled_own": _rolled("coalesce(ASU_UUID, Context_UUID)"),
    "rolled_context": _rolled("Context_UUID"),
    "rolled_asu": f"""select r.Source, r.ContextID, {", ".join("r." + c for c in COUNTS)},
        case when a.key is not null then m.Context_UUID else r.key end as Context_UUID,
        a.key as ASU_UUID
        from rolled_own r
        left join (select distinct ASU_UUID as key from pottery where ASU_UUID is not null) a on a.key = r.key
        left join (select IdentifierUUID, Context_UUID from master where {ASU}) m on m.IdentifierUUID = a.key""",
    "polygons": r"""select seq, IdentifierUUID, cast(pos as integer) as pos, piece || ')' as wkt from (
        select seq, IdentifierUUID, generate_subscripts(p, 1) - 1 as pos, unnest(p) as piece from (
            select seq, IdentifierUUID, regexp_extract_all(CoverageXYZ, 'POLYGON( Z)? ?\(\([^)]*\)') as p
            from master where starts_with(CoverageXYZ, 'GEOMETRYCOLLECTION(')))""",
    "points": f"""select seq, pos, i, {NUMBER.format("n[1]")} as x, {NUMBER.format("n[2]")} as y,
        {NUMBER.format("n[3]")} as z from (
        select seq, pos, i, string_split(trim(point), ' ') as n from (
            select seq, pos, generate_subscripts(l, 1) as i, unnest(l) as point from (
                select seq, pos, string_split(replace(substr(wkt, strpos(wkt, '((') + 2), '))', ''), ',') as l
                from polygons)))""",
    "measures": """select seq, pos,
        case when count(*) = count(term) then abs(sum(term)) / 2 end as area, min(low) as low from (
        select seq, pos, least(x, y, z) as low,
               x * coalesce(lead(y) over w, first_value(y) over w)
               - coalesce(lead(x) over w, first_value(x) over w) * y as term
        from points window w as (partition by seq, pos order by i)) group by seq, pos""",
    "measured": "select p.*, m.area, m.low from polygons p join measures m using (seq, pos)",
    "top_two": """select *, rn - 1 as place from (
        select *, row_number() over (partition by seq order by area desc) as rn from (
            select *, row_number() over (partition by seq, area order by pos) as same from measured
            where area is not null) where same = 1) where rn <= 2""",
    "shapes": """select a.seq, case when b.low is null or a.low <= b.low then a.wkt else b.wkt end as opening,
        case when b.low is null or a.low <= b.low then b.wkt else a.wkt end as closing
        from (select * from top_two where place = 0) a
        left join (select * from top_two where place = 1) b using (seq)""",
    "placed": """select t.*, case when CoveragePosition like '%,%' then split_part(CoveragePosition, ',', 1) end as X,
        case when CoveragePosition like '%,%' then split_part(CoveragePosition, ',', 2) end as Y,
        s.opening, s.closing from master t left join shapes s using (seq)""",
    # Copies have the geometry of the row they copy, so its polygons are looked up by text.
    "again_shapes": """select distinct m.CoverageXYZ, s.opening, s.closing,
        coalesce(n.polygons, 0) as polygons from master m left join shapes s using (seq)
        left join (select seq, count(*) as polygons from top_two group by seq) n using (seq)
        where m.CoverageXYZ is not null""",
    "ranked": """select *, row_number() over (partition by IdentifierUUID order by seq) as rn from again""",
    "phased": _phases("placed", "flags"),
    "context_phased": _phases(f"(select * from placed where not {ASU})", "context_flags"),
    "found_asu": _finds("placed", f"({_levels('finds')})"),
    "found_context": _finds(
        f"(select * from placed where not {ASU})",
        "(select *, Context_UUID as target from finds where Context_UUID is not null)",
    ),
    # The first bad number of a bag as "column=value"; copies are counted among bags without one.
    "checked_bags": f"""select *, row_number() over (partition by IdentifierUUID, bad is null order by seq) as rn
        from (select *, coalesce({", ".join(
            f"case when {c} <> '' and {NUMBER.format(c)} is null then '{c}=' || {c} end" for c in COUNTS)}) as bad
            from t_bag)""",
    "sample_problems": _problems("t_sample", SAMPLE_CHECKS,
        """, concat_ws(' - ', coalesce(Source, ''), coalesce(Type, ''), coalesce(Identifier, ''),
           coalesce(Title, '')) as item"""),
    "issues": f"""select Source, Type, "Sub-Type", Identifier,
            case when starts_with(a.CoverageXYZ, 'GEOMETRYCOLLECTION(') then 'fewer than two polygons'
                 else 'not a geometry collection' end as reason
        from again a left join again_shapes s on a.CoverageXYZ = s.CoverageXYZ
        where a.CoverageXYZ is null or not starts_with(a.CoverageXYZ, 'GEOMETRYCOLLECTION(') or s.polygons < 2
        union all select Source, Type, "Sub-Type", Identifier, 'key used before' from ranked where rn > 1""",
}


def _ending(column: str, endings: dict[str, str]) -> str:
    def lookup(n: int) -> str:
        arms = " ".join(f"when '{k}' then '{v}'" for k, v in endings.items())
        return f"case right({column}, {n}) {arms} end"

    return "coalesce(" + ", ".join(lookup(n) for n in config.ENDING_LENGTHS) + ")"


_counts = ", ".join(COUNTS)
_stem = "replace(split_part(file_name, '.', 1), 'Stripped_', '')"

SQL = {
    "route_type": f"""select file_name, {_ending("file_name", config.EXPORT_SCHEMAS)} as export_schema,
        {_ending("file_name", config.STRIPPED_SCHEMAS)} as stripped_schema,
        {_ending("file_name", config.RECORD_TYPES)} as record_type from t_file""",
    "source_from_file": f"select file_name, {_stem} as Source from t_file",
    "align_contexts": " union all ".join(
        _shape_columns(t, lacking)
        for t, lacking in {
            "FillDeposit": ["RelationBelongsToUUID"],
            "Cut": ["Sub-Type"],
            "Structure": ["DateEarliest", "RelationBelongsToUUID"],
            "Surface": ["Sub-Type", "DateEarliest", "RelationBelongsToUUID"],
            "ASU": ["Sub-Type"],
        }.items()
    ),
    "report_rename": """select Source as Trench, Identifier as ContextID, "Sub-Type" as SubType,
        Description as ExcavationNote, IdentifierUUID from t_context""",
    "split_position": "select IdentifierUUID, CoveragePosition, X, Y from placed",
    "is_asu": f"select IdentifierUUID, {ASU} as is_asu from t_context",
    "drop_null_geometry": """select count(*) filter (opening is not null) as kept,
        count(*) filter (opening is null) as dropped from placed""",
    "contexts_only": f"""select Source, IdentifierUUID, Title, opening, closing
        from ranked r left join again_shapes s on r.CoverageXYZ = s.CoverageXYZ where rn = 1 and not {ASU}""",
    "check_required": f"select {FOUND} from sample_problems where code = 'required-constraint'",
    "check_enum": f"select {FOUND} from sample_problems where code = 'enumerable-constraint'",
    "check_type": f"select {FOUND} from ({_problems('t_bag', _not_numbers())})",
    "check_type_datetime": MISSING_TYPED,
    "check_unique": f"select {FOUND} from sample_problems where code = 'unique-constraint'",
    "check_unique_site": f"""select {FOUND} from ({_problems("t_context_again", [
        _repeated("t_context_again", "Identifier", False), _repeated("t_context_again", "IdentifierUUID", False)])})""",
    "missing_values": """select IdentifierUUID, nullif(nullif(Description, '5-LOW'), '') as Description
        from t_context""",
    "violation_report": 'select source_file, row, item, "column", code, message from sample_problems',
    "violation_counts": """select Source as source_file, count(*) as n_rows, coalesce(max(n), 0) as n_violations,
        coalesce(max(n), 0) > 0 as failing from t_sample
        left join (select source_file, count(*) as n from sample_problems group by 1) on source_file = Source
        group by 1""",
    "file_totals": """select count(*) as examined, count(*) filter (n is null) as clean,
        count(*) filter (n is not null) as failing from (select distinct Source from t_sample)
        left join (select source_file, count(*) as n from sample_problems group by 1) on source_file = Source""",
    "pottery_violations": _problems("t_bag", _bag_checks(False),
        ", Source as trench, ShapeCountComment as shapecount, "
        "PotteryCountDiagnosticsBeforeMending as diagcount, Identifier as potbag"),
    "pottery_violations_file": _problems("t_bag", _bag_checks(True)),
    "pottery_violations_all": f"""select 'pottery' as "table", {FOUND}
        from ({_problems("t_bag", _bag_checks(True))})""",
    "concat_type": """select Source || ' Sample Bags.tab' as file_name, Source || ' Sample Bags' as Source,
            Identifier, IdentifierUUID from t_sample
        union all select 'Stripped_' || Source || ' Finds.csv', Source || ' Finds', Identifier, IdentifierUUID
        from t_find""",
    "type_row_counts": "select Type, count(*) as n_rows from t_context group by Type",
    "master_context": "select * exclude (seq) from master",
    "distinct_keys": """select distinct 'context' as kind, Context_UUID as key from pottery where Context_UUID is not null
        union all select distinct 'asu', ASU_UUID from pottery where ASU_UUID is not null
        union all select distinct 'context without asu', Context_UUID from pottery
        where ASU_UUID is null and Context_UUID is not null""",
    "explode_relation": f"""select IdentifierUUID, e.pos, e.parent from t_photo
        left join ({_edges("t_photo")}) e using (seq)""",
    "guid_index": "select * from key_list",
    "asu_parent": f"select IdentifierUUID, Context_UUID, ASU_UUID from master where {ASU}",
    "classify_parents": "select * exclude (seq, unknown) from samples",
    "asu_fallback_context": """select IdentifierUUID, Context_UUID, ASU_UUID, FlotationBag_UUID, PotteryBag_UUID
        from finds""",
    "pottery_parents": "select IdentifierUUID, Context_UUID, ASU_UUID, SampleBag_UUID from pottery",
    "orphans_blank": """select Source, Type, Identifier, Title, IdentifierUUID from t_sample
        where RelationBelongsToUUID is null""",
    "orphans_unresolved": """select Source, IdentifierUUID, unknown as parent from samples
        where unknown is not null and Context_UUID is null and ASU_UUID is null""",
    "asu_no_parent": f"""select Source, Identifier, IdentifierUUID,
        case when RelationBelongsToUUID is null then 'no parent given' else 'parent is not a context' end as reason
        from master where {ASU} and Context_UUID is null""",
    "pottery_no_fk": """select Source, ContextID, Identifier from pottery
        where Context_UUID is null and ASU_UUID is null""",
    "pottery_key_check": """select Source, ContextID, Identifier, RelationBelongsToUUID from pottery
        where Context_UUID is null and ASU_UUID is null""",
    "explode_photos": f"""select case when n > 1 then md5(IdentifierUUID || '#' || e.parent) else IdentifierUUID end
            as IdentifierUUID, Source,
            case when n > 1 then e.parent else RelationBelongsToUUID end as RelationBelongsToUUID,
            case when n > 1 then IdentifierUUID end as OriginalIdentifierUUID
        from (select *, len(string_split(RelationBelongsToUUID, chr(92) || 'n')) as n from t_photo) p
        left join ({_edges("t_photo")}) e using (seq)""",
    "join_bag_links": f"""select j.IdentifierUUID, e.pos, e.parent as PotBag_UUID,
            case when b.seq is not null then b.ContextID else s.ContextID end as ContextID,
            case when b.seq is not null then b.Context_UUID else s.Context_UUID end as Context_UUID,
            case when b.seq is not null then b.ASU_UUID else s.ASU_UUID end as ASU_UUID,
            b.seq is not null or s.seq is not null as found
        from t_join j left join ({_edges("t_join", "RelationIncludesUUID")}) e using (seq)
        left join pottery b on b.IdentifierUUID = e.parent
        left join (select *, row_number() over (partition by SampleBag_UUID order by seq desc) as rn
                   from pottery where SampleBag_UUID is not null) s
        on s.SampleBag_UUID = e.parent and s.rn = 1""",
    "rollup_context_asu": f"""select Source, ContextID, {_counts}, Context_UUID, ASU_UUID
        from rolled_asu""",
    "rollup_context": f"""select Source, ContextID, {_counts}, key as Context_UUID,
        cast(null as varchar) as ASU_UUID from rolled_context""",
    "int_sum": "select Source as key, " + ", ".join(
        f"cast(coalesce(sum({WHOLE.format(c)}), 0) as bigint) as {c}" for c in COUNTS
    ) + " from t_bag group by 1",
    "concat_ids": "select Context_UUID as key, seq, coalesce(Identifier, '') as Identifier, "
    "row_number() over (partition by Context_UUID order by seq) - 1 as n from pottery "
    "where Context_UUID is not null",
    "first_labels": "select key, Source, ContextID from rolled_context",
    "bad_numbers": " union all ".join(
        f"""select Source, ContextID, Identifier, '{c}' as "column", {c} as value from t_bag
        where {c} is not null and {c} <> '' and {NUMBER.format(c)} is null""" for c in COUNTS
    ),
    "rollup_reconcile": f"""select rollup, before, after, before - after as not_rolled_up from (
            select cast(sum({WHOLE.format(config.CONTROL_COLUMN)}) as bigint) as before from pottery) b
        cross join (
            select 'context_asu' as rollup, cast(sum({config.CONTROL_COLUMN}) as bigint) as after from rolled_asu
            union all
            select 'context', cast(sum({config.CONTROL_COLUMN}) as bigint) from rolled_context) a""",
    "not_rolled_up": """select 'context_asu' as rollup, Source, ContextID, Identifier from pottery
            where coalesce(ASU_UUID, Context_UUID) is null
        union all select 'context', Source, ContextID, Identifier from pottery where Context_UUID is null""",
    "context_counts": f"""select count(*) filter (not {ASU}) as contexts, count(*) filter ({ASU}) as asus,
        count(*) as total from master""",
    "phase_map": f"select IdentifierUUID, CoverageTemporal, {SLOT} as slot, {FLAG} as flag from t_bag",
    "phase_flags": "select * exclude (Period) from flags",
    "period": "select target, Period from context_flags",
    "bag_notes": "select *, row_number() over (partition by target order by seq desc) - 1 as n from notes",
    "phases_context_asu": "select * exclude (seq) from phased",
    "phases_context": "select * exclude (seq) from context_phased",
    "counts_context_asu": f"""select p.IdentifierUUID, Type, Period, r.ContextID, {_counts},
        r.Source as Pottery_Source, r.Context_UUID as Pottery_Context_UUID, r.ASU_UUID as Pottery_ASU_UUID
        from phased p join rolled_asu r
        on ({ASU} and p.IdentifierUUID = r.ASU_UUID)
        or (not {ASU} and r.ASU_UUID is null and p.IdentifierUUID = r.Context_UUID)""",
    "counts_context": f"""select p.IdentifierUUID, Type, Period, r.ContextID, {_counts},
        r.Source as Pottery_Source, r.key as Pottery_Context_UUID
        from context_phased p join rolled_context r on p.IdentifierUUID = r.key""",
    "no_counts": f"""select Source, Identifier, IdentifierUUID from master
        where case when {ASU} then IdentifierUUID not in (select ASU_UUID from rolled_asu where ASU_UUID is not null)
        else IdentifierUUID not in (select Context_UUID from rolled_asu
                                    where ASU_UUID is null and Context_UUID is not null) end""",
    "no_counts_context": f"""select Source, Identifier, IdentifierUUID from master
        where not {ASU} and IdentifierUUID not in (select key from rolled_context)""",
    "find_class": f"select IdentifierUUID, Title, {CLASS} as find_class from t_find",
    "finds_context_asu": "select IdentifierUUID, Type, "
        + ", ".join(f'"{c}"' for c in CLASSES) + " from found_asu",
    "finds_context": "select IdentifierUUID, Type, "
        + ", ".join(f'"{c}"' for c in CLASSES) + " from found_context",
    "split_collection": "select IdentifierUUID, pos, wkt from polygons",
    "polygon_area": "select IdentifierUUID, pos, area from measured",
    "min_coordinate": "select IdentifierUUID, pos, low from measured",
    "top2_polygons": "select IdentifierUUID, cast(place as integer) as place, wkt, area, low from top_two",
    "open_close": "select IdentifierUUID, opening, closing from placed",
    "geo_contexts": """select r.* exclude (seq, rn),
        case when CoveragePosition like '%,%' then split_part(CoveragePosition, ',', 1) end as X,
        case when CoveragePosition like '%,%' then split_part(CoveragePosition, ',', 2) end as Y,
        opening, closing from ranked r left join again_shapes s on r.CoverageXYZ = s.CoverageXYZ where rn = 1""",
    "polygon_issues": "select * from issues",
    "asu_without_context_row": f"""select Source, Type, Identifier, Context_UUID from (
        select *, row_number() over (partition by Context_UUID order by seq) as n from master
        where Context_UUID is null
           or Context_UUID not in (select IdentifierUUID from master where not {ASU})) where n = 1""",
    "polygon_features": """select Source as Trench, Type, "Sub-Type" as SubType, Identifier as ID,
            IdentifierUUID as UUID, 'open' as kind, opening as wkt from placed where opening is not null
        union all select Source, Type, "Sub-Type", Identifier, IdentifierUUID, 'close', closing
        from placed where closing is not null""",
    "layer_phase_pottery": f"""select p.Source, Type, "Sub-Type", p.Identifier, Title, Description, p.IdentifierUUID,
        {", ".join(f'"{s}"' for s in SLOTS)}, Period, r.ContextID, {_counts},
        p.Context_UUID, opening as wkt
        from context_phased p join rolled_context r on p.IdentifierUUID = r.key where opening is not null""",
    "layer_sf_summary": f"""select Source, Type, "Sub-Type", Identifier, Title, Description, IdentifierUUID,
        Context_UUID, ASU_UUID, {", ".join(f'"{c}"' for c in CLASSES)}, opening as wkt
        from found_context where opening is not null""",
    "bad_wkt": f"""select IdentifierUUID, wkt from (
            select IdentifierUUID, wkt, string_split(split_part(split_part(wkt, '((', 2), '))', 1), ', ') as corners
            from (select IdentifierUUID, 'POLYGON' || split_part(piece, '))', 1) || '))' as wkt
                from (select IdentifierUUID, unnest(string_split(CoverageXYZ, 'POLYGON')[2:]) as piece from master)))
        where strpos(wkt, '), (') > 0 or corners[1] <> corners[-1] or len(corners) < 4
           or len(list_filter(string_split(array_to_string(corners, ' '), ' '), lambda n: {NUMBER.format("n")} is null)) > 0""",
    "dedupe_first": "select Source, Identifier, IdentifierUUID, Description from ranked where rn = 1",
    "repeated_rows": "select Source, Identifier, IdentifierUUID, Description from ranked where rn > 1",
    "first_match": "select parent, Context_UUID, ASU_UUID, SampleBag_UUID from candidates",
    "sorted_issues": 'select * from issues order by reason, Source, Type, "Sub-Type", Identifier',
    "publish_table": """select Source, Type, "Sub-Type", Identifier, Title, Description, DateEarliest,
        IdentifierUUID, RelationBelongsToUUID, CoverageXYZ from ranked
        where rn = 1 and IdentifierUUID is not null""",
    "publish_numbers": "select Source, ContextID, Identifier, "
        + ", ".join(f"{NUMBER.format(c)} as {c}" for c in COUNTS)
        + """, IdentifierUUID from checked_bags where bad is null and rn = 1""",
    "publish_number_rejects": """select Source, Identifier, IdentifierUUID,
        case when bad is null then 'key loaded before' else 'not a number' end as reason,
        split_part(bad, '=', 1) as "column", split_part(bad, '=', 2) as value
        from checked_bags where bad is not null or rn > 1""",
    "publish_number_counts": """select count(*) filter (bad is null and rn = 1) as loaded,
        count(*) filter (bad is not null or rn > 1) as failed from checked_bags""",
    "publish_rejects": """select Source, Identifier, IdentifierUUID,
        case when IdentifierUUID is null then 'no key' else 'key loaded before' end as reason,
        cast(null as varchar) as "column", cast(null as varchar) as value
        from ranked where rn > 1 or IdentifierUUID is null""",
    "publish_counts": """select count(*) filter (rn = 1 and IdentifierUUID is not null) as loaded,
        count(*) filter (rn > 1 or IdentifierUUID is null) as failed from ranked""",
}


def _needed(sql: str, known: dict[str, None]) -> None:
    for name in re.findall(r"\b(?:from|join)\s+([a-z_]+)\b", sql):
        if name in PARTS and name not in known:
            _needed(PARTS[name], known)
            known[name] = None


def oracle_sql() -> dict[str, str]:
    """Each query as one statement, with the building blocks it needs in front."""
    statements = {}
    for name, sql in SQL.items():
        needed: dict[str, None] = {}
        _needed(sql, needed)
        parts = ",\n".join(f"{n} as ({PARTS[n]})" for n in needed)
        statements[name] = f"with {parts}\n{sql}" if needed else sql
    return statements
