"""The linter: every rule gives project_id, category, severity, rule, entity.

Rules of all categories on one row share a pass over their table. What a rule asks of other objects of a table or project is
gathered as bits and counts in one partial aggregation by table and one by project, so that no rule joins the fleet's
tables anew and none gathers a project; tables of one name in a project count as one. The first holder of a lineage tag is
found by a minimum, so that a tag or project holding most rows needs no large sort in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import BARE, QUALIFIED
from ..sources.fleet import dealt, fleet, fleet_sql
from ..sources.frames import written
from .graphs import components

_c = F.col
QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


Rule = tuple[str, str, str, Column]  #: category, severity, rule, condition


def flagged(df: DataFrame, entity: Column, rules: list[Rule], wanted: tuple[str, ...]) -> list[DataFrame]:
    """One row per row and rule of the wanted categories that holds, in one pass; a null condition doesn't hold."""
    named = lambda *x: F.struct(*(F.lit(v).alias(n) for n, v in zip(("category", "severity", "rule"), x)))
    marks = [F.when(cond, named(k, s, r)) for k, s, r, cond in rules if k in wanted]
    if not marks:
        return []
    # a lambda would have all conditions interpreted, not compiled
    hits = df.select("project_id", entity.alias("entity"), F.explode(F.array(*marks)).alias("f")).filter("f is not null")
    return [hits.select("project_id", "f.category", "f.severity", "f.rule", "entity")]


def counted(df: DataFrame, rules: list[Rule], wanted: tuple[str, ...], severities: tuple[str, ...]) -> list[DataFrame]:
    """What flagged gives for rules of the wanted severities as findings by project and rule: rows are counted where they are, none is made for a finding."""
    rules = [r for r in rules if r[0] in wanted and r[1] in severities]
    if not rules:
        return []
    n = df.groupBy("project_id").agg(*(F.count_if(cond).alias(f"n{k}") for k, (*_, cond) in enumerate(rules)))
    found = F.array(*(F.struct(*(F.lit(v).alias(name) for name, v in zip(("category", "severity", "rule"), r)), _c(f"n{k}").alias("findings")) for k, r in enumerate(rules)))
    return [n.select("project_id", F.inline(found)).filter("findings > 0")]


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _member(table: str = "table_name", name: str = "name") -> Column:
    return F.concat_ws(".", table, name)


def all_formulas(spark, sf) -> DataFrame:
    """project_id, kind, table_name, name, expression of measures, calculated columns and calculation items."""
    m = fleet(spark, sf, "formulas").select("project_id", F.lit("measure").alias("kind"), "table_name", "name", "expression")
    c = fleet(spark, sf, "columns").filter("is_calculated").select("project_id", F.lit("column").alias("kind"), "table_name", _c("column_name").alias("name"), "expression")
    i = fleet(spark, sf, "items").select("project_id", F.lit("item").alias("kind"), "table_name", "name", "expression")
    return together(m, c, i)


_TEXTS = fleet_sql("formulas", "columns", "items") + """, texts as (select project_id, 'measure' as kind, table_name, name, expression from formulas
  union all select project_id, 'column', table_name, column_name, expression from columns where is_calculated union all select project_id, 'item', table_name, name, expression from items)"""


def named(texts: DataFrame) -> DataFrame:
    """project_id, kind, own_table, own_name, table_name (null: brackets without a table), column_name; a text may show a name again in another spelling."""
    own = ["project_id", "kind", _c("table_name").alias("own_table"), _c("name").alias("own_name")]
    found = lambda pattern, group: F.explode(F.array_distinct(F.regexp_extract_all("expression", F.lit(pattern), F.lit(group))))
    full = texts.select(*own, found(QUALIFIED, 0).alias("r"))
    full = full.select("project_id", "kind", "own_table", "own_name", F.replace(F.trim(F.regexp_extract("r", r"^([^\[]*)", 1)), F.lit("'"), F.lit("")).alias("table_name"), F.regexp_extract("r", r"\[([^\]]+)\]", 1).alias("column_name"))
    bare = texts.select(*own, found(BARE, 1).alias("column_name")).withColumn("table_name", F.lit(None).cast("string"))
    return full.unionByName(bare)


def references(texts: DataFrame) -> DataFrame:
    """What texts name, each once a text."""
    return named(texts).distinct()


_REFS = _TEXTS + """, q as (select project_id, kind, table_name, name, unnest(regexp_extract_all(expression, '[A-Za-z_''][A-Za-z0-9_'' ]*\\[[^\\]]+\\]')) as r from texts),
  qualified as (select distinct project_id, kind, table_name as own_table, name as own_name, replace(trim(regexp_extract(r, '^([^\\[]*)', 1)), '''', '') as table_name, regexp_extract(r, '\\[([^\\]]+)\\]', 1) as column_name from q),
  bare as (select distinct project_id, kind, table_name as own_table, name as own_name, unnest(regexp_extract_all(expression, '(^|[^A-Za-z0-9_''])\\[([^\\]]+)\\]', 2)) as column_name from texts)"""


@query(f"""with {fleet_sql('formulas', 'columns', 'items', 'role_filters', 'expressions')}, {_TEXTS[_TEXTS.index("texts as"):]}
  select * from texts where expression is not null union all select project_id, 'role', table_name, role, filter from role_filters where filter is not null union all select project_id, 'format', table_name, name, format_string from formulas where format_string is not null
  union all select project_id, 'expression', null, name, body from expressions""")
def all_expressions(spark, sf):
    """Every text of the fleet that is a formula or names objects: measures, calculated columns, items, filters of roles, formats, named expressions."""
    own = lambda name, kind, table, who, text: fleet(spark, sf, name).select("project_id", F.lit(kind).alias("kind"), table.alias("table_name"), _c(who).alias("name"), _c(text).alias("expression"))
    more = together(own("role_filters", "role", _c("table_name"), "role", "filter"), own("formulas", "format", _c("table_name"), "name", "format_string"), own("expressions", "expression", F.lit(None).cast("string"), "name", "body"))
    return all_formulas(spark, sf).unionByName(more).filter("expression is not null")


def _blank(column: str) -> Column:
    return F.trim(F.coalesce(column, F.lit(""))) == ""


def _empty(column: str) -> Column:
    return F.coalesce(column, F.lit("")) == ""


#: fixed values: functions that aggregate
_AGGREGATION = r"(?i)\b(SUM|AVERAGE|COUNT|COUNTROWS|MIN|MAX|SUMX|AVERAGEX|COUNTX|MAXX|MINX)\s*\("
#: closed strings and comments of a formula
_QUOTED = r'"(?:[^"]|"")*"|//[^\n]*|/\*[\s\S]*?\*/'


def _formula_rules(there: Column) -> list[Rule]:
    e = F.when(there, _c("expression"))
    bare = F.when(e.contains("/"), F.regexp_replace(e, _QUOTED, ""))
    year = F.regexp_extract(e, r"\b(20[2-9]\d)\b", 1)
    return [
        ("dax", "warning", "dax_use_divide_function", bare.rlike(r"[\w)\]]\s*/") & ~e.rlike("(?i)DIVIDE")),
        ("dax", "warning", "dax_iferror_to_iserror", e.rlike(r"(?i)\bIFERROR\s*\(")),
        ("dax", "info", "dax_nested_calculate", F.regexp_count(e, F.lit(r"(?i)\bCALCULATE\s*\(")) > 2),
        ("dax", "info", "dax_use_selectedvalue", e.rlike(r"(?i)\bIF\s*\(\s*HASONEVALUE\s*\(")),
        ("dax", "info", "dax_treatas_over_intersect", e.rlike(r"(?i)\bINTERSECT\s*\(") & e.rlike(r"(?i)\bFILTER\s*\(")),
        ("dax", "info", "dax_values_in_calculate", e.rlike(r"(?is)\bCALCULATE\s*\(.*\bVALUES\s*\(")),
        ("dax", "info", "dax_hardcoded_year", F.when(year != "", year.cast("int")).between(2020, 2030)),
    ]


def _column_rules() -> list[Rule]:
    kind, name, fmt = _c("data_type"), _c("column_name"), _c("format_string")
    return [
        ("structural", "warning", "missing_lineage_tag", _empty("tag")),
        ("performance", "warning", "perf_avoid_float_columns", (kind == "double") & ~_c("is_calculated")),
        ("performance", "warning", "perf_calc_column_with_aggregation", _c("is_calculated") & _c("expression").rlike(_AGGREGATION)),
        ("performance", "warning", "perf_summarize_id_column", (_c("summarize_by") == "sum") & name.rlike("(?i)(ID|Key|Code|Num)$")),
        ("formatting", "info", "fmt_integer_decimal_format", (kind == "int64") & fmt.rlike(r"\.0+")),
        ("formatting", "info", "fmt_currency_without_symbol", (kind == "double") & name.rlike("(?i)(amount|price|cost|revenue|sales|total)") & (fmt != "") & ~fmt.rlike("(?i)[$€£¥]|currency")),
        ("naming", "warning", "name_whitespace", name != F.trim(name)),
        ("error", "warning", "err_missing_data_type", _empty("data_type")),
        *_formula_rules(_c("is_calculated")),
    ]


def _measure_rules() -> list[Rule]:
    name, fmt, e = _c("name"), _c("format_string"), _c("expression")
    return [
        ("structural", "warning", "missing_lineage_tag", _empty("tag")),
        ("formatting", "info", "fmt_missing_format_string", _empty("format_string") & ~_c("is_hidden")),
        ("formatting", "warning", "fmt_percentage_mismatch", name.rlike("(?i)(percent|pct|%|ratio)") & (fmt != "") & ~fmt.contains("%")),
        ("formatting", "warning", "fmt_svg_missing_image_url", e.rlike(r"(?i)data:image/svg\+xml") & ~_c("data_category").eqNullSafe("ImageUrl")),
        ("maintenance", "info", "maint_missing_measure_description", ~_c("is_hidden") & _empty("description")),
        ("naming", "warning", "name_whitespace", name != F.trim(name)),
        ("naming", "warning", "name_special_characters", name.rlike("[<>{}|&~`^]")),
        ("error", "info", "err_userelationship_check", e.rlike(r"(?i)\bUSERELATIONSHIP\s*\(")),
        ("error", "error", "err_empty_measure_expression", _blank("expression")),
        *_formula_rules(F.lit(True)),
    ]


def _item_rules() -> list[Rule]:
    return [
        ("structural", "error", "calc_item_missing_name", F.trim("name") == ""),
        ("structural", "error", "calc_item_missing_expression", _blank("expression")),
        *_formula_rules(F.lit(True)),
    ]


_TABLE, _GROUP, _LOADED, _UNTAGGED, _REF, _COLUMN, _VISIBLE, _NAME, _ORDINAL, _ITEM, _MEASURE, _LINKED = (1 << k for k in range(12))


def _by_table(t: DataFrame, cols: DataFrame, rels: DataFrame, items: DataFrame, m: DataFrame, refs: DataFrame) -> DataFrame:
    """project_id, table_name, bits (what there is of that name), n (its columns); one shuffle of partial aggregates."""

    def part(df: DataFrame, always: int, bits: dict[int, Column] | None = None, table: str = "table_name", n: int = 0) -> DataFrame:
        every = [F.when(cond, bit).otherwise(0) for bit, cond in (bits or {}).items()]
        return df.select("project_id", _c(table).alias("table_name"), reduce(Column.__add__, every, F.lit(always)).alias("bits"), F.lit(n).alias("n"))

    source, kind = _c("source_column"), _c("data_type")
    return together(
        part(t, _TABLE, {_GROUP: _c("is_group"), _LOADED: _c("source") != "calculated", _UNTAGGED: _empty("tag")}),
        part(cols, _COLUMN, {_VISIBLE: ~F.coalesce("is_hidden", F.lit(False)), _NAME: (source == "Name") & (kind == "string"), _ORDINAL: (source == "Ordinal") & (kind == "int64")}, n=1),
        part(rels, _LINKED, table="from_table"), part(rels, _LINKED, table="to_table"),
        part(items, _ITEM), part(m, _MEASURE), part(refs.filter("coalesce(kind, 'table') = 'table'"), _REF, table="ref"),
    ).groupBy("project_id", "table_name").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))


def _table_rules() -> list[Rule]:
    has = lambda bit: _c("bits").bitwiseAND(bit) != 0
    group, plain = has(_TABLE) & has(_GROUP), has(_TABLE) & ~has(_GROUP)
    name = _c("table_name")
    return [
        ("structural", "error", "calc_group_missing_ref_table", group & ~has(_REF)),
        ("structural", "error", "calc_group_missing_name_column", group & ~has(_NAME)),
        ("structural", "error", "calc_group_missing_ordinal_column", group & ~has(_ORDINAL)),
        ("structural", "error", "orphaned_table_ref", has(_REF) & ~has(_TABLE)),
        ("structural", "warning", "missing_lineage_tag", has(_UNTAGGED)),
        ("performance", "warning", "perf_too_many_columns", _c("n") > 100),
        ("maintenance", "info", "maint_unconnected_table", plain & has(_LOADED) & has(_COLUMN) & ~has(_LINKED)),
        ("maintenance", "warning", "maint_empty_calc_group", group & ~has(_ITEM)),
        ("maintenance", "info", "maint_fully_hidden_table", plain & has(_COLUMN) & ~has(_VISIBLE) & ~has(_MEASURE)),
        ("naming", "warning", "name_whitespace", has(_TABLE) & (name != F.trim(name))),
    ]


def _by_project(p: DataFrame, t: DataFrame, rels: DataFrame, m: DataFrame) -> DataFrame:
    """project_id and the counts that rules on whole models need."""
    counts = {"discouraging": (p, _c("discourages")), "n_tables": (t, F.lit(True)), "groups": (t, _c("is_group")), "idle": (rels, ~_c("is_active")), "shown": (m, ~_c("is_hidden")), "unfiled": (m, ~_c("is_hidden") & _empty("display_folder"))}
    of = lambda df: df.select("project_id", *((cond if own is df else F.lit(False)).alias(n) for n, (own, cond) in counts.items()))
    return together(*map(of, (p, t, rels, m))).groupBy("project_id").agg(*(F.count_if(n).alias(n) for n in counts))


def _project_rules() -> list[Rule]:
    return [
        ("structural", "error", "calc_group_missing_discourage_implicit", (_c("groups") > 0) & (_c("discouraging") == 0)),
        ("performance", "info", "perf_many_inactive_relationships", _c("idle") > 5),
        ("performance", "info", "perf_many_tables", _c("n_tables") > 30),
        ("maintenance", "info", "maint_measures_without_folders", (_c("shown") >= 10) & (_c("unfiled") > 5)),
    ]


#: names of columns that may be broadcast
_FEW = 10_000


def relationship_ends(rels: DataFrame, names: DataFrame, cols: DataFrame) -> DataFrame:
    """Relationships with, for both ends, whether the table is there (from_t, to_t), the column (from_c, to_c) and its type."""
    place = ["project_id", "table_name", "column_name"]
    ends = written(together(*(rels.select("project_id", _c(f"{side}_table").alias("table_name"), _c(f"{side}_column").alias("column_name")) for side in ("from", "to"))).distinct())
    names_of = ends.select("column_name").distinct()
    if names_of.limit(_FEW + 1).count() <= _FEW:  # then most columns are left out where they are
        cols = cols.join(F.broadcast(names_of), "column_name", "left_semi")
    # a minimum of texts sorts its rows, so that only columns at an end are left for it
    known = written(cols.join(ends, place, "left_semi").groupBy(*place).agg(F.lit(True).alias("c"), F.min(F.when(_c("data_type") != "", _c("data_type"))).alias("type")))
    for side in ("from", "to"):
        table, column = f"{side}_table", f"{side}_column"
        rels = rels.join(names.select("project_id", _c("table_name").alias(table), F.lit(True).alias(f"{side}_t")), ["project_id", table], "left")
        rels = rels.join(known.select("project_id", _c("table_name").alias(table), _c("column_name").alias(column), _c("c").alias(f"{side}_c"), _c("type").alias(f"{side}_type")), ["project_id", table, column], "left")
    return rels


def _relationship_rules() -> list[Rule]:
    return [
        ("performance", "warning", "perf_many_to_many_relationship", (F.coalesce("from_card", F.lit("many")) == "many") & (_c("to_card") == "many")),
        ("performance", "warning", "perf_bidirectional_crossfilter", _c("cross_filter") == "bothDirections"),
    ]


def _end_rules() -> list[Rule]:
    missing = lambda side: ("structural", "error", f"relationship_missing_{side}_table", _c(f"{side}_t").isNull())
    invalid = lambda side: ("structural", "error", f"relationship_invalid_{side}_column", _c(f"{side}_t").isNotNull() & _c(f"{side}_c").isNull())
    return [rule(side) for side in ("from", "to") for rule in (missing, invalid)] + [("error", "warning", "err_relationship_type_mismatch", _c("from_type") != _c("to_type"))]


#: nodes are project, kind, table and name in one text; of a table's calculated columns one that uses a measure needs all, by way of a node of the table
_NODE = "concat(cast({p} as string), '|{k}|', {t}, '|', {n})"


def _node(kind: str, table: str | Column, name: str | Column) -> Column:
    return F.concat(_c("project_id").cast("string"), F.lit(f"|{kind}|"), table, F.lit("|"), name)


def formula_edges(cols: DataFrame, formulas: DataFrame) -> DataFrame:
    """src, dst of all that a measure or column needs to be computed and that needs something itself: columns and measures its formula names, the column it is sorted by.

    Brackets with a table name a column of it, else a measure; brackets alone name the project's measures of that name, else a column of the own table. A
    measure used in a calculated column needs every calculated column of that column's table. What only names itself counts for columns, not for measures.
    Columns that are neither calculated nor sorted by another need nothing and lie on no cycle; all columns are looked at only where one hides a measure.
    """
    place = ["project_id", "table_name", "name"]
    m = written(formulas.select(*place).distinct())
    own = written(cols.filter("is_calculated or sort_by is not null").select("project_id", "table_name", _c("column_name").alias("name"), "is_calculated", "expression", "sort_by"))
    needy = written(own.groupBy(*place).agg(F.max("is_calculated").alias("calculated")))
    texts = together(formulas.select("project_id", F.lit("measure").alias("kind"), "table_name", "name", "expression"), own.filter("is_calculated").select("project_id", F.lit("column").alias("kind"), "table_name", "name", "expression"))
    refs = named(texts.filter("contains(expression, '[')")).select("project_id", "kind", "own_table", "own_name", F.coalesce("table_name", "own_table").alias("table_name"), _c("column_name").alias("name"), _c("table_name").isNull().alias("bare"))
    refs = written(refs)
    src = F.concat(_c("project_id").cast("string"), F.lit("|"), "kind", F.lit("|"), "own_table", F.lit("|"), "own_name").alias("src")
    # what is there of the name in the table, its own where brackets are alone: for all references in one join
    there = together(needy.select(*place, F.lit(1).alias("there")), m.select(*place, F.lit(2).alias("there"))).groupBy(*place).agg(F.bit_or("there").alias("there"))
    met = written(refs.join(there, place))
    of_table = written(met.filter("not bare and there >= 2"))
    hidden = cols.select("project_id", "table_name", _c("column_name").alias("name")).join(of_table.select(*place).distinct(), place, "left_semi")
    ends = ["project_id", "kind", "own_table", "own_name", "table_name", "name"]
    to_measure = together(of_table.join(hidden, place, "left_anti").select(*ends), refs.filter("bare").drop("table_name").join(m, ["project_id", "name"]).select(*ends))
    to_measure = written(to_measure.select("project_id", "kind", "own_table", src, _node("measure", "table_name", "name").alias("dst")).filter("dst is not null"))
    column = met.filter("there % 2 = 1")
    inner = column.filter("bare").join(m, ["project_id", "name"], "left_anti")
    to_column = together(column.filter("not bare").select(*ends), inner.select(*ends)).select(src, _node("column", "table_name", "name").alias("dst"))
    turning = to_measure.filter("kind = 'column'")
    turn = turning.select("src", _node("table", "own_table", F.lit("")).alias("dst"))
    inside = needy.filter("calculated").join(turning.select("project_id", _c("own_table").alias("table_name")).distinct(), ["project_id", "table_name"], "left_semi")
    inside = inside.select(_node("table", "table_name", F.lit("")).alias("src"), _node("column", "table_name", "name").alias("dst"))
    sort = own.filter("sort_by is not null").select("project_id", "table_name", _c("name").alias("by"), _c("sort_by").alias("name")).join(needy, place, "left_semi")
    sort = sort.select(_node("column", "table_name", "by").alias("src"), _node("column", "table_name", "name").alias("dst"))
    itself = (_c("src") == _c("dst")) & _c("src").contains("|measure|")
    return together(to_measure.select("src", "dst"), to_column, turn, inside, sort).filter(~itself).distinct()


def circular(cols: DataFrame, formulas: DataFrame) -> DataFrame:
    """project_id, kind, table_name, name, component of measures and columns on a cycle; component is its smallest member.

    A table's node is no member; with a single column beside it there is no cycle, as a column may use a measure of its own table.
    """
    e = written(formula_edges(cols, formulas))
    found = components(e).filter("name not like '%|table|%'")
    alone = found.groupBy("component").agg(F.count("*").alias("n"), F.min("name").alias("least"))
    itself = e.filter("src = dst").select(_c("src").alias("name"), F.lit(True).alias("itself"))
    kept = found.join(alone, "component").join(itself, "name", "left").filter("n > 1 or itself")
    part = F.split("name", r"\|")
    return kept.select(part[0].cast("long").alias("project_id"), part[1].alias("kind"), part[2].alias("table_name"), part[3].alias("name"), _c("least").alias("component"))


_CYCLES = f"""known as (select project_id, table_name, column_name, bool_or(is_calculated) as calculated from columns group by 1, 2, 3), ms as (select distinct project_id, table_name, name from formulas),
  qr as (select q.project_id, q.kind, own_table, {_NODE.format(p='q.project_id', k="' || q.kind || '", t='own_table', n='own_name')} as src, case when k.column_name is not null then {_NODE.format(p='q.project_id', k='column', t='q.table_name', n='q.column_name')} when ms.name is not null then {_NODE.format(p='q.project_id', k='measure', t='q.table_name', n='q.column_name')} end as dst,
    k.column_name is null and ms.name is not null as to_measure from qualified q left join known k on k.project_id = q.project_id and k.table_name = q.table_name and k.column_name = q.column_name left join ms on ms.project_id = q.project_id and ms.table_name = q.table_name and ms.name = q.column_name where q.kind <> 'item'),
  br as (select q.project_id, q.kind, own_table, {_NODE.format(p='q.project_id', k="' || q.kind || '", t='own_table', n='own_name')} as src, case when ms.name is not null then {_NODE.format(p='q.project_id', k='measure', t='ms.table_name', n='q.column_name')} when k.column_name is not null then {_NODE.format(p='q.project_id', k='column', t='own_table', n='q.column_name')} end as dst,
    ms.name is not null as to_measure from bare q left join ms on ms.project_id = q.project_id and ms.name = q.column_name left join known k on k.project_id = q.project_id and k.table_name = own_table and k.column_name = q.column_name where q.kind <> 'item'),
  named as (select * from qr union all select * from br),
  edge as (select distinct src, dst from (select src, dst from named union all select src, {_NODE.format(p='project_id', k='table', t='own_table', n="''")} from named where kind = 'column' and to_measure and dst is not null
    union all select {_NODE.format(p='project_id', k='table', t='table_name', n="''")}, {_NODE.format(p='project_id', k='column', t='table_name', n='column_name')} from known where calculated
    union all select {_NODE.format(p='c.project_id', k='column', t='c.table_name', n='c.column_name')}, {_NODE.format(p='c.project_id', k='column', t='c.table_name', n='c.sort_by')} from columns c join known k on k.project_id = c.project_id and k.table_name = c.table_name and k.column_name = c.sort_by)
    where dst is not null and not (src = dst and contains(src, '|measure|'))),
  walk as (select src, dst from edge union select walk.src, edge.dst from walk join edge on edge.src = walk.dst),
  ring as (select a.src as name, min(a.dst) filter (not contains(a.dst, '|table|')) as component, count(distinct a.dst) filter (not contains(a.dst, '|table|')) as n from walk a join walk b on b.src = a.dst and b.dst = a.src where not contains(a.src, '|table|') group by 1),
  circular as (select split_part(name, '|', 1)::bigint as project_id, split_part(name, '|', 2) as kind, split_part(name, '|', 3) as table_name, split_part(name, '|', 4) as name, component from ring where n > 1 or exists (select 1 from edge where src = dst and src = ring.name))"""


@query(f"with recursive {_REFS}, {_CYCLES} select * from circular")
def formula_cycles(spark, sf):
    return circular(dealt(spark, sf, "columns"), dealt(spark, sf, "formulas"))


def repeated_tags(t: DataFrame, c: DataFrame, m: DataFrame, f: DataFrame) -> DataFrame:
    """Every holder of a lineage tag but the first (tables, then columns, measures, functions)."""
    holders = ((t, _c("table_name"), _c("pos")), (c, _member(name="column_name"), _c("pos")), (m, _member(), _c("pos")), (f, _c("name"), F.lit(0)))
    tagged = together(*(df.filter("tag <> ''").select("project_id", entity.alias("entity"), "tag", F.lit(kind).alias("kind"), pos.cast("long").alias("pos")) for kind, (df, entity, pos) in enumerate(holders)))
    # the minimum of each kind is a number: that of a pair would have all rows sorted
    least = [F.min(F.when(_c("kind") == kind, _c("pos"))) for kind in range(len(holders))]
    first = tagged.groupBy("project_id", "tag").agg(F.count("*").alias("n"), *(x.alias(f"p{kind}") for kind, x in enumerate(least))).filter("n > 1")
    lead = F.coalesce(*(F.when(_c(f"p{kind}").isNotNull(), F.struct(F.lit(kind).alias("kind"), _c(f"p{kind}").alias("pos"))) for kind in range(len(holders))))
    # few tags have several holders, so that no holder is sorted for them
    return tagged.join(first.select("project_id", "tag", lead.alias("first")).hint("shuffle_hash"), ["project_id", "tag"]).filter(F.struct("kind", "pos") > _c("first"))


#: categories of rules
CATEGORIES = ("structural", "performance", "dax", "formatting", "maintenance", "naming", "error")
#: their severities, worst first
SEVERITIES = ("error", "warning", "info")


def lint(spark, sf, categories: tuple[str, ...] = CATEGORIES, totals: bool = False, severities: tuple[str, ...] = SEVERITIES) -> DataFrame:
    """All findings of the categories and severities asked for, in one pass over each kind of object and, for cycles, over the references between them.

    With totals their number by project and rule, so that no row is made, sent and counted for each finding.
    """
    p, refs, rels, f = (fleet(spark, sf, n) for n in ("projects", "refs", "relationships", "functions"))
    t, cols, m, items = fleet(spark, sf, "tables"), *(dealt(spark, sf, n) for n in ("columns", "formulas", "items"))
    if len(categories) > 1:
        t, cols, m, rels = map(written, (t, cols, m, rels))

    def hits(df: DataFrame, entity: Column, rules: list[Rule]) -> list[DataFrame]:
        return counted(df, rules, categories, severities) if totals else flagged(df, entity, [r for r in rules if r[1] in severities], categories)

    def found(category: str, severity: str, rule: str, make, entity: Column) -> list[DataFrame]:
        """Findings that are rows already; they are made only where asked for."""
        return hits(make(), entity, [(category, severity, rule, F.lit(True))]) if category in categories and severity in severities else []

    return together(
        *hits(cols, _member(name="column_name"), _column_rules()),
        *hits(m, _member(), _measure_rules()),
        *hits(items, _member(), _item_rules()),
        *hits(f, _c("name"), [("structural", "warning", "missing_lineage_tag", _empty("tag"))]),
        *hits(_by_table(t, cols, rels, items, m, refs), _c("table_name"), _table_rules()),
        *hits(_by_project(p, t, rels, m), F.lit("model"), _project_rules()),
        *hits(rels, _c("name"), _relationship_rules()),
        *hits(relationship_ends(rels, t.select("project_id", "table_name").distinct(), cols), _c("name"), _end_rules()),
        *found("structural", "error", "duplicate_lineage_tag", lambda: repeated_tags(t, cols, m, f), _c("entity")),
        *found("maintenance", "warning", "maint_duplicate_measure_name", lambda: m.groupBy("project_id", "name").agg(F.count_distinct("table_name").alias("n")).filter("n > 1"), _c("name")),
        *found("error", "error", "err_circular_dependency", lambda: circular(cols, m), _member()),
    )


_EV = """every as (select project_id, table_name as entity, tag, 0 as k, pos from tables union all select project_id, table_name || '.' || column_name, tag, 1, pos from columns
  union all select project_id, table_name || '.' || name, tag, 2, pos from formulas union all select project_id, name, tag, 3, 0 from functions),
  ranked as (select *, rank() over (partition by project_id, tag order by k, pos) as r from every where tag <> '')"""
_TREFS = "(select project_id, ref from refs where coalesce(kind, 'table') = 'table')"


def _end_sql(side: str) -> str:
    there = f"(project_id, {side}_table) in (select (project_id, table_name) from tables)"
    return f"""select project_id, 'error', 'relationship_missing_{side}_table', name from relationships where not {there}
  union all select project_id, 'error', 'relationship_invalid_{side}_column', name from relationships where {there} and (project_id, {side}_table, {side}_column) not in (select (project_id, table_name, column_name) from columns)"""


_STRUCTURAL = f"""select project_id, 'error' as severity, 'calc_group_missing_discourage_implicit' as rule, 'model' as entity from (select distinct project_id from tables where is_group) where project_id not in (select project_id from projects where discourages)
  union all select project_id, 'error', 'calc_group_missing_ref_table', table_name from tables where is_group and (project_id, table_name) not in (select (project_id, ref) from {_TREFS})
  union all select project_id, 'error', 'calc_group_missing_name_column', table_name from tables where is_group and (project_id, table_name) not in (select (project_id, table_name) from columns where source_column = 'Name' and data_type = 'string')
  union all select project_id, 'error', 'calc_group_missing_ordinal_column', table_name from tables where is_group and (project_id, table_name) not in (select (project_id, table_name) from columns where source_column = 'Ordinal' and data_type = 'int64')
  union all select project_id, 'error', 'calc_item_missing_name', table_name || '.' || name from items where trim(name) = ''
  union all select project_id, 'error', 'calc_item_missing_expression', table_name || '.' || name from items where trim(coalesce(expression, '')) = ''
  union all select project_id, 'error', 'orphaned_table_ref', ref from {_TREFS} where (project_id, ref) not in (select (project_id, table_name) from tables)
  union all {_end_sql('from')} union all {_end_sql('to')}
  union all select project_id, 'warning', 'missing_lineage_tag', entity from every where coalesce(tag, '') = ''
  union all select project_id, 'error', 'duplicate_lineage_tag', entity from ranked where r > 1"""
_S_TABLES = fleet_sql("projects", "tables", "refs", "columns", "relationships", "formulas", "items", "functions") + ", " + _EV


@query(f"with {_S_TABLES} {_STRUCTURAL}")
def lint_structural(spark, sf):
    return lint(spark, sf, ("structural",)).drop("category")


_PERFORMANCE = """select project_id, 'warning' as severity, 'perf_avoid_float_columns' as rule, table_name || '.' || column_name as entity from columns where data_type = 'double' and not is_calculated
  union all select project_id, 'warning', 'perf_calc_column_with_aggregation', table_name || '.' || column_name from columns where is_calculated and regexp_matches(expression, '(?i)\\b(SUM|AVERAGE|COUNT|COUNTROWS|MIN|MAX|SUMX|AVERAGEX|COUNTX|MAXX|MINX)\\s*\\(')
  union all select project_id, 'warning', 'perf_summarize_id_column', table_name || '.' || column_name from columns where summarize_by = 'sum' and regexp_matches(column_name, '(?i)(ID|Key|Code|Num)$')
  union all select project_id, 'warning', 'perf_many_to_many_relationship', name from relationships where coalesce(from_card, 'many') = 'many' and to_card = 'many'
  union all select project_id, 'warning', 'perf_bidirectional_crossfilter', name from relationships where cross_filter = 'bothDirections'
  union all select project_id, 'warning', 'perf_too_many_columns', table_name from columns group by project_id, table_name having count(*) > 100
  union all select project_id, 'info', 'perf_many_inactive_relationships', 'model' from relationships group by project_id having count_if(not is_active) > 5
  union all select project_id, 'info', 'perf_many_tables', 'model' from tables group by project_id having count(*) > 30"""


@query(f"with {fleet_sql('tables', 'columns', 'relationships')} {_PERFORMANCE}")
def lint_performance(spark, sf):
    return lint(spark, sf, ("performance",)).drop("category")


def _hits(severity: str, rule: str, cond: str) -> str:
    return f"select project_id, '{severity}' as severity, '{rule}' as rule, table_name || '.' || name as entity from texts where {cond}"


_FORMULAS = " union all ".join([
    _hits("warning", "dax_use_divide_function", rf"regexp_matches(regexp_replace(expression, '{_QUOTED}', '', 'g'), '[\w)\]]\s*/') and not regexp_matches(expression, '(?i)divide')"),
    _hits("warning", "dax_iferror_to_iserror", r"regexp_matches(expression, '(?i)\biferror\s*\(')"),
    _hits("info", "dax_nested_calculate", r"len(regexp_extract_all(expression, '(?i)\bcalculate\s*\(')) > 2"),
    _hits("info", "dax_use_selectedvalue", r"regexp_matches(expression, '(?i)\bif\s*\(\s*hasonevalue\s*\(')"),
    _hits("info", "dax_treatas_over_intersect", r"regexp_matches(expression, '(?i)\bintersect\s*\(') and regexp_matches(expression, '(?i)\bfilter\s*\(')"),
    _hits("info", "dax_values_in_calculate", r"regexp_matches(expression, '(?is)\bcalculate\s*\(.*\bvalues\s*\(')"),
    _hits("info", "dax_hardcoded_year", r"try_cast(regexp_extract(expression, '\b(20[2-9]\d)\b', 1) as int) between 2020 and 2030"),
])


@query(f"with {_TEXTS} {_FORMULAS}")
def lint_dax(spark, sf):
    return lint(spark, sf, ("dax",)).drop("category")


_FORMATTING = r"""select project_id, 'info' as severity, 'fmt_missing_format_string' as rule, table_name || '.' || name as entity from formulas where coalesce(format_string, '') = '' and not is_hidden
  union all select project_id, 'warning', 'fmt_percentage_mismatch', table_name || '.' || name from formulas where regexp_matches(name, '(?i)(percent|pct|%|ratio)') and format_string <> '' and not contains(format_string, '%')
  union all select project_id, 'warning', 'fmt_svg_missing_image_url', table_name || '.' || name from formulas where regexp_matches(expression, '(?i)data:image/svg\+xml') and data_category is distinct from 'ImageUrl'
  union all select project_id, 'info', 'fmt_integer_decimal_format', table_name || '.' || column_name from columns where data_type = 'int64' and regexp_matches(format_string, '\.0+')
  union all select project_id, 'info', 'fmt_currency_without_symbol', table_name || '.' || column_name from columns where data_type = 'double' and regexp_matches(column_name, '(?i)(amount|price|cost|revenue|sales|total)') and format_string <> '' and not regexp_matches(format_string, '(?i)[$€£¥]|currency')"""


@query(f"with {fleet_sql('formulas', 'columns')} {_FORMATTING}")
def lint_formatting(spark, sf):
    return lint(spark, sf, ("formatting",)).drop("category")


_MAINTENANCE = """select project_id, 'info' as severity, 'maint_unconnected_table' as rule, table_name as entity from tables where not is_group and source <> 'calculated' and (project_id, table_name) in (select (project_id, table_name) from columns)
    and (project_id, table_name) not in (select (project_id, from_table) from relationships union select (project_id, to_table) from relationships)
  union all select project_id, 'info', 'maint_measures_without_folders', 'model' from formulas where not is_hidden group by project_id having count(*) >= 10 and count_if(coalesce(display_folder, '') = '') > 5
  union all select project_id, 'warning', 'maint_empty_calc_group', table_name from tables where is_group and (project_id, table_name) not in (select (project_id, table_name) from items)
  union all select project_id, 'info', 'maint_missing_measure_description', table_name || '.' || name from formulas where not is_hidden and coalesce(description, '') = ''
  union all select project_id, 'info', 'maint_fully_hidden_table', table_name from tables where not is_group and (project_id, table_name) in (select (project_id, table_name) from columns group by project_id, table_name having bool_and(is_hidden)) and (project_id, table_name) not in (select (project_id, table_name) from formulas)
  union all select project_id, 'warning', 'maint_duplicate_measure_name', name from formulas group by project_id, name having count(distinct table_name) > 1"""


@query(f"with {fleet_sql('tables', 'columns', 'relationships', 'items', 'formulas')} {_MAINTENANCE}")
def lint_maintenance(spark, sf):
    return lint(spark, sf, ("maintenance",)).drop("category")


_NAMING = """select project_id, 'warning' as severity, 'name_whitespace' as rule, table_name as entity from tables where table_name <> trim(table_name)
  union all select project_id, 'warning', 'name_whitespace', table_name || '.' || column_name from columns where column_name <> trim(column_name)
  union all select project_id, 'warning', 'name_whitespace', table_name || '.' || name from formulas where name <> trim(name)
  union all select project_id, 'warning', 'name_special_characters', table_name || '.' || name from formulas where regexp_matches(name, '[<>{}|&~`^]')"""


@query(f"with {fleet_sql('tables', 'columns', 'formulas')} {_NAMING}")
def lint_naming(spark, sf):
    return lint(spark, sf, ("naming",)).drop("category")


_ERRORS = r"""select project_id, 'warning' as severity, 'err_missing_data_type' as rule, table_name || '.' || column_name as entity from columns where coalesce(data_type, '') = ''
  union all select r.project_id, 'warning', 'err_relationship_type_mismatch', r.name from relationships r join columns a on a.project_id = r.project_id and a.table_name = from_table and a.column_name = from_column
    join columns b on b.project_id = r.project_id and b.table_name = to_table and b.column_name = to_column where a.data_type <> b.data_type and a.data_type <> '' and b.data_type <> ''
  union all select project_id, 'info', 'err_userelationship_check', table_name || '.' || name from formulas where regexp_matches(expression, '(?i)\buserelationship\s*\(')
  union all select project_id, 'error', 'err_empty_measure_expression', table_name || '.' || name from formulas where trim(coalesce(expression, '')) = ''
  union all select project_id, 'error', 'err_circular_dependency', table_name || '.' || name from circular"""


@query(f"with recursive {_REFS}, {fleet_sql('relationships')}, {_CYCLES} {_ERRORS}")
def lint_errors(spark, sf):
    return lint(spark, sf, ("error",)).drop("category")


_ALL = f"""recursive {_REFS}, {fleet_sql('projects', 'tables', 'refs', 'relationships', 'functions')}, {_EV}, {_CYCLES},
  f as (select *, 'structural' as category from ({_STRUCTURAL}) union all select *, 'performance' from ({_PERFORMANCE}) union all select *, 'dax' from ({_FORMULAS}) union all select *, 'formatting' from ({_FORMATTING})
  union all select *, 'maintenance' from ({_MAINTENANCE}) union all select *, 'naming' from ({_NAMING}) union all select *, 'error' from ({_ERRORS}))"""


@query(f"with {_ALL} select project_id, count(*) as findings, count_if(severity = 'error') as errors, count_if(severity = 'warning') as warnings, count_if(severity = 'info') as infos, count(distinct rule) as rules, count_if(severity = 'error') = 0 as is_valid from f group by 1")
def lint_summary(spark, sf):
    """Totals by project; is_valid is taken over all findings, before any filter on severity."""
    n = lambda s: F.sum(F.when(_c("severity") == s, _c("findings")).otherwise(0))
    return lint(spark, sf, totals=True).groupBy("project_id").agg(F.sum("findings").alias("findings"), n("error").alias("errors"), n("warning").alias("warnings"), n("info").alias("infos"), F.count_distinct("rule").alias("rules"), (n("error") == 0).alias("is_valid"))


@query(f"with {_ALL} select category, rule, severity, count(*) as findings, count(distinct project_id) as projects from f where severity in ('error', 'warning') group by 1, 2, 3")
def lint_by_rule(spark, sf):
    """Findings of at least the severity of a warning, by rule."""
    return lint(spark, sf, totals=True, severities=("error", "warning")).groupBy("category", "rule", "severity").agg(F.sum("findings").alias("findings"), F.count_distinct("project_id").alias("projects"))
