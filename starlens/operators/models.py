"""Whole models at once: listings of all objects, dictionaries, hidden columns by role; definition texts written and read again; samples and further measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.fleet import fleet, fleet_sql
from ..sources.frames import lake, spread
from ..sources.projects import bindings, members, outline, report_info
from .rules import together

_c = F.col
QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def model_objects(spark, sf, tables: DataFrame | None = None) -> DataFrame:
    """project_id, kind, table_name, name, detail of tables, columns, measures, relationships and roles.

    `tables` (table_name) restricts all kinds but roles, which belong to no table; a relationship counts for the table it starts from.
    """
    row = lambda name, kind, table, own, detail: fleet(spark, sf, name).select("project_id", F.lit(kind).alias("kind"), _c(table).alias("table_name"), _c(own).alias("name"), _c(detail).alias("detail"))
    kept = together(
        row("tables", "table", "table_name", "table_name", "mode"), row("columns", "column", "table_name", "column_name", "data_type"), row("formulas", "measure", "table_name", "name", "expression"),
        row("relationships", "relationship", "from_table", "name", "to_table"),
    )
    if tables is not None:
        kept = kept.join(tables.select("table_name"), "table_name", "left_semi").select(kept.columns)
    roles = fleet(spark, sf, "roles").select("project_id", F.lit("role").alias("kind"), F.lit(None).cast("string").alias("table_name"), _c("role").alias("name"), _c("permission").alias("detail"))
    return kept.unionByName(roles)


_OBJECTS = fleet_sql("tables", "columns", "formulas", "relationships", "roles") + """, kept as (select project_id, 'table' as kind, table_name, table_name as name, mode as detail from tables
  union all select project_id, 'column', table_name, column_name, data_type from columns union all select project_id, 'measure', table_name, name, expression from formulas
  union all select project_id, 'relationship', from_table, name, to_table from relationships),
  objects as (select * from kept union all select project_id, 'role', null, role, permission from roles)"""


@query(f"with {_OBJECTS} select * from objects")
def model_schema(spark, sf):
    return model_objects(spark, sf)


@query(f"with {_OBJECTS} select project_id, kind, count(*) as n from (select * from kept where table_name in (select table_name from tables where is_hidden) union all select * from objects where kind = 'role') group by 1, 2")
def model_schema_counts(spark, sf):
    """Objects of hidden tables by kind: the list of tables is itself a table."""
    hidden = fleet(spark, sf, "tables").filter("is_hidden").select("table_name").distinct()
    return model_objects(spark, sf, hidden).groupBy("project_id", "kind").agg(F.count("*").alias("n"))


@query(f"""with {fleet_sql('tables', 'columns', 'formulas', 'relationships', 'items', 'functions')},
  l as (select project_id, table_name, 0 as section, '' as name, '## ' || table_name as line from tables union all select project_id, table_name, 1, column_name, '| ' || column_name || ' | ' || coalesce(nullif(data_type, ''), 'unknown') || ' |' from columns
  union all select project_id, table_name, 2, name, '- [' || name || '] ' || coalesce(description, '') from formulas
  union all select project_id, from_table, 3, name, from_table || '.' || from_column || ' -> ' || to_table || '.' || to_column || ' (' || coalesce(from_card, 'many') || '-to-' || coalesce(to_card, 'one') || ')' from relationships)
  select l.* from l where (project_id, table_name) in (select (project_id, table_name) from tables)
  union all select project_id, table_name, 4, name, '- item ' || ordinal || ': ' || name from items where (project_id, table_name) in (select (project_id, table_name) from tables) union all select project_id, null, 5, name, '- ' || name || '(' || params || ')' from functions""")
def data_dictionary(spark, sf, table: str | None = None):
    """The dictionary's text of every table as lines: written in the order of project, table, section and name they are its document. With `table`, of the tables of that name alone, else with the functions, which belong to none."""
    line = lambda name, table, section, own, text: fleet(spark, sf, name).select("project_id", _c(table).alias("table_name"), F.lit(section).alias("section"), own.alias("name"), text.alias("line"))
    lit = F.lit
    ends = F.concat("from_table", lit("."), "from_column", lit(" -> "), "to_table", lit("."), "to_column", lit(" ("), F.coalesce("from_card", lit("many")), lit("-to-"), F.coalesce("to_card", lit("one")), lit(")"))
    lines = together(
        line("tables", "table_name", 0, lit(""), F.concat(lit("## "), "table_name")), line("columns", "table_name", 1, _c("column_name"), F.concat(lit("| "), "column_name", lit(" | "), F.coalesce(F.nullif("data_type", lit("")), lit("unknown")), lit(" |"))),
        line("formulas", "table_name", 2, _c("name"), F.concat(lit("- ["), "name", lit("] "), F.coalesce("description", lit("")))), line("relationships", "from_table", 3, _c("name"), ends),
        line("items", "table_name", 4, _c("name"), F.concat(lit("- item "), _c("ordinal").cast("string"), lit(": "), "name")),
    )
    kept = fleet(spark, sf, "tables").select("project_id", "table_name")
    out = lines.join(kept if table is None else kept.filter(_c("table_name") == table), ["project_id", "table_name"], "left_semi").select("project_id", "table_name", "section", "name", "line")
    if table is not None:
        return out
    return out.unionByName(fleet(spark, sf, "functions").select("project_id", lit(None).cast("string").alias("table_name"), lit(5).alias("section"), "name", F.concat(lit("- "), "name", lit("("), "params", lit(")")).alias("line")))


@query(f"with {fleet_sql('tables', 'columns')} select project_id, table_name, 0 as section, '## ' || table_name as line from tables where table_name = 'T65' union all select project_id, table_name, 1, '| ' || column_name || ' | ' || coalesce(nullif(data_type, ''), 'unknown') || ' |' from columns where table_name = 'T65'")
def table_dictionary(spark, sf):
    """One table's heading and columns."""
    return data_dictionary(spark, sf, "T65").filter("section < 2").drop("name")


@query(f"""with {fleet_sql('columns', 'relationships')}, k as (select project_id, table_name, column_name, min(data_type) as t from columns group by 1, 2, 3)
  select project_id, name, a.t as from_type, b.t as to_type from relationships as r join k as a using (project_id) join k as b using (project_id)
  where a.table_name = r.from_table and a.column_name = r.from_column and b.table_name = r.to_table and b.column_name = r.to_column and a.t <> b.t""")
def lint_key_types(spark, sf):
    """Relationships whose ends have different data types, with both types."""
    k = fleet(spark, sf, "columns").groupBy("project_id", "table_name", "column_name").agg(F.min("data_type").alias("t"))
    end = lambda side: k.select("project_id", _c("table_name").alias(f"{side}_table"), _c("column_name").alias(f"{side}_column"), _c("t").alias(f"{side}_type"))
    r = fleet(spark, sf, "relationships").join(end("from"), ["project_id", "from_table", "from_column"]).join(end("to"), ["project_id", "to_table", "to_column"])
    return r.filter("from_type <> to_type").select("project_id", "name", "from_type", "to_type")


@query(f"""with {fleet_sql('columns', 'role_filters')}, n as (select project_id, table_name, count(*) as n from columns group by 1, 2), a as (select project_id, sum(n)::bigint as total from n group by 1),
  h as (select f.project_id, f.role, sum(coalesce(n, 0))::bigint as hidden from (select distinct project_id, role, table_name from role_filters where metadata = 'none') as f left join n using (project_id, table_name) group by 1, 2)
  select r.project_id, r.role, coalesce(total, 0) - coalesce(hidden, 0) as visible, coalesce(hidden, 0) as hidden from (select distinct project_id, role from role_filters) as r left join a using (project_id) left join h using (project_id, role)""")
def ols_by_role(spark, sf):
    """Columns that each role sees: a table whose metadata a role may not read is gone with all its columns. Counts by table meet the roles, columns never do."""
    n = fleet(spark, sf, "columns").groupBy("project_id", "table_name").agg(F.count("*").alias("n"))
    total = n.groupBy("project_id").agg(F.sum("n").alias("total"))
    f = fleet(spark, sf, "role_filters")
    hidden = f.filter("metadata = 'none'").select("project_id", "role", "table_name").distinct().join(n, ["project_id", "table_name"], "left")
    hidden = hidden.groupBy("project_id", "role").agg(F.sum(F.coalesce("n", F.lit(0))).alias("hidden"))
    r = f.select("project_id", "role").distinct().join(total, "project_id", "left").join(hidden, ["project_id", "role"], "left").na.fill(0, ["total", "hidden"])
    return r.select("project_id", "role", (_c("total") - _c("hidden")).alias("visible"), "hidden")


# Definitions written as texts, one row a file, and read again: the tables that they came from are the expected result.


def _quoted(c: str) -> Column:
    return F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))


@query(f"with {fleet_sql('formulas')} select pos, table_name, name, expression, format_string, is_hidden, description from formulas where trim(expression) <> ''")
def read_outlines(spark, sf):
    lit, f = F.lit, spread(fleet(spark, sf, "formulas").filter("trim(expression) <> ''"), "pos")
    optional = lambda c, head: F.coalesce(F.concat(lit(head), c), lit(""))
    content = F.concat(
        lit("table "), _quoted("table_name"), lit("\n"), optional(_c("description"), "\n\t/// "), lit("\n\tmeasure "), _quoted("name"), lit(" = "), "expression", optional(_c("format_string"), "\n\t\tformatString: "),
        F.when(_c("is_hidden"), "\n\t\tisHidden").otherwise(""), lit("\n"),
    )
    m = members(outline(f.select(_c("pos").cast("string").alias("path"), content.alias("content"))), "measure")
    p = _c("properties")
    hidden = F.coalesce(p["isHidden"], F.lit("false")) == "true"
    return m.select(_c("path").cast("long").alias("pos"), _c("holder").alias("table_name"), "name", "expression", p["formatString"].alias("format_string"), hidden.alias("is_hidden"), "description")


@query("""select p_partkey::varchar as visual_id, 'Measure' as kind, p_brand as entity, p_name as property, 'projection' as place from part
  union all select p_partkey::varchar, 'Column', p_type, 'Size', 'sort' from part where p_size % 2 = 0 union all select p_partkey::varchar, 'Column', p_type, 'Size', 'container' from part where p_size % 3 = 0""")
def read_bindings(spark, sf):
    field = lambda kind, entity, name: F.struct(F.struct(F.struct(F.struct(entity.alias("Entity")).alias("SourceRef")).alias("Expression"), name.alias("Property")).alias(kind))
    column = field("Column", _c("p_type"), F.lit("Size"))
    visual = F.struct(
        F.struct(
            F.struct(F.struct(F.array(F.struct(field("Measure", _c("p_brand"), _c("p_name")).alias("field"))).alias("projections")).alias("Values")).alias("queryState"),
            F.when(_c("p_size") % 2 == 0, F.struct(F.array(F.struct(column.alias("field"))).alias("sort"))).alias("sortDefinition"),
        ).alias("query"),
        F.when(_c("p_size") % 3 == 0, F.struct(F.array(column).alias("title"))).alias("visualContainerObjects"),
    )
    texts = spread(lake(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), "p_partkey").select(_c("p_partkey").cast("string").alias("visual_id"), F.to_json(F.struct(visual.alias("visual"))).alias("t"))
    return bindings(texts.select(F.lit("").alias("path"), F.lit("").alias("page_id"), "visual_id", F.parse_json("t").alias("j"))).select("visual_id", "kind", "entity", "property", "place")


@query("""select o_orderkey::varchar as path, 1::bigint as sources, (1 + o_orderkey % 3)::bigint as datasets, (o_orderkey % 4)::bigint as parameters, (o_orderkey % 4)::bigint as with_default, (case when o_orderkey % 2 = 0 then o_orderkey % 4 else 0 end)::bigint as with_valid,
  1::bigint as sections, (1 + o_orderkey % 5)::bigint as items, (o_orderkey % 5)::bigint as textboxes, o_orderkey % 6 = 0 as has_header, case when o_orderkey % 7 = 0 then '21cm' else '8.5in' end as page_width, '11in' as page_height from orders""")
def read_report_infos(spark, sf):
    lit, k = F.lit, _c("o_orderkey")
    times = lambda text, n: F.repeat(lit(text), n.cast("int"))
    some = lambda cond, text: F.when(cond, text).otherwise("")
    content = F.concat(
        lit('<?xml version="1.0"?><Report xmlns="http://example.org/2010/reportdefinition"><DataSources><DataSource Name="a"/></DataSources><DataSets>'), times('<DataSet Name="d"/>', 1 + k % 3), lit("</DataSets><ReportParameters>"),
        F.when(k % 2 == 0, times("<ReportParameter><DefaultValue><Values/></DefaultValue><ValidValues/></ReportParameter>", k % 4)).otherwise(times("<ReportParameter><DefaultValue/></ReportParameter>", k % 4)),
        lit('</ReportParameters><Body><ReportItems><Tablix Name="t"/>'), times('<Textbox Name="x"/>', k % 5), lit("</ReportItems></Body><Page>"), some(k % 6 == 0, "<PageHeader/>"), some(k % 7 == 0, "<PageWidth>21cm</PageWidth>"), lit("</Page></Report>"),
    )
    return report_info(spread(lake(spark, sf, "orders").select("o_orderkey"), "o_orderkey").select(k.cast("string").alias("path"), content.alias("content")))


# Whole listings and guarded creation


@query(f"""with {fleet_sql('tables', 'columns', 'formulas', 'items')}, c as (select project_id, table_name, count(*) as columns, count_if(is_hidden) as hidden_columns, count_if(is_calculated) as calculated from columns group by 1, 2),
  f as (select project_id, table_name, count(*) as measures from formulas group by 1, 2), i as (select project_id, table_name, count(*) as items from items group by 1, 2)
  select project_id, table_name, coalesce(is_hidden, false) as is_hidden, is_group, coalesce(columns, 0) as columns, coalesce(hidden_columns, 0) as hidden_columns, coalesce(calculated, 0) as calculated, coalesce(measures, 0) as measures, 1 as partitions, coalesce(mode, 'import') as mode,
    case when is_group then coalesce(items, 0) end as items from tables left join c using (project_id, table_name) left join f using (project_id, table_name) left join i using (project_id, table_name)""")
def table_listing(spark, sf):
    """Every table with its columns, measures and partitions counted; calculation groups with their items. Counts come from one aggregation of marks."""
    t = fleet(spark, sf, "tables")
    flags = ("columns", "hidden_columns", "calculated", "measures", "items")

    def marks(name: str, **on: Column) -> DataFrame:
        return fleet(spark, sf, name).select("project_id", "table_name", *(on.get(k, F.lit(False)).alias(k) for k in flags))

    true = F.lit(True)
    all_ = together(marks("columns", columns=true, hidden_columns=_c("is_hidden"), calculated=_c("is_calculated")), marks("formulas", measures=true), marks("items", items=true))
    n = all_.groupBy("project_id", "table_name").agg(*(F.count_if(k).alias(k) for k in flags))
    j = t.join(n, ["project_id", "table_name"], "left").na.fill(0, list(flags))
    return j.select("project_id", "table_name", F.coalesce("is_hidden", F.lit(False)).alias("is_hidden"), "is_group", *flags[:4], F.lit(1).alias("partitions"), F.coalesce("mode", F.lit("import")).alias("mode"), F.when(_c("is_group"), _c("items")).alias("items"))


_NEW_ITEMS = """select s_suppkey - s_suppkey % 64 as project_id, 'T' || cast(s_suppkey - s_suppkey % 16 + case when s_suppkey % 4 = 1 then 5 else 3 end as string) as table_name,
  case when s_suppkey % 7 = 0 then '  ' when s_suppkey % 3 = 0 then 'I' || cast(s_suppkey - s_suppkey % 8 as string) else 'New' || cast(s_suppkey % 5 as string) end as name, s_suppkey as pos from {supplier}"""


@query(f"""with {fleet_sql('tables', 'items')}, b as ({_NEW_ITEMS.format(supplier='supplier')}), g as (select project_id, table_name, bool_or(is_group) as is_group from tables group by 1, 2), h as (select project_id, table_name, max(ordinal) as top from items group by 1, 2),
  s as (select b.*, case when trim(b.name) = '' then 'bad name' when g.table_name is null then 'unknown table' when not g.is_group then 'no calculation group' when (project_id, table_name, b.name) in (select (project_id, table_name, name) from items) then 'exists'
    when row_number() over (partition by project_id, table_name, b.name order by pos) > 1 then 'twice in batch' else 'created' end as outcome, top from b left join g using (project_id, table_name) left join h using (project_id, table_name))
  select pos, outcome, case when outcome = 'created' then coalesce(top, -1) + row_number() over (partition by project_id, table_name, outcome order by pos) end as ordinal from s""")
def bulk_item_guards(spark, sf):
    """New calculation items: reasons for those refused; those created get ordinals after the group's last one, in the batch's order."""
    b = spark.sql(_NEW_ITEMS, supplier=lake(spark, sf, "supplier"))
    key = ["project_id", "table_name"]
    groups = fleet(spark, sf, "tables").groupBy(*key).agg(F.max("is_group").alias("is_group"))
    items = fleet(spark, sf, "items")
    top, there = items.groupBy(*key).agg(F.max("ordinal").alias("top")), items.select(*key, "name").distinct().withColumn("there", F.lit(True))
    j = b.withColumn("k", F.row_number().over(Window.partitionBy(*key, "name").orderBy("pos"))).join(groups, key, "left").join(top, key, "left").join(there, [*key, "name"], "left")
    outcome = F.when(F.trim("name") == "", "bad name").when(_c("is_group").isNull(), "unknown table").when(~_c("is_group"), "no calculation group").when(_c("there"), "exists").when(_c("k") > 1, "twice in batch").otherwise("created")
    made = j.withColumn("outcome", outcome)
    place = F.row_number().over(Window.partitionBy(*key, "outcome").orderBy("pos"))
    return made.select("pos", "outcome", F.when(_c("outcome") == "created", F.coalesce("top", F.lit(-1)) + place).alias("ordinal"))


_NEW_LEVELS = """select c_custkey - c_custkey % 64 as project_id, 'T' || cast(c_custkey as string) as table_name, case when c_custkey % 9 = 0 then '' else 'H' || cast(c_custkey as string) end as hierarchy, pos, case when pos = 0 then 'Key' when pos = 1 then 'Code' when c_custkey % 6 = 0 then 'Nope' else 'Key' end as column_name
  from {customer} lateral view explode(array(0, 1, 2)) as pos where pos < 2 or c_custkey % 3 <> 1"""


@query(f"""with {fleet_sql('tables', 'columns')}, b as (select c_custkey - c_custkey % 64 as project_id, 'T' || c_custkey as table_name, case when c_custkey % 9 = 0 then '' else 'H' || c_custkey end as hierarchy, pos, case when pos = 0 then 'Key' when pos = 1 then 'Code' when c_custkey % 6 = 0 then 'Nope' else 'Key' end as column_name
    from (select *, unnest([0, 1, 2]) as pos from customer) where pos < 2 or c_custkey % 3 <> 1),
  s as (select project_id, table_name, hierarchy, count(*) as levels, count(*) - count(distinct column_name) as repeated, count_if((project_id, table_name, column_name) not in (select (project_id, table_name, column_name) from columns)) as missing, bool_and((project_id, table_name) in (select (project_id, table_name) from tables)) as there from b group by 1, 2, 3)
  select project_id, table_name, levels, case when hierarchy = '' then 'bad name' when not there then 'unknown table' when missing > 0 then 'unknown column' when repeated > 0 then 'column twice' else 'created' end as outcome from s""")
def bulk_hierarchy_guards(spark, sf):
    """New hierarchies by their levels: the table and all columns are there, no column is used twice."""
    b = spark.sql(_NEW_LEVELS, customer=lake(spark, sf, "customer"))
    mark = lambda df, n: df.distinct().withColumn(n, F.lit(True))
    there, known = mark(fleet(spark, sf, "tables").select("project_id", "table_name"), "there"), mark(fleet(spark, sf, "columns").select("project_id", "table_name", "column_name"), "known")
    j = b.join(there, ["project_id", "table_name"], "left").join(known, ["project_id", "table_name", "column_name"], "left")
    g = j.groupBy("project_id", "table_name", "hierarchy").agg(F.count("*").alias("levels"), (F.count("*") - F.count_distinct("column_name")).alias("repeated"), F.count_if(_c("known").isNull()).alias("missing"), F.count_if(_c("there").isNull()).alias("lost"))
    outcome = F.when(_c("hierarchy") == "", "bad name").when(_c("lost") > 0, "unknown table").when(_c("missing") > 0, "unknown column").when(_c("repeated") > 0, "column twice").otherwise("created")
    return g.select("project_id", "table_name", "levels", outcome.alias("outcome"))


@query(f"""with {fleet_sql('columns')}, n as (select o_orderkey as pos, case when o_orderkey % 2 = 0 then '[Key] * 2' end as expression, case when o_orderkey % 4 = 1 then 'Source' end as source_column, case when o_orderkey % 3 = 0 then '0' end as format_string from orders where o_orderkey % 5 = 0)
  select c.pos, column_name, case when n.expression is not null then n.expression when n.source_column is not null then null else c.expression end as expression, case when n.source_column is not null and n.expression is null then n.source_column when n.expression is not null then null else c.source_column end as source_column,
    coalesce(n.format_string, c.format_string) as format_string, case when n.expression is not null then true when n.source_column is not null then false else is_calculated end as is_calculated from columns c left join n on n.pos = c.pos""")
def bulk_update_columns(spark, sf):
    """Columns with only what is given changed; a formula takes the source away and a source the formula, and with them the kind of column."""
    o = lake(spark, sf, "orders").filter("o_orderkey % 5 = 0")
    k = _c("o_orderkey")
    n = o.select(k.alias("pos"), F.when(k % 2 == 0, "[Key] * 2").alias("e"), F.when(k % 4 == 1, "Source").alias("s"), F.when(k % 3 == 0, "0").alias("f"))
    c = fleet(spark, sf, "columns").join(n, "pos", "left")
    e, s = _c("e").isNotNull(), _c("s").isNotNull()
    return c.select(
        "pos", "column_name", F.when(e, _c("e")).when(s, F.lit(None)).otherwise(_c("expression")).alias("expression"), F.when(e, F.lit(None)).when(s, _c("s")).otherwise(_c("source_column")).alias("source_column"),
        F.coalesce("f", "format_string").alias("format_string"), F.when(e, True).when(s, False).otherwise(_c("is_calculated")).alias("is_calculated"),
    )


# Samples and further measures


@query("select o_orderkey, o_totalprice from orders order by md5(o_orderkey::varchar), o_orderkey limit 1000")
def sample_rows(spark, sf):
    """A thousand rows drawn by a hash of their key: the same ones in every run, each task keeps at most a thousand."""
    return lake(spark, sf, "orders").orderBy(F.md5(_c("o_orderkey").cast("string")), "o_orderkey").select("o_orderkey", "o_totalprice").limit(1000)


@query("select event_type, count(distinct user_id) as exact, true as near from events group by 1")
def approx_distinct(spark, sf):
    """Whether the approximate distinct count (relative deviation 1 %) lies within 5 % of the exact one. Both are of distinct pairs: beside a distinct count, a sketch (13 KB) would be kept for each of them."""
    pairs = lake(spark, sf, "events").select("event_type", "user_id").distinct()
    e = pairs.groupBy("event_type").agg(F.count("user_id").alias("exact"), F.approx_count_distinct("user_id", 0.01).alias("about"))
    return e.select("event_type", "exact", (F.abs(_c("about") - _c("exact")) <= F.lit(0.05) * _c("exact")).alias("near"))


@query("select l_orderkey, round(product(1 - l_discount), 9) as kept_share from lineitem group by 1")
def product_measure(spark, sf):
    return lake(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.round(F.product(1 - _c("l_discount")), 9).alias("kept_share"))


@query("""with p as (select distinct o_custkey, o_orderdate::date as d from orders)
  select d, last_day(d) as month_end, (date_trunc('quarter', d) + interval 3 month - interval 1 day)::date as quarter_end, count(*) as customers, (d - date_trunc('month', d)::date + 1)::int as mtd_days, (d - date_trunc('quarter', d)::date + 1)::int as qtd_days, (d - date_trunc('year', d)::date + 1)::int as ytd_days from p group by d""")
def ti_period_sets(spark, sf):
    """Ends of month and quarter, and how many days each set to date holds."""
    p = lake(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d")).groupBy("d").agg(F.count_distinct("o_custkey").alias("customers"))
    days = lambda unit: (F.date_diff("d", F.trunc("d", unit)) + 1)
    return p.select("d", F.last_day("d").alias("month_end"), F.date_sub(F.add_months(F.trunc("d", "quarter"), 3), 1).alias("quarter_end"), "customers", days("month").alias("mtd_days"), days("quarter").alias("qtd_days"), days("year").alias("ytd_days"))


_NEW = "select p_partkey - p_partkey % 64 as project_id, 'T' || cast(p_partkey - p_partkey % 64 + p_partkey // 2 % 70 as string) as table_name, case when p_partkey % 5 = 0 then 'Key' when p_partkey % 5 = 1 then 'M' || cast(p_partkey as string) when p_partkey % 7 = 2 then ' ' else 'N' || cast(p_partkey // 2 as string) end as name, p_partkey as pos from part"


@query(f"""with {fleet_sql('tables', 'columns', 'formulas')}, b as ({_NEW}), s as (select b.*, trim(b.name) = '' as bad, t.table_name is null as orphan, c.column_name is not null as clash, m.name is not null as taken,
  row_number() over (partition by b.project_id, b.table_name, b.name order by b.pos) as k from b left join tables as t using (project_id, table_name)
  left join (select distinct project_id, table_name, column_name from columns) as c on c.project_id = b.project_id and c.table_name = b.table_name and c.column_name = b.name left join (select distinct project_id, name from formulas) as m on m.project_id = b.project_id and m.name = b.name)
  select pos, case when bad then 'bad name' when orphan then 'unknown table' when clash then 'column of that name' when taken then 'measure of that name' when k > 1 then 'twice in batch' else 'created' end as outcome from s""")
def bulk_measure_guards(spark, sf):
    """New measures: the name is not blank, the table is there, no column of the table and no measure of the project has the name, the first of equal ones wins."""
    b = lake(spark, sf, "part").select(*(F.expr(x) for x in (
        "p_partkey - p_partkey % 64 as project_id", "'T' || cast(p_partkey - p_partkey % 64 + p_partkey div 2 % 70 as string) as table_name",
        "case when p_partkey % 5 = 0 then 'Key' when p_partkey % 5 = 1 then 'M' || cast(p_partkey as string) when p_partkey % 7 = 2 then ' ' else 'N' || cast(p_partkey div 2 as string) end as name", "p_partkey as pos",
    )))
    mark = lambda df, n: df.distinct().withColumn(n, F.lit(True))
    there = mark(fleet(spark, sf, "tables").select("project_id", "table_name"), "there")
    clash = mark(fleet(spark, sf, "columns").select("project_id", "table_name", _c("column_name").alias("name")), "clash")
    taken = mark(fleet(spark, sf, "formulas").select("project_id", "name"), "taken")
    first = F.row_number().over(Window.partitionBy("project_id", "table_name", "name").orderBy("pos"))
    j = b.withColumn("k", first).join(there, ["project_id", "table_name"], "left").join(clash, ["project_id", "table_name", "name"], "left").join(taken, ["project_id", "name"], "left")
    outcome = F.when(F.trim("name") == "", "bad name").when(_c("there").isNull(), "unknown table").when(_c("clash"), "column of that name").when(_c("taken"), "measure of that name").when(_c("k") > 1, "twice in batch").otherwise("created")
    return j.select("pos", outcome.alias("outcome"))
