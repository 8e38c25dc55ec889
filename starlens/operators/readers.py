"""Definition texts of whole folders, one row a file (path, content): projects, pages, paginated reports and all objects of models.

The lake holds no such files, so that each query writes lake rows as texts, with quotes, blanks, several lines, comments and broken files among them, and
reads them again; what they were written from is the expected result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.fleet import fleet, fleet_sql
from ..sources.frames import lake, spread
from ..sources.projects import members, outline, pages_of, relationships, report_items, resolve_projects, visuals_of
from .rules import together

_c, _l = F.col, F.lit
QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _text(c: Column | str) -> Column:
    return (_c(c) if isinstance(c, str) else c).cast("string")


@query("""with c as (select c_custkey as k, c_nationkey as n, case c_custkey % 5 when 0 then '/lake/a' when 1 then '/lake/a/b/c' when 2 then '/lake/a/b/c/d' when 3 then '/lake/node_modules' else '/lake/z z' end as dir from customer)
  select 'P' || k as name, case when k % 7 = 1 then null when k % 3 = 0 then dir || '/M' || k when k % 3 = 1 and k % 4 <> 0 then regexp_replace(dir, '/[^/]*$', '') || '/models/M' || k end as model_path, case when k % 7 <> 1 and k % 3 <> 2 then dir || '/R' || k end as report_path
  from c where k % 5 in (0, 1, 4) and k % 11 <> 0""")
def read_projects(spark, sf):
    """Projects of a listing of files: at most three folders down, tools' folders left out, broken files dropped, the model by the report where the project names none."""
    k = _c("c_custkey")
    part = k % 5
    dir_ = F.when(part == 0, "/lake/a").when(part == 1, "/lake/a/b/c").when(part == 2, "/lake/a/b/c/d").when(part == 3, "/lake/node_modules").otherwise("/lake/z z")
    name = _text(k)
    model = F.concat(_l('{"semanticModel": {"path": "./x/../M'), name, _l('"}}'))
    report = F.concat(_l('{"report": {"path": "R'), name, _l('"}}'))
    named = F.when(k % 7 == 1, "").when(k % 3 == 0, F.concat(report, _l(", "), model)).when(k % 3 == 1, report).otherwise("")
    project = F.when(k % 11 == 0, '{"artifacts": [').otherwise(F.concat(_l('{"version": "1.0", "artifacts": ['), named, _l("]}")))
    back = F.when(k % 4 == 0, "not json").otherwise(F.concat(_l('{"datasetReference": {"byPath": {"path": "../../models/./M'), name, _l('"}}}')))
    c = lake(spark, sf, "customer")
    files = c.select(F.concat(dir_, _l("/P"), name, _l(".pbip")).alias("path"), project.alias("content")).unionByName(c.select(F.concat(dir_, _l("/R"), name, _l("/definition.pbir")).alias("path"), back.alias("content")))
    return resolve_projects(files, "/lake", 3).select("name", "model_path", "report_path")


@query("""with v as (select o_orderkey as k, o_custkey as c from orders)
  select 'R' || c as page_id, case when c % 9 = 0 then null else 'Page "' || c || '"' end as display_name, count(k) filter (k % 13 <> 0) as visuals, count(k) filter (k % 13 <> 0 and k % 4 = 0) as unknown, count(k) filter (k % 13 <> 0 and k % 4 = 1) as cards, count(k) filter (k % 13 <> 0 and k % 3 = 0) as titled
  from (select c_custkey as c from customer where c_custkey % 10 <> 0) left join v using (c) group by all""")
def read_pages(spark, sf):
    """Pages with their visuals by type from page and visual files; broken visuals are dropped, a visual without a type is unknown, titles lose their quotes."""
    k, c = _c("o_orderkey"), _c("o_custkey")
    page = lambda key: F.concat(_l("/r/definition/pages/R"), _text(key), _l("/"))
    p = lake(spark, sf, "customer").filter("c_custkey % 10 <> 0")
    shown = F.when(_c("c_custkey") % 9 == 0, "{}").otherwise(F.to_json(F.struct(F.concat(_l('Page "'), _text("c_custkey"), _l('"')).alias("displayName"))))
    kind = F.when(k % 4 == 0, "").when(k % 4 == 1, '"visualType": "card", ').otherwise('"visualType": "lineChart", ')
    title = F.when(k % 3 == 0, F.concat(_l('"title": [{"properties": {"text": {"expr": {"Literal": {"Value": "\''), _text(k), _l("'\"}}}}}]"))).otherwise("")
    visual = F.when(k % 13 == 0, '{"visual": ').otherwise(F.concat(_l('{"visual": {'), kind, _l('"visualContainerObjects": {'), title, _l("}}}")))
    files = p.select(F.concat(page("c_custkey"), _l("page.json")).alias("path"), shown.alias("content"))
    files = files.unionByName(lake(spark, sf, "orders").select(F.concat(page(c), _l("visuals/V"), _text(k), _l("/visual.json")).alias("path"), visual.alias("content")))
    v = visuals_of(files).groupBy("page_id").agg(F.count("*").alias("visuals"), F.count_if(_c("type") == "unknown").alias("unknown"), F.count_if(_c("type") == "card").alias("cards"), F.count_if(_c("title") == F.regexp_extract("visual_id", r"(\d+)", 1)).alias("titled"))
    return pages_of(files).select("page_id", "display_name").join(v, "page_id", "left").na.fill(0, ["visuals", "unknown", "cards", "titled"])


@query("""with o as (select o_orderkey as k, 1 + o_orderkey % 2 as s, o_orderkey % 3 as v from orders), sec as (select k, v, s, unnest(range(case when v = 0 then s else 1 end))::int as section from o),
  i as (select k, section, 'body' as part, 'Textbox' as type, 'a&b' || k as name, null as parent from sec union all select k, section, 'body', 'Rectangle', 'outer', null from sec union all select k, section, 'body', 'Textbox', 'inner', 'outer' from sec union all select k, section, 'body', 'Rectangle', 'middle', 'outer' from sec
  union all select k, section, 'body', 'Image', 'deep', 'middle' from sec union all select k, section, 'body', 'Tablix', 'grid', null from sec where k % 5 = 0 union all select k, section, 'body', 'Textbox', 'cell', 'grid' from sec where k % 5 = 0
  union all select k, section, 'header', 'Image', 'logo', null from sec where k % 4 = 0 union all select k, section, 'footer', 'Textbox', 'page', null from sec where k % 6 = 0)
  select 'r' || k as path, section, part, type, name, parent from i""")
def read_report_items(spark, sf):
    """Items of paginated reports at any depth, with section, part of the page and the item that holds them, from three versions of the format."""
    k = _c("o_orderkey")
    some = lambda cond, text: F.when(cond, text).otherwise("")
    grid = some(k % 5 == 0, "<Tablix Name='grid'><TablixBody><TablixCell><CellContents><Textbox Name=\"cell\"/></CellContents></TablixCell></TablixBody></Tablix>")
    body = F.concat(
        _l('<Body><!-- <Textbox Name="no"> --><ReportItems><Textbox Name="a&amp;b'), _text(k), _l('"><Value><![CDATA[<Textbox Name="no"/>]]></Value></Textbox><Rectangle Name="outer"><ReportItems><Textbox Name="inner"></Textbox>'
        '<Rectangle\n  Name="middle"><ReportItems><Image Name="deep" /></ReportItems></Rectangle></ReportItems></Rectangle>'), grid, _l("</ReportItems></Body>"),
    )
    page = F.concat(_l("<Page>"), some(k % 4 == 0, '<PageHeader><ReportItems><Image Name="logo"/></ReportItems></PageHeader>'), some(k % 6 == 0, '<PageFooter><ReportItems><Textbox Name="page"/></ReportItems></PageFooter>'), _l("</Page>"))
    one = F.concat(body, page)
    section = F.concat(_l("<ReportSection>"), one, _l("</ReportSection>"))
    whole = F.when(k % 3 == 0, F.concat(_l('<Report xmlns="http://example.org/2016/01/reportdefinition"><ReportSections>'), F.when(k % 2 == 1, F.concat(section, section)).otherwise(section), _l("</ReportSections></Report>")))
    whole = whole.when(k % 3 == 1, F.concat(_l('<?xml version="1.0"?><Report xmlns="http://example.org/2010/01/reportdefinition">'), one, _l("</Report>"))).otherwise(F.concat(_l('<Report xmlns="http://example.org/2008/01/reportdefinition">'), one, _l("</Report>")))
    return report_items(spread(lake(spark, sf, "orders").select("o_orderkey"), "o_orderkey").select(F.concat(_l("r"), _text(k)).alias("path"), whole.alias("content")))


# Objects of models


def _quoted(c: Column | str) -> Column:
    c = _c(c) if isinstance(c, str) else c
    return F.concat(_l("'"), F.replace(c, _l("'"), _l("''")), _l("'"))


def _line(c: Column | str, head: str) -> Column:
    c = _c(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(_l(head), c), _l(""))


def _flag(c: str, text: str) -> Column:
    return F.when(_c(c), text).otherwise("")


@query(f"with {fleet_sql('columns')} select pos, table_name, trim(column_name) as column_name, nullif(data_type, '') as data_type, is_calculated, case when is_calculated then expression || chr(10) || chr(10) || chr(9) || '+ 0 /* '' = '' */' end as expression, summarize_by, format_string, sort_by, is_hidden, tag from columns where column_name not in ('Key', 'Code')")
def read_columns(spark, sf):
    """Columns of tables, with formulas of several lines, names with blanks and quotes, flags and properties that nothing asks for."""
    c = spread(fleet(spark, sf, "columns").filter("column_name not in ('Key', 'Code')"), "pos", "table_name")
    formula = F.when(_c("is_calculated"), F.concat(_l(" =\n\t\t\t"), _c("expression"), _l("\n\n\t\t\t\t+ 0 /* ' = ' */"))).otherwise("")
    text = F.concat(
        _l("table "), _quoted("table_name"), _l("\r\n\tlineageTag: x\n\n\tcolumn "), _quoted("column_name"), formula, _line(F.nullif("data_type", _l("")), "\n\t\tdataType: "), _l("\n\t\tchangedProperty: IsHidden"), _line("format_string", "\n\t\tformatString: "), _line("summarize_by", "\n\t\tsummarizeBy: "),
        _line("sort_by", "\n\t\tsortByColumn: "), _flag("is_hidden", "\n\t\tisHidden"), _line("tag", "\n\t\tlineageTag: "), _l("\n\n\t\tannotation Note = column dataType: none\n\n\tpartition p = m\n\t\tmode: import\n\t\tsource =\n\t\t\t\tlet\n\t\t\t\t\tcolumn = 1\n\t\t\t\tin column\n"),
    )
    p = _c("properties")
    m = members(outline(c.select(F.concat_ws("|", _text("pos"), "table_name").alias("path"), text.alias("content"))), "column")
    return m.select(
        F.split("path", r"\|")[0].cast("long").alias("pos"), _c("holder").alias("table_name"), F.trim("name").alias("column_name"), p["dataType"].alias("data_type"), _c("expression").isNotNull().alias("is_calculated"), "expression", p["summarizeBy"].alias("summarize_by"),
        p["formatString"].alias("format_string"), p["sortByColumn"].alias("sort_by"), F.coalesce(p["isHidden"] == "true", _l(False)).alias("is_hidden"), p["lineageTag"].alias("tag"),
    )


@query(f"with {fleet_sql('relationships')} select name, from_table, from_column, to_table, to_column, coalesce(from_card, 'many') as from_card, coalesce(to_card, 'one') as to_card, coalesce(cross_filter, 'oneDirection') as cross_filter, coalesce(is_active, true) as is_active from relationships")
def read_relationships(spark, sf):
    r = spread(fleet(spark, sf, "relationships"), "name")
    end = lambda s: F.concat(_quoted(f"{s}_table"), _l("."), _c(f"{s}_column"))
    text = F.concat(_l("relationship "), "name", _l("\n\tfromColumn: "), end("from"), _l("\n\ttoColumn: "), end("to"), _line("from_card", "\n\tfromCardinality: "), _line("to_card", "\n\ttoCardinality: "), _line("cross_filter", "\n\tcrossFilteringBehavior: "), F.when(_c("is_active").eqNullSafe(False), "\n\tisActive: false").otherwise(""), _l("\n"))
    return relationships(outline(r.select(_c("name").alias("path"), text.alias("content")))).drop("path")


@query(f"with {fleet_sql('role_filters')} select role, table_name, filter, metadata from role_filters where filter is not null or metadata is not null")
def read_roles(spark, sf):
    """Roles with a permission for each table: a filter, or what hides the table, or both."""
    f = spread(fleet(spark, sf, "role_filters").filter("filter is not null or metadata is not null"), "role", "table_name")
    text = F.concat(_l("role "), _quoted("role"), _l("\n\tmodelPermission: read\n\n\ttablePermission "), _quoted("table_name"), _line("filter", " = "), _line("metadata", "\n\t\tmetadataPermission: "), _l("\n\n\tannotation N = 1\n"))
    m = members(outline(f.select(F.concat_ws("|", "role", "table_name").alias("path"), text.alias("content"))), "tablePermission")
    return m.select(_c("holder").alias("role"), _c("name").alias("table_name"), _c("expression").alias("filter"), _c("properties")["metadataPermission"].alias("metadata"))


@query(f"with {fleet_sql('items')} select project_id, table_name, 'C ' || name as name, ordinal::int as ordinal, nullif(expression, '') as expression, case when ordinal = 1 then '\"0.0\"' end as format from items where name <> ''")
def read_calculation_items(spark, sf):
    """Calculation items with ordinals, and formats that are formulas themselves."""
    i = spread(fleet(spark, sf, "items").filter("name <> ''"), "project_id", "table_name", "name", "ordinal")
    fmt = F.when(_c("ordinal") == 1, '\n\n\t\t\tformatStringDefinition = "0.0"').otherwise("")
    text = F.concat(_l("table "), _quoted("table_name"), _l("\n\tcalculationGroup\n\t\tprecedence: 20\n\n\t\tcalculationItem "), _quoted(F.concat(_l("C "), "name")), _l(" =\n\t\t\t\t"), "expression", fmt, _l("\n\t\t\tordinal: "), _text("ordinal"), _l("\n\n\tcolumn Name\n\t\tdataType: string\n"))
    objects = outline(i.select(F.concat_ws("|", _text("project_id"), "table_name", "name", _text("ordinal")).alias("path"), text.alias("content")))
    # an item and the format below it have the item's line in common, so that files are read once
    both = objects.filter("kind in ('calculationItem', 'formatStringDefinition')").withColumn("own", _c("kind") == "calculationItem")
    of = both.groupBy("path", F.when(_c("own"), _c("n")).otherwise(_c("parent")).alias("n")).agg(F.max_by(F.struct("name", "expression", "properties"), "own").alias("i"), F.max(F.when(~_c("own"), _c("expression"))).alias("format"), F.max("own").alias("own")).filter("own").select("path", "i.*", "format")
    return of.select(F.split("path", r"\|")[0].cast("long").alias("project_id"), F.split("path", r"\|")[1].alias("table_name"), "name", _c("properties")["ordinal"].cast("int").alias("ordinal"), "expression", "format")


@query("with l as (select n_regionkey, n_name, row_number() over (partition by n_regionkey order by n_nationkey) - 1 as k from nation) select 'H ' || r_name as hierarchy, k::int as ordinal, 'L ' || n_name as level, n_name as column_ from l join region on r_regionkey = n_regionkey")
def read_hierarchies(spark, sf):
    """Hierarchies with the levels in their order; a level names its column."""
    n = lake(spark, sf, "nation").join(lake(spark, sf, "region"), _c("n_regionkey") == _c("r_regionkey"))
    level = F.concat(_l("\n\t\tlevel "), _quoted(F.concat(_l("L "), "n_name")), _l("\n\t\t\tlineageTag: y\n\t\t\tcolumn: "), _quoted("n_name"), _l("\n"))
    g = n.groupBy("r_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", level.alias("t")))), lambda s: s["t"]), "").alias("t"))
    objects = outline(g.select(_c("r_name").alias("path"), F.concat(_l("table Geo\n\n\thierarchy "), _quoted(F.concat(_l("H "), "r_name")), _l("\n\t\tlineageTag: x\n"), "t").alias("content")))
    rank = objects.filter("kind = 'level'").select("path", "n", F.row_number().over(_file("path", "parent")).alias("at"), "name", "parent", "properties")
    up = objects.select("path", _c("n").alias("parent"), _c("name").alias("hierarchy"))
    return rank.join(up, ["path", "parent"]).select("hierarchy", (_c("at") - 1).alias("ordinal"), _c("name").alias("level"), _c("properties")["column"].alias("column_"))


def _file(*keys: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys).orderBy("n")  # an object of one file


@query(f"with {fleet_sql('tables', 'functions', 'expressions')} select 'partition' as kind, table_name as name, coalesce(mode, 'import') as detail, case when source = 'm' then 'let' || chr(10) || chr(9) || 'x = ''a'' ' || chr(10) || 'in x' end as body from tables union all select 'function', name, nullif(params, ''), '(' || params || ') =>' || chr(10) || chr(9) || 'a' from functions union all select 'expression', name, 'M', body from expressions")
def read_other_objects(spark, sf):
    """Partitions with their scripts, functions with their parameters in comments, named expressions."""
    t, f, e = spread(fleet(spark, sf, "tables"), "project_id", "table_name"), spread(fleet(spark, sf, "functions"), "project_id", "name"), spread(fleet(spark, sf, "expressions"), "project_id", "name")
    script = F.when(_c("source") == "m", "\n\t\tsource =\n\t\t\t\tlet\n\t\t\t\t\tx = 'a' \n\t\t\t\tin x").otherwise("")
    part = F.concat(_l("table "), _quoted("table_name"), _l("\n\n\tpartition "), _quoted("table_name"), _l(" = m"), _line("mode", "\n\t\tmode: "), script, _l("\n"))
    fn = F.concat(_line(F.nullif("params", _l("")), "/// "), _l("\nfunction "), _quoted("name"), _l(" =\n\t\t("), "params", _l(") =>\n\t\t\ta\n\tlineageTag: z\n"))
    ex = F.concat(_l("expression "), _quoted("name"), _l(" = "), "body", _l("\n\tlineageTag: z\n"))
    files = together(
        t.select(F.concat(_l("t|"), _text("project_id"), "table_name").alias("path"), part.alias("content")), f.select(F.concat(_l("f|"), _text("project_id"), "name").alias("path"), fn.alias("content")), e.select(F.concat(_l("e|"), _text("project_id"), "name").alias("path"), ex.alias("content"))
    )
    o = outline(files).filter("kind in ('partition', 'function', 'expression')")
    detail = F.when(_c("kind") == "partition", F.coalesce(_c("properties")["mode"], _l("import"))).when(_c("kind") == "function", _c("description")).otherwise("M")
    body = F.when((_c("kind") != "partition") | (_c("expression") != "m"), _c("expression"))
    return o.select("kind", "name", detail.alias("detail"), body.alias("body"))
