"""Lookups in catalog tables: references, tags, callers, ancestor paths, missing keys; syntax checks, redaction, moves and generated rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.frames import lake, related
from .catalog import MEASURES_SQL, measures

_c = F.col
QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@query(f"with {MEASURES_SQL}, r as (select name, unnest(list_distinct(regexp_extract_all(expression, '\\[([^\\]]+)\\]', 1))) as ref from m) select name, ref, ref in (select name from m) as is_measure from r")
def measure_refs(spark, sf):
    m = measures(spark, sf)
    refs = m.select("name", F.explode(F.array_distinct(F.regexp_extract_all("expression", F.lit(r"\[([^\]]+)\]"), 1))).alias("ref"))
    known = m.select(_c("name").alias("ref"), F.lit(True).alias("known")).distinct()
    return refs.join(known, "ref", "left").select("name", "ref", F.coalesce("known", F.lit(False)).alias("is_measure"))


@query("select p_partkey, p_brand, array_to_string(list_sort(list_distinct(string_split(lower(p_name), ' '))), ',') as tags from part where list_contains(string_split(lower(p_name), ' '), (select min(string_split(lower(p_name), ' ')[1]) from part)) and contains(lower(p_brand), 'brand')")
def search_tags(spark, sf):
    p = lake(spark, sf, "part").withColumn("t", F.split(F.lower("p_name"), " "))
    wanted = p.agg(F.min(_c("t")[0]).alias("wanted"))  # one row
    found = p.join(F.broadcast(wanted), F.array_contains("t", _c("wanted"))).filter(F.lower("p_brand").contains("brand"))
    return found.select("p_partkey", "p_brand", F.array_join(F.array_sort(F.array_distinct("t")), ",").alias("tags"))


@query(f"with {MEASURES_SQL}, k as (select distinct 'M' || (l_partkey + l_suppkey) as name from lineitem) select k.name, case when m.name is null then 'not_found' else 'found' end as status, m.table_name from k left join m using (name)")
def bulk_lookup(spark, sf):
    keys = lake(spark, sf, "lineitem").select(F.concat(F.lit("M"), (_c("l_partkey") + _c("l_suppkey")).cast("string")).alias("name")).distinct()
    m = measures(spark, sf).select("name", "table_name", F.lit("found").alias("hit"))
    return keys.join(m, "name", "left").select("name", F.coalesce("hit", F.lit("not_found")).alias("status"), "table_name")


@query(f"""with {MEASURES_SQL}, g as (select table_name as package_id, coalesce(min_by(format_string, p_partkey) filter (format_string is not null), 'unknown') as version, count(*) as functions from m group by 1) select g.*, name from g join m on m.table_name = package_id""")
def group_by_annotation(spark, sf):
    """Packages with their version and number of functions, and a row for each function."""
    version = F.min_by("format_string", F.when(_c("format_string").isNotNull(), _c("p_partkey")))
    m = measures(spark, sf).withColumnRenamed("table_name", "package_id")
    return m.groupBy("package_id").agg(F.coalesce(version, F.lit("unknown")).alias("version"), F.count("*").alias("functions")).join(m.select("package_id", "name"), "package_id")


@query(f"with {MEASURES_SQL} select name as caller, unnest(list_distinct(regexp_extract_all(expression, '([A-Za-z_][A-Za-z0-9_.]*)\\s*\\(', 1))) as callee from m")
def function_callers(spark, sf):
    called = F.regexp_extract_all("expression", F.lit(r"(?<![\w'\[])([A-Za-z_][\w.]*)\s*\("), 1)
    return measures(spark, sf).select(_c("name").alias("caller"), F.explode(F.array_distinct(called)).alias("callee"))


@query("select c_custkey, c_acctbal from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name in ('ASIA', 'EUROPE') and c_acctbal > 0")
def rls_in_list(spark, sf):
    c = related(spark, sf, lake(spark, sf, "customer"), "customer_nation", "nation_region")
    return c.filter(_c("r_name").isin("ASIA", "EUROPE") & (_c("c_acctbal") > 0)).select("c_custkey", "c_acctbal")


@query("""select p_partkey, case p_partkey % 3 when 0 then p_name when 1 then p_name else '''' || p_name end as name from part""")
def unquote_names(spark, sf):
    k = _c("p_partkey") % 3
    quoted = F.when(k == 0, F.concat(F.lit("'"), "p_name", F.lit("'"))).when(k == 1, F.concat(F.lit('"'), "p_name", F.lit('"'))).otherwise(F.concat(F.lit("'"), "p_name"))
    return lake(spark, sf, "part").select("p_partkey", F.regexp_replace(quoted, r"""^(['"])(.*)\1$""", "$2").alias("name"))


@query("""select c_custkey, r_name || '|' || n_name || '|' || c_name as path, n_name as item2, c_name as item_last, 3 as length, r_name = 'ASIA' as in_asia
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def path_functions(spark, sf):
    c = related(spark, sf, lake(spark, sf, "customer"), "customer_nation", "nation_region").filter("r_name is not null")
    c = c.withColumn("path", F.concat_ws("|", "r_name", "n_name", "c_name")).withColumn("p", F.split("path", r"\|"))
    return c.select("c_custkey", "path", F.element_at("p", 2).alias("item2"), F.element_at("p", -1).alias("item_last"), F.size("p").alias("length"), F.array_contains("p", "ASIA").alias("in_asia"))


#: closed strings and comments of a formula
_QUOTED = r'"(?:[^"\n]|"")*"|//[^\n]*|/\*[\s\S]*?\*/'


@query(rf"""with l as (select doc_id, unnest(string_split(regexp_replace(text, '{_QUOTED}', '', 'g'), chr(10))) as line from documents where text is not null)
  select doc_id, count_if(contains(line, '"')) as unclosed from l group by 1""")
def check_strings(spark, sf):
    lines = F.split(F.regexp_replace("text", _QUOTED, ""), "\n", -1)
    return lake(spark, sf, "documents").filter("text is not null").select("doc_id", F.size(F.filter(lines, lambda x: x.contains('"'))).cast("long").alias("unclosed"))


@query(rf"""select doc_id, regexp_matches(regexp_replace(text, '{_QUOTED}', '', 'g'), '[-+*/&<>=,][ \t\r\n)}}\]]*$') as trailing from documents""")
def check_trailing(spark, sf):
    return lake(spark, sf, "documents").select("doc_id", F.regexp_replace("text", _QUOTED, "").rlike(r"[-+*/&<>=,][ \t\r\n)}\]]*\z").alias("trailing"))


@query(f"""with {MEASURES_SQL}, t as (select *, case p_partkey % 3 when 0 then 'let a = ' || expression || ' in a' when 1 then '"x" meta [Source = 1]' else expression end as script from m)
  select name, case when p_partkey % 3 = 0 then '[M-code redacted]' else script end as script from t""")
def redact_script(spark, sf):
    k = _c("p_partkey") % 3
    script = F.when(k == 0, F.concat(F.lit("let a = "), "expression", F.lit(" in a"))).when(k == 1, F.lit('"x" meta [Source = 1]')).otherwise(_c("expression"))
    t = measures(spark, sf).select("name", script.alias("script"))
    code = _c("script").rlike(r"(?is)\blet\b.*\bin\b|\bSource\s*=") & ~_c("script").rlike(r'(?s)^\s*"[^"]*"\s+meta\s*\[')
    return t.select("name", F.when(code, "[M-code redacted]").otherwise(_c("script")).alias("script"))


@query(f"""with {MEASURES_SQL}, c as (select name, table_name as old, case when p_partkey % 4 = 0 then table_name else (select min(table_name) from m) end as target from m where p_partkey % 2 = 0),
  taken as (select distinct c.name, c.target from c join m on m.name = c.name and m.table_name = c.target)
  select c.name, c.old, c.target, case when c.old = c.target then 'already_there' when taken.name is not null then 'name_taken' else 'moved' end as status from c left join taken on taken.name = c.name and taken.target = c.target""")
def bulk_move(spark, sf):
    """A change table of measures and the table each shall go to; rows that can't move say why."""
    m = measures(spark, sf)
    first = m.agg(F.min("table_name").alias("least"))  # one row
    c = m.filter("p_partkey % 2 = 0").crossJoin(F.broadcast(first))
    c = c.select("name", _c("table_name").alias("old"), F.when(_c("p_partkey") % 4 == 0, _c("table_name")).otherwise(_c("least")).alias("target"))
    taken = m.select("name", _c("table_name").alias("target"), F.lit(True).alias("taken")).distinct()
    status = F.when(_c("old") == _c("target"), "already_there").when(_c("taken"), "name_taken").otherwise("moved")
    return c.join(taken, ["name", "target"], "left").select("name", "old", "target", status.alias("status"))


#: generated measures: suffix -> formula and format over a measure {m} (fixed values: they are stored in models)
FAMILIES = {
    "MTD": ("TOTALMTD([{m}], Cal[Date])", None),
    "QTD": ("TOTALQTD([{m}], Cal[Date])", None),
    "YTD": ("TOTALYTD([{m}], Cal[Date])", None),
    "PY": ("CALCULATE([{m}], SAMEPERIODLASTYEAR(Cal[Date]))", None),
    "PY MTD": ("TOTALMTD([{m}], SAMEPERIODLASTYEAR(Cal[Date]))", None),
    "PY QTD": ("TOTALQTD([{m}], SAMEPERIODLASTYEAR(Cal[Date]))", None),
    "PY YTD": ("TOTALYTD([{m}], SAMEPERIODLASTYEAR(Cal[Date]))", None),
    "YoY": ("[{m}] - CALCULATE([{m}], SAMEPERIODLASTYEAR(Cal[Date]))", None),
    "YoY %": ("VAR _Current = [{m}]\nVAR _PY = CALCULATE([{m}], SAMEPERIODLASTYEAR(Cal[Date]))\nRETURN\n    DIVIDE(_Current - _PY, _PY, BLANK())", "0.0%"),
    "Target": ("[{m} PY] * 1.05", "#,0"),
    "Variance": ("[{m}] - [{m} Target]", "#,0"),
    "Variance %": ("DIVIDE([{m} Variance], [{m} Target], BLANK())", "0.0%"),
    "Status Color": ('VAR _Ratio = DIVIDE([{m}], [{m} Target], BLANK())\nRETURN\n    SWITCH(\n        TRUE(),\n        _Ratio >= 1, "#80004B",\n        _Ratio >= 0.95, "#0D9F6E",\n        _Ratio >= 0.8, "#C97A1E",\n        _Ratio > 0, "#C92A2A",\n        "#9E9E9E"\n    )', None),
    "Gauge Max": ("MAX([{m}], [{m} Target]) * 1.1", "#,0"),
    "Subtitle": ('"Now: " & FORMAT([{m}], "#,0")', None),
}
_FAMILY_SQL = ", ".join("('{}', '{}', {})".format(k, e.replace("\n", "' || chr(10) || '"), f"'{f}'" if f else "null::varchar") for k, (e, f) in FAMILIES.items())


@query(f"""with {MEASURES_SQL}, v(suffix, body, format_string) as (values {_FAMILY_SQL}),
  n as (select name || ' ' || suffix as name, table_name, replace(body, '{{m}}', name) as expression, v.format_string from m, v where not is_hidden) select * from n where name not in (select name from m)""")
def gen_family_rows(spark, sf):
    """New catalog rows, one per visible measure and variant (time to date, prior year, key figure, subtitle), where the name is still free."""
    m = measures(spark, sf)
    body = lambda e: F.replace(F.lit(e), F.lit("{m}"), _c("name"))
    variants = F.array(*(F.struct(F.lit(k).alias("suffix"), body(e).alias("expression"), F.lit(f).cast("string").alias("format_string")) for k, (e, f) in FAMILIES.items()))
    rows = m.filter("not is_hidden").select("name", "table_name", F.explode(variants).alias("v")).select(F.concat_ws(" ", "name", "v.suffix").alias("name"), "table_name", "v.expression", "v.format_string")
    return rows.join(m.select("name"), "name", "left_anti")
