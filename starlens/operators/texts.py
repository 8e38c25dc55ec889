"""Checks and redaction of formula and script texts, over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.packs import applied, color_hex_to_rgb
from ..functions.formats import by_format
from ..functions.text import CONNECTIONS, QUOTED, REDACTED, balanced, blanked, dedent, redact
from ..sources.fleet import fleet, fleet_sql
from ..sources.frames import lake
from .rules import _TEXTS, all_formulas

_c = F.col
QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _sql_text(p: str) -> str:
    return p.replace("'", "''")


_NESTED = "text"
for _p in CONNECTIONS.values():
    _NESTED = f"regexp_replace({_NESTED}, '{_sql_text(_p)}', '{REDACTED}', 'gi')"
#: documents and page addresses, every fifth with a connection before its text
_SOURCES = """src as (select 'document' as kind, doc_id as id, case doc_id % 5 when 0 then 'Server = db1;' when 1 then 'x = Sql.Database("a", "b") ' else '' end || text as text from documents union all select 'page', page_id, url from pages)"""


def _sources(spark, sf):
    k = _c("doc_id") % 5
    head = F.when(k == 0, "Server = db1;").when(k == 1, 'x = Sql.Database("a", "b") ').otherwise("")
    d = lake(spark, sf, "documents").select(F.lit("document").alias("kind"), _c("doc_id").alias("id"), F.concat(head, "text").alias("text"))
    return d.union(lake(spark, sf, "pages").select(F.lit("page"), "page_id", "url"))


@query(f"with {_SOURCES} select kind, id, md5({_NESTED}) as text_md5, contains({_NESTED}, '{REDACTED}') as changed from src")
def redact_connections(spark, sf):
    """All patterns in their order; the digest stands for the whole redacted text."""
    s = _sources(spark, sf).withColumn("r", redact(_c("text")))
    return s.select("kind", "id", F.md5("r").alias("text_md5"), _c("r").contains(REDACTED).alias("changed"))


@query(f"with {_SOURCES} select kind, count(*) as texts, " + ", ".join(f"coalesce(sum(len(regexp_extract_all(text, '(?i){_sql_text(p)}'))), 0)::bigint as {n}" for n, p in CONNECTIONS.items()) + " from src group by 1")
def redaction_report(spark, sf):
    """Hits of each pattern on the untouched texts."""
    hits = [F.coalesce(F.sum(F.regexp_count("text", F.lit("(?i)" + p))), F.lit(0)).alias(n) for n, p in CONNECTIONS.items()]
    return _sources(spark, sf).groupBy("kind").agg(F.count("*").alias("texts"), *hits)


#: the function names that the check knows; a parameter of the check
KNOWN = ("CALCULATE", "DIVIDE", "FILTER", "IF", "INTERSECT", "SELECTEDMEASURE", "SUM", "VALUES")


def unknown_functions(texts, known):
    """Calls outside strings and comments of names that `known` (name) lacks; keywords don't count."""
    calls = F.regexp_extract_all(blanked("expression"), F.lit(r"(?<![A-Za-z0-9_])([A-Za-z][A-Za-z0-9.]*)\s*\("), F.lit(1))
    called = texts.select("project_id", "kind", "table_name", "name", F.explode(F.array_distinct(F.transform(calls, F.upper))).alias("fn"))
    called = called.filter(~_c("fn").isin("VAR", "RETURN", "DEFINE", "EVALUATE"))
    return called.join(F.broadcast(known.select(_c("name").alias("fn"))), "fn", "left_anti")  # a list of names, not data


@query(f"""with {_TEXTS}, c as (select distinct project_id, kind, table_name, name, upper(unnest(regexp_extract_all(regexp_replace(expression, '{QUOTED}', '', 'g'), '\\b([A-Za-z][A-Za-z0-9.]*)\\s*\\(', 1))) as fn from texts)
  select * from c where fn not in {KNOWN} and fn not in ('VAR', 'RETURN', 'DEFINE', 'EVALUATE')""")
def check_functions(spark, sf):
    return unknown_functions(all_formulas(spark, sf), spark.createDataFrame([(n,) for n in KNOWN], "name string"))


@query(rf"""select doc_id, len(regexp_extract_all(regexp_replace('f(' || text || case doc_id % 4 when 0 then ' + )' when 1 then '"" )' else ')' end, '{QUOTED}', '_', 'g'), '[-+*/&<>=]\s*\)')) as missing from documents where text is not null""")
def check_operands(spark, sf):
    """Operators right before a closing parenthesis; a string, also an empty one, is an operand."""
    k = _c("doc_id") % 4
    t = F.concat(F.lit("f("), "text", F.when(k == 0, " + )").when(k == 1, '"" )').otherwise(")"))
    return lake(spark, sf, "documents").filter("text is not null").select("doc_id", F.regexp_count(blanked(t, "_"), F.lit(r"[-+*/&<>=]\s*\)")).cast("long").alias("missing"))


@query(rf"""with t as (select doc_id, trim(regexp_replace(text, '{QUOTED}', '', 'g')) as t from documents) select doc_id, case when t = '' then 'empty' when regexp_matches(t, '\b[A-Za-z][A-Za-z0-9.]*\s*\(') or contains(t, '[') or regexp_matches(t, '\b\d+(\.\d+)?\b')
  or regexp_matches(t, '(?i)\b(VAR|RETURN|DEFINE|EVALUATE|TRUE|FALSE|BLANK)\b') then 'formula' else 'no construct' end as verdict from t where t is not null""")
def check_constructs(spark, sf):
    a, z = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
    t = _c("t")
    some = t.rlike(a + r"[A-Za-z][A-Za-z0-9.]*\s*\(") | t.contains("[") | t.rlike(a + r"\d+(\.\d+)?" + z) | t.rlike(f"(?i){a}(VAR|RETURN|DEFINE|EVALUATE|TRUE|FALSE|BLANK){z}")
    d = lake(spark, sf, "documents").filter("text is not null").select("doc_id", F.trim(blanked("text")).alias("t"))
    return d.select("doc_id", F.when(t == "", "empty").when(some, "formula").otherwise("no construct").alias("verdict"))


@query(rf"""with t as (select doc_id, [m for m in regexp_extract_all(regexp_replace(case doc_id % 4 when 0 then 'f([a], (' when 1 then '([)]' when 2 then '{{(x)}}' else ')' end || coalesce(text, ''), '{QUOTED}', '', 'g'), '[()\[\]{{}}]')] as m from documents),
  s as (select doc_id, array_to_string(m, '') as s from t), u as (select doc_id, s from s)
  select doc_id, (with recursive r(s, k) as (select u.s, 0 union all select regexp_replace(s, '\(\)|\[\]|\{{\}}', '', 'g'), k + 1 from r where regexp_matches(s, '\(\)|\[\]|\{{\}}')) select min(length(s)) = 0 from r) as balanced from u""")
def check_delimiters(spark, sf):
    k = _c("doc_id") % 4
    head = F.when(k == 0, "f([a], (").when(k == 1, "([)]").when(k == 2, "{(x)}").otherwise(")")
    return lake(spark, sf, "documents").select("doc_id", balanced(F.concat(head, F.coalesce("text", F.lit("")))).alias("balanced"))


@query(r"""with t as (select doc_id, string_split(chr(10) || chr(9) || chr(9) || replace(text, chr(10), chr(10) || chr(9)) || chr(10) || ' ', chr(10)) as l from documents where text is not null),
  m as (select doc_id, l, coalesce(list_min([length(regexp_extract(x, '^\t*')) for x in l if not regexp_full_match(x, '\s*')]), 0) as k from t)
  select doc_id, md5(regexp_replace(array_to_string([case when regexp_full_match(x, '\s*') then '' else substr(x, k + 1) end for x in l], chr(10)), '^\n+|\n+$', '', 'g')) as text_md5 from m""")
def dedent_text(spark, sf):
    t = F.concat(F.lit("\n\t\t"), F.replace("text", F.lit("\n"), F.lit("\n\t")), F.lit("\n "))
    return lake(spark, sf, "documents").filter("text is not null").select("doc_id", F.md5(dedent(t)).alias("text_md5"))


@query(f"""with {fleet_sql('formulas')}, t as (select project_id, name, pos % 3 as k, case pos % 3 when 0 then 'evaluate ' when 1 then 'select a from t where ' else 'exec ' end || expression as q from formulas where expression is not null)
  select project_id, name, case k when 0 then 'DAX' when 1 then case when contains(q, '[') then 'MDX' else 'SQL' end else 'SQL' end as kind, case when k = 0 then array_to_string(list_sort(list_distinct(regexp_extract_all(q, '\\[([^\\]]+)\\]', 1))), ',') end as refs from t""")
def query_refs(spark, sf):
    """Kind of each query text; the bracketed names of those of the formula language."""
    k = _c("pos") % 3
    q = F.concat(F.when(k == 0, "evaluate ").when(k == 1, "select a from t where ").otherwise("exec "), "expression")
    t = F.upper(F.trim("q"))
    kind = F.when(t.rlike("^(EVALUATE|DEFINE|VAR)"), "DAX").when(t.rlike("^WITH") & t.rlike("MEMBER|SET"), "MDX").when(t.rlike("^SELECT") & t.contains("FROM") & t.contains("["), "MDX").when(t.rlike("^(SELECT|EXEC|CALL|INSERT)"), "SQL").otherwise("unknown")
    refs = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("q", F.lit(r"\[([^\]]+)\]"), F.lit(1)))), ",")
    f = fleet(spark, sf, "formulas").filter("expression is not null").withColumn("q", q).withColumn("kind", kind)
    return f.select("project_id", "name", "kind", F.when(_c("kind") == "DAX", refs).alias("refs"))


@query("""select p_partkey, try_cast(right(p_brand, 1) as double) as number_, make_date(2000 + p_partkey % 20, 1 + p_partkey % 12, 1 + p_partkey % 28) as date_, p_size % 2 <> 0 as flag,
  'rgb(' || (p_partkey * 7 % 256) || ',' || (p_size * 5 % 256) || ',' || (p_partkey % 256) || ')' as rgb, p_size::varchar || ' pcs' as text_ from part""")
def udf_convert_pack(spark, sf):
    """Texts, numbers, days, flags and colours converted; what can't be read is null."""
    part = lambda x: F.lpad(F.hex(x % 256), 2, "0")
    k, size = _c("p_partkey"), _c("p_size")
    day = F.concat_ws("-", *((x).cast("string") for x in (2000 + k % 20, 1 + k % 12, 1 + k % 28)))
    made = {"number_": F.expr("try_cast(right(p_brand, 1) as double)"), "date_": F.to_date(day, "yyyy-M-d"), "flag": size % 2 != 0, "rgb": color_hex_to_rgb(F.concat(F.lit("#"), part(k * 7), part(size * 5), part(k))), "text_": F.concat(size.cast("string"), F.lit(" pcs"))}
    return lake(spark, sf, "part").select("p_partkey", *(v.alias(n) for n, v in made.items()))


@query("select o_custkey, round(v, 2) as v, case when t > 0 then round((v - t) / t, 4) end as variance_pct, v >= t as reached from (select o_custkey, sum(o_totalprice::decimal(18,2))::double as v, (count(*) * 150000)::double as t from orders group by 1)")
def sql_udf_kpi(spark, sf):
    """A model function with typed parameters, as a function of columns: nothing is registered in the session."""
    variance_pct = lambda v, t: F.when(t > 0, (v - t) / t)
    o = lake(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(_c("o_totalprice").cast("decimal(18,2)")).cast("double").alias("v"), (F.count("*") * 150000).cast("double").alias("t"))
    return o.select("o_custkey", F.round("v", 2).alias("v"), F.round(variance_pct(_c("v"), _c("t")), 4).alias("variance_pct"), (_c("v") >= _c("t")).alias("reached"))


#: fixed values: what names, column references and formats may hold before they are put into formulas
NAME_PATTERN = r"^[A-Za-z_][A-Za-z0-9_ &%]*\z"
REFERENCE_PATTERN = r"^(?:'[A-Za-z0-9_ ]+'|[A-Za-z_][A-Za-z0-9_]*)?\[[A-Za-z0-9_ ]+\]\z"
FORMAT_PATTERN = r"^[A-Za-z0-9#0 .,:;%$\-/\\()@*+]*\z"
CONTROL_PATTERN = r"[\x00-\x1f]"


@query(rf"""with {fleet_sql('formulas')}, t as (select project_id, name, pos, table_name || '[' || name || ']' as ref, coalesce(format_string, name) as fmt, description as label, expression as e, '{REFERENCE_PATTERN.replace("'", "''")}' as rp from formulas)
  select project_id, name, pos, regexp_matches(name, '{NAME_PATTERN}') as name_ok, not contains(name, '[') and not contains(name, ']') and not regexp_matches(name, '{CONTROL_PATTERN}') as bracket_ok, regexp_matches(ref, rp) as reference_ok, regexp_matches(fmt, '{FORMAT_PATTERN}') as format_ok,
  length(label) between 1 and 256 and not regexp_matches(label, '{CONTROL_PATTERN}') as label_ok, length(e) between 1 and 100000 and (not regexp_matches(e, '{CONTROL_PATTERN}') or regexp_matches(e, '[\r\n\t]')) as expression_ok, replace(e, '"', '""') as literal from t""")
def input_guards(spark, sf):
    """Guards of texts that go into formulas: names, references, formats, labels, formulas; and the formula as a string literal. Null inputs give null."""
    name, label, e = _c("name"), _c("description"), _c("expression")
    control = lambda c: c.rlike(CONTROL_PATTERN)
    guards = {
        "name_ok": name.rlike(NAME_PATTERN),
        "bracket_ok": ~name.contains("[") & ~name.contains("]") & ~control(name),
        "reference_ok": F.concat("table_name", F.lit("["), name, F.lit("]")).rlike(REFERENCE_PATTERN),
        "format_ok": F.coalesce("format_string", name).rlike(FORMAT_PATTERN),
        "label_ok": F.length(label).between(1, 256) & ~control(label),
        "expression_ok": F.length(e).between(1, 100_000) & (~control(e) | e.rlike(r"[\r\n\t]")),
        "literal": F.replace(e, F.lit('"'), F.lit('""')),
    }
    return fleet(spark, sf, "formulas").select("project_id", "name", "pos", *(g.alias(n) for n, g in guards.items()))


#: formats with one, two and three sections, optional digits, quoted parts and signs
FORMATS = ("0.0%", "#,0", "0.00", "$#,0.00", '"$"#,0.00;("$"#,0.00);"-"', "0.##", '#,##0.0 "items"', "+0.0%;-0.0%;0%", "0000", "#.00", "#,0;;zero", "\\x0.0")
_IN = "round(abs(v), {})"
_FORMAT_SQL = {
    "0.0%": "sg || format('{:.1f}', round(a * 100, 1)::double) || '%'", "#,0": "sg || format('{:,}', round(a, 0)::bigint)", "0.00": "sg || format('{:.2f}', round(a, 2)::double)", "$#,0.00": "sg || '$' || format('{:,.2f}', round(a, 2)::double)",
    '"$"#,0.00;("$"#,0.00);"-"': "case when v = 0 then '-' when v < 0 then '($' || format('{:,.2f}', round(a, 2)::double) || ')' else '$' || format('{:,.2f}', round(a, 2)::double) end",
    "0.##": "sg || regexp_replace(regexp_replace(format('{:.2f}', round(a, 2)::double), '0{1,2}$', ''), '\\.$', '')", '#,##0.0 "items"': "sg || format('{:,.1f}', round(a, 1)::double) || ' items'",
    "+0.0%;-0.0%;0%": "case when v = 0 then '0%' else case when v < 0 then '-' else '+' end || format('{:.1f}', round(a * 100, 1)::double) || '%' end", "0000": "sg || lpad(round(a, 0)::bigint::varchar, greatest(4, length(round(a, 0)::bigint::varchar))::int, '0')",
    "#.00": "sg || regexp_replace(format('{:.2f}', round(a, 2)::double), '^0\\.', '.')", "#,0;;zero": "case when v = 0 then 'zero' else sg || format('{:,}', round(a, 0)::bigint) end", "\\x0.0": "sg || 'x' || format('{:.1f}', round(a, 1)::double)",
}
_DIGITS = {"0.0%": "round(a * 100, 1)", "#,0": "round(a, 0)", "0.00": "round(a, 2)", "$#,0.00": "round(a, 2)", "0.##": "round(a, 2)", '#,##0.0 "items"': "round(a, 1)", "0000": "round(a, 0)", "#.00": "round(a, 2)", "#,0;;zero": "round(a, 0)", "\\x0.0": "round(a, 1)"}
_TEXT = lambda t: "'" + t.replace("'", "''") + "'"
_VALUES = "case s_suppkey % 5 when 0 then 0 when 1 then -s_acctbal when 2 then s_acctbal / 100000 when 3 then s_acctbal end"


@query(f"""with x as (select s_suppkey, ({_VALUES})::decimal(18,2)::decimal(18,6) / 1 as v0, k from supplier, (select unnest(range({len(FORMATS)})) as k)), y as (select s_suppkey, k, (case s_suppkey % 5 when 2 then s_acctbal::decimal(18,2) / 100000 else {_VALUES} end)::decimal(18,6) as v from (select supplier.*, unnest(range({len(FORMATS)})) as k from supplier)),
  z as (select s_suppkey, k, v, abs(v) as a from y)
  select s_suppkey, k::int as k, case when v is null then null {' '.join(f"when k = {k} then (select {_FORMAT_SQL[f].replace('sg', f"(case when v < 0 and {_DIGITS.get(f, '1')} > 0 then '-' else '' end)")})" for k, f in enumerate(FORMATS))} end as shown from z""")
def format_sections(spark, sf):
    """Values above, below and at zero, small ones and blanks by every kind of format text."""
    v = F.when(_c("s_suppkey") % 5 == 2, (_c("s_acctbal").cast("decimal(18,2)") / F.lit(100000)).cast("decimal(18,6)")).otherwise(F.expr(_VALUES).cast("decimal(18,6)"))
    rows = lake(spark, sf, "supplier").select("s_suppkey", v.alias("v"), F.posexplode(F.array(*map(F.lit, FORMATS))).alias("k", "fmt"))
    return by_format(rows, "v", "fmt", "shown").select("s_suppkey", "k", "shown")


_BODIES = """select distinct name, params, case when params = '' then '''a'' || ''b''' when params like '%STRING%' then 'upper(b) || case when a > 5000 then ''b!'' else ''a?'' end' else 'cast(cast(round(a * 2) as bigint) as string)' end as body from {functions} where project_id = 0"""


@query(f"""with {fleet_sql('functions')}, f as (select distinct name, params from functions where project_id = 0)
  select s_suppkey, f.name, case when params = '' then 'ab' when contains(params, 'STRING') then upper(s_name) || case when s_acctbal > 5000 then 'b!' else 'a?' end else (round(s_acctbal * 2)::bigint)::varchar end as value from supplier, f""")
def typed_functions(spark, sf):
    """A model's functions, built from their rows with typed parameters, on every supplier; a project's functions are few."""
    rows = spark.sql(_BODIES, functions=fleet(spark, sf, "functions")).limit(1000).collect()
    made = [F.struct(F.lit(r.name).alias("name"), applied(r.params, r.body, {"a": "s_acctbal", "b": "s_name"}).alias("value")) for r in sorted(rows)]
    return lake(spark, sf, "supplier").select("s_suppkey", F.explode(F.array(*made)).alias("f")).select("s_suppkey", "f.name", "f.value")
