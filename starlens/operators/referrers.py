"""Listings of the fleet's catalogs and who refers to what: columns, named expressions, calculation groups, cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.fleet import fleet, fleet_sql
from ..sources.frames import lake
from .graphs import components
from .rules import _REFS, all_formulas, references, together

_c = F.col
QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _joined(c: str) -> Column:
    return F.array_join(F.array_sort(F.collect_list(c)), ",")


@query(f"""with {fleet_sql('relationships')} select project_id, name, from_table || '.' || from_column as from_, to_table || '.' || to_column as to_, coalesce(from_card, 'many') as from_card, coalesce(to_card, 'one') as to_card,
  coalesce(cross_filter, 'oneDirection') as cross_filter, coalesce(is_active, true) as is_active from relationships where from_table = 'T1' or to_table in ('T1', 'T65')""")
def list_relationships(spark, sf):
    r = fleet(spark, sf, "relationships").filter(_c("from_table").isin("T1") | _c("to_table").isin("T1", "T65"))
    default = lambda n, v: F.coalesce(n, F.lit(v)).alias(n)
    return r.select(
        "project_id", "name", F.concat_ws(".", "from_table", "from_column").alias("from_"), F.concat_ws(".", "to_table", "to_column").alias("to_"),
        default("from_card", "many"), default("to_card", "one"), default("cross_filter", "oneDirection"), default("is_active", True),
    )


@query(f"""with {fleet_sql('roles', 'role_filters')} select r.project_id, r.role, any_value(permission) as permission, count(filter) as filters, coalesce(count_if(metadata = 'none'), 0) as hidden, coalesce(string_agg(table_name, ',' order by table_name), '') as tables
  from roles r left join role_filters f on f.project_id = r.project_id and f.role = r.role group by 1, 2""")
def list_roles(spark, sf):
    f = fleet(spark, sf, "role_filters").groupBy("project_id", "role").agg(F.count("filter").alias("filters"), F.count_if(_c("metadata") == "none").alias("hidden"), _joined("table_name").alias("tables"))
    return fleet(spark, sf, "roles").join(f, ["project_id", "role"], "left").na.fill(0, ["filters", "hidden"]).na.fill("", ["tables"])


@query(f"with {fleet_sql('functions')} select project_id, name, case when params = '' then 0 else len(string_split(params, ', ')) end as n_params, nullif(regexp_extract(params, ': ([A-Z0-9]+)', 1), '') as first_type, tag is not null as has_tag, package from functions")
def list_functions(spark, sf):
    n = F.when(_c("params") == "", 0).otherwise(F.size(F.split("params", ", ")))
    return fleet(spark, sf, "functions").select("project_id", "name", n.alias("n_params"), F.nullif(F.regexp_extract("params", ": ([A-Z0-9]+)", 1), F.lit("")).alias("first_type"), _c("tag").isNotNull().alias("has_tag"), "package")


@query("select o_orderkey, count(*) as n, count(distinct l_partkey) as parts from orders join lineitem on l_orderkey = o_orderkey where l_returnflag in ('R', 'A') group by 1")
def list_children(spark, sf):
    """With a filter on the children, parents left without one are left out."""
    n = lake(spark, sf, "lineitem").filter(_c("l_returnflag").isin("R", "A")).groupBy(_c("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.count_distinct("l_partkey").alias("parts"))
    return lake(spark, sf, "orders").select("o_orderkey").join(n, "o_orderkey")


@query(f"with {fleet_sql('tables')} select coalesce(mode, 'import') as mode, case when source in ('calculated', 'entity') then source else 'm' end as source, count(*) as n, count_if(source not in ('m', 'calculated', 'entity')) as unknown from tables group by 1, 2")
def partition_inventory(spark, sf):
    s = _c("source")
    kind = F.when(s.isin("calculated", "entity"), s).otherwise("m")
    t = fleet(spark, sf, "tables").select(F.coalesce("mode", F.lit("import")).alias("mode"), kind.alias("source"), (~s.isin("m", "calculated", "entity")).alias("odd"))
    return t.groupBy("mode", "source").agg(F.count("*").alias("n"), F.count_if("odd").alias("unknown"))


@query(f"""with {fleet_sql('relationships')}, {_REFS}, uses as (select project_id, from_table as table_name, from_column as column_name, 'relationship' as kind, name as who from relationships union select project_id, to_table, to_column, 'relationship', name from relationships
    union select project_id, table_name, sort_by, 'sort', column_name from columns where sort_by is not null
    union select project_id, table_name, column_name, kind, own_table || '.' || own_name from qualified union select project_id, own_table, column_name, kind, own_table || '.' || own_name from bare)
  select u.project_id, u.table_name, u.column_name, u.kind, count(*) as n, min(who) as first from uses u join (select distinct project_id, table_name, column_name from columns) c on c.project_id = u.project_id and c.table_name = u.table_name and c.column_name = u.column_name
  where not (u.kind = 'column' and who = u.table_name || '.' || u.column_name) group by 1, 2, 3, 4""")
def column_referrers(spark, sf):
    """Who refers to a column: relationship ends, sort-by columns and formulas; bare brackets only within the column's table, its own formula not."""
    cols, rels = fleet(spark, sf, "columns"), fleet(spark, sf, "relationships")
    key = ["project_id", "table_name", "column_name"]
    end = lambda s: rels.select("project_id", _c(f"{s}_table").alias("table_name"), _c(f"{s}_column").alias("column_name"), F.lit("relationship").alias("kind"), _c("name").alias("who"))
    sort = cols.filter("sort_by is not null").select("project_id", "table_name", _c("sort_by").alias("column_name"), F.lit("sort").alias("kind"), _c("column_name").alias("who"))
    refs = references(all_formulas(spark, sf)).select("project_id", F.coalesce("table_name", "own_table").alias("table_name"), "column_name", "kind", F.concat_ws(".", "own_table", "own_name").alias("who"))
    itself = (_c("kind") == "column") & (_c("who") == F.concat_ws(".", "table_name", "column_name"))
    uses = together(end("from"), end("to"), sort, refs).filter(~itself).distinct()
    return uses.join(cols.select(*key).distinct(), key, "left_semi").groupBy(*key, "kind").agg(F.count("*").alias("n"), F.min("who").alias("first"))


@query(f"""with {fleet_sql('expressions')}, t as (select distinct project_id, name as referrer, unnest(regexp_extract_all(body, '[A-Za-z_][A-Za-z0-9_.]*')) as name from expressions),
  d as (select project_id, name as referrer, unnest(regexp_extract_all(body, '([A-Za-z_][A-Za-z0-9_.]*)\\s*=', 1)) as name from expressions)
  select project_id, name, referrer from t where (project_id, name) in (select (project_id, name) from expressions) and name <> referrer and (project_id, referrer, name) not in (select (project_id, referrer, name) from d)""")
def expression_referrers(spark, sf):
    """Whole-word mentions of named expressions, but for names that the mentioning text defines itself."""
    e = fleet(spark, sf, "expressions")
    words = lambda pattern, group: e.select("project_id", _c("name").alias("referrer"), F.explode(F.array_distinct(F.regexp_extract_all("body", F.lit(pattern), F.lit(group)))).alias("name"))
    known = words(r"[A-Za-z_][A-Za-z0-9_.]*", 0).filter("name <> referrer").join(e.select("project_id", "name"), ["project_id", "name"], "left_semi")
    return known.join(words(r"([A-Za-z_][A-Za-z0-9_.]*)\s*=", 1), ["project_id", "referrer", "name"], "left_anti").select("project_id", "name", "referrer")


@query(f"with {fleet_sql('tables')}, {_REFS} select distinct t.project_id, t.table_name, q.kind, own_table || '.' || own_name as referrer from qualified q join tables t on t.project_id = q.project_id and t.table_name = q.table_name where is_group and own_table <> t.table_name")
def group_referrers(spark, sf):
    groups = fleet(spark, sf, "tables").filter("is_group").select("project_id", "table_name")
    outside = references(all_formulas(spark, sf)).filter("table_name <> own_table").join(groups, ["project_id", "table_name"], "left_semi")
    return outside.select("project_id", "table_name", "kind", F.concat_ws(".", "own_table", "own_name").alias("referrer")).distinct()


@query("""with recursive g as (select p_partkey as src, case when p_partkey % 10 = 9 then p_partkey - 3 else p_partkey + 1 end as dst from part union select p_partkey, p_partkey + 10 from part where p_partkey % 10 = 0 and p_partkey % 50 <> 40),
  e as (select src, dst from g where dst in (select p_partkey from part)), r as (select src, dst from e union select r.src, e.dst from r join e on e.src = r.dst)
  select a.src as name, min(a.dst) as component from r as a join r as b on b.src = a.dst and b.dst = a.src group by 1""")
def dep_cycles(spark, sf):
    """Nodes on cycles with the smallest node of their component."""
    p = lake(spark, sf, "part").select(_c("p_partkey").alias("src"))
    g = p.withColumn("dst", F.when(_c("src") % 10 == 9, _c("src") - 3).otherwise(_c("src") + 1)).union(p.filter("src % 10 = 0 and src % 50 <> 40").withColumn("dst", _c("src") + 10))
    return components(g.join(p.select(_c("src").alias("dst")), "dst", "left_semi").select("src", "dst"))
