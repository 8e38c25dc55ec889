"""Questions over a fleet's catalog tables: listings, search, audits, lineage and bulk changes.

The catalog tables of many projects are derived from the lake by rules (shim views), so that every question runs at the
lake's scale. The rules are written once for Spark and once for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import packs
from ..functions.order import ranks
from ..sources.frames import RELATIONSHIPS, lake
from ..sources.frames import cut as _cut
from ..sources.frames import written
from .graphs import ancestry, longest_chains, reach_counts, reach_index, reaches

_c = F.col
QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def measures(spark, sf) -> DataFrame:
    """project_id, table_name, name, display_folder, is_hidden, format_string, expression (in the manner of a formula)."""
    k = _c("p_partkey")
    ref = F.concat(F.lit("["), F.lit("M"), F.floor(k / 2).cast("string"), F.lit("]"))
    text = (
        F.when(k % 11 == 0, F.concat(F.lit("IFERROR("), ref, F.lit(", 0)"))).when(k % 13 == 0, F.concat(ref, F.lit(" / 2"))).when(k % 17 == 0, F.concat(F.lit("CALCULATE("), ref, F.lit(", Cal[Year] = 2024)")))
        .when(k % 19 == 0, F.lit(" ")).otherwise(F.concat(F.lit("DIVIDE("), ref, F.lit(", 2)")))
    )
    return lake(spark, sf, "part").select(
        (k % 20).alias("project_id"), _c("p_brand").alias("table_name"), F.concat(F.lit("M"), k.cast("string")).alias("name"), F.when(_c("p_size") % 5 != 0, _c("p_type")).alias("display_folder"),
        (_c("p_size") % 7 == 0).alias("is_hidden"), F.element_at(F.array(F.lit(None), F.lit("0.0%"), F.lit("#,0")), (_c("p_size") % 3 + 1).cast("int")).alias("format_string"), text.alias("expression"), "p_partkey",
    )


MEASURES_SQL = """m as (select p_partkey % 20 as project_id, p_brand as table_name, 'M' || p_partkey as name, case when p_size % 5 <> 0 then p_type end as display_folder, p_size % 7 = 0 as is_hidden,
  case p_size % 3 when 1 then '0.0%' when 2 then '#,0' end as format_string, p_partkey,
  case when p_partkey % 11 = 0 then 'IFERROR([M' || (p_partkey // 2) || '], 0)' when p_partkey % 13 = 0 then '[M' || (p_partkey // 2) || '] / 2' when p_partkey % 17 = 0 then 'CALCULATE([M' || (p_partkey // 2) || '], Cal[Year] = 2024)'
  when p_partkey % 19 = 0 then ' ' else 'DIVIDE([M' || (p_partkey // 2) || '], 2)' end as expression from part)"""

@query("select c_custkey, n_name as nation, r_name as region from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey where c_name not like 'RowNumber-%'")
def resolve_ids(spark, sf):
    n = lake(spark, sf, "nation").join(lake(spark, sf, "region"), _c("n_regionkey") == _c("r_regionkey"), "left")
    return lake(spark, sf, "customer").filter("c_name not like 'RowNumber-%'").join(n, _c("c_nationkey") == _c("n_nationkey"), "left").select("c_custkey", _c("n_name").alias("nation"), _c("r_name").alias("region"))


@query("select p_partkey, p_brand as type_, (p_size > 10)::varchar as required from part")
def parse_meta_map(spark, sf):
    p = lake(spark, sf, "part").select("p_partkey", F.concat(F.lit('"x" meta [IsParameterQuery=true, Type="'), "p_brand", F.lit('", Required='), (_c("p_size") > 10).cast("string"), F.lit("]")).alias("e"))
    meta = F.str_to_map(F.regexp_extract("e", r"meta\s*\[([^\]]+)\]\s*$", 1), F.lit(","), F.lit("="))
    meta = F.transform_values(F.transform_keys(meta, lambda k, v: F.trim(k)), lambda k, v: F.regexp_replace(v, '^"|"$', ""))
    return p.select("p_partkey", meta["Type"].alias("type_"), meta["Required"].alias("required"))


@query(f"with {MEASURES_SQL} select project_id, table_name, count(*) as measures, count_if(is_hidden) as hidden, count(distinct display_folder) as folders from m group by 1, 2")
def list_tables(spark, sf):
    return measures(spark, sf).groupBy("project_id", "table_name").agg(F.count("*").alias("measures"), F.count_if("is_hidden").alias("hidden"), F.count_distinct("display_folder").alias("folders"))


@query(f"with {MEASURES_SQL} select project_id, name, coalesce(is_hidden, false) as is_hidden, format_string from m where table_name = 'Brand#1' or display_folder like 'STANDARD%'")
def list_measures(spark, sf):
    return measures(spark, sf).filter("table_name = 'Brand#1' or display_folder like 'STANDARD%'").select("project_id", "name", F.coalesce("is_hidden", F.lit(False)).alias("is_hidden"), "format_string")


def edges(spark, sf) -> DataFrame:
    """project-wide references: src measure -> dst measure, by the names in brackets that are measures; itself excluded."""
    m = measures(spark, sf)
    refs = m.select(_c("name").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all("expression", F.lit(r"\[([^\]]+)\]"), 1))).alias("dst"))
    return refs.join(m.select(_c("name").alias("dst")), "dst", "left_semi").filter("src <> dst").select("src", "dst")


_EDGES = f"{MEASURES_SQL}, e as (select distinct src, dst from (select name as src, unnest(regexp_extract_all(expression, '\\[([^\\]]+)\\]', 1)) as dst from m) where dst in (select name from m) and src <> dst)"


@query(f"with {_EDGES} select src, dst from e")
def dep_edges(spark, sf):
    return edges(spark, sf)


@query(f"with {_EDGES}, p as (select src as name, 'depends_on' as relation, dst as other from e union all select dst, 'used_by', src from e) select name, relation, other, count(*) over (partition by name, relation) as n from p union all select name, 'isolated', null, 0 from m where name not in (select name from p)")
def dep_summary(spark, sf):
    """What each measure needs and what needs it, a row each with the number of such rows: a measure that all others need is no list in one row."""
    e = edges(spark, sf)
    p = e.select(_c("src").alias("name"), F.lit("depends_on").alias("relation"), _c("dst").alias("other")).unionByName(e.select(_c("dst").alias("name"), F.lit("used_by").alias("relation"), _c("src").alias("other")))
    counted = p.join(p.groupBy("name", "relation").agg(F.count("*").alias("n")), ["name", "relation"])
    alone = measures(spark, sf).select("name").join(p.select("name").distinct(), "name", "left_anti")
    return counted.select("name", "relation", "other", "n").unionByName(alone.select("name", F.lit("isolated").alias("relation"), F.lit(None).cast("string").alias("other"), F.lit(0).cast("long").alias("n")))


@query(f"with {_EDGES}, k as (select src, dst, (row_number() over (partition by src order by dst) - 1) // 100 as piece from e) select src || ' -> ' || string_agg(dst, ', ' order by dst) as line, piece::bigint as piece from k group by src, piece union all select name || ' (isolated)', 0 from m where name not in (select src from e union select dst from e)")
def dep_adjacency(spark, sf):
    """Lines of what a measure needs, a hundred names each at most, and the measures that neither need nor are needed."""
    e = edges(spark, sf)
    k = ranks(e.withColumn("order_", _c("dst")), "src", "order_", rising=True).withColumn("piece", F.floor((_c("rank_") - 1) / 100))
    lines = k.groupBy("src", "piece").agg(F.array_join(F.array_sort(F.collect_list("dst")), ", ").alias("to")).select(F.concat("src", F.lit(" -> "), "to").alias("line"), "piece")
    used = e.select(_c("src").alias("name")).union(e.select("dst")).distinct()
    alone = measures(spark, sf).select("name").join(used, "name", "left_anti").select(F.concat("name", F.lit(" (isolated)")).alias("line"), F.lit(0).cast("long").alias("piece"))
    return lines.unionByName(alone)


@query(f"with recursive {_EDGES}, r(name, top, k) as (select name, name, 0 from m union all select e.dst, r.top, k + 1 from r join e on e.src = r.name) select top as name, max(k) as depth from r group by 1")
def dep_depth(spark, sf):
    return longest_chains(measures(spark, sf).select("name"), edges(spark, sf))


@query(f"with recursive {_EDGES}, r(src, dst, k) as (select src, dst, 1 from e union select r.src, e.dst, k + 1 from r join e on e.src = r.dst) select src, count(distinct dst) as upstream, max(k) as hops from r group by 1")
def dep_closure(spark, sf):
    """How many measures each one needs, directly or not, and how long its longest chain is; from a reachability index, not from pairs."""
    e = written(edges(spark, sf))
    depth = longest_chains(e.select(_c("src").alias("name")).union(e.select("dst")).distinct(), e)
    return reach_counts(e).join(depth, "name").filter("depth > 0").select(_c("name").alias("src"), _c("reached").alias("upstream"), _c("depth").alias("hops"))


@query(f"with recursive {_EDGES}, r(src, dst) as (select src, dst from e union select r.src, e.dst from r join e on e.src = r.dst), q as (select l_returnflag, 'M' || l_partkey as src, 'M' || l_suppkey as dst from lineitem) select l_returnflag, count(*) as asked, count(r.src) as reached from q left join r on r.src = q.src and r.dst = q.dst group by 1")
def dep_reaches(spark, sf):
    """Whether one measure needs another, for many pairs at once: each is an equality join with the index and a comparison of positions."""
    pairs = lake(spark, sf, "lineitem").select("l_returnflag", F.concat(F.lit("M"), _c("l_partkey").cast("string")).alias("src"), F.concat(F.lit("M"), _c("l_suppkey").cast("string")).alias("dst"))
    return reaches(pairs, *reach_index(edges(spark, sf))).groupBy("l_returnflag").agg(F.count("*").alias("asked"), F.count_if("reached").alias("reached"))


@query("with recursive g as (select p_partkey as src, (p_partkey * 7 + 3) % (select count(*) from part) as dst from part where p_partkey < (select count(*) from part)), r(src, dst, k) as (select src, dst, 1 from g union select r.src, g.dst, k + 1 from r join g on g.src = r.dst where k < 6) select distinct src as name from r where src = dst")
def short_cycles(spark, sf):
    p = lake(spark, sf, "part")
    n = p.agg(F.count("*").alias("n"))
    g = _cut(p.crossJoin(F.broadcast(n)).filter("p_partkey < n").select(_c("p_partkey").alias("src"), ((_c("p_partkey") * 7 + 3) % _c("n")).alias("dst")))
    walk, found = g, g.filter("src = dst").select("src")
    for _ in range(5):
        walk = walk.select("src", _c("dst").alias("via")).join(g.select(_c("src").alias("via"), "dst"), "via").select("src", "dst").distinct()
        found = found.unionByName(walk.filter("src = dst").select("src"))
    return found.distinct().select(_c("src").alias("name"))


@query(f"with {MEASURES_SQL} select project_id, coalesce(display_folder, '(root)') as folder, count(*) as measures, count(distinct table_name) as tables from m group by 1, 2")
def display_folders(spark, sf):
    return measures(spark, sf).groupBy("project_id", F.coalesce("display_folder", F.lit("(root)")).alias("folder")).agg(F.count("*").alias("measures"), F.count_distinct("table_name").alias("tables"))


@query(f"with {MEASURES_SQL} select project_id, count(*) as measures, count(distinct table_name) as tables, count(distinct display_folder) as folders, count_if(format_string is null) as unformatted from m group by 1")
def project_info(spark, sf):
    return measures(spark, sf).groupBy("project_id").agg(F.count("*").alias("measures"), F.count_distinct("table_name").alias("tables"), F.count_distinct("display_folder").alias("folders"), F.count_if(_c("format_string").isNull()).alias("unformatted"))


@query("select doc_id, case when a and b then 'both' when a then 'name' else 'expression' end as matched_in, case when length(text) > 200 then substr(text, 1, 200) || '...' else text end as preview from (select *, contains(lower(source), 'src1') as a, contains(lower(text), 'ouer') as b from documents) where a or b")
def search_text(spark, sf):
    d = lake(spark, sf, "documents").withColumns({"a": F.lower("source").contains("src1"), "b": F.lower("text").contains("ouer")}).filter("a or b")
    return d.select("doc_id", F.when(_c("a") & _c("b"), "both").when(_c("a"), "name").otherwise("expression").alias("matched_in"), F.when(F.length("text") > 200, F.concat(F.substring("text", 1, 200), F.lit("..."))).otherwise(_c("text")).alias("preview"))


@query("with b as (select l_orderkey as visual, case when l_quantity = 1 then 'Nowhere' else p_brand end as entity, case when l_linenumber = 7 then p_name || '?' else p_name end as property from lineitem join part on l_partkey = p_partkey) select case when entity not in (select p_brand from part) then 'missing_table' when not exists (select 1 from part where p_brand = entity and p_name = property) then 'missing_measure' else 'valid' end as verdict, count(*) as n, count(distinct visual) as visuals from b group by 1")
def binding_audit(spark, sf):
    p = lake(spark, sf, "part")
    li = lake(spark, sf, "lineitem").join(p, _c("l_partkey") == _c("p_partkey"))
    b = li.select(_c("l_orderkey").alias("visual"), F.when(_c("l_quantity") == 1, "Nowhere").otherwise(_c("p_brand")).alias("entity"), F.when(_c("l_linenumber") == 7, F.concat("p_name", F.lit("?"))).otherwise(_c("p_name")).alias("property"))
    known_t = p.select(_c("p_brand").alias("entity")).distinct().withColumn("t", F.lit(True))
    known_m = p.select(_c("p_brand").alias("entity"), _c("p_name").alias("property")).distinct().withColumn("m", F.lit(True))
    v = b.join(known_t, "entity", "left").join(known_m, ["entity", "property"], "left")
    return v.groupBy(F.when(_c("t").isNull(), "missing_table").when(_c("m").isNull(), "missing_measure").otherwise("valid").alias("verdict")).agg(F.count("*").alias("n"), F.count_distinct("visual").alias("visuals"))


@query("""select o_orderkey, coalesce(string_agg(distinct 'P.' || l_partkey, ',' order by 'P.' || l_partkey) filter (l_linenumber % 2 = 0), '') as columns, coalesce(string_agg(distinct 'S.' || l_suppkey, ',' order by 'S.' || l_suppkey) filter (l_linenumber % 2 <> 0), '') as measures, count(l_orderkey) as n
  from orders left join lineitem on l_orderkey = o_orderkey group by 1""")
def collect_minimal(spark, sf):
    """Two sorted lists without repeats for each holder of bindings, empty where there is none, and the number of bindings; an order has few lines."""
    j = lake(spark, sf, "orders").join(lake(spark, sf, "lineitem"), _c("l_orderkey") == _c("o_orderkey"), "left")
    even = _c("l_linenumber") % 2 == 0
    named = lambda cond, head, key: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.concat(F.lit(head), _c(key).cast("string"))))), ",")
    return j.groupBy("o_orderkey").agg(named(even, "P.", "l_partkey").alias("columns"), named(~even, "S.", "l_suppkey").alias("measures"), F.count("l_orderkey").alias("n"))


@query("""with k as (select distinct s_suppkey % 30 as n_nationkey from supplier where s_suppkey % 4 = 0), w as (select r_name as n_name from region union select n_name from nation where n_regionkey = 1)
  select n_nationkey, n_name, case when n_nationkey in (select n_nationkey from k) or n_name in (select n_name from w) then 'included' else 'excluded' end as status from nation
  union all select n_nationkey, null, 'unknown' from k where n_nationkey not in (select n_nationkey from nation) union all select null, n_name, 'unknown' from w where n_name not in (select n_name from nation)""")
def union_filter_unknowns(spark, sf):
    """Rows asked for by key or by name are included, the others excluded; keys and names that are asked for and not there are unknown."""
    n, said = lake(spark, sf, "nation").select("n_nationkey", "n_name"), F.lit(True)
    keys = lake(spark, sf, "supplier").filter("s_suppkey % 4 = 0").select((_c("s_suppkey") % 30).alias("n_nationkey")).distinct()
    names = lake(spark, sf, "region").select(_c("r_name").alias("n_name")).union(lake(spark, sf, "nation").filter("n_regionkey = 1").select("n_name")).distinct()
    found = n.join(keys.withColumn("k", said), "n_nationkey", "left").join(names.withColumn("w", said), "n_name", "left")
    rows = found.select("n_nationkey", "n_name", F.when(F.coalesce("k", "w"), "included").otherwise("excluded").alias("status"))
    unknown = lambda asked, column: asked.join(n, column, "left_anti").select(column, F.lit("unknown").alias("status"))
    return rows.unionByName(unknown(keys, "n_nationkey"), allowMissingColumns=True).unionByName(unknown(names, "n_name"), allowMissingColumns=True)


@query("select c_nationkey, case when n > 20 then array_to_string(a[1:20], ', ') || ' (+' || (n - 20) || ' more)' else array_to_string(a, ', ') end as names from (select c_nationkey, list(c_name order by c_name) as a, count(*) as n from customer group by 1)")
def capped_list(spark, sf):
    c = lake(spark, sf, "customer").select("c_nationkey", "c_name")
    first = c.withColumn("r", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.asc_nulls_last("c_name")))).filter("r <= 20")
    first = first.groupBy(_c("c_nationkey").alias("k")).agg(F.array_join(F.array_sort(F.collect_list("c_name")), ", ").alias("head"))
    g = c.groupBy("c_nationkey").agg(F.count("*").alias("n")).join(first, _c("c_nationkey").eqNullSafe(_c("k")))
    return g.select("c_nationkey", F.when(_c("n") > 20, F.concat("head", F.lit(" (+"), (_c("n") - 20).cast("string"), F.lit(" more)"))).otherwise(_c("head")).alias("names"))


_FOLDER_SQL = "case p_size % 4 when 0 then 'Plain' when 1 then 'Brass' end"
_MOVES_SQL = "case when starts_with(p_type, 'STANDARD') and current_folder is distinct from 'Plain' then 'Plain' when ends_with(p_type, 'BRASS') and current_folder is distinct from 'Brass' then 'Brass' when contains(p_type, 'O') and current_folder is distinct from 'Other' then 'Other' end"


@query(f"select * from (select p_partkey, current_folder, {_MOVES_SQL} as new_folder from (select p_partkey, p_type, {_FOLDER_SQL} as current_folder from part)) where new_folder is not null")
def classify_first_match(spark, sf):
    """The first rule that matches and would change the folder; a matching rule of the current folder is passed over."""
    rules = [(F.startswith, "STANDARD", "Plain"), (F.endswith, "BRASS", "Brass"), (F.contains, "O", "Other")]
    parts = lake(spark, sf, "part").select("p_partkey", "p_type", F.expr(_FOLDER_SQL).alias("current_folder"))
    first = [F.when(match(_c("p_type"), F.lit(pattern)) & ~_c("current_folder").eqNullSafe(folder), folder) for match, pattern, folder in rules]
    return parts.select("p_partkey", "current_folder", F.coalesce(*first).alias("new_folder")).filter("new_folder is not null")


@query("select doc_id, case when k = 0 then 'DAX' when k = 1 then 'MDX' when k = 2 then 'SQL' else 'unknown' end as kind from (select doc_id, doc_id % 4 as k from documents where text is not null)")
def classify_query_text(spark, sf):
    head = F.element_at(F.array(*map(F.lit, ("evaluate ", "with member ", "exec ", "zz "))), (_c("doc_id") % 4 + 1).cast("int"))
    t = F.upper(F.trim(F.concat(head, "text")))
    kind = F.when(t.rlike("^(EVALUATE|DEFINE|VAR)"), "DAX").when(t.rlike("^WITH") & t.rlike("MEMBER|SET"), "MDX").when(t.rlike("^SELECT") & t.rlike("FROM") & t.contains("["), "MDX").when(t.rlike("^(SELECT|EXEC|CALL|INSERT)"), "SQL").otherwise("unknown")
    return lake(spark, sf, "documents").filter("text is not null").select("doc_id", kind.alias("kind"))


# Bulk changes: a change table in, a new table and a report out; nothing is written.


@query("select c_custkey % 1000 as k, case when c_custkey % 1000 in (select s_suppkey from supplier) then 'exists' when row_number() over (partition by c_custkey % 1000 order by c_custkey) > 1 then 'duplicate in batch' else 'created' end as outcome, c_custkey from customer")
def bulk_insert_guarded(spark, sf):
    b = lake(spark, sf, "customer").select((_c("c_custkey") % 1000).alias("k"), "c_custkey")
    old = lake(spark, sf, "supplier").select(_c("s_suppkey").alias("k"), F.lit(True).alias("there"))
    n = F.row_number().over(Window.partitionBy("k").orderBy("c_custkey"))
    return b.join(old, "k", "left").select("k", F.when(_c("there"), "exists").when(n > 1, "duplicate in batch").otherwise("created").alias("outcome"), "c_custkey")


@query("select s_suppkey, case when s_suppkey % 3 = 0 then 'renamed ' || s_suppkey else s_name end as s_name, case when s_suppkey % 5 = 0 then 0 else s_acctbal end as s_acctbal from supplier")
def bulk_update_coalesce(spark, sf):
    s = lake(spark, sf, "supplier")
    change = s.filter("s_suppkey % 3 = 0 or s_suppkey % 5 = 0").select("s_suppkey", F.when(_c("s_suppkey") % 3 == 0, F.concat(F.lit("renamed "), _c("s_suppkey").cast("string"))).alias("n"), F.when(_c("s_suppkey") % 5 == 0, 0.0).alias("b"))
    return s.join(change, "s_suppkey", "left").select("s_suppkey", F.coalesce("n", "s_name").alias("s_name"), F.coalesce("b", "s_acctbal").alias("s_acctbal"))


@query("select p_partkey, coalesce(n, 0) as blockers, coalesce(n, 0) = 0 as deleted from part left join (select l_partkey, count(*) as n from lineitem group by 1) on l_partkey = p_partkey where p_size = 3")
def guarded_delete(spark, sf):
    n = lake(spark, sf, "lineitem").groupBy(_c("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return lake(spark, sf, "part").filter("p_size = 3").select("p_partkey").join(n, "p_partkey", "left").select("p_partkey", F.coalesce("n", F.lit(0)).alias("blockers"), _c("n").isNull().alias("deleted"))


@query("""with r as (select n_nationkey as k, n_nationkey + 20 as fresh, n_nationkey + 20 in (select n_nationkey from nation) as taken from nation where n_nationkey % 4 = 0), h as (select 'customer' as kind, c_custkey as host, c_nationkey as k from customer union all select 'supplier', s_suppkey, s_nationkey from supplier)
  select kind, host, case when not taken then fresh else h.k end as nationkey, case when taken then 'name taken' when fresh is not null then 'moved' else 'kept' end as outcome from h left join r on r.k = h.k""")
def rename_cascade(spark, sf):
    """A key renamed in every table that refers to it; a rename to a key that is there already is refused and changes nothing."""
    n = lake(spark, sf, "nation").select("n_nationkey")
    renames = n.filter("n_nationkey % 4 = 0").select(_c("n_nationkey").alias("k"), (_c("n_nationkey") + 20).alias("fresh"))
    renames = renames.join(n.select(_c("n_nationkey").alias("fresh"), F.lit(True).alias("taken")), "fresh", "left")
    side = lambda t, host, k: lake(spark, sf, t).select(F.lit(t).alias("kind"), _c(host).alias("host"), _c(k).alias("k"))
    hosts = side("customer", "c_custkey", "c_nationkey").unionByName(side("supplier", "s_suppkey", "s_nationkey")).join(renames, "k", "left")
    outcome = F.when(_c("taken"), "name taken").when(_c("fresh").isNotNull(), "moved").otherwise("kept")
    return hosts.select("kind", "host", F.coalesce(F.when(_c("taken").isNull(), _c("fresh")), "k").alias("nationkey"), outcome.alias("outcome"))


@query("with o as (select p_partkey as host, 'Note' as name, p_brand as value from part where p_partkey % 2 = 0 union all select p_partkey, 'Owner', p_type from part where p_partkey % 5 = 0), d as (select p_partkey as host, case when p_partkey % 6 = 0 then 'Owner' else 'Note' end as name from part where p_partkey % 3 = 0) select coalesce(o.host, d.host) as host, coalesce(o.name, d.name) as name, o.value, case when o.host is null then 'not found' when d.host is null then 'kept' else 'deleted' end as outcome from o full join d on o.host = d.host and o.name = d.name")
def annotation_delete(spark, sf):
    """Annotations with deletions by host and name: kept, deleted, or asked for and not found."""
    p = lake(spark, sf, "part")
    note = lambda cond, name, v: p.filter(cond).select(_c("p_partkey").alias("host"), F.lit(name).alias("name"), _c(v).alias("value"), F.lit(True).alias("o"))
    old = note("p_partkey % 2 = 0", "Note", "p_brand").unionByName(note("p_partkey % 5 = 0", "Owner", "p_type"))
    gone = p.filter("p_partkey % 3 = 0").select(_c("p_partkey").alias("host"), F.when(_c("p_partkey") % 6 == 0, "Owner").otherwise("Note").alias("name"), F.lit(True).alias("d"))
    return old.join(gone, ["host", "name"], "full").select("host", "name", "value", F.when(_c("o").isNull(), "not found").when(_c("d").isNull(), "kept").otherwise("deleted").alias("outcome"))


@query("with o as (select p_partkey as host, p_brand as v from part where p_partkey % 2 = 0), n as (select p_partkey as host, p_type as v from part where p_partkey % 3 = 0) select coalesce(o.host, n.host) as host, coalesce(n.v, o.v) as value, o.host is null as created from o full join n on o.host = n.host")
def annotation_upsert(spark, sf):
    p = lake(spark, sf, "part")
    o, n = p.filter("p_partkey % 2 = 0").select(_c("p_partkey").alias("host"), _c("p_brand").alias("o")), p.filter("p_partkey % 3 = 0").select(_c("p_partkey").alias("host"), _c("p_type").alias("n"))
    return o.join(n, "host", "full").select("host", F.coalesce("n", "o").alias("value"), _c("o").isNull().alias("created"))


@query("select p_partkey, regexp_matches(p_name, '^[A-Za-z_][A-Za-z0-9_ ]*$') as identifier, length(p_name) between 1 and 256 as label, not regexp_matches(p_name, '[\\x00-\\x1f]') as printable from part")
def name_guards(spark, sf):
    n = _c("p_name")
    return lake(spark, sf, "part").select("p_partkey", n.rlike("^[A-Za-z_][A-Za-z0-9_ ]*$").alias("identifier"), F.length(n).between(1, 256).alias("label"), (~n.rlike(r"[\x00-\x1f]")).alias("printable"))


# Security


@query("select count(*) as n, sum(l_quantity::decimal(18,2))::double as quantity from lineitem where l_orderkey in (select o_orderkey from orders where o_custkey in (select c_custkey from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name in ('ASIA', 'EUROPE')))")
def rls_apply(spark, sf):
    keys = lake(spark, sf, "region").filter(_c("r_name").isin("ASIA", "EUROPE")).select(_c("r_regionkey").alias("k"))
    for name in ("nation_region", "customer_nation", "orders_customer", "lineitem_orders"):
        fact, x, _, _, _ = RELATIONSHIPS[name]
        own = {"nation": "n_nationkey", "customer": "c_custkey", "orders": "o_orderkey", "lineitem": None}[fact]
        seen = lake(spark, sf, fact).join(keys, _c(x) == _c("k"), "left_semi")
        keys = seen.select(_c(own).alias("k")) if own else seen
    return keys.agg(F.count("*").alias("n"), F.sum(_c("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))


@query("select u as user_id, count(*) as customers from customer join (select n_nationkey, n_nationkey % 5 as u from nation union select n_nationkey, 9 from nation where n_nationkey < 3) on c_nationkey = n_nationkey group by 1")
def rls_dynamic(spark, sf):
    n = lake(spark, sf, "nation")
    users = n.select("n_nationkey", (_c("n_nationkey") % 5).alias("user_id")).union(n.filter("n_nationkey < 3").select("n_nationkey", F.lit(9))).distinct()
    return lake(spark, sf, "customer").join(users, _c("c_nationkey") == _c("n_nationkey")).groupBy("user_id").agg(F.count("*").alias("customers"))


@query("select r_name as role, count(c_custkey) as visible, round(count(c_custkey) / (select count(*) from customer), 6) as share from region left join nation on n_regionkey = r_regionkey left join customer on c_nationkey = n_nationkey group by 1")
def rls_coverage(spark, sf):
    c = lake(spark, sf, "customer")
    seen = lake(spark, sf, "region").join(lake(spark, sf, "nation"), _c("n_regionkey") == _c("r_regionkey"), "left").join(c, _c("c_nationkey") == _c("n_nationkey"), "left")
    n = c.agg(F.count("*").alias("all"))
    return seen.groupBy(_c("r_name").alias("role")).agg(F.count("c_custkey").alias("visible")).crossJoin(F.broadcast(n)).select("role", "visible", F.round(_c("visible") / _c("all"), 6).alias("share"))


@query("select c_custkey, c_name, c_nationkey, c_mktsegment from customer")
def ols_apply(spark, sf):
    return lake(spark, sf, "customer").drop("c_acctbal")


_BOSSES = """with recursive t as (select p_partkey as id, nullif(p_partkey // 3, 0) as boss from part), r(id, root, path) as (select id, id, [id] from t where boss is null or boss not in (select id from t)
  union all select t.id, r.root, list_append(r.path, t.id) from r join t on t.boss = r.id), up as (select id, unnest(path) as above from r)"""


def _staff(spark, sf) -> DataFrame:
    return lake(spark, sf, "part").select(_c("p_partkey").alias("name"), F.nullif(F.floor(_c("p_partkey") / 3), F.lit(0)).alias("parent"))


@query(_BOSSES + """, n as (select above as id, count(*) as n from up group by 1) select r.id, root, len(path) - 1 as depth, row_number() over (partition by root order by path) as enter_, row_number() over (partition by root order by path) + n - 1 as leave_ from r join n using (id)""")
def rls_hierarchy(spark, sf):
    """Every person's place in the tree of managers: a manager sees those of one root whose enter_ lies between own enter_ and leave_."""
    return ancestry(_staff(spark, sf)).select(_c("name").alias("id"), "root", "depth", _c("enter").alias("enter_"), _c("leave").alias("leave_"))


@query(_BOSSES + " select l_returnflag, count(*) as asked, count(above) as visible from lineitem left join up on up.id = l_partkey and up.above = l_suppkey group by 1")
def rls_is_above(spark, sf):
    """Rows that a manager (l_suppkey) may see as they belong to someone below (l_partkey), or to themselves: two joins by key and a comparison of numbers."""
    n = written(ancestry(_staff(spark, sf)))
    side = lambda k, end: n.select(_c("name").alias(k), *(_c(c).alias(f"{end}_{c}") for c in ("root", "enter", "leave")))
    rows = lake(spark, sf, "lineitem").select("l_returnflag", "l_partkey", "l_suppkey").join(side("l_partkey", "own"), "l_partkey", "left").join(side("l_suppkey", "boss"), "l_suppkey", "left")
    sees = (_c("own_root") == _c("boss_root")) & _c("own_enter").between(_c("boss_enter"), _c("boss_leave"))
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("asked"), F.count_if(sees).alias("visible"))


# Texts

REDACTED = "[Connection string redacted]"


@query(f"select page_id, regexp_replace(url, 'https?://[^\\s\"'']+', '{REDACTED}', 'gi') as url from pages")
def redact_text(spark, sf):
    return lake(spark, sf, "pages").select("page_id", F.regexp_replace("url", r"(?i)https?://[^\s\"']+", REDACTED).alias("url"))


@query("select doc_id, (length(t) - length(replace(t, '(', ''))) - (length(t) - length(replace(t, ')', ''))) as open_, (length(t) - length(replace(t, '[', ''))) - (length(t) - length(replace(t, ']', ''))) as brackets from (select doc_id, coalesce(text, '') as t from documents)")
def check_balance(spark, sf):
    t = F.coalesce("text", F.lit(""))
    n = lambda ch: F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))
    return lake(spark, sf, "documents").select("doc_id", (n("(") - n(")")).cast("long").alias("open_"), (n("[") - n("]")).cast("long").alias("brackets"))


@query("select p_partkey, case when p_partkey % 3 = 0 then format('{:,}', round(p_retailprice)::bigint) when p_partkey % 3 = 1 then p_size || '.0%' else '$' || format('{:,}', p_partkey) end as shown from part")
def format_values(spark, sf):
    k = _c("p_partkey") % 3
    return lake(spark, sf, "part").select("p_partkey", F.when(k == 0, F.format_number(F.round("p_retailprice").cast("long"), 0)).when(k == 1, F.expr("format_number(p_size / 100, '0.0%')")).otherwise(F.concat(F.lit("$"), F.format_number("p_partkey", 0))).alias("shown"))


@query("""select p_partkey, lpad(p_size::varchar, 6, '0') as padded, rpad(p_brand, 12, '.') as padded_right, printf('%05.2f', round(p_size / 7, 2)) as number_, printf('%.1f%%', round(100 * (p_size / 64), 1)) as percent_, '$' || format('{:,.2f}', round(p_retailprice, 2)) as currency_ from part""")
def udf_format_pack(spark, sf):
    k, size = _c("p_partkey"), _c("p_size")
    shown = {"padded": packs.pad_left(size, 6, "0"), "padded_right": packs.pad_right(_c("p_brand"), 12, "."), "number_": packs.format_number(size / 7, 2), "percent_": packs.format_percent(size / 64, 1), "currency_": packs.format_currency(_c("p_retailprice"), "$")}
    return lake(spark, sf, "part").select(k, *(v.alias(n) for n, v in shown.items()))


@query("""select o_orderkey, case when r >= 1 then '%2322C55E' when r >= 0.8 then '%23F59E0B' else '%23EF4444' end as color, chr(case when r >= 1 then 9989 when r >= 0.8 then 9888 else 10060 end) as icon, chr(case when v > b then 9650 when v < b then 9660 else 9644 end) || ' ' as arrow,
  case when v >= t then '+' else '' end || printf('%.1f%%', round(case when t <> 0 then (v - t) / t else 0 end * 100, 1) + 0.0) as variance from (select *, case when t <> 0 then v / t else 0 end as r from (select o_orderkey, o_totalprice as v, (o_orderkey % 5 * 50000)::double as t, (o_orderkey % 7 * 30000)::double as b from orders))""")
def udf_kpi_pack(spark, sf):
    v, t, before = _c("o_totalprice"), (_c("o_orderkey") % 5 * 50000).cast("double"), (_c("o_orderkey") % 7 * 30000).cast("double")
    shown = {"color": packs.status_color(v, t), "icon": packs.status_icon(v, t), "arrow": packs.trend_arrow(v, before), "variance": packs.variance_format(v, t)}
    return lake(spark, sf, "orders").select("o_orderkey", *(x.alias(n) for n, x in shown.items()))


@query("""select p_partkey, '<b>' || p_name || '</b>' as bold, '<i>' || p_brand || '</i>' as italic, '<span style=''color:red''>' || p_type || '</span>' as colored, '<span style=''font-size:12px''>' || p_name || '</span>' as sized from part""")
def udf_markup_pack(spark, sf):
    name = _c("p_name")
    shown = {"bold": packs.html_bold(name), "italic": packs.html_italic(_c("p_brand")), "colored": packs.html_color(_c("p_type"), "red"), "sized": packs.html_size(name, 12)}
    return lake(spark, sf, "part").select("p_partkey", *(x.alias(n) for n, x in shown.items()))


@query("select event_id, k as path, v as value from (select event_id, unnest(json_keys(props)) as k, props from events), lateral (select json_extract_string(props, '$.' || k) as v)")
def json_path_walk(spark, sf):
    e = lake(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return e.select("event_id", F.explode("m").alias("path", "value"))
