"""Change-sets over the fleet: a change table in, new catalog rows and reasons out; nothing is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.fleet import fleet, fleet_sql
from ..sources.frames import lake, written
from .rules import relationship_ends, together

_c = F.col
ENDS = ["from_table", "from_column", "to_table", "to_column"]
QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@query("""with b as (select l_suppkey as page, p_brand as entity, p_name as property, case when l_linenumber % 2 = 0 then p_brand || '.' || p_name else 'shown as ' || p_name end as label from lineitem join part on l_partkey = p_partkey),
  r as (select distinct p_brand as entity, p_name as property, p_name || ' v2' as fresh from part where p_size % 5 = 0)
  select page, count(*) as bindings, count(fresh) as rewritten, count_if(fresh is not null and label = b.entity || '.' || b.property) as labels, count(distinct coalesce(fresh, b.property)) as properties from b left join r on r.entity = b.entity and r.property = b.property group by 1""")
def binding_rewrite(spark, sf):
    """Bindings renamed by exact (entity, property); labels equal to entity.property follow, other labels stay; counts by page."""
    p = lake(spark, sf, "part")
    b = lake(spark, sf, "lineitem").join(p, _c("l_partkey") == _c("p_partkey")).select(
        _c("l_suppkey").alias("page"), _c("p_brand").alias("entity"), _c("p_name").alias("property"), F.when(_c("l_linenumber") % 2 == 0, F.concat_ws(".", "p_brand", "p_name")).otherwise(F.concat(F.lit("shown as "), "p_name")).alias("label")
    )
    renames = p.filter("p_size % 5 = 0").select(_c("p_brand").alias("entity"), _c("p_name").alias("property"), F.concat("p_name", F.lit(" v2")).alias("fresh")).distinct()
    done = b.join(renames, ["entity", "property"], "left")
    follows = _c("fresh").isNotNull() & (_c("label") == F.concat_ws(".", "entity", "property"))
    return done.groupBy("page").agg(F.count("*").alias("bindings"), F.count("fresh").alias("rewritten"), F.count_if(follows).alias("labels"), F.count_distinct(F.coalesce("fresh", "property")).alias("properties"))


_NEW_FILTERS = "n as (select project_id, role, table_name, '[Key] > 7' as fresh from role_filters where cast(substr(table_name, 2) as bigint) % 6 = 0)"


@query(f"""with {fleet_sql('role_filters')}, {_NEW_FILTERS}, old as (select f.*, (f.project_id, f.role) in (select (project_id, role) from n) as touched from role_filters f)
  select coalesce(o.project_id, n.project_id) as project_id, coalesce(o.role, n.role) as role, coalesce(o.table_name, n.table_name) as table_name, case when coalesce(touched, true) then fresh else filter end as filter, metadata
  from old o full join n on n.project_id = o.project_id and n.role = o.role and n.table_name = o.table_name where fresh is not null or metadata is not null or not touched""")
def role_update(spark, sf):
    """A role's row filters replaced by the given ones; what hides its tables is carried over, other roles stay as they are."""
    old = fleet(spark, sf, "role_filters")
    key = ["project_id", "role", "table_name"]
    new = old.filter(F.substr("table_name", F.lit(2)).cast("long") % 6 == 0).select(*key, F.lit("[Key] > 7").alias("fresh"))
    roles = new.select("project_id", "role").distinct().withColumn("touched", F.lit(True))
    both = old.join(new, key, "full").join(roles, ["project_id", "role"], "left")
    kept = both.filter("fresh is not null or metadata is not null or touched is null")
    return kept.select(*key, F.when(_c("touched"), _c("fresh")).otherwise(_c("filter")).alias("filter"), "metadata")


@query(f"""with {fleet_sql('tables')}, w as (select s_suppkey - s_suppkey % 64 as project_id, case when s_suppkey % 3 = 0 then 'T' else 'Group' end || s_suppkey as table_name from supplier), ok as (select * from w where (project_id, table_name) not in (select (project_id, table_name) from tables))
  select project_id, table_name, 'table' as part, table_name as name, null::int as ordinal from ok union all select project_id, table_name, 'ref', table_name, null from ok union all select project_id, table_name, 'column', unnest(['Name', 'Ordinal']), null from ok
  union all select project_id, table_name, 'item', unnest(['Current', 'YoY']), unnest([0, 1]) from ok union all select project_id, table_name, 'rejected', 'exists', null from w where (project_id, table_name) in (select (project_id, table_name) from tables)""")
def calc_group_create(spark, sf):
    """Each wanted group as rows of four catalog tables, items numbered in their order; groups whose name is taken are rejected."""
    s = _c("s_suppkey")
    wanted = lake(spark, sf, "supplier").select((s - s % 64).alias("project_id"), F.concat(F.when(s % 3 == 0, "T").otherwise("Group"), s.cast("string")).alias("table_name"))
    taken = fleet(spark, sf, "tables").select("project_id", "table_name").distinct().withColumn("taken", F.lit(True))
    row = lambda part, name, ordinal=None: F.struct(F.lit(part).alias("part"), name.alias("name"), F.lit(ordinal).cast("int").alias("ordinal"))
    made = F.array(row("table", _c("table_name")), row("ref", _c("table_name")), *(row("column", F.lit(n)) for n in ("Name", "Ordinal")), *(row("item", F.lit(n), i) for i, n in enumerate(("Current", "YoY"))))
    out = wanted.join(taken, ["project_id", "table_name"], "left").withColumn("rows", F.when(_c("taken"), F.array(row("rejected", F.lit("exists")))).otherwise(made))
    return out.select("project_id", "table_name", F.explode("rows").alias("r")).select("project_id", "table_name", "r.*")


@query(f"""with {fleet_sql('functions')}, b as (select p_partkey - p_partkey % 64 as project_id, 'New' || (p_partkey % 8) as package, 'Fn.' || p_partkey as name from part where p_partkey % 2 = 0), bad as (select distinct project_id, package from b where (project_id, name) in (select (project_id, name) from functions))
  select project_id, package, count(*) as functions, (project_id, package) not in (select (project_id, package) from bad) as installed, case when (project_id, package) in (select (project_id, package) from bad) then 'name taken' end as reason from b group by 1, 2""")
def package_install(spark, sf):
    """All functions of a package or none: one name that is taken rejects the package."""
    k = _c("p_partkey")
    b = lake(spark, sf, "part").filter("p_partkey % 2 = 0").select((k - k % 64).alias("project_id"), F.concat(F.lit("New"), (k % 8).cast("string")).alias("package"), F.concat(F.lit("Fn."), k.cast("string")).alias("name"))
    known = fleet(spark, sf, "functions").select("project_id", "name").distinct().withColumn("taken", F.lit(True))
    g = b.join(known, ["project_id", "name"], "left").groupBy("project_id", "package").agg(F.count("*").alias("functions"), F.count("taken").alias("clashes"))
    return g.select("project_id", "package", "functions", (_c("clashes") == 0).alias("installed"), F.when(_c("clashes") > 0, "name taken").alias("reason"))


@query(f"""with {fleet_sql('columns', 'tables', 'relationships')}, d as (select project_id, table_name, column_name from columns where pos % 9 = 0), u as (select project_id, from_table as table_name, from_column as column_name, name from relationships union all select project_id, to_table, to_column, name from relationships union all select project_id, table_name, sort_by, column_name from columns where sort_by is not null)
  select d.project_id, d.table_name, d.column_name, count(u.name) as blockers, count(u.name) = 0 as deleted from d left join u on u.project_id = d.project_id and u.table_name = d.table_name and u.column_name = d.column_name group by 1, 2, 3""")
def column_delete(spark, sf):
    """Columns asked to go; one that a relationship or a sort order uses stays, with the number of uses."""
    cols, rels = fleet(spark, sf, "columns"), fleet(spark, sf, "relationships")
    key = ["project_id", "table_name", "column_name"]
    end = lambda s: rels.select("project_id", _c(f"{s}_table").alias("table_name"), _c(f"{s}_column").alias("column_name"))
    uses = together(end("from"), end("to"), cols.filter("sort_by is not null").select("project_id", "table_name", _c("sort_by").alias("column_name"))).groupBy(*key).agg(F.count("*").alias("n"))
    asked = cols.filter("pos % 9 = 0").select(*key).distinct().join(uses, key, "left")
    return asked.select(*key, F.coalesce("n", F.lit(0)).alias("blockers"), _c("n").isNull().alias("deleted"))


_NEW_COLUMNS = """new as (select o_custkey - o_custkey % 64 as project_id, 'T' || cast(o_custkey as string) as table_name, case o_orderkey % 4 when 0 then 'Key' when 1 then 'New' || cast(o_orderkey % 3 as string) when 2 then 'M' || cast(o_custkey + 3 as string) else 'C' || cast(o_orderkey as string) end as name, o_orderkey as pos from {orders} where o_orderkey % 3 = 0)"""


@query(f"""with {fleet_sql('tables', 'columns', 'formulas')}, {_NEW_COLUMNS.format(orders='orders')}, r as (select *, row_number() over (partition by project_id, table_name, name order by pos) as r from new)
  select project_id, table_name, name, pos, case when (project_id, table_name) not in (select (project_id, table_name) from tables) then 'table not found' when (project_id, table_name, name) in (select (project_id, table_name, column_name) from columns) then 'column exists'
    when (project_id, table_name, name) in (select (project_id, table_name, name) from formulas) then 'measure of that name' when r > 1 then 'repeated in batch' else 'created' end as outcome from r""")
def create_columns(spark, sf):
    """A batch of new columns and what becomes of each: unknown table, column or measure of that name, repeated, created."""
    new = spark.sql(_NEW_COLUMNS[len("new as (") : -1], orders=lake(spark, sf, "orders"))
    key = ["project_id", "table_name", "name"]
    t = fleet(spark, sf, "tables").select("project_id", "table_name", F.lit(True).alias("t")).distinct()
    taken = together(fleet(spark, sf, "columns").select("project_id", "table_name", _c("column_name").alias("name"), F.lit(0).alias("by")), fleet(spark, sf, "formulas").select(*key, F.lit(1).alias("by"))).groupBy(*key).agg(F.min("by").alias("by"))
    first = new.groupBy(*key).agg(F.min("pos").alias("first"))
    j = new.join(t, ["project_id", "table_name"], "left").join(taken, key, "left").join(first, key)
    outcome = F.when(_c("t").isNull(), "table not found").when(_c("by") == 0, "column exists").when(_c("by") == 1, "measure of that name").when(_c("pos") > _c("first"), "repeated in batch").otherwise("created")
    return j.select(*key, "pos", outcome.alias("outcome"))


_NEW_RELATIONSHIPS = """new as (select o_custkey - o_custkey % 64 as project_id, 'N' || cast(o_orderkey as string) as name, case when o_orderkey % 11 = 0 then 'Tz' else 'T' || cast(o_custkey as string) end as from_table, case when o_orderkey % 7 = 0 then 'No' when o_orderkey % 5 = 0 then 'Code' else 'Key' end as from_column,
  'T' || cast(o_custkey - o_custkey % 64 + case when o_orderkey % 17 = 0 then 30 when o_orderkey % 3 = 0 then 2 else 1 end as string) as to_table, case when o_orderkey % 13 = 0 then 'No' else 'Key' end as to_column from {orders} where o_orderkey % 4 < 3)"""


@query(f"""with {fleet_sql('tables', 'columns', 'relationships')}, {_NEW_RELATIONSHIPS.format(orders='orders')}
  select project_id, name, case when (project_id, from_table) not in (select (project_id, table_name) from tables) then 'from table not found' when (project_id, to_table) not in (select (project_id, table_name) from tables) then 'to table not found'
    when (project_id, from_table, from_column) not in (select (project_id, table_name, column_name) from columns) then 'from column not found' when (project_id, to_table, to_column) not in (select (project_id, table_name, column_name) from columns) then 'to column not found'
    when (project_id, from_table, from_column, to_table, to_column) in (select (project_id, from_table, from_column, to_table, to_column) from relationships) then 'relationship exists' else 'created' end as outcome from new""")
def create_relationships(spark, sf):
    """A batch of new relationships and what becomes of each: an end that isn't there, the same ends related already, created."""
    new = spark.sql(_NEW_RELATIONSHIPS[len("new as (") : -1], orders=lake(spark, sf, "orders"))
    old = fleet(spark, sf, "relationships").select("project_id", *ENDS, F.lit(True).alias("old")).distinct()
    names = fleet(spark, sf, "tables").select("project_id", "table_name").distinct()
    j = relationship_ends(new, names, fleet(spark, sf, "columns")).join(old, ["project_id", *ENDS], "left")
    missing = [F.when(_c(f"{side}_{k}").isNull(), f"{side} {what} not found") for k, what in (("t", "table"), ("c", "column")) for side in ("from", "to")]
    return j.select("project_id", "name", F.coalesce(*missing, F.when(_c("old"), "relationship exists"), F.lit("created")).alias("outcome"))


def composed(ops: DataFrame) -> DataFrame:
    """entity, property, to_entity, to_property, steps: what a sequence of renames and moves makes of every key that one of them names.

    ops: seq, entity, property and new_entity (a move) or new_property (a rename) or both; seq tells all apart. An operation takes what is called by its
    key at its turn, so that a rename of a rename, a move of what was renamed, and swaps by way of a third name come out as if done one after
    the other. Each operation is followed by the next one on the key it leads to; these links are doubled until they end, in rounds that grow with the
    logarithm of the longest chain. Null entity or property names nothing.
    """
    o = written(ops.select("seq", "entity", "property", F.coalesce("new_entity", "entity").alias("e2"), F.coalesce("new_property", "property").alias("p2")).filter("entity is not null and property is not null"))
    leaving = o.select("entity", "property", "seq", F.lit(True).alias("leaves"), F.lit(None).cast("long").alias("op"))
    coming = o.select(_c("e2").alias("entity"), _c("p2").alias("property"), "seq", F.lit(False).alias("leaves"), _c("seq").cast("long").alias("op"))
    later = Window.partitionBy("entity", "property").orderBy("seq").rangeBetween(1, Window.unboundedFollowing)
    nxt = leaving.unionByName(coming).withColumn("next", F.min(F.when(_c("leaves"), _c("seq"))).over(later)).filter("not leaves").select(_c("op").alias("seq"), "next")
    at = written(o.join(nxt, "seq").select("seq", "next", "e2", "p2", F.lit(1).alias("steps")))
    while not at.filter("next is not null").isEmpty():
        on = at.select(_c("seq").alias("next"), _c("next").alias("n2"), _c("e2").alias("e3"), _c("p2").alias("p3"), _c("steps").alias("s2"))
        at = written(at.join(on, "next", "left").select("seq", _c("n2").alias("next"), F.coalesce("e3", "e2").alias("e2"), F.coalesce("p3", "p2").alias("p2"), (_c("steps") + F.coalesce("s2", F.lit(0))).alias("steps")))
    first = o.groupBy("entity", "property").agg(F.min("seq").alias("seq"))
    return first.join(at, "seq").select("entity", "property", _c("e2").alias("to_entity"), _c("p2").alias("to_property"), "steps")


_OPS = """select cast(p_partkey as bigint) as seq, concat('E', cast(p_partkey % 8 as string)) as entity, concat('N', cast(p_partkey * 5 % 31 as string)) as property, case when p_size % 3 = 0 then concat('E', cast(p_size % 8 as string)) end as new_entity,
  case when p_size % 3 <> 0 or p_size % 4 = 0 then concat('N', cast(p_partkey * 11 % 31 as string)) end as new_property from {part} where p_partkey % 3 = 0"""
_BINDINGS = "select l_suppkey as page, 'E' || l_partkey % 9 as entity, 'N' || (l_partkey + l_linenumber) % 37 as property, l_linenumber from lineitem"


@query(f"""with recursive ops as ({_OPS.format(part='part')}), b as ({_BINDINGS}), r(entity, property, e, p, seq, steps) as (select distinct entity, property, entity, property, -1::bigint, 0 from b
    union all select r.entity, r.property, coalesce(o.new_entity, o.entity), coalesce(o.new_property, o.property), o.seq, steps + 1 from r join ops o on o.entity = r.e and o.property = r.p and o.seq > r.seq
      where not exists (select 1 from ops x where x.entity = r.e and x.property = r.p and x.seq > r.seq and x.seq < o.seq)),
  last as (select entity, property, arg_max(e, steps) as e, arg_max(p, steps) as p, max(steps)::int as steps from r group by 1, 2)
  select page, e as entity, p as property, count(*) as bindings, count_if(steps > 0) as touched, max(steps) as steps from b join last using (entity, property) group by 1, 2, 3""")
def change_sequence(spark, sf):
    """Bindings after a sequence of renames and moves: the operations are composed first, and each binding is then looked up once."""
    b = lake(spark, sf, "lineitem").select(_c("l_suppkey").alias("page"), F.concat(F.lit("E"), (_c("l_partkey") % 9).cast("string")).alias("entity"), F.concat(F.lit("N"), ((_c("l_partkey") + _c("l_linenumber")) % 37).cast("string")).alias("property"))
    done = b.join(composed(spark.sql(_OPS, part=lake(spark, sf, "part"))), ["entity", "property"], "left").withColumn("steps", F.coalesce("steps", F.lit(0)))
    now = done.groupBy("page", F.coalesce("to_entity", "entity").alias("e"), F.coalesce("to_property", "property").alias("p"))
    return now.agg(F.count("*").alias("bindings"), F.count_if(_c("steps") > 0).alias("touched"), F.max("steps").alias("steps")).select("page", _c("e").alias("entity"), _c("p").alias("property"), "bindings", "touched", "steps")
