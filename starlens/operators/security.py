"""Roles as bit masks: predicate rows compiled to one column a table, passed along relationships, OR-ed over a user's roles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.fleet import fleet, fleet_sql
from ..sources.frames import RELATIONSHIPS, lake, money

_c = F.col
QUERIES, ORACLES = {}, {}
#: a mask is a long; bit r is role r
MOST_ROLES = 63
#: predicate rows of one model that are compiled into expressions
MOST_PREDICATES = 20_000


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


#: fixed values: comparisons that a predicate row may have
_OPS = {"=": Column.__eq__, "<>": Column.__ne__, "<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}


def compiled(predicates: DataFrame, types: dict[str, dict[str, str]]) -> dict[str, tuple[Column, int]]:
    """For each table its mask column, and the roles that have a predicate on it as bits.

    predicates: role (0 to 62), table_name, column_name, op, value (text). Rows of one role, table and column with `=` are a list of which one must
    hold; all else must hold together. A null in the data fulfils nothing. A role without a predicate on a table has its bit everywhere. Predicates are part of
    a model, so at most 20,000 rows of them come to the driver; more are an error. types gives the type of each column that has one.
    """
    rows = predicates.select("role", "table_name", "column_name", "op", "value").distinct().limit(MOST_PREDICATES + 1).collect()
    if len(rows) > MOST_PREDICATES:
        raise ValueError(f"more than {MOST_PREDICATES} predicates")
    if any(not 0 <= r.role < MOST_ROLES for r in rows):
        raise ValueError(f"roles are numbers below {MOST_ROLES}")
    by: dict[tuple[str, int], dict[tuple[str, str], list[str]]] = {}
    for r in rows:
        by.setdefault((r.table_name, r.role), {}).setdefault((r.column_name, r.op), []).append(r.value)
    out: dict[str, tuple[Column, int]] = {}
    for table in {t for t, _ in by}:
        bits, restricted = [], 0
        for (t, role), tests in sorted(by.items()):
            if t != table:
                continue
            restricted |= 1 << role
            holds = [_test(c, op, sorted(values), types[table][c]) for (c, op), values in sorted(tests.items())]
            bits.append(F.when(reduce(Column.__and__, holds), F.lit(1 << role)).otherwise(F.lit(0)))
        free = (1 << MOST_ROLES) - 1 & ~restricted
        out[table] = reduce(Column.bitwiseOR, bits, F.lit(free).cast("long")), restricted
    return out


def _test(column: str, op: str, values: list[str], kind: str) -> Column:
    given = [F.lit(v).cast(kind) for v in values]
    if op == "=":
        return _c(column).isin(given)
    return reduce(Column.__and__, (_OPS[op](_c(column), v) for v in given))


def masked(spark: SparkSession, sf_dir: str, table: str, masks: dict[str, tuple[Column, int]]) -> tuple[DataFrame, int]:
    """A table with `mask`: the roles that see the row, by its own predicates and those of all tables that filter it along active relationships.

    A row whose key finds no row of the other table is seen by the roles that nothing there restricts. Only keys and masks of the other tables travel.
    """
    own, restricted = masks.get(table, (F.lit((1 << MOST_ROLES) - 1), 0))
    df, total = lake(spark, sf_dir, table).withColumn("mask", own), restricted
    for fact, a, to, b, active in RELATIONSHIPS.values():
        if fact == table and active:
            other, limits = masked(spark, sf_dir, to, masks)
            if limits:
                there = other.select(_c(b).alias("there"), _c("mask").alias("there_mask"))
                free = F.lit((1 << MOST_ROLES) - 1 & ~limits).cast("long")
                df = df.join(there, _c(a) == _c("there"), "left").withColumn("mask", _c("mask").bitwiseAND(F.coalesce("there_mask", free))).drop("there", "there_mask")
                total |= limits
    return df, total


def by_user(groups: DataFrame, users: DataFrame, measures: list[str]) -> DataFrame:
    """user_id and the sums of measures over the mask groups (mask, measures) that one of the user's roles (user_id, role) sees; 0 where there is none.

    A user's roles are OR-ed by taking each pair of user and mask once. Masks are few (one for each set of roles that sees some row), however many rows there are.
    """
    bits = groups.select("mask", F.explode(F.filter(F.sequence(F.lit(0), F.lit(MOST_ROLES - 1)), lambda r: F.getbit("mask", r) == 1)).alias("role"))
    seen = users.select("user_id", "role").join(bits, "role").select("user_id", "mask").distinct().join(groups, "mask")
    sums = seen.groupBy("user_id").agg(*(F.sum(m).alias(m) for m in measures))
    return users.select("user_id").distinct().join(sums, "user_id", "left").na.fill(0, measures)


_PREDICATES = """select cast(n_nationkey % 4 as int) as role, 'nation' as table_name, 'n_nationkey' as column_name, '=' as op, cast(n_nationkey as string) as value from {nation} where n_nationkey % 3 <> 0
  union all select 1, 'part', 'p_size', '>=', '10' union all select 1, 'part', 'p_size', '<', '40' union all select 4, 'region', 'r_name', '=', r_name from {region} where r_regionkey % 2 = 0
  union all select 4, 'orders', 'o_orderstatus', '<>', 'F' union all select 5, 'part', 'p_brand', '=', p_brand from {part} where p_partkey % 97 = 0 union all select 6, 'supplier', 's_acctbal', '>', '5000.0' union all select 6, 'lineitem', 'l_returnflag', '=', 'R'"""
#: role 7 has no predicate; users have one to three roles
_USERS = "select s_suppkey as user_id, cast(s_suppkey % 7 as int) as role from {supplier} union select s_suppkey, cast(s_suppkey * 3 % 7 as int) from {supplier} where s_suppkey % 2 = 0 union select s_suppkey, 7 from {supplier} where s_suppkey % 25 = 0 union select s_suppkey, 1 from {supplier} where s_suppkey % 5 = 0"
_TYPES = {"nation": {"n_nationkey": "int"}, "part": {"p_size": "int", "p_brand": "string"}, "region": {"r_name": "string"}, "orders": {"o_orderstatus": "string"}, "supplier": {"s_acctbal": "double"}, "lineitem": {"l_returnflag": "string"}}


def _shim(spark, sf, text: str) -> DataFrame:
    return spark.sql(text, **{t: lake(spark, sf, t) for t in ("nation", "region", "part", "supplier") if f"{{{t}}}" in text})


def _role_sql() -> str:
    """For each role whether it sees a line of the joined star; written role by role, not by masks."""
    column = {"nation": "n_nationkey::varchar", "region": "r_name", "part": "p_brand"}
    listed = lambda r, t: f"((not exists (select 1 from preds where role = {r} and table_name = '{t}' and op = '=')) or coalesce({column[t]} in (select value from preds where role = {r} and table_name = '{t}' and op = '='), false))"
    tests = {r: [listed(r, "nation")] for r in range(4)} | {4: [listed(4, "region"), "coalesce(o_orderstatus <> 'F', false)"], 5: [listed(5, "part")], 6: ["coalesce(s_acctbal > 5000, false)", "l_returnflag = 'R'"], 7: ["true"]}
    tests[1] += ["coalesce(p_size >= 10 and p_size < 40, false)"]
    return ", ".join(f"{' and '.join(t)} as sees{r}" for r, t in tests.items())


_VISIBLE = f"""preds as ({_PREDICATES.format(nation='nation', region='region', part='part')}), users as ({_USERS.format(supplier='supplier')}),
  star as (select l_quantity::decimal(18,2) as q, {_role_sql()} from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
    left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey),
  sets as (select user_id, {', '.join(f'bool_or(role = {r}) as r{r}' for r in range(8))} from users group by user_id),
  cells as (select {', '.join(f'sees{r}' for r in range(8))}, count(*) as n, sum(q) as q from star group by all)"""


@query(f"with {_VISIBLE} select user_id, coalesce(sum(n), 0)::bigint as n, coalesce(sum(q), 0)::double as quantity from sets left join cells on {' or '.join(f'(r{r} and sees{r})' for r in range(8))} group by user_id")
def rls_users(spark, sf):
    """Rows and quantity that each of all users sees, with several roles a user, in one pass over the facts."""
    df, _ = masked(spark, sf, "lineitem", compiled(_shim(spark, sf, _PREDICATES), _TYPES))
    groups = df.groupBy("mask").agg(F.count("*").alias("n"), F.sum(money("l_quantity")).alias("quantity"))
    return by_user(groups, _shim(spark, sf, _USERS), ["n", "quantity"]).select("user_id", "n", _c("quantity").cast("double").alias("quantity"))


@query(f"with {_VISIBLE} " + " union all ".join(f"select {r}::int as role, count_if(sees{r}) as visible, round(count_if(sees{r}) / count(*), 6) as share from star" for r in range(8)))
def rls_roles(spark, sf):
    """Rows that each role sees and their share, from the same masks."""
    df, _ = masked(spark, sf, "lineitem", compiled(_shim(spark, sf, _PREDICATES), _TYPES))
    n = df.agg(F.count("*").alias("all"), *(F.count_if(F.getbit("mask", F.lit(r)) == 1).alias(f"r{r}") for r in range(8)))
    rows = F.explode(F.array(*(F.struct(F.lit(r).alias("role"), _c(f"r{r}").alias("visible")) for r in range(8)))).alias("x")
    return n.select("all", rows).select("x.role", "x.visible", F.round(_c("x.visible") / _c("all"), 6).alias("share"))


_HIDDEN = f"""{fleet_sql('columns', 'role_filters', 'column_permissions')}, gone as (select distinct project_id, role, table_name from role_filters where metadata = 'none'),
  cols as (select distinct project_id, table_name, column_name from columns), said as (select distinct project_id, role, table_name, column_name from column_permissions where metadata = 'none'),
  hidden as (select g.project_id, role, g.table_name, column_name, 'table' as by_ from gone g join cols using (project_id, table_name)
    union all select s.project_id, s.role, s.table_name, s.column_name, 'column' from said s join cols using (project_id, table_name, column_name) where (s.project_id, s.role, s.table_name) not in (select (project_id, role, table_name) from gone))"""


@query(f"with {_HIDDEN} select * from hidden")
def ols_columns(spark, sf):
    """Columns that a role may not see, because its table is hidden from the role or the column itself is; permissions on what isn't there hide nothing."""
    cols = fleet(spark, sf, "columns").select("project_id", "table_name", "column_name").distinct()
    gone = fleet(spark, sf, "role_filters").filter("metadata = 'none'").select("project_id", "role", "table_name").distinct()
    said = fleet(spark, sf, "column_permissions").filter("metadata = 'none'").select("project_id", "role", "table_name", "column_name").distinct()
    by_table = gone.join(cols, ["project_id", "table_name"]).select("project_id", "role", "table_name", "column_name", F.lit("table").alias("by_"))
    by_column = said.join(cols, ["project_id", "table_name", "column_name"], "left_semi").join(gone, ["project_id", "role", "table_name"], "left_anti")
    return by_table.unionByName(by_column.select("project_id", "role", "table_name", "column_name", F.lit("column").alias("by_")))


def _broken(kind: str) -> str:
    return f"select distinct project_id, role, {kind} as formula from (select h.project_id, h.role, q.kind || '|' || q.own_table || '.' || q.own_name as {kind} from hidden h join qualified q using (project_id, table_name, column_name))"


def _refs_sql() -> str:
    from .rules import _REFS

    return _REFS


@query(f"with {_refs_sql()}, {_HIDDEN.replace(fleet_sql('columns', 'role_filters', 'column_permissions'), fleet_sql('role_filters', 'column_permissions'))} {_broken('formula')}")
def ols_broken_formulas(spark, sf):
    """Formulas that a role can't evaluate, as they name a column that is hidden from it."""
    from .rules import all_formulas, references

    refs = references(all_formulas(spark, sf)).filter("table_name is not null")
    hit = ols_columns(spark, sf).join(refs, ["project_id", "table_name", "column_name"])
    return hit.select("project_id", "role", F.concat("kind", F.lit("|"), F.concat_ws(".", "own_table", "own_name")).alias("formula")).distinct()
