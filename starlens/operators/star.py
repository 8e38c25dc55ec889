"""Joins along relationships, filters that never fan out, and measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.order import percentiles
from ..sources.frames import RELATIONSHIPS, divide, lake, money, related, total

_c = F.col
QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_STAR = "lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey"
_PATH = ("lineitem_orders", "orders_customer", "customer_nation", "nation_region", "lineitem_part", "lineitem_supplier")
_M = "::decimal(18,2)"


@query(f"select r_name as region, p_brand as brand, sum(l_extendedprice{_M})::double as revenue, count(*) as n, sum(s_acctbal{_M})::double as supplier_balance from {_STAR} group by 1, 2")
def star_join(spark, sf):
    return related(spark, sf, lake(spark, sf, "lineitem"), *_PATH).groupBy(_c("r_name").alias("region"), _c("p_brand").alias("brand")).agg(total("l_extendedprice").alias("revenue"), F.count("*").alias("n"), total("s_acctbal").alias("supplier_balance"))


@query(f"select n_name as supplier_nation, r_name as region, sum(l_extendedprice{_M})::double as revenue from lineitem left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey group by 1, 2")
def use_relationship(spark, sf):
    """The inactive relationship of suppliers to nations in place of the customers' one."""
    li = related(spark, sf, lake(spark, sf, "lineitem"), "lineitem_supplier", "supplier_nation", "nation_region")
    return li.groupBy(_c("n_name").alias("supplier_nation"), _c("r_name").alias("region")).agg(total("l_extendedprice").alias("revenue"))


_DAYS = "days as (select d::date as d, year(d)::bigint as y, quarter(d)::bigint as q from (select unnest(generate_series(lo, hi, interval 1 day)) as d from (select min(o_orderdate)::date as lo, max(o_orderdate)::date as hi from orders)))"


@query(f"with {_DAYS}, daily as (select l_shipdate::date as d, sum(l_extendedprice{_M}) as v, count(*) as n from lineitem group by 1) select y as ship_year, q as ship_quarter, sum(v)::double as revenue, sum(n)::bigint as n from daily left join days using (d) group by 1, 2")
def use_relationship_date(spark, sf):
    """Lines by the day they shipped, along the inactive relationship to the day frame of the orders; days beyond the frame are blank."""
    span = lake(spark, sf, "orders").agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d")).select("d", F.year("d").cast("long").alias("ship_year"), F.quarter("d").cast("long").alias("ship_quarter"))
    daily = lake(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.sum(money("l_extendedprice")).alias("v"), F.count("*").alias("n"))
    return daily.join(days, "d", "left").groupBy("ship_year", "ship_quarter").agg(F.sum("v").cast("double").alias("revenue"), F.sum("n").alias("n"))


@query(f"select l_returnflag, count(*) as n, sum(l_quantity{_M})::double as quantity from lineitem where l_partkey in (select p_partkey from part where p_size > 25) group by 1")
def filter_propagate(spark, sf):
    dim = lake(spark, sf, "part").filter("p_size > 25").select(_c("p_partkey").alias("l_partkey"))
    return lake(spark, sf, "lineitem").join(dim, "l_partkey", "left_semi").groupBy("l_returnflag").agg(F.count("*").alias("n"), total("l_quantity").alias("quantity"))


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_totalprice > 200000)")
def cross_filter_both(spark, sf):
    keys = lake(spark, sf, "orders").filter("o_totalprice > 200000").select(_c("o_custkey").alias("c_custkey")).distinct()
    return lake(spark, sf, "customer").join(keys, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query(f"select count(*) as suppliers, sum(s_acctbal{_M})::double as balance from supplier where s_suppkey in (select l_suppkey from lineitem where l_partkey in (select p_partkey from part where p_brand = 'Brand#1' or p_size = 7))")
def m2m_filter(spark, sf):
    parts = lake(spark, sf, "part").filter("p_brand = 'Brand#1' or p_size = 7").select(_c("p_partkey").alias("l_partkey"))
    bridge = lake(spark, sf, "lineitem").join(parts, "l_partkey", "left_semi").select(_c("l_suppkey").alias("s_suppkey")).distinct()
    return lake(spark, sf, "supplier").join(bridge, "s_suppkey", "left_semi").agg(F.count("*").alias("suppliers"), total("s_acctbal").alias("balance"))


@query(f"select o_orderstatus, sum(o_totalprice{_M})::double as v from orders where o_custkey in (select s_suppkey from supplier where s_acctbal > 0) group by 1")
def treatas(spark, sf):
    values = lake(spark, sf, "supplier").filter("s_acctbal > 0").select(_c("s_suppkey").alias("o_custkey"))
    return lake(spark, sf, "orders").join(values, "o_custkey", "left_semi").groupBy("o_orderstatus").agg(total("o_totalprice").alias("v"))


@query("with u as (select c_nationkey, c_mktsegment, min(c_name) as name, count(distinct c_name) as n from customer group by 1, 2) select n_nationkey, case when n = 1 then name end as found, coalesce(n, 0) > 1 as ambiguous from nation left join u on c_nationkey = n_nationkey and c_mktsegment = 'BUILDING'")
def lookup_value(spark, sf):
    u = lake(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").groupBy("c_nationkey").agg(F.min("c_name").alias("name"), F.count_distinct("c_name").alias("n"))
    return lake(spark, sf, "nation").join(u, _c("n_nationkey") == _c("c_nationkey"), "left").select("n_nationkey", F.when(_c("n") == 1, _c("name")).alias("found"), (F.coalesce("n", F.lit(0)) > 1).alias("ambiguous"))


@query("select r_regionkey, r_name, n_name from region join (select n_regionkey as r_regionkey, n_name from nation) using (r_regionkey)")
def natural_join(spark, sf):
    left, right = lake(spark, sf, "region"), lake(spark, sf, "nation").select(_c("n_regionkey").alias("r_regionkey"), "n_name")
    return left.join(right, [c for c in left.columns if c in right.columns])


@query("select r_regionkey, r_name, n_name from region left join (select n_regionkey as r_regionkey, n_name from nation where n_regionkey < 3) using (r_regionkey)")
def natural_left_join(spark, sf):
    """Every row of the left side once or more, joined on all columns of one name."""
    left, right = lake(spark, sf, "region"), lake(spark, sf, "nation").filter("n_regionkey < 3").select(_c("n_regionkey").alias("r_regionkey"), "n_name")
    return left.join(right, [c for c in left.columns if c in right.columns], "left")


@query("select c_custkey, o_orderkey, o_totalprice from (select c_custkey, o_orderkey, o_totalprice, row_number() over (partition by c_custkey order by o_totalprice desc, o_orderkey) as k from customer left join orders on o_custkey = c_custkey) where k <= 2")
def generate_topn(spark, sf):
    w = Window.partitionBy("c_custkey").orderBy(_c("o_totalprice").desc_nulls_last(), "o_orderkey")
    o = lake(spark, sf, "customer").join(lake(spark, sf, "orders"), _c("o_custkey") == _c("c_custkey"), "left")
    return o.withColumn("k", F.row_number().over(w)).filter("k <= 2").select("c_custkey", "o_orderkey", "o_totalprice")


_ABOVE = "o_totalprice > 20 * abs(c_acctbal)"


def _generate(outer: bool) -> str:
    """Two orders of each customer that are large for the customer's balance; the inner form leaves out customers without one.

    The argument meets the outer row's values by a join on its key: a comparison with an outer column would be evaluated for all pairs of orders and balances.
    """
    table = f"(select o_orderkey, o_totalprice from (select * from {{orders}} join {{customer}} on o_custkey = c_custkey and {_ABOVE}) x where x.c_custkey = c.c_custkey order by o_totalprice desc, o_orderkey limit 2) t"
    return f"select c.c_custkey, c.c_mktsegment, o_orderkey, o_totalprice from {{customer}} c {'left' if outer else 'inner'} join lateral {table}" + (" on true" if outer else "")


_GENERATE_SQL = f"select c_custkey, c_mktsegment, o_orderkey, o_totalprice from customer {{}} join (select * from (select c_custkey as k, o_orderkey, o_totalprice, row_number() over (partition by c_custkey order by o_totalprice desc, o_orderkey) as r from customer join orders on o_custkey = c_custkey where {_ABOVE}) where r <= 2) on k = c_custkey"


@query(_GENERATE_SQL.format("inner"))
def generate_inner(spark, sf):
    """A table expression evaluated for each outer row, with a filter and a limit of its own: rows for which it is empty go."""
    return spark.sql(_generate(False), customer=lake(spark, sf, "customer"), orders=lake(spark, sf, "orders"))


@query(_GENERATE_SQL.format("left"))
def generate_outer(spark, sf):
    """The same, and rows for which it is empty stay with nulls."""
    return spark.sql(_generate(True), customer=lake(spark, sf, "customer"), orders=lake(spark, sf, "orders"))


@query("select c_custkey, unnest(['low', 'high']) as band, unnest([0, 5000]) as from_, case unnest([0, 5000]) when 0 then c_acctbal < 5000 else c_acctbal >= 5000 end as inside from customer")
def datatable_rows(spark, sf):
    """A table of constants, and one row built of expressions, met by every outer row."""
    bands = F.explode(F.array(*(F.struct(F.lit(b).alias("band"), F.lit(f).alias("from_")) for b, f in (("low", 0), ("high", 5000))))).alias("t")
    inside = F.when(_c("t.from_") == 0, _c("c_acctbal") < 5000).otherwise(_c("c_acctbal") >= 5000)
    return lake(spark, sf, "customer").select("c_custkey", "c_acctbal", bands).select("c_custkey", "t.band", "t.from_", inside.alias("inside"))


def _audit(spark, sf, name):
    a, x, b, y, _ = RELATIONSHIPS[name]
    left, right = lake(spark, sf, a).select(_c(x).cast("long").alias("k")), lake(spark, sf, b).select(_c(y).cast("long").alias("k"))
    lk, rk = left.groupBy("k").agg(F.count("*").alias("l")), right.groupBy("k").agg(F.count("*").alias("r"))
    return lk.join(rk, "k", "full").select(F.lit(name).alias("relationship"), "l", "r")


_PAIRS = " union all ".join(f"select '{n}' as relationship, l, r from (select {x}::bigint as k, count(*) as l from {a} group by 1) full join (select {y}::bigint as k, count(*) as r from {b} group by 1) using (k)" for n, (a, x, b, y, _) in RELATIONSHIPS.items())


def _pairs(spark, sf):
    out = None
    for n in RELATIONSHIPS:
        one = _audit(spark, sf, n)
        out = one if out is None else out.unionByName(one)
    return out


@query(f"select relationship, sum(case when r is null then l else 0 end)::bigint as orphan_rows, count_if(r is null) as orphan_keys, count_if(l is null) as unused_keys from ({_PAIRS}) group by 1")
def ri_audit(spark, sf):
    return _pairs(spark, sf).groupBy("relationship").agg(F.sum(F.when(_c("r").isNull(), _c("l")).otherwise(0)).alias("orphan_rows"), F.count_if(_c("r").isNull()).alias("orphan_keys"), F.count_if(_c("l").isNull()).alias("unused_keys"))


@query(f"select relationship, case when max(l) > 1 then 'many' else 'one' end as from_side, case when max(r) > 1 then 'many' else 'one' end as to_side, count_if(r > 1) as duplicate_keys from ({_PAIRS}) group by 1")
def cardinality_audit(spark, sf):
    side = lambda c: F.when(F.max(c) > 1, "many").otherwise("one")
    return _pairs(spark, sf).groupBy("relationship").agg(side("l").alias("from_side"), side("r").alias("to_side"), F.count_if(_c("r") > 1).alias("duplicate_keys"))


@query("select p_partkey from part where p_partkey not in (select l_partkey from lineitem where l_quantity >= 45) and p_partkey not in (select p_partkey // 2 from part)")
def unused_items(spark, sf):
    """Items that neither a large line nor another item's formula uses."""
    sold = lake(spark, sf, "lineitem").filter("l_quantity >= 45").select(_c("l_partkey").alias("p_partkey"))
    named = lake(spark, sf, "part").selectExpr("p_partkey div 2 as p_partkey")
    return lake(spark, sf, "part").join(sold, "p_partkey", "left_anti").join(named, "p_partkey", "left_anti").select("p_partkey")


@query("with cal as (select unnest(generate_series((select min(ts)::date from events)::timestamp, (select max(ts)::date from events)::timestamp, interval 1 day))::date as d) select d, count(event_id) as n, count(distinct user_id) as users from cal left join events on ts::date = d group by 1")
def join_on_date(spark, sf):
    e = lake(spark, sf, "events").groupBy(F.to_date("ts").alias("d")).agg(F.count("event_id").alias("n"), F.count_distinct("user_id").alias("users"))
    cal = e.agg(F.min("d").alias("a"), F.max("d").alias("b")).select(F.explode(F.sequence("a", "b")).alias("d"))
    return cal.join(e, "d", "left").na.fill(0, ["n", "users"])


# Measures


@query(f"select l_returnflag, sum(l_quantity{_M})::double as quantity, sum((l_extendedprice * (1 - l_discount))::decimal(18,4))::double as net from lineitem group by 1")
def measure_sum(spark, sf):
    return lake(spark, sf, "lineitem").groupBy("l_returnflag").agg(total("l_quantity").alias("quantity"), F.sum((_c("l_extendedprice") * (1 - _c("l_discount"))).cast("decimal(18,4)")).cast("double").alias("net"))


@query(f"select l_linestatus, sum(l_extendedprice{_M})::double / nullif(sum(l_quantity{_M})::double, 0) as price from lineitem group by 1")
def measure_ratio(spark, sf):
    return lake(spark, sf, "lineitem").groupBy("l_linestatus").agg(divide(total("l_extendedprice"), total("l_quantity")).alias("price"))


@query("select event_type, count(distinct user_id) as no_blank, count(distinct user_id) + max((user_id is null)::bigint) as with_blank from (select event_type, nullif(user_id, 1) as user_id from events) group by 1")
def measure_distinct(spark, sf):
    e = lake(spark, sf, "events").withColumn("user_id", F.nullif("user_id", F.lit(1)))
    n = F.count_distinct("user_id")
    return e.groupBy("event_type").agg(n.alias("no_blank"), (n + F.max(_c("user_id").isNull().cast("long"))).alias("with_blank"))


@query(f"with a as (select r_name, n_name, sum(o_totalprice{_M})::double as v from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2) select r_name, n_name, round(v / sum(v) over (partition by r_name), 9) as of_region, round(v / sum(v) over (), 9) as of_all from a")
def share_of_total(spark, sf):
    o = related(spark, sf, lake(spark, sf, "orders"), "orders_customer", "customer_nation", "nation_region")
    a = o.groupBy("r_name", "n_name").agg(total("o_totalprice").alias("v"))
    share = lambda w: F.round(_c("v") / F.sum("v").over(w), 9)
    return a.select("r_name", "n_name", share(Window.partitionBy("r_name")).alias("of_region"), share(Window.partitionBy()).alias("of_all"))


@query(f"with a as (select o_orderpriority, sum(case when o_orderstatus = 'F' then o_totalprice{_M} end)::double as finished, sum(o_totalprice{_M})::double as v from orders group by 1) select o_orderpriority, finished, (select sum(o_totalprice{_M})::double from orders) as removed, finished / v as share from a")
def calculate_filter(spark, sf):
    o = lake(spark, sf, "orders")
    a = o.groupBy("o_orderpriority").agg(F.sum(F.when(_c("o_orderstatus") == "F", money("o_totalprice"))).cast("double").alias("finished"), total("o_totalprice").alias("v"))
    return a.crossJoin(F.broadcast(o.agg(total("o_totalprice").alias("removed")))).select("o_orderpriority", "finished", "removed", divide(_c("finished"), _c("v")).alias("share"))


#: how each column is summarised where nothing else is said
SUMMARIZE_BY = {"l_quantity": "sum", "l_extendedprice": "sum", "l_discount": "max", "l_tax": "min", "l_suppkey": "distinctCount", "l_linenumber": "count"}


@query(f"select l_returnflag, sum(l_quantity{_M})::double as l_quantity, sum(l_extendedprice{_M})::double as l_extendedprice, max(l_discount) as l_discount, min(l_tax) as l_tax, count(distinct l_suppkey) as l_suppkey, count(l_linenumber) as l_linenumber from lineitem group by 1")
def default_summarize(spark, sf):
    how = {"sum": total, "max": F.max, "min": F.min, "count": F.count, "average": F.avg, "distinctCount": F.count_distinct}
    return lake(spark, sf, "lineitem").groupBy("l_returnflag").agg(*(how[h](c).alias(c) for c, h in SUMMARIZE_BY.items() if h != "none"))


@query(f"select r_name, c_mktsegment, sum(o_totalprice{_M})::double as v from region join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by 1, 2 having sum(o_totalprice{_M}) is not null")
def summarize_columns(spark, sf):
    o = related(spark, sf, lake(spark, sf, "orders"), "orders_customer", "customer_nation", "nation_region")
    return o.groupBy("r_name", "c_mktsegment").agg(total("o_totalprice").alias("v")).filter("v is not null and r_name is not null")


@query(f"select r_name, n_name, c_mktsegment, sum(o_totalprice{_M})::double as v, grouping(r_name)::bigint as g1, grouping(n_name)::bigint as g2, grouping(c_mktsegment)::bigint as g3 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by rollup (r_name, n_name, c_mktsegment)")
def hierarchy_rollup(spark, sf):
    o = related(spark, sf, lake(spark, sf, "orders"), "orders_customer", "customer_nation", "nation_region")
    levels = ("r_name", "n_name", "c_mktsegment")
    return o.rollup(*levels).agg(total("o_totalprice").alias("v"), *(F.grouping(x).cast("long").alias(f"g{k}") for k, x in enumerate(levels, 1)))


@query(f"""with o as (select year(o_orderdate)::int as y, quarter(o_orderdate)::int as q, month(o_orderdate)::int as m, o_totalprice{_M} as v from orders)
  select y, q, m, sum(v)::double as v, count(*) as n, grouping_id(y, q, m)::int as level from o group by rollup (y, q, m)""")
def date_rollup(spark, sf):
    """Totals by year, quarter and month with subtotals; level is 0 for a month, 1 for a quarter, 3 for a year, 7 for all. Days are summed once, before the levels are."""
    days = lake(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.sum(money("o_totalprice")).alias("v"), F.count("*").alias("n"))
    levels = days.select(F.year("d").alias("y"), F.quarter("d").alias("q"), F.month("d").alias("m"), "v", "n")
    return levels.rollup("y", "q", "m").agg(F.sum("v").cast("double").alias("v"), F.sum("n").alias("n"), F.grouping_id("y", "q", "m").cast("int").alias("level"))


_PROFILED = ("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")


@query(" union all ".join(f"select '{x}' as col, count({x}) as n, count(*) - count({x}) as nulls, count(distinct {x}) as distinct_values, min({x})::varchar as lo, max({x})::varchar as hi from part" for x in _PROFILED))
def column_profile(spark, sf):
    """Each column by its own values with their counts: all in one pass would make a row of every column for each column."""
    p = lake(spark, sf, "part")
    def profile(x: str) -> DataFrame:
        values = p.groupBy(_c(x).alias("x")).agg(F.count("*").alias("k"))
        there = F.coalesce(F.sum(F.when(_c("x").isNotNull(), _c("k"))), F.lit(0))
        return values.agg(there.alias("n"), (F.coalesce(F.sum("k"), F.lit(0)) - there).alias("nulls"), F.count("x").alias("distinct_values"), F.min("x").cast("string").alias("lo"), F.max("x").cast("string").alias("hi")).select(F.lit(x).alias("col"), "*")

    return reduce(DataFrame.unionByName, map(profile, _PROFILED))


@query("select o_orderpriority, quantile_cont(o_totalprice, 0.5) as median, quantile_cont(o_totalprice, 0.9) as p90 from orders group by 1")
def percentile_inc(spark, sf):
    return percentiles(lake(spark, sf, "orders"), "o_orderpriority", "o_totalprice", {"median": (0.5, False), "p90": (0.9, False)})


@query("with r as (select o_orderpriority as k, o_totalprice as v, row_number() over (partition by o_orderpriority order by o_totalprice) as i, count(*) over (partition by o_orderpriority) as n from orders), b as (select *, 0.9 * (n + 1) as h from r) select k, round(max(case when i = floor(h) then v end) + max(h - floor(h)) * (max(case when i = floor(h) + 1 then v end) - max(case when i = floor(h) then v end)), 4) as p90 from b group by k")
def percentile_exc(spark, sf):
    p = percentiles(lake(spark, sf, "orders"), "o_orderpriority", "o_totalprice", {"p90": (0.9, True)})
    return p.select(_c("o_orderpriority").alias("k"), F.round("p90", 4).alias("p90"))


@query("select l_returnflag, round(stddev_pop(l_quantity), 6) as sd_p, round(stddev_samp(l_quantity), 6) as sd_s, round(var_pop(l_quantity), 6) as var_p, round(var_samp(l_quantity), 6) as var_s, round(exp(avg(ln(l_quantity))), 6) as geomean, round(regr_slope(l_extendedprice, l_quantity), 4) as slope, round(regr_intercept(l_extendedprice, l_quantity), 2) as intercept from lineitem group by 1")
def stat_aggs(spark, sf):
    q = "l_quantity"
    return lake(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        *(F.round(f(q), 6).alias(n) for n, f in (("sd_p", F.stddev_pop), ("sd_s", F.stddev_samp), ("var_p", F.var_pop), ("var_s", F.var_samp))), F.round(F.exp(F.avg(F.ln(q))), 6).alias("geomean"),
        F.round(F.regr_slope("l_extendedprice", q), 4).alias("slope"), F.round(F.regr_intercept("l_extendedprice", q), 2).alias("intercept"),
    )


@query("select r_name, string_agg(n_name, ', ' order by n_name) as nations from nation join region on n_regionkey = r_regionkey group by 1")
def concatenatex(spark, sf):
    return related(spark, sf, lake(spark, sf, "nation"), "nation_region").groupBy("r_name").agg(F.concat_ws(", ", F.array_sort(F.collect_list("n_name"))).alias("nations"))


@query("select event_type, count(*) as rows_, count(v) as values_, count(*) - count(v) as blanks, round(avg(v), 6) as mean, min(v) as lo, max(v) as hi from (select event_type, case when event_id % 5 <> 0 then value end as v from events) group by 1")
def count_variants(spark, sf):
    e = lake(spark, sf, "events").select("event_type", F.when(_c("event_id") % 5 != 0, _c("value")).alias("v"))
    return e.groupBy("event_type").agg(F.count("*").alias("rows_"), F.count("v").alias("values_"), F.count_if(_c("v").isNull()).alias("blanks"), F.round(F.avg("v"), 6).alias("mean"), F.min("v").alias("lo"), F.max("v").alias("hi"))


@query("select o_custkey, case when count(distinct o_orderstatus) = 1 then min(o_orderstatus) else 'several' end as status from orders group by 1")
def selected_value(spark, sf):
    return lake(spark, sf, "orders").groupBy("o_custkey").agg(F.when(F.count_distinct("o_orderstatus") == 1, F.min("o_orderstatus")).otherwise("several").alias("status"))


# Set operations

_A, _B = "select c_custkey // 2 as k from customer where c_acctbal > 5000", "select s_suppkey as k from supplier where s_acctbal > 0"


def _two(spark, sf):
    return lake(spark, sf, "customer").filter("c_acctbal > 5000").selectExpr("c_custkey div 2 as k"), lake(spark, sf, "supplier").filter("s_acctbal > 0").select(_c("s_suppkey").alias("k"))


@query(f"{_A} union all {_B}")
def set_union(spark, sf):
    a, b = _two(spark, sf)
    return a.unionByName(b)


@query(f"with a as ({_A}), b as ({_B}) select k from a where k in (select k from b)")
def set_intersect(spark, sf):
    a, b = _two(spark, sf)
    return a.join(b, a.k.eqNullSafe(b.k), "left_semi")


@query(f"with a as ({_A}), b as ({_B}) select k from a where not exists (select 1 from b where b.k is not distinct from a.k)")
def set_except(spark, sf):
    a, b = _two(spark, sf)
    return a.join(b, a.k.eqNullSafe(b.k), "left_anti")


@query("select distinct c_nationkey, c_mktsegment from customer")
def set_distinct(spark, sf):
    return lake(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query("select unnest(generate_series((select min(p_size) from part)::bigint, (select max(p_size) from part)::bigint, 3)) as value")
def generate_series(spark, sf):
    return lake(spark, sf, "part").agg(F.min("p_size").cast("long").alias("a"), F.max("p_size").cast("long").alias("b")).select(F.explode(F.sequence("a", "b", F.lit(3).cast("long"))).alias("value"))


@query("select r_name, seg as c_mktsegment, count(c_custkey) as n from region cross join (select distinct c_mktsegment as seg from customer) left join (select c_custkey, c_mktsegment, n_regionkey from customer join nation on c_nationkey = n_nationkey where c_acctbal > 9500) on n_regionkey = r_regionkey and c_mktsegment = seg group by 1, 2")
def add_missing_items(spark, sf):
    c = lake(spark, sf, "customer")
    facts = related(spark, sf, c.filter("c_acctbal > 9500"), "customer_nation", "nation_region").groupBy("r_name", "c_mktsegment").agg(F.count("*").alias("n"))
    items = lake(spark, sf, "region").select("r_name").crossJoin(c.select("c_mktsegment").distinct())  # every pair is the result; no side is forced to all executors
    return items.join(facts, ["r_name", "c_mktsegment"], "left").select("r_name", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n"))


@query("with a as (select p_partkey, p_brand from part where p_partkey % 10 <> 1), b as (select p_partkey, case when p_partkey % 10 = 2 then 'new' else p_brand end as p_brand from part where p_partkey % 10 <> 3) select p_partkey, case when a.p_brand is null then 'added' when b.p_brand is null then 'removed' else 'changed' end as change from a full join b using (p_partkey) where a.p_brand is distinct from b.p_brand")
def catalog_diff(spark, sf):
    p = lake(spark, sf, "part").select("p_partkey", "p_brand")
    a = p.filter("p_partkey % 10 <> 1").select("p_partkey", _c("p_brand").alias("a"))
    b = p.filter("p_partkey % 10 <> 3").select("p_partkey", F.when(_c("p_partkey") % 10 == 2, "new").otherwise(_c("p_brand")).alias("b"))
    return a.join(b, "p_partkey", "full").filter(~_c("a").eqNullSafe(_c("b"))).select("p_partkey", F.when(_c("a").isNull(), "added").when(_c("b").isNull(), "removed").otherwise("changed").alias("change"))


# Latest n, top n


@query("select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by ts desc, event_id) as k from events) where k <= 5")
def latest_n_per_group(spark, sf):
    w = Window.partitionBy("user_id").orderBy(_c("ts").desc(), "event_id")
    return lake(spark, sf, "events").withColumn("k", F.row_number().over(w)).filter("k <= 5").select("user_id", "event_id")


@query(f"select c_mktsegment, o_custkey, v from (select *, rank() over (partition by c_mktsegment order by v desc) as k from (select c_mktsegment, o_custkey, sum(o_totalprice{_M})::double as v from orders join customer on o_custkey = c_custkey group by 1, 2)) where k <= 10")
def topn_with_ties(spark, sf):
    a = related(spark, sf, lake(spark, sf, "orders"), "orders_customer").groupBy("c_mktsegment", "o_custkey").agg(total("o_totalprice").alias("v"))
    return a.withColumn("k", F.rank().over(Window.partitionBy("c_mktsegment").orderBy(_c("v").desc()))).filter("k <= 10").drop("k")


@query("select c_custkey // 8 as label, count(distinct k) as sort_values, min(k) as sort_value, count(distinct k) > 1 as broken from (select c_custkey, case when c_custkey % 40 = 3 then -1 else c_custkey // 16 end as k from customer) group by 1")
def sort_by_audit(spark, sf):
    """A label may be sorted by another column only where each label has one value of it."""
    c = lake(spark, sf, "customer").selectExpr("c_custkey div 8 as label", "case when c_custkey % 40 = 3 then -1 else c_custkey div 16 end as k")
    return c.groupBy("label").agg(F.count_distinct("k").alias("sort_values"), F.min("k").alias("sort_value"), (F.count_distinct("k") > 1).alias("broken"))


@query("select count(*) as exported, (select count(*) from lineitem) > 100000 as truncated from (select 1 from lineitem limit 100000)")
def capped_export(spark, sf):
    head = lake(spark, sf, "lineitem").select(F.lit(1).alias("x")).limit(100_001)
    return head.agg(F.least(F.count("*"), F.lit(100_000)).alias("exported"), (F.count("*") > 100_000).alias("truncated"))
