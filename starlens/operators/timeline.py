"""Time intelligence on a gap-free day frame, windows, calculation groups and key figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.order import neighbourhood, ranks
from ..sources.frames import DENSE_SQL, blank_sub, dense, divide, lake, orders_by_region, related, total

_c = F.col
QUERIES, ORACLES = {}, {}


def query(sql: str | None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return add


def to_date_total(frame: DataFrame, period: str, value: str = "v", key: str = "region") -> Column:
    """Running total from the start of the period."""
    w = Window.partitionBy(key, F.trunc("d", period)).orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(w)


def prior_year(frame: DataFrame, *values: str, key: str = "region") -> DataFrame:
    """Each row with the same measures a year before (always shifted backwards, so 29 Feb meets 28 Feb)."""
    past = frame.select(key, _c("d").alias("__d"), *(_c(v).alias(f"py_{v}") for v in values))
    return frame.withColumn("__d", F.add_months("d", -12)).join(past, [key, "__d"], "left").drop("__d")


def _frame(spark, sf):
    return dense(orders_by_region(spark, sf))


_PERIODS = {"mtd": "month", "qtd": "quarter", "ytd": "year"}
_RUN = "sum(v) over (partition by region, date_trunc('{p}', d) order by d rows unbounded preceding)"
_PY = "left join {t} as p on p.region = f.region and p.d = (f.d - interval 1 year)::date"

for _n, _p in _PERIODS.items():

    @query(f"with {DENSE_SQL} select region, d, round({_RUN.format(p=_p)}, 4) as value from dense", f"ti_{_n}")
    def _to_date(spark, sf, p=_p):
        f = _frame(spark, sf)
        return f.select("region", "d", F.round(to_date_total(f, p), 4).alias("value"))

    @query(f"with {DENSE_SQL}, f as (select region, d, round({_RUN.format(p=_p)}, 4) as x from dense) select f.region, f.d, p.x as value from f {_PY.format(t='f')}", f"ti_py_{_n}")
    def _py_to_date(spark, sf, p=_p):
        f = _frame(spark, sf)
        return prior_year(f.select("region", "d", F.round(to_date_total(f, p), 4).alias("x")), "x").select("region", "d", _c("py_x").alias("value"))


_SUB = "case when f.v is null and p.v is null then null else coalesce(f.v, 0) - coalesce(p.v, 0) end"


@query(f"with {DENSE_SQL} select f.region, f.d, p.v as value from dense as f {_PY.format(t='dense')}")
def ti_py(spark, sf):
    return prior_year(_frame(spark, sf), "v").select("region", "d", _c("py_v").alias("value"))


@query(f"with {DENSE_SQL} select f.region, f.d, {_SUB} as value from dense as f {_PY.format(t='dense')}")
def ti_yoy(spark, sf):
    return prior_year(_frame(spark, sf), "v").select("region", "d", blank_sub(_c("v"), _c("py_v")).alias("value"))


@query(f"with {DENSE_SQL} select f.region, f.d, ({_SUB}) / nullif(p.v, 0) as value from dense as f {_PY.format(t='dense')}")
def ti_yoy_pct(spark, sf):
    return prior_year(_frame(spark, sf), "v").select("region", "d", divide(blank_sub(_c("v"), _c("py_v")), _c("py_v")).alias("value"))


@query(
    f"with {DENSE_SQL}, m as (select region, date_trunc('month', d)::date as d, sum(v) as v from dense group by 1, 2), y as (select region, d, v, {_RUN.format(p='year')} as ytd from m) "
    f"select f.region, f.d, round(f.v, 2) as revenue, round(f.ytd, 2) as ytd, round(p.v, 2) as py, round({_SUB}, 2) as yoy, round(({_SUB}) / nullif(p.v, 0), 6) as yoy_pct from y as f {_PY.format(t='y')}"
)
def monthly_revenue(spark, sf):
    m = _frame(spark, sf).groupBy("region", F.trunc("d", "month").alias("d")).agg(F.sum("v").alias("v"))
    y = prior_year(m.withColumn("ytd", to_date_total(m, "year")), "v")
    yoy = blank_sub(_c("v"), _c("py_v"))
    return y.select("region", "d", F.round("v", 2).alias("revenue"), F.round("ytd", 2).alias("ytd"), F.round("py_v", 2).alias("py"), F.round(yoy, 2).alias("yoy"), F.round(divide(yoy, _c("py_v")), 6).alias("yoy_pct"))


_FAM = f"""with {DENSE_SQL.replace("as v from orders", "as v, count(*)::double as n, max(o_totalprice) as hi from orders").replace("select region, d, v from days", "select region, d, v, n, hi from days")},
l as (select region, d, 'Revenue' as base, v as x from dense union all select region, d, 'Orders', n from dense union all select region, d, 'Largest', hi from dense),
r as (select region, base, d, x, {", ".join(f"sum(x) over (partition by region, base, date_trunc('{p}', d) order by d rows unbounded preceding) as {n}" for n, p in _PERIODS.items())} from l),
j as (select r.*, p.x as py, {", ".join(f"p.{n} as py_{n}" for n in _PERIODS)}, case when r.x is null and p.x is null then null else coalesce(r.x, 0) - coalesce(p.x, 0) end as yoy from r left join r as p on p.region = r.region and p.base = r.base and p.d = (r.d - interval 1 year)::date)
""" + " union all ".join(f"select region, d, base || ' {shown}' as measure, round({x}, 4) as value from j" for shown, x in (("MTD", "mtd"), ("QTD", "qtd"), ("YTD", "ytd"), ("PY", "py"), ("PY MTD", "py_mtd"), ("PY QTD", "py_qtd"), ("PY YTD", "py_ytd"), ("YoY", "yoy"), ("YoY %", "yoy / nullif(py, 0)")))


@query(_FAM)
def ti_family(spark, sf):
    """Nine variants of three measures: to date by month, quarter and year, the same a year before, and the change."""
    o = related(spark, sf, lake(spark, sf, "orders"), "orders_customer", "customer_nation", "nation_region")
    daily = o.groupBy(_c("r_name").alias("region"), F.to_date("o_orderdate").alias("d")).agg(total("o_totalprice").alias("Revenue"), F.count("*").cast("double").alias("Orders"), F.max("o_totalprice").alias("Largest"))
    bases = ("Revenue", "Orders", "Largest")
    f = dense(daily)
    f = f.select("*", *(to_date_total(f, p, b).alias(f"{b}_{n}") for b in bases for n, p in _PERIODS.items()))
    f = prior_year(f, *bases, *(f"{b}_{n}" for b in bases for n in _PERIODS))
    out = []
    for b in bases:
        yoy = blank_sub(_c(b), _c(f"py_{b}"))
        out += [(f"{b} {n.upper()}", _c(f"{b}_{n}")) for n in _PERIODS] + [(f"{b} PY", _c(f"py_{b}"))] + [(f"{b} PY {n.upper()}", _c(f"py_{b}_{n}")) for n in _PERIODS]
        out += [(f"{b} YoY", yoy), (f"{b} YoY %", divide(yoy, _c(f"py_{b}")))]
    rows = F.array(*(F.struct(F.lit(n).alias("measure"), F.round(x, 4).alias("value")) for n, x in out))
    return f.select("region", "d", F.explode(rows).alias("s")).select("region", "d", "s.*")


@query(f"with {DENSE_SQL} select f.region, f.d, a.v as previous_day, b.v as next_day, m.v as month_back from dense as f left join dense as a on a.region = f.region and a.d = f.d - 1 left join dense as b on b.region = f.region and b.d = f.d + 1 left join dense as m on m.region = f.region and m.d = (f.d - interval 1 month)::date")
def ti_dateadd(spark, sf):
    f = _frame(spark, sf)
    w = Window.partitionBy("region").orderBy("d")
    back = f.select("region", _c("d").alias("m"), _c("v").alias("month_back"))
    g = f.withColumns({"previous_day": F.lag("v").over(w), "next_day": F.lead("v").over(w), "m": F.add_months("d", -1)})
    return g.join(back, ["region", "m"], "left").select("region", "d", "previous_day", "next_day", "month_back")


@query(f"with {DENSE_SQL}, q as (select region, date_trunc('quarter', d)::date as q, round(sum(v), 4) as v from dense group by 1, 2) select region, q, v, lag(v) over (partition by region order by q) as previous_quarter, lead(v) over (partition by region order by q) as next_quarter from q")
def ti_parallel(spark, sf):
    q = _frame(spark, sf).groupBy("region", F.trunc("d", "quarter").alias("q")).agg(F.round(F.sum("v"), 4).alias("v"))
    w = Window.partitionBy("region").orderBy("q")
    return q.select("region", "q", "v", F.lag("v").over(w).alias("previous_quarter"), F.lead("v").over(w).alias("next_quarter"))


for _p in ("month", "year"):

    @query(f"with {DENSE_SQL}, q as (select region, date_trunc('{_p}', d)::date as period, round(sum(v), 4) as v from dense group by 1, 2) select region, period, v, lag(v) over (partition by region order by period) as previous, lead(v) over (partition by region order by period) as following from q", f"ti_parallel_{_p}")
    def _parallel(spark, sf, p=_p):
        q = _frame(spark, sf).groupBy("region", F.trunc("d", p).alias("period")).agg(F.round(F.sum("v"), 4).alias("v"))
        w = Window.partitionBy("region").orderBy("period")
        return q.select("region", "period", "v", F.lag("v").over(w).alias("previous"), F.lead("v").over(w).alias("following"))


for _p in ("quarter", "year"):

    @query(f"with {DENSE_SQL}, m as (select region, date_trunc('{_p}', d)::date as period, max_by(v, d) filter (v is not null) as closing from dense group by 1, 2) select region, period, closing, lag(closing) over (partition by region order by period) as opening from m", f"ti_balance_{_p}")
    def _balance(spark, sf, p=_p):
        m = _frame(spark, sf).groupBy("region", F.trunc("d", p).alias("period")).agg(F.max_by("v", F.when(_c("v").isNotNull(), _c("d"))).alias("closing"))
        return m.withColumn("opening", F.lag("closing").over(Window.partitionBy("region").orderBy("period")))


@query(f"with {DENSE_SQL} select region, d, round(sum(v) over (partition by region order by d rows 27 preceding), 4) as value from dense")
def ti_moving_28d(spark, sf):
    return _frame(spark, sf).select("region", "d", F.round(F.sum("v").over(Window.partitionBy("region").orderBy("d").rowsBetween(-27, 0)), 4).alias("value"))


@query(f"with {DENSE_SQL}, m as (select region, date_trunc('month', d)::date as month, max_by(v, d) filter (v is not null) as closing, min_by(v, d) filter (v is not null) as first_value from dense group by 1, 2) select region, month, closing, first_value, lag(closing) over (partition by region order by month) as opening from m")
def ti_closing_balance(spark, sf):
    day = F.when(_c("v").isNotNull(), _c("d"))
    m = _frame(spark, sf).groupBy("region", F.trunc("d", "month").alias("month")).agg(F.max_by("v", day).alias("closing"), F.min_by("v", day).alias("first_value"))
    return m.withColumn("opening", F.lag("closing").over(Window.partitionBy("region").orderBy("month")))


@query("select distinct o_orderdate::date as d, date_trunc('month', o_orderdate)::date as month_start, last_day(o_orderdate::date) as month_end, date_trunc('quarter', o_orderdate)::date as quarter_start, (date_trunc('quarter', o_orderdate) + interval 3 month - interval 1 day)::date as quarter_end, date_diff('day', date_trunc('month', o_orderdate)::date, o_orderdate::date) + 1 as mtd_days, date_diff('day', date_trunc('quarter', o_orderdate)::date, o_orderdate::date) + 1 as qtd_days, date_diff('day', date_trunc('year', o_orderdate)::date, o_orderdate::date) + 1 as ytd_days, date_trunc('year', o_orderdate)::date as year_start, (date_trunc('year', o_orderdate) + interval 1 year - interval 1 day)::date as year_end from orders")
def ti_period_bounds(spark, sf):
    d = lake(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    days = [(F.date_diff("d", F.trunc("d", p)) + 1).cast("long").alias(f"{n}_days") for n, p in _PERIODS.items()]  # days in the set to date
    return d.select("d", F.trunc("d", "month").alias("month_start"), F.last_day("d").alias("month_end"), F.trunc("d", "quarter").alias("quarter_start"), F.date_sub(F.add_months(F.trunc("d", "quarter"), 3), 1).alias("quarter_end"), *days, F.trunc("d", "year").alias("year_start"), F.date_sub(F.add_months(F.trunc("d", "year"), 12), 1).alias("year_end"))


@query("with f as (select year(o_orderdate)::bigint as y, o_custkey, min(o_orderdate::date) as d from orders group by 1, 2), n as (select y, d, count(*) as k from f group by 1, 2) select y, d, sum(k) over (partition by y order by d)::bigint as customers from n")
def ti_ytd_distinct(spark, sf):
    first = lake(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("long").alias("y"), "o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("d"))
    n = first.groupBy("y", "d").agg(F.count("*").alias("k"))
    return n.select("y", "d", F.sum("k").over(Window.partitionBy("y").orderBy("d")).alias("customers"))


_SPEND = "select c_mktsegment, o_custkey, sum(o_totalprice::decimal(18,2))::double as v from orders join customer on o_custkey = c_custkey group by 1, 2"


def _spend(spark, sf):
    return related(spark, sf, lake(spark, sf, "orders"), "orders_customer").groupBy("c_mktsegment", "o_custkey").agg(total("o_totalprice").alias("v"))


@query(f"select *, rank() over (partition by c_mktsegment order by v desc)::bigint as rank_, dense_rank() over (partition by c_mktsegment order by v desc)::bigint as dense_ from ({_SPEND})")
def rank_measure(spark, sf):
    return ranks(_spend(spark, sf), "c_mktsegment", "v")


@query(f"select c_mktsegment, o_custkey, lag(v, 2) over w as two_before, lead(v, 1) over w as next_, first_value(v) over w as first_ from ({_SPEND}) window w as (partition by c_mktsegment order by v desc, o_custkey)")
def window_offset(spark, sf):
    spend = _spend(spark, sf)
    near = neighbourhood(spend, "c_mktsegment", "v", "o_custkey", 2, 1, {"two_before": lambda w: F.lag("v", 2).over(w), "next_": lambda w: F.lead("v").over(w)})
    most = spend.groupBy(_c("c_mktsegment").alias("k")).agg(F.max("v").alias("first_"))
    return near.join(most, _c("c_mktsegment").eqNullSafe(_c("k")), "left").select("c_mktsegment", "o_custkey", "two_before", "next_", "first_")


@query(f"select c_mktsegment, o_custkey, round(sum(v) over (partition by c_mktsegment order by v desc, o_custkey rows between 2 preceding and 1 following), 4) as s from ({_SPEND})")
def window_frame(spark, sf):
    near = neighbourhood(_spend(spark, sf), "c_mktsegment", "v", "o_custkey", 2, 1, {"s": lambda w: F.round(F.sum("v").over(w.rowsBetween(-2, 1)), 4)})
    return near.select("c_mktsegment", "o_custkey", "s")


@query("select p_brand, p_partkey, (select count(*) from part as q where q.p_brand = part.p_brand and q.p_retailprice > part.p_retailprice) + 1 as r from part")
def earlier_rank(spark, sf):
    p = lake(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    return ranks(p, "p_brand", "p_retailprice").select("p_brand", "p_partkey", _c("rank_").alias("r"))


# Calculation groups: an item is a function from a measure (and its prior year) to a value.

_MONTHS = f"with {DENSE_SQL}, m as (select region, date_trunc('month', d)::date as d, round(sum(v), 2) as v, count(v)::double as n from dense group by 1, 2), l as (select region, d, 'Revenue' as base, v from m union all select region, d, 'Days', n from m), j as (select f.region, f.d, f.base, f.v, p.v as py from l as f left join l as p on p.region = f.region and p.base = f.base and p.d = (f.d - interval 1 year)::date)"
_J_SUB = "case when v is null and py is null then null else coalesce(v, 0) - coalesce(py, 0) end"

#: name, ordinal, value, format
ITEMS = (("Current", 0, lambda v, py: v, None), ("YoY", 1, blank_sub, None), ("YoY %", 2, lambda v, py: divide(blank_sub(v, py), py), "0.0%"))


def _bases(spark, sf):
    m = _frame(spark, sf).groupBy("region", F.trunc("d", "month").alias("d")).agg(F.round(F.sum("v"), 2).alias("v"), F.count("v").cast("double").alias("n"))
    m = prior_year(m, "v", "n")
    rows = F.array(F.struct(F.lit("Revenue").alias("base"), _c("v"), _c("py_v").alias("py")), F.struct(F.lit("Days").alias("base"), _c("n").alias("v"), _c("py_n").alias("py")))
    return m.select("region", "d", F.explode(rows).alias("s")).select("region", "d", "s.*")


@query(f"{_MONTHS} select region, d, base, 'Current' as item, 0 as ordinal, v as value from j union all select region, d, base, 'YoY', 1, round({_J_SUB}, 2) from j union all select region, d, base, 'YoY %', 2, round(({_J_SUB}) / nullif(py, 0), 6) from j")
def calc_group(spark, sf):
    digits = {"Current": 2, "YoY": 2, "YoY %": 6}
    rows = F.array(*(F.struct(F.lit(n).alias("item"), F.lit(o).alias("ordinal"), F.round(f(_c("v"), _c("py")), digits[n]).alias("value")) for n, o, f, _ in ITEMS))
    return _bases(spark, sf).select("region", "d", "base", F.explode(rows).alias("s")).select("region", "d", "base", "s.*")


@query(f"{_MONTHS} select region, d, base, round(2 * ({_J_SUB}), 4) as value from j")
def calc_group_precedence(spark, sf):
    groups = [(20, lambda x: (x[0] * 2, x[1] * 2)), (10, lambda x: (blank_sub(*x), F.lit(None).cast("double")))]
    x = (_c("v"), _c("py"))
    for _, f in sorted(groups, key=lambda g: g[0]):  # the higher precedence comes last
        x = f(x)
    return _bases(spark, sf).select("region", "d", "base", F.round(x[0], 4).alias("value"))


@query(f"{_MONTHS} select distinct base, item, case when item = 'YoY %' and base = 'Revenue' then '0.0%' when base = 'Revenue' then '#,0.00' else '#,0' end as format from j cross join (values ('Current'), ('YoY'), ('YoY %')) as i(item)")
def calc_group_format(spark, sf):
    own = F.when(_c("base") == "Revenue", "#,0.00").otherwise("#,0")
    rows = F.array(*(F.struct(F.lit(n).alias("item"), (F.when(own == "#,0.00", fmt).otherwise(own) if fmt else own).alias("format")) for n, _, _, fmt in ITEMS))
    return _bases(spark, sf).select("base").distinct().select("base", F.explode(rows).alias("s")).select("base", "s.*")


@query(f"{_MONTHS}, r(region, rate) as (select r_name, 1 + r_regionkey * 0.25 from region) select region, d, round(v * rate, 4) as converted, round(v - py, 4) as to_target, round(v / nullif(py, 0), 6) as of_target from j join r using (region) where base = 'Revenue'")
def calc_group_currency(spark, sf):
    rates = lake(spark, sf, "region").select(_c("r_name").alias("region"), (1 + _c("r_regionkey") * 0.25).alias("rate"))
    b = _bases(spark, sf).filter("base = 'Revenue'").join(rates, "region")
    return b.select("region", "d", F.round(_c("v") * _c("rate"), 4).alias("converted"), F.round(_c("v") - _c("py"), 4).alias("to_target"), F.round(divide(_c("v"), _c("py")), 6).alias("of_target"))


@query(f"{_MONTHS}, k as (select region, d, v, py * 1.05 as target from j where base = 'Revenue') select region, d, round(target, 4) as target, round(v - target, 4) as variance, round((v - target) / nullif(target, 0), 6) as variance_pct, case when v / nullif(target, 0) >= 1 then '#80004B' when v / nullif(target, 0) >= 0.95 then '#0D9F6E' when v / nullif(target, 0) >= 0.8 then '#C97A1E' when v / nullif(target, 0) > 0 then '#C92A2A' else '#9E9E9E' end as color, round(greatest(v, target) * 1.1, 4) as gauge_max from k")
def kpi_suite(spark, sf):
    k = _bases(spark, sf).filter("base = 'Revenue'").withColumn("target", _c("py") * 1.05)
    ratio = divide(_c("v"), _c("target"))
    color = F.when(ratio >= 1, "#80004B").when(ratio >= 0.95, "#0D9F6E").when(ratio >= 0.8, "#C97A1E").when(ratio > 0, "#C92A2A").otherwise("#9E9E9E")
    variance = _c("v") - _c("target")
    return k.select("region", "d", F.round("target", 4).alias("target"), F.round(variance, 4).alias("variance"), F.round(divide(variance, _c("target")), 6).alias("variance_pct"), color.alias("color"), F.round(F.greatest("v", "target") * 1.1, 4).alias("gauge_max"))


@query(f"{_MONTHS}, p as (select region, d, least(1.0, greatest(0.0, v / nullif(py, 0))) as pct from j where base = 'Revenue' and py is not null) select region, d, case when pct >= 0.9 then 'good' when pct >= 0.7 then 'warning' else 'bad' end as band, round(pct * 120)::bigint as bar from p")
def rag_band(spark, sf):
    p = _bases(spark, sf).filter("base = 'Revenue' and py is not null").withColumn("pct", F.least(F.lit(1.0), F.greatest(F.lit(0.0), divide(_c("v"), _c("py")))))
    return p.select("region", "d", F.when(_c("pct") >= 0.9, "good").when(_c("pct") >= 0.7, "warning").otherwise("bad").alias("band"), F.round(_c("pct") * 120).cast("long").alias("bar"))


@query(f"{_MONTHS}, p as (select region, d, ({_J_SUB}) / nullif(py, 0) as x from j where base = 'Revenue') select region, d, case when x >= 0.1 then '▲' when x >= 0 then '●' else '▼' end as arrow from p where x is not null")
def yoy_status(spark, sf):
    x = divide(blank_sub(_c("v"), _c("py")), _c("py"))
    return _bases(spark, sf).filter("base = 'Revenue'").withColumn("x", x).filter("x is not null").select("region", "d", F.when(_c("x") >= 0.1, "▲").when(_c("x") >= 0, "●").otherwise("▼").alias("arrow"))


@query("select r_name, 'Orders: ' || format('{:,}', count(*)) as subtitle from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1")
def subtitle_text(spark, sf):
    o = related(spark, sf, lake(spark, sf, "orders"), "orders_customer", "customer_nation", "nation_region")
    return o.groupBy("r_name").agg(F.concat(F.lit("Orders: "), F.format_number(F.count("*"), 0)).alias("subtitle"))


@query("select r_name, count_if(l_extendedprice * (1 - l_discount) > c_acctbal) as above_balance from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1")
def calculated_column(spark, sf):
    li = related(spark, sf, lake(spark, sf, "lineitem"), "lineitem_orders", "orders_customer", "customer_nation", "nation_region")
    li = li.withColumn("above", _c("l_extendedprice") * (1 - _c("l_discount")) > _c("c_acctbal"))
    return li.groupBy("r_name").agg(F.count_if("above").alias("above_balance"))
