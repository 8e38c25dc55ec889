"""Lake tables, the star's relationships and the gap-free day frame."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: name -> (from table, from column, to table, to column, active); many to one, the to side filters the from side.
RELATIONSHIPS = {
    "lineitem_orders": ("lineitem", "l_orderkey", "orders", "o_orderkey", True),
    "orders_customer": ("orders", "o_custkey", "customer", "c_custkey", True),
    "customer_nation": ("customer", "c_nationkey", "nation", "n_nationkey", True),
    "nation_region": ("nation", "n_regionkey", "region", "r_regionkey", True),
    "lineitem_part": ("lineitem", "l_partkey", "part", "p_partkey", True),
    "lineitem_supplier": ("lineitem", "l_suppkey", "supplier", "s_suppkey", True),
    "supplier_nation": ("supplier", "s_nationkey", "nation", "n_nationkey", False),
}


def lake(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by its keys to four tasks a core: a file of few MB is read by one task, however much work its rows are. Few columns should be left."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def money(c: Column | str) -> Column:
    """A double with cents as an exact decimal, so that sums don't depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def cut(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder, its lineage cut."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df written as a table in the checkpoint folder and read from there.

    Like cut, but what is known of the rows is their true size: a loop's plan neither inherits the estimates and constraints of all
    rounds before, which the optimizer would go through again and again, nor sorts tables that are small enough to be broadcast.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        cut(spark.range(0))  # names the folder
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def total(c: Column | str) -> Column:
    return F.sum(money(c)).cast("double")


def divide(a: Column, b: Column, alternate: Column | None = None) -> Column:
    """a / b; the alternate (else null) where b is 0 or null."""
    out = F.try_divide(a, F.nullif(b, F.lit(0.0)))
    return out if alternate is None else F.coalesce(out, alternate)


def blank_sub(a: Column, b: Column) -> Column:
    """a - b where a blank counts as 0, unless both are blank."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0)))


def related(spark: SparkSession, sf_dir: str, fact: DataFrame, *names: str) -> DataFrame:
    """Follows many-to-one relationships by name; a fact row stays even where the dimension has none.

    Join sides are left to the optimizer, which broadcasts a dimension only below its size threshold.
    """
    for name in names:
        _, a, to, b, _ = RELATIONSHIPS[name]
        fact = fact.join(lake(spark, sf_dir, to), F.col(a) == F.col(b), "left")
    return fact


def orders_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, day, revenue: aggregated to days before anything else happens."""
    o = related(spark, sf_dir, lake(spark, sf_dir, "orders"), "orders_customer", "customer_nation", "nation_region")
    return o.groupBy(F.col("r_name").alias("region"), F.to_date("o_orderdate").alias("d")).agg(total("o_totalprice").alias("v"))


def dense(daily: DataFrame, key: str = "region", day: str = "d") -> DataFrame:
    """Every day from each key's first to the overall last; measures of days without data are null."""
    last = daily.agg(F.max(day).alias("last"))
    spans = daily.groupBy(key).agg(F.min(day).alias("first")).crossJoin(F.broadcast(last))  # one row
    days = spans.select(key, F.explode(F.sequence("first", "last")).alias(day))
    return days.join(daily, [key, day], "left")


#: the same frame for DuckDB: daily(region, d, v) and dense(region, d, v)
DENSE_SQL = """
daily as (select r_name as region, o_orderdate::date as d, sum(o_totalprice::decimal(18,2))::double as v from orders left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey group by 1, 2),
days as (select region, unnest(generate_series(first::timestamp, (select max(d) from daily)::timestamp, interval 1 day))::date as d from (select region, min(d) as first from daily group by region)),
dense as (select region, d, v from days left join daily using (region, d))
"""
