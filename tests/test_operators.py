import subprocess
import sys

import pytest

import __spark_entry__ as entry
from starlens.operators import MODULES, catalog, graphs, models, star, timeline
from starlens.sources.frames import dense

from .support import same

NAMES = [(m, n) for m in MODULES for n in m.QUERIES]


@pytest.mark.parametrize(("module", "name"), NAMES, ids=[n for _, n in NAMES])
def test_equals_sql(spark, sf_dir, module, name):
    same(module.QUERIES[name](spark, sf_dir), module.ORACLES[name], sf_dir)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_library_does_not_need_the_text_operators():
    seen = "import sys, starlens.operators, starlens.sources.projects; print([m for m in sys.modules if m.startswith('starlens.llm')])"
    assert subprocess.run([sys.executable, "-c", seen], capture_output=True, text=True, check=True).stdout.strip() == "[]"


def test_dense_frame_has_no_gap_and_feb_29_meets_feb_28(spark):
    daily = spark.sql("select 'a' as region, date'2019-02-28' as d, 1.0D as v union all select 'a', date'2020-02-29', 3.0D")
    f = dense(daily)
    assert f.count() == 367
    got = timeline.prior_year(f, "v").filter("d = '2020-02-29'").first()
    assert got.py_v == 1.0


def test_longest_paths_take_the_longer_branch_and_leave_cycles_out(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "x"), ("z", "x")], "src string, dst string")
    nodes = spark.createDataFrame([(x,) for x in "abcxyz"], "name string")
    assert {r.name: r.depth for r in graphs.longest_chains(nodes, e).collect()} == {"a": 2, "b": 1, "c": 0}


def test_capped_list_keeps_twenty_names_before_it_gathers_them(spark, tmp_path):
    rows = [(1, f"c{k:03}") for k in range(30)] + [(2, "b"), (2, "a"), (2, "a"), (None, "x"), (3, None)] + [(4, None)] + [(4, f"d{k:02}") for k in range(20)]
    spark.createDataFrame(rows, "c_nationkey int, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    df = catalog.capped_list(spark, str(tmp_path))
    d = ", ".join(f"d{k:02}" for k in range(20))
    assert {r.c_nationkey: r.names for r in df.collect()} == {1: ", ".join(f"c{k:03}" for k in range(20)) + " (+10 more)", 2: "a, a, b", None: "x", 3: "", 4: d + " (+1 more)"}
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_key_figures_round_the_product_as_sql_does(spark, tmp_path):
    spark.createDataFrame([(67781, 285925.0), (1, 49975.0), (5, 7.0)], "o_orderkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.o_orderkey: r.variance for r in catalog.udf_kpi_pack(spark, str(tmp_path)).collect()}
    assert got == {67781: "+471.9%", 1: "-0.1%", 5: "+0.0%"}


def test_approximate_counts_are_of_distinct_pairs_without_a_sketch_a_user(spark, tmp_path):
    spark.range(20000).selectExpr("case id % 3 when 0 then 'a' when 1 then 'b' end as event_type", "case when id % 7 > 0 then id % 4000 end as user_id").write.parquet(f"{tmp_path}/events.parquet")
    df = models.approx_distinct(spark, str(tmp_path))
    users = lambda left: len({k % 4000 for k in range(20000) if k % 3 in left and k % 7})
    assert {r.event_type: (r.exact, r.near) for r in df.collect()} == {"a": (users({0}), True), "b": (users({1}), True), None: (users({2}), True)}
    steps = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [x for x in steps if "approx_count_distinct" in x and "user_id" in x.split("keys=[")[1].split("]")[0]]


def test_profiles_of_columns_make_no_row_of_all_columns(spark, tmp_path):
    spark.sql("select id as p_partkey, case when id % 3 > 0 then concat('n', id % 7) end as p_name, 'b' as p_brand, cast(null as int) as p_size, id / 2 as p_retailprice from range(50)").write.parquet(f"{tmp_path}/part.parquet")
    df = star.column_profile(spark, str(tmp_path))
    assert {r.col: (r.n, r.nulls, r.distinct_values, r.lo, r.hi) for r in df.collect()} == {
        "p_partkey": (50, 0, 50, "0", "49"), "p_name": (33, 17, 7, "n0", "n6"), "p_brand": (50, 0, 1, "b", "b"), "p_size": (0, 50, 0, None, None), "p_retailprice": (50, 0, 50, "0.0", "24.5")}
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
