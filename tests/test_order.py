import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starlens.functions.order import neighbourhood, percentiles, ranks


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    hot = [("a", rng.choice([1.5, rng.randrange(500) / 4, None]), k) for k in range(900)]  # ties, nulls, one value of many rows
    return hot + [("b", float(k), k) for k in range(7)] + [(None, 2.0, 0), (None, 1.0, 1), ("c", 3.0, 0), ("d", None, 0)]


def by_key(rows):
    return {k: [(v, i) for key, v, i in rows if key == k] for k in {r[0] for r in rows}}


def test_ranks(spark, rows):
    want = {}
    for k, group in by_key(rows).items():
        values = [v for v, _ in group if v is not None]
        for v, i in group:
            above = [x for x in values if v is None or x > v]
            want[k, i] = (len(above) + 1, len(set(above)) + 1)
    got = ranks(spark.createDataFrame(rows, "k string, v double, i long"), "k", "v").collect()
    assert len(got) == len(rows) and {(r.k, r.i): (r.rank_, r.dense_) for r in got} == want


def test_percentiles(spark, rows):
    got = percentiles(spark.createDataFrame(rows, "k string, v double, i long"), "k", "v", {"p50": (0.5, False), "p100": (1.0, False), "p90x": (0.9, True)}).collect()
    groups = {k: [v for v, _ in g if v is not None] for k, g in by_key(rows).items()}
    assert {r.k for r in got} == {k for k, g in groups.items() if g}
    for r in got:
        g = sorted(groups[r.k])
        assert r.p50 == pytest.approx(np.percentile(g, 50)) and r.p100 == g[-1]
        h = 0.9 * (len(g) + 1)
        assert r.p90x == (pytest.approx(np.percentile(g, 90, method="weibull")) if 1 <= h <= len(g) else None)


def test_neighbours_across_stretches(spark, rows):
    made = {"before": lambda w: F.lag("i", 2).over(w), "after": lambda w: F.lead("i").over(w), "s": lambda w: F.sum("v").over(w.rowsBetween(-2, 1))}
    got = neighbourhood(spark.createDataFrame(rows, "k string, v double, i long"), "k", "v", "i", 2, 1, made, size=5).collect()
    want = {}
    for k, group in by_key(rows).items():
        line = sorted(group, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
        for n, (_, i) in enumerate(line):
            near = [v for v, _ in line[max(n - 2, 0) : n + 2] if v is not None]
            want[k, i] = (line[n - 2][1] if n > 1 else None, line[n + 1][1] if n + 1 < len(line) else None, sum(near) if near else None)
    assert len(got) == len(rows) and {(r.k, r.i): (r.before, r.after, r.s) for r in got} == want
    empty = neighbourhood(spark.createDataFrame([], "k string, v double, i long"), "k", "v", "i", 2, 1, made)
    assert empty.count() == 0


def test_only_large_keys_are_divided(spark, rows, monkeypatch):
    from starlens.functions import order

    monkeypatch.setattr(order, "WHOLE", 100)
    df = spark.createDataFrame(rows, "k string, v double, i long").repartition(4)
    pieces = {r.k: r.n for r in order._pieces(df, "k", "v").groupBy("k").agg(F.count_distinct("_piece").alias("n")).collect()}
    assert pieces.pop("a") > 10 and set(pieces.values()) == {1}
    divided = {(r.k, r.i): (r.rank_, r.dense_) for r in ranks(df, "k", "v").collect()}
    monkeypatch.setattr(order, "WHOLE", 1 << 16)
    assert divided == {(r.k, r.i): (r.rank_, r.dense_) for r in ranks(df, "k", "v").collect()}
