import random
import time

import pytest
from pyspark.sql import functions as F

from starlens.operators import graphs


def frame(spark, edges):
    return spark.createDataFrame([(str(a), str(b)) for a, b in edges], "src string, dst string")


def reached(edges):
    """What every node reaches by at least one edge, step by step."""
    nxt = {}
    for a, b in edges:
        nxt.setdefault(str(a), set()).add(str(b))
    out = {}
    for n in {str(x) for e in edges for x in e}:
        seen, todo = set(), list(nxt.get(n, ()))
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += nxt.get(x, ())
        out[n] = seen
    return out


def brute_components(edges):
    r = reached(edges)
    return {n: min(m for m in r[n] if n in r[m]) for n in r if n in r[n]}


def random_edges(seed, n, m):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]


GRAPHS = {
    "sparse": random_edges(1, 40, 45), "dense": random_edges(3, 20, 80), "part": random_edges(5, 12, 40), "loops": [(1, 1), (1, 2), (2, 3), (4, 5), (5, 4), (5, 5), (6, 6), (6, 1), (2, 2)],
    "two rings and a bridge": [*((k, (k + 1) % 7) for k in range(7)), *((10 + k, 10 + (k + 1) % 5) for k in range(5)), (3, 20), (20, 21), (21, 12)], "repeated": [(1, 2)] * 3 + [(2, 1)] * 2,
}


#: all of them as one graph, with names that keep them apart
ALL = [(f"{name} {a}", f"{name} {b}") for name, edges in GRAPHS.items() for a, b in edges]


def test_components(spark):
    assert {r.name: r.component for r in graphs.components(frame(spark, ALL)).collect()} == brute_components(ALL)


def test_no_edges_and_no_cycles(spark):
    assert graphs.components(frame(spark, [(1, 2)])).count() == graphs.components(frame(spark, [(1, 2)]).limit(0)).count() == 0


def test_a_long_ring_takes_few_rounds(spark):
    began = time.time()
    ring = spark.range(400).select(F.col("id").alias("src"), ((F.col("id") + 1) % 400).alias("dst"))
    got = graphs.components(ring).groupBy("component").count().collect()
    assert [(r.component, r["count"]) for r in got] == [(0, 400)] and time.time() - began < 90


def test_reach_counts_and_answers(spark):
    want, e = reached(ALL), frame(spark, ALL)
    index = graphs.reach_index(e)
    assert {r.name: r.reached for r in graphs.reach_counts(e, index).collect()} == {n: len(s) for n, s in want.items()}
    pairs = [(a, b) for a in sorted(want)[::4] for b in sorted(want) if a != b] + [("no such", "1")]
    got = graphs.reaches(spark.createDataFrame(pairs, "src string, dst string"), *index)
    assert {(r.src, r.dst): r.reached for r in got.collect()} == {(a, b): b in want.get(a, ()) for a, b in pairs}


def test_forests_have_numbers_in_place_of_labels(spark):
    rng = random.Random(7)
    forest = [(k, rng.randrange(k // 2, k)) for k in range(1, 60) if k % 9] + [(5, 5), (70, 70)]
    index = graphs.reach_index(frame(spark, forest))
    assert index[1] is None and index[0].count() == len(reached(forest))
    want = reached(forest)
    assert {r.name: r.reached for r in graphs.reach_counts(frame(spark, forest), index).collect()} == {n: len(s) for n, s in want.items()}
    pairs = [(a, b) for a in want for b in want if a != b] + [("no such", "1"), ("1", None)]
    got = graphs.reaches(spark.createDataFrame(pairs, "src string, dst string"), *index)
    assert {(r.src, r.dst): r.reached for r in got.collect()} == {(a, b): b in want.get(a, ()) for a, b in pairs}
    for more in ([(9, 3), (9, 4)], [(18, 20), (20, 18)]):  # two edges out; a ring, in a graph of one edge out
        e = [x for x in forest if not (more[0][0] == 18 and x[0] in (18, 20))] + more
        got = graphs.reach_index(frame(spark, e))
        assert got[1] is not None
        assert {r.name: r.reached for r in graphs.reach_counts(frame(spark, e), got).collect()} == {n: len(s) for n, s in reached(e).items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_longest_chains(spark, seed):
    edges = [(a, b) for a, b in random_edges(seed, 40, 70) if a < b] + ([(50, 51), (51, 50), (49, 50), (48, 49), (48, 39)] if seed else [])
    nodes = sorted({x for e in edges for x in e} | {99})
    nxt = {n: {b for a, b in edges if a == n} for n in nodes}
    on = set(brute_components(edges))
    bad = on | {n for n, s in reached(edges).items() if s & on}

    def depth(n):
        return max((1 + depth(b) for b in nxt[n]), default=0)

    got = graphs.longest_chains(spark.createDataFrame([(str(n),) for n in nodes], "name string"), frame(spark, edges))
    assert {r.name: r.depth for r in got.collect()} == {str(n): depth(n) for n in nodes if str(n) not in bad}


def test_ancestry(spark):
    rng = random.Random(5)
    parent = {1: None, 2: 77, **{n: rng.randrange(1, n) for n in range(3, 60)}, 100: 101, 101: 100, 102: 101, **{n: n - 1 for n in range(201, 240)}, 200: None}
    got = {r.name: r for r in graphs.ancestry(spark.createDataFrame(list(parent.items()), "name long, parent long")).collect()}

    def up(n):
        return [n, *(up(parent[n]) if parent[n] in parent else [])]

    assert set(got) == set(parent) - {100, 101, 102}
    above = {n: up(n) for n in got}
    for n, r in got.items():
        assert (r.root, r.depth) == (above[n][-1], len(above[n]) - 1)
        for m, s in got.items():
            assert (r.root == s.root and r.enter <= s.enter <= r.leave) == (n in above[m])
