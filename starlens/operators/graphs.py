"""Graph algorithms on edge tables: components, longest chains, reachability, ancestors.

None of them walks a path step by step: chains are halved or doubled in every round, so that rounds grow with the logarithm of a chain's
length. The state is a table of edges that gets smaller, or one row for each node; pairs of nodes are never written out.
Edges have src and dst, of any type that can be compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.frames import written as cut

_c = F.col


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _draw(c: str, turn: int) -> Column:
    return F.struct(F.xxhash64(c, F.lit(turn)), c)


def components(edges: DataFrame) -> DataFrame:
    """name, component (its smallest name) of every node on a cycle; nodes on none are left out.

    A node without an edge in or out is on no cycle and goes. A node v with one edge in, u -> v, or with one out, is taken out and its
    neighbours are joined directly, which makes no more edges than it takes away; v is in the component of u exactly if one of its
    paths u -> v -> w has u and w in one component, so that its component is found when theirs are. Of neighbours that could both go, the one
    with the larger number drawn does. When no such node is left, all nodes take the largest name that reaches them and, from the nodes
    that keep their own, whatever of the same colour reaches them back is one component; edges between colours go.
    """
    e = edges.filter("src <> dst").select("src", "dst").distinct()
    for _ in range(2):  # most nodes of a graph that has few cycles go at once
        e = cut(e.join(e.select(_c("dst").alias("src")).distinct(), "src", "left_semi").join(e.select(_c("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst"))
    loops = [edges.filter("src = dst").select(_c("src").alias("name"))]
    out, taken, turn = [], [], 0
    while not e.isEmpty():
        turn += 1
        ends = e.select(_c("src").alias("name"), F.lit(0).alias("i"), F.lit(1).alias("o")).union(e.select("dst", F.lit(1), F.lit(0)))
        near = ends.groupBy("name").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))
        # 0: on no cycle, 1: may be taken out
        light = near.filter("i < 2 or o < 2").select("name", F.when((_c("i") == 0) | (_c("o") == 0), 0).otherwise(1).alias("k"))
        mark = lambda end: light.select(_c("name").alias(end), _c("k").alias(f"{end}_k"))  # noqa: E731, B023
        marked = cut(e.join(mark("src"), "src", "left").join(mark("dst"), "dst", "left").select("src", "dst", "src_k", "dst_k"))
        if marked.filter("src_k is not null or dst_k is not null").isEmpty():
            found, e = _coloured(e)
            out.append(found)
            continue
        both = marked.filter("src_k = 1 and dst_k = 1")
        beaten = both.select(F.when(_draw("src", turn) < _draw("dst", turn), _c("src")).otherwise(_c("dst")).alias("name")).distinct()
        go = marked.filter("src_k = 1").select(_c("src").alias("name")).union(marked.filter("dst_k = 1").select("dst")).distinct().join(beaten, "name", "left_anti").select("name")
        alive = marked.filter("coalesce(src_k, 1) = 1 and coalesce(dst_k, 1) = 1").select("src", "dst")
        into = alive.join(go.select(_c("name").alias("dst")), "dst", "left_semi").select(_c("dst").alias("name"), _c("src").alias("u"))
        from_ = alive.join(go.select(_c("name").alias("src")), "src", "left_semi").select(_c("src").alias("name"), _c("dst").alias("w"))
        paths = cut(into.join(from_, "name").select("name", "u", "w"))
        taken.append(paths)
        loops.append(paths.filter("u = w").select(_c("u").alias("name")))
        rest = alive.join(go.select(_c("name").alias("src")), "src", "left_anti").join(go.select(_c("name").alias("dst")), "dst", "left_anti")
        e = cut(rest.select("src", "dst").union(paths.filter("u <> w").select("u", "w")).distinct())
    once = cut(_union(loops).distinct())
    gone = _union([p.select("name") for p in taken]).distinct() if taken else once.limit(0)
    # a node with a loop is on a cycle, alone if nothing else shows
    alone = lambda names, others: names.join(others.select("name"), "name", "left_anti").select("name", _c("name").alias("component"))
    known = _union(out) if out else once.select("name", _c("name").alias("component")).limit(0)
    known = cut(known.unionByName(alone(once.join(gone, "name", "left_anti"), known)))
    for paths in reversed(taken):  # tables get larger as they come, so that writing them again doubles the work at most
        at = lambda end: known.select(_c("name").alias(end), _c("component").alias(f"{end}_in"))  # noqa: E731, B023
        met = paths.join(at("u"), "u").join(at("w"), "w").filter("u_in = w_in").select("name", _c("u_in").alias("component")).distinct()
        known = cut(known.unionByName(met).unionByName(alone(once.join(paths.select("name").distinct(), "name", "left_semi"), met)))
    least = known.groupBy("component").agg(F.min("name").alias("least"))
    return known.join(least, "component").select("name", _c("least").alias("component"))


def _coloured(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components of the nodes that keep their own colour, and the edges that may still hold others."""
    names = e.select(_c("src").alias("name")).union(e.select("dst")).distinct()
    colour = cut(names.select("name", _c("name").alias("colour")))
    while True:
        sent = e.join(colour.toDF("src", "colour"), "src").groupBy(_c("dst").alias("name")).agg(F.max("colour").alias("sent"))
        new = cut(colour.join(sent, "name", "left").select("name", F.greatest("colour", "sent").alias("colour"), F.coalesce(_c("sent") > _c("colour"), F.lit(False)).alias("moved")))
        colour = new.select("name", "colour")
        if new.filter("moved").isEmpty():
            break
    side = lambda end: colour.toDF(end, f"{end}_colour")
    inner = cut(e.join(side("src"), "src").join(side("dst"), "dst").filter("src_colour = dst_colour").select("src", "dst", _c("src_colour").alias("colour")))
    found = last = cut(colour.filter("name = colour"))
    while not last.isEmpty():
        back = inner.join(last.select(_c("name").alias("dst")), "dst", "left_semi").select(_c("src").alias("name"), "colour").distinct()
        last = cut(back.join(found.select("name"), "name", "left_anti"))
        found = found.unionByName(last)
    found = cut(found.select("name", _c("colour").alias("component")))
    rest = inner.join(found.select(_c("name").alias("src")), "src", "left_anti").join(found.select(_c("name").alias("dst")), "dst", "left_anti").select("src", "dst")
    # a node that only has edges to other colours is on no cycle
    return found.join(found.groupBy("component").count().filter("count > 1").select("component"), "component", "left_semi").select("name", "component"), cut(rest)


def longest_chains(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """name, depth: the longest chain of edges that starts at each node, 0 without one. Nodes on or above a cycle never end and are left out.

    depth(v) = max(least, weight + depth(next)) for a node with one edge left, and such functions compose: those nodes jump over each other until
    each hangs on a node that has none or several edges, in as many rounds as the logarithm of the longest run. Edges into runs
    move to their ends, edges to nodes without further ones become part of `least`, and so on with what is left; the runs get their depths last.
    """
    e = cut(edges.filter("src <> dst").join(nodes.select(_c("name").alias("src")), "src", "left_semi").groupBy("src", "dst").agg(F.lit(1).alias("w")))
    open_ = nodes.select("name", F.lit(0).alias("least")).join(edges.filter("src = dst").select(_c("src").alias("name")), "name", "left_anti")
    done, runs = [], []
    while True:
        out = e.groupBy(_c("src").alias("name")).agg(F.count("*").alias("n"), F.max(F.struct("w", "dst")).alias("one"))
        state = cut(open_.join(out, "name", "left").select("name", "least", F.coalesce("n", F.lit(0)).alias("n"), _c("one.w").alias("w"), _c("one.dst").alias("dst")))
        ended = state.filter("n = 0").select("name", _c("least").alias("depth"))
        done.append(ended)
        run, size = _run_ends(state.filter("n = 1").select("name", "least", "w", "dst"))
        runs.append(run)
        many = state.filter("n > 1").select("name", "least")
        if many.isEmpty():
            break
        kept = e.join(many.select(_c("name").alias("src")), "src", "left_semi")
        on = run.select(_c("name").alias("dst"), _c("least").alias("l2"), _c("w").alias("w2"), _c("dst").alias("d2"))
        moved = kept.join(on, "dst", "left").select("src", F.coalesce("d2", "dst").alias("dst"), (_c("w") + F.coalesce("w2", F.lit(0))).alias("w"), (_c("w") + F.coalesce("l2", F.lit(0))).alias("floor"))
        moved = moved.join(ended.select(_c("name").alias("dst"), "depth"), "dst", "left")
        moved = cut(moved.select("src", "dst", "w", F.greatest("floor", _c("w") + F.coalesce("depth", F.lit(0))).alias("floor"), _c("depth").isNotNull().alias("over")))
        floors = moved.groupBy(_c("src").alias("name")).agg(F.max("floor").alias("floor"))
        before = e.count()
        open_ = cut(many.join(floors, "name", "left").select("name", F.greatest("least", F.coalesce("floor", F.lit(0))).alias("least")))
        e = cut(moved.filter("not over").groupBy("src", "dst").agg(F.max("w").alias("w")))
        if not size and ended.isEmpty() and e.count() == before:
            break  # all that is left goes round
    for run in reversed(runs):
        done.append(run.join(_union(done).toDF("dst", "depth"), "dst").select("name", F.greatest("least", _c("w") + _c("depth")).alias("depth")))
    return _union(done)


def _run_ends(run: DataFrame) -> tuple[DataFrame, int]:
    """run (name, least, w, dst) with dst moved to where each run ends, four times as far with every table written, and its size; runs that go round are left out."""

    def jump(r: DataFrame) -> DataFrame:
        on = r.select(_c("name").alias("dst"), _c("least").alias("l2"), _c("w").alias("w2"), _c("dst").alias("d2"))
        return r.join(on, "dst", "left").select("name", F.greatest("least", _c("w") + F.coalesce("l2", F.lit(0))).alias("least"), (_c("w") + F.coalesce("w2", F.lit(0))).alias("w"), F.coalesce("d2", "dst").alias("dst"))

    size = run.count()
    for _ in range((size.bit_length() + 1) // 2):
        run = cut(jump(jump(run)))
        on = run.join(run.select(_c("name").alias("dst")), "dst", "left_semi")
        if on.isEmpty():
            return run, size
    return (cut(run.join(run.select(_c("name").alias("dst")), "dst", "left_anti")) if size else run), size


def chains(edges: DataFrame) -> DataFrame:
    """name, chain, pos, weight, for all nodes of an acyclic graph: paths that share no node; pos counts to the path's end, whose name the chain has.

    Every node asks for its smallest successor and a successor takes the smallest that asks. Positions are found by doubling.
    """
    asked = edges.groupBy("src").agg(F.min("dst").alias("dst")).groupBy("dst").agg(F.min("src").alias("src"))
    names = edges.select(_c("src").alias("name")).union(edges.select("dst")).distinct()
    at = cut(names.join(asked.select(_c("src").alias("name"), _c("dst").alias("next")), "name", "left").select("name", F.coalesce("next", "name").alias("chain"), _c("next").isNotNull().cast("int").alias("pos")))
    def jump(at: DataFrame) -> DataFrame:
        on = at.select(_c("name").alias("chain"), _c("chain").alias("c2"), _c("pos").alias("p2"))
        return at.join(on, "chain").select("name", _c("c2").alias("chain"), (_c("pos") + _c("p2")).alias("pos"))

    while True:
        at = cut(jump(jump(at)))
        if at.join(at.filter("pos > 0").select(_c("name").alias("chain")), "chain", "left_semi").isEmpty():
            return at


def _trees(edges: DataFrame) -> DataFrame | None:
    """name, root, depth, enter, leave of all nodes where no node has two edges out and none is on a cycle, but with itself; else nothing."""
    e = edges.filter("src <> dst")
    if not e.groupBy("src").count().filter("count > 1").isEmpty():
        return None
    names = cut(e.select(_c("src").alias("name"), _c("dst").alias("parent")).union(edges.select("dst", F.lit(None))).groupBy("name").agg(F.max("parent").alias("parent")))
    trees = cut(ancestry(names))
    return trees if trees.count() == names.count() else None


def reach_index(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The nodes (name, component, chain, pos) and their labels (component, chain, pos): a component reaches all of a chain up to that pos.

    Where the graph is a forest, whose nodes reach just what is above them, there are no labels and the nodes have numbers (name, root, depth, enter, leave).

    Components are shrunk to one node, a path cover divides what is left into chains, and a label is the furthest position of one chain that a node
    reaches. Labels are joined with those of the positions they name until none gets longer, which doubles the paths they stand for.
    """
    edges = cut(edges.select("src", "dst").distinct())
    if (trees := _trees(edges)) is not None:
        return trees, None
    within = cut(components(edges))
    end = lambda k: within.select(_c("name").alias(k), _c("component").alias(f"{k}_in"))
    joined = edges.join(end("src"), "src", "left").join(end("dst"), "dst", "left").select(F.coalesce("src_in", "src").alias("src"), F.coalesce("dst_in", "dst").alias("dst"))
    names = edges.select(_c("src").alias("name")).union(edges.select("dst")).distinct().join(within, "name", "left").select("name", F.coalesce("component", "name").alias("component"))
    thin = cut(joined.filter("src <> dst").distinct())
    place = cut(chains(thin))
    to = place.select(_c("name").alias("dst"), "chain", "pos")
    best = lambda df: df.groupBy("name", "chain").agg(F.max(F.struct("pos", "at")).alias("m")).select("name", "chain", _c("m.pos").alias("pos"), _c("m.at").alias("at"))
    label = cut(best(thin.join(to, "dst").select(_c("src").alias("name"), "chain", "pos", _c("dst").alias("at"))))
    size = label.agg(F.count("*"), F.sum("pos")).first()
    while True:
        on = label.select(_c("name").alias("at"), _c("chain").alias("c2"), _c("pos").alias("p2"), _c("at").alias("a2"))
        further = label.join(on, "at").select("name", _c("c2").alias("chain"), _c("p2").alias("pos"), _c("a2").alias("at"))
        label = cut(best(label.unionByName(further)))
        new = label.agg(F.count("*"), F.sum("pos")).first()
        if new == size:
            break
        size = new
    nodes = cut(names.join(place.select(_c("name").alias("component"), "chain", "pos"), "component", "left").select("name", "component", "chain", "pos"))
    return nodes, label.select(_c("name").alias("component"), "chain", "pos")


def reach_counts(edges: DataFrame, index: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """name, reached: how many nodes each node of edges reaches, itself counted where it is on a cycle. From the index, so that no pair is written."""
    edges = cut(edges.select("src", "dst"))
    nodes, labels = index or reach_index(edges)
    loops = edges.filter("src = dst").select(_c("src").alias("name")).distinct().withColumn("loop", F.lit(1))
    if labels is None:
        return nodes.join(loops, "name", "left").select("name", (_c("depth") + F.coalesce("loop", F.lit(0))).cast("long").alias("reached"))
    weight = nodes.groupBy("component").agg(F.count("*").alias("weight"), F.first("chain").alias("chain"), F.first("pos").alias("pos"))
    upto = Window.partitionBy("chain").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heavy = cut(weight.filter("weight > 1 and chain is not null"))
    # a chain's nodes count one each, but for its components of several nodes
    extra = heavy.select("chain", _c("pos").alias("from_"), F.sum(_c("weight") - 1).over(upto).alias("extra"))
    more = labels.join(extra, "chain").filter("from_ <= pos").groupBy("component", "chain").agg(F.max("extra").alias("extra"))
    n = labels.join(more, ["component", "chain"], "left").groupBy("component").agg(F.sum(_c("pos") + 1 + F.coalesce("extra", F.lit(0))).alias("n"))
    own = nodes.join(weight.select("component", "weight"), "component").join(n, "component", "left").join(loops, "name", "left")
    round_ = F.when(_c("weight") > 1, _c("weight")).otherwise(F.coalesce("loop", F.lit(0)))
    return own.select("name", (F.coalesce("n", F.lit(0)) + round_).cast("long").alias("reached"))


def reaches(pairs: DataFrame, nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """pairs (src, dst) with `reached`: whether a path leads from one to the other; nodes without edges reach nothing."""
    if labels is None:
        below = nodes.select(_c("name").alias("src"), _c("root").alias("src_root"), _c("enter").alias("at"))
        above = nodes.select(_c("name").alias("dst"), _c("root").alias("dst_root"), "enter", "leave")
        met = pairs.join(below, "src", "left").join(above, "dst", "left")
        return met.select(*pairs.columns, F.coalesce((_c("src_root") == _c("dst_root")) & _c("at").between(_c("enter"), _c("leave")) & (_c("src") != _c("dst")), F.lit(False)).alias("reached"))
    end = lambda k: nodes.select(_c("name").alias(k), _c("component").alias(f"{k}_in"), _c("chain").alias(f"{k}_chain"), _c("pos").alias(f"{k}_pos"))
    p = pairs.join(end("src"), "src", "left").join(end("dst"), "dst", "left")
    p = p.join(labels.select(_c("component").alias("src_in"), _c("chain").alias("dst_chain"), "pos"), ["src_in", "dst_chain"], "left")
    same = (_c("src_in") == _c("dst_in")) & (_c("src") != _c("dst"))
    return p.select(*pairs.columns, F.coalesce((_c("pos") >= _c("dst_pos")) | same, same, F.lit(False)).alias("reached"))


def ancestry(nodes: DataFrame) -> DataFrame:
    """name, root, depth, enter, leave for nodes (name, parent): a is above b, or is b, where both have one root and a.enter <= b.enter <= a.leave.

    `enter` numbers the nodes of a tree from 1, parents before children and children by name; leave is the last number below a node. Ancestors at
    distances 1, 2, 4 ... give depths, sizes of subtrees and numbers in twice as many rounds as the logarithm of the depth. A parent that is no
    node is none; nodes on or below a cycle have no root and are left out.
    """
    n = cut(nodes.select("name", "parent"))
    at = cut(n.join(n.select(_c("name").alias("parent"), F.lit(True).alias("there")), "parent", "left").select("name", F.when(_c("there"), _c("parent")).alias("up"), F.lit(1).alias("size"), F.when(_c("there"), 1).otherwise(0).alias("depth")))
    first, hops = at.select("name", _c("up").alias("parent")), [at.select("name", "up")]
    for _ in range(n.count().bit_length()):
        if at.filter("up is not null").isEmpty():
            break
        below = at.filter("up is not null").groupBy(_c("up").alias("name")).agg(F.sum("size").alias("more"))
        on = at.select(_c("name").alias("up"), _c("up").alias("u2"), _c("depth").alias("d2"))
        at = cut(at.join(below, "name", "left").join(on, "up", "left").select("name", _c("u2").alias("up"), (_c("size") + F.coalesce("more", F.lit(0))).alias("size"), (_c("depth") + F.coalesce("d2", F.lit(0))).alias("depth")))
        hops.append(at.select("name", "up"))
    at = at.filter("up is null")
    # roots have no siblings; by themselves they don't meet in one task
    earlier = Window.partitionBy("parent", F.when(_c("parent").isNull(), _c("name"))).orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    skip = F.when(_c("parent").isNull(), 1).otherwise(1 + F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    number = cut(first.join(at.select("name", "size", "depth"), "name").select("name", "size", "depth", skip.alias("enter"), _c("name").alias("root")))
    for up in hops[:-1]:
        on = number.select(_c("name").alias("up"), _c("enter").alias("e2"), _c("root").alias("r2"))
        number = cut(number.join(up, "name").join(on, "up", "left").select("name", "size", "depth", (_c("enter") + F.coalesce("e2", F.lit(0))).alias("enter"), F.coalesce("r2", "root").alias("root")))
    return number.select("name", "root", "depth", "enter", (_c("enter") + _c("size") - 1).alias("leave"))
