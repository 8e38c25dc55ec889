"""Formats, paths, report trees, sequences of changes and role masks against plain Python."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from starlens.functions.formats import by_format, section, sections
from starlens.functions.order import ranks
from starlens.operators import changes, security
from starlens.sources.projects import report_items, resolve_projects, xml_tree


def test_sections_of_a_format():
    assert sections(r'0;"a;b"0;\;') == ["0", '"a;b"0', r"\;"] and sections("") == [""]
    s = section('"$"#,##0.0# "x"')
    assert (s.before, s.behind, s.whole, s.fixed, s.places, s.grouped, s.hundredfold) == ("$", " x", 1, 1, 2, True, 0)
    assert not section('"none"').digits and section("0%").hundredfold == 1


def plain(v, text):
    """One format on one decimal, step by step."""
    parts = sections(text)
    k = 0
    if v < 0 and len(parts) > 1 and parts[1]:
        k = 1
    if v == 0 and len(parts) > 2 and parts[2]:
        k = 2
    s = section(parts[k])
    if not s.digits:
        return s.before + s.behind
    r = (abs(v) * 100**s.hundredfold).quantize(Decimal(1).scaleb(-s.places), ROUND_HALF_UP)
    whole, _, dec = f"{r:.{s.places}f}".partition(".")
    while len(dec) > s.fixed and dec.endswith("0"):
        dec = dec[:-1]
    whole = f"{int(whole):,}" if s.grouped else whole
    whole = "" if whole == "0" and s.whole == 0 else "0" * max(0, s.whole - len(whole.replace(",", ""))) + whole
    sign = "-" if v < 0 and r > 0 and (len(parts) == 1 or not parts[1]) else ""
    return sign + s.before + whole + ("." + dec if dec else "") + s.behind


def test_formats_on_values_of_every_sign(spark):
    formats = ["0", "#", "#,0", "#,##0.00", "0.0%", "000.0#", ".00", "+0;-0;zero", "0;(0)", '0;;"nil"', '"q;"0', "\\#0", "$#,0.0 ;neg $0", '"only text"', "0.###%", "", "x0y;a0b;c"]
    values = [Decimal(x) for x in ("0", "1", "-1", "0.5", "-0.5", "1234567.891", "-1234567.895", "0.004", "-0.004", "99.995", "-0.0005", "12")]
    rows = [(v, f) for v in values for f in formats] + [(None, f) for f in formats] + [(Decimal(3), None)]
    got = by_format(spark.createDataFrame(rows, "v decimal(18,6), f string"), "v", "f", "shown").collect()
    assert len(got) == len(rows)
    for r in got:
        if r.v is None:
            assert r.shown is None
        elif r.f:
            assert r.shown == plain(r.v, r.f), (r.v, r.f)
        else:
            assert Decimal(r.shown) == r.v
    with pytest.raises(ValueError):
        by_format(spark.createDataFrame(rows, "v decimal(18,6), f string"), "v", "f", "shown", most=3)


def test_projects_by_paths(spark):
    files = [
        ("/r/a.pbip", '{"artifacts": [{"report": {"path": "a.Report"}}, {"semanticModel": {"path": "./m/../a.Model"}}]}'), ("/r/x/b.pbip", '{"artifacts": [{"report": {"path": "../b.Report"}}]}'), ("/r/b.Report/definition.pbir", '{"datasetReference": {"byPath": {"path": "../../up/b.Model"}}}'),
        ("/r/c.pbip", '{"artifacts": [{"report": {"path": "c.Report"}}]}'), ("/r/c.Report/definition.pbir", "broken"), ("/r/1/2/3/d.pbip", "{}"), ("/r/1/2/3/4/e.pbip", "{}"), ("/r/dist/f.pbip", "{}"), ("/r/g.pbip", "["), ("/r/h.pbip", None), ("/r/i.pbip", '{"artifacts": []}'), ("/s/j.pbip", "{}"),
        ("/r/k.pbip", '{"artifacts": [{"report": {"path": "/abs//k.Report/"}}]}'),
    ]
    got = {r.name: (r.model_path, r.report_path) for r in resolve_projects(spark.createDataFrame(files, "path string, content string"), "/r/", 3).collect()}
    assert got == {"a": ("/r/a.Model", "/r/a.Report"), "b": ("/up/b.Model", "/r/b.Report"), "c": (None, "/r/c.Report"), "d": (None, None), "i": (None, None), "k": (None, "/abs/k.Report")}


def test_report_trees_of_odd_files(spark):
    files = [
        ("deep", "<r:Report><Body><ReportItems>" + "<Rectangle Name='r'><ReportItems>" * 30 + '<Line Name="l>&lt;&amp;lt;"/>' + "</ReportItems></Rectangle>" * 30 + "</ReportItems></Body></r:Report>"),
        ("sections", "<Report><ReportSections>" + "".join(f"<ReportSection><Body><ReportItems><Textbox Name='t{k}'/></ReportItems></Body><Page><PageHeader><ReportItems><Image Name='h{k}'/></ReportItems></PageHeader></Page></ReportSection>" for k in range(3)) + "</ReportSections></Report>"),
        ("empty", ""), ("null", None), ("no xml", "a < b > c"), ("unnamed", "<Report><Body><ReportItems><Chart/><Textbox></Textbox></ReportItems></Body></Report>"),
    ]
    df = spark.createDataFrame(files, "path string, content string")
    got = {}
    for r in report_items(df).collect():
        got.setdefault(r.path, []).append((r.section, r.part, r.type, r.name, r.parent))
    assert len(got["deep"]) == 31 and sum(x[4] is None for x in got["deep"]) == 1 and (0, "body", "Line", "l><&lt;", "r") in got["deep"]
    assert sorted(got["sections"]) == sorted((k, part, kind, f"{c}{k}", None) for k in range(3) for part, kind, c in (("body", "Textbox", "t"), ("header", "Image", "h")))
    assert sorted(got["unnamed"]) == [(0, "body", "Chart", "", None), (0, "body", "Textbox", "", None)] and set(got) == {"deep", "sections", "unnamed"}
    assert {r.name: r.level for r in xml_tree(df.filter("path = 'unnamed'")).collect()} == {"Report": 1, "Body": 2, "ReportItems": 3, "Chart": 4, "Textbox": 4}


def test_sequences_of_changes_come_out_as_if_done_in_turn(spark):
    rng = random.Random(6)
    ops = [(k, f"E{rng.randrange(3)}", f"P{rng.randrange(4)}", rng.choice([None, "E0", "E1"]), rng.choice([None, "P0", "P1", "P2"])) for k in range(60)]
    ops += [(100, "A", "x", None, "tmp"), (101, "A", "y", None, "x"), (102, "A", "tmp", None, "y"), (103, "A", "y", "B", None), (104, None, "x", None, "z")]
    got = {(r.entity, r.property): (r.to_entity, r.to_property, r.steps) for r in changes.composed(spark.createDataFrame(ops, "seq long, entity string, property string, new_entity string, new_property string")).collect()}
    want = {}
    for key in {(e, p) for _, e, p, _, _ in ops if e is not None}:
        now, steps = key, 0
        for _, e, p, e2, p2 in ops:
            if now == (e, p):
                now, steps = (e2 or e, p2 or p), steps + 1
        want[key] = (*now, steps)
    assert got == want and got["A", "x"][:2] == ("B", "y") and got["A", "y"][:2] == ("A", "x")


def test_masks_of_odd_predicates(spark):
    rows = spark.createDataFrame([(1, "a"), (5, "b"), (None, "a"), (9, None)], "n int, s string")
    preds = [(0, "t", "n", "=", "1"), (0, "t", "n", "=", "9"), (1, "t", "n", ">", "1"), (1, "t", "n", "<", "9"), (2, "t", "s", "<>", "a"), (3, "u", "n", "=", "1"), (62, "t", "s", "=", "a"), (62, "t", "n", ">=", "1")]
    p = spark.createDataFrame(preds, "role int, table_name string, column_name string, op string, value string")
    mask, limited = security.compiled(p, {"t": {"n": "int", "s": "string"}, "u": {"n": "int"}})["t"]
    got = [tuple(r[f"r{k}"] for k in (0, 1, 2, 3, 62)) for r in rows.select(*(F.getbit(mask, F.lit(k)).alias(f"r{k}") for k in (0, 1, 2, 3, 62))).collect()]
    assert got == [(1, 0, 0, 1, 1), (0, 1, 1, 1, 0), (0, 0, 0, 1, 0), (1, 0, 0, 1, 0)] and limited == 0b111 | 1 << 62
    with pytest.raises(ValueError):
        security.compiled(p.withColumn("role", F.lit(63)), {"t": {"n": "int", "s": "string"}, "u": {"n": "int"}})


def test_strings_are_ranked_across_pieces(spark):
    names = [f"{k % 7}é{k:05}" for k in range(3000)] + ["", "z"]
    df = spark.createDataFrame([("all", n) for n in names] + [("one", "x")], "k string, v string")
    got = {r.v: r.rank_ for r in ranks(df, "k", "v", rising=True).filter("k = 'all'").collect()}
    assert [v for v, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(names, key=str.encode) and sorted(got.values()) == list(range(1, len(names) + 1))
