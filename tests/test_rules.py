from pyspark.sql import functions as F

from starlens.operators import rules
from starlens.sources import fleet as sources

COLS = "project_id long, table_name string, column_name string, is_calculated boolean, expression string, sort_by string"
MEASURES = "project_id long, table_name string, name string, expression string"


def fleet(spark):
    cols = [
        (1, "T", "Plain", False, None, None), (1, "T", "A", True, "T[B] + [Plain]", None), (1, "T", "B", False, None, "A"), (1, "T", "Twice", False, None, None), (1, "T", "Twice", True, "'T'[Twice] + T[Twice]", None),
        (1, "T", "Sorted", False, None, "Plain"), (1, "U", "Hides", False, None, None), (1, "U", "C", True, "[M] + 1", None), (1, "U", "D", True, "U[C]", None), (None, "T", "A", True, "T[A]", None),
    ]
    measures = [(1, "T", "M", "U[D] + T[Plain]"), (1, "T", "X", "[Y]"), (1, "U", "Y", "T[X] + [Plain]"), (1, "U", "Hides", "[V]"), (1, "T", "V", "U[Hides]"), (1, "T", "Self", "[Self] + T[Self]"), (2, "T", "X", "[Y]")]
    return spark.createDataFrame(cols, COLS), spark.createDataFrame(measures, MEASURES)


def test_edges_lead_to_no_plain_column(spark):
    edges = {(r.src, r.dst) for r in rules.formula_edges(*fleet(spark)).filter("src is not null").collect()}
    node = lambda kind, table, name: f"1|{kind}|{table}|{name}"
    a, b, twice, c, d, table = node("column", "T", "A"), node("column", "T", "B"), node("column", "T", "Twice"), node("column", "U", "C"), node("column", "U", "D"), node("table", "U", "")
    m, x, y, hides, v = (node("measure", *n) for n in (("T", "M"), ("T", "X"), ("U", "Y"), ("U", "Hides"), ("T", "V")))
    assert edges == {(a, b), (b, a), (twice, twice), (c, m), (c, table), (table, c), (table, d), (d, c), (m, d), (x, y), (y, x), (hides, v)}


def test_cycles_of_columns_and_measures(spark):
    got = {(r.kind, r.table_name, r.name): r.component for r in rules.circular(*fleet(spark)).filter(F.col("project_id") == 1).collect()}
    ring = "1|column|U|C"
    assert got == {
        ("column", "T", "A"): "1|column|T|A", ("column", "T", "B"): "1|column|T|A", ("column", "T", "Twice"): "1|column|T|Twice", ("column", "U", "C"): ring, ("column", "U", "D"): ring, ("measure", "T", "M"): ring,
        ("measure", "T", "X"): "1|measure|T|X", ("measure", "U", "Y"): "1|measure|T|X"}


def test_rules_are_compiled_and_a_null_condition_does_not_hold(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", None), (2, "c", 5)], "project_id long, name string, x int")
    found = rules.flagged(df, F.col("name"), [("naming", "info", "odd", F.col("x") % 2 == 1), ("dax", "error", "large", F.col("x") > 4), ("error", "error", "not asked for", F.lit(True))], ("naming", "dax"))
    assert sorted(map(tuple, found[0].collect())) == [(1, "naming", "info", "odd", "a"), (2, "dax", "error", "large", "c"), (2, "naming", "info", "odd", "c")]
    assert "lambda" not in found[0]._jdf.queryExecution().optimizedPlan().toString()


def test_a_file_of_one_row_group_is_many_tasks(spark, sf_dir):
    for name in ("columns", "formulas", "items"):
        one, many = (f(spark, sf_dir, name) for f in (sources.fleet, sources.dealt))
        assert many.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism > one.rdd.getNumPartitions()
        assert many.exceptAll(one).isEmpty() and many.count() == one.count()


def test_findings_by_rule_are_compiled(spark, sf_dir):
    assert "lambda" not in rules.lint_by_rule(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_totals_count_what_the_findings_are(spark, sf_dir):
    by = ["project_id", "category", "severity", "rule"]
    rows, totals = rules.lint(spark, sf_dir).groupBy(*by).agg(F.count("*").alias("findings")), rules.lint(spark, sf_dir, totals=True).groupBy(*by).agg(F.sum("findings").alias("findings"))
    assert rows.count() > 100 and rows.exceptAll(totals).isEmpty() and totals.exceptAll(rows).isEmpty()
    worst = rules.lint(spark, sf_dir, totals=True, severities=("error",)).groupBy(*by).agg(F.sum("findings").alias("findings"))
    assert rows.filter("severity = 'error'").exceptAll(worst).isEmpty() and worst.exceptAll(rows).isEmpty()


def test_findings_are_counted_where_they_are(spark, sf_dir):
    df = spark.createDataFrame([(1, 1), (1, None), (2, 5), (None, 7)], "project_id long, x int")
    found = rules.counted(df, [("naming", "info", "odd", F.col("x") % 2 == 1), ("dax", "error", "large", F.col("x") > 4), ("dax", "warning", "never", F.lit(False))], ("naming", "dax"), ("error", "warning"))
    assert sorted(map(tuple, found[0].collect()), key=str) == [(2, "dax", "error", "large", 1), (None, "dax", "error", "large", 1)]
    plan = rules.lint_by_rule(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "dax_use_divide_function" in plan and "dax_hardcoded_year" not in plan  # no rule that isn't asked for


def test_ends_of_relationships(spark, monkeypatch):
    rels = spark.createDataFrame([(1, "a", "T", "Key", "U", "Key"), (1, "b", "T", "Gone", "V", "Key"), (1, "c", "T", "Code", "U", "Key"), (2, "d", "T", "Key", None, "Key")], "project_id long, name string, from_table string, from_column string, to_table string, to_column string")
    names = spark.createDataFrame([(1, "T"), (1, "U"), (2, "T")], "project_id long, table_name string")
    cols = spark.createDataFrame([(1, "T", "Key", "int64"), (1, "T", "Code", "string"), (1, "U", "Key", "int64"), (1, "U", "Other", "string"), (2, "T", "Key", "")], "project_id long, table_name string, column_name string, data_type string")
    for few in (10_000, 0):  # with names of columns broadcast and without
        monkeypatch.setattr(rules, "_FEW", few)
        got = {r.name: (r.from_t, r.from_c, r.from_type, r.to_t, r.to_c, r.to_type) for r in rules.relationship_ends(rels, names, cols).collect()}
        assert got == {"a": (True, True, "int64", True, True, "int64"), "b": (True, None, None, None, None, None), "c": (True, True, "string", True, True, "int64"), "d": (True, True, None, None, None, None)}


def test_first_holders_of_a_tag_are_found_without_sorting(spark):
    t = spark.createDataFrame([(1, "T", "a", 5), (1, "U", "a", 5), (1, "V", "a", 6), (2, "T", "a", 9)], "project_id long, table_name string, tag string, pos long")
    c = spark.createDataFrame([(1, "T", "C", "a", -1), (1, "T", "D", "b", 3), (1, "T", "E", "b", -3), (1, "T", "F", "", 1)], "project_id long, table_name string, column_name string, tag string, pos long")
    m = spark.createDataFrame([(1, "T", "M", "b", -9), (1, "T", "N", None, 1)], "project_id long, table_name string, name string, tag string, pos long")
    f = spark.createDataFrame([(1, "F", "f"), (1, "G", "f"), (1, "H", "b")], "project_id long, name string, tag string")
    found = rules.repeated_tags(t, c, m, f)
    assert sorted((r.project_id, r.entity, r.tag) for r in found.collect()) == [(1, "H", "b"), (1, "T.C", "a"), (1, "T.D", "b"), (1, "T.M", "b"), (1, "V", "a")]
    plan = rules.repeated_tags(t, c, m, f)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
