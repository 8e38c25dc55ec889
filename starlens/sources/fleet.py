"""A fleet of model catalogs derived from the lake, so that catalog questions run at its scale.

Each catalog table is one SQL text that Spark and DuckDB read alike. A project is a block of 64 customer keys; flags come
from residues, so that every rule of the linter has rows to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .frames import lake, spread

_P, _T = "c_custkey - c_custkey % 64", "'T' || cast(c_custkey as string)"
_KEPT = "({0} % 64 < 24 or {0} % 128 >= 64)"
_K = "cast(o_orderkey as string)"
_PK = "cast(p_partkey as string)"
_OWNER = "case when o_orderkey % 4 = 0 then o_custkey - o_custkey % 64 + 1 else o_custkey end"

SHIMS = {
    "projects": f"select distinct {_P} as project_id, {_P} >= 0 and ({_P}) % 192 <> 0 as discourages from {{customer}}",
    "tables": f"""select {_P} as project_id, {_T} as table_name, c_custkey % 16 = 3 as is_group, c_custkey % 8 = 1 as is_hidden, case c_custkey % 5 when 0 then 'import' when 1 then 'directQuery' end as mode,
      case c_custkey % 7 when 0 then 'calculated' when 1 then 'entity' when 2 then 'unheard of' else 'm' end as source, case when c_custkey % 9 <> 0 then 't' || cast(c_custkey - c_custkey % 4 as string) end as tag,
      c_custkey as pos from {{customer}} where {_KEPT.format('c_custkey')}""",
    "refs": f"select {_P} as project_id, case when c_custkey % 21 = 0 then 'Gone' || cast(c_custkey as string) else {_T} end as ref, case c_custkey % 3 when 0 then 'table' when 1 then 'role' end as kind from {{customer}} where {_KEPT.format('c_custkey')} and c_custkey % 32 <> 3",
    "columns": f"""select o_custkey - o_custkey % 64 as project_id, 'T' || cast({_OWNER} as string) as table_name,
      case o_orderkey % 5 when 0 then 'Item' || {_K} || 'ID' when 1 then 'Unit Price ' || {_K} when 2 then ' C' || {_K} when 3 then 'Tax Rate' || {_K} else 'C' || {_K} end as column_name,
      case when o_orderkey % 97 = 0 then '' when o_orderkey % 4 = 1 then 'double' when o_orderkey % 4 = 2 then 'string' else 'int64' end as data_type, o_orderkey % 7 = 3 as is_calculated,
      case when o_orderkey % 7 = 3 then case when o_orderkey % 2 = 0 then 'SUM([Amount])' else '[Key] + 1' end end as expression, case o_orderkey % 3 when 0 then 'sum' else 'none' end as summarize_by,
      case o_orderkey % 8 when 2 then 'Name' when 3 then 'Ordinal' end as source_column, case o_orderkey % 6 when 1 then '#,0' when 2 then '0.00' when 3 then '$#,0' when 4 then '0.0%' end as format_string,
      case when o_orderkey % 15 = 4 then 'Key' end as sort_by, o_custkey % 6 = 2 or o_orderkey % 4 = 1 as is_hidden, case when o_orderkey % 13 <> 0 then 'c' || cast(o_orderkey - o_orderkey % 3 as string) end as tag,
      o_orderkey as pos from {{orders}} where {_KEPT.format('o_custkey')}
      union all select {_P}, {_T}, 'Key', 'int64', false, null, 'none', null, null, null, c_custkey % 6 = 2, 'k' || cast(c_custkey as string), -2 from {{customer}} where {_KEPT.format('c_custkey')} and c_custkey % 10 <> 7
      union all select {_P}, {_T}, 'Code', 'string', false, null, 'none', null, null, null, c_custkey % 6 = 2, 'd' || cast(c_custkey as string), -1 from {{customer}} where {_KEPT.format('c_custkey')} and c_custkey % 10 <> 7
      union all select {_P}, {_T}, 'Status', 'string', true, case when c_custkey % 20 in (5, 10) then 'IF([Key] > 1, "late", "ok")' else '"ok"' end, 'none', null, null, case when c_custkey % 20 <> 10 then 'Rank' end, false, 's' || cast(c_custkey as string), -4 from {{customer}} where {_KEPT.format('c_custkey')} and c_custkey % 5 = 0
      union all select {_P}, {_T}, 'Rank', 'int64', true, case c_custkey % 20 when 5 then 'SWITCH(' || {_T} || '[Status], "late", 1)' when 10 then '[M' || cast(c_custkey as string) || '] + 1' else '[Key] + 2' end, 'none', null, null, null, false, 'r' || cast(c_custkey as string), -3
        from {{customer}} where {_KEPT.format('c_custkey')} and c_custkey % 5 = 0
      union all select {_P}, {_T}, 'Due', 'int64', true, '[M' || cast(c_custkey as string) || '] + 3', 'none', null, null, null, false, 'u' || cast(c_custkey as string), -5 from {{customer}} where {_KEPT.format('c_custkey')} and c_custkey % 20 = 10 and c_custkey % 3 <> 0""",
    "relationships": f"""select o_custkey - o_custkey % 64 as project_id, 'R' || {_K} as name, case when o_orderkey % 30 = 0 then 'Tx' else 'T' || cast(o_custkey as string) end as from_table,
      case when o_orderkey % 18 = 0 then 'Nope' else 'Key' end as from_column, case when o_orderkey % 42 = 0 then 'Ty' else 'T' || cast(o_custkey - o_custkey % 64 + 1 as string) end as to_table,
      case when o_orderkey % 54 = 0 then 'Kez' when o_orderkey % 24 = 0 then 'Code' else 'Key' end as to_column, case when o_orderkey % 12 = 0 then 'many' end as from_card, case when o_orderkey % 36 = 0 then 'many' end as to_card,
      case when o_orderkey % 60 = 0 then 'bothDirections' end as cross_filter, case when o_orderkey % 48 = 0 then false end as is_active from {{orders}} where {_KEPT.format('o_custkey')} and o_orderkey % 6 = 0 and o_custkey % 5 <> 4""",
    "formulas": f"""select p_partkey - p_partkey % 64 as project_id, 'T' || cast(p_partkey - p_partkey % 64 + 1 + p_partkey % 5 as string) as table_name,
      case p_partkey % 11 when 0 then 'Margin pct ' || {_PK} when 1 then ' M' || {_PK} when 2 then 'M<' || {_PK} || '>' when 3 then 'Dup' || cast(p_partkey - p_partkey % 22 as string) else 'M' || {_PK} end as name,
      case when p_partkey % 4 = 0 then p_type end as display_folder, p_partkey % 9 = 0 as is_hidden, case p_partkey % 3 when 1 then '0.0%' when 2 then '#,0' end as format_string, case when p_partkey % 6 <> 0 then p_name end as description,
      case when p_partkey % 13 <> 0 then 'm' || {_PK} end as tag, case when p_partkey % 28 = 7 then 'ImageUrl' end as data_category,
      case p_partkey % 16 when 0 then '[M1] / [M2]' when 1 then 'IFERROR([M1], 0)' when 2 then 'CALCULATE(CALCULATE(CALCULATE([M1])))' when 3 then 'IF(HASONEVALUE(Cal[Year]), 1)' when 4 then 'CALCULATE(INTERSECT(A, B), FILTER(C, TRUE))'
      when 5 then 'CALCULATE([M' || cast(p_partkey - p_partkey % 64 + 10 as string) || '], VALUES(Cal[Year]))' when 6 then 'CALCULATE([M1], Cal[Year] = 2024)' when 7 then '"data:image/svg+xml;utf8,"' when 8 then 'CALCULATE([M1], USERELATIONSHIP(A[B], C[D]))' when 9 then ' ' when 10 then 'DIVIDE([M' || cast(p_partkey - p_partkey % 64 + (p_partkey + 16) % 64 as string) || '], 2) / 3'
      when 11 then '"a / b" & [M1]' when 13 then 'SUM(T' || cast(p_partkey - p_partkey % 64 + 1 as string) || '[Key])' when 14 then 'SUM(''T' || cast(p_partkey - p_partkey % 64 + 1 + p_partkey % 5 as string) || '''[Code]) + Fn.' || {_PK} || '(1)'
      when 15 then 'CALCULATE([M1], T' || cast(p_partkey - p_partkey % 32 + 3 as string) || '[Name] = "YoY") + [Key]' end as expression, p_partkey as pos from {{part}}""",
    "items": f"""select p_partkey - p_partkey % 64 as project_id, 'T' || cast(p_partkey - p_partkey % 32 + 3 as string) as table_name, case when p_partkey % 24 = 0 then '' else 'I' || {_PK} end as name, p_partkey % 8 as ordinal,
      case p_partkey % 24 when 1 then '' when 2 then 'CALCULATE(SELECTEDMEASURE(), Cal[Year] = 2021)' when 8 then 'SELECTEDMEASURE() / 2' else 'SELECTEDMEASURE()' end as expression from {{part}} where p_partkey % 8 < 3""",
    "roles": "select s_suppkey - s_suppkey % 64 as project_id, 'Role' || cast(s_suppkey as string) as role, case when s_suppkey % 3 = 0 then 'readRefresh' else 'read' end as permission from {supplier}",
    "role_filters": f"select {_P} as project_id, 'Role' || cast({_P} + c_custkey % 8 as string) as role, {_T} as table_name, case when c_custkey % 4 <> 1 then '[Key] = ' || cast(c_nationkey as string) end as filter, case when c_custkey % 3 = 0 then 'none' end as metadata from {{customer}}",
    "column_permissions": f"""select o_custkey - o_custkey % 64 as project_id, 'Role' || cast(o_custkey - o_custkey % 64 + o_orderkey % 8 as string) as role, 'T' || cast({_OWNER} as string) as table_name,
      case when o_orderkey % 3 = 0 then 'Key' when o_orderkey % 5 = 0 then 'Item' || {_K} || 'ID' else 'Gone' end as column_name, case when o_orderkey % 4 <> 1 then 'none' else 'read' end as metadata from {{orders}} where o_orderkey % 9 < 2""",
    "functions": f"""select p_partkey - p_partkey % 64 as project_id, 'Fn.' || {_PK} as name, case p_partkey % 3 when 0 then '' when 1 then 'a: DOUBLE' else 'a: DOUBLE, b: STRING' end as params, 'Pack' || cast(p_partkey % 4 as string) as package,
      case when p_partkey % 5 <> 0 then 'f' || {_PK} end as tag from {{part}} where p_partkey % 16 in (0, 3, 6, 14)""",
    "expressions": f"""select p_partkey - p_partkey % 64 as project_id, 'Expr' || {_PK} as name, 'let Source = Expr' || cast(p_partkey + 1 as string) || ', Expr' || cast(p_partkey + 2 as string) || ' = 1 in Expr' || cast(p_partkey + 2 as string) || ' + Expr' || cast(p_partkey - 1 as string) as body
      from {{part}} where p_partkey % 2 = 0 or p_partkey % 7 = 1""",
}

_LAKE = ("customer", "orders", "part", "supplier")


def fleet(spark: SparkSession, sf_dir: str, name: str, keys: dict[str, str] | None = None) -> DataFrame:
    """One catalog table of the fleet; lake tables that have one of `keys` are dealt by it."""
    text, keys = SHIMS[name], keys or {}
    return spark.sql(text, **{t: spread(lake(spark, sf_dir, t), keys[t]) if t in keys else lake(spark, sf_dir, t) for t in _LAKE if f"{{{t}}}" in text})


def dealt(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A catalog table whose texts are a lot of work: the keys it is made of are few bytes and are dealt to all cores first, since a file of one row group is one task."""
    return fleet(spark, sf_dir, name, {"orders": "o_orderkey", "part": "p_partkey"})


def fleet_sql(*names: str) -> str:
    """The same tables as DuckDB common table expressions."""
    return ", ".join(f"{n} as ({SHIMS[n].format(**{t: t for t in _LAKE})})" for n in names)
