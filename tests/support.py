import datetime
import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return "[" + ",".join(map(shown, v)) + "]" if isinstance(v, list) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(shown(r[i]) for i in order) for r in rows)


def oracle(sql, sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return sorted(names), rows_of(names, got.fetchall())


def same(df, sql, sf_dir):
    names, want = oracle(sql, sf_dir)
    assert sorted(df.columns) == names
    assert rows_of(df.columns, df.collect()) == want
