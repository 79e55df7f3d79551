"""Rows of two engines as comparable values."""

import math


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


def spark_rows(frame):
    return rows(frame.columns, [tuple(r) for r in frame.collect()])


def duckdb_rows(sql, sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in ("events",):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), rows(names, cursor.fetchall())
