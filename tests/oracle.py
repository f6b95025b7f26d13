"""Compares a query with DuckDB on the driver's tables."""

from pathlib import Path

import duckdb


def plain(v):
    if v is None or v != v:
        return None
    v = v.item() if hasattr(v, "item") else v
    return int(v) if isinstance(v, float) and v == int(v) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def same(spark, query, sql, sf_dir="/root/testdata/sf0.001"):
    db = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        db.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    found, wanted = query(spark, sf_dir), db.sql(sql)
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == rows_of(wanted.columns, wanted.fetchall())
