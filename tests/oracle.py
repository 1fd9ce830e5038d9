"""Runs registered SQL in DuckDB over the same tables."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(map(repr, (r[i] for i in order))) for r in found.fetchall())


def agree(df, sql, sf):
    cols = sorted(df.columns)
    names, expected = rows_of(sql, sf)
    assert cols == names
    assert sorted(tuple(map(repr, r)) for r in df.select(cols).collect()) == expected
