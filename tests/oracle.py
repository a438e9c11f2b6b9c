"""Compares a query with its SQL on the same Parquet tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return names, cur.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def assert_same(df, sql: str, sf_dir: str):
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    want = normal(*oracle_rows(sql, sf_dir))
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]), (len(got[1]), len(want[1]))
    wrong = [(g, w) for g, w in zip(got[1], want[1], strict=True) if g != w]
    assert not wrong, (len(wrong), wrong[:3])
