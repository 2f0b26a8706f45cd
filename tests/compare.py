"""Side-by-side run of a Spark query and its SQL."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "boolean": "BOOLEAN"}


def differences(con, frame, sql):
    """What differs between the results; empty when they are equal."""
    result = con.execute(sql)
    theirs = [(d[0], str(d[1])) for d in result.description]
    expected = rows_of([n for n, _ in theirs], result.fetchall())
    found = rows_of(frame.columns, frame.collect())
    problems = []
    ours = sorted((n, TYPES.get(k, k)) for n, k in frame.dtypes)
    if ours != sorted(theirs):
        problems.append(f"schema {ours} vs {sorted(theirs)}")
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows vs {len(expected)}")
    if found != expected:
        mine, other = set(found), set(expected)
        problems.append(f"only Spark {sorted(mine - other, key=repr)[:3]} only SQL {sorted(other - mine, key=repr)[:3]}")
    return problems
