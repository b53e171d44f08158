"""Order-free comparison of a Spark result with a DuckDB oracle."""

import datetime
import decimal
import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def norm(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, decimal.Decimal):
        return repr(float(x))
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, list | tuple):
        return "[" + ",".join(map(norm, x)) + "]"
    return repr(x)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted([norm(r[n]) for n in names] for r in df.collect())


def duck_rows(c, sql):
    r = c.execute(sql)
    found = [d[0] for d in r.description]
    at = [found.index(n) for n in sorted(found)]
    return sorted(found), sorted([norm(r[i]) for i in at] for r in r.fetchall())
