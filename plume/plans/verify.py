"""Result comparison used by the oracle harness and the tests: columns sorted
by name, floats rounded, rows compared as a sorted multiset."""

from __future__ import annotations

import datetime as dt
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    import numpy as np

    if v is None:
        return None
    if isinstance(v, bool | np.bool_):
        return bool(v)
    if isinstance(v, float | np.floating):
        return None if math.isnan(v) else round(float(v), 6)
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(cols), sorted(out, key=repr)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(df, con, sql: str):
    """(ok, detail) for a Spark DataFrame against DuckDB SQL."""
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    sc, sv = canonical(df.columns, srows)
    dc, dv = canonical(dcols, res.fetchall())
    if sc != dc:
        return False, f"columns spark={sc} duck={dc}"
    if sv != dv:
        ds, dd = set(dv), set(sv)
        return False, (f"rows spark={len(sv)} duck={len(dv)}; spark-only={[r for r in sv if r not in ds][:3]}"
                       f" duck-only={[r for r in dv if r not in dd][:3]}")
    return True, f"{len(sv)} rows"
