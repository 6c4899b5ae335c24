"""Compare a Spark DataFrame with a DuckDB query on the driver tables."""

import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "item"):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(out, key=lambda t: tuple((0, "") if x is None else (1, str(x)) for x in t))


def close(a, b, tol=1e-6):
    if a == b:
        return True
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return abs(a - b) <= tol * max(1.0, abs(a), abs(b))
    return False


def assert_same(spark_df, sql, con, tol=1e-6):
    sc, sr = rows(spark_df.toPandas())
    dc, dr = rows(con.execute(sql).df())
    assert sc == dc, (sc, dc)
    assert len(sr) == len(dr), (len(sr), len(dr))
    for a, b in zip(sr, dr):
        assert all(close(x, y, tol) for x, y in zip(a, b)), list(zip(sc, a, b))
