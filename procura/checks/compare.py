"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import os
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

SPARK2DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "StringType": "VARCHAR", "DateType": "DATE",
              "BooleanType": "BOOLEAN", "DoubleType": "DOUBLE", "TimestampNTZType": "TIMESTAMP",
              "ShortType": "SMALLINT", "ByteType": "TINYINT", "FloatType": "FLOAT"}


def norm(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral() else str(v.normalize())
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict(recursive=True))
    return v


def spark_type(t) -> str:
    n = type(t).__name__
    if n == "DecimalType":
        return f"DECIMAL({t.precision},{t.scale})"
    return SPARK2DUCK.get(n, n)


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(sdf, con, sql: str) -> dict:
    """Row count, column names, column types and multiset of values."""
    srows, scols = sdf.collect(), sdf.columns
    stypes = dict(zip(scols, [spark_type(f.dataType) for f in sdf.schema.fields]))
    rel = con.sql(sql)
    drows, dcols = rel.fetchall(), rel.columns
    dtypes = dict(zip(dcols, [str(x) for x in rel.types]))
    same_cols = sorted(scols) == sorted(dcols)
    order = sorted(scols)
    sc = Counter(tuple(norm(r[scols.index(c)]) for c in order) for r in srows)
    dc = Counter(tuple(norm(r[dcols.index(c)]) for c in order) for r in drows) if same_cols else Counter()
    return {
        "rows": (len(srows), len(drows)),
        "columns_equal": same_cols,
        "type_diff": {c: (stypes.get(c), dtypes.get(c)) for c in set(scols) | set(dcols)
                      if stypes.get(c) != dtypes.get(c)},
        "values_equal": same_cols and sc == dc,
        "only_spark": list((sc - dc).elements())[:3],
        "only_duck": list((dc - sc).elements())[:3],
    }
