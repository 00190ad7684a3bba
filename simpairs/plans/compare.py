"""Side-by-side check of a registered query against its DuckDB oracle (dev/test tool)."""
from __future__ import annotations

import datetime
import decimal
import hashlib

from simpairs.sources.tables import TABLES


def oracle_frame(sql: str, sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    rel = con.sql(sql)
    return list(rel.columns), rel.fetchall()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if f != f:
            return "NaN"
        return repr(round(f, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, name: str, sf_dir: str, show: int = 3) -> dict:
    from simpairs.plans.queries import ORACLE, QUERIES
    df = QUERIES[name](spark, sf_dir)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    out = {"name": name, "spark_rows": len(s_rows), "cols": s_cols}
    if name not in ORACLE:
        out["oracle"] = None
        return out
    o_cols, o_rows = oracle_frame(ORACLE[name], sf_dir)
    sd, sl = digest(s_cols, s_rows)
    od, ol = digest(o_cols, o_rows)
    out.update(oracle_rows=len(o_rows), cols_match=sorted(s_cols) == sorted(o_cols), match=sd == od)
    if not out["match"]:
        a, b = set(sl), set(ol)
        out["only_spark"] = sorted(a - b)[:show]
        out["only_oracle"] = sorted(b - a)[:show]
        out["oracle_cols"] = o_cols
    return out
