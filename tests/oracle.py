"""Run registered queries next to their SQL: ``python -m tests.oracle sf0.01 [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _frame(pdf: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, comparable types, rows in order."""
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        kind = pdf[c].dtype
        if pd.api.types.is_bool_dtype(kind) or (kind == object and pdf[c].dropna().map(type).eq(bool).all() and len(pdf[c].dropna())):
            pdf[c] = pdf[c].map(lambda v: None if pd.isna(v) else str(bool(v)))
        elif pd.api.types.is_numeric_dtype(kind):
            pdf[c] = pdf[c].astype("float64")
        elif pd.api.types.is_datetime64_any_dtype(kind):
            pdf[c] = pdf[c].astype("datetime64[us]").astype("int64").where(pdf[c].notna(), -1)
        else:
            pdf[c] = pdf[c].map(lambda v: "~" if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else str(v))
    return pdf.sort_values(list(pdf.columns), na_position="last", ignore_index=True)


def compare(df, con, text) -> str | None:
    """None when equal, otherwise what differs first."""
    left = _frame(df.toPandas())
    right = _frame(con.execute(text).df())
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} != {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    differ = ~((left == right) | (left.isna() & right.isna()))
    bad = differ.any(axis=1)
    if bad.any():
        i = bad.idxmax()
        shown = [c for c in left.columns if differ.loc[i, c]][:4]
        return f"{int(bad.sum())} of {len(left)} rows differ, e.g. " + "; ".join(f"{c}: {left.loc[i, c]!r} != {right.loc[i, c]!r}" for c in shown)
    return None


def main() -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    wanted = sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not wanted or any(w == n or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    failed = 0
    for name in names:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = None if (n := len(df.collect())) else "no rows"
        except Exception:
            problem = traceback.format_exc(limit=-2)[-1500:]
        failed += problem is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - started:6.2f}s {name}" + (f": {problem}" if problem else ""), flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
