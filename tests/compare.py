"""Run a registered query and its SQL oracle on the same Parquet tables and compare whole results."""
from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_frame(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).df()


def _text(v) -> str:
    if v is None or v is pd.NaT or v is pd.NA:
        return "~"
    if isinstance(v, float):
        if v != v:
            return "~"
        return repr(0.0 if v == 0 else v)
    if hasattr(v, "item"):
        return _text(v.item())
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return repr(float(v))
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return "[" + ",".join(_text(x) for x in v) + "]"
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    return str(v)


def rows(pdf: pd.DataFrame) -> list[tuple[str, ...]]:
    cols = sorted(pdf.columns)
    data = [pdf[c].astype(object).tolist() for c in cols]
    return sorted(tuple(_text(v) for v in r) for r in zip(*data))


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if a == b:
        return None
    sa, sb = set(a), set(b)
    return (f"rows {len(a)} vs {len(b)}; {sorted(got.columns)}; "
            f"only here {sorted(sa - sb)[:3]}; only oracle {sorted(sb - sa)[:3]}")


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]").appName("netkpi-check")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    picked = sys.argv[1:]
    if picked and picked[0].startswith("/"):
        sf, picked = picked[0], picked[1:]
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not picked or any(p in n for p in picked)]
    bad = 0
    for n in names:
        t = time.time()
        try:
            got = queries[n](spark, sf).toPandas()
            took = time.time() - t
            if n in oracles:
                diff = differences(got, oracle_frame(oracles[n], sf))
            else:
                diff = None
            print(f"{'ok ' if diff is None else 'BAD'} {n} rows={len(got)} {took:.2f}s "
                  f"{'' if n in oracles else '(no oracle)'} {diff or ''}", flush=True)
            bad += diff is not None
        except Exception as e:  # report and go on with the next query
            print(f"ERR {n} {type(e).__name__}: {str(e)[:900]}", flush=True)
            bad += 1
    print(f"{len(names)} queries, {bad} bad")
