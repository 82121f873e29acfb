"""CLI: compare every (or the named) catalogued query with its oracle.

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle_harness import compare, duck_connection  # noqa: E402
from starkit.session import get_session  # noqa: E402


def main(argv):
    plain = "--plain" in argv
    argv = [a for a in argv if a != "--plain"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    if plain:  # the way an external driver builds its session: no starkit settings
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
        smoke = entry.entry(spark)
        print("entry rows", smoke.count(), smoke.columns, flush=True)
    else:
        spark = get_session("local[8]")
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        if name not in oracle:
            n = df.count()
            print(f"{name:34s} rows-only {n:8d} {time.time() - t0:6.1f}s", flush=True)
            continue
        try:
            r = compare(spark, name, df, oracle[name], con)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:34s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        status = "OK " if r["ok"] else "BAD"
        bad += 0 if r["ok"] else 1
        print(f"{name:34s} {status} {r['spark_rows']:8d} {r['oracle_rows']:8d} "
              f"{time.time() - t0:6.1f}s", flush=True)
        if not r["ok"]:
            print("    ", {k: v for k, v in r.items() if k not in ("name", "ok")}, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
