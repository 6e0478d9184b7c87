"""Run every catalogued query in Spark and its DuckDB oracle; report matches.

usage: python scripts/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle.compare import compare, duck  # noqa: E402
from oracle.duckdb_sql import SQL  # noqa: E402
from transitlake.catalog import QUERIES  # noqa: E402
from transitlake.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    # Optional session settings to check that results do not depend on them.
    if os.environ.get("CHECK_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["CHECK_TZ"])
    if os.environ.get("CHECK_ANSI"):
        spark.conf.set("spark.sql.ansi.enabled", os.environ["CHECK_ANSI"])
    con = duck(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name not in SQL:
                print(f"{name:28s} NO-ORACLE rows={df.count()}")
                continue
            ok, msg = compare(df, con, SQL[name])
        except Exception as e:  # report and continue
            ok, msg = False, f"{type(e).__name__}: {e}"[:2000]
            traceback.print_exc()
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {time.time() - t0:6.1f}s {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
