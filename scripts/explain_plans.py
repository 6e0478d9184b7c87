"""Write PLANS.md: the physical plans of the production path.

Builds a lake at one scale factor (landing -> bronze -> silver), then
explains what a production run executes: the silver builds as written
(with the rebalance before the partitioned write), the gold fact read from
stored silver, and the profiles.  For each plan the operator tree and the
scan details (pushed filters, read schema, partition filters) are kept.

usage: python scripts/explain_plans.py [sf_dir] [out_file]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from transitlake.operators import duplicate_profile, null_profile  # noqa: E402
from transitlake.plans import daily, layers, pings, routes, trips  # noqa: E402
from transitlake.session import local_session  # noqa: E402
from transitlake.sources import adapters  # noqa: E402
from transitlake.sources.lake import Lake  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = []
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and ("Scan" in block.splitlines()[0] or "Exchange" in block.splitlines()[0]):
            lines = [ln for ln in block.splitlines() if not ln.startswith("Location")]
            keep.append("\n".join(lines))
    return tree.strip() + "\n\n" + "\n\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = local_session(shuffle_partitions=16)
    lake = Lake.on_shared_storage(spark)
    landing = layers.land(
        spark, lake, adapters.gps_raw(spark, sf_dir), adapters.routes_raw(spark, sf_dir), adapters.trips_raw(spark, sf_dir)
    )
    layers.run_bronze(spark, lake, landing)
    layers.run_silver(spark, lake)

    bronze = {t: lake.read(spark, "bronze", t) for t in ("gps", "mco", "linhas")}
    silver = {t: lake.read(spark, "silver", t) for t in ("gps", "mco", "linhas")}
    sections = [
        (
            "Silver pings as written (bronze -> parse -> dedup -> rebalance by day)",
            pings.silver_pings(bronze["gps"]).hint("rebalance", "data_particao"),
            "One hash exchange on the dedup key, with a partial `min(struct)` aggregate before it "
            "(map-side combine of repeated keys), then the rebalance exchange on the partition column "
            "that sizes the write tasks.",
        ),
        (
            "Silver trips as written (bronze -> typed -> rebalance by month)",
            trips.silver_trips(bronze["mco"]).hint("rebalance", "ano", "mes"),
            "Narrow: every step is one projection over the scan; the only exchange is the write rebalance.",
        ),
        (
            "Silver routes",
            routes.silver_routes(bronze["linhas"]),
            "One exchange for the key dedup (partial aggregate first).",
        ),
        (
            "Gold fact from stored silver",
            daily.daily_performance(silver["gps"], silver["linhas"], silver["mco"]),
            "Trips: duration filter pushed into the Parquet scan, 5 columns read, partial+final aggregate by "
            "(day, line, consortium), then the size-checked broadcast of the route lookup. Pings: range "
            "filters pushed, 3 columns read, dynamic partition pruning on `data_particao`, partial+final "
            "aggregate. Final left join of two aggregates (AQE decides the strategy at run time).",
        ),
        (
            "Incremental silver merge: the touched days read back",
            silver["gps"].filter(F.col("data_particao").isin(["2024-01-03", "2024-01-04"])),
            "What `plans.live` reads of the base for the days that later batches touch: their day "
            "values become a partition filter, so only those day directories are listed and read.",
        ),
        (
            "Null profile of silver trips",
            null_profile(silver["mco"]),
            "One scan, one global aggregate of conditional counts (one partial row per task).",
        ),
        (
            "Duplicate profile of silver pings",
            duplicate_profile(silver["gps"]),
            "One grouped count over all columns with map-side combine, then a global sum.",
        ),
    ]
    parts = [
        "# PLANS — physical plans of the production path\n",
        f"Generated by `scripts/explain_plans.py` on `{os.path.basename(sf_dir)}` with `local[*]`, shuffle "
        "partitions 16, AQE on (the plans shown are the initial adaptive plans; AQE may still coalesce "
        "partitions or switch join strategy at run time). Scan locations are omitted.\n",
    ]
    for title, df, note in sections:
        parts.append(f"## {title}\n\n{note}\n\n```\n{formatted(df)}\n```\n")
    text = "\n".join(parts)
    text = re.sub(r"#\d+L?", "", text)  # expression ids change between runs
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    with open(out, "w") as f:
        f.write(text)
    print(out)


if __name__ == "__main__":
    main()
