"""Command line: run the lake's layers (for ``spark-submit``).

    spark-submit --py-files transitlake.zip -m transitlake \\
        --lake s3://bucket/lake --gps s3://.../gps/ --routes s3://.../linhas.csv \\
        --trips s3://.../mco/ [--layers bronze,silver,gold] [--policy fail]

The session comes from the launcher (master, memory and cluster settings
are the submitter's choice).  Prints one JSON line per layer with the row
counts observed while writing.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession

from transitlake.plans import layers
from transitlake.plans.daily import GPS_MATCHES
from transitlake.sources.lake import Lake


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="transitlake")
    ap.add_argument("--lake", required=True, help="lake root on shared storage")
    ap.add_argument("--format", default="parquet", help="silver/gold table format")
    ap.add_argument("--gps", help="GPS dump text files (bronze input)")
    ap.add_argument("--routes", help="route catalogue CSV, ',' separated")
    ap.add_argument("--trips", help="trip-control CSV, ';' separated")
    ap.add_argument("--layers", default="bronze,silver,gold")
    ap.add_argument("--policy", default="fail", choices=["fail", "warn", "quarantine"])
    ap.add_argument("--profile", action=argparse.BooleanOptionalAction, default=True, help="log NULL/duplicate profiles per layer")
    ap.add_argument("--flag-labels", default="", help="further texts that mean true in trip flags, comma separated (e.g. S)")
    ap.add_argument("--strip-accents", action="store_true", help="drop accents from trip header names")
    ap.add_argument("--strip-quotes", action="store_true", help="drop double quotes around GPS dump lines")
    ap.add_argument("--gps-match", default="public_code", choices=sorted(GPS_MATCHES), help="trip key that GPS line codes match")
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("transitlake").getOrCreate()
    lake = Lake(args.lake, args.format)
    landing = None
    if args.gps and args.routes and args.trips:
        landing = layers.LandingFiles(pings=args.gps, routes=args.routes, trips=args.trips)
    silver_options = {
        "gps": {"strip_quotes": args.strip_quotes},
        "mco": {"flag_labels": [x for x in args.flag_labels.split(",") if x], "strip_accents": args.strip_accents},
    }
    for layer in [x.strip() for x in args.layers.split(",") if x.strip()]:
        counts = layers.run_layer(
            spark, lake, layer, landing, args.policy, args.profile,
            silver_options=silver_options, gold_options={"gps_match": args.gps_match},
        )
        print(json.dumps({"layer": layer, "rows": counts}))


if __name__ == "__main__":
    main()
