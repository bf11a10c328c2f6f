"""python -m loomgraph.cli --config FILE (--all | --stage A,B) [--skip C] [--out FOLDER] [--log FOLDER]

The settings name the extractor, or a dictionary of names to extract by rule.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from loomgraph.plans.pipeline import Build
from loomgraph.shipping import ship
from loomgraph.sources.config import load_settings
from loomgraph.sources.tables import write_log


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loomgraph")
    parser.add_argument("--config", required=True)
    parser.add_argument("--all", action="store_true")
    parser.add_argument("--stage", default="")
    parser.add_argument("--skip", default="")
    parser.add_argument("--out")
    parser.add_argument("--log")
    args = parser.parse_args(argv)
    if not args.all and not args.stage:
        parser.error("--all or --stage is needed")
    names = lambda s: [x.strip() for x in s.split(",") if x.strip()]
    spark = ship(SparkSession.builder.getOrCreate())
    build = Build.from_settings(spark, load_settings(args.config))
    summary = build.run(names(args.stage) or None, names(args.skip))
    if args.out:
        build.graph.save(args.out)
        if build.postings is not None:
            build.postings.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/path_postings")
    if args.log:
        write_log(build.events_frame(), args.log, {"run_id": build.run_id, "config": args.config}, summary)
    print(json.dumps(summary, sort_keys=True))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
