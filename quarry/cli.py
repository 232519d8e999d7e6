"""Command line: run a config-driven job or a quality report.

    python -m quarry.cli spark-etl --config configs/spark_etl.json [--input P] [--output P]
    python -m quarry.cli file-etl  --config configs/file_etl.json [--input P ...]
    python -m quarry.cli api       --config configs/api_job.json --pages DIR
    python -m quarry.cli quality   --input P [--approx]

The session comes from ``spark-submit`` (master, resources); config
``spark_conf`` is merged over the recommended defaults and never replaces
them.  ``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session(config: dict, master: str | None) -> SparkSession:
    from .plans.spark_etl import recommended_conf
    b = SparkSession.builder.appName("quarry")
    if master:
        b = b.master(master)
    for k, v in recommended_conf(config).items():
        b = b.config(k, v)
    return b.getOrCreate()


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="quarry")
    ap.add_argument("command", choices=["spark-etl", "file-etl", "api", "quality"])
    ap.add_argument("--config", default=None)
    ap.add_argument("--input", nargs="*", default=None)
    ap.add_argument("--output", default=None)
    ap.add_argument("--pages", default=None, help="folder of page-<n>.json files (api)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--approx", action="store_true", help="approximate quantiles (quality)")
    a = ap.parse_args(argv)
    config = {}
    if a.config:
        with open(a.config) as f:
            config = json.load(f)
    spark = _session(config, a.master)
    if a.command == "spark-etl":
        from .plans.spark_etl import SparkETLJob
        rep = SparkETLJob(spark, config).run(a.input[0] if a.input else None, a.output)
    elif a.command == "file-etl":
        from .plans.file_etl import FileETLJob
        rep = FileETLJob(spark, config).run(a.input or None)
    elif a.command == "api":
        from .plans.api_etl import APIJob
        from .sources.paged import file_pages
        if a.output:
            config["output"] = a.output
        rep = APIJob(spark, config).run(fetch=file_pages(a.pages) if a.pages else None,
                                        path=a.input[0] if a.input else None)
    else:
        from .operators.quality import run_report
        from .sources.readers import read_table
        rep = run_report(read_table(spark, a.input[0]), method="approx" if a.approx else "exact")
    print(json.dumps(rep, default=str, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
