"""spark-submit or ``python -m logstats``: the job with its arguments by name."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from logstats.plans import run_report
from logstats.settings import CONFIG, MODES, SOFTWARE_REV


def arguments(given: Sequence[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="logstats", description=__doc__)
    for name in ("log", "level-weights", "code-actions", "report"):
        parser.add_argument(f"--{name}-path", required=True)
    for name in ("system-list-path", "metrics-path", "start-date", "end-date"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--stamp", default="", help="put after the paths of what is written")
    parser.add_argument("--files", type=int, default=1, help="files of the report, 0: as they come")
    parser.add_argument("--mode", choices=MODES, default=MODES[0])
    parser.add_argument("--all-columns", action=argparse.BooleanOptionalAction)
    parser.add_argument("--config", default=CONFIG)
    parser.add_argument("--software-rev", default=SOFTWARE_REV)
    found = vars(parser.parse_args(given))
    return {**found, "files": found["files"] or None}


def main(given: Sequence[str] | None = None) -> None:
    spark = SparkSession.builder.appName("logstats").getOrCreate()
    run_report(spark, **arguments(given)).show(truncate=False)


if __name__ == "__main__":
    main()
