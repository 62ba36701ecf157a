"""python -m tidemark [-v] [--log-file FILE] [--path LOGS] CONFIG.json: run a capture."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark.plans.capture import run
from tidemark.spec import CaptureSpec


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("config")
    parser.add_argument("-v", action="store_true", help="log at debug level, whatever the file says")
    parser.add_argument("--log-file", help="log to this file, whatever the file says")
    parser.add_argument("--path", help="read log files here instead of the server's stream")
    given = parser.parse_args(arguments)
    spec = CaptureSpec.load(given.config, log_level="debug" if given.v else None, log_file=given.log_file)
    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run(spark, given.path, spec)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
