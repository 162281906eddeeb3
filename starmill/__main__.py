"""Run one job: ``python -m starmill star --source parquet:/ods --target parquet:/star``.

A place is ``csv:FOLDER``, ``parquet:FOLDER``, ``postgres://USER@HOST:PORT/DATABASE`` or
``clickhouse://USER@HOST:PORT/DATABASE``; passwords come from the environment.
"""

from __future__ import annotations

import argparse
import os
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

from starmill.plans.jobs import load_marts, load_staging, load_star, preview
from starmill.sources.csv_files import CsvFolder
from starmill.sources.jdbc import clickhouse, postgres
from starmill.sources.zone import ParquetZone

_FOLDERS = {"csv": CsvFolder, "parquet": ParquetZone}
_DATABASES = {"postgres": (postgres, 5432), "clickhouse": (clickhouse, 8123)}


def place(text: str):
    kind, _, rest = text.partition(":")
    if kind in _FOLDERS and rest:
        return _FOLDERS[kind](rest)
    if kind in _DATABASES:
        connect, port = _DATABASES[kind]
        url = urlsplit(text)
        password = os.environ.get(f"{kind.upper()}_PASSWORD", "")
        return connect(
            url.hostname, url.port or port, url.path.lstrip("/"), url.username or "", password
        )
    raise argparse.ArgumentTypeError(f"not a place: {text}")


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starmill", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for job in ("staging", "star", "marts"):
        command = jobs.add_parser(job)
        command.add_argument("--source", type=place, required=True)
        command.add_argument("--target", type=place, required=True)
        modes = ("overwrite", *(("appendable",) if job == "star" else ()), "append")
        command.add_argument("--mode", choices=modes, default="overwrite")
        if job == "star":
            command.add_argument("--strict-grain", action="store_true")
    command = jobs.add_parser("preview")
    command.add_argument("--source", type=place, required=True)
    command.add_argument("--table", required=True)
    command.add_argument("--rows", type=int, default=5)
    return parser.parse_args(arguments)


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, int] | None:
    if args.job == "preview":
        preview(args.source.read(spark, args.table), args.rows).show(args.rows, truncate=False)
        return None
    if args.job == "star":
        return load_star(spark, args.source, args.target, args.mode, args.strict_grain)
    load = load_staging if args.job == "staging" else load_marts
    return load(spark, args.source, args.target, args.mode)


def main() -> None:
    args = parse()
    spark = SparkSession.builder.appName(f"starmill {args.job}").getOrCreate()
    for table, rows in (run(spark, args) or {}).items():
        print(f"{table}: {rows} rows")
    spark.stop()


if __name__ == "__main__":
    main()
