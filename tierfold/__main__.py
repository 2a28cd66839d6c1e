"""Run one job: ``python -m tierfold ACTION [COLLECTION ...]``.

Settings come from ``spark.tierfold.*`` (see ``LakeConfig.from_session``), which
spark-submit takes from ``--conf`` or ``--properties-file``.
"""

from __future__ import annotations

import argparse
from datetime import date

from tierfold.config import LakeConfig
from tierfold.plans.jobs import ACTIONS, Options, preview
from tierfold.session import build_session
from tierfold.sinks.marts import mart_from_config


def main(argv: list[str] | None = None) -> object:
    parser = argparse.ArgumentParser(prog="tierfold")
    parser.add_argument("action", choices=sorted(ACTIONS))
    parser.add_argument("collections", nargs="*")
    parser.add_argument("--since", type=date.fromisoformat, help="first partition date to clean")
    parser.add_argument("--latest", action="store_true", help="clean the newest row of a document")
    parser.add_argument(
        "--incremental", action="store_true", help="clean the ingests not cleaned yet"
    )
    parser.add_argument("--json", metavar="PATH", help="write documents as JSON to this folder")
    parser.add_argument(
        "--objects", nargs="+", default=(), metavar="URI", help="read Parquet documents there"
    )
    parser.add_argument("--delete", action="store_true", help="delete the files of the report")
    parser.add_argument("--show", action="store_true", help="print a resulting report")
    args = parser.parse_args(argv)
    wanted, job = ACTIONS[args.action]
    if len(args.collections) < wanted:
        parser.error(f"{args.action} takes {wanted} collection name(s)")
    spark = build_session()
    config = LakeConfig.from_session(spark)
    options = Options(
        args.since, args.latest, args.incremental, args.json, tuple(args.objects), args.delete
    )
    result = job(
        spark, config, lambda: mart_from_config(config), options, *args.collections[:wanted]
    )
    if args.show and hasattr(result, "printSchema"):
        preview(result)
    return result


if __name__ == "__main__":
    print(main())
