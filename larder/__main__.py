"""Command line: run the whole pipeline on a raw Parquet dump, or land one.

    spark-submit --py-files larder.zip -m larder run --raw s3a://raw/food/food_20240610.parquet \
        --out s3a://gold/ --variant a --audit s3a://raw/pipeline_logs/
    python -m larder land --source /data/food.parquet --base s3a://raw/

Session settings (master, memory, spark.checkpoint.dir, ...) come from spark-submit.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    from larder.config import VARIANTS
    from larder.plans.warehouse import run_pipeline
    from larder.session import get_session, remove_work
    from larder.sources.io import RAW_CONTRACT, land_checked, read_raw, verify_landing

    ap = argparse.ArgumentParser(prog="larder")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="staging -> dimensions -> fact -> KPIs -> checks -> audit")
    run.add_argument("--raw", required=True, help="raw Parquet dump")
    run.add_argument("--out", required=True, help="folder for the gold tables")
    run.add_argument("--variant", default="default", choices=sorted(VARIANTS))
    run.add_argument("--audit", default=None, help="audit table folder (appended)")
    run.add_argument("--silver", default=None, help="also write the six staging tables to this folder")
    run.add_argument("--contract", default=None, help="JSON file {column: type} the raw files must keep; default: the columns a run needs")
    run.add_argument("--buckets", type=int, default=None, help="keep the fact and the product dimension as catalog tables in so many buckets by product")
    run.add_argument("--no-contract", action="store_true", help="do not check the raw files")
    land = sub.add_parser("land", help="copy a raw dump to food/food_YYYYMMDD.parquet and check it")
    land.add_argument("--source", required=True)
    land.add_argument("--base", required=True)
    land.add_argument("--fixed-name", action="store_true", help="write food.parquet instead of a dated key")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    own = SparkSession.getActiveSession() is None
    spark = get_session("larder")
    if args.cmd == "run":
        contract = RAW_CONTRACT
        if args.contract:
            with open(args.contract) as f:
                contract = json.load(f)
        res = run_pipeline(read_raw(spark, args.raw), VARIANTS[args.variant], out=args.out, audit_path=args.audit, source_file=args.raw,
                           silver=args.silver, raw_path=args.raw, contract=None if args.no_contract else contract,
                           buckets=args.buckets)
        failed = res["quality_report"].filter("NOT passed").count()
        if own:
            remove_work(spark)  # everything that stays is written
        print(json.dumps({"out": args.out, "variant": args.variant, "failed_checks": failed}))
    else:
        path, landed = land_checked(read_raw(spark, args.source, schema=None), args.base, dated=not args.fixed_name)
        ok, n = verify_landing(spark, path, landed)
        print(json.dumps({"path": path, "rows": landed.rows, "digest": landed.digest, "verified": ok}))
        if not ok:
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
