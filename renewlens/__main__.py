"""Command line: run one batch job.

  python -m renewlens period   --sf-dir DIR --out PATH
  python -m renewlens calendar --start-year 2020 --end-year 2030 --out PATH
  python -m renewlens location --sf-dir DIR --out PATH [--run-ts YYYYMMDD_HHMMSS]
  python -m renewlens profile  --sf-dir DIR --out PATH [--location PATH] [--as-of YYYY-MM-DD]

Marts are written as versioned snapshots (``run_ts=...``); the newest version is read back
and its row count printed.  ``--master`` is only for local runs (spark-submit sets it).
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from renewlens import config


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="renewlens")
    p.add_argument("job", choices=["period", "calendar", "location", "profile"])
    p.add_argument("--sf-dir")
    p.add_argument("--out", required=True)
    p.add_argument("--start-year", type=int)
    p.add_argument("--end-year", type=int)
    p.add_argument("--run-ts", default=datetime.now().strftime("%Y%m%d_%H%M%S"))
    p.add_argument("--location")
    p.add_argument("--as-of", type=date.fromisoformat, default=config.PERIOD_AS_OF)
    p.add_argument("--master")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from renewlens.plans import jobs
    from renewlens.plans.catalog import tables_for
    from renewlens.session import checkpoint_dir, local_session

    spark = local_session(cpus=args.master) if args.master else SparkSession.builder.getOrCreate()
    checkpoint_dir(spark)
    cfg = config.DRIVER_CONFIG
    if args.job == "calendar":
        out = jobs.run_calendar_job(spark, args.start_year, args.end_year, cfg, args.out)
    else:
        if not args.sf_dir:
            p.error("--sf-dir is required for this job")
        a = tables_for(spark, args.sf_dir).adapters
        if args.job == "period":
            out = jobs.run_period_job(a, cfg, args.out)
        elif args.job == "location":
            out = jobs.run_location_job(a, cfg, args.out, args.run_ts)
        else:
            out = jobs.run_profile_job(a, cfg, args.as_of, args.location, args.out)
    print(f"{args.job}: {out.count()} rows in the newest version at {args.out}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
