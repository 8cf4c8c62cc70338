"""The batch jobs: read raw tables, build a mart, write it.

* period job    -> membership-period mart (new snapshot version)
* calendar job  -> calendar dimension, upserted into the existing version
* location job  -> location metrics written as a timestamped snapshot
* profile job   -> member profile; reads the newest location snapshot (the hand-off
  between the two jobs is a written table, which also cuts the lineage)
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.config import DomainConfig
from renewlens.operators.calendar import calendar_dim
from renewlens.plans.periods import period_mart, rules_table
from renewlens.plans.profile import location_metrics, member_profile
from renewlens.sources import schemas
from renewlens.sources.sinks import stamp_audit, upsert
from renewlens.sources.snapshots import read_latest_snapshot, version, write_snapshot


def _now_ts(as_of: datetime | None):
    return F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()


def run_period_job(a, cfg: DomainConfig, out: str, stamped_at: datetime | None = None) -> DataFrame:
    """Write the mart as a new snapshot version: a failure mid-write never removes the
    previous complete version (readers take the newest)."""
    spark = a.t.spark
    mart = period_mart(a.periods, a.plans, a.freezes, a.members, a.facilities,
                       rules_table(spark, cfg.facility_rules), cfg.paid_plans)
    mart = stamp_audit(schemas.conform(mart, schemas.PERIOD_MART, schemas.PERIOD_MART_DEFAULTS), _now_ts(stamped_at))
    write_snapshot(mart.sortWithinPartitions("user_id", "start_date"), out, version(stamped_at))
    return read_latest_snapshot(spark, out)


def run_calendar_job(spark, start_year: int, end_year: int, cfg: DomainConfig, path: str,
                     stamped_at: datetime | None = None) -> DataFrame:
    """Upsert the calendar for the years into the newest version; created_at kept for existing days."""
    cal = schemas.conform(calendar_dim(spark, start_year, end_year, cfg.holidays, cfg.school_breaks),
                          schemas.CALENDAR, schemas.CALENDAR_DEFAULTS)
    fresh = stamp_audit(cal, _now_ts(stamped_at))
    current = read_latest_snapshot(spark, path, fresh.schema)
    update = [c for c in fresh.columns if c not in ("dt", "created_at")]
    merged = upsert(current, fresh, ["dt"], update_cols=update, check_unique=False)
    write_snapshot(merged, path, version(stamped_at))
    return read_latest_snapshot(spark, path, fresh.schema)


def run_location_job(a, cfg: DomainConfig, snapshot_path: str, run_ts: str) -> DataFrame:
    metrics = schemas.conform(location_metrics(a, cfg), schemas.GEO_METRICS, schemas.GEO_DEFAULTS)
    write_snapshot(metrics, snapshot_path, run_ts)
    return read_latest_snapshot(a.t.spark, snapshot_path, schemas.GEO_METRICS)


def run_profile_job(a, cfg: DomainConfig, as_of: date, location_snapshot: str | None, out: str,
                    stamped_at: datetime | None = None) -> DataFrame:
    spark = a.t.spark
    geo = (read_latest_snapshot(spark, location_snapshot, schemas.GEO_METRICS)
           if location_snapshot else None)
    prof = schemas.conform(member_profile(a, cfg, as_of, spark, geo=geo), schemas.PROFILE, schemas.PROFILE_DEFAULTS)
    write_snapshot(stamp_audit(prof, _now_ts(stamped_at)), out, version(stamped_at))
    return read_latest_snapshot(spark, out)
