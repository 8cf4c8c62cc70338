import uuid
from datetime import datetime

from renewlens import config
from renewlens.config import DRIVER_CONFIG
from renewlens.plans import jobs
from renewlens.session import scratch_path
from renewlens.sources.tables import Tables
from tests.conftest import SF001


def test_jobs_end_to_end(spark):
    a = Tables(spark, SF001).adapters
    base = scratch_path(spark, "jobs", uuid.uuid4().hex)
    mart = jobs.run_period_job(a, DRIVER_CONFIG, f"{base}/period_mart", datetime(2024, 1, 1))
    assert mart.count() == 909 and dict(mart.dtypes)["period_id"] == "string"
    geo = jobs.run_location_job(a, DRIVER_CONFIG, f"{base}/geo", "20240201_000000")
    assert dict(geo.dtypes)["home_latitude"] == "decimal(10,7)"
    prof = jobs.run_profile_job(a, DRIVER_CONFIG, config.PERIOD_AS_OF, f"{base}/geo", f"{base}/profile")
    assert len(prof.columns) == 54 and dict(prof.dtypes)["weight_kg"] == "decimal(6,2)" and "updated_at" in prof.columns
    assert prof.count() == prof.select("user_id").distinct().count() > 0
    cal1 = jobs.run_calendar_job(spark, 2020, 2021, DRIVER_CONFIG, f"{base}/cal", datetime(2024, 1, 1))
    cal2 = jobs.run_calendar_job(spark, 2021, 2022, DRIVER_CONFIG, f"{base}/cal", datetime(2024, 2, 1))
    assert cal1.count() == 731 and cal2.count() == 1096
    kept = cal2.filter("dt = DATE'2021-06-01'").first()
    assert kept.created_at == datetime(2024, 1, 1) and kept.updated_at == datetime(2024, 2, 1)
