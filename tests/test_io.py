import uuid
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException

from renewlens.session import scratch_path
from renewlens.sources.profile import null_profile, schema_profile
from renewlens.sources.sinks import upsert, write_table
from renewlens.sources.snapshots import read_latest_snapshot, version, write_snapshot
from renewlens.sources.tables import scan_between


def test_upsert_and_duplicate_keys(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(tuple(r) for r in upsert(tgt, src, ["k"]).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    dup = spark.createDataFrame([(2, "c"), (2, "e")], "k int, v string")
    with pytest.raises(ValueError):
        upsert(tgt, dup, ["k"])


def test_upsert_idempotent(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, w int")
    src = spark.createDataFrame([(2, "c", 99), (3, "d", 30)], "k int, v string, w int")
    once = upsert(tgt, src, ["k"], update_cols=["v"])
    twice = upsert(once, src, ["k"], update_cols=["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [
        (1, "a", 10), (2, "c", 20), (3, "d", 30)]


def test_snapshots_latest_and_empty(spark):
    base = scratch_path(spark, "test", uuid.uuid4().hex)
    schema = "k int, v string"
    assert read_latest_snapshot(spark, base + "/none", spark.createDataFrame([], schema).schema).count() == 0
    write_snapshot(spark.createDataFrame([(1, "old")], schema), base, "20240101_000000")
    write_snapshot(spark.createDataFrame([(1, "new"), (2, "new")], schema), base, "20240201_000000")
    got = read_latest_snapshot(spark, base)
    assert sorted(r.v for r in got.collect()) == ["new", "new"]
    write_snapshot(spark.createDataFrame([(3, "newest")], schema), base, version(datetime(2024, 2, 1, 0, 0, 0), tie="000000000001"))
    assert [r.v for r in read_latest_snapshot(spark, base).collect()] == ["newest"]
    # a version that was never published doesn't count; a folder that holds no versions is an error
    spark.createDataFrame([(4, "half")], schema).write.parquet(f"{base}/run_ts=20990101_000000")
    assert [r.v for r in read_latest_snapshot(spark, base).collect()] == ["newest"]
    other = scratch_path(spark, "test", uuid.uuid4().hex)
    spark.createDataFrame([(1, "x", "r")], schema + ", run_ts string").write.parquet(other)
    with pytest.raises(AnalysisException):
        read_latest_snapshot(spark, other, got.schema).collect()


def test_write_modes(spark):
    path = scratch_path(spark, "test", uuid.uuid4().hex)
    df = spark.createDataFrame([(1,)], "k int")
    write_table(df, path, "replace")
    write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 2
    write_table(df, path, "replace")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(Exception):
        write_table(df, path, "fail")


def test_scan_between_inclusive_and_anded(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05"), (3, "2024-01-10")], "id int, d string")
    df = df.selectExpr("id", "CAST(d AS DATE) AS d")
    got = scan_between(df, "d", "2024-01-01", "2024-01-10", where=df.id > 1)
    assert sorted(r.id for r in got.collect()) == [2, 3]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 2.0, None), (3, None, "z")], "k long, a double, b string")
    nulls = {r.column_name: r.nulls for r in null_profile(df).collect()}
    assert nulls == {"k": 0, "a": 2, "b": 1}
    sp = {r.field: r for r in schema_profile(df, 2, "k").collect()}
    assert sp["a"].type == "double" and sp["a"].sample_values == "null | 2.0"
    assert sp["b"].sample_values == "x | null"


def test_json_documents_scan_and_flatten(spark):
    from pyspark.sql import functions as F

    from renewlens.operators.location import flatten_location
    from renewlens.sources.tables import Tables, scan
    from tests.conftest import SF001

    docs = Tables(spark, SF001).adapters.member_locations
    path = scratch_path(spark, "test", uuid.uuid4().hex)
    fmt = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}   # JSON default keeps milliseconds only
    docs.write.options(**fmt).json(path)
    back = scan(spark, path, schema=docs.schema, fmt="json", where=F.col("user_id") >= 0, options=fmt)
    a = sorted(map(tuple, flatten_location(back).collect()))
    b = sorted(map(tuple, flatten_location(docs).collect()))
    assert a == b and len(a) > 0


def test_conform_decimals_defaults_and_order(spark):
    from decimal import Decimal

    from renewlens.sources import schemas

    df = spark.createDataFrame([("u1", 43.123456789, None, 1.23456), ("u2", None, 5, None)],
                               "user_id string, home_latitude double, location_sample_size int, "
                               "commute_convenience_score double")
    out = schemas.conform(df, schemas.GEO_METRICS, schemas.GEO_DEFAULTS)
    assert out.columns == schemas.GEO_METRICS.fieldNames()
    r = {x.user_id: x for x in out.collect()}
    assert r["u1"].home_latitude == Decimal("43.1234568")            # rounded half-up at the sink
    assert r["u1"].commute_convenience_score == Decimal("1.2346")
    assert r["u1"].location_sample_size == 0 and r["u1"].is_home_nearby is False
    assert r["u1"].location_data_quality == "none" and r["u2"].location_sample_size == 5
