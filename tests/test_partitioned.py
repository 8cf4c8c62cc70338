import os
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from renewlens.operators import norm_state as N
from renewlens.operators import weekly as W
from renewlens.plans import q_history as H
from renewlens.plans.catalog import load_all, tables_for
from renewlens.sources.partitioned import read_table, upsert_partitions
from tests.conftest import SF001

SCHEMA = StructType().add("id", "integer").add("value", "string").add("day", "date")
D = [date(2024, 1, 1) + timedelta(days=i) for i in range(5)]


def files(path):
    return {os.path.join(a, f): os.stat(os.path.join(a, f)).st_mtime_ns for a, _, names in os.walk(path) for f in names if f.endswith(".parquet") and "/data/" in a}


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"a{i}", D[i % 4]) for i in range(40)] + [(99, "none", None)]
    assert len(upsert_partitions(spark.createDataFrame(rows, SCHEMA), f"file://{path}", ["id", "day"], "day", "0001")) == 5
    before = files(path)
    change = [(0, "new", D[0]), (4, "new", D[0]), (77, "added", D[4]), (98, "more", None)]
    assert set(upsert_partitions(spark.createDataFrame(change, SCHEMA), f"file://{path}", ["id", "day"], "day", "0002")) == {str(D[0]), str(D[4]), None}
    after = files(path)
    assert before.items() <= after.items()
    written = {re.search(r"day=([^/]+)", f)[1] for f in set(after) - set(before)}
    assert written == {str(D[0]), str(D[4]), "__HIVE_DEFAULT_PARTITION__"}
    want = {(i, d): v for i, v, d in rows} | {(i, d): v for i, v, d in change}
    got = {(r.id, r.day): r.value for r in read_table(spark, f"file://{path}", SCHEMA, "day").collect()}
    assert got == want
    # only the manifest's folders are listed, and a filter on the partition prunes further
    plan = read_table(spark, f"file://{path}", SCHEMA, "day").filter(F.col("day") == D[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert upsert_partitions(spark.createDataFrame([], SCHEMA), f"file://{path}", ["id", "day"], "day", "0003") == []
    assert read_table(spark, f"file://{path}", SCHEMA, "day").count() == len(want)
    with pytest.raises(ValueError):
        upsert_partitions(spark.createDataFrame(change, SCHEMA), f"file://{path}", ["id"], "day", "0004")


def test_unpublished_versions_are_not_seen(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert read_table(spark, path, SCHEMA, "day").collect() == []
    upsert_partitions(spark.createDataFrame([(1, "a", D[0])], SCHEMA), path, ["id", "day"], "day", "0001")
    # a writer that died before it published
    spark.createDataFrame([(1, "b", D[0])], SCHEMA).write.partitionBy("day").parquet(f"{path}/data/v=0002")
    assert [r.value for r in read_table(spark, path, SCHEMA, "day").collect()] == ["a"]


def full(events, alpha):
    """week -> norm of a member's (week number, amount) list, by definition."""
    amounts = {}
    for week, x in events:
        amounts[week] = amounts.get(week, 0) + x
    lo, hi, out = min(amounts), max(amounts), {}
    for i in range(lo, hi + 1):
        ws = [(1 - alpha) ** (i - 1 - j) for j in range(lo, i)]
        out[i] = (amounts.get(i, 0), sum(w * amounts.get(j, 0) for w, j in zip(ws, range(lo, i))) / sum(ws) if ws else None)
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_runs_one_after_the_other_equal_one_run(spark, seed):
    rng, monday = random.Random(seed), date(2020, 1, 6)
    events = {m: [(rng.randrange(60) if m else rng.randrange(5), float(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 25))] for m in range(6)}
    batches = [[], [], [], []]
    for m, rows in events.items():
        for week, x in rows:
            batches[min(3, week // 20) if rng.random() < 0.7 else 3].append((m, monday + timedelta(days=7 * week), x))
    batches[1].append((None, monday, 1.0))
    state, norms = spark.createDataFrame([], N.STATE), {}
    kind = "user_id long, week date, x double, x_ewma double"
    for rows in batches:
        lowest = {}
        for m, week, _ in rows:
            lowest[m] = min(week, lowest.get(m, week))
        # a run is given no more norms than it may read
        known = [(*k, *v) for k, v in norms.items() if k[0] in lowest and k[1] >= lowest[k[0]]]
        state, changed = N.advance(state, spark.createDataFrame(known, kind), spark.createDataFrame(rows, "user_id long, week date, x double"), "x", 0.3)
        state = spark.createDataFrame(state.collect(), N.STATE)
        norms |= {(r.user_id, r.week): (r.x, r.x_ewma) for r in changed.collect()}
    want = {(m, monday + timedelta(days=7 * i)): v for m, rows in events.items() for i, v in full(rows, 0.3).items()}
    assert norms.keys() == want.keys()
    for k, (x, norm) in want.items():
        assert norms[k][0] == x and (norms[k][1] is None) == (norm is None) and (norm is None or abs(norms[k][1] - norm) < 1e-9)


def test_bucketed_tables_join_on_the_member_without_an_exchange(spark):
    load_all()
    t = tables_for(spark, SF001)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3k")
        # as large tables: members aren't broadcast
        plan = H.bucketed_mart(t)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    at = next(i for i, line in enumerate(plan) if re.search(r"SortMergeJoin \[user_id#\d+L\], \[user_id#\d+L\]", line))
    depth = re.search(r"\w|\*", plan[at]).start()
    below = [line for line in plan[at + 1:] if re.search(r"\w|\*", line).start() > depth]
    below = below[: next((i for i, line in enumerate(plan[at + 1:]) if re.search(r"\w|\*", line).start() <= depth), len(below))]
    assert sum("Bucketed: true" in line for line in below) == 2
    assert not any("Exchange hashpartitioning(user_id" in line or "Exchange hashpartitioning(plan_id" in line for line in below)


def test_range_of_days_lists_their_folders_only(spark):
    load_all()
    plan = H.scan_sessions_partitioned(tables_for(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-01-08.*day#\d+ <= 2024-01-14", plan) and "PushedFilters: [IsNotNull(event_type)" in plan


def test_facts_sum_further_columns(spark):
    load_all()
    a = tables_for(spark, SF001).adapters.activity
    f = W.fact_member_week(a, extra={"one": F.lit(1.0)})
    assert f.filter("one <> sessions").count() == 0
