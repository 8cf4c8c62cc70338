import __spark_entry__ as E
from renewlens.plans.catalog import ORACLE, QUERIES, load_all
from tests.conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "next_start" in df.columns


def test_catalogue_integrity():
    load_all()
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(ORACLE) == {"train_baseline", "train_trees", "train_survival", "batch_score"}


def test_plans_have_no_cartesian_nested_loop_or_python(spark):
    """Every catalogued query (MLlib training aside): no Cartesian product, no nested-loop
    join, no Python UDF evaluation in the physical plan."""
    load_all()
    bad = {}
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
              "FlatMapGroupsInPandas", "MapInPandas")
    for name in sorted(ORACLE):
        if name.startswith(("train_", "batch_score")):
            continue
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        hits = [b for b in banned if b in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_scan_pushdown(spark):
    plan = E.queries()["scan_table"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_acctbal), IsNotNull(c_mktsegment), GreaterThan(c_acctbal,0.0)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double,c_mktsegment:string>" in plan
