import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry
from renewlens.llm import decontam, jaccard, langid, mixing, toxicity
from renewlens.llm.common import read
from renewlens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLE) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in got.select(cols).collect())


def test_pipeline_equals_its_operators_one_by_one(spark):
    """Each stage's rows are those its operator decides on, over all rows that its predecessor kept."""
    docs = read(spark, SF, "documents").limit(120).cache()
    first = docs.columns
    chain = toxicity.fit(docs, read(spark, SF, "labels"))
    toxic = {r.doc_id for r in toxicity.score(docs, chain).where("toxic").collect()}
    a = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert a.columns == first and sorted(r.doc_id for r in a.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in toxic)
    model = langid.fit(a)
    sure = {r.doc_id for r in langid.predict(a, model).collect() if r.lang_pred != "und"}
    b = corpus_pipeline.identify_language(spark, a, SF)
    assert b.columns == first and {r.doc_id for r in b.collect()} == sure
    heads = {r.doc_id for r in jaccard.link_documents(b).collect() if r.n == 0 or r.doc_id == r.component_id}
    c = corpus_pipeline.one_per_group(spark, b, SF)
    assert c.columns == first and sorted(r.doc_id for r in c.collect()) == sorted(heads)
    hit = {r.doc_id for r in decontam.contamination(c, read(spark, SF, "benchmark")).collect()}
    d = corpus_pipeline.decontaminate(spark, c, SF)
    assert d.columns == first and {r.doc_id for r in d.collect()} == heads - hit
    times = {r.doc_id: r.copies for r in mixing.mixed(d).collect()}
    e = [r.doc_id for r in corpus_pipeline.mix_sources(spark, d, SF).collect()]
    assert {i: e.count(i) for i in times} == times
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing"] and corpus_pipeline.ORACLE_SQL is None
