import random
import zlib

import numpy as np
import pytest

from renewlens.llm import langid, quality, toxicity

LANGS = {"aa": "the of and to in that is was".split(), "bb": "der die und das ist nicht ein von".split(), "cc": "le la et les des un une que".split()}
INSULTS = ["blarg", "snorf", "vumpelo"]


def make(n=360, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang = rng.choice(list(LANGS))
        words = [rng.choice(LANGS[lang]) + rng.choice(["", "a", "en", "ox"]) for _ in range(rng.randrange(15, 90))]
        good, toxic = int(rng.random() < 0.75), int(rng.random() < 0.3)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "ish", ","]))
        text = " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, lang, "s", 0))
        if i % 5:
            labels.append((i, good, toxic))
    return docs, labels


EDGE = [(9001, None, None), (9002, "", None), (9003, "12 34 !! --", "aa"), (None, "der die und das", "bb"), (9004, "word " * 40_000, None), (9005, "\U0001F600 中", None), (0, "the of and", "aa")]


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = make()
    rows = docs + [(i, t, lang, None, None) for i, t, lang in EDGE]
    labels = labels + [(None, 1, 1), (77777, 1, 1), (3, None, None), (1, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, ids string, y int").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, labels


def test_quality(spark, tables):
    docs, labels, rows, known = tables
    got = quality.score(docs, labels).collect()
    assert len(got) == len(rows) + len(EDGE)
    by = {r.doc_id: r for r in got}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [(q, by[i].predicted) for i, q, _ in known if i in by and q is not None and by[i].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.95
    none = spark.createDataFrame([], labels.schema)
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).collect() == []


def test_nonnegative_risk_on_overlapping_classes():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(1.5, 1, (3000, quality.FEATURES)), rng.normal(-1.5, 1, (1000, quality.FEATURES))
    model = quality.fit_pu(pos[:1000], np.concatenate((pos[1000:], neg[:667])), 0.75, steps=300)
    assert (model.score(pos) >= 0.5).mean() > 0.97 and (model.score(neg) < 0.5).mean() > 0.9


def test_toxicity(spark, tables):
    docs, labels, rows, known = tables
    chain = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    assert toxicity.score(docs, chain).count() == len(rows) + len(EDGE)
    truth = [(any(x in t.lower() for x in INSULTS), got[i].toxic) for i, t, *_ in rows if i]
    assert sum(a == b for a, b in truth) / len(truth) > 0.97
    assert not any(got[i].toxic for i in (9001, 9002, 9004))
    kept = toxicity.without_toxic(docs, chain)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect() if r.doc_id} == {i for i, r in got.items() if i and not r.toxic}
    junk = [(got[i].p_toxic_junk >= 0.5, bool(t and not q)) for i, q, t in known if i in got and t is not None and q is not None]
    assert sum(a == b for a, b in junk) / len(junk) > 0.9
    blank = toxicity.fit(docs, spark.createDataFrame([], labels.schema))
    assert {r.p_toxic for r in toxicity.score(docs, blank).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), chain).collect() == []


def test_chain_feeds_out_of_fold_probabilities():
    rng = np.random.default_rng(1)
    first = rng.integers(0, 2, 400)
    rows = [np.array([5 + f, 20 + int(rng.integers(0, 10))]) for f in first]
    second = 1 - first  # follows from the first category alone
    chain = toxicity.fit_chain(rows, np.stack([first, second], 1).astype(float), ["a", "b"], np.arange(400) % 3)
    assert len(chain.models) == 2 and (chain.models[1].ids >= toxicity.EARLIER).any() and not (chain.models[0].ids >= toxicity.EARLIER).any()
    assert [round(p) for p in chain.of(np.array([6]))] == [1, 0] and [round(p) for p in chain.of(np.array([5]))] == [0, 1]


def test_the_last_link_decides_with_what_the_earlier_ones_say():
    """Toxic is one of two kinds, each told by its own feature or by neither but the other link: the first alone is wrong."""
    rng = np.random.default_rng(3)
    kind = rng.integers(0, 3, 900)
    rows = [np.unique([100 + int(k == 0), 200 + int(k == 1), 300 + int(rng.integers(0, 9))]) for k in kind]
    labels = np.stack([kind == 0, kind == 1, kind < 2], 1).astype(float)
    chain = toxicity.fit_chain(rows, labels, [c for c, _ in toxicity.CATEGORIES], np.arange(900) % 3)
    assert chain.names[-1] == "toxic" and {toxicity.EARLIER, toxicity.EARLIER + 1} <= set(chain.models[2].ids.tolist())
    p = np.array([chain.of(r) for r in rows])
    assert ((p[:, 0] >= 0.5) != (kind < 2)).mean() > 0.2 and ((p[:, 2] >= 0.5) == (kind < 2)).all()
    blind = toxicity.Chain(chain.names, [*chain.models[:2], toxicity.Linear(*(lambda m: (m.ids[m.ids < toxicity.EARLIER], m.weights[m.ids < toxicity.EARLIER], m.bias))(chain.models[2]))])
    assert any(abs(blind.of(r)[2] - chain.of(r)[2]) > 0.05 for r in rows[:50])


@pytest.mark.parametrize("prior", [0.25, 0.5, 0.75, 0.9])
def test_class_prior_without_negatives(prior):
    rng = np.random.default_rng(int(prior * 100))
    n, d = 6000, quality.FEATURES
    ones = int(n * prior)
    unlabelled = np.concatenate((rng.normal(1, 1, (ones, d)), rng.normal(-1, 1, (n - ones, d))))
    assert abs(quality.class_prior(rng.normal(1, 1, (3000, d)), unlabelled) - prior) < 0.06


def test_labels_may_hold_positives_only(spark, tables):
    docs, labels, _, known = tables
    got = {r.doc_id: r for r in quality.score(docs, labels.where("quality = 1")).collect()}
    held = [(q, got[i].predicted) for i, q, _ in known if i in got and q is not None and got[i].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_language(spark, tables):
    docs, _, rows, _ = tables
    model = langid.fit(docs)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows) + len(EDGE)
    by = {r.doc_id: r for r in got}
    held = [(lang, by[i].lang_pred) for i, _, lang, *_ in rows if i and by[i].held_out]
    assert len(held) > 40 and sum(a == b for a, b in held) / len(held) > 0.97
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert [by[i].lang_pred for i in (9001, 9002, 9003)] == ["und"] * 3 and by[9005].lang_pred in LANGS
    assert (np.count_nonzero(model.weights) < 0.5 * model.weights.size) and 0.05 <= model.temperature <= 20
    kept = langid.identified(docs, model)
    assert kept.columns == docs.columns and {9001, 9002, 9003}.isdisjoint({r.doc_id for r in kept.collect()}) and kept.count() > 0.9 * len(rows)
    blank = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, blank).collect()} == {"und"}


def test_temperature_softens_what_is_too_sure():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3)) * 2
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert abs(langid.temperature(z * 5, y) - 5) < 0.6 and abs(langid.temperature(z, y) - 1) < 0.15
