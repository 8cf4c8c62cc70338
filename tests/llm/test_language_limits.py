import random

import numpy as np
import pytest

from renewlens.llm import langid

WORDS = {"aa": "the of and to in that is was".split(), "bb": "der die und das ist nicht ein von".split(), "cc": "le la et les des un une que".split()}


def sentence(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "a", "en", "ox"]) for _ in range(n))


def gibberish(rng):
    return " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(12))


def test_texts_of_no_learned_language_go_and_short_clean_ones_stay(spark):
    rng = random.Random(5)
    known = [(i, sentence(rng, WORDS[lang := rng.choice(list(WORDS))], rng.randrange(2, 90)), lang) for i in range(900)]
    foreign = ["今天的天气非常好我们一起去公园散步", "Сегодня хорошая погода и мы идем гулять в парк", gibberish(rng), gibberish(rng)]
    short = ["the", "of and", "der die und", "les des", "la"]
    rows = known + [(10_000 + i, t, None) for i, t in enumerate(foreign)] + [(20_000 + i, t, None) for i, t in enumerate(short)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.fit(docs)
    kept = {r.doc_id for r in langid.identified(docs, model).collect()}
    assert not kept & {10_000 + i for i in range(len(foreign))}
    assert {20_000 + i for i in range(len(short))} <= kept
    assert len(kept & {i for i, *_ in known}) >= 0.99 * len(known)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    # rejected or not, a text with letters is predicted to be of a learned language
    assert {r.lang_pred for r in got.values()} == set(WORDS) and all(0 < r.score <= 1 for r in got.values())
    bare = spark.createDataFrame([(1, None, None), (2, "", None), (3, "12 + 34!", None), (4, "42 ж", None)], docs.schema)
    assert {r.doc_id: (r.lang_pred in WORDS, r.score > 0) for r in langid.predict(bare, model).collect()} == {1: (False, False), 2: (False, False), 3: (False, False), 4: (True, True)}
    assert [r.doc_id for r in langid.identified(bare, model).collect() if r.doc_id < 4] == []


def test_the_probability_decides_on_long_texts_and_allows_for_short_ones():
    rng = np.random.default_rng(0)
    n, i = rng.integers(20, 2000, 4000), rng.integers(0, 2, 4000)
    r = langid.limits(5 + i + rng.normal(size=4000) * np.sqrt(0.01 + 4 / n), n, i, np.full(4000, 0.9), 2, 0.001)
    assert r.mean == pytest.approx([5, 6], abs=0.1)
    assert r.reject(5, 2000, 0, 0.3) and not r.reject(5, 20, 0, 0.3) and not r.reject(5, 2000, 0, 0.9)
    assert r.reject(8, 2000, 0, 0.9) and not r.reject(8, 20, 0, 0.9) and r.reject(15, 20, 0, 0.9) and not r.reject(15, langid.FEWEST - 1, 0, 0.9)
    assert langid.limits(np.empty(0), np.empty(0), np.empty(0, int), np.empty(0), 2, 0.001) is None
