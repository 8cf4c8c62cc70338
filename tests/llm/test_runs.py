import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from renewlens.llm import runs


def brute(words, least=12):
    """Every period, every maximal stretch; the smallest period of a stretch only."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if (length := j - i + q) >= max(least, 2 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(2, 14))
def test_small_alphabets(words, least):
    assert runs.runs_of(np.array(words, np.int64), least) == brute(words, least)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=12), st.integers(1, 9)), max_size=8))
def test_repeated_blocks(blocks):
    words = [w for block, times in blocks for w in block * times]
    assert runs.runs_of(np.array(words, np.int64)) == brute(words)


def test_one_word_and_unique_words_are_quick():
    n = 200_000
    assert runs.runs_of(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert runs.runs_of(np.arange(n)) == []
    assert runs.runs_of(np.arange(n) % (n // 2)) == [(0, n, n // 2)]


def test_many_rounds_of_splitting():
    # each split leaves the next word alone: 0 1 0 2 1 3 2 4 3 ...
    words = np.array([0] + [w for i in range(2000) for w in (i + 1, i)])
    assert runs.frequent_segments(words, 12) == []


def test_rows_of_any_kind(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(60))), "x", i) for i in range(200)]
    rows += [(900, None, "x", 0), (901, "", "x", 0), (902, " \t\n", "x", 0), (None, "z " * 13, "x", 0), (5, "again", "x", 0), (5, "again", "x", 0)]
    rows += [(903, "é " * 6 + "  " * 12 + "tail", "x", 0), (904, "w%d " * 20000 % tuple(i % 7000 for i in range(20000)), "x", 0)]
    df = spark.createDataFrame(rows, "doc_id int, text string, runs string, n_words int")
    got = runs.collapse_runs(df).collect()
    key = lambda r: (str(r[0]), r[1])
    want = []
    for doc_id, text, *_ in rows:
        words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
        if len(words) < 1000:
            found = brute(words)
            out = {i for s, n, q in found for i in range(s + q, s + n)}
        else:
            found, out = [(0, 20000, 7000)], set(range(7000, 20000))
        want.append((doc_id, len(words), found, " ".join(w for i, w in enumerate(words) if i not in out)))
    assert sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got], key=key) == sorted(want, key=key)
    assert runs.collapse_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        runs.collapse_runs(df, 1)


def test_query_digests(spark, tmp_path):
    import zlib

    from renewlens.llm.queries import op11_runs

    rng = random.Random(7)
    texts = {i: " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(40))) for i in range(150)}
    texts[3] = None
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op11_runs(spark, str(tmp_path)).collect()}
    assert set(got) == set(texts)
    planted = 0
    for i, text in texts.items():
        words, h = (text or "").split(), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (j - a) % p] for j in range(a, n)]
        found = brute(words)
        out = {j for s, m, q in found for j in range(s + q, s + m)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[i]
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for j, w in enumerate(words) if j not in out).encode()).hexdigest()
    assert planted > 5 and any(r.n_runs for r in got.values())
