import random

import numpy as np

from renewlens.llm import decontam as D
from renewlens.llm.common import WordHashes

WORDS = [f"word{i}" for i in range(500)]


def text(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def least_edits(item, doc):
    """Plain semi-global edit distance."""
    row = [0] * (len(doc) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(doc, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    rng = random.Random(5)
    items = [(i, text(rng, rng.randrange(12, 60))) for i in range(30)]
    bench = [(i, " ".join(t)) for i, t in items] + [(100, None), (101, ""), (102, "... --")]
    docs, planted = [], {}
    for d in range(120):
        body = text(rng, rng.randrange(0, 300))
        if d % 2:
            i, item = rng.choice(items)
            new = list(item)
            for _ in range(rng.randrange(0, 1 + len(item) // 10)):
                new[rng.randrange(len(new))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() + "," if rng.random() < 0.2 else w for w in new]
            planted[d] = i
        docs.append((d, " ".join(body), "x"))
    docs += [(500, None, "x"), (501, "", "x"), (None, bench[0][1], "x"), (7, docs[7][1], "x"), (502, " ".join(text(rng, 30_000)) + " " + bench[1][1], "x")]
    schema = "doc_id long, text string, item_id string"
    frame, b = spark.createDataFrame(docs, schema).repartition(3), spark.createDataFrame(bench, "item_id long, text string")
    got = D.contamination(frame, b).collect()
    pairs = {(r.doc_id, r.item_id): r.edits for r in got}
    byid = dict(items)
    want = {}
    for d, t, _ in docs:
        body = (t or "").lower().replace(",", "").split()
        if len(body) > 5000:
            continue
        for i, item in items:
            if (e := least_edits(item, body)) <= len(item) // 5:
                want[d, i] = e
    found = {k: v for k, v in pairs.items() if k[0] != 502}
    assert found == want and (502, 1) in pairs
    assert all((d, i) in pairs for d, i in planted.items()) and byid
    assert sum(r.doc_id == 7 for r in got) == 2 * sum(d == 7 for d, _ in want)
    kept = D.decontaminated(frame, b)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, *_ in docs if d not in {x for x, _ in pairs}), key=str)
    blocks = D.blocks(b, block_words=200)
    assert len(blocks) > 3
    assert {(r.doc_id, r.item_id) for r in D.contamination(frame, b, block_words=200).collect()} == set(pairs)


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    assert D.contamination(docs, bench).collect() == [] and D.contamination(one, bench).collect() == []
    assert D.decontaminated(one, bench).count() == 1


def test_edit_distance_equals_plain():
    rng = random.Random(2)
    for _ in range(50):
        item, seg = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 9))], [rng.randrange(1, 6) for _ in range(rng.randrange(1, 12))]
        got = D.edit_distance(np.array([item], np.uint64), np.array([len(item)]), np.array([seg], np.uint64))
        assert got[0] == least_edits(item, seg)


def test_cgk_keeps_near_sequences_near():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 1 << 60, size=(200, 40)).astype(np.uint64) | np.uint64(1)
    b, c = a.copy(), a[::-1].copy()
    b[np.arange(200), rng.integers(0, 40, 200)] = 77
    n, steps = np.full(200, 40), rng.integers(1 << 62, size=(4, 120)).astype(np.uint64) | np.uint64(1)
    every = np.broadcast_to(np.arange(120)[None, None, :], (4, 200, 120))
    ea, eb, ec = (D.cgk(x, n, steps, every) for x in (a, b, c))
    assert (ea == eb).mean() > 0.85 and (ea == ec).mean() < 0.35
    assert (D.sequence("Foo, bar! -- (baz)", WordHashes(key=D._word_key)) == D.sequence("foo bar BAZ", WordHashes(key=D._word_key))).all()
