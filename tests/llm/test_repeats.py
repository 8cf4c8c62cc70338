import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from renewlens.llm import repeats


def brute(texts, span):
    """Spans of each text, by counting every window."""
    seen = collections.Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                hit[i : i + span] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(int), [0]))))
        out.append([tuple(e) for e in edges.reshape(-1, 2).tolist()])
    return out


def laid(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))


def test_long_texts_are_cut_alike_in_blocks_of_any_size(monkeypatch):
    rng = random.Random(9)
    texts = [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(3000))) for _ in range(8)] + [b"x" * 700]
    data, offsets = laid(texts)
    whole = repeats.anchors(data, offsets, 50, 10)
    monkeypatch.setattr(repeats, "_BLOCK", 173)
    assert all((a == b).all() for a, b in zip(whole, repeats.anchors(data, offsets, 50, 10)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=90).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=6), st.integers(16, 30))
def test_every_window_has_one_anchor_and_equal_windows_the_same(texts, span):
    data, offsets = laid(texts)
    t, h, first, last, place = repeats.anchors(data, offsets, span, 4)
    served = {}
    for row in zip(t.tolist(), h.tolist(), first.tolist(), last.tolist(), place.tolist()):
        for p in range(row[2], row[3] + 1):
            assert (row[0], p) not in served
            served[row[0], p] = row[1], row[4] - (p - row[2])
    assert set(served) == {(i, p) for i, x in enumerate(texts) for p in range(len(x) - span + 1)}
    by_bytes = {}
    for (i, p), key in served.items():
        assert by_bytes.setdefault(texts[i][p : p + span], key) == key


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(16, 44), st.integers(0, 7)), min_size=1, max_size=9), st.integers(16, 27), st.integers(1, 4))
def test_merged_transforms_against_all_windows(cuts, span, shards):
    rng = random.Random(3)
    source = [bytes(rng.choice(b"ab\0") for _ in range(60)) for _ in range(4)]
    pieces, place = [], []
    for which, start, size, turn in cuts:
        piece = source[which][start : start + max(size, span)]
        pieces.append(piece)
        place.append(turn + 16 - start)  # the same bytes of a source are cut alike
    data, offsets = laid(pieces)
    twice = np.zeros(len(pieces), bool)
    twice[0] = len(pieces) % 2
    got = repeats.repeats_of(data, offsets, np.array(place), twice, span, shards)
    keys = [(piece[i : i + span], (place[n] - i) % 8) for n, piece in enumerate(pieces) for i in range(len(piece) - span + 1)]
    seen = collections.Counter(keys)
    for n, piece in enumerate(pieces):
        for i in range(len(piece) - span + 1):
            seen[piece[i : i + span], (place[n] - i) % 8] += bool(twice[n])
    assert got.tolist() == [seen[k] > 1 for k in keys]


def test_pieces_that_end_at_the_depth_merged_by():
    source = bytes(range(97, 97 + 26)) * 2
    pieces = [source[:n] for n in (40, 24, 32, 24, 25, 24)] * 3
    data, offsets = laid(pieces)
    for shards in (1, 2, 3, 5):
        got = repeats.repeats_of(data, offsets, np.zeros(len(pieces), int), np.zeros(len(pieces), bool), 24, shards)
        starts = np.concatenate([np.arange(len(p) - 23) for p in pieces])
        assert got.all() and len(got) == len(starts)


def made(rng, n=120):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared = [prose(60) for _ in range(4)]
    texts = []
    for i in range(n):
        parts = [prose(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(0, 60)
            parts += [s[a : a + rng.randrange(150, 320)], prose(rng.randrange(20))]
        texts.append("é".join(parts))
    texts += [texts[5], texts[5], texts[6][3:], "x" * 450, "y" * 201, "ab" * 130, "z" * 200, "z" * 199, "q" * 200, "", None]
    near = texts[7] + prose(50)
    texts += [near[:k] + "!" + near[k:] for k in range(0, len(near), 60)]
    return texts


@pytest.mark.parametrize("most, chunk, spread", [(4096, 1 << 21, 1000), (3, 2000, 4)])
def test_against_counting_all_windows(spark, most, chunk, spread):
    rng = random.Random(most)
    texts = made(rng)
    rows = [(i if i else None, t, [i], "x") for i, t in enumerate(texts)] + [(5, texts[5], [0], "x")]
    df = spark.createDataFrame(rows, "doc_id int, text string, spans array<int>, kept string")
    got = repeats.remove_repeats(df, most_pieces=most, chunk_bytes=chunk, spread_rows=spread).collect()
    data = [(t or "").encode() for _, t, *_ in rows]
    want = brute(data, 200)
    key = lambda r: (r[0] is None, r[0] or 0)
    expected = sorted(((r[0], len(t), s, b"".join(t[a:b] for a, b in zip([0, *(e for _, e in s)], [*(a for a, _ in s), len(t)]))) for r, t, s in zip(rows, data, want)), key=key)
    assert sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got), key=key) == expected
    assert sum(bool(s) for s in want) > 30


def test_other_spans_no_rows_and_bad_values(spark):
    df = spark.createDataFrame([(1, "0123456789abcdefghij-left"), (2, "right-0123456789abcdefghij"), (3, "0123456789abcdefghi")], "doc_id long, text string")
    got = {r.doc_id: ([tuple(s) for s in r.spans], bytes(r.kept)) for r in repeats.remove_repeats(df, span=20).collect()}
    assert got == {1: ([(0, 20)], b"-left"), 2: ([(6, 26)], b"right-"), 3: ([], b"0123456789abcdefghi")}
    assert repeats.remove_repeats(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(df, span=8)


def test_query_digests(spark, tmp_path):
    from renewlens.llm.queries import op13_repeats

    passage = " ".join(f"word{i}" for i in range(60))
    texts = {1: "a " + passage + " b", 2: "c " + passage, 3: "alone", 4: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in op13_repeats(spark, str(tmp_path)).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    n = len(passage)
    assert got == {1: (n + 4, n + 1, 1, sha(b"a b")), 2: (n + 2, n + 1, 1, sha(b"c")), 3: (5, 0, 0, sha(b"alone")), 4: (0, 0, 0, sha(b""))}
