import duckdb
import pytest

from renewlens.llm import chat, mixing
from renewlens.llm.common import WORD_PATTERN


def water(sizes, weights=(1, 2, 3), cap=3):
    """Targets by sharing again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, cut = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in cut]
        left = total - sum(cut.values())
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > cap * sizes[s]]
        if not over:
            return {**cut, **share}
        cut.update({s: cap * sizes[s] for s in over})


DOCS = [(i, "w " * (i % 37), f"s{i % 5}" if i % 5 < 4 else None) for i in range(600)]
DOCS += [(1000, "a   b\x0bc", "tiny"), (1001, None, "zero"), (1002, "", "zero"), (None, "x y z", "s1"), (None, "x y z u", "s1"), (7, DOCS[7][1], DOCS[7][2])]


def test_targets_and_takings(spark):
    df = spark.createDataFrame([(*d, "c", 1) for d in DOCS], "doc_id long, text string, source string, copy string, Mix_Rate int").repartition(4)
    rows = mixing.mixed(df).collect()
    assert len(rows) == len(DOCS)
    sizes = {}
    for _, t, s in DOCS:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    want = water(sizes)
    for s, size in sizes.items():
        own = [r for r in rows if r.source == s]
        assert {(r.source_size, round(r.target, 6)) for r in own} == {(size, round(want[s], 6))}
        assert all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in own)
        if size > 1000:
            assert abs(sum(r.taken for r in own) - want[s]) < 0.02 * want[s]
    mix = mixing.mix(df)
    assert mix.columns == [*df.columns, "copy_"]
    assert mix.count() == sum(r.copies for r in rows)
    assert sorted(mixing.mixed(df).collect(), key=str) == sorted(rows, key=str)
    assert mixing.mixed(df.limit(0)).collect() == [] and mixing.mix(df.limit(0)).collect() == []
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", DOCS)
    assert sorted(map(str, con.execute(mixing.SQL).fetchall())) == sorted(str(tuple(r)) for r in rows)
    assert WORD_PATTERN


TURNS = [(0, 0, "user", "hi"), (0, 1, "assistant", "one"), (0, 2, "user", "more"), (0, 3, "assistant", "two"), (1, 0, "user", "hi"), (1, 1, "assistant", "two"), (2, 0, "user", "q"), (2, 1, "assistant", "lone"),
         (4, 0, "user", "no reply"), (5, 1, "assistant", "b"), (5, 0, "system", None), (6, 0, None, "x"), (6, 1, "assistant", ""), (7, 0, "assistant", "z"), (7, 0, "assistant", "z"), (None, 0, "user", "lost"), (8, None, "assistant", "n"), (9, 0, "assistant", "é\U0001F600")]
TURNS += [(20, i, ("user", "assistant")[i % 2], f"turn {i} " * 30) for i in range(400)]


TURNS += [(c, i, ("user", "assistant")[i % 2], f"{c // 2 if i < 5 else c} {i}") for c in range(30, 50) for i in range(c % 7 + 1)]


def test_preference_pairs_equal_sql(spark):
    df = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, pair_id string")
    got = chat.format_preferences(chat.neighbour_pairs(df))
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", TURNS)
    want = con.execute(chat.SQL).fetchall()
    rows = got.collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in rows)
    assert {r.pair_id for r in rows} == {c for c, *_ in TURNS if c is not None} and len({r.prompt_turns for r in rows}) > 2
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert chat.format_preferences(chat.neighbour_pairs(df.limit(0))).collect() == []


@pytest.mark.parametrize("a,b,n", [([], [], 0), (None, [("user", "x")], 0), ([("user", "x")], [("user", "x")], 1), ([("user", "x"), ("assistant", "y"), ("user", "z")], [("user", "x"), ("assistant", "w")], 1), ([("user", "x")], [("assistant", "x")], 0)])
def test_common_prefix_and_masks(spark, a, b, n):
    kind = "array<struct<role:string,text:string>>"
    r = chat.format_preferences(spark.createDataFrame([(1, a, b)], f"pair_id long, chosen {kind}, rejected {kind}")).first()
    show = lambda turns: "".join(f"<|{x}|>\n{t}<|end|>\n" for x, t in turns or [])
    assert r.prompt_turns == n and r.prompt == show((a or [])[:n])
    for side, text, spans in ((a, r.chosen, r.chosen_spans), (b, r.rejected, r.rejected_spans)):
        rest = (side or [])[n:]
        assert text == show(rest)
        cut = [text[int(s.split(":")[0]) : int(s.split(":")[1])] for s in spans.split(";") if s]
        assert cut == [f"{t}<|end|>\n" for x, t in rest if x == "assistant"]
