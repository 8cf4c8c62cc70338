import json
import random

from renewlens.sources.documents import document_profile, unnested


def walk(value, path="$", at=()):
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "long", float: "decimal", type(None): "null"}[type(value)]
    yield path, kind, at, None if kind in ("object", "array", "null") else (str(value).lower() if isinstance(value, bool) else str(value))
    if isinstance(value, dict):
        for i, k in enumerate(sorted(value)):
            yield from walk(value[k], f"{path}.{k}" if k.isidentifier() else f'{path}["{k}"]', (*at, i))
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from walk(v, f"{path}[]", (*at, i))


def made(rng, depth=0):
    pick = rng.randrange(8 if depth < 5 else 6)
    if pick < 6:
        return [None, True, rng.randrange(100), rng.randrange(1, 100) + 0.5, "text", "ü"][pick]
    if pick == 6:
        return [made(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {k: made(rng, depth + 1) for k in rng.sample(["a", "b", "c d", "e"], rng.randrange(4))}


def test_nodes_at_any_depth(spark):
    rng = random.Random(3)
    docs = [(i, {"root": made(rng), "list": [made(rng)]}) for i in range(60)]
    deep = {"x": 1}
    for _ in range(12):
        deep = {"n": [deep]}
    docs.append((60, deep))
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in docs] + [(70, None), (71, "{oops"), (72, "")], "id int, doc string")
    got = sorted(((r._id, r.path, r.type, r.value) for r in unnested(df, "id", "doc").collect() if r._id < 70), key=str)
    want = sorted(((i, p, k, v) for i, d in docs for p, k, _, v in walk(d)), key=str)
    assert list(map(str, got)) == list(map(str, want))
    rows = {(r.path, r.type): r for r in document_profile(df, "id", "doc").collect()}
    assert (rows["$", "missing"].documents, rows["$", "invalid"].documents, rows["$", "object"].documents) == (1, 2, 61)
    for (path, kind), r in rows.items():
        nodes = [(i, at, v) for i, d in docs for p, k, at, v in walk(d) if (p, k) == (path, kind)]
        if kind in ("missing", "invalid"):
            continue
        assert r.nodes == len(nodes) and r.documents == len({i for i, *_ in nodes})
        others = {k for i, d in docs for p, k, *_ in walk(d) if p == path and k != "null"} | ({"invalid"} if path == "$" else set())
        assert r.mixed == (len(others) > 1)
        if kind not in ("object", "array"):
            assert r.sample_values == " | ".join("null" if v is None else v for *_, v in sorted(nodes, key=lambda n: n[:2])[:5])
    assert document_profile(df.limit(0), "id", "doc").collect() == []
