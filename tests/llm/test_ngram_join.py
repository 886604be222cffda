import random
import re

import numpy as np
import pytest

from fitframe.llm import ngram_join
from fitframe.llm.components import connected_components

SCHEMA = "doc_id long, text string, n_shingles string, component_id string, key string"


def brute(rows, k, num, den):
    sets = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[doc_id] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def varied(seed):
    """Groups of near copies with edits of every size, passages that many
    texts share, and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for length in (3, 9, 10, 11, 20, 40, 90, 200, 600, 1100):
        base = rng.choices(vocabulary, k=length)
        for copy in range(14):
            w = list(base)
            for _ in range(rng.randint(0, max(1, length // 25))):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.insert(at, rng.choice(vocabulary)), lambda: w.pop(at) if len(w) > 1 else None,
                            lambda: w.__setitem__(at, rng.choice(vocabulary))])()
            texts.append(" ".join(w).title() if copy % 3 else " \n".join(w))
    for _ in range(15):
        texts.append(" ".join(passage + rng.choices(vocabulary, k=rng.randint(1, 60))))
    texts += ["", "  ", None, "one", "One", "one two", "two one", "one two"]
    rng.shuffle(texts)
    return list(enumerate(texts, 10))


@pytest.mark.parametrize("seed,k,num,den", [(1, 3, 90, 100), (2, 5, 80, 100)])
def test_components_match_brute_force(spark, seed, k, num, den):
    rows = varied(seed)
    df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)
    got = ngram_join.similar_classes(df, k=k, num=num, den=den).collect()
    want = brute(rows, k, num, den)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < len(rows) - 20


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "a b c d e f"
    df = spark.createDataFrame([(5, text), (5, text), (None, text), (None, "x y z w"), (7, None), (3, "A b c D e F")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.similar_classes(df).collect() if r.component_id is not None)
    assert got == [(0, 4, 3), (3, 4, 3), (5, 4, 3), (5, 4, 3), (7, 0, 7)]
    assert ngram_join.similar_classes(df).where("component_id is null").count() == 1


def test_one_id_on_different_texts(spark):
    """Rows of an id link by their own text only; rows without ids link too."""
    long = [f"w{i}" for i in range(60)]
    near = " ".join(long[:30] + ["x"] + long[31:])
    other = [f"v{i}" for i in range(60)]
    rows = [(7, " ".join(long)), (7, " ".join(other)), (3, near), (9, " ".join(other[:-1])), (None, " ".join(other[1:])),
            (None, "q r s t u v w x y z " * 3 + "one"), (None, "q r s t u v w x y z " * 3 + "one"), (8, "alone " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.component_id, r.group_key) for r in ngram_join.similar_classes(df, num=80).sort("n_shingles", "doc_id").collect()]
    groups = {}
    for i, c, g in got:
        groups.setdefault(g, []).append((i, c))
    found = sorted((sorted(v, key=str) for v in groups.values()), key=str)
    assert found == sorted([[(3, 3), (7, 3)], [(7, 7), (9, 7), (None, 7)], [(None, None), (None, None)], [(8, 8)]], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (50, 100)])
def test_pigeonhole_keeps_a_common_key(num, den):
    """Two sets within the allowed difference always share a kept key."""
    rng = np.random.default_rng(3)
    for n in [1, 2, 5, 9, 10, 19, 37, 100, 400, 700]:
        for _ in range(30):
            a = rng.integers(1, 2**62, n).astype(np.uint64)
            drop = int(rng.integers(0, n * (den - num) // (den + num) + 1))
            b = np.concatenate([a[drop:], rng.integers(1, 2**62, int(rng.integers(0, drop + 1))).astype(np.uint64)])
            if den * (n - drop) < num * (n + len(b) - (n - drop)) or not len(b):
                continue
            import pyarrow as pa
            batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([a.view(np.int64), b.view(np.int64)]), pa.array([1, 2])], names=["id", "h", "k"])
            out = next(ngram_join.sketch_batches(num, den)([batch])).to_pylist()
            assert set(out[0]["keys"]) & set(out[1]["keys"])
            bits = [np.array(r["sketch"], dtype=np.int64).view(np.uint64) for r in out]
            far = sum(int(x).bit_count() for x in bits[0] ^ bits[1])
            assert far <= len(set(a.tolist()) ^ set(b.tolist()))


def test_wide_sketches_bound_the_difference(spark):
    """Folded or not, the distance of wide sketches is a lower bound, and close to it."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    rng = np.random.default_rng(4)
    base = rng.integers(1, 2**62, 1400)
    sets = [base[:700], base[:1000], base[:1100], base[50:1100], base[:300]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets))), pa.array(sets), pa.array(range(len(sets)))], names=["id", "h", "k"])
    rows = next(ngram_join.sketch_batches(50, 100)([batch])).to_pylist()
    assert [len(r["wide"]) for r in rows] == [32, 32, 64, 64, 0]
    df = spark.createDataFrame([(i, j, rows[i]["wide"], rows[j]["wide"]) for i in range(5) for j in range(5)], "i int, j int, wu array<bigint>, wv array<bigint>")
    for r in df.select("i", "j", ngram_join._wide_hamming("wu", "wv").alias("far")).collect():
        true = len(set(sets[r.i].tolist()) ^ set(sets[r.j].tolist()))
        assert r.far <= true and (r.far >= 0.6 * true or 4 in (r.i, r.j))


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(50)] + [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(50)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for u, v in edges:
        if u != v:
            x, y = find(u), find(v)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root}
