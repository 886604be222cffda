import math
from collections import Counter

import numpy as np
import pytest

from fitframe.llm import whitening

SF = "/root/testdata/sf0.001"
NAN = float("nan")


def brute(rows):
    """Plain Python and numpy over [(id, vector)]."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, [math.floor(64 * float(c)) + 1000000 for c in v]) for i, v in kept]
    fit = sorted({tuple(x) for _, x in xs})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    cov = np.array([[sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for x in fit) / n**3 for b in range(d)] for a in range(d)])
    values, vectors = np.linalg.eigh(cov)
    order = [o for o in np.argsort(-values)[:16] if values[o] > values.max() * d * 1e-13]
    out = []
    for i, x in xs:
        gap = [(n * x[j] - s[j]) for j in range(d)]
        for k, o in enumerate(order):
            z = np.array([g / n for g in gap]) @ vectors[:, o] / math.sqrt(values[o])
            out.append((i, k + 1, n, sum(g * g for g in gap), z, values[o] / np.trace(cov)))
    return out


def compare(got, want):
    def key(r):
        return (r[0] is None, r[0] or 0, r[1], r[3], round(abs(r[4]), 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4] and abs(a[4]) == pytest.approx(abs(b[4]), abs=1e-8) and a[5] == pytest.approx(b[5], rel=1e-6)
    signs = {}
    for a, b in zip(got, want):
        if abs(b[4]) > 1e-6:
            signs.setdefault(a[1], set()).add((a[4] > 0) == (b[4] > 0))
    assert all(len(v) == 1 for v in signs.values())


def flat(df):
    return [(r.vec_id, k + 1, r.n, int(r.deviation), r.whitened[k], r.explained[k]) for r in df.collect() for k in range(len(r.whitened))]


def test_given_table_as_by_brute_force(spark):
    got = whitening.run_query(spark, SF).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare([tuple(r[c] for c in ("vec_id", "component", "n", "deviation", "whitened", "explained")) for r in got], brute(rows))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8
    assert Counter(r.component for r in got) == {k: len(rows) for k in range(1, 17)}


def test_nulls_repeats_clashing_columns_and_large_entries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(40)]
    rows += [(5, rows[5][1])] * 7 + [(None, rows[6][1]), (90, None), (91, [1.0, None, 2.0]), (92, [1.0, NAN, 2.0]), (93, [1.0, float("inf"), 0.0]),
                                     (94, []), (95, [1.0]), (96, [1.0, 70000.0, -3.0]), (97, [-0.0, 0.0, 1e-9])]
    df = spark.createDataFrame([(i, v, 1, "a", 9) for i, v in rows], "vec_id long, embedding array<double>, n long, x string, component int")
    compare(flat(whitening.whiten(df)), brute([(i, v) for i, v in rows if v is None or len(v) == 3]))
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in whitening.whiten(huge).collect()}
    assert len(got) == 3 and all(len(r.whitened) == 1 and np.isfinite(r.whitened).all() for r in got.values())
    assert int(got[3].deviation) == sum((3 * x - s) ** 2 for x, s in ((1000000, 3000000), (1000320, 3000512)))


def test_equal_vectors_and_empty_table(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.n, int(r.deviation), r.whitened, r.identity_error) for r in whitening.whiten(df).collect()] == [(1, 0, [], 0.0)] * 2
    assert whitening.whiten(df.limit(0)).count() == 0


def test_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for rows, high in ((1, 1), (63, 5), (64, 1 << 20), (1000, 1 << 40)):
        u = rng.integers(0, high, size=(rows, 4), endpoint=True)
        u[:, 2] = 0
        bits = [int(u[:, j].max()).bit_length() for j in range(4)]
        counts = np.zeros((sum(bits), sum(bits)), np.int64)
        whitening.add_overlaps(whitening.bit_planes(u, bits), counts)
        want = u.astype(object).T @ u.astype(object)
        assert (whitening.weigh(counts, bits) == want).all()
