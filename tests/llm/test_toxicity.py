import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from fitframe.llm import toxicity_crf as crf

SF = "/root/testdata/sf0.01"


def chains(rng, lengths):
    first = np.zeros(sum(lengths), bool)
    first[np.cumsum([0] + lengths[:-1])] = True
    return rng.normal(size=len(first)) * 2, first


def enumerated(e, shared):
    """Marginals and log partition of one chain over all labellings."""
    _, t01, t10, t11 = shared
    move = {(0, 0): 0.0, (0, 1): t01, (1, 0): t10, (1, 1): t11}
    paths = list(itertools.product((0, 1), repeat=len(e)))
    value = np.array([sum(y * v for y, v in zip(p, e)) + t01 * p[0] + sum(move[a, b] for a, b in zip(p, p[1:])) for p in paths])
    w = np.exp(value - value.max())
    z = w.sum()
    return np.array([sum(w[i] for i, p in enumerate(paths) if p[t]) / z for t in range(len(e))]), np.log(z) + value.max()


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    lengths = [1, 2, 7, 5, 1, 9]
    e, first = chains(rng, lengths)
    shared = np.array([0.0, -1.5, 0.4, 2.5])
    got = 1 / (1 + np.exp(-crf._odds(e, first, shared)[0]))
    at = 0
    for n in lengths:
        np.testing.assert_allclose(got[at:at + n], enumerated(e[at:at + n], shared)[0], atol=1e-9)
        at += n


def test_gradient_and_likelihood():
    rng = np.random.default_rng(6)
    lengths = [3, 1, 6]
    _, first = chains(rng, lengths)
    n, k = len(first), 4
    owner, key = rng.integers(0, n, 12), rng.integers(0, k, 12)
    y = rng.integers(0, 2, n).astype(float)
    x = rng.normal(size=k + 4)
    f, g = crf._loss(x, k, owner, key, first, y, 0.0)
    for i in range(len(x)):
        d = np.zeros(len(x))
        d[i] = 1e-5
        slope = (crf._loss(x + d, k, owner, key, first, y, 0.0)[0] - crf._loss(x - d, k, owner, key, first, y, 0.0)[0]) / 2e-5
        assert abs(slope - g[i]) < 1e-3
    e = x[k] + np.bincount(owner, weights=x[:k][key], minlength=n)
    want, at = 0.0, 0
    for m in lengths:
        path = y[at:at + m].astype(int)
        value = (path * e[at:at + m]).sum() + x[k + 1] * path[0]
        value += sum({(0, 0): 0.0, (0, 1): x[k + 1], (1, 0): x[k + 2], (1, 1): x[k + 3]}[a, b] for a, b in zip(path, path[1:]))
        want += enumerated(e[at:at + m], x[k:])[1] - value
        at += m
    assert abs(f - want) < 1e-2  # the ridge on the shared weights is left


def test_descent_finds_the_least():
    a = np.diag([1.0, 10.0, 100.0])
    x = crf.minimise(lambda v: (0.5 * v @ a @ v - v.sum(), a @ v - 1), np.zeros(3), 200)
    np.testing.assert_allclose(x, [1, 0.1, 0.01], atol=1e-3)


def planted(spark, n=300, seed=2):
    """Made-up words; toxic rows hold a stem with ever new endings."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(words) + 1)
                words[at:at] = [f"Zorqux{word()},", f"zorqux{word()}"][:rng.randint(1, 2)]
        rows.append((i, " ".join(words), "de", 1))
        labels.append((i, int(toxic)))
    return rows, labels


def test_stems_spans_and_odd_rows(spark):
    rows, labels = planted(spark)
    odd = [(1000, None, "x", 1), (1001, "", "x", 1), (1002, "  \n", "x", 1), (None, "zorquxabc", "x", 1), (1003, "fine words " * 20000, "x", 1),
           (1004, "fine words " * 20000 + "(ZORQUXqq) zorquxé! end", "x", 1), (3, "zorquxabc and zorquxabd", "x", 1), (3, rows[3][1], "x", 1), (1005, "?! ... zorquxab", "x", 1)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score int")
    marks = spark.createDataFrame(labels + [(None, 1), (1, None), (2, 7), (0, 1)], "doc_id long, toxic int")
    got = crf.score_documents(docs, marks, train=F.col("id") % 3 != 1).collect()
    assert len(got) == len(rows) + len(odd)
    of = {}
    for r in got:
        of.setdefault(r.id, []).append(r)
    for i, y in labels:
        if i != 3:
            assert (of[i][0].score >= 0.3) == bool(y), (i, y, of[i][0].score)
    assert all(of[i][0].score < 0.3 and of[i][0].spans == [] for i in (1000, 1001, 1002, 1003))
    assert of[1000][0].score == of[1001][0].score and of[None][0].score > 0.3
    long = of[1004][0]
    text = next(r[1] for r in odd if r[0] == 1004)
    assert long.score > 0.3 and [text[s.start:s.end] for s in long.spans] == ["ZORQUXqq) zorquxé"]
    assert sorted(r.score > 0.3 for r in of[3]) == [False, False, True]
    assert [(s.start, s.end) for s in of[1005][0].spans] == [(7, 15)]
    for i, y in labels:
        if y:
            text = rows[i][1]
            assert any("zorqux" in text[s.start:s.end].lower() for s in of[i][0].spans)


def test_without_labels_or_documents(spark):
    rows, labels = planted(spark, 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert {r.score for r in crf.score_documents(docs, marks.where("toxic = 0")).collect()} == {0.0}
    assert {r.score for r in crf.score_documents(docs, marks.where("toxic = 1")).collect()} == {1.0}
    assert {r.score for r in crf.score_documents(docs, marks.where("toxic > 5")).collect()} == {0.0}
    assert crf.score_documents(docs.limit(0), marks).count() == 0


def test_copies_teach_once(spark):
    """A toxic text copied often must not make its own words toxic keys."""
    rows, labels = planted(spark)
    twin = "calm harbour morning zorquxtwin lantern meadow"
    rows += [(5000 + i, twin, "de", 1) for i in range(400)] + [(9000, "calm harbour lantern meadow", "de", 1)]
    labels += [(5000 + i, 1) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.id: r for r in crf.score_documents(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert got[9000].score < 0.3 and got[5000].score > 0.3
    assert [twin[s.start:s.end] for s in got[5000].spans] == ["zorquxtwin"]


def test_held_out_documents(spark):
    """English toxic words of the given table are told; the toxic labels of
    its other languages stand on texts without any sign."""
    got = crf.run_query(spark, SF)
    t = (got.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
         .join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").collect())
    told = ("idiot", "scum", "trash", "clown", "loser", "worthless", "stupid", "moron", "pathetic", "disgusting")
    clean = [r for r in t if r.toxic == 0]
    toxic = [r for r in t if r.toxic == 1 and any(w in r.text.lower().split() for w in told)]
    assert len(clean) > 50 and sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert len(toxic) >= 5 and sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count() and got.where("score < 0 or score > 1").isEmpty()
