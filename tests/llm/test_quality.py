import re
import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from fitframe.llm import quality_model, quality_rules

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_ids_are_no_inputs(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_model.run_query(spark, SF).join(labels, "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in zip(got.doc_id, got.held_out))
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.97
    assert ((got.score >= 0.5).astype(int) == got.predicted).all() and got.score.between(0, 1).all()
    # labels that are held out change nothing
    other = quality_model.score_documents(spark.read.parquet(f"{SF}/documents.parquet"), labels.withColumn(
        "quality", F.when(quality_model.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))),
        train=~quality_model.held_out(F.col("id"))).toPandas().sort_values("id")
    assert np.allclose(other.score, quality_model.run_query(spark, SF).toPandas().sort_values("doc_id").score)


def test_scores_match_numpy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200).select("doc_id", "text")
    rows = quality_model.features(docs, "text").toPandas()
    labels = [(int(i), int(i) % 2) for i in rows.doc_id]
    got = quality_model.score_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int")).toPandas().set_index("id").score
    x = rows[list(quality_model.FEATURES)].to_numpy()
    y = np.array([i % 2 for i in rows.doc_id])
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-6] = 1
    z = (x - centre) / scale
    within = {c: np.cov(z[y == c].T, bias=True) for c in (0, 1)}
    pooled = sum(within[c] * (y == c).mean() for c in (0, 1))
    density = {}
    for c in (0, 1):
        cov = (1 - quality_model.RIDGE) * ((1 - quality_model.POOLED_SHRINK) * within[c] + quality_model.POOLED_SHRINK * pooled) + quality_model.RIDGE * np.eye(x.shape[1])
        d = z - z[y == c].mean(axis=0)
        density[c] = np.log((y == c).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
    want = 1 / (1 + np.exp(density[0] - density[1]))
    assert np.allclose([got[i] for i in rows.doc_id], want, atol=1e-6)


def test_model_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "words are here", "c"), (2, "word " * 20_000, "d")], "doc_id long, text string, f_words string")
    for labels, want in (([], {0.5}), ([(1, 1)], {1.0}), ([(1, 0), (None, 1), (2, None)], {0.0})):
        got = quality_model.score_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(got) == 4 and {r.score for r in got} == want
    both = quality_model.score_documents(docs, spark.createDataFrame([(1, 0), (2, 1), (2, 1)], "doc_id long, quality int")).collect()
    assert all(0 <= r.score <= 1 for r in both)
    assert quality_model.score_documents(docs.limit(0), spark.createDataFrame([(1, 0)], "doc_id long, quality int")).count() == 0


def brute_counts(t):
    w = re.findall(r"[^\x20\x09-\x0d]+", t)
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    spots = {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(spots)


def test_counts_and_edges(spark):
    texts = ["", None, " \n\t\x0b ", "a b c d e a b c d e", "a a a a a a a", "x\n\nx\n x\nx", "é #1 <b> 😀😀", "w " * 30_000, "one two three four five six seven eight nine ten"]
    df = spark.createDataFrame([(i, t, None if i % 2 else "en", "s", 1) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 1), (None, "x", "en", None, 1)],
                               "doc_id long, text string, lang string, source string, n_words int")
    got = quality_rules.apply_rules(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = brute_counts("x" if r.doc_id is None else texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)
    assert quality_rules.apply_rules(df.limit(0)).count() == 0


def test_buckets_are_monotone_and_tight(spark):
    v = sorted({*range(2000), *(2 ** i + d for i in range(8, 40) for d in (-1, 0, 1, 7))})
    got = spark.createDataFrame([(x,) for x in v], "v long").select("v", quality_rules.bucket(F.col("v")).alias("b")).withColumn(
        "top", quality_rules.bucket_top(F.col("b"))).orderBy("v").collect()
    assert [r.b for r in got] == sorted(r.b for r in got)
    assert all(r.v <= r.top <= r.v * (1 + 1 / 32) for r in got)


def test_adaptive_thresholds_follow_their_group(spark):
    """A source of symbol-rich texts keeps them; elsewhere one is rejected; a
    small source takes the thresholds of its language."""
    plain = "the quick brown fox jumps over a lazy dog near some river bank {i}"
    rich = " ".join(f"#tag{{i}}{j}" for j in range(12))
    rows = [(i, plain.format(i=i), "en", "web") for i in range(80)] + [(100 + i, rich.format(i=i), "en", "code") for i in range(80)]
    rows += [(300, rich.format(i=1), "en", "web"), (301, plain.format(i=1), "en", "tiny"), (302, plain.format(i=2), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(df).collect()}
    assert all(kept[i] for i in range(80)) and all(kept[100 + i] for i in range(80))
    assert not kept[300] and kept[301] and kept[302]


def test_rules_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(quality_rules.oracle()).df().sort_values("doc_id").reset_index(drop=True)
    got = quality_rules.run_query(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert (got[sorted(got.columns)] == want[sorted(want.columns)]).all().all()
