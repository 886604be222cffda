import hashlib
import random

import corpus_pipeline
from fitframe.llm import sentencepiece_bpe

SF = "/root/testdata/sf0.01"


def words(seed, n):
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ren", "tas", "vu", "pel", "dor"]
    return ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n)]


def sentence(seed, n=60):
    w = words(seed, n)
    return ". ".join(" ".join(w[i:i + 8]).capitalize() for i in range(0, n, 8)) + "."


def test_stages_on_planted_cases(spark, tmp_path):
    """Each stage removes or changes what is planted for it and keeps clean documents."""
    item = sentence(999, 30)
    rows = [(i, sentence(i)) for i in range(120)]
    rows += [(200 + i, " ".join(f"{w}***" for w in words(i, 60))) for i in range(60)]             # junk
    rows += [(300, sentence(5)), (301, sentence(6).replace("lo", "lox", 1)), (302, sentence(7) + " And more")]  # copies
    rows += [(400, sentence(400) + " " + item), (500, sentence(500) + ' token = "' + hashlib.sha1(b"k").hexdigest() + '"'), (600, sentence(600))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, int(i < 200), 0) for i, _ in rows if i < 300], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r.doc_id for r in kept.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == docs.columns
        if name == "secret scan":
            text = {r.doc_id: r for r in kept.collect()}
            assert text[500].text.endswith('token = "[SECRET]"') and text[500].n_chars == len(text[500].text)
            assert all(text[i].text == t for i, t in rows if i in text and i != 500)
    clean = {i for i, _ in rows if i < 200} | {600}
    assert seen[0] == {i for i, _ in rows if not 200 <= i < 300}
    assert seen[1] == clean | {400, 500} and seen[2] == seen[3] == seen[4] == clean | {500}
    v = sentencepiece_bpe.vocabulary(sentencepiece_bpe.default_path())
    texts = dict(rows)
    for r in kept.collect():
        if r.doc_id != 500:
            assert r.ids == v.library.encode(texts[r.doc_id], add_eos=True) and r.n_tokens == len(r.ids)


def test_run_on_the_tables(spark):
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in got]
    assert len(ids) == len(set(ids)) and set(ids) < docs and len(ids) > 0.6 * len(docs)


def test_near_duplicate_stage_keeps_clean_rows_and_drops_copies(spark):
    """Ids on several rows, missing ids and repeated rows: each row is judged
    by its own text, and one row of each group stays."""
    near = sentence(1).replace("lo", "lox", 1)
    rows = [(1, sentence(1)), (7, near), (7, sentence(2)), (8, sentence(3)), (8, sentence(3)), (None, sentence(4)), (None, sentence(4)),
            (None, sentence(1)), (9, sentence(5)), (9, sentence(5).replace("ka", "kax", 1)), (10, None), (10, None), (11, ""), (12, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()), key=str)
    assert [g for g in got if g[0] != 9] == sorted([(1, sentence(1)), (7, sentence(2)), (8, sentence(3)), (None, sentence(4)), (10, None), (11, ""), (12, "")], key=str)
    assert len([g for g in got if g[0] == 9]) == 1


def test_stages_on_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0, name
