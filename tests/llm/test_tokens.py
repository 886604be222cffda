import hashlib
import random

import pytest

from fitframe.llm import sentencepiece_bpe, token_count

ODD = ["", " ", "  a", "a ", "\n", "\n\n a", "▁", "▁▁a ▁b", "日本語 テスト 😀", "a\x00b", "\t x", "  many   spaces  ", "<s> </s> <0x0A>",
       "a" * 500, " " * 100, "مرحبا", "x▁y", "nb sp", "﻿bom", "𝒳𝒴", "é", "<|endoftext|>", "a<|endoftext|> b", "it's I'LL we'd",
       "\u0085x", "\x1c \x1f", "½ Ⅷ ٣", " \n y", "ǅ ª"]


def texts(seed, n=400):
    rng = random.Random(seed)
    signs = list("abc the sd'é1² \n\t▁_-.!") + [" ", "　", "日", "😀", "\u0085", "\x1c", "ß", "́", "<|endoftext|>", " ", " ", "٣"]
    return ODD + ["".join(rng.choices(signs, k=rng.randint(1, 50))) for _ in range(n)]


def test_encoding_equals_the_library(spark):
    path = sentencepiece_bpe.default_path()
    v = sentencepiece_bpe.vocabulary(path)
    rows = texts(1)
    assert v.encode_batch(rows) == v.library.encode(rows, add_eos=True)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*rows, None, None])], "doc_id long, text string, ids string")
    got = sentencepiece_bpe.decode(sentencepiece_bpe.encode(df, path), path).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        want = v.library.encode(r.text or "", add_eos=True)
        assert r.ids == want and r.decoded == v.library.decode(want)
    told = {r.doc_id: r for r in sentencepiece_bpe.digests(df, path).collect()}
    for r in got:
        assert told[r.doc_id].n_tokens == len(r.ids)
        assert told[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert told[r.doc_id].decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert sentencepiece_bpe.digests(df.limit(0), path).count() == 0


def test_a_wrong_score_is_noticed():
    v = sentencepiece_bpe.Vocabulary(sentencepiece_bpe.default_path())
    v.scores = {p: -s for p, s in v.scores.items()}
    with pytest.raises(RuntimeError, match="differ from the library"):
        v.encode_batch(["the quick brown fox jumps over the lazy dog"])


def test_counts_equal_the_library(spark, monkeypatch):
    path = token_count.default_path()
    library = token_count.counter(path).library
    monkeypatch.setattr(token_count, "BLOCK_BYTES", 2000)  # several blocks
    rows = [(i, t, "x", 0) for i, t in enumerate([*texts(2), "word " * 5000, None])] + [(None, "null id", "", 0), (3, "again", "", 0), (3, "again", "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens string, n_tokens long")
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_bytes, r.n_tokens) for r in token_count.token_counts(df, path).collect())
    want = sorted(((i if i is not None else -1), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in rows)
    assert got == want
    assert token_count.token_counts(df.limit(0), path).count() == 0
