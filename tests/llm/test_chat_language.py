import itertools
import zlib

import numpy as np

from fitframe.llm import language_id, quote_linking

SF = "/root/testdata/sf0.01"
FIRST = "Hello there everyone today.\nHow do we sort a list?"
REPLY = "On Monday Ann wrote:\n> How do we sort a list?\nUse sorted for that please.\nIt is stable."
NESTED = "> > How do we sort a list?\n> Use sorted for that please. \nThanks a lot."


def messages(spark, rows):
    return spark.createDataFrame([(*r, "a", 5) for r in rows], "conv_id long, turn long, role string, text string, said string, depth int")


def test_links_across_levels_and_conversations(spark):
    rows = [(1, 0, "user", FIRST), (1, 1, "assistant", REPLY), (1, 2, "user", NESTED), (1, 3, "user", None),
            (2, 0, "user", "> use SORTED for that please\nIn Python?"), (2, 1, "user", ""), (None, 1, "user", "> Thanks a lot.\nx"),
            (1, 2, "user", NESTED), (3, None, "user", "y"), (3, 1, "user", "> nobody said so\nz"), (2, 2, None, "> In Python?\nNo."),
            (4, 0, "user", "> In Python?\nshort quotes stay in their conversation")]
    got = quote_linking.link_quotes(messages(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    place = lambda r: (r.reply_conv, r.reply_turn, r.conversation, r.root_turn, r.depth)
    assert place(by[1, 0]) == (None, None, 1, 0, 0)
    assert place(by[1, 1]) == (1, 0, 1, 0, 1) and by[1, 1].said == "Use sorted for that please.\nIt is stable."
    assert place(by[1, 2]) == (1, 1, 1, 0, 2) and by[1, 2].said == "Thanks a lot." and by[1, 2].quoted_lines == 2
    assert place(by[2, 0]) == (1, 1, 1, 0, 2) and place(by[2, 2]) == (2, 0, 1, 0, 3)
    assert by[1, 3].said == "" and place(by[None, 1])[:2] == (None, None) and place(by[4, 0]) == (None, None, 4, 0, 0)
    assert by[1, 0].said == FIRST and sum((r.conv_id, r.turn) == (1, 2) for r in got) == 2
    order = [r.block for r in quote_linking.formatted(quote_linking.link_quotes(messages(spark, rows))).collect()]
    assert order.index("<|unknown|>\nNo.\n") > order.index("<|user|>\nIn Python?\n") > order.index("<|assistant|>\nUse sorted for that please.\nIt is stable.\n")


def test_long_chains_and_one_original_for_many(spark):
    n = 60
    rows = [(1, i, "u", f"line number {i} of this talk\n" + (f"> line number {i - 1} of this talk" if i else "")) for i in range(n)]
    rows += [(2, i, "u", f"> line number 0 of this talk\nanswer {i}") for i in range(n)]
    got = quote_linking.link_quotes(messages(spark, rows)).collect()
    assert {(r.conv_id, r.turn, r.depth, r.conversation) for r in got} == {(1, i, i, 1) for i in range(n)} | {(2, i, 1, 1) for i in range(n)}
    assert quote_linking.link_quotes(messages(spark, [])).count() == 0


def test_texts_without_quotes_are_unchanged(spark):
    got = {(r.conv_id, r.turn): r.said for r in quote_linking.link_quotes(spark.read.parquet(f"{SF}/conversations.parquet")).collect()}
    want = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    assert got == want


def test_viterbi_is_optimal():
    rng = np.random.default_rng(1)
    texts = [(rng.normal(size=(n, 3)) * 5).astype(np.float32) for n in (0, 1, 5, 6, 2, 7, 0, 7, 3)]

    def value(s, path):
        return sum(s[i, x] for i, x in enumerate(path)) - 4 * sum(a != b for a, b in zip(path, path[1:]))
    for s, labels in zip(texts, language_id.viterbi(texts, 4.0)):
        assert len(labels) == len(s)
        if len(s):
            assert abs(value(s, labels) - max(value(s, p) for p in itertools.product(range(3), repeat=len(s)))) < 1e-3
    assert language_id.viterbi([]) == []


def test_held_out_accuracy(spark):
    got = language_id.run_query(spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/documents.parquet").toPandas(), on="doc_id")
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in zip(got.doc_id, got.held_out))
    held = got[got.held_out & got.text.str.len().gt(40)]
    assert (held.lang_pred == held.lang).mean() > 0.97 and got.score.between(0, 1).all()


def test_spans_scripts_and_edges(spark):
    english, french = "the man and the woman went to the old house", "les hommes et les femmes dans une maison près de chez nous"
    russian = "это было давно и никто не помнит"
    taught = spark.createDataFrame([(english, "en")] * 5 + [(french, "fr")] * 5 + [(russian, "ru")] * 5 + [(None, "fr"), ("x", None)], "text string, lang string")
    model = language_id.train(taught)
    assert model.languages == ["en", "fr", "ru"]
    mixed = f"{english}. {french}. {russian}"
    df = spark.createDataFrame([(1, mixed, "a"), (2, None, "a"), (3, "123 !!", "a"), (4, "никто", "a"), (None, english, "a"), (1, mixed, "a"), (5, english * 3000, "a"), (6, "ქართული", "a")],
                               "doc_id long, text string, score string")
    got = language_id.identify(df, model).collect()
    assert len(got) == 8
    by = {r.doc_id: r for r in got}
    assert [mixed[s.start:s.end] for s in by[1].spans] == [english, french, russian] and [s.lang for s in by[1].spans] == ["en", "fr", "ru"]
    assert (by[2].lang_pred, by[2].score, by[2].spans) == ("und", 0.0, []) and by[3].lang_pred == "und"
    assert by[4].lang_pred == "ru" and by[None].lang_pred == "en" and len(by[5].spans) == 1 and by[6].lang_pred in model.languages
    none = language_id.train(taught.limit(0))
    assert {r.lang_pred for r in language_id.identify(df, none).collect()} == {"und"}
    assert language_id.identify(df.limit(0), model).count() == 0


def test_long_and_mixed_runs_are_scored_whole():
    text = "hello" + "中" * 100 + "Привет " + "é" * 41
    found = language_id.pieces(text)
    assert found == ["hello", "中" * 40, "中" * 40, "中" * 20, "Привет", "é" * 40, "é"]
    assert [text[a:b] for a, b in language_id.piece_places(text)] == found
    model = language_id.LanguageModel(["en", "zh"], np.zeros((2, language_id.BUCKETS)),
                                      {"Latin": np.array([True, False]), "Han": np.array([False, True])})
    assert language_id.Labeller(model).label(["hello" + "中" * 100])[0][1].tolist() == [0, 1, 1, 1]


def test_more_languages_than_a_byte_holds():
    scores = np.full((4, 300), -30, np.float32)
    scores[[0, 1, 2, 3], [290, 290, 140, 140]] = 0
    assert language_id.viterbi([scores])[0].tolist() == [290, 290, 140, 140]


def test_number_signs_are_no_letters_and_marks_stay_in_words(spark):
    model = language_id.train(spark.createDataFrame([("the man went home", "en")] * 3 + [("हिन्दी में लिखा हुआ", "hi")] * 3, "text string, lang string"))
    df = spark.createDataFrame([(1, "½ ²"), (2, "Ⅳ 12"), (3, "①②"), (4, "हिन्दी ½"), (5, "home²"), (6, "\u0301\u0302")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(df, model).collect()}
    assert all((got[i].lang_pred, got[i].score, got[i].spans) == ("und", 0.0, []) for i in (1, 2, 3, 6))
    assert got[4].lang_pred == "hi" and [(s.start, s.end) for s in got[4].spans] == [(0, 6)] and got[5].lang_pred == "en"
    assert language_id.pieces("हिन्दी ½ e\u0301te\u0301 x²y") == ["हिन्दी", "e\u0301te\u0301", "x", "y"]
    assert language_id.n_letters("e\u0301te\u0301") == 3
