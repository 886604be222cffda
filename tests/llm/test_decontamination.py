from fitframe.llm import decontamination

ITEM = ("A farmer in Texas buys 12 apples and 30 pears from Maria for 5 dollars each, how much does Maria get "
        "from the farmer today?")
OTHER = "A farmer in Kansas buys 17 apples and 44 pears from Julia for 9 dollars each, how much does Julia get from the farmer today?"
MIXED = "A farmer in Kansas buys 17 apples and 44 pears from Julia for 9 dollars each, how much does Peter"


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, "a", 1) for d in docs], "doc_id long, text string, item string, n_covered long"),
            spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, doc_id string"))


def test_copies_templates_and_clean_texts(spark):
    filler = " ".join(f"word{i}" for i in range(50))
    docs, items = frames(spark, [
        (1, f"{filler}. {ITEM} {filler}"), (2, f"{filler}. {OTHER} {filler}"), (3, f"Hello. {ITEM.upper()}"), (4, f"Hello. {MIXED}"),
        (5, "11 12 13 14 15 16 17 18 19 20 21"), (6, None), (7, ""), (8, filler), (9, " ".join(ITEM.split()[:7])), (None, ITEM),
        (1, f"{filler}. {ITEM} {filler}"), (10, "alpha beta gamma delta epsilon"), (11, "alpha beta gamma delta zeta eta")],
        [(1, ITEM), (2, None), (3, ""), (4, "1 2 3 4 5 6 7 8 9 10"), (5, "alpha beta gamma delta epsilon"), (6, "too short"), (1, ITEM)])
    got = {(r.id, r.item): r for r in decontamination.occurrences(docs, items).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 1), (None, 1), (10, 5)}
    assert got[1, 1].exact and not got[2, 1].exact and got[2, 1].n_slots == 7
    # the literal words of document 4 are enough although one name is inconsistent
    assert got[4, 1].n_covered - got[4, 1].n_slots >= decontamination.ENOUGH
    kept = sorted(r.doc_id for r in decontamination.drop_contaminated(docs, items).collect())
    assert kept == [5, 6, 7, 8, 9, 11]
    assert decontamination.drop_contaminated(docs, items).columns == docs.columns


def test_inconsistent_slots_are_no_template(spark):
    item = "Ann has 3 and Bob has 4 so Ann and Bob have 7 in all"
    docs, items = frames(spark, [(1, "x. Joe said that Eve has 5 and Jim has 6 so Eve and Jim have 11 in all"),
                                 (2, "x. so that Eve has 5 and Jim has 6 so Kim and Tom have 11 in all")],
                         [(1, "so that " + item)])
    assert [r.id for r in decontamination.occurrences(docs, items).collect()] == [1]


def test_anchors_lose_nothing(spark, monkeypatch):
    """The same occurrences as when every text is put into template form, on
    given texts whose numbers, names and other words were changed."""
    import random
    import re
    sf, rng = "/root/testdata/sf0.001", random.Random(3)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(900, "Ann has 3 and Bob has 4 so Ann and Bob have 7 in all"), (901, "3 + 4 = 7 , 5 + 6 = 11 , 7 + 8 = 15"),
              (902, "+ - * / + - * /"), (903, ITEM), (904, "Don't (ever) \"quote\" me, she said to Max"), (905, "A 1 b 2 c 3 d 4")]
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()[:60]]
    for _, t in items:
        for way in range(4):
            new = re.sub(r"\d+", lambda m: str(rng.randint(1, 99)), t) if way == 1 else t.upper() if way == 2 else t
            new = " ".join(w + rng.choice(["", ",", ".", "!"]) if way == 3 else w for w in new.split(" "))
            at = rng.randrange(max(1, len(new) // 2))
            texts.append(f"{rng.choice(texts[:60])} {new[at:] if way == 0 else new} {rng.choice(texts[:60])}")
    for with_free in (False, True):  # item 902 has no anchor: then every text is looked at
        docs, marks = frames(spark, list(enumerate(texts)), [i for i in items if with_free or i[0] != 902])
        rows = lambda: sorted(tuple(r) for r in decontamination.occurrences(docs, marks).collect())
        got = rows()
        with monkeypatch.context() as m:
            m.setattr(decontamination, "_with_anchors", lambda src, anchors: src)
            assert got == rows()
        assert len(got) > 3 * len(items) // 2


def test_short_items_word_for_word(spark):
    docs, items = frames(spark, [(1, "He said: define photosynthesis in plants, please."), (2, "x name three noble gases! y"), (3, "name four noble gases"),
                                 (4, "He said yes to it."), (5, "So\n  Yes! \nno"), (6, "pi day"), (7, "Pi day\r"), (8, "define photosynthesis in animals"), (None, "Yes")],
                         [(1, "Define photosynthesis in plants."), (2, "Name three noble gases"), (3, "Yes."), (4, "Pi day"), (5, "Add 3 to 4"), (6, " "), (7, "?!")])
    got = {(r.id, r.item): r.exact for r in decontamination.occurrences(docs, items).collect()}
    assert set(got) == {(1, 1), (2, 2), (5, 3), (6, 4), (7, 4), (None, 3)} and all(got.values())
    kept = sorted(r.doc_id for r in decontamination.drop_contaminated(docs, items).collect())
    assert kept == [3, 4, 8]


def test_very_long_text(spark):
    docs, items = frames(spark, [(1, "filler words here " * 100_000 + ITEM), (2, "filler words here " * 100_000)], [(1, ITEM)])
    assert [(r.id, r.exact) for r in decontamination.occurrences(docs, items).collect()] == [(1, True)]


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, ITEM)], [(1, ITEM)])
    assert decontamination.occurrences(docs.limit(0), items).count() == 0
    assert decontamination.occurrences(docs, items.limit(0)).count() == 0


def test_verbatim_copies_on_the_small_tables(spark):
    """Every plain 8-word match of an item and a document is found, and only those."""
    import re
    sf = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.item_id) for r in decontamination.run_query(spark, sf).collect()}
    grams = {}
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = re.findall(r"\S+", r.text.lower())
        for i in range(len(w) - 7):
            grams.setdefault(tuple(w[i:i + 8]), set()).add(r.item_id)
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = re.findall(r"\S+", (r.text or "").lower())
        for i in range(len(w) - 7):
            want |= {(r.doc_id, item) for item in grams.get(tuple(w[i:i + 8]), ())}
    assert got == want


def test_short_and_dense_items_as_verbatim_copies(spark):
    chain, dates = "3 + 4 = 7 , 5 + 6 = 11 , 7 + 8 = 15", "Anna Berta Carl Dora Emil Franz Gerd"
    docs, items = frames(spark, [(1, "x. What is 12 times 34? y"), (2, f"so {chain} ."), (3, f"List: {dates} end"),
                                 (4, "x. What is 99 times 35? y"), (5, "so 3 + 4 = 7 , 5 + 6 = 12 , 7 + 9 = 15")],
                         [(1, "What is 12 times 34?"), (2, chain), (3, dates)])
    got = {(r.id, r.item): r.exact for r in decontamination.occurrences(docs, items).collect()}
    assert got[1, 1] and got[2, 2] and got[3, 3] and not {i for i, _ in got} & {4}


def test_names_after_any_blank_and_first_words(spark):
    docs, items = frames(spark, [(1, "the next question What is the capital city of France"), (2, "the next question What is the capital city of Spain"),
                                 (3, "x. so when did\nAnna and  Bert see Carl again"), (4, "x. so when did\nEva and  Tim see\nKim again")],
                         [(1, "What is the capital city of France"), (2, "so when did Anna and Bert see Carl again")])
    got = {(r.id, r.item): r.exact for r in decontamination.occurrences(docs, items).collect()}
    assert got == {(1, 1): True, (2, 1): False, (3, 2): True, (4, 2): False}
