"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, capitalised words inside a sentence
and units after a number turn into typed placeholders, other words lose case
and outer punctuation.  Two more forms stand beside the template: one with
names as words, and the plain words without any placeholder, in which windows
need no literals.  Windows of WINDOW template tokens are hashed and
joined between documents and benchmark items.  Matches of one item on one
diagonal (the same shift between item and document) form an occurrence.  Its
slots, the words behind the placeholders, must map one to one: then it is an
exact copy or the same question with other parameters.

Few documents hold any window, and a window needs its anchor: two neighbouring
literal words of it, the longest ones.  Texts are split and the pairs of
neighbouring words hashed once; only texts with an anchor of some window are
put into template form.  Nothing is lost by that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.functions.sizing import measure
from fitframe.llm.common import SEPARATORS, bounded, keep, table

WINDOW = 8         # template tokens; an item of 3 to 7 tokens is one window
SHORTEST = 5       # words of an item that is looked for as a template
SHORTEST_RUN = 3   # shorter items must be a line of their own
LITERALS = 4       # literal tokens that a window of the template forms needs
ENOUGH = 13        # covered tokens, or half of the item, make an occurrence

NUM, NAME, UNIT = "\u0001", "\u0002", "\u0003"
# units that count after a number
UNITS = ("kg", "g", "mg", "t", "lb", "oz", "km", "m", "cm", "mm", "ft", "in", "mi", "miles", "meters", "metres", "l", "ml",
         "s", "ms", "min", "h", "hours", "minutes", "seconds", "days", "weeks", "months", "years", "mph", "kmh", "hz", "w",
         "kw", "v", "a", "j", "n", "pa", "k", "usd", "eur", "gbp", "dollars", "euros", "cents", "percent", "degrees")


NUMBER = r"(?<![\p{L}\p{N}])[+-]?\d+(?:[.,:/-]\d+)*%?"


def _stripped(t: Column) -> Column:
    t = F.regexp_replace(t, r"(?<!\S)[\"'(\[{]+(?=\S)", "")
    return F.lower(F.regexp_replace(t, r"(?<=\S)[.,;:!?\"')\]}]+(?!\S)", ""))


def _clean(text: Column) -> Column:
    """Any blank counts as one space."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "[\u0001-\u0003]", "?"), SEPARATORS, " ")


def canonical(text: Column) -> Column:
    """The text with placeholders, lower-cased, outer punctuation removed;
    word by word aligned with the text."""
    t = F.regexp_replace(_clean(text), NUMBER, NUM)
    t = F.regexp_replace(t, rf"(?i)(?<={NUM} ?)(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", UNIT)
    t = F.regexp_replace(t, rf"[$€£](?={NUM})", UNIT)
    return _stripped(F.regexp_replace(t, r"(?<=[^\s.!?:;] )\p{Lu}\p{Ll}+(?!\p{L})", NAME))


def plain(text: Column) -> Column:
    """The text without placeholders, else as ``canonical``."""
    return _stripped(_clean(text))


def with_names(tokens: Column, words: Column) -> Column:
    """Template tokens with the names as words; ``words`` are the plain ones."""
    return F.zip_with(tokens, words, lambda a, b: F.when(a.contains(NAME), F.regexp_replace(b, NUMBER, NUM)).otherwise(a))


def _split(t: Column) -> Column:
    return F.filter(F.split(t, SEPARATORS), lambda x: x != "")


WINDOW_TYPE = "array<struct<k:int,pos:int,h:bigint>>"


def _hashed(h: Column, k: int, places: Column) -> Column:
    return F.transform(places, lambda i: F.struct(
        F.lit(k).alias("k"), i.alias("pos"), F.xxhash64(F.lit(k), *[F.get(h, i + j) for j in range(k)]).alias("h")))


def windows(tokens: Column, lengths: list[int]) -> Column:
    """Array of (k, pos, h): the windows of these lengths at every position."""
    hashes = F.transform(F.array(F.transform(tokens, lambda x: F.xxhash64(x))), lambda h: F.concat(*[
        F.when(F.size(h) < k, F.array().cast(WINDOW_TYPE)).otherwise(_hashed(h, k, F.sequence(F.lit(0), F.size(h) - k)))
        for k in lengths]))
    return hashes[0]


def other_windows(tokens: Column, base: Column, lengths: list[int]) -> Column:
    """The windows of ``tokens`` that differ from those of ``base``."""
    changed = F.filter(F.transform(F.zip_with(tokens, base, lambda a, b: a != b), lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    both = F.transform(F.array(F.struct(F.transform(tokens, lambda x: F.xxhash64(x)).alias("h"), changed.alias("at"))), lambda s: F.concat(*[
        F.when((F.size(s["h"]) < k) | (F.size(s["at"]) == 0), F.array().cast(WINDOW_TYPE)).otherwise(_hashed(s["h"], k, F.array_distinct(
            F.flatten(F.transform(s["at"], lambda p: F.sequence(F.greatest(F.lit(0), F.least(p - (k - 1), F.size(s["h"]) - k)), F.least(p, F.size(s["h"]) - k)))))))
        for k in lengths]))
    return both[0]


# Splits a text into words for anchors: all ASCII but letters and digits.
ANCHOR_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _anchor_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), ANCHOR_SEPARATORS), lambda x: x != "")


def anchor_of(part: Column) -> Column:
    """``(h, pair)``: hash of the longest two neighbouring literal words of the
    tokens ``part``, else of its longest literal word; null without any.
    Outer punctuation and case, which forms strip, are no part of an anchor."""
    cores = F.transform(part, lambda x: F.when(~x.rlike("[\u0001-\u0003]"), _anchor_words(x)))
    pairs = F.zip_with(cores, F.slice(cores, 2, F.greatest(F.size(cores), F.lit(1))), lambda a, b: F.when(
        (F.size(a) > 0) & (F.size(b) > 0), F.struct((F.length(F.element_at(a, -1)) + F.length(F.get(b, 0))).alias("n"),
                                                  F.xxhash64(F.element_at(a, -1), F.get(b, 0)).alias("h"))))
    alone = F.transform(cores, lambda a: F.when(F.size(a) > 0, F.struct(F.length(F.get(a, 0)).alias("n"), F.xxhash64(F.get(a, 0)).alias("h"))))
    best = lambda found, pair: F.when(F.array_max(found).isNotNull(), F.struct(F.array_max(found)["h"].alias("h"), F.lit(pair).alias("pair")))
    return F.coalesce(best(pairs, True), best(alone, False))


def _with_anchors(src: DataFrame, anchors: DataFrame) -> DataFrame:
    """The rows of ``src(id, text, text_key)`` whose text has one of the
    ``anchors(anchor)``; a null one stands for every text."""
    n, free, words_alone = anchors.agg(F.count("anchor"), F.count(F.when(F.col("anchor").isNull(), 1)),
                                       F.count(F.when(~F.col("anchor.pair"), 1))).first()
    if free:
        return src
    words = src.select("id", "text_key", F.split(F.lower(F.coalesce("text", F.lit(""))), ANCHOR_SEPARATORS).alias("w"))
    hashes = F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    if words_alone:
        hashes = F.concat(hashes, F.transform("w", lambda a: F.xxhash64(a)))
    hit = (words.select("id", "text_key", F.explode(hashes).alias("h")).join(bounded(anchors.select("anchor.h").distinct(), n), "h", "left_semi")
           .select(F.col("id").alias("c_id"), F.col("text_key").alias("c_key")).distinct())
    hit = keep(hit, "anchored")
    return src.join(bounded(hit, hit.count()), F.col("id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key")), "left_semi")


def _line_items(src: DataFrame, benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Occurrences of the items of fewer than SHORTEST_RUN words: a line of a
    text that is nothing else."""
    lines = lambda c: F.array_join(_split(plain(c)), " ")
    short = (benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("t")).dropna().distinct()
             .select("item", lines(F.col("t")).alias("line"), F.size(_split(F.col("t"))).alias("len"))
             .where((F.col("len") > 0) & (F.col("len") < SHORTEST_RUN)).distinct())
    short = keep(short, "line-items")
    if short.isEmpty():
        return None
    own = (src.select("id", "text_key", F.explode(F.array_distinct(F.split("text", "\n"))).alias("l"))
           .where(F.size(_split(F.col("l"))) < SHORTEST_RUN).select("id", "text_key", lines(F.col("l")).alias("line")))
    return (own.join(measure(short).for_join(), "line").select("id", "text_key", "item", F.col("len").alias("n_covered"), F.lit(0).alias("n_slots"), F.lit(True).alias("exact"))
            .distinct())


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Items with the tokens of their forms: ``tokens``, with names as words
    (``worded``), with the first word as inside a sentence (``inner``), and
    the plain words."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("t")).dropna().distinct()
    inner = _split(canonical(F.concat(F.lit("x "), F.ltrim("t"))))
    items = items.select("item", F.xxhash64("t").alias("item_key"), _split(canonical(F.col("t"))).alias("tokens"),
                         _split(plain(F.col("t"))).alias("plain"), F.slice(inner, 2, F.greatest(F.size(inner), F.lit(1))).alias("inner"),
                         _split(F.col("t")).alias("raw"))
    return items.withColumn("worded", with_names(F.col("tokens"), F.col("plain"))).withColumn(
        "len", F.size("tokens")).where(F.col("len") >= SHORTEST_RUN)


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id, text_key, item, n_covered, n_slots, exact)``: the benchmark
    items that stand in documents, one row per document, text and item.

    Null and empty texts and items never match.  Items of 3 and 4 words match
    word for word only, shorter ones as a line of their own.  Repeated rows of
    one id and text give one row.  A null id is kept.  Items may repeat.  Empty tables give an empty result,
    and other columns are not read.
    """
    items = keep(_items(benchmark, item_col, item_text_col), "items")
    lengths = sorted(r[0] for r in items.select(F.least("len", F.lit(WINDOW))).distinct().collect()) or [WINDOW]
    is_slot = lambda x: x.rlike("[\u0001-\u0003]")
    form = lambda c, literals: F.struct(F.col(c).alias("tokens"), F.lit(literals).alias("literals"))
    forms = (items.select("item", "item_key", "len", F.explode(F.array(*[form(c, LITERALS) for c in ("tokens", "worded", "inner")], form("plain", 0))).alias("f"))
             .where((F.col("len") >= SHORTEST) | (F.col("f.literals") == 0)))
    wanted = (forms.select("item", "item_key", "len", "f.tokens", "f.literals", F.explode(windows(F.col("f.tokens"), lengths)).alias("w"))
              .withColumn("k", F.least("len", F.lit(WINDOW)))
              .withColumn("part", F.expr("slice(tokens, w.pos + 1, k)"))
              .where("w.k = k")
              .where(F.size(F.filter("part", lambda x: ~is_slot(x))) >= F.col("literals"))
              .select("item", "item_key", F.col("w.pos").alias("ipos"), F.col("w.h").alias("h"), anchor_of(F.col("part")).alias("anchor")))
    wanted = keep(wanted.distinct(), "wanted")

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_key"))
    near = _with_anchors(src, wanted.select("anchor").distinct())
    told = (near.select("id", "text_key", _split(canonical(F.col("text"))).alias("tokens"), _split(plain(F.col("text"))).alias("plain"))
            .withColumn("worded", with_names(F.col("tokens"), F.col("plain"))))
    every = told.select("id", "text_key", F.explode(F.concat(
        windows(F.col("tokens"), lengths), other_windows(F.col("worded"), F.col("tokens"), lengths),
        other_windows(F.col("plain"), F.col("worded"), lengths))).alias("w"))
    hits = every.select("id", "text_key", "w.pos", "w.h").join(measure(wanted.drop("anchor").distinct()).for_join(), "h")
    k = F.least("len", F.lit(WINDOW))
    runs = (hits.groupBy("id", "text_key", "item", "item_key", (F.col("pos") - F.col("ipos")).alias("shift"))
            .agg(F.array_sort(F.collect_set("ipos")).alias("at"))   # at most one entry per word of the item
            .join(items.select("item", "item_key", "tokens", "inner", "raw", "len"), ["item", "item_key"])
            .withColumn("covered", F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + k - 1)))))
            .withColumn("n_covered", F.size("covered"))
            .where((F.col("n_covered") >= ENOUGH) | (2 * F.col("n_covered") >= F.col("len"))))
    # a first word that is a name inside a sentence must fit too
    runs = keep(runs.withColumn("slots", F.filter("covered", lambda p: is_slot(F.get("tokens", p)) | is_slot(F.get("inner", p))))
                .withColumn("n_slots", F.size(F.filter("slots", lambda p: is_slot(F.get("tokens", p)))))
                .select("id", "text_key", "item", "shift", "n_covered", "raw", "slots", "n_slots"), "runs")

    # the words behind the slots, of those documents that have some
    asked = runs.where(F.size("slots") > 0).select("id", "text_key").distinct()
    behind = (src.join(bounded(asked.select(F.col("id").alias("a_id"), F.col("text_key").alias("a_key")), asked.count()),
                      F.col("id").eqNullSafe(F.col("a_id")) & (F.col("text_key") == F.col("a_key")), "left_semi")
             .select(F.col("id").alias("d_id"), F.col("text_key").alias("d_key"), _split(F.col("text")).alias("words")).distinct())
    both = runs.join(behind, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("text_key") == F.col("d_key")), "left")
    bare = lambda x: F.regexp_replace(F.lower(x), r"^[\"'(\[{]+|[.,;:!?\"')\]}]+$", "")
    pairs = F.array_distinct(F.transform("slots", lambda p: F.struct(
        bare(F.get("raw", p)).alias("a"), bare(F.get("words", p + F.col("shift"))).alias("b"))))
    judged = both.select("id", "text_key", "item", "n_covered", "n_slots", pairs.alias("pairs"))
    one_to_one = ((F.size("pairs") == F.size(F.array_distinct(F.col("pairs.a"))))
                  & (F.size("pairs") == F.size(F.array_distinct(F.col("pairs.b")))))
    # without consistent slots, the literal words alone must be enough
    good = judged.where((F.col("n_slots") == 0) | one_to_one | (F.col("n_covered") - F.col("n_slots") >= ENOUGH))
    exact = F.forall("pairs", lambda x: x["a"] == x["b"])
    best = F.max(F.struct("n_covered", exact.alias("exact"), "n_slots"))
    found = (good.groupBy("id", "text_key", "item").agg(best.alias("b"))
             .select("id", "text_key", "item", "b.n_covered", "b.n_slots", "b.exact"))
    as_lines = _line_items(src, benchmark, item_col, item_text_col)
    return found if as_lines is None else found.unionByName(as_lines)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    hit = keep(occurrences(docs, benchmark, id_col, text_col).select(
        F.col("id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "contaminated")
    return docs.join(bounded(hit, hit.count()), docs[id_col].eqNullSafe(F.col("__id"))
                     & (F.xxhash64(docs[text_col]) == F.col("__key")), "left_anti")


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: every document against every benchmark item."""
    found = occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_covered", "n_slots", "exact")
