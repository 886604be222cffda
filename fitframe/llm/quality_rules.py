"""Quality rules with adaptive thresholds.

Fixed base rules first.  Then each metric of a text, an integer, must lie
within a fence around the quartiles of its language and source.  Quartiles
come from a mergeable sketch: counts by bucket, exact below 64 and with six
significant bits above, so a quantile is off by at most 1/32 of its value.
Sketches of a source are merged into that of its language and of the corpus;
a group of fewer than MIN_GROUP texts takes the thresholds of the next wider
one.  Merging adds counts: the result does not depend on partitions or order,
and a frequent source is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.llm.common import keep, table, words

MIN_GROUP = 50     # texts a group needs for thresholds of its own
FENCE = 4          # quartile distances beyond the quartile
# metric -> the least distance from the quartile to the fence, so that a group
# without spread does not reject small deviations
SLACK = {"m_word_len": 250, "m_symbols": 100, "m_dup_lines": 200, "m_repeats": 200, "m_upper": 200, "m_marks": 200,
         "m_twice": 100}
LOWER = ("m_word_len",)  # metrics with a fence below as well
SYMBOLS = "#*$%&|<>"
LONGEST_WINDOW = 5


def repeat_words(w: Column, k: int = LONGEST_WINDOW) -> Column:
    """Words of an array that stand in k-word windows found twice or more."""
    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda p, i: F.least(F.lit(k), F.coalesce(F.get(starts, i + 1) - p, F.lit(k)))),
            F.lit(0), lambda s, x: s + x)

    def twice(h: Column) -> Column:
        order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        hits = F.transform(F.array(order), lambda o: F.array_sort(F.transform(F.filter(
            o, lambda s, i: F.get(o, i - 1)["x"].eqNullSafe(s["x"]) | F.get(o, i + 1)["x"].eqNullSafe(s["x"])),
            lambda s: s["i"])))[0]
        return F.transform(F.array(hits), covered)[0]

    windows = F.transform(F.array(w), lambda a: F.when(F.size(a) < k, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(a) - (k - 1)),
                    lambda i: F.xxhash64(*[F.element_at(a, i + j) for j in range(k)]))))[0]
    return F.transform(F.array(windows), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(twice(h)))[0].cast("long")


def text_counts(text: Column) -> dict[str, Column]:
    t = F.coalesce(text, F.lit(""))
    w = words(t)
    per_words = F.transform(F.array(w), lambda a: F.struct(
        F.size(a).cast("long").alias("n"),
        F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + F.length(x)).alias("chars"),
        repeat_words(a).alias("repeats"),
        F.size(F.filter(a, lambda x, i: (i > 0) & (x == F.get(a, i - 1)))).cast("long").alias("twice")))[0]
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    per_lines = F.transform(F.array(lines), lambda a: F.struct(
        F.size(a).cast("long").alias("n"), (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("dup")))[0]
    return {
        "w": per_words, "l": per_lines,
        "symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "marks": (F.length(t) - F.length(F.translate(t, "!?", ""))).cast("long"),
        "upper": F.regexp_count(t, F.lit("[A-ZÀ-ÖØ-Þ]")).cast("long"),
        "letters": F.regexp_count(t, F.lit("[A-Za-zÀ-ÖØ-öø-ÿ]")).cast("long"),
    }


def _per(part: Column, whole: Column, unit: int, added: int) -> Column:
    """Integer rate; ``added`` blank items keep the rates of short texts low."""
    return F.floor(part * unit / (whole + added)).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """Counts, base verdict and metrics of rows (id, lang, source, text)."""
    s = docs.select("id", "lang", "source", *[c.alias(k) for k, c in text_counts(F.col("text")).items()])
    n, ln = F.col("w.n"), F.col("l.n")
    base = s.select(
        "id", "lang", "source", n.alias("n_words"), F.col("w.chars").alias("word_chars"),
        F.col("symbols").alias("n_symbols"), F.col("l.dup").alias("n_dup_lines"), F.col("w.repeats").alias("n_repeat_words"),
        ((n < 10) | (100 * F.col("w.repeats") > 20 * n)).alias("base_failed"),
        _per(F.col("w.chars") + 100, n, 100, 20).alias("m_word_len"),  # 20 words of 5 characters added
        _per(F.col("symbols"), n, 1000, 20).alias("m_symbols"), _per(F.col("l.dup"), ln, 1000, 10).alias("m_dup_lines"),
        _per(F.col("w.repeats"), n, 1000, 20).alias("m_repeats"), _per(F.col("w.twice"), n, 1000, 20).alias("m_twice"),
        _per(F.col("upper"), F.col("letters"), 1000, 100).alias("m_upper"), _per(F.col("marks"), n, 1000, 20).alias("m_marks"))
    return base


def bucket(v: Column) -> Column:
    """Bucket of a non-negative integer: its six leading bits and their place."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return (shift * 64).cast("long") + F.call_function("shiftright", v, shift)


def bucket_top(b: Column) -> Column:
    """Largest value of a bucket."""
    return F.call_function("shiftleft", (b % 64) + 1, F.floor(b / 64).cast("int")) - 1


def sketch(measured: DataFrame) -> DataFrame:
    """Mergeable sketch: counts by (lang, source, metric, bucket) over the
    texts that pass the base rules."""
    stacked = measured.where(~F.col("base_failed")).select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), bucket(F.col(m)).alias("b")) for m in SLACK])).alias("x"))
    return stacked.groupBy("lang", "source", "x.metric", "x.b").agg(F.count("*").alias("n"))


def _quartiles(counts: DataFrame, by: list[str]) -> DataFrame:
    """Per group of ``by``: texts and the quartiles of each metric."""
    merged = counts.groupBy(*by, "metric", "b").agg(F.sum("n").alias("n"))
    # a group has at most 64 x 58 buckets, however many texts
    packed = (merged.groupBy(*by, "metric")
              .agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("b", "n"))).alias("bs")))

    def at(q: int) -> Column:
        """First bucket at which the running count reaches q quarters."""
        state = F.struct(F.lit(0).cast("long").alias("run"), F.lit(None).cast("long").alias("b"))
        return F.aggregate("bs", state, lambda s, x: F.struct(
            (s["run"] + x["n"]).alias("run"),
            F.coalesce(s["b"], F.when(4 * (s["run"] + x["n"]) >= q * F.col("total"), x["b"])).alias("b")),
            lambda s: bucket_top(s["b"]))
    quart = packed.select(*by, "metric", "total", at(1).alias("q1"), at(3).alias("q3"))
    return quart.groupBy(*by).agg(F.max("total").alias("total"), F.map_from_entries(F.collect_list(
        F.struct("metric", F.struct("q1", "q3")))).alias("q"))


def thresholds(counts: DataFrame) -> DataFrame:
    """Quartiles for each (lang, source): its own, or those of the language or
    the corpus where it has fewer than MIN_GROUP texts."""
    own = _quartiles(counts, ["lang", "source"])
    lang = _quartiles(counts, ["lang"]).select(F.col("lang").alias("l_lang"), F.col("total").alias("l_total"), F.col("q").alias("l_q"))
    # one row with two numbers a metric
    corpus = {m: (q["q1"], q["q3"]) for r in _quartiles(counts, []).collect() for m, q in (r["q"] or {}).items()}
    whole = F.create_map(*[x for m, (a, b) in corpus.items() for x in (
        F.lit(m), F.struct(F.lit(a).alias("q1"), F.lit(b).alias("q3")))]) if corpus else F.lit(None)
    wide = own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang"))).withColumn("c_q", whole.cast(own.schema["q"].dataType))
    return wide.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), F.when(
        F.col("total") >= MIN_GROUP, F.col("q")).when(F.col("l_total") >= MIN_GROUP, F.col("l_q"))
        .otherwise(F.col("c_q")).alias("q"))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """Counts and verdict of every row of ``docs``.

    Null and empty texts have no words and fail the base rules.  A null
    language or source is a group like any other.  Repeated rows are each
    judged.  An empty table gives an empty result.  Other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                      F.col(text_col).alias("text"))
    rows = keep(measure(src), "rules")
    limits = keep(thresholds(sketch(rows)), "limits")
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    inside = F.lit(True)
    for m, slack in SLACK.items():
        q1, q3 = F.col("q")[m]["q1"], F.col("q")[m]["q3"]
        reach = F.greatest(FENCE * (q3 - q1), F.lit(slack))
        inside = inside & (F.col(m) <= q3 + reach)
        if m in LOWER:
            inside = inside & (F.col(m) >= q1 - reach)
    return joined.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(inside, F.lit(True))).alias("kept"))


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: rules over all documents."""
    return apply_rules(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The rules in SQL, with the constants of this module."""
    def rate(part, whole, unit, added):
        return f"(({part}) * {unit} // ({whole} + {added}))::BIGINT"

    metrics = {"m_word_len": rate("word_chars + 100", "n_words", 100, 20), "m_symbols": rate("n_symbols", "n_words", 1000, 20),
               "m_dup_lines": rate("n_dup_lines", "n_lines", 1000, 10), "m_repeats": rate("n_repeat_words", "n_words", 1000, 20),
               "m_upper": rate("upper", "letters", 1000, 100), "m_marks": rate("marks", "n_words", 1000, 20),
               "m_twice": rate("twice", "n_words", 1000, 20)}
    without = lambda chars: f"len(t) - len(translate(t, '{chars}', ''))"
    fences = []
    for m, slack in SLACK.items():
        reach = f"greatest({FENCE} * ({m}_q3 - {m}_q1), {slack})"
        fences.append(f"{m} <= {m}_q3 + {reach}" + (f" AND {m} >= {m}_q1 - {reach}" if m in LOWER else ""))

    def quartiles(name, by):
        group = ", ".join([*by, "metric"])
        return f"""
{name}_c AS (SELECT {group}, b, sum(n) AS n FROM sketch GROUP BY {group}, b),
{name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {group} ORDER BY b) AS run, sum(n) OVER (PARTITION BY {group}) AS total FROM {name}_c),
{name}_q AS (SELECT {group}, max(total) AS total, min(b) FILTER (4 * run >= total) AS b1, min(b) FILTER (4 * run >= 3 * total) AS b3
  FROM {name}_r GROUP BY {group})"""
    top = lambda b: f"((({b} % 64) + 1) << ({b} // 64)::INT) - 1"
    chosen = lambda q: f"CASE WHEN o.total >= {MIN_GROUP} THEN o.{q} WHEN l.total >= {MIN_GROUP} THEN l.{q} ELSE c.{q} END"
    wide = ", ".join(f"max({top('b1')}) FILTER (metric = '{m}') AS {m}_q1, max({top('b3')}) FILTER (metric = '{m}') AS {m}_q3" for m in SLACK)
    stacked = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {m} AS v FROM measured WHERE NOT base_failed" for m in SLACK)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
windows AS (SELECT r, i, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
hits AS (SELECT r, unnest(range(i, i + 5)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM hits GROUP BY r),
twins AS (SELECT r, count(*) AS n FROM (SELECT r, w, unnest(range(2, len(w) + 1)) AS i FROM d WHERE len(w) >= 2) WHERE w[i] = w[i - 1] GROUP BY r),
counts AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0)::BIGINT AS word_chars,
    ({without(SYMBOLS)})::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, coalesce(twins.n, 0) AS twice, ({without("!?")}) AS marks,
    len(t) - len(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS upper, len(t) - len(regexp_replace(t, '[A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g')) AS letters
  FROM d LEFT JOIN repeats USING (r) LEFT JOIN twins USING (r)),
measured AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {', '.join(f'{v} AS {k}' for k, v in metrics.items())} FROM counts),
shifted AS (SELECT lang, source, metric, v, greatest(len(bin(v)) - 6, 0) AS s FROM ({stacked})),
sketch AS (SELECT lang, source, metric, s * 64 + (v >> s::INT) AS b, count(*) AS n FROM shifted GROUP BY ALL),
{quartiles('own', ['lang', 'source'])}, {quartiles('lng', ['lang'])}, {quartiles('crp', [])},
limits AS (SELECT o.lang, o.source, o.metric, {chosen('b1')} AS b1, {chosen('b3')} AS b3 FROM own_q o
  JOIN lng_q l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric JOIN crp_q c ON o.metric = c.metric),
wide AS (SELECT lang AS t_lang, source AS t_source, {wide} FROM limits GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE coalesce({' AND '.join(fences)}, true) END AS kept
FROM measured LEFT JOIN wide ON lang IS NOT DISTINCT FROM t_lang AND source IS NOT DISTINCT FROM t_source
"""
