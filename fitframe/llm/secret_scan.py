"""Secret scans with a random forest against false positives.

Candidates are all values that a word holds: runs of MIN_VALUE or more key
characters with a digit, whatever is glued on, keys of a known prefix, values
assigned inside the word, those of a credential name from LEAST_ASSIGNED
characters on, and passwords of addresses.  A word may give several, also one
inside another.  Each becomes a row of features: length, character classes and their
transitions, coverage by words of the corpus, path marks and the neighbouring
words.  A forest trained on labelled findings scores the candidates.

Dictionary coverage joins the letter runs of distinct candidate values to
document frequencies over the whole corpus.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.llm.common import bounded, keep, table, words

MIN_VALUE = 12           # key characters of a candidate value
LEAST_ASSIGNED = 6       # characters of a value assigned to a credential name
TRAIN_DOCUMENTS = 1500   # documents whose words surround the labelled findings
DICTIONARY_SHARE = 1e-4  # share of documents that a dictionary word stands in ...
DICTIONARY_LEAST = 3     # ... and the least number of them
TREES, DEPTH, SEED = 40, 8, 17
MASK = "[SECRET]"

CREDENTIAL = r"(?i)(pass(?:word|wd|phrase)?|pwd|token|secret|credential|auth|bearer|api_?-?key|access_?-?key|private_?-?key)"
HARMLESS = r"(?i)(example|dummy|sample|placeholder|change_?me|your_|xxxx|test|todo|fake|foo|redacted)"
DIGEST = r"(?i)(commit|sha1|sha256|sha512|md5|checksum|digest|uuid|guid|etag|rev|hash|version|build|card|order|invoice|phone)"
KNOWN = r"(AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-|sk_live_|AIza[A-Za-z0-9_-]{30,}"
EDGES = r"[\"'`,;<>()\[\]{}]"
# Inside a word: a name with its sign, runs of key characters with the name or
# marks before them, assigned values, and user:password@ of an address.
SIGN = r"[\"'`]?(?:=>|:=|==?|:(?!//))[\"'`]?"
NAMED = rf"[A-Za-z0-9_.-]{{1,40}}{SIGN}"
PADDED = r"(?:={1,2}(?![A-Za-z0-9+/_.~=-]))?"
RUN = rf"(?:{NAMED}|[^\s\"'`,;&=:A-Za-z0-9+/_.~-]{{1,3}})?(?=([A-Za-z0-9+/_.~-]{{{MIN_VALUE},}}+{PADDED}))\1"
ASSIGNED = rf"{NAMED}(?=([^\s\"'`,;&=:]++{PADDED}))"
CREDENTIAL_SIGN = CREDENTIAL + rf"[A-Za-z0-9_.-]{{0,40}}{SIGN}"
CREDENTIAL_VALUE = CREDENTIAL + r"[A-Za-z0-9_.-]{0,40}[\"'`]?(?:=>|:=|==?|:(?!//))(?:\"([^\"]+)\"|'([^']+)'|[\"'`]?([^\s\"'`,;&]+))"
USER_PASSWORD = r"://[^\s/:@\"'`,;]*:([^\s/\"'`,;]+)@"
KNOWN_KEY = rf"(?<![A-Za-z0-9])((?:{KNOWN})[A-Za-z0-9_-]*)"


def value_of(word: Column) -> Column:
    """The value in a word: after the last = or : and without quotes."""
    bare = F.regexp_replace(word, rf"^(?:{EDGES})+|(?:{EDGES}|[.!?])+$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"^.*[=:](?=[^=:]+$)", ""), rf"^(?:{EDGES})+", "")


def is_candidate(word: Column, before: Column) -> Column:
    value = value_of(word)
    return ((F.length(word) >= MIN_VALUE) & (F.length(value) >= MIN_VALUE) & value.rlike(r"^[A-Za-z0-9+/_.~!$%&*-]+$")
            & (value.rlike(r"\d") | word.rlike(CREDENTIAL) | before.rlike(CREDENTIAL)))


def values_in(word: Column, before: Column) -> Column:
    """Sorted array of (value, rank, piece): the values that a word holds, each
    with the piece of the word that names it.  Equal values may repeat."""
    near, digit = before.rlike(CREDENTIAL), r"\d"
    spaced = before.rlike(CREDENTIAL + r"[A-Za-z0-9_.-]{0,40}[\"'`]?\s?(?:=>|:=|==?|:)[\"'`]?$")
    whole = value_of(word)
    quoted = F.regexp_extract(word, r"^[\"'`]([^\"'`]+)[\"'`]", 1)
    row = lambda value, rank, piece: F.struct(value.alias("value"), F.lit(rank).alias("rank"), piece.alias("piece"))
    some = lambda test, value, rank: F.when(test, F.array(row(value, rank, word)))

    def all_of(pattern: str, groups: tuple[int, ...], rank: int, fits) -> Column:
        parts = [F.regexp_extract_all(word, F.lit(pattern), F.lit(g)) for g in (0, *groups)]
        zipped = F.arrays_zip(*[p.alias(f"p{i}") for i, p in enumerate(parts)])
        rows = F.transform(zipped, lambda z: row(F.concat(*[z[f"p{i + 1}"] for i in range(len(groups))]), rank, z["p0"]))
        return F.filter(rows, lambda r: fits(r["value"], r["piece"]))

    trimmed = lambda v: F.regexp_replace(v, r"^(?:[.~]+|--+)|(?:[.~]+|--+)$", "")
    runs = F.filter(F.transform(all_of(RUN, (1,), 1, lambda v, p: v.rlike(digit)), lambda r: F.struct(
        trimmed(r["value"]).alias("value"), r["rank"].alias("rank"), r["piece"].alias("piece"))), lambda r: F.length(r["value"]) >= MIN_VALUE)
    assigned = F.transform(all_of(ASSIGNED, (1,), 2, lambda v, p: (F.length(v) >= MIN_VALUE) & (v.rlike(digit) | p.rlike(CREDENTIAL))),
                           lambda r: F.struct(r["value"].alias("value"), r["rank"].alias("rank"), F.concat(r["piece"], r["value"]).alias("piece")))
    long_enough = lambda v, p: F.length(v) >= LEAST_ASSIGNED
    lists = [
        some(is_candidate(word, before), whole, 0),
        some(spaced & (F.length(whole) >= LEAST_ASSIGNED) & ~whole.rlike(r"[\"'`]"), whole, 0),
        some(spaced & (F.length(quoted) >= LEAST_ASSIGNED), quoted, 0),
        F.when(word.rlike(digit), runs), F.when(word.rlike("[=:]"), assigned),
        F.when(word.rlike(CREDENTIAL_SIGN), all_of(CREDENTIAL_VALUE, (2, 3, 4), 3, long_enough)),
        F.when(word.contains("://"), all_of(USER_PASSWORD, (1,), 4, long_enough)),
        F.when(word.rlike(KNOWN), all_of(KNOWN_KEY, (1,), 5, long_enough)),
    ]
    none = F.array().cast("array<struct<value:string,rank:int,piece:string>>")
    return F.array_sort(F.concat(*[F.coalesce(x, none) for x in lists]))


def candidates(docs: DataFrame) -> DataFrame:
    """Rows (id, text_key, pos, word, value, before, after) of (id, text);
    ``word`` is the piece of the word that names the value."""
    def around(a: Column, i: Column, steps: range) -> Column:
        return F.concat_ws(" ", *[F.get(a, i + j) for j in steps])

    # the cheap test comes first: few words are long and hold a digit or sign
    def worth(a: Column, s: Column) -> Column:
        n, last = F.length(s["word"]), F.concat_ws(" ", F.get(a, s["pos"] - 1), F.get(a, s["pos"] - 2))
        return (((n >= LEAST_ASSIGNED + 4) & s["word"].rlike(r"\d|[=:]")) | ((n >= MIN_VALUE) & last.rlike(CREDENTIAL))
                | ((n >= LEAST_ASSIGNED) & F.get(a, s["pos"] - 1).rlike("[=:>\"'`]$") & last.rlike(CREDENTIAL)))

    found = F.transform(F.array(words(F.col("text"))), lambda a: F.transform(
        F.filter(F.transform(a, lambda x, i: F.struct(i.alias("pos"), x.alias("word"))), lambda s: worth(a, s)),
        lambda s: F.struct(s["pos"].alias("pos"), s["word"].alias("word"),
                           around(a, s["pos"], range(-3, 0)).alias("before"), around(a, s["pos"], range(1, 3)).alias("after"))))[0]
    held = (docs.select("id", F.xxhash64("text").alias("text_key"), F.explode(found).alias("c"))
            .select("id", "text_key", "c.pos", "c.before", "c.after", values_in(F.col("c.word"), F.col("c.before")).alias("all")))
    once = F.filter("all", lambda x, i: (i == 0) | (F.get("all", i - 1)["value"] != x["value"]))
    return (held.select("id", "text_key", "pos", "before", "after", F.explode(once).alias("v"))
            .select("id", "text_key", "pos", F.col("v.piece").alias("word"), "v.value", "before", "after"))


def letter_runs(value: Column) -> Column:
    return F.regexp_extract_all(F.lower(value), F.lit(r"\p{L}{3,}"), F.lit(0))


def coverage(values: DataFrame, docs: DataFrame) -> DataFrame:
    """(value, cover): the share of the characters of each distinct value that
    stand in letter runs which are words of the corpus."""
    values = values.select("value").distinct()
    runs = values.select("value", F.explode(letter_runs(F.col("value"))).alias("run"))
    asked = keep(runs.select("run").distinct(), "runs")
    n_docs = docs.count()
    spoken = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(?<![\p{L}\p{N}_=/+-])\p{L}{3,}(?![\p{L}\p{N}_=/+-])"), F.lit(0)))).alias("run"))
    known = (spoken.join(bounded(asked, asked.count()), "run", "left_semi").groupBy("run").count()
             .where((F.col("count") >= DICTIONARY_LEAST) & (F.col("count") >= DICTIONARY_SHARE * n_docs)).select("run"))
    covered = runs.join(known, "run").groupBy("value").agg(F.sum(F.length("run")).alias("chars"))
    return keep(values.join(covered, "value", "left").select(
        "value", (F.coalesce("chars", F.lit(0)) / F.length("value")).alias("cover")), "coverage")


def feature_columns() -> dict[str, Column]:
    v, w = F.col("value"), F.col("word")
    n = F.length(v)
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    flag = lambda c: c.cast("double")
    return {
        "x_len": n.cast("double"), "x_lower": share("[a-z]"), "x_upper": share("[A-Z]"), "x_digit": share(r"\d"),
        "x_other": share("[^A-Za-z0-9]"), "x_vowel": share("(?i)[aeiou]"),
        "x_turns": share("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])"),
        "x_letter_run": F.coalesce(F.array_max(F.transform(letter_runs(v), F.length)), F.lit(0)).cast("double"),
        "x_chars": F.size(F.array_distinct(F.split(v, ""))) / n,
        "x_hex": flag(v.rlike("^[0-9a-f]+$|^[0-9A-F]+$")), "x_number": flag(v.rlike(r"^[\d.+-]+$")),
        "x_known": flag(v.rlike(KNOWN)), "x_cover": F.col("cover").cast("double"),
        "x_slashes": F.regexp_count(w, F.lit(r"[/\\]")).cast("double"), "x_dots": F.regexp_count(w, F.lit(r"\.")).cast("double"),
        "x_url": flag(w.rlike("://|^www\\.|@")), "x_assigned": flag(w.rlike("[=:]") | F.col("before").rlike(r"[=:]$")),
        "x_credential": flag(F.concat_ws(" ", "before", "word").rlike(CREDENTIAL)),
        "x_digest": flag(F.concat_ws(" ", "before", F.regexp_replace(w, "[=:][^=:]*$", " ")).rlike(DIGEST)),
        "x_harmless": flag(v.rlike(HARMLESS)), "x_harmless_near": flag(F.concat_ws(" ", "before", "after").rlike(HARMLESS)),
    }


def featured(rows: DataFrame, cover: DataFrame) -> DataFrame:
    joined = rows.join(cover, "value").select("*", *[c.alias(k) for k, c in feature_columns().items()])
    return joined.fillna(0.0, list(feature_columns()))


def train(findings: DataFrame, cover: DataFrame) -> PipelineModel:
    """Fit the forest on findings (word, value, before, after, label)."""
    made = VectorAssembler(inputCols=list(feature_columns()), outputCol="x_all")
    rows = featured(findings.where(F.col("label").isNotNull()), cover).withColumn("label", F.col("label").cast("double"))
    forest = RandomForestClassifier(featuresCol="x_all", labelCol="label", probabilityCol="x_prob", numTrees=TREES,
                                    maxDepth=DEPTH, seed=SEED)
    model: RandomForestClassificationModel = forest.fit(keep(made.transform(rows).select("x_all", "label"), "findings"))
    return PipelineModel([made, model])


def labelled_findings(docs: DataFrame, n_docs: int = TRAIN_DOCUMENTS) -> DataFrame:
    """Labelled findings where none are given: values of known kind, derived
    from digests of the ids, between words of ``n_docs`` documents (those of
    the least id hash).  Values of credential formats are labelled 1;
    digests, numbers, addresses, file names, paths and placeholders 0.
    """
    total = docs.count()
    least = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # about four times the bound pass the hash filter, whatever the corpus
    picked = (docs.where(least <= F.lit(min(1.0, 4 * n_docs / max(total, 1)))).where(F.size(words(F.col("text"))) >= 8)
              .select("id", words(F.substring("text", 1, 2000)).alias("w")).orderBy(F.xxhash64("id"), "id").limit(n_docs))
    h = lambda salt: F.sha1(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(salt)).cast("binary"))
    mixed = lambda salt: F.regexp_replace(F.base64(F.unhex(F.concat(h(salt), h(salt + "'")))), "[+/=]", "x")
    digits = lambda salt, n: F.rpad(F.regexp_replace(h(salt), "[a-f]", ""), n, "4715903826")
    word = lambda i: F.regexp_replace(F.get("w", F.lit(i)), r"[^\p{L}]", "")
    pick = lambda salt, *names: F.get(F.array(*map(F.lit, names)), F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(names))).cast("int"))
    name = lambda salt: pick(salt, "password", "passwd", "pwd", "secret", "api_key", "token", "auth_token", "access_key")
    cut = lambda c, least, more, salt: F.substr(c, F.lit(1), (F.pmod(F.xxhash64("id", F.lit(salt + "#")), F.lit(more)) + least).cast("int"))
    join = F.concat
    made = [  # (label, word before, word)
        (1, None, join(F.lit("AKIA"), F.substring(F.upper(mixed("a")), 1, 16))),
        (1, None, join(F.lit("ghp_"), F.substring(mixed("b"), 1, 36))),
        (1, None, join(name("c"), F.lit("="), cut(h("c"), 14, 12, "c"))),
        (1, "=", join(F.lit('"'), h("d"), F.lit('"'))),
        (1, ":", cut(mixed("e"), 16, 30, "e")),
        (1, None, join(name("f"), F.lit(":"), cut(mixed("f"), 14, 20, "f"))),
        (1, None, join(name("g"), F.lit("='"), cut(mixed("g"), 14, 20, "g"), F.lit("'"))),
        (1, None, join(name("c8"), F.lit("="), cut(mixed("c8"), 8, 4, "c8"))),
        (1, "=", join(F.lit('"'), cut(mixed("d8"), 8, 4, "d8"), F.lit('"'))),
        (1, None, join(name("e8"), F.lit("="), F.base64(F.unhex(h("e8"))))),
        (1, None, join(name("f8"), F.lit("="), F.substring(mixed("f8"), 1, 6), pick("f9", "@", "#", "^"), F.substring(h("f8"), 1, 7))),
        (1, None, join(F.lit("://app:"), cut(mixed("g8"), 10, 10, "g8"), F.lit("@"))),
        (0, None, join(name("h8"), F.lit("="), pick("h9", "required", "missing", "disabled", "optional", "default"))),
        (0, "=", join(F.lit('"'), word(2), word(3), F.lit('"'))), (0, None, join(name("i8"), F.lit(":"), word(4), word(5))),
        (0, None, join(F.lit("@"), word(1), digits("j8", 2), F.lit("."), word(2), F.lit(".com"))),
        (0, None, digits("h", 16)), (0, "commit", h("i")), (0, "sha1", h("j")), (0, "checksum", join(h("k"), F.substring(h("k2"), 1, 24))),
        (0, None, join(F.lit("sha256:"), h("l"), F.substring(h("l2"), 1, 24))),
        (0, None, F.concat_ws(".", *[F.conv(F.substring(h(f"m{i}"), 1, 2), 16, 10) for i in range(4)])),
        (0, None, F.concat_ws("-", F.substring(h("n"), 1, 8), F.substring(h("n"), 9, 4), F.substring(h("n"), 13, 4), F.substring(h("n"), 17, 4), F.substring(h("n"), 21, 12))),
        (0, None, join(F.lit("https://www."), word(1), F.lit(".com/"), word(2), F.lit("/"), digits("o", 6))),
        (0, None, join(F.lit("/usr/lib/"), word(3), F.lit("/"), word(4), digits("p", 2), F.lit(".so"))),
        (0, None, join(F.lit("IMG_"), digits("q", 8), F.lit("_"), digits("q2", 6), F.lit(".jpg"))),
        (0, None, join(word(1), word(5), word(6), digits("r", 2))),
        (0, None, join(F.lit("v1."), digits("s", 2), F.lit("."), digits("s2", 8), F.lit("-beta"))),
        (0, None, join(name("t"), F.lit("=changeme"), digits("t", 6))), (0, None, join(name("u"), F.lit("=your_"), name("u"), F.lit("_123"))),
        (0, None, join(name("v"), F.lit("="), word(2), word(3), word(4))),
        (0, None, join(F.lit("+1-("), digits("x", 3), F.lit(")"), digits("x2", 9))),
        (0, None, join(F.lit("2024-"), digits("y", 2), F.lit("-"), digits("y2", 2), F.lit("T10:00:00"))),
    ]
    rows = F.array(*[F.struct(
        F.lit(label).alias("label"), w.alias("word"),
        F.concat_ws(" ", F.get("w", F.lit(5)), *([F.lit(b) if b == "commit" or len(b or "") > 1 else name(str(i))] if b else [F.get("w", F.lit(6))]),
                    *([F.lit(b)] if b in ("=", ":") else [])).alias("before"),
        F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(7))).alias("after")) for i, (label, b, w) in enumerate(made)])
    # one of each: the whole value first, else the longest inside the word
    held = picked.select(F.explode(rows).alias("c")).select("c.*", values_in(F.col("c.word"), F.col("c.before")).alias("all"))
    order = lambda x: F.struct((x["rank"] == 0).alias("whole"), F.length(x["value"]).alias("n"), x["value"].alias("value"))
    return held.where(F.size("all") > 0).select("label", "word", F.array_max(F.transform("all", order))["value"].alias("value"), "before", "after")


def scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Candidates of all rows with the forest's verdict: ``(id, text_key, pos,
    word, value, score, is_secret)``, ``pos`` counting words from 0; a word may
    hold several values, ``word`` is the piece of it that names the value.

    ``findings`` are labelled findings (word, value, before, after, label);
    without them, ``labelled_findings`` makes some.  Null and empty texts have
    no candidates.  Repeated rows give repeated candidates; a null id is kept.
    Findings of one label only, or none: that label's verdict, or the one of
    the candidate's kind (a known prefix or an assigned credential).  Other
    columns are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = keep(candidates(src), "candidates")
    taught = keep(labelled_findings(src) if findings is None else findings, "labelled")
    cover = coverage(rows.select("value").unionByName(taught.select("value")), src)
    told = featured(rows, cover)
    seen = sorted(r[0] for r in taught.where(F.col("label").isNotNull()).select("label").distinct().collect())
    if len(seen) == 2:
        scored = train(taught, cover).transform(told).withColumn("score", F.get(vector_to_array("x_prob"), F.lit(1)))
    elif seen:
        scored = told.withColumn("score", F.lit(float(seen[0])))
    else:
        scored = told.withColumn("score", F.greatest("x_known", F.col("x_credential") * F.col("x_assigned")))
    return scored.select("id", "text_key", "pos", "word", "value", "score", (F.col("score") >= 0.5).alias("is_secret"))


def mask(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the secrets of ``found`` replaced by MASK, a value inside
    another after it."""
    hits = keep(found.where("is_secret").groupBy(F.col("id").alias("__id"), F.col("text_key").alias("__key"))
                .agg(F.transform(F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), asc=False),
                                 lambda x: x["value"]).alias("__values")), "secrets")   # the longest first
    size = hits.agg(F.coalesce(F.sum(F.size("__values")), F.lit(0))).first()[0]
    joined = docs.join(bounded(hits, size), docs[id_col].eqNullSafe(F.col("__id"))
                       & (F.xxhash64(docs[text_col]) == F.col("__key")), "left")
    clean = F.when(F.col("__values").isNull(), docs[text_col]).otherwise(
        F.aggregate("__values", docs[text_col], lambda t, v: F.replace(t, v, F.lit(MASK))))
    return joined.select(*[clean.alias(c) if c == text_col else docs[c] for c in docs.columns])


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the candidates of all documents, each with the forest's verdict;
    values are given as SHA-256."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "pos", F.length("value").alias("n_chars"),
                        F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")
