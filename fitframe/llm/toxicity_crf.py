"""Toxic spans by a linear-chain conditional random field.

Labels mark whole documents.  Labelled tokens come from them: a key (a word,
or its first letters) that occurs in significantly more toxic than clean
documents, and hardly in clean ones, marks the tokens of toxic documents that
have it; all other tokens are clean.  Counts are of distinct texts, over all
labelled documents that may teach.

The field has two labels.  A token's evidence is the sum of the weights of its
keys; transitions let spans go on.  As there are two labels, the forward and
the backward messages are one log ratio each, and all documents of a batch are
solved together: ratios are computed from the ratios of their neighbours until
none changes, which takes as many rounds as a span is long.  The marginals
give the offending offsets, and through a logistic curve over the greatest
marginal and the expected number of toxic tokens the score of the document.

The weights are fitted on the driver on a bounded sample (TRAIN_DOCUMENTS per
class, TRAIN_CHARS in all); a model has at most MAX_KEYS weights.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.llm.common import bounded, keep, small_batches, table

PREFIXES = (4, 5, 6)        # letters
LEAST_SHARE = 0.001         # of the toxic texts have a key, at least
FEATURE_G2 = 10.83          # likelihood ratio of a key with a weight (chance 1 in 1,000)
LABEL_STRENGTH = 3.0        # times the logarithm of the keys tried: likelihood ratio of a key that labels tokens
LEAST_TOXIC = 0.9           # share of toxic texts among those with a key that labels tokens
MAX_KEYS = 20_000
ROUNDS = 4                  # searches for keys, each in the toxic texts not yet explained
TRAIN_DOCUMENTS = 1_000
TRAIN_CHARS = 2_000_000
RIDGE = 0.05                # on the weights
DOCUMENT_RIDGE = 1.0        # on the curve of the document score
FILTER_BITS = 20            # size of the key filter: 2^20 flags
FLUSH_KEYS = 300_000        # keys a task counts before it sends them on
CACHE_WORDS = 500_000
SOLVE_WORDS = 200_000       # words solved together
LIMIT = 300.0               # log ratios beyond are as good as certain
SPAN = 0.5                  # least marginal of a token of a span
_RUN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_WORD = re.compile(r"\S+")
_MARKS = ".,;:!?()\"'"   # around words; all other marks are left to _RUN
# Thai, Lao, Han, Kana and the like stand without blanks: pairs of letters are keys
_UNSPACED = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-鿿\U00020000-\U0003ffff]")


def keys_of(word: str) -> list[str]:
    """Keys of what stands between two blanks."""
    lower = word.lower().strip(_MARKS)
    runs = (lower,) if lower.isalpha() else _RUN.findall(lower)
    found = []
    for run in runs:
        found.append("=" + run)
        found += ["^" + run[:k] for k in PREFIXES if len(run) >= k]
        if not run.isascii() and _UNSPACED.search(run):
            found += ["~" + run[i:i + 2] for i in range(len(run) - 1)]
    return found


class _Memo(dict):
    """Results by word; emptied when full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[word] = self.make(word)
        return got


def _bucket(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(1 << FILTER_BITS))


def document_counts(texts: DataFrame, flags: bytes | None = None, told: frozenset[str] = frozenset()) -> DataFrame:
    """``(key, n)``: in how many rows of ``texts(text)`` each key occurs, the
    key "" standing for the rows themselves.  With ``flags`` only keys whose
    bucket is flagged count; rows that hold a key of ``told`` are left out."""
    def count(batches):
        from zlib import crc32

        def wanted(word):
            found = keys_of(word)
            return found if flags is None else [k for k in found if flags[crc32(k.encode("utf-8", "surrogatepass")) & ((1 << FILTER_BITS) - 1)]]

        memo, counts = _Memo(wanted), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["key", "n"])
        for batch in batches:
            for text in batch.column(0):
                seen = {""}
                for word in set((text.as_py() or "").split()):
                    seen.update(memo[word])
                if told.isdisjoint(seen):
                    counts.update(seen)
                if len(counts) >= FLUSH_KEYS:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return texts.select("text").mapInArrow(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


def context_counts(texts: DataFrame, keys: list[str]) -> dict[str, int]:
    """In how many different surroundings (the word before and the word after)
    each key stands.  Passages that documents copy from each other count once,
    however many copies, near copies included, there are."""
    number = {k: i for i, k in enumerate(keys)}

    def contexts(batches):
        from zlib import crc32
        memo, seen = _Memo(lambda word: [number[k] for k in keys_of(word) if k in number]), set()

        def out():
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.int32()), pa.array([c for _, c in seen], pa.int64())], ["key", "context"])
        for batch in batches:
            for text in batch.column(0):
                split = ["", *(text.as_py() or "").split(), ""]
                for i in range(1, len(split) - 1):
                    found = memo[split[i]]
                    if found:
                        context = crc32(f"{split[i - 1]} {split[i + 1]}".encode("utf-8", "surrogatepass"))
                        seen.update((k, context) for k in found)
                if len(seen) >= FLUSH_KEYS:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    got = texts.select("text").mapInArrow(contexts, "key int, context long").distinct().groupBy("key").count().collect()
    return {keys[r["key"]]: r["count"] for r in got}


def likelihood_ratio(toxic: float, clean: float, share: float) -> float:
    """G2 of a key in so many toxic and clean texts, 0 if it is not more
    frequent in toxic ones than their ``share`` of all."""
    n = toxic + clean
    if toxic <= n * share:
        return 0.0
    return 2 * (toxic * math.log(toxic / (n * share)) + (clean * math.log(clean / (n * (1 - share))) if clean else 0.0))


def toxic_keys(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int) -> dict[str, bool]:
    """Keys tied to toxic texts, and whether they label tokens.

    Each round compares the toxic texts that no labelling key explains yet
    with all clean ones, so that the keys of a rare language or topic stand
    out once the frequent ones are told.  To label, a key counts for at most
    as many toxic texts as it has surroundings in them.  At most MAX_KEYS, of the
    highest likelihood ratios of each round."""
    first = keep(document_counts(toxic).where(F.col("n") >= max(2, LEAST_SHARE * n_toxic)), "toxic-keys")
    flags = bytearray(1 << FILTER_BITS)
    for r in first.where("key <> ''").select(_bucket(F.col("key")).alias("b")).distinct().toLocalIterator():
        flags[r["b"]] = 1
    other = keep(document_counts(clean, bytes(flags)).join(first.select("key"), "key"), "clean-keys").select("key", F.col("n").alias("clean"))
    keys, found = {}, first
    for _ in range(ROUNDS):
        size = found.where("key = ''").first()
        if size is None:
            break
        n_left = size["n"]
        share = n_left / (n_left + n_clean)
        least = max(2, LEAST_SHARE * n_left, FEATURE_G2 / (2 * math.log(1 / share)))
        tried = found.where((F.col("key") != "") & (F.col("n") >= least))
        both = tried.join(other, "key", "left").select("key", F.col("n").cast("double").alias("toxic"), F.coalesce("clean", F.lit(0)).cast("double").alias("clean"))
        n = F.col("toxic") + F.col("clean")
        g2 = 2 * (F.col("toxic") * F.log(F.col("toxic") / (n * share)) +
                  F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - share)))).otherwise(0.0))
        label_g2 = LABEL_STRENGTH * math.log(max(tried.count(), 2))  # as many keys were tried
        tied = (both.withColumn("g2", g2).where((F.col("toxic") > n * share) & (F.col("g2") >= FEATURE_G2))
                .orderBy(F.desc("g2"), "key").limit(MAX_KEYS).collect())
        stands_out = lambda n, clean: likelihood_ratio(n, clean, share) >= label_g2 and n >= LEAST_TOXIC * (n + clean)
        contexts = context_counts(toxic, [r["key"] for r in tied if stands_out(r["toxic"], r["clean"])])
        new = False
        for r in tied:
            if len(keys) < MAX_KEYS or r["key"] in keys:
                labels = r["key"] in contexts and stands_out(min(r["toxic"], contexts[r["key"]]), r["clean"])
                new = new or labels and not keys.get(r["key"], False)
                keys[r["key"]] = keys.get(r["key"], False) or labels
        if not new:
            break
        found = keep(document_counts(toxic, told=frozenset(k for k, y in keys.items() if y)), "unexplained-keys")
    return keys


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def messages(e: np.ndarray, first: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Log ratios ``r`` of a chain: ``r = e`` where ``first``, else
    ``r = e + log((exp(move[0]) + exp(move[2] + r')) / (1 + exp(move[1] + r')))``
    with the ratio r' before it.  Solved for all places at once; only places
    whose neighbour changed are computed again."""
    come, leave, stay = np.exp(move)

    def after(ratio):
        x = np.exp(np.clip(ratio, -LIMIT, LIMIT))
        return np.log((come + stay * x) / (1 + leave * x))

    # most tokens have the same evidence: begin with the ratio that repeats it
    usual = common = float(np.median(e)) if len(e) else 0.0
    for _ in range(500):
        usual, before = common + float(after(usual)), usual
        if usual == before:
            break
    r = np.where(first, e, e + float(after(usual)))
    open_at = np.flatnonzero(~first)
    open_at = open_at[np.abs(r[open_at - 1] - usual) > 1e-11]
    while len(open_at):
        new = e[open_at] + after(r[open_at - 1])
        changed = open_at[np.abs(new - r[open_at]) > 1e-11]
        r[open_at] = new
        following = changed + 1
        following = following[following < len(e)]
        open_at = following[~first[following]]
    return r


@dataclass
class Field:
    """Weights of the keys, and [bias, 0->1, 1->0, 1->1]."""

    keys: dict[str, int]
    weights: np.ndarray
    shared: np.ndarray
    curve: np.ndarray          # of the document score: constant, greatest marginal, expected tokens
    prior: float = 0.0         # the score without any key

    def __post_init__(self):
        self.bias = float(self.shared[0])

    def evidence(self, word: str) -> float:
        at = {self.keys[k] for k in keys_of(word) if k in self.keys}
        return float(self.shared[0] + sum(self.weights[i] for i in sorted(at))) if at else self.bias

    def marginals(self, e: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds that each token is toxic."""
        return _odds(e, first, self.shared)[0]


def _odds(e, first, shared):
    """Log odds of the marginals, forward ratios, and backward ratios with the
    evidence of their token."""
    _, t01, t10, t11 = shared
    r = messages(e + t01 * first, first, np.array([t01, t10, t11]))  # a text begins as after a clean token
    last = np.roll(first, -1)
    # backwards, the ratio u = e + q; transitions change sides
    u = messages(e[::-1], last[::-1], np.array([t10, t01, t11]))[::-1]
    return r + u - e, r, u


def _loss(params, n_keys, owner, key, first, y, weight_of_ridge=RIDGE):
    """Negative log likelihood of the labels and its gradient."""
    n = len(first)
    w, shared = params[:n_keys], params[n_keys:]
    e = shared[0] + np.bincount(owner, weights=w[key], minlength=n)
    odds, r, u = _odds(e, first, shared)
    _, t01, t10, t11 = shared
    p = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
    nxt = np.flatnonzero(~first)      # places with a place before them
    a, b = r[nxt - 1], u[nxt]
    a1, b1 = np.exp(np.clip(a, -LIMIT, LIMIT)), np.exp(np.clip(b, -LIMIT, LIMIT))
    into, out, on = np.exp(t01) * b1, np.exp(t10) * a1, np.exp(t11) * a1 * b1
    z = 1 + into + out + on
    y0, y1 = y[nxt - 1], y[nxt]
    lasts = np.flatnonzero(np.roll(first, -1))
    log_z = np.log1p(out).sum() + _softplus(r[lasts]).sum()
    told = (y * e).sum() + t01 * (y[first].sum() + ((1 - y0) * y1).sum()) + t10 * (y0 * (1 - y1)).sum() + t11 * (y0 * y1).sum()
    gap = p - y
    grad = np.empty_like(params)
    grad[:n_keys] = np.bincount(key, weights=gap[owner], minlength=n_keys)
    grad[n_keys:] = [gap.sum(), gap[first].sum() + (into / z).sum() - ((1 - y0) * y1).sum(), (out / z).sum() - (y0 * (1 - y1)).sum(),
                     (on / z).sum() - (y0 * y1).sum()]
    ridge = np.full(len(params), weight_of_ridge)
    ridge[n_keys] = 1e-4  # the bias is free
    return log_z - told + (ridge * params ** 2).sum() / 2, grad + ridge * params


def minimise(loss, x: np.ndarray, rounds: int = 50, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with a halving line search."""
    f, g = loss(x)
    past = []
    for _ in range(rounds):
        d, alphas = -g, []
        for s, t in reversed(past):
            alphas.append((s @ d) / (s @ t))
            d = d - alphas[-1] * t
        if past:
            s, t = past[-1]
            d = d * ((s @ t) / (t @ t))
        else:
            d = d / max(np.abs(g).max(), 1.0)
        for (s, t), alpha in zip(past, reversed(alphas)):
            d = d + (alpha - (t @ d) / (s @ t)) * s
        slope, size = g @ d, 1.0
        for _ in range(30):
            f1, g1 = loss(x + size * d)
            if f1 <= f + 1e-4 * size * slope:
                break
            size /= 2
        else:
            return x
        s, t = size * d, g1 - g
        if s @ t > 1e-12:
            past = [*past, (s, t)][-memory:]
        done = abs(f - f1) <= 1e-6 * max(abs(f), 1.0)
        x, f, g = x + s, f1, g1
        if done:
            break
    return x


def _encoded(rows: DataFrame, keys: dict[str, int], labelling: set[int]) -> DataFrame:
    """Per row of ``rows(label, text)``: label, words, and the places, key
    numbers and labelled places of its tokens."""
    def encode(batches):
        memo = _Memo(lambda word: sorted({keys[k] for k in keys_of(word) if k in keys}))
        for batch in batches:
            out = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                split = (text.as_py() or "").split()
                at, of, toxic = [], [], []
                for i, word in enumerate(split):
                    found = memo[word]
                    if found:
                        at += [i] * len(found)
                        of += found
                        if label == 1 and not labelling.isdisjoint(found):
                            toxic.append(i)
                out.append((label, len(split), at, of, toxic))
            if out:
                label, n, at, of, toxic = zip(*out)
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(n, pa.int32()), pa.array(at, ints), pa.array(of, ints), pa.array(toxic, ints)],
                                                 ["label", "n", "at", "of", "toxic"])

    return rows.select(F.col("label").cast("int"), "text").mapInArrow(encode, "label int, n int, at array<int>, of array<int>, toxic array<int>")


def _summary(odds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document: 1, its greatest log odds, log(1 + expected toxic tokens)."""
    starts = np.flatnonzero(first)
    p = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
    most = np.maximum.reduceat(odds, starts) if len(starts) else np.zeros(0)
    total = np.add.reduceat(np.where(p > 0.01, p, 0.0), starts) if len(starts) else np.zeros(0)
    return np.stack([np.ones(len(starts)), np.clip(most, -12, 12), np.log1p(total)], axis=1)


_NO_TOKENS = np.array([1.0, -12.0, 0.0])


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    c = np.zeros(x.shape[1])
    penalty = np.diag([0.0] + [DOCUMENT_RIDGE] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(c))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - penalty @ c)
        c = c + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return c


def fit(docs: DataFrame, taught: DataFrame) -> Field:
    """Learn from ``docs(id, text, text_key)`` and ``taught(id, label)``."""
    nothing = Field({}, np.zeros(0), np.zeros(4), np.zeros(3))
    labelled = keep(docs.select("id", "text_key").join(bounded(taught, taught.count()), "id")
                    .groupBy("text_key", "label").agg(F.min("id").alias("id")), "taught")
    n = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if not n.get(1):
        return nothing
    if not n.get(0):
        nothing.prior = 1.0
        return nothing
    nothing.prior = n[1] / (n[0] + n[1])

    def texts(chosen):
        # one row of each (id, text): repeated rows count once
        return docs.join(bounded(chosen, n[0] + n[1]), ["id", "text_key"]).select("label", "text")

    tied = toxic_keys(texts(labelled.where("label = 1")), texts(labelled.where("label = 0")), n[1], n[0])
    keys = {k: i for i, k in enumerate(tied)}
    labelling = {keys[k] for k, y in tied.items() if y}
    if not labelling:
        return nothing

    order = F.xxhash64("id", F.lit("sample"))
    ids = None
    for label in (0, 1):
        some = labelled.where(F.col("label") == label).orderBy(order, "id", "text_key").limit(TRAIN_DOCUMENTS)
        ids = some if ids is None else ids.unionByName(some)
    ids = keep(ids, "sample")
    sizes = (docs.join(F.broadcast(ids), ["id", "text_key"]).groupBy("id", "text_key", "label").agg(F.max(F.length("text")).alias("chars"))
             .orderBy(order, "id", "label").collect())
    room, chosen = {0: TRAIN_CHARS // 2, 1: TRAIN_CHARS // 2}, []
    for r in sizes:
        room[r["label"]] -= r["chars"] or 0
        if room[r["label"]] >= 0:
            chosen.append((r["id"], r["text_key"], r["label"]))
    picked = docs.sparkSession.createDataFrame(chosen, ids.select("id", "text_key", "label").schema)
    got = _encoded(docs.join(F.broadcast(picked), ["id", "text_key"]).dropDuplicates(["id", "text_key", "label"]), keys, labelling).collect()
    got = [r for r in got if r["n"]]
    if not any(r["toxic"] for r in got):
        return nothing
    begin = np.cumsum([0] + [r["n"] for r in got])
    first = np.zeros(begin[-1], bool)
    first[begin[:-1]] = True
    owner = np.concatenate([np.array(r["at"], np.int64) + b for r, b in zip(got, begin)])
    key = np.concatenate([np.array(r["of"], np.int64) for r in got])
    y = np.zeros(begin[-1])
    y[np.concatenate([np.array(r["toxic"], np.int64) + b for r, b in zip(got, begin)])] = 1
    start = np.zeros(len(keys) + 4)
    start[len(keys)] = -4.0
    params = minimise(lambda x: _loss(x, len(keys), owner, key, first, y), start)
    field = Field(keys, params[:len(keys)], params[len(keys):], np.zeros(3), nothing.prior)
    e = field.shared[0] + np.bincount(owner, weights=field.weights[key], minlength=len(first))
    told = np.array([float(r["label"]) for r in got])
    share = {c: n[c] / max((told == c).sum(), 1) for c in (0, 1)}
    field.curve = _curve(_summary(field.marginals(e, first), first), told, np.where(told == 1, share[1], share[0]) / (n[0] + n[1]) * len(told))
    return field


def _spans(text: str, odds: np.ndarray) -> list[dict]:
    """Runs of tokens at or above SPAN, from the first letter of the first to
    the last letter of the last (in characters)."""
    found, run = [], []
    floor = math.log(SPAN / (1 - SPAN))
    places = {}
    wanted = set(np.flatnonzero(odds >= floor).tolist())
    for i, m in enumerate(_WORD.finditer(text)):
        if i in wanted:
            inner = list(_RUN.finditer(m.group()))
            places[i] = (m.start() + inner[0].start(), m.start() + inner[-1].end()) if inner else m.span()
    for i in sorted(wanted):
        if run and i == run[-1] + 1:
            run.append(i)
        else:
            if run:
                found.append(run)
            run = [i]
    if run:
        found.append(run)
    return [{"start": places[r[0]][0], "end": places[r[-1]][1], "score": float(1 / (1 + math.exp(-min(odds[r].max(), 700.0))))} for r in found]


def score_documents(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """``(id, score, spans)`` of every row of ``docs``: the score in [0, 1] and
    the toxic spans ``(start, end, score)`` as places of characters, learned
    from the labelled rows whose id satisfies ``train`` (a condition on a
    column ``id``; all of them by default).

    Null and empty texts score as texts without toxic tokens.  Repeated rows
    are each scored; copies of one text teach once; null ids and labels teach
    nothing, labels other than 0 and 1 neither.  Without toxic labels every
    score is 0, without clean ones 1; where no key stands out it is the share
    of toxic texts.  Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_key"))
    taught = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().where("label in (0, 1)").distinct()
    field = fit(src, taught.where(train) if train is not None else taught)
    kind = src.schema["id"].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def score(batches):
        memo = _Memo(field.evidence)

        def solve(texts, parts):
            """Scores and spans of texts whose evidence is ``parts``."""
            x = np.tile(_NO_TOKENS, (len(texts), 1))
            spans = [[] for _ in texts]
            some = [i for i, e in enumerate(parts) if len(e)]
            if some and field.keys:
                e = np.concatenate([parts[i] for i in some])
                begin = np.cumsum([0] + [len(parts[i]) for i in some])
                first = np.zeros(len(e), bool)
                first[begin[:-1]] = True
                odds = field.marginals(e, first)
                x[some] = _summary(odds, first)
                for i, b, c in zip(some, begin, begin[1:]):
                    if x[i, 1] >= math.log(SPAN / (1 - SPAN)):
                        spans[i] = _spans(texts[i], odds[b:c])
            if not field.keys:
                return [field.prior] * len(texts), spans
            return (1 / (1 + np.exp(-np.clip(x @ field.curve, -30, 30)))).tolist(), spans

        for batch in batches:
            scores, spans, texts, parts, size = [], [], [], [], 0
            for text in batch.column(1):
                text = text.as_py() or ""
                split = text.split() if field.keys else ()
                texts.append(text)
                parts.append(np.fromiter(map(memo.__getitem__, split), np.float64, len(split)))
                size += len(split)
                if size >= SOLVE_WORDS:
                    s, p = solve(texts, parts)
                    scores, spans, texts, parts, size = scores + s, spans + p, [], [], 0
            s, p = solve(texts, parts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores + s, pa.float64()), pa.array(spans + p, spans_type)], ["id", "score", "spans"])

    return src.select("id", "text").mapInArrow(score, f"id {kind}, score double, spans array<struct<start:int,end:int,score:double>>")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


THRESHOLD = 0.3


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: learn on the rows that are not held out, score all documents."""
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train=~held_out(F.col("id")))
    return scored.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
