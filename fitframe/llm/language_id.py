"""Language identification of mixed text.

Words are runs of letters and the marks on them of one script, long runs cut
into pieces of LONG_WORD characters; number signs are no letters.  Every word's script narrows the languages: a language is a candidate if
training saw the script in at least SCRIPT_SHARE of its letters.  The score of
a word in a language is the log probability of its character n-grams, hashed
to BUCKETS, less that of the mean language.  A Viterbi pass over the words
with a penalty for each switch labels spans; the language of a text is the
one with most letters in its spans.

Counts are sums over all training texts, first of words and then of the
n-grams of distinct words.  The model has one number per language and bucket,
whatever the corpus, and is broadcast with the task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitframe.llm.common import keep, small_batches, table

BUCKETS = 1 << 14
SMOOTHING = 0.5
WORD_CAP = 6.0         # a word says at most so much for or against a language
SWITCH_PENALTY = 8.0
SCRIPT_SHARE = 0.01
CACHE_WORDS = 300_000  # words whose scores a worker remembers
LONG_WORD = 40         # letters of a piece; longer runs are several pieces
UNKNOWN = "und"
# First code points of script ranges, and the script from there on.
SCRIPTS = ((0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
           (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Other"),
           (0x0B80, "Tamil"), (0x0C00, "Other"), (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"),
           (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
           (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"),
           (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"),
           (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"), (0x32000, "Other"))
_STARTS = [s for s, _ in SCRIPTS]
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
# the same where no mark and no number sign stands, and quicker
_PLAIN_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = regex.compile(r"[\p{M}\p{Nl}\p{No}]")


def _ranges(script: str) -> str:
    """The code points of a script as the inside of a character class."""
    ends = [*_STARTS[1:], 0x110000]
    return "".join(f"\\U{0 if i == 0 else s:08x}-\\U{e - 1:08x}" for i, ((s, name), e) in enumerate(zip(SCRIPTS, ends)) if name == script)


PIECE = re.compile("|".join(f"[{_ranges(name)}]{{1,{LONG_WORD}}}" for name in dict.fromkeys(name for _, name in SCRIPTS)))
NOT_LATIN = re.compile(f"[^{_ranges('Latin')}]")


def _word(text: str):
    return _PLAIN_WORD if text.isascii() or not _SIGNS.search(text) else WORD


def n_letters(piece: str) -> int:
    """Letters of a piece, without marks."""
    return len(piece) if piece.isalpha() else sum(map(str.isalpha, piece))


def pieces(text: str) -> list[str]:
    """All letters of a text, with their marks, as runs of one script of up to
    LONG_WORD characters."""
    words = _word(text).findall(text)
    if not words or (max(map(len, words)) <= LONG_WORD and (text.isascii() or not NOT_LATIN.search(text))):
        return words
    return [p for w in words for p in PIECE.findall(w)]


def piece_places(text: str) -> list[tuple[int, int]]:
    """Where the pieces of a text begin and end."""
    return [(m.start() + p.start(), m.start() + p.end()) for m in _word(text).finditer(text) for p in PIECE.finditer(m.group())]


def script_places(words: list[str]) -> np.ndarray:
    """Place in SCRIPTS of the first letter of each word."""
    return np.maximum(np.searchsorted(_STARTS, [ord(w[0]) for w in words], side="right") - 1, 0)


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 1- to 3-grams of lower-cased words with their edges, as flat arrays
    (place of the word, bucket)."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    owners, hashes, h = [], [], np.zeros(len(codes), np.uint64)
    for k in range(3):
        h = (h[: len(codes) - k] + codes[k:] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        inside = owner[: len(owner) - k] == owner[k:]
        owners.append(owner[: len(owner) - k][inside])
        hashes.append(h[inside])
    return np.concatenate(owners), (np.concatenate(hashes) >> np.uint64(11)).astype(np.int64) % BUCKETS


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray             # languages x BUCKETS, log probabilities less their mean
    by_script: dict[str, np.ndarray]  # script -> which languages are candidates

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Scores (words x languages), 0 for the best language of a word."""
        owner, bucket = ngrams(words)
        n = np.bincount(owner, minlength=len(words))
        s = np.stack([np.bincount(owner, weights=w[bucket], minlength=len(words)) for w in self.weights], axis=1)
        s *= (np.minimum([len(w) + 2 for w in words], 8) / n)[:, None]
        s = np.maximum(s - s.max(axis=1, keepdims=True), -WORD_CAP)
        place = script_places(words)
        for i in np.unique(place):
            allowed = self.by_script.get(SCRIPTS[i][1])
            if allowed is not None and allowed.any():
                s[np.ix_(place == i, ~allowed)] = -4 * WORD_CAP
        return s


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from all rows with a language; null texts teach nothing.  No row
    gives a model without languages."""
    small_batches(docs.sparkSession)

    def count_words(batches):
        from collections import Counter

        held: dict[str, Counter] = {}

        def out():
            rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))],
                                              names=["lang", "word", "n"])
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(lang, Counter()).update(pieces((text or "").lower()))
            if sum(map(len, held.values())) > CACHE_WORDS:
                yield out()
                held = {}
        if any(held.values()):
            yield out()

    def count_grams(batches):
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for b in batches:
            langs, words, n = np.array(b.column(0).to_pylist(), object), b.column(1).to_pylist(), np.asarray(b.column(2))
            owner, bucket = ngrams(words)
            place, letters = script_places(words), n * np.array([n_letters(w) for w in words])
            for lang in set(langs):
                own = langs == lang
                hit = own[owner]
                grams[lang] = grams.get(lang, 0) + np.bincount(bucket[hit], weights=n[owner[hit]], minlength=BUCKETS)
                scripts[lang] = scripts.get(lang, 0) + np.bincount(place[own], weights=letters[own], minlength=len(SCRIPTS))
        rows = [(kind, lang, i, int(c[i])) for kind, sums in (("gram", grams), ("script", scripts)) for lang, c in sums.items()
                for i in np.flatnonzero(c).tolist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.int64()))],
                                             names=["kind", "lang", "what", "n"])

    src = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null")
    counted = (src.mapInArrow(count_words, "lang string, word string, n long")
               .mapInArrow(count_grams, "kind string, lang string, what int, n long")
               .groupBy("kind", "lang", "what").agg(F.sum("n").alias("n")))
    # at most languages x (BUCKETS + scripts) rows, however many texts
    counted = keep(counted, "languages").toPandas()
    seen = sorted(counted["lang"].unique())
    counts = np.zeros((len(seen), BUCKETS))
    at = {lang: i for i, lang in enumerate(seen)}
    grams = counted[counted["kind"] == "gram"]
    counts[grams["lang"].map(at).to_numpy(int), grams["what"].to_numpy(int)] = grams["n"]
    logs = np.log((counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))
    weights = logs - logs.mean(axis=0, keepdims=True) if seen else logs
    scripts = counted[counted["kind"] == "script"]
    letters = scripts.groupby("lang")["n"].sum()
    by_script = {}
    for script, rows in scripts.groupby(scripts["what"].map(lambda i: SCRIPTS[i][1])):
        share = rows.groupby("lang")["n"].sum() / letters
        by_script[script] = np.array([share.get(lang, 0) >= SCRIPT_SHARE for lang in seen])
    return LanguageModel(seen, weights, by_script)


def viterbi(scores: list[np.ndarray], penalty: float = SWITCH_PENALTY) -> list[np.ndarray]:
    """Best label of every word for each text, by dynamic programming over all
    texts of a batch at once.  ``scores`` are (words x languages) arrays; of
    equal paths the one that stays, then the first language, is taken."""
    order = np.argsort([-len(s) for s in scores], kind="stable")
    lengths = np.array([len(scores[i]) for i in order])
    if not len(lengths) or not lengths[0]:
        return [np.zeros(0, np.int8) for _ in scores]
    n_lang = scores[order[0]].shape[1]
    kind = np.int8 if n_lang <= 127 else np.int32
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts longer than t
    starts = np.concatenate([[0], np.cumsum(alive)])
    # time-major: the t-th words of all texts longer than t stand together
    flat = np.empty((starts[-1], n_lang), np.float32)
    for rank, i in enumerate(order[: alive[0]]):
        flat[starts[: lengths[rank]] + rank] = scores[i]
    back = np.empty((starts[-1], n_lang), kind)
    value = flat[: alive[0]].astype(np.float64)
    final = np.empty((alive[0], n_lang))
    stay = np.arange(n_lang, dtype=kind)
    for t in range(1, lengths[0]):
        a = alive[t]
        if a < len(value):
            final[a: len(value)] = value[a:]
            value = value[:a]
        best = value.argmax(axis=1)
        moved = value[np.arange(a), best] - penalty
        switch = moved[:, None] > value
        back[starts[t]: starts[t] + a] = np.where(switch, best[:, None], stay)
        value = np.where(switch, moved[:, None], value) + flat[starts[t]: starts[t] + a]
    final[: len(value)] = value
    state = final.argmax(axis=1)
    labels = np.empty(starts[-1], kind)
    for t in range(lengths[0] - 1, -1, -1):
        a = alive[t]
        labels[starts[t]: starts[t] + a] = state[:a]
        if t:
            state[:a] = back[starts[t] + np.arange(a), state[:a]]
    out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(scores)
    for rank, i in enumerate(order):
        out[i] = labels[starts[: lengths[rank]] + rank] if lengths[rank] else out[i]
    return out


class Labeller:
    """A model with the scores of the words met so far."""

    def __init__(self, model: LanguageModel):
        self.model, self.place = model, {}
        self.table = np.empty((0, len(model.languages)), np.float32)

    def label(self, texts: list[str]) -> list[tuple[list[str], np.ndarray]]:
        """Per text its pieces and their labels."""
        if len(self.place) > CACHE_WORDS:
            self.place, self.table = {}, self.table[:0]
        words = [pieces(t) for t in texts]
        lowered = ["\n".join(w).lower().split("\n") if w else [] for w in words]
        fresh = list(set().union(*lowered).difference(self.place))
        if fresh:
            self.place.update(zip(fresh, range(len(self.table), len(self.table) + len(fresh))))
            self.table = np.concatenate([self.table, self.model.word_scores(fresh).astype(np.float32)])
        scores = [self.table[np.fromiter(map(self.place.__getitem__, w), np.int64, len(w))] for w in lowered]
        return list(zip(words, viterbi(scores)))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", spans: bool = True) -> DataFrame:
    """``(id_col, lang_pred, score, spans)`` of every row: the language with
    most letters, its share of the letters, and the labelled spans as offsets
    of code points (null unless ``spans``).

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text if the model has no language.  Repeated rows and null ids are kept;
    other columns are not read.
    """
    small_batches(docs.sparkSession)
    schema = docs.select(F.col(id_col)).schema
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])
    schema = schema.add("lang_pred", T.StringType()).add("score", T.DoubleType()).add("spans", T.ArrayType(span))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers

    def run(batches):
        labeller = Labeller(shared.value)
        names = labeller.model.languages
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()] if names else [""] * b.num_rows
            langs, shares, marked = [], [], []
            for text, (found, labels) in zip(texts, labeller.label(texts) if names else [([], None)] * b.num_rows):
                if not found:
                    langs.append(UNKNOWN)
                    shares.append(0.0)
                    marked.append([] if spans else None)
                    continue
                letters = np.bincount(labels, weights=list(map(n_letters, found)), minlength=len(names))
                best = int(letters.argmax())
                langs.append(names[best])
                shares.append(float(letters[best] / letters.sum()))
                if spans:
                    at = piece_places(text)
                    edge = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(at)]
                    marked.append([{"start": at[x][0], "end": at[y - 1][1], "lang": names[labels[x]]} for x, y in zip(edge, edge[1:])])
                else:
                    marked.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(shares, pa.float64()), pa.array(marked, kind)],
                                             names=[id_col, "lang_pred", "score", "spans"])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: learn on the rows that are not held out, label all documents."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs, model, spans=False)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
