"""SentencePiece encoding and decoding of merge-type vocabularies.

A text becomes characters with the space mark.  An agenda of adjacent pairs,
ordered by the score of the merged piece and then by position, merges until
no pair is a piece; a character that is no piece falls back to byte pieces.

Merges never cross two characters that stand side by side in no piece.  The
characters fall into families that pieces don't mix (letters, digits, marks
...), and no piece holds a space mark after another character; so a text falls
into segments, space marks and a run of one family, that can be encoded by
themselves.  Each worker keeps the ids of the segments it has met, up to
CACHE_SEGMENTS, and encodes only new ones.  New segments of an Arrow batch are
checked against the sentencepiece library; a difference raises an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.llm.common import small_batches, table

CACHE_SEGMENTS = 400_000   # segments that a worker remembers
LONG_SEGMENT = 64          # longer ones are not remembered
SHORT_SEGMENT = 40         # characters up to which the agenda is a plain list
NEVER = float("-inf")      # score of a pair that is no piece
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class Vocabulary:
    """A merge-type vocabulary and its encoder."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        model = model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only merge-type models without text normalisation are supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.eos = self.library.eos_id()
        self.unknown = self.library.unk_id()
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_ids = {}
        self.bytes = []     # what decode() writes for an id
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes.append(bytes([value]))
            elif p.type == CONTROL:
                self.bytes.append(b"")
            elif p.type == UNKNOWN:
                self.bytes.append(" ⁇ ".encode())
            else:
                self.bytes.append(p.piece.replace(SPACE, " ").encode())
        self.inner = any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        self.segments = re.compile("|".join([f"{SPACE}*[{re.escape(f)}]+" for f in self.families()] + [f"{SPACE}+", "(?s:.)"]))
        self.cache: dict[str, tuple[int, ...]] = {}

    def families(self) -> list[str]:
        """Characters joined by standing side by side in pieces, the largest
        family first; a character without neighbours is in none."""
        root: dict[str, str] = {}

        def find(c):
            while root.setdefault(c, c) != c:
                root[c] = root[root[c]]
                c = root[c]
            return c
        for piece in self.ids:
            for a, b in zip(piece, piece[1:]):
                if SPACE not in (a, b):
                    root[find(a)] = find(b)
                elif b != SPACE:
                    find(b)
        found: dict[str, list[str]] = {}
        for c in root:
            found.setdefault(find(c), []).append(c)
        return ["".join(sorted(f)) for f in sorted(found.values(), key=lambda f: (-len(f), f))]

    def _short(self, text: str) -> list[str]:
        """The pieces of a short segment: the agenda is the list of the pairs'
        scores in order, of which the first best is merged."""
        get, pieces = self.scores.get, list(text)
        agenda = [get(a + b, NEVER) for a, b in zip(pieces, pieces[1:])]
        while agenda:
            best = max(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            merged = pieces[i] + pieces[i + 1]
            pieces[i:i + 2] = [merged]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = get(merged + pieces[i + 1], NEVER)
            if i:
                agenda[i - 1] = get(pieces[i - 1] + merged, NEVER)
        return pieces

    def encode_segment(self, text: str) -> tuple[int, ...]:
        """The ids of a segment, by the agenda."""
        pieces = self._short(text) if len(text) <= SHORT_SEGMENT else self._long(text)
        try:
            return tuple([self.ids[p] for p in pieces])
        except KeyError:  # some characters are no piece
            pass
        out = []
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in p.encode())
            else:
                out.append(self.unknown)
        return tuple(out)

    def _long(self, text: str) -> list[str]:
        """The pieces of a long segment: the agenda is a heap, the symbols a
        linked list."""
        pieces, scores = list(text), self.scores
        left = list(range(-1, len(pieces) - 1))
        right = list(range(1, len(pieces))) + [-1]
        agenda = [(-scores[a + b], i, a + b) for i, (a, b) in enumerate(zip(pieces, pieces[1:])) if a + b in scores]
        heapq.heapify(agenda)
        while agenda:
            _, i, merged = heapq.heappop(agenda)
            j = right[i] if pieces[i] else -1
            if j < 0 or pieces[i] + pieces[j] != merged:
                continue  # one side has been merged meanwhile
            pieces[i], pieces[j] = merged, ""
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
            for at, other in ((i, k), (left[i], i)):
                if at >= 0 and other >= 0 and pieces[at] + pieces[other] in scores:
                    heapq.heappush(agenda, (-scores[pieces[at] + pieces[other]], at, pieces[at] + pieces[other]))
        return [p for p in pieces if p]

    def _check(self, fresh: list[str]) -> None:
        """Hold the cached ids of new segments against the library."""
        if not fresh:
            return
        # a mark before the segment makes the library's own prefix one more mark
        texts = ["\n" + s.replace(SPACE, " ") for s in fresh]
        for s, got in zip(fresh, self.library.encode(texts, num_threads=1)):
            at = got.index(self.byte_ids[10]) + 1 if 10 in self.byte_ids else 0
            if tuple(got[at:]) != self.cache[s]:
                raise RuntimeError(f"ids of {s!r} differ from the library: {self.cache[s]} and {got[at:]}")

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts, each with the end id."""
        if self.inner:  # pieces cross words: the texts are the segments
            found = [list(self.encode_segment(self.prefix + t.replace(" ", SPACE))) if t else [] for t in texts]
            if found != self.library.encode(texts, num_threads=1):
                raise RuntimeError("ids differ from the library")
            return [ids + [self.eos] for ids in found]
        cache, out = self.cache, []
        if len(cache) > CACHE_SEGMENTS:
            cache.clear()
        fresh, long = [], []
        for t in texts:
            segments = self.segments.findall(self.prefix + t.replace(" ", SPACE)) if t else []
            for s in set(segments).difference(cache):
                cache[s] = self.encode_segment(s)
                fresh.append(s)
                if len(s) > LONG_SEGMENT:
                    long.append(s)
            ids = list(chain.from_iterable(map(cache.__getitem__, segments)))
            ids.append(self.eos)
            out.append(ids)
        self._check(fresh)
        for s in long:
            cache.pop(s, None)
        return out

    def decode(self, ids: list[int]) -> str:
        """What the library's decode(ids) returns."""
        raw = b"".join(map(self.bytes.__getitem__, ids))
        if self.prefix and raw.startswith(b" ") and ids and self.bytes[ids[0]].startswith(b" "):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self.library.decode(ids)


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this worker, read once."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``, the ids of the whole text and the end id.

    A null text counts as empty: the end id alone.  Rows and the other columns
    stay as they are; a column of that name is replaced.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != ids_col]
    schema = docs.select(*kept, F.array().cast("array<int>").alias(ids_col)).schema

    def run(batches):
        v = vocabulary(path)
        for b in batches:
            ids = pa.array(v.encode_batch(_texts(b.column(text_col))), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, ids_col])
    return docs.select(*kept).mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids_col``; null ids give an empty text."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != text_col]
    schema = docs.select(*kept, F.lit("").alias(text_col)).schema

    def run(batches):
        v = vocabulary(path)
        for b in batches:
            texts = pa.array([v.decode(i or []) for i in b.column(ids_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, text_col])
    return docs.select(*kept).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)`` of every row, encoded
    and decoded in one pass over each Arrow batch, so that no ids are stored.

    Null and empty texts give the end id alone and an empty decoded text;
    repeated rows and null ids are kept; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        v = vocabulary(path)
        spelled = [str(i) for i in range(len(v.bytes))]
        for b in batches:
            n, told, back = [], [], []
            texts = _texts(b.column(1))
            for start in range(0, len(texts), 64):  # a few texts at a time bound the ids in memory
                for ids in v.encode_batch(texts[start:start + 64]):
                    n.append(len(ids))
                    told.append(hashlib.sha256(" ".join(map(spelled.__getitem__, ids)).encode()).hexdigest())
                    back.append(hashlib.sha256(v.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(told, pa.string()), pa.array(back, pa.string())],
                                             names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every whole text of ``documents``."""
    return digests(table(spark, sf_dir, "documents"), default_path())
