"""Token counts without ids.

A byte-level vocabulary splits a text into pre-tokens and encodes each by
itself, so the tokens of a text are the sum over its pre-tokens.

1. Documents are read in blocks of BLOCK_BYTES.  A block writes, for every
   document, its pre-token frequencies as numbers into the block's list of
   distinct pre-tokens, and that list in parts, dealt by pre-token hash.
2. The parts are brought together by hash: the pieces of every distinct
   pre-token are counted once, and each part returns as an array of counts.
3. The counts of a block are joined to the frequencies of its documents.

A frequent pre-token is one entry per block, so it does not skew a join, and
a group of the join is one block.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.llm.common import keep, small_batches, table

BLOCK_BYTES = 16 << 20
KNOWN_TOKENS = 1_000_000   # counts that a worker remembers
LIMIT = 1024

# The split rule of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Texts within these characters are split here, where Unicode tables agree
# for certain; the library splits the others.
PLAIN = r"[\x00-\x1b\x20-\x84\x86-ɏ]*"

BLOCK_SCHEMA = ("block long, part int, doc_id long, n_bytes long, added long, places binary, times binary, "
                "start int, tokens array<string>")


class Counter:
    """Split rule and piece counts of a byte-level vocabulary."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        kind = self.library.pre_tokenizer
        if self.library.normalizer is not None or type(kind).__name__ != "ByteLevel" or kind.add_prefix_space:
            raise ValueError("only byte-level vocabularies without normaliser and prefix are supported")
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        for t in self.library.get_added_tokens_decoder().values():
            if t.lstrip or t.rstrip or t.single_word or t.normalized:
                raise ValueError("added tokens with strip or word rules are not supported")
        self.splitter = regex.compile(SPLIT)
        self.plain = regex.compile(PLAIN)
        self.around = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.pieces = Tokenizer.from_file(path)
        self.pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and the number of added tokens in it."""
        parts, added = [text], 0
        if self.around is not None and self.around.search(text):
            parts = self.around.split(text)
            added = len(parts) - 1
        tokens: list[str] = []
        for p in parts:
            if self.plain.fullmatch(p):
                tokens += self.splitter.findall(p)
            else:
                tokens += [p[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(p)]
        return tokens, added

    def count(self, tokens: list[str]) -> list[int]:
        """Pieces of each pre-token."""
        return [len(e) for e in self.pieces.encode_batch(tokens, add_special_tokens=False)]


_LOADED: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _LOADED:
        _LOADED[path] = Counter(path)
    return _LOADED[path]


def _pack(values: np.ndarray) -> bytes:
    kind = "B" if values.max(initial=0) < 1 << 8 else "H" if values.max(initial=0) < 1 << 16 else "I"
    return kind.encode() + values.astype(kind).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, raw[:1].decode(), offset=1).astype(np.int64)


def blocks(path: str, parts: int):
    """An Arrow function from (doc_id, text) to BLOCK_SCHEMA."""
    def made(docs: list, known: dict[str, int]):
        block = uuid.uuid4().int >> 65
        tokens = np.array(list(known), dtype=object)
        part = pd.util.hash_array(tokens, categorize=False) % np.uint64(parts) if len(tokens) else np.zeros(0, np.uint64)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rows = []
        for doc_id, n_bytes, added, at, times in docs:
            spot = place[at]
            by = np.argsort(spot)
            rows.append((block, -1, doc_id, n_bytes, added, _pack(np.diff(spot[by], prepend=0)), _pack(times[by]), None, None))
        edges = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(order)]):
            rows.append((block, int(part[order[a]]), None, None, None, None, None, int(a), tokens[order[a:b]].tolist()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
            pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.string())))],
            names=["block", "part", "doc_id", "n_bytes", "added", "places", "times", "start", "tokens"])

    def run(batches):
        c = counter(path)
        docs, known, size = [], defaultdict(count().__next__), 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tokens, added = c.split(text or "")
                at, times = np.unique(np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens)), return_counts=True)
                n_bytes = len((text or "").encode())
                docs.append((doc_id, n_bytes, added, at, times))
                size += n_bytes
                if size >= BLOCK_BYTES:
                    yield made(docs, known)
                    docs, known, size = [], defaultdict(count().__next__), 0
        if docs:
            yield made(docs, known)
    return run


def count_parts(path: str):
    """An Arrow function from (block, start, tokens) to (block, start, counts)."""
    def run(batches):
        c, known = counter(path), {}
        for b in batches:
            lists = b.column(2).to_pylist()
            if len(known) > KNOWN_TOKENS:
                known.clear()
            fresh = list({t for tokens in lists for t in tokens}.difference(known))
            for i in range(0, len(fresh), 10_000):
                known.update(zip(fresh[i:i + 10_000], c.count(fresh[i:i + 10_000])))
            counts = [_pack(np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))) for tokens in lists]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts, pa.binary())], names=["block", "start", "counts"])
    return run


def _sums(docs: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """Documents of one block against the counts of its pre-tokens."""
    pieces = np.concatenate([_unpack(r) for _, r in sorted(zip(counted["start"], counted["counts"]))] or [np.zeros(0, np.int64)])
    total = [int(a + (pieces[np.cumsum(_unpack(p))] * _unpack(t)).sum()) for a, p, t in zip(docs["added"], docs["places"], docs["times"])]
    return pd.DataFrame({"doc_id": docs["doc_id"].astype("Int64"), "n_bytes": docs["n_bytes"].astype("int64"),
                         "n_tokens": np.array(total, dtype=np.int64)})


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens)`` of every row, as the tokenizers library
    counts them without special tokens at the ends.

    Null and empty texts have no tokens.  Repeated rows and null ids are kept;
    an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    made = keep(src.mapInArrow(blocks(path, parts), BLOCK_SCHEMA), "pretokens")
    counted = (made.where("part >= 0").select("block", "start", "tokens", "part").repartition("part").drop("part")
               .mapInArrow(count_parts(path), "block long, start int, counts binary"))
    left = made.where("part < 0").select("block", "doc_id", "n_bytes", "added", "places", "times")
    summed = left.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(_sums, "doc_id long, n_bytes long, n_tokens long")
    return summed.withColumnRenamed("doc_id", id_col)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every whole text of ``documents``."""
    counts = token_counts(table(spark, sf_dir, "documents"), default_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
