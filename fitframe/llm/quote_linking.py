"""Chat formatting by quotation linking.

Lines that begin with one or more ``>`` are quotes of that level.  Passages
(neighbouring lines of one level) and their lines are normalised and hashed,
and joined to the same units of what messages say themselves.  The original
of a unit is the earliest message that says it, of the same conversation if
there is one.  A message replies to the original with the shallowest quote
level, then the most quoted words.  Replies go to the conversation of the
message that their chain starts from, ordered by depth, without quotes.

Originals are minima, combined on the map side, so a unit that a third of the
messages share is one row.  Chains are shortened by doubling: the rounds grow
with the logarithm of the longest.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitframe.llm.common import bounded, keep, small_batches, table

QUOTE = re.compile(r"^\s*((?:>\s?)+)(.*)$")
INTRODUCTION = re.compile(r"^\s*(?:On\b.*\bwrote|.{1,80}\bwrote|Le\b.*\ba écrit|Am\b.*\bschrieb.*)\s*:\s*$")
GLOBAL_WORDS = 5   # words that a unit needs to link to another conversation

UNIT_SCHEMA = (T.StructField("key", T.LongType()), T.StructField("own", T.BooleanType()), T.StructField("level", T.IntegerType()),
               T.StructField("words", T.IntegerType()), T.StructField("unit", T.BinaryType()))


def parse(text: str) -> tuple[str, list[tuple[int, list[str]]]]:
    """What a message says itself, and its passages as (level, lines): level 0
    is own text, a blank line or another level ends a passage."""
    said, passages = [], []
    level_before = None
    lines = (text or "").split("\n")
    for i, line in enumerate(lines):
        m = QUOTE.match(line)
        level, body = (m.group(1).count(">"), m.group(2)) if m else (0, line)
        if not level and INTRODUCTION.match(line) and i + 1 < len(lines) and QUOTE.match(lines[i + 1]):
            level_before = None
            continue
        if not level:
            said.append(line)
        if not body.strip():
            level_before = None
            continue
        if level == level_before:
            passages[-1][1].append(body)
        else:
            passages.append((level, [body]))
        level_before = level
    return "\n".join(said).strip("\n") if any(level for level, _ in passages) else (text or ""), passages


def normal(text: str) -> str:
    return " ".join(re.findall(r"\w+", text.lower()))


def units(passages: list[tuple[int, list[str]]]) -> list[tuple[int, int, bytes]]:
    """(level, words, hash) of every passage, of its lines, and of all own
    text together."""
    out = []
    own = [line for level, body in passages if not level for line in body]
    for level, body in [*passages, *([(0, own)] if len(own) > 1 else [])]:
        for t in {normal(" ".join(body)), *map(normal, body)}:
            if t:
                out.append((level, t.count(" ") + 1, hashlib.md5(t.encode()).digest()))
    return sorted(set(out))


def _parsed(batches):
    for b in batches:
        rows = [(i, key, level == 0, level, n, h) for i, (key, text) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist()))
                for level, n, h in units(parse(text)[1])]
        if rows:
            at, *cols = zip(*rows)
            kinds = (pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)),
                                              *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                                             names=["conv", "turn", "key", "own", "level", "words", "unit"])


def _unquoted(batches):
    for b in batches:
        told = [parse(t) for t in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([t for t, _ in told], pa.string()),
                                          pa.array([sum(len(x) for level, x in p if level) for _, p in told], pa.int32())],
                                         names=[*b.schema.names[:-1], "said", "quoted_lines"])


def reply_links(messages: DataFrame) -> DataFrame:
    """``(key, reply_key)`` of messages (key, conv, turn, text) that quote."""
    spoken = messages.where("conv is not null and turn is not null")
    places = spoken.select("conv", "turn").schema
    found = keep(spoken.select("conv", "turn", "key", "text").mapInArrow(
        _parsed, T.StructType([*places, *UNIT_SCHEMA])), "units")
    quoted = found.where("not own").distinct()
    asked = keep(quoted.select("unit").distinct(), "asked")
    own = found.where("own").join(bounded(asked, asked.count()), "unit", "left_semi")
    same = own.groupBy("conv", "unit").agg(F.min(F.struct("turn", "key")).alias("near"))
    first = own.where(F.col("words") >= GLOBAL_WORDS).groupBy("unit").agg(F.min(F.struct("conv", "turn", "key")).alias("far"))
    matched = (quoted.join(same, ["conv", "unit"], "left").join(first, "unit", "left")
               .withColumn("origin", F.when(F.col("near.turn") < F.col("turn"), F.struct("conv", "near.turn", "near.key"))
                           .when(F.struct("far.conv", "far.turn") < F.struct("conv", "turn"), F.col("far")))
               .where("origin is not null"))
    by_origin = matched.groupBy("key", "origin").agg(F.min("level").alias("level"), F.sum("words").alias("words"))
    best = F.min(F.struct("level", (-F.col("words")).alias("words"), "origin"))
    return by_origin.groupBy("key").agg(best.alias("b")).select("key", F.col("b.origin.key").alias("reply_key"))


def _roots(links: DataFrame) -> DataFrame:
    """``(key, root, depth)`` of linked messages; a link points to an earlier
    message, so there are no cycles."""
    state = keep(links.select("key", F.col("reply_key").alias("up"), F.lit(1).cast("long").alias("depth")), "chains")
    while True:
        above = state.select(F.col("key").alias("up"), F.col("up").alias("higher"), F.col("depth").alias("more"))
        moved = state.join(above, "up", "left")
        if moved.where("higher is not null").isEmpty():
            return state.select("key", F.col("up").alias("root"), "depth")
        state = keep(moved.select("key", F.coalesce("higher", "up").alias("up"),
                                  (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "chains")


def link_quotes(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """Every row with its place in a reply-ordered conversation:
    ``(conv_col, turn_col, role_col, said, quoted_lines, reply_conv,
    reply_turn, conversation, root_turn, depth)``.  Ordered by conversation,
    root_turn, depth, conv and turn, a reply follows what it replies to.

    ``said`` is the text without quotes; a text without any is unchanged.  A
    null text says nothing and quotes nothing.  Rows without conversation or
    turn are kept with themselves as conversation and are never linked.
    Repeated rows are kept and share their link; of several messages of one
    turn, the one with the least key is the original.  An empty table gives an
    empty result; other columns are not read.
    """
    small_batches(conversations.sparkSession)
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                                F.col(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("conv", "turn", "role", F.coalesce("text", F.lit("")), F.col("conv").isNull(), F.col("turn").isNull()))
    links = keep(reply_links(rows.select("key", "conv", "turn", "text")), "links")
    named = links.select("key").unionByName(links.select(F.col("reply_key").alias("key"))).distinct()
    where = (rows.select("key", "conv", "turn").join(bounded(named, 2 * links.count()), "key", "left_semi").distinct())
    placed = (links.join(_roots(links), "key")
              .join(where.select(F.col("key").alias("reply_key"), F.col("conv").alias("reply_conv"), F.col("turn").alias("reply_turn")), "reply_key")
              .join(where.select(F.col("key").alias("root"), F.col("conv").alias("root_conv"), F.col("turn").alias("root_turn")), "root")
              .select("key", "reply_conv", "reply_turn", "root_conv", "root_turn", "depth"))
    placed = keep(placed, "placed")
    plain = rows.select("key", "conv", "turn", "role", "text")
    said = plain.mapInArrow(_unquoted, plain.drop("text").schema.add("said", T.StringType()).add("quoted_lines", T.IntegerType()))
    out = said.join(bounded(placed, placed.count()), "key", "left")
    return out.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "said", "quoted_lines",
        "reply_conv", "reply_turn", F.coalesce("root_conv", "conv").alias("conversation"),
        F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"))


def formatted(linked: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role") -> DataFrame:
    """The messages of ``link_quotes`` in reply order, each as a chat block;
    a sort over the cluster, so that a long conversation isn't one row."""
    block = F.concat(F.lit("<|"), F.coalesce(role_col, F.lit("unknown")), F.lit("|>\n"), F.col("said"), F.lit("\n"))
    return (linked.withColumn("block", block).orderBy("conversation", "root_turn", "depth", conv_col, turn_col)
            .select("conversation", "block"))


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: all messages of ``conversations``, in reply order."""
    linked = link_quotes(table(spark, sf_dir, "conversations"))
    return linked.select("conv_id", "turn", "role", "conversation", "root_turn", "depth", "reply_conv", "reply_turn",
                         "quoted_lines", F.sha2("said", 256).alias("said_sha256"))
