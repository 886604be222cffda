"""Prefix trie of conversations that are rebuilt from stored turns.

A conversation is a head of another conversation's first turns followed by
turns of its own.  Every turn is an affine map ``x -> a x + b`` modulo 2^64
(``a`` odd), made from two hashes of its role and text; the fingerprint of a
sequence is the composition of its maps.  Such maps form a group, so the
fingerprint of ``head + own[h+1..j]`` follows from prefix products of the
stored turns alone: ``P_own[j] P_own[h]^-1 P_base[k]``.  No rebuilt text exists
anywhere; a row of a path carries a fingerprint and a reference
``(ref_conv, ref_pos)`` to the stored turn that ends it.

Prefixes with one fingerprint and depth are a node.  Equality is verified
through the stored turns: the members of a node must share the parent and both
hashes of the referenced turn, and all stored turns with one pair of hashes
must have the same role and text.  Should that fail, the trie is built anew
with other hashes.

Prefix products come from a sort by range: a long conversation spans tasks,
and what its earlier tasks contribute (two numbers each) is composed in
afterwards.  Sums over subtrees are sums over members: each node belongs to
the path of its smallest member, and a subtree holds, of each member's own
nodes, those from the subtree's depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.functions.ordered import running_totals
from fitframe.llm.common import bounded, keep, small_batches, table, words

BLOCK = 20                 # conversations that share a base
LONGEST_HEAD = 3           # turns taken from the base at most
PIECE = 1 << 20            # bytes of joined ids hashed at a time
HOT_CHILDREN = 5_000       # nodes with more children are joined by broadcast
CHAIN_ROWS = 200_000       # nodes of a path summed in one task
NOTHING = hashlib.sha256(b"").hexdigest()
_MASK = (1 << 64) - 1
_KEY = ["depth", "a", "b"]


def base_of(conv: Column) -> Column:
    return conv - conv % BLOCK


def head_of(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % (LONGEST_HEAD + 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _inverse(a: np.ndarray) -> np.ndarray:
    """Inverse of odd numbers modulo 2^64."""
    x = a.copy()
    for _ in range(6):
        x *= np.uint64(2) - a * x
    return x


def _u64(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _i64(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def stored_turns(df: DataFrame, seed: int, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    return df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        F.xxhash64(F.lit(seed), role, text).alias("h1"), F.xxhash64(F.lit(seed + 1), text, role).alias("h2"),
        F.size(words(text)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"))


def prefix_products(turns: DataFrame) -> DataFrame:
    """``(conv, pos, a, b, h1, h2, words)``: the place of each turn in its
    conversation, from 1, and the composition of the maps up to it."""
    def scan(batches):
        part = TaskContext.get().partitionId()
        conv, pos, a, b = None, 0, 1, 0
        first = None  # the conversation that an earlier task may have begun

        def mark():
            return [conv, part, 0, _signed(a), _signed(b), 0, 0, pos]
        for batch in batches:
            rows = []
            for c, h1, h2, w in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if c != conv:
                    if conv is not None and first is None:
                        rows.append(mark())
                        first = conv
                    conv, pos, a, b = c, 0, 1, 0
                t = (h1 | 1) & _MASK
                pos, a, b = pos + 1, t * a & _MASK, (t * b + h2) & _MASK
                rows.append([c, part, pos, _signed(a), _signed(b), h1, h2, w])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)
        if conv is not None:  # the conversation that a later task may continue
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in mark()], names)

    names = ["conv", "part", "pos", "a", "b", "h1", "h2", "words"]
    order = ["conv", "turn", "role", "text", "row"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "h1", "h2", "words")
    scanned = keep(dealt.mapInArrow(scan, ", ".join(f"{n} long" for n in names)), "turns")

    # a row or two a task: what came before in the same conversation
    before, last = {}, {}
    for r in scanned.where("pos = 0").orderBy("conv", "part").collect():
        n, a, b = last.get(r["conv"], (0, 1, 0))
        if n:
            before[r["conv"], r["part"]] = (n, a, b)
        t = r["a"] & _MASK
        last[r["conv"]] = (n + r["words"], t * a & _MASK, (t * b + r["b"]) & _MASK)
    split = np.array(sorted({c for c, _ in before}), np.int64)

    def compose(batches):
        for batch in batches:
            conv, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            pos, a, b = batch.column(2).to_numpy(zero_copy_only=False).copy(), _u64(batch.column(3)).copy(), _u64(batch.column(4)).copy()
            for i in np.flatnonzero(np.isin(conv, split)) if len(split) else ():
                n, a0, b0 = before.get((int(conv[i]), int(part[i])), (0, 1, 0))
                t = int(a[i])
                pos[i] += n
                a[i], b[i] = t * a0 & _MASK, (t * b0 + int(b[i])) & _MASK
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pos), _i64(a), _i64(b), *(batch.column(i) for i in (5, 6, 7))],
                                             ["conv", "pos", "a", "b", "h1", "h2", "words"])
    return scanned.where("pos > 0").mapInArrow(compose, "conv long, pos long, a long, b long, h1 long, h2 long, words long")


def rebuilt_paths(turns: DataFrame, base: Callable, head: Callable, longest: int) -> DataFrame:
    """``(conv, depth, a, b, pa, pb, h1, h2, words, ref_conv, ref_pos, last)``:
    each prefix of each rebuilt conversation, its fingerprint and its parent's."""
    tops = range(1, longest + 1)
    at = [F.max(F.when(F.col("pos") == j, F.col(c))).alias(f"{c}{j}") for j in tops for c in ("a", "b", "h1", "h2", "words")]
    stored = keep(turns.groupBy("conv").agg(F.max("pos").alias("n"), *at), "conversations")
    of_base = stored.select(F.col("conv").alias("base"), F.col("n").alias("base_n"),
                            *[F.col(f"{c}{j}").alias(f"base_{c}{j}") for j in tops for c in ("a", "b", "h1", "h2", "words")])

    def pick(prefix, c, place):  # the product after `place` turns
        got = F.lit(1 if c == "a" else 0).cast("long")
        for j in tops:
            got = F.when(place == j, F.col(f"{prefix}{c}{j}")).otherwise(got)
        return got

    plan = (stored.select("conv", "n", *[f"{c}{j}" for j in tops for c in "ab"], base(F.col("conv")).alias("base"),
                          F.least(head(F.col("conv")), F.lit(longest)).cast("long").alias("h"))
            .join(of_base, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
            .withColumn("end", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    tip = {"a": one, "b": zero, "pa": zero, "pb": zero, "h1": zero, "h2": zero, "words": zero, "ref_conv": F.lit(None).cast("long"), "ref_pos": zero}
    steps = [F.struct(zero.alias("depth"), *[v.alias(k) for k, v in tip.items()])]
    for j in tops:
        steps.append(F.struct(
            F.lit(j).cast("long").alias("depth"), F.col(f"base_a{j}").alias("a"), F.col(f"base_b{j}").alias("b"),
            (F.col(f"base_a{j - 1}") if j > 1 else one).alias("pa"), (F.col(f"base_b{j - 1}") if j > 1 else zero).alias("pb"),
            F.col(f"base_h1{j}").alias("h1"), F.col(f"base_h2{j}").alias("h2"), F.col(f"base_words{j}").alias("words"),
            F.col("base").alias("ref_conv"), F.lit(j).cast("long").alias("ref_pos")))
    heads = (plan.select("conv", "k", "end", F.explode(F.array(*steps)).alias("s")).where("s.depth <= k")
             .select("conv", "s.*", (F.col("s.depth") == F.col("end")).alias("last")))

    joint = plan.where("n > h").select("conv", "h", "k", "end", pick("base_", "a", F.col("k")).alias("ka"), pick("base_", "b", F.col("k")).alias("kb"),
                                       pick("", "a", F.col("h")).alias("oa"), pick("", "b", F.col("h")).alias("ob"))
    names = ["conv", "depth", "a", "b", "pa", "pb", "h1", "h2", "words", "ref_conv", "ref_pos", "last"]

    def join_on(batches):
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            pos, h, k, end = (col[c].to_numpy(zero_copy_only=False) for c in ("pos", "h", "k", "end"))
            a, b, h1, h2, ka, kb, oa, ob = (_u64(col[c]) for c in ("a", "b", "h1", "h2", "ka", "kb", "oa", "ob"))
            turn_back = _inverse(h1 | np.uint64(1))
            out = []
            for x, y in ((a, b), (a * turn_back, (b - h2) * turn_back)):  # up to this turn, and to the one before
                x = x * _inverse(oa)          # own turns after the first h
                y = y - x * ob
                out += [x * ka, x * kb + y]   # behind the head
            depth = k + pos - h
            yield pa.RecordBatch.from_arrays([col["conv"], pa.array(depth), *map(_i64, out), col["h1"], col["h2"], col["words"], col["conv"],
                                              pa.array(pos), pa.array(depth == end)], names)

    own = (turns.join(bounded(joint, stored.count()), "conv").where("pos > h")
           .mapInArrow(join_on, ", ".join(f"{n} {'boolean' if n == 'last' else 'long'}" for n in names)))
    return keep(heads.select(names).unionByName(own), "paths")


def digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ascending ``conv`` of each node of
    ``ends(depth, a, b, conv)``.  Ranges of ids are joined to pieces side by
    side; a node's pieces are then hashed in order, one at a time."""
    def join_ids(batches):
        key, ids, size = None, [], 0

        def flush():
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in (*key, ids[0])), pa.array([",".join(map(str, ids))])],
                                              ["depth", "a", "b", "first", "ids"])
        for batch in batches:
            for *at, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if key is not None and (at != key or size >= PIECE):
                    yield flush()
                    ids, size = [], 0
                key = at
                ids.append(c)
                size += 20
        if ids:
            yield flush()

    def digest(batches):
        key, state = None, None

        def row():
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in key), pa.array([state.hexdigest()])], ["depth", "a", "b", "ends_sha256"])
        for batch in batches:
            for *at, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if at != key:
                    if key is not None:
                        yield row()
                    key, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if key is not None:
            yield row()

    pieces = (ends.select(*_KEY, "conv").repartitionByRange(*_KEY, "conv").sortWithinPartitions(*_KEY, "conv")
              .mapInArrow(join_ids, "depth long, a long, b long, first long, ids string"))
    return (pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").select(*_KEY, "ids")
            .mapInArrow(digest, "depth long, a long, b long, ends_sha256 string"))


def _grouped(paths: DataFrame) -> DataFrame:
    same = [f(c).alias(f"{c}_{n}") for c in ("h1", "h2", "pa", "pb") for n, f in (("least", F.min), ("most", F.max))]
    return paths.groupBy(*_KEY).agg(F.min("conv").alias("r"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
                                    F.min("ref_conv").alias("ref_conv"), F.min_by("ref_pos", "ref_conv").alias("ref_pos"), *same)


def build_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
               base: Callable = base_of, head: Callable = head_of, longest: int = LONGEST_HEAD) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256`` and ``ref_conv, ref_pos`` (where the last
    turn of the node is stored: the conversation, and its place there from 1).

    ``base(conv)`` names the conversation whose first ``head(conv)`` turns, at
    most ``longest``, replace as many first turns of ``conv``.

    Turns are ordered by turn (null first), then role and text; null role and
    text are empty; rows without a conversation are left out.  Repeated rows
    are turns of their own.  Any text length; an empty table gives an empty
    result (no root); other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark, 5000)
    for seed in range(0, 20, 2):
        turns = stored_turns(df, seed, conv_col, turn_col, role_col, text_col)
        paths = rebuilt_paths(prefix_products(turns), base, head, longest)
        grouped = keep(_grouped(paths), "nodes")
        unequal = grouped.where(" or ".join(f"{c}_least <> {c}_most" for c in ("h1", "h2", "pa", "pb")))
        clashes = turns.select("h1", "h2", "role", "text").distinct().groupBy("h1", "h2").count().where("count > 1")
        if unequal.isEmpty() and clashes.isEmpty():
            break
    else:
        raise RuntimeError("fingerprints of different turns were equal with every seed")

    nodes = grouped.select(*_KEY, "r", "n_convs", F.col("pa_least").alias("pa"), F.col("pb_least").alias("pb"), "ref_conv", "ref_pos",
                           ((F.col("n_convs") - 1) * F.col("words")).alias("s"))
    children = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
                .agg(F.count("*").alias("n_children")))
    nodes = keep(nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).withColumn("one", F.lit(1)), "nodes-children")

    # what each conversation's own nodes hold; members add it up for a node
    own = keep(nodes.groupBy("r").agg(F.sum("s").alias("total"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
               .withColumnRenamed("r", "conv"), "own-nodes")
    below = (paths.select(*_KEY, "conv").join(bounded(own, own.count()), "conv").groupBy(*_KEY)
             .agg(F.sum("leaf").alias("n_leaves"), F.sum("total").alias("members_total")))
    chain = running_totals(nodes, "depth", ["s", "one"], by=["r"], rows_per_bucket=CHAIN_ROWS)

    # parents: the same path, the root, or another path for its first node
    root = nodes.where("depth = 0").select("r").first()
    top = root["r"] if root else None
    parents = nodes.where("n_children > 0 and depth > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("r").alias("parent"), "n_children")
    up = ["depth", "pa", "pb"]
    hot = keep(parents.where(F.col("n_children") > HOT_CHILDREN).select(*up, F.col("parent").alias("hot_parent")), "hot-parents")
    starts = chain.where("cum_one = 1 and depth > 1").select(*_KEY, "pa", "pb").join(bounded(hot, hot.count()), up, "left")
    cold = (starts.where("hot_parent is null").drop("hot_parent")
            .join(parents.where(F.col("n_children") <= HOT_CHILDREN).select(*up, "parent"), up).select(*_KEY, "parent"))
    linked = cold.unionByName(starts.where("hot_parent is not null").select(*_KEY, F.col("hot_parent").alias("parent")))

    return (chain.join(below, _KEY).join(linked, _KEY, "left").join(digests(paths.where("last")), _KEY, "left")
            .select(F.col("r").alias("conv_id"), "depth",
                    F.when(F.col("depth") > 0, F.when(F.col("cum_one") > 1, F.col("r")).when(F.col("depth") == 1, F.lit(top).cast("long"))
                           .otherwise(F.col("parent"))).alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves",
                    (F.col("members_total") - F.col("cum_s") + F.col("s")).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"), "ref_conv", "ref_pos"))


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the trie of all rebuilt conversations."""
    return build_trie(table(spark, sf_dir, "conversations")).drop("ref_conv", "ref_pos")


# crc32 by its table of 256 entries, made from the polynomial 0xEDB88320
ORACLE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) AS tab),
turns AS (SELECT conv_id AS c, coalesce(text, '') AS text, dense_rank() OVER (ORDER BY coalesce(role, ''), coalesce(text, '')) AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
         FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, list(t ORDER BY pos) AS own FROM turns GROUP BY c),
heads AS (SELECT c, own, c - c % 20 AS base,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ord(x))),
             lambda v, x: xor(v // 256, tab[(xor(v, x) % 256) + 1])), 4294967295) % 4 AS h FROM convs, crc),
rebuilt AS (SELECT x.c, list_concat(coalesce(y.own, [])[1:x.h], x.own[x.h + 1:]) AS seq FROM heads x LEFT JOIN convs y ON y.c = x.base),
steps AS (SELECT c, unnest(range(len(seq) + 1)) AS d, seq FROM rebuilt),
paths AS (SELECT c, d, seq[1:d] AS p, d = len(seq) AS last FROM steps),
size_of AS (SELECT t, max(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS words FROM turns GROUP BY t),
nodes AS (SELECT p, d, min(c) AS r, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '') AS ends
         FROM paths GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.k, 0) AS k, (n.n - 1) * coalesce(z.words, 0) AS s
         FROM nodes n LEFT JOIN kids k ON k.p = n.p LEFT JOIN size_of z ON n.d > 0 AND z.t = n.p[n.d]),
ups AS (SELECT *, unnest(range(d + 1)) AS u FROM full_nodes),
below AS (SELECT p[1:u] AS p, sum(s) AS saved, count(*) FILTER (WHERE k = 0) AS leaves FROM ups GROUP BY 1)
SELECT n.r AS conv_id, CAST(n.d AS BIGINT) AS depth, q.r AS parent_conv_id, n.n AS n_convs, CAST(n.k AS BIGINT) AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN below b ON b.p = n.p LEFT JOIN nodes q ON n.d > 0 AND q.p = n.p[1:n.d - 1]
"""
