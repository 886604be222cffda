"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles, as 64-bit hashes.  Two
sets A and B with Jaccard similarity of at least t differ in at most
``d = (|A|+|B|) (1-t)/(1+t)`` shingles.

* Size bands.  Sizes fall into bands a quarter wide; a set meets sets of its
  own band and, where t lets it reach so far, of the next one.
* Pigeonhole.  In a band with at most d differences, shingles are dealt by
  hash to ``d + 1 + c`` segments and the hashes of a segment are XORed.  A
  difference touches one segment, so at least c + 1 segments agree.  Each set
  gives up the c segments that rank lowest by (shingles, XOR).  The ranking
  depends on content alone, so the highest-ranked agreeing segment is given
  up by neither side: no link is lost, and the least selective keys go.
* Parity sketch.  Every shingle flips one of 1,024 bits, and for sets of more
  than WIDE_FROM one of the 2 to 4 bits per shingle of a wide sketch, which
  the short one would be too full for.  The Hamming distance of two sketches
  is at most the symmetric difference, so a larger distance than d rejects a
  pair before its shingles are read.  Wide sketches have a power of two words;
  the wider of two is folded to the other's width.
* Verification compares the shingle sets of the pairs that are left.

Equal sets are one class before all this.  Keys are range-partitioned by
(key, id), so one frequent key spans several tasks.  A key's members are
first tied to one hub each, a few times with other hubs; afterwards only
members of different components are compared.  So a group of near copies
gives linear work, and pairs that stay in one component are never listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitframe.llm.common import keep, lower_ascii, small, small_batches, words
from fitframe.llm.components import connected_components

SKETCH_WORDS = 16
WIDE_FROM = 512      # shingles
HUB_ROUNDS = 3
_MIX = np.uint64(0x9E3779B97F4A7C15)

SKETCH_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("sig_a", T.LongType()), T.StructField("sig_b", T.LongType()),
    T.StructField("sketch", T.ArrayType(T.LongType())),
    T.StructField("wide", T.ArrayType(T.LongType())),
    T.StructField("keys", T.ArrayType(T.LongType())),
    T.StructField("text_key", T.LongType()),
])


def shingle_hashes(text: Column, k: int) -> Column:
    """Distinct hashes of the k-word shingles of an A-Z lower-cased text; a
    text of fewer words is one shingle, one without words gives []."""
    w = words(lower_ascii(text))
    return F.transform(F.array(w), lambda a: F.when(F.size(a) == 0, F.array().cast("array<bigint>")).when(
        F.size(a) < k, F.array(F.xxhash64(F.concat_ws(" ", a), F.lit("short")))).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(a) - (k - 1)), lambda i: F.xxhash64(
            *[F.element_at(a, i + j) for j in range(k)])))))[0]


def band_table(largest: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper sizes of the bands up to ``largest`` and the differences allowed
    to two sets of at most that size."""
    tops, top = [], 0
    while top < largest or len(tops) < 2:
        low = top + 1
        top = max(low, low * 5 // 4, (top * den) // num)
        tops.append(top)
    tops = np.array(tops, dtype=np.int64)
    return tops, 2 * tops * (den - num) // (den + num)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _segment_keys(h: np.ndarray, doc: np.ndarray, band: np.ndarray, diffs: np.ndarray):
    """For documents with a band (>= 0): flat (document, key) arrays of the
    segments that are kept."""
    need = np.where(band >= 0, diffs + 1, 0)
    parts = need + need // 4
    base = np.concatenate([[0], np.cumsum(parts)])
    live = band[doc] >= 0
    h, d = h[live], doc[live]
    slot = base[d] + (_mix(h, 0x5EED) % parts[d].astype(np.uint64)).astype(np.int64)
    xors = np.zeros(base[-1], dtype=np.uint64)
    np.bitwise_xor.at(xors, slot, h)
    count = np.bincount(slot, minlength=base[-1])
    owner = np.repeat(np.arange(len(parts)), parts)
    part = np.arange(base[-1]) - base[owner]
    order = np.lexsort((part, xors, -count, owner))
    kept = order[(np.arange(base[-1]) - base[owner]) < need[owner]]
    o = owner[kept]
    place = (band[o].astype(np.uint64) << np.uint64(32)) | part[kept].astype(np.uint64)
    return o, _mix(xors[kept] ^ _mix(place, 0xBA5E), 0x0DD)


def sketch_batches(num: int, den: int):
    """An Arrow function from (id, shingle hashes, text key) to SKETCH_SCHEMA."""
    def run(batches):
        for b in batches:
            lists = b.column(1)
            h = np.asarray(lists.flatten()).astype(np.int64).view(np.uint64)
            n = np.asarray(lists.value_lengths()).astype(np.int64)
            doc = np.repeat(np.arange(len(n)), n)
            sig_a, sig_b = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            np.add.at(sig_a, doc, _mix(h, 0xA))
            np.bitwise_xor.at(sig_b, doc, _mix(h, 0xB))
            bits = np.bincount(doc * (64 * SKETCH_WORDS) + (_mix(h, 0xC) % np.uint64(64 * SKETCH_WORDS)).astype(np.int64),
                               minlength=len(n) * 64 * SKETCH_WORDS) & 1
            sketch = np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)
            width = np.where(n > WIDE_FROM, 1 << np.ceil(np.log2(np.maximum(n, 1) / 32)).astype(np.int64), 0)
            wide_at = np.concatenate([[0], np.cumsum(width)])
            long = width[doc] > 0
            bit = _mix(h[long], 0xD) % (64 * width[doc[long]]).astype(np.uint64)
            wide = np.zeros(wide_at[-1], np.uint64)
            np.bitwise_xor.at(wide, wide_at[doc[long]] + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
            tops, diffs = band_table(int(n.max(initial=1)) * den // num + 1, num, den)
            own = np.searchsorted(tops, n)
            above = np.where((n > 0) & (n * den // num > tops[own]), own + 1, -1)
            own = np.where(n > 0, own, -1)
            pairs = [_segment_keys(h, doc, band, diffs[band]) for band in (own, above)]
            o = np.concatenate([p[0] for p in pairs])
            order = np.argsort(o, kind="stable")
            keys = np.concatenate([p[1] for p in pairs])[order].view(np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(o, minlength=len(n)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n), pa.array(sig_a.view(np.int64)), pa.array(sig_b.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * SKETCH_WORDS), pa.array(sketch)),
                pa.ListArray.from_arrays(pa.array(wide_at.astype(np.int32)), pa.array(wide.view(np.int64))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)), b.column(2),
            ], names=["id", "n", "sig_a", "sig_b", "sketch", "wide", "keys", "text_key"])
    return run


def _shared_runs(batches):
    """Of rows sorted by (key, id): those whose key has a neighbour row in
    the partition, and the first and last row, whose key may go on elsewhere."""
    held = None  # the last row, not yet decided
    prev_key = None
    first = True
    for b in batches:
        if not b.num_rows:
            continue
        key, ids = np.asarray(b.column(0)), np.asarray(b.column(1))
        if held is not None:
            key, ids = np.concatenate([[held[0]], key]), np.concatenate([[held[1]], ids])
        same = key[1:] == key[:-1]
        shared = np.concatenate([[prev_key is not None and prev_key == key[0]], same]) | np.concatenate([same, [False]])
        if first:
            shared[0], first = True, False
        prev_key = key[-2] if len(key) > 1 else prev_key
        held = (key[-1], ids[-1])
        out = shared[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(key[:-1][out]), pa.array(ids[:-1][out])], names=["key", "id"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.int64())], names=["key", "id"])


def _allowed(n: Column, num: int, den: int) -> Column:
    return n * (den - num) / F.lit(den + num)


def _hamming(a: Column, b: Column) -> Column:
    total = F.lit(0)
    for i in range(SKETCH_WORDS):
        total = total + F.bit_count(a[i].bitwiseXOR(b[i]))
    return total


def _wide_hamming(a: str, b: str) -> Column:
    """Hamming distance of two wide sketches, the wider one folded; 0 where
    one of the sets is too small to have any."""
    m = f"least(size({a}), size({b}))"
    fold = lambda x: (f"(CASE WHEN size({x}) = {m} THEN {x} ELSE transform(sequence(0, {m} - 1), i -> "  # noqa: E731
                      f"aggregate(sequence(0, CAST(size({x}) / {m} AS INT) - 1), 0L, (s, j) -> s ^ get({x}, i + j * {m}))) END)")
    return F.expr(f"CASE WHEN {m} <= 0 THEN 0 ELSE aggregate(zip_with({fold(a)}, {fold(b)}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x) END")


def _verified(pairs: DataFrame, near: DataFrame, src: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (u, v) of nodes whose shingle sets are similar enough.  The
    sets are made anew from the texts of these nodes alone: kept for all
    candidates, they would be larger than the texts."""
    pairs = keep(pairs, "pairs")
    both = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    ids = keep(near.select("node", F.col("id").alias("of_id"), F.col("text_key").alias("of_key")).join(both, "node"), "pair-ids")
    sets = (src.join(small(ids), F.col("id").eqNullSafe(F.col("of_id")) & (F.xxhash64("text") == F.col("of_key")))
            .select("node", shingle_hashes(F.col("text"), k).alias("h")))
    a = sets.select(F.col("node").alias("u"), F.col("h").alias("ha"))
    b = sets.select(F.col("node").alias("v"), F.col("h").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return (pairs.join(a, "u").join(b, "v")
            .where(den * both >= num * (F.size("ha") + F.size("hb") - both)).select("u", "v"))


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                    num: int = 90, den: int = 100) -> DataFrame:
    """Link documents whose k-word shingle sets have a Jaccard similarity of
    at least ``num/den`` and return, for every input row, ``(id_col,
    n_shingles, component_id, text_key, group_key)``: the size of its set, the
    least id that links reach, the hash of its text, and a number that the
    linked rows share.

    Null and empty texts have no shingles and stand alone, as their own
    component, with a null group.  A row without an id is linked like any
    other; its component is null where links reach no id.  Repeated rows are
    kept.  Rows of one id with different texts are linked each by its own
    text.  Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    hashed = src.select("id", shingle_hashes(F.col("text"), k).alias("h"), F.xxhash64("text").alias("text_key"))
    sk = keep(hashed.mapInArrow(sketch_batches(num, den), SKETCH_SCHEMA), "sketches")

    # a node is an id; an id on different sets, or a missing one, is replaced
    # by a number for each of its sets
    filled = sk.where("n > 0")
    shared_ids = keep(filled.where("id is not null").groupBy("id").agg(*[f(c).alias(f"{c}_{n}") for c in ("sig_a", "sig_b") for n, f in (("least", F.min), ("most", F.max))])
                      .where("sig_a_least <> sig_a_most or sig_b_least <> sig_b_most").select("id", F.lit(True).alias("of_several")), "shared-ids")
    odd = not shared_ids.isEmpty()
    several = filled.join(small(shared_ids), "id", "left") if odd else filled.withColumn("of_several", F.lit(None).cast("boolean"))
    filled = several.withColumn("node", F.when(F.col("id").isNull() | F.col("of_several"), F.xxhash64("sig_a", "sig_b", F.coalesce("id", F.lit(-1)))).otherwise(F.col("id")))

    classes = filled.groupBy("sig_a", "sig_b").agg(F.min("node").alias("rep"))
    members = keep(filled.select("id", "node", "n", "sig_a", "sig_b", "text_key").join(classes, ["sig_a", "sig_b"])
                   .select("id", "node", "n", "sig_a", "sig_b", "text_key", "rep"), "members")
    copies = keep(members.where("node <> rep").select("node", "sig_a", "sig_b").distinct(), "class-copies")
    reps = filled.join(small(copies), ["node", "sig_a", "sig_b"], "left_anti")

    keyed = reps.select(F.explode("keys").alias("key"), F.col("node").alias("id"))
    shared = (keyed.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
              .mapInArrow(_shared_runs, "key long, id long"))
    shared = keep(shared.distinct(), "shared")

    ids = keep(shared.select(F.col("id").alias("node")).distinct(), "candidates")
    near = keep(reps.select("node", "id", "text_key", "n", "sketch", "wide").join(small(ids), "node", "left_semi"), "near")
    comp = _classes(shared, near, src, k, num, den)
    labelled = (members.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
                .select("id", F.col("n").alias("n_shingles"), "text_key", F.coalesce("component", "rep").alias("group_key")))
    # the least node of a group is its least id, but for made-up numbers
    made_up = members.where("id is null or node <> id") if odd else members.where("id is null")
    if odd or not made_up.isEmpty():
        labelled = keep(labelled, "labelled")
        least = labelled.groupBy("group_key").agg(F.min("id").alias("component_id"))
        labelled = labelled.join(least, "group_key", "left")
    else:
        labelled = labelled.withColumn("component_id", F.col("group_key"))
    names = ["id", "n_shingles", "component_id", "text_key", "group_key"]
    empty = sk.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), "text_key", F.lit(None).cast("long").alias("group_key"))
    return labelled.select(names).unionByName(empty).withColumnRenamed("id", id_col)


def _joined(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """``(node, component)`` after more links: only the components that they
    tie together are worked on."""
    if comp is None:
        return keep(connected_components(links), "comps")
    at = lambda end: comp.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    ties = (links.join(at("u"), "u", "left").join(at("v"), "v", "left")
            .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
    moved = keep(connected_components(ties), "ties")
    relabelled = comp.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select(
        "node", F.coalesce("to", "component").alias("component"))
    fresh = moved.join(comp.select("node"), "node", "left_anti").select("node", "component")
    return keep(relabelled.unionByName(fresh), "comps")


def _classes(shared: DataFrame, near: DataFrame, src: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``(node, component)`` of the sets that are similar to another, by
    links that connect every pair of similar sets."""
    left = near.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("su"), F.col("wide").alias("wu"))
    right = near.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("sv"), F.col("wide").alias("wv"))
    far = F.greatest(_hamming(F.col("su"), F.col("sv")), _wide_hamming("wu", "wv"))
    limit = _allowed(F.col("nu") + F.col("nv"), num, den)
    # the short sketch first: it is compiled, and rejects nearly all small sets
    fits = (_hamming(F.col("su"), F.col("sv")) <= limit) & (_wide_hamming("wu", "wv") <= limit)

    rows = shared.withColumn("comp", F.col("id"))
    comp = None
    for turn in range(HUB_ROUNDS):
        hub = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("o"), "id", "comp")).alias("hub"))
        pairs = rows.join(hub, "key").where("comp <> hub.comp").select(F.col("id").alias("u"), F.col("hub.id").alias("v")).distinct()
        # of its hubs, a document is compared with the nearest by sketch; what
        # that leaves apart is for the next turns and the last comparison
        nearest = (pairs.join(left, "u").join(right, "v").where(fits).groupBy("u")
                   .agg(F.min(F.struct((far / (F.col("nu") + F.col("nv"))).alias("far"), "v")).alias("best")).select("u", "best.v"))
        comp = _joined(comp, keep(_verified(nearest, near, src, k, num, den), "links"))
        rows = (rows.select("key", "id").join(comp, F.col("id") == F.col("node"), "left")
                .select("key", "id", F.coalesce("component", "id").alias("comp")))
        mixed = rows.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key")
        rows = keep(rows.join(mixed, "key", "left_semi"), "mixed")
        if rows.isEmpty():
            return comp

    # what is left: members of one key in different components, all compared
    full = rows.join(near.select(F.col("node").alias("id"), "n", "sketch"), "id")
    a = full.select("key", F.col("id").alias("u"), F.col("comp").alias("cu"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
    b = full.select("key", F.col("id").alias("v"), F.col("comp").alias("cv"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))
    rest = a.join(b, (a["key"] == b["key"]) & (F.col("u") < F.col("v")) & (F.col("cu") != F.col("cv"))
                  & (_hamming(F.col("su"), F.col("sv")) <= limit))
    rest = rest.select("u", "v").distinct().join(left, "u").join(right, "v").where(_wide_hamming("wu", "wv") <= limit)
    return _joined(comp, keep(_verified(rest.select("u", "v"), near, src, k, num, den), "links"))


def run_query(spark, sf_dir):
    """op6: 3-word shingles, links at 0.9, all of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return similar_classes(docs, k=3, num=90, den=100).drop("text_key", "group_key")


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS a FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(a) < 3 THEN array_to_string(a, ' ')
    ELSE array_to_string(a[i:i+2], ' ') END AS g
  FROM (SELECT doc_id, a, unnest(range(1, greatest(len(a) - 2, 1) + 1)) AS i FROM w WHERE len(a) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
texts AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY h) AS rep
  FROM (SELECT doc_id, count(*) AS n, sum(hash(g)::HUGEINT) AS h FROM s GROUP BY doc_id)),
r AS (SELECT s.doc_id, s.g FROM s JOIN texts t ON s.doc_id = t.doc_id AND t.rep = t.doc_id),
p AS (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS i FROM r x JOIN r y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 90 * (a.n + b.n - i)),
c(node, root) AS (SELECT rep, rep FROM texts WHERE rep = doc_id UNION SELECT e.v, c.root FROM c JOIN e ON e.u = c.node)
SELECT d.doc_id, coalesce(t.n, 0)::BIGINT AS n_shingles, coalesce(k.m, d.doc_id) AS component_id
FROM documents d LEFT JOIN texts t ON t.doc_id = d.doc_id
LEFT JOIN (SELECT node, min(root) AS m FROM c GROUP BY node) k ON k.node = t.rep
"""
