import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from fitframe.llm import conversation_trie as trie

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    """Nodes of the trie from real sequences of (role, text)."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        seq = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * (len(WORD.findall(p[-1][1])) if p else 0)
        sums[p] = (own + sum(sums[q][0] for q in kids[p]), sum(sums[q][1] for q in kids[p]) or 1)
    return sorted((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(kids[p]), sums[p][1], sums[p][0],
                   hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()) for p in members)


def result(df):
    return sorted(tuple(r[f] for f in FIELDS) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, a string")


def planted():
    rows = []
    for c in range(0, 130):
        if c in (40, 60):  # bases that are absent
            continue
        kind = c % 7
        for t in range(kind):
            rows.append((c, t, "user" if t % 2 == 0 else None, f"the {'same' if kind < 4 else c} turn {t}" if t != 2 else None))
    rows += [(5, None, "user", "null turn goes first"), (5, None, None, None), (None, 0, "user", "nobody"), (-3, 0, "u", "negative"), (-20, 1, "u", "below"),
             (1, 0, "user", "tie"), (1, 0, "user", "tie"), (300, 0, "u", "x " * 5000), (301, 0, "u", "x " * 5000)]
    return rows


def test_nodes_as_by_brute_force(spark):
    rows = planted()
    assert result(trie.build_trie(frame(spark, rows))) == brute(rows)
    assert trie.build_trie(frame(spark, []).select("conv_id", "turn", "role", "text")).count() == 0


def test_given_table_by_brute_force_and_sql(spark):
    t = spark.read.parquet(f"{SF}/conversations.parquet")
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in t.collect()])
    assert result(trie.run_query(spark, SF)) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    got = con.execute(trie.ORACLE).fetchall()
    assert sorted(got) == want


def test_sql_on_planted_rows():
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", planted())
    assert sorted(con.execute(trie.ORACLE).fetchall()) == brute(planted())


def test_long_and_common_conversations_over_many_tasks(spark, monkeypatch):
    """One conversation of many turns, one shared by many ids, ids hashed in
    several pieces, nodes with many children: every split path is taken."""
    monkeypatch.setattr(trie, "PIECE", 100)
    monkeypatch.setattr(trie, "HOT_CHILDREN", 3)
    monkeypatch.setattr(trie, "CHAIN_ROWS", 50)
    rows = [(100, t, "u", f"turn {t // 2}") for t in range(400)]
    rows += [(c, t, "u", f"shared {t}") for c in range(1000, 1200) for t in range(4)]
    rows += [(c, t, "u", f"shared {t}" if t < 3 else f"own {c}") for c in range(1200, 1240) for t in range(5)]
    assert result(trie.build_trie(frame(spark, rows).repartition(13))) == brute(rows)


def test_equal_hashes_of_different_turns_are_found_and_rebuilt(spark, monkeypatch):
    plain = trie.stored_turns

    def colliding(df, seed, *cols):
        got = plain(df, seed, *cols)
        if seed:
            return got
        from pyspark.sql import functions as F
        return got.withColumn("h1", F.lit(1).cast("long")).withColumn("h2", F.lit(2).cast("long"))
    monkeypatch.setattr(trie, "stored_turns", colliding)
    rows = [(1, 0, "u", "one"), (2, 0, "u", "two"), (3, 0, "u", "two")]
    assert result(trie.build_trie(frame(spark, rows))) == brute(rows)


def test_fingerprints_compose():
    import numpy as np
    a = np.array([1, 3, 2**63 + 1, 2**64 - 1, 987654321987654321], np.uint64)
    assert (a * trie._inverse(a) == 1).all()
    assert trie._signed(2**64 - 1) == -1 and pytest.approx(trie._signed(5)) == 5
