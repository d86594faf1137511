"""Conversation prefix trie against a brute-force version."""

import hashlib
import random
import zlib

import pytest

from mercato.llm import prefix_trie, queries
from tests.conftest import SF_SMALL

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """(role, text) turns of every conversation in order."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn, role or "", text or ""))
    def order(t):
        key = hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()
        return t[0], t[1] or 0, t[2], key
    return {c: [t[2:] for t in sorted(turns, key=order)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        lender = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = convs.get(lender, [])[:h] + turns[h:]
    return out


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {k: 0 for k in nodes}
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k, members in nodes.items():
        weight = (len(members) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += weight
            leaves[k[:d]] += kids[k] == 0
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids[k], leaves[k],
                    saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def random_rows(seed, convs=60):
    rnd = random.Random(seed)
    rows = []
    for c in range(-7, convs):
        if rnd.random() < 0.1:
            continue
        same = rnd.random() < 0.4                     # a common conversation, cut somewhere
        for t in range(rnd.randrange(1, 14)):
            text = f"t{t}" if same else rnd.choice(["a", "b", "é", "", None, "x" * 50])
            rows.append((c, None if rnd.random() < 0.05 else t, rnd.choice(["user", "user", None]) if not same
                         else "user", text))
    rows += [rows[3], rows[3], (None, 1, "user", "lost"), (1000, 0, None, None)]
    rnd.shuffle(rows)
    return rows


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op11_prefix_trie(spark, SF_SMALL)) == brute(rebuilt(sequences(rows)))


@pytest.mark.parametrize("seed,convs,turns", [(1, 4096, 1 << 16), (2, 3, 8), (3, 1, 1), (4, 7, 20)])
def test_random_conversations(spark, seed, convs, turns):
    """Nulls anywhere, repeated rows, negative identifiers, conversations rebuilt without turns;
    shards down to one conversation."""
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    trie = prefix_trie.build(prefix_trie.rebuilt(df), convs, turns)
    got = rows_of(prefix_trie.with_ends_digest(trie))
    want = rebuilt(sequences(rows))
    assert any(not turns for turns in want.values())
    assert got == brute(want)


def test_plain_sequences_and_extra_columns(spark):
    rows = random_rows(9, 20)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", pos int, key string")
    trie = prefix_trie.build(prefix_trie.numbered(df), 4)
    assert rows_of(prefix_trie.with_ends_digest(trie)) == brute(sequences(rows))
    listed = sorted(int(c) for r in trie.ends.collect() for c in r.ends.split(","))
    assert listed == sorted(sequences(rows))                   # every conversation ends once


def test_one_conversation_that_most_repeat(spark):
    turns = [("user", "hi"), ("assistant", "yes " * 50), ("user", "bye")]
    rows = [(c, t, *turn) for c in range(500) for t, turn in enumerate(turns)]
    rows += [(c, 0, "user", f"own {c}") for c in range(500, 520)]
    trie = prefix_trie.build(prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA)), 16)
    assert rows_of(prefix_trie.with_ends_digest(trie)) == brute(sequences(rows))


def test_long_conversation(spark):
    rows = [(c, t, "user", f"{t}") for c in (1, 2) for t in range(3000)] + [(1, 3000, "user", "z" * 100000)]
    trie = prefix_trie.build(prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA)), 1, 100)
    got = {r.depth: r for r in trie.nodes.collect()}
    assert len(got) == 3002 and got[0].saved_tokens == sum(len(str(t)) for t in range(3000))
    assert got[3000].n_convs == 2 and got[3001].n_convs == 1 and got[0].n_leaves == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    trie = prefix_trie.build(prefix_trie.rebuilt(empty))
    assert prefix_trie.with_ends_digest(trie).count() == 0
