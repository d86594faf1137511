"""Conversation prefix trie by vertical bitmaps.

A node is a distinct sequence of first turns (role, text); the root is the empty one.
``build`` returns every node with its members, children, leaves and the bytes that
sharing it saves.

*Shards.* Conversations are dealt by ranges of ``conv_id`` and cut into shards of at most
``CONVS`` whole conversations. A shard indexes (position, turn) to a bitset of its
conversations and goes depth first: the parent's bitset, intersected with the postings of
the next position, gives the children; popcounts give the member counts, the bitset of the
conversations of that length the end list. Each intersection takes the posting of the
lowest member left, so there are as many as children; a lone member is one chain.

*Shards together.* A node is known by its depth and 128 bits of hashes over its (position,
turn) pairs, so shards meet by (depth, hash) as numbers, never as texts. Only nodes of several
shards are matched: the shard with the smallest member owns a node. Every subtree total is
a sum over members less a sum over owned nodes, so each shard adds up its own preorder
ranges and the shards' shares are added; no round per depth.

Memory: a shard, and the longest single conversation at 40 bytes a turn (a sequence is one
task's, its texts are not: only digests leave the scan). A first turn or a whole
conversation that a third of all rows repeat is one row per shard.

Defined results: a null role or text counts as empty; a null turn comes first; equal
turns are ordered by role, then by the digest of role and text; repeated rows are turns of their own; rows
without a ``conv_id`` belong to no conversation and are left out; a conversation without
turns is a member of the root. Empty tables give no nodes. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm import hashing
from mercato.llm.common import written

CONVS = 4096        # conversations of a shard (bits of a bitset)
TURNS = 1 << 16     # turns after which a shard is closed at the next conversation
_LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

_LOCAL = ("shard long, node long, parent long, size long, depth long, hash_a long, hash_b long, "
          "conv_id long, n_convs long, n_children long, n_bytes long, ends string")
_KEY = ["depth", "hash_a", "hash_b"]
_PART = ("depth long, hash_a long, hash_b long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, shared boolean, shard long, ends string")


class Trie(NamedTuple):
    """``nodes``: depth, hash_a, hash_b (the node's key), conv_id (smallest member),
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens; the last turn of a node is turn
    ``depth`` of ``conv_id``. ``ends``: depth, hash_a, hash_b, shard, ends: the conversations that
    end at a node, comma-joined in shares whose order is that of ``shard``."""

    nodes: DataFrame
    ends: DataFrame


def numbered(turns: DataFrame) -> DataFrame:
    """``(conv_id, pos, key, n_bytes)`` of every turn: its place from 1, the first half of
    the SHA-256 of role and text, the bytes of its text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.substring(F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256), 1, 32))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    return (turns.where("conv_id is not null")
            .select("conv_id", "turn", role.alias("role"), key.alias("key"),
                    F.octet_length(text).cast("long").alias("n_bytes"))
            .select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "key", "n_bytes"))


def rebuilt(turns: DataFrame, block: int = 5, most: int = 9) -> DataFrame:
    """Conversations that begin like a neighbour, as ``numbered`` gives them: the first h turns of
    conversation ``c - c % block``, then the own turns after the first h, with
    ``h = crc32(c) % most``. A conversation's first row has no key."""
    own = written(numbered(turns))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(most)).alias("h")
    convs = own.where("pos = 1").select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % F.lit(block)).alias("lender"), h)
    heads = own.where((F.col("pos") < most) & (F.col("conv_id") % F.lit(block) == 0)).select(
        F.col("conv_id").alias("lender"), "pos", "key", "n_bytes")
    lent = convs.join(heads, "lender").where("pos <= h").select("conv_id", "pos", "key", "n_bytes")
    rest = own.select("*", h).where("pos > h").select(
        "conv_id", (F.col("pos") + most).alias("pos"), "key", "n_bytes")
    marks = convs.select("conv_id", F.lit(0).cast("long").alias("pos"),
                         F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("n_bytes"))
    return marks.unionByName(lent).unionByName(rest)


def _shard(convs: np.ndarray, starts: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> dict:
    """The trie of some conversations: turns ``starts[k]:starts[k + 1]`` of ``keys`` and
    ``sizes`` are those of ``convs[k]``. Columns of its nodes in preorder."""
    lengths = np.diff(starts)
    depth = (np.arange(starts[-1]) - np.repeat(starts[:-1], lengths) + 1).astype(np.uint64)
    hashes = []
    for lane, odd in zip(keys.T, _LANES):
        acc = np.concatenate((np.zeros(1, np.uint64), np.bitwise_xor.accumulate(
            hashing.mix(lane ^ hashing.mix(depth * odd)))))
        hashes.append(acc[1:] ^ np.repeat(acc[starts[:-1]], lengths))
    turn = np.unique(keys, axis=0, return_inverse=True)[1].ravel().tolist() if len(keys) else []
    first, length = starts.tolist(), lengths.tolist()

    postings: dict[tuple[int, int], int] = {}
    stop: dict[int, int] = {}
    for k, n in enumerate(length):
        bit, at = 1 << k, first[k]
        stop[n] = stop.get(n, 0) | bit
        for d in range(n):
            place = (d, turn[at + d])
            postings[place] = postings.get(place, 0) | bit

    lowest, deep, parent, members, ends = [], [], [], [], []
    stack = [((1 << len(length)) - 1, 0, -1)]
    while stack:
        bits, d, up = stack.pop()
        low = (bits & -bits).bit_length() - 1
        count = bits.bit_count()
        if count == 1:                                  # one conversation: a chain to its end
            n, at = length[low] - d + 1, len(deep)
            lowest += [low] * n
            deep += range(d, d + n)
            parent += [up, *range(at, at + n - 1)]
            members += [1] * n
            ends += [None] * (n - 1) + [str(convs[low])]
            continue
        at = len(deep)
        done = bits & stop.get(d, 0)
        lowest.append(low)
        deep.append(d)
        parent.append(up)
        members.append(count)
        ends.append(",".join(str(convs[k]) for k in _ones(done)) if done else None)
        left, children = bits & ~done, []
        while left:
            k = (left & -left).bit_length() - 1
            child = left & postings[d, turn[first[k] + d]]
            children.append((child, d + 1, at))
            left &= ~child
        stack += reversed(children)

    size, kids = [1] * len(deep), [0] * len(deep)
    for i in range(len(deep) - 1, 0, -1):
        size[parent[i]] += size[i]
        kids[parent[i]] += 1
    deep, lowest = np.array(deep), np.array(lowest)
    row = starts[lowest] + deep - 1
    inner = deep > 0

    def of_turn(values):
        out = np.zeros(len(deep), values.dtype)
        out[inner] = values[row[inner]]
        return out.view(np.int64)

    return {"node": np.arange(len(deep)), "parent": np.array(parent), "size": np.array(size), "depth": deep,
            "hash_a": of_turn(hashes[0]), "hash_b": of_turn(hashes[1]), "conv_id": convs[lowest],
            "n_convs": np.array(members), "n_children": np.array(kids), "n_bytes": of_turn(sizes), "ends": ends}


def _ones(bits: int) -> Iterator[int]:
    while bits:
        yield (bits & -bits).bit_length() - 1
        bits &= bits - 1


def _shards(batches: Iterator, convs_a_shard: int, turns_a_shard: int) -> Iterator:
    """Cut sorted rows into shards of whole conversations and send their nodes."""
    import pyarrow as pa

    def table(ids, has, keys, sizes):
        heads = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        turns_before = np.concatenate(([0], np.cumsum(has)))
        starts = turns_before[np.concatenate((heads, [len(ids)]))]
        keys, sizes = keys[has], sizes[has]
        for i in range(0, len(heads), convs_a_shard):
            cut = starts[i:i + convs_a_shard + 1]
            columns = _shard(ids[heads[i:i + convs_a_shard]], cut - cut[0],
                             keys[cut[0]:cut[-1]], sizes[cut[0]:cut[-1]])
            n = len(columns["node"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, ids[heads[i]]), pa.int64()),
                 *(pa.array(v, pa.string() if k == "ends" else pa.int64()) for k, v in columns.items())],
                ["shard", *columns])

    held: list = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        raw = b.column(1)
        has = np.asarray(raw.is_valid())
        keys = np.zeros((b.num_rows, 2), np.uint64)
        keys[has] = np.frombuffer(b"".join(raw.drop_null().to_pylist()), np.uint64).reshape(-1, 2)
        held.append((b.column(0).to_numpy(), has, keys, b.column(2).to_numpy()))
        rows += b.num_rows
        if rows >= turns_a_shard and held[0][0][0] != held[-1][0][-1]:
            whole = [np.concatenate(x) for x in zip(*held)]
            cut = int(whole[0].searchsorted(whole[0][-1]))       # the last conversation may go on
            yield from table(*(x[:cut] for x in whole))
            held = [tuple(x[cut:] for x in whole)]
            rows = len(held[0][0])
    if held:
        yield from table(*(np.concatenate(x) for x in zip(*held)))


def _shares(nodes, known):
    """A shard's share of its nodes' totals; ``known`` tells of the nodes that other
    shards have too: the smallest member of all and whether any has a child."""
    import pyarrow as pa

    nodes = nodes.sort_by("node")
    c = {k: nodes[k].to_numpy() for k in ("parent", "size", "depth", "hash_a", "hash_b", "conv_id",
                                          "n_convs", "n_children", "n_bytes")}
    least, leaf = c["conv_id"].copy(), c["n_children"] == 0
    shared = np.zeros(len(least), bool)
    if known.num_rows:
        at = known["at"].to_numpy()
        shared[at] = True
        least[at] = known["least"].to_numpy()
        leaf[at] = ~known["any_child"].to_numpy(zero_copy_only=False)
    owned = least == c["conv_id"]
    inner = c["parent"] >= 0

    def subtree(values):
        sums = np.concatenate(([0], np.cumsum(values)))
        return sums[np.arange(len(values)) + c["size"]] - sums[:-1]

    up = pa.array(np.where(inner, least[c["parent"]], 0), pa.int64(), mask=~inner)
    return pa.table({
        "depth": c["depth"], "hash_a": c["hash_a"], "hash_b": c["hash_b"], "conv_id": least,
        "parent_conv_id": up, "n_convs": c["n_convs"],
        "n_children": np.bincount(c["parent"][inner & owned], minlength=len(least)),
        "n_leaves": subtree((owned & leaf).astype(np.int64)),
        "saved_tokens": subtree((c["n_convs"] - owned) * c["n_bytes"]),
        "shared": shared, "shard": nodes["shard"], "ends": nodes["ends"]})


def build(sequences: DataFrame, convs: int = CONVS, turns: int = TURNS) -> Trie:
    """The trie of ``(conv_id, pos, key, n_bytes)`` rows (``numbered``, ``rebuilt``); a row
    without a key only says that the conversation exists."""
    rows = written(sequences.select("conv_id", "pos", "key", "n_bytes"))
    rows = (rows.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "pos")
            .select("conv_id", "key", "n_bytes"))
    local = written(rows.mapInArrow(lambda b: _shards(b, convs, turns), _LOCAL))
    several = (local.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("shards"), F.min("conv_id").alias("least"),
                                        (F.max("n_children") > 0).alias("any_child"))
               .where("shards > 1").drop("shards"))
    places = local.select(F.col("shard").alias("in_shard"), F.col("node").alias("at"), *_KEY)
    known = places.join(several, _KEY).drop(*_KEY)
    parts = written(local.groupBy("shard").cogroup(known.groupBy("in_shard")).applyInArrow(_shares, _PART))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    met = parts.where("shared").groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.min("parent_conv_id").alias("parent_conv_id"), *sums)
    alone = parts.where("not shared").select(*met.columns)
    return Trie(alone.unionByName(met), parts.where("ends is not null").select(*_KEY, "shard", "ends", "shared"))


def _digests(batches: Iterator) -> Iterator:
    """SHA-256 of every node's end list from its shares in order, one share held at a time."""
    import pyarrow as pa

    node, digest = None, None
    for b in batches:
        out: list = []
        for *key, ends in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if key != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], [*_KEY, "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())],
                                         [*_KEY, "ends_sha256"])


def with_ends_digest(trie: Trie) -> DataFrame:
    """The nodes with the SHA-256 of their comma-joined end lists (of the empty text where
    nothing ends). A digest runs over the whole list, so one task streams each list."""
    alone = trie.ends.where("not shared").select(*_KEY, F.sha2("ends", 256).alias("ends_sha256"))
    met = (trie.ends.where("shared").drop("shared").repartition(*_KEY).sortWithinPartitions(*_KEY, "shard")
           .mapInArrow(_digests, "depth long, hash_a long, hash_b long, ends_sha256 string"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return (trie.nodes.join(alone.unionByName(met), _KEY, "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)))
