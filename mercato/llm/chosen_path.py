"""MinHash near-dedup by a chosen-path set similarity join.

Documents link when ``100 * |A n B| >= threshold * |A u B|`` over their sets of distinct word
shingles (ASCII lower-cased; shingles are equal by 64-bit hash). Every class of equal sets has
one representative, a signature of ``WIDTH`` minwise tokens and a sketch of a bit each.

*Trees.* From a tree's root each set branches along the ``CHOSEN`` positions that the
path so far selects (by hash), to the children named by its minwise tokens there. Two
sets of similarity J share a child with probability J per chosen position, so with two positions a
pair at the threshold 0.8 survives any depth with probability 0.93, and pairs below 0.5
die out. Independent trees are repeated to the target recall (``trees_for``).

*Nodes.* Small nodes are compared exhaustively by sketches (cutoff five standard
deviations below a pair at the threshold), and what is similar is confirmed on full sets.
First each set meets the leaders of its clusters, so a family of near copies becomes a
component with a check or two per set. Then, per node, only sets with a similar one in another
component are left; where these are few, their texts go to the node and are held against each
other there: no pairs are sent, only links. Equal nodes of different trees are one. Other
nodes branch again; what counts as few doubles with each level, which ends the recursion.

*Hot nodes.* Rows are dealt by ranges of (path, set), so a node that holds a third of all sets
is many pieces; a piece sends its leader to the next tier, which joins the pieces.

Defined results: null or blank texts have an empty set, linked with nothing, not with each
other; texts of fewer than ``size`` words are one shingle. Every row is a document of its own,
also where identifiers repeat; a component is named by its smallest identifier (null only if it has no
other). Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import hashing
from mercato.llm.common import arrow_rows, join_hot, texts_of, written
from mercato.llm.components import components

WIDTH = 128             # minwise tokens of a signature, 16 bits each
CHOSEN = 2              # positions along which a set leaves a node
STEPS = 2               # tokens chosen between two comparisons of a tree's nodes
RECALL = 0.999999       # target for a pair at the threshold, over all trees
PIECE = 1024            # sets of a node compared at a time
FEW = 4096              # pairs of different components per row of a small node, at first
SHINGLES = 1 << 22      # shingles of a small node's sets together, at first
TEXT_BYTES = 1 << 20    # text hashed at a time
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NODE = ["path", "id", "n", "s0", "s1"]
_ROWS = "kind int, path long, id long, n int, s0 long, s1 long, other long"


def trees_for(recall: float, threshold: int) -> int:
    """Independent trees for the target recall of a pair at the threshold (in percent): a pair
    survives any depth with the fixed point of ``p = 1 - (1 - J p) ** 2``."""
    j = threshold / 100
    if j <= 0.55:
        raise ValueError("two chosen positions per node need a threshold above 55 percent")
    survives = (2 * j - 1) / j ** 2
    return math.ceil(math.log(1 - recall) / math.log(1 - survives)) if survives < 1 else 1


def cutoff(threshold: int) -> int:
    """Equal sketch bits below which a pair is not confirmed: unequal tokens agree in a bit
    half the time; five standard deviations below the threshold."""
    p = (1 + threshold / 100) / 2
    return math.floor(WIDTH * p - 5 * math.sqrt(WIDTH * p * (1 - p)))


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    codes, bounds = hashing.words([t.encode().lower() for t in texts])
    return [np.unique(hashing.sequence(codes[s:e], min(size, e - s))) if e > s
            else np.zeros(0, np.uint64) for s, e in zip(bounds[:-1], bounds[1:])]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The low 16 bits of ``WIDTH`` minwise tokens of every (non-empty) set."""
    number = np.arange(WIDTH, dtype=np.uint64)
    times = (hashing.mix(number + np.uint64(1)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    plus = hashing.mix(number + np.uint64(1 << 20)).astype(np.uint32)
    items = hashing.mix(np.concatenate(sets)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), WIDTH), np.uint16)
    for i in range(WIDTH):
        out[:, i] = np.minimum.reduceat(items * times[i] + plus[i], starts).astype(np.uint16)
    return out


def _keyed(docs: DataFrame, size: int) -> DataFrame:
    """Every row with its number, set size, digest of its set (two halves) and signature; the
    text stays beside them for the confirmation."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            n, digests, sigs = [], [], []
            for texts in texts_of(b.column(2), TEXT_BYTES):
                sets = shingle_sets(texts, size)
                filled = [s for s in sets if len(s)]
                signed = iter(signatures(filled)) if filled else iter(())
                for s in sets:
                    n.append(len(s))
                    digests.append(_digest(s) if len(s) else (0, 0))
                    sigs.append(next(signed).tobytes() if len(s) else None)
            halves = np.array(digests, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(n, pa.int64()), *(pa.array(h) for h in halves.T), pa.array(sigs, pa.binary())],
                ["row", "doc_id", "text", "n", "d0", "d1", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string"))
    return rows.mapInArrow(run, f"row long, doc_id {kind}, text string, n long, d0 long, d1 long, sig binary")


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    import hashlib

    return tuple(np.frombuffer(hashlib.sha256(shingles.tobytes()).digest()[:16], np.int64).tolist())


def _children(sig: np.ndarray, paths: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Paths ``steps`` tokens further down, and the row of ``sig`` of each."""
    at = np.arange(len(sig))
    for _ in range(steps):
        first = hashing.mix(paths ^ _ODD) % np.uint64(WIDTH)
        chosen = [first]
        for k in range(1, CHOSEN):
            jump = hashing.mix(paths + np.uint64(k)) % np.uint64(WIDTH - 1)
            chosen.append((first + np.uint64(1) + jump) % np.uint64(WIDTH))
        paths = np.concatenate([
            hashing.mix(paths ^ hashing.mix((i << np.uint64(16)) + sig[at, i.astype(np.int64)] + _ODD)) for i in chosen])
        at = np.tile(at, CHOSEN)
    return paths, at


def _signed(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, WIDTH)


def _sketch(sig: np.ndarray) -> np.ndarray:
    return np.packbits((sig & 1).astype(np.uint8), axis=1).view(np.int64)


def _branch(rows: DataFrame, trees: int = 0) -> DataFrame:
    """The ``_NODE`` rows below: of ``(id, n, sig)`` rows those of each tree, of ``(id, n, sig,
    path)`` rows those below their path."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        roots = hashing.mix(np.arange(1, trees + 1, dtype=np.uint64) * _ODD)
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                ids, n = part.column(0).to_numpy(), part.column(1).to_numpy()
                sig = _signed(part.column(2))
                sketch = _sketch(sig)
                starts = ([np.full(len(ids), root) for root in roots] if trees
                          else [part.column(3).to_numpy().view(np.uint64)])
                for paths in starts:
                    below, at = _children(sig, paths, STEPS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (below.view(np.int64), ids[at], n[at], *sketch[at].T)], _NODE)

    return rows.mapInArrow(run, "path long, id long, n int, s0 long, s1 long")


def _equal_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal sketch bits of every row of ``a`` with every row of ``b``."""
    a, b = a.view(np.uint64), b.view(np.uint64)     # of signed numbers, magnitudes would be counted
    differ = np.bitwise_count(a[:, None, 0] ^ b[None, :, 0]).astype(np.int16)
    differ += np.bitwise_count(a[:, None, 1] ^ b[None, :, 1])
    return WIDTH - differ


def _groups(batches: Iterator, keys: int, most: int) -> Iterator:
    """Sorted rows as whole groups of equal leading columns: yields columns, the bounds of the
    groups in them, and whether the first and the last go on beyond. Groups of over
    ``most`` rows come in pieces (0: never)."""
    held, before = None, None
    for b in batches:
        if not b.num_rows:
            continue
        new = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        n = len(held[0])
        change = np.zeros(n - 1, bool)
        for c in held[:keys]:
            change |= c[1:] != c[:-1]
        heads = np.concatenate(([0], np.flatnonzero(change) + 1))
        end = int(heads[-1])
        if most and n - end >= most:
            end = n - (n - end) % most
        if not end:
            continue
        bounds = np.append(heads[heads < end], end)
        key = tuple(c[end - 1] for c in held[:keys])
        on = end < n and tuple(c[end] for c in held[:keys]) == key
        yield [c[:end] for c in held], bounds, before == tuple(c[0] for c in held[:keys]), on
        before, held = key, [c[end:] for c in held]
    if held is not None and len(held[0]):
        change = np.zeros(len(held[0]) - 1, bool)
        for c in held[:keys]:
            change |= c[1:] != c[:-1]
        bounds = np.concatenate(([0], np.flatnonzero(change) + 1, [len(held[0])]))
        yield held, bounds, before == tuple(c[0] for c in held[:keys]), False


def _leaders(batches: Iterator, least: int, ranged: bool) -> Iterator:
    """Meet the sets of each node: kind 0 are similar pairs (each set with its leader), kind 1
    the rows of nodes that these pairs do not settle, kind 2 the leaders of pieces of
    nodes that go on in another piece."""
    import pyarrow as pa

    def rows(kind, at, other=None):
        ids = columns[1]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), kind, np.int32)), *(pa.array(c[at]) for c in columns),
             pa.array(ids[at if other is None else other])], ["kind", *_NODE, "other"])

    first = True
    for (columns, bounds, on_before, on_after), last in _lookahead(_groups(batches, 1, PIECE)):
        sketch = np.stack(columns[3:], 1)
        size = np.diff(bounds)
        more = np.zeros(len(size), bool)
        more[0] |= on_before or (ranged and first)
        more[-1] |= on_after or (ranged and last)
        first = False
        pair = bounds[np.flatnonzero((size == 2) & ~more)]
        if len(pair):
            differ = np.bitwise_count((sketch[pair] ^ sketch[pair + 1]).view(np.uint64)).sum(1).astype(np.int64)
            pair = pair[WIDTH - differ >= least]
            yield rows(0, pair + 1, pair)
        for g in np.flatnonzero((size > 2) | more):
            for s in range(bounds[g], bounds[g + 1], PIECE):
                e = min(s + PIECE, int(bounds[g + 1]))
                pieces = more[g] or size[g] > PIECE
                near = _equal_bits(sketch[s:e], sketch[s:e]) >= least
                leader = np.full(e - s, -1)
                for i in range(e - s):
                    if leader[i] < 0:
                        leader[(leader < 0) & near[i]] = i
                follows = np.flatnonzero(leader != np.arange(e - s))
                if len(follows):
                    yield rows(0, s + follows, s + leader[follows])
                # settled: no similar pair but those of a set and its leader
                if pieces or near.sum() > e - s + 2 * len(follows):
                    yield rows(1, np.arange(s, e))
                if pieces:
                    yield rows(2, np.array([s + int(np.bincount(leader).argmax())]))


def _lookahead(items: Iterator) -> Iterator:
    """Items with whether each is the last."""
    held = None
    for item in items:
        if held is not None:
            yield held, False
        held = item
    if held is not None:
        yield held, True


def _met(nodes: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Similar pairs ``(a, b)`` of a level's nodes, and the rows that are not settled."""
    dealt = nodes.repartitionByRange("path", "id").sortWithinPartitions("path", "id").select(*_NODE)
    met = written(dealt.mapInArrow(lambda b: _leaders(b, least, True), _ROWS))
    rows, pairs, tier = met.where("kind = 1").select(*_NODE), met.where("kind = 0"), met.where("kind = 2")
    while not tier.isEmpty():               # leaders of pieces: a thousandth of the rows each time
        dealt = tier.select(*_NODE).distinct().repartition("path").sortWithinPartitions("path", "id")
        met = written(dealt.mapInArrow(lambda b: _leaders(b, least, False), _ROWS))
        pairs, tier = pairs.unionByName(met.where("kind = 0")), met.where("kind = 2")
    pairs = pairs.select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b"))
    return written(pairs.distinct()), rows


def _across(batches: Iterator, least: int) -> Iterator:
    """Of (path, chunk) groups the sets that have a similar one in another component, under the
    digest of the group's sets."""
    import hashlib

    import pyarrow as pa

    for columns, bounds, _, _ in _groups(batches, 2, 0):
        _, _, ids, s0, s1, comp, main = columns
        sketch = np.stack((s0, s1), 1)
        for s, e in zip(bounds[:-1], bounds[1:]):
            rest = np.flatnonzero(~main[s:e]) + s
            hit = np.zeros(e - s, bool)
            for i in range(0, len(rest), 256):
                mine = rest[i:i + 256]
                near = (_equal_bits(sketch[mine], sketch[s:e]) >= least) & (comp[mine][:, None] != comp[None, s:e])
                hit |= near.any(0)
                hit[mine - s] |= near.any(1)
            at = np.flatnonzero(hit) + s
            if len(at):
                digest = np.frombuffer(hashlib.sha256(np.sort(ids[at]).tobytes()).digest()[:16], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), digest[0])), pa.array(np.full(len(at), digest[1])),
                     *(pa.array(x[at]) for x in (ids, s0, s1, comp))], ["g0", "g1", "id", "s0", "s1", "comp"])


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Parity bitmaps of sets, rows of 64-bit words, several bits per shingle of the largest. Two
    bitmaps differ in no more bits than the sets differ in shingles."""
    bits = 64
    while bits < 4 * max(map(len, sets)):
        bits *= 2
    at = np.concatenate(sets) & np.uint64(bits - 1)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.zeros((len(sets), bits // 64), np.uint64)
    np.bitwise_xor.at(out, (row, (at >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (at & np.uint64(63)))
    return out


def _links_of(rows: list, threshold: int) -> Iterator:
    """Links between the components of a group's sets."""
    ids, sketch, comp, sets = zip(*rows)
    sketch, comp, n = np.array(sketch), np.array(comp), np.array([len(s) for s in sets])
    bitmaps = _bitmaps(sets)
    step = max(1, (1 << 22) // bitmaps.shape[1])        # pairs whose bitmaps are held at a time
    for i in range(0, len(ids), 256):
        equal = _equal_bits(sketch[i:i + 256], sketch)
        x, y = np.nonzero((equal >= cutoff(threshold)) & (comp[i:i + 256, None] != comp)
                          & (np.arange(len(ids)) < np.arange(i, min(i + 256, len(ids)))[:, None])
                          & (100 * np.minimum(n[i:i + 256, None], n) >= threshold * np.maximum(n[i:i + 256, None], n)))
        x += i
        order = np.argsort(-equal[x - i, y], kind="stable")          # the likeliest links first
        for j in range(0, len(x), step):
            a, b = x[order[j:j + step]], y[order[j:j + step]]
            differ = np.bitwise_count(bitmaps[a] ^ bitmaps[b]).sum(1).astype(np.int64)
            may = (n[a] + n[b] - differ) * (100 + threshold) >= 2 * threshold * (n[a] + n[b])
            for u, v in zip(a[may], b[may]):
                if comp[u] != comp[v]:
                    both = _common(sets[u], sets[v])
                    if 100 * both >= threshold * (n[u] + n[v] - both):
                        comp[comp == comp[v]] = comp[u]
                        yield max(ids[u], ids[v]), min(ids[u], ids[v])


def _linked(batches: Iterator, size: int, threshold: int) -> Iterator:
    """Links between components in groups of sets, from rows sorted by group: similar pairs are
    held against each other until their components are one. A group's sets are held."""
    group, held = None, []
    for batch in batches:
        out, at = [], 0
        for texts in texts_of(batch.column(6), TEXT_BYTES):
            part = batch.slice(at, len(texts))
            at += len(texts)
            for g0, g1, i, s0, s1, c, mine in zip(
                    *(part.column(j).to_pylist() for j in range(6)), shingle_sets(texts, size)):
                if (g0, g1) != group:
                    out += _links_of(held, threshold) if len(held) > 1 else []
                    group, held = (g0, g1), []
                held.append((i, (s0, s1), c, mine))
        yield _pairs(out)
    if len(held) > 1:
        yield _pairs(list(_links_of(held, threshold)))


def _pairs(rows: list):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], ["a", "b"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = b.searchsorted(a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _confirmed(batches: Iterator, size: int, threshold: int) -> Iterator:
    """Pairs that link, from rows by hub: the hub's text first, then those it is held
    against. One hub's set is held."""
    hub, held = None, None
    for batch in batches:
        out, at = [], 0
        for texts in texts_of(batch.column(2), TEXT_BYTES):
            part = batch.slice(at, len(texts))
            at += len(texts)
            for h, other, mine in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                      shingle_sets(texts, size)):
                if other is None:
                    hub, held = h, mine
                    continue
                assert hub == h
                both = _common(held, mine)
                if 100 * both >= threshold * (len(held) + len(mine) - both):
                    out.append((other, h))
        yield _pairs(out)


class _Links:
    """Links and components so far. ``texts`` holds the sets that may have a partner."""

    def __init__(self, texts: DataFrame, size: int, threshold: int):
        self.texts, self.size, self.threshold = texts, size, threshold
        self.links = self.roots = None
        self.stale = False

    def add(self, links: DataFrame, name: bool) -> None:
        """Take in links; ``name`` the components anew."""
        links = written(links)
        if not links.isEmpty():
            self.links = links if self.links is None else self.links.unionByName(links)
            self.stale = True
        if name and self.stale:
            self.roots, self.stale = written(components(self.links)), False

    def confirm(self, pairs: DataFrame, name: bool) -> None:
        """Add those of the pairs that link on their full sets. A pair's smaller set is its hub,
        a leader of pieces, so a hub has as many partners as these had rows."""
        texts = self.texts.hint("merge")
        hubs = pairs.select("b").distinct().join(texts, F.col("b") == F.col("id")).select(
            "b", F.lit(None).cast("long").alias("a"), "text")
        rows = pairs.join(texts, F.col("a") == F.col("id")).select("b", "a", "text").unionByName(hubs)
        dealt = rows.repartition("b").sortWithinPartitions("b", F.col("a").asc_nulls_first())
        size, threshold = self.size, self.threshold
        with arrow_rows(pairs.sparkSession, 512):
            self.add(dealt.mapInArrow(lambda b: _confirmed(b, size, threshold), "a long, b long"), name)

    def labelled(self, rows: DataFrame, node: str = "id", name: str = "comp") -> DataFrame:
        """The rows with the component of their set."""
        if self.roots is None:
            return rows.withColumn(name, F.col(node))
        roots = self.roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        return (rows.join(roots, F.col(node) == F.col("_node"), "left")
                .withColumn(name, F.coalesce("_root", node)).drop("_node", "_root"))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets are in different components."""
        return self.labelled(self.labelled(pairs, "a", "_x"), "b", "_y").where("_x <> _y").select("a", "b")

    def within(self, groups: DataFrame) -> None:
        """Add the links between components in groups of sets (``_across``), and name them."""
        texts = self.texts.hint("merge")
        rows = groups.dropDuplicates(["g0", "g1", "id"]).join(texts, "id")
        dealt = (rows.select("g0", "g1", "id", "s0", "s1", "comp", "text").repartition("g0", "g1")
                 .sortWithinPartitions("g0", "g1", "id"))
        size, threshold = self.size, self.threshold
        with arrow_rows(groups.sparkSession, 512):
            self.add(dealt.mapInArrow(lambda b: _linked(b, size, threshold), "a long, b long"), True)


def _open(rows: DataFrame) -> DataFrame:
    """Rows of the nodes that hold several components, with the size of the main one and the
    pairs of different components."""
    sizes = rows.groupBy("path", "comp").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("_n"))
    nodes = sizes.groupBy("path").agg(
        F.sum("k").alias("m"), F.max("k").alias("n_main"), F.max_by("comp", "k").alias("main"),
        F.sum("_n").alias("shingles"),
        ((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).cast("double").alias("pairs"))
    return join_hot(rows, written(nodes.where("pairs > 0")), ["path"], "m", "id")


def _groups_of(rows: DataFrame, least: int) -> DataFrame:
    """The sets of small nodes that have a similar one in another component. The main
    component's rows are dealt to chunks, the others go to every chunk of their node."""
    chunks = F.ceil(F.col("n_main") / PIECE).cast("int")
    rows = rows.withColumn("is_main", F.col("comp") == F.col("main")).withColumn("chunk", F.explode(
        F.when(F.col("is_main"), F.array(F.pmod(F.xxhash64("id"), chunks).cast("int")))
        .otherwise(F.sequence(F.lit(0), chunks - 1))))
    dealt = (rows.select("path", F.col("chunk").cast("long"), "id", "s0", "s1", "comp", "is_main")
             .repartition("path", "chunk").sortWithinPartitions("path", "chunk", "id"))
    return dealt.mapInArrow(lambda b: _across(b, least), "g0 long, g1 long, id long, s0 long, s1 long, comp long")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, threshold: int = 80,
         recall: float = RECALL, few: int = FEW) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    with arrow_rows(docs.sparkSession, 512):
        keyed = written(_keyed(docs, size))
    classes = written(keyed.where("n > 0").groupBy("d0", "d1").agg(
        F.min("row").alias("id"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")))
    signed = written(keyed.select(F.col("row").alias("id"), F.col("n").cast("int").alias("n"), "sig")
                     .join(classes.select("id").hint("merge"), "id", "left_semi"))

    least, shingles, found = cutoff(threshold), SHINGLES, None
    nodes = written(_branch(signed, trees_for(recall, threshold)))
    while True:
        pairs, rows = _met(nodes, least)
        rows = written(rows)
        if found is None:                   # deeper levels only hold sets of these
            partners = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(rows.select("id")).distinct()
            texts = written(keyed.select(F.col("row").alias("id"), "text").join(
                partners.hint("merge"), "id", "left_semi"))
            found = _Links(texts, size, threshold)
        done = rows.isEmpty()
        found.confirm(pairs.groupBy("a").agg(F.min("b").alias("b")), True)
        found.confirm(found.apart(pairs), done)         # else named together with what the nodes give
        if done:
            break
        rows = written(_open(found.labelled(rows)))
        small = (F.col("pairs") <= F.col("m") * few) & (F.col("shingles") <= shingles)
        found.within(written(_groups_of(rows.where(small), least)))
        large = rows.where(~small)
        if large.isEmpty():
            break
        nodes = written(_branch(large.select("path", "id").join(signed, "id").select("id", "n", "sig", "path")))
        few, shingles = few * 2, shingles * 2

    named = classes
    if found.roots is not None:
        named = found.labelled(classes)
        whole = named.groupBy("comp").agg(F.min("least").alias("smallest"), F.count(F.lit(1)).alias("members"))
        named = join_hot(named, written(whole), ["comp"], "members", "id").withColumn("least", F.col("smallest"))
    named = named.select("d0", "d1", F.col("least").alias("component_id"), "rows")
    rows = keyed.select("row", "doc_id", "n", "d0", "d1")
    linked = join_hot(rows.where("n > 0"), written(named), ["d0", "d1"], "rows", "row")
    linked = linked.select("doc_id", "n", "component_id").unionByName(
        rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                         F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
