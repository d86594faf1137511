"""Exact n-gram Jaccard join: size-banded tiles, bitmap signatures, exact check.

Two documents link when ``100 * |A n B| >= threshold * |A u B|`` over their sets of
distinct word shingles (ASCII lower-cased; equality of shingles by 64-bit hash).

*Tiles.* Sizes are cut into bands. Linked sets differ in at most H shingles, where
H follows from the band, so if the hash range is cut into H + 1 slices and some spare
ones, two linked sets agree on more slices than are spare. A tile is (band, slice, content of the
slice); a document enters the tiles of its band and, if a linked set may be that
small, of the band below. Tiles are found from packed (tile, document) runs: a task
keeps one entry per tile, so a tile shared by a third of all rows arrives as one
entry per task, not per row.

*Signatures.* A document has a parity bitmap of its hashed shingles, as many bits
as shingles. Two bitmaps differ in no more bits than the sets differ in shingles,
so the bit count bounds the overlap from above; only pairs below the bound are
compared by intersecting the sorted arrays.

*Links without all pairs.* The smallest document of a tile is its hub; documents
that share a tile share the group of its hub. Groups are first cut down by bitmaps
alone: documents that a chain of pairs within the bound connects are one family, and
every link lies inside a family. Then each text goes once, to its family, where pairs
of different components are held against each other by bitmaps and sets, and
components joined as soon as one link is found. A family of more than ``GROUP``
members (a huge group of near copies) does not go to one task: every member first
meets the smallest; where they still fall into several components, the members
outside the largest are held against all, in blocks of bounded size, by bitmaps; in
the first rounds each keeps its best partner per block only, in the last all
remaining pairs of different components are checked. No link between different
components is lost; pairs inside a component need no check.

Defined results: null or blank texts have an empty set, linked with nothing; texts
of fewer than ``size`` words are one shingle. Rows with a null identifier get their
set size, are linked with nothing and have a null component. Rows repeating an
identifier are one node, linked where any of them links. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import hashing
from mercato.llm.common import arrow_rows, texts_of, written
from mercato.llm.components import components

BAND_GROWTH = 1.5
ENTRIES = 1 << 19       # packed tile entries a map task holds before it sends them
TEXT_BYTES = 1 << 20    # text hashed at a time
GROUP = 4096            # members of a group or family settled in one task
BLOCK = 256             # members of a block of a larger family
TILE_BYTES = 5          # of a tile's hash, beside its bucket
PAIRS = 512             # pairs of texts in one Arrow batch


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    codes, bounds = hashing.words([t.encode().lower() for t in texts])
    return [np.unique(hashing.sequence(codes[s:e], min(size, e - s))) if e > s
            else np.zeros(0, np.uint64) for s, e in zip(bounds[:-1], bounds[1:])]


class Bands:
    """Size bands and the number of slices each needs at a threshold in percent."""

    def __init__(self, threshold: int):
        self.threshold = threshold
        low = [1]
        while low[-1] < 1 << 31:
            low.append(max(low[-1] + 1, int(low[-1] * BAND_GROWTH)))
        self.low = np.array(low)

    def slices(self, band: int) -> tuple[int, int]:
        """Slices of a band, and how many of them are spare: linked sets agree on more
        slices than that. A set with no more empty slices than spare ones need not enter
        the tiles of its empty slices: what it links with agrees on a filled one too."""
        top = int(self.low[band + 1]) - 1
        both = top + top * 100 // self.threshold
        needed = both * (100 - self.threshold) // (100 + self.threshold) + 1
        return needed + needed // 4, needed // 4

    def tiles(self, shingles: np.ndarray) -> np.ndarray:
        """The tiles of one (non-empty) set, as 64-bit hashes."""
        n, out = len(shingles), []
        sums = np.concatenate((np.zeros(1, np.uint64),
                               np.cumsum(hashing.mix(shingles), dtype=np.uint64)))
        band = int(self.low.searchsorted(n, "right")) - 1
        while band >= 0 and (int(self.low[band + 1]) - 1) * 100 >= self.threshold * n:
            k, spare = self.slices(band)
            number = np.arange(k + 1, dtype=np.uint64)
            at = ((shingles >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).searchsorted(number)
            where = number[:-1] * np.uint64(2654435761) + np.uint64(band << 40)
            tiles = hashing.mix(hashing.mix(where) ^ (sums[at[1:]] - sums[at[:-1]]))
            filled = at[1:] > at[:-1]
            out.append(tiles[filled] if k - filled.sum() <= spare else tiles)
            band -= 1
        return np.concatenate(out)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set, as 64-bit words: a power of two, a bit per shingle."""
    bits = 64
    while bits < len(shingles):
        bits *= 2
    flips = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """The same bitmap at a smaller width (rows of 64-bit words)."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def may_link(threshold: int, n_a, n_b, differing):
    """Whether sets of these sizes can link if they differ in ``differing`` shingles
    at least: the overlap is at most ``(n_a + n_b - differing) / 2``."""
    both = n_a + n_b
    return (both - differing) * (100 + threshold) >= 2 * threshold * both


def _signatures(rows: DataFrame, size: int) -> DataFrame:
    """Set size and bitmap of every row."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            sets = [s for texts in texts_of(b.column(1), TEXT_BYTES) for s in shingle_sets(texts, size)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([bitmap(s).tobytes() for s in sets], pa.binary())], ["node", "n", "bits"])

    return rows.mapInArrow(run, "node long, n long, bits binary")


def _tiles_of(rows: DataFrame, size: int, threshold: int, buckets: int) -> DataFrame:
    """``(tile, member)`` for every tile with several members."""
    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bands = Bands(threshold)
        held: list[tuple[np.ndarray, int]] = []
        names = ["bucket", "entries", "tiles", "docs", "met"]

        def batch():
            # bucket above, the low bytes of the tile below: two tiles that fall together
            # only bring a pair more to check
            tile = np.concatenate([t for t, _ in held])
            tile = (((tile >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
                     << np.uint64(8 * TILE_BYTES)) | (tile & np.uint64((1 << 8 * TILE_BYTES) - 1)))
            doc = np.repeat([d for _, d in held], [len(t) for t, _ in held]).astype(np.int64)
            order = np.lexsort((doc, tile))
            tile, doc = tile[order], doc[order]
            first = np.append(True, tile[1:] != tile[:-1])
            group = first.cumsum() - 1
            several = (np.bincount(group) > 1)[group]
            # members that met in this task are reported here; one goes on
            met = np.stack((tile[several].view(np.int64), doc[several]))
            tile, doc = tile[first], doc[first]
            bucket = tile >> np.uint64(8 * TILE_BYTES)
            cut = bucket.searchsorted(np.arange(buckets + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(cut)).tolist()
            share = np.linspace(0, met.shape[1], len(some) + 1).astype(int)
            out = [[b, int(cut[b + 1] - cut[b]), hashing.planes(tile[cut[b]:cut[b + 1]], TILE_BYTES),
                    hashing.planes(doc[cut[b]:cut[b + 1]]),
                    met[:, share[i]:share[i + 1]].tobytes()] for i, b in enumerate(some)]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        entries = 0
        for b in batches:
            ids, done = b.column(0).to_pylist(), 0
            for texts in texts_of(b.column(1), TEXT_BYTES):
                for s in shingle_sets(texts, size):
                    if len(s):
                        held.append((bands.tiles(s), ids[done]))
                        entries += len(held[-1][0])
                    done += 1
                if entries >= ENTRIES:
                    yield batch()
                    held.clear()
                    entries = 0
        if held:
            yield batch()

    def meet(table):
        import pyarrow as pa

        counts = table.column("entries").to_pylist()
        tile, doc = (np.concatenate([hashing.from_planes(x, n, k) for x, n in
                                     zip(table.column(c).to_pylist(), counts)])
                     for c, k in (("tiles", np.uint64), ("docs", np.int64)))
        tile |= np.uint64(table.column("bucket")[0].as_py() << 8 * TILE_BYTES)
        met = [np.frombuffer(x, np.int64).reshape(2, -1) for x in table.column("met").to_pylist()]
        order = np.lexsort((doc, tile))
        tile, doc = tile[order], doc[order]
        first = np.append(True, tile[1:] != tile[:-1])[:len(tile)]
        several = (np.bincount(first.cumsum() - 1) > 1)[first.cumsum() - 1] if len(tile) else first
        return pa.table({
            "tile": np.concatenate((tile[several].view(np.int64), *[m[0] for m in met])),
            "member": np.concatenate((doc[several], *[m[1] for m in met]))})

    packed = rows.mapInArrow(pack, "bucket int, entries int, tiles binary, docs binary, met binary")
    return packed.groupBy("bucket").applyInArrow(meet, "tile long, member long")


def _cards(texts: DataFrame, size: int) -> DataFrame:
    """Size, digest, bitmap and text of the members ``(node, text)`` of large families."""
    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        for b in batches:
            sets = [s for texts in texts_of(b.column(1), TEXT_BYTES) for s in shingle_sets(texts, size)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                         pa.binary()),
                pa.array([bitmap(s).tobytes() for s in sets], pa.binary()), b.column(1),
            ], ["node", "n", "digest", "bits", "text"])

    return written(texts.mapInArrow(
        run, "node long, n long, digest binary, bits binary, text string"))


def _linked(pairs: DataFrame, cards: DataFrame, size: int, threshold: int) -> DataFrame:
    """The pairs ``(a, b)`` that link: equal digests do, pairs above the bitmap bound
    do not, the rest is decided by intersecting the sorted arrays."""
    def bound(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            a, c, n_a, n_c, x, y, same = (b.column(i).to_pylist() for i in range(7))
            verdict = []
            for i in range(len(a)):
                if same[i]:
                    verdict.append(1)
                    continue
                u, v = np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64)
                width = min(len(u), len(v))
                differing = int(np.bitwise_count(folded(u, width) ^ folded(v, width)).sum())
                verdict.append(2 if may_link(threshold, n_a[i], n_c[i], differing) else 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(verdict, pa.int32())], ["a", "b", "verdict"])

    def exact(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            keep, done = [], 0
            for texts in texts_of(b.column(2), TEXT_BYTES):
                other = [t or "" for t in b.column(3).slice(done, len(texts)).to_pylist()]
                done += len(texts)
                keep += [links(s, t, threshold) for s, t in
                         zip(shingle_sets(texts, size), shingle_sets(other, size))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    def side(name: str, *columns: str) -> DataFrame:
        return cards.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    seen = (pairs.join(side("a", "n", "digest", "bits"), "a").join(side("b", "n", "digest", "bits"), "b")
            .select("a", "b", "a_n", "b_n", "a_bits", "b_bits",
                    ((F.col("a_digest") == F.col("b_digest")) & (F.col("a_n") > 0)).alias("same")))
    seen = written(seen.mapInArrow(bound, "a long, b long, verdict int").where("verdict > 0"))
    texts = (seen.where("verdict = 2").join(side("a", "text"), "a").join(side("b", "text"), "b")
             .select("a", "b", "a_text", "b_text"))
    with arrow_rows(pairs.sparkSession, PAIRS):     # a row holds two whole texts
        return written(seen.where("verdict = 1").select("a", "b")
                       .unionByName(texts.mapInArrow(exact, "a long, b long")).distinct())


def _across(groups: DataFrame, roots: DataFrame, cards: DataFrame, threshold: int,
            best_only: bool) -> DataFrame:
    """Pairs of one hub group and different components that the bitmaps let pass.

    Members outside a group's largest component are held against all its members,
    in blocks of about ``BLOCK`` (dealt by hash), so a task sees two blocks at a time.
    """
    labelled = (groups.join(roots.select(F.col("node").alias("member"), "root"), "member", "left")
                .select("hub", "member", F.coalesce("root", "member").alias("root")))
    sizes = labelled.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = (sizes.groupBy("hub").agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("m"))
             .where("m > top.c")
             .select("hub", F.col("top.root").alias("main"),
                     F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"),
                     F.ceil((F.col("m") - F.col("top.c")) / BLOCK).cast("int").alias("others")))
    signed = (labelled.join(mixed, "hub")
              .join(cards.select(F.col("node").alias("member"), "n", "bits"), "member"))
    spread = F.xxhash64("member")

    def each(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    # every block of all members with every block of those outside the main component
    columns = ["hub", "block", "other", "few", "member", "root", "n", "bits"]
    everyone = (signed.withColumn("block", F.pmod(spread, F.col("blocks")).cast("int"))
                .withColumn("other", each("others")).withColumn("few", F.lit(False)))
    few = (signed.where("root <> main").withColumn("other", F.pmod(spread, F.col("others")).cast("int"))
           .withColumn("block", each("blocks")).withColumn("few", F.lit(True)))

    def hold(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        sides = [_unpacked(table.filter(pc.equal(table.column("few"), side))) for side in (True, False)]
        found = list(_close(*sides, threshold, best_only))
        a, c = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(c, pa.int64())})

    return (everyone.select(*columns).unionByName(few.select(*columns))
            .groupBy("hub", "block", "other").applyInArrow(hold, "a long, b long")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _unpacked(cards):
    return (cards.column("member").to_pylist(), cards.column("root").to_numpy(),
            cards.column("n").to_numpy(),
            [np.frombuffer(x, np.uint64) for x in cards.column("bits").to_pylist()])


def _close(left, right, threshold: int, best_only: bool) -> Iterator[tuple[int, int]]:
    ids, roots, sizes, maps = left
    others, other_roots, other_sizes, other_maps = right
    widths: dict[int, np.ndarray] = {}
    for i, own in enumerate(ids):
        near = np.flatnonzero((other_roots != roots[i])
                              & may_link(threshold, sizes[i], other_sizes, abs(other_sizes - sizes[i])))
        if not len(near):
            continue
        width = min(len(maps[i]), min(len(other_maps[j]) for j in near))
        if width not in widths:  # bitmaps narrower than this one are not in ``near``
            widths[width] = np.stack([folded(m, width) if len(m) >= width else
                                      np.zeros(width, np.uint64) for m in other_maps])
        differing = np.bitwise_count(widths[width][near] ^ folded(maps[i], width)).sum(
            1, dtype=np.int64)
        good = may_link(threshold, sizes[i], other_sizes[near], differing)
        if best_only and good.any():
            best = np.where(good, differing, np.iinfo(np.int64).max).argmin()
            good = np.arange(len(near)) == best
        yield from ((own, others[j]) for j in near[good])


def _families(groups: DataFrame, signatures: DataFrame, threshold: int) -> DataFrame:
    """Pairs ``(a, b)`` that join documents to families: those that a chain of pairs
    within the bitmaps' bound connects in a group. A group of more than ``GROUP``
    members is dealt as pairs of blocks of about half that size."""
    def near(table):
        import pyarrow as pa

        ids = table.column("member").to_numpy()
        maps = [np.frombuffer(x, np.uint64) for x in table.column("bits").to_pylist()]
        label = _joined(table.column("n").to_numpy(), maps, threshold)
        head = ids[label]
        own = head != ids
        return pa.table({"a": ids[own], "b": head[own]})

    blocks = F.when(F.col("c") > GROUP, F.ceil(F.col("c") / (GROUP // 2 + 1))).otherwise(1)
    sized = groups.join(groups.groupBy("hub").agg(F.count(F.lit(1)).alias("c")), "hub")
    dealt = (sized.withColumn("blocks", blocks.cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("hub", "member", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    return (dealt.hint("merge").join(
        signatures.select(F.col("node").alias("member"), "n", "bits"), "member")
        .groupBy("hub", "i", "j").applyInArrow(near, "a long, b long"))


def _settled(members: DataFrame, size: int, threshold: int) -> DataFrame:
    """``(node, root)`` of every member ``(family, node, text)`` of families of bounded
    size."""
    def settle(table):
        import pyarrow as pa

        ids = table.column("node").to_pylist()
        sets = [s for texts in texts_of(table.column("text").combine_chunks(), TEXT_BYTES)
                for s in shingle_sets(texts, size)]
        label = _components_of(sets, threshold)
        of: dict[int, int] = {}
        for at, i in enumerate(ids):  # rows of one identifier are one node
            if of.setdefault(i, at) != at:
                label[label == label[at]] = label[of[i]]
        of = {i: int(label[at]) for i, at in of.items()}
        least: dict[int, int] = {}
        for i, own in of.items():
            least[own] = min(i, least.get(own, i))
        return pa.table({"node": pa.array(of, pa.int64()),
                         "root": pa.array([least[own] for own in of.values()], pa.int64())})

    return members.groupBy("family").applyInArrow(settle, "node long, root long")


def _joined(sizes: np.ndarray, maps: list[np.ndarray], threshold: int, check=None) -> np.ndarray:
    """Labels (positions) of sets that pairs within the bound join; with ``check(i, j)``
    a pair must pass it too. Pairs inside a label are not looked at again."""
    label = np.arange(len(maps))
    tables: dict[int, np.ndarray] = {}
    widths = np.array([len(m) for m in maps])
    for i in range(len(maps)):
        near = np.flatnonzero((label[i + 1:] != label[i]) & may_link(
            threshold, sizes[i], sizes[i + 1:], abs(sizes[i + 1:] - sizes[i]))) + i + 1
        if not len(near):
            continue
        width = min(widths[i], widths[near].min())
        if width not in tables:  # narrower bitmaps are never in ``near`` at this width
            tables[width] = np.stack([folded(m, width) if len(m) >= width else
                                      np.zeros(width, np.uint64) for m in maps])
        differing = np.bitwise_count(tables[width][near] ^ tables[width][i]).sum(1, dtype=np.int64)
        good = may_link(threshold, sizes[i], sizes[near], differing)
        for j in near[good][np.argsort(differing[good], kind="stable")].tolist():
            if label[j] != label[i] and (check is None or check(i, j)):
                low, high = sorted((label[i], label[j]))
                label[label == high] = low
    return label


def _components_of(sets: list[np.ndarray], threshold: int) -> np.ndarray:
    """A component (a position) for each set: equal sets first, then all pairs of
    different components that the bitmaps let pass, the closest first."""
    first: dict[bytes, int] = {}
    same = np.array([first.setdefault(s.tobytes(), i) for i, s in enumerate(sets)], np.int64)
    own = np.flatnonzero(same == np.arange(len(sets)))
    kept = [sets[i] for i in own]
    label = _joined(np.array([len(s) for s in kept]), [bitmap(s) for s in kept], threshold,
                    lambda i, j: links(kept[i], kept[j], threshold))
    out = np.empty(len(sets), np.int64)
    out[own] = own[label]
    return out[same]


def links(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """The exact check: intersection of two sorted arrays."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both) > 0


def _large(members: DataFrame, size: int, threshold: int, best_rounds: int) -> DataFrame:
    """Links of families ``(family, node, text)`` of any size, none in one task."""
    cards = _cards(members.select("node", "text"), size)
    groups = written(members.select(F.col("family").alias("hub"), F.col("node").alias("member")).distinct())
    stars = groups.where("member <> hub").select(F.col("member").alias("a"), F.col("hub").alias("b"))
    found = _linked(stars, cards, size, threshold)
    for step in range(best_rounds + 1):
        more = _across(groups, written(components(found)), cards, threshold, step < best_rounds)
        found = found.unionByName(_linked(written(more), cards, size, threshold))
    return found


def _over(rows: DataFrame, key: str) -> DataFrame:
    """Keys of more than ``GROUP`` rows, written."""
    return written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
                   .where(F.col("c") > GROUP).select(key))


def join(docs: DataFrame, size: int = 3, threshold: int = 90, id_col: str = "doc_id",
         text_col: str = "text", buckets: int | None = None, best_rounds: int = 2) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    ``buckets`` deals the packed tiles; by default one per 256 documents (64 at
    least, 65536 at most), so that a bucket's entries stay small in memory.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("node"),
                       F.col(f"`{text_col}`").alias("text"))
    if buckets is None:
        buckets = min(max(rows.count() // 256, 64), 1 << 16)
    signatures = written(_signatures(rows, size))
    known = rows.where("node is not null")
    member = written(_tiles_of(known, size, threshold, buckets))
    hubs = member.groupBy("tile").agg(F.min("member").alias("hub"), F.max("member").alias("far"))
    groups = written(member.join(hubs.where("hub < far").drop("far"), "tile")
                     .select("hub", "member").distinct())
    pairs = _families(groups, signatures, threshold)
    families = written(components(pairs).withColumnRenamed("root", "family"))
    # each text goes once to its family. Both sides grow with the corpus: the merge hint
    # keeps either from a broadcast
    members = written(families.hint("merge").join(known, "node").select("family", "node", "text"))
    large = _over(families, "family")
    if large.isEmpty():
        roots = _settled(members, size, threshold)
    else:
        roots = _settled(members.join(large, "family", "left_anti"), size, threshold).unionByName(
            components(_large(members.join(large, "family", "left_semi"), size, threshold, best_rounds)))
    return (signatures.join(roots, "node", "left")
            .select(F.col("node").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("root", "node").alias("component_id")))


def keep_one(docs: DataFrame, size: int = 5, threshold: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component (the smallest identifier) left.

    Where identifiers repeat or are null, a document is an identifier with a text, in the
    order of the identifiers (null last) and text digests; equal rows are one document.
    """
    node = F.col(f"`{id_col}`").cast("long")
    if not (docs.select(node.alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("c"))
            .where("c > 1 or node is null").isEmpty()):
        docs, id_col = _numbered(docs, id_col, text_col), "__node"
    found = join(docs, size, threshold, id_col, text_col)
    gone = written(found.where("component_id <> doc_id")
                   .select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti").drop("__node")


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a ``__node`` for every pair of identifier and text, in their order."""
    keyed = docs.withColumn("__sha", F.coalesce(F.sha2(F.col(f"`{text_col}`"), 256), F.lit("")))
    one = F.col(f"`{id_col}`")
    pairs = keyed.select(one.alias("__id"), F.col("__sha").alias("__text")).distinct()
    nodes = written(pairs.orderBy(F.col("__id").cast("long").asc_nulls_last(), "__id", "__text")
                    .withColumn("__node", F.monotonically_increasing_id()))
    return (keyed.join(nodes, one.eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__text")))
            .drop("__sha", "__id", "__text"))
