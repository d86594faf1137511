"""Suffix-array dedup of repeated byte strings, by merging shard transforms.

Every string of ``window`` bytes that starts more than once anywhere (same document
included) is repeated; all bytes such strings cover are removed.

*Sparse suffixes.* Of each window only its anchor counts, the place of the smallest
hash of its ``GRAM``-byte grams. Equal windows have equal anchors at equal offsets,
so it is enough to hold suffixes that begin at anchors: about two per window length.
Neighbouring windows with one anchor form a context (its bytes, and where the anchor
stands in them). Equal contexts are counted by digest, with map-side aggregation:
all windows of a context seen twice are repeated. Anchors with a single context hold
nothing else; only anchors with several different contexts need their bytes, one
copy of each context.

*Merge.* Each task sends its contexts as a shard: suffixes (the bytes from the anchor
on) in order, each with the bytes before it, which is what a Burrows-Wheeler transform
keeps of a sorted suffix. A bucket of anchors merges its shards by refining their
interleave: it starts with all suffixes of an anchor tied, and each round reads eight
more bytes of the suffixes that are still tied and splits them; the round at which
neighbours part is their common prefix. The bytes before the anchors are refined the
same way. A window ``o`` bytes before the anchor is repeated if another suffix agrees
for ``window - o`` bytes to the right and ``o`` to the left, which the two arrays of
common prefixes answer for all suffixes at once. No suffix is compared with another
one, and no suffix outside tied intervals is read further.

An anchor with more than ``MERGED`` different contexts (a huge group of near copies)
is not merged in one task: its windows are counted by digest instead.

Defined results: null texts are empty; matches never cross documents; texts shorter
than a window are kept whole. Rows with a null identifier and rows repeating one are
documents of their own (so repeated rows repeat each other). Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import hashing
from mercato.llm.common import named, texts_of, written

GRAM = 64
PIECE = 1 << 20          # bytes hashed at a time; longer texts go in overlapping pieces
MERGED = 1 << 16         # different contexts of one anchor merged in one task
_PLACE_BITS = 21         # of a place within a buffer of up to 2 * PIECE bytes
_NO_ID = -(1 << 63)      # stands for a null identifier
_TAG = 1 << 32           # a row's tag stands above the place within its text


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def contexts(texts: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor, over all texts (together at most 2 * PIECE
    bytes): text number, first window, windows, anchor's offset in the run, hash of
    the anchor's gram, hash of the run's bytes."""
    gram = min(GRAM, window)
    sizes = np.array([len(t) for t in texts], np.int64)
    spans = np.maximum(sizes - window + 1, 0)
    if not spans.sum():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sums, inverse = hashing.prefix_sums(raw)
    start = np.arange(len(raw) - gram + 1)
    grams = hashing.spans_hash(sums, inverse, start, start + gram)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = _sliding_min((grams & ~low) | start.astype(np.uint64), window - gram + 1)
    text = np.repeat(np.arange(len(texts)), spans)
    place = np.arange(spans.sum()) - np.repeat(spans.cumsum() - spans, spans)
    at = place + np.repeat(sizes.cumsum() - sizes, spans)
    anchor = (least[at] & low).astype(np.int64)
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    n = np.diff(np.append(first, len(at)))
    begin, offset = at[first], anchor[first] - at[first]
    whole = hashing.spans_hash(sums, inverse, begin, begin + n + window - 1)
    whole = hashing.mix(whole ^ offset.astype(np.uint64))
    return (text[first], place[first], n, offset, grams[anchor[first]].view(np.int64),
            whole.view(np.int64))


def _pieces(texts: list[str], window: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts as UTF-8 in groups of bounded size, long ones cut so that every window
    is in one piece: text numbers, places of the pieces in their texts, bytes."""
    numbers, places, held, size = [], [], [], 0
    for i, text in enumerate(texts):
        raw = text.encode()
        for at in range(0, max(len(raw) - window + 1, 0), PIECE - window):
            piece = raw[at:at + PIECE - 1]
            if size + len(piece) > PIECE and held:
                yield numbers, places, held
                numbers, places, held, size = [], [], [], 0
            numbers.append(i)
            places.append(at)
            held.append(piece)
            size += len(piece)
    if held:
        yield numbers, places, held


def _occurrences(rows: DataFrame, window: int) -> DataFrame:
    """One row per context: anchor, digest, document, place, windows, offset."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["anchor", "digest", "doc", "start", "n", "off"]
        for b in batches:
            ids, tags = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            done = 0
            for texts in texts_of(b.column(1)):
                for numbers, places, raw in _pieces(texts, window):
                    text, place, n, off, gram, whole = contexts(raw, window)
                    row = np.array(numbers)[text] + done
                    start = place + np.array(places)[text] + tags[row]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (gram, whole, ids[row], start, n.astype(np.int32),
                                               off.astype(np.int32))], names)
                done += len(texts)

    return rows.mapInArrow(run, "anchor long, digest long, doc long, start long, n int, off int")


def interleave(words: np.ndarray, tied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged order of all suffixes and the common prefix (bytes) of neighbours in it,
    by refining the interleave of suffixes that are tied (equal ``tied``) at the start.

    ``words`` holds each suffix as a row of big-endian 64-bit words. Every round looks
    at one more word of the suffixes still tied with a neighbour.
    """
    m, width = words.shape
    order = np.argsort(tied, kind="stable")
    common = np.full(m, 8 * width, np.int64)
    common[np.flatnonzero(np.append(True, tied[order][1:] != tied[order][:-1])[:m])] = -1
    for depth in range(width):
        same = common == 8 * width
        open_ = same | np.append(same[1:], False)
        at = np.flatnonzero(open_)
        if not len(at):
            break
        block = np.cumsum(~same)[at]
        symbol = words[order[at], depth]
        finer = np.lexsort((symbol, block))
        order[at], symbol = order[at][finer], symbol[finer]
        parted = np.flatnonzero((block[1:] == block[:-1]) & (symbol[1:] != symbol[:-1])) + 1
        apart = symbol[parted] ^ symbol[parted - 1]
        lead = sum((apart >> np.uint64(56 - 8 * k) == 0).astype(np.int64) for k in range(8))
        common[at[parted]] = 8 * depth + lead
    return order, common


def _matrix(parts: list[bytes], size: int) -> np.ndarray:
    size = -(-size // 8) * 8
    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in parts), ">u8")
    return raw.astype(np.uint64).reshape(len(parts), size // 8)


def repeated(anchor: np.ndarray, context: list[bytes], off: np.ndarray, n: np.ndarray,
             window: int) -> np.ndarray:
    """For each context, which of its windows another context has at the same distance
    from an equal anchor: a boolean row over the distances 0, 1, ... to the anchor."""
    reach = window - min(GRAM, window) + 1
    right = [c[o:o + window] for c, o in zip(context, off.tolist())]
    left = [c[max(0, o - reach + 1):o][::-1] for c, o in zip(context, off.tolist())]
    right_order, right_common = interleave(_matrix(right, window), anchor)
    left_order, left_common = interleave(_matrix(left, max(reach - 1, 1)), anchor)
    m = len(context)
    out = np.zeros((m, reach), bool)
    right_class, left_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(reach):
        here = np.flatnonzero((o <= off) & (o > off - n))
        if len(here) < 2:
            continue
        right_class[right_order] = np.cumsum(right_common < window - o)
        left_class[left_order] = np.cumsum(left_common < o)
        key = left_class[here] * (m + 1) + right_class[here]
        order = np.argsort(key)
        equal = key[order][1:] == key[order][:-1]
        out[here[order[1:][equal]], o] = True
        out[here[order[:-1][equal]], o] = True
    return out


def _runs(flags: np.ndarray) -> np.ndarray:
    """Starts and ends of the true runs of one row."""
    return np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])))).reshape(-1, 2)


def _sent(texts: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """The bytes of the chosen contexts, each task's in suffix order."""
    asked = chosen.groupBy("doc").agg(F.collect_list(F.struct(
        "anchor", "bucket", "start", "n", "off", "single", "merged")).alias("asked"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["bucket", "anchor", "doc", "start", "n", "off", "single", "merged", "context"]
        kinds = [pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]

        def shard(held: list[tuple]):
            held.sort(key=lambda x: (x[0], x[1], x[8][x[5]:]))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

        for b in batches:
            held, size = [], 0
            for doc, text, tag, asked in zip(*(b.column(i) for i in range(4))):
                doc, raw, tag = doc.as_py(), (text.as_py() or "").encode(), tag.as_py()
                for a in asked.as_py():
                    place = a["start"] - tag
                    if 0 <= place < _TAG:
                        context = raw[place:place + a["n"] + window - 1]
                        held.append((a["bucket"], a["anchor"], doc, a["start"], a["n"], a["off"],
                                     a["single"], a["merged"], context))
                        size += len(context)
                if size > 4 * PIECE:
                    yield shard(held)
                    held, size = [], 0
            if held:
                yield shard(held)

    return (texts.join(asked.hint("merge"), "doc").select("doc", "text", "tag", "asked")
            .mapInArrow(run, "bucket int, anchor long, doc long, start long, n int, off int, "
                             "single boolean, merged boolean, context binary"))


_FOUND = "doc long, start long, n int"


def _merge(sent: DataFrame, window: int) -> DataFrame:
    """Repeated windows of contexts that occur once, from merging the shards."""
    def run(table):
        import pyarrow as pa

        anchor, doc, start, n, off = (table.column(c).to_numpy() for c in (
            "anchor", "doc", "start", "n", "off"))
        single = table.column("single").to_numpy(zero_copy_only=False).astype(bool)
        flags = repeated(anchor, table.column("context").to_pylist(), off.astype(np.int64),
                         n.astype(np.int64), window)
        out = []
        for i in np.flatnonzero(flags.any(1) & single).tolist():
            for s, e in _runs(flags[i]).tolist():       # distances to the anchor, s to e - 1
                out.append((int(doc[i]), int(start[i] + off[i] - (e - 1)), e - s))
        cols = list(zip(*out)) or [()] * 3
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32()))],
                        ["doc", "start", "n"])

    return sent.where("merged").groupBy("bucket").applyInArrow(run, _FOUND)


def _count(sent: DataFrame, window: int) -> DataFrame:
    """The same for anchors with too many contexts: their windows, counted by digest."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for i in range(b.num_rows):
                context, n = b.column(8)[i].as_py(), b.column(4)[i].as_py()
                sums, inverse = hashing.prefix_sums(np.frombuffer(context, np.uint8))
                at = np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(b.column(1)[i].as_py(), n)),
                     pa.array((b.column(5)[i].as_py() - at).astype(np.int32)),
                     pa.array(hashing.spans_hash(sums, inverse, at, at + window).view(np.int64)),
                     pa.array(np.repeat(b.column(2)[i].as_py(), n)),
                     pa.array(b.column(3)[i].as_py() + at),
                     pa.array(np.repeat(b.column(6)[i].as_py(), n))],
                    ["anchor", "o", "digest", "doc", "start", "single"])

    windows = sent.where("not merged").mapInArrow(
        run, "anchor long, o int, digest long, doc long, start long, single boolean")
    key = ["anchor", "o", "digest"]
    twice = windows.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(*key)
    return (windows.where("single").join(twice, key, "left_semi")
            .select("doc", "start", F.lit(1).alias("n")))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` (null identifiers as the smallest number), ``text``, ``tag``; the tag
    tells rows of a repeated identifier apart by their texts."""
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias("doc"),
                       named(text_col, "text"))
    again = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc")
    if again.isEmpty():
        return rows.withColumn("tag", F.lit(0).cast("long"))
    tag = F.shiftleft(F.xxhash64("text").bitwiseAND(F.lit((1 << 31) - 1)), 32)
    return (rows.join(again.withColumn("again", F.lit(True)), "doc", "left")
            .withColumn("tag", F.when(F.col("again"), tag).otherwise(0)).drop("again"))


def dedup(docs: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text",
          buckets: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed``
    where ``removed`` holds the removed byte runs as (start, end).

    ``buckets`` deals the anchors to be merged; by default one per 1024 documents (32
    at least, 65536 at most), so that a bucket's contexts stay small in memory.
    """
    texts = _rows(docs, id_col, text_col)
    if buckets is None:
        buckets = min(max(docs.count() // 1024, 32), 1 << 16)
    seen = written(_occurrences(texts, window))
    classes = seen.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("doc", "start", "n", "off")).alias("one"))
    classes = written(classes.select("anchor", "digest", "c", "one.*"))
    mixed = (classes.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.min("c").alias("least"))
        .where("kinds > 1 and least = 1")
        .select("anchor", (F.col("kinds") <= MERGED).alias("merged")))
    chosen = (classes.join(mixed, "anchor")
              .withColumn("single", F.col("c") == 1)
              .withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)).cast("int")))
    # both joins with the texts deal them by document, in one and the same exchange:
    # same columns, and a merge at any size
    sent = _sent(texts, chosen, window)
    if mixed.where("not merged").isEmpty():
        found = _merge(sent, window)
    else:
        sent = written(sent)
        found = _merge(sent, window).unionByName(_count(sent, window))
    whole = seen.join(classes.where("c > 1").select("anchor", "digest"), ["anchor", "digest"],
                      "left_semi").select("doc", "start", "n")
    spans = (whole.unionByName(found).groupBy("doc")
             .agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    return _apply(texts.join(spans.hint("merge"), "doc", "left").select("doc", "text", "tag", "spans"),
                  window)


def _apply(judged: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            out = []
            for text, tag, spans in zip(*(b.column(i) for i in (1, 2, 3))):
                raw, tag = (text.as_py() or "").encode(), tag.as_py()
                edges = np.zeros(len(raw) + 1, np.int64)
                if spans.is_valid:
                    start = spans.values.field("start").to_numpy() - tag
                    n = spans.values.field("n").to_numpy()
                    own = (start >= 0) & (start < _TAG)
                    np.add.at(edges, start[own], 1)
                    np.add.at(edges, start[own] + n[own] + window - 1, -1)
                runs = _runs(edges.cumsum()[:-1] > 0).tolist()
                kept, at = hashlib.sha256(), 0
                for s, e in runs:
                    kept.update(raw[at:s])
                    at = e
                kept.update(raw[at:])
                out.append((len(raw), sum(e - s for s, e in runs), len(runs), kept.hexdigest(),
                            [{"start": s, "end": e} for s, e in runs]))
            kinds = [*[pa.int64()] * 3, pa.string(),
                     pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    out = judged.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
             "removed array<struct<start: int, end: int>>")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))
