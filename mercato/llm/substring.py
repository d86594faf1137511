"""Substring dedup over word windows by De Bruijn compaction.

Windows of ``window`` words are the edges of a De Bruijn graph over word sequences.
An edge is filed under its minimiser (the smallest hash of its short word grams),
so equal edges always meet, and neighbouring edges mostly share a minimiser and
travel as one run. A task first meets equal edges among its own texts and sends
each of them once, so an edge that a third of all documents hold arrives once per
task, not per document. Where a task or a bucket finds an edge that also starts in
a document with a smaller identifier, it reports that document's place as source;
edges of a run that follow each other in both places form one fragment.

Fragments are then compacted into paths: neighbouring fragments of a document that
continue at the same source are joined, whatever bucket they came from. Last, the
source coordinates verify the paths: the words of every source span are digested
where the source's text is, and a path only counts if the document's own span has
that digest. Covered words are removed and the rest is digested.

Defined results: null texts have no words; texts shorter than a window stay whole;
overlapping windows count, and windows are judged on the input, not on what is left.
Rows with a null identifier are kept whole and are nobody's source. Rows repeating
an identifier are judged one by one; equal identifiers are not smaller than each
other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm import hashing
from mercato.llm.common import named, texts_of, written

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
GRAM = 5                # words of a minimiser's gram
RUN_BYTES = 4 << 20     # text in which a task meets equal edges before sending
SPANS = 256             # source spans of one document digested in one row
_HASH_BYTES = 5
_PLACE = (1 << 32) - 1     # of a place: the word; above it, the row's tag
_FRAGMENT = "doc long, start long, n int, source long, source_start long"


class Edges:
    """The windows of some texts: hash, minimiser and place of each."""

    def __init__(self, texts: list[str], window: int):
        codes, bounds = hashing.words([t.encode() for t in texts])
        counts = np.diff(bounds)
        spans = np.maximum(counts - window + 1, 0)
        self.row = np.repeat(np.arange(len(texts)), spans)
        self.place = np.arange(spans.sum()) - np.repeat(spans.cumsum() - spans, spans)
        at = self.place + np.repeat(bounds[:-1], spans)
        if not len(at):
            self.hash = self.gram = np.zeros(0, np.uint64)
            self.offset = np.zeros(0, np.int64)
            return
        gram = min(GRAM, window)
        grams = hashing.sequence(codes, gram)
        views = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
        self.offset = views[at].argmin(1)            # the leftmost smallest
        self.gram = grams[at + self.offset]
        self.hash = hashing.sequence(codes, window)[at] & np.uint64((1 << 8 * _HASH_BYTES) - 1)

    def keys(self) -> np.ndarray:
        return edge_keys(self.gram, self.offset, self.hash)


def edge_keys(gram: np.ndarray, offset: np.ndarray, window_hash: np.ndarray) -> np.ndarray:
    return hashing.mix(gram) ^ hashing.mix(window_hash * np.uint64(64) + offset.astype(np.uint64))


def _firsts(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, doc, given order), where groups of equal keys begin in it, and
    each ordered entry's group."""
    order = np.lexsort((doc, key))
    begins = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])[:len(key)])
    group = np.zeros(len(key), np.int64)
    group[begins[1:]] = 1
    return order, begins, group.cumsum()


def _fragments(doc, place, source, source_place, run) -> list[np.ndarray]:
    """Join claims (in text order) that follow each other in both places."""
    if not len(doc):
        return [np.zeros(0, np.int64)] * 5
    new = np.append(True, (run[1:] != run[:-1]) | (source[1:] != source[:-1])
                    | (place[1:] != place[:-1] + 1) | (source_place[1:] != source_place[:-1] + 1))
    at = np.flatnonzero(new)
    return [doc[at], place[at], np.diff(np.append(at, len(doc))), source[at], source_place[at]]


def _claimed(key, doc, row, place, run) -> tuple[list[np.ndarray], np.ndarray]:
    """Fragments of the edges that also start in a smaller document here, and which
    edges have to be met elsewhere (one per key; other rows of its identifier too)."""
    order, begins, group = _firsts(key, doc)
    head = order[begins][group]                      # per ordered entry: its group's first
    claim = np.zeros(len(key), bool)
    claim[order] = doc[order] > doc[head]
    send = np.zeros(len(key), bool)
    send[order] = (order == head) | ((doc[order] == doc[head]) & (row[order] != row[head]))
    first = np.empty(len(key), np.int64)
    first[order] = head
    at = np.flatnonzero(claim)
    return _fragments(doc[at], place[at], doc[first[at]], place[first[at]], run[at]), send


def _find(rows: DataFrame, window: int, buckets: int) -> DataFrame:
    """Fragments ``(doc, start, n, source, source_start)`` of all documents."""
    def send(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["bucket", "runs", "gram", "doc", "place", "sizes", "offset", "hash", "found"]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 7]
        for b in batches:
            ids, tags = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            done = 0
            for texts in texts_of(b.column(1), RUN_BYTES):
                e = Edges(texts, window)
                doc = ids[done:done + len(texts)][e.row]
                place = e.place + tags[done:done + len(texts)][e.row]
                done += len(texts)
                if not len(doc):
                    continue
                run = np.append(0, np.cumsum((np.diff(e.place + e.offset) != 0) | (np.diff(e.row) != 0)))
                found, go = _claimed(e.keys(), doc, e.row, place, run)
                # what goes on, again in runs of one minimiser, dealt by it
                at = np.flatnonzero(go)
                begin = np.append(True, (np.diff(run[at]) != 0) | (np.diff(at) != 1))
                begin = np.flatnonzero(begin)
                size = np.diff(np.append(begin, len(at)))
                bucket = ((e.gram[at[begin]] >> np.uint64(32)) * np.uint64(buckets)
                          >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = bucket[order].searchsorted(np.arange(buckets + 1))
                inner = np.repeat(begin[order] - np.append(0, size[order].cumsum()[:-1]),
                                  size[order]) + np.arange(len(at))
                hashes = e.hash[at[inner]]
                ends = np.append(0, size[order].cumsum())
                heads = at[begin[order]]
                out = []
                some = np.flatnonzero(np.diff(cut)).tolist()
                share = np.linspace(0, len(found[0]), len(some) + 1).astype(int)
                for i, k in enumerate(some):
                    s = slice(cut[k], cut[k + 1])
                    h = heads[s]
                    out.append([
                        k, len(h), hashing.planes(e.gram[h]), hashing.planes(doc[h]),
                        hashing.planes(place[h]),
                        size[order][s].astype(np.uint8).tobytes(),
                        e.offset[h].astype(np.uint8).tobytes(),
                        hashing.planes(hashes[ends[cut[k]]:ends[cut[k + 1]]], _HASH_BYTES),
                        np.stack(found)[:, share[i]:share[i + 1]].astype(np.int64).tobytes()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    def meet(table):
        import pyarrow as pa

        parts = {n: [] for n in ("gram", "doc", "place", "sizes", "offset", "hash")}
        found = []
        for r in table.to_pylist():
            n, sizes = r["runs"], np.frombuffer(r["sizes"], np.uint8).astype(np.int64)
            parts["gram"].append(hashing.from_planes(r["gram"], n))
            parts["doc"].append(hashing.from_planes(r["doc"], n, np.int64))
            parts["place"].append(hashing.from_planes(r["place"], n, np.int64))
            parts["offset"].append(np.frombuffer(r["offset"], np.uint8).astype(np.int64))
            parts["sizes"].append(sizes)
            parts["hash"].append(hashing.from_planes(r["hash"], int(sizes.sum())))
            found.append(np.frombuffer(r["found"], np.int64).reshape(5, -1))
        p = {k: np.concatenate(v) for k, v in parts.items()}
        run = np.repeat(np.arange(len(p["sizes"])), p["sizes"])
        step = np.arange(len(run)) - np.repeat(p["sizes"].cumsum() - p["sizes"], p["sizes"])
        doc, place = p["doc"][run], p["place"][run] + step
        key = edge_keys(p["gram"][run], p["offset"][run] - step, p["hash"])
        here, _ = _claimed(key, doc, run, place, run)
        cols = [np.concatenate(c) for c in zip(here, *found)]
        kinds = [np.int64, np.int64, np.int32, np.int64, np.int64]
        return pa.table([pa.array(c.astype(k)) for c, k in zip(cols, kinds)],
                        ["doc", "start", "n", "source", "source_start"])

    sent = rows.mapInArrow(send, "bucket int, runs int, gram binary, doc binary, place binary, "
                                 "sizes binary, offset binary, hash binary, found binary")
    return sent.groupBy("bucket").applyInArrow(meet, _FRAGMENT)


def _paths(fragments: DataFrame) -> DataFrame:
    """Neighbouring fragments that continue at the same source become one path."""
    same = Window.partitionBy("doc", "source", "shift").orderBy("start", "n")
    ahead = (F.lag(F.col("start") + F.col("n")).over(same)).eqNullSafe(F.col("start"))
    return (fragments.withColumn("shift", F.col("source_start") - F.col("start"))
            .withColumn("path", F.when(ahead, 0).otherwise(1))
            .withColumn("path", F.sum("path").over(
                same.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .groupBy("doc", "source", "shift", "path")
            .agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n"))
            .select("doc", "start", "n", "source",
                    (F.col("start") + F.col("shift")).alias("source_start")))


def _digest(words: list[bytes], start: int, n: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start:start + n]), digest_size=16).digest()


def _source_digests(rows: DataFrame, paths: DataFrame, window: int) -> DataFrame:
    """The digest of every source span, made where the source's text is."""
    spans = paths.select(F.col("source").alias("doc"), F.col("source_start").alias("start"), "n").distinct()
    many = spans.groupBy("doc").agg(F.ceil(F.count(F.lit(1)) / SPANS).alias("parts"))
    asked = (spans.join(many, "doc")
             .withColumn("part", F.pmod(F.xxhash64("start", "n"), F.col("parts")))
             .groupBy("doc", "part").agg(F.collect_list(F.struct("start", "n")).alias("spans")))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            out = []
            for doc, text, tag, spans in zip(*(b.column(i) for i in range(4))):
                doc, words = doc.as_py(), WORD.findall((text.as_py() or "").encode())
                for s in _own(spans.as_py(), tag.as_py(), len(words) - window + 1):
                    out.append((doc, s["start"], s["n"],
                                _digest(words, s["start"] & _PLACE, s["n"] + window - 1)))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["source", "source_start", "n", "digest"])

    return (rows.join(asked.hint("merge"), "doc").select("doc", "text", "tag", "spans")
            .mapInArrow(run, "source long, source_start long, n int, digest binary"))


def _own(spans, tag: int, edges: int) -> Iterator[dict]:
    """The spans that name this very row (not another one of its identifier)."""
    for s in spans:
        if s["start"] & ~_PLACE == tag and (s["start"] & _PLACE) + s["n"] <= edges:
            yield s


def _tagged(rows: DataFrame) -> DataFrame:
    """Rows with a ``tag``, the high half of their places: 0 where the identifier is
    unique, else from the text, so that rows of one identifier are told apart."""
    again = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc")
    if again.isEmpty():
        return rows.select("doc", "text", F.lit(0).cast("long").alias("tag"))
    tag = F.shiftleft(F.xxhash64("text").bitwiseAND(F.lit((1 << 31) - 1)), 32)
    return rows.join(again.withColumn("again", F.lit(True)), "doc", "left").select(
        "doc", "text", F.when(F.col("again"), tag).otherwise(0).alias("tag"))


def _removal(words: list[bytes], spans, tag: int, window: int) -> np.ndarray:
    """Mask of the words to remove: the verified paths, and every further window of
    this text that equals one of theirs."""
    begins = np.zeros(max(len(words) - window + 1, 0), bool)
    for s in _own(spans, tag, len(begins)):
        start = s["start"] & _PLACE
        if _digest(words, start, s["n"] + window - 1) == s["digest"]:
            begins[start:start + s["n"]] = True
    if begins.any() and not begins.all():
        code = {}
        codes = np.array([code.setdefault(w, len(code)) for w in words], np.uint64)
        hashes = hashing.sequence(hashing.mix(codes), window)
        begins = np.isin(hashes, hashes[begins])
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(begins)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return edges.cumsum()[:-1] > 0


def dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
          buckets: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256, removed`` where
    ``removed`` holds the removed word runs as (start, end).

    ``buckets`` deals the edges; by default one per 256 documents (64 at least, 65536
    at most), so that a bucket's edges stay small in memory.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), named(text_col, "text"))
    if buckets is None:
        buckets = min(max(rows.count() // 256, 64), 1 << 16)
    known = _tagged(rows.where("doc is not null"))
    paths = written(_paths(_find(known, window, buckets)))
    # both joins below deal the texts by identifier, in one and the same exchange (same
    # columns, and a merge at any size)
    digests = _source_digests(known, paths, window)
    proven = (paths.join(digests, ["source", "source_start", "n"])
              .groupBy("doc").agg(F.collect_list(F.struct("start", "n", "digest")).alias("spans")))
    judged = known.join(proven.hint("merge"), "doc", "left").select("doc", "text", "tag", "spans")
    blank = rows.where("doc is null").select("doc", "text", F.lit(0).cast("long").alias("tag"), F.lit(
        None).cast("array<struct<start: long, n: int, digest: binary>>").alias("spans"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            out = []
            for text, tag, spans in zip(*(b.column(i) for i in (1, 2, 3))):
                words = WORD.findall((text.as_py() or "").encode())
                gone = _removal(words, spans.as_py() or (), tag.as_py(), window)
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]
                                 if gone.any() else words)
                turns = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                            [{"start": int(s), "end": int(e)} for s, e in turns.reshape(-1, 2)]))
            kinds = [pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"])

    return judged.unionByName(blank).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, "
             "removed array<struct<start: int, end: int>>")
