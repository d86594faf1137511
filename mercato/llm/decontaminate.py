"""Benchmark decontamination with training suffix arrays.

Documents are searched where they are read: each Arrow batch is cut into shards
of bounded size, a shard gets a suffix array over its words, and every test
suffix (the start of every benchmark window) is binary-searched in it. The array
is sparse: a suffix that does not begin with two words some window begins with
cannot match and is left out before sorting. Hits give the covered words, the
items, and the longest verbatim matches with their places in document and item.

The benchmark goes to the tasks in blocks of at most about ``block_bytes`` of
text (counted first); a benchmark beyond one block makes one pass per block, each
adding to the spans found so far, so what is broadcast stays bounded whatever
the benchmark's size. No shuffle of documents at any size.

Defined results: null texts have no words; an item of fewer than ``window`` words
is one window, an item without words never occurs; repeated items (same id) count
once, a null item id reads as ''. Rows are judged one by one, so ties and
repeated rows each get their own result. Empty documents or benchmark: no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import texts_of

WINDOW = 10
BLOCK_BYTES = 4 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 with A-Z lower-cased
_MATCH = "array<struct<item: string, item_word: int, doc_word: int, n_words: int>>"
_ADDED = {"n_words": "bigint", "spans": "array<struct<start: int, end: int>>",
          "items": "array<string>", "matches": _MATCH}


def words_of(text: str) -> list[bytes]:
    """Words of one text: A-Z lower-cased, runs of ASCII letters, digits and any
    character beyond ASCII."""
    return _WORD.findall(text.encode().lower())


class Block:
    """The windows of some benchmark items, ready for searching."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.names: list[str] = []
        places: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        for name, text in items:
            code = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            if not code:
                continue
            size = min(window, len(code))
            raw = np.array(code, ">u4").tobytes()
            for at in range(len(code) - size + 1):
                owners = places.setdefault((size, raw[4 * at:4 * (at + size)]), [])
                if not owners or owners[-1][0] != len(self.names):  # first place in the item
                    owners.append((len(self.names), at))
            self.names.append(name)
        self.sizes = np.array([s for s, _ in places], np.int64)
        self.owners = list(places.values())
        full = 4 * window
        self.low = np.array([k for _, k in places], f"S{full}")
        self.high = np.array([k.ljust(full, b"\xff") for _, k in places], f"S{full}")
        firsts = [np.frombuffer(k[:8].ljust(8, b"\0"), ">u4").astype(np.int64) for _, k in places]
        self.pairs = np.unique([a << 32 | b for (a, b), s in zip(firsts, self.sizes) if s > 1])
        self.singles = np.unique([a for (a, _), s in zip(firsts, self.sizes) if s == 1])

    def search(self, texts: list[str]) -> list[tuple[int, list, list, list]]:
        """Per text: word count, covered word runs, items, longest matches."""
        get = self.ids.get
        coded = [np.array([get(w, 0) for w in words_of(t)], np.int64) for t in texts]
        counts = [len(c) for c in coded]
        if not len(self.sizes):
            return [(n, [], [], []) for n in counts]
        # one shard: texts one after the other, an unknown word between them
        gap = np.zeros(1, np.int64)
        shard = np.concatenate([x for c in coded for x in (c, gap)]
                               + [np.zeros(self.window, np.int64)])
        begins = np.cumsum([0, *[n + 1 for n in counts]])
        at = np.flatnonzero(shard)
        starts = _among(shard[at] << 32 | shard[at + 1], self.pairs) | _among(shard[at], self.singles)
        at = at[starts]
        if not len(at):
            return [(n, [], [], []) for n in counts]
        # the sparse suffix array of the shard, to the depth of a window
        suffixes = shard[at[:, None] + np.arange(self.window)].astype(">u4")
        suffixes = np.ascontiguousarray(suffixes).view(f"S{4 * self.window}").ravel()
        order = suffixes.argsort(kind="stable")
        suffixes, at = suffixes[order], at[order]
        lo, hi = suffixes.searchsorted(self.low), suffixes.searchsorted(self.high, "right")
        found: dict[int, list[tuple[int, int]]] = {}
        for k in np.flatnonzero(hi > lo).tolist():
            for place in at[lo[k]:hi[k]].tolist():
                doc = int(begins.searchsorted(place, "right")) - 1
                found.setdefault(doc, []).append((place - int(begins[doc]), k))
        return [(n, *self._collect(sorted(found.get(i, ())))) for i, n in enumerate(counts)]

    def _collect(self, hits: list[tuple[int, int]]) -> tuple[list, list, list]:
        spans: list[list[int]] = []
        chains: dict[tuple[int, int], list[int]] = {}
        matches: list[tuple[str, int, int, int]] = []
        items: set[int] = set()
        for place, k in hits:
            end = place + int(self.sizes[k])
            if spans and place <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([place, end])
            for item, item_at in self.owners[k]:
                items.add(item)
                chain = chains.get((item, place - item_at))
                if chain and place <= chain[1] - int(self.sizes[k]) + 1:
                    chain[1] = end  # the next window of the same alignment
                else:
                    chains[item, place - item_at] = chain = [place, end]
                    matches.append((item, item_at, chain))
        return ([tuple(s) for s in spans], sorted({self.names[i] for i in items}),
                [(self.names[i], a, c[0], c[1] - c[0]) for i, a, c in matches])


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(known.searchsorted(values), len(known) - 1)] == values


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    """The benchmark's items in blocks of about ``block_bytes``, one at a time."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == b)
        yield [(r.name, r.text) for r in part.collect()]


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, prefix: str = "",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (covered word runs), ``items`` (sorted) and
    ``matches`` (longest verbatim ones), each named with ``prefix``; columns of the
    same names are replaced."""
    spark = docs.sparkSession
    added = [prefix + n for n in _ADDED]
    keep = [c for c in docs.columns if c not in added]
    frame = docs.select(*[F.col(f"`{c}`") for c in keep])
    at = keep.index(text_col)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields]
    schema = ", ".join(fields + [f"`{prefix}{n}` {kind}" for n, kind in _ADDED.items()])
    for part in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(part)
        frame = frame.mapInArrow(_searcher(shared, window, at, len(keep), [*keep, *added]), schema)
    return frame


def _searcher(shared, window: int, at: int, width: int, names: list[str]):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                 pa.list_(pa.string()),
                 pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int32()),
                                     ("doc_word", pa.int32()), ("n_words", pa.int32())]))]
        block = Block(shared.value, window)
        for b in batches:
            rows = [r for texts in texts_of(b.column(at)) for r in block.search(texts)]
            if b.num_columns > width:  # spans, items and matches of the blocks before
                before = [b.column(i).to_pylist() for i in range(width + 1, width + 4)]
                rows = [(n, _joined([(x["start"], x["end"]) for x in s0] + s),
                         sorted({*i0, *i}), [tuple(x.values()) for x in m0] + m)
                        for (n, s, i, m), s0, i0, m0 in zip(rows, *before)]
            found = [[_plain(v, k) for v in col] for k, col in enumerate(zip(*rows))] or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:width], *[pa.array(c, t) for c, t in zip(found, kinds)]], names)
    return run


def _plain(value, kind: int):
    if kind == 1:
        return [{"start": a, "end": e} for a, e in value]
    if kind == 3:
        return [dict(zip(("item", "item_word", "doc_word", "n_words"), m)) for m in value]
    return value


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, e in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([a, e])
    return [tuple(x) for x in out]


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          text_col: str = "text") -> DataFrame:
    """The documents without any occurrence of a benchmark window, columns as given."""
    found = search(docs, benchmark, window, "__match_", text_col)
    return found.where(F.size("__match_spans") == 0).drop(*[f"__match_{n}" for n in _ADDED])
