"""Quality classifier: histogram gradient-boosted trees over document statistics.

``features`` computes statistics of every whole text (no labels, language, source
or identifier) in one Arrow pass. ``train`` bins a bounded labelled sample by
quantiles and boosts small trees on per-bin gradient sums; the fitted trees are
flattened into arrays, and scoring walks all rows through all trees at once by
numpy indexing. Only the sample's feature rows (at most ``max_rows`` of a few
dozen numbers) meet on the driver.

Defined results: null texts count as empty, an empty text gets the score its
statistics lead to; a null identifier is never held out nor trained on; null
labels are left out; a repeated identifier is trained on once. Without labelled
rows every score is 0.5, with a single label value it is that value's prior.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import texts_of

MAX_ROWS = 20_000        # labelled rows used for fitting, at most
BINS, DEPTH, TREES, RATE, L2, LEAST = 32, 4, 60, 0.2, 1.0, 10

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789", "space": b" \t", "line": b"\n", "stop": b".,;:?",
    "bang": b"!", "bar": b"|", "mark": b"*$%&#@^~", "quote": b"'\"`", "brace": b"(){}[]<>",
    "slash": b"/\\_=+-", "high": bytes(range(128, 256)), "control": bytes([*range(9), *range(11, 32)]),
}
NAMES = [*(f"share_{k}" for k in _CLASSES), "log_bytes", "log_words", "word_length",
         "word_spread", "distinct_words", "top_word", "upper_words", "marked_words",
         "digit_words", "one_char_words", "line_length", "distinct_lines", "short_lines",
         "repeated_pairs", "stop_words_end", "longest_word"]
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _i, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _i
_MARKED = re.compile(r"[^\w\s.,;:?!'\"()-]$|!!$")


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of ``NAMES``."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(len(raw), 1)
    shares = np.bincount(_CLASS_OF[raw], minlength=len(_CLASSES) + 1)[:-1] / n
    words, lines = text.split(), [x for x in text.split("\n") if x]
    w, m = max(len(words), 1), max(len(lines), 1)
    count = Counter(words)
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    upper = marked = digits = single = 0
    for x, c in count.items():
        upper += c * (x.isupper() and len(x) > 1)
        marked += c * (_MARKED.search(x) is not None)
        digits += c * any(map(str.isdigit, x))
        single += c * (len(x) == 1)
    again = len(words) - 1 - len(set(zip(words, words[1:]))) if len(words) > 1 else 0
    return [*shares.tolist(), np.log1p(len(raw)), np.log1p(len(words)), sizes.mean(), sizes.std(),
            len(count) / w, max(count.values(), default=0) / w, upper / w, marked / w, digits / w,
            single / w, np.log1p(len(text) / m), len(set(lines)) / m,
            sum(len(x) < 30 for x in lines) / m, again / w,
            sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / m, np.log1p(sizes.max())]


def _matrix_of(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(NAMES))


def _matrix(column) -> np.ndarray:
    return np.concatenate([np.zeros((0, len(NAMES))), *map(_matrix_of, texts_of(column))])


@dataclass
class Trees:
    """Flattened trees: node ``i`` of tree ``t`` sends a row to ``2 i + 1`` or, where
    ``x[feature] > cut``, to ``2 i + 2``; ``value`` counts at the last level."""

    feature: np.ndarray   # (trees, 2 ** depth - 1)
    cut: np.ndarray       # the same shape; +inf sends all rows left
    value: np.ndarray     # (trees, 2 ** depth)
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1]))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - (len(value) - 1)]
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost ``trees`` trees on the log loss over quantile-binned columns."""
    n, width = x.shape if len(x) else (0, len(NAMES))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    prior = min(max(y.mean(), 1e-3), 1 - 1e-3) if n else 0.5
    start = float(np.log(prior / (1 - prior)))
    feature = np.zeros((trees, inner), np.int64)
    cuts = np.full((trees, inner), np.inf)
    values = np.zeros((trees, leaves))
    if not n or y.min() == y.max():
        return Trees(feature[:0], cuts[:0], values[:0], start)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([e.searchsorted(x[:, j], "left") for j, e in enumerate(edges)])
    margin = np.full(n, start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, size = 2 ** level - 1, 2 ** level
            slot = (node - first) * BINS
            gain_best = np.full(size, 1e-6)
            at = np.zeros((size, 2), np.int64) - 1
            for j in range(width):
                cell = slot + binned[j]
                g, h, c = (np.bincount(cell, v, size * BINS).reshape(size, BINS).cumsum(1)
                           for v in (gradient, weight, None))
                gain = (g ** 2 / (h + L2) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + L2)
                        - g[:, -1:] ** 2 / (h[:, -1:] + L2))
                gain[(c < LEAST) | (c[:, -1:] - c < LEAST)] = 0
                k = gain.argmax(1)
                better = gain[np.arange(size), k] > gain_best
                gain_best = np.where(better, gain[np.arange(size), k], gain_best)
                at[better] = np.stack([np.full(size, j), k], 1)[better]
            right = np.zeros(n, np.int64)
            for i, (j, k) in enumerate(at):
                if j >= 0:
                    feature[t, first + i], cuts[t, first + i] = j, edges[j][k]
                    here = node == first + i
                    right[here] = binned[j][here] > k
            node = 2 * node + 1 + right
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, leaves), np.bincount(leaf, weight, leaves)
        values[t] = -RATE * g / (h + L2)
        margin += values[t][leaf]
    return Trees(feature, cuts, values, start)


def fold(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the identifier as text, modulo ``folds``."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_ROWS, held_out_fold: int = 0) -> Trees:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold,
    chosen by the hash of their identifiers. The chosen identifiers are bounded by
    ``max_rows``, so they may be broadcast to the scan of ``docs``."""
    chosen = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("y"))
              .where(F.col("id").isNotNull() & F.col("y").isNotNull()
                     & (fold(F.col("id")) != held_out_fold))
              .groupBy("id").agg(F.min("y").alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
            .join(F.broadcast(chosen), "id").select("y", "text", "id"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            x = _matrix(b.column(1))
            flat = pa.array(x.ravel())
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays(
                [b.column(2), b.column(0).cast(pa.float64()), pa.ListArray.from_arrays(ends, flat)],
                ["id", "y", "x"])

    kind = dict(rows.dtypes)["id"]
    got = (rows.mapInArrow(run, f"id {kind}, y double, x array<double>")
           .groupBy("id").agg(F.min(F.struct("x", "y")).alias("r"))
           .select("id", "r.x", "r.y").orderBy("id").collect())
    x = np.array([r.x for r in got]).reshape(len(got), len(NAMES))
    return fit(x, np.array([r.y for r in got]))


def score(docs: DataFrame, model: Trees, text_col: str = "text",
          out_col: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 as ``out_col`` (replaced if there)."""
    keep = [c for c in docs.columns if c != out_col]
    frame = docs.select(*[F.col(f"`{c}`") for c in keep])
    at = keep.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(model.score(_matrix(b.column(at))))], [*keep, out_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return frame.mapInArrow(run, f"{fields}, `{out_col}` double")
