"""Token counts by rank-synchronous array merging.

The vocabulary file is a BPE with word ends (a ``tokenizers`` JSON file). A
task cuts texts at white space, and counts the tokens of each distinct word once
(a word's pre-tokens do not depend on its neighbours). New words are normalised
and split into pre-tokens; all pre-tokens of a run of texts are then held as one
ragged numpy array of symbols, and every round merges, in all sequences at the
same time, each sequence's pair of lowest rank, wherever it occurs. Sequences
without a known pair leave; a sequence's surviving symbols are its tokens. One
scan, no shuffle; the table of known words is bounded and only saves time.

Defined results: null and empty texts have 0 tokens; special strings of the file
inside a text count one token each, as in the library's default; nothing is
truncated. Rows are kept one by one (ties and repeated rows included).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import kept, texts_of

KNOWN_WORDS = 1 << 19
_NONE = np.iinfo(np.int64).max


def _byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in out)
    return out | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Bpe:
    """The merge table as sorted arrays, and counting over ragged arrays."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        vocab = spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right, made = (np.array([vocab[x] for x in col], np.int64) for col in (
            [a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        table = _byte_symbols()
        self.inner = np.array([vocab[table[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[table[b] + suffix] for b in range(256)], np.int64)
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.white = regex.compile(r"\s+")
        # the library's own normaliser and splitter, for words beyond ASCII: what
        # counts as a letter depends on its Unicode version
        self.library = Tokenizer.from_file(path)
        self.back = {c: b for b, c in table.items()}
        self.known: dict[str, int] = {}

    def pretokens(self, word: str) -> list[bytes]:
        if word.isascii():
            return [x.encode() for x in self.pattern.findall(word.lower())]
        normal = self.library.normalizer.normalize_str(word)
        return [bytes(map(self.back.__getitem__, x))
                for x, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def count_sequences(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left in each (non-empty) sequence after all merges."""
        n = len(sequences)
        sizes = np.fromiter(map(len, sequences), np.int64, n)
        raw = np.frombuffer(b"".join(sequences), np.uint8)
        symbols, ends = self.inner[raw], sizes.cumsum()
        symbols[ends - 1] = self.final[raw[ends - 1]]
        owner = np.repeat(np.arange(n), sizes)
        counts = sizes.copy()
        while len(symbols) > 1:
            pair = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(self.key.searchsorted(pair), len(self.key) - 1)
            hit = (self.key[at] == pair) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(hit, self.rank[at], _NONE), _NONE)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(owner)))
            active = np.repeat(lowest != _NONE, size)
            merge = active & (rank == np.repeat(lowest, size))
            # of overlapping pairs (a a a) every second one, from the left
            where = np.flatnonzero(merge)
            if not len(where):
                break
            fresh = np.append(True, np.diff(where) != 1)
            run = where[fresh][fresh.cumsum() - 1]
            where = where[(where - run) % 2 == 0]
            symbols[where] = self.made[at[where]]
            keep = active
            keep[where + 1] = False
            np.subtract.at(counts, owner[where], 1)
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > KNOWN_WORDS:
            self.known.clear()
        words = list(words)
        pieces = [self.pretokens(w) for w in words]
        flat = [p for ps in pieces for p in ps]
        total = np.zeros(len(flat) + 1, np.int64)
        if flat:
            total[1:] = self.count_sequences(flat).cumsum()
        ends = np.cumsum([0, *map(len, pieces)])
        self.known.update(zip(words, (total[ends[1:]] - total[ends[:-1]]).tolist()))

    def words(self, text: str) -> list[str]:
        # str.split also cuts at the four ASCII separators; the pattern decides there
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [w for w in self.white.split(text) if w]
        return text.split()

    def count(self, texts: list[str]) -> list[int]:
        special = [0] * len(texts)
        cut = []
        for i, text in enumerate(texts):
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                special[i] = len(parts) - 1
                cut.append([w for p in parts for w in self.words(p)])
            else:
                cut.append(self.words(text))
        seen = set().union(*cut)
        new = seen.difference(self.known)
        if new:
            if len(self.known) + len(new) > KNOWN_WORDS:
                new = seen
            self.learn(new)
        get = self.known.__getitem__
        return [s + sum(map(get, words)) for s, words in zip(special, cut)]


def loaded(path: str) -> Bpe:
    """The table for ``path``, read once per worker process."""
    return kept(path, lambda: Bpe(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = loaded(path)
        for b in batches:
            n = [c for texts in texts_of(b.column(1), keeps=path) for c in bpe.count(texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    kind = dict(rows.dtypes)["doc_id"]
    out = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
