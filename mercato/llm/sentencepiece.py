"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The public model is a SentencePiece BPE with byte fallback, whose best path is
not the one of highest summed score but the one its merges lead to. That path
has an exact lattice form: a sequence of pieces is the merge result of its text
if and only if every two neighbouring pieces are the merge result of their joint
text (no merge ever crosses the border of two final pieces, and the first one
that did would do so in the pair alone). So the lattice's edges are pieces, an
edge may follow another if that pair stands, and at every position exactly one
edge survives: the last piece of that prefix. The pass runs over the characters,
keeps back-pointers only for a window of the longest piece, and commits ids
whenever all surviving paths of the window meet in one boundary. In this model
no piece holds a word mark (U+2581) after another character, so all paths meet
before each run of marks and a task remembers the ids of short words.

Defined results: null and empty texts have no ids; characters outside the model
become byte pieces; ids equal the library's. Decoding gives the text back, except
that a literal U+2581 comes back as the space it stands for.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import kept, texts_of

MARK = "▁"
CACHED_CHARS, CACHED_WORDS, CACHED_PARTS, CACHED_PAIRS = 48, 1 << 19, 1 << 19, 1 << 18
DECODED_ROWS = 512
_NORMAL, _BYTE, _CONTROL_KINDS = 1, 6, (2, 3)


class Recent:
    """A table of short texts and their ids, bounded: when the newer half is full it
    becomes the older one, and what is asked for again moves back."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size // 2, {}, {}

    def learn(self, text: str, make) -> bytes:
        if (found := self.old.get(text)) is None:
            found = make(text)
        if len(text) <= CACHED_CHARS:
            if len(self.new) >= self.size:
                self.new, self.old = {}, self.new
            self.new[text] = found
        return found


class Model:
    """The pieces of a BPE model file, the lattice pass and decoding."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec, normal = proto.trainer_spec, proto.normalizer_spec
        if spec.model_type != spec.BPE or normal.precompiled_charsmap \
                or not normal.add_dummy_prefix or normal.remove_extra_whitespaces:
            raise ValueError("a BPE model with dummy prefix and identity normalisation is needed")
        self.score = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.longest = max(map(len, self.score))
        byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.byte_ids = [byte[b] for b in range(256)]
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("a piece holds a word mark after another character")
        if any(c not in self.score for p in self.score for c in p):
            raise ValueError("a character of a piece is no piece itself")
        self.bytes_of = [b"" if p.type in _CONTROL_KINDS else bytes([int(p.piece[3:5], 16)])
                         if p.type == _BYTE else p.piece.replace(MARK, " ").encode()
                         for p in proto.pieces]
        # pieces that their own text merges to, with the symbols that stood at their
        # left and right border on the way; and a trie of them, read from the end
        self.borders: dict[str, tuple[tuple, tuple]] = {}
        self.ending: dict = {}
        for piece in self.score:
            if (found := self._derive(piece)) is not None:
                self.borders[piece] = found
                node = self.ending
                for c in reversed(piece):
                    node = node.setdefault(c, {})
                node[""] = piece
        self.joined = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words = Recent(CACHED_WORDS)
        self.parts = Recent(CACHED_PARTS)
        flat = [np.frombuffer(x, np.uint8) for x in self.bytes_of]
        self.byte_count = np.array([len(x) for x in flat], np.int64)
        self.byte_start = self.byte_count.cumsum() - self.byte_count
        self.byte_flat = np.concatenate(flat)

    def _steps(self, text: str) -> Iterator[tuple[list[str], int, float]]:
        """The merge procedure itself, for the few characters of a piece or a pair:
        join the neighbours of best score, leftmost first, until none is a piece.
        Yields the parts before each step, where it joins, and its score."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score[x], -i) for i in range(len(parts) - 1)
                        if (x := parts[i] + parts[i + 1]) in self.score), default=None)
            if best is None:
                break
            yield parts, -best[1], best[0]
            parts[-best[1]:2 - best[1]] = [parts[-best[1]] + parts[1 - best[1]]]
        yield parts, -1, -math.inf

    def _derive(self, piece: str) -> tuple[tuple, tuple] | None:
        """Border symbols of ``piece`` as (symbol, score it was made at, score it is
        used up at), left and right; None if its text merges to something else."""
        left, right = [[piece[0], math.inf, -math.inf]], [[piece[-1], math.inf, -math.inf]]
        for parts, i, score in self._steps(piece):
            if i < 0:
                return (tuple(map(tuple, left)), tuple(map(tuple, right))) if parts == [piece] else None
            for border, touched in ((left, i == 0), (right, i + 2 == len(parts))):
                if touched:
                    border[-1][2] = score
                    border.append([parts[i] + parts[i + 1], score, -math.inf])
                    if border[-2][1] <= score and MARK not in border[-1][0]:
                        raise ValueError("a piece outranks one it is made of")
        return None

    def _follows(self, left: str, right: str) -> bool:
        """Whether the text of the pair merges to just this pair: no symbol at the
        right border of ``left`` may join one at the left border of ``right`` while
        both stand (scores fall from step to step; on equal scores the leftmost)."""
        if left not in self.borders or right not in self.borders:
            return True  # a character outside the model joins nothing
        key = (left, right)
        if (found := self.pairs.get(key)) is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            if MARK in right:  # runs of marks: many equal scores
                found = list(self._steps(left + right))[-1][0] == [left, right]
            else:
                score = self.score
                found = not any(
                    x + y in score and max(ends_x, ends_y) <= score[x + y] != ends_x
                    and score[x + y] < min(made_x, made_y)
                    for x, made_x, ends_x in self.borders[left][1]
                    for y, made_y, ends_y in self.borders[right][0])
            self.pairs[key] = found
        return found

    def path(self, text: str) -> Iterator[str]:
        """Pieces of ``text`` (marks already in), committed as the paths meet."""
        longest, ending, pairs, follows = self.longest, self.ending, self.pairs, self._follows
        base = 0          # position up to which all pieces are committed
        last = [""]       # last[i - base]: the last piece of the prefix up to i
        for end in range(1, len(text) + 1):
            # the one edge into ``end`` that survives, read back from its end
            node, start, chosen = ending, end, text[end - 1]
            while start > base:
                start -= 1
                node = node.get(text[start])
                if node is None:
                    break
                if (piece := node.get("")) is not None:
                    before = last[start - base]
                    if not before or (known := pairs.get((before, piece))) or (
                            known is None and follows(before, piece)):
                        chosen = piece
                        break
            last.append(chosen)
            if len(last) > 4 * longest:
                # all paths of the window, traced back until they meet
                live = set(range(end - longest + 1, end + 1))
                while len(live) > 1:
                    at = max(live)
                    live.remove(at)
                    live.add(max(at - len(last[at - base]), base))
                meet = live.pop()
                if meet > base:
                    yield from self._trace(last, base, meet)
                    # the piece at the boundary stays, the next pair needs it
                    last, base = last[meet - base:], meet
        yield from self._trace(last, base, len(text))

    @staticmethod
    def _trace(last: list[str], base: int, end: int) -> list[str]:
        out = []
        while end > base:
            out.append(last[end - base])
            end -= len(out[-1])
        return out[::-1]

    def ids(self, text: str) -> bytes:
        """The ids of a part of a text (marks in), as the bytes of 32-bit numbers."""
        out: list[int] = []
        for piece in self.path(text):
            if piece in self.id:
                out.append(self.id[piece])
            else:
                out.extend(self.byte_ids[b] for b in piece.encode())
        return array("i", out).tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of a word mark and ``word``.

        Where two neighbours stand together in no piece, every path has a boundary:
        the parts between such places are encoded (and remembered) on their own.
        """
        text, joined, parts = MARK + word, self.joined, self.parts
        start, out = 0, []
        for i in range(1, len(text) + 1):
            if i == len(text) or text[i - 1:i + 1] not in joined:
                part = text[start:i]
                out.append(parts.new.get(part) or parts.learn(part, self.ids))
                start = i
        return out[0] if len(out) == 1 else b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            # a run of marks belongs to the word after it
            words = [w[1:] for w in _SEGMENT.findall(MARK + text.replace(" ", MARK))]
        else:
            words = text.split(" ")
        known, encode = self.words, self._word
        return np.frombuffer(b"".join([known.new.get(w) or known.learn(w, encode) for w in words]),
                             np.int32)

    def decode_flat(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts whose ids lie one after the other (``ends`` of each),
        and the texts' ends in them."""
        count = self.byte_count[ids]
        stop = count.cumsum()
        at = np.arange(stop[-1] if len(stop) else 0) + np.repeat(
            self.byte_start[ids] - (stop - count), count)
        return self.byte_flat[at], np.append(0, stop)[ends]

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")


def loaded(path: str) -> Model:
    """The model of ``path``, read once per worker process."""
    return kept(path, lambda: Model(path))


def encode(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids",
           check_col: str | None = None) -> DataFrame:
    """``docs`` with the ids of the whole text as ``out_col array<int>``; one scan, no
    shuffle. With ``check_col`` the ids are decoded again on the spot, and that column
    says whether the text came back (a literal U+2581 as a space). Columns of these
    names are replaced."""
    added = [out_col] + [check_col] * (check_col is not None)
    keep = [c for c in docs.columns if c not in added]
    frame = docs.select(*[F.col(f"`{c}`") for c in keep])
    at = keep.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = loaded(path)
        for b in batches:
            done = 0
            for texts in texts_of(b.column(at), keeps=path):
                ids = [model.encode(t) for t in texts]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                more = [column]
                if check_col is not None:
                    back = _texts(model, column).to_pylist()
                    more.append(pa.array([t.replace(MARK, " ") == x for t, x in zip(texts, back)]))
                part = b.slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*keep, *added])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields]
    fields += [f"`{out_col}` array<int>"] + [f"`{check_col}` boolean"] * (check_col is not None)
    return frame.mapInArrow(run, ", ".join(fields))


def _texts(model: Model, column):
    """The texts of an Arrow column of ids."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ends = np.append(0, pc.fill_null(pc.list_value_length(column), 0).to_numpy(
        zero_copy_only=False).cumsum())
    flat, ends = model.decode_flat(column.flatten().to_numpy(zero_copy_only=False), ends)
    raw, begins, stops = flat.tobytes(), ends[:-1], ends[1:]
    dummy = np.zeros(len(begins), np.int64)
    some = stops > begins
    dummy[some] = flat[begins[some]] == 32      # the space the encoder put before the text
    try:
        raw.decode()
        texts = [raw[s:e].decode() for s, e in zip((begins + dummy).tolist(), stops.tolist())]
    except UnicodeDecodeError:                  # ids that no text has
        texts = [raw[s:e].decode("utf-8", "replace")
                 for s, e in zip((begins + dummy).tolist(), stops.tolist())]
    return pa.array(texts, pa.string())


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids_col`` as ``out_col``; null ids give ''."""
    keep = [c for c in rows.columns if c != out_col]
    frame = rows.select(*[F.col(f"`{c}`") for c in keep])
    at = keep.index(ids_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = loaded(path)
        for b in batches:
            column = b.column(at)
            for start in range(0, len(column), DECODED_ROWS):
                part = b.slice(start, DECODED_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, _texts(model, part.column(at))], [*keep, out_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return frame.mapInArrow(run, f"{fields}, `{out_col}` string")
