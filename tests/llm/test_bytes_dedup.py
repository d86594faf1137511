"""Byte-string dedup against a brute-force version."""

import hashlib
import random
from collections import Counter

import pytest

from mercato.llm import bytes_dedup, queries
from tests.conftest import SF_SMALL


def brute(rows, window=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(hash(w[p:p + window]) for _, w in texts for p in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        mask = bytearray(len(w))
        for p in range(len(w) - window + 1):
            if count[hash(w[p:p + window])] > 1:
                mask[p:p + window] = b"\1" * window
        kept = bytes(b for b, g in zip(w, mask) if not g)
        spans = sum(g and (not p or not mask[p - 1]) for p, g in enumerate(mask))
        out.append((i, len(w), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = brute(docs)
    assert rows_of(queries.op6_suffix_dedup(spark, SF_SMALL)) == want
    assert any(r[2] for r in want)


@pytest.mark.parametrize("window,merged,seed", [(400, 1 << 16, 1), (80, 1 << 16, 2), (80, 1, 3), (10, 2, 4)])
def test_random_texts(spark, monkeypatch, window, merged, seed):
    monkeypatch.setattr(bytes_dedup, "MERGED", merged)
    rnd = random.Random(seed)

    def noise(n):
        return "".join(rnd.choice("abcdé \n中") for _ in range(n))

    pool = [noise(rnd.randrange(window // 2, 4 * window)) for _ in range(4)]
    rows = [(None, pool[0]), (None, None), (1, ""), (2, "a" * (window + 7)), (3, "ab" * window),
            (4, "\0" * window + "x"), (4, "\0" * (window - 1)), (5, pool[1]), (5, pool[1] + "x"),
            (6, pool[2] + pool[2])]
    for i in range(10, 45):
        text = ""
        for _ in range(rnd.randrange(1, 4)):
            part = list(rnd.choice(pool) if rnd.random() < 0.6 else noise(rnd.randrange(window)))
            for _ in range(rnd.choice([0, 0, 1, 3])):
                if part:
                    part[rnd.randrange(len(part))] = rnd.choice("xyz")
            text += "".join(part)
        rows.append((i, text))
    rows += rows[-2:]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows],
                                 "doc_id long, text string, n int, doc string")
    assert rows_of(bytes_dedup.dedup(docs, window, buckets=3)) == brute(rows, window)
    assert bytes_dedup.dedup(docs.limit(0), window).count() == 0


def test_long_texts_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(bytes_dedup, "PIECE", 1000)
    rnd = random.Random(9)
    base = "".join(rnd.choice("abcdefgh") for _ in range(5000))
    rows = [(1, base + "x" + base[700:2900]), (2, "qq" + base[100:3100]), (3, base[:90])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(bytes_dedup.dedup(docs, 100)) == brute(rows, 100)
