"""Substring dedup against a brute-force version."""

import hashlib
import random
import re

import pytest

from mercato.llm import queries, substring
from tests.conftest import SF_SMALL


def brute(rows, window=13):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in texts:
        if i is not None:
            for p in range(len(w) - window + 1):
                key = tuple(w[p:p + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in texts:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = brute(docs)
    assert rows_of(queries.op1_substring_dedup(spark, SF_SMALL)) == want
    assert any(r[2] for r in want)


@pytest.mark.parametrize("window,seed", [(13, 1), (4, 2), (7, 3), (1, 4)])
def test_random_texts(spark, monkeypatch, window, seed):
    monkeypatch.setattr(substring, "SPANS", 3)
    rnd = random.Random(seed)
    pool = [[f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(5, 60))] for _ in range(6)]
    rows = [(None, "a b c"), (None, " ".join(pool[0])), (1, None), (2, ""), (3, " \t"), (4, "x " * 300),
            (5, "y " + "x " * 40), (5, " ".join(pool[1] * 2)), (5, " ".join(pool[1])), (0, "x " * 13)]
    for i in range(10, 60):
        words = []
        for _ in range(rnd.randrange(1, 5)):
            words += rnd.choice(pool)[rnd.randrange(4):] if rnd.random() < 0.6 else \
                [f"é{rnd.randrange(500)}" for _ in range(rnd.randrange(20))]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(words)))
    rows += rows[-3:]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows],
                                 "doc_id long, text string, start int, source string")
    assert rows_of(substring.dedup(docs, window, buckets=5)) == brute(rows, window)
    assert substring.dedup(docs.limit(0), window).count() == 0
