"""Benchmark decontamination against a brute-force version."""

import hashlib
import re

import pytest

from mercato.llm import decontaminate, queries
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    keys = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            keys.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    sizes = {len(k) for k in keys}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (names := keys.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= names
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def as_rows(found):
    return [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r["items"])
            for r in found.collect()]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0)
            for d, n, h, i in brute(docs, items)}
    got = {r[0]: tuple(r[1:]) for r in queries.op3_decontaminate(spark, SF_SMALL).collect()}
    assert got == want
    assert any(v[-1] for v in want.values()) and not all(v[-1] for v in want.values())


LONG = " ".join(f"w{i % 97}" for i in range(40_000))
DOCS = [(1, "x A b c D e f g h i j y"), (2, "One, two!"), (3, None), (4, ""), (5, "Two three four"),
        (None, "a b c d e f g h i j"), (6, LONG), (6, LONG), (7, "é É ünï word"),
        (8, "und " * 500), (9, "b c d e f g h i j k l a b c d e f g h i j k")]
ITEMS = [(10, "a b c d e f g h i j k l"), (2, "one two"), (2, "one two"), (3, "Four"), (None, "word"),
         (5, ""), (6, None), (7, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (8, "und " * 25),
         (9, "É ünï")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_edges_and_blocks(spark, block_bytes):
    docs = spark.createDataFrame([(d, t, "s", 1) for d, t in DOCS],
                                 "doc_id long, text string, spans string, item_id int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.search(docs, items, block_bytes=block_bytes)
    assert sorted(as_rows(found), key=str) == sorted(brute(DOCS, ITEMS), key=str)
    first = {r.doc_id: r.matches for r in found.collect()}
    assert [tuple(m) for m in first[1]] == [("10", 0, 1, 10)]
    assert max(m.n_words for m in first[9]) == 11
    clean = decontaminate.clean(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4]
    assert decontaminate.search(docs.limit(0), items).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == len(DOCS)
