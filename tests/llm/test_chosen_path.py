"""Chosen-path join against a brute-force version."""

import random
import re

import numpy as np
import pytest

from mercato.llm import chosen_path, queries
from tests.conftest import SF_SMALL


def shingles(text, size):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size=4, threshold=80):
    """Every row a document of its own; the smallest identifier of a component names it."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and min(len(a), len(b)) * 100 >= threshold * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= threshold * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    named = {}
    for i, (doc, _) in enumerate(rows):
        named.setdefault(find(i), []).append(doc)
    named = {r: min((d for d in docs if d is not None), default=None) for r, docs in named.items()}
    return sorted(((doc, len(s), named[find(i)], doc == named[find(i)])
                   for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(queries.op13_minhash_dedup(spark, SF_SMALL)) == brute([tuple(d) for d in docs])


def near_copies(seed, bases=20, copies=12):
    rnd = random.Random(seed)
    rows, key = [], 100
    for _ in range(bases):
        words = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([4, 6, 20, 60, 300]))]
        for _ in range(rnd.randrange(1, copies)):
            copy = list(words)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, len(words) // 30])):
                copy[rnd.randrange(len(copy))] = f"v{rnd.randrange(4000)}"
            rows.append((key, " ".join(copy)))
            key += 1
    rnd.shuffle(rows)
    return rows


ODD = [(None, None), (None, "a b c d"), (None, "a b c d"), (1, ""), (2, " \n"), (3, "A b"), (4, "a  B"), (5, "a"),
       (6, "a b c"), (7, None), (8, "a b c"), (8, "q r s t"), (8, "q r s t"), (9, "q r s t")]


@pytest.mark.parametrize("seed,piece,few", [(1, 1024, 512), (2, 4, 512), (3, 2, 0), (4, 1024, 0)])
def test_random_near_copies(spark, monkeypatch, seed, piece, few):
    """Small pieces and small nodes: leaders in tiers, chunks, branching below."""
    monkeypatch.setattr(chosen_path, "PIECE", piece)
    rows = near_copies(seed) + ODD
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, sig string")
    if few:
        got = chosen_path.join(df, few=few)
    else:                                    # every open node branches at first
        got = chosen_path.join(df, few=1 / 64)
    assert rows_of(got) == brute(rows)


def test_one_large_family(spark):
    """Most rows are near copies of one text or exact copies of another."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = [(9, "x " * 30)] * 300
    for i in range(400):
        copy = list(words)
        for _ in range(2):
            copy[rnd.randrange(200)] = f"v{i}"
        rows.append((1000 + i, " ".join(copy)))
    got = chosen_path.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got) == brute(rows)


def test_other_sizes_and_thresholds(spark):
    rows = near_copies(6, 10, 6) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(chosen_path.join(df, size=5, threshold=70)) == brute(rows, 5, 70)
    assert rows_of(chosen_path.join(df, size=1, threshold=100)) == brute(rows, 1, 100)


def test_recall_of_a_pair_at_the_threshold():
    """Pairs of signatures that agree in 80 percent of the positions meet in some tree."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (4000, chosen_path.WIDTH)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 1 << 16, a.shape).astype(np.uint16))
    met = np.zeros(len(a), bool)
    for tree in range(chosen_path.trees_for(chosen_path.RECALL, 80)):
        roots = np.full(len(a), np.uint64(77 + tree))
        (x, at), (y, _) = (chosen_path._children(s, roots, 4) for s in (a, b))
        np.logical_or.at(met, at[x == y], True)
    assert met.mean() > 0.998
    assert chosen_path.trees_for(0.999999, 80) == 5 and chosen_path.trees_for(0.9, 100) == 1
    with pytest.raises(ValueError):
        chosen_path.trees_for(0.9, 50)


def test_long_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(60000))
    rows = [(1, text), (2, text + " end"), (3, text[: len(text) // 2])]
    assert rows_of(chosen_path.join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert chosen_path.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only_empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert rows_of(chosen_path.join(only_empty)) == [(1, 0, 1, True), (2, 0, 2, True)]
