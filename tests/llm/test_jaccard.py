"""N-gram Jaccard join against a brute-force version."""

import random
import re

import pytest

from mercato.llm import jaccard, queries
from mercato.llm.components import components
from tests.conftest import SF_SMALL


def shingles(text, size):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size=3, threshold=90):
    sets = [(i, shingles(t, size)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is None or j is None or not a or not b:
                continue
            if min(len(a), len(b)) * 100 < threshold * max(len(a), len(b)):
                continue
            both = len(a & b)
            if 100 * both >= threshold * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(queries.op4_jaccard_join(spark, SF_SMALL)) == brute(docs)


@pytest.mark.parametrize("size,threshold,seed,group", [
    (3, 90, 1, 4096), (5, 80, 2, 4096), (1, 95, 3, 4096), (3, 90, 4, 3)])
def test_random_near_copies(spark, monkeypatch, size, threshold, seed, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    rnd = random.Random(seed)
    rows, key = [(None, None), (None, "a b c d"), (1, ""), (2, " \n"), (3, "A b"), (4, "a  B"), (5, "a"),
                 (6, "a b c"), (7, None), (8, "a b c"), (8, "q r s t"), (9, "q r s t")], 100
    for base in range(25):
        words = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([4, 8, 20, 60, 150, 400]))]
        for _ in range(rnd.randrange(1, 8)):
            copy = list(words)
            for _ in range(rnd.randrange(0, max(2, len(words) // 25))):
                copy[rnd.randrange(len(copy))] = f"w{rnd.randrange(4000)}"
            rows.append((key := key + 1, " ".join(copy)))
            if rnd.random() < 0.3:
                words = copy  # chains: each link close, the ends far apart
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                                 "doc_id long, text string, node int, hub string")
    assert rows_of(jaccard.join(docs, size, threshold)) == brute(rows, size, threshold)


@pytest.mark.parametrize("group", [4096, 3])
def test_a_far_hub_hides_no_links(spark, monkeypatch, group):
    """All copies meet a hub that links with none of them; they link among each other."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "GROUP", group)
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    far = [f"z{i}" if i % 40 == 0 else w for i, w in enumerate(words)]
    rows = [(0, " ".join(far))]
    for k in range(1, 40):
        copy = list(words)
        for _ in range(3):
            copy[rnd.randrange(len(copy))] = f"y{rnd.randrange(9999)}"
        rows.append((k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard.join(docs)) == brute(rows)


def test_keep_one_and_empty(spark):
    docs = spark.createDataFrame([(2, "a b c d e f", "k"), (1, "A b c d e f", "k"), (None, "x", "k"),
                                  (3, "", "k")], "doc_id long, text string, root string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]
    assert jaccard.join(docs.limit(0)).count() == 0


def test_keep_one_of_repeated_and_null_identifiers(spark):
    near = "a b c d e f g h i j k l m n o p q r s t u v w"
    rows = [(1, near), (2, near + " x"), (2, "quite another text of some more words"), (None, near + " y"),
            (7, "z " * 3 + near.upper() + " q r s t"), (7, "one two three four five six seven eight nine ten"),
            (7, "One two three four five six seven eight nine ten"), (None, "p1 p2 p3 p4 p5 p6"),
            (None, "P1 p2 p3 p4 p5 p6"), (None, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), str(r.text).lower()) for r in kept.collect())
    assert got == sorted((str(i), str(t).lower()) for i, t in (
        rows[0], rows[2], rows[4], rows[5], rows[7], rows[9], rows[10]))


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(5, 3), (3, 9), (9, 8), (100, 7), (100, 7), (4, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == ({i: 20 for i in range(20, 61)} | {i: 3 for i in (3, 5, 8, 9)} | {7: 7, 100: 7})
