"""Quality classifier: held-out accuracy, traversal, edges."""

import zlib

import numpy as np

from mercato.llm import quality, queries
from tests.conftest import SF_CHECK


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op5_quality(spark, SF_CHECK).collect()}
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()
    held = [(got[r.doc_id], r.quality) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(g.held_out for g, _ in held)
    assert sum(g.predicted == y for g, y in held) >= 0.97 * len(held)
    assert all(0 <= g.score <= 1 for g in got.values())


def walk(model, row):
    """One row through the trees, node by node."""
    total = model.start
    for feature, cut, value in zip(model.feature, model.cut, model.value):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
        total += value[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_flat_traversal_equals_walking_the_trees():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, len(quality.NAMES))).round(1)
    y = ((x[:, 3] > 0.2) ^ (x[:, 7] > 1)).astype(float)
    model = quality.fit(x, y, trees=25)
    s = model.score(x)
    assert np.allclose(s, [walk(model, r) for r in x])
    assert ((s > 0.5) == (y == 1)).mean() > 0.95


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "good text here.", 9.0), (None, None, 1.0), (2, "", None), (2, "", None),
         (3, "x" * 200_000, 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, None, "c"), (None, 0, "d")],
                                   "doc_id long, quality int, text string")
    model = quality.train(docs, labels)
    out = quality.score(docs, model)
    assert out.columns == ["doc_id", "text", "score"] and out.count() == 5
    assert all(0 <= r.score <= 1 for r in out.collect())
    empty = quality.train(docs.limit(0), labels.limit(0))
    assert all(r.score == 0.5 for r in quality.score(docs, empty).collect())
    assert quality.score(docs.limit(0), model).count() == 0
