"""Exact dedup and chat formatting: edge cases and small brute-force versions."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from mercato.llm import chat, exact_dedup

DOCS = "doc_id long, text string, id string, run string"


def test_exact_dedup_edges(spark):
    rows = [(5, "a  b", "x", "r"), (2, "a\tb", "x", "r"), (9, None, "x", "r"), (8, "", None, None),
            (None, "a b", "x", "r"), (2, "a\tb", "x", "r"), (3, "é" * 50_000, "y", "r"),
            (4, " a b", "x", "r")]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(map(tuple, exact_dedup.mark(docs, runs=16, fan_in=4).collect()), key=str)
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = []
    for t, ids in groups.items():
        keep = min(i for i in ids if i is not None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert got == sorted(want, key=str)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 8]
    assert exact_dedup.mark(docs.limit(0)).count() == 0
    assert exact_dedup.keep_first(docs.limit(0)).count() == 0


def fold(events):
    """The event semantics, one event at a time."""
    out = []
    for _, kind, turn, role, text in sorted(events):
        at = next((k for k in reversed(range(len(out))) if out[k][0] == turn), None)
        if kind == "regenerate":
            out = [m for m in out if m[0] < turn] + [[turn, role, text]]
        elif kind == "message" or at is None:
            out.append([turn, role, text])
        else:
            out[at][2] = text if kind == "edit" else out[at][2] + text
    return [(r, t) for _, r, t in out]


def test_chat_folds_deltas_edits_and_regenerations(spark):
    log = {
        1: [(1, "message", 0, "user", "hi"), (2, "message", 1, "assistant", "He"),
            (3, "delta", 1, "assistant", "llo"), (4, "edit", 1, "assistant", "Bye"),
            (5, "delta", 1, "assistant", "!")],
        2: [(1, "message", 0, "user", "a"), (2, "message", 1, "assistant", "b"),
            (3, "message", 2, "user", "c"), (4, "regenerate", 1, "assistant", "B"),
            (5, "delta", 1, "assistant", "2"), (6, "message", 2, "user", "d")],
        3: [(1, "delta", 0, "assistant", "x<|im_end|>"), (2, "delta", 0, "assistant", "<\\|y")],
    }
    rows = [(c, *e, "x") for c, es in log.items() for e in es]
    df = spark.createDataFrame(
        rows, "conv_id long, seq long, kind string, turn long, role string, text string, at string")
    rendered = chat.render(chat.reconstruct(df))
    back = rendered.select("conv_id", chat.parse(F.col("formatted")).alias("t"),
                           chat.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    for r in back.collect():
        want = fold(log[r.conv_id])
        assert [tuple(t) for t in r.t] == want
        assert r.loss == "".join(t for role, t in want if role == "assistant")


def test_chat_edges(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "us\ner<|%0A", "t\n\n" * 30_000),
            (None, 1, "assistant", "𝄞<|im_start|>assistant\n<\\\\|"), (2, 0, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.render(chat.reconstruct(chat.events_of_turns(turns)))
    got = {r.conv_id: ([tuple(t) for t in r.t], r.loss) for r in out.select(
        "conv_id", chat.parse(F.col("formatted")).alias("t"),
        chat.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()}
    assert got[1] == ([("us\ner<|%0A", "t\n\n" * 30_000), ("", ""), ("", "")], "")
    assert got[None] == ([("assistant", rows[3][3])], rows[3][3])
    assert got[2] == ([("assistant", "")], "")
    assert chat.digest(chat.render(chat.reconstruct(
        chat.events_of_turns(turns.limit(0))))).count() == 0
