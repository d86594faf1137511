"""The corpus pipeline, stage by stage, against brute-force versions."""

import re

import sentencepiece as library

import corpus_pipeline
from mercato.llm import quality
from mercato.llm.queries import tokenizer_file
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_jaccard import brute as near


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    model = quality.train(docs, labels)
    rows = {r.doc_id: r for r in docs.collect()}
    left = [i for i in sorted(rows) if model.score(
        quality._matrix_of([rows[i].text or ""]))[0] >= 0.3]
    seen, unique = set(), []
    for i in left:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", rows[i].text or "")
        if text not in seen:
            seen.add(text)
            unique.append(i)
    one = [i for i, _, root in near([(i, rows[i].text) for i in unique], 5, 80) if i == root]
    clean = {i for i, _, hit, _ in leaks([(i, rows[i].text) for i in one], items) if not hit}
    assert 0 < len(clean) < len(one) < len(unique) < len(left) < len(rows)

    sp = library.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == [*docs.columns, "ids"]
    out = got.collect()
    assert {r.doc_id for r in out} == clean and len(out) == len(clean)
    for r in out:
        assert r.text == rows[r.doc_id].text and r.ids == sp.encode(r.text or "")


def test_stages_keep_columns_and_take_empty_tables(spark):
    odd = spark.createDataFrame(
        [(1, None, "en", "s", None), (1, None, "en", "s", None), (None, "", None, None, 0),
         (2, "a " * 30_000, "en", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns[:5] == docs.columns, name
            out.count()
