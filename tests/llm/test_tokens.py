"""Token counts and SentencePiece ids against the libraries themselves."""

import random

import public_tokenizers
import pytest

from mercato.llm import sentencepiece, token_count
from tests.conftest import SF_SMALL

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
EDGES = [None, "", "   ", "a", "\x1ca\x1db", "ΑΣ Σ s", " ▁x y", "<|endoftext|>a<|startoftext|>b",
         "aaaa" * 500, "🎉🎉" * 30 + "é́", "́x", " .\n\n  .  x   y    z",
         "it's we'll I'D", "x" * 30_000, " " * 1000, "\u0085a b", "a", "a"]


def random_texts(seed=7):
    rnd = random.Random(seed)
    alphabet = "abcdeé🎉 \n'▁ .,1239ßñ中文́ʼ"
    return (["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 200))) for _ in range(400)]
            + ["".join(chr(rnd.randint(1, 0x3000)) for _ in range(50)) for _ in range(100)])


@pytest.fixture(scope="module")
def docs(spark):
    rows = list(enumerate(EDGES + random_texts())) + [(None, "null id"), (3, "a")]
    made = spark.createDataFrame([(i, t, 1, 2) for i, t in rows],
                                 "doc_id long, text string, ids int, n_tokens int")
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return made.unionByName(real.select("doc_id", "text"), allowMissingColumns=True)


def test_token_counts_equal_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    rows = docs.collect()
    want = [(r.doc_id, len((r.text or "").encode()),
             len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in rows]
    got = token_count.count_tokens(docs, WORDS).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r[:3])) for r in got)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_count.count_tokens(docs.limit(0), WORDS).count() == 0


def test_ids_equal_the_library_and_decode_back(docs):
    import sentencepiece as library

    sp = library.SentencePieceProcessor(model_file=PIECES)
    ids = sentencepiece.encode(docs, PIECES)
    assert ids.columns == ["doc_id", "text", "n_tokens", "ids"]
    for r in ids.collect():
        assert r.ids == sp.encode(r.text or "")
    back = sentencepiece.decode(ids.withColumnRenamed("text", "given"), PIECES)
    for r in back.collect():
        assert r.text == (r.given or "").replace("▁", " ")
    checked = sentencepiece.encode(docs, PIECES, check_col="n_tokens")
    assert checked.columns == ["doc_id", "text", "ids", "n_tokens"]
    assert checked.where("n_tokens").count() == docs.count()
    assert sentencepiece.encode(docs.limit(0), PIECES).count() == 0


def test_the_window_stays_bounded():
    model = sentencepiece.loaded(PIECES)
    first = next(iter(model.path("ab" * 1_000_000)))  # committed long before the end is read
    assert first


def test_a_worker_lets_go_of_another_operators_tables(docs):
    """pipeline: the encoder's tables do not stay in a worker that serves the classifier next."""
    import gc
    import weakref

    import pyarrow as pa

    from mercato.llm import quality

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    model = weakref.ref(sentencepiece.loaded(path))
    assert sentencepiece.loaded(path) is model()           # kept for the next task
    quality._matrix(pa.array(["some text"]))
    gc.collect()
    assert model() is None
