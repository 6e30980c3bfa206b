"""SentencePiece against the library, on awkward texts, noise, whole tables and any ids."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece

from tallyloom.llm import sentence_pieces
from tallyloom.llm.queries import op13_sentence_pieces
from tests.llm.support import AWKWARD, CLASHING, documents

MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    with open(MODEL, "rb") as f:
        return sentence_pieces.Codec(f.read())


def ids_of(library, text):
    return library.encode(text or "", add_bos=True, add_eos=True)


def test_awkward_texts(spark, library, codec):
    rng = np.random.default_rng(1)
    texts = AWKWARD + ["▁a", "▁▁ a", "<s> <0x0A> </s> <unk>", "�￾", "\U0001f44d\U0001f3fd ŉ ①",
                       "ａ", " " * 1_000 + "x", "日本語テキスト", "e" * 5_000]
    texts += ["".join(map(chr, rng.integers(32, 0x250, 300))) for _ in range(20)]
    texts += ["".join(rng.choice(list(codec.ids), 300)) for _ in range(20)]
    df = documents(spark, texts, **CLASHING)
    df = df.unionByName(df.limit(4))
    rows = sentence_pieces.decode(sentence_pieces.encode(df, MODEL), MODEL).collect()
    assert len(rows) == len(texts) + 4
    for r in rows:
        ids = ids_of(library, texts[r["doc_id"]])
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["n_tokens"] == len(ids) and r["decoded"] == library.decode(ids)


def test_query_equals_the_library(spark, sf, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op13_sentence_pieces(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(library, texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_decoding_any_ids(library, codec):
    draw = random.Random(3)
    for _ in range(2_000):
        ids = [draw.choice([0, 1, 2]) if draw.random() < 0.05 else draw.randint(3, 258)
               if draw.random() < 0.5 else draw.randint(259, 31_999)
               for _ in range(draw.randint(0, 8))]
        assert codec._decoded(np.array(ids, "<u4")) == library.decode(ids)


def test_parts_without_cuts_go_through_the_table(library, codec):
    """The table alone, on texts it is otherwise spared."""
    rng = np.random.default_rng(4)
    for _ in range(30):
        text = " ".join("".join(rng.choice(list("thealion"), int(k))) for k in rng.integers(1, 12, 20))
        escaped = sentence_pieces.SPACE + text.replace(" ", sentence_pieces.SPACE)
        assert codec.encode_part(escaped) == library.encode(text)


def test_null_ids_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, "a")], "doc_id long, text string")
    assert sentence_pieces.encode(df, MODEL).collect()[0]["doc_id"] is None
    empty = sentence_pieces.encode(documents(spark, []), MODEL)
    assert sentence_pieces.decode(empty, MODEL).count() == 0
    nulls = spark.createDataFrame([(None,), (bytearray(),)], "ids binary")
    assert [r["decoded"] for r in sentence_pieces.decode(nulls, MODEL).collect()] == [None, ""]


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        sentence_pieces.Codec(b"")
