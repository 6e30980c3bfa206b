"""Byte-level BPE against tiktoken; packing against the tokenizer and its own limits."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallyloom.llm import bpe, packing
from tallyloom.llm.queries import op2_byte_bpe, op10_packing
from tests.llm.support import AWKWARD, CLASHING, documents

RANKS = P.path("byte_bpe_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(spark, texts, **extra):
    df = bpe.decode(bpe.encode(documents(spark, texts, **extra), RANKS, P.PATTERN), RANKS)
    return {r["doc_id"]: r for r in df.collect()}


def test_bpe_equals_tiktoken_on_awkward_texts(spark, reference):
    rng = np.random.default_rng(1)
    noise = ["".join(map(chr, rng.integers(32, 0x250, 300))) for _ in range(20)]
    noise += ["".join(rng.choice(list("ab"), 4_000)), " " * 3_000 + "x"]
    got = encoded(spark, AWKWARD + noise, **CLASHING)
    for i, t in enumerate(AWKWARD + noise):
        ids = reference.encode_ordinary(t or "")
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids
        assert got[i]["n_tokens"] == len(ids)
        assert bytes(got[i]["decoded"]) == (t or "").encode()


def test_bpe_query_equals_tiktoken(spark, sf, reference):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(reference.encode_ordinary(texts[r["doc_id"]] or ""), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_bpe_of_an_empty_table(spark):
    assert encoded(spark, []) == {}


def test_pair_table_finds_all_pairs_and_no_others():
    rng = np.random.default_rng(2)
    pairs = {(int(a), int(b)): k for k, (a, b) in enumerate(rng.integers(0, 500, (3_000, 2)))}
    t = bpe.PairTable(pairs)
    left, right = np.meshgrid(np.arange(-1, 500), np.arange(-1, 500))
    want = [pairs.get(p, bpe.NO_RANK) for p in zip(left.ravel().tolist(), right.ravel().tolist())]
    assert t.rank(left.ravel(), right.ravel()).tolist() == want


def pieces_hold(rows, ids_of):
    """Every id in one piece, sequences gapless, full or a power of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids_of)
    for d, rs in by_doc.items():
        at = 0
        for r in sorted(rs, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids_of[d])
            want = np.array(ids_of[d][at:at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(want)
            at += r["length"]
        assert at == len(ids_of[d])
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096 and at & (at - 1) == 0
        assert len(rs) <= packing.SEGMENTS


def test_packing_query(spark, sf):
    t = Tokenizer.from_file(WORDS)
    ids = {r["doc_id"]: t.encode(r["text"] or "", add_special_tokens=False).ids + [2]
           for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pieces_hold(op10_packing(spark, sf).collect(), ids)


def test_packing_awkward_texts(spark):
    from pyspark.sql import functions as F

    t = Tokenizer.from_file(WORDS)
    texts = AWKWARD + ["a<|endoftext|>b \u03a3\u03a3 \u0130", "\u0301a \u00a0b", "x",
                       "End. end, a.) ). 5. 5.5. <|ENDOFTEXT|> \u0130stanbul \u00c9t\u00c9. A.\x1c b",
                       "a\u0345b, don't. o'er, ...", "\u01c5 \u1fb3 \u1e9e. \ufb01n"] + ["."] * 1_500
    df = packing.pack_documents(documents(spark, texts, **CLASHING).drop("prompt"), WORDS)
    rows = df.withColumn("ids_crc32", F.crc32("ids")).collect()
    pieces_hold(rows, {i: t.encode(x or "", add_special_tokens=False).ids + [2]
                       for i, x in enumerate(texts)})
    assert packing.pack_documents(documents(spark, []), WORDS).count() == 0


def test_limits_hold_together():
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 900, 400)
    prompts = np.minimum(rng.integers(0, 900, 400), lengths)
    sequences = packing.pack(lengths, prompts, tokens=1024, segments=5, loss=300)
    seen = defaultdict(int)
    for pieces in sequences:
        total = sum(n for *_, n in pieces)
        bears = sum(max(s + n - max(prompts[i], s), 0) for i, s, n in pieces)
        assert total <= 1024 and total & (total - 1) == 0
        assert len(pieces) <= 5 and bears <= 300
        for i, s, n in pieces:
            assert s == seen[i]
            seen[i] += n
    assert all(seen[i] == n for i, n in enumerate(lengths) if n)


def test_prompts_bear_no_loss(spark):
    from pyspark.sql import functions as F

    df = documents(spark, ["one two three four", "alpha beta"]).withColumn(
        "head", F.when(F.col("doc_id") == 0, 8))
    bears, total = defaultdict(int), defaultdict(int)
    for r in packing.pack_documents(df, WORDS, prompt_chars="head").collect():
        bears[r["doc_id"]] += r["loss_tokens"]
        total[r["doc_id"]] += r["length"]
    assert bears[0] == total[0] - 2  # "one two" is the prompt
    assert bears[1] == total[1]


def test_a_block_is_tokenized_in_bounded_pieces():
    with open(WORDS, "rb") as f:
        real, sizes = packing.WordTokens(f.read()), []

    class Seen:
        def packed(self, texts, end):
            sizes.append(sum(map(len, texts)))
            return real.packed(texts, end)

    texts = [f"word{i} of text. " * 20_000 for i in range(40)] + ["", "one"]
    block = pa.RecordBatch.from_pydict({"text": texts})
    assert packing._packed(Seen(), block, b"\2\0\0\0") == real.packed(texts, b"\2\0\0\0")
    assert sum(sizes) == sum(map(len, texts)) and max(sizes) <= packing.PIECE_BYTES < sum(sizes)
