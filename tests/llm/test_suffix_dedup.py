"""Repeated byte strings against brute force over all strings."""

import hashlib

import numpy as np
import pytest

from tallyloom.llm import suffix_dedup
from tallyloom.llm.queries import op5_suffix_dedup
from tests.llm.support import AWKWARD, CLASHING, documents

N = suffix_dedup.LENGTH


def brute(texts):
    """Per text: n_bytes, n_removed, n_spans, kept bytes."""
    seen, out = set(), []
    for raw in texts:
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - N + 1):
            s = raw[at:at + N]
            if s in seen:
                gone[at:at + N] = True
            seen.add(s)
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((len(raw), int(gone.sum()), runs,
                    bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def holds(spark, texts, **extra):
    rows = {r["doc_id"]: r for r in suffix_dedup.removed(
        documents(spark, texts, **extra).repartition(5)).collect()}
    assert len(rows) == len(texts)
    for i, want in enumerate(brute([(t or "").encode() for t in texts])):
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want, i


def test_awkward_texts(spark):
    holds(spark, [t if t is None else t[:3_000] for t in AWKWARD] + ["x" * 700, "ab" * 400],
          **CLASHING)


def test_edits_shared_passages_and_copies(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdé"), rng.integers(1, 7)))
    texts = [" ".join(word() for _ in range(rng.integers(5, 200))) for _ in range(40)]
    hot = " ".join(word() for _ in range(40))
    for _ in range(150):
        t = texts[rng.integers(len(texts))]
        kind = rng.integers(4)
        if kind == 0:
            w = t.split(" ")
            for _ in range(rng.integers(1, 6)):
                w[rng.integers(len(w))] = word()
            t = " ".join(w)
        elif kind == 1:
            t = word() + hot + word() * int(rng.integers(0, 9))
        elif kind == 2:
            a, b = sorted(rng.integers(0, len(t), 2))
            t = t[a:b] + hot[: rng.integers(0, len(hot))] + t[:a]
        texts.append(t)
    holds(spark, texts)


def test_query_equals_brute_force(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want = brute([(t or "").encode() for _, t in docs])
    got = {r["doc_id"]: r for r in op5_suffix_dedup(spark, sf).collect()}
    for (d, _), (n, gone, runs, kept) in zip(docs, want):
        r = got[d]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            n, gone, runs, hashlib.sha256(kept).hexdigest())


def test_repeated_rows_and_empty_table(spark):
    t = "".join(map(str, range(200)))
    df = documents(spark, [t, t])
    rows = suffix_dedup.removed(df.union(df)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in rows) == [
        (0, 0), (0, 0), (1, len(t)), (1, len(t))]
    assert suffix_dedup.removed(df.limit(0)).count() == 0


@pytest.mark.parametrize("data", [b"a" * 300, bytes(range(256)) * 2, b"ab" * 160])
def test_stretches_cover_every_start_once(data):
    first, count, off, *_ = suffix_dedup.stretches(np.frombuffer(data, np.uint8))
    assert first[0] == 0 and (first[1:] == (first + count)[:-1]).all()
    assert first[-1] + count[-1] == len(data) - N + 1
    assert (off < suffix_dedup.REACH).all() and (off >= 0).all()


def test_no_task_holds_a_passage_that_many_documents_share(spark, monkeypatch):
    rng = np.random.default_rng(6)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    hot, end = word(300), word(60)
    texts = [word(60) + hot + word(60) for _ in range(200)]
    texts += [hot[:150] + end + word(5) for _ in range(40)] + texts[:20]
    largest = []
    third = suffix_dedup._third_pass

    def watched(spans):
        largest.append(max(r["count"] for r in spans.groupBy("key").count().collect()))
        return third(spans)

    monkeypatch.setattr(suffix_dedup, "_third_pass", watched)
    monkeypatch.setattr(suffix_dedup, "LARGE", 50, raising=False)
    holds(spark, texts)
    assert 1 < largest[0] <= 50
