"""Fingerprints: order of documents, edits, likeness, bands."""

import hashlib

from pyspark.sql import functions as F

from tallyloom.llm import fingerprints
from tallyloom.llm.queries import op6_fingerprints
from tests.llm.support import AWKWARD, CLASHING, documents


def holds(rows, texts):
    ids = sorted(texts, reverse=True)
    prints = {texts[r["doc_id"]]: r["fingerprint"] for r in rows}
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        after = texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        cut = len(t) // 3
        new = t[:len(t) - cut] + after[:cut]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == prints[t]
        assert new not in prints or r["edited_fingerprint"] == prints[new]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert after != t or r["near_next"] == 1


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_fingerprints(spark, sf).collect()
    holds(rows, texts)
    near = [(r["near_edited"], r["near_next"]) for r in rows if r["n_chars"] >= 200]
    assert sum(a > 0.5 for a, _ in near) >= 0.98 * len(near)
    assert sum(a > b for a, b in near) >= 0.98 * len(near)


def test_awkward_texts(spark):
    df = documents(spark, AWKWARD, **CLASHING)
    rows = fingerprints.compared(fingerprints.with_next(df)).collect()
    holds(rows, dict(enumerate(t or "" for t in AWKWARD)))
    one = fingerprints.compared(fingerprints.with_next(df.filter("doc_id = 9"))).first()
    assert one["near_next"] == 1
    assert fingerprints.compared(fingerprints.with_next(df.limit(0))).count() == 0
    twice = fingerprints.with_next(df.union(df))
    assert twice.count() == 2 * len(AWKWARD)


def test_search_finds_likely_pairs(spark):
    body = [" ".join(f"{i * 7919 % 1000 + k * 31}" for k in range(120)) for i in range(40)]
    texts = body + [t[:-30] + "changed at the end" for t in body]
    rows = documents(spark, texts).select("doc_id", fingerprints.fingerprint(F.col("text"))
                                          .alias("fingerprint"))
    found = fingerprints.search(rows.filter("doc_id < 10"), rows, 0.8).collect()
    pairs = {(r["query_id"], r["doc_id"]) for r in found}
    assert all((i, i) in pairs for i in range(10))
    assert sum((i, 40 + i) in pairs for i in range(10)) >= 9
    assert all(b in (a, a + 40) for a, b in pairs)
    likes = rows.alias("x").crossJoin(rows.filter("doc_id = 3").alias("y")).select(
        "x.doc_id", fingerprints.similar(F.col("x.fingerprint"), F.col("y.fingerprint")).alias("l"))
    assert {r["doc_id"]: r["l"] for r in likes.collect()}[3] == 1.0


def test_walks_reach_the_end_of_short_texts():
    import numpy as np

    rng = np.random.default_rng(3)
    for n, most in ((1, 0), (5, 3), (10, 6)):
        same = 0
        for _ in range(100):
            text = "".join(rng.choice(list("abcdefghijklmno"), n))
            a, b = fingerprints.fingerprints([text, text[:-1] + "Z"])
            same += (a == b).all()
        assert same <= most, (n, same)


def test_prints_do_not_depend_on_the_window_or_on_company(monkeypatch):
    import numpy as np

    texts = [t or "" for t in AWKWARD[:8]] + ["some words " * k for k in (3, 40, 200)]
    together = fingerprints.fingerprints(texts)
    alone = np.concatenate([fingerprints.fingerprints([t]) for t in texts])
    monkeypatch.setattr(fingerprints, "WINDOW", 7)
    assert (together == alone).all() and (together == fingerprints.fingerprints(texts)).all()


def test_null_ids_texts_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "x y z"), (3, None), (3, None), (9, "x y z")],
                               "doc_id long, text string")
    rows = fingerprints.compared(fingerprints.with_next(df)).collect()
    assert sorted((r["doc_id"] or -1, r["n_chars"]) for r in rows) == [(-1, 5), (3, 0), (3, 0), (9, 5)]
    assert len({r["fingerprint"] for r in rows if r["n_chars"] == 5}) == 1
