"""Fill-in-middle: SQL on whole tables, plain slicing on awkward texts, blocks of long texts."""

import hashlib

import numpy as np
import pyarrow as pa

from tallyloom.llm import fill_middle
from tallyloom.llm.queries import ORACLES, op12_fill_middle
from tests.llm.support import AWKWARD, CLASHING, documents
from tests.support.oracle import compare, connect


def brute(doc_id, text, percent=90):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    lo, hi = sorted([h1 % (n + 1), h2 % (n + 1)])
    p, m, s = text[:lo], text[lo:hi], text[hi:]
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, text, text
    if h4 % 100 < 20:
        return n, "spm", lo, hi - lo, f"<S>{s}<P>{p}<M>{m}", text
    return n, "psm", lo, hi - lo, f"<P>{p}<S>{s}<M>{m}", text


def test_query_equals_sql(spark, sf):
    report = compare(op12_fill_middle(spark, sf), connect(sf), ORACLES["op12_fill_middle"])
    assert report["ok"], report


def test_awkward_texts(spark):
    texts = AWKWARD + ["a<P>b", "<S>", "x<M", "M>y", "<S<", "<<P", "P>", "<", ">", "a<S", "S>S>",
                       "\U0001f600" * 9, "é", "z<", "<M<P"] * 12
    df = documents(spark, texts, **CLASHING)
    df = df.unionByName(df.limit(5))  # repeated rows
    for percent in (90, 100, 0):
        done = fill_middle.restore(fill_middle.transform(df, percent=percent))
        rows = done.collect()
        assert len(rows) == len(texts) + 5
        for r in rows:
            assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"],
                    r["restored"]) == brute(r["doc_id"], texts[r["doc_id"]], percent)


def test_null_ids_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, "some text"), (None, None)], "doc_id long, text string")
    rows = fill_middle.restore(fill_middle.transform(df)).collect()
    assert [tuple(r)[1:] for r in rows] == [brute(None, "some text"), brute(None, None)]
    assert fill_middle.restore(fill_middle.transform(documents(spark, []))).count() == 0


def test_restoring_nulls(spark):
    df = spark.createDataFrame([(None, "psm"), ("a", None), ("<S>c<P>a<M>b", "spm")],
                               "output string, form string")
    assert [r["restored"] for r in fill_middle.restore(df).collect()] == [None, None, "abc"]


def test_texts_longer_than_a_block(monkeypatch):
    rng = np.random.default_rng(5)
    letters = list("abé中\U0001f600")
    texts = ["".join(rng.choice(letters, int(k))) for k in rng.integers(0, 60, 40)]
    first, second = np.sort([[rng.integers(0, len(t) + 1) for t in texts] for _ in range(2)], axis=0)
    want = [[t[:a] for t, a in zip(texts, first)],
            [t[a:b] for t, a, b in zip(texts, first, second)],
            [t[b:] for t, b in zip(texts, second)]]
    for block in (4, 7, 64, 1 << 20):
        monkeypatch.setattr(fill_middle, "BLOCK", block)
        array = pa.array(["skipped", *texts], pa.string()).slice(1)
        assert [p.to_pylist() for p in fill_middle.pieces(array, first, second)] == want
