"""Exact groups against SQL and brute force."""

import hashlib
from collections import defaultdict

from tallyloom.llm import exact_dedup
from tallyloom.llm.queries import ORACLES, op4_exact_dedup
from tests.llm.support import AWKWARD, CLASHING, documents
from tests.support.oracle import compare, connect


def test_query_equals_sql(spark, sf):
    report = compare(op4_exact_dedup(spark, sf), connect(sf), ORACLES["op4_exact_dedup"])
    assert report["ok"], report


def test_awkward_rows_and_a_hot_group(spark):
    texts = AWKWARD + ["hot"] * 400 + [f"t{i % 90}" for i in range(300)]
    df = documents(spark, texts, **CLASHING)
    df = df.unionByName(df.filter("doc_id = 4"))  # a repeated row
    for largest in (False, True):
        rows = exact_dedup.groups(df, largest=largest).collect()
        assert len(rows) == len(texts) + 1
        members = defaultdict(list)
        for i, t in [*enumerate(texts), (4, texts[4])]:
            members[t or ""].append(i)
        for r in rows:
            t = texts[r["doc_id"]] or ""
            keep = (max if largest else min)(members[t])
            assert (r["keep_id"], r["group_size"], r["kept"]) == (
                keep, len(members[t]), r["doc_id"] == keep)
            assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a"), (3, "a"), (None, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"])
           for r in exact_dedup.groups(df).collect()}
    assert got == {(None, 3, 2, False), (3, 3, 2, True), (None, None, 1, True)}
    assert exact_dedup.groups(df.limit(0)).count() == 0
