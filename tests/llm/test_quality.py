"""Quality classifier: the pairwise identity, held-out accuracy, awkward rows."""

import zlib
from itertools import combinations

import numpy as np

from tallyloom.llm import quality
from tallyloom.llm.queries import op9_quality
from tests.llm.support import AWKWARD, CLASHING, documents


def test_sum_of_squares_identity():
    rng = np.random.default_rng(9)
    m = quality.Model(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    rows = [(rng.choice(50, n, replace=False), rng.normal(size=n)) for n in (1, 5, 9)]
    got = m.scores(*quality._flat(rows))
    for p, (i, x) in zip(got, rows):
        pairs = sum(m.factors[i[a]] @ m.factors[i[b]] * x[a] * x[b]
                    for a, b in combinations(range(len(i)), 2))
        assert np.isclose(p, 1 / (1 + np.exp(-(0.3 + m.weights[i] @ x + pairs))))




def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in op9_quality(spark, sf).collect()}
    right = total = 0
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        got = rows[r["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert got["predicted"] == int(got["score"] >= 0.7) and 0 <= got["score"] <= 1
        if got["held_out"]:
            total += 1
            right += got["predicted"] == r["quality"]
    assert right >= 0.93 * total


def test_awkward_rows_and_no_labels(spark):
    docs = documents(spark, AWKWARD, **CLASHING)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(AWKWARD))] + [(None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0), labels.filter("quality = 1")):
        model = quality.fit(docs, some)
        scores = [r[0] for r in docs.select(quality.score(model, docs)).collect()]
        assert len(scores) == len(AWKWARD) and all(0 <= s <= 1 for s in scores)
    assert docs.limit(0).select(quality.score(model, docs)).count() == 0
