"""Near-duplicate groups against all pairs."""

import numpy as np

from tallyloom.llm import ngram_join
from tallyloom.llm.queries import op7_ngram_join
from tests.llm.support import AWKWARD, CLASHING, documents


def brute(texts, words=4, percent=85):
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        n = min(words, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    home = list(range(len(texts)))

    def find(i):
        while home[i] != i:
            i = home[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                home[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def holds(spark, texts, words=4, percent=85, **extra):
    rows = ngram_join.groups(documents(spark, texts, **extra).repartition(4), words=words,
                             percent=percent).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert len(rows) == len(texts)
    assert got == dict(enumerate(brute(texts, words, percent)))


def edited(rng, text, times):
    w = text.split(" ")
    for _ in range(times):
        w[rng.integers(len(w))] = f"e{rng.integers(10**6)}"
    return " ".join(w)


def test_awkward_texts(spark):
    holds(spark, AWKWARD + ["one two", "ONE two", "one two three four five"] * 2, **CLASHING)


def test_near_copies_of_all_degrees(spark):
    rng = np.random.default_rng(6)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 3_000, rng.integers(5, 120)))
            for _ in range(15)]
    texts = base + [edited(rng, base[rng.integers(15)], rng.integers(0, 9)) for _ in range(150)]
    holds(spark, texts)
    holds(spark, texts, words=5, percent=80)


def test_a_large_group_and_frequent_passages(spark):
    rng = np.random.default_rng(7)
    core = " ".join(f"c{x}" for x in range(150))
    hot = " ".join(f"h{x}" for x in range(30))
    texts = [edited(rng, core, rng.integers(0, 6)) for _ in range(120)]
    texts += [hot + " " + " ".join(f"w{x}" for x in rng.integers(0, 10**6, 20)) for _ in range(120)]
    holds(spark, texts + [core] * 60)


def test_query_equals_brute_force(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want = brute([t for _, t in docs])
    got = {r["doc_id"]: r for r in op7_ngram_join(spark, sf).collect()}
    for (d, _), (n, home) in zip(docs, want):
        assert (got[d]["n_shingles"], got[d]["component_id"]) == (n, docs[home][0])


def test_keep_first(spark):
    df = documents(spark, ["a b c d e f", "x", "a b c d e f", None, None], **CLASHING)
    kept = ngram_join.keep_first(df, words=5, percent=80)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 3, 4]
    assert ngram_join.keep_first(df.limit(0), words=5, percent=80).count() == 0


def test_null_and_reused_ids_link_by_their_own_texts(spark):
    rng = np.random.default_rng(9)
    a, b, c = (" ".join(f"{k}{x}" for x in rng.integers(0, 10**6, 60)) for k in "abc")
    bridge = " ".join([*a.split()[:-2], "x", "y"])
    far = " ".join([*bridge.split()[2:], "z", "v"])
    rows = [(5, a), (None, bridge), (8, far), (1, b), (7, c), (7, edited(rng, b, 1)), (7, c),
            (None, "alone here"), (None, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.groups(df, words=4, percent=85).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in got) == sorted([
        (5, 57, 5), (-1, 57, 5), (8, 57, 5), (1, 57, 1), (7, 57, 7), (7, 57, 1), (7, 57, 7),
        (-1, 1, -1), (-1, 0, -1), (9, 0, 9)])
    kept = ngram_join.keep_first(df, words=4, percent=85).collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept) == sorted(
        (d or -1, t or "") for i, (d, t) in enumerate(rows) if i not in (2, 5))


def test_a_group_that_few_heads_join(spark):
    """Copies so far apart that only some pairs link: turns join most, the last look the rest."""
    rng = np.random.default_rng(11)
    core = " ".join(f"c{x}" for x in range(90))
    holds(spark, [edited(rng, core, 2) for _ in range(150)] + ["other text of five words"] * 3)


def test_shingles_of_a_slice_are_those_of_single_texts():
    texts = [t or "" for t in AWKWARD] + ["a b c d e", "a  b\nc", "A B C d", "x"]
    together = ngram_join.Shingler(4).sets(texts)
    for t, s in zip(texts, together):
        assert (ngram_join.Shingler(4).sets([t])[0] == s).all()
    assert ngram_join.Shingler(4).sets([]) == []
    assert (together[-2] == ngram_join.Shingler(4).sets(["a b c d"])[0]).all()


def test_bitmaps_keep_every_similar_pair_and_few_others(spark):
    rng = np.random.default_rng(8)
    for percent, n in ((85, 40), (80, 300), (85, 2_000)):
        sets = [rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(3)]
        most = n - ngram_join.required(n, percent)
        sets += [np.concatenate([s[k:], rng.integers(0, 2**64, int(rng.integers(0, k + 1)),
                                                     dtype=np.uint64)])
                 for s in sets for k in rng.integers(0, most + 1, 10)]
        df = spark.createDataFrame(
            [(i, len(s), *ngram_join._bitmap(np.unique(s)).tolist()) for i, s in enumerate(sets)],
            ", ".join(f"{c} long" for c in ("i", "n", *ngram_join.BITMAP)))
        other = df.select(*[df[c].alias(f"{c}2") for c in df.columns])
        kept = {(r["i"], r["i2"]) for r in df.crossJoin(other).filter(
            ngram_join._may_link(percent, "{}2")).collect()}
        similar = set()
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                both = len(np.intersect1d(x, y))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    similar.add((i, j))
        assert len(similar) > 60 and similar <= kept
        if n < 1_000:
            assert len(kept) <= 2 * len(similar)


def test_texts_that_share_a_frequent_passage_make_few_pairs(spark):
    """Short texts, so that the passage is in every prefix; the join makes a row for every pair of
    them where bitmaps are not compared."""
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{i}" for i in range(9))
    texts = [f"{passage} " + " ".join(f"w{x}" for x in rng.integers(0, 10**6, 8))
             for _ in range(400)]
    summary = ngram_join._summaries(
        documents(spark, texts).selectExpr("doc_id doc", "doc_id th", "text"), 4)
    counts = np.full(ngram_join.COUNTERS, 400)
    rows = ngram_join._prefixes(
        documents(spark, texts).select("text"), 4, 60, type("Sent", (), {"value": counts}))
    nodes = summary.filter("node IS NOT NULL").select("node", *ngram_join.BITMAP)
    mixed = rows.join(nodes, "node")
    right = mixed.select("token", *[mixed[c].alias(f"{c}2") for c in ("node", "n", *ngram_join.BITMAP)])
    met = mixed.join(right, "token").filter("node < node2")
    assert met.count() > 10_000
    assert met.filter(ngram_join._may_link(85, "{}2")).count() < 100
    holds(spark, texts[:150] + [texts[0] + " end"])


def test_words_are_hashed_by_all_their_bytes():
    rng = np.random.default_rng(10)
    words = {bytes(rng.integers(33, 127, n, dtype=np.uint8)) for n in range(1, 200) for _ in range(20)}
    words |= {w[:-1] + b"~" for w in words} | {b"x" * n for n in range(1, 200)}
    words |= {w[:i] + b"\x00" + w[i:] for w in list(words)[:200] for i in (0, len(w))}
    words = sorted(words)
    texts = [b" ".join(words).decode(), "", " ".join(w.decode() for w in reversed(words))]
    split, counts = ngram_join.split_words([t.encode() for t in texts])
    assert counts.tolist() == [len(words), 0, len(words)]
    h = ngram_join._word_hashes(split).tolist()
    assert h[:len(words)] == h[len(words):][::-1]  # wherever a word stands
    assert len(set(h)) == len(words)
    x = np.array(h[:len(words)], np.uint64)
    for bit in range(64):
        assert 0.45 < ((x >> np.uint64(bit)) & np.uint64(1)).mean() < 0.55
