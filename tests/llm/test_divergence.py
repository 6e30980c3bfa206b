"""Source divergence: against SQL on whole tables, against plain Python on awkward rows."""

import re
from collections import Counter, defaultdict

from tallyloom.llm import divergence
from tallyloom.llm.queries import ORACLES, op11_divergence
from tests.llm.support import AWKWARD, CLASHING, documents
from tests.support.oracle import compare, connect

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, min_docs=3, top=200):
    """Every kept term for every group, absent ones too."""
    n, df, groups, out = defaultdict(Counter), defaultdict(Counter), defaultdict(set), []
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        n[lang, source].update(words)
        df[lang].update(set(words))
    for lang, sources in groups.items():
        kept = [t for t, d in df[lang].items() if d >= min_docs]
        share, whole = {}, Counter()
        for s in sources:
            whole.update({t: n[lang, s][t] for t in kept})
            total = sum(n[lang, s][t] for t in kept)
            share[s] = {t: 1 + 10**9 * (n[lang, s][t] + 1) // (total + len(kept)) for t in kept}
        total = sum(whole.values())
        q = {t: 1 + 10**9 * (whole[t] + 1) // (total + len(kept)) for t in kept}
        for s in sources:
            p = share[s]
            pairs = [(o, sum((p[t] - share[o][t])**2 // share[o][t] for t in kept))
                     for o in sources - {s}]
            own = [(t, (p[t] - q[t])**2 // q[t]) for t in kept if n[lang, s][t] and p[t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", own, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(items[:most])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_query_equals_sql(spark, sf):
    report = compare(op11_divergence(spark, sf), connect(sf), ORACLES["op11_divergence"])
    assert report["ok"], report


def test_awkward_rows(spark):
    texts = [t for t in AWKWARD for _ in range(2)] + [
        "Straße STRAßE İ Été don't", "Été İ w W", "w1w-w_w`w{w", "x\x85y   z"] * 3
    langs, sources = ["en", None, "", "de"], ["s", "t", None, "", "u"]
    rows = [(t, langs[i % 4], sources[i % 5]) for i, t in enumerate(texts)]
    rows += rows[:7]  # rows that occur twice count twice
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "text string, lang string, source string, term string, n string")
    assert rows_of(divergence.audit(df)) == brute(rows)
    assert rows_of(divergence.audit(df, min_docs=1, top=2)) == brute(rows, 1, 2)


def test_a_language_without_terms_and_an_empty_table(spark):
    rows = [("12 34", "en", "a"), (None, "en", "b"), ("once", "en", "c")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = rows_of(divergence.audit(df))
    assert got == brute(rows) and {r[4] for r in got} == {0} and len(got) == 6
    assert divergence.audit(documents(spark, [], **CLASHING)).count() == 0


def test_counters_are_passed_on_when_many(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 5)
    texts = [f"w{chr(97 + i % 7)} same" for i in range(50)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 50, "source": ["s"] * 50,
                                        "text": [t.encode() for t in texts]})
    n, docs = Counter(), Counter()
    for part in divergence._counted(iter([batch])):
        for r in part.to_pylist():
            n[r["term"]] += r["n"]
            docs[r["term"]] += r["docs"]
    assert n == docs == Counter(w.encode() for t in texts for w in t.split())
