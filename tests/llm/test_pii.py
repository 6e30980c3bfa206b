"""Base spans against Python's re; learned spans on planted contexts."""

import hashlib
import re

from tallyloom.llm import pii
from tallyloom.llm.queries import op1_pii
from tests.llm.support import AWKWARD, CLASHING, documents

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return sum(d[::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")),
            "card": 16 <= len(digits) <= 19 and luhn(digits),
            "phone": 8 <= len(digits) <= 15}[kind]


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "")
            if valid(k, m.group())]


def holds(row, text):
    base = brute(text)
    for k in PLAIN:
        assert row[f"n_{k}"] == sum(b[0] == k for b in base), (k, text)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
    assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text
    assert set(joined.split(",")) <= set(row["spans"].split(",")) or not joined


TEXTS = ["a@b.c d.e@f-g.h.i_j@k.l x@y @z.w a@b..c a.b@c.d@e.f", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8.9",
         "0001.02.003.255 1.2.3.0256", "4111 1111 1111 1111", "4111-1111-1111-1111 5 4111111111111111",
         "14111111111111111", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "4111  1111 1111 1111",
         "+1 (168) 555-5254 +49.30.1234567- +1 2 ++12345678 +123456789012345 +1234567890123456",
         "é\U0001f600 a@b.co é 10.0.0.1\n+44 20 7946 0958", "a@" + "b." * 9_000 + "c",
         "x" * 40_000 + "@", "1." * 20_000, "1 " * 20_000, "+" + "1 " * 9_000 + "x",
         "9" * 40_000]


def test_base_spans_on_awkward_texts(spark):
    texts = AWKWARD + TEXTS
    rows = pii.detect(documents(spark, texts, **CLASHING)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        holds(r, texts[r["doc_id"]])
    assert pii.detect(documents(spark, [])).count() == 0


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_pii(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        holds(r, texts[r["doc_id"]])


def test_contexts_discover_unseen_identifiers(spark):
    texts = [f"please ring {'+1 202 555 01%02d' % i} now" for i in range(30)]
    texts += ["please ring 0171 5550 199 now", "the year 1999 2000 2001 passed"]
    got = {r["doc_id"]: r for r in pii.detect(documents(spark, texts)).collect()}
    assert got[30]["spans"] == "phone:12:25" and got[30]["n_phone"] == 0
    assert got[31]["spans"] == ""


def added(row):
    """Spans beyond the base ones, with their texts' places."""
    return sorted((s["kind"], s["start"], s["end"]) for s in row["added"])


def local(i):
    return f"0{200 + i} 5550 {100 + i}"


def phones(i):
    return f"+1 202 555 {1000 + i}"


def test_contexts_with_most_instances_unseen(spark):
    for seeds, unseen in ((30, 30), (30, 270)):
        texts = [f"please ring {phones(i)} now" for i in range(seeds)]
        texts += [f"please ring {local(i)} now" for i in range(unseen)]
        texts += [f"the meeting {local(500 + i)} ended" for i in range(40)]  # no seed says so
        got = {r["doc_id"]: r for r in pii.detect(documents(spark, texts)).collect()}
        for i in range(seeds, seeds + unseen):
            assert added(got[i]) == [("phone", 12, 12 + len(local(i - seeds)))], texts[i]
        for i in [*range(seeds), *range(seeds + unseen, len(texts))]:
            assert not added(got[i]), texts[i]


def test_found_instances_lead_to_further_contexts(spark):
    # local numbers stand beside "mobile:" only where they were found beside "ring" before
    texts = [f"please ring {phones(i)} x{i}" for i in range(20)]
    texts += [f"please ring {local(i)} y{i}" for i in range(10)]
    texts += [f"a mobile: {local(i)} z{i}" for i in range(30)]
    texts += [f"born in {1950 + i}-03-0{1 + i % 9} w" for i in range(30)]
    got = {r["doc_id"]: r for r in pii.detect(documents(spark, texts)).collect()}
    for i in range(20, 60):
        assert [k for k, _, _ in added(got[i])] == ["phone"], texts[i]
    assert not any(added(got[i]) for i in range(60, 90))


def test_contrary_and_rare_instances_keep_a_context_out(spark):
    dates = [f"on call {1900 + i}-01-{10 + i % 20} shift" for i in range(40)]
    few = [f"on call {phones(i)} shift" for i in range(10)]
    wide = [f"near {local(i)} v{i}" for i in range(300)] + [f"near {phones(50 + i)} u{i}"
                                                            for i in range(10)]
    texts = dates + few + ["on call 0171 5550 199 shift"] + wide
    assert not any(added(r) for r in pii.detect(documents(spark, texts)).collect())


def test_many_matches_in_one_text(spark):
    n = 200_000
    text = " ".join("a%d@b.co" % i if i % 2 else "12 34 56 %07d" % i for i in range(n))
    row = pii.detect(documents(spark, [text])).collect()[0]
    assert row["n_email"] == n // 2
    holds(row, text)
    out = pii.redacted(documents(spark, [text])).collect()[0]["text"]
    assert out == re.sub(r"a[0-9]+@b\.co", "[EMAIL]", text)


def test_candidates_beside_base_spans_are_left_out(spark):
    text = "10.0.0.1 1234567 a@b.co 99 1234567 +49 30 1234567 7654321 4111 1111 1111 1111"
    rows = pii._placed(pii._scan(documents(spark, [text]), "doc_id", "text")).collect()
    base = [(r["start"], r["end"]) for r in rows if r["kind"]]
    other = [(r["start"], r["end"]) for r in rows if not r["kind"]]
    assert sorted(base) == sorted((a, b) for _, a, b in brute(text))
    want = [m.span() for m in re.finditer(r"[0-9(+](?:[() ./-]*[0-9])+", text)
            if len(m.group()) >= 7 and not any(a < m.end() and m.start() < b for a, b in base)]
    assert sorted(other) == want


def test_null_and_repeated_ids(spark):
    rows = [(None, "x a@b.co"), (None, "y"), (7, "x a@b.co"), (7, "x a@b.co"), (7, "10.0.0.1 z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_email"], r["n_ip"]) for r in pii.detect(df).collect())
    assert got == [(-1, 0, 0), (-1, 1, 0), (7, 0, 1), (7, 1, 0), (7, 1, 0)]
    out = sorted((r["doc_id"] or -1, r["text"]) for r in pii.redacted(df).collect())
    assert out == [(-1, "x [EMAIL]"), (-1, "y"), (7, "[IP] z"), (7, "x [EMAIL]"), (7, "x [EMAIL]")]


def test_redaction(spark):
    df = documents(spark, ["é a@b.co, 10.0.0.1", None, "", "+4111 1111 1111 1111 x"], **CLASHING)
    out = pii.redacted(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[0]["text"] == "é [EMAIL], [IP]" and got[0]["n_chars"] == 15
    assert got[1]["text"] is None and got[2]["text"] == ""
    assert "4111" not in got[3]["text"]
