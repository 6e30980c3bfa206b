"""The pipeline, each stage against brute force on what the one before kept, and as a whole."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tallyloom.llm import packing, pii
from tests.llm import test_line_dedup, test_ngram_join, test_pii
from tests.llm.support import AWKWARD, CLASHING, documents


def texts(docs):
    rows = docs.collect()
    out = {r["doc_id"]: r["text"] for r in rows}
    assert len(out) == len(rows)
    return out


def cut(text, spans):
    """The text with spans replaced, the first of those that overlap giving its name."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_stages_on_the_small_tables(spark, sf):
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    documents_ = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = documents_.columns, texts(documents_)

    good = stages[0](spark, documents_, sf).cache()
    kept = texts(good)
    assert all(before[d] == t for d, t in kept.items())
    quality = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    right = [(d in kept) == (q == 1) for d, q in quality.items() if d in before]
    assert np.mean(right) >= 0.85

    lines = stages[1](spark, good, sf).cache()
    want, copies = test_line_dedup.brute({d: (t or "").split("\n") for d, t in kept.items()})
    deduped = texts(lines)
    assert deduped.keys() == kept.keys()
    for d, t in kept.items():
        own = (t or "").split("\n")
        most = [x for at, x in enumerate(own) if (d, at) not in copies]
        least = [x for at, x in enumerate(own) if (d, at) not in want]
        left = iter(most)  # between what exact copies leave and what all like lines leave
        if most != least:
            got = deduped[d].split("\n") if deduped[d] else []
            assert all(x in left for x in got) and len(got) >= len(least), d
        else:
            assert (deduped[d] or "") == "\n".join(most), d

    near = stages[2](spark, lines, sf).cache()
    ids = sorted(deduped)
    first = {ids[i]: ids[c] for i, (_, c) in enumerate(
        test_ngram_join.brute([deduped[d] for d in ids], words=5, percent=80))}
    assert texts(near) == {d: deduped[d] for d in ids if first[d] == d}

    clean = stages[3](spark, near, sf).cache()
    added = {r["doc_id"]: r["added"] for r in pii.detect(near).collect()}
    redacted = texts(clean)
    for d, t in texts(near).items():
        spans = [(a, b, k) for k, a, b in test_pii.brute(t)]
        spans += [(s["start"], s["end"], s["kind"]) for s in added[d]]
        assert (redacted[d] or "") == cut(t or "", spans), d

    for docs in (good, lines, near, clean):
        assert docs.columns == columns
    packed = stages[4](spark, clean, sf).collect()
    pieces, total = {}, {}
    for r in sorted(packed, key=lambda r: (r["doc_id"], r["start"])):
        pieces[r["doc_id"]] = pieces.get(r["doc_id"], b"") + bytes(r["ids"])
        total[r["sequence_id"]] = total.get(r["sequence_id"], 0) + r["length"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert pieces == {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2],
                                  "<u4").tobytes() for d, t in texts(clean).items()}
    assert all(n <= packing.TOKENS and n & (n - 1) == 0 for n in total.values())


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_stages_on_awkward_and_empty_tables(spark, sf):
    for docs in (documents(spark, AWKWARD, **CLASHING), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES[1:]:
            stage(spark, docs, sf).count()
