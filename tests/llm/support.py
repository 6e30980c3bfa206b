"""Awkward inputs that every operator is tried on."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=0, **extra):
    """Documents with the given texts; further columns may clash with an operator's own."""
    rows = [(first + i, t, "en", "s", None if t is None else len(t), *extra.values())
            for i, t in enumerate(texts)]
    schema = DOCS + "".join(f", `{name}` string" for name in extra)
    return spark.createDataFrame(rows, schema)


CLASHING = {name: "x" for name in (
    "run", "digest", "owner", "keep", "ids", "n_tokens", "start", "host", "path", "score",
    "component_id", "n_bytes", "fingerprint", "word", "line", "prompt", "kind", "value", "a.b")}
AWKWARD = [None, "", " ", "\n", "a", "a", "\x00", "e\u0301 \u00e9 \U0001f600", "x" * 50_000,
           "w " * 20_000, "tab\tnew\nline\r\n\x0b\x0c", "don't we'll  \u2028 \x1c 12,5"]
