"""Source divergence audit: how far the word frequencies of a language's sources lie apart.

Terms are runs of ASCII letters and of characters beyond ASCII; only A-Z are lowered. One
``bytes.translate`` does both, ``bytes.split`` cuts, a ``Counter`` of each document gives its
frequencies. Everything after the counting is whole-number arithmetic in Spark, over the terms
that occur: terms absent from a source all have one share there, so they are added up by
inclusion and exclusion instead of being written out.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import col, slices, stored

UNIT = 1_000_000_000  # shares are whole numbers of parts in a thousand million, plus one
HELD = 200_000        # counters that a task holds before it passes them on
ROWS = 20_000         # rows of one Arrow batch going out

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
TRANSLATE = bytes((b | 0x20 if b < 128 else b) if b in _LETTERS else 0x20 for b in range(256))


def _counted(batches):
    """lang, source, term, occurrences and documents, summed over as many texts as HELD allows."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def rows():
        out = [(*group, t, n, docs[t]) for group, (freq, docs) in held.items()
               for t, n in freq.items()]
        for i in range(0, len(out), ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out[i:i + ROWS]), (
                    pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()))],
                names=["lang", "source", "term", "n", "docs"])

    size = 0
    for part in slices(batches):
        groups = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
        for group, text in zip(groups, part.column("text").to_pylist()):
            freq, docs = held.setdefault(group, (Counter(), Counter()))
            size -= len(freq)
            own = Counter(text.translate(TRANSLATE).split())
            docs.update(own.keys())
            for t, n in own.items():
                freq[t] += n
            size += len(freq)
            if size > HELD:
                yield from rows()
                held.clear()
                size = 0
    yield from rows()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang",
                source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (rows that hold it); nulls count as ''."""
    plain = docs.select(*(F.coalesce(col(c).cast("string"), F.lit("")).alias(a)
                          for c, a in ((lang, "lang"), (source, "source"))),
                        F.coalesce(col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    parts = plain.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    return (parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"),
                                                        F.sum("docs").alias("docs"))
            .withColumn("term", F.col("term").cast("string")))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + terms)); null without terms."""
    product = (n + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return 1 + F.call_function("div", product, F.nullif(total + terms, F.lit(0)).cast("decimal(20,0)"))


def _term(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of two shares. Shares are at most UNIT + 1, so a term is at most
    about 10^18; the terms of a pair together stay below 10^18 + 10^9 * terms."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: the sources that a source is unlike, and its own terms.

    A language keeps the terms of at least ``min_docs`` of its rows. A source's share of a term is
    1 + floor(10^9 * (count + 1) / (occurrences of kept terms + number of kept terms)). Part
    ``pair`` sums floor((p - q)^2 / q) over the kept terms for every other source of the language;
    part ``term`` gives it against the whole language for terms more frequent here, the first
    ``top`` of them. Ranks go by value, then by the item's bytes.

    A null text, lang or source counts as ''. A source without terms takes part in all pairs; in a
    language without kept terms all values of pairs are 0. A repeated row counts again. A long text
    is worked on whole, as one document. An empty table gives no rows. Other columns are not
    looked at. A task holds the counters of at most ``HELD`` terms and of one slice of texts.
    """
    counted = stored(term_counts(docs, text, lang, source), "terms")
    plain = docs.select(*(F.coalesce(col(c).cast("string"), F.lit("")).alias(a)
                          for c, a in ((lang, "lang"), (source, "source"))))

    kept = (counted.groupBy("lang", "term")
            .agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= min_docs).drop("docs"))
    terms = stored(counted.drop("docs").join(kept, ["lang", "term"]), "kept-terms")

    of_source = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = (kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("all_total")))
    zero = F.lit(0).cast("long")
    groups = (plain.distinct().join(of_source, ["lang", "source"], "left")
              .join(of_lang, "lang", "left")
              .select("lang", "source", F.coalesce("total", zero).alias("total"),
                      F.coalesce("v", zero).alias("v"),
                      F.coalesce("all_total", zero).alias("all_total"))
              .withColumn("p0", _share(zero, F.col("total"), F.col("v"))))
    groups = stored(groups, "sources")

    shares = terms.join(groups, ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("total"), F.col("v")))
    return _pairs(groups, shares).unionByName(_own_terms(shares, top))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).select(
        "lang", "source", "part", "item", "value", "rank")


def _own_terms(shares: DataFrame, top: int) -> DataFrame:
    q = _share(F.col("all_n"), F.col("all_total"), F.col("v"))
    rows = (shares.withColumn("q", q).filter(F.col("p") > F.col("q"))
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    _term(F.col("p"), F.col("q")).alias("value")))
    return _ranked(rows).filter(F.col("rank") <= top)


def _directed(pairs: DataFrame, there: Column, back: Column) -> DataFrame:
    """Both directions of each pair (a, b) as rows lang, source, item, value."""
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"),
                            there.alias("value")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item"),
                            back.alias("value")))
    return pairs.select("lang", F.explode(ways).alias("way")).select("lang", "way.*")


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """The sum over all kept terms of every ordered pair of sources.

    With absent shares p0: every term as if absent from both, plus the change for the terms of
    either alone (by the distinct shares of a source, not term by term), plus the change of the
    change for terms that both hold.
    """
    a0 = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), "v")
    b0 = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0"))
    other = F.col("a") != F.col("b")
    a, b, p, q = F.col("a0"), F.col("b0"), F.col("p"), F.col("q")

    base = a0.join(b0, "lang").filter(other).select(
        "lang", F.col("a").alias("source"), F.col("b").alias("item"),
        F.coalesce(F.col("v") * _term(a, b), F.lit(0)).alias("value"))

    levels = shares.groupBy("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), "p").agg(
        F.count("*").alias("terms"))
    alone = levels.join(b0, "lang").filter(other)
    one = _directed(alone, F.col("terms") * (_term(p, b) - _term(a, b)),
                    F.col("terms") * (_term(b, p) - _term(b, a)))

    left = shares.select("lang", "term", F.col("source").alias("a"), "p", F.col("p0").alias("a0"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q"),
                          F.col("p0").alias("b0"))
    both = (left.join(right, ["lang", "term"]).filter(F.col("a") < F.col("b"))
            .groupBy("lang", "a", "b").agg(
        F.sum(_term(p, q) - _term(p, b) - _term(a, q) + _term(a, b)).alias("there"),
        F.sum(_term(q, p) - _term(q, a) - _term(b, p) + _term(b, a)).alias("back")))
    two = _directed(both, F.col("there"), F.col("back"))

    summed = base.unionByName(one).unionByName(two).groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"))
    return _ranked(summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
