"""Document fingerprints by randomised edit embedding.

All documents take the same random walk (Chakraborty, Goldenberg and Koucky, 2016): in step j a
text writes its current character and moves on or stays, by a random bit of j and that character.
Texts at a small edit distance fall back into step, so that edit distance becomes Hamming
distance between what they wrote. A walk needs two steps a character on average; it gets three standard deviations
more, so that all but about one in a thousand reach the end of their text, and little of the
walk is spent there. The fingerprint samples BITS places of it; where the places lie depends on the length, but consistently: of two
lengths that differ by a share p, all but about p of the places are the same (Lamping and Veach,
2014). Each sample is one random bit of place and character.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import col, slices

BITS, BANDS = 256, 16
WINDOW = 1024    # steps of the walk held at a time
SLICE = 8 << 20  # text bytes worked on together; a longer text is a slice of its own
# Rows of random bits; the walk goes through them again and again.
PERIOD = 8192
_RNG = np.random.default_rng(20160619)
STEPS = _RNG.integers(0, 2, (PERIOD, 256), dtype=np.uint8)
STEPS[:, 0] = 0  # class 0 stands for the end of a text: stay there
SIGNS = _RNG.integers(0, 2, (BITS, 256), dtype=np.uint8)


def _places() -> list[np.ndarray]:
    """For each sample the ascending places that it moves to as texts grow longer."""
    rng, out = np.random.default_rng(2014), []
    for _ in range(BITS):
        at, places = 0, []
        while at < 1 << 40:
            places.append(at)
            at = int((at + 1) / rng.random()) + (0 if at else 1)
            at = max(at, places[-1] + 1)
        out.append(np.array(places))
    return out


PLACES = _places()


def classes(text: str) -> np.ndarray:
    """One of 255 classes per code point."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return ((codes * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(255) + np.uint32(1)


def fingerprints(texts: list[str]) -> np.ndarray:
    """Packed fingerprints, one row of BITS / 8 bytes per text.

    All texts walk at once. Of the walk only WINDOW steps are held at a time: the sampled places
    are read while it goes by.
    """
    if not texts:
        return np.zeros((0, BITS // 8), np.uint8)
    coded = [classes(t).astype(np.uint8) for t in texts]
    length = np.array([len(c) for c in coded])
    order = np.argsort(-length, kind="stable")
    length = length[order]
    flat = np.concatenate([x for i in order for x in (coded[i], np.zeros(1, np.uint8))])
    at = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    steps = 2 * length + np.ceil(3 * np.sqrt(2 * length)).astype(np.int64)  # descending: in step j the first ``live`` texts still walk
    place = np.stack([p[np.maximum(np.searchsorted(p, steps) - 1, 0)] for p in PLACES])
    rising = np.argsort(place, axis=None, kind="stable")
    sampled = np.zeros(place.size, np.uint8)  # the class an empty text writes is 0
    window = np.zeros((WINDOW, len(texts)), np.uint8)
    last, done = int(steps[0]), 0
    for begin in range(0, last, WINDOW):
        end = min(begin + WINDOW, last)
        live = len(steps) - np.searchsorted(steps[::-1], np.arange(begin, end), side="right")
        for j, n in enumerate(live.tolist()):
            here = at[:n]
            wrote = flat.take(here, out=window[j, :n], mode="clip")
            here += STEPS[(begin + j) % PERIOD].take(wrote)
        upto = done + np.searchsorted(place.ravel()[rising[done:]], end)
        cells = rising[done:upto]
        rows = cells % len(texts)
        sampled[cells] = np.where(steps[rows] > 0, window[place.ravel()[cells] - begin, rows], 0)
        done = upto
    # the place itself decides which bit of the class counts
    which = (np.arange(BITS)[:, None] + place) % BITS
    bits = np.empty((len(texts), BITS), np.uint8)
    bits[order] = SIGNS[which, sampled.reshape(place.shape)].T
    return np.packbits(bits, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1: equal bits beyond the half that unrelated texts share by chance."""
    different = np.bitwise_count(a ^ b).sum(axis=1)
    return np.maximum(1 - 2 * different / BITS, 0.0)


def _distinct(texts: list[str]) -> tuple[list[str], np.ndarray]:
    seen: dict[str, int] = {}
    return seen, np.array([seen.setdefault(t, len(seen)) for t in texts], np.int64)


def fingerprint(text: Column) -> Column:
    """Fingerprint as lowercase hex. Null counts as empty; the empty text has one too, and equal
    texts have equal ones."""
    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        seen, at = _distinct([t if isinstance(t, str) else "" for t in texts])
        hexes = [r.tobytes().hex() for r in fingerprints(list(seen))]
        return pd.Series([hexes[i] for i in at], dtype=object)

    return made(text)


def similar(a: Column, b: Column) -> Column:
    """Likeness of two hex fingerprints, in Spark's own functions."""
    width = 15  # hex digits that fit a long
    parts = [F.bit_count(F.conv(F.substring(a, k, width), 16, 10).cast("long").bitwiseXOR(
        F.conv(F.substring(b, k, width), 16, 10).cast("long")))
        for k in range(1, BITS // 4 + 1, width)]
    different = sum(parts[1:], parts[0])
    return F.greatest(F.lit(1.0) - different * (2.0 / BITS), F.lit(0.0))


def bands(print_: Column) -> Column:
    """The fingerprint cut into bands; two texts that share one are candidates."""
    width = BITS // 4 // BANDS
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.concat(
        b.cast("string"), F.lit(":"), F.substring(print_, b * width + 1, F.lit(width))))


def search(queries: DataFrame, corpus: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs (query_id, doc_id, likeness) at or above the threshold that share a band.

    Both tables have doc_id and fingerprint. A stated set of queries meets all rows; rows with
    one fingerprint meet it once, as one class, and are given back by ``doc_id`` afterwards.
    """
    def banded(rows, name):
        kinds = rows.select("fingerprint").distinct()
        return kinds.select(F.col("fingerprint").alias(name),
                            F.explode(bands(F.col("fingerprint"))).alias("band"))
    pairs = (banded(queries, "a").join(banded(corpus, "b"), "band").select("a", "b").distinct()
             .withColumn("likeness", similar(F.col("a"), F.col("b")))
             .filter(F.col("likeness") >= threshold))
    return (pairs.join(queries.select(F.col("doc_id").alias("query_id"),
                                      F.col("fingerprint").alias("a")), "a")
            .join(corpus.select("doc_id", F.col("fingerprint").alias("b")), "b")
            .select("query_id", "doc_id", "likeness"))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and next_text: the text of the next row in descending order of id (equal ids:
    by text); after the last row comes the first. A null id comes last; a null text is empty.

    Rows are dealt by ranges of ids and sorted inside them, so nothing sees the whole table. Each
    range also gets a copy of the first row of the range after it. The driver learns one id per
    range.
    """
    spark = docs.sparkSession
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
                       ).withColumn("at", F.coalesce("doc_id", F.lit(-2**63)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / (4 * parts) for i in range(1, 4 * parts)]
    bounds = rows.agg(F.percentile_approx("at", cuts, 20_000)).first()[0]
    if bounds is None:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    edges = F.array(*[F.lit(b) for b in sorted(set(bounds))])
    ranged = rows.withColumn("part", F.size(F.filter(edges, lambda b: b < F.col("at"))))
    firsts = ranged.groupBy("part").agg(F.max("at").alias("at"))
    order = sorted((r["part"] for r in firsts.collect()), reverse=True)
    before = dict(zip([*order[1:], order[0]], order))  # range -> the one that precedes it
    target = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    heads = (ranged.join(F.broadcast(firsts), ["part", "at"]).groupBy("part", "at")
             .agg(F.min_by(F.struct("doc_id", "text"), "text").alias("row"))
             .select(target[F.col("part")].alias("part"), F.lit(1).alias("guest"),
                     "row.doc_id", "row.text", "at"))
    dealt = (ranged.select("part", F.lit(0).alias("guest"), "doc_id", "text", "at")
             .unionByName(heads).repartition(parts, "part")
             .sortWithinPartitions(F.desc("part"), "guest", F.desc("at"), "text")
             .select("guest", "doc_id", "text"))

    def follow(batches):
        held = None
        for b in slices(batches, most=SLICE):
            guest, ids = b.column("guest").to_pylist(), b.column("doc_id").to_pylist()
            body, out = b.column("text").to_pylist(), []
            for row in zip(guest, ids, body):
                if held is not None and not held[0]:
                    out.append((held[1], held[2], row[2]))
                held = row
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.string())], names=["doc_id", "text", "next_text"])

    return dealt.mapInArrow(follow, "doc_id long, text string, next_text string")


def edited(text: Column, next_text: Column) -> Column:
    """The last third of the text (rounded down) replaced by the start of the next one."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut),
                    F.substring(next_text, F.lit(1), cut))


def compared(ordered: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next:
    fingerprints of each text and its edited text, and how like they and the next one are.

    A null text counts as empty. Repeated rows are compared one by one; other columns are not
    looked at; an empty table gives no rows. A worker holds one slice of texts at a time.
    """
    changed = edited(F.col("text"), F.col("next_text"))
    rows = ordered.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                          F.coalesce("next_text", F.lit("")).alias("next_text")).withColumn(
        "edited", changed).select("doc_id", F.length("text").cast("long").alias("n_chars"),
                                  F.sha2("edited", 256).alias("edited_sha256"),
                                  "text", "edited", "next_text")

    def run(batches):
        for part in slices(batches, most=SLICE):
            n = part.num_rows
            seen, at = _distinct([t for c in ("text", "edited", "next_text")
                                  for t in part.column(c).to_pylist()])
            prints = fingerprints(list(seen))[at]
            own, new, after = prints[:n], prints[n:2 * n], prints[2 * n:]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array([p.tobytes().hex() for p in own], pa.string()),
                 pa.array([p.tobytes().hex() for p in new], pa.string()),
                 pa.array(likeness(own, new)), pa.array(likeness(own, after))],
                names=COMPARED)

    return rows.mapInArrow(run, ", ".join(map(" ".join, zip(COMPARED, (
        "long", "long", "string", "string", "string", "double", "double")))))


COMPARED = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
            "near_edited", "near_next"]
