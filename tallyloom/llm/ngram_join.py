"""Jaccard join of documents on word n-grams with adaptive multi-match prefixes.

The n-grams of a document are put in one order for all, rare ones first (estimated from counters
over all n-grams of all documents), then by hash. Two sets of Jaccard similarity t or more share
at least m of the first n - ceil(t n) + m n-grams of each, for every m (Wang, Li and Feng, 2012). Each
document picks its own m: longer prefixes cost more candidates to count, and in turn demand more
shared n-grams, so fewer pairs to verify; m is where the estimated sum is least. A pair is held to
the smaller m of the two.

Documents with equal sets are one node. Links are first sought turn by turn with one node of each
bucket, which joins large groups of near copies at the cost of a few pairs per node. Then every
remaining pair of nodes in different components that meets its m is verified, so that no link
between components is lost; pairs inside a component need no look. Verification is on whole sets.

Every node carries a bitmap of its set: 512 bits, each the parity of the n-grams whose hash falls
to it. Where two bitmaps differ, so does an n-gram at least, so most pairs that only share a
frequent passage are told apart where they meet, without a look at their texts (Sandes, Teodoro
and Melo, 2020).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.sizing import fits_broadcast
from tallyloom.llm.graph import components
from tallyloom.llm.shared import col, slices, split_words, stored

COUNTERS = 1 << 16
LONGEST = 4  # m is 1 .. LONGEST
BITMAP = [f"b{i}" for i in range(8)]  # 64 bits each
NO_ID = -2**63
LONG_WORD = 64  # bytes
TRIES = 3  # pairs that a node is tried with in one turn
TOGETHER = 500  # pairs whose texts are cut to n-grams together
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Shingler:
    """64-bit hashes of word n-grams; words end at ASCII white space, A-Z are folded."""

    def __init__(self, words: int):
        self.words = words

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """The distinct hashes of each text, ascending; one for a text with fewer words, none
        without words. Words of all texts are hashed together."""
        words, counts = split_words([t.encode().translate(_FOLD) for t in texts])
        h = _word_hashes(words)
        whole = _mixed(h, self.words) if len(h) >= self.words else None
        out, at = [], 0
        for n in counts.tolist():
            if n >= self.words:
                out.append(np.unique(whole[at:at + n - self.words + 1]))
            else:
                out.append(_mixed(h[at:at + n], n) if n else np.zeros(0, np.uint64))
            at += n
        return out


def _word_hashes(words: pa.LargeBinaryArray) -> np.ndarray:
    """A 64-bit hash of every word, eight bytes of all words at a time; long words one by one."""
    from xxhash import xxh3_64_intdigest

    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[:len(words) + 1]
    data = bytes(words.buffers()[2]) + bytes(8)
    at, sizes = offsets[:-1], np.diff(offsets)
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # from every byte on
    h = sizes.astype(np.uint64) * _B
    rows = np.arange(len(words))
    for k in range(0, LONG_WORD, 8):
        left = np.minimum(sizes[rows] - k, 8).astype(np.uint64)
        part = eights[at[rows] + k] & (np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * left))
        x = (h[rows] ^ part) * _A
        x = (x ^ x >> np.uint64(32)) * _B
        h[rows] = x ^ x >> np.uint64(29)
        rows = rows[sizes[rows] > k + 8]
    for i in rows.tolist():
        h[i] = xxh3_64_intdigest(words[i].as_py())
    return h


def _mixed(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for every n words in a row."""
    out = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        out = (out ^ h[k:len(h) - n + 1 + k]) * _A
        out ^= out >> np.uint64(29)
    return out * _B


def _node(shingles: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    return int(np.int64(np.uint64(xxh3_64_intdigest(shingles.tobytes()))))


def _bitmap(shingles: np.ndarray) -> np.ndarray:
    """One long for each column of BITMAP."""
    bits = 64 * len(BITMAP)
    place = (shingles >> np.uint64(65 - bits.bit_length())).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(48)).astype(np.int64)


def _summaries(docs: DataFrame, words: int) -> DataFrame:
    """One row (doc, th, n, node, bitmap) per document, and per task one (n, counter) per used
    counter."""
    names = ["doc", "th", "n", "node", "counter", *BITMAP]

    def run(batches):
        shingler, counts = Shingler(words), np.zeros(COUNTERS, np.int64)
        for part in slices(batches):
            sets = shingler.sets(part.column("text").to_pylist())
            counts += np.bincount(_counter(np.concatenate(sets)), minlength=COUNTERS)
            bitmaps = np.stack([_bitmap(s) for s in sets], axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("th"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                 pa.nulls(part.num_rows, pa.int64()), *map(pa.array, bitmaps)], names=names)
        used = np.flatnonzero(counts)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, pa.array(counts[used]), none, pa.array(used), *[none] * len(BITMAP)],
            names=names)

    return docs.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def required(n: int, percent: int) -> int:
    """Least number of n-grams a set of n shares with any set that it is similar to."""
    return -(-percent * n // 100)


def prefix(shingles: np.ndarray, counts: np.ndarray, percent: int, *,
           levels: np.ndarray | None = None, usual: float | None = None) -> tuple[np.ndarray, int]:
    """The n-grams to index and m, the number of them that a partner has to share."""
    levels = _levels(counts) if levels is None else levels
    counter = _counter(shingles)
    # the n-grams are ascending, and stay so within a level
    order = np.argsort(levels[counter], kind="stable")
    n = len(shingles)
    base = n - required(n, percent)
    ms = np.arange(1, min(LONGEST, n - base) + 1)
    often = counts[counter[order[:base + int(ms[-1])]]]
    reads = np.cumsum(often)[base + ms - 1] / (counts.mean() if usual is None else usual)
    cost = reads + n * reads / 4.0 ** ms  # counting, and verifying what still matches
    m = int(ms[cost.argmin()])
    return shingles[order[:base + m]], m


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.log2(counts + 1.0).astype(np.int8)


def _prefixes(docs: DataFrame, words: int, percent: int, counts) -> DataFrame:
    """token, node, n, m: the prefix of every set that a task meets, once a task."""
    def run(batches):
        shingler = Shingler(words)
        levels, usual = _levels(counts.value), float(counts.value.mean())
        for part in slices(batches):
            tokens, rows, seen = [], [], set()
            for s in shingler.sets(part.column("text").to_pylist()):
                if len(s) and (node := _node(s)) not in seen:
                    seen.add(node)
                    p, m = prefix(s, counts.value, percent, levels=levels, usual=usual)
                    tokens.append(p)
                    rows.append((node, len(s), m))
            if rows:
                times = [len(t) for t in tokens]
                a = np.array(rows, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)),
                     *[pa.array(np.repeat(a[:, k], times)) for k in range(3)]],
                    names=["token", "node", "n", "m"])

    return docs.mapInArrow(run, "token long, node long, n long, m long")


def _sets_of(nodes: DataFrame, docs: DataFrame, first: DataFrame, words: int) -> DataFrame:
    """node, packed (compressed text) for some nodes, each from its first document.

    A document is found by id and by a hash of its text, so an id with several texts gives each
    node its own."""
    needed = stored(nodes.join(first, "node").select("node", "first.*"), "needed")
    side = F.broadcast(needed) if fits_broadcast(needed, check_sources=False) else needed

    def squeeze(batches):
        press, shingler = zstandard.ZstdCompressor(3), Shingler(words)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            good = [_node(s) == node if len(s) else False for s, node in zip(
                shingler.sets(texts), part.column("node").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("node").filter(pa.array(good, pa.bool_())),
                 pa.array([press.compress(t.encode()) for t, g in zip(texts, good) if g],
                          pa.binary())], names=["node", "packed"])

    return (docs.join(side, ["doc", "th"]).select("node", "text")
            .mapInArrow(squeeze, "node long, packed binary")
            .groupBy("node").agg(F.min("packed").alias("packed")))


def _linked(pairs: DataFrame, docs: DataFrame, first: DataFrame, words: int,
            percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = stored(_sets_of(nodes, docs, first, words), "sets")

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        shingler, unpack = Shingler(words), zstandard.ZstdDecompressor()
        known: dict[bytes, np.ndarray] = {}
        out, pairs = [], list(zip(left, right))
        for at in range(0, len(pairs), TOGETHER):
            some = pairs[at:at + TOGETHER]
            needed = {p for pair in some for p in pair}
            known = {p: known[p] for p in needed if p in known}
            new = [p for p in needed if p not in known]
            known.update(zip(new, shingler.sets([unpack.decompress(p).decode() for p in new])))
            for x, y in some:
                x, y = known[x], known[y]
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    a = sets.select(F.col("node").alias("a"), F.col("packed").alias("pa"))
    b = sets.select(F.col("node").alias("b"), F.col("packed").alias("pb"))
    return pairs.join(a, "a").join(b, "b").filter(similar("pa", "pb")).select("a", "b")


def _may_link(percent: int, other: str) -> Column:
    """Whether two sets can be similar by their sizes and bitmaps; ``other``.format(column) names a
    column of the second one.

    Every bit in which the bitmaps differ stands for an n-gram of one set alone.
    """
    n, n2 = F.col("n"), F.col(other.format("n"))
    differ = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(other.format(b)))) for b in BITMAP),
                 start=F.lit(0))
    return (100 * F.least(n, n2) >= percent * F.greatest(n, n2)) & (
        (100 + percent) * differ <= (100 - percent) * (n + n2))


def _placed(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of tokens that nodes of several components share, with the component of each."""
    placed = shared.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = placed.groupBy("token").agg(F.min("component").alias("low"),
                                        F.max("component").alias("high")).filter("low < high")
    return stored(placed.join(mixed.select("token"), "token"), "mixed")


def _tries(mixed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Up to TRIES pairs (a, b) for each node: with the heads of its buckets that are of another
    component and may link with it. Every turn another node of a bucket is its head, first the one with the least part
    of n-grams of its own, which is most like the others."""
    order = F.xxhash64("node", F.lit(turn))
    if turn == 0:
        length = F.expr(f"n - ({percent} * n + 99) DIV 100 + m")  # of the prefix
        often = mixed.groupBy("node").agg((F.count(F.lit(1)) / F.first(length)).alias("often"))
        mixed, order = mixed.join(often, "node"), F.struct("often", order)
    heads = mixed.groupBy("token").agg(
        F.max(F.struct(order.alias("order"), "node", "n", "component", *BITMAP)).alias("head"))
    best = Window.partitionBy("node").orderBy(F.desc("times"), "head")
    return (mixed.join(heads, "token").filter(F.col("component") != F.col("head.component"))
            .filter(_may_link(percent, "head.{}"))
            .groupBy("node", F.col("head.node").alias("head")).agg(F.count(F.lit(1)).alias("times"))
            .withColumn("k", F.row_number().over(best)).filter(F.col("k") <= TRIES)
            .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
            .distinct())


def _may_reach(percent: int) -> Column:
    """Whether two sets can be similar that share ``times`` n-grams of their prefixes.

    Any other n-gram that they share lies, in the order of all, behind the prefix that ends first,
    so there are no more of them than that set has left there.
    """
    left = F.expr(f"greatest(({percent} * n + 99) DIV 100 - m, ({percent} * n2 + 99) DIV 100 - m2)")
    return (100 + percent) * (F.col("times") + left) >= percent * (F.col("n") + F.col("n2"))


def _pairs_left(mixed: DataFrame) -> int:
    """How many pairs of different components meet in the buckets, at most."""
    parts = mixed.groupBy("token", "component").agg(F.count(F.lit(1)).cast("double").alias("size"))
    pairs = parts.groupBy("token").agg(
        ((F.sum("size") * F.sum("size") - F.sum(F.col("size") * F.col("size"))) / 2).alias("pairs"))
    return int(pairs.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0])


def _links(shared: DataFrame, docs: DataFrame, first: DataFrame, words: int,
           percent: int) -> DataFrame:
    """node, component of every node that has a link.

    Turn by turn, nodes are tried with one other node of each bucket, and what links becomes one
    component. That goes on while it saves pairs: until fewer pairs are left than rows, or turns no
    longer make them fewer by a tenth. Then every pair that is left, of nodes in different
    components that share enough of their prefixes, is verified. The number of turns changes the
    work, never the result.
    """
    none = shared.select("node", F.col("node").alias("component")).limit(0)
    labels, tried, left, turn = none, None, None, 0
    rows = shared.count()
    while True:
        mixed = _placed(shared, labels)
        before, left = left, _pairs_left(mixed)
        if left <= rows or (turn > 1 and left > 0.9 * before):
            break
        fresh = _tries(mixed, turn, percent)
        fresh = stored(fresh if tried is None else fresh.join(tried, ["a", "b"], "left_anti"), "tries")
        tried = fresh if tried is None else tried.unionByName(fresh)
        labels = _joined(labels, _linked(fresh, docs, first, words, percent))
        turn += 1
    right = mixed.select("token", *[F.col(c).alias(f"{c}2")
                                    for c in ("node", "n", "m", "component", *BITMAP)])
    pairs = (mixed.join(right, "token").filter(
        (F.col("node") < F.col("node2")) & (F.col("component") != F.col("component2"))
        & _may_link(percent, "{}2"))
        .groupBy(F.col("node").alias("a"), F.col("node2").alias("b"))
        .agg(F.count(F.lit(1)).alias("times"), *[F.min(c).alias(c) for c in ("n", "m", "n2", "m2")])
        .filter(F.col("times") >= F.least("m", "m2")).filter(_may_reach(percent))
        .select("a", "b"))
    if tried is not None:
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
    return _joined(labels, _linked(stored(pairs, "pairs"), docs, first, words, percent))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of nodes after further links; of many links between two components one counts."""
    def home(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_home"))

    edges = (links.join(home("a"), "a", "left").join(home("b"), "b", "left")
             .select(F.coalesce("a_home", "a").alias("a"), F.coalesce("b_home", "b").alias("b"))
             .filter("a <> b").distinct())
    merged = components(stored(edges, "links"))
    known = labels.select("node", F.col("component").alias("at")).unionByName(
        merged.select("node", F.col("node").alias("at")).join(labels, "node", "left_anti"))
    return stored(known.join(merged.withColumnRenamed("node", "at"), "at", "left").select(
        "node", F.coalesce("component", "at").alias("component")), "labels")


def _homes(docs: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """doc, th, n, least: of every row its id, a hash of its text, the size of its set and the
    smallest id of its group; null ids are NO_ID."""
    spark = docs.sparkSession
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    plain = docs.select(F.coalesce(col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
                        F.xxhash64(whole).alias("th"), whole.alias("text"))
    summary = stored(_summaries(plain, words), "summaries")
    members = summary.filter(F.col("counter").isNull()).drop("counter")
    # a fixed number of counters, whatever the corpus
    table = np.zeros(COUNTERS, np.int64)
    for c, n in (summary.filter(F.col("counter").isNotNull()).groupBy("counter")
                 .agg(F.sum("n")).collect()):
        table[c] = n
    counts = spark.sparkContext.broadcast(table)
    first = stored(members.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min(F.struct("doc", "th")).alias("first"),
        F.min(F.nullif("doc", F.lit(NO_ID))).alias("least"),
        *[F.first(b).alias(b) for b in BITMAP]), "nodes")

    # read twice, so stored: only n-grams of several sets go on
    rows = stored(_prefixes(plain, words, percent, counts), "prefixes")
    several = rows.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")
                                        ).filter("low < high").select("token")
    shared = stored(rows.join(several, "token").groupBy("token", "node").agg(
        F.first("n").alias("n"), F.first("m").alias("m"))
        .join(first.select("node", *BITMAP), "node"), "shared")
    linked = _links(shared, plain, first.select("node", "first"), words, percent)

    # the smallest document of a component; documents of one node share it
    placed = first.join(linked, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component"))
    least = placed.groupBy("component").agg(F.min("least").alias("least"))
    homes = placed.select("node", "component").join(least, "component").select("node", "least")
    return members.join(homes, "node", "left").select("doc", "th", "n", "least")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, words: int = 4,
           percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable
    by links, itself included).

    Two documents link when 100 x shared >= percent x united of their distinct n-grams. A text
    with fewer words is one n-gram; a null, empty or blank one has none and links with nothing.
    Rows that repeat an id are judged each by its own text. A row without an id links like any
    other and joins others, but null is a component's id only where no row of it has one. Sets
    are told apart by a 64-bit hash. Long texts are worked on whole, an empty table gives no
    rows, and other columns are not looked at.
    """
    own = F.nullif("doc", F.lit(NO_ID))
    return _homes(docs, doc_id, text, words, percent).select(
        own.alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("least", own).alias("component_id"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, words: int,
               percent: int) -> DataFrame:
    """The rows whose document is the smallest id of its group; all columns are passed on.

    Of an id with several texts each is kept or dropped by its own group; rows alike in id and
    text are kept or dropped together. A null id is kept.
    """
    found = _homes(docs, doc_id, text, words, percent)
    gone = stored(found.filter((F.col("doc") != NO_ID) & (F.col("doc") != F.col("least")))
                  .select(F.col("doc").alias("_gone"), F.col("th").alias("_th")).distinct(), "gone")
    side = F.broadcast(gone) if fits_broadcast(gone, check_sources=False) else gone
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    return docs.join(side, (col(doc_id) == F.col("_gone")) & (F.xxhash64(whole) == F.col("_th")),
                     "left_anti")
