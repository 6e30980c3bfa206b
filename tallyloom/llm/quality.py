"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Score = sigmoid(bias + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j). The pairwise term is
computed in linear time, as half of the squared sum less the sum of squares, factor by factor
(Rendle, 2010). It is fitted on a bounded sample of labelled rows and applied to every row.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import col

# Buckets of hashed words; levels of each structure statistic.
WORD_BUCKETS, LEVELS = 1 << 15, 16
FACTORS = 8
# Largest number of labelled rows that a model is fitted on.
SAMPLE = 8_192
# Words whose buckets a worker remembers before it starts over.
REMEMBERED = 500_000

# Classes of bytes for the structure statistics, by their bit: upper case, digit, symbol, bar.
_CLASSES = np.zeros((256, 4))
_CLASSES[ord("A"):ord("Z") + 1, 0] = 1
_CLASSES[ord("0"):ord("9") + 1, 1] = 1
for _b in range(33, 127):
    if not chr(_b).isalnum() and chr(_b) not in ".,;:'\"?-()":
        _CLASSES[_b, 2] = 1
_CLASSES[ord("|"), 3] = 1


class Featurizer:
    """Sparse features (index, value) of a text and its number of characters."""

    SIZE = WORD_BUCKETS + 12 * LEVELS

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        counts = Counter(words)
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        for w in [w for w in counts if w not in known]:
            known[w] = zlib.crc32(w.lower().encode()) % WORD_BUCKETS
        n = max(len(words), 1)
        index = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
        value = np.fromiter(counts.values(), np.float64, len(counts)) / n
        stats = self._statistics(text, words, counts, n_chars)
        levels = np.clip(stats * LEVELS, 0, LEVELS - 1).astype(np.int64)
        return (np.concatenate([index, WORD_BUCKETS + np.arange(12) * LEVELS + levels]),
                np.concatenate([value, np.ones(12)]))

    @staticmethod
    def _statistics(text, words, counts, n_chars) -> np.ndarray:
        """Twelve numbers, each brought to 0..1."""
        n, size = max(len(words), 1), max(len(text), 1)
        raw = np.frombuffer(text.encode(), np.uint8)
        upper, digit, symbol, bar = np.bincount(raw, minlength=256) @ _CLASSES / size
        repeats = sum(map(operator.eq, words, words[1:])) / n
        lines = text.split("\n")
        top = max(counts.values(), default=0) / n
        known_chars = len(text) if n_chars is None or n_chars != n_chars else max(n_chars, 0)
        return np.array([
            np.log2(known_chars + 1) / 20, np.log2(len(words) + 1) / 16,
            sum(map(len, counts)) / max(len(counts), 1) / 16,
            len(counts) / n, np.sqrt(repeats), np.sqrt(upper), np.sqrt(digit),
            np.sqrt(symbol), np.sqrt(2 * bar), np.log2(n / len(lines) + 1) / 10,
            len(set(lines)) / len(lines) - 1e-9, np.sqrt(top)])


@dataclass
class Model:
    """Parameters of bounded size, whatever the corpus."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Probabilities for documents whose features begin at ``starts``."""
        linear = np.add.reduceat(self.weights[index] * value, starts)
        sums, squares = _moments(self.factors, index, value, starts)
        return 1 / (1 + np.exp(-(self.bias + linear + 0.5 * (sums ** 2 - squares).sum(axis=1))))


def _moments(factors, index, value, starts):
    parts = factors[index] * value[:, None]
    return (np.add.reduceat(parts, starts, axis=0),
            np.add.reduceat(parts ** 2, starts, axis=0))


def _flat(rows):
    starts = np.cumsum([0] + [len(i) for i, _ in rows[:-1]])
    return np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), starts


def fit_rows(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *,
             steps: int = 240, batch: int = 256, rate: float = 0.05, l2: float = 1e-5,
             seed: int = 7) -> Model:
    """Log loss minimised by AdaGrad over about ``steps`` mini-batches; the same rows
    give the same model."""
    rng = np.random.default_rng(seed)
    size = Featurizer.SIZE
    share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    model = Model(float(np.log(share / (1 - share))), np.zeros(size),
                  rng.normal(0, 0.02, (size, FACTORS)))
    if len(set(labels.tolist())) < 2:
        model.factors[:] = 0
        return model
    sum_w, sum_v, sum_b = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3), 1e-3
    per_epoch = -(-len(labels) // batch)
    for _ in range(-(-steps // per_epoch)):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            index, value, starts = _flat([features[i] for i in some])
            error = model.scores(index, value, starts) - labels[some]
            lengths = np.diff(np.append(starts, len(index)))
            e = np.repeat(error, lengths) / len(some)
            sums, _ = _moments(model.factors, index, value, starts)
            used, inverse = np.unique(index, return_inverse=True)
            g = np.bincount(inverse, e * value) + l2 * model.weights[used]
            sum_w[used] += g * g
            model.weights[used] -= rate * g / np.sqrt(sum_w[used])
            spread = np.repeat(sums, lengths, axis=0)
            own = model.factors[index] * value[:, None]
            by_row = (e * value)[:, None] * (spread - own)
            gv = np.stack([np.bincount(inverse, by_row[:, f]) for f in range(FACTORS)], axis=1)
            gv += l2 * model.factors[used]
            sum_v[used] += gv * gv
            model.factors[used] -= rate * gv / np.sqrt(sum_v[used])
            gb = error.mean()
            sum_b += gb * gb
            model.bias -= rate * gb / np.sqrt(sum_b)
    return model


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4 (a null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
        n_chars: str = "n_chars", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on the ``sample`` labelled rows with the smallest hashes of their id that are not held
    out. Rows without a label, an id or a document are left out. The features, not the texts, of
    this bounded sample go to the driver."""
    chosen = (labels.select(col(doc_id).cast("long").alias("_id"),
                            col(label).cast("double").alias("_label"))
              .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull()
                      & ~held_out(F.col("_id")))
              .distinct().orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample))

    def features(batches):
        import pyarrow as pa

        make = Featurizer()
        for b in batches:
            made = [make(t or "", n) for t, n in zip(b.column("text").to_pylist(),
                                                     b.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_label"),
                 pa.array([i.astype(np.int32).tobytes() for i, _ in made], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for _, v in made], pa.binary())],
                names=["_id", "_label", "index", "value"])

    rows = (docs.select(col(doc_id).cast("long").alias("_id"), col(text).alias("text"),
                        col(n_chars).cast("double").alias("n"))
            .join(F.broadcast(chosen), "_id")  # ``sample`` rows of two numbers
            .select("_id", "_label", "text", "n")
            .mapInArrow(features, "_id long, _label double, index binary, value binary")
            .collect())
    rows.sort(key=lambda r: (r["_id"], r["_label"], bytes(r["index"])))
    return fit_rows([(np.frombuffer(r["index"], np.int32), np.frombuffer(
        r["value"], np.float32).astype(float)) for r in rows],
        np.array([r["_label"] for r in rows]))


def score(model: Model, docs: DataFrame, *, text: str = "text",
          n_chars: str = "n_chars") -> Column:
    """Probability of label 1 as a column of ``docs``; null and empty texts get one too.

    Only the text and its number of characters go in: no label, language, source or id.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series, chars: pd.Series) -> pd.Series:
        make, parts = Featurizer(), []
        for at in range(0, len(texts), 512):
            rows = [make(t if isinstance(t, str) else "", n)
                    for t, n in zip(texts.iloc[at:at + 512], chars.iloc[at:at + 512])]
            parts.append(shipped.value.scores(*_flat(rows)))
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return scored(col(text).cast("string"), col(n_chars).cast("double"))
