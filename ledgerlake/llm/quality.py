"""Quality classifier: a factorisation machine.

Features of a document are its hashed words, structure statistics of its text
and its metadata (the stored length), the latter two cut into bins. All pairs
of features interact through low-rank factors; the sum over pairs is computed
in linear time as half of the square of the factors' sum less the sum of their
squares.

The model is fitted on a bounded sample of labelled rows (`max_train`, the
lowest by a hash of the id), outside the held-out fold. Labels, language,
source and id never enter a score. Every document is scored on its whole text.

Defined results: NULL and empty texts are scored by their structure bins; a
missing length has a bin of its own; several labels of one id count by their
majority, 0 on a tie; rows without labels are scored like all others; with
labels of one kind only, or none, the score is the smoothed share of label 1;
repeated rows get equal scores; input columns named like a result column are
replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import held_out, kept_fields, named, table, with_columns

FOLDS = 5
MAX_TRAIN = 20_000
THRESHOLD = 0.3
WORD_BITS = 16
RANK = 8
BINS = 12
EPOCHS = 6
BATCH = 256
STEP = 0.1
DECAY = 1e-5
STATS = ("bytes", "words", "word_length", "distinct_words", "top_word", "upper", "digits", "symbols", "other_bytes",
         "repeated_lines", "line_words", "sentence_ends", "symbol_runs", "stored_length")


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # one weight per feature
    factors: np.ndarray  # feature x rank
    edges: np.ndarray  # statistic x (BINS - 1)


def _byte_classes() -> np.ndarray:
    """0 space, 1 lower case, 2 upper case, 3 digit, 4 sentence end, 5 other ASCII, 6 part of a longer character."""
    kinds = np.full(256, 5, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = 0
    kinds[ord("a"):ord("z") + 1] = 1
    kinds[ord("A"):ord("Z") + 1] = 2
    kinds[ord("0"):ord("9") + 1] = 3
    kinds[[ord(c) for c in ".,?;:"]] = 4
    kinds[128:] = 6
    return kinds


class Features:
    """Word indices and statistics of texts. Word hashes are remembered up to a bound."""

    REMEMBERED = 1 << 18

    def __init__(self) -> None:
        self.kinds = _byte_classes()
        self.seen: dict[bytes, int] = {}

    def of(self, text: str | None, stored_length: int | None) -> tuple[np.ndarray, list[float]]:
        import zlib
        from collections import Counter
        text = text or ""
        data = text.encode("utf-8", "surrogatepass")
        words = data.lower().split()
        counts = Counter(words)
        seen = self.seen
        if len(seen) > self.REMEMBERED:
            seen.clear()
        index = set()
        for w in counts:
            i = seen.get(w)
            if i is None:
                i = seen[w] = zlib.crc32(w) & ((1 << WORD_BITS) - 1)
            index.add(i)
        kinds = self.kinds[np.frombuffer(data, np.uint8)]
        by = np.bincount(kinds, minlength=7).tolist()
        runs = int(np.count_nonzero((kinds[1:] == 5) & (kinds[:-1] == 5))) if len(kinds) > 1 else 0
        n, letters = max(1, len(data)), max(1, by[1] + by[2])
        lines = [x for x in text.split("\n") if x.strip()]
        n_words = len(words)
        most = max(counts.values()) if counts else 0
        stats = [np.log1p(len(data)), np.log1p(n_words), (len(data) - by[0]) / max(1, n_words),
                 # distinct words fall with length in any text: compared with its root
                 len(counts) / max(1, n_words), most / max(1, n_words), by[2] / letters, by[3] / n, by[5] / n, by[6] / n,
                 1 - len(set(lines)) / len(lines) if lines else 0.0, np.log1p(n_words / max(1, len(lines))),
                 by[4] / max(1, n_words), runs / n, -1.0 if stored_length is None else np.log1p(max(0, stored_length))]
        return np.fromiter(sorted(index), np.int32, len(index)), stats


def _bins(stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Feature index of each row's bin of each statistic, after the word features."""
    out = np.empty(stats.shape, np.int64)
    for j in range(stats.shape[1]):
        out[:, j] = np.searchsorted(edges[j], stats[:, j], side="right") + (1 << WORD_BITS) + j * BINS
    return out


def _rows(words: list[np.ndarray], bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indices, values, row starts): words share a length of one, each bin counts one over the root of their number."""
    idx, val, starts, at = [], [], [], 0
    unit = 1.0 / np.sqrt(bins.shape[1])
    for w, b in zip(words, bins):
        starts.append(at)
        idx += [w, b]
        val += [np.full(len(w), 1.0 / np.sqrt(max(1, len(w))), np.float32), np.full(len(b), unit, np.float32)]
        at += len(w) + len(b)
    return np.concatenate(idx), np.concatenate(val), np.array(starts)


def _margin(m: Model, idx: np.ndarray, val: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(margin, factor sums, x*v): bias + linear + half of (sum of x v)^2 - sum of (x v)^2."""
    xv = m.factors[idx] * val[:, None]
    sums = np.add.reduceat(xv, starts, axis=0)
    squares = np.add.reduceat(np.einsum("ij,ij->i", xv, xv), starts)
    linear = np.add.reduceat(m.linear[idx] * val, starts)
    return m.bias + linear + 0.5 * (np.einsum("ij,ij->i", sums, sums) - squares), sums, xv


def fit(words: list[np.ndarray], stats: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """AdaGrad on the logistic loss in mini-batches."""
    size = (1 << WORD_BITS) + len(STATS) * BINS
    rng = np.random.RandomState(seed)
    edges = np.array([np.quantile(stats[:, j], np.arange(1, BINS) / BINS) for j in range(stats.shape[1])]) \
        if len(stats) else np.zeros((len(STATS), BINS - 1))
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    m = Model(float(np.log(share / (1 - share))), np.zeros(size, np.float32),
              np.zeros((size, RANK), np.float32), edges)
    if len(set(labels.tolist())) < 2:
        return m
    m.factors[:] = rng.normal(0, 0.05, m.factors.shape)
    bins = _bins(stats, edges)
    g_bias, g_lin, g_fac = 1e-6, np.full(size, 1e-6, np.float32), np.full((size, RANK), 1e-6, np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), BATCH):
            part = order[lo:lo + BATCH]
            idx, val, starts = _rows([words[i] for i in part], bins[part])
            z, sums, xv = _margin(m, idx, val, starts)
            err = (1 / (1 + np.exp(-z)) - labels[part]) / len(part)
            lengths = np.diff(np.append(starts, len(idx)))
            e = np.repeat(err, lengths) * val
            lin = np.bincount(idx, e, size) + DECAY * m.linear
            fac = np.column_stack([np.bincount(idx, e * (np.repeat(sums[:, f], lengths) - xv[:, f]), size)
                                   for f in range(RANK)]) + DECAY * m.factors
            g_bias += float(err.sum()) ** 2
            g_lin += lin ** 2
            g_fac += fac ** 2
            m.bias -= STEP * float(err.sum()) / np.sqrt(g_bias)
            m.linear -= (STEP * lin / np.sqrt(g_lin)).astype(np.float32)
            m.factors -= (STEP * fac / np.sqrt(g_fac)).astype(np.float32)
    return m


def featurised(docs: DataFrame) -> DataFrame:
    """(doc_id, label, words, stats) of labelled documents, both packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            made = [features.of(t, n) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([w.tobytes() for w, _ in made], pa.binary()),
                 pa.array([np.array(s).tobytes() for _, s in made], pa.binary())], names=["doc_id", "label", "words", "stats"])

    return docs.select("doc_id", "label", "text", "n_chars").mapInArrow(run, "doc_id long, label int, words binary, stats binary")


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most `max_train` labelled documents outside the held-out fold."""
    votes = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.avg("quality").alias("share"))
    one = votes.select("doc_id", (F.col("share") > 0.5).cast("int").alias("label")).where(~held_out(F.col("doc_id"), folds))
    order = F.xxhash64("doc_id")
    have = one.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    # about `max_train` rows by a hash of the id, so that no partition hands on more than its share of the bound
    cut = (max_train << 20) // max(have.count(), max_train)
    sample = have.where(F.pmod(order, F.lit(1 << 20)) < cut).orderBy(order, "doc_id").limit(max_train)
    length = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    rows = featurised(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", length.alias("n_chars"))
                      .join(F.broadcast(sample), "doc_id"))
    got = rows.orderBy(order, "doc_id", "words").limit(max_train).collect()  # bounded by `max_train`
    words = [np.frombuffer(r["words"], np.int32) for r in got]
    stats = np.array([np.frombuffer(r["stats"]) for r in got]).reshape(len(got), len(STATS))
    return fit(words, stats, np.array([r["label"] for r in got], np.float64))


def score(docs: DataFrame, model: Model, score_col: str = "score") -> DataFrame:
    """The documents with their probability of label 1."""
    kept = kept_fields(docs, score_col)
    schema = T.StructType([*kept, T.StructField(score_col, T.DoubleType())])
    has_length = any(f.name == "n_chars" for f in kept)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by WORD_BITS and RANK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, features = shared.value, Features()
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                texts = batch.column("text").to_pylist()
                lengths = batch.column("n_chars").to_pylist() if has_length else [None] * len(texts)
                made = [features.of(t, n) for t, n in zip(texts, lengths)]
                idx, val, starts = _rows([w for w, _ in made], _bins(np.array([s for _, s in made]), m.edges))
                z = _margin(m, idx, val, starts)[0]
                yield with_columns(batch, {score_col: pa.array(1 / (1 + np.exp(-z.astype(np.float64))), pa.float64())})

    return docs.select(*named(kept)).mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents the classifier does not reject, with their own columns."""
    mark = "_quality_score"
    return score(docs, train(docs, labels), mark).where(F.col(mark) >= threshold).select(*named(docs.schema.fields))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored for quality by a model fitted outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
