"""Quality classifier: document statistics, random Fourier features, ridge scores, isotonic calibration.

The features approximate a Gaussian kernel over standardised statistics of the whole text. Each task sums its share
of the normal equations; Spark adds up the sums, cell by cell, and the driver solves one system of FEATURES + 1
unknowns. Calibration pools neighbouring score bins until they rise; their number is fixed too. So what the driver
sees does not grow with the labelled rows, and all of them are learnt from.

Null and empty texts have statistics of 0 and are scored like any other. Repeated documents or labels count as often
as they are there; labels without a quality or without a document are left out. Without any label every score is
0.5. Labels, lang, source and doc_id are no inputs of a score; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitry.llm.quality_rules import measures
from visitry.llm.text import stored

FEATURES = 128
SEED = 7
RIDGE = 1e-3
#: Standardised statistics beyond this count as this.
FAR = 5.0
#: Raw scores from LOW to HIGH are calibrated in this many bins.
BINS, LOW, HIGH = 1024, -0.5, 1.5


def statistics() -> Column:
    """Shares and sizes of a text as an array of doubles, from its measures."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return F.array(
        F.log1p(F.col("n_words")),
        share("word_chars", "n_words"),
        F.sqrt(share("n_symbols", "n_words")),
        F.sqrt(share("n_marked", "n_words")),
        F.sqrt(share("n_dup_lines", "n_lines")),
        F.sqrt(share("n_repeat_words", "n_words")),
        F.sqrt(share("n_upper", "word_chars")),
        F.sqrt(share("n_shouts", "n_words")),
        share("n_distinct", "n_words"),
        share("n_function", "n_words"),
    )


N_STATISTICS = 10


class Model:
    """mean, scale: of the statistics; weights: ridge; bounds, values: calibration. None of it without labels."""

    def __init__(self, mean=None, scale=None, weights=None, bounds=None, values=None):
        self.mean, self.scale, self.weights, self.bounds, self.values = mean, scale, weights, bounds, values

    def features(self, x: np.ndarray) -> np.ndarray:
        """cos(wx + b) for fixed random w and b, and a constant."""
        draw = np.random.default_rng(SEED)
        w = draw.normal(0, 1 / np.sqrt(N_STATISTICS), (N_STATISTICS, FEATURES))
        b = draw.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -FAR, FAR)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.interp(self.raw(x), self.bounds, self.values)


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)


def rising(n: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The rising sequence closest to `mean`, weighted by n: neighbours that fall are pooled."""
    pools: list[list[float]] = []
    for count, value in zip(n, mean, strict=True):
        pools.append([count, value, 1])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            b, a = pools.pop(), pools.pop()
            pools.append([a[0] + b[0], (a[0] * a[1] + b[0] * b[1]) / (a[0] + b[0]), a[2] + b[2]])
    return np.repeat([p[1] for p in pools], [p[2] for p in pools])


def fit(labelled: DataFrame) -> Model:
    """A model from columns x (statistics) and y (0 or 1)."""
    labelled = stored(labelled.select("x", F.col("y").cast("double").alias("y")), "labelled")
    each = [F.col("x")[i] for i in range(N_STATISTICS)]
    row = labelled.agg(F.count(F.lit(1)).alias("n"), *(f(c) for f in (F.mean, F.stddev_pop) for c in each)).first()
    if not row["n"]:
        return Model()
    scale = np.array(row[1 + N_STATISTICS :], dtype=float)
    model = Model(np.array(row[1 : 1 + N_STATISTICS], dtype=float), np.where(scale > 1e-9, scale, 1.0))
    size = FEATURES + 1

    def sums(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.features(_matrix(batch, "x"))
            total += z.T @ np.hstack([z, batch.column("y").to_numpy()[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["cell", "part"])

    cells = labelled.mapInArrow(sums, "cell int, part double").groupBy("cell").agg(F.sum("part").alias("total"))
    total = np.zeros(size * (size + 1))
    for cell in cells.collect():  # FEATURES squared, whatever the rows
        total[cell["cell"]] = cell["total"]
    total = total.reshape(size, size + 1)
    model.weights = np.linalg.solve(total[:, :size] + RIDGE * row["n"] / size * np.eye(size), total[:, size])

    def binned(batches):
        for batch in batches:
            place = (model.raw(_matrix(batch, "x")) - LOW) / (HIGH - LOW) * BINS
            yield pa.RecordBatch.from_arrays([pa.array(np.clip(place, 0, BINS - 1).astype(np.int32)), batch.column("y")], names=["bin", "y"])

    bins = labelled.mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.mean("y").alias("y"))
    bins = sorted(bins.collect())  # at most BINS
    model.bounds = LOW + (np.array([b["bin"] for b in bins]) + 0.5) * (HIGH - LOW) / BINS
    model.values = rising(np.array([b["n"] for b in bins], dtype=float), np.array([b["y"] for b in bins]))
    return model


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def fit_on_labels(seen: DataFrame, labels: DataFrame) -> Model:
    """seen: doc_id, x. Labels of held-out documents are not looked at."""
    known = labels.where("quality IS NOT NULL").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("y"))
    return fit(seen.join(known, "doc_id").select("x", "y"))


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from a score of 0.5) of every row."""
    seen = stored(measures(docs).select("doc_id", statistics().alias("x")), "statistics")
    model = fit_on_labels(seen, labels)

    def scored(batches):
        for batch in batches:
            score = model.score(_matrix(batch, "x"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    out = seen.mapInArrow(scored, "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not rejected (score of 0.5 or more), with all their columns.

    Rows are measured a second time, with their columns beside, instead of being joined with their scores: whole
    texts are never shuffled.
    """
    model = fit_on_labels(stored(measures(docs).select("doc_id", statistics().alias("x")), "statistics"), labels)
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), "text")
    seen = measures(whole, "__row").select(*(F.col("__row").getField(c).alias(f"c{i}") for i, c in enumerate(docs.columns)), statistics().alias("x"))

    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.score(_matrix(batch, "x")) >= 0.5))

    good = seen.mapInArrow(kept, seen.schema)
    return good.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
