"""Quality classifier by co-training of two views.

One view sees a text's content (rates of symbols, capitals, repeats, lengths),
the other only its page metadata (source, language tag, stored length). Each
starts from the labelled rows of a bounded sample. In every round each view
scores all unlabelled documents, and all those that it is confident about
become pseudo-labelled rows for the other view, whose weights together are at
most half those of the labelled rows for either class. At the end both views are calibrated on labelled rows kept apart, and the sum
of their calibrated log-odds, weighted on those rows, scores all documents.

Fitting a view is Newton's method for logistic regression: the labelled rows,
bounded by a parameter, are on the driver, and of the pseudo-labelled rows
Spark sums the gradient and curvature, which are of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from vehicle_metrics.llm.common import add_columns
from vehicle_metrics.storage import materialize

BINS = 32  # hashed bins of a metadata value


@dataclass(frozen=True)
class CoTraining:
    sample: int = 20_000  # labelled rows, at most
    rounds: int = 3
    steps: int = 4  # Newton steps of a round
    pseudo_weight: float = 0.5  # of a pseudo-labelled row, at most, and of all of a class against the labelled rows
    confident: float = 0.95
    keep_score: float = 0.5


def content_view(text: str) -> list[float]:
    """Content features of one text, all zero without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * CONTENT
    chars = sum(map(len, words))
    letters = sum(map(str.isalpha, text)) or 1
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = sum(map(text.count, "#*$%&|<>"))
    triples = len(set(zip(words, words[1:], words[2:])))
    return [symbols / chars, text.count("|") / n, sum(map(str.isupper, text)) / letters,
            sum(map(str.isdigit, text)) / chars, (text.count("!") + text.count("?")) / n,
            (chars - letters) / chars, chars / n / 10, len(set(words)) / n, len(set(lines)) / len(lines),
            triples / max(1, n - 2), np.log1p(n), np.log1p(n / len(lines)),
            sum(1 for w in words if len(w) <= 3) / n, sum(1 for w in words if len(w) > 15) / n,
            sum(1 for x in lines if x.rstrip()[-1] in ".!?\"'") / len(lines), 1.0 if n < 50 else 0.0]


CONTENT = 16


def _binned(value: str | None, salt: str) -> int:
    return crc32(f"{salt}{value}".encode()) % BINS if value is not None else BINS


def metadata_view(source: str | None, lang: str | None, length: float | None) -> list[float]:
    """Metadata features: hashed source and language, log of the stored length."""
    row = [0.0] * METADATA
    row[_binned(source, "s")] = 1.0
    row[BINS + 1 + _binned(lang, "l")] = 1.0
    row[-1] = float(np.log1p(max(0.0, length or 0.0)))
    return row


METADATA = 2 * (BINS + 1) + 1


class View:
    """A logistic classifier of one view: its labelled rows, standardised,
    and its coefficients (last: intercept)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(0), x.std(0)
        self.scale[self.scale == 0] = 1.0
        self.z, self.y = self.standard(x), y
        self.beta = np.zeros(self.z.shape[1])
        self.penalty = np.diag(np.append(np.full(x.shape[1], ridge), 1e-6))

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])

    def step(self, gradient: np.ndarray | float = 0.0, curvature: np.ndarray | float = 0.0) -> float:
        """One Newton step on the labelled rows and the given sums over other
        ones; returns its greatest change."""
        g, c = newton_sums(self.z, self.y, self.beta)
        change = np.linalg.solve(c + curvature + self.penalty, g + gradient - self.penalty @ self.beta)
        self.beta = self.beta + change
        return float(np.abs(change).max())

    def fit(self, steps: int = 25) -> View:
        for _ in range(steps):
            if self.step() < 1e-6:
                break
        return self

    def raw(self) -> np.ndarray:
        """Coefficients for columns that are not standardised."""
        raw = self.beta[:-1] / self.scale
        return np.append(raw, self.beta[-1] - raw @ self.mean)


def newton_sums(z: np.ndarray, y: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
    return z.T @ (y - p), (z * (p * (1 - p))[:, None]).T @ z


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return View(x, y).fit().raw()


def exchange_sums(unlabelled: DataFrame, views: dict[str, View], teachers: dict[str, np.ndarray],
                  confident: float) -> dict[tuple[str, int], tuple[float, np.ndarray, np.ndarray]]:
    """(view, label) -> (rows, gradient, curvature) summed over every row that
    the other view labels so with confidence: the tasks send sums of a fixed
    size, whatever the number of rows."""
    spark = unlabelled.sparkSession
    shared = spark.sparkContext.broadcast((views, teachers))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learners, says = shared.value
        names = list(learners)
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = {v: batch.column(i).flatten().to_numpy().reshape(batch.num_rows, -1) for i, v in enumerate(names)}
            for k, v in enumerate(names):
                teacher = names[1 - k]
                linear = np.clip(x[teacher] @ says[teacher][:-1] + says[teacher][-1], -30, 30)
                sure = 1 / (1 + np.exp(-linear))
                for label, rows in ((1, sure >= confident), (0, sure <= 1 - confident)):
                    z = learners[v].standard(x[v][rows])
                    g, c = newton_sums(z, np.full(len(z), float(label)), learners[v].beta)
                    sums = np.concatenate([[len(z)], g, c.ravel()])
                    total[k, label] = total.get((k, label), 0.0) + sums
        for (k, label), sums in total.items():
            n = len(sums)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, 2 * k + label)), pa.array(np.arange(n)), pa.array(sums)],
                                             names=["part", "at", "value"])

    found = unlabelled.select(*views).mapInArrow(run, "part long, at long, value double").groupBy("part", "at").agg(
        F.sum("value").alias("value")).toPandas()
    shared.destroy()
    out = {}
    for k, (name, view) in enumerate(views.items()):
        d = len(view.beta)
        for label in (0, 1):
            sums = np.zeros(1 + d + d * d)
            own = found[found["part"] == 2 * k + label]
            sums[own["at"].to_numpy(int)] = own["value"]
            out[name, label] = sums[0], sums[1:d + 1], sums[d + 1:].reshape(d, d)
    return out


def _logit(view: str, beta: np.ndarray) -> Column:
    """The linear score of a feature array under bounded coefficients."""
    coefficients = F.array(*[F.lit(float(b)) for b in beta[:-1]])
    products = F.zip_with(view, coefficients, lambda a, b: a * b)
    return F.aggregate(products, F.lit(float(beta[-1])), lambda s, v: s + v)


def _sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit))))


def add_views(docs: DataFrame) -> DataFrame:
    """``docs`` (id, body, source, lang, length) as (id, content, metadata)."""
    def compute():
        def run(texts: list[bytes]) -> list[pa.Array]:
            return [pa.array([content_view(t.decode("utf-8", "replace")) for t in texts], pa.list_(pa.float64()))]

        return run

    features = add_columns(docs, "body", StructType([StructField("content", ArrayType(DoubleType()))]), compute)
    bins = lambda c, salt: F.coalesce(  # noqa: E731 - the same bins as metadata_view
        F.crc32(F.concat(F.lit(salt), F.col(c)).cast("binary")) % BINS, F.lit(BINS))
    hot = lambda at, n: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == at).cast("double"))
    metadata = F.concat(hot(bins("source", "s"), BINS + 1), hot(bins("lang", "l"), BINS + 1),
                        F.array(F.log1p(F.greatest(F.lit(0.0), F.coalesce("length", F.lit(0.0))))))
    return features.select("id", "content", metadata.alias("metadata"))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", length_col: str = "n_chars", label_id: str = "doc_id", label_col: str = "quality",
          settings: CoTraining = CoTraining()) -> DataFrame:
    """(id, content_score, metadata_score, score, kept) for every row; scores
    are probabilities of good quality, ``kept`` is score >= keep_score.

    NULL metadata has a bin of its own; NULL and empty texts have zero content
    features. An id with several labels is good only if all say so. With fewer
    than twenty labelled rows of either kind nothing is fitted: all scores are
    the share of good labels (1 without labels). Repeated rows each get a row;
    other columns are not carried.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"),
                       F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(length_col).cast("double").alias("length"))
    views = materialize(add_views(rows), "quality_views")
    known = (labels.where(F.col(label_id).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(label_id).alias("label_id")).agg(F.min(label_col).cast("double").alias("y")))
    known = materialize(known, "quality_labels")
    picked = known.orderBy(F.xxhash64("label_id"), "label_id").limit(settings.sample)
    order = F.xxhash64("id", F.lit(3))
    found = (views.join(F.broadcast(picked), F.col("id") == F.col("label_id")).select("id", "content", "metadata", "y")
             .orderBy(order, "id").limit(settings.sample).toPandas())
    y = found["y"].to_numpy(float)
    if min((y == 0).sum(), (y == 1).sum()) < 20:
        share = F.lit(float(y.mean()) if len(y) else 1.0)
        return views.select(F.col("id").alias(id_col), share.alias("content_score"), share.alias("metadata_score"),
                            share.alias("score"), (share >= settings.keep_score).alias("kept"))

    x = {v: np.stack(found[v].to_numpy()).astype(float) for v in ("content", "metadata")}
    apart = np.arange(len(y)) % 4 == 3  # for calibration, in hash order
    learners = {v: View(x[v][~apart], y[~apart]).fit() for v in x}
    unlabelled = materialize(views.join(known.select("label_id"), F.col("id") == F.col("label_id"), "left_anti").select(*x),
                             "quality_unlabelled")
    for _ in range(settings.rounds):
        teachers = {v: view.raw() for v, view in learners.items()}
        for _ in range(settings.steps):
            sums = exchange_sums(unlabelled, learners, teachers, settings.confident)
            moved = 0.0
            for v, view in learners.items():
                weights = {label: min(settings.pseudo_weight, settings.pseudo_weight * len(view.y) / max(1.0, sums[v, label][0]))
                           for label in (0, 1)}
                moved = max(moved, view.step(sum(weights[k] * sums[v, k][1] for k in weights),
                                             sum(weights[k] * sums[v, k][2] for k in weights)))
            if moved < 1e-3:
                break
    beta = {v: view.raw() for v, view in learners.items()}
    linear = {v: x[v][apart] @ beta[v][:-1] + beta[v][-1] for v in x}
    platt = {v: fit_logistic(linear[v][:, None], y[apart]) for v in x}
    calibrated = np.column_stack([platt[v][0] * linear[v] + platt[v][1] for v in x])
    joint = fit_logistic(calibrated, y[apart])
    logits = {v: F.lit(float(platt[v][0])) * _logit(v, beta[v]) + F.lit(float(platt[v][1])) for v in x}
    total = sum((F.lit(float(joint[i])) * F.col(f"l_{v}") for i, v in enumerate(x)), F.lit(float(joint[-1])))
    scored = views.select("id", *[logits[v].alias(f"l_{v}") for v in x]).withColumn("score", _sigmoid(total))
    return scored.select(F.col("id").alias(id_col), *[_sigmoid(F.col(f"l_{v}")).alias(f"{v}_score") for v in x], "score",
                         (F.col("score") >= settings.keep_score).alias("kept"))
