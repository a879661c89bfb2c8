"""Hard negatives by segment summary filtering.

Scores are inner products of integer vectors. A vector is cut into segments,
and of each segment its mean and its deviation (root of the mean square
distance from the mean) are stored. For segments of n components

    x . y  =  n mean_x mean_y + sum (x - mean_x)(y - mean_y),

and the sum is at most n dev_x dev_y either way (Cauchy-Schwarz), so the means'
product plus or minus the deviations' product, added over segments, bounds a
score. Bounds of 1, 4 and 16 segments are stored: a pair of anchor and row goes
on to the next finer ones, and to its exact score, only while its bounds do not
rule it out.

Anchors are worked on in blocks of bounded size, each sent to every task and
held against all rows, where the rows lie: only the best few of each task move.
A first pass finds each anchor's positives, a second one its negatives, whose
bands of scores follow from the positives.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vehicle_metrics.storage import materialize

LEVELS = (1, 4, 16)  # segments of a vector, each level cuts the one before
ANCHOR_BLOCK = 2_000  # anchors held against all rows at a time, on average
ROW_BLOCK = 1_024  # rows that a task scores at a time
PER_ANCHOR, PER_POSITIVE = 5, 5
LOW, HIGH = 80, 100  # a negative's score in hundredths of the positive's
SCALE = 256
EXACT = 1 << 53  # up to here a sum of doubles that are integers is exact


def summaries(vectors: np.ndarray) -> list[np.ndarray]:
    """For each level, (rows, 2 g): the means and then the deviations of the g
    segments, both times the root of the segment's length, so that bounds are
    inner products. Short vectors have fewer segments."""
    n, dim = vectors.shape
    out = []
    for g in LEVELS:
        edges = np.unique(np.linspace(0, dim, g + 1).astype(int))
        means, devs = [], []
        for a, b in zip(edges, edges[1:]):
            part = vectors[:, a:b].astype(np.float64)
            mean = part.mean(1)
            means.append(mean * np.sqrt(b - a))
            devs.append(np.sqrt(((part - mean[:, None]) ** 2).sum(1)))
        out.append(np.stack([*means, *devs], 1) if means else np.zeros((n, 0)))
    return out


def bounds(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores between rows of x and of y, one
    level's summaries each, widened by what rounding can take away."""
    g = x.shape[1] // 2
    middle, spread = x[:, :g] @ y[:, :g].T, x[:, g:] @ y[:, g:].T
    slack = 1 + 1e-9 * (np.abs(middle) + spread)
    return middle - spread - slack, middle + spread + slack


def exact_scores(x: np.ndarray, y: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """x[rows] . y[cols] as integers."""
    out = np.empty(len(rows), np.int64)
    for a in range(0, len(rows), 1 << 16):
        i, j = rows[a:a + (1 << 16)], cols[a:a + (1 << 16)]
        out[a:a + (1 << 16)] = np.einsum("ij,ij->i", x[i], y[j])
    return out


def _all_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All scores; in floating point where that is exact."""
    top = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * x.shape[1]
    if top < EXACT:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return x @ y.T


class Best:
    """For each of n lists, its best few (score, id, row), highest score first,
    then smallest id and row."""

    def __init__(self, n: int, keep: int):
        self.keep, self.n = keep, n
        self.list = np.zeros(0, np.int64)
        self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(n, np.iinfo(np.int64).min)  # a list that is full takes no score below this

    def add(self, which: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        which, score, ids, rows = (np.concatenate(p) for p in zip((self.list, self.score, self.id, self.row),
                                                                  (which, score, ids, rows)))
        order = np.lexsort((rows, ids, -score, which))
        which = which[order]
        start = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]])) if len(which) else np.zeros(0, int)
        place = np.arange(len(which)) - np.repeat(start, np.diff(np.append(start, len(which))))
        kept = order[place < self.keep]
        self.list, self.score, self.id, self.row = which[place < self.keep], score[kept], ids[kept], rows[kept]
        last = place == self.keep - 1
        self.least[which[last]] = score[order[last]]


def vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, id, label, vector, level0, ...): the rows that take part, with
    integer components floor(256 x) and the summaries of each level. Vectors
    shorter than the longest one count as continued by zeros."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                             F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL AND NOT exists(x, c -> c IS NULL OR isnan(c) "
                      "OR abs(c) = double('inf'))")
    dim = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0)).alias("d")).first().d
    rows = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "label", "x")
    lists = pa.list_(pa.float64())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(a, ROW_BLOCK)
                x = np.zeros((part.num_rows, dim), np.float64)
                sizes = part.column(3).value_lengths().to_numpy()
                values = part.column(3).flatten().to_numpy()
                x[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
                q = np.floor(SCALE * x).astype(np.int64)
                flat = lambda m, t: pa.ListArray.from_arrays(
                    pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel(), t))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], flat(q, pa.int64()), *(flat(s, lists.value_type) for s in summaries(q))],
                    names=["row", "id", "label", "vector", *(f"level{i}" for i in range(len(LEVELS)))])

    levels = ", ".join(f"level{i} array<double>" for i in range(len(LEVELS)))
    return rows.mapInArrow(run, f"row long, id long, label long, vector array<long>, {levels}")


def _unpack(table) -> dict:
    """Columns row, id and label as arrays, vector and levels as matrices."""
    def matrix(c):
        values = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).flatten().to_numpy(zero_copy_only=False)
        return values.reshape(len(c), len(values) // max(1, len(c)))

    def get(c):
        return table.column(table.schema.get_field_index(c))

    out = {c: get(c).to_numpy() for c in ("row", "id", "label")}
    out["vector"] = matrix(get("vector"))
    out["levels"] = [matrix(get(f"level{i}")) for i in range(len(LEVELS))]
    return out


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROW_BLOCK):
            yield _unpack(batch.slice(a, ROW_BLOCK))


def _refine(anchors: dict, rows: dict, open_pairs: np.ndarray, ruled_out) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs that no level's bounds rule out.

    ``open_pairs`` is a matrix of anchors by rows; ``ruled_out(low, high, a)``
    says which pairs cannot count, given bounds and the pairs' anchors."""
    low, high = bounds(anchors["levels"][0], rows["levels"][0])
    every = np.arange(len(open_pairs))[:, None]
    open_pairs &= ~ruled_out(low, high, every)
    for level in range(1, len(LEVELS)):
        a, r = np.nonzero(open_pairs)
        if len(a) * 8 > open_pairs.size:  # dense: as one matrix product
            low, high = bounds(anchors["levels"][level], rows["levels"][level])
            open_pairs &= ~ruled_out(low, high, every)
            continue
        for at in range(0, len(a), 1 << 16):
            i, j = a[at:at + (1 << 16)], r[at:at + (1 << 16)]
            x, y = anchors["levels"][level][i], rows["levels"][level][j]
            g = x.shape[1] // 2
            middle, spread = (x[:, :g] * y[:, :g]).sum(1), (x[:, g:] * y[:, g:]).sum(1)
            slack = 1 + 1e-9 * (np.abs(middle) + spread)
            out = ruled_out(middle - spread - slack, middle + spread + slack, i)
            open_pairs[i[out], j[out]] = False
    a, r = np.nonzero(open_pairs)
    if len(a) * 8 > open_pairs.size:
        return a, r, _all_scores(anchors["vector"], rows["vector"])[a, r]
    return a, r, exact_scores(anchors["vector"], rows["vector"], a, r)


def _positives(rows: DataFrame, block, keep: int) -> DataFrame:
    """(anchor, positive_row, positive_id, score): each task's best rows of the
    anchor's label; ``anchor`` is the anchor's row number."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        best = Best(len(anchors["row"]), keep)
        for part in _blocks(batches):
            same = anchors["label"][:, None] == part["label"][None, :]
            same &= anchors["row"][:, None] != part["row"][None, :]
            a, r, score = _refine(anchors, part, same, lambda low, high, a: high < best.least[a])
            best.add(a, score, part["id"][r], part["row"][r])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchors["row"][best.list], best.row, best.id, best.score)],
                                         names=["anchor", "positive_row", "positive_id", "score"])

    return rows.mapInArrow(run, "anchor long, positive_row long, positive_id long, score long")


def _negatives(rows: DataFrame, block, keep: int) -> DataFrame:
    """(anchor, positive_score, negative_row, negative_id, score): each task's
    best rows of another label, for each of the anchor's positive scores."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, bands = block.value  # bands: a positive score, or -1, in each of a few columns
        n, k = bands.shape
        best = Best(n * k, keep)
        # 80 p <= 100 s <= 100 p
        floor, top = -(-LOW * bands // 100), HIGH * bands // 100
        floor = np.where(bands < 0, np.iinfo(np.int64).max, floor)

        def ruled_out(low, high, a):
            out = True
            least = best.least.reshape(n, k)
            for c in range(k):
                out &= (high < np.maximum(floor[a, c], least[a, c])) | (low > top[a, c])
            return out

        for part in _blocks(batches):
            other = anchors["label"][:, None] != part["label"][None, :]
            a, r, score = _refine(anchors, part, other, ruled_out)
            for c in range(k):
                ok = np.flatnonzero((score >= floor[a, c]) & (score <= top[a, c]))
                best.add(a[ok] * k + c, score[ok], part["id"][r[ok]], part["row"][r[ok]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (anchors["row"][best.list // k], bands.ravel()[best.list], best.row, best.id, best.score)],
            names=["anchor", "positive_score", "negative_row", "negative_id", "score"])

    return rows.mapInArrow(run, "anchor long, positive_score long, negative_row long, negative_id long, score long")


def _first(found: DataFrame, keys: list[str], id_col: str, row_col: str, keep: int) -> DataFrame:
    """The best ``keep`` rows of each key with their rank: each task has sent
    at most that many."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), id_col, row_col)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(rows: DataFrame, is_anchor: str, per_anchor: int = PER_ANCHOR, per_positive: int = PER_POSITIVE,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for ``rows`` as ``vectors`` gives them and the anchors
    among them, those with the condition ``is_anchor`` on id.

    A positive is one of the anchor's best ``per_anchor`` other rows of its
    label, a negative one of the best ``per_positive`` rows of another label
    with 80 to 100 hundredths of the positive's score. Ties go to the smaller
    id, and among rows of one id to the one read first; repeated rows are rows
    of their own. Scores must fit 64 bits.
    """
    spark = rows.sparkSession
    anchors = rows.where(is_anchor)
    n_blocks = -(-anchors.count() // anchor_block)
    anchors = materialize(anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, n_blocks)))), "negatives_anchors")
    results = []
    for b in range(n_blocks):
        block = _unpack(anchors.where(F.col("block") == b).drop("block").toArrow())
        held = spark.sparkContext.broadcast(block)
        found = _first(_positives(rows, held, per_anchor), ["anchor"], "positive_id", "positive_row", per_anchor)
        positives = materialize(found.select("anchor", "positive_row", "positive_id", F.col("score").alias("positive_score")),
                                "negatives_positives")
        held.destroy()
        # At most per_anchor scores for each anchor of the block.
        bands = np.full((len(block["row"]), per_anchor), -1, np.int64)
        place = {row: i for i, row in enumerate(block["row"].tolist())}
        filled = [0] * len(place)
        for anchor, score in zip(*(c.to_pylist() for c in positives.select("anchor", "positive_score").where(
                "positive_score >= 0").distinct().toArrow().columns)):
            i = place[anchor]
            bands[i, filled[i]] = score
            filled[i] += 1
        held = spark.sparkContext.broadcast((block, bands))
        best = _first(_negatives(rows, held, per_positive), ["anchor", "positive_score"], "negative_id", "negative_row", per_positive)
        ids = anchors.where(F.col("block") == b).select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
        results.append(materialize(
            positives.join(best, ["anchor", "positive_score"]).join(ids, "anchor").select(
                "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                F.col("score").alias("negative_score")), "negatives_found"))
        held.destroy()
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                                         "negative_score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def hard_negatives(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   relabel: int = 7, labels: int = 10, anchor_every: int = 100) -> DataFrame:
    """``mine`` over ``embeddings``, the anchors being the rows whose id is
    divisible by ``anchor_every``; where the id is divisible by ``relabel``,
    the label first becomes the next one modulo ``labels``.

    Rows with a NULL id, label, vector or component, or one that is not
    finite, take no part. Empty vectors score zero. An empty table, or one
    without anchors, gives an empty result; other columns are not carried."""
    ident, label = F.col(id_col), F.col(label_col).cast("long")
    changed = F.when(ident % relabel == 0, (label + 1) % labels).otherwise(label)
    rows = embeddings.select(ident.alias("id"), F.col(vector_col).alias("x"), changed.alias("label"))
    return mine(materialize(vectors(rows, "id", "x", "label"), "negatives_vectors"), f"id % {anchor_every} = 0")
