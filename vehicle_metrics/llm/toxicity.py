"""Toxicity scores: gradient-boosted trees over dense features, with isotonic
calibration.

The features of a text are rates: lexicon densities (a fixed list of insults
and a list learned from labelled texts), how much of the lexicon stands near a
second-person pronoun, capitals, punctuation and obfuscation (letters mixed
with digits or symbols inside a word, or spelled out one by one). The learned
lexicon and the trees are fitted on a bounded sample of labelled rows; every
text is then scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from vehicle_metrics.llm.common import add_columns, in_split, may_train, text_blocks
from vehicle_metrics.storage import materialize

SAMPLE = 20_000  # labelled rows that the lexicon, the trees and the calibration are fitted on
LEXICON = 300  # words of the learned lexicon
CUT = 0.3

# A seed list of insults and second-person pronouns.
INSULTS = frozenset("idiot idiots moron morons stupid trash worthless pathetic disgusting clown loser losers dumb fool "
                    "garbage scum ugly hate".split())
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi vous votre vos du dich dir dein deine ihr euch tú ti "
                          "usted ustedes vosotros".split())
LEET = str.maketrans("013457@$!€", "oieastasie")
TRIM = re.compile(r"^[^\w@$*]+|[^\w@$*]+$")
MIXED = re.compile(r"[^\W\d_][\d@$*!#%]+[^\W\d_]")
NEAR = 5  # words to each side


def plain_word(word: str) -> str:
    return TRIM.sub("", word.lower())


def features(text: str, learned: frozenset[str]) -> list[float]:
    """The dense features of one text; all zero for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    low = [plain_word(w) for w in words]
    mixed = [i for i, w in enumerate(words) if MIXED.search(w)]
    clean = {i: low[i].translate(LEET).replace("*", "") for i in mixed}
    seed = [i for i, w in enumerate(low) if w in INSULTS or clean.get(i) in INSULTS]
    own = [i for i, w in enumerate(low) if w in learned or clean.get(i) in learned]
    hits = sorted({*seed, *own})
    second = [i for i, w in enumerate(low) if w in SECOND_PERSON]
    near, at = 0, 0
    for i in hits:
        while at < len(second) and second[at] < i - NEAR:
            at += 1
        near += at < len(second) and second[at] <= i + NEAR
    singles = sum(1 for a, b, c in zip(low, low[1:], low[2:]) if len(a) == len(b) == len(c) == 1)
    letters = sum(map(str.isalpha, text)) or 1
    capitals = sum(map(str.isupper, text))
    shouted = sum(1 for w in words if len(w) > 2 and w.isupper())
    marks = text.count("!") + text.count("?")
    return [len(seed) / n, len(own) / n, float(len(hits)), float(len({low[i] for i in hits})), near / n,
            len(second) / n, capitals / letters, shouted / n, marks / n,
            (text.count("!!") + text.count("??")) / n, len(mixed) / n, singles / n, float(min(n, 2000)),
            float(max(hits, default=-1) - min(hits, default=-1)) / n]


FEATURES = ("seed_density", "learned_density", "lexicon_hits", "lexicon_distinct", "near_second_person", "second_person",
            "capitals", "shouted", "marks", "repeated_marks", "mixed", "spelled", "words", "hit_span")


def labelled_sample(labels: DataFrame, sample: int = SAMPLE, label_id: str = "doc_id",
                    label_col: str = "toxic") -> DataFrame:
    """(label_id, y): at most ``sample`` labelled ids that may be learned
    from, by hash of the id; an id with several labels counts as toxic if any
    says so. The result is small by its limit."""
    rows = (labels.where(F.col(label_col).isNotNull() & may_train(label_id, 4, 2))
            .groupBy(F.col(label_id).alias("label_id")).agg(F.max(label_col).cast("double").alias("y")))
    return rows.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)


def training_rows(rows: DataFrame, picked: DataFrame) -> DataFrame:
    """(id, body, y) for the labelled ids of ``picked``, one row for each id,
    so that repeated ids cannot exceed the sample: of several texts with one id
    the one with the least hash is learned from."""
    found = rows.join(F.broadcast(picked), F.col("id") == F.col("label_id")).select(
        "id", "body", "y", F.monotonically_increasing_id().alias("row"))
    found = materialize(found, "toxic_found")
    one = found.groupBy("id").agg(F.min(F.struct(F.xxhash64("body").alias("h"), F.col("row"))).alias("one"))
    keep = F.broadcast(one.select(F.col("one.row").alias("row")))  # at most one number for each picked id
    return materialize(found.join(keep, "row", "left_semi").select("id", "body", "y"), "toxic_train")


def learn_lexicon(train: DataFrame, size: int = LEXICON) -> frozenset[str]:
    """Words that stand in at least three toxic texts and one in a hundred of
    them, and there at least four times as often as in the others; the ``size``
    with the largest G statistic. ``train`` has columns body and y."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, all_texts = Counter(), Counter()

        def out() -> pa.RecordBatch:
            words = list(all_texts)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([bad[w] for w in words], pa.int64()),
                 pa.array([all_texts[w] for w in words], pa.int64())], names=["word", "bad", "n"])
            bad.clear()
            all_texts.clear()
            return batch

        for part, texts in text_blocks(batches, "body"):
            for y, text in zip(part.column(part.schema.get_field_index("y")).to_pylist(), texts):
                seen = {plain_word(w) for w in text.decode("utf-8", "replace").split()} - {""}
                all_texts.update(seen)
                if y == 1:
                    bad.update(seen)
            if len(all_texts) > 500_000:
                yield out()
        yield out()

    totals = train.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("bad")).first()
    n, n_bad = totals.n, totals.bad
    if not 0 < n_bad < n:
        return frozenset()
    counted = train.mapInArrow(run, "word string, bad long, n long").groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    inside, outside = F.col("bad") / n_bad, (F.col("n") - F.col("bad") + 0.5) / (n - n_bad + 1)
    chosen = (counted.where((F.col("bad") >= max(3, 0.01 * n_bad)) & (inside >= 4 * outside))
              .withColumn("g", F.col("bad") * F.log(inside / outside)).orderBy(F.desc("g"), "word").limit(size))
    return frozenset(r.word for r in chosen.collect())


def add_features(docs: DataFrame, text_col: str, out: str, learned: frozenset[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def compute():
        words = shared.value
        return lambda texts: [pa.array([features(t.decode("utf-8", "replace"), words) for t in texts],
                                       pa.list_(pa.float64()))]

    return add_columns(docs, text_col, StructType([StructField(out, ArrayType(DoubleType()))]), compute)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
          label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(id, held_out, score, predicted) for every row.

    Only rows whose crc32(id) mod 4 is not 2 are learned from, at most
    ``sample`` labelled ones: four fifths fit the trees and one fifth the
    calibration. NULL and empty texts are scored with all features zero. With
    fewer than ten labelled rows of either kind, every score is the share of
    toxic labels (0 without labels). Repeated rows each get a row, and of rows
    with one id one is learned from; a NULL id is never held out; other columns are not carried.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    picked = materialize(labelled_sample(labels, sample, label_id, label_col), "toxic_labels")
    train = training_rows(rows, picked)
    learned = learn_lexicon(train)
    fit = materialize(add_features(train, "body", "x", learned).select(
        array_to_vector("x").alias("x"), "y", (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(5)) == 0).alias("calibrate")),
        "toxic_features")
    n = fit.groupBy("y").count().collect()
    by = {r.y: r["count"] for r in n}
    result = add_features(rows, "body", "x", learned).select(
        "id", in_split("id", 4, 2).alias("held_out"), array_to_vector("x").alias("x"))
    if min(by.get(0.0, 0), by.get(1.0, 0)) < 10:
        share = by.get(1.0, 0) / max(1, sum(by.values()))
        scored = result.withColumn("score", F.lit(float(share)))
    else:
        learner = GBTClassifier(featuresCol="x", labelCol="y", maxIter=15, maxDepth=4, stepSize=0.2,
                                subsamplingRate=0.8, seed=17, predictionCol="guess")
        learner.setProbabilityCol("p").setRawPredictionCol("raw")
        trees = learner.fit(fit.where("NOT calibrate").coalesce(6))
        raw = trees.transform(fit.where("calibrate")).select(vector_to_array("p")[1].alias("p1"), "y")
        steps = IsotonicRegression(featuresCol="p1", labelCol="y", predictionCol="score").fit(raw)
        scored = steps.transform(trees.transform(result).withColumn("p1", vector_to_array("p")[1]))
        scored = scored.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score"))))
    return scored.select(F.col("id").alias(id_col), "held_out", "score",
                         F.when(F.col("score") >= CUT, 1).otherwise(0).cast("int").alias("predicted"))
