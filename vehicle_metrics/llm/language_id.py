"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent 1- to 3-grams in order of frequency. Texts
are lower-cased, everything but letters becomes one space, and n-grams include
the space as word edge. A document's profile is compared with each language's
by out-of-place distance: for each of the document's n-grams, how many ranks
apart it stands in the two, or the full profile length if the language's
profile lacks it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from vehicle_metrics.llm.common import add_columns, fresh, may_train, text_blocks
from vehicle_metrics.storage import materialize

PROFILE = 400  # n-grams of a language profile
DOC_PROFILE = 300  # n-grams of a document profile
MAX_LANGUAGES = 2000  # the profiles go to every task: 2000 x 400 entries of 16 bytes at most
FLUSH = 1 << 20  # distinct n-grams that a training task holds for a language before it emits them
TAIL = 0.001  # share of the learned rows that may lie beyond a quantile that a cutoff is set by
UNKNOWN = "und"


def letter_codes():
    """A function from UTF-8 text to its code points with every letter
    lower-cased, every run of other characters turned into one space, and a
    space at both ends; empty if there is no letter."""
    table = np.zeros(sys.maxunicode + 1, np.int64)
    known = np.zeros(sys.maxunicode + 1, bool)

    def codes(text: bytes) -> np.ndarray:
        raw = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), "<u4")
        if not known[raw].all():
            for c in np.unique(raw[~known[raw]]).tolist():
                known[c], table[c] = True, c if chr(c).isalpha() else 32
        mapped = np.concatenate([[32], table[raw], [32]])
        mapped = mapped[np.concatenate([[True], (mapped[1:] != 32) | (mapped[:-1] != 32)])]
        return mapped if len(mapped) > 1 else mapped[:0]

    return codes


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 1- to 3-grams, as numbers of 21 bits a character, with counts;
    the single space is not counted."""
    one = codes[codes != 32] << 42
    two = codes[:-1] << 42 | codes[1:] << 21
    three = two[:-1] | codes[2:]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def top_ranked(grams: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent n-grams, ties by code."""
    return grams[np.lexsort((grams, -counts))[:k]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """(lang, gram, rank): the ``size`` most frequent n-grams of every
    language over all the rows given, rank from 0.

    Tasks pre-aggregate n-grams over all their rows. The top of a language is
    taken in two steps, within hash buckets and then over the buckets' tops,
    so that no task sees all n-grams of a language.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, held = letter_codes(), {}

        def out(lang: str) -> pa.RecordBatch:
            grams, counts = merged(held.pop(lang))
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)],
                names=["lang", "gram", "n"])

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return grams, np.bincount(at, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)

        for part, texts in text_blocks(batches, "body"):
            by_lang: dict[str, list] = {}
            for lang, text in zip(part.column(0).to_pylist(), texts):
                c = codes(text)
                if len(c):
                    by_lang.setdefault(lang, []).append(c)
            for lang, seen in by_lang.items():
                # Texts end and begin with a space; two spaces never meet inside one, so such n-grams are dropped.
                grams, counts = gram_counts(np.concatenate(seen))
                inside = ((grams >> 21 & 0x1FFFFF != 32) | (grams >> 42 != 32)) & (
                    (grams & 0x1FFFFF != 32) | (grams >> 21 & 0x1FFFFF != 32))
                parts = held.setdefault(lang, [])
                parts.append((grams[inside], counts[inside]))
                if sum(len(p[0]) for p in parts) > FLUSH:
                    held[lang] = [merged(parts)]
                    if len(held[lang][0][0]) > FLUSH // 2:
                        yield out(lang)
        for lang in list(held):
            yield out(lang)

    counted = (rows.where("lang IS NOT NULL AND body IS NOT NULL").mapInArrow(run, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = [F.desc("n"), F.asc("gram")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(16))).orderBy(*order)
    tops = counted.withColumn("place", F.row_number().over(near)).where(F.col("place") <= size).drop("place")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return tops.withColumn("rank", place - 1).where(F.col("rank") < size).select("lang", "gram", "rank")


def _nearness(langs: list[str], grams: np.ndarray, ranks: np.ndarray, size: int, doc_size: int):
    """A function from a text to 1 minus its out-of-place distance to each
    language as a share of the largest possible one; None if there is no
    letter or no language. ``grams`` is sorted; ``ranks`` has a row for each
    and a last one for absent n-grams."""
    codes = letter_codes()

    def one(text: bytes) -> np.ndarray | None:
        c = codes(text)
        if not len(c) or not langs:
            return None
        own = top_ranked(*gram_counts(c), doc_size)
        at = np.searchsorted(grams, own)
        at[at == len(grams)] = 0
        at = np.where(grams[at] == own, at, len(grams))
        place = ranks[at]
        apart = np.abs(place - np.arange(len(own))[:, None])
        apart[place < 0] = size
        return 1.0 - apart.sum(0) / (size * len(own))

    return one


def _scorer(langs: list[str], grams: np.ndarray, ranks: np.ndarray, size: int, doc_size: int):
    """A function from texts to (language, score) lists."""
    near = _nearness(langs, grams, ranks, size, doc_size)

    def one(text: bytes) -> tuple[str, float]:
        scores = near(text)
        if scores is None:
            return UNKNOWN, 0.0
        best = int(np.argmax(scores))
        return langs[best], float(scores[best])

    return lambda texts: zip(*map(one, texts))


def profile_arrays(profiles: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages, the sorted n-grams of all profiles and their ranks by
    language, on the driver; the number of languages is checked first."""
    n = profiles.select("lang").distinct().count()
    if n > MAX_LANGUAGES:
        raise ValueError(f"{n} languages; the profiles of at most {MAX_LANGUAGES} are sent to every task")
    table = profiles.toPandas()
    langs = sorted(table["lang"].unique())
    grams = np.unique(table["gram"].to_numpy(np.int64))
    ranks = np.full((len(grams) + 1, len(langs)), -1, np.int32)
    if langs:
        ranks[np.searchsorted(grams, table["gram"].to_numpy(np.int64)),
              np.searchsorted(langs, table["lang"].to_numpy(str))] = table["rank"].to_numpy(np.int32)
    return langs, grams, ranks


def learn_cutoffs(train: DataFrame, profiles: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  size: int = PROFILE, doc_size: int = DOC_PROFILE, tail: float = TAIL) -> dict[str, float]:
    """For each language, the score from which on a text counts as being in it.

    Every training row is scored with its own language's profile, and with the
    best of the others, as it would be if its language were unknown. The cutoff
    lies half way between the scores that all but the share ``tail`` of the
    language's rows reach and that all but the share ``tail`` of the other
    rows nearest to it stay below; where the two overlap, or there is no
    other row, it is the former. Only quantiles leave Spark.
    """
    langs, grams, ranks = profile_arrays(profiles)
    shared = train.sparkSession.sparkContext.broadcast((langs, grams, ranks))
    rows = train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("body"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value[0]
        near, at = _nearness(*shared.value, size, doc_size), {x: i for i, x in enumerate(names)}
        for part, texts in text_blocks(batches, "body"):
            lang, own, score = [], [], []
            for name, text in zip(part.column(0).to_pylist(), texts):
                scores = near(text)
                if scores is None or name not in at:
                    continue
                lang.append(name)
                own.append(True)
                score.append(float(scores[at[name]]))
                if len(names) > 1:
                    scores[at[name]] = -1.0
                    best = int(np.argmax(scores))
                    lang.append(names[best])
                    own.append(False)
                    score.append(float(scores[best]))
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(own, pa.bool_()),
                                              pa.array(score, pa.float64())], names=["lang", "own", "score"])

    found = rows.mapInArrow(run, "lang string, own boolean, score double").groupBy("lang", "own").agg(
        F.percentile_approx("score", [tail, 1 - tail], 10_000).alias("q")).collect()
    low = {r.lang: r.q[0] for r in found if r.own}
    high = {r.lang: r.q[1] for r in found if not r.own}
    return {x: min(q, (q + high.get(x, q)) / 2) for x, q in low.items()}


def add_language(docs: DataFrame, profiles: DataFrame, pred: str, score: str, text_col: str = "text",
                 size: int = PROFILE, doc_size: int = DOC_PROFILE) -> DataFrame:
    """Every row with the nearest language and 1 minus its out-of-place
    distance as a share of the largest possible one.

    Equal distances go to the first language in alphabetical order. The
    profiles are read to the driver and sent to the tasks; their size is
    checked against MAX_LANGUAGES first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profile_arrays(profiles))

    def compute():
        apply = _scorer(*shared.value, size, doc_size)

        def run(texts: list[bytes]) -> list[pa.Array]:
            names, scores = apply(texts)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return run

    return add_columns(docs, text_col, StructType([
        StructField(pred, StringType()), StructField(score, DoubleType())]), compute)


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Profiles from the rows whose crc32(id) mod 4 is not 2, stored."""
    train = docs.where(may_train(id_col, 4, 2)).select(text_col, lang_col)
    return materialize(learn_profiles(train, text_col, lang_col), "language_profiles")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) for every row.

    Texts that are NULL, empty or without a letter get ``und`` and score 0,
    and so does everything if no row may be learned from. A NULL id is not
    learned from and not held out; repeated rows count each; other columns are
    not carried.
    """
    profiles = learn(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return add_language(rows, profiles, "lang_pred", "score", "body").select(
        F.col("id").alias(id_col), held.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    min_score: float | None = None) -> DataFrame:
    """The rows whose language can be told: not ``und`` and a score of at
    least the cutoff learned for that language, or ``min_score`` if given.
    Their own columns are kept as they are.

    NULL, empty and letterless texts go; a NULL id or language is not learned
    from; repeated rows count each; if nothing may be learned from, no row
    stays. A very long text is one array of its n-grams in its task."""
    pred, score = fresh(docs, "_lang_pred"), fresh(docs, "_lang_score")
    profiles = learn(docs, id_col, text_col, lang_col)
    scored = add_language(docs, profiles, pred, score, text_col)
    if min_score is None:
        cutoffs = learn_cutoffs(docs.where(may_train(id_col, 4, 2)), profiles, text_col, lang_col)
        pairs = [x for lang, c in cutoffs.items() for x in (F.lit(lang), F.lit(c))]
        least = F.element_at(F.create_map(*pairs), F.col(pred)) if pairs else F.lit(None).cast("double")
    else:
        least = F.lit(min_score)
    return scored.where((F.col(pred) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
