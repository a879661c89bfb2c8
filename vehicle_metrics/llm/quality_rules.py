"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

A rule rejects a document whose measure exceeds the rule's cutoff in the
document's stratum. Cutoffs are not set by hand: on labelled documents of good
quality, a candidate cutoff is certified when the exact binomial test rejects
"this cutoff would reject more than ``epsilon`` of the good documents of the
stratum", which is the same as a Clopper-Pearson upper bound of at most
``epsilon``. All candidates of all rules and strata are tested at
``delta / number of tests`` (Bonferroni), so with probability 1 - delta every
certified cutoff keeps its promise at once. The lowest certified cutoff of a
rule and stratum is used; where none is certified, the rule rejects nothing.
``epsilon`` is the allowed total rate divided by the number of rules, so a
stratum loses at most the allowed rate over all rules.

Strata and rules are given as SQL expressions over the measures, so their
number, and with it the table of cutoffs, is bounded by the arguments.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.llm.common import SPACES, fresh
from vehicle_metrics.storage import materialize

#: Measure name -> SQL over the base measures; larger is worse.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "long_words": "word_chars / greatest(n_words, 1) / 100",
}
CUTOFFS = {
    "symbols": (0.01, 0.02, 0.05, 0.1, 0.2, 0.3),
    "duplicate_lines": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5),
    "repeated_words": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5),
    "capitals": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7),
    "long_words": (0.08, 0.1, 0.12, 0.15, 0.2, 0.4),
}
STRATA = {"short": "n_words < 200", "medium": "n_words >= 200 AND n_words < 1000", "long": "n_words >= 1000"}
BASE_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


@dataclass(frozen=True)
class RiskControl:
    false_rejection: float = 0.05  # of good documents in a stratum, over all rules
    delta: float = 0.05  # chance that any certified cutoff breaks its promise

    @property
    def epsilon(self) -> float:
        return self.false_rejection / len(RULES)

    @property
    def alpha(self) -> float:
        return self.delta / (len(STRATA) * sum(map(len, CUTOFFS.values())))


def add_measures(docs: DataFrame, text_col: str, names: dict[str, str]) -> DataFrame:
    """``docs`` with the base measures; ``names`` gives each one's column.

    The projections are chained so that each array is built once per row:
    Catalyst does not merge a projection that would repeat costly work.
    """
    w, lines, tri, ranked, twice, t = (fresh(docs, f"_{x}") for x in ("w", "lines", "tri", "ranked", "twice", "t"))
    df = docs.withColumn(t, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = df.withColumn(w, F.array_remove(F.split(t, SPACES), ""))
    df = df.withColumn(lines, F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size(w)
    # One 64-bit hash for each window of three words; equal windows have equal hashes.
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    df = df.withColumn(tri, F.when(n >= 3, windows))
    repeats = F.size(F.array_distinct(tri)) < F.size(tri)
    df = df.withColumn(ranked, F.when(repeats, F.sort_array(F.transform(tri, lambda h, i: F.struct(
        h.alias("h"), i.alias("i"))))))
    h = lambda i: F.get(ranked, i)["h"]  # noqa: E731 - neighbours in hash order
    df = df.withColumn(twice, F.filter(ranked, lambda x, i: (x["h"] == h(i - 1)) | (x["h"] == h(i + 1))))
    covered = F.array_distinct(F.flatten(F.transform(
        twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    values = {
        "n_words": n,
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.when(F.col(twice).isNull(), 0).otherwise(F.size(covered)),
        "n_lines": F.size(lines),
        "n_capitals": F.length(F.regexp_replace(t, r"[^A-Z]+", "")),
    }
    return df.select(*docs.columns, *[values[m].cast("long").alias(names[m]) for m in MEASURES])


def _sql(expression: str, names: dict[str, str]) -> str:
    """``expression`` with each measure replaced by its column."""
    import re

    return re.sub(r"\b(" + "|".join(MEASURES) + r")\b", lambda m: f"`{names[m[1]]}`", expression)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly term by term in logs."""
    import math

    odds = math.log(p) - math.log1p(-p)
    first = n * F.lit(math.log1p(-p))
    start = F.struct(first.alias("log_term"), F.exp(first).alias("total"))

    def add(state, i):
        log_term = state["log_term"] + F.log((n - i + 1) / i) + F.lit(odds)
        return F.struct(log_term.alias("log_term"), (state["total"] + F.exp(log_term)).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.aggregate(steps, start, add, lambda s: s["total"])


def certify(good: DataFrame, names: dict[str, str], risk: RiskControl = RiskControl()) -> DataFrame:
    """(stratum, rule, cutoff, n, k, p_value, certified) for all candidates,
    from the measures of the good labelled documents that pass the base rules.

    One aggregate over the rows counts the rejections of every candidate; the
    exact test then runs on the counts."""
    stacked = [(s, r, c, f"count_if(({cond}) AND {RULES[r]} > {c}D) AS k{i}_{r}_{j}")
               for i, (s, cond) in enumerate(STRATA.items()) for r in RULES for j, c in enumerate(CUTOFFS[r])]
    totals = [f"count_if({cond}) AS n{i}" for i, cond in enumerate(STRATA.values())]
    counts = good.selectExpr(*[f"`{names[m]}` AS {m}" for m in MEASURES]).where(f"NOT {BASE_FAILED}").agg(
        *[F.expr(x) for x in totals], *[F.expr(x[3]) for x in stacked])
    position = {s: i for i, s in enumerate(STRATA)}
    entries = ", ".join(f"struct('{s}' AS stratum, '{r}' AS rule, {c}D AS cutoff, n{position[s]} AS n, "
                        f"{sql.rpartition(' AS ')[2]} AS k)" for s, r, c, sql in stacked)
    tests = counts.selectExpr(f"inline(array({entries}))")
    # From k >= n * epsilon on the tail is near one half or more, so no test there can succeed.
    tail = F.when((F.col("n") == 0) | (F.col("k") >= F.col("n") * risk.epsilon), F.lit(1.0)).otherwise(
        binomial_tail(F.col("k"), F.col("n"), risk.epsilon))
    return tests.withColumn("p_value", tail).withColumn("certified", F.col("p_value") <= risk.alpha)


def good_rows(measured: DataFrame, labels: DataFrame, id_col: str, label_id: str = "doc_id",
              label_col: str = "quality") -> DataFrame:
    """Measured documents that some label calls good and none calls bad."""
    key = fresh(measured, "_label_id")
    good = (labels.where(F.col(label_id).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(F.col(label_id).alias(key)).agg(F.min(label_col).alias("low")).where("low = 1").select(key))
    return measured.join(good, F.col(id_col) == F.col(key), "left_semi")


def verdict(tests: DataFrame, names: dict[str, str]) -> Column:
    """Whether a row is kept, under the lowest certified cutoffs. The cutoffs
    are read to the driver: at most one for each rule and stratum."""
    chosen = tests.where("certified").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff")).collect()
    rejects = [f"(({_sql(STRATA[x.stratum], names)}) AND {_sql(RULES[x.rule], names)} > {x.cutoff!r}D)"
               for x in sorted(chosen, key=lambda x: (x.stratum, x.rule))]
    return F.expr(f"NOT ({' OR '.join([_sql(BASE_FAILED, names), *rejects])})")


def assess(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           risk: RiskControl = RiskControl()) -> DataFrame:
    """(id, measures, base_failed, kept) for every row.

    The measures are computed in one scan and stored; the cutoffs and the
    result both read that small table. NULL and empty texts have no words and
    fail the base rules; repeated rows each get a row and each count as a
    labelled document; NULL ids match no label; without good labels no cutoff
    is certified and only the base rules reject. Other columns are not carried.
    """
    names = {m: m for m in MEASURES}
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    measured = materialize(add_measures(rows, "body", names).drop("body"), "quality_measures")
    kept = verdict(certify(good_rows(measured, labels, "id"), names, risk), names)
    return measured.select(F.col("id").alias(id_col), *MEASURES, F.expr(BASE_FAILED).alias("base_failed"),
                           kept.alias("kept"))


def keep_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   risk: RiskControl = RiskControl()) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    The rows are written once with their measures; the cutoffs and the filter
    both read that table. (A filter over the measuring projection itself would
    be pushed into it and measure anew for every condition.)
    """
    names = {m: fresh(docs, f"_{m}") for m in MEASURES}
    measured = materialize(add_measures(docs, text_col, names), "quality_measured")
    tests = certify(good_rows(measured, labels, id_col), names, risk)
    return measured.where(verdict(tests, names)).select(*docs.columns)
