"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from vehicle_metrics.llm.quality_rules import BASE_FAILED, CUTOFFS, RULES, STRATA, RiskControl

_RISK = RiskControl()


def _candidates() -> str:
    rows = [f"SELECT '{s}' AS stratum, '{r}' AS rule, {c}::DOUBLE AS cutoff, "
            f"count(*) FILTER (WHERE {cond}) AS n, "
            f"count(*) FILTER (WHERE ({cond}) AND {_double(RULES[r])} > {c}::DOUBLE) AS k FROM good"
            for s, cond in STRATA.items() for r in RULES for c in CUTOFFS[r]]
    return " UNION ALL ".join(rows)


def _double(rule: str) -> str:
    return rule.replace(" / 100", " / 100.0")


def _op1() -> str:
    rejects = " OR ".join(
        f"(({cond}) AND coalesce({_double(RULES[r])} > (SELECT min(cutoff) FROM certified "
        f"WHERE stratum = '{s}' AND rule = '{r}'), false))" for s, cond in STRATA.items() for r in RULES)
    p = _RISK.epsilon
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
w AS (SELECT rid, doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
tri AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM tri) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY rid),
m AS (SELECT rid, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
  len(lines)::BIGINT AS n_lines, length(regexp_replace(body, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
  FROM w LEFT JOIN rep USING (rid)),
good_ids AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
good AS (SELECT * FROM m WHERE doc_id IN (SELECT doc_id FROM good_ids) AND NOT {BASE_FAILED}),
candidates AS ({_candidates()}),
certified AS (SELECT stratum, rule, cutoff FROM candidates WHERE n > 0 AND k < n * {p!r}::DOUBLE AND
  list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    + i * ln({p!r}::DOUBLE) + (n - i) * ln(1 - {p!r}::DOUBLE)))) <= {_RISK.alpha!r}::DOUBLE)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals,
  {BASE_FAILED} AS base_failed, NOT ({BASE_FAILED} OR {rejects}) AS kept FROM m
"""


_OP12 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
  list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
p AS (SELECT a, anchor_id, b AS p, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.id, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


ORACLE_SQL: dict[str, str] = {"op1_quality_rules": _op1(), "op12_hard_negatives": _OP12}
