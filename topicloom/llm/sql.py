"""SQL twins of the operators that SQL can express."""

from topicloom.llm.bisector_clusters import BisectorClusters
from topicloom.llm.quality_rules import RULES, RiskControl

_GAP = "[\\x20\\x09-\\x0D]+"
_CONTROL = RiskControl()
_SHARE = _CONTROL.risk / len(_CONTROL.cutoffs)
_GRID = ", ".join(
    f"('{rule}', {at}, CAST({cut} AS DOUBLE))" for rule, cuts in _CONTROL.cutoffs.items() for at, cut in enumerate(cuts)
)
_VALUES = " UNION ALL ".join(
    f"SELECT doc_id, stratum, good, '{rule}' AS rule, CASE WHEN n_words > 0 THEN {value} ELSE 0.0 END AS value FROM held"
    for rule, value in RULES.items()
)
_FAILED = " OR ".join(
    f"coalesce(CASE WHEN n_words > 0 THEN {value} ELSE 0.0 END > "
    f"(SELECT max(b.cutoff) FROM best b WHERE b.stratum = s.stratum AND b.rule = '{rule}'), false)"
    for rule, value in RULES.items()
)

QUALITY_RULES_SQL = f"""
WITH base AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_GAP}'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
spots AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS pos FROM base),
windows AS (
  SELECT doc_id, pos, [x, lead(x, 1) OVER o, lead(x, 2) OVER o] AS tri FROM spots
  WINDOW o AS (PARTITION BY doc_id ORDER BY pos) QUALIFY lead(x, 2) OVER o IS NOT NULL),
twice AS (SELECT doc_id, tri FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT pos + o) AS n
  FROM windows JOIN twice USING (doc_id, tri), (VALUES (0), (1), (2)) AS x(o) GROUP BY doc_id),
s AS (
  SELECT b.doc_id, b.stratum, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{_GAP}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         (len(w) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(w)) AS base_failed
  FROM base b LEFT JOIN covered c USING (doc_id)),
held AS (
  SELECT s.*, y.good FROM s
  JOIN (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) y USING (doc_id)
  WHERE NOT base_failed),
vals AS ({_VALUES}),
grid(rule, pos, cutoff) AS (VALUES {_GRID}),
sums AS (
  SELECT stratum, rule, pos, cutoff, count(*) FILTER (good) AS n,
         count(*) FILTER (good AND value > cutoff) AS k, count(*) FILTER (NOT good AND value > cutoff) AS b
  FROM vals JOIN grid USING (rule) GROUP BY ALL),
tails AS (
  SELECT *, CASE WHEN n > 0 AND k < n * {_SHARE!r} THEN
    (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_SHARE!r}) + (n - i) * ln(1 - {_SHARE!r})))
     FROM (SELECT unnest(range(0, k + 1)) AS i)) ELSE 1.0 END AS tail
  FROM sums),
tested AS (
  SELECT *, tail <= {_CONTROL.delta} / ({len(_CONTROL.cutoffs)} * (SELECT count(DISTINCT stratum) FROM sums)) AS ok,
         b - {_CONTROL.price} * k AS gain FROM tails),
certified AS (
  SELECT t.* FROM tested t WHERE gain > 0 AND NOT EXISTS (
    SELECT 1 FROM tested f WHERE f.stratum = t.stratum AND f.rule = t.rule AND f.pos <= t.pos AND NOT f.ok)),
best AS (
  SELECT stratum, rule, arg_max(cutoff, gain * 1000 - pos) AS cutoff FROM certified GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND NOT ({_FAILED})) AS kept
FROM s
"""

_CLUSTERS = BisectorClusters()
_APART = "list_sum(list_transform(list_zip(v.x, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _rounds() -> str:
    out = []
    for i in range(_CLUSTERS.rounds + 1):
        out.append(f"""
a{i} AS MATERIALIZED (
  SELECT best.* FROM (
    SELECT v.row, any_value(v.vec_id) AS vec_id, min({{'d': {_APART}, 'k': c.k}}) AS best
    FROM vectors v CROSS JOIN c{i} c GROUP BY v.row) AS best)""")
        if i < _CLUSTERS.rounds:
            out.append(f"""
s{i} AS (
  SELECT k, pos, sum(y)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM (SELECT a.best.k AS k, unnest(v.x) AS y, unnest(range({_CLUSTERS.dims})) AS pos FROM a{i} a JOIN vectors v USING (row))
  GROUP BY ALL),
m{i} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS c FROM s{i} GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN m{i} m USING (k))""")
    return ",".join(out)


BISECTOR_CLUSTERS_SQL = f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda y: CAST(floor({_CLUSTERS.scale} * CAST(y AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {_CLUSTERS.dims}
    AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {_CLUSTERS.dims}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{_CLUSTERS.seed}:' || vec_id)) - 1 AS k, x AS c
  FROM vectors WHERE vec_id IS NOT NULL ORDER BY k LIMIT {_CLUSTERS.k}),{_rounds()}
SELECT a.vec_id, CAST(a.best.k AS INTEGER) AS cluster, CAST(a.best.d AS BIGINT) AS distance,
       CAST(sum(a.best.d) OVER (PARTITION BY a.best.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{_CLUSTERS.rounds} a JOIN c{_CLUSTERS.rounds} c ON c.k = a.best.k
"""
