"""DuckDB SQL equivalents of the registered queries (brute force where the
Spark plan is clever; the views ``lineitem orders customer events
embeddings part ...`` are registered by the checker)."""

from __future__ import annotations

PCT_TEXT = ("CASE WHEN starts_with(printf('%.1f', {x}), '0.') THEN substr(printf('%.1f', {x}), 2) "
            "ELSE printf('%.1f', {x}) END")

CATEGORY_OVERLAP = """
WITH obs AS (
  SELECT o.o_orderpriority AS category, l.l_partkey AS item_id, c.c_mktsegment AS market
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE')),
flags AS (
  SELECT category, item_id,
         max(CASE WHEN market = 'BUILDING' THEN 1 ELSE 0 END) AS in_m1,
         max(CASE WHEN market = 'AUTOMOBILE' THEN 1 ELSE 0 END) AS in_m2
  FROM obs GROUP BY category, item_id),
per AS (
  SELECT category, CAST(sum(in_m1) AS BIGINT) AS count_m1, CAST(sum(in_m1 * in_m2) AS BIGINT) AS overlap
  FROM flags GROUP BY category)
SELECT category, count_m1, overlap,
       CAST(overlap AS DOUBLE) / CAST(count_m1 AS DOUBLE) * 100.0 AS pct
FROM per WHERE count_m1 > 0
"""

CATEGORY_OVERLAP_TEXT = f"""
WITH ov AS ({CATEGORY_OVERLAP})
SELECT category,
       'total ' || CAST(CAST(count_m1 AS DOUBLE) AS VARCHAR) || '; ' || {PCT_TEXT.format(x='pct')}
       || '% in AUTOMOBILE' AS line
FROM ov
"""

_GROWTH_CORE = """
r AS (
  SELECT *, row_number() OVER (PARTITION BY market, item_id
                               ORDER BY date_key ASC NULLS LAST, obs_id) AS rn
  FROM obs),
k AS (
  SELECT market, item_id,
         CAST(count(CASE WHEN date_key IS NOT NULL AND rn <= 2 THEN 1 END) AS BIGINT) AS n_used,
         max(CASE WHEN date_key IS NOT NULL AND rn = 1 THEN views END) AS early,
         max(CASE WHEN date_key IS NOT NULL AND rn = 2 THEN views END) AS late
  FROM r GROUP BY market, item_id),
g AS (
  SELECT market, item_id, n_used, early, late,
         CASE WHEN n_used < 2 THEN 0.0::DOUBLE
              WHEN early = 0 THEN NULL
              ELSE (CAST(late AS DOUBLE) - CAST(early AS DOUBLE)) / CAST(early AS DOUBLE) * 100.0 END AS pct
  FROM k),
rep AS (
  SELECT market, item_id, pct, CAST(trunc(pct) AS BIGINT) AS pct_trunc,
         market || ';  ' || CAST(item_id AS VARCHAR) || ',  ' || {pct_text} || '%' AS line
  FROM g WHERE pct IS NOT NULL AND trunc(pct) >= 1000)
""".replace("{pct_text}", PCT_TEXT.format(x="pct"))

_GROWTH_ORDERS = """
WITH obs AS (
  SELECT o_orderpriority AS market, o_custkey AS item_id, o_orderdate AS date_key,
         o_totalprice AS views, o_orderkey AS obs_id
  FROM orders),
""" + _GROWTH_CORE

GROWTH_FIRST_TWO = _GROWTH_ORDERS + "SELECT market, item_id, n_used, early, late, pct FROM g"

GROWTH_OVER_1000 = _GROWTH_ORDERS + "SELECT market, item_id, pct_trunc, line FROM rep"

GROWTH_LINES = _GROWTH_ORDERS + "SELECT line FROM rep"

GROWTH_FROM_LINES = """
WITH obs AS (
  SELECT o_orderpriority AS market, CAST(o_custkey AS VARCHAR) AS item_id,
         CAST(strftime(o_orderdate, '%y%m%d') AS INTEGER) AS date_key,
         CAST(floor(o_totalprice) AS BIGINT) AS views, o_orderkey AS obs_id
  FROM orders),
""" + _GROWTH_CORE + "SELECT market, item_id, pct_trunc, line FROM rep"

DATE_KEY = """
WITH t AS (SELECT event_id, strftime(ts, '%y.%d.%m') AS txt FROM events),
d AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN replace(txt, '.', '-')
              WHEN event_id % 11 = 0 THEN txt || '.'
              WHEN event_id % 13 = 0 THEN substr(txt, 1, 5)
              WHEN event_id % 17 = 0 THEN substr(txt, 1, 6)
              WHEN event_id % 19 = 0 THEN substr(txt, 1, 3) || substr(txt, 6, 3)
              ELSE txt END AS obs_date
  FROM t),
p AS (SELECT event_id, obs_date, string_split(rtrim(obs_date, '.'), '.') AS piece FROM d)
SELECT event_id, obs_date,
       CASE WHEN len(piece) = 3 AND regexp_full_match(piece[1] || piece[3] || piece[2], '[+-]?[0-9]+')
            THEN TRY_CAST(piece[1] || piece[3] || piece[2] AS INTEGER) END AS date_key
FROM p
"""

# A comma splits if the quotes behind it are even in number. Of a line
# id,type,"props" with inner quotes doubled: one stray quote behind the type
# joins id and type; one behind the last field does so for all but the commas
# inside props, which then do split; both together leave the plain fields.
SPLIT_QUOTED = """
WITH l AS (
  SELECT event_id, CAST(event_id AS VARCHAR) || ',' || event_type || CASE WHEN event_id % 5 = 0 THEN '"' ELSE '' END
         || ',"' || replace(props, '"', '""') || '"' || CASE WHEN event_id % 9 = 0 THEN '"' ELSE '' END AS line
  FROM events),
c AS (
  SELECT event_id, line, list_filter(range(1, len(line) + 1), lambda i: line[i] = ','
           AND (len(line[i:]) - len(replace(line[i:], '"', ''))) % 2 = 0) AS cuts
  FROM l)
SELECT event_id, CAST(len(cuts) + 1 AS INTEGER) AS n_fields,
       substr(line, 1, coalesce(cuts[1], len(line) + 1) - 1) AS f0,
       CASE WHEN len(cuts) >= 1 THEN substr(line, cuts[1] + 1, coalesce(cuts[2], len(line) + 1) - cuts[1] - 1) END AS f1,
       CASE WHEN len(cuts) >= 2 THEN substr(line, cuts[2] + 1, coalesce(cuts[3], len(line) + 1) - cuts[2] - 1) END AS f2
FROM c
"""

PARSE_LONG = """
WITH v AS (SELECT event_id, regexp_extract(props, '"k":\\s*(-?[0-9]+)', 1) AS k FROM events),
t AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN k || '.0'
              WHEN event_id % 11 = 0 THEN ' ' || k
              ELSE k END AS views_text
  FROM v)
SELECT event_id, views_text,
       CASE WHEN regexp_full_match(views_text, '[+-]?[0-9]+') THEN TRY_CAST(views_text AS BIGINT) END AS views
FROM t
"""

MULTILINE_OBSERVATIONS = """
SELECT CAST(doc_id AS VARCHAR) AS item_id, lang AS category, n_chars AS views, source AS market, text AS body
FROM documents
"""

CSV_ROUNDTRIP = """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS f0, p_retailprice AS f1 FROM part
"""

PROJECT_CAST = """
SELECT vec_id AS id, label AS label_test, CAST(label AS DOUBLE) AS prediction,
       CAST(CAST(label AS DOUBLE) AS INTEGER) AS prediction_int
FROM embeddings
"""

ROW_ID = "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_distinct FROM embeddings"

ASSEMBLE_FEATURES = """
SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(embedding[i + 1] AS DOUBLE) AS value
FROM embeddings, unnest(range(len(embedding))) AS t(i)
"""

PCA_PROJECT = """
SELECT vec_id, label, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6) AS norm
FROM embeddings
"""

# The ten greatest eigenvalues of the covariance: a matrix squared 24 times over
# keeps its first direction only (step % 25 = 24 takes it out and goes on with the rest).
PRINCIPAL_COMPONENTS = """
WITH RECURSIVE
x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
y AS (SELECT vec_id, i, v - avg(v) OVER (PARTITION BY i) AS v FROM x),
c AS (SELECT a.i, b.i AS j, sum(a.v * b.v) / (count(*) - 1) AS cov FROM y a JOIN y b ON a.vec_id = b.vec_id GROUP BY a.i, b.i),
r AS (SELECT i, list(cov ORDER BY j) AS cells FROM c GROUP BY i),
it AS (
  SELECT 0 AS step, list(cells ORDER BY i) AS cov, list(cells ORDER BY i) AS p, NULL::DOUBLE AS variance, NULL::DOUBLE[] AS vec FROM r
  UNION ALL
  SELECT step + 1,
         CASE WHEN take THEN list_transform(cov, lambda row, i: list_transform(row, lambda z, j: z - lam * vec[i] * vec[j])) ELSE cov END,
         CASE WHEN take THEN list_transform(cov, lambda row, i: list_transform(row, lambda z, j: z - lam * vec[i] * vec[j]))
              ELSE list_transform(p, lambda a: list_transform(p, lambda b: list_dot_product(a, b) / (top * top))) END,
         CASE WHEN take THEN lam END, CASE WHEN take THEN vec END
  FROM (SELECT *, list_sum(list_transform(cov, lambda row, i: vec[i] * list_dot_product(row, vec))) AS lam
        FROM (SELECT step, cov, p, top, take, list_transform(p[peak], lambda z: z / sqrt(top * trace)) AS vec
              FROM (SELECT step, cov, p, list_max(diagonal) AS top, list_position(diagonal, list_max(diagonal)) AS peak,
                           list_sum(diagonal) AS trace, step % 25 = 24 AS take
                    FROM (SELECT step, cov, p, list_transform(p, lambda row, i: row[i]) AS diagonal FROM it WHERE step < 250))))),
found AS (SELECT row_number() OVER (ORDER BY step) - 1 AS component, variance, vec FROM it WHERE variance IS NOT NULL)
SELECT component::INT AS component, round(variance, 7) AS variance, (i - 1)::INT AS i, round(vec[i], 5) + 0.0 AS loading
FROM found, unnest(range(1, len(vec) + 1)) AS t(i)
"""

# The optimum of each class's regularised logistic loss by plain gradient descent:
# rows have norm 1 and a 1 for the intercept, so the curvature is below 0.53 and
# 900 steps of 1.9 leave under exp(-30) of the way.
_CELLS = ", ".join(f"sum(miss * x[{j}])" for j in range(1, 66))

_LOGISTIC = f"""
WITH RECURSIVE
e AS (SELECT vec_id, label, list_append(list_transform(embedding, lambda v: CAST(v AS DOUBLE)), 1.0::DOUBLE) AS x FROM embeddings),
t AS (SELECT * FROM e WHERE vec_id % 5 <> 0),
it AS (
  SELECT 0 AS step, label AS class, list_transform(range(65), lambda j: 0.0::DOUBLE) AS w FROM t GROUP BY label
  UNION ALL
  SELECT step + 1, class, list_transform(list_zip(w, [{_CELLS}]),
         lambda z, j: z[1] - 1.9 * (z[2] / count(*) + CASE WHEN j <= 64 THEN 0.02 * z[1] ELSE 0.0 END))
  FROM (SELECT step, class, w, x, 1 / (1 + exp(-list_dot_product(w, x))) - CASE WHEN label = class THEN 1 ELSE 0 END AS miss
        FROM it, t WHERE step < 900)
  GROUP BY step, class, w),
best AS (SELECT class, w FROM it WHERE step = 900)
"""

LOGISTIC_OPTIMUM = _LOGISTIC + """,
loss AS (
  SELECT class, w, count(*) AS n,
         avg(ln(1 + exp(CASE WHEN label = class THEN -1 ELSE 1 END * list_dot_product(w, x)))) + 0.01 * list_dot_product(w[1:64], w[1:64]) AS loss
  FROM best, t GROUP BY class, w)
SELECT class::INT AS label, n::BIGINT AS n, round(loss, 9) AS loss, TRUE AS fit_is_optimal, (i - 1)::INT AS i, round(w[i], 6) + 0.0 AS weight
FROM loss, unnest(range(1, 66)) AS u(i)
"""

LOGISTIC_OVERLAP = _LOGISTIC + """
SELECT vec_id, label AS actual, arg_max(class, list_dot_product(w, x))::INT AS predicted
FROM e, best WHERE vec_id % 5 = 0 GROUP BY vec_id, label
"""

# Classes far apart: the only sound prediction of every row is its label.
CLASSIFY_FAR = "SELECT vec_id, label AS actual, label AS predicted FROM embeddings WHERE vec_id % 5 = 0"

KNN_PCA_CLASSIFY = "SELECT vec_id AS qid, label AS actual, label AS predicted FROM embeddings WHERE vec_id % 5 = 0"

CROSS_VALIDATE_FAR = """
SELECT CAST(floor((row_number() OVER (ORDER BY vec_id) - 1) * 3 / count(*) OVER ()) AS INTEGER) AS fold,
       vec_id, label AS actual, label AS predicted
FROM embeddings
"""

CONFUSION_OTHER_LABELS = """
SELECT CAST(CASE WHEN vec_id % 5 = 0 THEN -1 ELSE label END AS INTEGER) AS predicted,
       CAST(CASE WHEN vec_id % 7 = 0 THEN label + 10 WHEN vec_id % 11 <> 0 THEN label END AS INTEGER) AS actual, count(*) AS n
FROM embeddings GROUP BY 1, 2
"""

_DIST = ("list_sum(list_transform(list_zip({a}, {b}), lambda x: "
         "(CAST(x[1] AS DOUBLE) - CAST(x[2] AS DOUBLE)) * (CAST(x[1] AS DOUBLE) - CAST(x[2] AS DOUBLE))))")

_KNN_NB = f"""
q AS (SELECT vec_id AS qid, label AS qlabel, embedding AS qv FROM embeddings WHERE vec_id % 5 = 0),
t AS (SELECT vec_id AS tid, label AS tlabel, embedding AS tv FROM embeddings WHERE vec_id % 5 <> 0),
d AS (SELECT qid, qlabel, tid, tlabel, {_DIST.format(a='qv', b='tv')} AS dist FROM q, t),
nb AS (
  SELECT qid, qlabel, tid, tlabel, dist,
         CAST(row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS INTEGER) AS rank
  FROM d QUALIFY rank <= 5)
"""

_VOTE = """
votes AS (
  SELECT qid, qlabel, tlabel, CAST(count(*) AS BIGINT) AS votes, min(rank) AS best
  FROM nb GROUP BY qid, qlabel, tlabel),
pred AS (
  SELECT qid, qlabel AS actual, tlabel AS predicted, votes FROM votes
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY votes DESC, best) = 1)
"""

KNN_TOPK = "WITH " + _KNN_NB + "SELECT qid, qlabel, tid, tlabel, rank, round(dist, 6) AS dist FROM nb"

_PRED = "WITH " + _KNN_NB + "," + _VOTE

KNN_PREDICT = _PRED + "SELECT qid, actual, predicted, votes FROM pred"

ERROR_COUNT = _PRED + """
SELECT CAST(count(*) FILTER (WHERE actual IS DISTINCT FROM predicted) AS BIGINT) AS errors FROM pred
"""

ACCURACY = _PRED + """,
a AS (SELECT CAST(count(*) AS BIGINT) AS n,
             CAST(count(*) FILTER (WHERE actual IS DISTINCT FROM predicted) AS BIGINT) AS errors FROM pred)
SELECT n, errors, CAST(n - errors AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy FROM a
"""

PREDICTION_COUNT = _PRED + "SELECT CAST(count(*) AS BIGINT) AS n FROM pred"

_MATRIX = """,
cells AS (
  SELECT CAST(predicted AS INTEGER) AS predicted, CAST(actual AS INTEGER) AS actual, CAST(1 AS BIGINT) AS n FROM pred
  UNION ALL
  SELECT CAST(p.range AS INTEGER), CAST(a.range AS INTEGER), CAST(0 AS BIGINT) FROM range(10) p, range(10) a),
m AS (SELECT predicted, actual, CAST(sum(n) AS BIGINT) AS n FROM cells GROUP BY predicted, actual)
"""

CONFUSION_MATRIX = _PRED + _MATRIX + "SELECT predicted, actual, n FROM m"

CONFUSION_WIDE = _PRED + _MATRIX + "SELECT predicted, " + ", ".join(
    f"CAST(sum(CASE WHEN actual = {j} THEN n ELSE 0 END) AS BIGINT) AS actual_{j}" for j in range(10)
) + " FROM m GROUP BY predicted"

_COUNTS = """,
r AS (
  SELECT CAST(actual AS INTEGER) AS label, 1 AS is_a, 0 AS is_p,
         CASE WHEN actual = predicted THEN 1 ELSE 0 END AS tp FROM pred
  UNION ALL SELECT CAST(predicted AS INTEGER), 0, 1, 0 FROM pred
  UNION ALL SELECT CAST(range AS INTEGER), 0, 0, 0 FROM range(10)),
per AS (
  SELECT label, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(is_a) AS BIGINT) AS na,
         CAST(sum(is_p) AS BIGINT) AS np FROM r GROUP BY label),
c AS (SELECT *, CAST(sum(na) OVER () AS BIGINT) AS total FROM per)
"""


def _ratio(num: str, den: str) -> str:
    return f"round(CASE WHEN {den} = 0 THEN NULL ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END, 3)"


CLASS_METRICS = _PRED + _COUNTS + f"""
SELECT label, tp, np - tp AS fp, na - tp AS fn, total - tp - (np - tp) - (na - tp) AS tn,
       {_ratio('tp', 'np')} AS precision, {_ratio('tp', 'na')} AS recall,
       {_ratio('2 * tp', 'na + np')} AS f_measure, na AS support
FROM c
"""

CLASS_METRICS_COMPAT = _PRED + _COUNTS + f"""
SELECT label, tp, na - tp AS fp, np - tp AS fn, total - tp - (np - tp) - (na - tp) AS tn,
       {_ratio('tp', 'na')} AS precision, {_ratio('tp', 'np')} AS recall,
       {_ratio('tp', 'na + np')} AS f_measure, np AS support
FROM c
"""

_FOLDS = """
folds AS (
  SELECT vec_id, label, embedding,
         CAST(row_number() OVER (ORDER BY vec_id) - 1 AS BIGINT) AS pos,
         CAST(floor((row_number() OVER (ORDER BY vec_id) - 1) * 10 / count(*) OVER ()) AS INTEGER) AS fold
  FROM embeddings)
"""

CONTIGUOUS_FOLDS = "WITH " + _FOLDS + "SELECT vec_id, pos, fold FROM folds"

FILE_POSITION = "SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row_id, label, embedding[1]::DOUBLE AS f0 FROM embeddings"

FOLD_COVARIANCES = "WITH " + _FOLDS + """,
x AS (SELECT f.fold, f.vec_id, unnest(e.embedding) AS v, generate_subscripts(e.embedding, 1) - 1 AS i FROM folds f JOIN embeddings e ON e.vec_id = f.vec_id),
p AS (SELECT a.fold, a.i, b.i AS j, count(*) AS n, sum(a.v::DOUBLE) AS sx, sum(b.v::DOUBLE) AS sy, sum(a.v::DOUBLE * b.v::DOUBLE) AS sxy
      FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY ALL),
held AS (SELECT DISTINCT fold FROM folds),
t AS (SELECT held.fold, i, j, sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxy) AS sxy FROM held JOIN p ON p.fold <> held.fold GROUP BY held.fold, i, j)
SELECT fold, n::BIGINT AS n, i::INT AS i, j::INT AS j, round((sxy - sx * sy / n) / (n - 1), 7) + 0.0 AS cov FROM t
"""

_FOLD_PRED = "WITH " + _FOLDS + f""",
d AS (
  SELECT q.vec_id AS qid, q.label AS qlabel, q.fold, t.vec_id AS tid, t.label AS tlabel,
         {_DIST.format(a='q.embedding', b='t.embedding')} AS dist
  FROM folds q JOIN folds t ON q.fold <> t.fold),
nb AS (
  SELECT qid, qlabel, fold, tid, tlabel, dist,
         row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rank
  FROM d QUALIFY rank <= 5),
votes AS (
  SELECT qid, qlabel, fold, tlabel, count(*) AS votes, min(rank) AS best
  FROM nb GROUP BY qid, qlabel, fold, tlabel),
pred AS (
  SELECT qid, fold, qlabel AS actual, tlabel AS predicted FROM votes
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY votes DESC, best) = 1)
"""

MERGE_CONFUSION = _FOLD_PRED + """,
per_fold AS (SELECT fold, predicted, actual, count(*) AS n FROM pred GROUP BY fold, predicted, actual)
SELECT CAST(predicted AS INTEGER) AS predicted, CAST(actual AS INTEGER) AS actual, CAST(sum(n) AS BIGINT) AS n
FROM per_fold GROUP BY predicted, actual
"""

MEAN_FOLD_ACCURACY = _FOLD_PRED + """,
acc AS (SELECT fold, avg(CASE WHEN actual = predicted THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS a
        FROM pred GROUP BY fold)
SELECT CAST(count(*) AS BIGINT) AS n_folds, round(avg(a), 9) AS mean_accuracy FROM acc
"""

# Multinomial naive Bayes in closed form (smoothing 1): log prior
# log(n_c + 1) - log(n + L), log likelihood log(tf_ci + 1) - log(tf_c + d),
# prediction = argmax over classes of prior + sum_i x_i * likelihood_ci.
NAIVE_BAYES = """
WITH e AS (
  SELECT vec_id, label,
         list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) + 1.0
                        + CASE WHEN i - 1 = label THEN 1.0 ELSE 0.0 END) AS f
  FROM embeddings),
train AS (SELECT * FROM e WHERE vec_id % 5 <> 0),
test AS (SELECT * FROM e WHERE vec_id % 5 = 0),
cells AS (SELECT label, unnest(f) AS v, unnest(generate_series(1, len(f))) AS i FROM train),
tf AS (SELECT label, i, sum(v) AS s FROM cells GROUP BY label, i),
tot AS (SELECT label, sum(s) AS total, count(*) AS d FROM tf GROUP BY label),
theta AS (SELECT tf.label, tf.i, ln(tf.s + 1.0) - ln(tot.total + tot.d * 1.0) AS lt
          FROM tf JOIN tot ON tf.label = tot.label),
nc AS (SELECT label, count(*) AS n FROM train GROUP BY label),
prior AS (SELECT label, ln(n + 1.0) - ln((SELECT count(*) FROM train) + (SELECT count(*) FROM nc) * 1.0) AS lp
          FROM nc),
tcells AS (SELECT vec_id, label AS actual, unnest(f) AS v, unnest(generate_series(1, len(f))) AS i FROM test),
score AS (SELECT t.vec_id, t.actual, th.label, sum(t.v * th.lt) AS s
          FROM tcells t JOIN theta th ON t.i = th.i GROUP BY t.vec_id, t.actual, th.label),
final AS (SELECT s.vec_id, s.actual, s.label, s.s + p.lp AS score FROM score s JOIN prior p ON s.label = p.label)
SELECT vec_id, actual, label AS predicted FROM final
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC) = 1
"""

KNN_FOLD_PREDICT = _FOLD_PRED + """,
v AS (SELECT qid, fold, tlabel, count(*) AS votes, min(rank) AS best FROM nb GROUP BY qid, fold, tlabel),
top AS (SELECT qid, fold, tlabel, CAST(votes AS BIGINT) AS votes FROM v
        QUALIFY row_number() OVER (PARTITION BY qid ORDER BY votes DESC, best) = 1)
SELECT p.qid, p.fold, p.actual, p.predicted, top.votes FROM pred p JOIN top ON p.qid = top.qid
"""
