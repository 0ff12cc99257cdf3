"""DuckDB SQL oracles for the registered queries (driver correctness gate).

Each statement re-derives the bound inputs from the raw test tables with
the rules of ``histwise.sources.testdata`` and then computes the feature from
its definition, by other means than the library where there are any (counts per
pair, lists, joins on positions), in the order ``(timestamp, row_id)``. Floating sums whose order of
addition differs between engines are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

# The lecture kinds (same list as histwise.sources.testdata).
_KINDS = "['concept', 'solving question', 'intention', 'starter']"

PRELUDE = f"""
WITH ev AS (
  SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
), train AS (
  SELECT event_id AS row_id, user_id,
         CAST((epoch_us(ts) // 3600000000) * 3600000 AS BIGINT) AS timestamp,
         k AS content_id,
         CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS content_type_id,
         CASE WHEN event_type = 'signup' THEN -1 WHEN value > 3 * k THEN 1 ELSE 0 END
           AS answered_correctly,
         CASE WHEN (event_id // 10) % 10 = 0 THEN NULL ELSE CAST(epoch_us(ts) % 3600000000 // 1000 AS DOUBLE) END
           AS prior_question_elapsed_time,
         CASE WHEN (event_id // 10) % 10 = 0 THEN NULL ELSE event_type = 'view' END
           AS prior_question_had_explanation
  FROM ev
), questions AS (
  SELECT p_partkey AS question_id, CAST(1 + p_size % 7 AS INTEGER) AS part
  FROM part
), val_row_id AS (
  SELECT event_id AS row_id FROM events WHERE event_id % 10 = 7
), lectures AS (
  SELECT DISTINCT content_id AS lecture_id, CAST(1 + content_id % 7 AS INTEGER) AS part,
         ({_KINDS})[content_id % 4 + 1] AS type_of
  FROM train WHERE content_type_id = 1
), tq AS (
  SELECT t.row_id, t.user_id, t.timestamp, t.content_id, t.answered_correctly, q.part,
         CASE WHEN v.row_id IS NOT NULL THEN 1 ELSE 0 END AS val
  FROM train t
  LEFT JOIN questions q ON t.content_id = q.question_id
  LEFT JOIN val_row_id v ON t.row_id = v.row_id
  WHERE t.content_type_id = 0
), train_full AS (
  SELECT t.row_id, t.user_id, t.timestamp, t.content_type_id,
         l.part AS lecture_part, l.type_of AS lecture_type_of
  FROM train t LEFT JOIN lectures l ON t.content_type_id = 1 AND t.content_id = l.lecture_id
), ranked AS (
  SELECT user_id, content_id, val, answered_correctly,
         row_number() OVER (PARTITION BY user_id, content_id ORDER BY timestamp, row_id) AS rnk
  FROM tq
), acc AS (
  SELECT content_id, AVG(answered_correctly) AS accuracy
  FROM ranked WHERE val = 0 AND rnk = 1 GROUP BY content_id
), wt AS (
  SELECT content_id, accuracy,
         CASE WHEN accuracy = 0 THEN 999.0::DOUBLE ELSE (1 - accuracy) / accuracy END AS weight
  FROM acc
)"""

W_USER = "PARTITION BY user_id ORDER BY timestamp, row_id"
W_PART = "PARTITION BY user_id, part ORDER BY timestamp, row_id"
W_ITEM = "PARTITION BY user_id, content_id ORDER BY timestamp, row_id"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _q(body: str) -> str:
    return PRELUDE + body


def fold() -> str:
    return _q(", f AS (SELECT row_id, val FROM tq) SELECT row_id, val FROM f")


def target() -> str:
    return _q(", f AS (SELECT row_id, answered_correctly FROM tq) SELECT * FROM f")


def label_encoding() -> str:
    return _q("""
, f AS (
  SELECT t.row_id, q.part,
         CASE WHEN t.prior_question_had_explanation IS TRUE THEN 1 ELSE 0 END
           AS prior_question_had_explanation
  FROM train t LEFT JOIN questions q ON t.content_id = q.question_id
  WHERE t.content_type_id = 0)
SELECT * FROM f""")


def numeric_features() -> str:
    return _q(""", f AS (SELECT row_id, prior_question_elapsed_time FROM train
WHERE content_type_id = 0) SELECT * FROM f""")


def _history(frame: str, n: str, s: str, source: str = "tq", weighted: bool = False) -> str:
    if weighted:
        out = ("round(n, 6) AS cumlative_user_appearance, "
               "round(s, 6) AS cumlative_user_corrected_answers, "
               "round(s / NULLIF(n, 0), 6) AS mean_user_accuracy")
    else:
        out = ("CAST(n AS BIGINT) AS cumlative_user_appearance, "
               "CAST(s AS BIGINT) AS cumlative_user_corrected_answers, "
               "CAST(s AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0) AS mean_user_accuracy")
    return _q(f"""
, c AS (
  SELECT row_id, {n} OVER ({frame}) AS n, {s} OVER ({frame}) AS s FROM {source})
, f AS (SELECT row_id, {out} FROM c)
SELECT * FROM f""")


def user_cumulative() -> str:
    return _history(f"{W_USER} {BEFORE}", "SUM(1)", "SUM(answered_correctly)")


def user_cumulative_by_part() -> str:
    return _history(f"{W_PART} {BEFORE}", "SUM(1)", "SUM(answered_correctly)")


def user_by_part_window(width: int) -> str:
    return _history(f"{W_PART} ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING",
                    "SUM(1)", "SUM(answered_correctly)")


def _weighted_source() -> str:
    return "(SELECT t.*, w.weight FROM tq t LEFT JOIN wt w ON t.content_id = w.content_id)"


def user_weighted_window(width: int, by_part: bool) -> str:
    spec = W_PART if by_part else W_USER
    return _history(f"{spec} ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING",
                    "SUM(weight)", "SUM(answered_correctly * weight)",
                    source=_weighted_source(), weighted=True)


def content_first_attempt_accuracy() -> str:
    return _q("""
, f AS (SELECT tq.row_id, acc.accuracy AS mean_content_accuracy
        FROM tq LEFT JOIN acc ON tq.content_id = acc.content_id)
SELECT * FROM f""")


def content_number_of_answers() -> str:
    return _q("""
, agg AS (
  SELECT content_id, COUNT(*) AS answers, COUNT(DISTINCT user_id) AS answered_users,
         COUNT(*) / COUNT(DISTINCT user_id) AS answers_per_user
  FROM tq GROUP BY content_id)
, f AS (
  SELECT tq.row_id, CAST(agg.answers AS BIGINT) AS answers,
         CAST(agg.answered_users AS BIGINT) AS answered_users,
         CAST(agg.answers_per_user AS DOUBLE) AS answers_per_user
  FROM tq LEFT JOIN agg ON tq.content_id = agg.content_id)
SELECT * FROM f""")


def content_number_after_second() -> str:
    """From the number of answers of each user to each item: all but the first come after it."""
    return _q("""
, pair AS (SELECT user_id, content_id, COUNT(*) AS n FROM tq GROUP BY user_id, content_id)
, item AS (
  SELECT content_id, SUM(n) AS n_all, SUM(n - 1) AS n_later,
         COUNT(*) AS u_all, COUNT(*) FILTER (WHERE n > 1) AS u_later
  FROM pair GROUP BY content_id)
SELECT tq.row_id,
       CAST(n_later AS BIGINT) AS answers_after_second_time,
       CAST(u_later AS BIGINT) AS answered_users_after_second_time,
       CAST(n_later AS DOUBLE) / CAST(n_all AS DOUBLE) AS answers_rate_after_second_time,
       CAST(u_later AS DOUBLE) / CAST(u_all AS DOUBLE) AS answered_user_rate_after_second_time,
       CASE WHEN u_later = 0 THEN 0.0::DOUBLE ELSE CAST(n_later AS DOUBLE) / CAST(u_later AS DOUBLE) END
         AS answers_per_user_after_second_time
FROM tq LEFT JOIN item USING (content_id)""")


def user_last_solved() -> str:
    return _q(f"""
, j AS (SELECT tq.*, acc.accuracy FROM tq LEFT JOIN acc ON tq.content_id = acc.content_id)
, f AS (
  SELECT row_id,
         LAG(answered_correctly) OVER w AS prior_answered_correctly,
         CASE WHEN part = (LAG(part) OVER w) THEN 1 ELSE 0 END AS prior_same_part,
         LAG(accuracy) OVER w AS prior_mean_content_accuracy,
         CASE WHEN accuracy = 0 THEN -999.0::DOUBLE
              ELSE ((LAG(accuracy) OVER w) - accuracy) / accuracy END
           AS change_rate_mean_content_accuracy
  FROM j WINDOW w AS ({W_USER}))
SELECT * FROM f""")


_FLAGS = (["is_lecture"] + [f"is_lecture_part_{p}" for p in range(1, 8)]
          + ["is_lecture_type_of_concept", "is_lecture_type_of_solving_question",
             "is_lecture_type_of_intention", "is_lecture_type_of_starter"])


def user_lectured_at_least_once() -> str:
    """A flag is on from the user's first lecture of its kind: compare with that time."""
    kinds = ["concept", "solving question", "intention", "starter"]
    rules = ["TRUE"] + [f"lecture_part = {p}" for p in range(1, 8)] + [f"lecture_type_of = '{k}'" for k in kinds]
    since = [f"MIN(timestamp) FILTER (WHERE {rule}) AS t{i}" for i, rule in enumerate(rules)]
    flags = [f"CAST(COALESCE(s.t{i} <= a.timestamp, FALSE) AS INTEGER) AS {name}" for i, name in enumerate(_FLAGS)]
    return _q(f"""
, since AS (SELECT user_id, {', '.join(since)} FROM train_full WHERE content_type_id = 1 GROUP BY user_id)
SELECT a.row_id, {', '.join(flags)} FROM tq a LEFT JOIN since s ON a.user_id = s.user_id""")


def user_answered_in_past() -> str:
    """From lists: a user's answers to one item in order, with their places among all answers."""
    seq = " + ".join(f"{10.0 ** -i:.9f}::DOUBLE * (CASE WHEN a > {i + 1} THEN ys[a - {i + 1}] ELSE 0 END)" for i in range(10))
    return _q(f"""
, placed AS (SELECT *, row_number() OVER ({W_USER}) AS place FROM tq)
, lists AS (
  SELECT user_id, content_id, list(row_id ORDER BY place) AS ids, list(answered_correctly ORDER BY place) AS ys,
         list(timestamp ORDER BY place) AS ts, list(place ORDER BY place) AS places
  FROM placed GROUP BY user_id, content_id)
, each AS (SELECT *, unnest(range(1, len(ids) + 1)) AS a FROM lists)
, before AS (
  SELECT *, ids[a] AS row_id, CASE WHEN a > 1 THEN ts[a] - ts[a - 1] END AS waited,
         CASE WHEN a > 1 AND places[a - 1] > 1 THEN places[a] - places[a - 1] - 1 END AS others
  FROM each)
SELECT row_id, CAST(a - 1 AS BIGINT) AS number_of_answered_the_sampe_question,
       CASE WHEN a > 1 THEN CAST(list_sum(ys[1:a - 1]) AS DOUBLE) / (a - 1) END AS mean_user_accuracy,
       waited AS diff_timestamp, CAST(others AS BIGINT) AS diff_answers,
       CASE WHEN others = 0 THEN -999.0::DOUBLE ELSE CAST(waited AS DOUBLE) / CAST(others AS DOUBLE) END AS differential,
       {seq} AS seq2vec
FROM before""")


def similarity() -> str:
    return _q(f"""
, emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
, size AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM emb)
, t AS (SELECT row_id, content_id, LAG(content_id, 1) OVER ({W_USER}) AS prior_content_id FROM tq)
SELECT t.row_id,
       round(CASE WHEN p.norm = 0 OR c.norm = 0 THEN -999.0::DOUBLE
            ELSE list_dot_product(p.v, c.v) / p.norm / c.norm END, 6) AS similarity
FROM t LEFT JOIN size c ON t.content_id = c.vec_id LEFT JOIN size p ON t.prior_content_id = p.vec_id""")


def content_posterior(min_support: int) -> str:
    """Each answer is paired with the one before it by its place in the user's answers."""
    return _q(f"""
, placed AS (SELECT *, row_number() OVER ({W_USER}) AS place FROM tq)
, pairs AS (
  SELECT y.row_id, y.content_id, y.answered_correctly AS outcome, x.content_id AS from_item, x.answered_correctly AS from_outcome,
         y.val = 0 AND x.val = 0 AND y.part = x.part AS counts
  FROM placed y LEFT JOIN placed x ON x.user_id = y.user_id AND x.place = y.place - 1)
, share AS (
  SELECT from_outcome, from_item, content_id, SUM(outcome) / COUNT(*) AS share, COUNT(*) AS n
  FROM pairs WHERE counts GROUP BY ALL HAVING n >= {int(min_support)})
SELECT pairs.row_id, share.share AS mean_content_accuracy, CAST(share.n AS BIGINT) AS size
FROM pairs LEFT JOIN share USING (from_outcome, from_item, content_id)""")


# --- composite queries -------------------------------------------------------------------
# (feature class, oracle builder, columns rounded to 6 digits on both sides)
MATRIX_PARTS = [
    ("Fold", fold), ("Target", target),
    ("LabelEncoding", label_encoding), ("NumericFeatures", numeric_features),
    ("UserCumulativeUserInteractions", user_cumulative),
    ("ContentAverageCorrectedAnswers", content_first_attempt_accuracy),
    ("ContentNumberOfAnswers", content_number_of_answers),
    ("ContentNumberOfAnswersAfterSecondTime", content_number_after_second),
    ("UserCumulativeUserInteractionsByPart", user_cumulative_by_part),
    ("UserLastSolvedProblem", user_last_solved),
    ("UserLecturedAtLeastOnce", user_lectured_at_least_once),
    ("UserAnsweredInThePast", user_answered_in_past),
    ("UserLastSolvedProblemSimilarity", similarity),
    ("UserCumulativeUserInteractionsByPartWindowSize100", lambda: user_by_part_window(100)),
    ("UserCumulativeUserInteractionsByPartWeightedWindowSize100",
     lambda: user_weighted_window(100, True)),
    ("UserCumulativeUserInteractionsWeightedWindowSize100",
     lambda: user_weighted_window(100, False)),
    ("ContentAverageCorrectedAnswersPosterior", lambda: content_posterior(100)),
]


def _strip(sql: str) -> str:
    return sql.strip()


def feature_matrix(columns: dict[str, list[str]]) -> str:
    """Join of all feature statements on row_id, columns prefixed ``{Class}_``."""
    parts, sel = [], ["m0.row_id"]
    for i, (name, build) in enumerate(MATRIX_PARTS):
        alias = f"m{i}"
        parts.append(f"({_strip(build())}) AS {alias}" if i == 0 else
                     f"JOIN ({_strip(build())}) AS {alias} ON m0.row_id = {alias}.row_id")
        sel += [f'{alias}."{c}" AS "{name}_{c}"' for c in columns[name]]
    return f"SELECT {', '.join(sel)} FROM " + "\n".join(parts)


def debug_sample(n: int = 10_000) -> str:
    return f"SELECT * FROM ({_strip(user_cumulative())}) AS s ORDER BY row_id LIMIT {int(n)}"


def null_report(matrix_sql: str, cols: list[str]) -> str:
    counts = ", ".join(f'CAST(COUNT(*) - COUNT("{c}") AS BIGINT) AS "{c}"' for c in cols)
    return f"SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, {counts} FROM ({matrix_sql}) AS m"


def column_ranges(matrix_sql: str, cols: list[str]) -> str:
    aggs = ", ".join(f'MIN("{c}") AS "min_{c}", MAX("{c}") AS "max_{c}"' for c in cols)
    return f"SELECT {aggs} FROM ({matrix_sql}) AS m"


def narrow_columns(matrix_sql: str, cols: list[str]) -> str:
    """The smallest type that holds a column's range with strict bounds; without values the type stays."""
    one = """SELECT '{c}' AS column_name, any_value(typeof("{c}")) AS t, MIN("{c}")::DOUBLE AS lo, MAX("{c}")::DOUBLE AS hi FROM m"""
    each = " UNION ALL ".join(one.format(c=c) for c in cols)
    own = "CASE t WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' ELSE 'double' END"
    whole = " ".join(f"WHEN lo > -{2 ** b} AND hi < {2 ** b - 1} THEN '{n}'" for n, b in (("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63)))
    return f"""
WITH m AS ({matrix_sql}), r AS ({each})
SELECT column_name, CASE WHEN t = 'DOUBLE' OR lo IS NULL THEN {own} {whole} ELSE {own} END AS narrow_type,
       CASE WHEN lo IS NULL THEN {own} WHEN t = 'DOUBLE' THEN 'float' {whole} ELSE {own} END AS narrow_type_float32
FROM r"""


def fold_balance() -> str:
    return _q(""", f AS (SELECT val, CAST(COUNT(*) AS BIGINT) AS n_rows,
  CAST(SUM(answered_correctly) AS BIGINT) AS positives FROM tq GROUP BY val) SELECT * FROM f""")


def odds_weight() -> str:
    return _q(", f AS (SELECT content_id, accuracy AS mean_content_accuracy, weight FROM wt) "
              "SELECT * FROM f")


def attempt_number() -> str:
    return _q(f""", f AS (SELECT row_id, CAST(row_number() OVER ({W_ITEM}) AS BIGINT) AS attempt_no
FROM tq) SELECT * FROM f""")


def _scores() -> str:
    """Two deterministic per-row scores standing in for two fold models."""
    return f"""
, a AS (SELECT tq.row_id, tq.answered_correctly AS label, tq.val, acc.accuracy AS score
        FROM tq LEFT JOIN acc ON tq.content_id = acc.content_id)
, b AS (SELECT row_id, answered_correctly AS label, val,
               CAST(SUM(answered_correctly) OVER ({W_USER} {BEFORE}) AS DOUBLE)
               / NULLIF(CAST(SUM(1) OVER ({W_USER} {BEFORE}) AS DOUBLE), 0) AS score FROM tq)"""


def prediction_mean() -> str:
    return _q(_scores() + """
, u AS (SELECT row_id, score FROM a UNION ALL SELECT row_id, score FROM b)
, f AS (SELECT row_id, AVG(score) AS score FROM u GROUP BY row_id)
SELECT * FROM f""")


def auc_exact() -> str:
    return _q(_scores() + """
, s AS (SELECT label AS y, score AS p FROM a WHERE val = 1 AND score IS NOT NULL AND score <> 0)
, g AS (SELECT p, SUM(y) AS pos, SUM(1 - y) AS neg FROM s GROUP BY p)
, c AS (SELECT p, pos, neg,
               COALESCE(SUM(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS below FROM g)
, f AS (SELECT SUM(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0))
                 / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) AS auc,
               CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg FROM c)
SELECT * FROM f""")


def train_test_union() -> str:
    return _q(f"""
, h AS (SELECT row_id, val, prior_question_elapsed_time,
               CAST(SUM(1) OVER ({W_USER} {BEFORE}) AS BIGINT) AS cumlative_user_appearance,
               CAST(SUM(answered_correctly) OVER ({W_USER} {BEFORE}) AS DOUBLE)
               / NULLIF(CAST(SUM(1) OVER ({W_USER} {BEFORE}) AS DOUBLE), 0) AS mean_user_accuracy
        FROM (SELECT tq.*, t.prior_question_elapsed_time FROM tq JOIN train t USING (row_id)))
, f AS (
  SELECT row_id, cumlative_user_appearance, mean_user_accuracy,
         CAST(NULL AS DOUBLE) AS prior_question_elapsed_time, 0 AS target FROM h WHERE val = 0
  UNION ALL
  SELECT row_id, cumlative_user_appearance, CAST(NULL AS DOUBLE) AS mean_user_accuracy,
         prior_question_elapsed_time, 1 AS target FROM h WHERE val = 1)
SELECT * FROM f""")


def top_k(matrix_sql: str, cols: list[str], k: int = 30) -> str:
    per_fold = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, \"Fold_val\" AS fold, CAST(COUNT(\"{c}\") AS DOUBLE) AS value "
        f"FROM m GROUP BY \"Fold_val\"" for c in cols)
    return f"""
WITH m AS ({matrix_sql}), imp AS ({per_fold})
, f0 AS (SELECT feature, value FROM imp WHERE fold = 0)
, f1 AS (SELECT feature, value FROM imp WHERE fold = 1)
SELECT f0.feature, (f0.value + f1.value) / 2.0 AS value
FROM f0 JOIN f1 ON f0.feature = f1.feature
ORDER BY value DESC, feature ASC LIMIT {int(k)}"""
