"""DuckDB twins of the registered queries (same column names and values).

Written independently of the Spark code, directly as SQL over the driver's
tables; ``sub`` is the subscriber view of ``churnlens.sources.fixture_view``.
"""

from __future__ import annotations

from churnlens.schema import (FIXTURE, TENURE_EDGES_4, TENURE_EDGES_6, TENURE_LABELS_4,
                              TENURE_LABELS_6, VIEW_MEANINGS)
from churnlens.sources.fixture_view import FIXTURE_VIEW_SQL

C = FIXTURE


def with_sub(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH sub AS ({FIXTURE_VIEW_SQL}){extra}\n{body}"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def bin_case(col: str, edges) -> str:
    parts = [f"WHEN {col} > {edges[i - 1]} AND {col} <= {edges[i]} THEN {i}"
             for i in range(1, len(edges))]
    return "CASE " + " ".join(parts) + " END"


def label_case(col: str, labels) -> str:
    parts = [f"WHEN {i + 1} THEN {_q(lab)}" for i, lab in enumerate(labels)]
    return f"CASE {col} " + " ".join(parts) + " END"


def rate_by_bin_sql(edges, labels) -> str:
    return with_sub(f"""
SELECT bin_idx, {label_case('bin_idx', labels)} AS bin_label, count(*) AS n,
       round(avg({C.label}) * 100.0, 6) AS churn_rate
FROM b WHERE bin_idx IS NOT NULL GROUP BY bin_idx ORDER BY bin_idx""",
        f"b AS (SELECT {bin_case(C.tenure, edges)} AS bin_idx, {C.label} FROM sub)")


def rate_by_sql(source: str, columns, label: str, from_cte: str | None = None) -> str:
    unions = "\n  UNION ALL ".join(
        f"SELECT {_q(c)} AS variable, CAST({c} AS VARCHAR) AS level, "
        f"CAST({label} AS DOUBLE) AS y FROM {source}" for c in columns)
    body = """
SELECT variable, level, n, round(s / n * 100.0, 6) AS churn_rate, round(baseline, 6) AS baseline,
       round((s / n * 100.0) / baseline, 6) AS lift
FROM w WHERE level IS NOT NULL ORDER BY variable, churn_rate DESC, level"""
    ctes = [f"long AS ({unions})",
            "g AS (SELECT variable, level, count(*) AS n, sum(y) AS s FROM long GROUP BY variable, level)",
            "w AS (SELECT *, sum(s) OVER (PARTITION BY variable) / sum(n) OVER (PARTITION BY variable)"
            " * 100.0 AS baseline FROM g)"]
    if from_cte:
        ctes.insert(0, from_cte)
    if source == "sub":
        return with_sub(body, *ctes)
    return "WITH " + ",\n".join(ctes) + body


def rint_sql(x: str, digits: int) -> str:
    return f"(round_even(({x}) * {float(10 ** digits)}, 0) / {float(10 ** digits)})"


TEXT_CHARGES_CTE = ("ev AS (SELECT event_id, user_id, event_type, ts, value, props, "
                    "CASE WHEN event_type = 'signup' THEN ' ' ELSE CAST(value AS VARCHAR) END "
                    "AS charges_text FROM events)")
NUM_RE = r"^[+-]?((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?$"
COERCED_CTE = ("evc AS (SELECT event_id, user_id, event_type, "
               f"CASE WHEN regexp_full_match(trim(charges_text), '{NUM_RE}') "
               "THEN TRY_CAST(trim(charges_text) AS DOUBLE) END AS charges FROM ev)")

DESCRIBE_STATS = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


def describe_sql(source: str, columns, ctes=()) -> str:
    parts = []
    for c in columns:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT {_q(c)} AS variable, CAST(count({x}) AS DOUBLE) AS count, "
            f"{rint_sql(f'avg({x})', 2)} AS mean, {rint_sql(f'stddev_samp({x})', 2)} AS std, "
            f"{rint_sql(f'min({x})', 2)} AS min, {rint_sql(f'quantile_cont({x}, 0.25)', 2)} AS p25, "
            f"{rint_sql(f'quantile_cont({x}, 0.5)', 2)} AS p50, "
            f"{rint_sql(f'quantile_cont({x}, 0.75)', 2)} AS p75, {rint_sql(f'max({x})', 2)} AS max "
            f"FROM {source}")
    body = "\nUNION ALL ".join(parts)
    if source == "sub":
        return with_sub(body, *ctes)
    return body


CORR_COLUMNS = [C.tenure, C.monthly, C.total, C.senior, C.label]


def kde_sql(column: str, by: str, points: int = 1000) -> str:
    return with_sub(f"""
SELECT p.cls AS "class", CAST(p.j AS INTEGER) AS point, round(p.x, 9) AS x,
       round(sum(d.w * exp(-0.5 * ((p.x - d.v) / p.h) * ((p.x - d.v) / p.h)))
             / (p.n * p.h * sqrt(2 * pi())), 9) AS density
FROM pts p JOIN d ON d.cls = p.cls
GROUP BY p.cls, p.j, p.x, p.n, p.h""",
        f"s AS (SELECT {by} AS cls, count(*) AS n, min(CAST({column} AS DOUBLE)) AS mn, "
        f"max(CAST({column} AS DOUBLE)) AS mx, stddev_samp(CAST({column} AS DOUBLE)) AS sd "
        f"FROM sub WHERE {column} IS NOT NULL GROUP BY {by})",
        f"g AS (SELECT cls, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS h, mn - 0.5 * (mx - mn) AS lo, "
        f"((mx + 0.5 * (mx - mn)) - (mn - 0.5 * (mx - mn))) / {float(points - 1)} AS step FROM s "
        f"WHERE n > 1 AND sd > 0)",
        f"pts AS (SELECT g.*, t.range AS j, lo + t.range * step AS x FROM g, range({points}) t)",
        f"d AS (SELECT {by} AS cls, CAST({column} AS DOUBLE) AS v, count(*) AS w FROM sub "
        f"WHERE {column} IS NOT NULL GROUP BY {by}, {column})")


# The view's columns as the engine types them.
TYPES_CTE = f"kinds AS (SELECT column_type AS t FROM (DESCRIBE SELECT * FROM ({FIXTURE_VIEW_SQL})))"
N_NUMERIC = "count_if(t IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT', 'FLOAT', 'DOUBLE') OR t LIKE 'DECIMAL%')"


def summary_sql() -> str:
    census = ("SELECT 'census' AS section, 'n_rows' AS item, CAST(count(*) AS DOUBLE) AS value FROM sub"
              "\nUNION ALL SELECT 'census', 'n_columns', CAST(count(*) AS DOUBLE) FROM kinds"
              f"\nUNION ALL SELECT 'census', 'n_numeric', CAST({N_NUMERIC} AS DOUBLE) FROM kinds"
              "\nUNION ALL SELECT 'census', 'n_string', CAST(count_if(t = 'VARCHAR') AS DOUBLE) FROM kinds")
    label = (f"SELECT 'label', {C.label_text} || ':n', CAST(count(*) AS DOUBLE) FROM sub "
             f"GROUP BY {C.label_text}\nUNION ALL SELECT 'label', {C.label_text} || ':pct', "
             f"round({rint_sql('count(*) * 100.0 / sum(count(*)) OVER ()', 1)}, 6) FROM sub "
             f"GROUP BY {C.label_text}")
    desc = "\nUNION ALL ".join(
        f"SELECT 'describe', variable || ':{st}', round({st}, 6) FROM dsc" for st in DESCRIBE_STATS)
    return with_sub(f"{census}\nUNION ALL {label}\nUNION ALL {desc}", TYPES_CTE,
                    "dsc AS (" + describe_sql("sub", [C.tenure, C.monthly, C.total]) + ")")


# Fixed level vocabularies of the driver's tables (for explicit one-hot SQL).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def onehot_sql(col: str, prefix: str, levels) -> list[str]:
    return [f'CAST({col} IS NOT DISTINCT FROM {_q(lv)} AS INTEGER) AS "{prefix}_{lv}"'
            for lv in levels]


ORDERS_LABELLED = ("o AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label "
                   "FROM orders)")
ORDERS_RANKED = ("r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY "
                 "md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) AS rn, "
                 "count(*) OVER (PARTITION BY label) AS n FROM o)")


def standardized_sql() -> str:
    cols = list(C.numeric)
    sel = ", ".join(
        f"round(coalesce((CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} END, 0.0), 6)"
        f" AS {c}" for c in cols)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    return with_sub(f"SELECT {C.key}, {sel} FROM sub, st", f"st AS (SELECT {stats} FROM sub)")


ORACLE = {
    "tenure_rates": rate_by_bin_sql(TENURE_EDGES_6, TENURE_LABELS_6),
    "tenure_rates_4bin": rate_by_bin_sql(TENURE_EDGES_4, TENURE_LABELS_4),
    "contract_rates": rate_by_sql("sub", [C.contract], C.label),
    "multi_column_rates": rate_by_sql("sub", list(C.rate_columns), C.label),
    "lineitem_rates": rate_by_sql(
        "li", ["l_linestatus", "l_discount", "l_tax"], "returned",
        from_cte="li AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS returned, l_linestatus, "
                 "CAST(l_discount AS VARCHAR) AS l_discount, CAST(l_tax AS VARCHAR) AS l_tax "
                 "FROM lineitem)"),
    "overall_rate": with_sub(f"SELECT count(*) AS n, round(avg({C.label}) * 100.0, 6) AS churn_rate "
                             "FROM sub"),
    "rate_summary": with_sub(f"""
SELECT {_q(C.tenure)} AS panel, {label_case('bin_idx', TENURE_LABELS_4)} AS item, bin_idx AS ord,
       count(*) AS n, round(avg({C.label}) * 100.0, 6) AS churn_rate
FROM b WHERE bin_idx IS NOT NULL GROUP BY bin_idx
UNION ALL
SELECT variable AS panel, level AS item,
       CAST(row_number() OVER (PARTITION BY variable ORDER BY s / n DESC, level) AS INTEGER) AS ord,
       n, round(s / n * 100.0, 6) AS churn_rate
FROM g WHERE level IS NOT NULL""",
        f"b AS (SELECT {bin_case(C.tenure, TENURE_EDGES_4)} AS bin_idx, {C.label} FROM sub)",
        "long AS (" + "\n  UNION ALL ".join(
            f"SELECT {_q(c)} AS variable, CAST({c} AS VARCHAR) AS level, "
            f"CAST({C.label} AS DOUBLE) AS y FROM sub" for c in [C.contract, "paperless"]) + ")",
        "g AS (SELECT variable, level, count(*) AS n, sum(y) AS s FROM long GROUP BY variable, level)"),
    "coerce_drop": f"""WITH {TEXT_CHARGES_CTE}, {COERCED_CTE}
SELECT event_id, user_id, charges, CAST(event_type IS NOT DISTINCT FROM 'error' AS INTEGER) AS is_error
FROM evc WHERE charges IS NOT NULL AND NOT isnan(charges)""",
    "missing": f"""WITH {TEXT_CHARGES_CTE}, {COERCED_CTE}, m AS (
  SELECT 'event_id' AS "column", CAST(count_if(event_id IS NULL) AS BIGINT) AS n_missing FROM evc
  UNION ALL SELECT 'user_id', CAST(count_if(user_id IS NULL) AS BIGINT) FROM evc
  UNION ALL SELECT 'event_type', CAST(count_if(event_type IS NULL) AS BIGINT) FROM evc
  UNION ALL SELECT 'charges', CAST(count_if(charges IS NULL OR isnan(charges)) AS BIGINT) FROM evc)
SELECT * FROM m WHERE n_missing > 0""",
    "value_counts": with_sub(f"""
SELECT {C.label_text} AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM sub GROUP BY {C.label_text} ORDER BY n DESC, value"""),
    "describe": describe_sql("sub", [C.tenure, C.monthly, C.total]),
    "describe_lineitem": describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount",
                                                   "l_tax"]),
    "class_means": with_sub(f"SELECT {C.label}, " + ", ".join(
        f"round(avg({c}), 6) AS mean_{c}" for c in C.numeric) + f" FROM sub GROUP BY {C.label}"),
    "census": with_sub("SELECT (SELECT count(*) FROM sub) AS n_rows, CAST(count(*) AS INTEGER) AS n_columns, "
                       f"CAST({N_NUMERIC} AS INTEGER) AS n_numeric, CAST(count_if(t = 'VARCHAR') AS INTEGER) AS n_string "
                       "FROM kinds", TYPES_CTE),
    "summary": summary_sql(),
    "corr_matrix": with_sub("\nUNION ALL ".join(
        f"SELECT {_q(a)} AS x, {_q(b)} AS y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r "
        "FROM sub" for a in CORR_COLUMNS for b in CORR_COLUMNS)),
    "kde_by_class": kde_sql(C.tenure, C.label),
    "one_hot_all": with_sub(f"SELECT {C.key}, " + ", ".join(
        onehot_sql("contract", "contract", SEGMENTS) + onehot_sql("region", "region", REGIONS))
        + " FROM sub"),
    "one_hot_drop_first": with_sub(
        f"SELECT {C.key}, " + ", ".join(
            list(C.numeric)
            + [f"CAST({c} IS NOT DISTINCT FROM 'Yes' AS INTEGER) AS {c}_enc" for c in C.model_flags]
            + ["CAST(priority IS NOT DISTINCT FROM '1-URGENT' AS INTEGER) AS priority_enc"]
            + onehot_sql("contract", "contract", SEGMENTS[1:])
            + onehot_sql("region", "region", REGIONS[1:])) + " FROM sub"),
    "standardized": standardized_sql(),
    "split_exact": f"""WITH {ORDERS_LABELLED}, {ORDERS_RANKED}
SELECT o_orderkey, label, CAST(rn <= ceil(n * 0.2) AS INTEGER) AS is_test FROM r""",
    "split_sizes": f"""WITH {ORDERS_LABELLED}, {ORDERS_RANKED}
SELECT label, CAST(rn <= ceil(n * 0.2) AS INTEGER) AS is_test, count(*) AS n FROM r GROUP BY ALL""",
    "folds": f"""WITH {ORDERS_LABELLED}, {ORDERS_RANKED}
SELECT o_orderkey, label, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM r""",
    "class_weights": f"""WITH {ORDERS_LABELLED}, a AS (
  SELECT count(*) AS n, CAST(count_if(label = 1) AS BIGINT) AS n_pos FROM o)
SELECT n, n_pos, n - n_pos AS n_neg, round((n - n_pos) / n_pos, 6) AS pos_weight,
       round(n / (2.0 * n_pos), 6) AS w_pos, round(n / (2.0 * (n - n_pos)), 6) AS w_neg FROM a""",
}


# --- metrics, segments, explanations on fixed-coefficient scores -----------
FIXED_A = {"intercept": -0.5, "tenure": -1.2, "monthly_charges": 0.4,
           "total_charges": -0.3, "senior": 0.2}
FIXED_B = {"intercept": -0.3, "tenure": -0.8, "monthly_charges": -0.2,
           "total_charges": -0.6, "senior": 0.1}
NUMS = list(C.numeric)


def _logit_sql(coef) -> str:
    out = f"({coef['intercept']})"
    for c in NUMS:
        out = f"({out} + ({coef[c]}) * z_{c})"
    return out


SCORED_CTES = [
    "st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMS)
    + " FROM sub)",
    "z AS (SELECT sub.*, " + ", ".join(
        f"coalesce((CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} END, 0.0) AS z_{c}"
        for c in NUMS) + " FROM sub, st)",
    f"sc1 AS (SELECT *, round(1.0 / (1.0 + exp(-{_logit_sql(FIXED_A)})), 9) AS p_a, "
    f"round(1.0 / (1.0 + exp(-{_logit_sql(FIXED_B)})), 9) AS p_b FROM z)",
    "sc AS (SELECT *, CAST(p_a > 0.5 AS INTEGER) AS pred_a, CAST(p_b > 0.5 AS INTEGER) AS pred_b "
    "FROM sc1)",
]


def scored(body: str, *ctes: str) -> str:
    return with_sub(body, *SCORED_CTES, *ctes)


def auc_sql(src: str, y: str, s: str) -> str:
    return (f"(SELECT sum(CAST(pos AS DOUBLE) * (neg_cum - neg) + CAST(pos AS DOUBLE) * neg * 0.5) "
            f"/ (CAST(sum(pos) AS DOUBLE) * sum(neg)) FROM (SELECT *, sum(neg) OVER (ORDER BY s ROWS "
            f"BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM (SELECT CAST({s} AS DOUBLE) "
            f"AS s, count_if({y} = 1) AS pos, count_if({y} <> 1) AS neg FROM {src} GROUP BY 1)))")


def cells_sql(src: str, y: str, p: str) -> str:
    return (f"SELECT CAST(count_if({y} = 1 AND {p} = 1) AS BIGINT) AS tp, "
            f"CAST(count_if({y} <> 1 AND {p} = 1) AS BIGINT) AS fp, "
            f"CAST(count_if({y} <> 1 AND {p} <> 1) AS BIGINT) AS tn, "
            f"CAST(count_if({y} = 1 AND {p} <> 1) AS BIGINT) AS fn FROM {src}")


def _ratio(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / NULLIF({den}, 0), 0.0)"


METRIC_EXPRS = {
    "accuracy": _ratio("tp + tn", "tp + fp + tn + fn"),
    "precision": _ratio("tp", "tp + fp"),
    "recall": _ratio("tp", "tp + fn"),
    "f1": _ratio("2 * tp", "2 * tp + fp + fn"),
}


def metric_long_sql(name: str, y: str, p: str, s: str) -> str:
    parts = [f"SELECT '{m}' AS metric, {e} AS value FROM ({cells_sql('sc', y, p)})"
             for m, e in METRIC_EXPRS.items()]
    parts.append(f"SELECT 'auc', {auc_sql('sc', y, s)}")
    return "\nUNION ALL ".join(parts)


PROFILE_SELECT = (
    f"SELECT {C.contract}, count(*) AS n, "
    f"{rint_sql(f'avg({C.tenure})', 2)} AS tenure_mean, {rint_sql(f'avg({C.monthly})', 2)} AS monthly_mean, "
    f"{rint_sql(f'avg({C.total})', 2)} AS total_mean, "
    f"{rint_sql(rint_sql(f'avg({C.senior})', 2) + ' * 100.0', 1)} AS senior_pct, "
    f"{rint_sql(rint_sql(f'avg({C.label})', 2) + ' * 100.0', 1)} AS churn_rate "
    f"FROM sub GROUP BY {C.contract}")

LINEAR_SHAP_CTE = "ls AS (" + "\nUNION ALL ".join(
    f"SELECT {C.key}, p_a, '{c}' AS feature, z_{c} AS value, (z_{c} - 0.0) * ({FIXED_A[c]}) AS shap "
    "FROM sc" for c in NUMS) + ")"

ENC_CTE = "enc AS (SELECT " + ", ".join(
    [C.key, C.label] + list(C.numeric)
    + [f"CAST({c} IS NOT DISTINCT FROM 'Yes' AS INTEGER) AS {c}_enc" for c in C.model_flags]
    + ["CAST(priority IS NOT DISTINCT FROM '1-URGENT' AS INTEGER) AS priority_enc"]
    + onehot_sql("contract", "contract", SEGMENTS[1:]) + onehot_sql("region", "region", REGIONS[1:])) + " FROM sub)"
MODEL_FEATURES = (list(C.numeric) + [f"{c}_enc" for c in C.model_flags] + ["priority_enc"]
                  + [f"contract_{x}" for x in SEGMENTS[1:]] + [f"region_{x}" for x in REGIONS[1:]])
FLC_CTE = "flc AS (" + "\nUNION ALL ".join(
    f"SELECT {_q(f)} AS feature, round(corr(CAST({C.label} AS DOUBLE), CAST(\"{f}\" AS DOUBLE)), 9) AS r "
    "FROM enc" for f in MODEL_FEATURES) + ")"


def examples_sql() -> str:
    return scored("""
SELECT 'high' AS kind, customer_id, p_a FROM (
  SELECT * FROM (SELECT customer_id, p_a FROM sc WHERE p_a > 0.8 ORDER BY customer_id LIMIT 1)
  UNION ALL SELECT * FROM (SELECT customer_id, p_a FROM sc ORDER BY p_a DESC, customer_id LIMIT 1)
    WHERE NOT EXISTS (SELECT 1 FROM sc WHERE p_a > 0.8))
UNION ALL
SELECT 'low', customer_id, p_a FROM (
  SELECT * FROM (SELECT customer_id, p_a FROM sc WHERE p_a < 0.2 ORDER BY customer_id LIMIT 1)
  UNION ALL SELECT * FROM (SELECT customer_id, p_a FROM sc ORDER BY p_a, customer_id LIMIT 1)
    WHERE NOT EXISTS (SELECT 1 FROM sc WHERE p_a < 0.2))""")


def impact_sql() -> str:
    d = lambda x: f"CAST({x} AS DOUBLE)"
    return with_sub(f"""
SELECT 'onboarding' AS initiative, n_new AS target, s1 AS saved, round(s1 * (avg_monthly * 12.0), 6) AS revenue FROM v
UNION ALL SELECT 'contract_conversion', n_monthly, s2, round(s2 * (avg_monthly * 12.0), 6) FROM v
UNION ALL SELECT 'addon_trial', n_risk, s3, round(s3 * charge * 12.0, 6) FROM v
UNION ALL SELECT 'total', NULL, s1 + s2 + s3,
  round(s1 * (avg_monthly * 12.0) + s2 * (avg_monthly * 12.0) + s3 * charge * 12.0, 6) FROM v""",
        f"base AS (SELECT count(*) AS n_total, avg({C.monthly}) AS avg_monthly, "
        f"CAST(count_if({C.tenure} <= 12) AS BIGINT) AS n_new, "
        f"CAST(count_if({C.contract} = {_q(C.month_to_month)}) AS BIGINT) AS n_monthly FROM sub)",
        f"seg AS (SELECT {C.contract}, avg({C.label}) AS r, count(*) AS n, avg({C.monthly}) AS charge "
        f"FROM sub GROUP BY {C.contract})",
        "top AS (SELECT n AS n_risk, charge FROM seg ORDER BY r DESC, n DESC LIMIT 1)",
        "v AS (SELECT base.*, top.*, "
        f"CAST(trunc(n_new * {d(0.477)}) AS BIGINT) - CAST(trunc(n_new * {d(0.35)}) AS BIGINT) AS s1, "
        f"CAST(trunc(trunc(n_monthly * {d(0.15)}) * ({d(0.427)} - {d(0.113)})) AS BIGINT) AS s2, "
        f"CAST(trunc(trunc(n_risk * {d(0.2)}) * ({d(0.418)} - {d(0.146)})) AS BIGINT) AS s3 "
        "FROM base, top)")


def silhouette_sql() -> str:
    return """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM e),
cs AS (SELECT label AS c, j, sum(x) AS s FROM x GROUP BY label, j),
cn AS (SELECT label AS c, count(*) AS n FROM e GROUP BY label),
pq AS (SELECT vec_id, label, sum(x * x) AS sq FROM x GROUP BY vec_id, label),
cq AS (SELECT label AS c, sum(sq) AS q FROM pq GROUP BY label),
dots AS (SELECT x.vec_id, cs.c, sum(x.x * cs.s) AS d FROM x JOIN cs ON x.j = cs.j GROUP BY x.vec_id, cs.c),
dist AS (SELECT p.vec_id, p.label, dots.c, cn.n, cn.n * p.sq - 2 * dots.d + cq.q AS tot
         FROM pq p JOIN dots ON p.vec_id = dots.vec_id JOIN cn ON cn.c = dots.c JOIN cq ON cq.c = dots.c),
ab AS (SELECT vec_id, max(CASE WHEN c = label AND n > 1 THEN tot / (n - 1) END) AS a,
              min(CASE WHEN c <> label THEN tot / n END) AS b,
              max(CASE WHEN c = label THEN n END) AS own_n FROM dist GROUP BY vec_id)
SELECT round(avg(CASE WHEN own_n = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab"""


def top_in_row_sql(extra_sel: str, src: str, k: int) -> str:
    return (f"SELECT {C.key}{extra_sel}, CAST(rank AS INTEGER) AS rank, feature, round(value, 6) AS value, "
            f"round(shap9, 6) AS shap FROM (SELECT *, row_number() OVER (PARTITION BY {C.key} ORDER BY "
            f"abs(shap9) DESC, feature) AS rank FROM (SELECT *, round(shap, 9) AS shap9 FROM {src})) "
            f"WHERE rank <= {k}")


def executive_sql() -> str:
    parts = [
        f"SELECT 'churn_share' AS panel, {C.label_text} AS item, "
        f"round({rint_sql('count(*) * 100.0 / sum(count(*)) OVER ()', 1)}, 6) AS value "
        f"FROM sub GROUP BY {C.label_text}",
        f"SELECT 'tenure', {label_case('bin_idx', TENURE_LABELS_4)}, round(avg({C.label}) * 100.0, 6) "
        "FROM b WHERE bin_idx IS NOT NULL GROUP BY bin_idx",
        f"SELECT 'contract', {C.contract}, round(avg({C.label}) * 100.0, 6) FROM sub GROUP BY {C.contract}",
        "SELECT 'model', model || ':' || metric, round(value, 6) FROM ml WHERE metric IN ('auc', 'f1')",
        "SELECT 'shap', feature, round(avg(abs(shap)), 6) FROM ls GROUP BY feature",
        f"SELECT 'segment', {C.contract}, round(churn_rate, 6) FROM "
        f"({PROFILE_SELECT} ORDER BY churn_rate DESC, n DESC, {C.contract} LIMIT 5)",
    ]
    return scored("\nUNION ALL ".join(parts),
                  f"b AS (SELECT {bin_case(C.tenure, TENURE_EDGES_4)} AS bin_idx, {C.label} FROM sub)",
                  "ml AS (SELECT 'a' AS model, * FROM (" + metric_long_sql("a", C.label, "pred_a", "p_a")
                  + ") UNION ALL SELECT 'b', * FROM (" + metric_long_sql("b", C.label, "pred_b", "p_b")
                  + "))",
                  LINEAR_SHAP_CTE)


ORACLE.update({
    "confusion": scored("\nUNION ALL ".join(
        f"SELECT {a} AS actual, {p} AS predicted, CAST(count_if({C.label} = {a} AND pred_a = {p}) AS BIGINT)"
        f" AS n FROM sc" for a in (0, 1) for p in (0, 1))),
    "metrics_fixed": scored("SELECT " + ", ".join(f"round({e}, 6) AS {m}" for m, e in METRIC_EXPRS.items())
                            + f" FROM ({cells_sql('sc', C.label, 'pred_a')})"),
    "auc_fixed": scored(f"SELECT 'a' AS model, round({auc_sql('sc', C.label, 'p_a')}, 6) AS auc "
                        f"UNION ALL SELECT 'b', round({auc_sql('sc', C.label, 'p_b')}, 6)"),
    "auc_lineitem": "WITH li AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount FROM lineitem) "
                    f"SELECT round({auc_sql('li', 'y', 'l_discount')}, 6) AS auc",
    "roc_fixed": scored("""
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT s, round(neg_cum / N, 6), round(pos_cum / P, 6) FROM c, tot""",
        f"g AS (SELECT p_a AS s, count_if({C.label} = 1) AS pos, count_if({C.label} <> 1) AS neg "
        "FROM sc GROUP BY p_a)",
        "c AS (SELECT s, sum(pos) OVER w AS pos_cum, sum(neg) OVER w AS neg_cum FROM g "
        "WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
        "tot AS (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM g)"),
    "model_compare": scored("""
SELECT a.metric, round(a.value, 6) AS value_a, round(b.value, 6) AS value_b,
       round(b.value - a.value, 6) AS delta FROM ma a JOIN mb b ON a.metric = b.metric
UNION ALL SELECT 'keep_linear', NULL, NULL,
       CAST(abs(b.value - a.value) < 0.02 AS DOUBLE) FROM ma a JOIN mb b ON a.metric = b.metric
       WHERE a.metric = 'auc'""",
        "ma AS (" + metric_long_sql("a", C.label, "pred_a", "p_a") + ")",
        "mb AS (" + metric_long_sql("b", C.label, "pred_b", "p_b") + ")"),
    "calibration": scored(f"""
SELECT {C.contract}, n, actual_rate, predicted_prob, {rint_sql('actual_rate * 100.0', 1)} AS actual_pct,
       {rint_sql('predicted_prob * 100.0', 1)} AS predicted_pct
FROM (SELECT {C.contract}, count(*) AS n, {rint_sql(f'avg({C.label})', 3)} AS actual_rate,
             {rint_sql('avg(p_a)', 3)} AS predicted_prob FROM sc GROUP BY {C.contract})"""),
    "segment_profile": with_sub(PROFILE_SELECT),
    "segment_crosstab": with_sub(
        f"SELECT {C.contract}, " + ", ".join(
            [f'"{r}" AS "n_{r}"' for r in REGIONS]
            + [f'{rint_sql(f"\"{r}\" * 100.0 / tot", 1)} AS "pct_{r}"' for r in REGIONS])
        + " FROM (SELECT *, " + " + ".join(f'"{r}"' for r in REGIONS) + " AS tot FROM ("
        f"SELECT {C.contract}, " + ", ".join(
            f"CAST(count_if(region = {_q(r)}) AS BIGINT) AS \"{r}\"" for r in REGIONS)
        + f" FROM sub GROUP BY {C.contract}))"),
    "personas": with_sub(f"""
SELECT {C.contract}, n, churn_rate,
  CASE WHEN churn_rate > 40.0 THEN 'High Risk' WHEN churn_rate > 20.0 THEN 'Medium Risk' ELSE 'Low Risk' END
    AS persona,
  CASE WHEN churn_rate > 40.0 THEN 'Strengthen onboarding and early-tenure care'
       WHEN churn_rate > 20.0 THEN 'Offer annual-payment discount and retention offer'
       ELSE 'Loyalty programme and add-on upselling' END AS action
FROM ({PROFILE_SELECT})"""),
    "segment_ids": with_sub(f"""
SELECT s.{C.key}, s.{C.contract}, CAST(m.segment_id AS INTEGER) AS segment_id
FROM sub s JOIN (SELECT {C.contract}, row_number() OVER (ORDER BY avg({C.label}) DESC, count(*) DESC,
  {C.contract}) AS segment_id FROM sub GROUP BY {C.contract}) m ON s.{C.contract} = m.{C.contract}"""),
    "silhouette_fixed": silhouette_sql(),
    "linear_shap": scored(f"SELECT {C.key}, feature, round(value, 6) AS value, round(shap, 6) AS shap "
                          "FROM ls", LINEAR_SHAP_CTE),
    "shap_importance": scored("SELECT feature, round(avg(abs(shap)), 6) AS mean_abs_shap FROM ls "
                              "GROUP BY feature", LINEAR_SHAP_CTE),
    "top_features_named": scored(
        "SELECT CAST(row_number() OVER (ORDER BY mean_abs_shap DESC, feature) AS INTEGER) AS rank, feature, mean_abs_shap, "
        "CASE feature " + " ".join(f"WHEN {_q(f)} THEN {_q(m)}" for f, m in VIEW_MEANINGS.items()) + " ELSE '' END AS meaning "
        "FROM (SELECT feature, round(avg(abs(shap)), 6) AS mean_abs_shap FROM ls GROUP BY feature) "
        "QUALIFY rank <= 3", LINEAR_SHAP_CTE),
    "shap_cloud": scored(f"SELECT {C.key}, feature, round(value, 6) AS value, round(shap, 6) AS shap "
                         "FROM ls WHERE feature IN (SELECT feature FROM ls GROUP BY feature "
                         "ORDER BY avg(abs(shap)) DESC, feature LIMIT 2)", LINEAR_SHAP_CTE),
    "top_features": scored(top_in_row_sql("", "ls", 3), LINEAR_SHAP_CTE),
    "examples": examples_sql(),
    "explain_examples": scored(
        top_in_row_sql(", kind", "(SELECT ls.*, ex.kind FROM ls JOIN ex ON ls.customer_id = ex.customer_id)",
                       4),
        LINEAR_SHAP_CTE,
        "ex AS (SELECT 'high' AS kind, customer_id FROM (SELECT * FROM (SELECT customer_id "
        "FROM sc WHERE p_a > 0.8 ORDER BY customer_id LIMIT 1) UNION ALL SELECT * FROM (SELECT customer_id "
        "FROM sc ORDER BY p_a DESC, customer_id LIMIT 1) WHERE NOT EXISTS (SELECT 1 FROM sc WHERE p_a > 0.8)) "
        "UNION ALL SELECT 'low', customer_id FROM (SELECT * FROM (SELECT customer_id FROM sc WHERE p_a < 0.2 "
        "ORDER BY customer_id LIMIT 1) UNION ALL SELECT * FROM (SELECT customer_id FROM sc ORDER BY p_a, "
        "customer_id LIMIT 1) WHERE NOT EXISTS (SELECT 1 FROM sc WHERE p_a < 0.2)))"),
    "top_abs": with_sub("SELECT feature, r FROM flc ORDER BY abs(r) DESC, feature LIMIT 10", ENC_CTE, FLC_CTE),
    "top_signed": with_sub("""
SELECT * FROM (SELECT feature, r, 'positive' AS sign FROM flc WHERE r > 0 ORDER BY r DESC, feature LIMIT 5)
UNION ALL SELECT * FROM (SELECT feature, r, 'negative' FROM flc WHERE r < 0 ORDER BY r, feature LIMIT 5)""",
                           ENC_CTE, FLC_CTE),
    "impact": impact_sql(),
    "executive_summary": executive_sql(),
})


ORACLE["describe_merged"] = ORACLE["describe_lineitem"]
ORACLE["report_round_trip"] = ORACLE["contract_rates"]
ORACLE["kde_binned_check"] = with_sub(
    f"SELECT {C.label} AS class, CAST(1000 AS BIGINT) AS n_points, CAST(0 AS BIGINT) AS n_off, TRUE AS error_small "
    f"FROM sub GROUP BY {C.label}")

# --- invariants of fitted models, computed from the tables -------------------
TEST_ROWS = ("SELECT churn_binary, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n FROM sub GROUP BY churn_binary")
LEVEL_NAMES = (
    "SELECT 'contract_' || contract AS f FROM (SELECT DISTINCT contract FROM sub) "
    "WHERE contract > (SELECT min(contract) FROM sub) "
    "UNION ALL SELECT 'region_' || region FROM (SELECT DISTINCT region FROM sub) "
    "WHERE region > (SELECT min(region) FROM sub)")
FEATURE_NAMES = (" UNION ALL ".join(f"SELECT {_q(n)} AS f" for n in (
    *C.numeric, *(f"{c}_enc" for c in C.model_flags), *(f"{c}_enc" for c, _ in C.model_equals)))
    + " UNION ALL " + LEVEL_NAMES)

ORACLE.update({
    "renamed": "SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS price FROM orders",
    "flag_shares": with_sub(" UNION ALL ".join(
        f"SELECT '{c}_enc' AS flag, round(avg(CAST({c} = 'Yes' AS INTEGER)), 6) AS share FROM sub" for c in C.model_flags)),
    "csv_rejects": with_sub(f"""
SELECT 'good' AS kind, NULL::VARCHAR AS "column", count(*) AS n, round(sum({C.monthly}), 2) AS monthly,
       CAST(sum({C.key}) AS BIGINT) AS keys
FROM sub WHERE {C.key} % 7 <> 0 AND {C.key} % 11 <> 0 AND {C.key} % 13 <> 0
UNION ALL SELECT 'number of fields', NULL, count(*), NULL, NULL FROM sub WHERE {C.key} % 13 = 0
UNION ALL SELECT 'not double', '{C.tenure}', count(*), NULL, NULL FROM sub WHERE {C.key} % 7 = 0 AND {C.key} % 13 <> 0
UNION ALL SELECT 'not double', '{C.monthly}', count(*), NULL, NULL FROM sub WHERE {C.key} % 11 = 0 AND {C.key} % 13 <> 0"""),
    "resumed_check": with_sub(f"SELECT CAST(sum(n) AS BIGINT) AS n_scored, CAST(0 AS BIGINT) AS n_scores_off, "
                              "(SELECT count(*) FROM sub) AS n_segmented, CAST(0 AS BIGINT) AS n_segments_off, "
                              f"CAST(3 AS BIGINT) AS n_skipped, CAST(2 AS BIGINT) AS n_resumed FROM ({TEST_ROWS})"),
    "kmeans_check": "SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_clusters, TRUE AS inertia_holds, "
                    "CAST(0 AS BIGINT) AS n_off_mean FROM embeddings",
    "silhouette_euclid": """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
                  row_number() OVER (PARTITION BY label ORDER BY md5(vec_id || ':42'), vec_id) AS place FROM embeddings),
r AS (SELECT * FROM e WHERE place <= 32),
m AS (SELECT e.vec_id, e.label, r.label AS other, avg(list_distance(e.v, r.v)) AS d
      FROM e JOIN r ON e.vec_id <> r.vec_id GROUP BY e.vec_id, e.label, r.label),
s AS (SELECT vec_id, max(CASE WHEN other = label THEN d END) AS a, min(CASE WHEN other <> label THEN d END) AS b
      FROM m GROUP BY vec_id)
SELECT (SELECT count(*) FROM e) AS n, (SELECT count(*) FROM r) AS n_references,
       round(sum(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END)
             / (SELECT count(*) FROM e), 6) AS silhouette FROM s""",
    "pca_check": "SELECT count(*) AS n_rows, 0.0::DOUBLE AS mean_1, 0.0::DOUBLE AS mean_2, 0.0::DOUBLE AS covariance, "
                 "0.0::DOUBLE AS share_1_off, 0.0::DOUBLE AS share_2_off FROM embeddings",
    "segments_check": with_sub("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_without, CAST(0 AS BIGINT) AS "
                               "n_out_of_order, CAST(1 AS BIGINT) AS n_best, CAST(7 AS BIGINT) AS n_k, "
                               "CAST(0 AS BIGINT) AS k_off FROM sub"),
    "attached_check": with_sub("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_off, TRUE AS duplicate_refused FROM sub"),
    "segment_risk_check": with_sub("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_range FROM sub"),
    "logistic_gradient": with_sub("SELECT model, f AS feature, 0.0::DOUBLE AS gradient FROM "
                                  "(SELECT 'baseline' AS model UNION ALL SELECT 'ridge'), "
                                  f"(SELECT '(intercept)' AS f UNION ALL {FEATURE_NAMES})"),
    "test_scores_check": with_sub("SELECT model, churn_binary, n, CAST(0 AS BIGINT) AS n_bad FROM "
                                  "(SELECT 'baseline' AS model UNION ALL SELECT 'ridge' UNION ALL SELECT 'gbt'), "
                                  f"({TEST_ROWS})"),
    "shap_check": with_sub("SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_off, "
                           f"any_value(m) AS f_min, any_value(m) AS f_max FROM ({TEST_ROWS}), "
                           f"(SELECT count(*) AS m FROM ({FEATURE_NAMES}))"),
    # training rows of a class are dealt round-robin, so fold f has ceil((n - f) / 5) of them
    "cv_check": with_sub("SELECT model, CAST(fold AS INTEGER) AS fold, CAST(sum(ceil((n - fold) / 5)) AS BIGINT) AS n, "
                         "TRUE AS auc_holds, TRUE AS beyond_chance FROM (SELECT 'baseline' AS model UNION ALL SELECT 'ridge' "
                         "UNION ALL SELECT 'gbt'), (SELECT count(*) - ceil(count(*) * 0.2) AS n FROM sub GROUP BY churn_binary), "
                         "range(0, 5) AS r(fold) GROUP BY model, fold"),
    "test_auc_check": with_sub("SELECT model, CAST(sum(n) AS BIGINT) AS n, TRUE AS beyond_chance FROM "
                               "(SELECT 'baseline' AS model UNION ALL SELECT 'ridge' UNION ALL SELECT 'gbt'), "
                               f"({TEST_ROWS}) GROUP BY model"),
})
