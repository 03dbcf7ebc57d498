"""SQL counterpart of each registered query, on the same parquet tables.

Written apart from the Spark code: medians, quantiles, ranks and areas are computed from full
sorts and window functions here.
"""

from __future__ import annotations

import re

from riskweave.plans import expected
from riskweave.plans.expected import AT, FEATURES

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(text(v) for v in values)


def double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def hexed(expr: str, digits: int) -> str:
    return f"CAST(concat('0x', substr(md5({expr}), 1, {digits})) AS BIGINT)"


def each(pattern: str, names, glue: str = ", ") -> str:
    return glue.join(pattern.replace("@", n) for n in names)


def decimal_round(expr: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal form, as ``round`` on a double works in Spark."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def no_minus_zero(expr: str) -> str:
    return f"CASE WHEN {expr} = 0 THEN CAST(0 AS DOUBLE) ELSE {expr} END"


def margin(model: str) -> str:
    b, weights = expected.SCORECARDS[model]
    return " + ".join([double(b)] + [f"{double(w)} * {f}" for f, w in weights.items()])


def case(expr: str, mapping: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in mapping.items())
    return f"CASE {expr} {arms} ELSE {default} END"


def labelled_auc(source: str) -> str:
    """Mid-rank area under the curve of rows (model, label, score)."""
    return f"""
      SELECT model, round((sum(CASE WHEN label = 1 THEN r END) - any_value(p) * (any_value(p) + 1) / 2.0)
                          / (any_value(p) * (count(*) - any_value(p))), 6) AS roc_auc
      FROM (SELECT *, CAST(sum(label) OVER (PARTITION BY model) AS DOUBLE) AS p,
                   rank() OVER (PARTITION BY model ORDER BY score)
                   + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r
            FROM {source}) ranked
      GROUP BY model"""


def drift_ctes(name: str, base: str, incoming: str, features: list[str]) -> dict[str, str]:
    """CTEs ``<name>_edges`` (feature_name, edges), ``<name>_hist`` and ``<name>_psi``."""
    complete = each("@ IS NOT NULL AND NOT isnan(@)", features, " AND ")
    rows = " UNION ALL ".join(
        f"SELECT {text(f)} AS feature_name, side, CAST({f} AS DOUBLE) AS v FROM sides WHERE {complete}" for f in features
    )
    cols = ", ".join(features)
    probs = ", ".join(str(i / 10) for i in range(11))
    return {
        f"{name}_rows": f"""
          WITH sides AS (SELECT 'e' AS side, {cols} FROM {base} UNION ALL SELECT 'a', {cols} FROM {incoming})
          {rows}""",
        f"{name}_edges": f"""
          SELECT feature_name, CASE WHEN len(d) > 2 THEN d[2:len(d) - 1] ELSE [] END AS edges
          FROM (SELECT feature_name, list_sort(list_distinct(quantile_cont(v, [{probs}]))) AS d
                FROM {name}_rows WHERE side = 'e' GROUP BY 1) q""",
        f"{name}_hist": f"""
          WITH placed AS (
            SELECT r.feature_name, side, len(list_filter(edges, lambda x: x < v)) AS bin
            FROM {name}_rows r JOIN {name}_edges e ON r.feature_name = e.feature_name),
          counted AS (
            SELECT feature_name, bin, count(*) FILTER (WHERE side = 'e') AS ne, count(*) FILTER (WHERE side = 'a') AS na
            FROM placed GROUP BY 1, 2),
          grid AS (SELECT feature_name, unnest(range(0, len(edges) + 1)) AS bin FROM {name}_edges),
          filled AS (
            SELECT g.feature_name, g.bin, coalesce(ne, 0) AS ne, coalesce(na, 0) AS na
            FROM grid g LEFT JOIN counted c ON g.feature_name = c.feature_name AND g.bin = c.bin)
          SELECT feature_name, CAST(bin AS INT) AS bin, CAST(ne AS BIGINT) AS expected_rows, CAST(na AS BIGINT) AS actual_rows,
                 CAST(ne AS DOUBLE) / sum(ne) OVER (PARTITION BY feature_name) AS expected_share,
                 CAST(na AS DOUBLE) / sum(na) OVER (PARTITION BY feature_name) AS actual_share
          FROM filled""",
        f"{name}_psi": f"""
          SELECT feature_name, psi_score,
                 CASE WHEN psi_score < 0.10 THEN 'Stable' WHEN psi_score < 0.20 THEN 'Monitor'
                      ELSE 'Retraining Trigger' END AS drift_status
          FROM (SELECT feature_name, round(sum((a - e) * ln(a / e)), 4) AS psi_score
                FROM (SELECT feature_name, CASE WHEN expected_share = 0 THEN 0.0001 ELSE expected_share END AS e,
                             CASE WHEN actual_share = 0 THEN 0.0001 ELSE actual_share END AS a
                      FROM {name}_hist) s GROUP BY 1) p""",
    }


CTES: dict[str, str] = {
    "home_like": """
      SELECT o.o_orderkey AS SK_ID_CURR,
        CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS TARGET,
        -(6570 + (o.o_custkey * 37) % 15000) AS DAYS_BIRTH,
        CASE WHEN o.o_orderkey % 6 = 0 THEN 365243 ELSE -((o.o_custkey * 13) % 6000) END AS DAYS_EMPLOYED,
        o.o_totalprice AS AMT_CREDIT,
        CASE WHEN o.o_orderkey % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE li.top_price / 12 END AS AMT_ANNUITY,
        c.c_acctbal AS AMT_INCOME_TOTAL,
        li.low_price * 4 AS AMT_GOODS_PRICE,
        CASE WHEN o.o_orderkey % 2 = 0 THEN NULL ELSE (o.o_orderkey % 1000) / CAST(1000 AS DOUBLE) END AS EXT_SOURCE_1,
        CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE (o.o_orderkey % 777) / CAST(777 AS DOUBLE) END AS EXT_SOURCE_2,
        CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE (o.o_orderkey % 333) / CAST(333 AS DOUBLE) END AS EXT_SOURCE_3,
        CASE o.o_orderstatus WHEN 'O' THEN 'M' WHEN 'F' THEN 'F' ELSE 'XNA' END AS CODE_GENDER,
        c.c_mktsegment AS NAME_EDUCATION_TYPE, o.o_orderpriority AS NAME_FAMILY_STATUS,
        CAST(o.o_orderkey % 4 AS INT) AS CNT_CHILDREN
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS top_price, min(l_extendedprice) AS low_price
                 FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o.o_orderkey""",
    "batch_like": """
      SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                           CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS INT) AS VARCHAR))) AS row_key,
        18 + CAST(l_quantity AS INT) AS Age,
        CASE l_returnflag WHEN 'A' THEN 'male' WHEN 'R' THEN 'female' ELSE 'unknown' END AS Sex,
        CAST(l_linenumber % 5 AS INT) AS Job, l_linestatus AS Housing, l_extendedprice / 10 AS Credit_amount,
        CAST(6 * l_linenumber AS INT) AS Duration, l_returnflag AS Purpose
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'""",
    "projected_home": f"""
      SELECT SK_ID_CURR AS applicant_id,
        round(abs(DAYS_BIRTH) / CAST(365.25 AS DOUBLE), 1) AS age,
        AMT_CREDIT AS credit_amount,
        round(AMT_CREDIT / nullif(AMT_ANNUITY, 0), 1) AS duration_months,
        CASE WHEN DAYS_EMPLOYED <> 365243 THEN round(abs(DAYS_EMPLOYED) / CAST(365.25 AS DOUBLE), 1) END AS employment_years,
        AMT_INCOME_TOTAL AS income_proxy,
        round(AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0), 4) AS debt_to_income_ratio,
        {no_minus_zero('round(AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0), 4)')} AS financial_stress_index,
        CASE WHEN AMT_GOODS_PRICE > 0 THEN round(AMT_CREDIT / AMT_GOODS_PRICE, 4) END AS credit_to_goods_ratio,
        CASE WHEN DAYS_EMPLOYED <> 365243 AND abs(DAYS_BIRTH) > 0
             THEN round(CAST(abs(DAYS_EMPLOYED) AS DOUBLE) / abs(DAYS_BIRTH), 4) END AS employment_to_age_ratio,
        EXT_SOURCE_1 AS ext_source_1, EXT_SOURCE_2 AS ext_source_2, EXT_SOURCE_3 AS ext_source_3,
        CASE CODE_GENDER WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'Other' END AS gender,
        NAME_EDUCATION_TYPE AS education_level, NAME_FAMILY_STATUS AS family_status,
        CNT_CHILDREN AS num_children, CAST(TARGET AS INT) AS target, 'home_credit' AS source_dataset
      FROM home_like""",
    "middles": "SELECT "
    + each("list_sort(list(@) FILTER (WHERE @ IS NOT NULL))[CAST(ceil(0.5 * count(@)) AS INT)] AS @", expected.MEDIAN_FEATURES)
    + " FROM projected_home",
    "silver_home": "SELECT p.* REPLACE ("
    + each("coalesce(p.@, m.@) AS @", expected.MEDIAN_FEATURES)
    + ") FROM projected_home p CROSS JOIN middles m WHERE p.target IS NOT NULL AND p.gender <> 'Other'",
    "aligned_batch": f"""
      SELECT {hexed('row_key', 15)} AS applicant_id,
        CAST(Age AS DOUBLE) AS age, Credit_amount AS credit_amount, CAST(Duration AS DOUBLE) AS duration_months,
        CASE Job WHEN 0 THEN CAST(0 AS DOUBLE) WHEN 1 THEN 2 WHEN 2 THEN 5 WHEN 3 THEN 10 ELSE 3 END AS employment_years,
        {decimal_round('Credit_amount / Duration', 2)} AS income_proxy,
        round(CAST(Duration AS DOUBLE) / 12, 4) AS debt_to_income_ratio,
        round(Credit_amount / nullif(Credit_amount / Duration * 12, 0), 4) AS financial_stress_index,
        CAST(1 AS DOUBLE) AS credit_to_goods_ratio,
        round(CASE Job WHEN 0 THEN CAST(0 AS DOUBLE) WHEN 1 THEN 2 WHEN 2 THEN 5 WHEN 3 THEN 10 ELSE 3 END / Age, 4)
          AS employment_to_age_ratio,
        CAST(NULL AS DOUBLE) AS ext_source_1, CAST(NULL AS DOUBLE) AS ext_source_2, CAST(NULL AS DOUBLE) AS ext_source_3,
        CASE Sex WHEN 'male' THEN 'Male' WHEN 'female' THEN 'Female' ELSE 'Other' END AS gender,
        Housing AS education_level, Purpose AS family_status,
        CAST(0 AS INT) AS num_children, CAST(0 AS INT) AS target, 'german_credit' AS source_dataset
      FROM batch_like""",
    "silver_batch": "SELECT * REPLACE ("
    + each("coalesce(@, CAST(0.5 AS DOUBLE)) AS @", expected.EXTERNAL_SCORES)
    + ") FROM aligned_batch WHERE "
    + each("@ IS NOT NULL", [*FEATURES, "target"], " AND "),
    "scored_home": "SELECT *, "
    + ", ".join(f"1 / (1 + exp(-({margin(m)}))) AS {m}" for m in expected.SCORECARDS)
    + " FROM silver_home",
    "scored_batch": "SELECT *, "
    + ", ".join(f"1 / (1 + exp(-({margin(m)}))) AS {m}" for m in expected.SCORECARDS)
    + " FROM silver_batch",
    "missing_scores": f"""
      SELECT 'scorecard_a' AS model, target AS label, 1 / (1 + exp(-({margin('scorecard_a')}))) AS score
      FROM projected_home WHERE applicant_id % 11 <> 0 AND {margin('scorecard_a')} IS NOT NULL""",
    "long_scores": " UNION ALL ".join(
        f"SELECT {text(m)} AS model, target AS label, {m} AS score FROM scored_home" for m in expected.SCORECARDS
    ),
    "class_metrics": """
      SELECT model, round(accuracy, 6) AS accuracy,
             round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
             round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
             round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
      FROM (SELECT model, avg(CASE WHEN (label = 1) = (score > 0.4) THEN 1.0 ELSE 0.0 END) AS accuracy,
                   CAST(count(*) FILTER (WHERE label = 1 AND score > 0.4) AS DOUBLE) AS tp,
                   CAST(count(*) FILTER (WHERE label = 0 AND score > 0.4) AS DOUBLE) AS fp,
                   CAST(count(*) FILTER (WHERE label = 1 AND score <= 0.4) AS DOUBLE) AS fn
            FROM long_scores WHERE label IS NOT NULL AND score IS NOT NULL GROUP BY model) c""",
    "auc": labelled_auc("long_scores"),
    "board": "SELECT c.*, roc_auc FROM class_metrics c JOIN auc USING (model)",
    "gate": f"""
      SELECT {text(AT)} AS timestamp, a.roc_auc AS champion_auc, a.f1 AS champion_f1,
             b.roc_auc AS challenger_auc, b.f1 AS challenger_f1,
             CASE WHEN b.roc_auc > a.roc_auc THEN 'Challenger' ELSE 'Champion' END AS better_model,
             CASE WHEN b.roc_auc > a.roc_auc THEN 'PROMOTED to @Champion' ELSE 'REJECTED' END AS promotion_action
      FROM board a, board b WHERE a.model = 'scorecard_a' AND b.model = 'scorecard_b'""",
    **drift_ctes("silver_drift", "silver_home", "silver_batch", FEATURES),
    "line_base": "SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'",
    "line_incoming": "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'",
    "line_shifted": "SELECT * FROM line_incoming WHERE l_quantity > 10",
    "event_base": "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'",
    "event_incoming": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'",
    **drift_ctes("line_drift", "line_base", "line_incoming", ["l_quantity", "l_extendedprice", "l_discount"]),
    **drift_ctes("shift_drift", "line_base", "line_shifted", ["l_quantity", "l_extendedprice", "l_discount"]),
    **drift_ctes("event_drift", "event_base", "event_incoming", ["value"]),
    "shap": "SELECT s.*, "
    + ", ".join(f"{double(w)} * (s.{f} - m.m_{f}) AS shap_{f}" for f, w in expected.SCORECARDS["scorecard_a"][1].items())
    + " FROM scored_batch s CROSS JOIN (SELECT "
    + each("avg(@) AS m_@", FEATURES)
    + " FROM silver_batch) m",
    "shap_long": " UNION ALL ".join(
        f"SELECT applicant_id, scorecard_a AS score, {i} AS pos, {text(f)} AS feature, shap_{f} AS shap FROM shap"
        for i, f in enumerate(FEATURES)
    ),
    "shap_ranked": """
      SELECT *, row_number() OVER (PARTITION BY applicant_id ORDER BY shap, pos) AS up_from,
             row_number() OVER (PARTITION BY applicant_id ORDER BY shap DESC, pos DESC) AS down_from
      FROM shap_long""",
    "explained": f"""
      SELECT applicant_id, {text(expected.MODEL_VERSION)} AS model_version, score AS total_risk_score,
             up AS top_positive_feature, up_shap AS top_positive_shap, down AS top_negative_feature, down_shap AS top_negative_shap,
             'Risk ' || printf('%.1f%%', score * 100) || ' primarily driven UP by ' || up || ' and driven DOWN by ' || down || '.' AS explanation_summary,
             {text(AT)} AS audit_timestamp
      FROM (SELECT applicant_id, max(score) AS score,
                   max(feature) FILTER (WHERE down_from = 1) AS up, max(shap) FILTER (WHERE down_from = 1) AS up_shap,
                   max(feature) FILTER (WHERE up_from = 1) AS down, max(shap) FILTER (WHERE up_from = 1) AS down_shap
            FROM shap_ranked GROUP BY applicant_id) t""",
    "policy_tf": rf"""
      SELECT item_id, term, CAST(count(*) AS DOUBLE) AS tf
      FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '{expected.TOKEN_PATTERN}')) AS term FROM benchmark) t
      WHERE term NOT IN ({listed(expected.STOP_WORDS)}) GROUP BY 1, 2""",
    "policy_idf": """
      SELECT term, ln((1 + (SELECT count(*) FROM benchmark)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf
      FROM policy_tf GROUP BY term""",
    "policy_weight": """
      SELECT item_id, term, idf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY item_id)) AS weight
      FROM policy_tf JOIN policy_idf USING (term)""",
    "doc_x": rf"""
      SELECT doc_id, term, count(*) * any_value(idf) AS x
      FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{expected.TOKEN_PATTERN}')) AS term FROM documents) t
      JOIN policy_idf USING (term) GROUP BY 1, 2""",
    "doc_sim": """
      SELECT d.doc_id, b.item_id, coalesce(s.sim, 0) AS sim, coalesce(s.dot, 0) AS dot
      FROM documents d CROSS JOIN benchmark b LEFT JOIN (
        SELECT d.doc_id, w.item_id, sum(d.x * w.weight) / any_value(n.len) AS sim, sum(d.x * w.weight) AS dot
        FROM doc_x d JOIN policy_weight w USING (term)
        JOIN (SELECT doc_id, sqrt(sum(x * x)) AS len FROM doc_x GROUP BY 1) n ON n.doc_id = d.doc_id
        GROUP BY 1, 2) s ON s.doc_id = d.doc_id AND s.item_id = b.item_id""",
    "doc_top": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(dot, 9) DESC, item_id) AS rank
                     FROM doc_sim) r WHERE rank <= 2""",
    "grounded": """
      SELECT d.doc_id AS applicant_id, d.text, coalesce(g, 0) AS grounding
      FROM documents d LEFT JOIN (
        SELECT doc_id, sum(sim) / least(2, (SELECT count(*) FROM benchmark)) AS g FROM doc_top GROUP BY 1) t
      ON t.doc_id = d.doc_id""",
    "cost": f"""
      SELECT applicant_id, ml_risk_score, text AS explanation, round(grounding, 4) AS grounding_score,
             round(1 - grounding, 4) AS hallucination_risk,
             CASE WHEN len(hits) > 0 THEN array_to_string(hits, ', ') ELSE 'None' END AS compliance_claims_detected,
             band AS impact_band,
             {case('band', expected.REVIEW_FLAGS, 'NULL')} AS review_flag,
             {case('band', expected.EXPOSURES, text('Unknown'))} AS estimated_financial_exposure,
             {text(AT)} AS audit_timestamp
      FROM (SELECT *, CASE WHEN grounding < 0.30 THEN CASE WHEN len(hits) > 0 THEN 'VERY HIGH' ELSE 'HIGH' END
                           WHEN grounding < 0.50 THEN 'MEDIUM' ELSE 'LOW' END AS band
            FROM (SELECT *, list_filter([{listed(expected.DOCUMENT_KEYWORDS)}], lambda k: contains(lower(text), k)) AS hits,
                         ({hexed('CAST(applicant_id AS VARCHAR)', 13)} % 1000000) / CAST(1000000 AS DOUBLE) AS ml_risk_score
                  FROM grounded) h) b""",
    "audit": f"""
      WITH texts AS (SELECT * FROM explained),
      numbered AS (SELECT applicant_id AS own_id, row_number() OVER (ORDER BY applicant_id) - 1 AS ordinal FROM scored_batch),
      costs AS (SELECT cost.* REPLACE (own_id AS applicant_id) FROM cost JOIN numbered ON cost.applicant_id = ordinal),
      first_text AS (SELECT arg_min(explanation_summary, applicant_id) AS t FROM texts),
      first_cost AS (SELECT arg_min(review_flag, applicant_id) AS r, arg_min(impact_band, applicant_id) AS b FROM costs)
      SELECT s.applicant_id, round(scorecard_a, 4) AS model_prediction,
             CASE WHEN scorecard_a > 0.5 THEN {text(expected.RISK_HIGH)} WHEN scorecard_a > 0.3 THEN {text(expected.RISK_MEDIUM)}
                  ELSE {text(expected.RISK_LOW)} END AS risk_classification,
             coalesce(e.explanation_summary, ft.t || {text(expected.TEMPLATE_SUFFIX)}, {text(expected.NO_EXPLANATION)}) AS shap_summary,
             (SELECT round(avg(psi_score), 4) FROM line_drift_psi) AS drift_score_avg_psi,
             (SELECT promotion_action FROM gate) AS retraining_status,
             coalesce(c.review_flag, fc.r, {text(expected.NOT_EVALUATED)}) AS explanation_label,
             coalesce(c.impact_band, fc.b, {text(expected.NOT_SCORED)}) AS hallucination_cost_band,
             {text(expected.MODEL_VERSION)} AS model_version, {text(AT)} AS timestamp
      FROM scored_batch s LEFT JOIN texts e USING (applicant_id) LEFT JOIN costs c USING (applicant_id)
      CROSS JOIN first_text ft CROSS JOIN first_cost fc""",
    "neighbours": """
      SELECT * FROM (
        SELECT q.vec_id AS query_id, c.vec_id AS passage_id, s AS similarity,
               row_number() OVER (PARTITION BY q.vec_id ORDER BY round(s, 9) DESC, c.vec_id) AS rank
        FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) q
        JOIN (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) c ON q.vec_id <> c.vec_id
        CROSS JOIN LATERAL (SELECT list_cosine_similarity(q.e, c.e) AS s) x) r
      WHERE rank <= 2""",
    "paragraphs": f"""
      SELECT doc_id, CAST(pos AS INT) AS paragraph_id,
             CASE WHEN instr(substr(p, 1, 80), ',') > 0 THEN trim(split_part(p, ',', 1), {WS}) ELSE 'GENERAL' END AS section,
             p AS text, CAST(length(p) AS INT) AS char_count,
             CAST(len(regexp_extract_all(p, '\\S+')) AS INT) AS word_count
      FROM (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS pos
            FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, {WS})),
                                             lambda x: x <> '') AS ps FROM documents) a) b""",
    "scenarios": """
      SELECT SK_ID_CURR AS applicant_id, round(abs(DAYS_BIRTH) / CAST(365.25 AS DOUBLE), 1) AS age,
             abs(AMT_INCOME_TOTAL) * 12 AS income, CAST(SK_ID_CURR % 67 + 6 AS INT) AS duration FROM home_like""",
}


def scenario(source: str) -> str:
    return f"""
      SELECT *, CASE WHEN predicted_risk > 0.65 THEN 'HIGH RISK' WHEN predicted_risk < 0.25 THEN 'LOW RISK'
                     ELSE 'MEDIUM RISK' END AS classification,
             CASE WHEN predicted_risk > 0.65 THEN {text(expected.SCENARIO_HIGH_LABEL)}
                  WHEN predicted_risk < 0.25 THEN {text(expected.SCENARIO_LOW_LABEL)}
                  ELSE {text(expected.SCENARIO_MEDIUM_LABEL)} END AS hallucination_flag,
             'Risk primarily driven UP by loan_duration (+' || printf('%.2f', CAST(duration AS DOUBLE) / 10)
               || ') and driven DOWN by income_proxy' AS shap_summary
      FROM (SELECT *, greatest(CAST(0.01 AS DOUBLE), least(CAST(0.99 AS DOUBLE),
                     CASE WHEN age < 25 THEN CAST(0.35 AS DOUBLE) ELSE CAST(0.20 AS DOUBLE) END
                     + CAST(duration AS DOUBLE) * 1000 / (income + 1) * CAST(0.05 AS DOUBLE))) AS predicted_risk
            FROM ({source}) f) g"""


def missing_rows(source: str, columns: list[str], name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {text(c)} AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS {name} FROM {source}" for c in columns
    )


def filled_rows(source: str, columns: list[str], name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {text(c)} AS column_name, CAST(count({c}) AS BIGINT) AS {name} FROM {source}" for c in columns
    )


HOME_COLUMNS = [
    "SK_ID_CURR", "TARGET", "DAYS_BIRTH", "DAYS_EMPLOYED", "AMT_CREDIT", "AMT_ANNUITY", "AMT_INCOME_TOTAL",
    "AMT_GOODS_PRICE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "CODE_GENDER", "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS", "CNT_CHILDREN",
]
BATCH_COLUMNS = ["row_key", "Age", "Sex", "Job", "Housing", "Credit_amount", "Duration", "Purpose"]
SILVER_COLUMNS = [
    "applicant_id", *expected.MEDIAN_FEATURES, "gender", "education_level", "family_status", "num_children", "target",
    "source_dataset",
]


def spread(side: str, source: str) -> str:
    """Rounded statistics of every monitored feature of one table."""
    return " UNION ALL ".join(
        f"""SELECT {text(f)} AS feature, avg({f}) AS m, round(avg({f}), 3) AS {side}_mean, round(stddev_samp({f}), 3) AS {side}_std,
            round(list_sort(list({f}))[CAST(ceil(0.5 * count({f})) AS INT)], 3) AS {side}_median,
            round(min({f}), 3) AS {side}_min, round(max({f}), 3) AS {side}_max FROM {source}"""
        for f in FEATURES
    )


def contexts(hits: str, key: str, passages: str, passage_key: str) -> str:
    return f"""
      SELECT h.{key} AS query_id,
             string_agg('POLICY MODULE ' || CAST(rank AS VARCHAR) || ':' || chr(10) || p.text || chr(10) || chr(10), '' ORDER BY rank)
               AS context_text
      FROM {hits} h JOIN {passages} p ON p.{passage_key} = h.{'passage_id' if key == 'query_id' else 'item_id'}
      GROUP BY 1"""


GAPPED = [*FEATURES, "ext_source_1", "ext_source_2", "ext_source_3"]
CTES |= {
    "day_bins": """SELECT strftime(ts, '%Y-%m-%d') AS window_start, len(list_filter(edges, lambda x: x < value)) AS bin
      FROM events, event_drift_edges WHERE ts IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)""",
    "boost_rows": " UNION ALL ".join(f"SELECT {text(f)} AS feature, CAST({f} AS DOUBLE) AS v, target AS y FROM projected_home WHERE target IS NOT NULL" for f in GAPPED),
    "boost_edges": """SELECT DISTINCT feature, v AS edge FROM (
        SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) AS r, count(*) OVER (PARTITION BY feature) AS n, max(v) OVER (PARTITION BY feature) AS top
        FROM boost_rows WHERE v IS NOT NULL) o, range(1, 17) s(k) WHERE r = ceil(k * n / 16.0) AND v < top""",
    "boost_sums": """SELECT c.feature, edge, missing_left, g, h, coalesce(CASE WHEN v IS NOT NULL THEN edge IS NULL OR v <= edge END, missing_left) AS is_left
        FROM (SELECT feature, edge FROM boost_edges UNION ALL SELECT DISTINCT feature, CAST(NULL AS DOUBLE) FROM boost_rows) c,
             (VALUES (true), (false)) d(missing_left),
             (SELECT feature, v, CASE WHEN y = 1 THEN lift ELSE 1 END * (0.5 - y) AS g, CASE WHEN y = 1 THEN lift ELSE 1 END * 0.25 AS h
              FROM boost_rows, (SELECT round(CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) / count(*) FILTER (WHERE target = 1), 2) AS lift FROM projected_home) w) b
        WHERE b.feature = c.feature""",
}


def parts(source: str, share: str, seed: str) -> str:
    """Rows of ``source`` (applicant_id, target) with the part that the lowest id hashes of each class form."""
    return f"""
      SELECT applicant_id, target, h <= max(CASE WHEN r <= ceil({share} * n) THEN h END) OVER (PARTITION BY target) AS is_test
      FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY h) AS r, count(*) OVER (PARTITION BY target) AS n
            FROM (SELECT applicant_id, target, {hexed(f"concat_ws('|', CAST(applicant_id AS VARCHAR), '{seed}')", 13)} AS h
                  FROM {source}) a) b"""


CTES |= {
    "home_parts": parts("silver_home", "0.2", "42"),
    "numbered_batch": f"""
      SELECT n.number AS applicant_id, s.credit_amount, s.income_proxy, s.age
      FROM silver_batch s JOIN (SELECT {hexed('row_key', 15)} AS own_id, row_number() OVER (
        ORDER BY Age, Credit_amount, Duration, Housing, Job, Purpose, Sex, row_key) - 1 AS number FROM batch_like) n ON own_id = s.applicant_id""",
    "labelled_batch": f"""
      SELECT applicant_id, CASE WHEN ({hexed("concat_ws('|', CAST(applicant_id AS VARCHAR), '42')", 13)} % 1000000) / CAST(1000000 AS DOUBLE)
               < greatest(0, least(1, credit_amount / (income_proxy + 1) * 0.1 - age * 0.005 + 0.3)) THEN 1 ELSE 0 END AS target
      FROM numbered_batch""",
    "challenger_parts": parts("labelled_batch", "0.3", "101"),
    "chunk_rows": """
      SELECT doc_id, CAST(start / 450 AS INT) AS chunk_no, substr(text, start + 1, 500) AS chunk,
             CAST(doc_id AS VARCHAR) || ':' || CAST(CAST(start / 450 AS INT) AS VARCHAR) AS chunk_id
      FROM (SELECT doc_id, text, CAST(unnest(range(0, greatest(length(text) - 50, 1), 450)) AS INT) AS start FROM documents) c""",
    "chunk_tf": rf"""
      SELECT chunk_id, term, CAST(count(*) AS DOUBLE) AS tf
      FROM (SELECT chunk_id, unnest(regexp_extract_all(lower(chunk), '{expected.TOKEN_PATTERN}')) AS term FROM chunk_rows) t
      WHERE term NOT IN ({listed(expected.STOP_WORDS)}) GROUP BY 1, 2""",
    "chunk_idf": """
      SELECT term, ln((1 + (SELECT count(*) FROM chunk_rows)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM chunk_tf GROUP BY term""",
    "chunk_weight": """
      SELECT chunk_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY chunk_id)) AS weight
      FROM chunk_tf JOIN chunk_idf USING (term)""",
    "item_x": rf"""
      SELECT item_id, term, count(*) * any_value(idf) AS x
      FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '{expected.TOKEN_PATTERN}')) AS term FROM benchmark) t
      JOIN chunk_idf USING (term) GROUP BY 1, 2""",
}


def prompt(template: str) -> str:
    head, rest = template.split("{explanation}")
    middle, tail = rest.split("{context}")
    return " || ".join([text(head), "d.text", text(middle), "coalesce(c.context_text, '')", text(tail)])


BODIES: dict[str, str] = {
    "ingest_paragraphs": "SELECT * FROM paragraphs",
    "paragraph_words": """SELECT CAST(sum(word_count) AS BIGINT) AS sum_word_count, CAST(sum(char_count) AS BIGINT) AS sum_char_count,
      max(paragraph_id) AS max_paragraph_id FROM paragraphs""",
    "csv_roundtrip": "SELECT c_custkey, c_name AS customer_name, c_nationkey, c_acctbal AS account_balance, c_mktsegment FROM customer",
    "json_roundtrip": "SELECT * FROM events",
    "table_roundtrip": "SELECT * FROM supplier",
    "append_history": "SELECT o_orderstatus, count(*) AS order_count, 'run-2' AS run_id, '2026-02-01' AS run_at FROM orders GROUP BY 1",
    "optional_table": "SELECT lang, count(*) AS documents, CAST(0 AS BIGINT) AS reviewed FROM documents GROUP BY 1",
    "evolved_schema": """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice FROM orders""",
    "evolved_union": """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "table_profile": f"SELECT count(*) AS row_count, CAST({len(HOME_COLUMNS)} AS BIGINT) AS column_count FROM home_like",
    "value_counts": "SELECT event_type AS value, count(*) AS row_count FROM events GROUP BY 1",
    "class_share": """SELECT quality AS value, count(*) AS row_count,
      round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM labels) * 100, 2) AS percent FROM labels GROUP BY 1""",
    "null_profile": missing_rows("projected_home", SILVER_COLUMNS, "missing_count"),
    "null_profile_batch": missing_rows("aligned_batch", SILVER_COLUMNS, "missing_count"),
    "describe_stats": " UNION ALL ".join(
        f"""SELECT {text(c)} AS column_name, count({c}) AS value_count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
            CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM home_like"""
        for c in ["AMT_CREDIT", "AMT_ANNUITY", "AMT_INCOME_TOTAL", "DAYS_BIRTH", "EXT_SOURCE_1"]
    ),
    "schema_contract": f"""
      SELECT coalesce(a.column_name, b.column_name) AS column_name, a.column_name IS NOT NULL AS in_left,
             b.column_name IS NOT NULL AS in_right, coalesce(left_values, 0) AS left_values, coalesce(right_values, 0) AS right_values
      FROM ({filled_rows('home_like', HOME_COLUMNS, 'left_values')}) a
      FULL OUTER JOIN ({filled_rows('batch_like', BATCH_COLUMNS, 'right_values')}) b ON a.column_name = b.column_name""",
    "silver_contract": f"""
      SELECT a.column_name, TRUE AS in_left, TRUE AS in_right,
             a.column_name IN ({listed([*FEATURES, 'gender', 'education_level'])}) AS required, left_missing, right_missing
      FROM ({missing_rows('silver_home', SILVER_COLUMNS, 'left_missing')}) a
      JOIN ({missing_rows('silver_batch', SILVER_COLUMNS, 'right_missing')}) b ON a.column_name = b.column_name""",
    "dist_compare": f"""
      SELECT l.* EXCLUDE (m), r.* EXCLUDE (m, feature), round(abs(l.m - r.m), 3) AS mean_change
      FROM ({spread('left', 'silver_home')}) l JOIN ({spread('right', 'silver_batch')}) r ON l.feature = r.feature""",
    "silver_home": "SELECT * FROM projected_home",
    "silver_batch": "SELECT * FROM silver_batch",
    "silver_union": """SELECT source_dataset, gender, count(*) AS row_count, max(credit_amount) AS max_credit, min(age) AS min_age
      FROM (SELECT source_dataset, gender, credit_amount, age FROM silver_home
            UNION ALL SELECT source_dataset, gender, credit_amount, age FROM silver_batch) u GROUP BY 1, 2""",
    "impute_median": f"SELECT applicant_id, {', '.join(expected.MEDIAN_FEATURES)} FROM silver_home",
    "impute_const": "SELECT applicant_id, " + each("coalesce(@, CAST(0.5 AS DOUBLE)) AS @", expected.EXTERNAL_SCORES) + " FROM projected_home",
    "drop_non_finite": """SELECT SK_ID_CURR AS applicant_id, AMT_CREDIT AS credit_amount, round(AMT_CREDIT / AMT_ANNUITY, 4) AS months
      FROM home_like WHERE AMT_CREDIT IS NOT NULL AND AMT_ANNUITY IS NOT NULL AND AMT_ANNUITY <> 0""",
    "gender_crosstab": "SELECT gender, target, count(*) AS row_count FROM projected_home GROUP BY 1, 2",
    "approval_rate": """SELECT gender, count(*) AS total, count(*) FILTER (WHERE target = 0) AS approved,
      round(CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) / count(*) * 100, 2) AS approval_rate_pct FROM projected_home GROUP BY 1""",
    "fairness_gap": """
      SELECT *, round(approval_rate_pct / max(approval_rate_pct) OVER (), 4) AS impact_ratio,
             round(max(approval_rate_pct) OVER () - approval_rate_pct, 2) AS rate_gap_pct
      FROM (SELECT gender, count(*) AS total, count(*) FILTER (WHERE target = 0) AS approved,
              round(CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) / count(*) * 100, 2) AS approval_rate_pct
            FROM projected_home GROUP BY 1) r""",
    "class_ratio": """SELECT count(*) FILTER (WHERE quality = 0) AS negatives, count(*) FILTER (WHERE quality = 1) AS positives,
      round(CAST(count(*) FILTER (WHERE quality = 0) AS DOUBLE) / count(*) FILTER (WHERE quality = 1), 2) AS imbalance_ratio FROM labels""",
    "band_share": " UNION ALL ".join(
        f"""SELECT {text(b)} AS category, count(*) FILTER (WHERE impact_band = {text(b)}) AS row_count, count(*) AS total,
            round(CAST(count(*) FILTER (WHERE impact_band = {text(b)}) AS DOUBLE) / count(*) * 100, 0) AS percent FROM cost"""
        for b in expected.IMPACT_BANDS
    ),
    "alert_level": """
      SELECT round(g, 4) AS avg_grounding, round(h, 4) AS avg_hallucination_risk,
             CASE WHEN h > 0.7 THEN 'ALERT' WHEN h > 0.4 THEN 'NOTICE' ELSE 'HEALTHY' END AS alert_level
      FROM (SELECT avg(grounding_score) AS g, avg(hallucination_risk) AS h FROM cost) a""",
    "latest_event": """SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) x WHERE r = 1""",
    "drift_edges": """SELECT feature_name, CAST(pos - 1 AS INT) AS edge_no, round(edge, 6) AS edge
      FROM (SELECT feature_name, unnest(edges) AS edge, generate_subscripts(edges, 1) AS pos FROM line_drift_edges) e""",
    "drift_hist": """SELECT feature_name, bin, expected_rows, actual_rows, round(expected_share, 6) AS expected_share,
      round(actual_share, 6) AS actual_share FROM line_drift_hist""",
    "drift_psi": "SELECT * FROM silver_drift_psi",
    "drift_psi_lines": "SELECT * FROM line_drift_psi",
    "drift_psi_injected": "SELECT * FROM shift_drift_psi",
    "drift_psi_events": "SELECT * FROM event_drift_psi",
    "drift_stream": """
      SELECT window_start, 'value' AS feature_name, psi_score,
             CASE WHEN psi_score < 0.10 THEN 'Stable' WHEN psi_score < 0.20 THEN 'Monitor' ELSE 'Retraining Trigger' END AS drift_status
      FROM (SELECT window_start, round(sum((a - e) * ln(a / e)), 4) AS psi_score
            FROM (SELECT h.window_start, CASE WHEN expected_share = 0 THEN 0.0001 ELSE expected_share END AS e,
                         CASE WHEN coalesce(n, 0) = 0 THEN 0.0001 ELSE CAST(n AS DOUBLE) / total END AS a
                  FROM (SELECT window_start, total, bin, expected_share
                        FROM (SELECT window_start, count(*) AS total FROM day_bins GROUP BY 1) w, event_drift_hist) h
                  LEFT JOIN (SELECT window_start, bin, count(*) AS n FROM day_bins GROUP BY 1, 2) c
                         ON c.window_start = h.window_start AND c.bin = h.bin) s
            GROUP BY 1) p""",
    "drift_trigger": """SELECT round(avg(psi_score), 4) AS avg_psi, arg_max(feature_name, psi_score) AS max_feature,
      bool_or(drift_status = 'Retraining Trigger') AS retraining_trigger FROM silver_drift_psi""",
    "drift_report": f"""SELECT *, {text(AT)} AS audit_timestamp, 'drift-1' AS run_id, {text(AT)} AS run_at FROM line_drift_psi""",
    "stratified_split": f"""
      SELECT applicant_id, target, h <= max(CASE WHEN r <= ceil(0.2 * n) THEN h END) OVER (PARTITION BY target) AS is_test
      FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY h) AS r, count(*) OVER (PARTITION BY target) AS n
            FROM (SELECT applicant_id, target, {hexed("concat_ws('|', CAST(applicant_id AS VARCHAR), '42')", 13)} AS h
                  FROM projected_home) a) b""",
    "score_applicants": f"""SELECT applicant_id, {each('round(@, 6) AS @', expected.SCORECARDS)},
      CASE WHEN scorecard_a > 0.5 THEN {text(expected.RISK_HIGH)} WHEN scorecard_a > 0.3 THEN {text(expected.RISK_MEDIUM)}
           ELSE {text(expected.RISK_LOW)} END AS risk_classification FROM scored_home""",
    "confusion": """SELECT model, label, CASE WHEN score > 0.4 THEN 1 ELSE 0 END AS predicted, count(*) AS row_count
      FROM long_scores GROUP BY 1, 2, 3""",
    "classification_metrics": "SELECT * FROM class_metrics",
    "roc_auc": "SELECT * FROM auc",
    "roc_auc_missing": labelled_auc("missing_scores"),
    "metrics_missing": """
      SELECT model, round(avg(CASE WHEN hit = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
             round(coalesce(avg(CASE WHEN hit = 1 THEN label END), 0), 6) AS precision,
             round(coalesce(avg(CASE WHEN label = 1 THEN hit END), 0), 6) AS recall,
             round(coalesce(2.0 * sum(hit * label) / nullif(sum(hit) + sum(label), 0), 0), 6) AS f1
      FROM (SELECT model, label, CASE WHEN score > 0.4 THEN 1 ELSE 0 END AS hit FROM missing_scores) m GROUP BY model""",
    "tree_shap_additive": "SELECT applicant_id, true AS additive FROM silver_batch",
    "rerun_history": """SELECT r AS run_id, a AS run_at, count(DISTINCT o_orderpriority) AS row_count, count(*) AS order_count
      FROM orders, (VALUES ('1', '2026-01-01'), ('2', '2026-02-01')) v(r, a) GROUP BY 1, 2""",
    "interventional_additive": "SELECT applicant_id, true AS additive FROM silver_batch",
    "numbered_applicants": """SELECT row_number() OVER (ORDER BY row_key, Age, Sex, Job, Housing, Credit_amount, Duration, Purpose) - 1 AS applicant_id,
      row_key, Age, Credit_amount FROM batch_like""",
    "second_order_additive": "SELECT applicant_id, true AS additive FROM projected_home",
    "second_order_splits": """
      SELECT feature, round(edge, 6) AS edge, missing_left,
             round((gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1)) / 2, 4) AS gain
      FROM (SELECT feature, edge, missing_left, sum(g) FILTER (WHERE is_left) AS gl, sum(h) FILTER (WHERE is_left) AS hl,
                   sum(g) FILTER (WHERE NOT is_left) AS gr, sum(h) FILTER (WHERE NOT is_left) AS hr
            FROM boost_sums GROUP BY 1, 2, 3) t WHERE hl >= 1 AND hr >= 1""",
    "registry_alias": """SELECT CAST(s AS INT) AS step, a AS alias, CAST(v AS INT) AS version FROM (VALUES
      (0, 'Champion', 1), (0, 'Shadow', 1), (1, 'Champion', 2), (1, 'Shadow', 1), (2, 'Champion', 1), (2, 'Shadow', 1),
      (3, 'Champion', 1), (3, 'Shadow', 1), (4, 'Champion', 2), (4, 'Shadow', 1)) t(s, a, v)""",
    "managed_table": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "sketch_rank_error": f"SELECT unnest([{listed(expected.MEDIAN_FEATURES)}]) AS feature, true AS close",
    "sketch_quantiles": """SELECT feature, CAST(p AS DOUBLE) AS probability, n, true AS close
      FROM (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS feature, unnest([count(l_quantity), count(l_extendedprice), count(l_discount)]) AS n FROM lineitem) f,
           (SELECT unnest([0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]) AS p) q""",
    "sketch_by_year": """SELECT year, feature, CAST(p AS DOUBLE) AS probability, n, true AS close
      FROM (SELECT year, unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS feature, unnest([a, b, c]) AS n
            FROM (SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, count(l_quantity) AS a, count(l_extendedprice) AS b, count(l_discount) AS c FROM lineitem GROUP BY 1) y) f,
           (SELECT unnest([0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]) AS p) q""",
    "class_weights": """
      SELECT target, count(*) AS row_count, round(CAST(sum(count(*)) OVER () AS DOUBLE) / (2 * count(*)), 6) AS balanced,
             CASE WHEN target = 1 THEN round(CAST(sum(count(*)) OVER () - count(*) AS DOUBLE) / count(*), 2) ELSE CAST(1 AS DOUBLE) END AS positive_ratio
      FROM silver_home GROUP BY 1""",
    "training_facts": f"""
      SELECT model, fact, true AS holds, count(*) FILTER (WHERE NOT is_test) AS train_rows, count(*) FILTER (WHERE is_test) AS test_rows,
             count(*) FILTER (WHERE is_test AND target = 1) AS test_positives
      FROM home_parts, (SELECT 'logistic' AS model, 'gradient of ' || unnest(['intercept', {listed(FEATURES)}]) AS fact
                        UNION ALL SELECT unnest(['forest', 'boosting']), 'loss under constant') f
      GROUP BY 1, 2""",
    "importance_agrees": f"SELECT unnest([{listed(FEATURES)}]) AS feature, true AS agrees",
    "score_exported": "SELECT applicant_id, true AS logistic, true AS forest, true AS boosting FROM silver_batch",
    "run_log": f"""
      SELECT 'run-1' AS run_id, model, kind, key, value FROM (
        SELECT * FROM (VALUES ('logistic', 'param', 'maxIter', '50'), ('forest', 'param', 'numTrees', '10'), ('forest', 'param', 'maxDepth', '5'),
                              ('boosting', 'param', 'maxIter', '5'), ('boosting', 'param', 'maxDepth', '4')) p(model, kind, key, value)
        UNION ALL
        SELECT model, kind, key, 'true' FROM (SELECT unnest(['logistic', 'forest', 'boosting']) AS model) m,
          (SELECT 'metric' AS kind, unnest(['accuracy', 'precision', 'recall', 'f1', 'roc_auc']) AS key
           UNION ALL SELECT 'importance', unnest([{listed(FEATURES)}])) k) l""",
    "challenger_facts": """
      SELECT count(*) AS test_rows, count(*) FILTER (WHERE target = 1) AS test_positives, true AS auc_agrees, true AS action_follows,
             true AS version_follows FROM challenger_parts WHERE is_test""",
    "lifecycle_tables": """
      SELECT unnest(['projected_home', 'silver_home', 'training_split', 'test_scores', 'silver_batch', 'challenger_split', 'explanations',
                     'hallucination_cost', 'audit_table', 'challenger_scores', 'leaderboard', 'drift_metrics', 'model_comparison']) AS table_name,
             unnest([p, h, h, t, b, b, b, b, b, c, 3, 5, 1]) AS row_count
      FROM (SELECT (SELECT count(*) FROM projected_home) AS p, (SELECT count(*) FROM silver_home) AS h,
                   (SELECT count(*) FROM home_parts WHERE is_test) AS t, (SELECT count(*) FROM silver_batch) AS b,
                   (SELECT count(*) FROM challenger_parts WHERE is_test) AS c) n""",
    "csv_inferred": """
      SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS column_name,
             unnest(['whole number', 'whole number', 'string', 'double', 'timestamp', 'string']) AS data_type,
             unnest([count(o_orderkey), count(o_custkey), count(o_orderstatus), count(o_totalprice), count(o_orderdate), count(o_orderpriority)]) AS filled
      FROM orders""",
    "chunk_topk": """
      SELECT item_id, CAST(rank AS INT) AS rank, doc_id, chunk_no, round(similarity, 4) AS similarity FROM (
        SELECT b.item_id, c.doc_id, c.chunk_no, coalesce(s.sim, 0) AS similarity,
               row_number() OVER (PARTITION BY b.item_id ORDER BY round(coalesce(s.dot, 0), 9) DESC, c.chunk_id) AS rank
        FROM benchmark b CROSS JOIN chunk_rows c LEFT JOIN (
          SELECT q.item_id, w.chunk_id, sum(q.x * w.weight) AS dot, sum(q.x * w.weight) / any_value(n.len) AS sim
          FROM item_x q JOIN chunk_weight w USING (term) JOIN (SELECT item_id, sqrt(sum(x * x)) AS len FROM item_x GROUP BY 1) n ON n.item_id = q.item_id
          GROUP BY 1, 2) s ON s.item_id = b.item_id AND s.chunk_id = c.chunk_id) r
      WHERE rank <= 3""",
    "slider_grid": "SELECT age, income, duration, applicants, round(predicted_risk, 6) AS predicted_risk, classification FROM ("
    + scenario(
        """SELECT g.age, g.income, g.duration, coalesce(n, 0) AS applicants
           FROM (SELECT CAST(a AS INT) AS age, CAST(i AS INT) AS income, CAST(d AS INT) AS duration
                 FROM range(18, 81) x(a), range(10000, 150001, 5000) y(i), range(6, 73) z(d)) g
           LEFT JOIN (SELECT floor(greatest(18, least(80, age))) AS age, count(*) AS n,
                             floor((greatest(10000, least(150000, income)) - 10000) / 5000) * 5000 + 10000 AS income,
                             greatest(6, least(72, duration)) AS duration
                      FROM scenarios GROUP BY 1, 3, 4) s ON s.age = g.age AND s.income = g.income AND s.duration = g.duration"""
    )
    + ") s",
    "roc_auc_ties": labelled_auc(
        "(SELECT 'discount' AS model, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_discount AS score FROM lineitem) s"
    ),
    "leaderboard": """SELECT *, CAST(row_number() OVER (ORDER BY roc_auc DESC, f1 DESC, model) AS INT) AS place,
      row_number() OVER (ORDER BY roc_auc DESC, f1 DESC, model) = 1 AS is_champion FROM board""",
    "promotion_gate": "SELECT * FROM gate",
    "synthetic_labels": f"""
      SELECT applicant_id, round(p, 6) AS label_probability, CASE WHEN u < p THEN 1 ELSE 0 END AS target
      FROM (SELECT applicant_id,
              greatest(0, least(1, credit_amount / (income_proxy + 1) * 0.1 - age * 0.005 + 0.3)) AS p,
              ({hexed("concat_ws('|', CAST(applicant_id AS VARCHAR), '42')", 13)} % 1000000) / CAST(1000000 AS DOUBLE) AS u
            FROM silver_batch) s""",
    "linear_shap": f"SELECT applicant_id, {', '.join(no_minus_zero(f'round(shap_{f}, 6)') + f' AS shap_{f}' for f in FEATURES)} FROM shap",
    "global_importance": "SELECT feature, round(avg(abs(shap)), 6) AS importance FROM shap_long GROUP BY 1",
    "local_drivers": """
      SELECT applicant_id, string_agg(CASE WHEN down_from <= 3 THEN feature END, ',' ORDER BY down_from) AS drivers_up,
             string_agg(CASE WHEN up_from <= 3 THEN feature END, ',' ORDER BY up_from) AS drivers_down
      FROM shap_ranked GROUP BY 1""",
    "explanations": "SELECT * REPLACE ("
    + ", ".join(f"{no_minus_zero(f'round({c}, 6)')} AS {c}" for c in ("total_risk_score", "top_positive_shap", "top_negative_shap"))
    + ") FROM explained",
    "cosine_topk": "SELECT query_id, passage_id, round(similarity, 4) AS similarity, CAST(rank AS INT) AS rank FROM neighbours",
    "ann_recall": """SELECT count(*) AS queries, CAST(sum(least(10, n - 1)) AS BIGINT) AS wanted, true AS recalled
      FROM (SELECT count(*) OVER () AS n FROM embeddings) e""",
    "corpus_passages": f"SELECT doc_id AS passage_id, CAST(length(text) AS INT) AS char_count FROM documents WHERE length(trim(text, {WS})) >= 10",
    "context_blocks": contexts(
        "neighbours", "query_id", f"(SELECT * FROM documents WHERE length(trim(text, {WS})) >= 10)", "doc_id"
    ),
    "prompt_rows": f"""SELECT d.doc_id, {prompt(expected.PROMPT_TEMPLATE)} AS prompt
      FROM documents d LEFT JOIN ({contexts('doc_top', 'doc_id', 'benchmark', 'item_id')}) c ON c.query_id = d.doc_id""",
    "top_passages": "SELECT doc_id, item_id AS passage_id, round(sim, 4) AS similarity, CAST(rank AS INT) AS rank FROM doc_top",
    "pruned_top_passages": "SELECT doc_id, item_id AS passage_id, round(sim, 4) AS similarity, CAST(rank AS INT) AS rank FROM doc_top",
    "pruned_grounding": """SELECT applicant_id, round(grounding, 4) AS grounding_score, round(1 - grounding, 4) AS hallucination_risk
      FROM grounded""",
    "verdicts": f"""
      SELECT applicant_id, CASE WHEN grounding < 0.3 THEN '[UNSUPPORTED]' WHEN grounding < 0.5 THEN '[PARTIALLY GROUNDED]'
               ELSE '[GROUNDED]' END AS verdict, 'rule' AS source,
             CASE WHEN grounding < 0.3 THEN {text(expected.CLEARANCE_BLOCKED)} WHEN grounding < 0.5 THEN {text(expected.CLEARANCE_MANUAL)}
               ELSE {text(expected.CLEARANCE_GRANTED)} END AS clearance
      FROM grounded""",
    "tfidf_weights": "SELECT item_id, term, round(idf, 4) AS idf, round(weight, 4) AS weight FROM policy_weight",
    "grounding_score": """SELECT applicant_id, round(grounding, 4) AS grounding_score, round(1 - grounding, 4) AS hallucination_risk
      FROM grounded""",
    "compliance_hits": f"""
      SELECT conv_id, turn, CASE WHEN len(hits) > 0 THEN array_to_string(hits, ', ') ELSE 'None' END AS claims
      FROM (SELECT conv_id, turn, list_filter([{listed(expected.DOCUMENT_KEYWORDS)}], lambda k: contains(lower(text), k)) AS hits
            FROM (SELECT conv_id, turn, text FROM conversations
                  UNION ALL SELECT doc_id, CAST(-1 AS BIGINT), text FROM documents) t) h""",
    "impact_review": "SELECT * EXCLUDE (explanation) FROM cost",
    "metric_eval": """SELECT round(avg(grounding), 4) AS avg_grounding, round(avg(round(1 - grounding, 4)), 4) AS avg_hallucination_risk
      FROM grounded""",
    "chunk_overlap": f"""
      SELECT doc_id, CAST(start / 450 AS INT) AS chunk_no, substr(text, start + 1, 500) AS chunk
      FROM (SELECT doc_id, text, CAST(unnest(range(0, greatest(length(text) - 50, 1), 450)) AS INT) AS start
            FROM documents) c""",
    "audit_table": "SELECT * FROM audit",
    "audit_upsert": "SELECT * FROM audit",
    "keyed_upsert": """SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) x WHERE r = 1""",
    "latest_audit": "SELECT * FROM audit ORDER BY timestamp DESC, applicant_id LIMIT 50",
    "dashboard_kpis": """
      SELECT count(*) AS total_audited, round(avg(drift_score_avg_psi), 4) AS avg_drift_psi,
             round(count(*) FILTER (WHERE explanation_label LIKE '%BLOCK%') * CAST(100 AS DOUBLE) / count(*), 1) AS hallucination_rate_pct,
             count(*) FILTER (WHERE explanation_label LIKE '%BLOCK%') AS blocks_prevented,
             count(*) FILTER (WHERE hallucination_cost_band = 'VERY HIGH') AS severe_exposures
      FROM audit""",
    "applicant_ordinal": "SELECT applicant_id, row_number() OVER (ORDER BY applicant_id) - 1 AS ordinal FROM silver_batch",
    "badges": """SELECT applicant_id, CASE WHEN explanation_label LIKE '%BLOCK%' THEN 'BLOCKED' WHEN explanation_label LIKE '%MANUAL%'
      THEN 'REVIEW' ELSE 'APPROVED' END AS badge, split_part(risk_classification, '—', 1) AS short_class FROM audit""",
    "context_sentence": """SELECT applicant_id, 'Applicant #' || CAST(applicant_id AS VARCHAR) || ' has Risk: '
      || printf('%.1f%%', model_prediction * 100) || '. Class: ' || risk_classification || '. SHAP: ' || shap_summary
      || '. Label: ' || explanation_label || '.' AS sentence FROM audit""",
    "scenario_score": f"""SELECT applicant_id, round(predicted_risk, 6) AS predicted_risk, classification, hallucination_flag, shap_summary
      FROM ({scenario('SELECT * FROM scenarios')}) s""",
    "scenario_grid": "SELECT * REPLACE (round(predicted_risk, 6) AS predicted_risk) FROM ("
    + scenario(
        """SELECT CAST(floor(greatest(18, least(80, age))) AS INT) AS age,
                  CAST(floor((greatest(10000, least(150000, income)) - 10000) / 5000) * 5000 + 10000 AS INT) AS income,
                  CAST(greatest(6, least(72, duration)) AS INT) AS duration, count(*) AS applicants
           FROM scenarios GROUP BY 1, 2, 3"""
    )
    + ") s",
    "scenario_sweep": "SELECT duration, classification, count(*) AS applicants FROM ("
    + scenario("SELECT age, income, CAST(unnest(range(6, 73)) AS INT) AS duration FROM scenarios")
    + ") s GROUP BY 1, 2",
}


def _uses(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [name for name in CTES if name in words]


def _assemble(body: str) -> str:
    """Prefix the statement with the CTEs it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in _uses(CTES[name]):
            if needed != name:
                visit(needed)
        ordered.append(name)

    for name in _uses(body):
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + f"\n{body}"


ORACLES: dict[str, str] = {name: _assemble(body) for name, body in BODIES.items()}
