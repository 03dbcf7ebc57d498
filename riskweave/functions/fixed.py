"""Thresholds, labels, word lists and formats that results must agree on."""

# Monitored features, shared by both loan sources.
PROXY_FEATURES = ["age", "credit_amount", "duration_months", "employment_years", "income_proxy"]

# Columns of the silver tables that are imputed by their median.
MEDIAN_FEATURES = [
    "age", "credit_amount", "duration_months", "employment_years", "income_proxy",
    "debt_to_income_ratio", "financial_stress_index", "credit_to_goods_ratio",
    "employment_to_age_ratio", "ext_source_1", "ext_source_2", "ext_source_3",
]
EXTERNAL_SCORES = ["ext_source_1", "ext_source_2", "ext_source_3"]

# "Not employed" marker in a column of negative days.
EMPLOYMENT_SENTINEL = 365243
DAYS_PER_YEAR = 365.25

# Occupation code to years of employment, and the value for every other code.
JOB_YEARS = {0: 0.0, 1: 2.0, 2: 5.0, 3: 10.0}
JOB_YEARS_DEFAULT = 3.0

# Drift: bins, replacement for an empty share, status thresholds.
PSI_BINS = 10
PSI_EPSILON = 0.0001
PSI_MONITOR = 0.10
PSI_RETRAIN = 0.20
DRIFT_STABLE = "Stable"
DRIFT_MONITOR = "Monitor"
DRIFT_RETRAIN = "Retraining Trigger"

# Training.
TEST_SHARE = 0.20
CHALLENGER_TEST_SHARE = 0.30
SEED = 42
CHALLENGER_SEED = 101
DECISION_THRESHOLD = 0.5
LOGISTIC_PARAMS = {"maxIter": 1000}
FOREST_PARAMS = {"numTrees": 200, "maxDepth": 12, "minInstancesPerNode": 2, "seed": 42}
BOOSTING_PARAMS = {"maxIter": 200, "maxDepth": 8, "stepSize": 0.1, "seed": 42}

# Promotion outcomes.
PROMOTED = "PROMOTED to @Champion"
REJECTED = "REJECTED"

# Risk class of a predicted probability.
RISK_HIGH = "HIGH RISK — Likely Default"
RISK_MEDIUM = "MEDIUM RISK — Monitor"
RISK_LOW = "LOW RISK — Likely Repay"

# Grounding bands.
GROUNDING_WEAK = 0.30
GROUNDING_FAIR = 0.50
IMPACT_BANDS = ["LOW", "MEDIUM", "HIGH", "VERY HIGH"]
REVIEW_FLAGS = {
    "VERY HIGH": "🔴 BLOCK — Legal Review Required",
    "HIGH": "🔴 BLOCK — Senior Underwriter Review",
    "MEDIUM": "🟡 MANUAL REVIEW — Compliance Team",
    "LOW": "🟢 AUTO-APPROVE — Safe to Deploy",
}
EXPOSURES = {
    "VERY HIGH": "₹50L–₹5Cr+ (Regulatory Penalty + License Risk)",
    "HIGH": "₹10L–₹50L (Compliance Violation Fine)",
    "MEDIUM": "₹1L–₹10L (Customer Complaint Escalation)",
    "LOW": "Minimal (Within acceptable risk tolerance)",
}
COMPLIANCE_KEYWORDS = [
    "rbi", "sebi", "regulation", "guideline", "compliance", "mandate", "statutory", "legal",
    "penalty", "violation", "reserve bank", "securities board", "act", "circular",
]

# Verdict markers of a grounding judge, and the outcome of each.
VERDICT_GROUNDED = "[GROUNDED]"
VERDICT_PARTIAL = "[PARTIALLY GROUNDED]"
VERDICT_UNSUPPORTED = "[UNSUPPORTED]"
CLEARANCE_GRANTED = "REGULATORY CLEARANCE GRANTED"
CLEARANCE_MANUAL = "MANUAL UNDERWRITER REVIEW REQUIRED"
CLEARANCE_BLOCKED = "HALLUCINATION FLAG — EXPLANATION BLOCKED"

# Average hallucination risk: alert levels.
ALERT_HIGH = 0.7
ALERT_MODERATE = 0.4

# Text for audit columns whose upstream table is absent.
NO_EXPLANATION = "SHAP not computed"
TEMPLATE_SUFFIX = " [Prototype — per-applicant SHAP pending]"
NOT_SCORED = "Not scored"
NOT_EVALUATED = "Not evaluated"
NO_RETRAINING = "No retraining executed"

# Point score of one what-if scenario.
SCENARIO_HIGH = "HIGH RISK"
SCENARIO_MEDIUM = "MEDIUM RISK"
SCENARIO_LOW = "LOW RISK"
SCENARIO_HIGH_LABEL = "🔴 BLOCK — Senior Underwriter Review"
SCENARIO_MEDIUM_LABEL = "🟡 MANUAL REVIEW — Compliance Team"
SCENARIO_LOW_LABEL = "🟢 AUTO-APPROVE"
SLIDER_AGE = (18, 80, 1)
SLIDER_INCOME = (10_000, 150_000, 5_000)
SLIDER_DURATION = (6, 72, 1)

# Text passages.
MIN_PASSAGE_CHARS = 10
CHUNK_CHARS = 500
CHUNK_OVERLAP = 50
SECTION_PREFIX_CHARS = 80
SECTION_DEFAULT = "GENERAL"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
WHITESPACE = " \t\n\r\x0b\x0c"

# Default English stop words (a parameter wherever it is used).
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "a an the and but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very can will just should now"
).split()
