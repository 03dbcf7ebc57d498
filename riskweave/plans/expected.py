"""Fixed values that results must show, written down for the SQL side only.

The library's own constants are not imported here: a threshold, label or coefficient that is changed there by mistake no
longer agrees with the SQL.
"""

AT = "2026-01-01T00:00:00"
MODEL_VERSION = "scorecard_a/1"

FEATURES = ["age", "credit_amount", "duration_months", "employment_years", "income_proxy"]
EXTERNAL_SCORES = ["ext_source_1", "ext_source_2", "ext_source_3"]
MEDIAN_FEATURES = [
    "age", "credit_amount", "duration_months", "employment_years", "income_proxy",
    "debt_to_income_ratio", "financial_stress_index", "credit_to_goods_ratio", "employment_to_age_ratio",
    "ext_source_1", "ext_source_2", "ext_source_3",
]

# Intercept, then the coefficients in the order of the features.
SCORECARDS = {
    "scorecard_a": (-0.5, dict(zip(FEATURES, [-0.02, 0.000004, 0.005, -0.03, -0.00005]))),
    "scorecard_b": (0.25, dict(zip(FEATURES, [-0.01, -0.000002, 0.002, 0.05, -0.0002]))),
    "scorecard_c": (-1.0, dict(zip(FEATURES, [0.015, 0.000001, -0.01, 0.02, 0.0001]))),
}

RISK_HIGH = "HIGH RISK — Likely Default"
RISK_MEDIUM = "MEDIUM RISK — Monitor"
RISK_LOW = "LOW RISK — Likely Repay"

IMPACT_BANDS = ["LOW", "MEDIUM", "HIGH", "VERY HIGH"]
REVIEW_FLAGS = {
    "LOW": "🟢 AUTO-APPROVE — Safe to Deploy",
    "MEDIUM": "🟡 MANUAL REVIEW — Compliance Team",
    "HIGH": "🔴 BLOCK — Senior Underwriter Review",
    "VERY HIGH": "🔴 BLOCK — Legal Review Required",
}
EXPOSURES = {
    "LOW": "Minimal (Within acceptable risk tolerance)",
    "MEDIUM": "₹1L–₹10L (Customer Complaint Escalation)",
    "HIGH": "₹10L–₹50L (Compliance Violation Fine)",
    "VERY HIGH": "₹50L–₹5Cr+ (Regulatory Penalty + License Risk)",
}

CLEARANCE_GRANTED = "REGULATORY CLEARANCE GRANTED"
CLEARANCE_MANUAL = "MANUAL UNDERWRITER REVIEW REQUIRED"
CLEARANCE_BLOCKED = "HALLUCINATION FLAG — EXPLANATION BLOCKED"

NO_EXPLANATION = "SHAP not computed"
TEMPLATE_SUFFIX = " [Prototype — per-applicant SHAP pending]"
NOT_SCORED = "Not scored"
NOT_EVALUATED = "Not evaluated"

SCENARIO_HIGH_LABEL = "🔴 BLOCK — Senior Underwriter Review"
SCENARIO_MEDIUM_LABEL = "🟡 MANUAL REVIEW — Compliance Team"
SCENARIO_LOW_LABEL = "🟢 AUTO-APPROVE"

DOCUMENT_KEYWORDS = [
    "license", "copyright", "password", "secret", "token", "email", "phone", "warranty", "permission", "act",
]

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "a an the and but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very can will just should now"
).split()

PROMPT_TEMPLATE = """Audit task: decide whether the policy context supports the explanation of a risk score.

EXPLANATION:
"{explanation}"

CONTEXT:
{context}
Answer [GROUNDED] with one sentence of reason when the context clearly supports it, [PARTIALLY GROUNDED] when the \
variables occur but their limits are unclear, [UNSUPPORTED] when the context does not mention them.
"""
