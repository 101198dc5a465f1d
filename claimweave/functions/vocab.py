"""Vocabularies, weights and column lists. All values in this module are fixed values."""

# Legal results. 'null' is a label (no effect found), not a missing value.
RESULT_LABELS = ("positive", "negative", "null", "mixed")

# Other ways of saying a legal result.
RESULT_SYNONYMS = {
    "no effect": "null",
    "no significant effect": "null",
    "not significant": "null",
    "none": "null",
    "inconclusive": "mixed",
}

# Spelling -> study design. Everything else is 'other'.
STUDY_TYPES = {
    "rct": "rct",
    "randomized controlled trial": "rct",
    "randomised controlled trial": "rct",
    "randomized trial": "rct",
    "quasi-experimental": "quasi-experimental",
    "observational": "observational",
    "cohort": "observational",
    "cohort study": "observational",
    "prospective cohort": "observational",
    "retrospective cohort": "observational",
    "case-control": "case-control",
    "case control": "case-control",
    "cross-sectional": "cross-sectional",
    "cross sectional": "cross-sectional",
    "case report": "case report",
}
OTHER_STUDY_TYPE = "other"

# Fixed values: (study_type, weight, evidence_rank).
STUDY_WEIGHTS = (
    ("rct", "1.00", 1),
    ("quasi-experimental", "0.80", 2),
    ("observational", "0.60", 3),
    ("case-control", "0.50", 4),
    ("cross-sectional", "0.45", 5),
    ("case report", "0.30", 6),
    ("other", "0.50", 7),
)

# Weights applied to raw study types, and the weight of any other spelling.
RAW_STUDY_WEIGHTS = {
    "rct": "1.00",
    "randomized controlled trial": "1.00",
    "quasi-experimental": "0.80",
    "observational": "0.60",
    "case-control": "0.50",
    "cross-sectional": "0.45",
    "case report": "0.30",
}
RAW_STUDY_DEFAULT_WEIGHT = "0.50"

# Paper states.
INGEST_STATUSES = ("pending", "processing", "processed", "failed")

# Reject reasons, first match wins.
REJECT_REASONS = (
    "orphan_paper",
    "invalid_result",
    "invalid_confidence",
    "missing_intervention_or_outcome",
)

# Columns behind the row fingerprints, in order.
PAPER_HASH_COLUMNS = (
    "title",
    "source_filename",
    "ingest_status",
    "ingest_error",
    "created_at",
    "is_deleted",
    "canonical_paper_id",
)
CLAIM_HASH_COLUMNS = (
    "paper_id",
    "canonical_paper_id",
    "cluster_id",
    "population",
    "intervention",
    "outcome",
    "result",
    "study_type",
    "confidence",
    "is_deleted",
    "is_duplicate",
)
# Claims of one paper that agree on these report the same finding.
FINDING_COLUMNS = (
    "canonical_paper_id",
    "population",
    "intervention",
    "outcome",
    "result",
    "study_type",
    "is_deleted",
)

SYNTHETIC_PREFIX = "synthetic/"

# Words that make a sentence a claim, and words that decide its direction.
CLAIM_TRIGGERS = ("increase", "improve", "reduction", "decrease", "no significant")
NULL_WORDS = ("no significant",)
MIXED_WORDS = ("mixed",)
NEGATIVE_WORDS = ("decrease", "reduction", "lower")

# Fields of a claim found by the rules, and of the claim that stands for none.
RULE_CLAIM = {
    "population": "adults",
    "intervention": "intervention from paper",
    "outcome": "primary outcome",
    "study_type": "observational",
    "confidence": 0.35,
}
NO_CLAIM = {
    "population": "unknown",
    "intervention": "unspecified intervention",
    "outcome": "unspecified outcome",
    "result": "null",
    "study_type": "observational",
    "confidence": 0.2,
}
# What a model reply means by leaving a field out.
REPLY_DEFAULTS = {
    "population": "unknown",
    "intervention": "unknown",
    "outcome": "unknown",
    "result": "null",
    "study_type": "observational",
    "confidence": 0.5,
}

# Chunking and clustering parameters.
CHUNK_SIZE = 1500
CHUNK_OVERLAP = 200
CLUSTER_THRESHOLD = 0.25
EMBEDDING_SIZE = 256

# Unicode white space, with the four ASCII separators that text libraries also strip.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
