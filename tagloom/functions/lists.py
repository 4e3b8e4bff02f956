"""Word lists, lookup tables and limits the results depend on."""

# Words that count as "no label".
INVALID_WORDS = ["nan", "none", "null", "n/a", "na", "unknown"]

# Words left out of token sets.
STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have",
    "in", "is", "it", "of", "on", "or", "the", "to", "with", "without", "unknown",
    "general", "misc", "miscellaneous", "other", "unspecified", "none", "na", "n/a",
    "good", "bad", "poor", "training", "coaching", "clear", "unclear", "tag", "label",
]

# Acronyms kept in capitals by the weekly job, and the longer list of the backfill job.
ACRONYMS_WEEKLY = ["dm", "loa", "ivr", "mpan", "mprn", "tps", "3cx"]
ACRONYMS_BACKFILL = ACRONYMS_WEEKLY + [
    "vat", "dno", "mop", "dc", "hh", "mhhs", "bics", "bsa", "ncc",
]

# Opposite words; a label with one side must not join a label with the other.
OPPOSITES = [
    ("good", "poor"),
    ("clear", "unclear"),
    ("sent", "not sent"),
    ("received", "not received"),
    ("interested", "not interested"),
    ("available", "unavailable"),
    ("answer", "no answer"),
    ("callback", "do not call"),
    ("approved", "rejected"),
    ("agreed", "declined"),
]

# Actor words of the two sides of a call; two-word aliases apart.
AGENT_WORDS = ["agent", "advisor", "adviser", "rep", "representative", "consultant", "salesperson"]
CUSTOMER_WORDS = [
    "customer", "client", "prospect", "lead", "contact", "caller", "gatekeeper", "dm",
]
CUSTOMER_PHRASES = [("decision", "maker"), ("business", "owner")]

# Action words per class, in the order of the class bits 1, 2, 4.
ACTION_WORDS = {
    "rudeness_or_abuse": [
        "abuse", "abused", "abusive", "accuse", "accused", "argue", "argued",
        "aggressive", "aggression", "blame", "blamed", "curse", "cursed", "cussed",
        "hostile", "insult", "insulted", "insulting", "rude", "rudeness",
        "shout", "shouted", "shouting", "swear", "swore", "swearing",
        "threat", "threaten", "threatened", "yell", "yelled", "yelling",
    ],
    "disconnect_or_hangup": [
        "abandon", "abandoned", "cut", "disconnected", "disconnect", "dropped",
        "ended", "hang", "hanged", "hung", "terminate", "terminated",
    ],
    "refusal_or_rejection": [
        "decline", "declined", "reject", "rejected", "refusal", "refuse", "refused",
    ],
}

# Short meaning of each label field, part of the embedding text.
FIELD_MEANING = {
    "call_type": "call type category",
    "call_type_sub": "secondary call type category",
    "main_reason": "main business reason for call",
    "main_reason_sub": "secondary business reason for call",
    "outcome": "call result or commercial outcome",
    "outcome_sub": "secondary call result",
    "tags": "structured call modifier",
    "additional_tags": "free-form business intelligence tag",
    "descriptive_keywords": "search keyword or notable call topic",
    "tone": "customer tone or sentiment",
    "outcome_base": "broad outcome family",
    "call_type_base": "broad call type family",
}
DEFAULT_MEANING = "call classification field"

# Coaching label rules: tier words, direction words, prefixes (first match wins).
TIER_WORDS = [
    ("COMPLIANCE_RISK", ["fraud", "compliance", "deceptive", "time_gaming"]),
    ("PROCESS_DISCIPLINE",
     ["non_business", "personal_call", "audio_quality", "data_quality", "time_management"]),
]
DEFAULT_TIER = "AGENT_SKILL"
DIRECTION_WORDS = [
    ("STRENGTH_DEMONSTRATED", ["good", "training", "clear", "strength"]),
    ("IMPROVEMENT_NEEDED", ["poor", "coaching", "unclear", "weakness"]),
]
DEFAULT_DIRECTION = "NEUTRAL"
COACHING_PREFIXES = [
    "Training_Good_", "Training_Clear_", "Coaching_Poor_", "Coaching_Unclear_",
    "Coaching_", "Training_",
]

# Next-step label rules.
POLARITY_WORDS = [
    ("FORWARD_PROGRESS",
     ["sent", "scheduled", "confirmed", "received", "quote", "proposal", "pending", "closed",
      "date_found"]),
    ("DEAD_END", ["blocked", "do_not_call", "not_interested", "wrong_number", "ivr_failure"]),
    ("HOLDING_PATTERN",
     ["research", "try_later", "internal", "transfer", "admin", "message", "na"]),
]
DEFAULT_POLARITY = "UNKNOWN"

# Label fields of a call row, and those that hold several labels.
LABEL_FIELDS = [
    "call_type", "call_type_sub", "outcome", "outcome_sub", "main_reason", "main_reason_sub",
    "additional_tags", "next_step", "descriptive_keywords", "coaching_tags",
]
MULTI_FIELDS = [
    "call_type_sub", "outcome_sub", "main_reason_sub", "next_step", "additional_tags",
    "descriptive_keywords", "coaching_tags",
]

# Mapper thresholds.
EXISTING_THRESHOLD = 0.82
ANOMALY_THRESHOLD = 0.88
CANDIDATE_THRESHOLD = 0.72
SEMANTIC_MARGIN = 0.015
SAFE_MAP_CLOSE = 0.025
SAFE_MAP_SHARE = 0.80

# Promotion limits: distinct calls, occurrences, weeks.
PROMOTION_LIMITS = {
    "coaching_tags": (3, 5, 2),
    "additional_tags": (20, 50, 2),
}
DEFAULT_PROMOTION = (10, 25, 2)

# Spelling repairs of search queries.
QUERY_REPAIRS = {"agressive": "aggressive", "agression": "aggression"}

# Display names and medoids that say nothing.
GENERIC_NAMES = [
    "other", "misc", "unknown", "n/a", "na", "general", "default", "various", "miscellaneous",
]
WEAK_MEDOIDS = GENERIC_NAMES + ["true", "false", "yes", "no", "null", "undefined", "none"]

# Mapping statuses.
EXISTING = "EXISTING_CLUSTER"
KNOWN_ANOMALY = "KNOWN_TRUE_ANOMALY"
CANDIDATE = "NEW_CLUSTER_CANDIDATE"
TRUE_ANOMALY = "TRUE_ANOMALY"
NO_REFERENCE = "NO_CLUSTER_REFERENCE"
