"""Values that the results depend on: patterns, word lists, column lists, limits.

FIXED VALUES. Everything in this module is data the jobs must share with the
systems that read their output; the logic that uses it lives elsewhere.
"""

from __future__ import annotations

from datetime import date

# --- personal-data detector: category -> (pattern, ignore case), in detector order
PII_PATTERNS: dict[str, tuple[str, bool]] = {
    "email": (
        r"(?<![A-Z0-9.!#$%&'*+/=?^_`{|}~-])"
        r"[A-Z0-9](?:[A-Z0-9.!#$%&'*+/=?^_`{|}~-]{0,62}[A-Z0-9])?"
        r"@(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,63}(?![A-Z0-9-])",
        True,
    ),
    "fr_phone": (r"(?<!\d)(?:\+33|0033|0)\s*[1-9](?:[\s.-]*\d{2}){4}(?!\d)", False),
    "ipv4": (r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b", False),
    "url": (r"\b(?:https?://|www\.)[^\s<>'\"]+", True),
    "obvious_identifier": (
        r"\b(?:agent_id|user_id|client_id|customer_id|account_id|identifiant|login|username)\b"
        r"\s*[:=#-]?\s*[A-Z0-9._@-]{3,}",
        True,
    ),
}

PII_REPLACEMENTS: dict[str, str] = {
    "email": "[EMAIL]",
    "fr_phone": "[PHONE]",
    "ipv4": "[IP]",
    "url": "[URL]",
    "obvious_identifier": "[IDENTIFIER]",
}

# --- secret detector: (pattern, ignore case)
SECRET_PATTERNS: tuple[tuple[str, bool], ...] = (
    (r"\b(?:api[_-]?key|secret|token|password|passwd|pwd)\b\s*[:=]", True),
    (r"\b[A-Za-z0-9_=-]{32,}\b", False),
    (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", False),
)

# --- provider text clean-up (all ignore case)
HTML_TAG_PATTERN = r"</?[A-Z][^>]*>"
BRACKETED_EMAIL_PATTERN = r"<\s*(\[EMAIL\])\s*>"
MAILTO_EMAIL_PATTERN = r"\bmailto:\s*(\[EMAIL\])"

# --- diagnostic patterns of the quality report (ignore case; \b where SQL writes \m and \M)
HEURISTIC_PATTERNS: tuple[str, ...] = (
    r"[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}",
    r"(\+?[0-9][0-9 .()/-]{7,}[0-9])",
    r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
)

KNOWN_PLACEHOLDERS: tuple[str, ...] = ("[EMAIL]", "[PHONE]", "[URL]", "[IP]", "[IDENTIFIER]")

# --- provider payload field names, in order of preference
PAGE_CONTAINERS = ("tickets", "results", "data", "items")
ID_FIELDS = ("id", "ticket_id", "external_ticket_id")
SUMMARY_FIELDS = ("summary", "title", "subject")
DETAIL_FIELDS = ("details", "description", "detail", "body", "note", "symptom", "problem")
STATUS_FIELDS = ("status", "status_id", "statusid", "ticketstatus")
STATUS_OBJECT_FIELDS = ("name", "id")
PRIORITY_FIELDS = ("priority",)
CATEGORY_FIELDS = ("category", "ticket_type")
AGENT_FIELDS = ("agent_id", "agentId", "assigned_agent_id")
CREATED_FIELDS = (
    "created",
    "datecreated",
    "date_created",
    "dateoccurred",
    "date_opened",
    "opened_at",
    "dateopened",
)
UPDATED_FIELDS = ("updated", "last_update", "lastupdated", "dateupdated")
CLOSED_FIELDS = ("closed", "closed_at", "dateclosed", "resolved_at")
UNKNOWN_STATUS = "unknown"
UNTITLED_SUMMARY = "Untitled ticket"
EPOCH_MILLIS_ABOVE = 10_000_000_000

# --- stored tickets
TEXT_FIELDS = ("summary", "details")
RESIDUAL_SCAN_FIELDS = ("external_ticket_id", "summary", "details", "status", "priority", "category")
FORBIDDEN_STORAGE_FIELDS = ("agent_id", "raw_json", "raw_payload", "payload", "halopsa_payload")
DISTRIBUTION_COLUMNS = ("status", "priority", "category")
TEMPORAL_COLUMNS = ("ticket_created_at", "ticket_updated_at", "ticket_closed_at", "ingested_at")
PSEUDONYM_PREFIX = "hmac_sha256:"
MIN_TICKET_CREATED_AT = date(2025, 1, 1)
TEXT_PERCENTILES = (0.5, 0.9, 0.95, 0.99)
BUCKET_FORMATS = {"month": "yyyy-MM", "year": "yyyy"}

# --- quality report: what may never be shown
FORBIDDEN_OUTPUT_KEYS = (
    "id",
    "ids",
    "ticket_id",
    "summary",
    "details",
    "external_ticket_id",
    "agent_id_pseudonym",
    "payload",
    "secret",
    "secrets",
    "password",
    "api_key",
    "token",
)
FORBIDDEN_OUTPUT_TOKENS = ("external_ticket_id", "agent_id_pseudonym", "payload", "api_key", "password", "secret")

# --- feature dataset
DATASET_VERSION = "ticket_dataset_v1"
MAX_CLEANED_TEXT_CHARS = 512
SHORT_TEXT_BELOW = 80
MEDIUM_TEXT_BELOW = 240
RAW_INPUT_COLUMNS = ("summary", "details", "ticket_created_at")
FEATURE_COLUMNS = (
    "cleaned_text_truncated",
    "created_day_of_week",
    "created_month",
    "created_week",
    "cleaned_text_length",
    "text_length_bucket",
    "has_email_placeholder",
    "has_phone_placeholder",
    "has_url_placeholder",
)
DENIED_FEATURE_COLUMNS = (
    "external_ticket_id",
    "agent_id",
    "agent_id_pseudonym",
    "payload",
    "id",
    "ticket_id",
    "user_id",
    "client_id",
    "customer_id",
    "account_id",
    "created_at",
    "updated_at",
    "ticket_created_at",
    "closed_at",
    "resolved_at",
    "priority",
    "category",
    "summary",
    "details",
    "raw_text",
    "cleaned_text",
)
DENIED_FEATURE_PATTERNS = (
    r"(^|_)(id|uuid|guid)($|_)",
    r"timestamp|payload|priority|category",
    r"(^|_)(summary|details|raw_text|cleaned_text)($|_)",
)
EXACT_TIMESTAMP_PATTERNS = (r"(^|_)created_at$", r"timestamp", r"_at$")
RAW_TEXT_COLUMNS = ("summary", "details", "raw_text", "cleaned_text")
DRY_RUN_REPORT_KEYS = (
    "dataset_version",
    "mode",
    "status",
    "scope_min_ticket_created_at",
    "total_source_count",
    "included_count",
    "excluded_historical_outlier_count",
    "excluded_missing_ticket_created_at_count",
    "planned_dataset_columns",
    "pii_official_residual_count",
    "secret_scan_count",
    "forbidden_column_count",
    "exact_timestamp_column_count",
    "raw_text_column_count",
    "gates",
)
EXPORT_REPORT_KEYS = DRY_RUN_REPORT_KEYS + ("ttl_hours", "expires_at_utc", "output_extension")
DEFAULT_TTL_HOURS = 24
EXPORT_EXTENSION = ".parquet"
