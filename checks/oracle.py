"""Pieces of the checking SQL (DuckDB): detector patterns without look-around, masking, clean-up.

The SQL engine's regexes cannot look around, so a neighbour that must not be there
is matched as a group and put back. Neighbouring matches can then share that
character, which is why replacements run twice.
"""

from __future__ import annotations

from checks.tables import BOUNDARY, SCOPE, TICKETS_CTE

_LOCAL = "A-Za-z0-9.!#$%&'*+/=?^_`{|}~-"
_LABEL = "[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_EDGE = r"(^|[^\p{L}\p{N}_])"
_EDGE_END = r"($|[^\p{L}\p{N}_])"

#: category -> (pattern with its neighbours as groups, replacement), in an order that gives the earlier match precedence
PATTERNS = {
    "obvious_identifier": (
        _EDGE
        + r"(?:agent_id|user_id|client_id|customer_id|account_id|identifiant|login|username)(?:\s*[:=#-]\s*|\s+)[A-Za-z0-9._@-]{3,}",
        r"\1[IDENTIFIER]",
    ),
    "url": (_EDGE + r"(?:https?://|www\.)[^\s<>'\"]+", r"\1[URL]"),
    "email": (
        f"(^|[^{_LOCAL}])[A-Za-z0-9](?:[{_LOCAL}]{{0,62}}[A-Za-z0-9])?@(?:{_LABEL}\\.)+[A-Za-z]{{2,63}}($|[^A-Za-z0-9-])",
        r"\1[EMAIL]\2",
    ),
    "ipv4": (_EDGE + rf"(?:{_OCTET}\.){{3}}{_OCTET}" + _EDGE_END, r"\1[IP]\2"),
    "fr_phone": (r"(^|[^0-9])(?:\+33|0033|0)\s*[1-9](?:[\s.-]*[0-9]{2}){4}($|[^0-9])", r"\1[PHONE]\2"),
}
IGNORE_CASE = ("email", "url", "obvious_identifier")

#: category -> pattern of the match alone, for texts whose neighbours never get in the way
BARE = {
    "obvious_identifier": r"\b(?:agent_id|user_id|client_id|customer_id|account_id|identifiant|login|username)(?:\s*[:=#-]\s*|\s+)[A-Za-z0-9._@-]{3,}",
    "url": r"\b(?:https?://|www\.)[^\s<>'\"]+",
    "email": f"[A-Za-z0-9](?:[{_LOCAL}]{{0,62}}[A-Za-z0-9])?@(?:{_LABEL}\\.)+[A-Za-z]{{2,63}}",
    "ipv4": rf"\b(?:{_OCTET}\.){{3}}{_OCTET}\b",
    "fr_phone": r"(?:\+33|0033|\b0)\s*[1-9](?:[\s.-]*[0-9]{2}){4}\b",
}


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def has(category: str, text: str) -> str:
    flags = "i" if category in IGNORE_CASE else "c"
    return f"regexp_matches({text}, {quote(PATTERNS[category][0])}, '{flags}')"


def has_any(text: str) -> str:
    return "(" + " OR ".join(has(c, text) for c in PATTERNS) + ")"


def mask(text: str) -> str:
    for category, (pattern, replacement) in PATTERNS.items():
        flags = "gi" if category in IGNORE_CASE else "g"
        for _ in range(2):
            text = f"regexp_replace({text}, {quote(pattern)}, {quote(replacement)}, '{flags}')"
    return text


def unescape(text: str) -> str:
    """The entities that occur in the generated pages."""
    for entity, char in (("&copy;?", "©"), ("&middot;?", "·"), ("&quot;?", '"'), ("&amp;?", "&")):
        text = f"regexp_replace({text}, {quote(entity)}, {quote(char)}, 'g')"
    return text


def clean(text: str) -> str:
    masked = mask(unescape(unescape(f"trim({text}, chr(10) || chr(9) || ' ')")))
    return f"trim(regexp_replace({masked}, '</?[A-Za-z][^>]*>', ' ', 'g'), chr(10) || chr(9) || ' ')"


def secrets(text: str) -> str:
    keyword = r"\b(?:api[_-]?key|secret|token|password|passwd|pwd)\b\s*[:=]"
    return (
        f"(len(regexp_extract_all({text}, {quote('(?i)' + keyword)})) + "
        f"len(regexp_extract_all({text}, {quote(r'[A-Za-z0-9_=-]{32,}')})))"
    )


def with_tickets(query: str, *more: str) -> str:
    """A query over the ticket view and, as ``scoped``, its part inside the boundary."""
    parts = [TICKETS_CTE, f"scoped AS (SELECT * FROM tickets WHERE {SCOPE})", *more]
    return "WITH " + ", ".join(parts) + " " + query


FEATURES_CTE = f"""
cleaned AS (SELECT ticket_created_at AS t, substr(trim(regexp_replace(lower({mask("(summary || chr(10) || details)")}),
    '\\s+', ' ', 'g')), 1, 512) AS x FROM tickets WHERE ticket_created_at >= TIMESTAMP '{BOUNDARY} 00:00:00'),
features AS (SELECT x AS cleaned_text_truncated, CAST(month(t) AS INT) AS created_month, CAST(week(t) AS INT) AS created_week,
    CAST(isodow(t) - 1 AS INT) AS created_day_of_week, CAST(length(x) AS INT) AS cleaned_text_length,
    CASE WHEN length(x) < 80 THEN 'short' WHEN length(x) < 240 THEN 'medium' ELSE 'long' END AS text_length_bucket,
    contains(x, '[email]') AS has_email_placeholder, contains(x, '[phone]') AS has_phone_placeholder,
    contains(x, '[url]') AS has_url_placeholder FROM cleaned)
"""
