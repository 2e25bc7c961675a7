"""Per-value helpers behind the Arrow UDFs of :mod:`guichet.functions.text`."""

from __future__ import annotations

import html
import re
import sys
import unicodedata

from pyspark import cloudpickle

from guichet import fixed_values as fv
from guichet.functions.patterns import linear

# Executors get this module by value, so a job does not need the package installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FLAGS = {True: re.IGNORECASE, False: 0}
_DETECTORS = [(name, re.compile(p, _FLAGS[ic])) for name in fv.PII_PATTERNS for p, ic in [linear(name)]]
_PLACEHOLDER = dict(fv.PII_REPLACEMENTS)
_TAG = re.compile(fv.HTML_TAG_PATTERN, re.IGNORECASE)
_BRACKETED = re.compile(fv.BRACKETED_EMAIL_PATTERN, re.IGNORECASE)
_MAILTO = re.compile(fv.MAILTO_EMAIL_PATTERN, re.IGNORECASE)

# What a text cannot do without to hold a category, as in guichet.functions.text. A search for a
# substring, or from a literal, costs a small part of a search with a detector.
_PHONE = re.compile(r"(?:\+33|0033|0)\s*[1-9](?:[\s.-]*\d{2}){4}")
_OCTETS = re.compile(r"\.\d{1,3}\.\d")
_WORDS = ("_id", "identifiant", "login", "username")


def _has_identifier_word(text: str) -> bool:
    # the dotted capital, the dotless small i and the long s match a letter, and do not lower to it
    low = text.lower()
    return any(word in low for word in _WORDS) or any(c in text for c in "İıſ")


_MUST_HAVE = {
    "email": lambda t: "@" in t,
    "fr_phone": lambda t: ("0" in t or "+33" in t) and _PHONE.search(t),
    "ipv4": lambda t: _OCTETS.search(t),
    "url": lambda t: "://" in t or any(w in t for w in ("ww.", "wW.", "Ww.", "WW.")),
    "obvious_identifier": _has_identifier_word,
}


def normalise(text: str) -> str:
    return unicodedata.normalize("NFKC", html.unescape(text))


def normalise_each(texts: list[str | None]) -> list[str | None]:
    return [None if t is None else normalise(t) for t in texts]


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, category) of every detector hit in an already normalised text."""
    return sorted((m.start(), m.end(), name) for name, rx in _DETECTORS if _MUST_HAVE[name](text) for m in rx.finditer(text))


def _settle(text: str) -> tuple[str, list[tuple[int, int, str]]]:
    """The text to cut and its hits.

    Detection looks one normalisation further than the output does, so that a
    doubly escaped address is still seen. Where that second round changes the
    text, hits are cut from the text they were found in.
    """
    once = normalise(text)
    twice = normalise(once) if "&" in once else once
    hits = spans(twice)
    return (twice if hits else once), hits


def mask(text: str, merge_overlaps: bool = True) -> str:
    """Replace detector hits by typed placeholders, left to right.

    The tail of a hit that begins inside the previous one is hidden under the
    placeholder of the first; without ``merge_overlaps`` it stays.
    """
    base, hits = _settle(text)
    pieces, done = [], 0
    for start, end, name in hits:
        if start >= done:
            pieces += (base[done:start], _PLACEHOLDER[name])
            done = end
        elif merge_overlaps and end > done:
            done = end
    return "".join(pieces) + base[done:]


def mask_skipping(text: str) -> str:
    return mask(text, merge_overlaps=False)


def found_categories(text: str) -> list[str]:
    """Categories present, in order of first appearance."""
    return list(dict.fromkeys(name for _, _, name in _settle(text)[1]))


def hits(text: str) -> list[dict]:
    return [{"category": c, "start": a, "end": b} for a, b, c in spans(normalise(text))]


def _unwrap(text: str) -> str:
    return _BRACKETED.sub(r"\1", _MAILTO.sub(r"\1", text)) if "[" in text else text


def clean(text: str) -> str:
    """Provider text without markup, entities or personal data."""
    masked = mask(normalise(text.strip()))
    return _unwrap(_TAG.sub(" ", _unwrap(masked))).strip()


def stored_each(lists: list[list[str | None] | None], masked: tuple[int, ...]) -> list[str | None]:
    """Per list, what may be stored of its first entry that says something: cleaned again, and masked at some places."""
    out = []
    for i, text in enumerate(first_clean_each(lists)):
        text = None if text is None else clean(text)
        out.append(mask(text) if text and i in masked else text)
    return out


def first_clean_each(lists: list[list[str | None] | None]) -> list[str | None]:
    """Per list, the first entry that still says something once cleaned."""
    return [next(filter(None, (clean(t) for t in texts or () if t is not None)), None) for texts in lists]
