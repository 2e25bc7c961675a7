"""The fixed patterns in the dialects of both engines.

The patterns are written once, in the form of Python's ``re``. Executors match
them in the JVM wherever a row only has to be *flagged or counted*, so they are
also needed in Java form, with the same meaning of word, digit and space
characters. Java's own ``\\b``, ``\\d`` and ``\\s`` differ (ASCII only by default,
and a wider word class under ``(?U)``), so those three are spelled out.
"""

from __future__ import annotations

import unicodedata

from guichet import fixed_values as fv

_WORD = r"[\p{L}\p{N}_]"
_EDGE = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
_SPACE_IN_CLASS = r"\p{IsWhite_Space}\x1c-\x1f"
#: letters that fold to an ASCII letter, which [A-Z] also covers when case is ignored
_FOLDED_LETTERS = "İıſK"

#: characters Python's ``str.strip`` and ``str.split`` treat as blank, as a Java class
SPACE_CLASS = f"[{_SPACE_IN_CLASS}]"


def java_pattern(pattern: str, ignore_case: bool) -> str:
    """The same pattern for Java's regex engine (``rlike``, ``regexp_count``...)."""
    out: list[str] = []
    in_class = False
    i = 0
    while i < len(pattern):
        two, three = pattern[i : i + 2], pattern[i : i + 3]
        if two == r"\b":
            out.append(_EDGE)
            i += 2
        elif two == r"\d":
            out.append(r"\p{Nd}")
            i += 2
        elif two == r"\s":
            out.append(_SPACE_IN_CLASS if in_class else SPACE_CLASS)
            i += 2
        elif two[0] == "\\":
            out.append(two)
            i += 2
        elif in_class and ignore_case and three == "A-Z":
            out.append(f"A-Za-z{_FOLDED_LETTERS}")
            i += 3
        else:
            if two[0] == "[":
                in_class = True
            elif two[0] == "]":
                in_class = False
            out.append(two[0])
            i += 1
    return ("(?iu)" if ignore_case else "") + "".join(out)



def _swap(pattern: str, old: str, new: str) -> str:
    if old not in pattern:
        raise ValueError("a fixed pattern changed; review its linear-time form")
    return pattern.replace(old, new)


def linear(category: str) -> tuple[str, bool]:
    """A detector pattern that finds the same spans without backtracking over blanks.

    Once the blanks after an identifier word are consumed there is nothing to gain
    from giving some back, so a long run of them need not be retried at each length.
    """
    pattern, ignore_case = fv.PII_PATTERNS[category]
    if category == "obvious_identifier":
        pattern = _swap(pattern, r"\s*[:=#-]?\s*", r"\s*+(?:[:=#-]\s*+)?")
    return pattern, ignore_case


def counting(category: str) -> tuple[str, bool]:
    """A detector pattern with the same *number* of matches, safe for Java's stack.

    Java recurses once per domain label, and a junk text may have thousands. Here
    the labels are taken possessively, which Java does in a loop, up to the first
    one that can end the address instead of the last. The rest of the address
    cannot start another match, so counts and flags agree; ends do not.
    """
    pattern, ignore_case = linear(category)
    if category == "email":
        label, top = r"[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.", r"[A-Z]{2,63}(?![A-Z0-9-])"
        pattern = _swap(pattern, f"(?:{label})+{top}", f"{label}(?:(?!{top}){label})*+{top}")
    return pattern, ignore_case


JAVA_PII = {name: java_pattern(*counting(name)) for name in fv.PII_PATTERNS}
#: all in any case, because the scan reads text that has been lower-cased
JAVA_SECRETS = tuple(java_pattern(pattern, True) for pattern, _ in fv.SECRET_PATTERNS)


def _settled_class() -> str:
    """Java class of ASCII and of the characters that NFKC leaves alone in any company.

    Scripts beyond these are still handled, by the slower route. Combining marks
    and Hangul jamo are left out because they may merge with a neighbour. An ampersand
    may start an HTML entity and is looked for apart.

    Java tests a class in a class only if what stands before it does not match, but tests
    all ranges of a flat class for every character. So ASCII comes first, then the long ranges.
    """
    scripts = [
        (0x00, 0x17F),  # Latin
        (0x386, 0x3CE),  # Greek
        (0x400, 0x481),  # Cyrillic
        (0x5D0, 0x5EA),  # Hebrew
        (0x200B, 0x2033),  # punctuation and invisible marks
        (0x20AC, 0x20AC),  # euro sign
        (0x3041, 0x3096),  # hiragana
        (0x30A1, 0x30FA),  # katakana
        (0x4E00, 0x9FA5),  # ideographs
        (0xAC00, 0xD7A3),  # Hangul syllables
    ]
    spans: list[list[int]] = []
    for first, last in scripts:
        for point in range(first, last + 1):
            char = chr(point)
            if unicodedata.normalize("NFKC", char) != char or unicodedata.category(char)[0] == "M":
                continue
            if spans and spans[-1][1] == point - 1:
                spans[-1][1] = point
            else:
                spans.append([point, point])
    spans.sort(key=lambda span: span[0] - span[1])
    ranges = [f"\\u{a:04x}-\\u{b:04x}" for a, b in spans]
    parts = [r"\x00-\x7f", *ranges[:8], "".join(ranges[8:])]
    return "[" + "[".join(parts) + "]" * len(parts)


#: matches if there is a character that normalisation might change: the run of all others ends early
UNSETTLED = rf"\A{_settled_class()}*+(?!\z)"
