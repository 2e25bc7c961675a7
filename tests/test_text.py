"""Masking and detection against literal cases and a plain per-value recount."""

import html
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.functions import _masking
from guichet.functions import text as X
from guichet.functions.patterns import JAVA_PII

MASK_CASES = [
    ("VPN KO pour marie.dupont@example.test depuis 192.168.1.15", "VPN KO pour [EMAIL] depuis [IP]"),
    (
        "Rappeler au 06 12 34 56 78 et voir https://support.example.test/t/42 login: mdupont",
        "Rappeler au [PHONE] et voir [URL] [IDENTIFIER]",
    ),
    ("Erreur portail pour user_id: user-789", "Erreur portail pour [IDENTIFIER]"),
    ("Session client_id=client-456 à réinitialiser", "Session [IDENTIFIER] à réinitialiser"),
    ("Champ login.", "Champ login."),
    ("Le champ client_id.", "Le champ client_id."),
    ("Escalade vers USER+ALERT@HELPDESK.EXAMPLE.COM", "Escalade vers [EMAIL]"),
    ("Réponse attendue de support@example.com, puis clôture.", "Réponse attendue de [EMAIL], puis clôture."),
    ("Notifier @support puis vérifier utilisateur@example", "Notifier @support puis vérifier utilisateur@example"),
    ("Synthetic contact [EMAIL]", "Synthetic contact [EMAIL]"),
    ("login impossible", "[IDENTIFIER]"),
    ("Tom &amp;amp; Jerry", "Tom &amp; Jerry"),
    ("call +33612345678 now", "call [PHONE] now"),
    ("", ""),
    (None, None),
]

CLEAN_CASES = [
    ("Contact <qa.person@example.test>", "Contact [EMAIL]"),
    ("Write mailto:qa.person@example.test", "Write [EMAIL]"),
    ("<p>Owner: qa.person&#64;example.test</p>", "Owner: [EMAIL]"),
    ("Owner (qa.person@example.test),", "Owner ([EMAIL]),"),
    ("Escalate to qa.o'neil/team_test-alpha@example.engineering", "Escalate to [EMAIL]"),
    ("FULLWIDTH ｑａ．ｐｅｒｓｏｎ＠ｅｘａｍｐｌｅ．ｔｅｓｔ", "FULLWIDTH [EMAIL]"),
    ("MixedCase QA.Person@Example.Test", "MixedCase [EMAIL]"),
    ("Keep <strong>synthetic text</strong> without mailbox", "Keep  synthetic text  without mailbox"),
    ("Mention mailto: synthetic-alias without domain", "Mention mailto: synthetic-alias without domain"),
    ("Ignore qa.person@example without valid long enough suffix",) * 2,
    ("Ignore qa.person at example.test when separator is textual",) * 2,
    ("Contact [EMAIL]", "Contact [EMAIL]"),
    ("Write mailto: [EMAIL]", "Write [EMAIL]"),
    ("\u00a0 padded\t\n", "padded"),
    ("&nbsp;", ""),
    ("<br>", ""),
    (None, ""),
]


def test_mask_literals(evaluate):
    assert evaluate([c[0] for c in MASK_CASES], X.mask) == [c[1] for c in MASK_CASES]


def test_clean_literals(evaluate):
    assert evaluate([c[0] for c in CLEAN_CASES], X.clean) == [c[1] for c in CLEAN_CASES]


def test_overlap_modes(evaluate):
    value = "login: abc'def@example.test"
    assert evaluate([value], X.mask) == ["[IDENTIFIER]"]
    assert evaluate([value], X.clean) == ["[IDENTIFIER]"]
    assert evaluate([value], lambda c: X.mask(c, overlap="skip")) == ["[IDENTIFIER]'def@example.test"]


def test_key_header_is_found_in_any_case(evaluate):
    header = "-----BEGIN RSA PRIVATE KEY-----"
    found = evaluate([header, header.lower(), "begin private key"], lambda c: X.count_secrets(c).cast("string"))
    assert found == ["1", "1", "0"]


def test_hits_and_removed_categories(evaluate):
    value = "10.0.0.1 wrote to a@b.test and c@d.test"
    assert evaluate([value, "plain", None], X.removed_categories) == [["ipv4", "email"], [], None]
    hits = evaluate([value, "plain", None], X.pii_hits)
    assert [tuple(h) for h in hits[0]] == [("ipv4", 0, 8), ("email", 18, 26), ("email", 31, 39)]
    assert hits[1:] == [[], None]


def test_first_clean_skips_blank_candidates(spark):
    df = spark.createDataFrame(
        [(" ", "<br>", "kept"), (None, None, None), ("first", "second", None), ("a@b.test", None, "x"), ("<i></i>", "", None)],
        "a string, b string, c string",
    )
    df = df.select(F.array(F.array("a", "b", "c"), F.array("c")).alias("lists"))
    rows = [r.x for r in X.with_first_clean(df, "lists", "x").collect()]
    assert [r[1] for r in rows] == ["kept", None, None, "x", None]
    out = [r[0] for r in rows]
    assert out == ["kept", None, "first", "[EMAIL]", None]


def test_secret_count(evaluate):
    values = ["token: synthetic", "x" * 32, "a" * 31, "api-key = 1 password:2", "-----BEGIN RSA PRIVATE KEY-----", "tokens:", ""]
    expected = [
        sum(len(re.findall(p, v, re.IGNORECASE if ic else 0)) for p, ic in fv.SECRET_PATTERNS) for v in values
    ]
    assert evaluate(values, X.count_secrets) == expected
    assert expected[:3] == [1, 1, 0]


# ---------------------------------------------------------------- brute force

PIECES = [
    "a@b.test", "jean.dupont@société.fr", "x@y", "@", "ADMIN@EXAMPLE.COM", "qa.o'neil@ex-ample.co.uk", "a.@b.fr",
    "06 12 34 56 78", "+33 6.12.34.56.78", "0033612345678", "061234567", "06123456789", "٠٦", "1٢.3.4.5",
    "192.168.1.1", "256.1.1.1", "1.2.3.4.5", "10.0.0.1x", "_10.0.0.1", "é10.0.0.1",
    "https://a.b/c?d=e", "HTTP://X", "www.x", "WWW.é", "xwww.y", "http://", "ʰttp://k", "https://a'b",
    "login: abc", "LOGİN abc", "logın=abc", "login-ab", "user_id#ééé", "USER_ID  = a-b.c@d", "account_id: x", "mylogin: abcd",
    "username\x1d:\x1fabc", "identifiant\u2003abc", "client_id\u200babc",
    "&amp;", "&lt;", "&#64;", "a&#64;b.test", "a&amp;#64;b.test", "&eacute", "＠", "ﬁ", "①", "e\u0301", "ſ", "K", "İ", "ı", "\u00a0",
    " ", " ", "  ", "\n", "\t", ".", ",", "-", "'", "<", ">", "/", "_", "é", "x", "7", "0", "中文", "한", "\U0001f600", "<b>", "mailto:",
]


def texts(n=1500, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 9))) for _ in range(n)]


def naive_norm(t):
    return unicodedata.normalize("NFKC", html.unescape(t))


def naive_matches(t):
    out = []
    for name, (p, ic) in fv.PII_PATTERNS.items():
        out += [(m.start(), m.end(), name) for m in re.finditer(p, naive_norm(t), re.IGNORECASE if ic else 0)]
    return sorted(out)


@pytest.mark.parametrize("category", list(fv.PII_PATTERNS))
def test_jvm_detector_equals_per_value_detector(evaluate, category):
    values = texts()
    expected = [sum(1 for m in naive_matches(v) if m[2] == category) for v in values]
    assert sum(expected) > 0
    assert evaluate(values, lambda c: X.count_category(X.normalise(c), category)) == expected
    assert evaluate(values, lambda c: X.has_category(X.normalise(c), category)) == [e > 0 for e in expected]


def test_jvm_secret_detector_equals_per_value_detector(evaluate):
    values = texts() + ["=" * 40, "a=" * 20 + "é", "-" * 33 + "a", "é" + "a" * 40, "a" * 32 + "-"]
    expected = [sum(len(re.findall(p, v, re.IGNORECASE if ic else 0)) for p, ic in fv.SECRET_PATTERNS) for v in values]
    assert evaluate(values, X.count_secrets) == expected


def test_normalise_equals_per_value_normalisation(evaluate):
    values = texts()
    assert evaluate(values, X.normalise) == [naive_norm(v) for v in values]


def test_mask_equals_per_value_mask(evaluate):
    def naive(t):
        once = naive_norm(t)
        base = naive_norm(once)
        matches = naive_matches(once)
        if not matches:
            return once
        out, cursor = "", 0
        for a, b, name in matches:
            if a < cursor:
                continue
            out += base[cursor:a] + fv.PII_REPLACEMENTS[name]
            cursor = b
        return out + base[cursor:]

    values = texts()
    assert evaluate(values, lambda c: X.mask(c, overlap="skip")) == [naive(v) for v in values]


def test_hits_equal_per_value_hits(evaluate):
    values = texts(800, 13)
    got = evaluate(values, X.pii_hits)
    assert [[(h.start, h.end, h.category) for h in hits] for hits in got] == [naive_matches(v) for v in values]


def test_clean_equals_per_value_clean(evaluate):
    from guichet.functions import _masking

    tags = ["<b>", "</p >", "<İ>", "<1>", "<", "< a>", "<a\n>", "mailto:", "[EMAIL]", "[email]", "< [EMAIL] >"]
    rng = random.Random(8)
    values = ["".join(rng.choice(PIECES + tags * 6) for _ in range(rng.randint(1, 7))) for _ in range(1200)]
    assert evaluate(values, X.clean) == [_masking.clean(v) for v in values]


def test_squeeze_and_strip_follow_python(evaluate):
    values = texts(600, 3) + ["\x1c a \x1f\u3000b\u2028", "\x85x\xa0"]
    assert evaluate(values, X.squeeze) == [" ".join(v.split()) for v in values]
    assert evaluate(values, X.strip) == [v.strip() for v in values]


def test_lower_follows_python(evaluate):
    values = texts(300, 5) + ["ΑΣ", "ΑΣ ΟΔΟΣ", "ẞ"]
    assert evaluate(values, F.lower) == [v.lower() for v in values]


def test_long_adversarial_text_does_not_overflow(evaluate):
    values = ["x@" + "ab.c." * 40000 + "1", "x@" + "a1.c." * 40000 + "com", "login" + " " * 300000, "a@b.com.1.fr c@d.e1.fr.", None]
    assert evaluate(values, lambda c: X.count_category(c, "email")) == [1, 1, 0, 2, None]
    assert evaluate(values, lambda c: X.count_category(c, "obvious_identifier")) == [0, 0, 0, 0, None]
    masked = evaluate(values, X.mask)
    assert masked[0].startswith("[EMAIL]") and masked[1] == "[EMAIL]" and masked[2] == values[2]
    assert evaluate(values, X.looks_like_contact) == [True, True, False, True, None]


def test_texts_without_what_a_category_needs_are_not_searched(evaluate, monkeypatch):
    """Decimals are no addresses and a room number is no phone number; the rest of a text is left to a substring test."""
    plain = ["version 3.14 & 10.5", "room 101 &", "AT&amp;T in 2024.", "Müller & Söhne, 1.000.000 pièces", ""]
    for category in ("ipv4", "fr_phone"):
        assert evaluate([t for t in plain if "000" not in t], lambda c, name=category: X._MUST_HAVE[name](c), "string") == [False] * 4
    searched = []

    class Detector:
        def __init__(self, name, pattern):
            self.name, self.pattern = name, pattern

        def finditer(self, text):
            searched.append(self.name)
            return self.pattern.finditer(text)

    monkeypatch.setattr(_masking, "_DETECTORS", [(name, Detector(name, p)) for name, p in _masking._DETECTORS])
    assert [_masking.mask(t) for t in plain] == [_masking.normalise(t) for t in plain]
    assert set(searched) <= {"ipv4"}
    assert _masking.mask("a@b.test") == "[EMAIL]" and searched[-1] == "email"


def test_gates_lose_no_hit():
    """Every span that the detectors find by themselves, on texts made of their parts."""
    r = random.Random(5)
    parts = ["0", "+33", "0033", "6", "12", "34", " ", "\u00a0", ".", "-", "\n", "10.", "1.2.3.4", "٣.٤", "255.0.0.1", "www.", "wWw.a", "http\u017f://", "HTTPS://x"]
    parts += ["u\u017fername", "lOG\u0130N", "log\u0131n:", "user_\u0130d=abc", "agent_id x", "IDENTIFIANT#abc", "@", "a@b.cd", "[EMAIL]", "<", "mailto:", "&amp;", "x", "é"]
    found = 0
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 14)))
        want = sorted((m.start(), m.end(), name) for name, rx in _masking._DETECTORS for m in rx.finditer(text))
        assert _masking.spans(text) == want, text
        found += bool(want)
    assert found > 5_000


def test_gates_and_detectors_agree_in_the_jvm(spark):
    r = random.Random(6)
    parts = ["0", "+33", "0033", "6", "12", "34", "78", "1234", "12 34", "\u00a0", ".", "\n-", "10.", "1.2.3.4", "٣.٤.٣.٤", "255.0.0.1", "xé"]
    made = [("".join(r.choice(parts) for _ in range(r.randint(1, 14))),) for _ in range(5_000)]
    gap = lambda: r.choice(["", " ", ".", "-", "\u00a0", " - ", "x"])
    numbers = [r.choice(["0", "00", "33", "0033", "+33", "7", "+"]) + gap() + r.choice("0126") + "".join(gap() + r.choice(["12", "34", "٣٤", "5"]) for _ in range(4)) for _ in range(5_000)]
    rows = spark.createDataFrame(made + [(n,) for n in numbers], "t string").select(
        *(X.has_category(F.col("t"), name).alias(name) for name in ("ipv4", "fr_phone")), *(F.col("t").rlike(JAVA_PII[name]).alias(f"{name}_alone") for name in ("ipv4", "fr_phone"))
    )
    got = rows.collect()
    assert all(g.ipv4 == g.ipv4_alone and g.fr_phone == g.fr_phone_alone for g in got)
    assert sum(g.ipv4 for g in got) > 100 and sum(g.fr_phone for g in got) > 50


def test_the_normal_form_test_knows_every_character(evaluate):
    """One odd character between plain ones, for every code point below the surrogates and some beyond."""
    points = [*range(1, 0xD800, 7), *range(0x80, 0x600), *range(0x1100, 0x1200), 0x1F600, 0x2F800]
    unsettled = evaluate([f"a\u00e9{chr(p)}\u044f" for p in points], X.is_unsettled)
    changed = [unicodedata.normalize("NFKC", chr(p)) != chr(p) or unicodedata.category(chr(p))[0] == "M" or chr(p) == "&" for p in points]
    assert all(u for u, c in zip(unsettled, changed, strict=True) if c)
    plain = [u for p, u in zip(points, unsettled, strict=True) if 0x4E00 <= p <= 0x9FA5 or 0xC0 <= p <= 0x131]
    assert plain and not any(plain)


def test_strip_takes_every_space_of_either_end(evaluate):
    spaces = [chr(p) for p in range(0x3001) if chr(p).isspace()]
    texts_ = [s + "é x" for s in spaces] + ["é x" + s for s in spaces] + [" " + s + " x\u2003y" + s + " " for s in spaces] + ["", " ", "\u3000", "中", "\U0001f600", "é"]
    assert evaluate(texts_, X.strip) == [t.strip() for t in texts_]
