"""Masking, detection and clean-up of ticket text as column expressions.

Most ticket text holds nothing to mask and is already in normal form. Such rows
are recognised by JVM expressions, and the Arrow UDFs receive NULL for them:
``coalesce(udf(when(needed, text)), text)``. Only rows that need offsets, HTML
entities or Unicode normalisation cross into Python. Flags and counts never do,
except to normalise the few texts that are not in normal form.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from guichet import fixed_values as fv
from guichet.functions import _masking
from guichet.functions.patterns import JAVA_PII, JAVA_SECRETS, SPACE_CLASS, UNSETTLED, java_pattern

_HIT = T.StructType().add("category", "string").add("start", "integer").add("end", "integer")


def _per_value(fn, returns: T.DataType):
    """Arrow UDF that applies ``fn`` to the non-null values of one column.

    Declared nondeterministic although it is not: the optimizer merges projections
    around deterministic Python UDFs, and copies a computed text into every mention
    of it on the way, at the price of computing it that many times.
    """

    arrow_type = to_arrow_type(returns)

    @F.arrow_udf(returns)
    def apply(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else fn(v) for v in values.to_pylist()], arrow_type)

    return apply.asNondeterministic()


_normalise_udf = _per_value(_masking.normalise, T.StringType())
_normalise_each_udf = _per_value(_masking.normalise_each, T.ArrayType(T.StringType()))
_mask_udf = _per_value(_masking.mask, T.StringType())
_mask_skipping_udf = _per_value(_masking.mask_skipping, T.StringType())
_clean_udf = _per_value(_masking.clean, T.StringType())
_first_clean_udf = _per_value(_masking.first_clean_each, T.ArrayType(T.StringType()))
_categories_udf = _per_value(_masking.found_categories, T.ArrayType(T.StringType()))
_hits_udf = _per_value(_masking.hits, T.ArrayType(_HIT))


def _let(c: Column, fn) -> Column:
    """``fn(c)`` with ``c`` computed once, however often ``fn`` mentions it.

    The optimizer copies the definition of a computed column into every mention of
    it inside a Python UDF's arguments; a lambda variable stays a variable.
    """
    return F.get(F.transform(F.array(c), fn), 0)


def _where(c: Column, needed) -> Column:
    """The text where ``needed`` says so, else NULL."""
    return _let(c, lambda t: F.when(needed(t), t))


def _contains_any(c: Column, *needles: str) -> Column:
    return reduce(or_, (F.contains(c, F.lit(needle)) for needle in needles))


# ---------------------------------------------------------------- spaces


def strip(c: Column) -> Column:
    """Without leading and trailing Unicode white space (``trim`` drops spaces only)."""

    def stripped(t: Column) -> Column:
        # Three bytes hold any space. A place in a text is counted from its start; one in its bytes is not.
        data = t.cast("binary")
        head, tail = (F.substring(data, at, 3).cast("string") for at in (1, -3))
        ends = head.rlike(rf"\A{SPACE_CLASS}") | tail.rlike(rf"{SPACE_CLASS}\z")
        return F.when(ends, F.regexp_replace(t, f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")).otherwise(t)

    return _let(F.trim(c), stripped)


def squeeze(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE_CLASS}+", " "))


def blank_to_null(c: Column) -> Column:
    """NULL for text of spaces only, else the trimmed text."""
    return F.nullif(F.trim(c), F.lit(""))


# ---------------------------------------------------------------- normalisation


def _beyond_ascii(c: Column) -> Column:
    return F.octet_length(c) != F.char_length(c)


def is_unsettled(c: Column) -> Column:
    """True where HTML unescaping or NFKC could change the text."""
    return _contains_any(c, "&") | (_beyond_ascii(c) & c.rlike(UNSETTLED))


def normalise(c: Column) -> Column:
    """HTML entities resolved, then Unicode NFKC."""
    return F.coalesce(_normalise_udf(_where(c, is_unsettled)), c)


def normalise_each(texts: Column) -> Column:
    """:func:`normalise` for an array of texts without NULLs, in one trip to Python."""
    unsettled = F.transform(texts, lambda t: F.when(is_unsettled(t), t))
    needed = F.when(F.exists(unsettled, lambda t: t.isNotNull()), unsettled)
    return F.zip_with(F.coalesce(_normalise_each_udf(needed), texts), texts, lambda new, old: F.coalesce(new, old))


# ---------------------------------------------------------------- detection

# What a text cannot do without to hold a category. Substring tests work on bytes;
# a regex first has to decode the whole text, so it only runs on the rows that pass.
# The dotted capital and the dotless small i stand for any i when case is ignored,
# and do not lower to one.
_WORDS = ("_id", "identifiant", "login", "username")
_PHONE = java_pattern(r"[+0](?:33|033)?\s*+[1-9](?:[\s.-]*\d{2}){4}", False)
_MUST_HAVE = {
    "email": lambda c: _contains_any(c, "@"),
    "fr_phone": lambda c: _contains_any(c, "0", "+33") & c.rlike(_PHONE),
    "ipv4": lambda c: c.rlike(r"\.\p{Nd}{1,3}\.\p{Nd}"),
    "url": lambda c: _contains_any(c, "://", "ww.", "wW.", "Ww.", "WW."),
    "obvious_identifier": lambda c: _let(F.lower(c), lambda low: _contains_any(low, *_WORDS)) | _contains_any(c, "İ", "ı"),
}


def has_category(normalised: Column, category: str) -> Column:
    """True where a normalised text holds the category; NULL text gives NULL."""
    return _MUST_HAVE[category](normalised) & normalised.rlike(JAVA_PII[category])


def count_category(normalised: Column, category: str) -> Column:
    """Number of matches of one category in a normalised text."""
    count = F.regexp_count(normalised, F.lit(JAVA_PII[category]))
    return F.when(normalised.isNotNull(), F.when(_MUST_HAVE[category](normalised), count).otherwise(0))


def has_pii(normalised: Column) -> Column:
    return reduce(or_, (has_category(normalised, name) for name in JAVA_PII))


def count_pii(normalised: Column) -> Column:
    """Number of detector matches over all categories."""
    return reduce(add, (count_category(normalised, name) for name in JAVA_PII))


def pii_categories(normalised: Column) -> Column:
    """Sorted array of the categories present."""
    flags = [F.when(has_category(normalised, name), F.lit(name)) for name in sorted(JAVA_PII)]
    return F.array_compact(F.array(*flags))


def count_secrets(c: Column) -> Column:
    """Number of matches of the secret patterns."""
    return reduce(add, (F.regexp_count(c, F.lit(p)) for p in JAVA_SECRETS))


def _needs_masking(c: Column) -> Column:
    return is_unsettled(c) | has_pii(c)


def pii_hits(c: Column) -> Column:
    """Array of (category, start, end), by start, end and category; never the value."""
    return F.when(c.isNotNull(), F.coalesce(_hits_udf(_where(c, _needs_masking)), F.array().cast(T.ArrayType(_HIT))))


# ---------------------------------------------------------------- masking


def mask(c: Column, overlap: str = "merge") -> Column:
    """Text with personal data replaced by typed placeholders.

    The tail of a hit that begins inside the hit before it is hidden as well;
    ``overlap="skip"`` drops such a hit and keeps its tail.
    """
    udf = {"merge": _mask_udf, "skip": _mask_skipping_udf}[overlap]
    return F.coalesce(udf(_where(c, _needs_masking)), c)


_TITLED = r"\b(?:M\.|Mme|Mlle|Mr|Mrs|Ms|Dr)\s+\p{Lu}[\p{L}'-]+(?:\s+\p{Lu}[\p{L}'-]+)?"
_STREET = r"\b[0-9]{1,4}(?:\s?(?:bis|ter))?,?\s+(?:rue|avenue|boulevard|place|chemin|impasse|route|quai)\s+[^,;\n]{2,40}"
_TOWN = r"\b[0-9]{5}\s+\p{Lu}[\p{L}' -]+"
_ABROAD = r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}"
#: streets before towns, since a street may end in its town
MORE_PATTERNS = (_ABROAD, _TITLED, _STREET, _TOWN)
REDACTED = "[PII_REDACTED]"


def mask_more(c: Column, first_characters: int | None = None) -> Column:
    """Phone numbers of any country, titled names, streets and towns as one kind of placeholder, on request after :func:`mask`.

    ``first_characters`` cuts the text before anything else; a hit at the cut may be split.
    """
    text = c if first_characters is None else F.substring(c, 1, first_characters)
    for pattern in MORE_PATTERNS:
        text = F.regexp_replace(text, pattern, F.lit(REDACTED.replace("[", "\\[").replace("]", "\\]")))
    return text


def removed_categories(c: Column) -> Column:
    """Distinct categories that :func:`mask` removes, in order of appearance."""
    return F.when(c.isNotNull(), F.coalesce(_categories_udf(_where(c, _needs_masking)), F.array().cast("array<string>")))


_TAG = java_pattern(fv.HTML_TAG_PATTERN, True)
_PLACEHOLDER = r"(?iu)\[EMAIL\]"


def _needs_unwrapping(c: Column) -> Column:
    """True where cleaning takes more than removing tags: a placeholder may be wrapped, now or once masked."""
    return (_contains_any(c, "[") & c.rlike(_PLACEHOLDER)) | _needs_masking(c)


def _untagged(c: Column) -> Column:
    return strip(F.when(_contains_any(c, "<"), F.regexp_replace(c, _TAG, " ")).otherwise(c))


def clean(c: Column) -> Column:
    """Provider text: normalised, masked, markup and placeholder wrappers removed, stripped."""
    return F.coalesce(_clean_udf(_where(c, _needs_unwrapping)), _untagged(c), F.lit(""))


def first_text(candidates: Column) -> Column:
    """First entry of an array of texts that is not blank, stripped."""
    return F.get(F.filter(F.transform(candidates, strip), lambda t: t != ""), 0)


def with_first_stored(df: DataFrame, lists: str, out: str, masked: tuple[int, ...]) -> DataFrame:
    """Adds ``out``: like :func:`with_first_clean`, but cleaned once more and masked at the places ``masked``.

    A text that holds nothing to mask or resolve, with its tags and without them, is final once
    its tags are gone; both are looked at in one search. All others make one trip to the UDF,
    which does all of the work.
    """

    def by_itself(texts: Column) -> Column:
        def final(t: Column) -> Column:
            tagged = _contains_any(t, "<")

            def settled(u: Column) -> Column:
                both = F.when(tagged, F.concat(t, F.lit("\n\0\n"), u)).otherwise(t)
                fine = _let(both, lambda b: ~_needs_unwrapping(b)) & ~_contains_any(u, "<")
                return F.when(fine, F.nullif(u, F.lit("")))

            return _let(_untagged(t), settled)

        return _let(first_text(texts), final)

    df = df.withColumn("_plain", F.transform(lists, by_itself))
    left = F.zip_with("_plain", lists, lambda plain, texts: F.when(plain.isNull(), texts))
    left = F.when(F.exists(left, lambda texts: texts.isNotNull()), left)
    stored = _per_value(lambda lists: _masking.stored_each(lists, masked), T.ArrayType(T.StringType()))
    df = df.withColumn("_final", stored(left))
    picked = F.zip_with("_plain", F.coalesce("_final", "_plain"), lambda a, b: F.coalesce(a, b))
    return df.withColumn(out, picked).drop("_plain", "_final")


def with_first_clean(df: DataFrame, lists: str, out: str) -> DataFrame:
    """Adds ``out``: for each list of texts, the first that is not blank once cleaned, else NULL.

    The first text of a list that is not blank decides its route. If it only needs
    its tags removed, and something is left, it is the answer. Otherwise the whole
    list goes to the UDF.
    """

    def by_itself(texts: Column) -> Column:
        tagless = lambda t: F.when(~_needs_unwrapping(t), F.nullif(_untagged(t), F.lit("")))
        return _let(first_text(texts), tagless)

    df = df.withColumn("_plain", F.transform(lists, by_itself))
    left = F.zip_with("_plain", lists, lambda plain, texts: F.when(plain.isNull(), texts))
    df = df.withColumn("_cleaned", _first_clean_udf(left))
    return df.withColumn(out, F.zip_with("_plain", "_cleaned", lambda a, b: F.coalesce(a, b))).drop("_plain", "_cleaned")


# ---------------------------------------------------------------- report predicates


def looks_like_contact(c: Column) -> Column:
    """Loose diagnostic test for addresses and numbers, kept apart from the detector."""
    email, phone, ip = (java_pattern(p, True) for p in fv.HEURISTIC_PATTERNS)
    email = email.replace("+@", "@", 1)  # one character before the sign decides as much as many
    return (_contains_any(c, "@") & c.rlike(email)) | c.rlike(phone) | (c.rlike(r"[0-9]\.[0-9]") & c.rlike(ip))


def is_untitled(c: Column) -> Column:
    return F.lower(F.trim(c)) == fv.UNTITLED_SUMMARY.lower()


def length_bucket(length: Column) -> Column:
    return (
        F.when(length < fv.SHORT_TEXT_BELOW, "short").when(length < fv.MEDIUM_TEXT_BELOW, "medium").otherwise("long")
    )
