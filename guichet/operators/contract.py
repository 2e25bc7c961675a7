"""Column and report contracts of the feature dataset. Names only; no data is read.

A contract is a table of rules; a rule judges one name, given as text or as a column.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.schema import FEATURES, same_columns


class ContractError(ValueError):
    """A dataset or report does not keep to its contract."""


@dataclass(frozen=True)
class Rule:
    """Broken by a name that is listed or matches a pattern, unless it is spared; case does not matter.

    Without a list and patterns every name that is not spared breaks it.
    """

    spared: tuple[str, ...] = ()
    listed: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()

    def broken_by(self, name: str) -> bool:
        low = name.lower()
        if low in self.spared:
            return False
        return not (self.listed or self.patterns) or low in self.listed or any(re.search(p, low, re.IGNORECASE) for p in self.patterns)

    def flag(self, name: Column) -> Column:
        low, hit = F.lower(name), F.lit(not (self.listed or self.patterns))
        if self.listed:
            hit = hit | low.isin(*self.listed)
        if self.patterns:
            hit = hit | low.rlike("(?i)" + "|".join(self.patterns))
        return hit & ~low.isin(*self.spared) if self.spared else hit


_RAW, _DATED, _TEXTS = tuple(fv.RAW_INPUT_COLUMNS), tuple(fv.EXACT_TIMESTAMP_PATTERNS), tuple(fv.RAW_TEXT_COLUMNS)
#: records carry the three raw columns and nothing else
INPUT = {"forbidden": Rule(spared=_RAW), "exact_timestamp": Rule(spared=_RAW, patterns=_DATED), "raw_text": Rule(spared=_RAW, listed=_TEXTS)}
#: features are allowlisted names, with no date, raw text or identifier among them
OUTPUT = {"forbidden": Rule(spared=tuple(fv.FEATURE_COLUMNS)), "exact_timestamp": Rule(patterns=_DATED), "raw_text": Rule(listed=_TEXTS)}


def breaches(columns: Iterable[str], rules: Mapping[str, Rule]) -> Counter[str]:
    """How many different columns break each rule; rules that none breaks are not in it."""
    return Counter(name for c in set(columns) for name, rule in rules.items() if rule.broken_by(c))


def flags(name: Column, rules: Mapping[str, Rule] = INPUT) -> Column:
    """The rules on a column of names, as a struct of flags."""
    return F.struct(*(rule.flag(name).alias(n) for n, rule in rules.items()))


def matches_feature_schema(features: DataFrame) -> bool:
    return same_columns(features, FEATURES)


def assert_report_keys(names: Iterable[str], allowed: Iterable[str] = fv.DRY_RUN_REPORT_KEYS) -> None:
    """Refuse report fields outside the allowlist."""
    extra = sorted(set(names) - set(allowed))
    if extra:
        raise ContractError(f"{len(extra)} report fields are not on the list")


def ragged_columns(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """(column) every member name that occurs in a VARIANT column of JSON objects.

    Names are made distinct per task first, so the shuffle carries names, not rows.
    """
    members = F.map_keys(F.variant_get(F.col(column), "$", "map<string,variant>"))
    return payloads.select(F.explode(members).alias("column")).distinct()
