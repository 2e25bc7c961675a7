"""Date text and epochs against Python's own reading of them."""

import random
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from guichet.functions import dates as D

LITERALS = [
    "2026-01-02T03:04:05Z", "2024-12-31T23:30:00-05:00", "2025-01-01", "20250101", "2025-W06-1", "2025-W06", "2025W061",
    "2025-W53-1", "2026-W53-7", "2020-W53-7", "2025-W00", "2025-W01-0", "2025-W01-8", "0001-W01-1", "2025W06T10",
    "20250101T101112", "2025-01-01x10", "2025-01-01T10:11:12,123456789", "2025-01-01T10:11:12.1", "2025-01-01T10:11:12.1234567+23:59",
    "2025-01-01T10:11+01:30:15", "2025-01-01T1011", "2025-01-01T10:1112", "2025-01-01T10Z", "2025-01-01T10z", "2025-01-01 ",
    " 2025-01-01\t", "2025-01-01T", "2025-01-01T10:00-24:00", "2025-1-5", "2025", "2025-01", "２０２５-01-01", "2025-01-01T10:11:60",
    "2025-01-01T24:00", "2025-01-01T10:11:12.", "2025-01-01T10:60", "2025-01-01T10:11:12+01", "2025-01-01T10:11:12+0130",
    "2025-01-01T10:11:12-18:30", "2025-02-29", "2024-02-29", "20240230", "2025-13-01", "0000-01-01", "0001-01-01", "9999-12-31T23:59:59.999999",
    "not-a-date", "", "  ", "2025-0101", "202501-01", "2025-01-01T10.5", "2025-01-01T10:11.5", "2025-01-01T10:11:12 +01:00", None,
    "2025-01-01\n10:00", "-2025-01-01", "12025-01-01", "2025-01-01T+01:00", "2025-01-01 10:11:12", "2025-001",
]


def expected(text):
    if text is None or not text.strip():
        return None
    text = text.strip()
    try:
        value = datetime.fromisoformat(text[:-1] + "+00:00" if text.endswith("Z") else text)
    except ValueError:
        return None
    return (value if value.tzinfo else value.replace(tzinfo=timezone.utc)).astimezone(timezone.utc)


def micros(value):
    if value is None:
        return None
    delta = value - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def read(evaluate, values, fn=D.parse_iso, data_type="string"):
    return evaluate(values, lambda c: F.unix_micros(fn(c)), data_type)


def test_literal_texts(evaluate):
    got = read(evaluate, LITERALS)
    for text, value in zip(LITERALS, got, strict=True):
        assert value == micros(expected(text)), text


def test_generated_texts(evaluate):
    rng = random.Random(11)
    values = []
    for _ in range(800):
        day = rng.choice(["{:04}-{:02}-{:02}", "{:04}{:02}{:02}"]).format(rng.randint(1, 9999), rng.randint(1, 13), rng.randint(1, 31))
        if rng.random() < 0.3:
            day = rng.choice(["{:04}-W{:02}-{}", "{:04}W{:02}{}"]).format(rng.randint(1990, 2040), rng.randint(0, 54), rng.randint(0, 8))
        clock = rng.choice(["", "T{:02}", "T{:02}:{:02}", " {:02}:{:02}:{:02}", "T{:02}{:02}{:02}", "T{:02}:{:02}:{:02}.{:04}"])
        clock = clock.format(rng.randint(0, 24), rng.randint(0, 60), rng.randint(0, 60), rng.randint(0, 9999))
        zone = rng.choice(["", "Z", "+01:00", "-0530", "+14", "-23:59", "+01:02:03"]) if clock else ""
        values.append(day + clock + zone)
    got = read(evaluate, values)
    for text, value in zip(values, got, strict=True):
        try:
            want = micros(expected(text))
        except OverflowError:  # the zone moves it out of Python's calendar
            continue
        assert value == want, text


def test_epochs(evaluate):
    values = [1735689600.0, 1735689600000.0, 0.0, -1.0, 1.5, 1e10, 10000000001.0, 1e18, float("nan"), float("inf"), None, 1735689600.123456]
    want = [micros(datetime(2025, 1, 1, tzinfo=timezone.utc))] * 2 + [None, None, 1_500_000, 10**16, 10000000001000]
    want += [None, None, None, None, 1735689600123456]
    assert read(evaluate, values, D.parse_epoch, "double") == want


def test_utc_day_goes_through_the_instant(evaluate):
    values = ["2024-12-31T23:30:00-05:00", "2025-01-01", None]
    assert evaluate(values, lambda c: D.utc_date(c, "string")) == [date(2025, 1, 1), date(2025, 1, 1), None]
    assert evaluate([5], lambda c: D.utc_date(c, "int"), "int") == [None]
