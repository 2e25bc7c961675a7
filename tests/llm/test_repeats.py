import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from guichet.llm import repeats
from guichet.llm.store import written
from tests.llm.conftest import texts


def brute_force(found, window):
    data = [(t or "").encode("utf-8", "surrogatepass") for t in found]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        covered = np.zeros(len(d), bool)
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                covered[i : i + window] = True
        runs = int((np.diff(covered.astype(int), prepend=0) == 1).sum())
        out.append((len(d), int(covered.sum()), runs, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~covered])).hexdigest()))
    return out


def check(spark, found, window=400, **options):
    df = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(df, window=window, **options).collect()}
    want = brute_force(found, window)
    assert [got[i] for i in range(len(found))] == want
    return want


@pytest.mark.parametrize(("window", "seed"), [(400, 1), (64, 2), (100, 3)])
def test_same_as_brute_force(spark, window, seed):
    """Passages of about the window's length, at the ends and within, in copies and next to changed letters."""
    r = random.Random(seed)
    passages = ["".join(r.choice("abcde é") for _ in range(n)) for n in (window - 1, window, window + 1, 2 * window, 3 * window + 7)]
    found = []
    for t in texts(seed, 60, words=80):
        for _ in range(r.randint(0, 3)):
            p, at = r.choice(passages), r.randint(0, len(t))
            if r.random() < 0.3:
                i = r.randrange(len(p))
                p = p[:i] + "#" + p[i + 1 :]
            t = t[:at] + p + t[at:]
        found.append(t)
    found += found[:5] + [passages[1], passages[3] * 2, passages[1] + "x", "y" + passages[1]]
    want = check(spark, found, window)
    assert sum(w[1] for w in want) > 1000


def test_repetition_within_a_text(spark):
    line = "the same line over and over again, "
    check(spark, [line * 40, "a" * 1500, "ab" * 300, "b" * 399, "b" * 400, "x" + "a" * 401, "".join(texts(9, 30))])


def test_windows_that_several_partners_cover(spark):
    r = random.Random(4)
    base = "".join(r.choice("abcdefgh") for _ in range(1200))
    check(spark, [base, base[:450] + "!" + base[451:], base[300:800], "?" + base[500:1000] + "?", base[799:], base[:401]])


def test_anchors_do_not_depend_on_segments(monkeypatch):
    data = "".join(random.Random(6).choice("abc ") for _ in range(30_000)).encode()
    whole = repeats.anchors(data, 400)
    monkeypatch.setattr(repeats, "_SEGMENT", 4096)
    cut = repeats.anchors(data, 400)
    owner = lambda runs: [a for a, first, last in runs for _ in range(first, last + 1)]
    assert owner(whole) == owner(cut) and len(owner(whole)) == len(data) - 399


def test_odd_rows(spark, odd_docs, no_docs):
    found = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    got = Counter(map(tuple, repeats.remove_repeats(odd_docs).collect()))
    short = [(d, t if len(t or "") < 10_000 else None) for d, t in found]
    want = [(d, *w) for (d, _), w in zip(found, brute_force([t for _, t in short], 400), strict=True)]
    assert all(got[w] for w, (_, t) in zip(want, short, strict=True) if t is not None)
    long = {r[0]: r for r in got if r[0] in (7, 8)}
    assert long[7][1:4] == (long[7][1], long[7][1], 1) and long[8][2] == long[7][1]
    assert repeats.remove_repeats(no_docs).count() == 0
    with pytest.raises(ValueError):
        repeats.repeated_spans(odd_docs, window=32)


def test_equal_texts_are_written_once(spark, monkeypatch):
    """However many copies a text has, its windows are split from one of them."""
    tables = []

    def counted(df):
        tables.append(written(df))
        return tables[-1]

    monkeypatch.setattr(repeats, "written", counted)
    r = random.Random(9)
    text = "".join(r.choices("abcdefgh ", k=3000))
    found = [text] * 300 + [text[:1500] + "#" + text[1500:], text[:700] + "##" + text[700:]]
    df = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string").repartition(3)
    rows = {x["doc_id"]: x for x in repeats.remove_repeats(df).collect()}
    assert {x["n_removed"] for i, x in rows.items() if i < 300} == {3000} and rows[300]["n_removed"] == 3000 == rows[301]["n_removed"]
    with_text = [t for t in tables if "text" in t.columns]
    assert len(with_text) == 1 and with_text[0].count() <= 3


def test_copies_do_not_meet_in_one_task(spark, monkeypatch):
    """By text, only a row per range is brought together, and the join with whole texts can split one with many copies."""
    tables = []

    def counted(df):
        tables.append(written(df))
        return tables[-1]

    monkeypatch.setattr(repeats, "written", counted)
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in options}
    r = random.Random(11)
    text = "".join(r.choices("abcdefgh ", k=3000))
    others = ["".join(r.choices("abcdefgh ", k=300)) for _ in range(40)]
    found = [text] * 300 + [text[:1500] + "#" + text[1500:], text[:700] + "##" + text[700:], *others]
    df = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string").repartition(8)
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        out = repeats.remove_repeats(df)
        rows = {x["doc_id"]: x["n_removed"] for x in out.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [rows[i] for i in range(len(found))] == [3000] * 302 + [0] * 40
    by_text = [t for t in tables if "sha" in t.columns and "at" in t.columns]
    assert len(by_text) == 1 and 0 < by_text[0].count() < 100
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
