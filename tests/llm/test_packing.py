import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from guichet.llm import packing
from guichet.llm.queries import public_vocabulary
from tests.llm.conftest import texts

PATH = public_vocabulary("word_bpe_49k.json")


def ids_of(text, path=PATH):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_agrees_with_the_tokenizer(name):
    r = random.Random(3)
    latin = [chr(i) for i in range(256)] + list("'s't're've'm'll'd") + [" "] * 30 + list("etaoinshr") * 10
    wide = [*latin, *(chr(r.randrange(0x100, 0x3000)) for _ in range(300)), "́", "İ", "Σ", "ς", " ", "　", "​", "<|endoftext|>"]
    found = ["".join(r.choice(a) for _ in range(r.randrange(80))) for a in (latin, wide) for _ in range(1500)]
    encoder, tokenizer = packing.Encoder(public_vocabulary(name), 1), Tokenizer.from_file(public_vocabulary(name))
    for at in range(0, len(found), 64):
        part = found[at : at + 64]
        for text, ids in zip(part, encoder(part), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1], repr(text)


def check(rows, docs, tokens):
    """Every id in exactly one piece, sequences without gaps and within the limits."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    wanted = {d: ids_of(t) for d, t in docs}
    for doc, ids in wanted.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert set(pieces) == set(wanted)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= tokens
    return [sum(r["length"] for r in parts) for parts in sequences.values()]


@pytest.mark.parametrize("split", [True, False])
def test_round_trip(spark, split):
    docs = list(enumerate([*texts(1, 300, words=900), "", None]))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    lengths = check(packing.pack(df, PATH, split=split).collect(), docs, 2048)
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths)
    assert padding == 0 if split else padding < 0.05 * sum(lengths)


def test_limits_hold_at_the_same_time():
    limits, r = packing.Limits(tokens=100, segments=4, loss=50), random.Random(2)
    packer = packing.Packer(limits, split=False, pool=64)
    made, bins = 0, []
    for i in range(400):
        n = r.randint(1, 100)
        share = r.choice([0.0, 0.2, min(1.0, 50 / n)])
        packer.add([packing.Piece(i, 0, b"\0" * 4 * n, n, share)])
        made += 1
        while packer.ready():
            bins.append(packer.sequence())
    bins += packer.rest()
    assert sum(map(len, bins)) == made
    for b in bins:
        assert len(b) <= 4 and sum(p.length for p in b) <= 100
        assert sum(p.length * p.loss for p in b) <= 50 + 1e-6


def test_dot_product_prefers_the_piece_that_uses_what_is_left():
    packer = packing.Packer(packing.Limits(100, 10, 100), split=False, pool=8)
    packer.add([packing.Piece(0, 0, b"\0" * 4 * 60, 60, 1.0), packing.Piece(1, 0, b"\0" * 4 * 40, 40, 1.0), packing.Piece(2, 0, b"\0" * 4 * 40, 40, 0.0)])
    assert [p.doc for p in packer.sequence()] == [0, 1]


def test_loss_share_and_ids(spark):
    df = spark.createDataFrame([(1, "a b c d", 0.5), (2, "e f", None)], "doc_id long, text string, w double")
    rows = packing.pack(df.coalesce(1), PATH, loss_share="w", with_ids=True).collect()
    assert {r["doc_id"]: (r["ids"], r["loss_tokens"]) for r in rows if r["start"] == 0 and r["length"] == r["doc_tokens"]}.items() <= {1: (ids_of("a b c d"), 2), 2: (ids_of("e f"), 3)}.items()


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack(odd_docs, PATH).collect()
    total = sum(len(ids_of(r["text"])) for r in odd_docs.select("text").collect())
    assert sum(r["length"] for r in rows) == total
    assert [r["length"] for r in rows if r["doc_id"] == 1] == [1]
    assert packing.pack(no_docs, PATH).count() == 0


def test_the_pool_gives_the_best_fit_each_time():
    rng = np.random.default_rng(5)
    limits = packing.Limits(100, 6, 80)
    lengths, shares = rng.integers(1, 60, 300).tolist(), rng.random(300).tolist()
    packer = packing.Packer(limits, False, 64)
    packer.add([packing.Piece(i, 0, bytes(4 * n), n, s) for i, (n, s) in enumerate(zip(lengths, shares, strict=True))])
    left, full = dict(enumerate(zip(lengths, shares, strict=True))), np.array([100, 6, 80], float)
    while packer.pieces:
        free, want = full.copy(), []
        while fitting := [i for i, (n, s) in left.items() if i not in want and (np.array([n, 1, n * s]) <= free + 1e-9).all()]:
            scores = np.array([[n, 1, n * s] for n, s in map(left.get, fitting)]) / full @ (free / full)
            want.append(fitting[int(scores.argmax())])
            free -= [left[want[-1]][0], 1, left[want[-1]][0] * left[want[-1]][1]]
        assert [p.doc for p in packer.sequence()] == want
        left = {i: v for i, v in left.items() if i not in want}
    assert not left
