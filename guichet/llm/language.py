"""Language identification with unigram pieces, summed over every segmentation of a word.

Each language has a probability for every piece of a fixed public vocabulary. The
probability of a word is the sum over all ways to cut it into pieces, which the forward
algorithm adds up in one pass; a text's is the product over its words. Piece probabilities
come from expectation maximisation over the same lattices.

A word is a run of letters, lower-cased, with the vocabulary's word mark in front. A letter
that is no piece by itself counts as the unknown piece.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guichet.llm.store import bounded_batches, carried, restored, written

_WORD = re.compile(r"[^\W\d_]+")
_MARK = "▁"
_ROWS = 2048  # words in one lattice at a time
_CACHE = 200_000  # words whose score a task remembers
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """Numbers of the pieces, looked up by a hash of their letters for whole arrays at a time.

    Each hash is in one of two places of a table that is filled to less than a quarter.
    """

    def __init__(self, pieces: list[str]) -> None:
        self.number = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.bits = max(4, (4 * len(pieces)).bit_length())
        self.keys, self.rows = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        for p, row in self.number.items():
            h = self.start(1)
            for c in p:
                h = self.extended(h, np.array([ord(c)], np.uint64))
            key, at = h[0], 0
            for _ in range(1000):
                at = self._places(key)[0] if at != self._places(key)[0] else self._places(key)[1]
                key, self.keys[at] = self.keys[at], key
                row, self.rows[at] = self.rows[at], row
                if not key:
                    break
            else:
                raise ValueError("the vocabulary does not fit")

    def __len__(self) -> int:
        return len(self.number)

    @staticmethod
    def start(n: int) -> np.ndarray:
        return np.ones(n, np.uint64)

    @staticmethod
    def extended(hashes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Hashes of strings one letter longer; letters in front or behind give different strings, the order counts."""
        h = (hashes ^ letters) * _MULTIPLY
        return h ^ (h >> np.uint64(31))

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64), (h & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def rows_of(self, hashes: np.ndarray, none: int) -> np.ndarray:
        one, two = self._places(hashes)
        out = np.where(self.keys[two] == hashes, self.rows[two], np.int32(none))
        return np.where(self.keys[one] == hashes, self.rows[one], out)


@dataclass
class Model:
    """langs: sorted; table: probability by piece and language.

    The last two rows of the table are the unknown piece and the impossible one.
    """

    langs: list[str]
    pieces: Pieces
    table: np.ndarray


def vocabulary(path: str) -> Pieces:
    """The lower-cased letter pieces of a sentencepiece model, numbered."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
    kept = {p for p in pieces if _WORD.fullmatch(p.removeprefix(_MARK)) or p == _MARK}
    return Pieces(sorted(kept))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _lattice(words: list[str], pieces: Pieces) -> np.ndarray:
    """Row numbers of all pieces of words of one length: word by span, spans by end and growing length."""
    length, n, unknown = len(words[0]), len(words), len(pieces)
    letters = np.array(words, f"U{length}").view(np.uint32).reshape(n, length).astype(np.uint64)
    longest = min(length, pieces.longest)
    by_size = []
    hashes = np.ones((n, length), np.uint64)
    for size in range(1, longest + 1):  # hashes[:, s]: the string of this size that starts at s
        hashes = pieces.extended(hashes[:, : length - size + 1], letters[:, size - 1 :])
        rows = pieces.rows_of(hashes, unknown + 1)
        by_size.append(np.where(rows == unknown + 1, unknown, rows) if size == 1 else rows)
    columns = [by_size[size - 1][:, end - size] for end in range(1, length + 1) for size in range(1, min(end, longest) + 1)]
    return np.stack(columns, axis=1)


def _forward(ids: np.ndarray, length: int, longest: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward sums by word, end and language, and the logarithm of what was divided out of the last one."""
    n, langs = len(ids), table.shape[1]
    sums, logs, at = np.zeros((n, length + 1, langs)), np.zeros((n, langs)), 0
    sums[:, 0] = 1
    for end in range(1, length + 1):
        k = min(end, longest)
        sums[:, end] = np.einsum("nkl,nkl->nl", table[ids[:, at : at + k]], sums[:, end - k : end][:, ::-1])
        at += k
        if end % 8 == 0:  # all that later ends can reach stays in one scale
            scale = sums[:, end].copy()
            sums[:, max(0, end - longest) : end + 1] /= scale[:, None]
            logs += np.log(scale)
    return sums, logs


def _by_length(words: list[str]) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    for length, group in groups.items():
        step = max(1, _ROWS * 8 // (8 + length))
        yield from (group[i : i + step] for i in range(0, len(group), step))


def word_scores(words: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """The words in another order, and the log probability of each by language."""
    out, scores = [], [np.zeros((0, len(model.langs)))]
    for group in _by_length([_MARK + w for w in words]):
        length = len(group[0])
        if length > 256:
            out += [w[1:] for w in group]
            scores += [_long_score(w, model)[None] for w in group]
            continue
        sums, logs = _forward(_lattice(group, model.pieces), length, model.pieces.longest, model.table)
        out += [w[1:] for w in group]
        scores.append(np.log(sums[:, length]) + logs)
    return out, np.concatenate(scores)


def _long_score(word: str, model: Model) -> np.ndarray:
    """One very long word with the sums of the last few ends only, in memory that does not grow with it."""
    longest, get, unknown = model.pieces.longest, model.pieces.number.get, len(model.pieces)
    last, logs = [np.ones(model.table.shape[1])], np.zeros(model.table.shape[1])
    for end in range(1, len(word) + 1):
        now = np.zeros_like(logs)
        for k in range(1, min(end, longest) + 1):
            piece = get(word[end - k : end], unknown if k == 1 else -1)
            if piece >= 0:
                now = now + model.table[piece] * last[-k]
        last = [*last[-longest + 1 :], now] if longest > 1 else [now]
        if end % 8 == 0:
            logs, last = logs + np.log(now), [x / now for x in last]
    return np.log(last[-1]) + logs


def _expected(words: list[str], counts: np.ndarray, pieces: Pieces, column: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece, from forward and backward sums."""
    total = np.zeros(len(pieces) + 2)
    count = dict(zip(words, counts, strict=True))
    for group in _by_length(words):
        length, n, longest = len(group[0]), len(group), pieces.longest
        ids = _lattice(group, pieces)
        p = column[ids]
        sums = np.ones((n, length + 1))
        ends = np.cumsum([0, *(min(e, longest) for e in range(1, length + 1))])
        for end in range(1, length + 1):
            k = min(end, longest)
            sums[:, end] = (p[:, ends[end - 1] : ends[end]] * sums[:, end - k : end][:, ::-1]).sum(1)
        back = np.zeros((n, length + 1))
        back[:, length] = np.array([count[w] for w in group]) / sums[:, length]
        for end in range(length, 0, -1):
            k = min(end, longest)
            used = p[:, ends[end - 1] : ends[end]] * back[:, end][:, None]
            back[:, end - k : end] += used[:, ::-1]
            part = used * sums[:, end - k : end][:, ::-1]
            total += np.bincount(ids[:, ends[end - 1] : ends[end]].ravel(), part.ravel(), len(total))
    return total


def _count_words(text: str, lang: str, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for t, g in zip(batch[text].to_pylist(), batch[lang].to_pylist(), strict=True):
                seen.update((g, w[at : at + longest]) for w in words_of(t) for at in range(0, len(w), longest))
            if seen:
                langs, words = zip(*seen, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(seen.values(), pa.int64())], ["lang", "word", "n"])

    return run


def _shares(rows: dict[str, int], sample_docs: int, least_docs: int) -> dict[str, float]:
    """The share of each language's rows to learn from: the same for all, more where that gives too few."""
    common = sample_docs / max(sum(rows.values()), 1)
    return {g: min(1.0, max(common, least_docs / n)) for g, n in rows.items()}


def fit(
    docs: DataFrame,
    vocabulary_path: str,
    *,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    sample_docs: int = 20_000,
    least_docs: int = 500,
    longest_word: int = 40,
    rounds: int = 3,
    smoothing: float = 0.01,
) -> Model:
    """Learn the piece probabilities of each non-null language of ``docs``.

    The fit uses about ``sample_docs`` labelled rows, chosen by a hash of ``key`` and the
    text, and where that is less, about ``least_docs`` of each language (all, if there are
    fewer). Words of more than ``longest_word`` letters are learned in parts of that length. Word
    counts and expected counts are added up by Spark; the driver gets sums by piece and
    language only, at most vocabulary times languages. Rows with null text or language teach
    nothing; without any labelled row the model has no language.
    """
    bounded_batches(docs)
    hashed = F.xxhash64(key, text) / F.lit(2.0**64) + 0.5
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), hashed.alias("h")).filter("text is not null and lang is not null")
    spark = docs.sparkSession
    # One number per language, as many as the model has columns.
    rows = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    shares = _shares(rows, sample_docs, least_docs)
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))[F.col("lang")] if shares else F.lit(0.0)
    sample = labelled.filter(F.col("h") <= share).select("text", "lang")
    counted = sample.mapInArrow(_count_words("text", "lang", longest_word), "lang string, word string, n long")
    words = written(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    pieces = vocabulary(vocabulary_path)
    size = len(pieces) + 2
    table = np.full((size, len(langs)), 1.0 / (size - 1))
    table[-1] = 0
    for _ in range(rounds if langs else 0):
        held = spark.sparkContext.broadcast((langs, pieces, table))

        def expect(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            langs, pieces, table = held.value
            for batch in batches:
                frame = batch.to_pandas()
                for g, part in frame.groupby("lang"):
                    total = _expected([_MARK + w for w in part["word"]], part["n"].to_numpy(float), pieces, table[:, langs.index(g)])
                    used = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays([pa.array([langs.index(g)] * len(used), pa.int32()), pa.array(used, pa.int32()), pa.array(total[used])], ["lang", "piece", "n"])

        sums = words.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        table = np.full((size, len(langs)), smoothing)
        for r in sums:
            table[r["piece"], r["lang"]] += r["n"]
        table[-1] = 0
        table /= table.sum(0)
    return Model(langs, pieces, table)


def predictor(spark, model: Model):
    """A column function: text to a struct of lang_pred and score.

    lang_pred is the learned language under which the text is likeliest (the first in
    order, if several are), score its probability when all languages are equally likely
    beforehand. Null text, text without letters, and any text if no language was learned
    give ``und`` with score 0. A letter counts the same wherever it stands: order and
    repetition of rows change nothing.
    """
    held = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = held.value
        known: dict[str, int] = {}
        table = np.zeros((_CACHE, len(model.langs)))
        for texts in batches:
            langs, scores = [], []
            for at in range(0, len(texts), 256):
                split = [words_of(t) for t in texts.iloc[at : at + 256]]
                new = set().union(*split).difference(known) if model.langs else set()
                if len(known) + len(new) > _CACHE:
                    new, known = set().union(*split), {}
                    table = np.zeros((max(_CACHE, len(new)), len(model.langs)))
                if new:
                    words, scores_of = word_scores(list(new), model)
                    table[len(known) : len(known) + len(words)] = scores_of
                    known.update(zip(words, range(len(known), len(known) + len(words)), strict=True))
                for ws in split:
                    if not ws or not model.langs:
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    logs = table[np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))].sum(0)
                    best = int(logs.argmax())
                    langs.append(model.langs[best])
                    scores.append(float(1 / np.exp(logs - logs[best]).sum()))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    udf = F.pandas_udf(_typed(predict), "lang_pred string, score double")
    return lambda column: udf(column)


def _typed(predict):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from predict(batches)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return run


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; columns of these names are replaced, all others stay."""
    bounded_batches(docs)
    made = predictor(docs.sparkSession, model)(F.col(f"`{text}`"))
    found = docs.select(carried(docs, "lang_pred", "score"), made.alias("_made"))
    return found.select(*restored(docs, "lang_pred", "score"), "_made.lang_pred", "_made.score")
