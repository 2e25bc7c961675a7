"""Packing of tokenised examples into training sequences by vector bin packing.

An example takes up three resources of a sequence: tokens, a segment, and loss-bearing
tokens. One sequence is filled at a time: of the pieces that fit, the one with the largest
dot product between its demand and what is left in the sequence comes next, both as shares
of the limits. The pieces to choose from are those of a bounded pool that is refilled from
the partition's rows, so a task needs no more memory when there are more rows.

Tokenisers that never join across white space get one word at a time and remember them.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from guichet.llm.store import bounded_batches

# str.split() and Python's patterns also cut at four control characters, which tokenisers take for symbols.
_NO_SPACE = re.compile("[\x1c-\x1f]")
# Letters, single digits and runs of symbols of lower-cased Latin-1, behind the usual English endings.
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")


def _byte_letters() -> list[str]:
    """The character that byte-level vocabularies use for each byte: itself if visible, else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


class Encoder:
    """Token ids as unsigned 32-bit integers, the closing id behind each text.

    A tokeniser whose pieces never span white space, which is seen from its file, gets the
    different words of a text only. If it also lower-cases and splits as the pattern above,
    texts in Latin-1 are split here, and their different pieces go straight to its merges.
    """

    def __init__(self, path: str, closing: int, remembered: int = 200_000) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        normal, split = described.get("normalizer") or {}, described.get("pre_tokenizer") or {}
        kinds = [x.get("type") for x in split.get("pretokenizers", [])]
        rule = next((x for x in split.get("pretokenizers", []) if x.get("type") == "Split"), {})
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        self.by_word = kinds == ["Split", "ByteLevel"] and rule.get("invert") and rule.get("pattern") == {"Regex": pattern}
        self.by_piece = self.by_word and [x["type"] for x in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        bare = described | {"normalizer": None, "added_tokens": [], "pre_tokenizer": None}
        self.bare = Tokenizer.from_str(json.dumps(bare)) if self.by_piece else None
        letters = _byte_letters()
        self.bytewise = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}
        self.marks = [t["content"] for t in described.get("added_tokens", [])]
        self.closing = array("I", [closing]).tobytes()
        self.remembered = remembered
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> bool:
        if not self.by_piece or any(m in text for m in self.marks):
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def _learned(self, known: dict[str, bytes], split: list[list[str]], tokenizer, prepare) -> None:
        """Add the ids of all words of ``split`` that are not known."""
        if len(known) > self.remembered:
            known.clear()
        new = list(set().union(*split).difference(known))
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            known.update(zip(part, self._ids(tokenizer, prepare(part)), strict=True))

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        pieces: dict[int, list[str]] = {}
        words: dict[int, list[str]] = {}
        for i, t in enumerate(texts):
            if not t or not self.by_word or _NO_SPACE.search(t):
                continue
            if self._plain(t):
                pieces[i] = _PIECE.findall(t.lower())
            else:
                words[i] = t.split()
        self._learned(self.pieces, list(pieces.values()), self.bare, lambda part: [p if p.isascii() and p.isprintable() else p.translate(self.bytewise) for p in part])
        self._learned(self.words, list(words.values()), self.tokenizer, lambda part: part)
        for i, t in enumerate(texts):
            if i in pieces:
                ids = b"".join(map(self.pieces.__getitem__, pieces[i]))
            elif i in words:
                ids = b"".join(map(self.words.__getitem__, words[i]))
            else:
                ids = self._ids(self.tokenizer, [t])[0] if t else b""
            yield ids + self.closing


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most. A piece has one segment; its loss-bearing tokens may be fewer than its tokens."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@dataclass
class Piece:
    doc: object
    start: int
    ids: bytes
    total: int
    loss: float  # loss-bearing share of its tokens

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, length: int) -> tuple[Piece, Piece]:
        first, second = self.ids[: 4 * length], self.ids[4 * length :]
        return Piece(self.doc, self.start, first, self.total, self.loss), Piece(self.doc, self.start + length, second, self.total, self.loss)


class Packer:
    """Fills sequences from a pool; ``split`` allows pieces to be cut where one no longer fits."""

    def __init__(self, limits: Limits, split: bool, pool: int) -> None:
        self.limits, self.split, self.pool = limits, split, pool
        self.full = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.pieces: list[Piece] = []
        self.demand = np.zeros((0, 3))

    def _need(self, piece: Piece) -> list[float]:
        return [piece.length, 1, piece.length * piece.loss]

    def add(self, pieces: list[Piece]) -> None:
        self.pieces += pieces
        self.demand = np.concatenate([self.demand, np.array([self._need(p) for p in pieces], float).reshape(-1, 3)])

    def sequence(self) -> list[Piece]:
        """Take the next sequence's pieces out of the pool."""
        free, out, gone = self.full.copy(), [], np.zeros(len(self.pieces), bool)
        weighted = self.demand / self.full
        tokens, segments, loss = np.ascontiguousarray(self.demand.T)
        while True:
            room = free + 1e-9
            fits = (tokens <= room[0]) & (segments <= room[1]) & (loss <= room[2]) & ~gone
            if not fits.any():
                break
            score = np.where(fits, weighted @ (free / self.full), -1.0)
            best = int(score.argmax())
            out.append(self.pieces[best])
            gone[best] = True
            free -= self.demand[best]
        if self.split and free[0] >= 1 and free[1] >= 1 and not gone.all():
            best = int(np.where(gone, -1.0, self.demand[:, 0]).argmax())
            piece = self.pieces[best]
            length = int(min(free[0], free[2] / piece.loss if piece.loss > 0 else free[0], piece.length - 1))
            if length >= 1:
                first, second = piece.cut(length)
                out.append(first)
                self.pieces[best] = second
                self.demand[best] = self._need(second)
        keep = ~gone
        self.pieces, self.demand = list(compress(self.pieces, keep.tolist())), self.demand[keep]
        return out

    def ready(self) -> bool:
        return len(self.pieces) >= self.pool

    def rest(self) -> Iterator[list[Piece]]:
        """The sequences of what is left. With ``split``, the last one is cut to powers of two, which need no padding."""
        while self.pieces:
            out = self.sequence()
            if not out:
                raise ValueError("a piece exceeds the limits by itself")
            length = sum(p.length for p in out)
            if not self.split or self.pieces or length == self.limits.tokens:
                yield out
                continue
            while out:
                want, part = 1 << (length.bit_length() - 1), []
                length -= want
                while want:
                    piece = out.pop(0)
                    if piece.length > want:
                        piece, second = piece.cut(want)
                        out.insert(0, second)
                    want -= piece.length
                    part.append(piece)
                yield part


def _parts(piece: Piece, limits: Limits) -> Iterator[Piece]:
    """The piece in parts that fit into an empty sequence."""
    most = limits.tokens if piece.loss * limits.tokens <= limits.loss else max(1, int(limits.loss / piece.loss))
    while piece.length > most:
        first, piece = piece.cut(most)
        yield first
    yield piece


_OUT = ("start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset")


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    loss_share: str | None = None,
    closing: int = 1,
    limits: Limits = Limits(),
    split: bool = True,
    pool: int = 1024,
    remembered: int = 200_000,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a file of the ``tokenizers`` library; ``loss_share`` names a
    column with the share of a document's tokens that bear loss (null: 1). Longer documents
    than a sequence are cut into whole sequences and a rest. With ``split``, rests are cut
    too: all sequences are full but where segments or loss run out first, and the last ones
    of a partition, which have lengths that are powers of two. Without it only documents
    longer than a sequence are cut. ``remembered`` is the number of words whose ids a worker
    keeps, some 200 bytes each, before it starts anew. ``with_ids`` adds the ids as an array.

    Null and empty text have the closing id only. Repeated rows are packed as often as they
    occur, null identifiers like others. Sequences are numbered by partition and order, and
    depend on the partition's rows alone. An empty table gives no rows.
    """
    bounded_batches(docs)
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType
    fields = [StructField(key, kind), *(StructField(n, LongType()) for n in _OUT)]
    schema = StructType(fields)
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    share = F.coalesce(F.col(f"`{loss_share}`").cast("double"), F.lit(1.0)) if loss_share else F.lit(1.0)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), share.alias("loss"), F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, closing, remembered)
        packer, made, base = Packer(limits, split, pool), 0, 0
        found: list[tuple] = []

        def put(pieces: list[Piece]) -> None:
            nonlocal made
            at = 0
            for p in pieces:
                row = (p.doc, p.start, p.length, zlib.crc32(p.ids), p.total, round(p.length * p.loss), base + made, at)
                found.append((*row, np.frombuffer(p.ids, "<i4")) if with_ids else row)
                at += p.length
            made += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True))
            found.clear()
            arrays = [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        for batch in batches:
            if not batch.num_rows:
                continue
            base = batch["part"][0].as_py() << 33
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts, keys, losses = (part[c].to_pylist() for c in ("text", "key", "loss"))
                for doc, loss, ids in zip(keys, losses, encoder(texts), strict=True):
                    *whole, rest = _parts(Piece(doc, 0, ids, len(ids) // 4, min(1.0, max(0.0, loss))), limits)
                    for p in whole:
                        put([p])
                    if rest.length == limits.tokens:
                        put([rest])
                    else:
                        packer.add([rest])
                while packer.ready():
                    put(packer.sequence())
                if len(found) >= 10_000 or with_ids and found:
                    yield flush()
        for pieces in packer.rest():
            put(pieces)
        if found:
            yield flush()

    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    return rows.mapInArrow(run, schema)


_encoders: dict[tuple[str, int, int], Encoder] = {}


def _encoder(path: str, closing: int, remembered: int) -> Encoder:
    """One per worker process; loading it takes longer than a small task."""
    if (path, closing, remembered) not in _encoders:
        _encoders[path, closing, remembered] = Encoder(path, closing, remembered)
    return _encoders[path, closing, remembered]
