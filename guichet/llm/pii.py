"""Surrogates for personal data: keyed, of the same kind and format, distinct and coreferent.

An entity is a kind and a canonical form: the digits of a phone number, the lower-cased
address, a surname. Its surrogate comes from a keyed digest of both and of the number of the
attempt, so that one entity has one surrogate in the whole corpus, however its mentions are
written. Collision checks run over the table of distinct entities: a surrogate that is some
entity's real form, or another entity's surrogate, is given up for the next attempt's.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guichet.llm.store import bounded_batches, carried, restored, written

GIVEN = {
    ("f", "Latin"): "Anna Maria Mary Emma Laura Julia Sarah Claire Sophie Elena Carmen Lucia Marta Petra Ingrid Helga Monique Nathalie Rachel Susan Linda Karen Alice Helen Jane",
    ("m", "Latin"): "John James Robert Michael William David Thomas Peter Paul Pierre Jean Hans Klaus Stefan Jürgen Carlos Juan Miguel Pablo Antonio Daniel Martin George Henry Frank",
    ("f", "Cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Юлия Екатерина",
    ("m", "Cyrillic"): "Иван Сергей Алексей Дмитрий Николай Михаил Андрей Владимир Павел Олег",
    ("f", "Greek"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Βασιλική",
    ("m", "Greek"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παναγιώτης",
}
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Г-н Господин Κύριος",
    "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra Srta Г-жа Госпожа Κυρία",
    "n": "Dr Prof",
}
_SYMBOLS = "+/_.=-"
_PRIVATE = [ipaddress.ip_network(block) for block in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")]
_GENDER = {name: gender for (gender, _), names in GIVEN.items() for name in names.split()}
_TITLE = {title: gender for gender, titles in TITLES.items() for title in titles.split()}
_SYLLABLES = {
    "Latin": "ba be bo da de do fa fe ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve vo",
    "Cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то ва ве во",
    "Greek": "βα βε βο δα δε δο κα κε κο λα λε λο μα με μο να νε νο ρα ρε ρο σα σε σο τα τε το",
}
_ENDING = {("f", "Latin"): "na", ("m", "Latin"): "ner", ("f", "Cyrillic"): "на", ("m", "Cyrillic"): "нор", ("f", "Greek"): "να", ("m", "Greek"): "νος"}
_CAP = r"[A-ZÀ-ÖØ-ÞΆ-ΫА-ЯЁ][^\W\d_]*(?:['’-][^\W\d_]+)*"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

_AMERICAN = r"1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"

PATTERNS: list[tuple[str, re.Pattern]] = [
    ("email", re.compile(r"[\w.+%-]*[\w+%-]@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)*\.[^\W\d_]{2,}")),
    ("secret", re.compile(r"(?:(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|private[_-]?key)\w*[\"']?\s*[=:]\s*[\"']?)(?P<own>[A-Za-z0-9+/_.=-]{8,})")),
    ("secret", re.compile(r"(?<![A-Za-z0-9])(?P<own>(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,})")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("ip6", re.compile(rf"(?:(?<![\w:])|(?<=[^\W0-9A-Fa-f]:)|(?<=[Vv]6:))(?:[0-9A-Fa-f]{{0,4}}:){{2,8}}(?:(?:{_OCTET}\.){{3}}{_OCTET}|[0-9A-Fa-f]{{1,4}}|(?<=::)(?<!:::))(?!\w|:[\w:])")),
    ("ip4", re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)")),
    ("phone", re.compile(rf"(?<![\w+])\+{_AMERICAN}")),
    ("phone", re.compile(rf"(?<![\w+])\+(?!{_AMERICAN})\d{{1,3}}(?:[ .-]?\(\d{{1,4}}\)|[ .-]?\d{{1,4}})(?:[ .-]?\d{{2,4}}){{1,4}}(?!\d|\.\d)")),
    ("phone", re.compile(r"(?<![\w+])(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4}(?!\d)")),
    ("phone", re.compile(r"(?<![\w+])0\d(?:[ .-]\d{2}){4}(?!\d)")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("account", re.compile(r"(?<!\w)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?!\w)")),
]
_TITLED = re.compile(rf"(?<!\w)(?P<title>{'|'.join(sorted(map(re.escape, _TITLE), key=len, reverse=True))})\b\.? +(?P<names>{_CAP}(?: +{_CAP}){{0,2}})")
_NAMED = re.compile(rf"(?<![\w@.])(?P<names>(?:{'|'.join(_GENDER)}) +{_CAP})")


def _marks() -> str:
    """What any of the above needs, for Java's and Python's engines alike.

    Words are only tried at capital letters, which makes the search one pass over the
    characters and not one per word.
    """
    names = sorted({*map(re.escape, _TITLE), *_GENDER}, key=len, reverse=True)
    return rf"[0-9@:=_]|(?=[A-ZÀ-ÞΆ-ΫЀ-Я])(?:(?:{'|'.join(names)})\.? |AKIA|ASIA)|xox[abpr]-"


MARKS = _marks()


@dataclass(frozen=True)
class Mention:
    first: int
    last: int
    kind: str
    canonical: str


def script_of(text: str) -> str:
    for c in text:
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "Greek"
        if "Ѐ" <= c <= "ӿ":
            return "Cyrillic"
    return "Latin"


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _canonical(kind: str, text: str) -> str:
    if kind in ("phone", "ssn", "account"):
        return ("+" if text.startswith("+") else "") + _digits(text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ip6":
        return ipaddress.ip_address(text).packed.hex(":", 2)
    return text if kind == "secret" else text.lower()


def _address(text: str) -> bool:
    """Whether it is an IPv6 address of somebody: not ::, ::1, nor the ::2 of a slice."""
    try:
        address = ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return not (text.startswith("::") and "." not in text and int(address) < 1 << 32)


def _drawn(text: str) -> bool:
    """Whether what stands where a secret would is a blank to fill in or a ruled line."""
    return not any(c.isalnum() for c in text) and len(set(text)) < 3


def _names(match: re.Match) -> Iterator[Mention]:
    """A mention per name: the last is the surname, those before are given names of the title's or the name's gender."""
    titled = _TITLE.get(match.groupdict().get("title") or "", "n")
    parts = [(m.start() + match.start("names"), m.group()) for m in re.finditer(r"\S+", match["names"])]
    own = next((_GENDER[p] for _, p in parts if p in _GENDER), "n")
    gender = titled if titled != "n" else own
    for i, (at, name) in enumerate(parts):
        name = re.sub("['’]s$", "", name)
        given = i < len(parts) - 1 or len(parts) == 1 and name in _GENDER
        kind = f"given-{gender}" if given else "surname"
        yield Mention(at, at + len(name), f"{kind}-{script_of(name)}", name.lower())


def _again(text: str, names: list[Mention]) -> Iterator[Mention]:
    """Each further place of a name as it is written there, of the kind that it has first; initials are no names."""
    known: dict[str, Mention] = {}
    for m in sorted(names, key=lambda m: m.first):
        if m.last - m.first > 1:
            known.setdefault(text[m.first : m.last], m)
    if known:
        taken = {m.first for m in names}
        either = "|".join(map(re.escape, sorted(known, key=len, reverse=True)))
        for m in re.finditer(rf"(?<!\w)(?:{either})(?!\w)", text):
            if m.start() not in taken:
                yield Mention(m.start(), m.end(), known[m.group()].kind, known[m.group()].canonical)


def mentions(text: str) -> list[Mention]:
    """All mentions in order, without overlaps: the one that begins first, then the longer one.

    A name that a title or a given name shows is one wherever else it stands in the text.
    One that begins inside another and ends behind it makes one secret of both, so that
    nothing of either is left.
    """
    found = []
    for kind, pattern in PATTERNS:
        for m in pattern.finditer(text):
            name = "own" if "own" in pattern.groupindex else 0
            if kind == "secret" and _drawn(m[name]) or kind == "ip6" and not _address(m[name]):
                continue
            found.append(Mention(m.start(name), m.end(name), kind, _canonical(kind, m[name])))
    names = [name for pattern in (_TITLED, _NAMED) for m in pattern.finditer(text) for name in _names(m)]
    found += [*names, *_again(text, names)]
    found.sort(key=lambda m: (m.first, -m.last))
    out: list[Mention] = []
    for m in found:
        if not out or m.first >= out[-1].last:
            out.append(m)
        elif m.last > out[-1].last:
            first = out.pop().first
            out.append(Mention(first, m.last, "secret", text[first : m.last]))
    return out


class _Stream:
    """Numbers from a keyed digest."""

    def __init__(self, key: bytes, *parts: object) -> None:
        self.state = hmac.new(key, "|".join(map(str, parts)).encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        self.pool = int.from_bytes(self.state, "big")

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            self.state = hashlib.sha256(self.state).digest()
            self.pool = int.from_bytes(self.state, "big")
        self.pool, out = divmod(self.pool, n)
        return out

    def pick(self, choices: str | list[str]) -> str:
        return choices[self.below(len(choices))]


def _like(text: str, s: _Stream) -> str:
    """Each letter by a letter of its case and script, each digit by a digit; the rest stays."""
    alphabets = {"Latin": "abcdefghijklmnopqrstuvwxyz", "Greek": "αβγδεζηθικλμνξοπρστυφχψω", "Cyrillic": "абвгдежзиклмнопрстуфхцчшэюя"}
    out = []
    for c in text:
        if c.isdigit():
            out.append(s.pick("0123456789"))
        elif c.isalpha():
            made = s.pick(alphabets[script_of(c)])
            out.append(made.upper() if c.isupper() else made)
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _number(kind: str, canonical: str, s: _Stream, attempt: int) -> str:
    digits = canonical.lstrip("+")
    if kind == "phone":
        keep = 0 if canonical == digits else 1 if digits[0] in "17" else 2
    else:
        keep = 1 if kind == "account" else 0
    length = len(digits) + max(0, attempt - 20)
    made = digits[:keep] + s.pick("23456789" if kind == "phone" else "123456789")
    made += "".join(s.pick("0123456789") for _ in range(length - len(made)))
    if kind == "account" and _luhn(digits[:-1]) == int(digits[-1]):
        made = made[:-1] + str(_luhn(made[:-1]))
    return ("+" if canonical.startswith("+") else "") + made


def _email(canonical: str, key: bytes, s: _Stream, attempt: int) -> str:
    local, _, domain = canonical.rpartition("@")
    made = _like(local, s) + "".join(s.pick("abcdefghijklmnopqrstuvwxyz") for _ in range(max(0, attempt - 2)))
    labels = domain.split(".")
    fixed = 2 if len(labels) > 1 and labels[-2] == "example" else 1
    other = _like(".".join(labels[:-fixed]), _Stream(key, "domain", domain))
    return f"{made}@{'.'.join(x for x in (other, *labels[-fixed:]) if x)}"


def _secret(canonical: str, s: _Stream, attempt: int) -> str:
    """Symbols are replaced too where there is nothing else."""
    more = max(0, attempt - 2)
    if not any(c.isalnum() for c in canonical):
        return "".join(s.pick(_SYMBOLS) for _ in range(len(canonical) + more))
    hexadecimal = re.fullmatch("[0-9a-f]+", canonical)
    made = "".join(s.pick("0123456789abcdef") for _ in canonical) if hexadecimal else _like(canonical, s)
    return made + "".join(s.pick("0123456789abcdef") for _ in range(more))


def _iban(canonical: str, s: _Stream, attempt: int) -> str:
    body = "".join(s.pick("0123456789") if c.isdigit() else s.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in canonical[4:])
    body += "".join(s.pick("0123456789") for _ in range(max(0, attempt - 20)))
    number = int("".join(str(int(c, 36)) for c in body + canonical[:2] + "00"))
    return f"{canonical[:2]}{98 - number % 97:02d}{body}"


def _ip4(canonical: str, s: _Stream, attempt: int) -> str:
    """Private addresses leave their two octets for their block, and that for all private ones, when it is full.

    Only with those full too any address will do, and at last one of IPv6.
    """
    own, address = canonical.split("."), ipaddress.ip_address(canonical)
    if attempt >= 40:
        return ":".join(["fd00", *(f"{s.below(65536):04x}" for _ in range(7))])
    if attempt >= 30:
        return str(ipaddress.ip_address(s.below(1 << 32)))
    if attempt >= 3 and address.is_private:
        blocks = [b for b in _PRIVATE if address in b and attempt < 5] or _PRIVATE
        at = s.below(sum(b.num_addresses for b in blocks))
        for block in blocks:
            if at < block.num_addresses:
                return str(block[at])
            at -= block.num_addresses
    keep = 1 if own[0] in ("10", "127") else 2 if address.is_private else 0
    public = [str(x) for x in range(1, 224) if x not in (10, 100, 127, 169, 172, 192, 198, 203)]
    made = own[:keep] or [s.pick(public)]
    return ".".join(made + [str(s.below(256)) for _ in range(4 - len(made))])


def _name(kind: str, s: _Stream, attempt: int) -> str:
    _, *rest = kind.split("-")
    script, gender = rest[-1], rest[0] if len(rest) > 1 else "n"
    syllables = _SYLLABLES[script].split()
    if kind.startswith("given"):
        gender = s.pick("fm") if gender == "n" else gender
        if attempt == 0:
            return s.pick(GIVEN[gender, script].split()).lower()
        made = "".join(s.pick(syllables) for _ in range(2 + attempt // 4))
        return made + _ENDING[gender, script]
    return "".join(s.pick(syllables) for _ in range(3 + attempt // 2))


def surrogate(kind: str, canonical: str, attempt: int, key: bytes) -> str:
    """Canonical form of the replacement; later attempts may be longer, so that some attempt is always free."""
    s = _Stream(key, kind, canonical, attempt)
    if kind in ("phone", "ssn", "account"):
        return _number(kind, canonical, s, attempt)
    if kind == "email":
        return _email(canonical, key, s, attempt)
    if kind == "iban":
        return _iban(canonical, s, attempt)
    if kind == "ip4":
        return _ip4(canonical, s, attempt)
    if kind == "ip6":
        return ":".join("0000" if group == "0000" and attempt < 4 else f"{1 + s.below(65535):04x}" for group in canonical.split(":"))
    if kind == "secret":
        return _secret(canonical, s, attempt)
    return _name(kind, s, attempt)


def _ip6_like(mention: str, made: str) -> str:
    """Shortened, with leading zeros, or with an end in octets, as the mention is."""
    tail = str(ipaddress.IPv4Address(int(ipaddress.IPv6Address(made)) & 0xFFFFFFFF)) if "." in mention else ""
    if "::" in mention:
        groups = made.split(":")
        short = ipaddress.IPv6Address(":".join([*groups[:6], "1", "1"]) if tail else made).compressed
        return short.removesuffix("1:1") + tail if tail else short
    out = made.split(":") if re.search(r"(?<![0-9A-Fa-f])0[0-9A-Fa-f]", mention) else [f"{int(x, 16):x}" for x in made.split(":")]
    return ":".join([*out[:6], tail] if tail else out)


def written_like(mention: str, kind: str, made: str) -> str:
    """The surrogate in the format of the mention it replaces."""
    if kind in ("phone", "ssn", "account", "iban"):
        left = list(made.lstrip("+"))
        slots = str.isalnum if kind == "iban" else str.isdigit
        out = [left.pop(0) if slots(c) and left else c for c in mention]
        return "".join(out + left)
    if kind == "secret":
        return made
    if kind == "ip6":
        made = _ip6_like(mention, made)
    if mention.isupper():
        return made.upper()
    return made.title() if kind.startswith(("given", "surname")) else made


def replaced(text: str, of: Callable[[str, str], str]) -> tuple[str, list[dict]]:
    """The text with surrogates, and their kinds and places in it."""
    out, spans, at, length = [], [], 0, 0
    for m in mentions(text):
        made = written_like(text[m.first : m.last], m.kind, of(m.kind, m.canonical))
        out += [text[at : m.first], made]
        length += m.first - at
        spans.append({"kind": m.kind, "first": length, "last": length + len(made)})
        length += len(made)
        at = m.last
    return "".join([*out, text[at:]]), spans


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(key.as_py(), kind, canonical) for key, text in zip(batch["key"], batch["text"], strict=True) for kind, canonical in {(m.kind, m.canonical) for m in mentions(text.as_py())}]
        if rows:
            keys, kinds, canonicals = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(kinds), pa.array(canonicals)], ["key", "kind", "canonical"])


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, surrogate) of the distinct ``entities`` (kind, canonical), without collisions within a kind.

    In each round the entities without a surrogate try the next one. It must be no entity's
    real form and no surrogate already given; of several that want the same, the first in
    order gets it.
    """

    def propose(attempt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(batch["kind"].to_pylist(), batch["canonical"].to_pylist(), strict=True)
                made = pa.array([surrogate(k, c, attempt, key) for k, c in pairs], pa.string())
                yield pa.RecordBatch.from_arrays([batch["kind"], batch["canonical"], made], ["kind", "canonical", "surrogate"])

        return run

    schema = "kind string, canonical string, surrogate string"
    entities = written(entities)
    real = entities.select("kind", F.col("canonical").alias("surrogate"))
    pending, given, attempt = entities, None, 0
    while True:
        wanted = written(pending.mapInArrow(propose(attempt), schema))
        free = wanted.join(real, ["kind", "surrogate"], "left_anti")
        if given is not None:
            free = free.join(given.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        got = free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")).select("kind", "canonical", "surrogate")
        given = written(got if given is None else given.union(got))
        pending = written(pending.join(given, ["kind", "canonical"], "left_anti"))
        if pending.isEmpty():
            return given
        attempt += 1


def _replacer():
    def run(texts: pd.Series, maps: pd.Series) -> pd.DataFrame:
        made, spans = [], []
        for text, found in zip(texts, maps, strict=True):
            names = json.loads(found) if found else {}
            t, s = replaced(text, lambda kind, canonical, names=names: names[f"{kind}|{canonical}"])
            made.append(t)
            spans.append(s)
        return pd.DataFrame({"text": made, "spans": spans})

    run.__annotations__ = {"texts": pd.Series, "maps": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, "text string, spans array<struct<kind:string,first:int,last:int>>")


def pseudonymise(docs: DataFrame, key: bytes, *, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and pii_spans: kind, first and last (exclusive) in the new text.

    Kinds: email, phone, account and card numbers, social security numbers, IBANs, IP
    addresses, secrets behind a name like token, and personal names behind a title or a known
    given name, with all further mentions of these in the same text that are written alike. Only texts with a digit, one of the signs these need, a title or a given name
    go to Python, whole; all others stay as they are and have no spans, as do null
    and empty texts. Rows are treated alike whatever their identifiers; other columns stay,
    one named pii_spans is replaced.
    """
    bounded_batches(docs)
    column: Column = F.col(f"`{text}`")
    rows = docs.select(carried(docs, "pii_spans"), column.cast("string").alias("text"), F.coalesce(column.rlike(MARKS), F.lit(False)).alias("marked"))
    flagged = written(rows.filter("marked").withColumn("key", F.unhex(F.md5(F.col("text").cast("binary")))))
    found = written(flagged.select("key", "text").mapInArrow(_detect, "key binary, kind string, canonical string").distinct())
    given = surrogates(found.select("kind", "canonical").distinct(), key)
    pair = F.struct(F.concat_ws("|", "kind", "canonical"), F.col("surrogate"))
    maps = found.join(given, ["kind", "canonical"]).groupBy("key").agg(F.to_json(F.map_from_entries(F.collect_list(pair))).alias("map"))
    changed = flagged.join(maps, "key", "left").select("_doc", _replacer()(F.col("text"), F.col("map")).alias("made"))
    values = [F.col("made.text").alias(c) if c == text else v for c, v in zip((c for c in docs.columns if c != "pii_spans"), restored(docs, "pii_spans"), strict=True)]
    changed = changed.select(*values, F.col("made.spans").alias("pii_spans"))
    none = F.array().cast("array<struct<kind:string,first:int,last:int>>")
    untouched = rows.filter("not marked").select(*restored(docs, "pii_spans"), none.alias("pii_spans"))
    return untouched.unionByName(changed)
