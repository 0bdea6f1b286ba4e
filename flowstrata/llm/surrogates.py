"""Surrogates for personal data: keyed, type-consistent, distinct.

Detected entities (mail addresses, secrets, IP addresses, IBANs, card numbers,
phone and social security numbers, person names) are replaced by surrogates of
the same format: same length and separators, digits for digits, letters for
letters of the same script and case, valid check digits where the original has
them, first names of the same gender, the same title.

A surrogate is a keyed permutation of its format's values (a Feistel network
with cycle walking), taken as the successor in a secret cyclic order: it never
equals its original, equal entities get equal surrogates in every document
(coreference), and different entities of a format get different ones.  So
distinctness needs no table of all entities; it is checked all the same, per
document while replacing and over the corpus: :func:`checked` counts the
surrogates that stand for more than one original (keyed digests, aggregated
before they are shuffled).

A person is found by a title, a known first name before a capitalised surname,
words that announce a name (``my name is``, ``signed by``), or by being listed
with such a person (``Anna Schmidt and Wei Zhang``).  Every mention of a part
of the name in the same text is replaced too, also before the full name, with a
possessive, or in capitals; ``SCHMIDT`` gets the capitals of the surrogate of
``Schmidt`` in every document.  The key is a secret of the caller; without it
surrogates cannot be inverted.

Cases: a null text stays null with no entities; overlapping entities go to the
first kind in ``KINDS``; very long texts are scanned whole, in time linear in
their length."""

from __future__ import annotations

import hashlib
import hmac
import math
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import fresh

KINDS = ("email", "secret", "ip", "iban", "card", "ssn", "phone", "person")

# First names by gender, fixed values in the order of their index.
FEMALE = ("Anna", "Maria", "Emma", "Laura", "Julia", "Sophie", "Clara", "Marie", "Elena", "Lucia", "Alice", "Sarah",
          "Helen", "Mary", "Carmen", "Sofia", "Camille", "Chloe", "Lena", "Ingrid", "Petra", "Rosa", "Grace", "Jane")
MALE = ("Peter", "Paul", "Thomas", "Lukas", "Martin", "James", "John", "David", "Carlos", "Miguel", "Pierre", "Louis",
        "Hans", "Karl", "Robert", "George", "Antoine", "Javier", "Pablo", "Michael", "William", "Otto", "Felix", "Henry")
FEMALE_CYRILLIC = ("Анна", "Мария", "Елена", "Ольга", "Ирина", "Наталья", "Светлана", "Вера")
MALE_CYRILLIC = ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Павел", "Борис")
TITLES = ("Mrs", "Mr", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señora", "Señor", "Sra", "Sr",
          "Mme", "г-жа", "г-н")
# Letters that are exchanged among themselves, fixed values.
_LOWER = ("aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúýàèìòùâêîôûäëïöüãõåæøœāăąēėęěīįōőūůű", "çñćčďđğłńňðþřśşšťźżžșț",
          "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "ъь", "αεηιουω", "βγδζθκλμνξπρστφχψ")
ALPHABETS = (*_LOWER, *(a.upper() for a in _LOWER), "0123456789")
_CLASS = {c: a for a in ALPHABETS for c in a}
_UPPER = "".join(a.upper() for a in _LOWER)
# a capitalised word, without a possessive at its end
_CAP = rf"[{_UPPER}](?:\w|['’-](?=\w)(?![sS]\b))+"
_FIRST = "|".join(FEMALE + MALE + FEMALE_CYRILLIC + MALE_CYRILLIC)

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_SECRET = re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b(\s*[:=]\s*[\"']?)([^\s\"',;]{6,})")
_IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b")
_CARD = re.compile(r"(?<![\w-])[3-6]\d(?:[ -]?\d){11,17}(?![\w-])")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w)"
                    r"|(?<![\w.])\+\d{1,3}[ .-]?\d{6,12}(?!\w)")
# a bare number is a phone number only where the words before it say so
_BARE_PHONE = re.compile(r"(?i)\b(?:phone|telephone|tel|mobile|cell|fax|call|text)\b(?: (?:me|us|at|on|is|number|no))*[.:]? ?(\d{7,12})(?!\w)")
_PERSON = re.compile(rf"\b(?:(?P<title>{'|'.join(TITLES)})\.? (?P<a>{_CAP})(?: (?P<b>{_CAP}))?"
                     rf"|(?P<first>{_FIRST}) (?P<last>{_CAP}))")
_PAIR = rf"({_CAP}) ({_CAP})"
_ANNOUNCED = re.compile(rf"\b(?:[Nn]ame is|[Nn]ame:|[Nn]amed|[Ss]igned by|[Ww]ritten by|[Ss]igned,) {_PAIR}")
_LISTED = re.compile(rf"(?:,| and|, and| und| et| y| и) {_PAIR}")
_WORD = re.compile(r"[^\W\d_]+")
_NAME_WORD = re.compile(_CAP)
_DIGIT = re.compile(r"\d").search


# ------------------------------------------------------ keyed permutations ----

class Cipher:
    """Keyed permutations of 0 .. n-1, one for each ``tweak``."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: str, i: int, x: int, a: int) -> int:
        digest = hmac.new(self.key, f"{tweak}|{i}|{x}".encode(), hashlib.sha256).digest()
        return int.from_bytes(digest, "big") % a

    def _walk(self, x: int, n: int, tweak: str, forward: bool) -> int:
        a = math.isqrt(n - 1) + 1
        while True:
            left, right = divmod(x, a)
            for i in (range(6) if forward else range(5, -1, -1)):
                if forward:
                    left, right = right, (left + self._round(tweak, i, right, a)) % a
                else:
                    left, right = (right - self._round(tweak, i, left, a)) % a, left
            x = left * a + right
            if x < n:
                return x

    def successor(self, x: int, n: int, tweak: str) -> int:
        """The next value after ``x`` in a secret cyclic order of all ``n``."""
        if n < 2:
            return x
        return self._walk((self._walk(x, n, tweak, True) + 1) % n, n, tweak, False)


def permuted(text: str, cipher: Cipher, tweak: str, alphabets: list[str | None],
             good: Callable[[str], bool] = lambda s: True) -> str:
    """``text`` with each character replaced inside its alphabet (None: kept),
    walking on until ``good`` holds (so the result stays in its format)."""
    n = 1
    x = 0
    for c, a in zip(text, alphabets):
        if a:
            x = x * len(a) + a.index(c)
            n *= len(a)
    form = "".join("." if a else c for c, a in zip(text, alphabets)) + "|" + "/".join(a or "" for a in alphabets)
    while True:
        x = rest = cipher.successor(x, n, f"{tweak}|{form}")
        out = []
        for c, a in zip(reversed(text), reversed(alphabets)):
            if a:
                rest, d = divmod(rest, len(a))
                c = a[d]
            out.append(c)
        result = "".join(reversed(out))
        if n < 2 or good(result):
            return result


def _classes(text: str) -> list[str | None]:
    return [_CLASS.get(c) for c in text]


# ---------------------------------------------------------- by entity kind ----

def _luhn_digit(payload: str) -> int:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card(text: str, cipher: Cipher) -> str:
    digits = [i for i, c in enumerate(text) if c.isdigit()]
    plain = "".join(text[i] for i in digits)
    off = (int(plain[-1]) - _luhn_digit(plain[:-1])) % 10  # 0 for a valid number
    body = permuted(plain[:-1], cipher, "card", [None] * 4 + ["0123456789"] * (len(plain) - 5))
    new = body + str((_luhn_digit(body) + off) % 10)
    out = list(text)
    for i, d in zip(digits, new):
        out[i] = d
    return "".join(out)


def _iban_check(country: str, bban: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in bban + country + "00")) % 97


def _iban(text: str, cipher: Cipher) -> str:
    plain = text.replace(" ", "")
    body = permuted(plain[4:], cipher, "iban" + plain[:2],
                    ["0123456789" if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in plain[4:]])
    new = iter(f"{plain[:2]}{_iban_check(plain[:2], body):02d}{body}")
    return "".join(c if c == " " else next(new) for c in text)


def _ip(text: str, cipher: Cipher) -> str:
    octets = [int(x) for x in text.split(".")]
    fixed = 1 if octets[0] in (10, 127) else 2 if octets[:2] == [192, 168] else 0
    ranges = [range(256)] * 4
    if octets[0] == 172 and 16 <= octets[1] < 32:
        fixed, ranges = 1, [range(256), range(16, 32), range(256), range(256)]
    elif not fixed:  # public stays public: first octet among those without private parts
        plain = [o for o in range(1, 224) if o not in (10, 127, 172, 192)]
        ranges = [plain if octets[0] in plain else [octets[0]], *[range(256)] * 3]
    n, x = 1, 0
    for o, r in list(zip(octets, ranges))[fixed:]:
        x = x * len(r) + list(r).index(o)
        n *= len(r)
    tweak = f"ip|{octets[:fixed]}|{[len(r) for r in ranges]}|{octets[0] if len(ranges[0]) == 1 else ''}"
    y = cipher.successor(x, n, tweak)
    out = []
    for r in reversed(ranges[fixed:]):
        y, d = divmod(y, len(r))
        out.append(list(r)[d])
    return ".".join(map(str, octets[:fixed] + out[::-1]))


_HEX = "0123456789abcdef"


def _secret(text: str, cipher: Cipher) -> str:
    if set(text) <= set(_HEX):
        return permuted(text, cipher, "hex", [_HEX] * len(text))
    groups = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return permuted(text, cipher, "secret", [next((g for g in groups if c in g), None) for c in text],
                    lambda s: not set(s) <= set(_HEX))


def _email(text: str, cipher: Cipher) -> str:
    local, _, domain = text.rpartition("@")
    name, dot, top = domain.rpartition(".")
    return f"{permuted(local, cipher, 'local', _classes(local))}@{permuted(name, cipher, 'domain', _classes(name))}{dot}{top}"


def _digits(kind: str, keep: int):
    def replace(text: str, cipher: Cipher) -> str:
        start = re.match(r"\+\d{1,3}(?=[ .(-])|", text).end() if keep else 0
        return permuted(text, cipher, kind, [None if i < start or not c.isdigit() else "0123456789"
                                             for i, c in enumerate(text)])
    return replace


_GENDERED = (FEMALE, MALE, FEMALE_CYRILLIC, MALE_CYRILLIC)


def _name(text: str, cipher: Cipher, first: bool) -> str:
    if len(text) > 1 and text.isupper():
        return _name(_titled(text), cipher, first).upper()
    for names in _GENDERED:  # a known name stays one: neither way leaves its own set, so both stay distinct
        if text in names:
            return names[cipher.successor(names.index(text), len(names), ("first" if first else "last") + names[0])]
    kinds = _classes(text)
    if sum(k is not None for k in kinds) > 1:
        kinds[-1] = None  # the ending shows the gender in many languages
    return permuted(text, cipher, "name", kinds, lambda s: s not in _KNOWN)


_KNOWN = {n for names in _GENDERED for n in names}


def _titled(text: str) -> str:
    return _WORD.sub(lambda m: m.group().capitalize(), text)


_REPLACE = {"email": _email, "secret": _secret, "ip": _ip, "iban": _iban, "card": _card,
            "ssn": _digits("ssn", 0), "phone": _digits("phone", 1)}


# --------------------------------------------------------------- detection ----

def entities(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the entities, in order, without overlap."""
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(*m.span(), "email") for m in _EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        found += [(*m.span(2), "secret") for m in _SECRET.finditer(text)]
    if _DIGIT(text):
        found += [(*m.span(), "ip") for m in _IP.finditer(text)]
        for m in _IBAN.finditer(text):
            plain = m.group().replace(" ", "")
            if _iban_check(plain[:2], plain[4:]) == int(plain[2:4]):
                found.append((*m.span(), "iban"))
        found += [(*m.span(), "card") for m in _CARD.finditer(text)]
        found += [(*m.span(), "ssn") for m in _SSN.finditer(text)]
        found += [(*m.span(), "phone") for m in _PHONE.finditer(text)]
        found += [(*m.span(1), "phone") for m in _BARE_PHONE.finditer(text)]
    found += _persons(text)
    return _without_overlap(found)


def _persons(text: str) -> list[tuple[int, int, str]]:
    found: list[tuple[int, int, str]] = []
    role: dict[str, str] = {}  # of each name part, in capitals
    ends: set[int] = set()  # where a person's name ends

    def person(m: re.Match, parts: list) -> None:
        for g in parts:
            kind = "person" if g == parts[-1] else "first"
            found.append((*m.span(g), kind))
            if role.get(m.group(g).upper()) != "person":
                role[m.group(g).upper()] = kind
        ends.add(m.end())

    for m in _PERSON.finditer(text):
        person(m, [g for g in ("a", "b", "first", "last") if m.group(g)])
    for m in _ANNOUNCED.finditer(text):
        person(m, [1, 2])
    if ends:
        for m in _LISTED.finditer(text):  # in order, so a list carries on from name to name
            if m.start() in ends:
                person(m, [1, 2])
    if role:
        for m in _NAME_WORD.finditer(text):
            word = m.group()
            kind = role.get(word.upper()) if word.isupper() or not word[1:].isupper() else None
            if kind:
                found.append((*m.span(), kind))
            elif not word.isalpha():  # Schmidt-based, Keller'sche
                for part in _WORD.finditer(word):
                    if part.group()[0].isupper() and (kind := role.get(part.group().upper())):
                        found.append((m.start() + part.start(), m.start() + part.end(), kind))
    return found


def _without_overlap(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The entities in order; of those that overlap the first kind stays."""
    by_kind: dict[str, list] = {}
    for f in sorted(set(found)):
        by_kind.setdefault(f[2], []).append(f)
    taken: list[tuple[int, int, str]] = []
    for kind in (*KINDS, "first"):
        free, k, end = [], 0, 0
        for f in by_kind.get(kind, ()):
            while k < len(taken) and taken[k][1] <= f[0]:
                k += 1
            if f[0] >= end and (k == len(taken) or taken[k][0] >= f[1]):
                free.append(f)
                end = f[1]
        taken = sorted(taken + free)  # two sorted runs
    return taken


def surrogate(value: str, kind: str, cipher: Cipher) -> str:
    return _REPLACE[kind](value, cipher) if kind in _REPLACE else _name(value, cipher, kind == "first")


def replace_entities(text: str | None, cipher: Cipher) -> tuple[str | None, list[tuple[str, str, str]]]:
    """The text with surrogates, and ``(kind, original, surrogate)`` of each entity."""
    if text is None:
        return None, []
    at, out, pairs = 0, [], []
    given: dict[tuple[str, str], str] = {}
    owner: dict[tuple[str, str], str] = {}
    for a, b, kind in entities(text):
        value = text[a:b]
        new = given.get((kind, value))
        if new is None:
            new = given[kind, value] = surrogate(value, kind, cipher)
            if owner.setdefault((kind, new), value) != value:
                raise RuntimeError(f"two {kind} entities got one surrogate")
        out += [text[at:a], new]
        pairs.append((kind, value, new))
        at = b
    out.append(text[at:])
    return "".join(out), pairs


# -------------------------------------------------------------- Spark jobs ----

def _replaced(docs: DataFrame, key: bytes, text: str, seen: str | None = None) -> DataFrame:
    """One narrow pass; ``seen`` names a column for the distinct
    ``(kind, original, surrogate)`` of a text, the original as a keyed digest."""
    got = fresh(docs, "_got")
    kind = "struct<kind:string,original:string,surrogate:string>"

    @F.pandas_udf(f"text string, n_entities int, entity_kinds string, seen array<{kind}>")
    def run(texts: pd.Series) -> pd.DataFrame:
        cipher = Cipher(key)
        rows = []
        for t in texts:
            new, pairs = replace_entities(t, cipher)
            kinds = ",".join(sorted({"person" if k == "first" else k for k, _, _ in pairs}))
            marks = [{"kind": k, "original": hmac.new(key, v.encode(), hashlib.sha256).hexdigest()[:32], "surrogate": s}
                     for k, v, s in sorted(set(pairs))] if seen else []
            rows.append((new, len(pairs), kinds, marks))
        return pd.DataFrame(rows, columns=["text", "n_entities", "entity_kinds", "seen"])

    out = (docs.withColumn(got, run(F.col(text))).withColumn(text, F.col(got)["text"])
           .withColumn("n_entities", F.col(got)["n_entities"]).withColumn("entity_kinds", F.col(got)["entity_kinds"]))
    return (out.withColumn(seen, F.col(got)["seen"]) if seen else out).drop(got)


def anonymised(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with the texts replaced and ``n_entities`` and ``entity_kinds``
    (columns of these names are replaced); one narrow pass."""
    return _replaced(docs.drop("n_entities", "entity_kinds"), key, text)


def _merged(marks: DataFrame) -> DataFrame:
    """``kind, surrogate, originals`` of the surrogates ``marks`` give to more
    than one original.  A frequent name is counted once a task before it moves."""
    return (marks.groupBy("kind", "surrogate", "original").agg(F.lit(1).alias("one"))
            .groupBy("kind", "surrogate").agg(F.count("one").alias("originals")).where("originals > 1"))


def checked(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """:func:`anonymised` with ``collisions``, the number of surrogates that
    stand for more than one original anywhere in the corpus (0 if the texts
    are safe to use), the same in every row.  The replaced texts are written
    once and checked there."""
    seen = fresh(docs, "_seen")
    out = stage(_replaced(docs.drop("n_entities", "entity_kinds", "collisions"), key, text, seen), "anonymised")
    total = _merged(out.select(F.explode(seen).alias("m")).select("m.*")).agg(F.count(F.lit(1)).alias("collisions"))
    return out.drop(seen).crossJoin(F.broadcast(total))  # one row


def collisions(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``kind, surrogate, originals``: surrogates that stand for more than one
    original anywhere in the corpus (none is expected)."""
    seen = fresh(docs, "_seen")
    return _merged(_replaced(docs, key, text, seen).select(F.explode(seen).alias("m")).select("m.*"))
