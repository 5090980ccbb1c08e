"""Personal data replaced by surrogates: keyed, type-consistent, distinct and coreferent.

An entity's canonical form (case, punctuation and spacing aside) is replaced by another
of the same type and format. Within each format the replacement is a keyed permutation
(a Feistel network walked until it stays inside the format, and shifted so that nothing
maps to itself), so equal entities get equal surrogates in every document, and different
entities different ones, without any table. The surrogate is then written back in the
entity's own punctuation and case. Names keep the gender that their title or given name
shows, and their script.

Distinctness across formats is checked against the corpus: the surrogates of all entities
are counted, and should two entities share one, all are made anew under the next key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that are tried before a collision is reported as an error.
KEYS_TRIED = 8
_ROUNDS = 6

# Domains that are reserved for examples and never belong to anyone.
RESERVED = ("example.com", "example.org", "example.net", "example", "test", "localhost")

# Given names by script and gender, family names by script, titles by gender.
GIVEN = {
    ("latin", "f"): ("anna", "barbara", "carmen", "claudia", "elena", "emily", "emma", "isabel",
                     "julia", "laura", "lucia", "maria", "marie", "mary", "nicole", "olivia",
                     "sarah", "sofia", "sophie", "susan"),
    ("latin", "m"): ("adam", "antonio", "carlos", "daniel", "david", "francisco", "hans", "jack",
                     "james", "jean", "john", "jose", "lukas", "michael", "paul", "peter",
                     "pierre", "robert", "thomas", "william"),
    ("cyrillic", "f"): ("анна", "елена", "ирина", "мария", "наталья", "ольга", "светлана", "татьяна"),
    ("cyrillic", "m"): ("александр", "алексей", "дмитрий", "иван", "михаил", "николай", "сергей",
                        "юрий"),
}
FAMILY = {
    "latin": ("brown", "davis", "fischer", "garcia", "johnson", "jones", "lefebvre", "lopez",
              "martin", "martinez", "meyer", "miller", "moreau", "muller", "petit", "roux",
              "schmidt", "schneider", "smith", "taylor", "wagner", "weber", "williams", "wilson"),
}
TITLES = {
    "f": ("Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra.", "г-жа"),
    "m": ("Mr.", "Mr", "Herr", "Monsieur", "Señor", "Sr.", "г-н"),
    "": ("Dr.", "Dr", "Prof.", "Prof"),
}
_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя",
              "αβγδεζηθικλμνξοπρστυφχψω", "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœšž")
_PLACE = {c: (k, i) for k, letters in enumerate(_ALPHABETS) for i, c in enumerate(letters)}

_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_PATTERNS = {
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])",
    "email": r"[A-Za-z0-9](?:[\w.%+-]*[A-Za-z0-9_])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?\b",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])(?!\.\d)",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
}
_EACH = {k: re.compile(p) for k, p in _PATTERNS.items()}
_ANY = re.compile("|".join(_PATTERNS.values()))
# Telephone numbers: with a country's code, after + or 00; national ones with a leading 0, solid,
# in pairs or as area code and blocks; groups as in North America; any number behind a word for it.
_PHONES = {
    "abroad": r"(?:(?<![\w+])\+|(?<=(?<![\w.,+-])00))[1-9]\d{0,2}(?:[ ./-]?\(\d{1,5}\))?(?:[ ./-]?\d){4,14}(?!\d)",
    "pairs": r"(?<![\w.,+-])0[1-9](?P<mark>[ ./-])\d\d(?:(?P=mark)\d\d){3}(?!\d|(?P=mark)\d)",
    "solid": r"(?<![\w.,+-])0[1-9]\d{7,10}(?![\w-]|[.,]\d)",
    "area": r"(?<![\w.,+-])(?:\(0[1-9]\d{0,4}\) ?|0[1-9]\d{1,4}(?: ?[/-] ?|[ .]))\d{2,8}(?:[ .-]\d{2,5}){0,4}(?!\d)",
    "groups": r"(?<![\d.])(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?:[ .-]\d{2,4})?(?![\d]|\.\d)",
    "cued": r"(?<![\w.,+-])\d(?:[ ./-]?\d){5,14}(?![\w]|[.,]\d)",
}
_PHONE = re.compile("|".join(_PHONES.values()))
_PHONES_EACH = {k: re.compile(p) for k, p in _PHONES.items()}
_CUE = re.compile(
    r"(?<!\w)(?:call|dial|phone|tel|telephone|telefon|t[ée]l[ée]phone|tel[ée]fono|mobile?|m[óo]vil|cell|cellphone|fax"
    r"|whatsapp|sms|portable|handy|rufnummer|telefonnummer|handynummer|anruf|anrufen|appel|appelez|llame|llamar"
    r"|тел|телефон|телефону|звоните)(?!\w)[^\w\n]{0,3}(?:[^\W\d]+[^\w\n]{1,3}){0,3}[^\w\n]?$", re.IGNORECASE)
#: Digits of a number with its country's code, where they are fixed.
_FIXED = {"1": 11, "7": 11, "33": 11, "34": 11}
#: How cards are written: in one block, in fours, or as 4-6-5 and 4-6-4.
_CARD_LAYOUT = re.compile(r"\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}[ -]\d{1,4}|\d{4}[ -]\d{6}[ -]\d{4,5}")
_TITLED = re.compile(
    "(?<!\\w)(?P<title>" + "|".join(map(re.escape, sorted(_GENDER, key=len, reverse=True)))
    + rf")[  ](?P<name>{_NAME}(?:[  ]{_NAME}){{0,2}})")
_KNOWN = re.compile(
    "(?<!\\w)(?P<given>" + "|".join(n.capitalize() for names in GIVEN.values() for n in names)
    + rf")[  ](?P<family>{_NAME})")


def _keyed(key: bytes, *parts) -> int:
    text = "\0".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(text, key=key, digest_size=32).digest(), "big")


def _feistel(x: int, size: int, key: bytes, tweak: str, forward: bool) -> int:
    """Keyed permutation of ``0 .. size - 1``: a network over a square that holds them all,
    walked until it comes back inside."""
    side = 1
    while side * side < size:
        side *= 2
    while True:
        left, right = divmod(x, side)
        for r in range(_ROUNDS) if forward else reversed(range(_ROUNDS)):
            if forward:
                left, right = right, (left + _wide(key, tweak, r, right, side)) % side
            else:
                left, right = (right - _wide(key, tweak, r, left, side)) % side, left
        x = left * side + right
        if x < size:
            return x


def _wide(key: bytes, tweak: str, r: int, half: int, side: int) -> int:
    value, block = _keyed(key, tweak, r, half), 1
    while value.bit_length() < side.bit_length() and block * 256 < side.bit_length():
        value = value << 256 | _keyed(key, tweak, r, half, block)
        block += 1
    return value % side


def permuted(x: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation without fixed points (but where ``size`` is 1)."""
    step = _feistel(x, size, key, tweak, True)
    return _feistel((step + 1) % size, size, key, tweak, False)


def _spelled(text: str, key: bytes, kind: str) -> str:
    """Every letter and digit replaced by one of its own alphabet, the rest kept."""
    places = [_PLACE.get(c) for c in text]
    number, size = 0, 1
    for place in places:
        if place:
            base = len(_ALPHABETS[place[0]])
            number, size = number * base + place[1], size * base
    pattern = "".join("_" + str(p[0]) if p else c for p, c in zip(places, text))
    number = permuted(number, size, key, f"{kind}|{pattern}")
    out = list(text)
    for k in range(len(text) - 1, -1, -1):
        if places[k]:
            letters = _ALPHABETS[places[k][0]]
            number, at = divmod(number, len(letters))
            out[k] = letters[at]
    return "".join(out)


def luhn(digits: str) -> int:
    """The check digit that makes ``digits`` with it valid."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _iban_checks(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country) + "00"
    return f"{98 - int(number) % 97:02d}"


def _private(n: int) -> int:
    a, b = n >> 24, n >> 16 & 255
    if a == 10 or (a, b) == (192, 168) or a == 172 and 16 <= b < 32:
        return 1
    return 2 if a == 127 or a == 0 or a >= 224 else 0


_LISTS = (*GIVEN.values(), *FAMILY.values())
_LISTED = {n: names for names in _LISTS for n in names}
_GENDERED = {n: g for (_, g), names in GIVEN.items() for n in names}


def _name(part: str, key: bytes) -> str:
    """A name; listed names stay in their list, others keep their pattern and are not listed.

    The name alone decides, not its title or place, so all roles together are distinct.
    """
    if part in _LISTED:
        names = _LISTED[part]
        return names[permuted(names.index(part), len(names), key, f"name|{names[0]}")]
    out = _spelled(part, key, "name")
    while out in _LISTED:
        out = _spelled(out, key, "name")
    return out


@lru_cache(maxsize=100_000)
def surrogate(kind: str, canonical: str, key: bytes) -> str:
    """The canonical form that takes the place of ``canonical``."""
    if kind == "email":
        local, domain = canonical.split("@")
        kept = next((s for s in RESERVED if domain == s or domain.endswith("." + s)), "")
        stem = domain[:len(domain) - len(kept)] if kept else domain + "."
        mixed = _spelled(f"{local}@{stem}", key, "email" + kept)
        return mixed + (kept or "invalid")
    if kind == "card":
        body = canonical[0] + _spelled(canonical[1:-1], key, "card")
        return body + str(luhn(body))
    if kind == "iban":
        account = _spelled(canonical[4:].lower(), key, "iban" + canonical[:2]).upper()
        return canonical[:2] + _iban_checks(canonical[:2], account) + account
    if kind == "ip":
        first = number = int.from_bytes(bytes(map(int, canonical.split("."))), "big")
        while True:
            number = permuted(number, 1 << 32, key, "ip")
            if _private(number) == _private(first):
                return ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))
    if kind == "secret":
        number = permuted(int(canonical, 16), 16 ** len(canonical), key, f"hex{len(canonical)}")
        return f"{number:0{len(canonical)}x}"
    if kind == "phone":
        rest = canonical.lstrip("0")
        out = _spelled(rest, key, kind)
        while out.startswith("0"):  # as many zeros in front as before: they tell its format
            out = _spelled(out, key, kind)
        return "0" * (len(canonical) - len(rest)) + out
    if kind.startswith("person"):
        return _name(canonical, key)
    return _spelled(canonical, key, kind)


def canonical_form(kind: str, found: str) -> str | None:
    """What equal entities have in common; None if ``found`` is no entity of the kind."""
    if kind == "card":
        digits = re.sub(r"\D", "", found)
        return digits if 13 <= len(digits) <= 19 and luhn(digits[:-1]) == int(digits[-1]) else None
    if kind == "phone":
        digits = re.sub(r"\D", "", found)
        least, most = (8, 13) if digits[0] == "0" else (7, 15)
        return digits if least <= len(digits) <= most else None
    if kind == "ip":
        octets = [int(o) for o in found.split(".")]
        return ".".join(map(str, octets)) if max(octets) < 256 else None
    if kind == "iban":
        plain = found.replace(" ", "")
        ok = 15 <= len(plain) <= 34 and _iban_checks(plain[:2], plain[4:]) == plain[2:4]
        return plain if ok else None
    return found.lower()


def _as_written(new: str, found: str) -> str:
    """Canonical ``new`` in the punctuation and case of ``found``, character by character."""
    if len(re.sub(r"\W", "", found)) == len(re.sub(r"\W", "", new)) and len(found) != len(new):
        marks = iter(re.sub(r"\W", "", new))
        new = "".join(next(marks) if c.isalnum() or c == "_" else c for c in found)
    upper = found.isupper()
    return "".join(c.upper() if upper or k < len(found) and found[k].isupper() else c
                   for k, c in enumerate(new))


def _abroad(text: str, start: int) -> int:
    """Up to so many digits behind + or 00 are a telephone number."""
    return 15 if text[max(0, start - 1):start] == "+" else 17 if text.startswith("00", start) else 0


def _card(text: str, start: int, end: int) -> tuple[int, str] | None:
    """End and canonical form of the card at ``start``: the longest run of whole blocks with a
    right check digit. Among other numbers it has to be in a layout of cards."""
    whole = not re.search(r"\d[ -]$", text[max(0, start - 2):start]) \
        and not re.match(r"[ -]?\d", text[end:end + 2])
    abroad = _abroad(text, start)
    borders = [m.start() for m in re.finditer("[ -]", text[start:end])]
    for n in (end - start, *reversed(borders)):
        written = text[start:start + n]
        if (whole and n == end - start) or _CARD_LAYOUT.fullmatch(written):
            form = canonical_form("card", written)
            if form is not None and len(form) > abroad:
                return start + n, form
    return None


def _phone(text: str, kind: str, hit: re.Match) -> tuple[int, str] | None:
    """End and canonical form of a telephone number: the most blocks that make one."""
    start = hit.start()
    if kind == "cued" and not _CUE.search(text[max(0, start - 60):start]):
        return None
    borders = [m.start() for m in re.finditer(r"(?<=[\d)])[^\d)]+(?=[\d(])", hit[0])]
    ends = [len(hit[0]), *reversed(borders)]
    forms = [(start + n, form) for n in ends if (form := canonical_form("phone", hit[0][:n]))]
    if kind == "abroad":
        fixed = [f for f in forms for code, n in _FIXED.items()
                 if f[1].startswith(code) and len(f[1]) == n]
        forms = fixed or [f for f in forms if len(f[1]) >= 8]
    elif kind not in ("area", "cued"):
        forms = forms[:1] if forms and forms[0][0] == hit.end() else []
    return forms[0] if forms else None


def _marked(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Entities that their characters tell. Where a candidate is none, its span is searched on.

    Telephone numbers, which no check tells, are looked for in what the others leave; the
    blocks of a number that is written like a card are none.
    """
    at, rest, done = 0, [], 0
    while match := _ANY.search(text, at):
        start = at = match.start()
        for kind, pattern in _EACH.items():
            if not (hit := pattern.match(text, start)):
                continue
            end, taken = hit.end(), hit.end()
            if kind == "card":
                end, form = _card(text, start, end) or (end, None)
                number = _CARD_LAYOUT.fullmatch(hit[0]) and not _abroad(text, start)
                taken = end if form is not None or number else start
            else:
                form = canonical_form(kind, hit[0])
                taken = end if form is not None else start
            if taken > done:
                rest += (text[done:start], "\0" * (taken - max(start, done)))
                done = taken
            if form is not None:
                yield start, end, kind, form
                at = end
                break
        else:
            at += 1
    rest, at = "".join([*rest, text[done:]]), 0
    while hit := _PHONE.search(rest, at):
        for kind, pattern in _PHONES_EACH.items():
            each = pattern.match(rest, hit.start())
            if each and (found := _phone(rest, kind, each)):
                yield hit.start(), found[0], "phone", found[1]
                at = found[0]
                break
        else:
            at = hit.start() + 1


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, canonical)`` of all entities, from left to right, not overlapping.

    A name is one entity for each of its parts, so ``Mr. John Smith`` and ``Mr. Smith`` share
    the family name's surrogate. Names are told by a title, or by a listed given name ahead of
    another capitalised word. A run of digits is a card only with a right check digit (Luhn).
    """
    text, found = text or "", []
    if re.search("[0-9@]|[0-9a-fA-F]{32}", text):
        found += _marked(text)
    for match in _TITLED.finditer(text):
        parts = []
        for part in re.finditer(_NAME, match["name"]):
            if not part[0][0].isupper() or part[0][1:2].isupper():
                break
            parts.append(part)
        gender = _GENDER[match["title"]] or next(
            (g for p in parts[:-1] if (g := _GENDERED.get(p[0].lower()))), "")
        for k, part in enumerate(parts):
            role = "family" if k == len(parts) - 1 else gender
            at = match.start("name")
            found.append((at + part.start(), at + part.end(), f"person:{role}", part[0].lower()))
    for match in _KNOWN.finditer(text):
        given = match["given"].lower()
        if match["family"][0].isupper() and not match["family"][1:2].isupper() \
                and match["family"] not in _GENDER:
            found.append((*match.span("given"), f"person:{_GENDERED[given]}", given))
            found.append((*match.span("family"), "person:family", match["family"].lower()))
    found.sort(key=lambda e: (e[0], -e[1]))
    kept, end = [], 0
    for e in found:
        if e[0] >= end:
            kept.append(e)
            end = e[1]
    return kept


def replaced(text: str | None, key: bytes) -> tuple[str | None, list[dict]]:
    """The text with surrogates, and where they stand in it."""
    if text is None:
        return None, []
    out, spans, last, length = [], [], 0, 0
    for start, end, kind, form in entities(text):
        new = _as_written(surrogate(kind, form, key), text[start:end])
        length += start - last
        spans.append({"kind": kind.partition(":")[0], "start": length, "end": length + len(new)})
        out += (text[last:start], new)
        length += len(new)
        last = end
    return ("".join([*out, text[last:]]) if out else text), spans


def _derived(secret: str, attempt: int) -> bytes:
    return hashlib.blake2b(f"{secret}\0{attempt}".encode(), digest_size=32).digest()


def collision_free_key(docs: DataFrame, secret: str, *, text_col: str = "text") -> bytes:
    """The first key derived from ``secret`` under which all entities have surrogates of
    their own. Entities are counted once in each task before they are shuffled."""
    for attempt in range(KEYS_TRIED):
        key = _derived(secret, attempt)

        def pairs(batches: Iterator[pd.DataFrame], key: bytes = key) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = {(k, form) for t in batch["text"] for _, _, k, form in entities(t)}
                # All roles of a person together, as a text shows names, not roles.
                rows = [(k.partition(":")[0], form, surrogate(k, form, key)) for k, form in sorted(found)]
                yield pd.DataFrame(rows, columns=["kind", "entity", "surrogate"], dtype=object)

        made = docs.select(F.col(text_col).alias("text")).mapInPandas(
            pairs, "kind string, entity string, surrogate string")
        shared = made.groupBy("kind", "surrogate").agg(
            F.min("entity").alias("a"), F.max("entity").alias("b")).where("a != b")
        if shared.isEmpty():
            return key
    raise ValueError("surrogates collide under every key that was tried")


def replace(text: Column, key: bytes) -> Column:
    """``struct<text, entities>``: the text with surrogates, and their kinds and places."""
    kind = pa.struct([("text", pa.string()), ("entities", pa.list_(pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])

    @F.arrow_udf("text string, entities array<struct<kind:string,start:int,end:int>>")
    def run(texts: pa.Array) -> pa.Array:
        made = (replaced(t.as_py(), key) for t in texts)
        return pa.array([{"text": t, "entities": e} for t, e in made], kind)

    return run(text)


def pseudonymise(docs: DataFrame, secret: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text_col``, and ``entities`` with their kinds and places.

    One row for each row of ``docs``, in the columns it came with. A NULL text stays NULL and
    an empty one empty, both without entities. Repeated rows are treated alike; an empty table
    stays empty. A column of ``docs`` called ``entities`` is replaced. The same ``secret``
    gives the same surrogates in every run, as long as no collision asks for another key.
    """
    key = collision_free_key(docs, secret, text_col=text_col)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        replace(F.col(text_col), key).alias("_new"))
    return inner.select(
        *[F.col("_new.text").alias(c) if c == text_col else F.col(f"_row.`{c}`")
          for c in docs.columns if c != "entities"], "_new.entities")
