"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, schemes, plus signs,
digits and identifier cues. At each anchor a small parser expands to both sides and checks what it
finds. Kinds, in this order:

    email    letters, digits and ._%+- before an at-sign, a dotted host behind it
    ip       four numbers of at most 255, joined by dots
    card     13 to 19 digits with single blanks or hyphens, Luhn's sum right
    phone    a plus sign, then 9 to 15 digits with blanks, dots, hyphens, brackets
    user     name and password before the host of a URL
    iban     an international account number with right check digits, right behind a cue
    account  6 to 20 digits right behind a cue such as "account"

The first four are found from left to right, without overlap within a kind; what fails a check is
used up. Defined cases: null and empty texts have no spans. Repeated rows each get their result.
Positions are code points, ends exclusive. Texts are used whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "user", "iban", "account")
CUES = ("account", "acct", "konto", "cuenta", "compte", "customer no", "passport", "ssn")
IBAN_CUE = "iban"
MOST_CUE_GAP = 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9]([ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USER = re.compile(r"[^\s/@:\"'<>]+:[^\s/@\"'<>]+@[A-Za-z0-9-]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"[^0-9\n]{0,%d}?([0-9][0-9 -]{4,22}[0-9])(?![0-9])" % MOST_CUE_GAP)

_AUTOMATA: list = []


def automaton():
    """Anchors and what they announce; one for each worker."""
    if not _AUTOMATA:
        import ahocorasick

        found = ahocorasick.Automaton()
        found.add_word("@", "@")
        found.add_word("+", "+")
        found.add_word("://", ":")
        for digit in "0123456789":
            found.add_word(digit, "0")
        for cue in (*CUES, IBAN_CUE):
            found.add_word(cue, "i" if cue == IBAN_CUE else "c")
        found.make_automaton()
        _AUTOMATA.append(found)
    return _AUTOMATA[0]


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lowered(text: str) -> str:
    """The text with small ASCII letters; every character keeps its place."""
    # Two letters beyond ASCII become ASCII ones, one of them two characters.
    if "\u0130" in text or "\u212a" in text:
        return text.translate(_LOWER)
    return text.lower()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _iban(text: str) -> bool:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Kind -> its spans in order."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys((*BASE, "user"), 0)  # what lies before is used up
    cues = []
    for end, sign in automaton().iter(lowered(text)):
        if sign == "0":
            if end >= free["ip"]:
                found = _IP.match(text, end)
                if not found:
                    free["ip"] = _DIGITS.match(text, end).end()
                else:
                    free["ip"] = found.end()
                    parts = (p.lstrip("0") for p in found[0].split("."))
                    if all(len(p) < 3 or (len(p) == 3 and int(p) <= 255) for p in parts):
                        out["ip"].append(found.span())
            if end >= free["card"]:
                found = _CARD.match(text, end)
                free["card"] = found.end() if found else end + 1
                if found:
                    digits = found[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append(found.span())
        elif sign == "@":
            start = end
            while start > free["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < end and (host := _HOST.match(text, end + 1)):
                out["email"].append((start, host.end()))
                free["email"] = host.end()
        elif sign == "+":
            if end >= free["phone"] and (found := _PHONE.match(text, end)):
                free["phone"] = found.end()
                if 9 <= sum(c in "0123456789" for c in found[0]) <= 15:
                    out["phone"].append(found.span())
        elif sign == ":":
            if end + 1 >= free["user"] and (found := _USER.match(text, end + 1)):
                out["user"].append((end + 1, found.end() - 2))
                free["user"] = found.end()
        else:
            cues.append((end + 1, sign))
    _accounts(text, cues, out)
    return out


def _accounts(text: str, cues: list[tuple[int, str]], out: dict[str, list[tuple[int, int]]]) -> None:
    taken: set[tuple[int, int]] = set()
    for at, sign in cues:
        # the number is looked for right behind the cue, an IBAN first
        area = at + MOST_CUE_GAP
        for found in _IBAN.finditer(text, at, area + 45):
            if found.start() <= area and _iban(found[0]) and found.span() not in taken:
                taken.add(found.span())
                out["iban"].append(found.span())
        if sign == "c" and (found := _ACCOUNT.match(text, at, area + 30)):
            span = found.span(1)
            apart = all(span[1] <= a or span[0] >= b for a, b in taken)
            if apart and 6 <= sum(c.isdigit() for c in found[1]) <= 20:
                taken.add(span)
                out["account"].append(span)


def _joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base
    kinds' spans), spans (of all kinds, kind:start:end)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([len(f[k]) for f in found], pa.int64()) for k in BASE),
                 pa.array([hashlib.sha256(_joined(f, BASE).encode()).hexdigest() for f in found]),
                 pa.array([_joined(f, KINDS) for f in found], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE)
    return docs.select(key, text).mapInArrow(
        run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")
