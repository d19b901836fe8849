"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts the score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import col, content, fresh, without

OUT = ("spans",)
SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("score", T.DoubleType())
    .add("base", T.BooleanType())
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """An account number whose first four characters are moved to the end, letters as 10 to 35, leaves 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


# Every match starts where no part of it could have started earlier, so texts are read in one pass.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
# Characters of an account number by country, from the public register.
_IBAN_LENGTHS = {
    c[:2]: int(c[2:])
    for c in """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22
    GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31
    MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20""".split()
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGITS = re.compile(r"[^0-9]+")
_ANY = re.compile(r"[0-9@]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` takes the longest run of local characters before it that no earlier match has."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p) < 4 and int(p) < 256 for p in (q.lstrip("0") or "0" for q in m[0].split("."))):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Words after a number may look like more of it: what ends with a word and has the country's length is tried first, then
    the rest from the longest. Without a number at a place the search goes on within the candidate, of at most 34 characters."""
    m = _IBAN.search(text)
    while m:
        ends = [i for i, c in enumerate(m[0]) if c == " "] + [len(m[0])]
        tries = [(e, len(account)) for e in reversed(ends) if 15 <= len(account := m[0][:e].replace(" ", "")) <= 34 and mod97(account)]
        if tries:
            end = m.start() + next((e for e, n in tries if n == _IBAN_LENGTHS.get(m[0][:2])), tries[0][0])
            yield m.start(), end
        else:
            end = m.start() + 4
        m = _IBAN.search(text, end)


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


@dataclass(frozen=True)
class Kind:
    """How sure a confirmed span of a kind is by itself, and what words nearby make of it."""

    name: str
    find: object
    prior: float
    context: tuple[str, ...] = field(default=())
    base: bool = True  # base spans stay whatever their score


KINDS = (
    Kind("email", emails, 0.9, ("mail", "contact", "write", "kontakt", "correo", "courriel")),
    Kind("ip", ips, 0.6, ("ip", "host", "server", "address", "login", "adresse")),
    Kind("card", cards, 0.7, ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta")),
    Kind("phone", phones, 0.6, ("phone", "call", "tel", "mobile", "fax", "anruf", "téléphone", "teléfono")),
    Kind("iban", ibans, 0.9, ("iban", "account", "bank", "konto", "compte", "cuenta"), base=False),
    Kind("ssn", ssns, 0.4, ("ssn", "social", "security"), base=False),
)
# Characters on each side in which context words count, what one adds, and the score that other kinds than the base need.
NEAR, BOOST, LEAST = 50, 0.2, 0.5


def find_spans(text: str) -> list[tuple[str, int, int, float, bool]]:
    """Spans by kind and start, in code points, end exclusive."""
    found: list[tuple[str, int, int, float, bool]] = []
    if not _ANY.search(text):
        return found
    for kind in KINDS:
        for start, end in kind.find(text):
            near = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
            score = min(1.0, kind.prior + BOOST * sum(w in near for w in kind.context))
            if kind.base or score >= LEAST:
                found.append((kind.name, start, end, score, kind.base))
    return found


@F.pandas_udf(SPANS)
def _spans(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [dict(zip(("kind", "start", "end", "score", "base"), s)) for s in find_spans(t)])


def pii_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows with ``spans``: kind, start, end (code points, end exclusive), score and whether the kind is a base one.

    Spans of one kind never overlap; those of different kinds may. Candidates of a base kind that a
    validator rejects are dropped and not tried again in part; account numbers (``iban``) are, up to each word end. NULL and empty texts have no spans. Columns of the input named like an
    added one are replaced.
    """
    return without(docs, OUT).withColumn("spans", _spans(content(text)))


def mask(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first stays."""
    (cut,) = fresh(docs, "cut")

    @F.pandas_udf("string")
    def masked(texts: pd.Series, found: pd.Series) -> pd.Series:
        def one(t: str, f) -> str:
            out, end = [], 0
            for s in sorted(f, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= end:
                    out += [t[end : s["start"]], f"<{s['kind']}>"]
                    end = s["end"]
            return "".join([*out, t[end:]])

        return pd.Series([one(t, f) for t, f in zip(texts, found)], dtype=object)

    return docs.withColumn(cut, masked(content(text), col(spans))).withColumn(text, F.col(cut)).drop(cut)
