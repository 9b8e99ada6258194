"""Personal data in whole texts: patterns propose spans, checksums confirm them, context words move the score.

Every scan is linear in the text: no pattern here can restart inside a run it has already read. Defined results:
NULL and empty texts have no spans; offsets count code points, ends are exclusive; repeated rows are scanned alike;
other columns pass through, and a column that has the result's name is refused; very long texts are scanned whole; an
empty table gives an empty table.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import refuse_clash, small_batches, text_of

# Order of kinds at equal starts.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Runs without a dot match too: a pattern that asked for one would start again at every digit of a long number.
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
# Lengths of account numbers by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}
# What the checks alone are worth, and the words before a span that raise it.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "amex", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "social-security"),
}
CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.3
LEAST_SCORE = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str):
    """Left of each @ the longest run of address characters after the last match, right of it a dotted name."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL_PART:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            floor = found.end()
        else:
            # Nothing that begins before this @ can match: an address holds one @ only.
            floor = at + 1
        at = text.find("@", max(floor, at + 1))


def addresses(text: str):
    """A run of dotted numbers is cut into fours from its left end."""
    for run in DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        at, parts = run.start(), run.group().split(".")
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                yield at, end
            at = end + 1


def cards(text: str):
    for run in CARD.finditer(text):
        digits = run.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield run.span()


def phones(text: str):
    if "+" in text:
        for run in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in run.group()) <= 15:
                yield run.span()


def ibans(text: str):
    for head in IBAN_HEAD.finditer(text):
        length = IBAN_LENGTH.get(head.group()[:2])
        if not length:
            continue
        at, account = head.start(), []
        while at < len(text) and len(account) < length:
            char = text[at]
            if ("0" <= char <= "9") or ("A" <= char <= "Z"):
                account.append(char)
            elif char != " " or text[at - 1] == " ":
                break
            at += 1
        if len(account) == length and not text[at : at + 1].isalnum() and mod97("".join(account)):
            yield head.start(), at


def numbers(text: str):
    for run in SSN.finditer(text):
        yield run.span()


FINDERS = {"email": emails, "ip": addresses, "card": cards, "phone": phones, "iban": ibans, "ssn": numbers}
BASE_KINDS = KINDS[:4]


def scan(text: str) -> list[tuple[str, int, int, float]]:
    """Confirmed spans of one text in order of start, then kind. Base kinds stay whatever their score."""
    spans, taken = [], []
    for kind in KINDS:
        for start, end in FINDERS[kind](text):
            near = text[max(0, start - CONTEXT_CHARS) : start].lower()
            score = round(min(1.0, BASE_SCORE[kind] + CONTEXT_GAIN * any(word in near for word in CONTEXT[kind])), 3)
            if kind in BASE_KINDS:
                taken.append((start, end))
            elif score < LEAST_SCORE or any(a < end and start < b for a, b in taken):
                continue
            spans.append((kind, start, end, score))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def find_spans(df: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """``df`` with an array of (kind, start, end, score)."""
    refuse_clash(df, into)
    small_batches(df.sparkSession)

    @F.pandas_udf(SPAN)
    def spans_of(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "score"), s)) for s in scan(t)] for t in texts], dtype=object)

    return df.withColumn(into, spans_of(text_of(df, text)))
