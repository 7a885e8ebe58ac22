"""Structured personal identifiers by pattern and checksum: counting on a probe, redaction of whole texts."""

from __future__ import annotations

import re


from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns that must equal the published definition, in the order of redaction. W is a word character.
PROBE_CHARS = 8000
W, NOT_AFTER, NOT_BEFORE = r"[\p{L}\p{N}_]", r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
IBAN = NOT_AFTER + r"[A-Z]{2}[0-9]{2}(?:[ \t\n\r]?[A-Z0-9]{4}){2,7}(?:[ \t\n\r]?[A-Z0-9]{1,3})?"
CARD = r"(?<!\p{Nd})(?:[0-9][ -]?){13,19}(?!\p{Nd})"  # checksums are defined on ASCII digits
PATTERNS = {
    "email": NOT_AFTER + r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)*\.[A-Za-z]{2,}" + NOT_BEFORE,
    "phone_in": r"(?<![\p{Nd}\p{L}\p{N}_])(?:\+91[\s-]?|0)?[6-9]\p{Nd}{9}(?!\p{Nd})",
    "aadhaar": r"(?<!\p{Nd})(?<!\p{Nd}[\s-])\p{Nd}{4}[\s-]\p{Nd}{4}[\s-]\p{Nd}{4}(?![\s-]?\p{Nd})",
    "pan": NOT_AFTER + r"[A-Z]{5}\p{Nd}{4}[A-Z]" + NOT_BEFORE,
    "ip": r"(?<!\p{Nd})(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}(?!\p{Nd})",
}
KINDS = ("iban", "card", *PATTERNS)


def luhn_ok(digits: Column) -> Column:
    """Luhn's check of a string of digits."""
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = F.transform(chars, lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97_ok(account: Column) -> Column:
    """The remainder 1 modulo 97 of a bank account number, digit by digit, so no number grows large."""
    turned = F.concat(F.substring(account, 5, 99), F.substring(account, 1, 4))
    values = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    left = F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return F.length(account).between(15, 34) & (left == 1)


def iban_spans(text: Column) -> Column:
    """Valid account numbers as they are written."""
    return F.filter(F.regexp_extract_all(text, F.lit(f"({IBAN})"), F.lit(1)), lambda m: mod97_ok(F.regexp_replace(m, r"\s", "")))


def card_spans(text: Column) -> Column:
    """Valid card numbers as they are written."""
    found = F.regexp_extract_all(text, F.lit(f"({CARD})"), F.lit(1))
    return F.filter(found, lambda m: F.length(F.regexp_replace(m, "[ -]", "")).between(13, 19) & luhn_ok(F.regexp_replace(m, "[ -]", "")))


def scan(text: Column, chars: int | None = None) -> Column:
    """Counts by kind in the text, or in its first ``chars`` characters; kinds without a hit are left out. An account number's digits are not also a card."""
    probe = F.coalesce(text if chars is None else F.substring(text, 1, chars), F.lit(""))
    ibans = iban_spans(probe)
    without = F.aggregate(ibans, probe, lambda t, m: F.replace(t, m, F.lit("\u0001")))
    counts = {"iban": F.size(ibans), "card": F.size(card_spans(without))} | {k: F.regexp_count(probe, F.lit(p if k != "email" else "(?i)" + p)) for k, p in PATTERNS.items()}
    every = F.create_map(*[x for k, c in counts.items() for x in (F.lit(k), c.cast("long"))])
    return F.map_filter(every, lambda _, n: n > 0)


def _python(p: str) -> re.Pattern:
    return re.compile(p.replace(r"[\p{L}\p{N}_]", r"\w").replace(r"\p{L}\p{N}_", r"\w").replace(r"\p{Nd}", r"\d"))


_REDACTORS: list[tuple[str, re.Pattern]] = []


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def _iban(text: str) -> bool:
    if not 15 <= len(text) <= 34 or not text.isascii():
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def redact_text(text: str) -> tuple[str, dict[str, int]]:
    """The text with every identifier replaced by ``[PII:kind]``, and how many of each kind there were."""
    if not _REDACTORS:
        _REDACTORS.extend([("iban", _python(IBAN)), ("card", _python(CARD)), *((k, re.compile(_python(p).pattern, re.I if k == "email" else 0)) for k, p in PATTERNS.items())])
    counts: dict[str, int] = {}
    for kind, pattern in _REDACTORS:

        def put(m: re.Match, kind: str = kind) -> str:
            raw = re.sub(r"[\s-]", "", m.group())
            if (kind == "iban" and not _iban(re.sub(r"\s", "", m.group()))) or (kind == "card" and not (13 <= len(raw) <= 19 and _luhn(raw))):
                return m.group()
            counts[kind] = counts.get(kind, 0) + 1
            return f"[PII:{kind}]"

        text = pattern.sub(put, text)
    return text, counts


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("counts", T.MapType(T.StringType(), T.LongType()))]))
def _redact(texts):
    import pandas as pd

    done = [(None, None) if t is None else redact_text(t) for t in texts]
    return pd.DataFrame({"text": [d[0] for d in done], "counts": [d[1] for d in done]})


def redact(text: Column) -> Column:
    """``struct(text, counts)`` of the whole text; null stays null. Checksums and the order of kinds need Python."""
    return _redact(text)
