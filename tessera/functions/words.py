"""Word normal form: folding of text and maximal runs of word characters."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Version of the normal form; part of every configuration identity.
NORMAL_FORM = 2


def ranges(codes: list[int]) -> str:
    """Character-class body for ascending code points."""
    out: list[list[int]] = []
    for c in codes:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in out)


@lru_cache(2)
def _patterns(astral: bool = True) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """Hidden characters, words, and runs. Without characters beyond the basic plane a class is one table lookup, with
    them a search through its ranges, so texts without any have patterns of their own."""
    last = sys.maxunicode if astral else 0xFFFF
    codes = [c for c in range(last + 1) if not 0xD800 <= c < 0xE000]
    hidden = [c for c in codes if c >= 0x80 and (unicodedata.category(chr(c)) == "Cf" or c == 0x34F or 0x180B <= c <= 0x180F or 0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF)]
    run = [c for c in codes if chr(c).isalnum() or unicodedata.category(chr(c))[0] == "M"]
    return re.compile(f"[{ranges(hidden)}]+"), re.compile(f"[{ranges(sorted({*run, 95}))}]+"), re.compile(f"[{ranges(run)}]+")


_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def _for(text: str) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    return _patterns(_ASTRAL.search(text) is not None)


def fold(text: str) -> str:
    """Lower case for ASCII; else compatibility composition, case folding, and no invisible characters."""
    if text.isascii():
        return text.lower()
    hidden = _for(text)[0]
    t = text if unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)
    t = t.casefold()
    if hidden.search(t):
        t = hidden.sub("", t)
    return t if unicodedata.is_normalized("NFKC", t) else unicodedata.normalize("NFKC", t)


def split_words(folded: str) -> list[str]:
    """Maximal runs of letters, digits, underscores and marks that hold more than marks."""
    return [w for w in _for(folded)[1].findall(folded) if w.isascii() or any(c.isalnum() or c == "_" for c in w)]


def normalize_words(text: str | None) -> list[str]:
    """Words of the folded text; null gives none."""
    return split_words(fold(text)) if text else []


def runs(text: str) -> list[str]:
    """Maximal runs of letters, marks and digits of the folded text; an underscore parts words here."""
    return plain_runs(fold(text))


def plain_runs(folded: str) -> list[str]:
    """The same of a text that is folded already."""
    return _for(folded)[2].findall(folded)


@F.pandas_udf(T.StringType())
def _fold_udf(texts):
    return texts.map(lambda t: None if t is None else fold(t))


def folded(text: Column) -> Column:
    """The folded text. Only rows that are not ASCII reach Python's tables of characters."""
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), F.lower(text)).otherwise(_fold_udf(text))


def words_of(folded_text: Column) -> Column:
    """Words of a folded text, inside the JVM. Explicit classes, since shorthand classes differ between engines."""
    return F.regexp_extract_all(folded_text, F.lit(r"(\p{M}*[\p{L}\p{N}_][\p{L}\p{N}_\p{M}]*)"), F.lit(1))
