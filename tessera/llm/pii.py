"""Personal information inside free text (problem 3).

Regular expressions propose spans, checksums confirm those that have one, and nearby words raise or lower the score;
spans that reach ``ACCEPT`` are replaced by typed placeholders. Names of persons have no checksum: what vouches for them is
how often their words follow a form of address or "my name is" in the corpus itself, wherever they then stand.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.words import ranges
from tessera.session import materialize

KINDS = ("email", "phone", "id_number", "address", "name")
#: Score from which a span counts, and characters on either side in which context words are looked for.
ACCEPT, REACH = 0.5, 34
#: A word belongs to names if at least this share of its places in texts with forms of address is behind one. Every worker holds
#: up to MOST_NAME_WORDS of them; more are joined to the texts they stand in.
NAME_SHARE, MOST_NAME_WORDS = 0.5, 200_000


@lru_cache(1)
def _plain() -> dict[int, str]:
    """One-to-one table to plain digits, signs and spaces, so that spans keep their places."""
    table = {}
    for c in range(0x80, 0x1F000):
        ch = chr(c)
        kind = unicodedata.category(ch)
        if kind == "Nd":
            table[c] = str(unicodedata.digit(ch))
        elif kind == "Zs":
            table[c] = " "
        elif kind == "Pd":
            table[c] = "-"
        elif 0xFF01 <= c <= 0xFF5E:
            table[c] = chr(c - 0xFEE0)
    return table


@lru_cache(1)
def _needs_plain() -> re.Pattern:
    """Characters that the table changes, and all beyond the basic plane: without those a class is one table lookup."""
    return re.compile(f"[{ranges(sorted(c for c in _plain() if c < 0x10000))}]|[\U00010000-\U0010ffff]")


def plain(text: str) -> str:
    """The text with plain digits, signs and spaces, as long as before."""
    return text if text.isascii() or not _needs_plain().search(text) else text.translate(_plain())


# Checksums.


def luhn(digits: str) -> bool:
    """Payment cards."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """International bank account numbers: 15 to 34 letters and digits that leave 1."""
    if not 15 <= len(account) <= 34 or not account.isascii() or not account.isalnum():
        return False
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


@lru_cache(1)
def _dihedral() -> tuple[list[list[int]], list[list[int]]]:
    """Products in the dihedral group of ten elements, and the powers of the permutation of the scheme."""
    d = [[(a + b) % 5 if a < 5 and b < 5 else (a + b % 5) % 5 + 5 if a < 5 else (a - b) % 5 + 5 if b < 5 else (a - b) % 5 for b in range(10)] for a in range(10)]
    powers = [list(range(10)), [1, 5, 7, 6, 2, 8, 3, 0, 9, 4]]
    while len(powers) < 8:
        powers.append([powers[1][x] for x in powers[-1]])
    return d, powers


def verhoeff(digits: str) -> bool:
    """Twelve-digit national identity numbers."""
    d, p = _dihedral()
    c = 0
    for i, x in enumerate(reversed(digits)):
        c = d[c][p[i % 8][int(x)]]
    return c == 0


# Context words.

_CONTEXT = {
    "phone": re.compile(
        r"\b(?:call|phone|mobile|cell|ring|whatsapp|text to|sms|number is|picks up|ph|tel|telephone|fax|contact|dial)\b"
        r"|फ़?ोन|फ़ोन|मोबाइल|संपर्क|ফোন|মোবাইল|নম্বর|கைபேசி|தொலைபேசி|அழைக்க|ఫోన్|మొబైల్|ફોન|મોબાઇલ|فون|موبائل|رابطہ",
        re.I,
    ),
    "id_number": re.compile(
        r"\b(?:identity|id|passport|pan|card|account|document|proof|iban|tax|national|aadhaar|licen[cs]e|holder)\b"
        r"|पहचान|पासपोर्ट|खाता|आधार|कार्ड|পরিচয়|পরিচয়|পাসপোর্ট|হিসাব|অ্যাকাউন্ট|அடையாள|கடவுச்சீட்டு|கணக்கு|గుర్తింపు|ఖాతా|ઓળખ|ખાતા|شناخت|کھاتہ|ओळख",
        re.I,
    ),
    "address": re.compile(
        r"\b(?:address|residence|resident|lives?|lived|living|parcels?|deliver(?:ed|y)?|sent to|moved to|come to|went to|post to|write to|stays? at)\b"
        r"|पता|पते|पत्ता|मकान|सामान|ঠিকানা|বাড়ি|বাড়ি|முகவரி|చిరునామా|సરનામું|સરનામું|پتہ|ठेगाना",
        re.I,
    ),
}
_AGAINST = re.compile(
    r"\b(?:order|invoice|bill no|catalogue|catalog|isbn|issn|build|version|ledger|total|meter|serial|sku|tracking|ticket|batch|part no|ref(?:erence)?|litres|rupees|grams|percent)\b",
    re.I,
)


def _near(t: str, a: int, b: int, p: re.Pattern, after: bool = True) -> bool:
    return bool(p.search(t, max(0, a - REACH), a) or (after and p.search(t, b, b + REACH)))


# Proposals: each yields (start, end, kind, score) on the plain text.

_EMAIL = re.compile(r"(?<![\w.+-])[^\W_][\w.+-]*\s{0,2}@\s{0,2}[^\W_](?:[\w-]*[^\W_])?(?:\s?\.\s?[^\W_](?:[\w-]*[^\W_])?)*?\.[^\W\d_]{2,24}(?![\w@])")
_AT = r"\s*(?:\(\s*at\s*\)|\[\s*at\s*\]|\{\s*at\s*\}|<\s*at\s*>)\s*"
_DOT = r"(?:\s*(?:\(\s*dot\s*\)|\[\s*dot\s*\]|\{\s*dot\s*\})\s*|\s+dot\s+|\.)"
_EMAIL_SPELLED = re.compile(rf"(?<![\w.+-])[^\W_](?:[\w+-]|{_DOT}(?=\w))*(?:{_AT}|\s+at\s+(?=[\w-]+\s+dot\s)|\s*@\s*)[^\W_][\w-]*(?:{_DOT}[^\W_][\w-]*)+", re.I)


def _emails(t: str) -> Iterator[tuple[int, int, str, float]]:
    if "@" in t:
        for m in _EMAIL.finditer(t):
            yield m.start(), m.end(), "email", 0.9
    low = t.lower()
    if "(at" in low or "[at" in low or "{at" in low or "<at" in low or " dot " in low or "[dot" in low or "(dot" in low or "( at" in low or "[ at" in low:
        for m in _EMAIL_SPELLED.finditer(t):
            if re.search(r"[^\W\d_]{2,}$", m.group()):
                yield m.start(), m.end(), "email", 0.8


_DIGITS = re.compile(r"(?<![\w@#])(?<!\d[.,])(?:\+\s?|\(\+?)?\d(?:[\s().-]{0,2}\d){6,18}(?![\w@]|[.,]\d)")
_DATE = re.compile(r"(?:19|20)\d\d[-./ ]\d{1,2}[-./ ]\d{1,2}|\d{1,2}[-./ ]\d{1,2}[-./ ](?:19|20)\d\d")
_QUAD = re.compile(r"(?:\d{1,3}\.){3}\d{1,3}")


def _phone_score(raw: str) -> float:
    digits = re.sub(r"\D", "", raw)
    n, groups = len(digits), re.findall(r"\d+", raw)
    if raw.lstrip("( ").startswith("+"):
        return 0.7 if 9 <= n <= 15 else 0.0
    if digits.startswith("00"):
        return 0.65 if 11 <= n <= 16 else 0.0
    if re.fullmatch(r"\(?0\d{1,4}\)?[\s-]?\d{3,4}[\s-]?\d{4}", raw):
        return 0.65
    if re.fullmatch(r"0?[6-9]\d{9}", digits):
        # ten digits at a stretch, or in groups as telephone numbers are written
        return 0.55 if len(groups) == 1 or [len(g) for g in groups] in ([5, 5], [3, 3, 4], [4, 3, 3], [3, 4, 3], [6, 5], [4, 6], [5, 6], [1, 5, 5], [4, 3, 4]) else 0.35
    if re.fullmatch(r"(?:1-)?\(?\d{3}\)?[\s.-]\d{3}[\s.-]\d{4}|1-\d{3}-\d{4}", raw):
        return 0.55
    return 0.25 if 7 <= n <= 12 else 0.0


def _numbers(t: str) -> Iterator[tuple[int, int, str, float]]:
    for m in _DIGITS.finditer(t):
        raw, a, b = m.group(), m.start(), m.end()
        if _DATE.fullmatch(raw) or _QUAD.fullmatch(raw):
            continue
        digits = re.sub(r"\D", "", raw)
        ctx_id = _near(t, a, b, _CONTEXT["id_number"])
        ctx_phone = _near(t, a, b, _CONTEXT["phone"])
        against = 0.4 if _near(t, a, b, _AGAINST) else 0.0
        ident = 0.0
        groups = [len(g) for g in re.findall(r"\d+", raw)]
        if 13 <= len(digits) <= 19 and luhn(digits) and "(" not in raw and "+" not in raw and (len(groups) == 1 or groups[:3] == [4, 4, 4] or groups[:2] == [4, 6]):
            ident = 0.9  # a valid card number is one, whatever it stands beside
        elif len(digits) == 12 and digits[0] > "1" and groups in ([12], [4, 4, 4]) and verhoeff(digits):
            ident = 0.9
        elif 9 <= len(digits) <= 18 and ctx_id and len(groups) == 1 and re.search(r"account|खाता|হিসাব|கணக்கு|ఖాతా|ખાતા", t[max(0, a - REACH) : a], re.I) and len(digits) not in (12, 16):
            ident = 0.55 - against
        phone = _phone_score(raw)
        if phone:
            phone += 0.3 * ctx_phone - 0.3 * (ctx_id and not ctx_phone) - against
        if ident >= ACCEPT:
            yield a, b, "id_number", ident
        elif phone >= ACCEPT and not (len(digits) in (12, 16) and "+" not in raw and not digits.startswith("0")):
            yield a, b, "phone", phone


_IBAN = re.compile(r"(?<![\w-])(?:[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?:[ -][A-Z0-9]{4}){2,7}(?:[ -][A-Z0-9]{1,4})?)|[a-z]{2}\d{2}(?:[a-z0-9]{11,30}|(?:[ -][a-z0-9]{4}){2,7}(?:[ -][a-z0-9]{1,4})?))(?!\w)")
_PAN = re.compile(r"(?<![\w])([A-Za-z]{5})[ -]?(\d{4})[ -]?([A-Za-z])(?![\w])")
_PASSPORT = re.compile(r"(?<![\w])[A-Za-z][ -]?\d{7}(?![\w])")


# What every such code holds, looked for first because it is rare.
_IBAN_HINT, _PAN_HINT, _PASSPORT_HINT = re.compile(r"[A-Za-z]{2}\d\d"), re.compile(r"\d{4}[ -]?[A-Za-z](?!\w)"), re.compile(r"\d{7}(?!\w)")


def _codes(t: str) -> Iterator[tuple[int, int, str, float]]:
    for m in _IBAN.finditer(t) if _IBAN_HINT.search(t) else ():
        raw = m.group()
        # a group behind the account may be a word of the sentence
        for end in [len(raw), *sorted((i for i, c in enumerate(raw) if c in " -"), reverse=True)[:1]]:
            if mod97(re.sub(r"[ -]", "", raw[:end]).upper()):
                yield m.start(), m.start() + end, "id_number", 0.9
                break
    for m in _PAN.finditer(t) if _PAN_HINT.search(t) else ():
        letters = m.group(1) + m.group(3)
        known = letters[3].upper() in "ABCFGHJLPT"
        score = 0.3 + 0.3 * (known and (letters.isupper() or letters.islower())) - 0.15 * (" " in m.group() or letters.islower())
        yield m.start(), m.end(), "id_number", score + 0.3 * _near(t, m.start(), m.end(), _CONTEXT["id_number"]) - 0.3 * _near(t, m.start(), m.end(), _AGAINST)
    for m in _PASSPORT.finditer(t) if _PASSPORT_HINT.search(t) else ():
        yield m.start(), m.end(), "id_number", 0.35 + 0.3 * _near(t, m.start(), m.end(), _CONTEXT["id_number"]) - 0.3 * _near(t, m.start(), m.end(), _AGAINST)


_NO = r"\d{1,4}(?:\s?[-/]\s?(?:\d{1,4}|[A-Za-z]))?(?!\d)"
_HOUSE = r"(?:\b(?:h\.?\s?no|house(?:\s+no)?|flat(?:\s+no)?|door\s+no|plot(?:\s+no)?|apartment|apt|room)\.?|मकान(?:\s+नंबर)?|घर(?:\s+क्रमांक|\s+नंबर)?|फ्लैट|বাড়ি(?:\s+নং)?|বাড়ি(?:\s+নং)?|ফ্ল্যাট|வீட்டு?\s+எண்|எண்|ఇంటి(?:\s+నం)?|ઘર(?:\s+નં)?|مکان(?:\s+نمبر)?)"
_STREET = r"(?:(?:road|street|lane|marg|cross|avenue|sarani|gali|path|drive|terrace|square|colony|rd|st|ave)\b|मार्ग|सड़क|गली|रोड|पथ|रस्ता|সরণি|রোড|লেন|গলি|তেরু|தெரு|சாலை|வீதி|వీధి|రోడ్డు|શેરી|રોડ|માર્ગ|سڑک|گلی|روڈ)"
_ADDRESS = re.compile(rf"(?P<house>{_HOUSE}\s*)?(?<![\d/-])(?P<no>{_NO}),?\s+(?:{_NO},?\s+)?(?P<way>(?:[^\W\d_][^\s\d,.;:]*\s+){{1,3}}?{_STREET})(?P<rest>(?:\s*,\s*near\s+[\w ]+?)?(?:\s*[,\n-]\s*|\s+)[^\s,.;:\d-]+(?:[\s,-]*(?:PIN\s*:?\s*)?(?P<pin>\d{{6}})\b)?)?", re.I)


_STREETS = tuple(sorted({w.removesuffix(r"\b").strip("()?:").removesuffix(r")\b") for w in _STREET[3:-1].split("|")}))


def _addresses(t: str) -> Iterator[tuple[int, int, str, float]]:
    low = t.lower()
    for m in _ADDRESS.finditer(t) if any(w in low for w in _STREETS) else ():
        rest = m.group("rest") or ""
        town = re.match(r"\s*[,\n-]", rest) is not None and re.search(r"[^\W\d_]{3,}", rest) is not None
        way = m.group("way").split()
        named = all(not w.isascii() or w[0].isupper() for w in way)
        score = 0.25 + 0.1 * named + 0.35 * bool(m.group("house")) + 0.2 * town + 0.35 * bool(m.group("pin")) + 0.25 * _near(t, m.start(), m.end(), _CONTEXT["address"], after=False)
        yield m.start(), m.end(), "address", score


# Names. Forms of address, and how people give their name.
_TITLES = ("mr", "mrs", "ms", "miss", "dr", "prof", "shri", "smt", "sri", "fr", "sister", "master")
_TITLES_BEFORE = (
    "श्रीमती", "श्री", "सुश्री", "डॉ", "डॉ.", "कुमारी", "श्रीमान", "শ্রীমতী", "শ্রী", "ডাঃ", "ডা.", "জনাব", "বেগম", "திருமதி", "திரு", "திரு.", "டாக்டர்", "செல்வி",
    "శ్రీమతి", "శ్రీ", "డాక్టర్", "શ્રીમતી", "શ્રી", "ડૉ.", "જનાબ", "جناب", "محترمہ", "ڈاکٹر",
)
_MY_NAME = ("मेरा नाम", "माझे नाव", "माझं नाव", "मेरो नाम", "আমার নাম", "என் பெயர்", "నా పేరు", "મારું નામ", "میرا نام")
# Words behind a name that are no part of it.
_BEHIND = frozenset("ने को का की के से में पर है हैं था थी जी और यांनी आहे आणि ले को हो छ र এর কে ছিল এবং আর மற்றும் ఉంది మరియు છે અને نے کو کا کی کے سے ہے اور".split())
# English words that begin sentences and are no names.
_OPENERS = frozenset(
    "a an the this that these those it its he she they we you i my our your his her their in on at by for from to of with without into over under after before when while if although though because since "
    "as and but or so not no nobody some many most all each every both either however meanwhile moreover therefore then there here yesterday today tomorrow now once what which who whose why how where "
    "mr mrs ms dr prof signed regards sincerely yours dear".split()
)
_PERSON = re.compile(r"\b(?:said|says|told|tells|asked|wrote|writes|complained|born|died|married|widow|widower|aged|daughter|son|wife|husband|mother|father|brother|sister|signed|regards|sincerely|named|lives?|lived|met|his|her|she|he|who)\b", re.I)
_PLACE = re.compile(r"\b(?i:roads?|streets?|lanes?|marg|cross|avenue|bridge|market|temple|village|council|school|library|museum|river|committee|hospital|station|district|town|city|university|college|company|bank|limited|ltd|park|lake|hill|hall)\b")
_WORD = r"[^\W\d_][^\s\d,.;:!?।۔()\[\]<>@\"“”…/_]*"
_CAP = r"(?:[A-Z][a-z]+(?:-[A-Z][a-z]+)*|[A-Z]{2,}(?:-[A-Z]{2,})*|[A-Z]\.)"
_LATIN_CUE = re.compile(rf"\b(?i:(?:{'|'.join(_TITLES)})\b\.?|my\s+name(?:\s+is|'s|’s))\s+(?P<n>{_CAP}(?:\s+{_CAP}){{0,2}})")
_BEFORE_CUE = r"(?:^|[\s(।])"


def _trie(words: tuple[str, ...]) -> str:
    """A pattern of the words that looks at each of their common beginnings once; a blank is any white space."""
    if "" in words:
        return ""
    by: dict[str, list[str]] = {}
    for w in sorted(words):
        by.setdefault(w[0], []).append(w[1:])
    parts = [(r"\s+" if c == " " else re.escape(c)) + _trie(tuple(rest)) for c, rest in by.items()]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


_CUE_TEST = _BEFORE_CUE + f"(?=[{''.join(sorted({w[0] for w in _TITLES_BEFORE + _MY_NAME}))}]){_trie(_TITLES_BEFORE + _MY_NAME)}"
_CUE = re.compile(rf"{_BEFORE_CUE}(?:{'|'.join(re.escape(w).replace(chr(92) + ' ', chr(92) + 's+') for w in sorted(_TITLES_BEFORE + _MY_NAME, key=len, reverse=True))})\s+(?P<n>(?:[A-Z]\.|{_WORD})(?:\s+(?:[A-Z]\.|{_WORD})){{0,2}})")
_CUE_HINT = re.compile(_CUE_TEST)
_TOKEN = re.compile(rf"[A-Z]\.|{_WORD}")
_WORDS = re.compile(_WORD)
_CUE_WORDS = frozenset([*_TITLES, "name"])
_TITLE_CASE = r"(?:[A-Z][a-z]+(?:-[A-Z][a-z]+)*|[A-Z]\.)"
_FULL = re.compile(rf"(?<![\w@.-]){_TITLE_CASE}(?:\s+{_TITLE_CASE}){{1,2}}(?![\w@])")
_INITIAL = re.compile(r"[A-Z]\.")


def _is_cased(w: str) -> bool:
    return w.isascii() and not w[0].isupper()


def _cued(t: str) -> Iterator[tuple[int, str]]:
    """Place and words behind the forms of address of a text, without what cannot be part of a name."""
    found = [*_LATIN_CUE.finditer(t), *(_CUE.finditer(t) if not t.isascii() and _CUE_HINT.search(t) else ())]
    for m in found:
        n, words = m.group("n"), m.group("n").split()
        latin = m.re is _LATIN_CUE
        end = 0
        for i, w in enumerate(words):
            bare = w.strip("'’")
            if bare in _BEHIND or (i and bare.lower() in _OPENERS) or (not latin and _is_cased(bare)) or (not latin and i == 2 and not any(map(_INITIAL.fullmatch, words[:2]))):
                break
            end = n.index(w, end) + len(w)
        n = n[:end]
        if n and not all(map(_INITIAL.fullmatch, n.split())):
            yield m.start("n"), n


def cue_test(text: Column) -> Column:
    """Whether a text may hold a form of address, inside the JVM."""
    latin = r"(?<![A-Za-z])[DdFfMmPpRrSs](?:[Rr][Ss]?|[Ss]|[Ii][Ss][Ss]|[Rr][Oo][Ff]|[Hh]?[Rr][Ii]|[Mm][Tt]|[Ii][Ss][Tt][Ee][Rr]|[Aa][Ss][Tt][Ee][Rr])\.?\s+[A-Z]|[Mm][Yy]\s+[Nn][Aa][Mm][Ee]"
    return text.rlike(latin) | text.rlike(_CUE_TEST)


def _count_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a partition's texts its places behind forms of address and all its places."""
    behind, all_ = Counter(), Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            t = plain(text)
            slots = [w for _, n in _cued(t) for w in n.split() if not _INITIAL.fullmatch(w)]
            if slots:
                behind.update(w.casefold() for w in slots)
                all_.update(w.casefold() for w in _TOKEN.findall(t))
        words = [w for w in all_ if behind[w]] if len(all_) > 1_000_000 else []
        if words:  # give what is counted so far away, so that a worker's memory stays bounded
            yield pa.RecordBatch.from_arrays([pa.array(list(all_)), pa.array([behind[w] for w in all_], pa.int64()), pa.array(list(all_.values()), pa.int64())], ["word", "behind", "n"])
            behind, all_ = Counter(), Counter()
    yield pa.RecordBatch.from_arrays([pa.array(list(all_), pa.string()), pa.array([behind[w] for w in all_], pa.int64()), pa.array(list(all_.values()), pa.int64())], ["word", "behind", "n"])


def name_words(df: DataFrame, text: str) -> list[str] | DataFrame:
    """Words of names, learned from all texts that hold a form of address: their list, or their table (``word``) if they are more
    than MOST_NAME_WORDS. Null texts tell nothing."""
    counted = df.select(F.col(text).alias("t")).where(cue_test(F.col("t"))).mapInArrow(_count_names, "word string, behind long, n long").groupBy("word").agg(F.sum("behind").alias("behind"), F.sum("n").alias("n")).where((F.col("behind") > 0) & (F.col("behind") >= NAME_SHARE * F.col("n")))
    kept = materialize(counted.select("word"), "name-words")
    return kept if kept.count() > MOST_NAME_WORDS else sorted(r[0] for r in kept.collect())


def _askable(t: str) -> set[str]:
    """Words of a text that tell names if they are words of names."""
    return {w.casefold() for w in set(_TOKEN.findall(t)) if not _is_cased(w)}


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word that a batch asks for, once, with the keys of the texts that do."""
    for batch in batches:
        asked: dict[str, list[int]] = {}
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for w in _askable(plain(text)):
                asked.setdefault(w, []).append(key)
        yield pa.RecordBatch.from_arrays([pa.array(list(asked), pa.string()), pa.array(list(asked.values()), pa.list_(pa.int64()))], ["word", "keys"])


def _known_by_text(texts: DataFrame, words: DataFrame) -> DataFrame:
    """``_known``, the words of names in the texts (``_text``) of every ``_key``, where there are any. Words, not texts, are
    shuffled; texts that share a key by chance get each other's words, which are words of names all the same."""
    asked = texts.select("_key", "_text").where("_text is not null").mapInArrow(_ask, "word string, keys array<long>")
    return asked.join(words, "word", "left_semi").select("word", F.explode("keys").alias("_key")).groupBy("_key").agg(F.collect_set("word").alias("_known"))


def _names(t: str, known: frozenset[str]) -> Iterator[tuple[int, int, str, float]]:
    words = set(_WORDS.findall(t.casefold()))
    for a, n in _cued(t) if not t.isascii() or not words.isdisjoint(_CUE_WORDS) else ():
        yield a, a + len(n), "name", 0.7 - 0.5 * bool(_PLACE.search(n))
    if not known.isdisjoint(words):
        run: list[tuple[int, int, bool]] = []  # neighbouring words of names and initials
        for m in [*_TOKEN.finditer(t), None]:
            if m is not None:
                w = m.group()
                initial = _INITIAL.fullmatch(w) is not None
                if run and t[run[-1][1] : m.start()].strip():
                    yield from _of_run(t, run)
                    run = []
                if initial or (w.casefold() in known and not _is_cased(w)):
                    run.append((m.start(), m.end(), initial))
                    continue
            yield from _of_run(t, run)
            run = []
    for m in _FULL.finditer(t):
        words = m.group().split()
        if words[0].lower() in _OPENERS:
            words = words[1:]
        while len(words) > 1 and words[-1].lower() in _OPENERS:
            words = words[:-1]
        if len(words) < 2 or all(map(_INITIAL.fullmatch, words)) or _PLACE.search(t, m.start(), m.end() + 12):
            continue
        a = m.start() + m.group().index(words[0])
        end = a + len(re.match(r"\s+".join(map(re.escape, words)), t[a:]).group())
        yield a, end, "name", 0.2 + 0.25 * _near(t, a, end, _PERSON) + 0.1 * (a > 1 and t[a - 2] not in ".!?\n।")


def _of_run(t: str, run: list[tuple[int, int, bool]]) -> Iterator[tuple[int, int, str, float]]:
    while run and run[-1][2]:  # an initial that ends a run belongs to the next sentence
        run = run[:-1]
    told = sum(not initial for _, _, initial in run)
    if len(run) < 2 or not told:
        return
    a, b = run[0][0], run[-1][1]
    if not (t[b : b + 1] == "@" or t[a - 1 : a] == "@"):
        yield a, b, "name", 0.4 + 0.15 * min(2, told) - 0.3 * bool(_PLACE.match(t, b + 1))


def find(text: str | None, known: frozenset[str] = frozenset()) -> list[tuple[int, int, str, float]]:
    """``(start, end, kind, score)`` of the accepted spans of a text, in order and without overlaps; ``known`` are words of names.

    Of overlapping spans the higher score wins, then the longer; names inside e-mail addresses are no names.
    """
    if not text:
        return []
    t = plain(text)
    spans: list[tuple[int, int, str, float]] = []
    spans += _emails(t)
    if re.search(r"\d", t):
        spans += _numbers(t)
        spans += _codes(t)
        spans += _addresses(t)
    spans += _names(t, known)
    taken: list[tuple[int, int, str, float]] = []
    for s in sorted((s for s in spans if s[3] >= ACCEPT), key=lambda s: (-round(s[3], 6), s[0] - s[1], s[0])):
        if all(s[1] <= x[0] or s[0] >= x[1] for x in taken):
            taken.append(s)
    return sorted(taken)


def redact(text: str | None, spans: list[tuple[int, int, str, float]] | None = None) -> str | None:
    """The text with every accepted span replaced by ``[EMAIL]``, ``[PHONE]`` and so on; the rest is unchanged."""
    if not text:
        return text
    out, at = [], 0
    for a, b, kind, _ in find(text) if spans is None else spans:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())])


def detect(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``spans`` (start, end, kind, score) and the ``redacted`` text of every row.

    Null texts stay null and, like empty ones, have no spans; texts are read whole, twice: words of names are learned from all
    of them first. If those are too many to be held, texts are read once more and shuffled once, to meet the words they hold;
    the result is the same. Repeated rows give repeated rows.
    """
    kinds = dict(df.dtypes)
    words = name_words(df, text)
    rows = df.select(*keep, F.col(text).alias("_text"))
    if isinstance(words, list):
        held = df.sparkSession.sparkContext.broadcast(words)
    else:
        held = None
        rows = rows.withColumn("_key", F.xxhash64("_text"))
        rows = rows.join(_known_by_text(rows, words), "_key", "left").select(*keep, "_text", "_known")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frozenset(held.value if held else ())
        for batch in batches:
            n = len(keep)
            texts = batch.column(n).to_pylist()
            found = [find(t, known) for t in texts] if held else [find(t, frozenset(k or ())) for t, k in zip(texts, batch.column(n + 1).to_pylist(), strict=True)]
            spans = [[dict(zip(("start", "end", "kind", "score"), s, strict=True)) for s in f] for f in found]
            clear = [redact(t, f) if f else t for t, f in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(spans, pa.list_(_SPAN)), pa.array(clear, pa.string())], [*batch.schema.names[:n], "spans", "redacted"])

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "spans array<struct<start:bigint,end:bigint,kind:string,score:double>>, redacted string"])
    return rows.mapInArrow(run, schema)
