"""Text that was decoded with the wrong character encoding (problem 9).

For every character of a repertoire and every wrong decoder of UTF-8 the garbled sequence is computed beforehand. One
Aho-Corasick automaton finds all of them in a text; only the matched spans are replaced. Of pairs of single-byte code pages,
where each character became one other, the garbled alphabets are computed: whole words of them are read back.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Decoders that UTF-8 text is commonly read with by mistake.
CODECS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "koi8-r", "cp866", "cp1250", "cp1254", "iso8859-15")
# Blocks of characters that are looked for (first, last).
BLOCKS = (
    (0x00A0, 0x00FF), (0x0600, 0x06FF), (0x0900, 0x097F), (0x0980, 0x09FF), (0x0A00, 0x0A7F), (0x0A80, 0x0AFF), (0x0B00, 0x0B7F), (0x0B80, 0x0BFF),
    (0x0C00, 0x0C7F), (0x0C80, 0x0CFF), (0x0D00, 0x0D7F), (0x0D80, 0x0DFF), (0x0E00, 0x0E7F), (0x200B, 0x200F), (0x2010, 0x2026), (0x2030, 0x203A), (0x20A8, 0x20BF), (0x2122, 0x2122),
    (0x2190, 0x2193), (0x2212, 0x2212), (0x2260, 0x2265), (0xFEFF, 0xFEFF), (0xFF10, 0xFF19), (0xFFFD, 0xFFFD),
)
#: Blocks of which a garbled character is two common signs: they count only where WEAK_LEAST of them are in a text.
WEAK_BLOCKS = ((0x0100, 0x017F), (0x0386, 0x03CE), (0x0401, 0x0491))
WEAK_LEAST = 3
#: Pictures beyond the basic plane, four bytes each.
PICTURES = ((0x1F300, 0x1F64F), (0x1F680, 0x1F6FF), (0x1F900, 0x1F9FF))
# Code pages of one byte a character by what they are read as by mistake, with the letters they hold and the commonest of these.
SINGLE = {
    ("cp1251", "koi8-r", "iso8859-5", "mac_cyrillic", "cp866"): ("абвгдежзийклмнопрстуфхцчшщъыьэюя", "оеаинтсрвл"),
    ("cp1253", "iso8859-7"): ("αβγδεζηθικλμνξοπρσςτυφχψωάέήίόύώ", "αοιετσνηυρ"),
}
SINGLE_READ_AS = ("cp1252", "latin-1")
#: Letters of a garbled word at least, and of all garbled words of a text.
SINGLE_WORD, SINGLE_ALL = 4, 8
LOST = "�"
_RANK = {c: i for i, c in enumerate([*CODECS, *(c + "*2" for c in CODECS)])}


def _is_weak(char: str) -> bool:
    return any(a <= ord(char) <= b for a, b in WEAK_BLOCKS)


def _decode(data: bytes, codec: str) -> str:
    """As lenient programs decode: bytes a code page leaves undefined become the control character of the same number."""
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@lru_cache(1)
def patterns() -> dict[str, tuple[tuple[str, str], ...]]:
    """Garbled sequence to its ``(codec, original)`` readings; twice garbled sequences have codecs such as ``cp1252*2``.

    An original of U+FFFD stands for a character of which bytes were lost.
    """
    found: dict[str, dict[str, str]] = {}

    def add(seq: str, codec: str, char: str) -> None:
        if len(seq) > 1 and not seq.isascii():
            found.setdefault(seq, {}).setdefault(codec, char)

    for first, last in (*BLOCKS, *WEAK_BLOCKS, *PICTURES):
        for code in range(first, last + 1):
            char = chr(code)
            data = char.encode()
            for codec in CODECS:
                once = _decode(data, codec)
                if _is_weak(char) and not all(ord(c) >= 0x80 for c in once):
                    continue
                add(once, codec, char)
                if codec in ("cp1252", "latin-1", "mac_roman", "cp437"):
                    add(_decode(once.encode(), codec), codec + "*2", char)
                if len(data) == 3:
                    for cut in (1, 2):  # a byte that the wrong decoder had no character for, shown as lost or left out
                        add(_decode(data[:cut], codec) + LOST + _decode(data[cut + 1 :], codec), codec, LOST)
                    add(_decode(data[:2], codec) + LOST, codec, LOST)
                    if codec == "latin-1" and all(0x80 <= b < 0xA0 for b in data[1:]):
                        add(_decode(data[:1] + data[2:], codec), codec, char)  # a control character was removed as invisible
                    if (first >= 0x0900 and last < 0x1000) or (0x2000 <= first < 0x2100 and codec in ("cp1252", "mac_roman", "cp437")):
                        add(_decode(data[:2], codec), codec, LOST)
    return {k: tuple(v.items()) for k, v in found.items()}


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    """The matcher over all garbled sequences."""
    a = ahocorasick.Automaton()
    for seq, readings in patterns().items():
        a.add_word(seq, (len(seq), readings))
    a.make_automaton()
    return a


@lru_cache(1)
def _alphabets() -> list[tuple[str, dict[int, str], str]]:
    """``(pair, garbled letter to letter, commonest letters)`` of all pairs of single-byte code pages."""
    out = []
    for pages, (letters, common) in SINGLE.items():
        for true in pages:
            for read in SINGLE_READ_AS:
                table = {}
                for c in letters + letters.upper():
                    try:
                        table[ord(c.encode(true).decode(read))] = c
                    except (UnicodeEncodeError, UnicodeDecodeError):
                        continue
                out.append((f"{true}>{read}", table, common))
    return out


@lru_cache(1)
def _single_class() -> str:
    """Regex class of all garbled letters of single-byte pairs."""
    return "[" + "".join(f"\\x{{{c:x}}}" for c in sorted({c for _, table, _ in _alphabets() for c in table if c >= 0x80})) + "]"


@lru_cache(1)
def _single_words() -> re.Pattern:
    cls = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m.group(1), 16))), _single_class())
    return re.compile(rf"(?<!\w){cls}{{{SINGLE_WORD},}}(?!\w)")


def restore_single(text: str) -> tuple[str, int, str | None]:
    """The text with words of one garbled alphabet read back, how many there were, and the pair. No language writes words of
    four and more such letters alone; of the pairs that can read all of them, the one whose letters are commonest in the
    language, and whose words are not capitalised inside, is taken."""
    words = _single_words().findall(text)
    if sum(map(len, words)) < SINGLE_ALL:
        return text, 0, None
    best = (0.0, "", {})
    for pair, table, common in _alphabets():
        read = [w.translate(table) for w in words if all(ord(c) in table for c in w)]
        if len(read) < len(words):
            continue
        letters = "".join(read)
        plain = sum(w[1:].islower() or w.isupper() for w in read) / len(read)
        score = plain * sum(c in common for c in letters.lower()) / len(letters)
        if score > best[0]:
            best = (score, pair, table)
    if best[0] < 0.45:
        return text, 0, None
    return _single_words().sub(lambda m: m.group().translate(best[2]), text), len(words), best[1]


@lru_cache(1)
def _triggers() -> tuple[re.Pattern, re.Pattern]:
    """A character that a garbled sequence starts with, and letters in a row that single-byte pairs leave. Each begins with one
    class, which is searched for by table."""
    firsts = {seq[0] for seq in patterns()} | {LOST}
    cls = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m.group(1), 16))), _single_class())
    return re.compile("[" + "".join(re.escape(c) for c in sorted(firsts)) + "]"), re.compile(cls * SINGLE_WORD)


def suspicious(text: str) -> bool:
    """Whether a text can hold garbled sequences or words at all: most cannot."""
    return not text.isascii() and any(p.search(text) for p in _triggers())


def restore(text: str | None) -> tuple[str | None, int, int, str | None]:
    """``(text, spans, lost, codec)``: the text with garbled spans replaced, how many there were, how many characters
    could not be restored, and the commonest wrong decoder. Text without garbled spans comes back unchanged.

    Readings of several decoders are weighed by how much of the text each explains; longer matches win over shorter.
    """
    if not text or not suspicious(text):
        return text, 0, 0, None
    matches = [(end - n + 1, end + 1, readings) for end, (n, readings) in automaton().iter(text)]
    weak = [all(_is_weak(char) for _, char in m[2]) for m in matches]
    if any(weak) and sum(weak) < WEAK_LEAST:
        matches = [m for m, w in zip(matches, weak, strict=True) if not w]
    alone = text.count(LOST)
    # whole words of a garbled alphabet tell more than the few pairs of signs in them that other garbling could leave
    if sum(map(len, _single_words().findall(text))) > 1.5 * sum(b - a for a, b, _ in matches):
        fixed, n, pair = restore_single(text)
        if n:
            return fixed, alone + n, alone, pair
    if not matches:
        return text, alone, alone, None
    weight: Counter = Counter()
    for a, b, readings in matches:
        for codec, char in readings:
            if char != LOST:
                weight[codec] += b - a
    # longest first at each place, left to right
    matches.sort(key=lambda m: (m[0], -m[1]))
    best: dict[int, tuple[int, tuple]] = {}
    for a, b, readings in matches:
        best.setdefault(a, (b, readings))
    out, at, spans, lost, used = [], 0, 0, 0, Counter()
    for a in sorted(best):
        if a < at:
            continue
        b, readings = best[a]
        codec, char = max(readings, key=lambda r: (weight[r[0]], -_RANK[r[0]]))
        out.append(text[at:a])
        out.append(char)
        at = b
        spans += 1
        lost += char == LOST
        used[codec] += 1
    out.append(text[at:])
    fixed = "".join(out)
    left = fixed.count(LOST) - lost
    return fixed, spans + left, lost + left, used.most_common(1)[0][0]


def _restore_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, rows = [], []
        for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            r = restore(text)
            if r[1]:
                ids.append(i)
                rows.append(r)
        keep = batch.take(pa.array(ids, pa.int64())) if ids else batch.slice(0, 0)
        cols = [keep.column(i) for i in range(batch.num_columns - 1)]
        cols += [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string())]
        names = [batch.schema.names[i] for i in range(batch.num_columns - 1)] + ["restored", "spans", "lost", "decoder"]
        yield pa.RecordBatch.from_arrays(cols, names)


def restore_garbled(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, restored, spans, lost, decoder)`` for every row whose text holds garbled spans.

    Null and empty texts are never affected; repeated keys give repeated rows; other columns are ignored. Texts are
    processed whole, and most are set aside by a search for the characters that garbled sequences start with. That search is
    made in the worker: a table look-up there, it took ten times as long as a pattern inside the JVM.
    """
    slim = df.select(F.col(key).alias(key), F.col(text).alias("_text"))
    schema = f"{key} {dict(df.dtypes)[key]}, restored string, spans long, lost long, decoder string"
    return slim.where("_text is not null").mapInArrow(_restore_batches, schema)
