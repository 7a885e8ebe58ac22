"""Language by script, as Catalyst expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.binding import let

# Scripts in the order in which ties are decided, and the languages they are written in.
PROBE_CHARS = 2000
SCRIPT_CLASSES = {
    "deva": r"\u0900-\u097F",
    "beng": r"\u0980-\u09FF",
    "guru": r"\u0A00-\u0A7F",
    "gujr": r"\u0A80-\u0AFF",
    "orya": r"\u0B00-\u0B7F",
    "taml": r"\u0B80-\u0BFF",
    "telu": r"\u0C00-\u0C7F",
    "knda": r"\u0C80-\u0CFF",
    "mlym": r"\u0D00-\u0D7F",
    "arab": r"\u0600-\u06FF\u0750-\u077F",
    "latn": "A-Za-z",
}
ONE_LANGUAGE = {"guru": "pan", "gujr": "guj", "orya": "ori", "taml": "tam", "telu": "tel", "knda": "kan", "mlym": "mal", "arab": "urd", "latn": "eng"}
SHARED = {"deva": ("hin", "mar", "nep", "san"), "beng": ("ben", "asm")}
ISO_CODES = {
    "hi": "hin", "ne": "nep", "bn": "ben", "ta": "tam", "en": "eng", "te": "tel", "ml": "mal", "mr": "mar", "gu": "guj",
    "ur": "urd", "sa": "san", "kn": "kan", "or": "ori", "pa": "pan", "as": "asm", "bh": "bho", "mai": "mai", "bpy": "bpy",
    "gom": "gom", "sd": "snd",
}


def script_counts(text: Column, probe: int | None = None) -> Column:
    """Characters of each script in the text, or in its first ``probe`` characters, as a map in order."""
    count = lambda part, cls: F.length(F.regexp_replace(part, f"[^{cls}]+", ""))
    return let(text if probe is None else F.substring(text, 1, probe), lambda part: F.create_map(*[x for name, cls in SCRIPT_CLASSES.items() for x in (F.lit(name), count(part, cls))]))


def dominant(counts: Column) -> Column:
    """``struct(script, share)`` from the counts: the commonest script, the earlier of equal ones; none for no script."""

    def of(m: Column) -> Column:
        best = F.array_max(F.map_values(m))
        total = F.aggregate(F.map_values(m), F.lit(0), lambda a, x: a + x)
        name = F.element_at(F.map_keys(m), F.array_position(F.map_values(m), best).cast("int"))
        return F.when(total > 0, F.struct(name.alias("script"), (best / total).alias("share"))).otherwise(F.struct(F.lit(None).cast("string").alias("script"), F.lit(0.0).alias("share")))

    return let(counts, of)  # the counts are made once


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key)


def language_of(script: Column) -> Column:
    """The language of a script that only one is written in, else null."""
    return _lookup(ONE_LANGUAGE, script)


def shard_code(iso: Column) -> Column:
    """The three-letter code of a two-letter one; unknown codes as they are."""
    return F.coalesce(_lookup(ISO_CODES, iso), iso)


def consistent(script: Column, language: Column) -> Column:
    """Whether a text in this script can be in the language that its shard declares; false where nothing is known."""
    shared = F.create_map(*[x for k, v in SHARED.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.coalesce(F.when(language_of(script).isNotNull(), language_of(script) == language).otherwise(F.array_contains(F.try_element_at(shared, script), language)), F.lit(False))


def effective_language(script: Column, language: Column) -> Column:
    """The identified language, else the declared one where it is consistent, else null."""
    return F.coalesce(language_of(script), F.when(consistent(script, language), language))


def load_model(path: str):
    """A language identification model of the optional library; raises where it or the file is missing."""
    import fasttext

    return fasttext.load_model(path)


_LOADED: dict[str, object] = {}


def method_of(path: str | None, load=load_model) -> str:
    """``model`` if the model can be loaded, else ``script``: recorded with every result, since the fallback is silent."""
    if not path:
        return "script"
    try:
        load(path)
    except Exception:  # noqa: BLE001  whatever is wrong, scripts still tell
        return "script"
    return "model"


def model_language(text: Column, path: str, chars: int | None = None, load=load_model) -> Column:
    """``struct(language, confidence)`` of the model's best label for the text in one line, or for its first ``chars``
    characters; codes are those of shards, unknown ones as the model gives them. One model a worker; null stays null."""

    @F.pandas_udf(T.StructType([T.StructField("language", T.StringType()), T.StructField("confidence", T.DoubleType())]))
    def identify(texts: pd.Series) -> pd.DataFrame:
        if path not in _LOADED:
            _LOADED[path] = load(path)
        rows = []
        for t in texts:
            if t is None or not t.strip():
                rows.append((None, None))
                continue
            labels, shares = _LOADED[path].predict(" ".join(t.split())[:chars])
            code = labels[0].removeprefix("__label__")
            rows.append((ISO_CODES.get(code, code), float(shares[0])))
        return pd.DataFrame(rows, columns=["language", "confidence"])

    return identify(text)
