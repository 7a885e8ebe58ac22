"""Text of HTML pages without a parser: blocks, comments and tags go, entities are decoded once."""

from __future__ import annotations

import importlib.util
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What is removed, and the entities that are decoded by name.
BLOCKS = r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>"
COMMENTS = r"(?s)<!--.*?-->"
TAGS = r"(?s)<[^>]+>"
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}
MIN_CHARS = 80
_ENTITY = re.compile(r"&(#\d+|#[xX][0-9a-fA-F]+|[a-zA-Z]+);")


def _decode(m: re.Match) -> str:
    body = m.group(1)
    if body[0] != "#":
        return NAMED.get(body.lower(), m.group())
    try:
        return chr(int(body[2:], 16) if body[1] in "xX" else int(body[1:]))
    except (ValueError, OverflowError):
        return m.group()


@F.pandas_udf(T.StringType())
def _entities(texts):
    return texts.map(lambda t: None if t is None else _ENTITY.sub(_decode, t))


def strip_tags(html: Column) -> Column:
    """Readable text of a page: tags become blanks, runs of blanks one, and blank lines are dropped.

    Only pages that hold an entity reach Python, since numeric ones cannot be decoded inside the JVM.
    """
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, BLOCKS, " "), COMMENTS, " "), TAGS, " ")
    decoded = F.when(bare.rlike(r"&(?:#\d+|#[xX][0-9a-fA-F]+|[a-zA-Z]+);"), _entities(bare)).otherwise(bare)
    spaced = F.regexp_replace(decoded, r"[ \t\u00a0]+", " ")
    lines = F.filter(F.transform(F.split(spaced, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(lines, "\n")


def main_content(html: Column) -> Column:
    """Main text of a page by the optional extraction library; null where it finds none."""

    @F.pandas_udf(T.StringType())
    def run(pages: pd.Series) -> pd.Series:
        import trafilatura

        return pages.map(lambda p: None if p is None else trafilatura.extract(p))

    return run(html)


def extract(df, html: str, min_chars: int = MIN_CHARS, library=None):
    """Rows with their ``text`` and ``extractor``; pages with less than ``min_chars`` characters are left out. Main content by
    the optional library, if it is installed (or by ``library``, a function of the column), else by stripping tags."""
    bare = strip_tags(F.col(html))
    if library is None and importlib.util.find_spec("trafilatura") is not None:
        library = main_content
    found = library(F.col(html)) if library else F.lit(None).cast("string")
    out = df.withColumn("_main", found).withColumn("extractor", F.when(F.col("_main").isNotNull(), F.lit("main_content")).otherwise(F.lit("strip_tags")))
    out = out.withColumn("text", F.regexp_replace(F.coalesce("_main", bare), "\n{2,}", "\n")).drop("_main")
    return out.where(F.length("text") >= min_chars)
