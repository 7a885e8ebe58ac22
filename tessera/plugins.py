"""Filter plugins: a predicate with a name, a version and an identity that enters the configuration."""

from __future__ import annotations

from importlib import metadata
from typing import Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUP = "tessera.filters"


@runtime_checkable
class Plugin(Protocol):
    """A filter over one text. ``column`` is preferred: Catalyst sees through it. Else ``check`` is run on Arrow batches."""

    name: str
    version: str

    def identity(self) -> dict: ...


class ColumnPlugin:
    """A plugin whose reason is an expression of the text column (null keeps the text)."""

    def __init__(self, name: str, version: str, expression, **parameters):
        self.name, self.version, self._expression, self._parameters = name, version, expression, parameters

    def identity(self) -> dict:
        return {"name": self.name, "version": self.version, **self._parameters}

    def column(self, text: Column) -> Column:
        return self._expression(text)


class TextPlugin:
    """A plugin that looks at one text at a time and returns a reason or None."""

    def __init__(self, name: str, version: str, check, **parameters):
        self.name, self.version, self.check, self._parameters = name, version, check, parameters

    def identity(self) -> dict:
        return {"name": self.name, "version": self.version, **self._parameters}


def min_words(n: int) -> ColumnPlugin:
    """Drops texts of fewer than n words between white space."""
    return ColumnPlugin("min_words", "1", lambda text: F.when(F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")) < n, F.lit(f"fewer than {n} words")), min_words=n)


def available() -> dict:
    """Installed plugins by name."""
    return {e.name: e for e in metadata.entry_points(group=GROUP)}


def load(names: list[str]) -> list[Plugin]:
    """The named plugins in order; a missing, incomplete or misnamed one raises."""
    known, out = available(), []
    for name in names:
        if name not in known:
            raise ValueError(f"no such plugin: {name}; installed: {', '.join(sorted(known)) or 'none'}")
        plugin = known[name].load()
        plugin = plugin() if isinstance(plugin, type) else plugin
        if not isinstance(plugin, Plugin) or not (hasattr(plugin, "column") or callable(getattr(plugin, "check", None))):
            raise ValueError(f"plugin {name} lacks a part of the contract")
        if plugin.name != name:
            raise ValueError(f"plugin {name} calls itself {plugin.name}")
        out.append(plugin)
    return out


def identities(plugins: list[Plugin]) -> list[dict]:
    """Identities in the given order, which matters: the first hit wins."""
    return [p.identity() for p in plugins]


def apply_plugins(df: DataFrame, text: str, plugins: list[Plugin], into: str) -> DataFrame:
    """``into``: ``plugin:<name>`` of the first plugin that gives a reason, else null; null texts are not shown to plugins."""
    reasons = []
    for p in plugins:
        if hasattr(p, "column"):
            reason = p.column(F.col(text))
        else:
            check = p.check

            @F.pandas_udf(T.StringType())
            def run(texts, check=check):
                return texts.map(lambda t: None if t is None else check(t))

            reason = run(F.col(text))
        reasons.append(F.when(F.col(text).isNotNull() & reason.isNotNull(), F.lit(f"plugin:{p.name}")))
    return df.withColumn(into, F.coalesce(*reasons) if reasons else F.lit(None).cast("string"))
