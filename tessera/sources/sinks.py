"""Writing: text shards, logs, identities, models, and small receipts with a completion rule."""

from __future__ import annotations

import hashlib
import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_shards(docs: DataFrame, path: str, shard: str = "shard_id", order: str = "doc_index", text: str = "text", redacted: str | None = None) -> None:
    """Kept documents, parted by blank lines, in files by shard in document order.

    A shard is written in as many files as ``spark.sql.files.maxRecordsPerFile`` says; ranges of (shard, order) keep the
    order without putting a large shard into one task. ``redacted`` replaces the text where it is not null.
    """
    body = F.coalesce(F.col(redacted), F.col(text)) if redacted else F.col(text)
    out = docs.select(F.col(shard).alias("shard_id"), F.col(order).alias("_o"), body.alias("value")).where("value is not null")
    out.repartitionByRange("shard_id", "_o").sortWithinPartitions("shard_id", "_o").select("shard_id", "value").write.partitionBy("shard_id").option("lineSep", "\n\n").text(path)


def json_lines(df: DataFrame, path: str) -> None:
    """Drop logs, evaluation sets and statistics as JSON lines."""
    df.write.json(path)


def identities(docs: DataFrame, path: str, shard: str = "shard_id") -> None:
    """Document ids, duplicates included, by shard."""
    docs.select(shard, "doc_hash").write.partitionBy(shard).parquet(path)


def signatures(signed: DataFrame, path: str, shard: str = "shard_id") -> None:
    """Signatures by shard; documents without one have null."""
    signed.write.partitionBy(shard).parquet(path)


def model(trigram: DataFrame, unigram: DataFrame, path: str) -> None:
    """Both tables of the language models, by language."""
    trigram.write.partitionBy("lang").parquet(f"{path}/trigram")
    unigram.write.partitionBy("lang").parquet(f"{path}/unigram")


def drop_list(ids: DataFrame, path: str) -> None:
    """The drop list in ascending order."""
    ids.select("doc_hash").distinct().orderBy("doc_hash").write.parquet(path)


def manifest(path: str, content: dict) -> str:
    """A receipt whose presence means that it is complete: written beside, synced, renamed. Returns its SHA-256."""
    data = json.dumps(content, indent=1, sort_keys=True, ensure_ascii=False).encode()
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    with tempfile.NamedTemporaryFile("wb", dir=folder, delete=False) as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f.name, path)
    return hashlib.sha256(data).hexdigest()


def file_sha256(path: str) -> str:
    """SHA-256 of one small file, such as a registry."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


class EventLog:
    """Events appended to ``events.jsonl``; a log that cannot be written never stops a run."""

    def __init__(self, folder: str | None):
        self.path = os.path.join(folder, "events.jsonl") if folder else None

    def emit(self, kind: str, **fields) -> None:
        if self.path:
            try:
                with open(self.path, "a", encoding="utf-8") as f:
                    f.write(json.dumps({"ts": time.time(), "kind": kind, **fields}) + "\n")
            except OSError:
                pass

    def tail(self, n: int = 400) -> list[dict]:
        """The last n whole events."""
        if not self.path or not os.path.isfile(self.path):
            return []
        out = []
        with open(self.path, encoding="utf-8") as f:
            for line in f.readlines()[-n:]:
                try:
                    out.append(json.loads(line))
                except ValueError:
                    continue
        return out

    def running(self, within: float = 30.0) -> bool:
        """Whether the last event is recent and no finish."""
        last = self.tail(1)
        return bool(last) and last[0]["kind"] != "finish" and time.time() - last[0]["ts"] < within


class Reporter:
    """Progress for people on a stream, a line a phase, mirrored to the event log. Spark's own pages tell about tasks."""

    def __init__(self, log: EventLog, stream=sys.stderr):
        self.log, self.stream, self.began, self.name = log, stream, time.time(), None

    def _say(self, event: str, line: str, **fields) -> None:
        print(f"[{time.time() - self.began:7.1f} s] {line}", file=self.stream, flush=True)
        self.log.emit(event, **fields)

    def phase(self, name: str) -> None:
        self.name = name
        self._say("phase", name, name=name)

    def update(self, done: int, total: int | None = None) -> None:
        self._say("update", f"{self.name}: {done:,}" + (f" of {total:,}" if total else ""), name=self.name, done=done, total=total)

    def info(self, text: str) -> None:
        self._say("info", text, text=text)

    def warn(self, text: str) -> None:
        self._say("warn", f"warning: {text}", text=text)

    def error(self, text: str) -> None:
        self._say("error", f"error: {text}", text=text)

    def finish(self) -> None:
        self._say("finish", "done", seconds=round(time.time() - self.began, 1))
