"""Filling containers of fixed capacity with documents (problem 7).

Hierarchical packing at several context sizes: a container of the capacity is one window of that size, or 2, 4 or 8 windows
of a half, a quarter or an eighth of it. Documents are routed to the smallest context size that holds them. The tiers are
packed from the longest down; what is left open in windows of longer tiers is filled from the shorter ones, and the rest of
a tier opens windows of its own size. Containers are dealt out to training steps so that every step has its share of each
context size and nearly equal tokens. All this is decided on the histogram of lengths, which is as small for any number of
documents; the plan is a table, which documents are joined with by their rank among documents of equal length.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

#: Context sizes at most, each half the one before, and the share of containers by which more of them may cost more space.
CONTEXTS, CONTEXT_COST = 4, 0.002
#: Containers of one step of training.
STEP_CONTAINERS = 64
#: Units a capacity is planned in. Lengths are planned exactly up to this capacity, rounded up to units beyond it.
UNITS = 65_536
#: Ranks of one block of the plan's key, and rows of a plan that is broadcast; a larger one is joined by shuffle.
BLOCK_RANKS, BROADCAST_ROWS = 256, 400_000


def route(size: int, capacity: int, contexts: int) -> int:
    """Tier of a length: 0 for the whole capacity, 1 for half of it, and so on; the last one takes all shorter lengths."""
    return min(contexts - 1, max(0, (capacity // size).bit_length() - 1))


class Windows:
    """Groups of equal windows by free space: ``(how many, {size: items in each}, context size's tier)``."""

    def __init__(self) -> None:
        self.groups: dict[int, list[tuple[int, dict[int, int], int]]] = defaultdict(list)
        self.order: list[int] = []  # free spaces in use, ascending

    def add(self, free: int, count: int, pattern: dict[int, int], tier: int) -> None:
        if free not in self.groups:
            bisect.insort(self.order, free)
        self.groups[free].append((count, pattern, tier))

    def fill(self, size: int, left: int) -> int:
        """Puts items into the gaps they fill best, whole groups of windows at a time; returns how many found none."""
        while left:
            at = bisect.bisect_left(self.order, size)
            if at == len(self.order):
                break
            free = self.order[at]
            count, pattern, tier = self.groups[free].pop()
            if not self.groups[free]:
                del self.groups[free], self.order[at]
            each = min(free // size, left)
            take = min(count, left // each)
            if take < count:
                self.add(free, count - take, pattern, tier)
            self.add(free - each * size, take, pattern | {size: pattern.get(size, 0) + each}, tier)
            left -= take * each
        return left


def pack_tiers(histogram: dict[int, int], capacity: int, contexts: int) -> tuple[int, list[tuple[int, int, int, dict[int, int]]]]:
    """Containers, and ``(tier, free space, windows, {size: items in each})`` of groups of equal windows."""
    tiers: dict[int, list[int]] = defaultdict(list)
    for size in sorted(histogram, reverse=True):
        tiers[route(size, capacity, contexts)].append(size)
    w = Windows()
    for tier in sorted(tiers):
        context = capacity >> tier
        for size in tiers[tier]:
            left = w.fill(size, histogram[size])
            each = context // size
            if left // each:
                w.add(context - each * size, left // each, {size: each}, tier)
            if left % each:
                w.add(context - left % each * size, 1, {size: left % each}, tier)
    groups = sorted((tier, free, count, pattern) for free, some in w.groups.items() for count, pattern, tier in some for pattern in [tuple(sorted(pattern.items()))])
    opened: dict[int, int] = defaultdict(int)
    for tier, _, count, _ in groups:
        opened[tier] += count
    return sum(-(-n >> tier) for tier, n in opened.items()), [(tier, free, count, dict(pattern)) for tier, free, count, pattern in groups]


def plan(histogram: dict[int, int], capacity: int) -> tuple[int, list[tuple[int, int, int, dict[int, int]]]]:
    """The same with as many context sizes as cost hardly any space: short windows need short documents to fill them."""
    tried = [pack_tiers(histogram, capacity, n) for n in range(CONTEXTS, 0, -1) if capacity >> (n - 1)]
    least = min(n for n, _ in tried)
    return next(t for t in tried if t[0] <= least * (1 + CONTEXT_COST))


def plan_rows(pack: int, histogram: dict[int, int], capacity: int, units: int) -> list[tuple[int, ...]]:
    """Rows ``(pack_id, unit, lo, hi, first, each, tier, context, base, steps)``: the items of a length with ranks from ``lo``
    to before ``hi`` go, ``each`` at a time, to the windows from ``first`` on of a tier whose containers begin at ``base``."""
    containers, groups = plan(histogram, units)
    steps = max(1, -(-containers // STEP_CONTAINERS))
    rows, placed, first, base = [], defaultdict(int), 0, 0
    for i, (tier, _, count, pattern) in enumerate(groups):
        if i and groups[i - 1][0] != tier:  # a tier's windows fill containers of their own
            base += -(-first >> groups[i - 1][0])
            first = 0
        for size, each in pattern.items():
            rows.append((pack, size, placed[size], placed[size] + count * each, first, each, tier, capacity >> tier, base, steps))
            placed[size] += count * each
        first += count
    return rows


def quantum(capacity: int) -> int:
    """Tokens of one unit."""
    return -(-capacity // UNITS)


def _items(capacities: list[tuple[int, int, int]]):
    """Pieces of every document for every capacity, numbered within equal lengths, in units, of this task's partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for pack, cap, q in capacities:
                    for piece, size in enumerate([cap] * (n // cap) + [n % cap] * (n % cap > 0)):
                        unit = min(-(-size // q), cap // q)
                        k = seen.get((pack, unit), 0)
                        seen[pack, unit] = k + 1
                        for c, v in zip(cols, (pack, doc, piece, size, unit, part, k), strict=True):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["pack_id", "doc_id", "piece", "n_tokens", "unit", "part", "k"])

    return run


_PLAN = ("pack_id", "unit", "lo", "hi", "first", "each", "tier", "context", "base", "steps")


def pack(counted: DataFrame, doc: str, tokens: str, sizes: DataFrame) -> DataFrame:
    """``(pack_id, container, window, context, doc_id, piece, n_tokens, step)``: the place of every document for every capacity.

    ``window`` numbers the windows of a container, each of ``context`` tokens. A text longer than the capacity is cut into
    pieces of the capacity and a remainder; no other text is split. Rows without tokens, or with a null id, take no place.
    A repeated id is placed once for each of its rows. Of a pack listed twice the larger capacity holds; capacities that are
    null or below 1 are left out.

    The plan has a few rows for each length there is, so at most for each unit of the capacities, however many documents.
    Rows of the plan and of the documents meet by blocks of ranks, so a length that a third of the documents have is no hot key.
    """
    spark = counted.sparkSession
    caps = {r[0]: r[1] for r in sizes.where("pack_id is not null and capacity_tokens > 0").groupBy("pack_id").agg(F.max("capacity_tokens")).collect()}
    slim = counted.select(F.col(doc).cast("long").alias("doc_id"), F.col(tokens).cast("long").alias("n")).where("doc_id is not null and n > 0")
    items = materialize(slim.mapInArrow(_items([(p, c, quantum(c)) for p, c in sorted(caps.items())]), "pack_id long, doc_id long, piece long, n_tokens long, unit long, part long, k long"), "items")
    counts = items.groupBy("pack_id", "unit", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("pack_id", "unit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))), "offsets")
    histograms: dict[int, dict[int, int]] = {p: {} for p in caps}
    for r in offsets.groupBy("pack_id", "unit").agg(F.sum("n").alias("n")).collect():
        histograms[r["pack_id"]][r["unit"]] = r["n"]
    rows = [row for p, h in histograms.items() if h for row in plan_rows(p, h, caps[p], caps[p] // quantum(caps[p]))]
    planned = spark.createDataFrame(pd.DataFrame(rows, columns=_PLAN, dtype="int64"), ", ".join(f"{c} long" for c in _PLAN))
    planned = planned.withColumn("block", F.explode(F.sequence(F.expr(f"lo div {BLOCK_RANKS}"), F.expr(f"(hi - 1) div {BLOCK_RANKS}"))))
    ranked = items.join(offsets.drop("n"), ["pack_id", "unit", "part"]).withColumn("rank", F.col("offset") + F.col("k")).withColumn("block", F.expr(f"rank div {BLOCK_RANKS}"))
    few = len(rows) + sum(n for h in histograms.values() for n in h.values()) // BLOCK_RANKS <= BROADCAST_ROWS
    at = ranked.join(F.broadcast(planned) if few else planned, ["pack_id", "unit", "block"]).where("rank >= lo and rank < hi").withColumn("slot", F.expr("first + (rank - lo) div each"))
    at = at.withColumn("container", F.expr("base + shiftright(slot, int(tier))")).withColumn("window", F.expr("slot - shiftleft(shiftright(slot, int(tier)), int(tier))"))
    # containers are in order of context size and fullness; they are dealt out forth and back
    turn, seat = F.expr("container div steps"), F.expr("container % steps")
    step = F.when(turn % 2 == 0, seat).otherwise(F.col("steps") - 1 - seat)
    return at.select("pack_id", "container", "window", "context", "doc_id", "piece", "n_tokens", step.alias("step"))
