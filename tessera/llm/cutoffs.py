"""Score cutoffs that keep a target fraction of each source (problem 4).

The cutoff is an order statistic, found as the minimiser of the convex pinball loss of each source. Every pass
aggregates, for all sources at once, the loss and its subgradient at a few trial points; cutting planes and the
bracket they give choose the next points, and the last bracket is snapped to a score that occurs.
"""

from __future__ import annotations

import math
import struct
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

#: Trial points per source and pass.
POINTS = 12
#: Sources whose brackets the driver holds at once (a few numbers each); more are taken block by block.
MOST_SOURCES = 200_000


def latest_scores(scores: DataFrame, keys: list[str], score: str, at: str, then: list[str]) -> DataFrame:
    """One row per record, its score that of its row with the latest ``at``; records whose latest score is null or NaN are left out.

    Rows that tie on ``at`` are decided by ``then`` and last by the larger score, so the result is the same in any order.
    """
    newest = F.max(F.struct(F.col(at), *[F.col(c) for c in then], F.col(score).alias("score"))).alias("newest")
    return scores.groupBy(*keys).agg(newest).select(*keys, F.col("newest.score").cast("double").alias("score")).where("score is not null and not isnan(score)")


def _order(x: float) -> int:
    bits = struct.unpack("<q", struct.pack("<d", x))[0]
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def _value(i: int) -> float:
    return struct.unpack("<d", struct.pack("<q", i if i >= 0 else -0x8000000000000000 - i))[0] if i >= 0 else -struct.unpack("<d", struct.pack("<q", -i))[0]


def _trials(low: float, high: float, plane_low: tuple[float, float], plane_high: tuple[float, float]) -> list[float]:
    """Points in ``[low, high)``: where the two cutting planes meet, and points that halve the bracket by value and by float order."""
    points = set()
    (a, s), (b, t) = plane_low, plane_high
    if t > s and all(map(math.isfinite, (a, s, b, t))):
        points.add((a - s * low - b + t * high) / (t - s))
    half = (POINTS - 1) // 2
    if math.isfinite(high - low):
        points.update(low + (high - low) * k / (half + 1) for k in range(1, half + 1))
    i, j = _order(low), _order(high)
    points.update(_value(i + (j - i) * k // (half + 1)) for k in range(1, half + 1))
    return sorted(p for p in points if low <= p < high)


def cutoffs(scored: DataFrame, source: str, targets: dict[str, float], points: int = POINTS) -> dict[str, dict]:
    """Per source the smallest score ``c`` with at least the target fraction of its records at or below ``c``.

    ``scored`` has the columns ``source`` and ``score`` and should be a written table, as it is read once a pass.
    A target of 0 or less gives the smallest score, of 1 or more the largest; sources without a score or with a null
    target have no cutoff. The result holds, for each source, its records, its cutoff and the number kept.
    """
    spark = scored.sparkSession
    if len(targets) > MOST_SOURCES:  # block by block
        names, found = sorted(targets, key=str), {}
        for at in range(0, len(names), MOST_SOURCES):
            found |= cutoffs(scored, source, {k: targets[k] for k in names[at : at + MOST_SOURCES]}, points)
        return found
    base = scored.groupBy(source).agg(F.count("score").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"), F.sum("score").alias("total"))
    known = spark.createDataFrame([(k,) for k in targets], f"{source} string")
    state, done = {}, {}
    for r in base.join(F.broadcast(known), source, "left_semi").collect():
        share = targets[r[0]]
        if share is None or math.isnan(share):
            continue
        k = min(r["n"], max(1, math.ceil(Fraction(share) * r["n"])))
        state[r[0]] = {"n": r["n"], "k": k, "low": r["low"], "high": r["high"], "below": 0, "total": r["total"], "kept": r["n"]}
    while state:
        rows = []
        for name, s in state.items():
            n, tau = s["n"], s["k"] / s["n"]
            loss = lambda c, cnt, tot: tau * (s["total"] - tot - (n - cnt) * c) + (1 - tau) * (cnt * c - tot)  # noqa: B023, E731
            at_low = (loss(s["low"], s["below"], s.get("sum_low", 0.0)), s["below"] - s["k"])
            at_high = (loss(s["high"], s["kept"], s.get("sum_high", s["total"])), s["kept"] - s["k"])
            trial = [s["low"], *_trials(s["low"], s["high"], at_low, at_high), s["high"]]
            rows.append((name, sorted(set(trial))))
        trials = spark.createDataFrame(rows, f"{source} string, points array<double>")
        # One pass: a record counts in the first slot whose point is not below it; slots are summed up per source afterwards.
        slot = F.size(F.filter("points", lambda p: p < F.col("score")))
        slots = scored.join(F.broadcast(trials), source).withColumn("slot", slot).groupBy(source, "slot").agg(F.count("score").alias("n"), F.sum("score").alias("total"), F.min("score").alias("least"), F.max("score").alias("most"))
        by: dict[str, dict] = {}
        for r in slots.collect():
            by.setdefault(r[0], {})[r["slot"]] = r
        for name, pts in rows:
            s, seen, total = state[name], 0, 0.0
            for i in range(len(pts) + 1):
                r = by[name].get(i)
                if r is not None:
                    if seen + r["n"] >= s["k"]:  # the cutoff lies in this slot
                        s.update(low=r["least"], high=r["most"], below=seen, kept=seen + r["n"], sum_low=total, sum_high=total + r["total"])
                        if i == 0 or r["least"] == r["most"]:  # slot 0 ends at the bracket's lower end, below which too few lie
                            done[name] = {"n": s["n"], "cutoff": r["most"], "kept": seen + r["n"]}
                        break
                    seen, total = seen + r["n"], total + r["total"]
        state = {k: v for k, v in state.items() if k not in done}
    return done


def keep_fraction(scores: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(report, above)`` for the doc_scores and keep_targets of the corpus.

    The report has a row for each target with the shard's language, the old cutoff, the new one and the numbers of
    scored and kept records (0 and null for a shard without any score). ``above`` has the records above the cutoff.
    A shard listed twice in the targets counts with its larger fraction.
    """
    spark = scores.sparkSession
    goals = targets.where("shard_id is not null").groupBy("shard_id").agg(F.max("target_fraction").alias("target_fraction"), F.max("language").alias("language"), F.max("max_bits_per_char").alias("max_bits_per_char"))
    wanted = {r["shard_id"]: r["target_fraction"] for r in goals.collect()}
    slim = scores.select("shard_id", "doc_index", "bits_per_char", "measured_at", "loaded_at").join(F.broadcast(spark.createDataFrame([(k,) for k in wanted], "shard_id string")), "shard_id", "left_semi")
    scored = materialize(latest_scores(slim, ["shard_id", "doc_index"], "bits_per_char", "measured_at", ["loaded_at"]), "scored")
    found = cutoffs(scored, "shard_id", wanted)
    cuts = spark.createDataFrame([(k, v["cutoff"], v["n"], v["kept"]) for k, v in found.items()], "shard_id string, cutoff double, scored long, kept long")
    report = goals.join(F.broadcast(cuts), "shard_id", "left").select(
        "shard_id", "language", "target_fraction", "max_bits_per_char", "cutoff", F.coalesce("scored", F.lit(0)).alias("scored"), F.coalesce("kept", F.lit(0)).alias("kept")
    )
    above = scored.join(F.broadcast(cuts.select("shard_id", "cutoff")), "shard_id").where("score > cutoff").select("shard_id", "doc_index")
    return report, above
