"""Finding records that hold too many rows for one task, and cutting them into time slices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import durable, estimated_bytes

# Slices per hot record come in these sizes; the search for a row's slice goes
# over every STEP-th bound first. A record has at most 1 / fraction thresholds of rows,
# so the last size suffices for any record.
TIERS = (8, 64, 512, 4096, 32_768, 131_072)
STEP = 64


@dataclass(frozen=True)
class Skew:
    """When a record counts as hot.

    It is hot above ``max(target_rows, total * fraction)`` rows, so there are at
    most ``1 / fraction`` hot records, with ``16 / fraction`` slice bounds in
    all: a table that is safe to broadcast. Inputs below ``min_bytes`` are not
    counted, as no record in them can be too large.
    """

    target_rows: int = 5_000_000
    fraction: float = 1e-5
    min_bytes: int = 256 << 20

    def __post_init__(self) -> None:
        if not 1 / TIERS[-1] <= self.fraction <= 1:
            raise ValueError(f"fraction must lie between 1 / {TIERS[-1]} and 1, as it bounds the slices")
        if self.target_rows < 1:
            raise ValueError("target_rows must be positive")

    def applies(self, *frames: DataFrame) -> bool:
        return sum(estimated_bytes(f) for f in frames) >= self.min_bytes


def hot_groups(rows: DataFrame, keys: list[str], skew: Skew) -> tuple[DataFrame, int] | None:
    """Key combinations above the threshold with their row count ``n``, and the threshold.

    One aggregation over the key columns, counted before the shuffle; only the
    large groups are written out.
    """
    total = Observation()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).observe(total, F.sum("n").alias("rows"))
    large = durable(counts.where(F.col("n") > skew.target_rows), "hot")
    threshold = max(skew.target_rows, int((total.get["rows"] or 0) * skew.fraction))
    hot = large.where(F.col("n") > threshold)
    return None if hot.isEmpty() else (hot, threshold)


def hot_slices(rows: DataFrame, key: str, time: str, skew: Skew) -> DataFrame | None:
    """Hot keys with ``bounds``: times that cut their rows into near-equal slices of threshold size."""
    rows = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    found = hot_groups(rows, [key], skew)
    if found is None:
        return None
    hot, threshold = found
    tier = F.lit(TIERS[-1])
    for slices in reversed(TIERS[:-1]):
        tier = F.when(F.col("n") <= threshold * slices, slices).otherwise(tier)
    tiered = hot.select(key, tier.alias("tier"))
    parts = []
    for (slices,) in tiered.select("tier").distinct().collect():
        shares = [i / slices for i in range(1, slices)]
        bounds = F.percentile_approx(time, shares, max(1_000, 20 * slices))
        members = F.broadcast(tiered.where(F.col("tier") == slices).select(key))
        parts.append(rows.join(members, key).groupBy(key).agg(F.array_distinct(bounds).alias("bounds")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    coarse = F.filter("bounds", lambda _, i: i % STEP == 0)
    return durable(every.withColumn("coarse", coarse), "slices")


def slice_number(time: Column) -> Column:
    """How many of a row's ``bounds`` are at or before its time."""
    block = F.size(F.filter("coarse", lambda b: b <= time))
    near = F.slice("bounds", (block - 1) * STEP + 1, STEP)
    return F.when(block == 0, 0).otherwise((block - 1) * STEP + F.size(F.filter(near, lambda b: b <= time)))
