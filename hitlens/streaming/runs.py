"""All-time totals as levelled runs of folded partials.

A micro-batch adds its partial aggregate as a run of level 0.  As soon as a level has ``fan`` runs of one stream
they are folded into one run of the next level, so a key is rewritten once per level, which is the logarithm of
the number of batches, and a reader folds at most ``fan`` - 1 runs per level.  The manifest names the runs that count: a fold shows
as a whole or not at all, and a batch that is replayed replaces its own run or, if it has been folded already, is left out.

For continuous top lists each run has a summary: its ``listed`` largest counts and a floor, which no other key of
the run exceeds.  Summaries add up: a key has at least the sum of its listed counts, and at most that plus the floors
of the runs that do not list it.  Only keys that can still reach the k-th place are counted exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.refine import bounded_broadcast
from .manifest import Manifest

FAN = 8
_FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}


def fold(partials: DataFrame, keys, folds: dict) -> DataFrame:
    """Combine partials: ``folds`` maps a column to sum / min / max."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = [_FOLDS[how](col).alias(col) for col, how in folds.items()]
    folded = partials.groupBy(*keys).agg(*aggs) if keys else partials.agg(*aggs)
    return folded.select(*keys, *[F.col(c).cast("bigint").alias(c) if folds[c] == "sum" else F.col(c) for c in folds])


class RunLedger:
    def __init__(self, spark: SparkSession, path: str, keys, folds: dict, fan: int = FAN, keep: int = 2,
                 rank_by: str | None = None, listed: int = 1000):
        """``rank_by``: the summed column of a top list, by one key; see ``top``."""
        if fan < 2:
            raise ValueError("a fold takes two runs at least")
        if rank_by and (folds[rank_by] != "sum" or not isinstance(keys, str)):
            raise ValueError("a top list ranks one key by a sum")
        self.keys, self.folds, self.fan, self.rank_by, self.listed = keys, folds, fan, rank_by, listed
        self.manifest = Manifest(spark, path, keep)

    def _write(self, rows: DataFrame, name: str) -> dict:
        entry = self.manifest.write(rows, name)
        if self.rank_by:
            largest = self.manifest.read(entry).select(self.keys, self.rank_by).orderBy(F.desc(self.rank_by)).limit(self.listed)
            entry["summary"] = self.manifest.write(largest, f"{name}-largest")
            n, least = self.manifest.read(entry["summary"]).agg(F.count("*"), F.min(self.rank_by)).first()
            entry["floor"] = least if n == self.listed else 0
        return entry

    def add(self, partial: DataFrame, batch_id: int, stream: str = "") -> None:
        """The partial of one batch, and a fold of every level that it fills: one commit for all of it."""
        runs = self.manifest.entries()
        if any(r["stream"] == stream and r["level"] and r["first"] <= batch_id <= r["last"] for r in runs):
            return
        runs = [r for r in runs if (r["stream"], r["first"], r["last"]) != (stream, batch_id, batch_id)]
        runs.append({"stream": stream, "level": 0, "first": batch_id, "last": batch_id,
                     **self._write(partial, f"batch-{batch_id}")})
        level = 0
        while len(full := [r for r in runs if r["stream"] == stream and r["level"] == level]) >= self.fan:
            first, last = min(r["first"] for r in full), max(r["last"] for r in full)
            entry = self._write(fold(self._rows(full), self.keys, self.folds), f"run-{first}-{last}")
            level += 1
            runs = [r for r in runs if r not in full] + [
                {"stream": stream, "level": level, "first": first, "last": last, **entry}]
        self.manifest.commit(runs)

    def _rows(self, runs: list[dict]) -> DataFrame:
        return reduce(DataFrame.unionByName, map(self.manifest.read, runs))

    def totals(self) -> DataFrame:
        """The fold of all runs; no batch yet is an error, since no schema is known."""
        runs = self.manifest.entries()
        if not runs:
            raise ValueError(f"no batch below {self.manifest.path}")
        return fold(self._rows(runs), self.keys, self.folds)

    def candidates(self, k: int) -> DataFrame | None:
        """The keys that can be among the first ``k``, ties included: at most ``listed`` per run.  None if keys that no run
        lists can be, too."""
        runs = self.manifest.entries()
        floors = sum(r["floor"] for r in runs)
        summaries = reduce(DataFrame.unionByName, (
            self.manifest.read(r["summary"]).withColumn("floor", F.lit(r["floor"]).cast("bigint")) for r in runs))
        bounds = summaries.groupBy(self.keys).agg(
            F.sum(self.rank_by).alias("least"), (F.sum(F.col(self.rank_by) - F.col("floor")) + floors).alias("most"))
        n, kth = bounds.orderBy(F.desc("least")).limit(k).agg(F.count("*"), F.min("least")).first()
        if floors and (n < k or floors >= kth):
            return None
        return bounds.where(F.col("most") >= (kth if n == k else 0)).select(self.keys)

    def top(self, k: int) -> DataFrame:
        """The ``k`` keys with the largest sums (ties by key, NULL last): exact counts of the candidates, or of all keys
        where the summaries cannot tell."""
        some = self.candidates(k)
        totals = self.totals()
        if some is not None:
            runs = self.manifest.entries()
            some = bounded_broadcast(some.withColumnRenamed(self.keys, "_key"), self.listed * len(runs))
            rows = self._rows(runs)
            totals = fold(rows.join(some, F.col(self.keys).eqNullSafe(F.col("_key")), "left_semi"), self.keys, self.folds)
        return totals.orderBy(F.desc(self.rank_by), F.col(self.keys).asc_nulls_last()).limit(k)
