"""Ledger of deliveries: which delivery of a month the fact holds, across runs.

A stored table that only grows, a row per month and delivery that a run decided on: the key of the month, the delivery
(name, files, fingerprint of the files), whether it was ``applied`` or ``ignored``, and the micro-batch.  Deliveries of a month
are ordered by name: by number where both names are numbers, else as text, numbers last.  A run applies a delivery
when it comes after all applied ones of its month.  An older one changes nothing and is noted as ignored (or refused, as
the caller chooses); the delivery that is applied already, found again with the same files, changes nothing either, so a
repeated batch or a lost checkpoint is harmless.  The same name with other files is an error: neither the old nor
the new files alone are the month.

The row is written after the fact's partitions.  A run that dies between the two finds its delivery unknown and writes
the same partitions again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

APPLIED, IGNORED = "applied", "ignored"


class DeliveryConflict(ValueError):
    """A delivery that is older than the stored one and must not be passed over, or an applied one with other files."""


def delivery_order(name: Column) -> Column:
    """What deliveries are ordered by: a number if the name is one (text comes before numbers), then the name."""
    return F.struct(name.try_cast("decimal(38,9)").alias("number"), name.alias("name"))


class DeliveryLedger:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], older: str = "ignore"):
        if older not in ("ignore", "refuse"):
            raise ValueError("older: ignore or refuse")
        self.spark, self.path, self.keys, self.older = spark, path, list(keys), older

    def read(self) -> DataFrame | None:
        """The stored rows, or None when there are none yet."""
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def decide(self, rows: DataFrame, delivery: Column, file: Column, batch_id: int) -> DataFrame:
        """One row per month and delivery of ``rows``: keys, delivery, files, fingerprint, last, status (None: apply), batch.

        ``rows`` are reduced to their files first, by partial aggregation; the rest is a few rows per month.
        """
        files = rows.groupBy(*[F.col(f"`{k}`") for k in self.keys], delivery.alias("delivery"), file.alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
        found = files.groupBy(*self.keys, "delivery").agg(
            F.count(F.lit(1)).alias("files"), F.sum("_n").alias("n_rows"),
            F.sum(F.xxhash64("_file", "_n").cast("decimal(38,0)")).cast("string").alias("fingerprint"))
        order = delivery_order(F.col("delivery"))
        last = found.groupBy(*[F.col(k).alias(f"_l_{k}") for k in self.keys]).agg(F.max(order).alias("_last"))
        found = found.join(last, self._same("_l_")).drop(*[f"_l_{k}" for k in self.keys])
        newest = order == F.col("_last")
        stored = self.read()
        if stored is None:
            return found.select(*self.keys, "delivery", "files", "n_rows", "fingerprint",
                                F.when(~newest, F.lit(IGNORED)).alias("status"), F.lit(batch_id).cast("long").alias("batch"))
        held = stored.filter(F.col("status") == APPLIED).groupBy(*[F.col(k).alias(f"_h_{k}") for k in self.keys]).agg(
            F.max(F.struct(delivery_order(F.col("delivery")).alias("o"), F.col("fingerprint"))).alias("_held"))
        known = stored.select(*[F.col(k).alias(f"_s_{k}") for k in self.keys], F.col("delivery").alias("_s_delivery"),
                              F.col("fingerprint").alias("_s_fingerprint"), F.lit(True).alias("_known")).distinct()
        again = (self._same("_s_") & F.col("delivery").eqNullSafe(F.col("_s_delivery"))
                 & (F.col("fingerprint") == F.col("_s_fingerprint")))
        both = found.join(held, self._same("_h_"), "left").join(known, again, "left")
        o = F.col("_held.o")
        state = (F.when(F.col("_known"), F.lit("repeated"))
                 .when(F.col("_held").isNotNull() & (order == o) & (F.col("fingerprint") != F.col("_held.fingerprint")), F.lit("conflict"))
                 .when(F.col("_held").isNotNull() & (order < o), F.lit("older"))
                 .when(~newest, F.lit(IGNORED)))
        return both.select(*self.keys, "delivery", "files", "n_rows", "fingerprint", state.alias("status"),
                           F.lit(batch_id).cast("long").alias("batch"))

    def _same(self, prefix: str) -> Column:
        cond = F.lit(True)
        for k in self.keys:
            cond = cond & F.col(f"`{k}`").eqNullSafe(F.col(f"{prefix}{k}"))
        return cond

    def check(self, decided: DataFrame) -> None:
        """Raise ``DeliveryConflict`` for what must not be passed over, before anything is written."""
        wrong = ["conflict", "older"] if self.older == "refuse" else ["conflict"]
        bad = decided.filter(F.col("status").isin(wrong)).first()
        if bad is not None:
            month = ", ".join(f"{k}={bad[k]}" for k in self.keys)
            why = ("is applied already, with other files; deliver it again whole under a later name" if bad["status"] == "conflict"
                   else "is older than the one that is applied")
            raise DeliveryConflict(f"delivery {bad['delivery']} of {month} {why}")

    def note(self, decided: DataFrame) -> None:
        """Store the decisions of a run; repeated deliveries are no news."""
        status = F.when(F.col("status").isNull(), APPLIED).otherwise(IGNORED)
        (decided.filter(F.col("status").isNull() | (F.col("status") != "repeated"))
         .withColumn("status", status).coalesce(1).write.mode("append").parquet(self.path))
