"""Surrogate keys that stay the same over refreshes.

A registry is a stored table (natural key, id) that only grows.  ``assign`` gives known natural keys the ids they have and
numbers new ones after the largest id so far, in the order asked for; so facts stored earlier go on pointing at the right
rows, whatever a refresh adds, changes or leaves out.  With an empty registry the ids are those of ``add_surrogate_key``.

New keys are appended before any table with their ids is written.  When a refresh dies after that, the next one finds the
keys known and hands out the same ids; when it dies while it appends, the keys that were committed count as known and the
others follow after the largest id, so no id is ever given twice.  One writer at a time: the caller must not refresh
the same star from two jobs at once.

Keys match null-safe (a NULL part of a key equals NULL).  The known keys meet the rows in one equi-join on the key, which
Spark broadcasts or shuffles by the sizes that it measures; only the largest id reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import ensure_checkpoint_dir
from .keys import add_surrogate_key


class RepeatedNaturalKey(ValueError):
    """A natural key is held by more than one row, so it cannot name one of them."""


def check_natural_key(df: DataFrame, keys: Sequence[str], what: str = "table") -> None:
    """Raise ``RepeatedNaturalKey`` if two rows share a natural key (one aggregation; one row reaches the driver)."""
    bad = df.groupBy(*[F.col(f"`{k}`") for k in keys]).count().filter(F.col("count") > 1).first()
    if bad is not None:
        raise RepeatedNaturalKey(f"{what} repeats the natural key {bad.asDict()}")


def _match(keys: Sequence[str]):
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}"))
    return cond


@dataclass(frozen=True)
class KeyRegistry:
    spark: SparkSession
    path: str
    keys: Sequence[str]
    id_col: str

    def read(self) -> DataFrame | None:
        """The stored (natural key, id) rows, or None when there are none yet."""
        try:
            return self.spark.read.parquet(self.path).select(*[f"`{k}`" for k in self.keys], self.id_col)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def seed(self, dimension: DataFrame) -> None:
        """Take over the ids of a stored dimension; what the registry held before is replaced."""
        check_natural_key(dimension, self.keys, self.path)
        dimension.select(*[f"`{k}`" for k in self.keys], self.id_col).write.mode("overwrite").parquet(self.path)

    def _known(self, registry: DataFrame) -> DataFrame:
        return registry.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(self.keys)],
                               F.col(self.id_col).alias("_id"))

    def assign(self, df: DataFrame, order_by: Sequence[str], id_type: str = "int") -> DataFrame:
        """``df`` with ``id_col``: known keys keep their id, new ones are numbered in ``order_by`` order and stored."""
        ensure_checkpoint_dir(self.spark)
        rows = df.checkpoint(eager=True)  # read three times, and every reader must see the same rows
        check_natural_key(rows, self.keys, "the source")
        registry = self.read()
        fresh, start = rows, 0
        if registry is not None:
            known = self._known(registry)
            fresh = rows.join(known, _match(self.keys), "left_anti")
            start = registry.agg(F.max(self.id_col)).first()[0] or 0
        new = add_surrogate_key(fresh, order_by, self.id_col, id_type=id_type, start=start)
        new.select(*[f"`{k}`" for k in self.keys], self.id_col).write.mode("append").parquet(self.path)
        known = self._known(self.read())
        named = rows.join(known, _match(self.keys))
        return named.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_id").cast(id_type).alias(self.id_col))


def upsert(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``new``, and those of ``stored`` whose natural key ``new`` does not hold."""
    current = new.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
    gone = stored.join(current, _match(keys), "left_anti")
    return new.unionByName(gone.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in new.schema]))
