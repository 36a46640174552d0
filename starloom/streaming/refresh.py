"""Monthly refresh of the fact table as an incremental Structured Streaming job.

New deliveries of the arrivals source land in a folder.  A file stream with the
``availableNow`` trigger picks up exactly the files not seen before (tracked in the
checkpoint location), builds their fact rows against the dimensions already stored,
and overwrites only the (year, month) partitions present in the delivery.  Re-running
a failed micro-batch rewrites the same partitions with the same rows, so the result is
exactly-once.  Contract: one delivery holds complete months (the source is released
monthly); a re-delivered month replaces the stored one, also when several deliveries of a month are found in
one run: per month only the rows of the latest delivery count.  Deliveries are ``key=value`` sub-folders (for
example ``delivery=2016-04/``), ordered by that value, of any number of files each.  A file placed outside
such a folder is a delivery by itself; whether two of them that hold the same month are parts of one delivery or
deliveries that replace each other cannot be told, so a run that finds such a file beside any other delivery of its
month raises before it writes anything.  Then the files belong into ``key=value`` folders, and the next run needs a new
checkpoint location (the refused files stay in the old one's log).  Columns that are not in the declared source schema never reach the fact.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import lenient_cast
from ..plans.fact import i94_fact
from ..session import ensure_checkpoint_dir
from ..sources.files import refresh_partitions
from .ledger import DeliveryLedger

FACT_PARTITIONS = ["i94yr", "i94mon"]
_DELIVERY = "_delivery"
_LOOSE = "_loose"  # path of a file outside a delivery folder
_FILE = "_file"
_LEDGER_KEYS = ["ledger_year", "ledger_month"]


def _file_name():
    """Name and size: what tells whether a delivery holds the same files, wherever its folder lies."""
    return F.concat_ws(" ", F.col("_metadata.file_name"), F.col("_metadata.file_size").cast("string"))


def check_loose_files(batch: DataFrame, columns: Sequence[str]) -> None:
    """Raise if a file outside a delivery folder is not the only delivery of its months in ``batch``."""
    names = {c.lower(): c for c in columns}
    months = batch.groupBy(*[F.col(f"`{names[c]}`") for c in FACT_PARTITIONS]).agg(
        F.max(f"{_DELIVERY}.{_LOOSE}").alias("loose"), F.min(_DELIVERY).alias("a"), F.max(_DELIVERY).alias("b"))
    bad = months.filter(F.col("loose").isNotNull() & ~F.col("a").eqNullSafe(F.col("b"))).first()
    if bad is not None:
        raise ValueError(f"month {bad[0]}-{bad[1]}: {bad['loose']} lies outside a key=value delivery folder and is not the only "
                         "delivery of this month; put the files of one delivery into one such folder")


def latest_delivery(batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Of each (year, month) the rows of its latest delivery, reduced to the declared columns."""
    names = {c.lower(): c for c in columns}
    year, month = (F.col(f"`{names[c]}`") for c in FACT_PARTITIONS)
    last = (batch.groupBy(year.alias("_year"), month.alias("_month"))
            .agg(F.max(_DELIVERY).alias("_last")))  # one row per month of the batch
    same = year.eqNullSafe(F.col("_year")) & month.eqNullSafe(F.col("_month")) & F.col(_DELIVERY).eqNullSafe(F.col("_last"))
    return batch.join(last, same, "left_semi").select(*[f"`{c}`" for c in columns])


def _month_columns(columns: Sequence[str]) -> list:
    """Year and month as the numbers of the fact's partitions."""
    names = {c.lower(): c for c in columns}
    return [lenient_cast(F.col(f"`{names[c]}`"), "bigint").alias(k) for c, k in zip(FACT_PARTITIONS, _LEDGER_KEYS)]


def _delivery_name(folders: Sequence[str]):
    """The folder's value, or the file's name outside a folder."""
    inside = F.col(f"{_DELIVERY}.`{folders[0]}`").cast("string") if folders else F.lit(None).cast("string")
    return F.coalesce(inside, F.col(f"{_DELIVERY}.{_LOOSE}"))


def _decide(ledger: DeliveryLedger, batch: DataFrame, columns: Sequence[str], folders: Sequence[str], batch_id: int) -> DataFrame:
    rows = batch.select(*_month_columns(columns), _delivery_name(folders).alias("_name"), _FILE)
    return ledger.decide(rows, F.col("_name"), F.col(_FILE), batch_id)


def _undecided(batch: DataFrame, columns: Sequence[str], folders: Sequence[str], decided: DataFrame) -> DataFrame:
    """The rows whose month and delivery the ledger says to apply."""
    todo = decided.filter(F.col("status").isNull()).select(*[F.col(k).alias(f"_d_{k}") for k in _LEDGER_KEYS],
                                                           F.col("delivery").alias("_d_name"))
    same = _delivery_name(folders).eqNullSafe(F.col("_d_name"))
    for month, k in zip(_month_columns(columns), _LEDGER_KEYS):
        same = same & month.eqNullSafe(F.col(f"_d_{k}"))
    return batch.join(todo, same, "left_semi")


def run_monthly_refresh(spark: SparkSession, source_dir: str, source_schema: T.StructType,
                        dims: Mapping[str, DataFrame], fact_path: str, checkpoint_location: str,
                        source_format: str = "parquet", int_type: str = "int",
                        timeout_sec: float | None = None, ledger_path: str | None = None, older: str = "ignore") -> None:
    """Process every delivery not yet seen under ``source_dir`` and stop (``availableNow``).

    ``ledger_path`` names the stored ledger of deliveries; ``older`` says whether an older delivery than the applied one is
    ignored (and noted) or refused (``DeliveryConflict``, before anything is written).

    Raises ``TimeoutError`` when ``timeout_sec`` passes before all is processed (the stream is stopped; the next
    call goes on from its checkpoint).
    """
    files = spark.readStream.schema(source_schema).format(source_format).load(source_dir)
    declared = {c.lower() for c in source_schema.fieldNames()}
    folders = [c for c in files.columns if c.lower() not in declared]
    inside = F.lit(False)
    for c in folders:
        inside = inside | F.col(f"`{c}`").isNotNull()
    delivery = F.struct(*[f"`{c}`" for c in folders], F.when(~inside, F.col("_metadata.file_path")).alias(_LOOSE))
    stream = files.select(*source_schema.fieldNames(), delivery.alias(_DELIVERY), _file_name().alias(_FILE))
    ledger = DeliveryLedger(spark, ledger_path, _LEDGER_KEYS, older) if ledger_path else None
    if ledger is not None and len(folders) > 1:
        raise ValueError(f"a ledger orders deliveries by one folder name, found {folders}")
    ensure_checkpoint_dir(spark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        check_loose_files(batch, source_schema.fieldNames())
        names = source_schema.fieldNames()
        decided = None
        if ledger is not None:
            decided = _decide(ledger, batch, names, folders, batch_id).checkpoint(eager=True)  # a few rows per month
            ledger.check(decided)
            batch = _undecided(batch, names, folders, decided)
        fact = i94_fact(latest_delivery(batch, names), dims["economics_country"], dims["economics_us_state"],
                        dims["temperature_country"], dims["temperature_us_state"], int_type=int_type)
        refresh_partitions(fact, fact_path, FACT_PARTITIONS, rebalance=True)
        if decided is not None:
            ledger.note(decided)

    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True)
             .start())
    if not query.awaitTermination(timeout_sec) and timeout_sec is not None and query.isActive:
        query.stop()
        raise TimeoutError(f"the refresh did not end within {timeout_sec} s")
    if query.exception() is not None:
        raise query.exception()
