"""Incremental forms of two batch operations.

Each micro-batch is an ordinary DataFrame, handled by the batch operators.
Outputs and state are written per batch number with ``overwrite``, so a batch
repeated after a failure replaces its own files and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.operators import ordered


def drain(stream: DataFrame, handle, checkpoint: str) -> None:
    """Process everything that has arrived, then stop; the checkpoint remembers the place."""
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


WHOLE_STATE_EVERY = 32  # batches; between them only the keys of a batch are written


def _latest_state(spark: SparkSession, folder: str, keys: Sequence[str], number: int) -> DataFrame | None:
    """The newest state row of every key before batch ``number``; null keys are a key."""
    first = (number - 1) // WHOLE_STATE_EVERY * WHOLE_STATE_EVERY
    if number == 0:
        return None
    parts = [spark.read.parquet(f"{folder}/state/{i}").withColumn("_batch", F.lit(i)) for i in range(first, number)]
    rows = reduce(DataFrame.unionByName, parts)
    kept = F.struct("wins_before", "losses_before", "last_before")
    return rows.groupBy(*keys).agg(F.max_by(kept, "_batch").alias("s")).select(*keys, "s.*")


def running_ratio_handler(
    folder: str, keys: Sequence[str], order: Sequence[str], win: Column, position: str
):
    """Batch handler: running ratios that continue from the totals of the batches before.

    The state is a table of wins, losses and the last position per key; a batch
    writes only the keys it changed, and every ``WHOLE_STATE_EVERY``-th all of them.  A
    row at or before its key's last position came too late to be placed: it is
    written to ``late`` and changes nothing.  A batch's rows are scanned in chunks as in
    the batch form, so a key that fills a batch is still split.
    """
    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        zero = F.lit(0).cast("bigint")
        batch.persist()
        before = _latest_state(spark, folder, keys, number)
        if before is None:
            before = batch.select(*keys, F.col(position).alias("last_before")).limit(0).withColumns(
                {"wins_before": zero, "losses_before": zero})
        named = {k: f"_state_{k}" for k in keys}
        held = before.withColumnsRenamed(named)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()])
        met = batch.join(held, same, "left").drop(*named.values())
        late = F.coalesce(F.col(position) <= F.col("last_before"), F.lit(False))
        met.where(late).select(*batch.columns).write.mode("overwrite").parquet(f"{folder}/late/{number}")
        fresh = met.where(~late)
        local = ordered.running_ratio(fresh, keys, order, win, position)
        out = (
            local.withColumns({"wins": F.col("wins") + F.coalesce("wins_before", zero),
                               "losses": F.col("losses") + F.coalesce("losses_before", zero)})
            .withColumn("ratio", F.try_divide("wins", "losses"))
            .drop("wins_before", "losses_before", "last_before")
        )
        out.write.mode("overwrite").parquet(f"{folder}/out/{number}")
        won = F.coalesce(win, F.lit(False)).cast("bigint")
        changed = fresh.groupBy(*keys).agg(
            (F.sum(won) + F.coalesce(F.max("wins_before"), zero)).alias("wins_before"),
            (F.sum(1 - won) + F.coalesce(F.max("losses_before"), zero)).alias("losses_before"),
            F.max(position).alias("last_before"))
        if number % WHOLE_STATE_EVERY == 0 and number:
            kept = F.struct("wins_before", "losses_before", "last_before")
            both = before.withColumn("_new", F.lit(0)).unionByName(changed.withColumn("_new", F.lit(1)))
            changed = both.groupBy(*keys).agg(F.max_by(kept, "_new").alias("s")).select(*keys, "s.*")
        changed.write.mode("overwrite").parquet(f"{folder}/state/{number}")
        batch.unpersist()

    return handle


def quality_gate_handler(folder: str, valid: Column):
    """Batch handler: rows that pass and rows that fail go to separate tables."""
    def handle(batch: DataFrame, number: int) -> None:
        judged = batch.withColumn("valid", F.coalesce(valid, F.lit(False)))
        judged.write.mode("overwrite").partitionBy("valid").parquet(f"{folder}/out/{number}")

    return handle


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All batches written so far."""
    return spark.read.parquet(f"{folder}/out/*")


def read_judged(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of the quality gate; a partition column comes back as text."""
    return read_batches(spark, folder).withColumn("valid", F.col("valid").cast("boolean"))
