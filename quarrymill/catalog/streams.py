"""Incremental twins of two batch queries: rows arrive in slices, results must agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import _ORACLES, query
from quarrymill.catalog import ordered as _ordered  # noqa: F401  registers the batch twin
from quarrymill.catalog.scalars import _TRAVEL, _travel_records
from quarrymill.functions import text, validate
from quarrymill.session import scratch_path
from quarrymill.streaming import incremental, stateful


@query("stream_running_ratio", _ORACLES["win_running_ratio"])
def stream_running_ratio(t):
    folder = scratch_path(t.spark, "stream-ratio")
    games = t.events.select("event_id", "user_id", "event_type")
    cuts = games.agg(F.percentile_approx("event_id", [0.33, 0.66])).first()[0]
    slices = [F.col("event_id") < cuts[0],
              (F.col("event_id") >= cuts[0]) & (F.col("event_id") < cuts[1]), F.col("event_id") >= cuts[1]]
    handle = incremental.running_ratio_handler(
        folder, ["user_id"], ["event_id"], F.col("event_type") == "purchase", "event_id"
    )
    for part in slices:  # a slice arrives, the stream catches up and stops
        games.where(part).write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(games.schema).parquet(f"{folder}/in")
        incremental.drain(stream, handle, f"{folder}/checkpoint")
    return incremental.read_batches(t.spark, folder).select(
        "event_id", "user_id", "wins", "losses", F.round("ratio", 9).alias("ratio")
    )


@query("stream_state_ratio", _ORACLES["win_running_ratio"])
def stream_state_ratio(t):
    """Rows arrive in the order of a hash inside slices that overlap; the query stops and starts again at each slice."""
    folder = scratch_path(t.spark, "stream-state")
    games = t.events.select(F.col("event_id").cast("bigint").alias("event_id"), "user_id", "event_type")
    low, high = games.agg(F.min("event_id"), F.max("event_id")).first()
    third = (high - low) // 3 + 1
    swap = F.pmod(F.xxhash64("event_id"), F.lit(4)) * (third // 8)  # up to three eighths of a slice later than its turn
    turn = F.least(F.floor((F.col("event_id") - low + swap) / third), F.lit(2))
    closing = games.select("user_id").distinct().select(
        F.lit(None).cast("bigint").alias("event_id"), "user_id", F.lit(None).cast("string").alias("event_type"))
    for part in [*[games.where(turn == i) for i in range(3)], closing]:
        part.write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(games.schema).parquet(f"{folder}/in")
        ran = stateful.running_ratio(stream, ["user_id"], F.col("event_type") == "purchase", "event_id", hold=third // 2)
        stateful.append_to(ran, f"{folder}/out", f"{folder}/checkpoint")
    return t.spark.read.parquet(f"{folder}/out").where("NOT late").select(
        "event_id", "user_id", "wins", "losses", F.round("ratio", 9).alias("ratio"))


@query("stream_quality_gate", _TRAVEL + """
SELECT c_custkey, complete AND byr AND iyr AND eyr AND hgt AND hcl AND ecl AND pid AS valid FROM r
""")
def stream_quality_gate(t):
    folder = scratch_path(t.spark, "stream-gate")
    records = _travel_records(t)
    records.write.parquet(f"{folder}/in")
    stream = t.spark.readStream.schema(records.schema).parquet(f"{folder}/in")
    valid = validate.record_valid(text.key_values(F.col("record")))
    incremental.drain(stream, incremental.quality_gate_handler(folder, valid), f"{folder}/checkpoint")
    return incremental.read_judged(t.spark, folder).select("c_custkey", "valid")
