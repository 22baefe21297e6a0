"""Running ratios with the totals of each key in the stream's state store.

The state of a key is its wins, its losses, the last position given out and the rows held back.  A row is held until
its key has seen a position ``hold`` beyond it, so rows may arrive in any order within that distance; then it
is given out with the totals up to it.  A row at or before the last position given out
comes back marked ``late`` and changes nothing.  A row without a position closes its key:
what is held is given out and the state is removed, so keys that end do not stay in the store.

Spark keeps the state by version with the checkpoint: a query that starts again goes on where it stopped, and a batch that is
repeated after a failure begins from the state before it.  A task holds, per key, 9 bytes for each row that is waiting or new in the
micro-batch; the source's own limits (``maxFilesPerTrigger``) bound those.

Defined results: null keys are a key; a null win is a loss; rows of a key with equal positions in one batch keep the wins last
among equals, so that the outcome does not depend on the order of arrival; an empty stream gives nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

STATE = "wins bigint, losses bigint, last bigint, held array<bigint>, held_won array<boolean>"


def settle(position: np.ndarray, won: np.ndarray, closing: bool, hold: int, totals: tuple[int, int, int | None]):
    """Split waiting rows into given out, late and still held; the totals after what is given out.

    Each part is ``(positions, wins, running wins, running losses)`` or without the last two.
    """
    wins, losses, last = totals
    late = np.zeros(len(position), bool) if last is None else position <= last
    set_aside = position[late], won[late]
    position, won = position[~late], won[~late]
    order = np.lexsort((won, position))
    position, won = position[order], won[order]
    upto = len(position)
    if len(position) and not closing:
        upto = int(np.searchsorted(position, position[-1] - hold, side="right"))
    out, out_won = position[:upto], won[:upto]
    ran = wins + np.cumsum(out_won), losses + np.cumsum(~out_won)
    if upto:
        wins, losses, last = int(ran[0][-1]), int(ran[1][-1]), int(out[-1])
    return (out, out_won, *ran), set_aside, (position[upto:], won[upto:]), (wins, losses, last)


def running_ratio(stream: DataFrame, keys: Sequence[str], win: Column, position: str, hold: int = 0) -> DataFrame:
    """``keys, position, won, wins, losses, ratio, late`` of a stream, by a state per key.  Positions are whole numbers."""
    names = [f"k{i}" for i in range(len(keys))]
    kinds = [stream.schema[k].dataType for k in keys]
    rows = stream.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(position).cast("bigint").alias("at"),
                         F.coalesce(win, F.lit(False)).alias("won"))
    schema = StructType([*[StructField(n, k) for n, k in zip(names, kinds)], StructField("at", LongType()),
                         StructField("won", BooleanType()), StructField("wins", LongType()),
                         StructField("losses", LongType()), StructField("late", BooleanType())])

    def frame(key: tuple, at, won, wins, losses, late: bool) -> pd.DataFrame:
        made = pd.DataFrame({"at": at, "won": won, "wins": pd.array(wins, "Int64"), "losses": pd.array(losses, "Int64")})
        made["late"] = late
        for name, value in zip(reversed(names), reversed(key)):
            made.insert(0, name, pd.Series([value] * len(made), dtype=object))
        return made

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        wins, losses, last, held, held_won = state.get if state.exists else (0, 0, None, [], [])
        at, won, closing = [np.array(held, np.int64)], [np.array(held_won, bool)], False
        for part in parts:
            placed = part["at"].notna()
            closing |= not placed.all()
            at.append(part["at"][placed].to_numpy(np.int64))
            won.append(part["won"][placed].to_numpy(bool))
        out, late, kept, totals = settle(np.concatenate(at), np.concatenate(won), closing, hold, (wins, losses, last))
        if closing:
            state.remove()
        else:
            state.update((*totals, kept[0].tolist(), kept[1].tolist()))
        if len(out[0]):
            yield frame(key, *out, False)
        if len(late[0]):
            nothing = [None] * len(late[0])
            yield frame(key, *late, nothing, nothing, True)

    ran = rows.groupBy(*names).applyInPandasWithState(advance, schema, STATE, "append", GroupStateTimeout.NoTimeout)
    return ran.withColumn("ratio", F.try_divide("wins", "losses")).select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)], F.col("at").alias(position), "won", "wins", "losses", "ratio", "late")


def append_to(rows: DataFrame, folder: str, checkpoint: str) -> None:
    """Process everything that has arrived into Parquet files, once each, then stop."""
    query = (
        rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(folder)
    )
    query.awaitTermination()
