"""Micro-batches must add up to the batch result, also when one is repeated."""

import numpy as np
from pyspark.sql import functions as F

from quarrymill.functions import text, validate
from quarrymill.operators import ordered
from quarrymill.streaming import incremental, stateful

GAMES = [(i, f"t{i % 3}", "W" if i * 7 % 5 < 3 else "L") for i in range(60)]


def test_slices_equal_the_batch_form(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame(GAMES, "seq BIGINT, team STRING, result STRING")
    win = F.col("result") == "W"
    handle = incremental.running_ratio_handler(folder, ["team"], ["seq"], win, "seq")
    for low, high in [(0, 20), (20, 21), (21, 60)]:
        df.where(F.col("seq").between(low, high - 1)).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
        incremental.drain(stream, handle, f"{folder}/checkpoint")
    incremental.drain(spark.readStream.schema(df.schema).parquet(f"{folder}/in"), handle, f"{folder}/checkpoint")
    got = {(r.seq, r.wins, r.losses, r.ratio) for r in incremental.read_batches(spark, folder).collect()}
    want = ordered.running_ratio(df, ["team"], ["seq"], win, "seq")
    assert got == {(r.seq, r.wins, r.losses, r.ratio) for r in want.collect()}


def test_a_repeated_batch_counts_once(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame(GAMES, "seq BIGINT, team STRING, result STRING")
    handle = incremental.running_ratio_handler(folder, ["team"], ["seq"], F.col("result") == "W", "seq")
    handle(df.where("seq < 30"), 0)
    for _ in range(2):
        handle(df.where("seq >= 30"), 1)
    out = incremental.read_batches(spark, folder)
    assert out.count() == 60
    assert out.groupBy("team").agg(F.max(F.col("wins") + F.col("losses")).alias("n")).agg(F.sum("n")).first()[0] == 60


def test_quality_gate_splits_rows(spark, tmp_path):
    folder = str(tmp_path)
    good = "byr:1955 iyr:2013 eyr:2024 hgt:66in hcl:#0a1b2c ecl:hzl pid:012345678"
    df = spark.createDataFrame([(1, good), (2, "byr:1955"), (3, None)], "id BIGINT, record STRING")
    handle = incremental.quality_gate_handler(folder, validate.record_valid(text.key_values(F.col("record"))))
    handle(df, 0)
    got = {(r.id, r.valid) for r in incremental.read_judged(spark, folder).collect()}
    assert got == {(1, True), (2, False), (3, False)}


def test_a_null_key_keeps_its_totals(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "L"), (2, None, "W")], "seq BIGINT, team STRING, result STRING")
    handle = incremental.running_ratio_handler(str(tmp_path), ["team"], ["seq"], F.col("result") == "W", "seq")
    handle(df.where("seq = 1"), 0)
    handle(df.where("seq = 2"), 1)
    got = {(r.seq, r.wins, r.losses) for r in incremental.read_batches(spark, str(tmp_path)).collect()}
    assert got == {(1, 0, 1), (2, 1, 1)}


def test_a_late_row_is_set_aside_and_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([(i, "t", "W" if i % 2 else "L") for i in range(1, 6)], "seq BIGINT, team STRING, result STRING")
    handle = incremental.running_ratio_handler(folder, ["team"], ["seq"], F.col("result") == "W", "seq")
    for number, seqs in enumerate(["1, 3", "2, 4", "5"]):
        handle(df.where(f"seq IN ({seqs})"), number)
    got = {(r.seq, r.wins, r.losses) for r in incremental.read_batches(spark, folder).collect()}
    assert got == {(1, 1, 0), (3, 2, 0), (4, 2, 1), (5, 3, 1)}
    assert [r.seq for r in spark.read.parquet(f"{folder}/late/*").collect()] == [2]


def test_state_goes_on_past_a_whole_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "WHOLE_STATE_EVERY", 2)
    folder = str(tmp_path)
    df = spark.createDataFrame([(i, f"t{i % 2}" if i < 2 else "t0", "W") for i in range(6)], "seq BIGINT, team STRING, result STRING")
    handle = incremental.running_ratio_handler(folder, ["team"], ["seq"], F.col("result") == "W", "seq")
    for i in range(6):
        handle(df.where(F.col("seq") == i), i)
    got = {(r.seq, r.wins) for r in incremental.read_batches(spark, folder).collect()}
    assert got == {(0, 1), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5)}


def _state_run(spark, folder, df, batches, hold):
    for batch in batches:
        df.where(batch).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
        rows = stateful.running_ratio(stream, ["team"], F.col("result") == "W", "seq", hold)
        stateful.append_to(rows, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").collect()


def test_state_store_equals_the_batch_form_over_shuffled_batches(spark, tmp_path):
    rows = [*GAMES, (60, None, "L"), (61, None, None), *[(None, t, None) for t in ("t0", "t1", "t2", None)]]
    df = spark.createDataFrame(rows, "seq BIGINT, team STRING, result STRING")
    late_by = "seq + pmod(seq * 7, 9)"  # a row comes up to eight places after its turn
    batches = [f"{late_by} < 20", f"{late_by} BETWEEN 20 AND 39", f"{late_by} >= 40", "seq IS NULL"]
    got = _state_run(spark, str(tmp_path), df, batches, 9)
    assert not any(r.late for r in got)
    want = ordered.running_ratio(df.where("seq IS NOT NULL"), ["team"], ["seq"], F.col("result") == "W", "seq").collect()
    assert sorted((r.seq, r.team or "", r.wins, r.losses, r.ratio) for r in got) == sorted(
        (r.seq, r.team or "", r.wins, r.losses, r.ratio) for r in want)


def test_state_store_sets_late_rows_aside_and_forgets_closed_keys(spark, tmp_path):
    rows = [(1, "t", "W"), (5, "t", "L"), (3, "t", "W"), (2, "t", "W"), (6, "t", "W"), (None, "t", None), (4, "t", "W")]
    df = spark.createDataFrame(rows, "seq BIGINT, team STRING, result STRING")
    got = _state_run(spark, str(tmp_path), df, ["seq IN (1, 5)", "seq IN (2, 3)", "seq = 6 OR seq IS NULL", "seq = 4"], 2)
    # 1 is given out at once, 5 is held; 3 and 2 are within the distance of 5, then 5 and 6 close the key, 4 begins a new one
    assert {(r.seq, r.wins, r.losses) for r in got if not r.late} == {(1, 1, 0), (2, 2, 0), (3, 3, 0), (5, 3, 1), (6, 4, 1)}
    assert not [r for r in got if r.late]
    assert 4 not in {r.seq for r in got}  # held: nothing of its new key lies two beyond it
    again = _state_run(spark, str(tmp_path), df, ["seq = 6", "seq = 1"], 2)
    assert {(r.seq, r.wins, r.losses) for r in again if not r.late} >= {(4, 1, 0)}
    assert [(r.seq, r.won, r.wins, r.ratio) for r in again if r.late] == [(1, True, None, None)]


def test_rows_settle_in_the_order_of_positions():
    at, won = np.array([7, 4, 9, 2, 4]), np.array([True, False, True, True, True])
    out, late, kept, totals = stateful.settle(at, won, False, 3, (1, 0, 2))
    assert out[0].tolist() == [4, 4] and out[1].tolist() == [False, True]
    assert (out[2].tolist(), out[3].tolist()) == ([1, 2], [1, 1])
    assert late[0].tolist() == [2] and kept[0].tolist() == [7, 9] and totals == (2, 1, 4)
    out, late, kept, totals = stateful.settle(at[:0], won[:0], True, 3, (1, 0, None))
    assert len(out[0]) == len(late[0]) == len(kept[0]) == 0 and totals == (1, 0, None)
