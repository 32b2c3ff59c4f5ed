import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelode.functions.dates import flexible_date
from pricelode.operators.intervals import IntervalMap, merge_intervals


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 12))))
def test_map_equals_set_of_days(spans):
    own, days = IntervalMap(), set()
    for start, length in spans:
        own.insert(start, start + length)
        days |= set(range(start, start + length + 1))
    assert {d for a, b in zip(own.starts, own.ends) for d in range(a, b + 1)} == days
    assert all(b + 1 < a for b, a in zip(own.ends, own.starts[1:]))
    assert {d for a, b in own.gaps() for d in range(a, b + 1)} == (set(range(min(days), max(days) + 1)) - days if days else set())


def test_merge_with_hot_entity_nulls_and_clashing_names(spark):
    random.seed(3)
    rows = [("hot", random.randint(0, 400)) for _ in range(3000)] + [("", 5), (None, 7), ("x", None)]
    day = dt.date(2026, 1, 1)
    data = [(e, s if s is None else day + dt.timedelta(s), s if s is None else day + dt.timedelta(s + 1), "k", 1) for e, s in rows] + [("r", day + dt.timedelta(5), day, "k", 2), ("o", day, dt.date(9999, 12, 31), "k", 3)]
    frame = spark.createDataFrame(data, "e string, a date, b date, entity string, day_from int").repartition(7)
    got = {(r.span_kind, r.e, r.span_from, r.span_to) for r in merge_intervals(frame, ["e"], F.col("a"), F.col("b")).collect()}
    want = IntervalMap()
    for e, s in rows:
        if e == "hot":
            want.insert(s, s + 1)
    expected = {("period", "hot", day + dt.timedelta(a), day + dt.timedelta(b)) for a, b in zip(want.starts, want.ends)} | {("gap", "hot", day + dt.timedelta(a), day + dt.timedelta(b)) for a, b in want.gaps()}
    expected |= {("period", "", day + dt.timedelta(5), day + dt.timedelta(6)), ("period", "o", day, dt.date(9999, 12, 31))}
    assert got == expected
    assert merge_intervals(frame.limit(0), ["e"], F.col("a"), F.col("b")).count() == 0


def test_flexible_date(spark):
    values = ["2026-06-01", " 2026/06/01 ", "20260601", "2026.06.01", "2026-02-30", "", None, "x"]
    got = [r.d for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", flexible_date(F.col("v")).alias("d")).orderBy("i").collect()]
    assert got == [dt.date(2026, 6, 1)] * 4 + [None] * 4


def test_stream_keeps_state(spark, tmp_path):
    from pricelode.streaming.history import interval_stream

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", 1, 3), ("a", 4, 5), ("b", 9, 2)], "e string, day_from int, day_to int").write.mode("append").parquet(source)
    stream = interval_stream(spark.readStream.schema("e string, day_from int, day_to int").parquet(source), "e")
    run = lambda: stream.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda f, n: f.write.mode("overwrite").parquet(f"{out}/{n}")).trigger(availableNow=True).start().awaitTermination(120)
    run()
    spark.createDataFrame([("a", 7, 8)], "e string, day_from int, day_to int").write.mode("append").parquet(source)
    run()
    assert {tuple(r) for r in spark.read.parquet(f"{out}/1").collect()} == {("a", "period", 1, 5), ("a", "period", 7, 8), ("a", "gap", 6, 6)}


def test_upserts_survive_repeats_and_failures(spark, tmp_path):
    from pricelode.streaming.history import compact, upsert_batches, upserted

    path, schema = str(tmp_path / "state"), "k int, at int, v string"
    write = upsert_batches(path)
    write(spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (1, 4, "old")], schema), 0)
    write(spark.createDataFrame([(1, 6, "new"), (2, 5, "tie"), (3, None, "x")], schema), 1)
    write(spark.createDataFrame([(1, 6, "new"), (2, 5, "tie"), (3, None, "x")], schema), 1)  # run again
    (tmp_path / "state" / "batch=2" / "_temporary").mkdir(parents=True)  # a batch that failed
    wanted = {(1, 6, "new"), (2, 5, "tie"), (3, None, "x")}
    assert {tuple(r) for r in upserted(spark, path, ["k"], "at").collect()} == wanted
    compact(spark, path, str(tmp_path / "next"), ["k"], "at")
    assert {tuple(r) for r in upserted(spark, str(tmp_path / "next"), ["k"], "at").collect()} == wanted
