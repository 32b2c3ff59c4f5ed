import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from pricelode.operators.spikes import SpikeRule, implausible_in_series, implausible_in_stretches, spike_scores

SCHEMA = "id bigint, src string, o bigint, promo boolean, day date, v double, series string"


def _series(spark, values, source="s", outlet=1, start=0):
    day = dt.date(2026, 1, 1)
    return [(start + i, source, outlet, False, day + dt.timedelta(i), None if v is None else float(v), "clash") for i, v in enumerate(values)]


def _found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    out = implausible_in_series(frame, row="id", source="src", series=["o"], regime="promo", at="day", value=F.col("v"), impossible=F.col("v") <= 0)
    return {(r.row_id, r.why) for r in out.collect()}


def test_spikes_but_no_lasting_change(spark):
    random = np.random.default_rng(1)
    values = list(100 * np.exp(random.normal(0, 0.03, 60)))
    values[20:23] = [900.0, 950.0, 920.0]
    values[40:] = [v * 1.6 for v in values[40:]]
    values[33] = None
    values[10] = -5.0
    values[47:51] = [v * 8 for v in values[47:51]]  # four together are no spike
    assert _found(spark, _series(spark, values)) == {(20, "spike"), (21, "spike"), (22, "spike")}


def test_stuck_against_the_usual_run(spark):
    random = np.random.default_rng(2)
    free = list(100 * np.exp(random.normal(0, 0.05, 80)))
    free[30:40] = [free[30]] * 10
    free[35] = None  # no observation, so it does not end the run
    held = [float(v) for v in np.repeat(100 + random.normal(0, 3, 12).round(2), 6)]
    held[24:43] = [held[24]] * 19
    rows = _series(spark, free, "free", 1) + _series(spark, held, "held", 2, 1000) + _series(spark, free[30:40], None, 3, 2000)
    got = _found(spark, rows + rows[:50])
    assert {i for i, w in got if w == "stuck" and i < 1000} == set(range(30, 40)) - {35}
    assert {i - 1000 for i, w in got if w == "stuck" and 1000 <= i < 2000} == set(range(24, 43))


def test_spikes_of_steady_sources_and_in_both_directions(spark):
    random = np.random.default_rng(5)
    values = list(100 * np.exp(random.normal(0, 0.01, 60)))
    values[20] *= 1.2
    values[40], values[41] = 300.0, 30.0
    assert _found(spark, _series(spark, values)) == {(20, "spike"), (40, "spike"), (41, "spike")}


def test_empty_and_null_tables(spark):
    assert _found(spark, []) == set()
    assert _found(spark, [(None, None, None, None, None, None, None), (1, None, None, None, None, 3.0, None), (1, None, None, None, None, 3.0, None)]) == set()
    assert len(spike_scores(np.array([]), np.array([]), SpikeRule())) == 0


def test_stretches(spark):
    rows = [(1, 1, 10.0), (2, 1, 10.0), (3, 1, 10.04), (4, 1, 30.0), (5, 1, None), (6, 2, 1.45), (7, 2, 1.4), (8, 2, 1.45), (4, 1, 30.0), (9, None, 5.0)]
    out = implausible_in_stretches(spark.createDataFrame(rows, "id int, k int, v double"), row="id", stretch=["k"], value=F.col("v"), impossible=F.col("v") <= 0)
    assert [(r.row_id, r.why) for r in out.collect()] == [(4, "stray")]


def test_a_long_series_is_judged_in_pieces(spark, monkeypatch):
    """The verdicts on one series do not depend on where its pieces end."""
    from pricelode.operators import spikes

    random = np.random.default_rng(3)
    values = list(np.round(100 * np.exp(random.normal(0, 0.03, 3000)), 2))
    for at in range(40, 3000, 97):
        values[at:at + 1 + at % 3] = [900.0 + at + k for k in range(1 + at % 3)]
    for at in range(300, 2900, 500):
        values[at:at + 25] = [77.77] * 25
    rows = _series(spark, values)
    whole = _found(spark, rows)
    assert sum(why == "stuck" for _, why in whole) >= 25 * 5
    import pandas as pd
    import pyarrow as pa

    frame = pd.DataFrame({"series": "x", "source": "s", "row_id": np.arange(3000), "regime": 0, "value": values, "plausible": True})

    def verdicts(piece):
        monkeypatch.setattr(spikes, "PIECE", piece)
        batches = [pa.RecordBatch.from_pandas(frame.iloc[a:a + 70], preserve_index=False) for a in range(0, 3000, 70)]
        out = pd.concat([b.to_pandas() for b in spikes._profile(SpikeRule(), iter(batches))])
        per_row = out[out.kind.isin(["spike", "stuck"])].sort_values(["kind", "row_id"])[["kind", "row_id", "metric"]].values.tolist()
        counts = out[~out.kind.isin(["spike", "stuck"])].groupby(["kind", "metric"]).weight.sum().to_dict()
        return per_row, counts

    assert verdicts(200) == verdicts(10**6)
