import json

from pyspark.sql import functions as F

from pricelode.sources.documents import embedded_json, links, wrapped_rows
from pricelode.sources.sinks import sparse_json, write_partitioned


def test_wrapped_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text("﻿" + json.dumps([{"id": 1, "t": "x"}, {"id": 2}]), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps({"items": [{"id": 3, "t": "y"}], "n": 1}))
    (tmp_path / "c.json").write_text('"text"')
    assert {(r.source, r.id, r.t) for r in wrapped_rows(spark, str(tmp_path), "id int, t string").collect()} == {("a", 1, "x"), ("a", 2, None), ("b", 3, "y")}


def test_html(spark):
    page = '<p><a class="k" href="/a">A</a><A HREF="/b">B</A><script id="d">{"k": 5}</script>'
    row = spark.createDataFrame([(page,), (None,)], "h string").select(links(F.col("h")).alias("l"), embedded_json(F.col("h"), "d", "k int").alias("j")).collect()
    assert row[0].l == ["/a", "/b"] and row[0].j.k == 5 and row[1].l is None


def test_sinks(spark, tmp_path):
    frame = spark.createDataFrame([("cz", "", 0, []), ("pl", "x", 1, [1])], "m string, t string, n int, l array<int>")
    assert sorted(r.document for r in sparse_json(frame).collect()) == ['{"m":"cz","n":0}', '{"m":"pl","t":"x","n":1,"l":[1]}']
    for _ in range(2):
        write_partitioned(frame, str(tmp_path / "p"), "m")
    write_partitioned(frame.where("m = 'cz'"), str(tmp_path / "p"), "m")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_markets_and_failing_sources(spark):
    import pytest

    from pricelode.plans.markets import attempted, chosen_markets, in_currency, market_table

    assert chosen_markets("PL, cz") == ["cz", "pl"] and len(chosen_markets()) == 5 == market_table(spark).count()
    with pytest.raises(ValueError):
        chosen_markets("xx")
    rows = spark.createDataFrame([("cz", 10.123), ("sk", 10.123), ("xx", 1.0)], "m string, v double")
    assert [r.x for r in rows.select(in_currency(F.col("v"), F.col("m")).alias("x")).collect()] == [10.123, 0.42, None]
    sources = {"a": lambda: spark.createDataFrame([(1,)], "v int"), "gone": lambda: spark.read.schema("v int").parquet("/nowhere/at/all"), "b": lambda: spark.createDataFrame([(2,)], "v int")}
    found, states = attempted(spark, sources, "v int")
    assert sorted((r.seq, r.source, r.v) for r in found.collect()) == [(0, "a", 1), (2, "b", 2)]
    assert {(r.source, r.ok, r.error is None) for r in states.collect()} == {("a", True, True), ("gone", False, False), ("b", True, True)}


def test_lineage_is_cut_in_one_folder_that_can_be_released(spark):
    from pathlib import Path

    from pricelode.session import checkpointed, release, shared_folder

    frame = checkpointed(spark.range(10).selectExpr("id", "map('a', id) as m", "array(struct(id)) as s"))
    folder = Path(shared_folder(spark).removeprefix("file:"))
    assert frame.count() == 10 and frame.schema["m"].dataType.simpleString() == "map<string,bigint>" and any(folder.iterdir())
    release(spark)
    assert not folder.exists() and checkpointed(spark.range(3)).count() == 3
