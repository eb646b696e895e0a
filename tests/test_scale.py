"""What large tables need of the plans: nothing is parsed, shuffled or kept more often than its size allows."""

from __future__ import annotations

import json
import os

import pandas as pd
import pytest

from tidemark import bindings
from tidemark.operators import nearest as nearest_module
from tidemark.operators import neighbours, rules, text

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the standard tables are not here")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@tables
@pytest.mark.parametrize("name", ["check_environment", "check_summary_blocks", "check_diff_manifest", "check_transient_layers", "check_signed_range", "validate_artifacts", "validate_rollup"])
def test_documents_are_parsed_once(spark, name):
    assert "MapInArrow" not in plan(bindings.QUERIES[name](spark, SF))


def test_objects_need_no_shuffle_and_hold_their_keys(spark):
    body = json.dumps({"a": {"b": 1, "c": [{"d": None}], "a/b": "x"}, "e": {}, "f": True})
    docs = spark.createDataFrame([("c", f"{i}", body) for i in range(3)] + [("c", "broken", "{,")], "capsule string, file string, text string")
    found = rules.objects(rules.json_nodes(docs))
    assert "Aggregate" not in plan(found) and "Join" not in plan(found)
    got = {(r["file"], r["path"]): {k: tuple(v) for k, v in r["keys"].items()} for r in found.collect()}
    one = {"": {"a": ("object", None, None), "e": ("object", None, None), "f": ("boolean", "true", None)}, "a": {"b": ("number", "1", 1.0), "c": ("array", None, None), "a/b": ("string", "x", None)}, "a/c/0": {"d": ("null", "null", None)}, "e": {}}
    assert got == {(f"{i}", path): keys for i in range(3) for path, keys in one.items()}


def test_cells_of_a_long_cloud_are_not_flat(spark):
    points = spark.range(10_000).selectExpr("id AS _pid", "CAST(id DIV 25 AS DOUBLE) * 25 AS x", "CAST(id % 25 AS DOUBLE) AS y")
    levels, _ = nearest_module.cell_tree(points, [], ["x", "y"])
    assert [n for _, n in levels[:3]] == [1, 4, 16]


def test_queries_of_one_position_go_down_once(spark):
    points = spark.range(200).selectExpr("id AS pid", "CAST(id AS DOUBLE) AS x", "CAST(id % 3 AS DOUBLE) AS y")
    queries = spark.range(60).selectExpr("id", "CASE WHEN id % 20 = 7 THEN NULL ELSE CAST(id % 20 AS DOUBLE) * 15 - 20.5 END AS x", "0.0D AS y")
    near = [min((((i % 20 * 15 - 20.5 - p) ** 2 + (p % 3) ** 2) ** 0.5, p) for p in range(200)) for i in range(60)]
    for radius in (None, 20.0):
        out = nearest_module.nearest(queries, points, ["x", "y"], "id", "pid") if radius is None else neighbours.nearest_within(queries, points, ["x", "y"], radius, "id", "pid")
        assert out.columns == ["id", "x", "y", "distance", "nearest"]
        want = {i: (None, None) if i % 20 == 7 or radius and d > radius else (d, p) for i, (d, p) in enumerate(near)}
        assert {r["id"]: (r["distance"], r["nearest"]) for r in out.collect()} == want


def test_nearest_within_meets_no_pairs_of_a_dense_cloud(spark):
    cloud = spark.range(2_000).selectExpr("id", "CAST(id AS DOUBLE) / 1000 AS x", "0.0D AS y")
    out = neighbours.nearest_within(cloud, cloud.withColumnRenamed("id", "pid"), ["x", "y"], 300.0, "id", "pid")
    assert "explode" not in plan(out) and out.filter("id = nearest AND distance = 0").count() == 2_000


@tables
def test_the_tree_is_written_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: pytest.fail("rows go through the driver"))
    assert {r["path"] for r in bindings.QUERIES["artifact_tree"](spark, SF).collect()} == {f"{i}.txt" for i in range(5)}


def test_codec_takes_texts_in_pieces(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(text, "PIECE_CHARS", 100)

    class Frame:
        schema = spark.range(0).selectExpr("id", "'' AS text").schema

        def mapInPandas(self, run, schema):  # noqa: N802
            seen.extend(len(p) for p in run(iter([pd.DataFrame({"id": range(7), "text": ["x" * 40] * 5 + ["y" * 500, None]})])))

    text._codec(Frame(), "text", lambda t: t)
    assert seen == [2, 2, 1, 1, 1]
