"""File layouts that the readers accept, and round trips of the writers."""

import json

from pyspark.sql import functions as F

from stepforge.sources import files as IO


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def game(bot, abilities):
    return {"meta": {"bot_name": bot, "result": "Victory", "map": "A"}, "order_list": abilities,
            "sequence": [{"seq": i, "ability": a, "game_time": i * 1.5, "obs": {"text": "t", "structured": {"time": 1}}}
                         for i, a in enumerate(abilities)]}


def test_trajectories(spark, tmp_path):
    put(tmp_path / "bot1/sequences/a.json", json.dumps(game("bot1", ["X", "Y"]), indent=2))
    put(tmp_path / "bot2/sequences/b.json", json.dumps(game("bot2", ["Z"])))
    put(tmp_path / "bot2/sequences/empty.json", json.dumps(game("bot2", [])))
    put(tmp_path / "bot2/results.json", json.dumps(game("report", ["X"])))
    put(tmp_path / "bot2/broken.json", "{not json")
    put(tmp_path / "bot2/plain.json", json.dumps({"other": 1}))
    rows = IO.read_trajectories(spark, str(tmp_path))
    assert sorted(r.meta.bot_name for r in rows.collect()) == ["bot1", "bot2"]
    actions = IO.actions_of(rows).filter("position = 1").collect()
    assert [(a.ability, a.seq, json.loads(a.obs.structured)) for a in actions] == [("Y", 1, {"time": 1})]
    alone = IO.read_trajectories(spark, str(tmp_path / "bot2/sequences/empty.json"))
    assert alone.count() == 1


def test_jsonl_with_mark_and_blank_lines(spark, tmp_path):
    put(tmp_path / "rows.jsonl", '﻿{"a": 1}\n\n{"a": 2}\n')
    rows = IO.read_jsonl(spark, str(tmp_path / "rows.jsonl"), "a int").filter("a is not null")
    assert sorted(r.a for r in rows.collect()) == [1, 2]


def test_sample_array(spark, tmp_path):
    samples = [{"system": f"s{i}", "conversations": [{"from": "human", "value": f"h{i}"}]} for i in range(3)]
    put(tmp_path / "samples.json", "﻿" + json.dumps(samples, indent=1))
    rows = IO.read_sample_array(spark, str(tmp_path / "samples.json")).orderBy("index").collect()
    assert [(r["index"], r.system, r.conversations[0].value) for r in rows] == [(i, f"s{i}", f"h{i}") for i in range(3)]


def test_step_docs(spark, tmp_path):
    put(tmp_path / "md/one.md", "# Summary\n go fast \n# Details\n\n[Step 1] old\n  [Step 2] two\n[Step 1] new\ntext [Step 3] no\n")
    rows = IO.read_step_docs(spark, str(tmp_path / "md")).orderBy("number").collect()
    assert [(r.number, r.line, r.summary) for r in rows] == [(1, "[Step 1] new", "go fast"), (2, "[Step 2] two", "go fast")]


def test_graph(spark, tmp_path):
    data = {"Ability": [
        {"name": "A1", "target": {"Build": {"produces_name": "B"}}, "tech_chain": ["B: [C] -> B (A1)"],
         "relations": [{"relation": "action_result", "object_name": "B"}]},
        {"name": "A2", "target": "Unit", "relations": []}, {"name": "A3", "target": {"Research": {"upgrade_name": "U"}}}],
        "Unit": [{"name": "B", "race": "Terran", "minerals": 50, "abilities": [{"ability_name": "A1"}]}],
        "Upgrade": [{"name": "U", "cost": {"minerals": 5}}]}
    put(tmp_path / "graph.json", json.dumps(data))
    tables = IO.read_graph(spark, str(tmp_path / "graph.json"))
    kinds = {r["name"]: (r.kind, r.result) for r in tables["Ability"].collect()}
    assert kinds == {"A1": ("Build", "B"), "A2": ("Unit", None), "A3": ("Research", "U")}
    assert [tuple(r) for r in tables["edges"].collect()] == [("A1", "action_result", "B")]
    assert tables["Unit"].select(F.explode("abilities.ability_name")).first()[0] == "A1"


def test_matches(spark, tmp_path):
    put(tmp_path / "bio/results.json", json.dumps({"matches": [{"bot_key": "bio", "victory": True}, {"bot_key": "bio"}]}))
    rows = IO.read_matches(spark, str(tmp_path)).collect()
    assert [(r.bot_key, r.victory) for r in rows] == [("bio", True), ("bio", None)]


def test_registry_and_manifest(spark, tmp_path):
    grid = spark.createDataFrame([(t, m) for t in IO.TASKS for m in IO.MODES], "task string, mode string")
    names = sorted(r.file_name for r in IO.dataset_registry(grid).collect())
    assert len(names) == 6 and names[0] == "sc2_executor_qwen3_nothink_sft.json"
    IO.write_manifest(grid, str(tmp_path / "m"), {"rows": F.count(F.lit(1))}, {"task": "all"})
    row = spark.read.json(str(tmp_path / "m")).first()
    assert (row.rows, row.parameters.task) == (6, "all")
