import json

import pytest
from pyspark.sql import functions as F

from strandweave import cli, dataset
from strandweave.config import Alignment

ROWS = [("b", 0, "lift", [1.0, 2.0]), ("a", 5, "move", [3.0, 4.0]), ("a", 2, "pick", [5.0, 6.0]), ("b", 1, "x", [7.0, 8.0]), ("c", 0, "pick", [0.0, 0.0]), (None, 0, None, [1.0, 1.0])]


@pytest.fixture
def root(spark, tmp_path):
    frames = spark.createDataFrame(ROWS, "session_id string, frame long, task string, state array<double>").repartition(3)
    info = dataset.write(frames, str(tmp_path / "d"), 10.0, "arm", ("state",))
    assert info == dataset.info_of(spark, str(tmp_path / "d"))
    assert (info["total_frames"], info["total_episodes"]) == (6, 4)
    return str(tmp_path / "d")


def test_written(spark, root):
    got = sorted((r["index"], r.episode_index, r.frame_index, r.task_index, r.timestamp, r.session_id, r.state) for r in dataset.frames_of(spark, root).collect() if r.task_index is not None)
    assert got == [(1, 1, 0, 0, 0.0, "a", [5.0, 6.0]), (2, 1, 1, 0, 0.1, "a", [3.0, 4.0]), (3, 2, 0, 1, 0.0, "b", [1.0, 2.0]), (4, 2, 1, 1, 0.1, "b", [7.0, 8.0]), (5, 3, 0, 0, 0.0, "c", [0.0, 0.0])]
    spans = sorted((r.episode_index, r.tasks, r.dataset_from_index, r.dataset_to_index) for r in dataset.episodes_of(spark, root).collect())
    assert spans == [(0, [], 0, 1), (1, ["pick"], 1, 3), (2, ["lift"], 3, 5), (3, ["pick"], 5, 6)]
    stats = {(r.feature, r.dim): (r.mean, r.min, r.n) for r in spark.read.json(f"{root}/meta/stats").collect()}
    assert stats["state", 1] == (21 / 6, 0.0, 6)


def test_validated(spark, root, tmp_path, capsys):
    assert [x[0] for x in dataset.validate(spark, root, ("session_id", "state"), {"state": 2})] == ["EPISODE_WITHOUT_TASK"]
    assert [x[0] for x in dataset.validate(spark, root, ("session_id", "pose"), {"state": 3})] == ["DATA_SCHEMA_MISSING_COLUMNS", "DATA_SCHEMA_EXTRA_COLUMNS", "VECTOR_WIDTH_MISMATCH", "EPISODE_WITHOUT_TASK"]
    assert {x[0] for x in dataset.validate(spark, str(tmp_path / "none"))} == {"MISSING_FILE"}
    assert cli.main(["validate", root], spark) == 0 and cli.main(["info", root], spark) == 0
    assert cli.main(["validate", str(tmp_path / "none")], spark) == 1
    frames = spark.createDataFrame([], "session_id string, frame long, task string, state array<double>")
    assert dataset.write(frames, str(tmp_path / "e"), 10.0)["total_frames"] == 0


def test_commands(spark, tmp_path, capsys, monkeypatch):
    assert cli.main(["init-config", str(tmp_path / "c.json")]) == 0
    assert set(json.loads((tmp_path / "c.json").read_text())) == set(Alignment.__dataclass_fields__)
    Alignment.from_file(str(tmp_path / "c.json"))
    assert cli.main(["queries"]) == 0 and "confidence_route" in capsys.readouterr().out
    assert cli.main(["doctor"]) == 0 and "pyspark" in capsys.readouterr().out
    monkeypatch.setenv("FFMPEG_BINARY", str(tmp_path / "nothing"))
    with pytest.raises(cli.MissingBinary):
        cli.binary("ffmpeg")
    monkeypatch.setenv("STRANDWEAVE_OUTPUT", "/somewhere")
    assert cli.output_root(None) == "/somewhere" and cli.output_root("x") == "x"
    (tmp_path / "in").mkdir()
    assert cli.main(["run", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--config", str(tmp_path / "c.json")], spark) == 0
    assert json.loads(capsys.readouterr().out)["stages"][0]["metrics"]["records"] == 0


def test_writer(spark, tmp_path):
    import pytest

    root = str(tmp_path / "w")
    w = dataset.Writer(spark, root, 10.0)
    with pytest.raises(ValueError, match="no episode"):
        w.finalize()
    frames = lambda n: spark.range(n).select(F.col("id").alias("frame"), F.col("id").cast("double").alias("x"))
    assert (w.register_task("pick"), w.register_task("place"), w.register_task("pick")) == (0, 1, 0)
    assert [w.add_episode(frames(3), "pick"), w.add_episode(frames(2), "place"), w.add_episode(frames(4), "pick")] == [0, 1, 2]
    with pytest.raises(ValueError, match="other columns"):
        w.add_episode(frames(2).drop("x"), "pick")
    info = w.finalize()
    assert (info["total_episodes"], info["total_frames"], info["total_tasks"]) == (3, 9, 2) and not dataset.validate(spark, root, ("session_id", "x"))
    got = [(r["index"], r.episode_index, r.frame_index, r.task_index, r.x) for r in dataset.frames_of(spark, root).orderBy("index").collect()]
    assert got[3] == (3, 1, 0, 1, 0.0) and got[8] == (8, 2, 3, 0, 3.0)
    assert not (tmp_path / "w/_staged").exists()
    with pytest.raises(ValueError, match="finished"):
        w.add_episode(frames(1), "pick")


def test_report(spark, tmp_path):
    from strandweave import report

    rows = [("a", 2_000_000, 500_000, 600_000, 3, 90, 40.0, 0.99, True, True, 2, {"pick": 3, "move": 1}, 0.9, 0, True), ("b", 2_000_000, 500_000, 400_000, 2, 60, 30.0, 0.95, False, True, 1, {"move": 1}, 0.7, 3, False)]
    found = report.write(spark.createDataFrame(rows, report.SESSION), str(tmp_path / "r"))
    assert found["efficiency"] == {"source_mb": 4.0, "video_mb": 1.0, "output_mb": 1.0, "compression": 0.25, "episodes": 5, "frames": 150, "episode_kb": 200.0}
    assert found["video"]["psnr_p5"] == 30.5 and found["video"]["aligned_rate"] == 0.5
    assert found["annotation"] == {"tasks": 3, "labels": {"pick": 3, "move": 2}, "dominant_label_pct": 60.0, "score_mean": 0.8}
    assert found["compliance"] == {"passed": 1, "failed": 1, "pass_rate": 0.5, "issues": 3}
    text = report.summary(found)
    assert "pass rate" in text and "    pick         3" in text
    none = report.write(spark.createDataFrame([], "session_id string"), str(tmp_path / "e"))
    assert none["sessions"] == 0 and "no sessions" in report.summary(none)
