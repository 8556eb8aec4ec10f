import json
import tarfile

import pytest
from pyspark.sql import functions as F

from strandweave import flow
from strandweave.config import Alignment
from strandweave.sources import records, sinks

T0 = 1_700_000_000_000_000_000


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "in"
    for k in range(3):
        t = T0 + k * 33_000_000
        for name, data in ((f"cam_left/{t}.jpg", b"j" * 100), (f"depth/{t + 5_000_000}.npy", b"d" * 50), (f"imu/{t + 1_000_000}.json", json.dumps({"label": "pick", "confidence": 0.96}).encode())):
            (root / name).parent.mkdir(parents=True, exist_ok=True)
            (root / name).write_bytes(data)
    (root / "imu" / "late.json").write_text(json.dumps({"timestamp_ns": T0 + 10**12}))
    (root / "imu" / "broken.json").write_text("{")
    return root


def lines(folder):
    return [json.loads(x) for f in sorted(folder.glob("part-*")) for x in f.read_text().splitlines()]


def test_run_over_a_folder(spark, source, tmp_path):
    out = tmp_path / "out"
    report = flow.run(spark, str(source), str(out), Alignment(shard_bytes=500))
    metrics = {s["name"]: s["metrics"] for s in report["stages"]}
    assert metrics["discover"] == {"records": 10, "mode": "directory_scan"}
    assert metrics["validate"] == {"valid": 10, "invalid": 0}
    assert metrics["align"] == {"samples": 3, "missing_stream_refs": 0}
    assert metrics["annotate"]["accepted"] == 3 and metrics["annotate"]["review"] == 0
    got = lines(out / "annotation" / "accepted")
    assert {(x["label"], x["confidence"]) for x in got} == {("pick", 0.95)}
    assert all(list(x["streams"]) == ["depth:depth", "imu:imu", "rgb:cam_left"] for x in got)
    # a document is of about 600 bytes, so each sample after the first opens a shard
    assert metrics["pack"] == {"samples_packed": 3, "shards": 3}
    archives = spark.read.parquet(str(out / "shards" / "archives")).withColumn("file", F.format_string("%s/shard-%06d", "session_id", "shard"))
    files = [r.path for r in sinks.exported(archives, str(out / "tars"), "file").collect()]
    names = [n for f in sorted(files) for n in tarfile.open(f).getnames()]
    assert len(names) == 12 and sum(n.endswith(".cam_left.jpg") or n.endswith("rgb_cam_left.jpg") for n in names) == 3
    assert json.loads((next((out / "report").glob("part-*"))).read_text()) == report


def test_run_over_a_manifest(spark, source, tmp_path):
    rows = [
        {"path": f"cam_left/{T0}.jpg", "timestamp_ns": T0, "stream": "rgb:cam_left", "modality": "rgb", "metadata": {"label": "", "confidence": "x"}, "note": 1},
        {"path": "gone.jpg", "timestamp_ns": T0 + 1, "stream": "rgb:cam_left"},
        {"timestamp_ns": T0, "stream": "rgb:cam_left"},
        {"path": f"depth/{T0 + 5_000_000}.npy", "stream": "depth:depth"},
    ]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, rows)))
    report = flow.run(spark, str(source), str(tmp_path / "out"), Alignment(expected=("depth:depth", "a")), manifest=str(tmp_path / "m.jsonl"))
    metrics = {s["name"]: s["metrics"] for s in report["stages"]}
    assert metrics["discover"]["records"] == 4 and metrics["validate"] == {"valid": 1, "invalid": 3}
    assert metrics["align"] == {"samples": 1, "missing_stream_refs": 2}
    assert metrics["annotate"]["review"] == 1 and metrics["pack"] == {"samples_packed": 0, "shards": 0}
    bad = [x["validation_errors"] for x in lines(tmp_path / "out" / "manifests" / "invalid")]
    assert sorted(bad) == [["missing_file"], ["missing_path"], ["missing_timestamp_ns"]]


def test_align_details(spark):
    rows = [("s", "rgb:a", "rgb", "a", 100, "a/1", "1", "{}"), ("s", "rgb:a", "rgb", "a", 100, "a/1", "1", "{}"), ("s", "imu:b", "imu", "b", 50_000_100, "b/1", "1", '{"state":"idle","confidence":2}'), ("s", "pose:c", "pose", "c", 50_000_101, "c/1", "1", "{}"), ("t", "imu:b", "imu", "b", 5, "b/2", "2", "{}")]
    found = spark.createDataFrame(rows, records.RECORD)
    got = {r.session_id: r for r in flow.annotate(flow.align(found)).collect()}
    assert got["s"].missing_streams == ["pose:c"] and sorted(got["s"].streams) == ["imu:b", "rgb:a"]
    assert got["s"].streams["imu:b"].delta_ms == 50.0
    assert (got["s"].label, got["s"].confidence, got["s"].accepted) == ("idle", 0.5, False)
    assert (got["t"].anchor_stream, got["t"].confidence) == ("imu:b", 0.5)
    assert flow.align(found.limit(0)).count() == 0
