import json
import struct

import pytest

from strandweave import config
from strandweave.operators.geometry import kabsch, umeyama
from strandweave.sources import records, sessions, sinks


def test_scan(spark, tmp_path):
    t = 1_700_000_000_000_000_000
    names = (f"cam_left/{t}.jpg", f"depth/{t + 5}.npy", "cam_left/notes.txt", f"__pycache__/{t}.jpg", f"Processed/{t}.jpg", f"venv/{t}.jpg", "cam_left/1700000000.jpg")
    names += (f"rgb/cam_left/{t}.WEBP", f"data/{t}.flac", f"output/{t}.las", f"raw/6dof/{t}.txt", f"x/{t}.abc")
    for name in names:
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_bytes(b"x")
    got = {(r.path, r.modality, r.sensor_id, r.timestamp_ns) for r in records.scan(spark, str(tmp_path)).collect()}
    want = {
        (f"cam_left/{t}.jpg", "rgb", "cam_left", t),
        (f"depth/{t + 5}.npy", "depth", "depth", t + 5),
        ("cam_left/1700000000.jpg", "rgb", "cam_left", 1_700_000_000 * 10**9),
        (f"rgb/cam_left/{t}.WEBP", "rgb", "cam_left", t),
        (f"data/{t}.flac", "audio", "audio", t),
        (f"output/{t}.las", "pointcloud", "output", t),
        (f"raw/6dof/{t}.txt", "pose", "6dof", t),
    }
    assert got == want
    own = records.scan(spark, str(tmp_path), extensions={"other": [".ABC"]}, skipped=["CAM_LEFT"])
    assert {(r.path, r.modality, json.loads(r.metadata)["discovered"]) for r in own.collect()} == {(f"x/{t}.abc", "other", True), (f"depth/{t + 5}.npy", "depth", True), (f"raw/6dof/{t}.txt", "pose", True)}


def test_manifest(spark, tmp_path):
    rows = [{"path": "a/1.jpg", "timestamp_ns": 2**60 + 1, "extra": 5}, {"file": "/b.npy", "timestamp_s": 1.5, "sensor": "d"}, {"stream": "x"}, {"uri": "c.wav", "timestamp": "1700000000000"}, {"path": "/root/d/e.txt", "timestamp": 1700000000000000, "metadata": "{no"}]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, rows)))
    good, bad = records.normalized(records.manifest(spark, str(tmp_path / "m.jsonl")), "/root")
    got = {r.path: (r.timestamp_ns, r.sensor_id) for r in good.collect()}
    assert got == {"a/1.jpg": (2**60 + 1, "rgb"), "/b.npy": (1_500_000_000, "d"), "c.wav": (1_700_000_000_000_000, "audio"), "d/e.txt": (1_700_000_000_000_000, "pose")}
    assert bad.count() == 1
    assert "extra" in good.where("path = 'a/1.jpg'").first().metadata
    last = good.where("path = 'd/e.txt'").first()
    assert last.frame_id == "e" and json.loads(last.metadata)["raw_metadata"] == "{no"
    assert records.demo(spark).count() == 12


def test_sidecars(spark, tmp_path):
    for name, text in (("a.json", '{"label": "pick"}'), ("b.json", "{broken"), ("c.json", "[1]")):
        (tmp_path / name).write_text(text)
    got = {r.path.rsplit("/", 1)[-1]: r.ok for r in records.sidecars(spark, str(tmp_path)).selectExpr("path", "metadata is not null as ok").collect()}
    assert got == {"a.json": True, "b.json": False, "c.json": False}


@pytest.fixture
def session(tmp_path):
    s = tmp_path / "s1"
    s.mkdir()
    (s / "rgb_head.mp4").write_bytes(b"v")
    (s / "config.json").write_text(json.dumps({"version": "1", "type": "t", "duration": 1.0, "items": [{"name": "rgb", "file": "rgb_head.mp4", "fps": 30.0}, {"name": "imu", "file": "imu.txt"}]}))
    (s / "rgb_head.csv").write_text("frame_index,timestamp_s\n0,1.0\n# note\n1,1.5\nbad\n")
    (s / "imu.txt").write_text("# ts ax\n1 2 3 4 5 6 7\n1 2 3\n 2\t3 4 5 6 7 8 \n")
    (s / "hands.json").write_text(json.dumps({"frames": {"1.000000": {"excluded": False, "hands": [{"is_right": True, "confidence": "high", "keypoints_3d_cam_m": {"wrist": [1.0, 2.0, 3.0]}}]}, "1.500000": {"excluded": True, "exclude_reason": "tail", "hands": []}}}))
    pcm = struct.pack("<4h", 16384, -16384, 0, 16384)
    (s / "mic.wav").write_bytes(b"RIFF" + struct.pack("<I", 36 + len(pcm)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 60, 120, 2, 16) + b"data" + struct.pack("<I", len(pcm)) + pcm)
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.txt").write_text("")
    return tmp_path


def test_session(spark, session):
    found = sessions.found(spark, str(session))
    assert [r.session_id for r in found.collect()] == ["s1"]
    assert sessions.latest(found, "^rgb_head").first().name == "rgb_head.mp4"
    assert {(r.session_id, r.name, r.fps) for r in sessions.manifests(spark, f"{session}/*/config.json").collect()} == {("s1", "rgb", 30.0), ("s1", "imu", None)}
    assert sorted(r.timestamp_s for r in sessions.timestamps(spark, f"{session}/*/rgb_head.csv").collect()) == [1.0, 1.5]
    assert sorted((r.ts, r.gyr) for r in sessions.imu(spark, f"{session}/*/imu.txt").collect()) == [(1.0, [5.0, 6.0, 7.0]), (2.0, [6.0, 7.0, 8.0])]
    hands = {(r.key, r.excluded, r.is_right) for r in sessions.key_points(spark, f"{session}/*/hands.json").collect()}
    assert hands == {("1.000000", False, True), ("1.500000", True, None)}
    assert [(r.frame, r.energy) for r in sessions.audio_energy(spark, f"{session}/*/mic.wav").orderBy("frame").collect()] == [(0, 0.25), (1, 0.125)]
    assert sessions.intrinsics({}, {"rgb_camera": {"intrinsic": {"fx": 1, "fy": 2, "ppx": 3, "ppy": 4}}}) == {"fx": 1.0, "fy": 2.0, "cx": 3.0, "cy": 4.0}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s1", 1, 0, 0), ("s2", 2, 1, 0)], "session_id string, i long, episode_index long, task_index long")
    assert sinks.write_jsonl(df, f"{tmp_path}/j") == 2
    assert records.stage(spark, f"{tmp_path}/j", "session_id string, i long").count() == 2
    for _ in range(2):  # written again, not twice
        sinks.write_frames(df, f"{tmp_path}/f")
    sinks.write_frames(df.where("session_id = 's1'"), f"{tmp_path}/f")
    assert spark.read.parquet(f"{tmp_path}/f").count() == 2
    info = sinks.info(df, 30.0)
    assert sinks.missing_info(info) == [] and info["total_episodes"] == 2
    sinks.write_document(info, f"{tmp_path}/info", spark)
    assert json.loads(spark.read.text(f"{tmp_path}/info").first().value)["total_frames"] == 2
    members = spark.createDataFrame([(0, "b", b"2"), (0, "a", b"1"), (1, "c", b"3")], "shard long, name string, data binary")
    one = {r.shard: bytes(r.archive) for r in sinks.tar_shards(members, ["shard"], "name", "data").collect()}
    two = {r.shard: bytes(r.archive) for r in sinks.tar_shards(members.repartition(3), ["shard"], "name", "data").collect()}
    assert one == two and len(one) == 2
    assert sinks.exported(sinks.tar_shards(members, ["shard"], "name", "data"), f"{tmp_path}/tars").count() == 2


def test_config():
    assert config.Alignment.from_mapping({"tolerance_ms": 5}).tolerance_ms == 5
    with pytest.raises(ValueError, match="speed"):
        config.Alignment.from_mapping({"speed": 1})
    assert config.dotenv("# x\nA='b c'\nB=1\n") == {"A": "b c", "B": "1"}
    known = config.Backends()
    known.register("text", "mock", len)
    assert known.get("text", "mock") is len
    with pytest.raises(LookupError):
        known.get("text", "real")


def test_geometry():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.normal(size=(10, 3))
    assert np.allclose(kabsch(a, a), np.eye(3))
    r = kabsch(a, rng.normal(size=(10, 3)))
    k, q, t = umeyama(a, 2 * (r @ a.T).T + 1)
    assert np.isclose(k, 2) and np.allclose(q, r) and np.allclose(t, 1)
