import hashlib
import json
import math
import sys

import numpy as np
import pytest

from strandweave import config
from strandweave.functions import seeds
from strandweave.sources import normal, sessions, sinks


def test_sessions_in_normal_form(spark, tmp_path):
    from pyspark.sql import functions as F

    root = str(tmp_path / "n")
    frames = spark.createDataFrame([("a", i, i / 20) for i in range(5)] + [("b", 0, 0.0)], "session_id string, frame_index long, rgb_timestamp_s double")
    half = math.sqrt(0.5)
    head = spark.createDataFrame([("a", 1, 1.0, 2.0, 3.0, 0.0, 0.0, half, half)], "session_id string, frame_index long, tx double, ty double, tz double, qx double, qy double, qz double, qw double")
    whole = [0.1] * 63
    keys = [("a", 0, "left", True, True, whole, [0.0] * 45), ("a", 1, "left", False, False, whole, None), ("a", 2, "right", True, False, [float("nan")] * 63, [0.0] * 44), ("a", 0, "right", None, None, None, None)]
    points = spark.createDataFrame(keys, "session_id string, frame_index long, hand string, present boolean, valid boolean, points array<double>, pose array<double>")
    normal.write({"frame_index": frames, "head_pose": head, "hand_keypoints": points}, root)
    normal.write({"frame_index": frames.where("session_id = 'b'").withColumn("frame_index", F.lit(7).cast("long"))}, root)  # replaces b alone
    back = normal.read(spark, root, "frame_index")
    assert sorted((r.session_id, r.frame_index) for r in back.collect()) == [("a", i) for i in range(5)] + [("b", 7)]
    assert {r.session_id: (r.n_frames, round(r.fps, 6)) for r in normal.frame_counts(back).collect()} == {"a": (5, 20.0), "b": (1, 30.0)}
    got = {(r.session_id, r.frame_index): (r.place, np.round(r.rotation, 6).tolist()) for r in normal.poses(back, normal.read(spark, root, "head_pose")).collect()}
    assert got["a", 0] == got["b", 7] == ([0.0] * 3, np.eye(3).ravel().tolist())
    assert got["a", 1] == got["a", 4] == ([1.0, 2.0, 3.0], [0.0, -1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0])
    hands = {(r.frame_index, r.hand): (r.valid, r.points is None, r.pose is None) for r in normal.hands(normal.read(spark, root, "hand_keypoints")).collect()}
    assert hands == {(0, "left"): (True, False, False), (1, "left"): (False, True, True), (2, "right"): (False, True, True), (0, "right"): (False, True, True)}
    seen = {(r.session_id, r.frame_index): r.visible for r in normal.visible(back, points).collect()}
    assert seen == {("a", 0): True, ("a", 1): False, ("a", 2): False, ("a", 3): False, ("a", 4): False, ("b", 7): True}
    assert normal.read(spark, root, "imu").count() == 0


def test_intrinsics(spark):
    calibration = spark.createDataFrame([("a", 500.0, 510.0, 320.0, 240.0, 640, 480)], "session_id string, fx double, fy double, cx double, cy double, width int, height int")
    videos = spark.createDataFrame([("a", 1280, 960), ("b", 100, 50)], "session_id string, width int, height int")
    got = {r.session_id: r for r in normal.intrinsics(calibration, videos).collect()}
    assert (got["a"].fx, got["a"].fy, got["a"].cx, got["a"].cy) == (1000.0, 1020.0, 640.0, 480.0)
    wide = {r.session_id: r for r in normal.intrinsics(calibration, videos, fov=60.0).collect()}
    assert wide["a"].fx == 1000.0 and math.isclose(wide["b"].hfov, 60.0) and wide["b"].fx == wide["b"].fy
    assert math.isclose(got["a"].hfov, 2 * math.degrees(math.atan(640 / 1000))) and (got["b"].fx, got["b"].cy) == (100.0, 25.0)


def test_probe(spark):
    full = {"streams": [{"width": 640, "height": 480, "r_frame_rate": "30000/1001", "nb_frames": "300", "duration": "10.01"}]}
    bare = {"streams": [{"r_frame_rate": "25/1"}], "format": {"duration": "2.02"}}
    texts = {"a": json.dumps(full), "b": json.dumps(bare), "c": json.dumps({"streams": []})}
    videos = spark.createDataFrame([(x,) for x in "abcd"], "path string")
    got = {r.path: r for r in normal.probe(videos, texts.__getitem__).collect()}
    assert (got["a"].n_frames, got["a"].width, round(got["a"].fps, 3), got["a"].duration_s, got["a"].probe_error) == (300, 640, 29.97, 10.01, None)
    assert (got["b"].n_frames, got["b"].height, got["b"].duration_s) == (50, 0, 2.02)
    assert got["c"].fps is None and got["c"].probe_error == "no video stream" and got["d"].probe_error.startswith("KeyError")
    assert normal.probe(videos.limit(1), binary=sys.executable).first().probe_error.startswith("CalledProcessError")


def test_key_first(spark):
    texts = {"a": '{"packets": [{"flags": "K__"}]}', "b": '{"packets": [{"flags": "___"}]}', "c": '{"packets": []}'}
    got = {r.path: (r.keyframe_first, r.probe_error) for r in normal.key_first(spark.createDataFrame([(x,) for x in "abc"], "path string"), texts.__getitem__).collect()}
    assert got == {"a": (True, None), "b": (False, None), "c": (None, None)}


def test_plain_yaml():
    text = """%YAML:1.0
---
cam0:  # left
  camera_model: pinhole
  intrinsics: [461.5, 460.25,
    367.0, 248.5]
  T_cam_imu:
  - [0.01, -0.99, 0.0, 1e-2]
  - [1.0, 0.0, 0.0, 0.0]
  resolution: [752, 480]
imu:
- name: a
  rate: 200
- name: "b: c"
  on: true
empty:
last: !!opencv-matrix
  rows: 2
  data: [ 1, 2 ]
"""
    got = sessions.plain_yaml(text)
    assert got["cam0"] == {"camera_model": "pinhole", "intrinsics": [461.5, 460.25, 367.0, 248.5], "T_cam_imu": [[0.01, -0.99, 0.0, 0.01], [1.0, 0.0, 0.0, 0.0]], "resolution": [752, 480]}
    assert got["imu"] == [{"name": "a", "rate": 200}, {"name": "b: c", "on": True}] and got["empty"] is None and got["last"] == {"rows": 2, "data": [1, 2]}
    assert sessions.intrinsics(got, {}) == {"fx": 461.5, "fy": 460.25, "cx": 367.0, "cy": 248.5} and sessions.plain_yaml("") == {}


def test_media(spark, tmp_path):
    (tmp_path / "v.mp4").write_bytes(b"abc")
    media = spark.createDataFrame([("s", "rgb.mp4", str(tmp_path / "v.mp4"))], "session_id string, name string, path string")
    assert normal.materialised(media, str(tmp_path / "out"), False).first()[2:] == ("referenced", str(tmp_path / "v.mp4"), 3)
    assert normal.materialised(media, str(tmp_path / "out"), True).first()[2:] == ("copied", str(tmp_path / "out/s/rgb.mp4"), 3)
    assert (tmp_path / "out/s/rgb.mp4").read_bytes() == b"abc"


def test_documents_and_upserts(spark, tmp_path):
    sinks.write_json({"b": 1, "a": "ä"}, str(tmp_path / "x/d.json"))
    assert (tmp_path / "x/d.json").read_text() == '{\n  "a": "ä",\n  "b": 1\n}\n' and [p.name for p in (tmp_path / "x").iterdir()] == ["d.json"]
    path, kind = str(tmp_path / "cache"), "key string, text string, created_at long"
    put = lambda *rows: sinks.upsert(spark.createDataFrame(list(rows), kind), path)
    put(("a", "1", 1), ("b", "1", 1))
    put(("a", "2", 2), ("a", "old", 0))
    assert sorted(map(tuple, put(("c", "3", 3), ("b", "late", 0)).collect())) == [("a", "2", 2), ("b", "1", 1), ("c", "3", 3)]
    (tmp_path / "cache/v=9").mkdir()  # not written whole
    assert sinks.versions(spark, path) == [2, 3]


def test_wav():
    import struct

    pcm = struct.pack("<4h", 16384, -16384, 0, 32767)
    head = lambda bits, n: b"RIFF" + struct.pack("<I", 0) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 2, 60, 0, 0, bits) + b"data" + struct.pack("<I", n)
    assert sessions.wav(head(16, 8) + pcm) == (60, [[0.5, -0.5], [0.0, 32767 / 32768]])
    assert sessions.wav(head(8, 2) + b"\x80\xff") == (60, [[0.0, 127 / 128]])


def test_seeds(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("v", 1), ("v", None)], "a string, b int").select(seeds.seed(F.lit("1"), F.col("a"), F.col("b")).alias("s"))
    want = [int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little") for x in (b"1|v|1", b"1|v|*")]
    rows = df.withColumn("d", seeds.draws(F.col("s"), 3)).collect()
    assert [int(r.s) for r in rows] == want
    assert rows[0].d == np.random.default_rng(want[0]).random(3).tolist()


def test_backends(monkeypatch):
    b = config.Backends()
    b.register("moge2", "mock", 1)
    assert b.of_environment("moge2") == 1 and b.device("moge2") == "cpu" and b.weights("moge2") is None
    monkeypatch.setenv("STRANDWEAVE_HANDPOSE_BACKEND", "Real")
    monkeypatch.setenv("STRANDWEAVE_MOGE2_DEVICE", "cuda:1")
    with pytest.raises(NotImplementedError, match="real for moge2"):
        b.of_environment("moge2")
    assert b.chosen("language") == "mock" and b.device("moge2") == "cuda:1"
    monkeypatch.setenv("STRANDWEAVE_MOGE2_BACKEND", "nothing")
    with pytest.raises(ValueError, match="none of"):
        b.chosen("moge2")
    assert b.check("hawor_s2", {"points": [0.0] * 63, "pose": [1.0], "betas": [0.0] * 10}) == ["orient is missing", "pose has 1 numbers, not 45"]


def test_intake(spark, tmp_path):
    from strandweave import cli, intake

    for name, frames in (("s1", 4), ("s2", 3)):
        at = tmp_path / "in" / name
        (at / "camera_params").mkdir(parents=True)
        (at / "rgb_head.mp4").write_bytes(b"video")
        items = [{"name": "rgb_head", "file": "rgb_head.mp4", "count": 4}, {"name": "imu", "file": "imu.csv"}]
        (at / "config.json").write_text(json.dumps({"version": "1", "duration": 4 / 30, "items": items}))
        lines = [f"{i if name == 's1' else 2 * i},{1 + i / 30:.6f}" for i in range(frames)]
        (at / "rgb_head.csv").write_text("frame_index,timestamp_s\n" + "\n".join(lines) + "\n")
        (at / "imu.txt").write_text("\n".join(f"{0.9 + 0.05 * i} 1 2 3 4 5 6" for i in range(8)) + "\n")
        (at / "head_hands_sixdof.csv").write_text("t,tx,ty,tz,qx,qy,qz,qw\n" + "\n".join(f"{1 + i / 30},{i},0,0,0,0,0,1" for i in range(frames)) + "\n")
        (at / "camera_params/head_param.json").write_text(json.dumps({"rgb_camera": {"intrinsic": {"fx": 500.0, "fy": 500.0, "ppx": 320.0, "ppy": 240.0, "width": 640, "height": 480}}}))
        points = {f"p{k:02d}": [0.0, float(k), 1.0] for k in range(21)}
        (at / "hands_keypoint_3d.json").write_text(json.dumps({"frames": {"1.000000": {"excluded": False, "hands": [{"is_right": True, "keypoints_3d_cam_m": points}]}, f"{1 + 1 / 30:.6f}": {"excluded": True, "hands": [{"is_right": True, "keypoints_3d_cam_m": points}]}}}))
        (at / "task_info.json").write_text(json.dumps({"task_id": "7", "name": "pick"}))
    out = str(tmp_path / "out")
    report = intake.run(spark, str(tmp_path / "in"), out)
    assert (report["sessions"], report["written"], report["frames"]) == (2, 1, 4)
    assert report["issues"] == {"error:RGB_FRAME_INDEX_NON_CONTIGUOUS": 1, "warn:DISCOVERY_MISMATCH": 2, "warn:MISSING_DEPTH_TIMESTAMPS": 2, "warn:RGB_FRAME_COUNT_MISMATCH": 1}
    table = lambda name: normal.read(spark, out, name)
    assert [(r.frame_index, r.rgb_timestamp_s, r.depth_timestamp_s) for r in table("frame_index").orderBy("frame_index").collect()][3] == (3, 1.1, None)
    assert sorted(r.tx for r in table("head_pose").collect()) == [0.0, 1.0, 2.0, 3.0]
    assert sorted(round(r.ts, 2) for r in table("imu").collect()) == [1.0, 1.05, 1.1]
    hand = table("hand_keypoints").collect()
    assert len(hand) == 1 and hand[0].valid and hand[0].hand == "right" and hand[0].points[3:6] == [0.0, 1.0, 1.0]
    assert json.loads(table("task").first().document)["name"] == "pick" and table("calibration").first().cx == 320.0
    assert table("media").first().kind == "referenced"
    assert cli.main(["ingest", str(tmp_path / "in"), "--output", out, "--even-with-errors"], spark) == 0
    assert normal.frame_counts(table("frame_index")).count() == 2
