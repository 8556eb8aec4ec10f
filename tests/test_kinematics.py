import numpy as np
import pytest

from strandweave.operators import geometry, kinematics
from strandweave.operators.kinematics import Robot, Settings, retarget, simple_hand, with_arm


def test_robot():
    hand, both = Robot(simple_hand("left")), Robot(with_arm(simple_hand("left"), "left"))
    assert (hand.dof, len(hand.arm), len(hand.hand), len(hand.tips)) == (20, 0, 20, 5)
    assert (both.dof, len(both.arm), both.links[0]) == (23, 3, "base_link") and both.joints[:3] == ["left_arm_joint1", "left_arm_joint2", "left_palm_joint"]
    assert np.allclose(both.high[:3], 1.5708) and np.allclose(hand.middle(), (hand.low + hand.high) / 2)
    assert np.allclose(both.clamp(np.full(23, 9.0)), both.high)
    rng, e = np.random.default_rng(0), 1e-6
    q = rng.uniform(both.low, both.high)
    _, p, axes = both.pose(q)
    links = [both.palm, *both.tips]
    steps = [(both.pose(q + e * d)[1][links] - both.pose(q - e * d)[1][links]) / (2 * e) for d in np.eye(23)]
    assert np.allclose(both.jacobian(links, p, axes), np.moveaxis(steps, 0, 2), atol=1e-7)
    tips, j = both.fingers(q, True)
    steps = [(both.fingers(q + e * d) - both.fingers(q - e * d)) / (2 * e) for d in np.eye(23)[both.hand]]
    assert np.allclose(j, np.moveaxis(steps, 0, 2), atol=1e-7) and np.allclose(tips, both.fingers(q))
    assert np.allclose(both.pose(np.zeros(23))[1][both.palm], [0, 0, -0.53])
    with pytest.raises(ValueError, match="root"):
        Robot('<robot><link name="a"/><link name="b"/></robot>')
    with pytest.raises(ValueError, match="no link"):
        with_arm(simple_hand("left"), "right")


def hand_of(robot, q, r, wrist, size):
    """21 points whose tips are the robot's, in a wrist's frame of its own."""
    points = np.zeros((21, 3))
    points[kinematics.MIDDLE], points[kinematics.INDEX] = [0, 0, 0.09], [0.02, 0, 0.08]
    points[list(kinematics.TIPS)] = robot.fingers(q) * size
    return points @ r.T + wrist


@pytest.mark.parametrize("arm", [False, True])
def test_retarget(spark, arm):
    urdf = with_arm(simple_hand(), "right") if arm else simple_hand()
    robot, rng, rows = Robot(urdf), np.random.default_rng(1), []
    for session in (1, 2):
        for t in range(12):
            q = robot.middle()
            q[robot.hand] += 0.15 * np.sin(0.3 * t + np.arange(20))
            r = kinematics.turn(np.array([0.0, 0.6, 0.8]), 0.1 * t)
            points = hand_of(robot, q, r, np.array([0.1, 0.01 * t, 0.3]), 0.9).ravel()
            if t == 5:
                points = np.zeros(63)
            rows.append((session, t, points.tolist(), t != 3))
    rows += [(3, 0, None, True), (None, 0, rows[0][2], True)]
    rng.shuffle(rows := [tuple(r) for r in rows])
    df = spark.createDataFrame([(None if r[0] is None else int(r[0]), int(r[1]), r[2], bool(r[3])) for r in rows], "s long, t long, points array<double>, kept boolean").repartition(3)
    found = retarget(df, "s", "t", "points", "kept", urdf, Settings(smooth=1e-6, rounds=60))
    got = {(r.s, r.t): r for r in found.collect()}
    assert len(got) == 26 and all((got[k].qpos is None) == (k[1] in (3, 5) and k[0] is not None or k[0] == 3) for k in got)
    solved = [r for r in got.values() if r.qpos and r.s]
    assert np.mean([r.error_mm for r in solved]) < 3 and all(r.within and len(r.ee) == 6 for r in solved)
    assert all((r.wrist_mm is None) != arm for r in solved)
    report = {r.s: r for r in kinematics.fit_report(found, "s").collect()}
    assert report[1].n == 10 and report[1].within == 1.0 and len(report[1].finger_mm) == 5 and 3 not in report
    assert np.isclose(report[1].max_mm, max(np.mean(r.error_mm) for r in solved if r.s == 1))


def test_fits(spark):
    rng = np.random.default_rng(4)
    r = kinematics.turn(np.array([0.0, 0.6, 0.8]), 1.1)
    rows = [(g, x.tolist(), (r @ x + 0.01 * g * rng.normal(size=3)).tolist()) for g in (0, 1) for x in rng.normal(size=(30, 3))]
    got = {x.g: x for x in geometry.fit_rotations(spark.createDataFrame(rows, "g long, a array<double>, b array<double>"), "g", "a", "b").collect()}
    for g in (0, 1):
        a, b = (np.array([x[k] for x in rows if x[0] == g]) for k in (1, 2))
        best = geometry.kabsch(a, b)
        assert np.allclose(got[g].r, best.ravel()) and np.isclose(got[g].rmse, np.sqrt((((best @ a.T).T - b) ** 2).sum(1).mean()), atol=1e-6)


def test_state(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0])], "a array<double>, b array<double>")
    s = df.select(kinematics.state({"left_wrist": F.col("a"), "right_wrist": F.col("b")}).alias("s"), kinematics.mask(F.lit(True), F.lit(None)).alias("m")).first()
    assert len(s.s) == 122 and s.s[:3] == [1.0, 2.0, 3.0] and np.isnan(s.s[3:]).all() and s.m == [True, False]
