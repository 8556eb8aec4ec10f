"""Robots as trees of joints: forward kinematics, Jacobians, and joint angles that follow a hand.

A robot is read from URDF text.  Its links are kept in an order in which each
comes after its parent, as arrays, so that a pose is one pass over them.
Retargeting works out each frame by itself, averages a session's frames in the
JVM, and then streams each session's frames in order, each solve starting from
the one before.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.operators.geometry import kabsch
from strandweave.operators.segment import folded

#: Of the 21 points of a hand the wrist, the first joints of index and middle finger, and the tips.
WRIST, INDEX, MIDDLE, TIPS = 0, 5, 9, (4, 8, 12, 16, 20)
#: The parts of a state vector and their widths, 122 in all: a wrist's place and turn, turns of 15 joints, shape.
STATE = {"left_wrist": 3, "left_orient": 3, "left_pose": 45, "left_betas": 10, "right_wrist": 3, "right_orient": 3, "right_pose": 45, "right_betas": 10}
#: A stand-in for an arm: joint, axis, shift, and the limit of all.
ARM = [("arm_joint1", "0 1 0", "0 0 0"), ("arm_joint2", "1 0 0", "0 0 -0.28"), ("palm_joint", "0 1 0", "0 0 -0.25")]
ARM_LIMIT = 1.5708


def numbers(element: ET.Element | None, name: str, default: str) -> np.ndarray:
    return np.array((default if element is None else element.get(name, default)).split(), float)


def turn(axis: np.ndarray, angle: float) -> np.ndarray:
    """Rodrigues' rotation about a unit axis."""
    x, y, z = axis
    k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    return np.eye(3) + np.sin(angle) * k + (1 - np.cos(angle)) * (k @ k)


def upright(rpy: np.ndarray) -> np.ndarray:
    """Roll, pitch and yaw about fixed axes."""
    x, y, z = np.eye(3)
    return turn(z, rpy[2]) @ turn(y, rpy[1]) @ turn(x, rpy[0])


class Robot:
    """A tree of links; ``q`` holds the angles of the revolute joints in the order of the text, other joints are fixed.

    ``palm``: the link whose name ends with palm_link; ``tips``: those that
    end with _tip_link, by name.  Joints from the root to the palm are the
    arm's, all others the hand's.
    """

    def __init__(self, urdf: str):
        top = ET.fromstring(urdf)
        names = [x.get("name") for x in top.findall("link")]
        joints = {j.find("child").get("link"): j for j in top.findall("joint")}
        roots = [n for n in names if n not in joints]
        if len(roots) != 1:
            raise ValueError(f"a robot has one root link, not {roots}")
        moving = [j.get("name") for j in top.findall("joint") if j.get("type") == "revolute"]
        order, held = [], {roots[0]}
        children: dict[str, list[str]] = {}
        for child, j in joints.items():
            children.setdefault(j.find("parent").get("link"), []).append(child)
        queue = list(roots)
        for link in queue:  # grows while it is read
            order.append(link)
            for child in children.get(link, []):
                if child in held:
                    raise ValueError(f"{child} has two parents")
                held.add(child)
                queue.append(child)
        at = {n: i for i, n in enumerate(order)}
        self.links, self.joints, self.dof = order, moving, len(moving)
        self.parent, self.column = np.full(len(order), -1), np.full(len(order), -1)
        self.shift, self.base, self.axis = np.zeros((len(order), 3)), np.tile(np.eye(3), (len(order), 1, 1)), np.zeros((len(order), 3))
        self.low, self.high = np.zeros(self.dof), np.zeros(self.dof)
        self.moves = np.zeros((len(order), self.dof), bool)  # which joints move a link
        for i, name in enumerate(order[1:], 1):
            j = joints[name]
            self.parent[i] = at[j.find("parent").get("link")]
            self.moves[i] = self.moves[self.parent[i]]
            self.shift[i], self.base[i] = numbers(j.find("origin"), "xyz", "0 0 0"), upright(numbers(j.find("origin"), "rpy", "0 0 0"))
            axis = numbers(j.find("axis"), "xyz", "0 0 1")
            self.axis[i] = axis / max(np.linalg.norm(axis), 1e-12)
            if j.get("type") == "revolute":
                k = self.column[i] = moving.index(j.get("name"))
                self.moves[i, k] = True
                self.low[k], self.high[k] = (numbers(j.find("limit"), side, "0")[0] for side in ("lower", "upper"))

        palms = [i for i, n in enumerate(order) if n.endswith("palm_link")]
        self.palm = palms[0] if len(palms) == 1 else None
        self.tips = [at[n] for n in sorted(order) if n.endswith("_tip_link")]
        arm = self.moves[self.palm] if self.palm is not None else np.zeros(self.dof, bool)
        self.arm, self.hand = np.flatnonzero(arm), np.flatnonzero(~arm)

    def clamp(self, q: np.ndarray) -> np.ndarray:
        return np.clip(q, self.low, self.high)

    def middle(self) -> np.ndarray:
        return (self.low + self.high) / 2

    def pose(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each link the rotation and place in the root's frame, and its joint's axis there."""
        n = len(self.links)
        r, p, axes = np.empty((n, 3, 3)), np.empty((n, 3)), np.zeros((n, 3))
        r[0], p[0] = np.eye(3), 0.0
        for i in range(1, n):
            up = self.parent[i]
            p[i] = p[up] + r[up] @ self.shift[i]
            r[i] = r[up] @ self.base[i]
            if self.column[i] >= 0:
                axes[i] = r[i] @ self.axis[i]
                r[i] = r[i] @ turn(self.axis[i], q[self.column[i]])
        return r, p, axes

    def jacobian(self, links: list[int], p: np.ndarray, axes: np.ndarray) -> np.ndarray:
        """How the places of ``links`` change with each angle: (links, 3, dof)."""
        own = np.flatnonzero(self.column >= 0)
        at = own[np.argsort(self.column[own])]  # the links that the joints carry
        arms = p[links][:, None, :] - p[at][None, :, :]
        return np.where(self.moves[links][:, None, :], np.cross(axes[at][None], arms).transpose(0, 2, 1), 0.0)

    def fingers(self, q: np.ndarray, with_jacobian: bool = False):
        """The tips in the palm's frame, and how they change with the hand's angles."""
        r, p, axes = self.pose(q)
        back = r[self.palm].T
        tips = (p[self.tips] - p[self.palm]) @ r[self.palm]
        return (tips, np.einsum("ij,tjk->tik", back, self.jacobian(self.tips, p, axes))[:, :, self.hand]) if with_jacobian else tips

    def span(self) -> float:
        """The mean distance of the tips from the palm in the middle pose, for the size of the hand."""
        return float(np.linalg.norm(self.fingers(self.middle()), axis=1).mean())


def damped(at, q: np.ndarray, low: np.ndarray, high: np.ndarray, near: np.ndarray, weight: float, rounds: int, damping: float = 1e-3, tolerance: float = 0.0) -> np.ndarray:
    """Levenberg-Marquardt within limits; ``at(q)`` gives residuals and their Jacobian.

    Angles far from ``near`` cost ``weight`` times the square.  A step that
    helps halves the damping, another one takes it times four; a gain under
    ``tolerance`` ends it.
    """
    n, root = len(q), np.sqrt(weight)

    def full(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e, j = at(q)
        return np.r_[e, root * (q - near)], np.r_[j, root * np.eye(n)]

    q = np.clip(q, low, high)
    (e, j), mu = full(q), damping
    for _ in range(rounds):
        new = np.clip(q - np.linalg.solve(j.T @ j + mu * np.eye(n), j.T @ e), low, high)
        e2, j2 = full(new)
        gain = e @ e - e2 @ e2
        if gain > 0:
            q, e, j, mu = new, e2, j2, max(mu / 2, 1e-9)
            if gain < tolerance:
                break
        else:
            mu = min(mu * 4, 1e6)
    return q


@dataclass(frozen=True)
class Settings:
    """How a hand is followed; the finger map names the human finger (thumb first) of each of the robot's."""

    fingers: tuple[int, ...] = (0, 1, 2, 3, 4)
    smooth: float = 0.01
    rounds: int = 30
    arm_rounds: int = 40
    scale: float | None = None
    tolerance: float = field(default=1e-8)


def hand_frame(points: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The wrist's axes (columns: across, normal, along the middle finger) and place; nothing if points coincide."""
    wrist = points[WRIST]
    z = points[MIDDLE] - wrist
    if not np.isfinite(z).all() or np.linalg.norm(z) < 1e-6:
        return None
    z = z / np.linalg.norm(z)
    x = points[INDEX] - wrist
    x = x - (x @ z) * z
    if not np.isfinite(x).all() or np.linalg.norm(x) < 1e-6:
        return None
    x = x / np.linalg.norm(x)
    return np.column_stack([x, np.cross(z, x), z]), wrist


def axis_angle(r: np.ndarray) -> np.ndarray:
    angle = np.arccos(np.clip((np.trace(r) - 1) / 2, -1, 1))
    if angle < 1e-8:
        return np.zeros(3)
    return np.array([r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1]]) / (2 * np.sin(angle)) * angle


def described(df: DataFrame, points: str, kept: str, settings: Settings = Settings()) -> DataFrame:
    """Adds ``tips`` (15 numbers in the wrist's frame, in the robot's order), ``wrist`` (3) and ``turned`` (3); null if not kept or degenerate."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for flat, use in zip(b.column(points).to_pylist(), b.column(kept).to_pylist(), strict=True):
                frame = hand_frame(np.array(flat, float).reshape(-1, 3)) if use and flat else None
                if frame is None:
                    rows.append((None, None, None))
                    continue
                hand, (r, wrist) = np.array(flat, float).reshape(-1, 3), frame
                tips = (hand[[TIPS[k] for k in settings.fingers]] - wrist) @ r
                rows.append((tips.ravel().tolist(), wrist.tolist(), axis_angle(r).tolist()) if np.isfinite(tips).all() else (None, None, None))
            kind = pa.list_(pa.float64())
            columns = zip(*rows, strict=True) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, kind) for c in columns]], names=[*b.schema.names, "tips", "wrist", "turned"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(add, f"{columns}, tips array<double>, wrist array<double>, turned array<double>")


def calibrated(frames: DataFrame, by: str) -> DataFrame:
    """by, n, layout (the mean of ``tips``) and centre (the mean of ``wrist``) of each session, by sums in the JVM."""
    mean = lambda c, n: F.array(*[F.avg(F.col(c)[k]) for k in range(n)])
    return frames.where("tips is not null").groupBy(by).agg(F.count(F.lit(1)).alias("n"), mean("tips", 15).alias("layout"), mean("wrist", 3).alias("centre"))


def retarget(df: DataFrame, by: str, order: str, points: str, kept: str, urdf: str, settings: Settings = Settings()) -> DataFrame:
    """Joint angles that follow a hand: by, order, qpos, ee (wrist's place and turn), error_mm, wrist_mm, within.

    ``points`` holds 21 points, flat.  Each of the session's fingers is scaled
    to the robot's and their mean turned onto its middle pose; then each frame
    is solved from the one before.  The arm, if the robot has one, takes the
    palm to the wrist as far as it goes; ``wrist_mm`` is what is left.  Frames
    not kept or degenerate have null; without any in a session all have.
    """
    frames = described(df.select(by, order, points, kept), points, kept, settings).select(by, order, "tips", "wrist", "turned")
    known = calibrated(frames, by).select(F.col(by).alias("_by"), "layout", "centre")
    rows = frames.join(known, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")

    def start() -> dict:
        return {"robot": Robot(urdf)}

    def step(state: dict, tips, wrist, turned, layout, centre) -> tuple[dict, tuple]:
        if tips is None:
            return state, (None,) * 5
        robot: Robot = state["robot"]
        if "q" not in state:
            own, human = robot.fingers(robot.middle()), np.reshape(layout, (5, 3))
            length = np.linalg.norm(human, axis=1)
            scale = np.where(length > 1e-6, np.linalg.norm(own, axis=1) / np.maximum(length, 1e-12), 1.0)
            scale = np.full(5, settings.scale) if settings.scale is not None else scale
            state |= {"scale": scale[:, None], "turn": kabsch(scale[:, None] * human, own), "q": robot.middle()}
            state["origin"] = np.array(centre) - robot.pose(robot.middle())[1][robot.palm]
        goal = state["scale"] * (np.reshape(tips, (5, 3)) @ state["turn"].T)
        q = state["q"].copy()

        def hand(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            q[robot.hand] = x
            at, j = robot.fingers(q, True)
            return (at - goal).ravel(), j.reshape(15, -1)

        best = damped(hand, q[robot.hand], robot.low[robot.hand], robot.high[robot.hand], state["q"][robot.hand], settings.smooth, settings.rounds, tolerance=settings.tolerance)
        q[robot.hand] = best
        left = None
        if len(robot.arm):
            target = np.array(wrist) - state["origin"]

            def palm(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                q[robot.arm] = x
                _, p, axes = robot.pose(q)
                return p[robot.palm] - target, robot.jacobian([robot.palm], p, axes)[0][:, robot.arm]

            q[robot.arm] = damped(palm, q[robot.arm], robot.low[robot.arm], robot.high[robot.arm], state["q"][robot.arm], settings.smooth, settings.arm_rounds)
            left = float(np.linalg.norm(robot.pose(q)[1][robot.palm] - target) * 1000)
        state["q"] = q
        error = np.linalg.norm(robot.fingers(q) - goal, axis=1) * 1000
        within = bool(((q >= robot.low - 1e-6) & (q <= robot.high + 1e-6)).all())
        return state, (q.tolist(), [*wrist, *turned], error.tolist(), left, within)

    out = "qpos array<double>, ee array<double>, error_mm array<double>, wrist_mm double, within boolean"
    return folded(rows, by, [order], ["tips", "wrist", "turned", "layout", "centre"], out, start, step).select(by, order, "qpos", "ee", "error_mm", "wrist_mm", "within")


def fit_report(found: DataFrame, by: str) -> DataFrame:
    """Of each session the number of solved frames, mean and largest error of the tips, share within the limits, mean rest of the arm, and error by finger."""
    mean = F.aggregate("error_mm", F.lit(0.0), lambda s, x: s + x) / F.size("error_mm")
    return found.where("qpos is not null").groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(mean).alias("mean_mm"), F.max(mean).alias("max_mm"), F.avg(F.col("within").cast("int")).alias("within"),
        F.avg("wrist_mm").alias("wrist_mm"), F.array(*[F.avg(F.col("error_mm")[k]) for k in range(5)]).alias("finger_mm"),
    )


def placed(df: DataFrame, q: str, urdf: str, link: str) -> DataFrame:
    """Adds ``place`` (three numbers) and ``turned`` (nine) of ``link`` for the joint angles ``q``; null for null."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        robot = Robot(urdf)
        at = robot.links.index(link)
        for b in batches:
            found = [robot.pose(np.array(x, float)) if x is not None else None for x in b.column(q).to_pylist()]
            kind = pa.list_(pa.float64())
            place = pa.array([None if x is None else x[1][at].tolist() for x in found], kind)
            rotation = pa.array([None if x is None else x[0][at].ravel().tolist() for x in found], kind)
            yield pa.RecordBatch.from_arrays([*b.columns, place, rotation], names=[*b.schema.names, "place", "turned"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(add, f"{columns}, place array<double>, turned array<double>")


def state(parts: dict[str, Column]) -> Column:
    """The state vector of both hands: STATE's parts one after another; a missing one, or one of another width, is NaN."""
    nan = lambda n: F.array_repeat(F.lit(float("nan")), n)
    sized = lambda c, n: F.when(F.size(c) == n, c.cast("array<double>")).otherwise(nan(n))
    return F.flatten(F.array(*[sized(parts[k], n) if k in parts else nan(n) for k, n in STATE.items()]))


def mask(left: Column, right: Column) -> Column:
    """Which hands a state holds."""
    return F.array(F.coalesce(left, F.lit(False)), F.coalesce(right, F.lit(False)))


def with_arm(urdf: str, side: str) -> str:
    """A hand's URDF with a stand-in arm of three joints before its palm."""
    top, palm = ET.fromstring(urdf), f"{side}_palm_link"
    if palm not in [x.get("name") for x in top.findall("link")]:
        raise ValueError(f"there is no link {palm}")
    links = ["base_link", f"{side}_arm_link1", f"{side}_arm_link2", palm]
    for k, name in enumerate(links[:-1]):
        top.insert(k, ET.Element("link", name=name))
    first = next((k for k, x in enumerate(top) if x.tag == "joint"), len(top))
    for k, (name, axis, shift) in enumerate(ARM):
        joint = ET.Element("joint", name=f"{side}_{name}", type="revolute")
        for tag, values in (("origin", {"xyz": shift, "rpy": "0 0 0"}), ("parent", {"link": links[k]}), ("child", {"link": links[k + 1]}), ("axis", {"xyz": axis}), ("limit", {"lower": str(-ARM_LIMIT), "upper": str(ARM_LIMIT)})):
            ET.SubElement(joint, tag, values)
        top.insert(first + k, joint)
    return ET.tostring(top, encoding="unicode")


def simple_hand(side: str = "right", segment: float = 0.03) -> str:
    """URDF of a hand of five fingers with four joints each, for tests and demonstrations."""
    parts = [f'<link name="{side}_palm_link"/>']
    for f in range(1, 6):
        links = [f"{side}_palm_link", *[f"{side}_finger{f}_link{k}" for k in range(1, 5)], f"{side}_finger{f}_tip_link"]
        for k in range(5):
            origin = f"{0.02 * (f - 3)} 0 0.06" if k == 0 else f"0 0 {segment}"
            kind = "revolute" if k < 4 else "fixed"
            axis, low, high = ("0 1 0", -0.4, 0.4) if k == 0 else ("1 0 0", -0.1, 1.6)
            parts.append(f'<link name="{links[k + 1]}"/>')
            parts.append(
                f'<joint name="{side}_f{f}_j{k + 1}" type="{kind}"><origin xyz="{origin}" rpy="0 0 0"/><parent link="{links[k]}"/><child link="{links[k + 1]}"/>'
                f'<axis xyz="{axis}"/><limit lower="{low}" upper="{high}"/></joint>'
            )
    return f'<robot name="{side}">{"".join(parts)}</robot>'
