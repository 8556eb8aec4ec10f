"""Queries over vector columns: frames, rotations, projections, learning samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandweave.functions import rotation as R
from strandweave.operators import geometry, kinematics
from strandweave.operators.segment import ordered
from strandweave.plans.registry import query
from strandweave.plans.sequences import EV, BY, ORDER, events
from strandweave.sources.tables import micros, table

_E = "e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


def part(first: int, n: int = 3) -> Column:
    return F.slice("v", first, n)


def spread(c: Column, names: str, digits: int = 6) -> list[Column]:
    return [F.round(c[i], digits).alias(n) for i, n in enumerate(names.split())]


_Q = f"""{_E}, q AS (SELECT vec_id, v[1] AS w, v[2] AS x, v[3] AS y, v[4] AS z, v[1] * v[1] + v[2] * v[2] + v[3] * v[3] + v[4] * v[4] AS s, v FROM e),
m AS (SELECT vec_id, v, 1 - 2 / s * (y * y + z * z) AS m0, 2 / s * (x * y - z * w) AS m1, 2 / s * (x * z + y * w) AS m2, 2 / s * (x * y + z * w) AS m3, 1 - 2 / s * (x * x + z * z) AS m4,
  2 / s * (y * z - x * w) AS m5, 2 / s * (x * z - y * w) AS m6, 2 / s * (y * z + x * w) AS m7, 1 - 2 / s * (x * x + y * y) AS m8 FROM q)"""


@query(f"""WITH {_Q} SELECT vec_id, round(m0, 5) AS m0, round(m1, 5) AS m1, round(m2, 5) AS m2, round(m3, 5) AS m3, round(m4, 5) AS m4, round(m5, 5) AS m5, round(m6, 5) AS m6, round(m7, 5) AS m7, round(m8, 5) AS m8,
  round(acos(greatest(-1, least(1, (m0 + m4 + m8 - 1) / 2))), 5) AS angle, true AS same FROM m""")
def rotation_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quaternion to matrix, to rotation vector, and back to the matrix."""
    rows = vectors(spark, sf_dir).select("vec_id", R.matrix_of_quaternion(part(1, 4)).alias("m"))
    rows = rows.withColumn("r", R.axis_angle_of_matrix(F.col("m"))).withColumn("back", R.matrix_of_axis_angle(F.col("r")))
    same = F.array_max(F.zip_with("m", "back", lambda a, b: F.abs(a - b))) < 1e-4
    return rows.select("vec_id", *spread(F.col("m"), "m0 m1 m2 m3 m4 m5 m6 m7 m8", 5), F.round(R.angle_of_matrix(F.col("m")), 5).alias("angle"), same.alias("same"))


@query(f"""WITH {_Q} SELECT vec_id, round(m0 * v[8] + m1 * v[9] + m2 * v[10] + v[5], 6) AS x, round(m3 * v[8] + m4 * v[9] + m5 * v[10] + v[6], 6) AS y, round(m6 * v[8] + m7 * v[9] + m8 * v[10] + v[7], 6) AS z, true AS back FROM m""")
def rigid_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera to world, and back again."""
    rows = vectors(spark, sf_dir).select("vec_id", R.matrix_of_quaternion(part(1, 4)).alias("m"), part(5).alias("t"), part(8).alias("p"))
    rows = rows.withColumn("w", R.to_world(F.col("m"), F.col("t"), F.col("p"))).withColumn("c", R.to_camera(F.col("m"), F.col("t"), F.col("w")))
    return rows.select("vec_id", *spread(F.col("w"), "x y z"), (F.array_max(F.zip_with("p", "c", lambda a, b: F.abs(a - b))) < 1e-9).alias("back"))


@query(f"""WITH {_E} SELECT vec_id, CASE WHEN v[3] > 1e-3 THEN round(500 * v[1] / v[3] + 320, 4) ELSE 'nan'::DOUBLE END AS u, CASE WHEN v[3] > 1e-3 THEN round(500 * v[2] / v[3] + 240, 4) ELSE 'nan'::DOUBLE END AS v FROM e""")
def pinhole_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("vec_id", *spread(R.projected(part(1), 500.0, 500.0, 320.0, 240.0), "u v", 4))


@query("""WITH p AS (SELECT vec_id, i - 1 AS i, embedding[i]::DOUBLE AS d FROM embeddings, range(1, 65, 3) r(i)) SELECT vec_id, i, round((i % 8 - 4) * d / 6, 6) AS x, round((i // 8 - 4) * d / 6, 6) AS y, round(d, 6) AS z FROM p WHERE d > 0""")
def backproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third pixel of 8 x 8 depth images; pixels without a depth go."""
    rows = vectors(spark, sf_dir).select("vec_id", F.posexplode("v").alias("i", "d")).where("i % 3 = 0").withColumn("i", F.col("i").cast("long"))
    found = rows.select("vec_id", "i", R.back_projected(F.col("i") % 8, F.expr("i div 8"), F.col("d"), 6.0, 6.0, 4.0, 4.0).alias("p"))
    return found.where("p is not null").select("vec_id", "i", *spread(F.col("p"), "x y z"))


@query(f"""WITH {_E}, a AS (SELECT vec_id, v[7] - v[1] AS zx, v[8] - v[2] AS zy, v[9] - v[3] AS zz, v[4] - v[1] AS tx, v[5] - v[2] AS ty, v[6] - v[3] AS tz FROM e),
b AS (SELECT vec_id, zx / n AS zx, zy / n AS zy, zz / n AS zz, tx, ty, tz FROM (SELECT *, sqrt(zx * zx + zy * zy + zz * zz) AS n FROM a)),
c AS (SELECT *, tx - k * zx AS xx, ty - k * zy AS xy, tz - k * zz AS xz FROM (SELECT *, tx * zx + ty * zy + tz * zz AS k FROM b)),
d AS (SELECT vec_id, zx, zy, zz, xx / n AS xx, xy / n AS xy, xz / n AS xz FROM (SELECT *, sqrt(xx * xx + xy * xy + xz * xz) AS n FROM c))
SELECT vec_id, round(xx, 5) AS m0, round(zy * xz - zz * xy, 5) AS m1, round(zx, 5) AS m2, round(xy, 5) AS m3, round(zz * xx - zx * xz, 5) AS m4, round(zy, 5) AS m5, round(xz, 5) AS m6, round(zx * xy - zy * xx, 5) AS m7, round(zz, 5) AS m8 FROM d""")
def wrist_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("vec_id", R.wrist_frame(part(1), part(4), part(7)).alias("m")).select("vec_id", *spread(F.col("m"), "m0 m1 m2 m3 m4 m5 m6 m7 m8", 5))


@query(f"""WITH {_E} SELECT vec_id, round(degrees(2 * atan(320 / (400 + 100 * v[1]))), 6) AS fov_x, round((400 + 100 * v[1]) * 320 / 640.0, 6) AS fx_scaled, CASE WHEN v[2] > 0 THEN round(v[2] * 500, 6) ELSE round(320 / tan(radians(30)), 6) END AS fx_or_default FROM e""")
def fov_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field of view, focal length at half the resolution, and that of 60 degrees where none is known."""
    fx = 400 + 100 * F.col("v")[0]
    known = F.when(F.col("v")[1] > 0, F.round(F.col("v")[1] * 500, 6)).otherwise(F.round(320 / F.tan(F.radians(F.lit(30.0))), 6))
    return vectors(spark, sf_dir).select("vec_id", F.round(F.degrees(2 * F.atan(320 / fx)), 6).alias("fov_x"), F.round(fx * 320 / 640.0, 6).alias("fx_scaled"), known.alias("fx_or_default"))


@query(f"""WITH {_E}, n AS (SELECT label, sqrt(v[1] * v[1] + v[2] * v[2] + v[3] * v[3]) AS a, sqrt(v[4] * v[4] + v[5] * v[5] + v[6] * v[6]) AS b FROM e) SELECT label, round(avg(a) / avg(b), 6) AS ratio FROM n GROUP BY label""")
def span_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir).select("label", R.norm(part(1)).alias("a"), R.norm(part(4)).alias("b"))
    return rows.groupBy("label").agg(F.round(F.avg("a") / F.avg("b"), 6).alias("ratio"))


@query(f"""WITH {_E} SELECT vec_id, round(cos(v[3]) * cos(v[2]), 6) AS m0, round(cos(v[3]) * sin(v[2]) * sin(v[1]) - sin(v[3]) * cos(v[1]), 6) AS m1, round(cos(v[3]) * sin(v[2]) * cos(v[1]) + sin(v[3]) * sin(v[1]), 6) AS m2,
  round(sin(v[3]) * cos(v[2]), 6) AS m3, round(sin(v[3]) * sin(v[2]) * sin(v[1]) + cos(v[3]) * cos(v[1]), 6) AS m4, round(sin(v[3]) * sin(v[2]) * cos(v[1]) - cos(v[3]) * sin(v[1]), 6) AS m5,
  round(-sin(v[2]), 6) AS m6, round(cos(v[2]) * sin(v[1]), 6) AS m7, round(cos(v[2]) * cos(v[1]), 6) AS m8 FROM e""")
def rpy_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = R.matrix_of_rpy(F.col("v")[0], F.col("v")[1], F.col("v")[2])
    return vectors(spark, sf_dir).select("vec_id", m.alias("m")).select("vec_id", *spread(F.col("m"), "m0 m1 m2 m3 m4 m5 m6 m7 m8"))


@query()
def kabsch_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir).select("label", part(1).alias("a"), part(4).alias("b"))
    return geometry.fit_rotations(rows, "label", "a", "b").select("label", *spread(F.col("r"), "r0 r1 r2 r3 r4 r5 r6 r7 r8", 4), F.round("rmse", 4).alias("rmse"))


@query(f"""WITH {_E} SELECT label, count(*) AS n, round(sum(v[1] * v[4]), 5) AS c0, round(sum(v[1] * v[5]), 5) AS c1, round(sum(v[1] * v[6]), 5) AS c2, round(sum(v[2] * v[4]), 5) AS c3, round(sum(v[2] * v[5]), 5) AS c4,
  round(sum(v[2] * v[6]), 5) AS c5, round(sum(v[3] * v[4]), 5) AS c6, round(sum(v[3] * v[5]), 5) AS c7, round(sum(v[3] * v[6]), 5) AS c8, round(sum(list_sum(list_transform(v[1:6], lambda x: x * x))), 5) AS spread FROM e GROUP BY label""")
def rotation_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums from which kabsch_fit follows."""
    rows = vectors(spark, sf_dir).select("label", part(1).alias("a"), part(4).alias("b"))
    return geometry.covariance(rows, "label", "a", "b").select("label", "n", *spread(F.col("c"), "c0 c1 c2 c3 c4 c5 c6 c7 c8", 5), F.round("spread", 5).alias("spread"))


@query(f"""WITH {_E}, q AS (SELECT vec_id, v[1] AS a, v[2] AS b, v[3] AS c FROM e),
s AS (SELECT vec_id, a, b + 0.3 AS b, c, cos(c) * 0.3 AS z3, -sin(c) * 0.3 AS y3, cos(0.3) AS k FROM q)
SELECT vec_id, round(cos(a) * (0.5 + sin(b) * (0.4 + z3)) - sin(a) * y3, 6) AS x, round(sin(a) * (0.5 + sin(b) * (0.4 + z3)) + cos(a) * y3, 6) AS y, round(cos(b) * (0.4 + z3), 6) AS z FROM s""")
def urdf_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the end of an arm of three joints, about z, y (tilted by 0.3) and x, lies for the vectors' first three numbers as angles."""
    rows = vectors(spark, sf_dir).select("vec_id", part(1).alias("q"))
    found = kinematics.placed(rows, "q", ARM, "end")
    return found.select("vec_id", *spread(F.col("place"), "x y z"))


ARM = """<robot name="arm"><link name="base"/><link name="a"/><link name="b"/><link name="c"/><link name="end"/>
<joint name="j1" type="revolute"><parent link="base"/><child link="a"/><axis xyz="0 0 1"/><limit lower="-3" upper="3"/></joint>
<joint name="j2" type="revolute"><origin xyz="0.5 0 0" rpy="0 0.3 0"/><parent link="a"/><child link="b"/><axis xyz="0 2 0"/><limit lower="-3" upper="3"/></joint>
<joint name="j3" type="revolute"><origin xyz="0 0 0.4"/><parent link="b"/><child link="c"/><axis xyz="1 0 0"/><limit lower="-3" upper="3"/></joint>
<joint name="tip" type="fixed"><origin xyz="0 0 0.3"/><parent link="c"/><child link="end"/></joint></robot>"""


def hands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as hands of 21 points near an open one; every seventh isn't kept."""
    finger = F.floor((F.col("i") - 1) / 4)
    rest = F.when(F.col("i") == 0, F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0))).otherwise(F.array((finger - 2) * 0.02, F.lit(0.0), 0.06 + 0.03 * ((F.col("i") - 1) % 4)))
    rows = vectors(spark, sf_dir).select("vec_id", "label", "v", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("i"))
    near = F.transform(rest, lambda x, k: x + 0.002 * F.get("v", (3 * F.col("i") + k) % 60))
    return rows.groupBy("label", "vec_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", near.alias("p")))), lambda x: x["p"])).alias("points")).withColumn("kept", F.col("vec_id") % 7 != 0)


@query("SELECT label, vec_id, vec_id % 7 = 0 AS skipped, CASE WHEN vec_id % 7 != 0 THEN true END AS within, CASE WHEN vec_id % 7 != 0 THEN true END AS near FROM embeddings")
def fk_ik(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joints of a robot's hand that follow the hands; all lie within their limits and bring the tips within 2 cm."""
    found = kinematics.retarget(hands(spark, sf_dir), "label", "vec_id", "points", "kept", kinematics.simple_hand())
    return found.select("label", "vec_id", F.isnull("qpos").alias("skipped"), "within", (F.array_max("error_mm") < 20).alias("near"))


@query()
def overlay_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir).select("vec_id", part(1, 15).alias("a"), part(16, 15).alias("b"))
    return geometry.similarity_residuals(rows, "vec_id", "a", "b", 5).withColumn("residual", F.round("residual", 5))


@query(f"""WITH {_E} SELECT vec_id, 122 AS width, vec_id % 2 = 0 AS left_kept, vec_id % 3 = 0 AS right_kept, round(v[1] + 2 * v[2], 6) AS head, round(v[61] + v[61], 6) AS betas FROM e""")
def state_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of 122 numbers from both hands' places, turns, poses and shapes, with a mask."""
    side = lambda k, n, first: F.slice("v", first + k, n)
    parts = {f"{name}_{what}": side(k, n, first) for k, name in enumerate(("left", "right")) for what, n, first in (("wrist", 3, 1), ("orient", 3, 4), ("pose", 45, 7), ("betas", 10, 52))}
    rows = vectors(spark, sf_dir).select("vec_id", kinematics.state(parts).alias("s"), kinematics.mask(F.col("vec_id") % 2 == 0, F.col("vec_id") % 3 == 0).alias("m"))
    return rows.select("vec_id", F.size("s").alias("width"), F.col("m")[0].alias("left_kept"), F.col("m")[1].alias("right_kept"), F.round(F.col("s")[0] + 2 * F.col("s")[1], 6).alias("head"), F.round(F.col("s")[60] + F.col("s")[120], 6).alias("betas"))


@query(f"""WITH {_E}, f AS (SELECT vec_id, label, unnest(range(5)) AS finger, v FROM e), g AS (SELECT finger, sqrt((v[3 * finger + 1] - v[3 * finger + 16]) ** 2 + (v[3 * finger + 2] - v[3 * finger + 17]) ** 2 + (v[3 * finger + 3] - v[3 * finger + 18]) ** 2) AS d FROM f)
SELECT finger, round(avg(d) * 1000, 4) AS mm FROM g GROUP BY finger""")
def fit_error_by_finger(spark: SparkSession, sf_dir: str) -> DataFrame:
    fingers = F.array(*[F.struct(F.lit(k).cast("long").alias("finger"), R.norm(R.minus(part(3 * k + 1), part(3 * k + 16))).alias("d")) for k in range(5)])
    rows = vectors(spark, sf_dir).select(F.inline(fingers))
    return rows.groupBy("finger").agg(F.round(F.avg("d") * 1000, 4).alias("mm"))


@query("""SELECT vec_id, label % 5 != 0 AS complete, CASE WHEN label % 5 != 0 THEN round(embedding[1]::DOUBLE + embedding[4]::DOUBLE + embedding[7]::DOUBLE, 5) END AS sum_x FROM embeddings""")
def keypoint_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named points gathered in a fixed order; nothing if one is missing, as the third is here in every fifth label."""
    names = ["wrist", "index", "middle"]
    points = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(part(1), part(4), part(7)))
    there = F.map_filter(points, lambda k, _: (F.col("label") % 5 != 0) | (k != "middle"))
    flat = F.flatten(F.transform(F.array(*map(F.lit, names)), lambda n: there[n]))
    rows = vectors(spark, sf_dir).select("vec_id", F.forall(F.array(*map(F.lit, names)), lambda n: F.map_contains_key(there, n)).alias("complete"), flat.alias("p"))
    return rows.select("vec_id", "complete", F.when(F.col("complete"), F.round(F.col("p")[0] + F.col("p")[3] + F.col("p")[6], 5)).alias("sum_x"))


@query("SELECT vec_id, CASE WHEN label % 4 = 0 THEN 'nan'::DOUBLE ELSE round(embedding[1]::DOUBLE, 6) END AS first, 64 AS width FROM embeddings")
def nan_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the wrong width (here those of every fourth label) become NaN of the right one."""
    v = F.when(F.col("label") % 4 == 0, F.slice("v", 1, 10)).otherwise(F.col("v"))
    rows = vectors(spark, sf_dir).select("vec_id", v.alias("v"))
    rows = rows.select("vec_id", F.when(F.size("v") == 64, F.col("v")).otherwise(F.array_repeat(F.lit(float("nan")), 64)).alias("v"))
    return rows.select("vec_id", F.round(F.col("v")[0], 6).alias("first"), F.size("v").alias("width"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE trunc(epoch_us(ts) / 1e6 * 1e3)::BIGINT * 1000000 END AS ts_ns FROM events")
def ns_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds to whole milliseconds in nanoseconds by cutting; missing ones are 0."""
    ms = (micros("ts") / 1e6 * 1e3).cast("long") * 1_000_000
    return table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", F.lit(0).cast("long")).otherwise(ms).alias("ts_ns"))


@query(f"WITH {EV}, n AS (SELECT *, max(position) OVER (PARTITION BY user_id) AS last FROM ev) SELECT event_id, position > last - 5 AND event_type != 'view' AS excluded FROM n")
def tail_toggle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("position", F.row_number().over(ordered(BY, ORDER)) - 1)
    tail = F.col("position") > F.max("position").over(Window.partitionBy("user_id")) - 5
    return rows.select("event_id", F.when(F.lit(True), tail & (F.col("event_type") != "view")).otherwise(False).alias("excluded"))


@query("SELECT event_id FROM events WHERE event_type != 'error' AND event_id % 13 != 0")
def finite_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose whole vector is finite, of ones with a NaN for errors and an infinity in every thirteenth."""
    x = F.when(F.col("event_type") == "error", F.lit(float("nan"))).when(F.col("event_id") % 13 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    finite = F.forall("v", lambda e: ~F.isnan(e) & (F.abs(e) < float("inf")))
    return table(spark, sf_dir, "events").select("event_id", F.array(x, F.col("value")).alias("v")).where(finite).select("event_id")


@query("""WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS c, lead(list_transform(embedding, lambda x: x::DOUBLE)) OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings)
SELECT vec_id, round(coalesce(n[1] - c[1], 0), 6) AS dx, round(coalesce(n[2] - c[2], 0), 6) AS dy, round(coalesce(n[3] - c[3], 0), 6) AS dz, round(list_sum(list_transform(coalesce(n, c)[7:12], lambda x: x)), 5) AS pose_sum, n IS NULL AS last FROM n""")
def state_delta_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions from states: the step in position, and the next pose; none and its own at the end."""
    rows = vectors(spark, sf_dir).withColumn("n", F.lead("v").over(ordered(["label"], ["vec_id"])))
    step = F.zip_with(F.slice(F.coalesce("n", "v"), 1, 3), F.slice("v", 1, 3), lambda a, b: a - b)
    pose = F.aggregate(F.slice(F.coalesce("n", "v"), 7, 6), F.lit(0.0), lambda s, x: s + x)
    return rows.select("vec_id", *spread(step, "dx dy dz"), F.round(pose, 5).alias("pose_sum"), F.col("n").isNull().alias("last"))


@query("""WITH n AS (SELECT conv_id, turn, role, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n, list(length(text)) OVER (w ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING) AS f FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, array_to_string(list_transform(range(4), lambda k: f[least(k, len(f) - 1) + 1]), ',') AS chunk, array_to_string(list_transform(range(4), lambda k: CASE WHEN k >= len(f) THEN 1 ELSE 0 END), '') AS pad FROM n WHERE i < n - 1""")
def future_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next four rows of each row that has one, the last of them held beyond the end and marked."""
    w = ordered(["conv_id"], ["turn"]).rowsBetween(1, 4)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.collect_list(F.length("text")).over(w).alias("f")).where(F.size("f") > 0)
    steps = F.sequence(F.lit(0), F.lit(3))
    chunk = F.transform(steps, lambda k: F.get("f", F.least(k, F.size("f") - 1)).cast("string"))
    pad = F.transform(steps, lambda k: F.when(k >= F.size("f"), "1").otherwise("0"))
    return rows.select("conv_id", "turn", F.array_join(chunk, ",").alias("chunk"), F.array_join(pad, "").alias("pad"))
