"""The registered queries over the test tables, and for each an oracle in SQL written on its own.

Doubles are rounded to six places after aggregation, integers are long."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.functions import calibration as C
from scanloom.functions import geo
from scanloom.operators import asof, cloud, curves, extrinsic, imu, interval, normals, pair, scan, tau, texture, velocity
from scanloom.sources import proxy, proxy_mesh, proxy_slam, slam
from scanloom.sources.proxy import prelude

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CAL = C.Calibration()
#: The test points are camera-like already.
FLAT = C.Calibration(rotation=C.IDENTITY, shift=C.NO_SHIFT)
#: Events are minutes apart where sensor messages are milliseconds apart.
GAP_MS, PERIOD_MS = 1_500_000.0, 900_000.0


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(f(spark, sf_dir))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, integers to long, as the oracles give them."""
    six = lambda x: geo.round_signed(x, 6)
    kinds = {"double": six, "float": lambda c: six(c.cast("double")), "int": lambda c: c.cast("long"), "array<double>": lambda c: F.transform(c, six)}
    return df.select(*[kinds[k](F.col(c)).alias(c) if k in kinds else F.col(c) for c, k in df.dtypes])


# Intervals of streams

DIFFS = prelude("ticks") + ", d AS (SELECT stream, seq, (us - lag(us) OVER (PARTITION BY stream ORDER BY seq)) / 1000.0::DOUBLE AS dt FROM ticks)\n"


@query(
    "q9_stamp_check",
    DIFFS + f"SELECT stream, count(*) AS n, round(avg(dt), 6) AS mean_ms, round(stddev_pop(dt), 6) AS std_ms, round(min(dt), 6) AS min_ms, round(max(dt), 6) AS max_ms, count(*) FILTER (dt > {GAP_MS}) AS n_gap, count(*) FILTER (dt > 100) AS n_slow FROM d WHERE dt IS NOT NULL GROUP BY stream",
)
def q9_stamp_check(spark, sf):
    return interval.interval_stats(proxy.ticks(spark, sf), ["stream"], "seq", "us", {"n_gap": GAP_MS, "n_slow": 100.0})


@query(
    "agg3_normal_gaps",
    DIFFS + f"""SELECT stream, count(*) FILTER (dt < {GAP_MS}) AS n_normal, round(avg(dt) FILTER (dt < {GAP_MS}), 6) AS mean_normal_ms, round(stddev_pop(dt) FILTER (dt < {GAP_MS}), 6) AS std_normal_ms,
  count(*) FILTER (dt >= {GAP_MS}) AS n_gaps, [round(x, 6) FOR x IN list_sort(list(dt) FILTER (dt >= {GAP_MS}))] AS gaps_ms,
  [round_even(x / {PERIOD_MS}, 1) FOR x IN list_sort(list(dt) FILTER (dt >= {GAP_MS}))] AS gap_periods FROM d WHERE dt IS NOT NULL GROUP BY stream""",
)
def agg3_normal_gaps(spark, sf):
    return interval.normal_and_gaps(proxy.ticks(spark, sf), ["stream"], "seq", "us", GAP_MS, PERIOD_MS)


@query(
    "agg3_gap_rows",
    DIFFS + f"""SELECT stream, seq, row_number() OVER (PARTITION BY stream ORDER BY dt) - 1 AS place, round(dt, 6) AS dt_ms, round_even(dt / {PERIOD_MS}, 1) AS gap_periods
  FROM d WHERE dt >= {GAP_MS}""",
)
def agg3_gap_rows(spark, sf):
    return interval.gap_rows(proxy.ticks(spark, sf), ["stream"], "seq", "us", GAP_MS, PERIOD_MS)


@query("agg23_corner_spread", prelude("points") + " SELECT scan_id AS image_id, round(min(\"time\"), 6) AS t, round(avg(x), 6) AS x, round(max(x) - min(x), 6) AS spread FROM points GROUP BY 1")
def agg23_corner_spread(spark, sf):
    return curves.corner_spread(proxy.points(spark, sf).select(F.col("scan_id").alias("image_id"), F.col("time").alias("t"), F.col("x").alias("u")))


@query(
    "agg4_rate_dropout",
    DIFFS + f"""SELECT stream, count(*) AS n, round(median(dt), 6) AS median_ms, round(min(dt), 6) AS min_ms, round(max(dt), 6) AS max_ms, count(*) FILTER (dt > {GAP_MS}) AS n_gaps,
  round(1000.0 / median(dt), 6) AS rate_hz, round(100.0 * count(*) FILTER (dt > {GAP_MS}) / count(*), 6) AS gap_percent FROM d WHERE dt IS NOT NULL GROUP BY stream""",
)
def agg4_rate_dropout(spark, sf):
    return interval.rate_and_dropout(proxy.ticks(spark, sf), ["stream"], "seq", "us", GAP_MS)


@query("srt3_first_intervals", DIFFS + ", n AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY seq) - 1 AS place FROM d) SELECT stream, place, round(dt, 6) AS dt_ms FROM n WHERE place BETWEEN 1 AND 15")
def srt3_first_intervals(spark, sf):
    return interval.first_intervals(proxy.ticks(spark, sf), ["stream"], "seq", "us")


WANTED = ("click", "view", "signup", "lidar")


@query(
    "q11_gates",
    prelude("ticks") + f""", l AS (SELECT max(us) AS last FROM ticks), w(stream) AS (VALUES {', '.join(f"('{x}')" for x in WANTED)}),
a AS (SELECT stream, count(*) FILTER (us > last - 3600000000) AS n, round(count(DISTINCT us) / count(*), 6) AS distinct_share FROM ticks, l GROUP BY stream)
SELECT stream, coalesce(n, 0) AS n, distinct_share, coalesce(n, 0) > 0 AS live FROM w LEFT JOIN a USING (stream)""",
)
def q11_gates(spark, sf):
    return interval.gates(proxy.ticks(spark, sf), "stream", "us", WANTED, 3_600_000_000)


# Inertial sensor


def norm_sql(v: str, n: int = 3) -> str:
    return "sqrt(" + " + ".join(f"{v}[{i}] * {v}[{i}]" for i in range(1, n + 1)) + ")"


def magnitude_sql(v: str) -> str:
    m = norm_sql(v)
    axes = ", ".join(f"round(avg({v}[{i}]), 6) AS {v}_{a}" for i, a in enumerate("xyz", 1))
    return f"round(avg({m}), 6) AS {v}_mean, round(stddev_pop({m}), 6) AS {v}_std, round(min({m}), 6) AS {v}_min, round(max({m}), 6) AS {v}_max, {axes}"


QNORM = norm_sql("quat", 4)
QUAT_SQL = f"round(avg({QNORM}), 6) AS quat_mean, round(stddev_pop({QNORM}), 6) AS quat_std, round(min({QNORM}), 6) AS quat_min, round(max({QNORM}), 6) AS quat_max, count(*) FILTER (abs(quat[1]) < 1e-6 AND abs(quat[2]) < 1e-6 AND abs(quat[3]) < 1e-6) AS degenerate"
LIVE_SQL = """o AS (SELECT row_number() OVER (ORDER BY seq) - 1 AS i, abs(list_dot_product(quat, lag(quat) OVER (ORDER BY seq))) AS dd FROM imu),
live AS (SELECT round(max(2 * acos(least(greatest(dd, 0), 1))), 6) AS largest_angle, coalesce(max(2 * acos(least(greatest(dd, 0), 1))) > 1e-3, false) AS live FROM o WHERE i % 20 = 1 AND dd IS NOT NULL)"""


@query("agg5_accel", prelude("imu") + f" SELECT {magnitude_sql('accel')}, avg({norm_sql('accel')}) > 5 AND avg({norm_sql('accel')}) < 15 AS plausible FROM imu")
def agg5_accel(spark, sf):
    return imu.gravity_gate(imu.magnitudes(proxy.imu(spark, sf), "accel", "accel"))


@query("agg6_quat_norm", prelude("imu") + f" SELECT {QUAT_SQL} FROM imu")
def agg6_quat_norm(spark, sf):
    return imu.quaternion_norms(proxy.imu(spark, sf))


@query("agg8_orientation", prelude("imu") + f", {LIVE_SQL} SELECT * FROM live")
def agg8_orientation(spark, sf):
    return imu.orientation_changes(proxy.imu(spark, sf), "seq")


@query(
    "q8_imu_health",
    prelude("imu") + f""", {LIVE_SQL}, d AS (SELECT (us - lag(us) OVER (ORDER BY seq)) / 1000.0::DOUBLE AS dt FROM imu),
r AS (SELECT count(*) AS n, round(median(dt), 6) AS median_ms, round(min(dt), 6) AS min_ms, round(max(dt), 6) AS max_ms, count(*) FILTER (dt > 5) AS n_gaps, round(1000.0 / median(dt), 6) AS rate_hz, round(100.0 * count(*) FILTER (dt > 5) / count(*), 6) AS gap_percent FROM d WHERE dt IS NOT NULL),
m AS (SELECT {magnitude_sql('accel')}, {magnitude_sql('gyro')}, {QUAT_SQL}, avg({norm_sql('accel')}) > 5 AND avg({norm_sql('accel')}) < 15 AS plausible FROM imu)
SELECT * FROM m, live, r""",
)
def q8_imu_health(spark, sf):
    return imu.health(proxy.imu(spark, sf), "seq", "us", 5.0)


# Poses

Q_UNIT = "list_transform(%s, lambda c: c / sqrt(list_dot_product(%s, %s)))"
MATCH = (
    prelude("odom", "shots")
    + f""", o AS (SELECT ns AS ons, {Q_UNIT % ('quat', 'quat', 'quat')} AS q, pos AS p FROM odom),
b AS (SELECT idx, ns, ons AS t0, q AS q0, p AS p0 FROM shots ASOF LEFT JOIN o ON shots.ns >= o.ons),
a AS (SELECT idx, ons AS t1, q AS q1, p AS p1 FROM shots ASOF LEFT JOIN o ON shots.ns <= o.ons),
j AS (SELECT *, CASE WHEN t0 IS NULL OR t1 IS NULL THEN 'out of span' WHEN t0 = ns THEN 'exact' WHEN (t1 - t0) / 1e9 > 0.05 THEN 'gap' ELSE 'interp' END AS reason FROM b JOIN a USING (idx)),
k AS (SELECT *, reason IN ('exact', 'interp') AS ok, CASE WHEN reason IN ('gap', 'interp') THEN (t1 - t0) / 1e9 END AS gap_s, CASE WHEN reason = 'interp' THEN (ns - t0)::DOUBLE / (t1 - t0) END AS u,
  list_dot_product(q0, q1) AS dq FROM j),
s AS (SELECT *, abs(dq) AS ad, CASE WHEN dq < 0 THEN list_transform(q1, lambda c: -c) ELSE q1 END AS q2 FROM k),
th AS (SELECT *, atan2(sqrt(greatest(1 - ad * ad, 0)), ad) AS theta FROM s),
w AS (SELECT *, CASE WHEN reason <> 'interp' THEN 1 WHEN sin(theta) < 1e-12 THEN 1 - u ELSE sin((1 - u) * theta) / sin(theta) END AS w0,
             CASE WHEN reason <> 'interp' THEN 0 WHEN sin(theta) < 1e-12 THEN u ELSE sin(u * theta) / sin(theta) END AS w1 FROM th),
matched AS (SELECT idx, ns, reason, gap_s, u, ok, """
    + ", ".join(f"CASE WHEN ok THEN p0[{i}] + coalesce(u, 0) * (CASE WHEN reason = 'interp' THEN p1[{i}] - p0[{i}] ELSE 0 END) END AS p{a}" for i, a in enumerate("xyz", 1))
    + ", "
    + ", ".join(f"CASE WHEN ok THEN w0 * q0[{i}] + w1 * q2[{i}] END AS q{a}" for i, a in enumerate("xyzw", 1))
    + " FROM w)\n"
)


def matched(spark, sf):
    return asof.match_poses(proxy.odom(spark, sf), proxy.shots(spark, sf), 0.05)


@query("q3_pose_match", MATCH + "SELECT idx, ns, reason, ok, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("gap_s", "u", "px", "py", "pz", "qx", "qy", "qz", "qw")) + " FROM matched")
def q3_pose_match(spark, sf):
    return matched(spark, sf)


@query("join1_bracket", prelude("odom", "shots") + ", b AS (SELECT idx, odom.ns AS before_ns FROM shots ASOF LEFT JOIN odom ON shots.ns >= odom.ns), a AS (SELECT idx, odom.ns AS after_ns FROM shots ASOF LEFT JOIN odom ON shots.ns <= odom.ns) SELECT idx, before_ns, after_ns FROM b JOIN a USING (idx)")
def join1_bracket(spark, sf):
    near = asof.bracket(proxy.odom(spark, sf), proxy.shots(spark, sf), bucket=500_000_000)
    return near.select("idx", F.col("before.ns").alias("before_ns"), F.col("after.ns").alias("after_ns"))


@query("agg16_match_rate", MATCH + "SELECT count(*) AS n, count(*) FILTER (ok) AS n_ok, round(100.0 * count(*) FILTER (ok) / count(*), 6) AS ok_percent FROM matched")
def agg16_match_rate(spark, sf):
    return asof.match_summary(matched(spark, sf))


@query("srt3_first_dropped", MATCH + "SELECT idx, reason FROM matched WHERE NOT ok ORDER BY idx LIMIT 5")
def srt3_first_dropped(spark, sf):
    return matched(spark, sf).filter("NOT ok").orderBy("idx").limit(5).select("idx", "reason")


@query("agg16b_span", prelude("odom") + " SELECT count(*) AS n, round((max(ns) - min(ns)) / 1e9, 6) AS span_s, round(count(*) / greatest(1e-9, (max(ns) - min(ns)) / 1e9), 6) AS rate_hz FROM odom")
def agg16b_span(spark, sf):
    return asof.span_summary(proxy.odom(spark, sf))


@query("win2_dedupe", prelude("ticks") + " SELECT us // 60000000 AS minute, min(seq) AS seq FROM ticks GROUP BY 1")
def win2_dedupe(spark, sf):
    return asof.dedupe_stamps(proxy.ticks(spark, sf).withColumn("minute", F.floor(F.col("us") / 60_000_000)), "minute", "seq").select("minute", "seq")


@query("src13_rebase", prelude("odom", "shots") + " SELECT idx, round((ns - (SELECT min(ns) FROM odom)) / 1e9, 6) AS t FROM shots")
def src13_rebase(spark, sf):
    return asof.rebase(proxy.shots(spark, sf), proxy.odom(spark, sf)).select("idx", "t")


@query("flt11_count_check", prelude("odom", "shots") + " SELECT (SELECT count(*) FROM odom) AS n_left, (SELECT count(*) FROM shots) AS n_right, (SELECT count(*) FROM odom) <> (SELECT count(*) FROM shots) AS differ")
def flt11_count_check(spark, sf):
    return pair.count_check(proxy.odom(spark, sf), proxy.shots(spark, sf))


def unit(spark, sf):
    return geo.with_unit(proxy.odom(spark, sf), "quat", "q").select("seq", "q", "pos")


UNIT = prelude("odom") + f", n AS (SELECT seq, {Q_UNIT % ('quat', 'quat', 'quat')} AS q, pos FROM odom)\n"
M_SQL = (
    "1 - 2 * (q[2]^2 + q[3]^2)", "2 * (q[1] * q[2] - q[3] * q[4])", "2 * (q[1] * q[3] + q[2] * q[4])",
    "2 * (q[1] * q[2] + q[3] * q[4])", "1 - 2 * (q[1]^2 + q[3]^2)", "2 * (q[2] * q[3] - q[1] * q[4])",
    "2 * (q[1] * q[3] - q[2] * q[4])", "2 * (q[2] * q[3] + q[1] * q[4])", "1 - 2 * (q[1]^2 + q[2]^2)",
)
MAT = UNIT.rstrip() + f", m AS (SELECT seq, q, pos, [{', '.join(M_SQL)}] AS m FROM n)\n"
MATRIX = lambda q: geo.quat_matrix(geo.of_array(F.col(q), 4))


@query("geo6_quat_matrix", MAT + "SELECT seq, [round(x, 6) FOR x IN m] AS m FROM m")
def geo6_quat_matrix(spark, sf):
    return unit(spark, sf).select("seq", F.array(*[c for row in MATRIX("q") for c in row]).alias("m"))


@query("geo10_matrix_quat", UNIT + "SELECT seq, round(abs(q[1]), 6) AS x, round(abs(q[2]), 6) AS y, round(abs(q[3]), 6) AS z, round(abs(q[4]), 6) AS w FROM n")
def geo10_matrix_quat(spark, sf):
    m = unit(spark, sf).select("seq", F.array(*[c for row in MATRIX("q") for c in row]).alias("m"))
    q = geo.matrix_quat([[F.col("m")[3 * i + j] for j in range(3)] for i in range(3)])
    return m.select("seq", *[F.abs(c).alias(n) for c, n in zip(q, "xyzw")])


R, T = C.LIDAR_TO_CAM, C.LIDAR_TO_CAM_SHIFT


def row_sql(r, *v: str) -> str:
    return "(" + " + ".join(f"({c}) * ({x})" for c, x in zip(r, v)) + ")"


@query(
    "geo8_world_to_camera",
    MAT + ", w AS (SELECT seq, pos, [" + ", ".join(row_sql(R[i], f"m[{3 * j + 1}]", f"m[{3 * j + 2}]", f"m[{3 * j + 3}]") for i in range(3) for j in range(3)) + "] AS r FROM m)\n"
    + "SELECT seq, [round(x, 6) FOR x IN r] AS r, [" + ", ".join(f"round({T[i]} - {row_sql([f'r[{3 * i + k}]' for k in (1, 2, 3)], 'pos[1]', 'pos[2]', 'pos[3]')}, 6)" for i in range(3)) + "] AS t FROM w",
)
def geo8_world_to_camera(spark, sf):
    r, t = geo.world_to_camera(CAL, MATRIX("q"), geo.of_array(F.col("pos"), 3))
    return unit(spark, sf).select("seq", F.array(*[c for row in r for c in row]).alias("r"), F.array(*t).alias("t"))


CENTRE = [-sum(R[k][i] * T[k] for k in range(3)) for i in range(3)]


@query(
    "geo9_camera_in_map",
    MAT + "SELECT seq, [" + ", ".join(f"round({row_sql([f'm[{3 * i + k}]' for k in (1, 2, 3)], *R[j])}, 6)" for i in range(3) for j in range(3)) + "] AS r, ["
    + ", ".join(f"round({row_sql([f'm[{3 * i + k}]' for k in (1, 2, 3)], *CENTRE)} + pos[{i + 1}], 6)" for i in range(3)) + "] AS t FROM m",
)
def geo9_camera_in_map(spark, sf):
    r, t = geo.camera_in_map(CAL, MATRIX("q"), geo.of_array(F.col("pos"), 3))
    return unit(spark, sf).select("seq", F.array(*[c for row in r for c in row]).alias("r"), F.array(*t).alias("t"))


@query(
    "geo11_axis_angle",
    prelude("odom") + """, a AS (SELECT seq, sqrt(pos[1]^2 + pos[2]^2 + pos[3]^2) AS n, pos, quat[1] AS w FROM odom), b AS (SELECT seq, pos[1] / n AS x, pos[2] / n AS y, pos[3] / n AS z, sin(w) AS s, cos(w) AS c FROM a)
SELECT seq, [round(v, 6) FOR v IN [c + x * x * (1 - c), x * y * (1 - c) - z * s, x * z * (1 - c) + y * s, y * x * (1 - c) + z * s, c + y * y * (1 - c), y * z * (1 - c) - x * s, z * x * (1 - c) - y * s, z * y * (1 - c) + x * s, c + z * z * (1 - c)]] AS m FROM b""",
)
def geo11_axis_angle(spark, sf):
    m = geo.axis_angle_matrix(geo.of_array(F.col("pos"), 3), F.col("quat")[0])
    return proxy.odom(spark, sf).select("seq", F.array(*[c for row in m for c in row]).alias("m"))


@query("doc6_yaw_spread", UNIT + "SELECT round(max(y) - min(y), 6) AS yaw_spread FROM (SELECT degrees(atan2(2 * (q[4] * q[3] + q[1] * q[2]), 1 - 2 * (q[2]^2 + q[3]^2))) AS y FROM n)")
def doc6_yaw_spread(spark, sf):
    return cloud.yaw_spread(proxy.odom(spark, sf))


# Pairing

PAIR_SLOP = 40_000_000


@query(
    "join2_pairing",
    prelude("ticks") + f""", c AS (SELECT a.seq AS l_id, b.seq AS r_id, a.us AS l_us, b.us AS r_us, abs(a.us - b.us) AS dt_us FROM (SELECT * FROM ticks WHERE stream = 'click') a JOIN (SELECT * FROM ticks WHERE stream = 'view') b ON abs(a.us - b.us) <= {PAIR_SLOP}),
r AS (SELECT *, row_number() OVER (PARTITION BY l_id ORDER BY dt_us, r_us, r_id) AS x, row_number() OVER (PARTITION BY r_id ORDER BY dt_us, l_us, l_id) AS y FROM c) SELECT l_id, r_id, l_us, r_us, dt_us FROM r WHERE x = 1 AND y = 1""",
)
def join2_pairing(spark, sf):
    t = proxy.ticks(spark, sf)
    return pair.pair_nearest(t.filter("stream = 'click'"), t.filter("stream = 'view'"), PAIR_SLOP)


@query("join2b_exact", prelude("odom", "shots") + " SELECT idx AS l_id, seq AS r_id, ns FROM shots JOIN odom USING (ns)")
def join2b_exact(spark, sf):
    return pair.pair_exact(proxy.shots(spark, sf).withColumnRenamed("idx", "seq"), proxy.odom(spark, sf), "ns").select("l_id", "r_id", "ns")


@query("join4_zip", prelude("odom", "shots") + ", a AS (SELECT row_number() OVER (ORDER BY seq) - 1 AS idx, seq FROM odom), b AS (SELECT row_number() OVER (ORDER BY idx) - 1 AS idx, ns FROM shots) SELECT idx, seq, ns FROM a JOIN b USING (idx)")
def join4_zip(spark, sf):
    shots = proxy.shots(spark, sf).withColumnRenamed("idx", "shot")
    return pair.zip_by_order(proxy.odom(spark, sf).select("seq"), shots, "seq", "shot").select("idx", "seq", "ns")


@query("join3_decorate", prelude("shots") + f" SELECT idx, ns, {C.FX}::DOUBLE AS fx, {C.FY}::DOUBLE AS fy, {C.CX}::DOUBLE AS cx, {C.CY}::DOUBLE AS cy FROM shots")
def join3_decorate(spark, sf):
    return pair.decorate(proxy.shots(spark, sf), {"fx": C.FX, "fy": C.FY, "cx": C.CX, "cy": C.CY})


@query("set1_union", prelude("ticks", "imu") + " SELECT kind, count(*) AS n FROM (SELECT 'EVT' AS kind, seq FROM ticks UNION ALL SELECT 'IMU', seq FROM imu) GROUP BY kind")
def set1_union(spark, sf):
    both = proxy.ticks(spark, sf).select(F.lit("EVT").alias("kind"), "seq").unionByName(proxy.imu(spark, sf).select(F.lit("IMU").alias("kind"), "seq"))
    return both.groupBy("kind").agg(F.count("*").alias("n"))


@query("set4_topics", prelude("ticks") + " SELECT list_sort(list(DISTINCT stream)) AS topics FROM ticks")
def set4_topics(spark, sf):
    return proxy.ticks(spark, sf).agg(F.sort_array(F.collect_set("stream")).alias("topics"))


# Scans


def band_sql(low: float, high: float, least: int) -> str:
    return f"front AS (SELECT * FROM points WHERE z > 0), band AS (SELECT * FROM front WHERE z > {low} AND z < {high} AND scan_id IN (SELECT scan_id FROM front WHERE z > {low} AND z < {high} GROUP BY scan_id HAVING count(*) >= {least}))"


for _name, (_low, _high, _least) in scan.BANDS.items():

    @query(f"flt3_band_{_name}", prelude("points") + f", {band_sql(_low, _high, _least)} SELECT scan_id, count(*) AS n, round(avg(z), 6) AS mean_z FROM band GROUP BY scan_id")
    def flt3_band(spark, sf, limits=(_low, _high, _least)):
        return scan.in_band(scan.to_camera(proxy.points(spark, sf), FLAT), *limits).groupBy("scan_id").agg(F.count("*").alias("n"), F.avg("z").alias("mean_z"))


CORE = f"""{band_sql(*scan.BANDS['far'])}, med AS (SELECT scan_id, median(z) AS depth FROM band GROUP BY scan_id),
core AS (SELECT scan_id, any_value(depth) AS depth, count(*) AS n, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, avg("time") AS mean_time FROM band JOIN med USING (scan_id) WHERE abs(z - depth) < 0.15 GROUP BY scan_id HAVING count(*) >= 30),
board AS (SELECT *, ({C.FX} * cx + {C.CX} * cz) / cz AS board_x FROM core)"""


@query("agg13_scan_centroid", prelude("points") + f", {CORE} SELECT scan_id, n, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("depth", "cx", "cy", "cz", "mean_time", "board_x")) + " FROM board")
def agg13_scan_centroid(spark, sf):
    return scan.core_centroid(proxy.points(spark, sf), FLAT)


@query("agg14_true_time", prelude("points") + f", {CORE} SELECT scan_id, round(scan_id * 0.0833 + mean_time, 6) AS true_time FROM board")
def agg14_true_time(spark, sf):
    return scan.core_centroid(proxy.points(spark, sf), FLAT).select("scan_id", (F.col("scan_id") * 0.0833 + F.col("mean_time")).alias("true_time"))


LIDAR = f"{CORE}, lidar AS (SELECT scan_id * 0.1 + 0.4 AS t, board_x AS x FROM board)"
SHIFT = """seg AS (SELECT t AS t0, x AS x0, coalesce(lead(t) OVER (ORDER BY t), t) AS t1, coalesce(lead(x) OVER (ORDER BY t), x) AS x1 FROM cam),
g AS (SELECT i AS tau_idx, -0.3::DOUBLE + i * 0.001::DOUBLE AS tau FROM range(0, 601) r(i)),
mv AS (SELECT tau_idx, tau, lid.t - tau AS t, x FROM lid, g), hit AS (SELECT tau_idx, tau, mv.x - (x0 + CASE WHEN t1 = t0 THEN 0 ELSE (mv.t - t0) / (t1 - t0) END * (x1 - x0)) AS e FROM mv JOIN seg ON mv.t >= t0 AND (mv.t < t1 OR (t1 = t0 AND mv.t = t0))),
err AS (SELECT tau_idx, tau, count(*) AS n, avg(e * e) AS mse FROM hit GROUP BY tau_idx, tau HAVING count(*) >= 10)"""


def lidar_curve(spark, sf):
    return scan.core_centroid(proxy.points(spark, sf), FLAT).select((F.col("scan_id") * 0.1 + 0.4).alias("t"), F.col("board_x").alias("x"))


@query("join8_shift_errors", prelude("points", "camera") + f", {LIDAR}, cam AS (FROM camera), lid AS (FROM lidar), {SHIFT} SELECT tau_idx, round(tau, 6) AS tau, n, round(mse, 6) AS mse FROM err")
def join8_shift_errors(spark, sf):
    return tau.errors_by_shift(proxy.camera_curve(spark, sf), lidar_curve(spark, sf))


@query(
    "q1_measure_tau",
    prelude("points", "camera") + f", {LIDAR}, cam AS (FROM camera), lid AS (FROM lidar), {SHIFT}, best AS (SELECT * FROM err ORDER BY round(mse, 9), tau_idx LIMIT 1) SELECT tau_idx, coalesce(round(tau, 6), 0) AS tau, coalesce(round(mse, 6), 'Infinity'::DOUBLE) AS mse, coalesce(n, 0) AS n FROM (SELECT 1) LEFT JOIN best ON true",
)
def q1_measure_tau(spark, sf):
    return tau.best_shift(proxy.camera_curve(spark, sf), lidar_curve(spark, sf))


HALF = """ends AS (SELECT least((SELECT min(t) FROM cam), (SELECT min(t) FROM lid)) AS t0, (SELECT min(t) + (max(t) - min(t)) / 2 FROM cam) AS mid),
based AS (SELECT 'c' AS kind, t - t0 AS t, x, t < mid AS first FROM cam, ends UNION ALL SELECT 'l', t - t0, x, t < mid FROM lid, ends),
parts AS (SELECT 'all' AS part, kind, t, x FROM based UNION ALL SELECT CASE WHEN first THEN 'first' ELSE 'second' END, kind, t, x FROM based),
enough AS (SELECT part FROM parts GROUP BY part HAVING part = 'all' OR (count(*) FILTER (kind = 'c') > 10 AND count(*) FILTER (kind = 'l') > 10)),
seg AS (SELECT part, t AS t0, x AS x0, coalesce(lead(t) OVER w, t) AS t1, coalesce(lead(x) OVER w, x) AS x1 FROM parts WHERE kind = 'c' WINDOW w AS (PARTITION BY part ORDER BY t)),
g AS (SELECT i AS tau_idx, -0.3::DOUBLE + i * 0.001::DOUBLE AS tau FROM range(0, 601) r(i)),
mv AS (SELECT part, tau_idx, tau, p.t - tau AS t, x FROM parts p, g WHERE kind = 'l'),
hit AS (SELECT mv.part, tau_idx, tau, mv.x - (x0 + CASE WHEN t1 = t0 THEN 0 ELSE (mv.t - t0) / (t1 - t0) END * (x1 - x0)) AS e FROM mv JOIN seg ON mv.part = seg.part AND mv.t >= t0 AND (mv.t < t1 OR (t1 = t0 AND mv.t = t0))),
err AS (SELECT part, tau_idx, tau, count(*) AS n, avg(e * e) AS mse FROM hit GROUP BY ALL HAVING count(*) >= 10),
ranked AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY round(mse, 9), tau_idx) AS k FROM err)
SELECT part, tau_idx, coalesce(round(tau, 6), 0) AS tau, coalesce(round(mse, 6), 'Infinity'::DOUBLE) AS mse, coalesce(n, 0) AS n FROM enough LEFT JOIN (SELECT * FROM ranked WHERE k = 1) r USING (part)"""


@query("win5_tau_halves", prelude("points", "camera") + f", {LIDAR}, cam AS (FROM camera), lid AS (FROM lidar), {HALF}")
def win5_tau_halves(spark, sf):
    return tau.shift_with_halves(proxy.camera_curve(spark, sf), lidar_curve(spark, sf))


@query("krn1_board_plane")
def krn1_board_plane(spark, sf):
    return scan.board_plane(proxy.points(spark, sf), FLAT, scan.BANDS["near"], 0.02, 1.2, 0.08)


def curve_parts(spark, sf):
    """Camera, LiDAR and inertial curves of the test tables."""
    lid = scan.core_centroid(proxy.points(spark, sf), FLAT).select((F.col("scan_id") * 0.1).alias("t"), geo.round_signed(F.col("board_x"), 6).alias("x"), "depth", "mean_time")
    w = proxy.imu(spark, sf).select((F.col("us") / 1e6).alias("t"), *[geo.round_signed(F.col("gyro")[i], 5).alias(f"w{a}") for i, a in enumerate("xyz")])
    return proxy.camera_curve(spark, sf), lid, w


IMU_ROWS = ", ".join(f"printf('%.5f', round(gyro[{i}], 5)) AS w{a}" for i, a in enumerate("xyz", 1))


@query("q2_dump_curves", prelude("points", "camera", "imu") + f""", {CORE} SELECT 'CAM' AS kind, printf('%.6f', t) AS stamp, printf('%.3f', x) AS a, '0' AS b FROM camera
UNION ALL SELECT 'LID', printf('%.6f', round(scan_id * 0.1::DOUBLE + mean_time, 9)), printf('%.3f', round(board_x, 6)), printf('%.6f', scan_id * 0.1::DOUBLE) FROM board
UNION ALL SELECT 'IMU', stamp, wx, wy FROM (SELECT printf('%.6f', us / 1e6) AS stamp, {IMU_ROWS} FROM imu)""")
def q2_dump_curves(spark, sf):
    return curves.tagged_curves(*curve_parts(spark, sf))


@query("q2_dump_curves_v3", prelude("points", "camera", "imu") + f""", {CORE} SELECT 'CAM' AS kind, printf('%.6f', t) AS stamp, printf('%.3f', x) AS a, '0' AS b, '0' AS c FROM camera
UNION ALL SELECT 'LID', printf('%.6f', scan_id * 0.1::DOUBLE), printf('%.3f', round(board_x, 6)), printf('%.3f', depth), '0' FROM board
UNION ALL SELECT 'IMU', stamp, wx, wy, wz FROM (SELECT printf('%.6f', us / 1e6) AS stamp, {IMU_ROWS} FROM imu)""")
def q2_dump_curves_v3(spark, sf):
    return curves.tagged_curves(*curve_parts(spark, sf), layout=3)


# Clouds

EXT = ", ".join(f"round(quantile_cont({a}, 0.99) - quantile_cont({a}, 0.01), 6) AS robust_{a}, round(max({a}) - min({a}), 6) AS full_{a}" for a in "xyz")


@query("q10_cloud_inspection", prelude("points") + f" SELECT count(*) AS n, {EXT}, least(robust_x, robust_y, robust_z) < 3.5 AS plausible FROM points")
def q10_cloud_inspection(spark, sf):
    return cloud.extents(proxy.points(spark, sf))


@query("flt1_finite", "WITH p AS (SELECT CASE WHEN l_quantity > 45 THEN 'NaN'::DOUBLE WHEN l_quantity < 5 THEN NULL WHEN l_quantity = 20 THEN 'Infinity'::DOUBLE ELSE l_quantity::DOUBLE END AS x FROM lineitem) SELECT count(*) AS n FROM p WHERE isfinite(x)")
def flt1_finite(spark, sf):
    q = F.col("l_quantity").cast("double")
    x = F.when(q > 45, float("nan")).when(q < 5, None).when(q == 20, float("inf")).otherwise(q)
    p = proxy.table(spark, sf, "lineitem").select(x.alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    return cloud.finite_points(p).agg(F.count("*").alias("n"))


@query("doc4_range_shares", prelude("points") + " SELECT round(avg((d < 5)::INT), 6) AS within_5, round(avg((d < 10)::INT), 6) AS within_10, round(avg((d > 50)::INT), 6) AS beyond_50 FROM (SELECT sqrt(x*x + y*y + z*z) AS d FROM points)")
def doc4_range_shares(spark, sf):
    return cloud.range_shares(proxy.points(spark, sf))


@query("agg22_quantile_trim", prelude("points") + " SELECT count(*) AS n, round(min(z), 6) AS lowest FROM points WHERE z >= (SELECT quantile_cont(z, 0.05) FROM points)")
def agg22_quantile_trim(spark, sf):
    return cloud.quantile_trim(proxy.points(spark, sf), "z").agg(F.count("*").alias("n"), F.min("z").alias("lowest"))


@query("srt4_downsample")
def srt4_downsample(spark, sf):
    return cloud.downsample(proxy.points(spark, sf), 1000)


def transform_sql(r, t, x: str = "x", y: str = "y", z: str = "z") -> list[str]:
    return [f"{row_sql(r[i], x, y, z)} + ({t[i]})" for i in range(3)]


def project_sql(x: str, y: str) -> tuple[str, str]:
    k1, k2, p1, p2, k3 = C.DISTORTION
    r2 = f"({x} * {x} + {y} * {y})"
    radial = f"(1 + ({k1}) * {r2} + ({k2}) * {r2} * {r2} + ({k3}) * {r2} * {r2} * {r2})"
    return (
        f"{C.FX} * ({x} * {radial} + 2 * ({p1}) * {x} * {y} + ({p2}) * ({r2} + 2 * {x} * {x})) + {C.CX}",
        f"{C.FY} * ({y} * {radial} + ({p1}) * ({r2} + 2 * {y} * {y}) + 2 * ({p2}) * {x} * {y}) + {C.CY}",
    )


PX, PY = project_sql("a", "b")
CAMERA_POINTS = prelude("points") + f", c AS (SELECT scan_id, x, y, z, {', '.join(f'{e} AS c{a}' for e, a in zip(transform_sql(R, T), 'xyz'))} FROM points)"
PROJECTED = CAMERA_POINTS + f", n AS (SELECT *, cx / cz AS a, cy / cz AS b FROM c WHERE cz > 0), uv AS (SELECT *, {PX} AS u, {PY} AS v FROM n)\n"


@query("geo1_transform", CAMERA_POINTS + " SELECT scan_id, round(sum(cx), 4) AS sx, round(sum(cy), 4) AS sy, round(sum(cz), 4) AS sz, count(*) FILTER (cz > 0) AS in_front FROM c GROUP BY scan_id")
def geo1_transform(spark, sf):
    q = geo.transform(R, T, geo.cols("x", "y", "z"))
    p = proxy.points(spark, sf).select("scan_id", *[c.alias(n) for c, n in zip(q, ("cx", "cy", "cz"))])
    return p.groupBy("scan_id").agg(*[F.round(F.sum(f"c{a}"), 4).alias(f"s{a}") for a in "xyz"], F.count_if(F.col("cz") > 0).alias("in_front"))


@query("geo2_pinhole", CAMERA_POINTS + f" SELECT scan_id, round(avg({C.FX} * cx / cz + {C.CX}), 4) AS u, round(avg({C.FY} * cy / cz + {C.CY}), 4) AS v FROM c WHERE cz > 0.3 GROUP BY scan_id")
def geo2_pinhole(spark, sf):
    q = geo.transform(R, T, geo.cols("x", "y", "z"))
    p = proxy.points(spark, sf).select("scan_id", F.array(*q).alias("q")).filter(F.col("q")[2] > 0.3)
    u, v = geo.pinhole(CAL, geo.of_array(F.col("q"), 3))
    return p.groupBy("scan_id").agg(F.round(F.avg(u), 4).alias("u"), F.round(F.avg(v), 4).alias("v"))


@query("geo3_projection", PROJECTED + f"SELECT scan_id, count(*) AS n, count(*) FILTER (u >= 0 AND u < {C.WIDTH} AND v >= 0 AND v < {C.HEIGHT}) AS n_in_frame, count(*) FILTER (round_even(u, 0) >= 0 AND round_even(u, 0) < {C.WIDTH} AND round_even(v, 0) >= 0 AND round_even(v, 0) < {C.HEIGHT}) AS n_rounded FROM uv GROUP BY scan_id")
def geo3_projection(spark, sf):
    p = scan.to_camera(proxy.points(spark, sf), CAL)
    u, v = geo.project(CAL, geo.cols("x", "y", "z"))
    p = p.select("scan_id", u.alias("u"), v.alias("v"))
    return p.groupBy("scan_id").agg(F.count("*").alias("n"), F.count_if(geo.in_frame(CAL, F.col("u"), F.col("v"))).alias("n_in_frame"), F.count_if(geo.in_frame_rounded(CAL, F.col("u"), F.col("v"))).alias("n_rounded"))




SX, SY, SZ, SW = (c / sum(x * x for x in C.STATIC_QUAT) ** 0.5 for c in C.STATIC_QUAT)
STATIC = (
    (1 - 2 * (SY * SY + SZ * SZ), 2 * (SX * SY - SZ * SW), 2 * (SX * SZ + SY * SW)),
    (2 * (SX * SY + SZ * SW), 1 - 2 * (SX * SX + SZ * SZ), 2 * (SY * SZ - SX * SW)),
    (2 * (SX * SZ - SY * SW), 2 * (SY * SZ + SX * SW), 1 - 2 * (SX * SX + SY * SY)),
)


@query("geo20_static_transform", prelude("points") + " SELECT scan_id, " + ", ".join(f"round(sum({e}), 4) AS s{a}" for e, a in zip(transform_sql(STATIC, C.STATIC_SHIFT), "xyz")) + " FROM points GROUP BY scan_id")
def geo20_static_transform(spark, sf):
    m = geo.quat_matrix(geo.quat_unit(geo.lit3(C.STATIC_QUAT)))
    q = geo.transform(m, C.STATIC_SHIFT, geo.cols("x", "y", "z"))
    return proxy.points(spark, sf).groupBy("scan_id").agg(*[F.round(F.sum(c), 4).alias(f"s{a}") for c, a in zip(q, "xyz")])


@query("geo16_pack_rgb", "SELECT l_orderkey AS k, max(4278190080 + ((l_linenumber * 30)::BIGINT << 16) + ((l_quantity)::BIGINT << 8) + l_linenumber) AS rgb FROM lineitem GROUP BY 1")
def geo16_pack_rgb(spark, sf):
    rgb = geo.pack_rgb(F.col("l_linenumber") * 30, F.col("l_quantity"), F.col("l_linenumber"))
    return proxy.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max(rgb).alias("rgb"))


def frame_pixels(spark, sf):
    """Pixels of a coarse test image for each scan: the colours follow the supplier table, one for each 8 by 8 block's corner."""
    s = proxy.table(spark, sf, "lineitem").select((F.col("l_orderkey") % 40).alias("image_id"), (F.col("l_partkey") % C.WIDTH).cast("int").alias("u"), (F.col("l_suppkey") * 7 % C.HEIGHT).cast("int").alias("v"), "l_linenumber", "l_quantity")
    return s.groupBy("image_id", "u", "v").agg((F.max("l_linenumber") * 30).cast("int").alias("b"), F.max("l_quantity").cast("int").alias("g"), F.min("l_linenumber").cast("int").alias("r"))


PIXELS = f"pixels AS (SELECT l_orderkey % 40 AS image_id, l_partkey % {C.WIDTH} AS u, (l_suppkey * 7) % {C.HEIGHT} AS v, max(l_linenumber) * 30 AS b, max(l_quantity)::INT AS g, min(l_linenumber) AS r FROM lineitem GROUP BY 1, 2, 3)"


@query(
    "q6_colourise",
    PROJECTED.rstrip() + f""", {PIXELS}, w AS (SELECT scan_id AS image_id, try_cast(round_even(u, 0) AS INT) AS u, try_cast(round_even(v, 0) AS INT) AS v FROM uv)
SELECT image_id, count(*) AS n, sum(rgb)::BIGINT AS total FROM (SELECT image_id, coalesce(4278190080 + (r::BIGINT << 16) + (g::BIGINT << 8) + b, 0) AS rgb FROM w LEFT JOIN pixels USING (image_id, u, v) WHERE u >= 0 AND u < {C.WIDTH} AND v >= 0 AND v < {C.HEIGHT}) GROUP BY 1""",
)
def q6_colourise(spark, sf):
    out = cloud.colourise(proxy.points(spark, sf).withColumnRenamed("scan_id", "image_id"), frame_pixels(spark, sf), CAL, keep_all=True)
    return out.filter("inside").groupBy("image_id").agg(F.count("*").alias("n"), F.sum("rgb").alias("total"))


@query(
    "q7_overlay",
    PROJECTED.rstrip() + f""", s AS (SELECT scan_id, row_number() OVER (ORDER BY scan_id) AS n FROM (SELECT DISTINCT scan_id FROM points)), f AS (SELECT a.scan_id AS frame, b.scan_id FROM s a JOIN s b ON b.n BETWEEN a.n - 24 AND a.n),
r AS (SELECT frame, min(cz) AS lo, max(cz) AS hi FROM f JOIN uv USING (scan_id) GROUP BY frame),
d AS (SELECT frame, (cz - lo) / greatest(hi - lo, 1e-3) AS ratio FROM f JOIN uv USING (scan_id) JOIN r USING (frame) WHERE round_even(u, 0) >= 0 AND round_even(u, 0) < {C.WIDTH} AND round_even(v, 0) >= 0 AND round_even(v, 0) < {C.HEIGHT})
SELECT frame, count(*) AS n, sum(trunc(round(255 * ratio, 6)))::BIGINT AS b, sum(trunc(round(255 * (1 - ratio), 6)))::BIGINT AS red FROM d GROUP BY frame""",
)
def q7_overlay(spark, sf):
    dots = cloud.rolling_overlay(proxy.points(spark, sf), CAL)
    return dots.groupBy("frame").agg(F.count("*").alias("n"), F.sum("b").alias("b"), F.sum("red").alias("red"))


@query("geo17_depth_colour", prelude("points") + ", e AS (SELECT min(z) AS lo, max(z) AS hi FROM points) SELECT trunc(255 * ((z - lo) / greatest(hi - lo, 1e-3)))::BIGINT AS b, 0::BIGINT AS g, count(*) AS n FROM points, e GROUP BY 1")
def geo17_depth_colour(spark, sf):
    p = proxy.points(spark, sf)
    ends = p.agg(F.min("z").alias("lo"), F.max("z").alias("hi"))
    b, g, _ = geo.depth_colour(F.col("z"), F.col("lo"), F.col("hi"))
    return p.crossJoin(F.broadcast(ends)).select(b.alias("b"), g.alias("g")).groupBy("b", "g").agg(F.count("*").alias("n"))


@query("str1_strings", prelude("ticks") + " SELECT DISTINCT lower(stream) AS name, contains(lower(stream), 'si') AS has_si, starts_with(stream, 'v') AS v, printf('%.3f', 1.5) AS text FROM ticks")
def str1_strings(spark, sf):
    s = F.lower("stream")
    return proxy.ticks(spark, sf).select(s.alias("name"), s.contains("si").alias("has_si"), F.startswith("stream", F.lit("v")).alias("v"), F.format_string("%.3f", F.lit(1.5)).alias("text")).distinct()


@query("geo19_stamps", prelude("odom") + " SELECT seq, ns // 1000000000 * 1000000000 + ns % 1000000000 AS ns, round(ns // 1000000000 + (ns % 1000000000) * 1e-9, 6) AS s FROM odom")
def geo19_stamps(spark, sf):
    sec, nano = F.floor(F.col("ns") / 1_000_000_000), F.col("ns") % 1_000_000_000
    return proxy.odom(spark, sf).select("seq", geo.nanoseconds(sec, nano).alias("ns"), geo.seconds(sec, nano).alias("s"))


# Texture


def scene(spark, sf):
    return proxy_mesh.faces(spark, sf), proxy_mesh.vertices(spark, sf), proxy_mesh.images(spark, sf)


SCENE = "WITH " + ",\n".join(proxy_mesh.SQL.values())
CORNERS = SCENE + f""", co AS (SELECT fid, {', '.join(f'v{k}.{a} AS {a}{k}' for k in range(3) for a in 'xyz')} FROM faces JOIN vertices v0 ON i0 = v0.vid JOIN vertices v1 ON i1 = v1.vid JOIN vertices v2 ON i2 = v2.vid),
nn AS (SELECT *, (y1-y0)*(z2-z0)-(z1-z0)*(y2-y0) AS nx, (z1-z0)*(x2-x0)-(x1-x0)*(z2-z0) AS ny, (x1-x0)*(y2-y0)-(y1-y0)*(x2-x0) AS nz, (x0+x1+x2)/3 AS mx, (y0+y1+y2)/3 AS my, (z0+z1+z2)/3 AS mz FROM co),
fn AS (SELECT *, sqrt(nx*nx+ny*ny+nz*nz) + 1e-12 AS nl FROM nn)"""


@query("geo12_face_normals", CORNERS + " SELECT fid, round(nx / nl, 6) AS nx, round(ny / nl, 6) AS ny, round(nz / nl, 6) AS nz FROM fn")
def geo12_face_normals(spark, sf):
    f, v, _ = scene(spark, sf)
    n = geo.face_normal(*[geo.cols(f"x{k}", f"y{k}", f"z{k}") for k in range(3)])
    return texture.gather_corners(f, v).select("fid", *[c.alias(f"n{a}") for c, a in zip(n, "xyz")])


# With identity poses the camera stands at t minus its own offset, and a world point p is at R (p - t) + T.
BEST = CORNERS + f""", ci AS (SELECT idx, fid, mx - t[1] AS dx, my - t[2] AS dy, mz - t[3] AS dz, {', '.join(f't[{i + 1}] + ({CENTRE[i]}) - m{a} AS e{a}' for i, a in enumerate('xyz'))}, nx / nl AS nx, ny / nl AS ny, nz / nl AS nz FROM fn, images),
cc AS (SELECT *, {', '.join(f'{e} AS c{a}' for e, a in zip(transform_sql(R, T, 'dx', 'dy', 'dz'), 'xyz'))} FROM ci), ab AS (SELECT *, cx / cz AS a, cy / cz AS b, round(abs((nx*ex + ny*ey + nz*ez) / (sqrt(ex*ex+ey*ey+ez*ez) + 1e-12)), 9) AS score FROM cc WHERE cz > 0),
pu AS (SELECT *, {PX} AS u, {PY} AS v FROM ab), ok AS (SELECT * FROM pu WHERE u >= 0 AND u < {C.WIDTH} AND v >= 0 AND v < {C.HEIGHT}),
bs AS (SELECT fid, idx, score, row_number() OVER (PARTITION BY fid ORDER BY score DESC, idx) AS k FROM ok),
best AS (SELECT faces.fid, coalesce(idx, -1) AS best_img, coalesce(score, -1) AS best_score FROM faces LEFT JOIN (SELECT * FROM bs WHERE k = 1) b ON faces.fid = b.fid)"""


@query("agg19_best_image", BEST + " SELECT fid, best_img, round(best_score, 6) AS best_score FROM best")
def agg19_best_image(spark, sf):
    return texture.best_images(*scene(spark, sf), CAL)


@query("agg18_seen_share", BEST + " SELECT round(avg((best_img >= 0)::INT), 6) AS seen_share FROM best")
def agg18_seen_share(spark, sf):
    return texture.seen_share(texture.best_images(*scene(spark, sf), CAL))


@query("set3_used_images", BEST + " SELECT DISTINCT best_img FROM best WHERE best_img >= 0")
def set3_used_images(spark, sf):
    return texture.best_images(*scene(spark, sf), CAL).filter("best_img >= 0").select("best_img").distinct()


def render_sql(assigned: str) -> str:
    """Rendered pixels of image 0's view at an eighth of its size, from a table `assigned` (fid, img), in plain steps."""
    w, h, corners = C.WIDTH // 8, C.HEIGHT // 8, [(s, k) for s in "rs" for k in range(3)]
    moved = ", ".join(f"{a}{k} - t{s}[{i}] AS d{s}{k}{a}" for s, k in corners for i, a in enumerate("xyz", 1))
    camera = ", ".join(f"{e} AS c{s}{k}{a}" for s, k in corners for e, a in zip(transform_sql(R, T, *[f"d{s}{k}{a}" for a in "xyz"]), "xyz"))
    plane = ", ".join(f"c{s}{k}x / c{s}{k}z AS a{s}{k}, c{s}{k}y / c{s}{k}z AS b{s}{k}" for s, k in corners)
    front = " AND ".join(f"c{s}{k}z > 0" for s, k in corners)
    bent = ", ".join(f"{e} AS {n}{s}{k}" for s, k in corners for e, n in zip(project_sql(f"a{s}{k}", f"b{s}{k}"), "uv"))
    inside = " AND ".join(f"us{k} >= 0 AND us{k} < {C.WIDTH} AND vs{k} >= 0 AND vs{k} < {C.HEIGHT}" for k in range(3))
    p = lambda n: ", ".join(f"{n}{k}" for k in range(3))
    mixed = lambda n: f"(a * {n}0 + b * {n}1 + (1 - a - b) * {n}2)"
    return f"""{assigned},
r1 AS (SELECT co.*, img, i.t AS ts, v.t AS tr FROM co JOIN assigned USING (fid) JOIN images i ON i.idx = img, (SELECT t FROM images WHERE idx = 0) v WHERE img >= 0),
r2 AS (SELECT fid, img, {moved} FROM r1), r3 AS (SELECT fid, img, {camera} FROM r2), r4 AS (SELECT *, {plane} FROM r3 WHERE {front}), r5 AS (SELECT *, {bent} FROM r4),
r6 AS (SELECT fid, img, {', '.join(f'ur{k} / 8 AS pu{k}, vr{k} / 8 AS pv{k}, us{k} AS tu{k}, vs{k} AS tv{k}, cr{k}z AS rz{k}' for k in range(3))} FROM r5 WHERE {inside}),
r7 AS (SELECT *, greatest(floor(least({p('pu')})), 0)::BIGINT AS minx, least(ceil(greatest({p('pu')})), {w - 1})::BIGINT AS maxx, greatest(floor(least({p('pv')})), 0)::BIGINT AS miny, least(ceil(greatest({p('pv')})), {h - 1})::BIGINT AS maxy,
  (pv1 - pv2) * (pu0 - pu2) + (pu2 - pu1) * (pv0 - pv2) AS d FROM r6),
r8 AS (SELECT *, unnest(range(miny, maxy + 1)) AS yy FROM r7 WHERE maxx >= minx AND maxy >= miny AND (maxx - minx) * (maxy - miny) <= {texture.MAX_TRIANGLE_PIXELS} AND abs(d) >= 1e-6),
r9 AS (SELECT *, unnest(range(minx, maxx + 1)) AS xx FROM r8),
r10 AS (SELECT *, ((pv1 - pv2) * (xx - pu2) + (pu2 - pu1) * (yy - pv2)) / d AS a, ((pv2 - pv0) * (xx - pu2) + (pu0 - pu2) * (yy - pv2)) / d AS b FROM r9),
r11 AS (SELECT yy, xx, fid, img, {mixed('rz')} AS z, least(greatest(trunc({mixed('tu')} + 1e-6), 0), {C.WIDTH - 1})::BIGINT AS u, least(greatest(trunc({mixed('tv')} + 1e-6), 0), {C.HEIGHT - 1})::BIGINT AS v FROM r10 WHERE a >= 0 AND b >= 0 AND 1 - a - b >= 0),
done AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY yy, xx ORDER BY round(z, 9), fid) AS k FROM r11) WHERE k = 1)"""


RENDERED = "SELECT yy, xx, round(z, 6) AS z, fid, img, u, v FROM done"
BY_BEST = render_sql(BEST + ", assigned AS (SELECT fid, best_img AS img FROM best)")
BY_FIRST = render_sql(CORNERS + ", assigned AS (SELECT fid, 0 AS img FROM faces)")


@query("q4_texture_render", f"{BY_BEST} {RENDERED}")
def q4_texture_render(spark, sf):
    f, v, i = scene(spark, sf)
    return texture.render(f, v, texture.best_images(f, v, i, CAL), i, CAL, view=0, shrink=8)


@query("q5_single_image_render", f"{BY_FIRST} {RENDERED}")
def q5_single_image_render(spark, sf):
    f, v, i = scene(spark, sf)
    return texture.render(f, v, f.select("fid", F.lit(0).cast("long").alias("best_img")), i, CAL, view=0, shrink=8)


@query("agg17_coverage", f"{BY_FIRST} SELECT round(count(*) / {(C.WIDTH // 8) * (C.HEIGHT // 8)}.0, 6) AS coverage FROM done")
def agg17_coverage(spark, sf):
    done = q5_single_image_render(spark, sf)
    grey = done.select(F.col("img").alias("idx"), "u", "v").distinct().select("*", *[F.lit(c).alias(n) for n, c in (("b", 9), ("g", 9), ("r", 9))])
    return texture.coverage(texture.colour(done, grey), C.WIDTH // 8, C.HEIGHT // 8)


@query("geo18_top_view", SCENE + f" SELECT vid, round((x - (SELECT min(x) FROM vertices)) / ((SELECT max(x) - min(x) FROM vertices) + 1e-9) * {C.WIDTH}, 6) AS u, round((y - (SELECT min(y) FROM vertices)) / ((SELECT max(y) - min(y) FROM vertices) + 1e-9) * {C.HEIGHT}, 6) AS v, round(z - (SELECT min(z) FROM vertices) + 0.1, 6) AS depth FROM vertices")
def geo18_top_view(spark, sf):
    return texture.top_view(proxy_mesh.vertices(spark, sf), CAL)


@query("doc7_outliers")
def doc7_outliers(spark, sf):
    v = proxy_mesh.vertices(spark, sf).withColumnRenamed("vid", "id")
    return scan.outlier_removal(v, 0.5).select("id", "mean_distance", "keep")


@query("doc5_distances", SCENE + f", d AS (SELECT a.vid, min(sqrt((a.x-b.x)^2 + (a.y-b.y)^2 + (a.z-b.z)^2)) AS distance FROM vertices a JOIN vertices b ON b.vid % 2 = 0 WHERE a.vid % 2 = 1 GROUP BY 1) SELECT round(median(distance), 6) AS median, round(quantile_cont(distance, 0.95), 6) AS p95, round(max(distance), 6) AS max FROM d")
def doc5_distances(spark, sf):
    v = proxy_mesh.vertices(spark, sf).withColumnRenamed("vid", "id")
    return cloud.distance_quantiles(cloud.nearest_distance(v.filter("id % 2 = 1"), v.filter("id % 2 = 0"), 0.5))


# Planes seen by both sensors, and normals


@query(
    "krn3_covariances",
    SCENE + """, d AS (SELECT a.vid AS id, b.vid AS other, b.x, b.y, b.z, (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) + (b.z - a.z) * (b.z - a.z) AS s FROM vertices a JOIN vertices b ON b.y BETWEEN a.y - 0.26 AND a.y + 0.26),
k AS (SELECT * FROM d WHERE s <= 0.25 * 0.25 QUALIFY row_number() OVER (PARTITION BY id ORDER BY s, other) <= 9)
SELECT id, count(*) AS n, """ + ", ".join(f"round(covar_pop({a}, {b}), 6) AS {a}{b}" for a, b in ("xx", "xy", "xz", "yy", "yz", "zz")) + " FROM k GROUP BY id",
)
def krn3_covariances(spark, sf):
    return normals.covariances(proxy_mesh.vertices(spark, sf).withColumnRenamed("vid", "id"), 0.25, 9)


def planes(spark, sf):
    """A plane for each embedding, which faces both sensors, in LiDAR coordinates and as the rig's camera sees it."""
    part = lambda first: F.slice("embedding", first, 3).cast("array<double>")
    held = proxy.table(spark, sf, "embeddings").select(part(1).alias("n_lidar"), F.zip_with(part(1), part(4), lambda n, c: c * 0.1 - n * 5).alias("c_lidar"))
    moved = lambda c, shift: F.array(*geo.transform(C.LIDAR_TO_CAM, shift, geo.of_array(F.col(c), 3)))
    return held.withColumns({"n_cam": moved("n_lidar", C.NO_SHIFT), "c_cam": moved("c_lidar", C.LIDAR_TO_CAM_SHIFT)})


@query("doc2_extrinsic")
def doc2_extrinsic(spark, sf):
    return extrinsic.extrinsic(planes(spark, sf))


VELOCITY = """%(c)sseg AS (SELECT t AS t0, x AS x0, lead(t) OVER (ORDER BY t) AS t1, lead(x) OVER (ORDER BY t) AS x1 FROM %(c)s),
%(c)sgrid AS (SELECT *, unnest(generate_series(ceil(t0 / 0.05::DOUBLE - 1e-9::DOUBLE)::BIGINT, ceil(t1 / 0.05::DOUBLE - 1e-9::DOUBLE)::BIGINT - 1)) AS k FROM %(c)sseg WHERE t1 > t0),
%(c)sat AS (SELECT k, x0 + (k * 0.05::DOUBLE - t0) / (t1 - t0) * (x1 - x0) AS x FROM %(c)sgrid),
%(c)sv AS (SELECT k, (x1 - x) / 0.05::DOUBLE AS v FROM (SELECT k, x, lead(k) OVER (ORDER BY k) AS k1, lead(x) OVER (ORDER BY k) AS x1 FROM %(c)sat) WHERE k1 = k + 1)"""


@query(
    "doc3_correlations",
    prelude("points", "camera") + f", {LIDAR}, cam AS (FROM camera), lid AS (FROM lidar), {VELOCITY % {'c': 'cam'}}, {VELOCITY % {'c': 'lid'}}, lags AS (SELECT unnest(generate_series(-8, 8)) AS lag) "
    "SELECT lag, count(*) AS n, round(corr(lidv.v, camv.v), 6) AS corr FROM lags, lidv JOIN camv ON camv.k = lidv.k - lag GROUP BY lag",
)
def doc3_correlations(spark, sf):
    return velocity.correlations(proxy.camera_curve(spark, sf), lidar_curve(spark, sf), 0.05, 8)


@query(
    "str1_paths",
    "SELECT event_id AS idx, 'img_' || event_id || '.png' AS base, event_type AS folder, 'png' AS kind, contains('img_' || event_id || '.png', '7') AS has_seven FROM events",
)
def str1_paths(spark, sf):
    """Base name, folder and extension of a path, and a part of the base name."""
    path = F.concat(F.lit("/data/"), F.col("event_type"), F.lit("/img_"), F.col("event_id").cast("string"), F.lit(".png"))
    parts = F.split(path, "/")
    base = F.element_at(parts, -1)
    return proxy.table(spark, sf, "events").select(
        F.col("event_id").alias("idx"), base.alias("base"), F.element_at(parts, -2).alias("folder"),
        F.element_at(F.split(base, r"\."), -1).alias("kind"), base.contains("7").alias("has_seven")
    )


@query(
    "doc1_world_points",
    f"WITH {proxy_slam.SQL} SELECT node_id, count(*) AS n, round(sum(x), 4) AS sx, round(sum(y), 4) AS sy, round(sum(z), 4) AS sz, sum(r)::BIGINT AS r, sum(g)::BIGINT AS g, sum(b)::BIGINT AS b FROM world GROUP BY node_id",
)
def doc1_world_points(spark, sf):
    """Coloured points of keyframes in the world, from deflated scans and poses."""
    totals = [F.round(F.sum(a), 4).alias(f"s{a}") for a in "xyz"] + [F.sum(c).alias(c) for c in "rgb"]
    return slam.world_points(proxy_slam.nodes(spark, sf)).groupBy("node_id").agg(F.count("*").alias("n"), *totals)


DOTS = PROJECTED.replace("SELECT scan_id, x, y, z,", "SELECT scan_id, point_id, x, y, z,").replace("AS scan_id, ((l_quantity", "AS scan_id, l_orderkey * 8 + l_linenumber AS point_id, ((l_quantity")


@query(
    "q7_overlay_frames",
    DOTS.rstrip() + f""", s AS (SELECT scan_id, row_number() OVER (ORDER BY scan_id) AS n FROM (SELECT DISTINCT scan_id FROM points)), f AS (SELECT a.scan_id AS frame, b.scan_id, b.n FROM s a JOIN s b ON b.n BETWEEN a.n - 24 AND a.n),
r AS (SELECT frame, min(cz) AS lo, max(cz) AS hi FROM f JOIN uv USING (scan_id) GROUP BY frame),
i AS (SELECT scan_id, point_id, cz, round_even(u, 0)::BIGINT AS u, round_even(v, 0)::BIGINT AS v FROM uv WHERE round_even(u, 0) >= 0 AND round_even(u, 0) < {C.WIDTH} AND round_even(v, 0) >= 0 AND round_even(v, 0) < {C.HEIGHT}),
o AS (SELECT scan_id, point_id, cz, u + du AS u, v + dv AS v FROM i, (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) t(du, dv) WHERE u + du >= 0 AND u + du < {C.WIDTH} AND v + dv >= 0 AND v + dv < {C.HEIGHT}),
k AS (SELECT frame, u, v, cz FROM f JOIN o USING (scan_id) QUALIFY row_number() OVER (PARTITION BY frame, u, v ORDER BY n DESC, point_id DESC, cz DESC) = 1),
d AS (SELECT frame, u, v, (cz - lo) / greatest(hi - lo, 1e-3) AS ratio FROM k JOIN r USING (frame))
SELECT frame, count(*) AS n, sum(u)::BIGINT AS u, sum(v)::BIGINT AS v, sum(trunc(round(255 * ratio, 6)))::BIGINT AS b, sum(trunc(round(255 * (1 - ratio), 6)))::BIGINT AS r FROM d GROUP BY frame""",
)
def q7_overlay_frames(spark, sf):
    """Pixels of the overlay with dots of radius 1."""
    line = proxy.table(spark, sf, "lineitem")
    seen = cloud.overlay_pixels(proxy.points_of(line, (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("point_id")), CAL)
    return seen.groupBy("frame").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in "uvbr"])


@query(
    "doc8_accumulation",
    prelude("points") + """, s AS (SELECT scan_id, row_number() OVER (ORDER BY scan_id) AS n FROM (SELECT DISTINCT scan_id FROM points)), f AS (SELECT a.scan_id AS frame, b.scan_id FROM s a JOIN s b ON b.n BETWEEN a.n - 29 AND a.n)
SELECT frame, count(*) AS n, count(DISTINCT scan_id) AS scans, round(min(z), 6) AS near, round(max(z), 6) AS far, round(sum(x), 4) AS sx FROM f JOIN points USING (scan_id) GROUP BY frame""",
)
def doc8_accumulation(spark, sf):
    whole = cloud.accumulated(proxy.points(spark, sf))
    return whole.groupBy("frame").agg(F.count("*").alias("n"), F.countDistinct("scan_id").alias("scans"), F.min("z").alias("near"), F.max("z").alias("far"), F.round(F.sum("x"), 4).alias("sx"))


def top_sql() -> str:
    """Image 0 on the mesh from above at an eighth of its size, in plain steps."""
    w, h, ks = C.WIDTH // 8, C.HEIGHT // 8, range(3)
    p = lambda n: ", ".join(f"{n}{k}" for k in ks)
    mixed = lambda n: f"(a * {n}0 + b * {n}1 + (1 - a - b) * {n}2)"
    camera = ", ".join(f"{e} AS c{a}" for e, a in zip(transform_sql(R, T, *[f"d{a}" for a in "xyz"]), "xyz"))
    gathered = ", ".join(f"q{k}.pu AS pu{k}, q{k}.pv AS pv{k}, q{k}.rz AS rz{k}, q{k}.tu AS tu{k}, q{k}.tv AS tv{k}" for k in ks)
    # the mesh's upper edge lies on pixel row 0, so coordinates must be doubles all the way, as decimals would differ in their last bit
    exact = SCENE.replace("* 0.1 - 0.95)::DOUBLE", "* 0.1::DOUBLE - 0.95::DOUBLE)").replace("* 0.1 - 1.2)::DOUBLE", "* 0.1::DOUBLE - 1.2::DOUBLE)")
    return exact + f""", ends AS (SELECT min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz FROM vertices),
t1 AS (SELECT vid, {', '.join(f'{a} - t[{i}] AS d{a}' for i, a in enumerate('xyz', 1))}, (x - lx) / (hx - lx + 1e-9) * {C.WIDTH} / 8 AS pu, (y - ly) / (hy - ly + 1e-9) * {C.HEIGHT} / 8 AS pv, z - lz + 0.1 AS rz FROM vertices, ends, (SELECT t FROM images WHERE idx = 0)),
t2 AS (SELECT vid, pu, pv, rz, {camera} FROM t1), t3 AS (SELECT *, cx / cz AS a, cy / cz AS b FROM t2 WHERE cz <> 0), t4 AS (SELECT vid, pu, pv, rz, {PX} AS tu, {PY} AS tv FROM t3),
t5 AS (SELECT * FROM t4 WHERE tu >= 0 AND tu < {C.WIDTH} AND tv >= 0 AND tv < {C.HEIGHT}),
t6 AS (SELECT fid, {gathered} FROM faces JOIN t5 q0 ON i0 = q0.vid JOIN t5 q1 ON i1 = q1.vid JOIN t5 q2 ON i2 = q2.vid),
t7 AS (SELECT *, greatest(floor(least({p('pu')})), 0)::BIGINT AS minx, least(ceil(greatest({p('pu')})), {w - 1})::BIGINT AS maxx, greatest(floor(least({p('pv')})), 0)::BIGINT AS miny, least(ceil(greatest({p('pv')})), {h - 1})::BIGINT AS maxy,
  (pv1 - pv2) * (pu0 - pu2) + (pu2 - pu1) * (pv0 - pv2) AS d FROM t6),
t8 AS (SELECT *, unnest(range(miny, maxy + 1)) AS yy FROM t7 WHERE maxx >= minx AND maxy >= miny AND (maxx - minx) * (maxy - miny) <= {texture.MAX_TRIANGLE_PIXELS} AND abs(d) >= 1e-6),
t9 AS (SELECT *, unnest(range(minx, maxx + 1)) AS xx FROM t8),
t10 AS (SELECT *, ((pv1 - pv2) * (xx - pu2) + (pu2 - pu1) * (yy - pv2)) / d AS a, ((pv2 - pv0) * (xx - pu2) + (pu0 - pu2) * (yy - pv2)) / d AS b FROM t9),
t11 AS (SELECT yy, xx, fid, 0 AS img, round({mixed('rz')}, 9) AS z, least(greatest(trunc({mixed('tu')} + 1e-6), 0), {C.WIDTH - 1})::BIGINT AS u, least(greatest(trunc({mixed('tv')} + 1e-6), 0), {C.HEIGHT - 1})::BIGINT AS v FROM t10 WHERE a >= 0 AND b >= 0 AND 1 - a - b >= 0),
done AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY yy, xx ORDER BY z, fid) AS k FROM t11) WHERE k = 1)"""


@query("q5_top_render", f"{top_sql()} {RENDERED}")
def q5_top_render(spark, sf):
    return texture.render_top(*scene(spark, sf), CAL, source=0, shrink=8)
