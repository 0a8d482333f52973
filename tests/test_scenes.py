"""Texturing of a flat grid, scans, clouds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions.calibration import HEIGHT, IDENTITY, NO_SHIFT, WIDTH, Calibration
from scanloom.operators import cloud, pair, scan, tau, texture

FLAT = Calibration(rotation=IDENTITY, shift=NO_SHIFT)


@pytest.fixture(scope="module")
def grid(spark):
    n = 6
    v = [(i * n + j, -1 + 2 * j / (n - 1), -1 + 2 * i / (n - 1), 3.0) for i in range(n) for j in range(n)]
    f = []
    for i in range(n - 1):
        for j in range(n - 1):
            a = i * n + j
            f += [(len(f), a, a + 1, a + n), (len(f) + 1, a + 1, a + n + 1, a + n)]
    one = [float(i % 4 == 0) for i in range(9)]
    images = spark.createDataFrame([(0, one, [0.0, 0.0, 0.0]), (1, one, [0.0, 0.0, 0.0])], "idx long, r array<double>, t array<double>")
    return spark.createDataFrame(f, "fid long, i0 long, i1 long, i2 long"), spark.createDataFrame(v, "vid long, x double, y double, z double"), images


def test_faces_take_their_own_image(spark, grid):
    faces, vertices, images = grid
    half = faces.select("fid", (F.col("fid") % 2).alias("best_img"))
    got = texture.render(faces, vertices, half, images, FLAT, view=0, shrink=4)
    by_image = {r["img"]: r["n"] for r in got.groupBy("img").agg(F.count("*").alias("n")).collect()}
    assert by_image[0] > 50 and by_image[1] > 50
    assert got.filter("abs(z - 3) > 1e-6").count() == 0
    grey = got.select(F.col("img").alias("idx"), "u", "v").distinct().select("*", F.lit(1).alias("b"), F.lit(0).alias("g"), F.lit(0).alias("r"))
    assert texture.coverage(texture.colour(got, grey), WIDTH // 4, HEIGHT // 4).collect()[0][0] > 0.05


def test_unseen_faces_stay_black_and_all_faces_are_seen(spark, grid):
    faces, vertices, images = grid
    none = faces.select("fid", F.lit(-1).cast("long").alias("best_img"))
    assert texture.render(faces, vertices, none, images, FLAT, view=0).count() == 0
    best = texture.best_images(faces, vertices, images, FLAT)
    assert texture.seen_share(best).collect()[0][0] == 1.0
    assert {r["best_img"] for r in best.collect()} == {0}  # equal scores: the lowest image
    for size, chunk in ((1, 1), (4, 7)):
        assert sorted(texture.best_images(faces, vertices, images, FLAT, size, chunk).collect()) == sorted(best.collect())


def room(spark, n_images, seed=5):
    """A box of 12 x 8 x 5 with cameras inside that look all ways."""
    rng = np.random.default_rng(seed)
    size, v, f = np.array([12.0, 8.0, 5.0]), [], []
    for axis in range(3):
        for end in (0.0, size[axis]):
            a, b = [k for k in range(3) if k != axis]
            base, na, nb = len(v), 14, 11
            for i in range(na):
                for j in range(nb):
                    p = np.zeros(3)
                    p[axis], p[a], p[b] = end, size[a] * i / (na - 1), size[b] * j / (nb - 1)
                    v.append((len(v), *p.tolist()))
            for i in range(na - 1):
                for j in range(nb - 1):
                    k = base + i * nb + j
                    f += [(len(f), k, k + 1, k + nb), (len(f) + 1, k + 1, k + nb + 1, k + nb)]
    images = []
    for i in range(n_images):
        q = rng.normal(size=4)
        x, y, z, w = (q / np.linalg.norm(q)).tolist()
        r = [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)]
        r += [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]
        images.append((i, r, rng.uniform(size * 0.1, size * 0.9).tolist()))
    frame = spark.createDataFrame
    return frame(f, "fid long, i0 long, i1 long, i2 long"), frame(v, "vid long, x double, y double, z double"), frame(images, "idx long, r array<double>, t array<double>")


def brute_best(faces, vertices, images, cal):
    v = {r["vid"]: np.array([r["x"], r["y"], r["z"]]) for r in vertices.collect()}
    world = {r["idx"]: (np.array(r["w"][:9]).reshape(3, 3), np.array(r["w"][9:])) for r in texture.world_to_camera_table(images, cal).collect()}
    k1, k2, p1, p2, k3 = cal.distortion
    out, seen = {}, 0
    for f in faces.collect():
        a, b, c = v[f["i0"]], v[f["i1"]], v[f["i2"]]
        n, m, best = np.cross(b - a, c - a), (a + b + c) / 3, (-1.0, 1)
        n = n / (np.linalg.norm(n) + 1e-12)
        for idx in sorted(world):
            r, t = world[idx]
            p = r @ m + t
            if p[2] <= 0:
                continue
            x, y = p[0] / p[2], p[1] / p[2]
            r2 = x * x + y * y
            g = 1 + k1 * r2 + k2 * r2**2 + k3 * r2**3
            u = cal.fx * (x * g + 2 * p1 * x * y + p2 * (r2 + 2 * x * x)) + cal.cx
            w = cal.fy * (y * g + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y) + cal.cy
            if 0 <= u < cal.width and 0 <= w < cal.height:
                seen += 1
                to = -r.T @ t - m
                best = max(best, (round(abs(float(n @ to / (np.linalg.norm(to) + 1e-12))), 9), -idx))
        out[f["fid"]] = (best[0], -best[1])
    return out, seen


def test_cameras_inside_a_room_meet_what_they_may_see(spark):
    cal = Calibration()
    faces, vertices, images = room(spark, 40)
    wanted, seen = brute_best(faces, vertices, images, cal)
    got = {r["fid"]: (r["best_score"], r["best_img"]) for r in texture.best_images(faces, vertices, images, cal, 8, 50).collect()}
    assert got.keys() == wanted.keys()
    for fid, (score, idx) in wanted.items():
        assert got[fid][0] == pytest.approx(score, abs=2e-9) and (got[fid][1] == idx or score < 0)
    flat, cameras = texture.seen_pairs(faces, vertices, images, cal, 8)
    met, product = flat.join(cameras, "cell").count(), faces.count() * images.count()
    print(f"pairs met {met}, seen {seen}, of {product}")
    assert seen <= met < 0.25 * product


def test_a_long_corridor_meets_under_a_tenth(spark):
    """Cameras that look across a corridor see little of it."""
    n, m = 400, 4
    v = [(i * m + j, 0.25 * i, 1.0, 0.8 * j) for i in range(n) for j in range(m)]
    f = [(2 * (i * m + j) + k, i * m + j + k, i * m + j + 1 + (m if k else 0), (i + 1) * m + j) for i in range(n - 1) for j in range(m - 1) for k in (0, 1)]
    across = [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, -1.0, 0.0]  # the sensor's z along the corridor's y
    images = [(i, across, [i * 2.0, 0.0, 1.0]) for i in range(50)]
    frame = spark.createDataFrame
    faces, vertices = frame(f, "fid long, i0 long, i1 long, i2 long"), frame(v, "vid long, x double, y double, z double")
    images = frame(images, "idx long, r array<double>, t array<double>")
    wanted, seen = brute_best(faces, vertices, images, FLAT)
    got = {r["fid"]: (r["best_score"], r["best_img"]) for r in texture.best_images(faces, vertices, images, FLAT, 16).collect()}
    assert all(got[k][0] == pytest.approx(s, abs=2e-9) and (got[k][1] == i or s < 0) for k, (s, i) in wanted.items())
    flat, cameras = texture.seen_pairs(faces, vertices, images, FLAT, 16)
    met, product = flat.join(cameras, "cell").count(), faces.count() * images.count()
    print(f"pairs met {met}, seen {seen}, of {product}")
    assert seen and seen <= met < 0.1 * product


def test_bounds_of_rays():
    from scanloom.operators.frustum import ray_bounds

    cal = Calibration()
    bx, by = ray_bounds(cal)
    x, y = np.meshgrid(np.linspace(-6, 6, 1201), np.linspace(-6, 6, 1201))
    k1, k2, p1, p2, k3 = cal.distortion
    r2 = x * x + y * y
    g = 1 + r2 * (k1 + r2 * (k2 + r2 * k3))
    u = cal.fx * (x * g + 2 * p1 * x * y + p2 * (r2 + 2 * x * x)) + cal.cx
    w = cal.fy * (y * g + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y) + cal.cy
    ok = (u >= 0) & (u < WIDTH) & (w >= 0) & (w < HEIGHT)
    assert np.abs(x[ok]).max() <= bx < 1.2 * np.abs(x[ok]).max() and np.abs(y[ok]).max() <= by < 1.25 * np.abs(y[ok]).max()
    assert ray_bounds(Calibration(distortion=(-0.5, 0.0, 0.0, 0.0, 0.0))) is None  # bends far rays back into the frame


def test_plane_and_core_find_a_board(spark):
    rng = np.random.default_rng(3)
    board = [
        (1, float(x), float(y), 0.8 + float(e), 0.01) for x, y,
        e in zip(rng.uniform(-0.3, 0.3, 200), rng.uniform(-0.3, 0.3, 200), rng.normal(0, 0.002, 200))
    ]
    noise = [(1, float(x), float(y), float(z), 0.05) for x, y, z in zip(rng.uniform(-1, 1, 60), rng.uniform(-1, 1, 60), rng.uniform(0.45, 1.15, 60))]
    points = spark.createDataFrame(board + noise + [(2, 0.0, 0.0, 0.8, 0.0)], "scan_id long, x double, y double, z double, time double")
    got = scan.board_plane(points, FLAT, scan.BANDS["near"], 0.02, 1.2, 0.08).collect()
    assert [r["scan_id"] for r in got] == [1] and got[0]["n"] >= 200 and got[0]["depth"] == pytest.approx(0.8, abs=0.005)
    core = scan.core_centroid(points, FLAT, scan.BANDS["near"]).collect()
    assert [r["scan_id"] for r in core] == [1] and core[0]["depth"] == pytest.approx(0.8, abs=0.02)
    assert scan.dominant_plane(points.filter("scan_id = 2"), 0.1).count() == 0  # one point spans no plane
    whole, parts = (scan.dominant_plane(points, 0.02, chunk_rows=n).collect() for n in (10**6, 37))
    assert whole == parts and abs(whole[0]["plane"][2]) > 0.99


def test_time_offset_is_found(spark):
    t = np.arange(0, 6, 0.05)
    curve = lambda x: 100 * np.sin(1.7 * x) + 20 * x
    cam = spark.createDataFrame([(float(a), float(curve(a))) for a in t], "t double, x double")
    lid = spark.createDataFrame([(float(a) + 0.123, float(curve(a))) for a in t[5:-5] + 0.01], "t double, x double")
    got = {r["part"]: r["tau"] for r in tau.shift_with_halves(cam, lid).collect()}
    assert got.keys() == {"all", "first", "second"} and all(abs(x - 0.123) < 0.003 for x in got.values())
    none = tau.best_shift(cam, lid.limit(3)).collect()[0]
    assert none["tau"] == 0.0 and none["mse"] == float("inf")


def test_pairs_are_mutual_nearest(spark):
    rng = np.random.default_rng(5)
    a, b = sorted(rng.integers(0, 10_000, 60).tolist()), sorted(rng.integers(0, 10_000, 60).tolist())
    df = lambda x: spark.createDataFrame(list(enumerate(x)), "seq long, us long")
    got = {(r["l_id"], r["r_id"]) for r in pair.pair_nearest(df(a), df(b), 100).collect()}
    best_r = {i: min((abs(x - y), y, j) for j, y in enumerate(b)) for i, x in enumerate(a)}
    best_l = {j: min((abs(x - y), x, i) for i, x in enumerate(a)) for j, y in enumerate(b)}
    want = {(i, best_r[i][2]) for i in best_r if best_r[i][0] <= 100 and best_l[best_r[i][2]][2] == i}
    assert got == want


def test_outliers_distances_and_downsample(spark):
    rng = np.random.default_rng(0)
    p = [(i, *map(float, rng.uniform(0, 1, 3))) for i in range(300)] + [(300, 3.0, 3.0, 3.0)]
    df = spark.createDataFrame(p, "id long, x double, y double, z double")
    got = {r["id"]: r["keep"] for r in scan.outlier_removal(df, 0.4, 8).collect()}
    assert not got[300] and sum(got.values()) > 250
    d = {r["id"]: r["distance"] for r in cloud.nearest_distance(df, df, 0.5).collect()}
    assert all(x == 0 for x in d.values())
    assert cloud.downsample(df, 10).collect() == cloud.downsample(df.repartition(7), 10).collect()
    assert cloud.time_field(["x", "stamps", "t"]) == "t" and cloud.time_field(["x"]) is None
