"""Meshes whose answers are known on paper: a cube, an open box, cubes apart, cubes that share a vertex, one inside another."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from facetforge.operators import forest, gates, geometry, graphs, meshes
from facetforge.operators.winding import winding

V, FACES = "sha string, vid long, x double, y double, z double", "sha string, fidx long, v0 long, v1 long, v2 long, pid int"
#: Twelve faces of a cube with corners numbered by x, y, z as bits, seen from outside.
CUBE = [(0, 2, 3), (0, 3, 1), (4, 5, 7), (4, 7, 6), (0, 1, 5), (0, 5, 4), (2, 6, 7), (2, 7, 3), (0, 4, 6), (0, 6, 2), (1, 3, 7), (1, 7, 5)]


def cube(sha, at=(0.0, 0.0, 0.0), side=1.0, pid=0, first=0, face=0, sides=range(12)):
    corners = [(sha, first + i, *(at[k] + side * (i >> k & 1) for k in range(3))) for i in range(8)]
    return corners, [(sha, face + n, *(first + v for v in CUBE[n]), pid) for n in sides]


def tables(spark, *cubes):
    vertices, faces = ([row for c in cubes for row in c[k]] for k in (0, 1))
    return spark.createDataFrame(vertices, V), spark.createDataFrame(faces, FACES)


def test_shapes_of_a_cube(spark):
    rows = meshes.shaped(*tables(spark, cube("a", side=2.0))).collect()
    assert len(rows) == 12 and sum(r.area for r in rows) == pytest.approx(24)
    for r in rows:  # normals look away from the middle
        assert (r.m_x - 1) * r.n_x + (r.m_y - 1) * r.n_y + (r.m_z - 1) * r.n_z == pytest.approx(1)


def test_winding_number_in_and_out(spark):
    shapes = meshes.shaped(*tables(spark, cube("a")))
    points = spark.createDataFrame([("a", 1, 0.5, 0.4, 0.3), ("a", 2, 2.0, 0.5, 0.5), ("a", 3, -0.1, 0.2, 0.2)], V)
    got = {r.vid: r.winding for r in winding(shapes, points, ["sha"]).collect()}
    assert abs(got[1]) == pytest.approx(1) and got[2] == pytest.approx(0, abs=1e-9) and got[3] == pytest.approx(0, abs=1e-9)


def ball(sha, at, radius, n, pid=0, first=0):
    """A closed ball of n rings of 2 n points, seen from outside."""
    place = lambda i, j: (math.sin(math.pi * i / n) * math.cos(math.pi * j / n), math.sin(math.pi * i / n) * math.sin(math.pi * j / n), math.cos(math.pi * i / n))
    vid = lambda i, j: first + (0 if i == 0 else 1 if i == n else 2 + (i - 1) * 2 * n + j % (2 * n))
    corners = {vid(i, j): (sha, vid(i, j), *(a + radius * b for a, b in zip(at, place(i, j)))) for i in range(n + 1) for j in range(2 * n)}
    faces = []
    for i, j in itertools.product(range(n), range(2 * n)):
        if i + 1 < n:
            faces.append((vid(i, j), vid(i + 1, j), vid(i + 1, j + 1)))
        if i:
            faces.append((vid(i, j), vid(i + 1, j + 1), vid(i, j + 1)))
    return list(corners.values()), [(sha, first + k, *f, pid) for k, f in enumerate(faces)]


def test_winding_tree_of_a_ball(spark):
    """Four thousand faces: within a hundredth of the exact sum, by far fewer rows than points times faces."""
    import random

    import numpy as np

    rng = random.Random(4)
    shapes = meshes.shaped(*tables(spark, ball("a", (0.3, -0.2, 5.0), 2.0, 32)))
    places = [[c + rng.uniform(-2.6, 2.6) for c in (0.3, -0.2, 5.0)] for _ in range(300)]
    points = spark.createDataFrame([("a", i, *p) for i, p in enumerate(places)], V)
    got = {r.vid: r.winding for r in winding(shapes, points, ["sha"], leaf=16).collect()}
    rows = np.array([[r[f"{p}_{a}"] for p in "abc" for a in "xyz"] for r in shapes.collect()]).reshape(-1, 3, 3)
    for i, p in enumerate(places):
        a, b, c = (rows[:, k] - np.array(p) for k in range(3))
        la, lb, lc = (np.linalg.norm(x, axis=1) for x in (a, b, c))
        up = (a * np.cross(b, c)).sum(1)
        exact = (2 * np.arctan2(up, la * lb * lc + (a * b).sum(1) * lc + (b * c).sum(1) * la + (c * a).sum(1) * lb)).sum() / (4 * math.pi)
        assert got[i] == pytest.approx(exact, abs=0.01)
    assert {round(abs(w)) for w in got.values()} == {0, 1}


def test_winding_of_many_points_in_one_place_and_of_none(spark):
    shapes = meshes.shaped(*tables(spark, ball("a", (0, 0, 0), 1.0, 8), cube("b", side=2.0), ([("c", i, 0.0, 0.0, 0.0) for i in range(3)], [("c", 0, 0, 1, 2, 0)])))
    points = spark.createDataFrame([(s, i, 0.1, 0.1, 0.2) for s in "abcd" for i in range(50)], V)
    got = {}
    for r in winding(shapes, points, ["sha"], leaf=4).collect():
        got.setdefault(r.sha, set()).add(round(abs(r.winding), 1))
    assert got == {"a": {1.0}, "b": {1.0}, "c": {0.0}}
    assert winding(shapes, points.limit(0), ["sha"]).count() == 0


def test_boundary_of_a_closed_and_an_open_box(spark):
    assert meshes.boundary(*tables(spark, cube("a"))).count() == 0
    rim = meshes.boundary(*tables(spark, cube("a", sides=range(10)))).collect()  # the side x = 1 is gone
    assert sorted((r.x, r.y, r.z) for r in rim) == [(1.0, 0.0, 0.5), (1.0, 0.5, 0.0), (1.0, 0.5, 1.0), (1.0, 1.0, 0.5)]


def test_new_open_edges(spark):
    before, after = (meshes.boundary(*tables(spark, cube("a", sides=s))) for s in (range(12), range(10)))
    diag = geometry.bounds(tables(spark, cube("a"))[0], ["sha"])
    assert [(r.sha, r.new_open) for r in gates.new_edges(before, after, diag).collect()] == [("a", 4)]
    assert [(r.sha, r.new_open) for r in gates.new_edges(after, after, diag).collect()] == [("a", 0)]
    assert [r.new_open for r in gates.new_edges(before, before, diag).collect()] == [0]  # a closed mesh has no open edges at all


def test_a_removal_keeps_shared_vertices_and_numbers_densely(spark):
    a, b = cube("a"), cube("a", (1.0, 1.0, 1.0), pid=1, first=7, face=12)
    b = (b[0][1:], b[1])  # vertex 7 is both cubes'
    vertices, faces = tables(spark, a, b)
    left, rest = meshes.renumbered(*meshes.kept(vertices, faces, F.col("pid") == 1))
    rows = sorted((r.vid, r.x, r.y, r.z) for r in left.collect())
    assert [r[0] for r in rows] == list(range(8)) and rows[0][1:] == (1.0, 1.0, 1.0)
    assert sorted(r.fidx for r in rest.collect()) == list(range(12)) and {v for r in rest.collect() for v in (r.v0, r.v1, r.v2)} == set(range(8))
    moved = meshes.moved(vertices, faces.where("pid = 1"), {"x": F.col("x") + 10})
    assert {r.vid for r in moved.where("x > 9").collect()} == set(range(7, 15))  # the shared vertex goes along


def test_scale_rotate_translate_about_the_part(spark):
    vertices, faces = tables(spark, *(cube(s) for s in "abc"))
    ops = spark.createDataFrame([("a", "scale"), ("b", "rotate"), ("c", "translate")], "sha string, op string")
    got, _ = meshes.edited(vertices, faces, F.col("pid") == 0, ops)
    at = {(r.sha, r.vid): (r.x, r.y, r.z) for r in got.collect()}
    assert at["a", 0] == pytest.approx((-0.25, -0.25, -0.25)) and at["c", 0] == pytest.approx((0.3, 0, 0))
    turn = math.radians(35)
    assert at["b", 0] == pytest.approx((0.5 - 0.5 * math.cos(turn) + 0.5 * math.sin(turn), 0.5 - 0.5 * math.sin(turn) - 0.5 * math.cos(turn), 0))


def test_replay_wants_enough_faces(spark):
    vertices, faces = tables(spark, cube("a"), cube("a", (2.0, 0, 0), pid=1, first=8, face=12))
    ops = spark.createDataFrame([("a", "scale")], "sha string, op string")
    for least, n in ((12, 8), (13, 0)):
        last, left, done = meshes.replayed(vertices, faces, F.col("pid") == 0, F.col("pid") == 1, ops, least)
        assert (last.count(), done.count()) == (n, n // 8) and {r.pid for r in left.collect()} <= {1}


def test_mirror_or_beside(spark):
    far, mid = cube("a", (3.0, 0, 0), pid=1, first=8, face=12), cube("b", (0, 3.0, 0), pid=1, first=8, face=12)
    got = meshes.doubled(*tables(spark, cube("a"), far, cube("b"), mid), F.col("pid") == 1)
    ops = {r.sha: r.op for r in got.collect()}
    assert ops == {"a": "mirror", "b": "duplicate"}
    assert sorted({round(r.x, 6) for r in got.where("sha = 'a'").collect()}) == [0.0, 1.0]  # about the mean of 0.5 and 3.5
    assert sorted({round(r.y, 6) for r in got.where("sha = 'b'").collect()}) == [4.15, 5.15]


def test_paste_on_top(spark):
    host, donor = tables(spark, cube("a", side=2.0))[0], tables(spark, cube("a", (7.0, 7.0, 7.0)))[0]
    got = meshes.pasted(host, donor, "top", 0.5).collect()
    assert min(r.z for r in got) == pytest.approx(2) and max(r.z for r in got) == pytest.approx(3)
    assert sum(r.x for r in got) / 8 == pytest.approx(1)
    assert min(r.z for r in meshes.pasted(host, donor, "top", 0.5, 0.02).collect()) == pytest.approx(1.96)
    around = spark.createDataFrame([("a", 0.0, 0.0, 0.0), ("a", 3.0, 3.0, 3.0)], "sha string, x double, y double, z double")
    got = meshes.pasted(host, donor, "around", 0.9, around=around).collect()
    assert max(r.x for r in got) - min(r.x for r in got) == pytest.approx(2.7) and sum(r.x for r in got) / 8 == pytest.approx(1.5)


def bodied(spark, *cubes):
    vertices, faces = tables(spark, *cubes)
    return meshes.shaped(vertices, faces).join(meshes.bodies(faces).select("sha", "fidx", "body"), ["sha", "fidx"]), geometry.bounds(vertices, ["sha"])


def test_bodies_hang_together_by_edges(spark):
    """Two cubes that share vertex 7 are two bodies, two that share an edge of four faces are two, a cube alone is one."""
    a, b = cube("a"), cube("a", (1.0, 1.0, 1.0), pid=1, first=7, face=12)
    faces = tables(spark, a, (b[0][1:], b[1]))[1]
    assert {(r.fidx // 12, r.body) for r in meshes.bodies(faces).collect()} == {(0, 0), (1, 12)}
    edge = [(s, f + 20, *(v + 100 if v not in (3, 7) else v for v in c), p) for s, f, *c, p in cube("a")[1]]
    got = meshes.bodies(spark.createDataFrame([*cube("a")[1], *edge], FACES)).collect()
    assert {(r.fidx >= 20, r.body) for r in got} == {(False, 0), (True, 20)}
    lone = spark.createDataFrame([("b", 5, 0, 1, 2, 0), ("b", 6, 2, 1, 3, 0), ("b", 9, 3, 4, 5, 0)], FACES)
    assert {r.fidx: r.body for r in meshes.bodies(lone).collect()} == {5: 5, 6: 5, 9: 9}
    assert meshes.bodies(lone.limit(0)).count() == 0


def test_orphans(spark):
    """Two cubes a third of the diagonal apart hang apart; a hundredth apart they don't."""
    for gap, orphan in ((0.8, True), (0.01, False)):
        shapes, diag = bodied(spark, cube("a"), cube("a", (1 + gap, 0, 0), pid=1, first=8, face=12))
        got = gates.isolated(shapes, diag).collect()
        assert {(r.body, r.faces, r.orphan) for r in got} == {(0, 12, orphan), (12, 12, orphan)}
        assert [r.orphans for r in gates.orphans(shapes, diag).collect()] == [2 * orphan]


def test_a_box_just_over_a_plate_is_no_orphan(spark):
    """No vertex of the plate is near the box, but its surface is."""
    plate = [("a", 100 + i, x, y, z) for i, (x, y, z) in enumerate(itertools.product((-10.0, 10.0), (-10.0, 10.0), (-0.1, 0.0)))]
    corner = [0, 4, 2, 6, 1, 5, 3, 7]  # of the cube's numbers, by x, y, z in turn
    sheet = [("a", 50 + n, *(100 + corner.index(v) for v in CUBE[n]), 1) for n in range(12)]
    shapes, diag = bodied(spark, cube("a", (-0.5, -0.5, 0.01)), (plate, sheet))
    assert {(r.body, r.orphan) for r in gates.isolated(shapes, diag).collect()} == {(0, False), (50, False)}


def test_orphans_of_few_and_small_bodies(spark):
    one = bodied(spark, cube("a"))
    assert [r.orphans for r in gates.orphans(*one).collect()] == [0]
    crumb = ([("a", 20, 9.0, 9.0, 9.0), ("a", 21, 9.0, 9.0, 9.5), ("a", 22, 9.0, 9.5, 9.0)], [("a", 30, 20, 21, 22, 2)])
    assert [r.orphans for r in gates.orphans(*bodied(spark, cube("a"), crumb)).collect()] == [-1]
    crumbs = (crumb[0] + [("a", 23 + i, float(i), 0.0, 0.0) for i in range(3)], crumb[1] + [("a", 31, 23, 24, 25, 2)])
    assert [r.orphans for r in gates.orphans(*bodied(spark, crumbs)).collect()] == [0]


def test_components_are_those_of_a_search(spark):
    import random

    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 400)]
    over = {x: x for ab in links for x in ab}

    def root(x):
        while over[x] != x:
            x = over[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        over[b] = a
    got = {r.node: r.label for r in graphs.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_roots_depend_on_the_order_of_links(spark):
    parts = spark.createDataFrame([("a", p) for p in range(5)] + [("b", 0)], "sha string, pid int")
    links = [("a", 0, 1, 1, 2), ("a", 0, 2, 1, 3), ("a", 3, 1, 4, 2)]
    got = forest.clusters(parts, spark.createDataFrame(links, "sha string, first int, second int, n1 int, n2 int")).collect()
    # 0 hangs on 1; then 0's root, 1, on 2; then 3 on 1's root, 2.
    assert {(r.sha, r.pid): r.cluster for r in got} == {("a", 0): 2, ("a", 1): 2, ("a", 2): 2, ("a", 3): 2, ("a", 4): 4, ("b", 0): 0}


def body(spark, rows):
    return spark.createDataFrame(rows, "sha string, sid long, x double, y double, z double, nx double, ny double, nz double, pid int")


def shell(at, side, pid, first, n=6):
    """Points on the faces of a box, with normals that look outward."""
    out, steps = [], [i / (n - 1) for i in range(n)]
    for axis, end, (a, b) in itertools.product(range(3), (0, 1), itertools.product(steps, steps)):
        p, nrm = [a, b], [0.0, 0.0, 0.0]
        p.insert(axis, end)
        nrm[axis] = 2.0 * end - 1
        out.append(("a", first + len(out), *(at[k] + side * p[k] for k in range(3)), *nrm, pid))
    return out


def test_a_forest_of_boxes(spark):
    """A large box; a small one inside it; a small one that lies on it; a far one."""
    points = body(spark, shell((0, 0, 0), 1.0, 0, 0, 12) + shell((0.4, 0.4, 0.4), 0.2, 1, 1000) + shell((0.4, 0.4, 0.995), 0.02, 2, 2000) + shell((3.0, 3.0, 3.0), 0.3, 3, 3000))
    areas = spark.createDataFrame([("a", 0, 6.0), ("a", 1, 0.24), ("a", 2, 0.0024), ("a", 3, 0.54)], "sha string, pid int, area double")
    inside = spark.createDataFrame([("a", 0, 1, 1.0), ("a", 0, 2, 0.0)], "sha string, large int, small int, inside double")
    cluster, tree, group = forest.forest(points, areas, inside)
    assert {r.pid: r.cluster for r in cluster.collect()} == {0: 0, 1: 1, 2: 2, 3: 3}
    assert {r.pid: (r.parent, r.rule) for r in tree.collect()} == {0: (None, None), 1: (0, "inside"), 2: (0, "attached"), 3: (None, None)}
    along = {}
    for r in group.collect():
        along.setdefault(r.root, set()).add(r.node)
    assert along == {0: {0, 1, 2}, 1: {1}, 2: {2}, 3: {3}}
    legend = {r.pid: r.cluster for r in forest.legend_clusters(cluster, tree).collect()}
    assert legend == {0: 0, 1: 0, 2: 0, 3: 3}


def test_the_forest_of_a_mesh(spark):
    """A cube inside a cube is its child by the winding number; one far off is nobody's."""
    vertices, faces = tables(spark, cube("a"), cube("a", (0.4, 0.3, 0.4), 0.3, pid=1, first=8, face=12), cube("a", (3.0, 3.0, 3.0), 0.4, pid=2, first=16, face=24))
    cluster, tree, group = forest.of_mesh(vertices, faces, 3000)
    assert {r.pid: (r.parent, r.rule, r.score) for r in tree.collect()} == {0: (None, None, None), 1: (0, "inside", 1.0), 2: (None, None, None)}
    assert {(r.root, r.node) for r in group.collect()} == {(0, 0), (0, 1), (1, 1), (2, 2)} and cluster.count() == 3


def test_two_hugging_shells_are_one_cluster(spark):
    points = body(spark, shell((0, 0, 0), 1.0, 0, 0) + shell((0.001, 0.001, 0.001), 1.0, 1, 1000))
    areas = spark.createDataFrame([("a", 0, 6.0), ("a", 1, 5.9)], "sha string, pid int, area double")
    cluster, _, group = forest.forest(points, areas)
    assert {r.cluster for r in cluster.collect()} == {1}  # the first hangs under the second
    assert {(r.root, r.node) for r in group.collect()} == {(0, 0), (0, 1), (1, 0), (1, 1)}


def test_exposure(spark):
    """Faces around a removed part that all look at it, all look away, or are too few."""
    part = spark.createDataFrame([(s, i / 10, 0.0, 0.0) for s in "abc" for i in range(11)], "sha string, x double, y double, z double")
    left = [(s, 0.5, 0.2 + i / 100, 0.0, 0.0, -1.0 if s == "a" else 1.0, 0.0) for s in "ab" for i in range(12)] + [("c", 0.5, 0.2, 0.0, 0.0, -1.0, 0.0)] * 3
    got = gates.exposure(part, spark.createDataFrame(left, "sha string, x double, y double, z double, nx double, ny double, nz double"), ["sha"])
    assert {r.sha: r.exposure for r in got.collect()} == {"a": 1.0, "b": 0.0, "c": 0.0}
    assert gates.exposure(part.where("x < 0.5"), left and spark.createDataFrame(left, "sha string, x double, y double, z double, nx double, ny double, nz double"), ["sha"]).where("exposure is not null").count() == 0


GATE = "key string, task string, sil_iou double, area_delta double, vis double, orphans int, exposure double, d_faces int, moved_frac double, mean_disp double, error string"


@pytest.mark.parametrize(
    ("row", "passes"),
    [
        (("k", "E1a", 0.93, None, None, None, None, None, None, None, None), True), (("k", "E1b", 0.92, None, None, None, None, None, None, None, None), False),
        (("k", "E3", None, 0.02, 0.3, 0, None, None, None, None, None), True), (("k", "E3", None, 0.02, 0.3, 0, 0.36, None, None, None, None), False),
        (("k", "E2", None, 0.6, 0.3, -1, 0.9, None, None, None, None), True), (("k", "E2", None, 0.61, 0.3, 0, None, None, None, None, None), False),
        (("k", "E3", None, 0.1, None, 0, None, None, None, None, None), False), (("k", "E3", None, 0.1, 0.5, 1, None, None, None, None, None), False),
        (("k", "E6", None, None, 0.3, 0, None, 0, 0.005, None, None), False), (("k", "E7", None, None, 0.3, 0, None, 2, None, None, None), True),
        (("k", "E9", None, None, None, None, None, None, None, 0.005, None), True), (("k", "E9", None, None, None, None, None, None, None, None, None), False),
        (("k", "E5", None, None, None, None, None, None, None, None, None), True), (("k", "E5", None, None, None, None, None, None, None, None, "broken"), False),
        (("k", "E2sem", None, None, None, 3, None, None, None, None, None), True),
    ],
)
def test_gate(spark, row, passes):
    assert [r.p for r in spark.createDataFrame([row], GATE).select(gates.passes().alias("p")).collect()] == [passes]


def test_a_chain_is_two_turns(spark):
    rows = spark.createDataFrame([("E10/a", "E10", None, 0.1, None, 0, 0.9, 1, None, None, None), ("E5/b", "E5", *[None] * 9)], GATE)
    got = sorted((r.key, r.task, r.vis, r.exposure) for r in gates.turns(rows).collect())
    assert got == [("E10/a#t1", "E3", 0.5, None), ("E10/a#t2", "E6", 0.5, None), ("E5/b", "E5", None, None)]


def test_samples_follow_the_areas(spark):
    vertices, faces = tables(spark, cube("a"), cube("a", (5.0, 0, 0), 2.0, pid=1, first=8, face=12))
    got = meshes.sampled(meshes.shaped(vertices, faces), 3000, 1)
    assert got.count() == 3000 and got.where("pid = 1").count() / 3000 == pytest.approx(0.8, abs=0.03)
    on = got.where("pid = 0").select(F.least("x", "y", "z", 1 - F.col("x"), 1 - F.col("y"), 1 - F.col("z")).alias("d")).agg(F.max("d"), F.min("d")).first()
    assert on[0] == pytest.approx(0, abs=1e-9) and on[1] == pytest.approx(0, abs=1e-9)


def test_the_gate_measures_what_each_task_asks(spark):
    """Two cubes side by side; one goes, comes, moves, is doubled; all is bent too far, or left as it is."""
    two = [cube("x"), cube("x", (1.02, 0, 0), pid=1, first=8, face=12)]
    of = lambda key, *cubes: [([(key, *v[1:]) for v in c[0]], [(key, *f[1:]) for f in c[1]]) for c in cubes]
    far = cube("x", (9.0, 0, 0), pid=1, first=8, face=12)
    near = cube("x", (1.0, 0.2, 0), pid=1, first=8, face=12)
    wide = ([(k, i, 2 * x, 2 * y, 2 * z) for c in two for k, i, x, y, z in c[0]], [f for c in two for f in c[1]])
    tall = ([(k, i, x, y, 3 * z) for c in two for k, i, x, y, z in c[0]], [f for c in two for f in c[1]])
    states = {  # task, before, after, the gate's word
        "E1a/same": ("E1a", two, [wide], True), "E1a/tall": ("E1a", two, [tall], False), "E3/cut": ("E3", two, two[:1], True), "E3/none": ("E3", two, two, False),
        "E2/put": ("E2", two[:1], two, False), "E6/near": ("E6", two, [two[0], near], True), "E6/far": ("E6", two, [two[0], far], False), "E6/still": ("E6", two, two, False),
        "E7/more": ("E7", two[:1], two, True), "E9/same": ("E9", two, two, False), "E9/tall": ("E9", two, [tall], False), "E9/few": ("E9", two, two[:1], False), "E5/any": ("E5", two, two[:1], True),
        "E10/c#t1": (None, two, two[:1], True), "E10/c#t2": (None, two[:1], [cube("x", (1.0, 0.2, 0))], True), "E3/broken": ("E3", two, two[:1], False),
    }
    before, after = (tables(spark, *(c for key, s in states.items() for c in of(key, *s[k]))) for k in (1, 2))
    rows = [(key, task, 0.9, "broken" if key == "E3/broken" else None) for key, (task, *_) in states.items() if task] + [("E10/c", "E10", None, None)]
    pairs = spark.createDataFrame(rows, "key string, task string, vis double, error string")
    removed = spark.createDataFrame([("E3/cut", 1)], "key string, pid int")
    got = {r.key: r for r in gates.judged(pairs, before, after, removed, samples=4000, res=16).collect()}
    assert set(got) == set(states)
    assert got["E3/cut"].area_delta == pytest.approx(0.5) and got["E3/cut"].exposure is not None and got["E3/cut"].new_open == 0 and got["E3/none"].area_delta == 0
    assert got["E2/put"].area_delta == pytest.approx(1) and got["E2/put"].orphans == 0
    assert got["E6/near"].moved_frac == pytest.approx(0.5) and got["E6/far"].orphans == 2 and got["E6/still"].moved_frac == 0
    assert got["E7/more"].d_faces == 12 and got["E7/more"].moved_frac is None
    assert got["E9/same"].mean_disp == 0 and got["E9/few"].mean_disp is None
    assert got["E1a/same"].sil_iou > 0.99 and got["E1a/tall"].sil_iou < 0.7
    assert (got["E10/c#t1"].task, got["E10/c#t1"].area_delta, got["E10/c#t2"].task) == ("E3", pytest.approx(0.5), "E6")
    assert got["E3/broken"].area_delta is None
    asked = {"E1a": {"sil_iou"}, "E3": {"area_delta", "orphans", "exposure", "new_open"}, "E2": {"area_delta", "orphans"}, "E6": {"orphans", "d_faces", "moved_frac"}, "E7": {"orphans", "d_faces", "moved_frac"}, "E9": {"mean_disp"}, "E5": set()}
    for r in got.values():  # nothing is measured that a task doesn't ask for
        assert {m for m in gates.METRICS if r[m] is not None} <= asked[r.task]
    assert {k: r.geo_pass for k, r in got.items()} == {k: s[3] for k, s in states.items()}
