"""Edits of meshes. Vertices are `embeddings` (the first three components; one asset for every hundred), and each vertex with
the two after it is a face, whose part is the label; so neighbouring faces share vertices, across parts too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetforge.operators import atlas, gates, geometry, meshes, ordering, winding
from facetforge.operators.geometry import AXES
from facetforge.operators.storing import dealt
from facetforge.plans.registry import query, table

MESH_SQL = """vertices AS (SELECT vec_id // 100 AS sha, vec_id AS vid, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
faces AS (SELECT vec_id // 100 AS sha, vec_id AS fidx, vec_id AS v0, vec_id + 1 AS v1, vec_id + 2 AS v2, label AS pid FROM embeddings WHERE vec_id % 100 < 98),
tri AS (SELECT f.*, a.x ax, a.y ay, a.z az, b.x bx, b.y by_, b.z bz, c.x cx, c.y cy, c.z cz, (a.x + b.x + c.x) / 3 mx, (a.y + b.y + c.y) / 3 my, (a.z + b.z + c.z) / 3 mz,
  (b.y - a.y) * (c.z - a.z) - (b.z - a.z) * (c.y - a.y) px, (b.z - a.z) * (c.x - a.x) - (b.x - a.x) * (c.z - a.z) py, (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) pz
  FROM faces f JOIN vertices a ON a.vid = f.v0 JOIN vertices b ON b.vid = f.v1 JOIN vertices c ON c.vid = f.v2),
shape AS (SELECT *, sqrt(px * px + py * py + pz * pz) / 2 AS area FROM tri),
ext AS (SELECT sha, max(x) - min(x) ex, max(y) - min(y) ey, max(z) - min(z) ez, avg(x) gx, avg(y) gy, min(z) z0, max(z) z1, max(x) hx, min(x) lx, max(y) hy, min(y) ly,
  sqrt((max(x) - min(x)) ** 2 + (max(y) - min(y)) ** 2 + (max(z) - min(z)) ** 2) diag FROM vertices GROUP BY sha)"""
#: Where a vertex goes by op, with the centre (kx, ky, kz) and the sides (ex, ey).
MOVES_SQL = """CASE op WHEN 'scale' THEN kx + 1.5 * (x - kx) WHEN 'rotate' THEN kx + (x - kx) * cos(radians(35)) - (y - ky) * sin(radians(35)) ELSE x + CASE WHEN ex >= ey THEN 0.3 * ex ELSE 0 END END AS nx,
  CASE op WHEN 'scale' THEN ky + 1.5 * (y - ky) WHEN 'rotate' THEN ky + (x - kx) * sin(radians(35)) + (y - ky) * cos(radians(35)) ELSE y + CASE WHEN ex >= ey THEN 0 ELSE 0.3 * ey END END AS ny,
  CASE op WHEN 'scale' THEN kz + 1.5 * (z - kz) ELSE z END AS nz"""


def mesh(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "embeddings")
    sha = F.floor(F.col("vec_id") / 100).alias("sha")
    xyz = [F.col("embedding")[i].cast("double").alias(a) for i, a in enumerate(AXES)]
    vertices = rows.select(sha, F.col("vec_id").alias("vid"), *xyz)
    corners = [(F.col("vec_id") + k).alias(v) for k, v in enumerate(meshes.CORNERS)]
    faces = rows.where(F.col("vec_id") % 100 < 98).select(sha, F.col("vec_id").alias("fidx"), *corners, F.col("label").alias("pid"))
    return vertices, faces


def rounded(df: DataFrame, *also: str, digits: int = 6) -> DataFrame:
    return df.select(*also, *(F.round(a, digits).alias(a) for a in AXES))


def in_turn(rows: DataFrame, names: list[str]) -> DataFrame:
    """sha, op: the assets in their order take the operations in turn."""
    numbered = ordering.numbered(rows.select("sha").distinct(), "sha")
    return numbered.select("sha", F.get(F.array(*map(F.lit, names)), ((F.col("rn") - 1) % len(names)).cast("int")).alias("op"))


OPS_SQL = "ops AS (SELECT sha, ['scale', 'rotate', 'translate'][(row_number() OVER (ORDER BY sha) - 1) % 3 + 1] AS op FROM ext)"
OPS = ["scale", "rotate", "translate"]


@query(f"""WITH {MESH_SQL} SELECT sha, fidx, pid, round(area, 6) AS area, round(mx, 6) AS m_x, round(coalesce(pz / nullif(2 * area, 0), 0), 5) AS n_z FROM shape""")
def q_face_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Centre, normal and area of each face."""
    rows = meshes.shaped(*mesh(spark, sf))
    return rows.select("sha", "fidx", "pid", F.round("area", 6).alias("area"), F.round("m_x", 6).alias("m_x"), F.round("n_z", 5).alias("n_z"))


@query(f"""WITH {MESH_SQL}, b AS (SELECT sha, sum(area) AS total, count(*) AS n FROM shape GROUP BY sha), a AS (SELECT sha, sum(area) AS total, count(*) AS n FROM shape WHERE pid <> 2 GROUP BY sha)
SELECT b.sha, round(abs(a.total - b.total) / greatest(b.total, 1e-9), 7) AS area_delta, b.n - a.n AS d_faces FROM b JOIN a ON a.sha = b.sha""")
def q_area_delta(spark: SparkSession, sf: str) -> DataFrame:
    """How much area and how many faces a removal takes, over what was there before."""
    shapes = meshes.shaped(*mesh(spark, sf))
    sums = shapes.groupBy("sha").agg(
        F.sum("area").alias("before"), F.sum(F.when(F.col("pid") != 2, F.col("area"))).alias("after"), F.count("*").alias("n"), F.count_if(F.col("pid") != 2).alias("m")
    )
    rows = sums.where("m > 0")
    return rows.select("sha", F.round(gates.relative(F.col("after"), F.col("before")), 7).alias("area_delta"), (F.col("n") - F.col("m")).alias("d_faces"))


@query(f"""WITH {MESH_SQL}, f AS (SELECT * FROM faces WHERE pid <> 2), t AS (SELECT DISTINCT sha, unnest([v0, v1, v2]) AS vid FROM f),
v AS (SELECT v.*, row_number() OVER (PARTITION BY v.sha ORDER BY v.vid) - 1 AS n FROM vertices v JOIN t ON t.sha = v.sha AND t.vid = v.vid)
SELECT f.sha, row_number() OVER (PARTITION BY f.sha ORDER BY fidx) - 1 AS fidx, a.n AS v0, b.n AS v1, c.n AS v2, f.pid, round(a.x, 6) AS x FROM f JOIN v a ON a.vid = f.v0 JOIN v b ON b.vid = f.v1 JOIN v c ON c.vid = f.v2""")
def q_removed_mesh(spark: SparkSession, sf: str) -> DataFrame:
    """A part taken away: its faces, and the vertices that no other face has; the rest numbered densely."""
    vertices, faces = meshes.renumbered(*meshes.kept(*mesh(spark, sf), F.col("pid") != 2))
    first = vertices.select("sha", F.col("vid").alias("v0"), F.round("x", 6).alias("x"))
    return faces.select("sha", F.col("fidx").cast("long").alias("fidx"), *(F.col(v).cast("long").alias(v) for v in meshes.CORNERS), "pid").join(first, ["sha", "v0"])


@query(f"""WITH {MESH_SQL}, {OPS_SQL}, k AS (SELECT sha, avg(mx) kx, avg(my) ky, avg(mz) kz FROM shape WHERE pid IN (1, 3) GROUP BY sha),
t AS (SELECT DISTINCT sha, unnest([v0, v1, v2]) AS vid FROM faces WHERE pid IN (1, 3)),
m AS (SELECT v.sha, v.vid, x, y, z, t.vid IS NOT NULL AS hit, op, {MOVES_SQL} FROM vertices v JOIN k ON k.sha = v.sha JOIN ext e ON e.sha = v.sha JOIN ops o ON o.sha = v.sha LEFT JOIN t ON t.vid = v.vid)
SELECT sha, vid, op, round(CASE WHEN hit THEN nx ELSE x END, 6) AS x, round(CASE WHEN hit THEN ny ELSE y END, 6) AS y, round(CASE WHEN hit THEN nz ELSE z END, 6) AS z FROM m""")
def q_transform(spark: SparkSession, sf: str) -> DataFrame:
    """A unit of two parts scaled, turned or shifted about its centre, asset by asset in turn; shared vertices go along."""
    vertices, faces = mesh(spark, sf)
    made, done = meshes.edited(vertices, faces, F.col("pid").isin(1, 3), in_turn(vertices, OPS))
    return rounded(made, "sha", "vid").join(done, "sha")


@query(f"""WITH {MESH_SQL}, k AS (SELECT sha, avg(mx) AS ax, avg(mx) FILTER (pid = 1) AS kx FROM shape GROUP BY sha),
t AS (SELECT DISTINCT v.* FROM vertices v JOIN faces f ON f.pid = 1 AND v.vid IN (f.v0, f.v1, f.v2)), p AS (SELECT sha, max(x) - min(x) AS px, max(y) - min(y) AS py FROM t GROUP BY sha),
r AS (SELECT t.*, abs(kx - k.ax) > 0.12 * ex AS mirror, k.ax, px, py, ex, ey FROM t JOIN k ON k.sha = t.sha JOIN ext e ON e.sha = t.sha JOIN p ON p.sha = t.sha)
SELECT sha, vid, CASE WHEN mirror THEN 'mirror' ELSE 'duplicate' END AS op, round(CASE WHEN mirror THEN 2 * ax - x WHEN ex >= ey THEN x + 1.15 * px ELSE x END, 6) AS x,
  round(CASE WHEN mirror OR ex >= ey THEN y ELSE y + 1.15 * py END, 6) AS y, round(z, 6) AS z FROM r""")
def q_mirror(spark: SparkSession, sf: str) -> DataFrame:
    """A part's copy: on the other side if the part stands off the middle, else beside it."""
    return rounded(meshes.doubled(*mesh(spark, sf), F.col("pid") == 1), "sha", "vid", "op")


@query(f"""WITH {MESH_SQL}, {OPS_SQL}, f AS (SELECT * FROM shape WHERE pid <> 2), t AS (SELECT DISTINCT sha, unnest([v0, v1, v2]) AS vid FROM f),
k AS (SELECT sha, avg(mx) kx, avg(my) ky, avg(mz) kz FROM f WHERE pid = 1 GROUP BY sha HAVING count(*) >= 8),
h AS (SELECT DISTINCT sha, unnest([v0, v1, v2]) AS vid FROM f WHERE pid = 1),
m AS (SELECT v.sha, v.vid, x, y, z, h.vid IS NOT NULL AS hit, op, {MOVES_SQL} FROM vertices v JOIN t ON t.vid = v.vid JOIN k ON k.sha = v.sha JOIN ext e ON e.sha = v.sha JOIN ops o ON o.sha = v.sha LEFT JOIN h ON h.vid = v.vid)
SELECT sha, vid, op, round(CASE WHEN hit THEN nx ELSE x END, 6) AS x, round(CASE WHEN hit THEN ny ELSE y END, 6) AS y, round(CASE WHEN hit THEN nz ELSE z END, 6) AS z FROM m""")
def q_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Two turns: a part goes, then another is changed in what is left, if enough of it is."""
    vertices, faces = mesh(spark, sf)
    last, _, done = meshes.replayed(vertices, faces, F.col("pid") == 2, F.col("pid") == 1, in_turn(vertices, OPS), least=8)
    return rounded(last, "sha", "vid").join(done, "sha")


#: Faces that hang together by edges which exactly two faces have, once some parts are gone; named by their smallest face.
BODY_SQL = """f AS (SELECT * FROM faces WHERE pid NOT IN (5, 6, 7)),
side AS (SELECT sha, fidx, least(v0, v1) p, greatest(v0, v1) q FROM f UNION ALL SELECT sha, fidx, least(v1, v2), greatest(v1, v2) FROM f UNION ALL SELECT sha, fidx, least(v2, v0), greatest(v2, v0) FROM f),
two AS (SELECT min(fidx) a, max(fidx) b FROM side GROUP BY sha, p, q HAVING count(*) = 2 AND min(fidx) < max(fidx)), link AS (SELECT a, b FROM two UNION SELECT b, a FROM two),
reach(fidx, body) AS (SELECT fidx, fidx FROM f UNION SELECT link.b, reach.body FROM reach JOIN link ON link.a = reach.fidx),
body AS (SELECT fidx, min(body) AS body FROM reach GROUP BY fidx)"""


@query(f"""WITH RECURSIVE {MESH_SQL}, {BODY_SQL} SELECT f.sha, f.fidx, body FROM f JOIN body USING (fidx)""")
def q_components(spark: SparkSession, sf: str) -> DataFrame:
    """What hangs together by shared edges once some parts are gone, by the smallest face."""
    _, left = meshes.kept(*mesh(spark, sf), ~F.col("pid").isin(5, 6, 7))
    return meshes.bodies(left).select("sha", "fidx", "body")


@query(f"""WITH RECURSIVE {MESH_SQL}, {BODY_SQL}, size AS (SELECT sha, body, count(*) AS faces FROM f JOIN body USING (fidx) GROUP BY ALL),
own AS (SELECT s.*, body FROM shape s JOIN body USING (fidx) JOIN size USING (body) WHERE faces >= 4),
c AS (SELECT *, round(sum(area) OVER (PARTITION BY body ORDER BY fidx) / sum(area) OVER (PARTITION BY body), 12) AS hi,
  round((sum(area) OVER (PARTITION BY body ORDER BY fidx) - area) / sum(area) OVER (PARTITION BY body), 12) AS lo FROM own),
s AS (SELECT sha, body, ('0x' || left(md5('0u:' || sha || ':' || body || ':' || i), 8))::UBIGINT / 4294967296.0 AS u, ('0x' || left(md5('0r:' || sha || ':' || body || ':' || i), 8))::UBIGINT / 4294967296.0 AS r,
  ('0x' || left(md5('0s:' || sha || ':' || body || ':' || i), 8))::UBIGINT / 4294967296.0 AS t FROM size, range(0, 2000) g(i) WHERE faces >= 4 AND i < greatest(200, least(2000, faces))),
pt AS (SELECT s.sha, s.body, (1 - sqrt(r)) * ax + sqrt(r) * (1 - t) * bx + sqrt(r) * t * cx AS x, (1 - sqrt(r)) * ay + sqrt(r) * (1 - t) * by_ + sqrt(r) * t * cy AS y,
  (1 - sqrt(r)) * az + sqrt(r) * (1 - t) * bz + sqrt(r) * t * cz AS z FROM s JOIN c ON c.body = s.body AND lo <= u AND u < hi),
d AS (SELECT p.body, min(sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2)) AS away FROM pt p JOIN pt q ON p.sha = q.sha AND p.body <> q.body GROUP BY p.body),
o AS (SELECT z.sha, z.body, z.faces, away IS NULL OR away > 0.04 * diag AS orphan FROM size z JOIN ext e ON e.sha = z.sha LEFT JOIN d ON d.body = z.body WHERE faces >= 4),
n AS (SELECT z.sha, CASE WHEN count(*) < 2 THEN 0 WHEN count(*) FILTER (z.faces >= 4) = 1 THEN -1 ELSE count(*) FILTER (o.orphan) END::INTEGER AS orphans FROM size z LEFT JOIN o ON o.body = z.body GROUP BY z.sha)
SELECT o.sha, o.body, o.faces, o.orphan, n.orphans FROM o JOIN n ON n.sha = o.sha""")
def q_nn_isolation(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies left hanging in the air: no sample of their surface is nearer to another body's than a share of the asset's
    diagonal; and how many an asset has."""
    vertices, faces = mesh(spark, sf)
    left, rest = meshes.kept(vertices, faces, ~F.col("pid").isin(5, 6, 7))
    bodied = meshes.bodies(rest).select("sha", "fidx", "body")
    shapes = meshes.shaped(left, rest).join(dealt(bodied), ["sha", "fidx"])
    diag = geometry.bounds(vertices, ["sha"])
    return gates.isolated(shapes, diag, faces=bodied).join(dealt(gates.orphans(shapes, diag, faces=bodied)), "sha")


SIDES_SQL = "SELECT sha, least(v0, v1) a, greatest(v0, v1) b FROM {f} UNION ALL SELECT sha, least(v1, v2), greatest(v1, v2) FROM {f} UNION ALL SELECT sha, least(v2, v0), greatest(v2, v0) FROM {f}"


@query(f"""WITH {MESH_SQL}, g AS (SELECT * FROM faces WHERE pid <> 2), s0 AS ({SIDES_SQL.format(f="faces")}), s1 AS ({SIDES_SQL.format(f="g")}),
b0 AS (SELECT sha, a, b FROM s0 GROUP BY ALL HAVING count(*) = 1), b1 AS (SELECT sha, a, b FROM s1 GROUP BY ALL HAVING count(*) = 1),
m0 AS (SELECT s.sha, (p.x + q.x) / 2 x, (p.y + q.y) / 2 y, (p.z + q.z) / 2 z FROM b0 s JOIN vertices p ON p.vid = a JOIN vertices q ON q.vid = b),
m1 AS (SELECT s.sha, a, b, (p.x + q.x) / 2 x, (p.y + q.y) / 2 y, (p.z + q.z) / 2 z FROM b1 s JOIN vertices p ON p.vid = a JOIN vertices q ON q.vid = b)
SELECT e.sha, count(m1.sha) FILTER (NOT EXISTS (SELECT 1 FROM m0 WHERE m0.sha = m1.sha AND sqrt((m0.x - m1.x) ** 2 + (m0.y - m1.y) ** 2 + (m0.z - m1.z) ** 2) <= 0.01 * diag)) AS new_open
FROM ext e LEFT JOIN m1 ON m1.sha = e.sha GROUP BY e.sha""")
def q_open_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges that a removal leaves open, and that weren't near an open one before."""
    vertices, faces = mesh(spark, sf)
    after = meshes.boundary(*meshes.kept(vertices, faces, F.col("pid") != 2))
    return gates.new_edges(meshes.boundary(vertices, faces), after, geometry.bounds(vertices, ["sha"]))


DONOR_SQL = """host AS (SELECT * FROM vertices WHERE sha % 2 = 0), don AS (SELECT v.sha - 1 AS sha, v.vid, x, y, z FROM vertices v WHERE v.sha % 2 = 1 AND v.vid IN (SELECT unnest([v0, v1, v2]) FROM faces WHERE pid = 1)),
d AS (SELECT sha, avg(x) dx, avg(y) dy, avg(z) dz, min(z) low, sqrt((max(x) - min(x)) ** 2 + (max(y) - min(y)) ** 2 + (max(z) - min(z)) ** 2) dd FROM don GROUP BY sha),
own AS (SELECT sha, avg(mx) fx, avg(my) fy, avg(mz) fz, sqrt((max(mx) - min(mx)) ** 2 + (max(my) - min(my)) ** 2 + (max(mz) - min(mz)) ** 2) fd FROM shape WHERE pid = 1 GROUP BY sha)"""
ON_TOP_SQL = "(x - dx) * {s} * diag / greatest(dd, 1e-6) + gx AS x, (y - dy) * {s} * diag / greatest(dd, 1e-6) + gy AS y, (z - low) * {s} * diag / greatest(dd, 1e-6) + z1 - {sink} * ez AS z"


def donors(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """sha (the host's), vid, x, y, z: part 1 of every second asset, for the asset before it."""
    part, _ = meshes.kept(vertices, faces, F.col("pid") == 1)
    return part.where("sha % 2 = 1").withColumn("sha", F.col("sha") - 1)


@query(f"""WITH {MESH_SQL}, {DONOR_SQL}, r AS (SELECT 'attach' AS how, don.sha, vid, {ON_TOP_SQL.format(s=0.35, sink=0.0)} FROM don JOIN d ON d.sha = don.sha JOIN ext e ON e.sha = don.sha
UNION ALL SELECT 'add', don.sha, vid, {ON_TOP_SQL.format(s=0.3, sink=0.02)} FROM don JOIN d ON d.sha = don.sha JOIN ext e ON e.sha = don.sha
UNION ALL SELECT 'replace', don.sha, vid, (x - dx) * 0.9 * fd / greatest(dd, 1e-6) + fx, (y - dy) * 0.9 * fd / greatest(dd, 1e-6) + fy, (z - dz) * 0.9 * fd / greatest(dd, 1e-6) + fz FROM don JOIN d ON d.sha = don.sha JOIN own o ON o.sha = don.sha)
SELECT how, sha, vid, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM r""")
def q_paste(spark: SparkSession, sf: str) -> DataFrame:
    """Another asset's part put on top of this one in two ways, or in the place of one of its own parts."""
    vertices, faces = mesh(spark, sf)
    donor, host = donors(vertices, faces), vertices.where("sha % 2 = 0")
    own = meshes.shaped(vertices, faces).where("pid = 1").select("sha", *(F.col(f"m_{a}").alias(a) for a in AXES))
    made = {"attach": meshes.pasted(host, donor, "top", 0.35), "add": meshes.pasted(host, donor, "top", 0.3, 0.02), "replace": meshes.pasted(host, donor, "around", 0.9, around=own)}
    rows = [rounded(df.withColumn("how", F.lit(how)), "how", "sha", "vid") for how, df in made.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(f"""WITH {MESH_SQL}, {DONOR_SQL}, r AS (SELECT sha, x, y, z, 0 AS late FROM host UNION ALL SELECT don.sha, {ON_TOP_SQL.format(s=0.35, sink=0.0)}, 1 FROM don JOIN d ON d.sha = don.sha JOIN ext e ON e.sha = don.sha),
w AS (SELECT sha, (min(x) + max(x)) / 2 ox, (min(y) + max(y)) / 2 oy, (min(z) + max(z)) / 2 oz, greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) / 2 / 0.8 s FROM r GROUP BY sha),
b AS (SELECT sha, (min(x) + max(x)) / 2 mx, max(x) - min(x) ex, (min(z) + max(z)) / 2 mz, max(z) - min(z) ez FROM r WHERE late = 1 GROUP BY sha)
SELECT b.sha, round((mx - 0.575 * ex - ox) / s, 6) AS lo_x, round((mx + 0.575 * ex - ox) / s, 6) AS hi_x, round((mz - 0.575 * ez - oz) / s, 6) AS lo_z, round((mz + 0.575 * ez - oz) / s, 6) AS hi_z FROM b JOIN w ON w.sha = b.sha""")
def q_chain_geo(spark: SparkSession, sf: str) -> DataFrame:
    """The padded box of what an edit added (what stands after the geometry there was before), in the frame of the whole."""
    vertices, faces = mesh(spark, sf)
    host = vertices.where("sha % 2 = 0")
    before = host.groupBy("sha").agg(F.count("*").alias("n_before"))
    after = host.withColumn("late", F.lit(0)).unionByName(meshes.pasted(host, donors(vertices, faces), "top", 0.35).withColumn("late", F.lit(1)))
    ranked = numbered_inside(after).join(before, "sha")
    box = meshes.padded(geometry.bounds(ranked.where("idx >= n_before"), ["sha"]), 1.15)
    rows = box.join(meshes.cubed(after), "sha")
    return rows.select("sha", *(F.round((F.col(f"{e}_{a}") - F.col(f"o_{a}")) / F.col("scale"), 6).alias(f"{e}_{a}") for a in "xz" for e in ("lo", "hi")))


def numbered_inside(after: DataFrame) -> DataFrame:
    """idx: the place of each vertex in its asset, what was there before first. An asset is one group of a window."""
    return after.withColumn("idx", F.row_number().over(Window.partitionBy("sha").orderBy("late", "vid")) - 1)


@query(f"""WITH {MESH_SQL}, p AS (SELECT sha, pid, (min(mx) + max(mx)) / 2 cx, (min(my) + max(my)) / 2 cy, (min(mz) + max(mz)) / 2 cz, greatest(max(mx) - min(mx), max(my) - min(my), max(mz) - min(mz)) w FROM shape GROUP BY ALL),
h AS (SELECT p.*, greatest(1.1 * w, 0.15 * greatest(ex, ey, ez)) AS half, (lx + hx) / 2 AS ox, greatest(ex, ey, ez) / 2 / 0.8 AS s, e.diag FROM p JOIN ext e ON e.sha = p.sha)
SELECT sha, pid, round(cx - half, 6) AS lo_x, round(cx + half, 6) AS hi_x, round((cx - half - ox) / s, 6) AS in_cube, round((cx - half - ox) / s * s + ox, 6) AS back,
  round(cx - half + 5e-4 * sqrt(12 * half * half), 6) AS anchor_x FROM h""")
def q_frames(spark: SparkSession, sf: str) -> DataFrame:
    """A part's closeup box, its place in the asset's cube and back, and a corner of the frame's anchor."""
    vertices, faces = mesh(spark, sf)
    box = meshes.part_box(meshes.shaped(vertices, faces), vertices, ["sha", "pid"])
    held = meshes.anchors(box.withColumn("sha", F.struct("sha", "pid"))).where("anchor = 0 and corner = 1").select("sha.sha", "sha.pid", F.col("x").alias("anchor_x"))
    rows = box.join(held, ["sha", "pid"]).join(meshes.cubed(vertices), "sha").withColumn("in_cube", (F.col("lo_x") - F.col("o_x")) / F.col("scale"))
    rows = rows.withColumn("back", F.col("in_cube") * F.col("scale") + F.col("o_x"))
    return rows.select("sha", "pid", *(F.round(c, 6).alias(c) for c in ("lo_x", "hi_x", "in_cube", "back", "anchor_x")))


@query(f"""WITH {MESH_SQL}, n AS (SELECT sha, count(*) AS n FROM faces GROUP BY sha), c AS (SELECT sha FROM n WHERE n BETWEEN 50 AND 200000 AND sha % 7 NOT IN (3) ORDER BY sha LIMIT 40),
o AS (SELECT sha, ['twist', 'taper', 'bulge', 'bend'][(row_number() OVER (ORDER BY md5('5:' || sha), sha) - 1) % 4 + 1] AS op FROM c),
t AS (SELECT v.*, op, gx, gy, ex, (z - z0) / greatest(z1 - z0, 1e-6) AS t FROM vertices v JOIN o ON o.sha = v.sha JOIN ext e ON e.sha = v.sha)
SELECT sha, vid, op, round(CASE op WHEN 'twist' THEN gx + (x - gx) * cos(radians(60) * t) - (y - gy) * sin(radians(60) * t) WHEN 'taper' THEN gx + (x - gx) * (1 - 0.55 * t)
  WHEN 'bulge' THEN gx + (x - gx) * (1 + 0.5 * exp(-((t - 0.5) ** 2) / 0.05)) ELSE x + 0.35 * ex * t * t END, 6) AS x,
  round(CASE op WHEN 'twist' THEN gy + (x - gx) * sin(radians(60) * t) + (y - gy) * cos(radians(60) * t) WHEN 'taper' THEN gy + (y - gy) * (1 - 0.55 * t)
  WHEN 'bulge' THEN gy + (y - gy) * (1 + 0.5 * exp(-((t - 0.5) ** 2) / 0.05)) ELSE y END, 6) AS y FROM t""")
def q_deform_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """The first forty clean assets, shuffled, bent in four ways in turn."""
    vertices, faces = mesh(spark, sf)
    clean = faces.groupBy("sha").agg(F.count("*").alias("n")).where(F.col("n").between(50, 200_000) & (F.col("sha") % 7 != 3))
    few = clean.orderBy("sha").limit(40)
    ranked = ordering.numbered(few.withColumn("draw", ordering.draw(5, "sha")), "draw", "sha")
    ops = ranked.select("sha", F.get(F.array(*map(F.lit, ["twist", "taper", "bulge", "bend"])), ((F.col("rn") - 1) % 4).cast("int")).alias("op"))
    frame = geometry.bounds(vertices, ["sha"], mean=True)
    rows = vertices.join(ops, "sha").join(frame, "sha")
    rows = rows.withColumn("t", (F.col("z") - F.col("lo_z")) / F.greatest(F.col("hi_z") - F.col("lo_z"), F.lit(1e-6)))
    x, y = geometry.deformed(F.col("op"), wide=F.col("hi_x") - F.col("lo_x"), degrees=60.0, taper=0.55, bulge=0.5, bend=0.35)
    return rows.select("sha", "vid", "op", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query(f"""WITH {MESH_SQL}, c AS (SELECT *, round(sum(area) OVER (PARTITION BY sha ORDER BY fidx) / sum(area) OVER (PARTITION BY sha), 12) AS hi,
  round((sum(area) OVER (PARTITION BY sha ORDER BY fidx) - area) / sum(area) OVER (PARTITION BY sha), 12) AS lo FROM shape),
s AS (SELECT sha, i AS sid, ('0x' || left(md5('3u:' || sha || ':' || i), 8))::UBIGINT / 4294967296.0 AS u, ('0x' || left(md5('3r:' || sha || ':' || i), 8))::UBIGINT / 4294967296.0 AS r,
  ('0x' || left(md5('3s:' || sha || ':' || i), 8))::UBIGINT / 4294967296.0 AS t FROM ext, range(0, 200) g(i))
SELECT s.sha, sid::INTEGER AS sid, fidx, pid, round((1 - sqrt(r)) * ax + sqrt(r) * (1 - t) * bx + sqrt(r) * t * cx, 6) AS x, round((1 - sqrt(r)) * az + sqrt(r) * (1 - t) * bz + sqrt(r) * t * cz, 6) AS z
FROM s JOIN c ON c.sha = s.sha AND lo <= u AND u < hi""")
def q_sampling(spark: SparkSession, sf: str) -> DataFrame:
    """Points on the surface, by area; each with the corners' weights."""
    rows = meshes.sampled(meshes.shaped(*mesh(spark, sf)), 200, 3)
    return rows.select("sha", "sid", "fidx", "pid", F.round("x", 6).alias("x"), F.round("z", 6).alias("z"))


@query(f"""WITH {MESH_SQL}, q AS (SELECT * FROM vertices WHERE vid % 10 = 0), d AS (SELECT q.sha, q.vid, s.pid, ax - x a1, ay - y a2, az - z a3, bx - x b1, by_ - y b2, bz - z b3, cx - x c1, cy - y c2, cz - z c3 FROM q JOIN shape s ON s.sha = q.sha),
n AS (SELECT *, sqrt(a1*a1 + a2*a2 + a3*a3) la, sqrt(b1*b1 + b2*b2 + b3*b3) lb, sqrt(c1*c1 + c2*c2 + c3*c3) lc, a1*(b2*c3 - b3*c2) + a2*(b3*c1 - b1*c3) + a3*(b1*c2 - b2*c1) AS up FROM d)
SELECT sha, vid, pid, round(sum(2 * atan2(up, la*lb*lc + (a1*b1 + a2*b2 + a3*b3) * lc + (b1*c1 + b2*c2 + b3*c3) * la + (c1*a1 + c2*a2 + c3*a3) * lb)) / (4 * pi()), 5) AS winding
FROM n GROUP BY ALL""")
def q_winding(spark: SparkSession, sf: str) -> DataFrame:
    """How often each part's surface winds about some points, by a tree of face clusters; faces that have the point as a corner
    say nothing."""
    vertices, faces = mesh(spark, sf)
    shapes = meshes.shaped(vertices, faces)
    asked = vertices.where("vid % 10 = 0").join(faces.select("sha", "pid").distinct(), "sha")
    found = winding.winding(shapes, asked, ["sha", "pid"])
    return found.select("sha", "vid", "pid", F.round("winding", 5).alias("winding"))


UV_SQL = "uv AS (SELECT s.*, (ax + 1) / 2 au, (ay + 1) / 2 av, (bx + 1) / 2 bu, (by_ + 1) / 2 bv, (cx + 1) / 2 cu, (cy + 1) / 2 cv FROM shape s WHERE pid = 1)"


@query(f"""WITH {MESH_SQL}, {UV_SQL}, p AS (SELECT sha, fidx, au * 23 x0, (1 - av) * 23 y0, bu * 23 x1, (1 - bv) * 23 y1, cu * 23 x2, (1 - cv) * 23 y2 FROM uv),
g AS (SELECT i::INTEGER AS x, j::INTEGER AS y FROM range(0, 24) a(i), range(0, 24) b(j)),
e AS (SELECT sha, x, y, (x1 - x0) * (y - y0) - (y1 - y0) * (x - x0) AS s0, (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) AS s1, (x0 - x2) * (y - y2) - (y0 - y2) * (x - x2) AS s2 FROM p, g
  WHERE x BETWEEN least(x0, x1, x2) AND greatest(x0, x1, x2) AND y BETWEEN least(y0, y1, y2) AND greatest(y0, y1, y2)),
m AS (SELECT DISTINCT sha, x, y FROM e WHERE least(s0, s1, s2) >= -1e-9 OR greatest(s0, s1, s2) <= 1e-9),
w AS (SELECT DISTINCT m.sha, g.x, g.y FROM m JOIN g ON abs(g.x - m.x) <= 2 AND abs(g.y - m.y) <= 2),
o AS (SELECT i AS dx, j AS dy, exp(-(i * i) / 8.0) / (SELECT sum(exp(-(k * k) / 8.0)) FROM range(-4, 5) t(k)) * exp(-(j * j) / 8.0) / (SELECT sum(exp(-(k * k) / 8.0)) FROM range(-4, 5) t(k)) AS wt FROM range(-4, 5) a(i), range(-4, 5) b(j)),
b AS (SELECT w.sha, g.x, g.y, sum(wt) AS m FROM g CROSS JOIN o JOIN w ON w.x = least(greatest(g.x + dx, 0), 23) AND w.y = least(greatest(g.y + dy, 0), 23) GROUP BY ALL)
SELECT sha, x, y, round(m, 5) AS m, trunc(round((40 + x) * (1 - m) + (200 - y) * m, 6))::INTEGER AS colour FROM b""")
def q_texture(spark: SparkSession, sf: str) -> DataFrame:
    """A part's triangles in the atlas, widened and blurred into a mask, and two textures blended by it."""
    vertices, faces = mesh(spark, sf)
    skin = vertices.withColumns({"u": (F.col("x") + 1) / 2, "v": (F.col("y") + 1) / 2})
    hot = atlas.rastered(meshes.shaped(skin, faces.where("pid = 1"), ("u", "v")), 24, 24).withColumn("m", F.lit(1.0))
    mask = atlas.spread(atlas.spread(hot, "m", 24, 24, 2, "max"), "m", 24, 24, 4, "blur")
    mask = mask.withColumn("m", F.round("m", 12))
    base = mask.select("sha", "x", "y", (40 + F.col("x")).alias("colour"))
    edit = mask.select("sha", "x", "y", (200 - F.col("y")).alias("colour"))
    both = atlas.blended(base, edit, mask, ["colour"]).join(mask, ["sha", "x", "y"])
    return both.select("sha", "x", "y", F.round("m", 5).alias("m"), "colour")


def drawn_sql(seed: int, n: int) -> str:
    """Points of each surface, as CTEs c{seed} and s{seed}, by their numbers' hashes."""
    number = lambda k: f"('0x' || left(md5('{seed}{k}:' || sha || ':' || i), 8))::UBIGINT / 4294967296.0"
    return f"""s{seed} AS (SELECT sha, i AS sid, {number("u")} AS p, {number("r")} AS r, {number("s")} AS t FROM ext, range(0, {n}) g(i))"""


REBAKE_SQL = f"""cum AS (SELECT *, round(sum(area) OVER (PARTITION BY sha ORDER BY fidx) / sum(area) OVER (PARTITION BY sha), 12) AS hi,
  round((sum(area) OVER (PARTITION BY sha ORDER BY fidx) - area) / sum(area) OVER (PARTITION BY sha), 12) AS lo, (ax + 1) / 2 au, (ay + 1) / 2 av, (bx + 1) / 2 bu, (by_ + 1) / 2 bv, (cx + 1) / 2 cu, (cy + 1) / 2 cv,
  (ay + 1) / 2 aq, (az + 1) / 2 aw, (by_ + 1) / 2 bq, (bz + 1) / 2 bw, (cy + 1) / 2 cq, (cz + 1) / 2 cw FROM shape), {drawn_sql(0, 300)}, {drawn_sql(1, 300)},
mid AS (SELECT *, (lx + hx) / 2 ox, (ly + hy) / 2 oy, (z0 + z1) / 2 oz, greatest(ex, ey, ez, 1e-9) AS w FROM ext),
src AS (SELECT s.sha, sid, ((1 - sqrt(r)) * ax + sqrt(r) * (1 - t) * bx + sqrt(r) * t * cx - ox) / w x, ((1 - sqrt(r)) * ay + sqrt(r) * (1 - t) * by_ + sqrt(r) * t * cy - oy) / w y, ((1 - sqrt(r)) * az + sqrt(r) * (1 - t) * bz + sqrt(r) * t * cz - oz) / w z,
  (1 - sqrt(r)) * au + sqrt(r) * (1 - t) * bu + sqrt(r) * t * cu u, (1 - sqrt(r)) * av + sqrt(r) * (1 - t) * bv + sqrt(r) * t * cv v FROM s0 s JOIN cum c ON c.sha = s.sha AND lo <= p AND p < hi JOIN mid m ON m.sha = s.sha),
tgt AS (SELECT s.sha, sid, ((1 - sqrt(r)) * ax + sqrt(r) * (1 - t) * bx + sqrt(r) * t * cx - ox) / w x, ((1 - sqrt(r)) * ay + sqrt(r) * (1 - t) * by_ + sqrt(r) * t * cy - oy) / w y, ((1 - sqrt(r)) * az + sqrt(r) * (1 - t) * bz + sqrt(r) * t * cz - oz) / w z,
  (1 - sqrt(r)) * aq + sqrt(r) * (1 - t) * bq + sqrt(r) * t * cq u, (1 - sqrt(r)) * aw + sqrt(r) * (1 - t) * bw + sqrt(r) * t * cw v FROM s1 s JOIN cum c ON c.sha = s.sha AND lo <= p AND p < hi JOIN mid m ON m.sha = s.sha),
look AS (SELECT *, trunc(least((u - floor(u)) * 95, 95))::INTEGER px, trunc(greatest(least((1 - (v - floor(v))) * 79, 79), 0))::INTEGER py FROM src),
hue AS (SELECT *, CASE WHEN sha % 3 = 2 THEN 200 ELSE (sha * 7 + px * 5 + py * 3) % 256 END r, CASE WHEN sha % 3 = 2 THEN 200 ELSE (px * py) % 256 END g FROM look),
met AS (SELECT a.sha, a.sid, a.u, a.v, b.r, b.g FROM tgt a JOIN hue b ON b.sha = a.sha QUALIFY row_number() OVER (PARTITION BY a.sha, a.sid ORDER BY (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2, b.sid) = 1),
baked AS (SELECT sha, trunc(least((u - floor(u)) * 15, 15))::INTEGER tx, trunc(greatest(least((1 - (v - floor(v))) * 15, 15), 0))::INTEGER ty, trunc(avg(r))::INTEGER r, trunc(avg(g))::INTEGER g FROM met GROUP BY ALL),
grid AS (SELECT sha, i::INTEGER AS x, j::INTEGER AS y FROM ext, range(0, 16) a(i), range(0, 16) b(j)),
full_ AS (SELECT g.sha, g.x, g.y, t.r, t.g FROM grid g JOIN baked t ON t.sha = g.sha QUALIFY row_number() OVER (PARTITION BY g.sha, g.x, g.y ORDER BY (g.x - tx) ** 2 + (g.y - ty) ** 2, tx, ty) = 1)"""


def textured(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The meshes' vertices with u and v for a texture, their faces, and textures of 96 x 80 for two of three assets, in tiles."""
    vertices, faces = mesh(spark, sf)
    skinned = vertices.withColumns({"u": (F.col("x") + 1) / 2, "v": (F.col("y") + 1) / 2})
    rows = vertices.select("sha").distinct().where("sha % 3 <> 2")
    texel = lambda i: F.concat(*(F.lpad(F.hex(c % 256), 2, "0") for c in (F.col("sha") * 7 + i % 96 * 5 + F.floor(i / 96) * 3, i % 96 * F.floor(i / 96), F.lit(90), F.lit(255))))
    pixels = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(96 * 80 - 1)), texel), ""))
    images = rows.select(F.col("sha").alias("image"), F.lit(96).alias("wide"), F.lit(80).alias("high"), pixels.alias("pixels"))
    return skinned, faces, atlas.tiled(images)


def rebaked(spark: SparkSession, sf: str) -> DataFrame:
    """The meshes' textures brought onto the same meshes with another unwrapping."""
    vertices, faces, tiles = textured(spark, sf)
    other = vertices.withColumns({"u": (F.col("y") + 1) / 2, "v": (F.col("z") + 1) / 2})
    was, goal = (meshes.shaped(v, faces, ("u", "v")) for v in (vertices, other))
    return atlas.rebaked((vertices, was), (other, goal), tiles, 16, 300)


@query(f"""WITH {MESH_SQL}, {REBAKE_SQL} SELECT sha, x, y, r, g FROM full_""")
def q_rebake(spark: SparkSession, sf: str) -> DataFrame:
    """Colours looked up in textures of the surface's points, carried over to the nearest points of another unwrapping,
    averaged in each texel; empty texels take the nearest one's. Assets without a texture are grey."""
    return rebaked(spark, sf).select("sha", "x", "y", "r", "g")


@query(f"""WITH {MESH_SQL}, {REBAKE_SQL}, centre AS (SELECT s.sha, s.fidx, s.pid, (mx - ox) / w x, (my - oy) / w y, (mz - oz) / w z FROM shape s JOIN mid m ON m.sha = s.sha),
near AS (SELECT a.sha, a.fidx, b.pid FROM centre a JOIN centre b ON b.sha = a.sha AND b.fidx % 2 = 0 QUALIFY row_number() OVER (PARTITION BY a.fidx ORDER BY sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2), b.fidx) = 1),
hot AS (SELECT sha, fidx FROM near WHERE pid = 1), cnt AS (SELECT f.sha, count(h.fidx) / count(*) AS part_face_share FROM faces f LEFT JOIN hot h ON h.fidx = f.fidx GROUP BY f.sha HAVING count(h.fidx) / count(*) >= 0.01),
tri2 AS (SELECT c.sha, aq * 15 x0, (1 - aw) * 15 y0, bq * 15 x1, (1 - bw) * 15 y1, cq * 15 x2, (1 - cw) * 15 y2 FROM cum c JOIN hot USING (fidx)),
g AS (SELECT i::INTEGER AS x, j::INTEGER AS y FROM range(0, 16) a(i), range(0, 16) b(j)),
e AS (SELECT sha, x, y, (x1 - x0) * (y - y0) - (y1 - y0) * (x - x0) AS s0, (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) AS s1, (x0 - x2) * (y - y2) - (y0 - y2) * (x - x2) AS s2 FROM tri2, g
  WHERE x BETWEEN least(x0, x1, x2) AND greatest(x0, x1, x2) AND y BETWEEN least(y0, y1, y2) AND greatest(y0, y1, y2)),
m AS (SELECT DISTINCT sha, x, y FROM e WHERE least(s0, s1, s2) >= -1e-9 OR greatest(s0, s1, s2) <= 1e-9),
wd AS (SELECT DISTINCT m.sha, g.x, g.y FROM m JOIN g ON abs(g.x - m.x) <= 2 AND abs(g.y - m.y) <= 2),
k AS (SELECT i AS d, exp(-(i * i) / 8.0) / (SELECT sum(exp(-(q * q) / 8.0)) FROM range(-4, 5) t(q)) AS wt FROM range(-4, 5) a(i)),
bl AS (SELECT wd.sha, g.x, g.y, sum(p.wt * q.wt) AS m FROM g CROSS JOIN k p CROSS JOIN k q JOIN wd ON wd.x = least(greatest(g.x + p.d, 0), 15) AND wd.y = least(greatest(g.y + q.d, 0), 15) GROUP BY ALL)
SELECT f.sha, f.x, f.y, trunc(round(f.r * (1 - coalesce(m, 0)) + f.x * 10 * coalesce(m, 0), 6))::INTEGER AS r, trunc(round(f.g * (1 - coalesce(m, 0)) + f.y * 10 * coalesce(m, 0), 6))::INTEGER AS g, round(part_face_share, 6) AS part_face_share
FROM full_ f JOIN cnt ON cnt.sha = f.sha LEFT JOIN bl ON bl.sha = f.sha AND bl.x = f.x AND bl.y = f.y""")
def q_texture_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A part's texture taken from an edited atlas and the rest from the rebaked one, from label transfer to blend: faces take
    the part of the nearest face of the original, the part's triangles become a mask, and assets with too little of it go."""
    vertices, faces, _ = textured(spark, sf)
    other = vertices.withColumns({"u": (F.col("y") + 1) / 2, "v": (F.col("z") + 1) / 2})
    shapes = meshes.shaped(other, faces, ("u", "v"))
    centres = atlas.unit_frame(shapes.select("sha", F.col("fidx").alias("sid"), *(F.col(f"m_{a}").alias(a) for a in AXES), "pid"), vertices)
    near = geometry.nearest(centres, centres.where("sid % 2 = 0"), F.lit(True)).select("sha", F.col("sid").alias("fidx"), F.col("near_sid").alias("sid"))
    hot = near.join(dealt(centres.select("sha", "sid", "pid")), ["sha", "sid"]).where("pid = 1").select("sha", "fidx")
    base = rebaked(spark, sf)
    edit = base.select("sha", "x", "y", (F.col("x") * 10).alias("r"), (F.col("y") * 10).alias("g"), F.lit(90).alias("b"), F.lit(255).alias("a"))
    made, share = atlas.merged(base, edit, shapes, hot, 16, 16)
    return made.join(dealt(share), "sha").select("sha", "x", "y", "r", "g", F.round("part_face_share", 6).alias("part_face_share"))
