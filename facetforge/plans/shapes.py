"""Geometry over points: `embeddings` with the first three components as x, y, z, the label as part, and one asset for
every hundred vectors; and texts that the pairs carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.functions import text
from facetforge.operators import gates, geometry, merging
from facetforge.plans.registry import query, table

POINTS_SQL = """points AS (SELECT vec_id // 100 AS sha, vec_id AS sid, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, label AS pid FROM embeddings)"""
BOX_SQL = f"""{POINTS_SQL}, box AS (SELECT sha, min(x) lo_x, max(x) hi_x, min(y) lo_y, max(y) hi_y, min(z) lo_z, max(z) hi_z, avg(x) c_x, avg(y) c_y, count(*) n FROM points GROUP BY sha)"""


def points(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    xyz = [F.col("embedding")[i].cast("double").alias(a) for i, a in enumerate(geometry.AXES)]
    return rows.select(F.floor(F.col("vec_id") / 100).alias("sha"), F.col("vec_id").alias("sid"), *xyz, F.col("label").alias("pid"))


@query(f"""WITH {POINTS_SQL} SELECT sha, pid, min(x) AS lo_x, max(x) AS hi_x, min(y) AS lo_y, max(y) AS hi_y, min(z) AS lo_z, max(z) AS hi_z, count(*) AS n,
round(sqrt((max(x) - min(x)) ** 2 + (max(y) - min(y)) ** 2 + (max(z) - min(z)) ** 2), 7) AS diag FROM points GROUP BY ALL""")
def q_bounds_diag(spark: SparkSession, sf: str) -> DataFrame:
    return geometry.bounds(points(spark, sf), ["sha", "pid"]).withColumn("diag", F.round("diag", 7))


@query(f"""WITH {POINTS_SQL}, c AS (SELECT sha, pid, avg(x) cx, avg(y) cy FROM points GROUP BY ALL)
SELECT p.sha, sid, p.pid, round(cx + 1.5 * (x - cx), 7) AS scaled_x,
  round(cx + (x - cx) * cos(radians(35)) - (y - cy) * sin(radians(35)), 7) AS turned_x,
  round(cy + (x - cx) * sin(radians(35)) + (y - cy) * cos(radians(35)), 7) AS turned_y FROM points p JOIN c ON c.sha = p.sha AND c.pid = p.pid""")
def q_centroid_affine(spark: SparkSession, sf: str) -> DataFrame:
    """Parts scaled and turned about their centroids."""
    pts = points(spark, sf)
    rows = pts.join(geometry.centroid(pts, ["sha", "pid"]), ["sha", "pid"])
    x, y = geometry.twisted(F.col("x"), F.col("y"), F.lit(1.0), F.col("c_x"), F.col("c_y"), 35.0)
    return rows.select("sha", "sid", "pid", F.round(F.col("c_x") + 1.5 * (F.col("x") - F.col("c_x")), 7).alias("scaled_x"), F.round(x, 7).alias("turned_x"), F.round(y, 7).alias("turned_y"))


@query(f"""WITH {BOX_SQL}, t AS (SELECT p.*, c_x, c_y, hi_x - lo_x AS ext, (z - lo_z) / greatest(hi_z - lo_z, 1e-6) AS t FROM points p JOIN box b ON b.sha = p.sha)
SELECT sha, sid, round(c_x + (x - c_x) * cos(radians(40) * t) - (y - c_y) * sin(radians(40) * t), 6) AS twist_x, round(c_y + (x - c_x) * sin(radians(40) * t) + (y - c_y) * cos(radians(40) * t), 6) AS twist_y,
  round(c_x + (x - c_x) * (1 - 0.45 * t), 6) AS taper_x, round(c_y + (y - c_y) * (1 - 0.45 * t), 6) AS taper_y, round(c_x + (x - c_x) * (1 + 0.35 * exp(-((t - 0.5) ** 2) / 0.05)), 6) AS bulge_x,
  round(c_y + (y - c_y) * (1 + 0.35 * exp(-((t - 0.5) ** 2) / 0.05)), 6) AS bulge_y, round(x + 0.35 * ext * t * t, 6) AS bend_x FROM t""")
def q_deform(spark: SparkSession, sf: str) -> DataFrame:
    pts = points(spark, sf)
    box = geometry.bounds(pts, ["sha"], mean=True)
    rows = pts.join(box, "sha").withColumn("t", (F.col("z") - F.col("lo_z")) / F.greatest(F.col("hi_z") - F.col("lo_z"), F.lit(1e-6)))
    made = {op: geometry.deformed(F.lit(op), F.col("hi_x") - F.col("lo_x")) for op in ("twist", "taper", "bulge", "bend")}
    sides = [F.round(v[k], 6).alias(f"{op}_{a}") for op, v in made.items() for k, a in enumerate("xy") if (op, a) != ("bend", "y")]
    return rows.select("sha", "sid", *sides)


@query(f"""WITH {BOX_SQL}, d AS (SELECT p.sha, abs(0.35 * (hi_x - lo_x) * ((z - lo_z) / greatest(hi_z - lo_z, 1e-6)) ** 2) AS way, sqrt((hi_x - lo_x) ** 2 + (hi_y - lo_y) ** 2 + (hi_z - lo_z) ** 2) AS diag
  FROM points p JOIN box b ON b.sha = p.sha), m AS (SELECT sha, avg(way) / any_value(diag) AS moved FROM d GROUP BY sha)
SELECT sha, round(moved, 7) AS moved, moved BETWEEN 0.005 AND 0.25 AS geo_pass FROM m""")
def q_displacement(spark: SparkSession, sf: str) -> DataFrame:
    """The gate of a deformation: equal vertex counts and a mean way inside the bounds."""
    pts = points(spark, sf)
    rows = pts.join(geometry.bounds(pts, ["sha"]).drop("n"), "sha")
    t = (F.col("z") - F.col("lo_z")) / F.greatest(F.col("hi_z") - F.col("lo_z"), F.lit(1e-6))
    after = rows.select("sha", "sid", geometry.bent(F.col("x"), t, F.col("hi_x") - F.col("lo_x")).alias("x"), "y", "z")
    moved = geometry.displacement(pts, after)
    return moved.select("sha", F.round("moved", 7).alias("moved"), F.coalesce(F.col("moved").between(0.005, 0.25), F.lit(False)).alias("geo_pass"))


@query(f"""WITH {POINTS_SQL}, b AS (SELECT sha, pid, min(x) ax, max(x) bx, min(y) ay, max(y) byy, min(z) az, max(z) bz, count(*) n FROM points GROUP BY ALL)
SELECT p.sha, p.pid AS small, q.pid AS large, round(greatest(least(p.bx, q.bx) - greatest(p.ax, q.ax), 0) * greatest(least(p.byy, q.byy) - greatest(p.ay, q.ay), 0)
 * greatest(least(p.bz, q.bz) - greatest(p.az, q.az), 0) / least(greatest(p.bx - p.ax, 1e-9) * greatest(p.byy - p.ay, 1e-9) * greatest(p.bz - p.az, 1e-9),
   greatest(q.bx - q.ax, 1e-9) * greatest(q.byy - q.ay, 1e-9) * greatest(q.bz - q.az, 1e-9)), 6) AS overlap
FROM b p JOIN b q ON p.sha = q.sha AND (p.n < q.n OR p.n = q.n AND p.pid > q.pid) AND q.n * 0.25 <= p.n WHERE p.n > 1 AND q.n > 1""")
def q_bbox_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Each part with the larger ones of its asset; pairs are of parts, of which an asset has few."""
    box = geometry.bounds(points(spark, sf), ["sha", "pid"]).where("n > 1")
    on = F.expr("p.sha = q.sha and (p.n < q.n or p.n = q.n and p.pid > q.pid) and q.n * 0.25 <= p.n")
    both = box.alias("p").join(box.alias("q"), on)
    return both.select("p.sha", F.col("p.pid").alias("small"), F.col("q.pid").alias("large"), F.round(geometry.overlap("p", "q"), 6).alias("overlap"))


def look(u: str, v: str, d: str, k: int) -> str:
    sign = "-" if k % 2 else ""
    at = lambda a: f"trunc(({a} - lo_{a}) / greatest(hi_{a} - lo_{a}, 1e-9) * 15)::INTEGER"
    return f"SELECT p.sha, sid, pid, {k} AS v, {at(u)} AS cu, {at(v)} AS cv, {sign}{d} AS depth FROM points p JOIN box b ON b.sha = p.sha"


LOOKS_SQL = " UNION ALL ".join(look(u, v, d, k) for k, (u, v, d) in enumerate([("x", "y", "z"), ("x", "y", "z"), ("y", "z", "x"), ("y", "z", "x"), ("x", "z", "y"), ("x", "z", "y")]))


@query(f"""WITH {BOX_SQL}, s AS ({LOOKS_SQL}), f AS (SELECT sha, v, pid FROM s QUALIFY row_number() OVER (PARTITION BY sha, v, cu, cv ORDER BY depth DESC, sid) = 1),
h AS (SELECT sha, v, pid, count(*) AS hits FROM f GROUP BY ALL), o AS (SELECT sha, v, pid, count(DISTINCT cu * 1000 + cv) AS cells FROM s GROUP BY ALL)
SELECT o.sha, o.pid, round(max(least(coalesce(hits, 0) / cells, 1.0)), 9) AS vis FROM o LEFT JOIN h ON h.sha = o.sha AND h.v = o.v AND h.pid = o.pid GROUP BY ALL""")
def q_zbuffer(spark: SparkSession, sf: str) -> DataFrame:
    return geometry.visibility(points(spark, sf), 16).withColumn("vis", F.round("vis", 9))


@query(f"""WITH {POINTS_SQL}, m AS (SELECT p.sha, p.sid, q.sid AS near_sid, sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2) AS d
  FROM points p JOIN points q ON p.sha = q.sha AND p.pid <> q.pid)
SELECT sha, sid, near_sid, round(d, 7) AS distance FROM m WHERE d <= 0.1 QUALIFY row_number() OVER (PARTITION BY sha, sid ORDER BY d, near_sid) = 1""")
def q_nn_join(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest point of another part within a tenth; q_nn_all has no such limit."""
    pts = points(spark, sf)
    return geometry.nearest(pts, pts, F.expr("p.pid <> q.pid"), 0.1).withColumn("distance", F.round("distance", 7))


@query(f"""WITH {POINTS_SQL}, m AS (SELECT p.sha, p.sid, q.sid AS near_sid, sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2) AS d
  FROM points p JOIN points q ON p.sha = q.sha AND p.pid <> q.pid)
SELECT sha, sid, near_sid, round(d, 7) AS distance FROM m QUALIFY row_number() OVER (PARTITION BY sha, sid ORDER BY d, near_sid) = 1""")
def q_nn_all(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest point of another part, however far, through cubes that widen."""
    pts = points(spark, sf)
    return geometry.nearest(pts, pts, F.expr("p.pid <> q.pid")).withColumn("distance", F.round("distance", 7))


@query("""SELECT event_id, json_extract_string('{' || '"k": ' || regexp_extract(props, '[0-9]+') || '}', '$.k')::INTEGER AS k FROM events WHERE regexp_extract(props, '[0-9]+') <> ''""")
def q_brace_json(spark: SparkSession, sf: str) -> DataFrame:
    """The answer inside the braces of what a model says."""
    said = text.braced(F.concat(F.lit("I think "), F.col("props"), F.lit(" so")))
    return table(spark, sf, "events").select("event_id", F.from_json(said, "k int").k.alias("k")).where("k is not null")


@query("SELECT doc_id, split_part(text, '. ', 1) AS instruction FROM documents")
def q_instruction_cut(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.before(F.col("text"), ". ").alias("instruction"))


@query("SELECT conv_id, string_agg(text, ' THEN ' ORDER BY turn) AS instruction FROM conversations GROUP BY conv_id")
def q_turns_join(spark: SparkSession, sf: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t.text), " THEN ").alias("instruction"))


@query("SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', -1) AS name FROM pages")
def q_path_parse(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.split("url", "/")
    return table(spark, sf, "pages").select("page_id", F.coalesce(F.get(parts, 2), F.lit("")).alias("host"), F.element_at(parts, -1).alias("name"))


@query("SELECT event_id, event_type = 'error' AS failed, right(props, 6) AS exc FROM events")
def q_error_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", (F.col("event_type") == "error").alias("failed"), F.right("props", F.lit(6)).alias("exc"))


@query("SELECT event_id, coalesce(nullif(event_type, ''), '?') AS shown, coalesce(nullif(value, 0), 1.0) AS weight FROM events")
def q_falsy_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.coalesce(merging.falsy(F.col("event_type")), F.lit("?"))
    return table(spark, sf, "events").select("event_id", shown.alias("shown"), F.coalesce(F.nullif(F.col("value"), F.lit(0.0)), F.lit(1.0)).alias("weight"))


@query(f"""WITH {BOX_SQL}, o AS (SELECT p.sha, p.sid, x, y, z FROM points p), n AS (SELECT p.sha, p.sid, x + 0.35 * (hi_x - lo_x) * ((z - lo_z) / greatest(hi_z - lo_z, 1e-6)) ** 2 AS x, y, z FROM points p JOIN box b ON b.sha = p.sha),
w AS (SELECT 0 AS s, * FROM o UNION ALL SELECT 1, * FROM n), f AS (SELECT s, sha, (min(x) + max(x)) / 2 cx, (min(y) + max(y)) / 2 cy, (min(z) + max(z)) / 2 cz, greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z), 1e-9) w FROM w GROUP BY ALL),
u AS (SELECT w.s, w.sha, trunc(least(greatest(((x - cx) / f.w + 0.5) * 15, 0), 15))::INTEGER a, trunc(least(greatest(((y - cy) / f.w + 0.5) * 15, 0), 15))::INTEGER b, trunc(least(greatest(((z - cz) / f.w + 0.5) * 15, 0), 15))::INTEGER c FROM w JOIN f ON f.s = w.s AND f.sha = w.sha),
v AS (SELECT s, sha, 0 AS ax, b AS p, c AS q FROM u UNION SELECT s, sha, 1, a, c FROM u UNION SELECT s, sha, 2, a, b FROM u),
i AS (SELECT sha, ax, p, q, count(*) AS k FROM v GROUP BY ALL), r AS (SELECT sha, ax, count(*) FILTER (k = 2) / count(*) AS iou FROM i GROUP BY ALL)
SELECT sha, round(avg(iou), 6) AS iou, avg(iou) >= 0.93 AS geo_pass FROM r GROUP BY sha""")
def q_silhouette_iou(spark: SparkSession, sf: str) -> DataFrame:
    """How far two states' outlines agree from three sides, each state in its own frame, and the gate on it."""
    pts = points(spark, sf)
    box = geometry.bounds(pts, ["sha"])
    rows = pts.join(box, "sha")
    t = (F.col("z") - F.col("lo_z")) / F.greatest(F.col("hi_z") - F.col("lo_z"), F.lit(1e-6))
    after = rows.withColumn("x", geometry.bent(F.col("x"), t, F.col("hi_x") - F.col("lo_x"))).select("sha", "sid", *geometry.AXES)
    found = geometry.silhouettes(pts.select("sha", "sid", *geometry.AXES), after, 16)
    return found.select("sha", F.round("iou", 6).alias("iou"), (F.col("iou") >= gates.SILHOUETTE).alias("geo_pass"))


@query(f"""WITH {BOX_SQL} SELECT p.sha, trunc((x - lo_x) / greatest(hi_x - lo_x, 1e-9) * 15)::INTEGER AS u, trunc((y - lo_y) / greatest(hi_y - lo_y, 1e-9) * 15)::INTEGER AS v,
round(avg(z), 7) AS colour FROM points p JOIN box b ON b.sha = p.sha GROUP BY ALL""")
def q_scatter_avg(spark: SparkSession, sf: str) -> DataFrame:
    above = geometry.seen_cells(points(spark, sf), 16, [("x", "y", "z", 1)])
    return above.groupBy("sha", "u", "v").agg(F.round(F.avg("depth"), 7).alias("colour"))


@query(f"""WITH {BOX_SQL} SELECT p.sha, sid, pid, round(2 * c_x - x, 7) AS x, 'mirror' AS op FROM points p JOIN box b ON b.sha = p.sha WHERE pid = 1
UNION ALL SELECT p.sha, sid, pid, round(x + 1.15 * (hi_x - lo_x), 7), 'duplicate' FROM points p JOIN box b ON b.sha = p.sha WHERE pid = 2
UNION ALL SELECT sha, sid, pid, round(x, 7), 'base' FROM points""")
def q_duplicate(spark: SparkSession, sf: str) -> DataFrame:
    """An asset with one part mirrored about its mean and another put beside it."""
    pts = points(spark, sf)
    box = geometry.bounds(pts, ["sha"]).join(geometry.centroid(pts, ["sha"]), "sha")
    made = pts.where("pid in (1, 2)").join(box, "sha")
    mirror = F.col("pid") == 1
    x = F.when(mirror, 2 * F.col("c_x") - F.col("x")).otherwise(F.col("x") + 1.15 * (F.col("hi_x") - F.col("lo_x")))
    made = made.select("sha", "sid", "pid", F.round(x, 7).alias("x"), F.when(mirror, "mirror").otherwise("duplicate").alias("op"))
    return made.unionByName(pts.select("sha", "sid", "pid", F.round("x", 7).alias("x"), F.lit("base").alias("op")))


@query("""WITH n AS (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id)
SELECT c.conv_id, turn, role FROM conversations c JOIN n ON n.conv_id = c.conv_id WHERE turn >= 2 AND turns > 2""")
def q_trailing(spark: SparkSession, sf: str) -> DataFrame:
    """What stands after the first two of a list: a list with such a row is longer than two by itself."""
    return table(spark, sf, "conversations").where("turn >= 2").select("conv_id", "turn", "role")


@query("""SELECT event_id, 'k' AS key, json_extract(props, '$.k')::INTEGER AS n FROM events WHERE json_extract(props, '$.k') IS NOT NULL""")
def q_map_explode(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", F.explode(F.from_json("props", "map<string,int>")).alias("key", "n"))
    return rows.where("key = 'k'")


@query("""SELECT doc_id, left(text, 8) AS head, right(text, 8) AS tail, starts_with(lower(text), 'the ') AS opens,
  replace(replace(replace(left(text, 20), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS shown FROM documents""")
def q_strings_misc(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.left("text", F.lit(20))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        shown = F.replace(shown, F.lit(sign), F.lit(name))
    opens = F.lower("text").startswith("the ")
    return table(spark, sf, "documents").select("doc_id", F.left("text", F.lit(8)).alias("head"), F.right("text", F.lit(8)).alias("tail"), opens.alias("opens"), shown.alias("shown"))


@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN lower(trim(p_name)) ELSE 'part' END AS name,
  replace('remove the {PART}', '{PART}', CASE WHEN p_size > 25 THEN lower(trim(p_name)) ELSE 'part' END) AS instruction FROM part""")
def q_naming_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Names from a model's answers, some of which are broken; a broken answer is the default name."""
    answer = F.when(F.col("p_size") > 25, F.to_json(F.struct(F.col("p_name").alias("part")))).otherwise(F.lit("no {answer"))
    rows = table(spark, sf, "part").select("p_partkey", text.named(answer).alias("name"))
    return rows.withColumn("instruction", text.filled(F.lit("remove the {PART}"), {"{PART}": F.col("name")}))


@query(f"""WITH {POINTS_SQL}, c AS (SELECT sha, pid, count(*) AS n FROM points GROUP BY ALL), big AS (SELECT sha, pid, n FROM c WHERE n > 12 QUALIFY row_number() OVER (PARTITION BY sha ORDER BY n DESC, pid) = 1)
SELECT a.sha, big.pid AS largest, coalesce(big.n, 0) AS n FROM (SELECT DISTINCT sha FROM points) a LEFT JOIN big ON big.sha = a.sha""")
def q_argmax_default(spark: SparkSession, sf: str) -> DataFrame:
    """The largest group of each asset among those of a least size; none, if there is none."""
    counts = points(spark, sf).groupBy("sha", "pid").agg(F.count("*").alias("n"))
    best = F.min(F.when(F.col("n") > 12, F.struct((-F.col("n")).alias("m"), "pid")))
    return counts.groupBy("sha").agg(best.alias("best")).select("sha", F.col("best.pid").alias("largest"), F.coalesce(-F.col("best.m"), F.lit(0)).cast("long").alias("n"))
