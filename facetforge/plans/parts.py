"""Parts of assets: shares, bases, picks, offsets, caps and set operations. Faces are rows of `lineitem`: the asset is the
supplier, the part the line number, the area the price and the height the quantity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetforge.functions import text
from facetforge.operators import merging, ordering, selecting
from facetforge.plans.registry import query, table

FACES_SQL = "faces AS (SELECT l_suppkey AS sha, l_linenumber AS pid, l_extendedprice AS area, l_quantity AS z FROM lineitem)"
STATS_SQL = f"""{FACES_SQL}, p AS (SELECT sha, pid, count(*) AS n_faces, sum(area) AS area, min(z) AS zmin FROM faces GROUP BY sha, pid),
stats AS (SELECT *, round(area / nullif(sum(area) OVER w, 0), 9) AS share, round(n_faces / sum(n_faces) OVER w, 9) AS face_share,
  row_number() OVER (PARTITION BY sha ORDER BY zmin, pid) = 1 AS is_base FROM p WINDOW w AS (PARTITION BY sha))"""


def faces(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem")
    return rows.select(F.col("l_suppkey").alias("sha"), F.col("l_linenumber").alias("pid"), F.col("l_extendedprice").alias("area"), F.col("l_quantity").alias("z"))


def stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = selecting.part_stats(faces(spark, sf))
    return rows.withColumns({c: F.round(c, 9) for c in ("share", "face_share")})  # as the SQL has them


@query(f"WITH {STATS_SQL} SELECT sha, pid, n_faces, face_share FROM stats WHERE face_share BETWEEN 0.13 AND 0.16 AND NOT is_base")
def q_part_share(spark: SparkSession, sf: str) -> DataFrame:
    kept = stats(spark, sf).where(F.col("face_share").between(0.13, 0.16) & ~F.col("is_base"))
    return kept.select("sha", "pid", "n_faces", "face_share")


@query(f"WITH {STATS_SQL} SELECT sha, pid, share FROM stats WHERE share BETWEEN 0.13 AND 0.16")
def q_area_share(spark: SparkSession, sf: str) -> DataFrame:
    return stats(spark, sf).where(F.col("share").between(0.13, 0.16)).select("sha", "pid", "share")


@query(f"WITH {STATS_SQL} SELECT sha, pid AS base, zmin FROM stats WHERE is_base")
def q_base_part(spark: SparkSession, sf: str) -> DataFrame:
    low = faces(spark, sf).groupBy("sha").agg(F.min(F.struct("z", "pid")).alias("low"))
    return low.select("sha", F.col("low.pid").alias("base"), F.col("low.z").alias("zmin"))


@query(f"""WITH {STATS_SQL} SELECT sha, pid, share FROM stats WHERE NOT is_base
QUALIFY row_number() OVER (PARTITION BY sha ORDER BY share DESC, pid) = 1""")
def q_best_part(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.first_of(stats(spark, sf).where("not is_base"), ["sha"], F.desc("share"), "pid").select("sha", "pid", "share")


@query(f"WITH {STATS_SQL} SELECT sha, pid, n_faces, share FROM stats WHERE NOT is_base AND share BETWEEN 0.13 AND 0.16 AND n_faces >= 80")
def q_part_stats(spark: SparkSession, sf: str) -> DataFrame:
    return selecting.usable(stats(spark, sf), share=(0.13, 0.16), faces=80).select("sha", "pid", "n_faces", "share")


@query(f"""WITH {FACES_SQL}, c AS (SELECT sha, floor(z)::INTEGER AS cluster, sum(area) AS area FROM faces GROUP BY ALL)
SELECT sha, cluster, round(area, 2) AS area FROM c QUALIFY row_number() OVER (PARTITION BY sha ORDER BY round(area, 2) DESC, cluster) <= 12""")
def q_topk_cluster(spark: SparkSession, sf: str) -> DataFrame:
    rows = faces(spark, sf).groupBy("sha", F.floor("z").cast("int").alias("cluster")).agg(F.round(F.sum("area"), 2).alias("area"))
    return ordering.first_of(rows, ["sha"], F.desc("area"), "cluster", n=12)


@query("""SELECT o_orderkey, (sum(o_custkey) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) - o_custkey)::BIGINT AS first_face FROM orders""")
def q_face_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Where each mesh's faces start when all meshes stand one after another."""
    rows = ordering.running(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", [], "o_custkey", "upto")
    return rows.select("o_orderkey", (F.col("upto") - F.col("o_custkey")).alias("first_face"))


@query("""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, ['scale', 'rotate', 'move'][(rn - 1) % 3 + 1] AS op, ((rn - 1) % 8)::INTEGER AS shard FROM r""")
def q_round_robin(spark: SparkSession, sf: str) -> DataFrame:
    rows = ordering.numbered(table(spark, sf, "orders").where("o_orderstatus = 'O'").select("o_orderkey"), "o_orderkey")
    ops = F.array(F.lit("scale"), F.lit("rotate"), F.lit("move"))
    return ordering.sharded(rows, "rn", 8).select("o_orderkey", F.get(ops, ((F.col("rn") - 1) % 3).cast("int")).alias("op"), "shard")


@query("""SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error') AND value > 1
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 8""")
def q_task_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The first eight successes of each task, failures left out before they are counted."""
    good = table(spark, sf, "events").select("event_id", "event_type", "value").where("event_type not in ('error') and value > 1")
    return ordering.first_of(good, ["event_type"], "event_id", n=8).select("event_id", "event_type")


@query("""WITH good AS (SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error') AND value > 1),
old AS (SELECT * FROM good WHERE event_id % 7 = 0 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= event_id % 5 + 2),
had AS (SELECT event_type, count(*) AS n FROM old GROUP BY event_type)
SELECT g.event_id, g.event_type FROM good g LEFT JOIN had h ON h.event_type = g.event_type WHERE g.event_id NOT IN (SELECT event_id FROM old)
QUALIFY row_number() OVER (PARTITION BY g.event_type ORDER BY g.event_id) + coalesce(h.n, 0) <= 8""")
def q_task_cap_rest(spark: SparkSession, sf: str) -> DataFrame:
    """What a second run adds under the same cap: what the first one accepted counts, new rows stand behind it."""
    good = table(spark, sf, "events").select("event_id", "event_type", "value").where("event_type not in ('error') and value > 1")
    rank = F.row_number().over(Window.partitionBy("event_type").orderBy("event_id"))
    old = good.where("event_id % 7 = 0").withColumn("rank", rank).where("rank <= event_id % 5 + 2")
    new = good.join(old.select("event_id"), "event_id", "left_anti")
    return ordering.topped_up(new, old, ["event_type"], 8, "event_id").select("event_id", "event_type")


@query(f"""WITH {STATS_SQL} SELECT sha, pid, share FROM stats WHERE share BETWEEN 0.13 AND 0.45
QUALIFY row_number() OVER (PARTITION BY sha ORDER BY pid) = 1""")
def q_one_per_asset(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.first_of(selecting.usable(stats(spark, sf), share=(0.13, 0.45), faces=0, base=True), ["sha"], "pid").select("sha", "pid", "share")


@query(f"""WITH {STATS_SQL}, c AS (SELECT sha, pid, round(sum(n_faces) OVER (PARTITION BY sha ORDER BY pid) / sum(n_faces) OVER (PARTITION BY sha), 12) AS cdf FROM stats)
SELECT sha, pid, cdf FROM c WHERE cdf > ('0x' || left(md5('7:' || sha), 8))::UBIGINT / 4294967296.0
QUALIFY row_number() OVER (PARTITION BY sha ORDER BY cdf, pid) = 1""")
def q_weighted_choice(spark: SparkSession, sf: str) -> DataFrame:
    rows = stats(spark, sf).select("sha", "pid", "n_faces")
    return ordering.weighted_choice(rows, ["sha"], "n_faces", 7, "pid").select("sha", "pid", "cdf")


@query("""WITH r AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS rn, lead(s_suppkey) OVER (ORDER BY s_suppkey) AS donor FROM supplier)
SELECT s_suppkey AS host, donor FROM r WHERE rn % 2 = 1 AND donor IS NOT NULL""")
def q_donor_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours paired off: the first with the second, the third with the fourth."""
    rows = ordering.numbered(table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey")
    pair = F.floor((F.col("rn") + 1) / 2)
    both = rows.groupBy(pair.alias("pair")).agg(F.min_by("s_suppkey", "rn").alias("host"), F.max_by("s_suppkey", "rn").alias("donor"), F.count("*").alias("n"))
    return both.where("n = 2").select("host", "donor")


@query("""WITH g AS (SELECT user_id, event_id, CASE WHEN event_type = 'signup' THEN 'E3' ELSE 'E6' END AS task, value AS part FROM events WHERE event_type = 'signup' OR event_type = 'purchase' AND event_id % 3 IS DISTINCT FROM 0),
a AS (SELECT user_id, arg_max(event_id, event_id) AS removed, arg_max(part, event_id) AS part FROM g WHERE task = 'E3' GROUP BY user_id), b AS (SELECT user_id, arg_min(event_id, event_id) AS moved, arg_min(part, event_id) AS other FROM g WHERE task = 'E6' GROUP BY user_id)
SELECT a.user_id, removed, moved FROM a JOIN b ON a.user_id = b.user_id WHERE part <> other""")
def q_compose_gated(spark: SparkSession, sf: str) -> DataFrame:
    """Two edits of one asset on different parts: the last removal and the first move that isn't an inverse."""
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", F.when(F.col("event_id") % 3 == 0, "inverse").alias("source"))
    first = merging.last_wins(rows.where("event_type = 'signup'").withColumns({"removed": F.col("event_id"), "part": F.col("value")}), "user_id", "event_id", "removed", "part")
    forward = rows.where("event_type = 'purchase' and not (source <=> 'inverse')")
    second = merging.first_wins(forward.withColumns({"moved": F.col("event_id"), "other": F.col("value")}), "user_id", "event_id", "moved", "other")
    return first.join(second, "user_id").where("part <> other").select("user_id", "removed", "moved")


@query("""SELECT l_orderkey AS pair, 'E3' AS task, l_partkey AS before_part, l_suppkey AS after_part FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, 'E2', l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'""")
def q_reverse_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each removal and, with its sides exchanged, the addition that undoes it."""
    made = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    made = made.select(F.col("l_orderkey").alias("pair"), F.lit("E3").alias("task"), F.col("l_partkey").alias("before_part"), F.col("l_suppkey").alias("after_part"))
    return made.unionByName(selecting.reversed_pairs(made, "E2", ("before_part", "after_part")))


@query("""SELECT 'both' AS kind, c_custkey AS k FROM customer INTERSECT SELECT 'both', o_custkey FROM orders
UNION ALL (SELECT 'rest', c_custkey FROM customer EXCEPT SELECT 'rest', o_custkey FROM orders)
UNION ALL (SELECT 'any', c_custkey FROM customer UNION SELECT 'any', o_custkey FROM orders)""")
def q_set_ops(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    b = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    sides = {"both": a.intersect(b), "rest": a.exceptAll(b.distinct()).distinct(), "any": a.union(b).distinct()}
    named = [rows.select(F.lit(kind).alias("kind"), "k") for kind, rows in sides.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("""SELECT l_orderkey, l_partkey FROM lineitem GROUP BY ALL HAVING count(*) = 1""")
def q_boundary_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges that one face alone has."""
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n")).where("n = 1").drop("n")


@query("""WITH r AS (SELECT l_suppkey AS sha, l_orderkey, l_linenumber, row_number() OVER w AS rn, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem
  WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber))
SELECT sha, l_orderkey, l_linenumber FROM r WHERE (rn - 1) % greatest(1, n // 100) = 0""")
def q_stride_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("sha"), "l_orderkey", "l_linenumber")
    return ordering.strided(rows, ["sha"], 100, "l_orderkey", "l_linenumber")


@query(f"""WITH {STATS_SQL}, top AS (SELECT sha, pid FROM stats QUALIFY row_number() OVER (PARTITION BY sha ORDER BY share DESC, pid) <= 3)
SELECT sha, pid, 'gray' AS color FROM stats s WHERE NOT EXISTS (SELECT 1 FROM top t WHERE t.sha = s.sha AND t.pid = s.pid)""")
def q_rest_gray(spark: SparkSession, sf: str) -> DataFrame:
    rows = stats(spark, sf)
    top = ordering.first_of(rows, ["sha"], F.desc("share"), "pid", n=3).select("sha", "pid")
    return rows.join(top, ["sha", "pid"], "left_anti").select("sha", "pid", F.lit("gray").alias("color"))


@query("""WITH t AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber IN (2, 3) AND l_returnflag = 'R')
SELECT o_orderkey, round(CASE WHEN t.l_orderkey IS NULL THEN o_totalprice ELSE o_totalprice * 1.5 END, 4) AS x FROM orders LEFT JOIN t ON t.l_orderkey = o_orderkey""")
def q_incidence(spark: SparkSession, sf: str) -> DataFrame:
    """Vertices that a face of the chosen parts touches are moved, those shared with other parts too."""
    touched = table(spark, sf, "lineitem").where("l_linenumber in (2, 3) and l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice").join(touched.distinct().withColumn("hit", F.lit(True)), "o_orderkey", "left")
    return rows.select("o_orderkey", F.round(F.when(F.col("hit"), F.col("o_totalprice") * 1.5).otherwise(F.col("o_totalprice")), 4).alias("x"))


@query("""WITH b AS (SELECT o_custkey, sum(o_shippriority_) AS total FROM (SELECT o_custkey, round(o_totalprice / 1000)::BIGINT AS o_shippriority_ FROM orders) GROUP BY o_custkey)
SELECT o_custkey, total::BIGINT AS total FROM b WHERE total <= 1500 QUALIFY row_number() OVER (PARTITION BY o_custkey % 10 ORDER BY total DESC, o_custkey) <= 5""")
def q_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Groups whose size is in the budget, and of those the largest in each slot."""
    sums = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(F.round(F.col("o_totalprice") / 1000).cast("bigint")).alias("total")).where("total <= 1500")
    return ordering.first_of(sums.withColumn("slot", F.col("o_custkey") % 10), ["slot"], F.desc("total"), "o_custkey", n=5).drop("slot")


@query("""WITH r AS (SELECT s_suppkey, s_nationkey, md5('42:' || s_suppkey) AS h FROM supplier)
SELECT s_nationkey, s_suppkey FROM r QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY h, s_suppkey) <= 2""")
def q_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Two of each group, drawn without replacement."""
    return ordering.first_of(table(spark, sf, "supplier").select("s_nationkey", "s_suppkey"), ["s_nationkey"], ordering.draw(42, "s_suppkey"), "s_suppkey", n=2)


@query("""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, count(*) FILTER (value > 50) AS passed FROM events GROUP BY event_type""")
def q_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("value") > 50).alias("passed"))


@query(f"""WITH {STATS_SQL} SELECT sha, pid, (row_number() OVER (PARTITION BY sha ORDER BY pid) - 1)::INTEGER AS new_pid, n_faces FROM stats WHERE pid <> 2""")
def q_remove(spark: SparkSession, sf: str) -> DataFrame:
    """A part taken away, and the rest numbered densely."""
    rest = stats(spark, sf).where("pid <> 2").withColumn("new_pid", F.row_number().over(Window.partitionBy("sha").orderBy("pid")) - 1)
    return rest.select("sha", "pid", "new_pid", "n_faces")


@query(f"""WITH {STATS_SQL}, m AS (SELECT * FROM (VALUES ('v1', 0.13, 0.145, 60), ('v2', 0.14, 0.16, 80), ('v3', 0.12, 0.15, 90)) t(rule, lo, hi, least))
SELECT rule, sha, pid, share FROM stats JOIN m ON share BETWEEN lo AND hi AND n_faces >= least WHERE NOT is_base""")
def q_threshold_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Parts under several rules at once."""
    rules = [("v1", 0.13, 0.145, 60), ("v2", 0.14, 0.16, 80), ("v3", 0.12, 0.15, 90)]
    return selecting.under_rules(stats(spark, sf).where("not is_base"), rules).select("rule", "sha", "pid", "share")


COLD, HOT = ["old ring", "large gear"], ["ring", "gear", "hot rod"]


@query("""SELECT p_partkey, CASE WHEN lower(trim(p_name)) IN ('old ring', 'large gear') THEN false WHEN lower(trim(p_name)) IN ('ring', 'gear', 'hot rod') THEN true
  ELSE list_has_any(string_split(lower(trim(p_name)), ' '), ['ring', 'gear', 'hot rod']) END AS addable FROM part""")
def q_addable(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", text.addable(F.col("p_name"), HOT, COLD).alias("addable"))


@query("""SELECT p_partkey, replace(replace('remove the {PART} from {DONOR_PART}', '{PART}', lower(trim(p_name))), '{DONOR_PART}', coalesce(nullif(p_brand, ''), 'part')) AS instruction,
  left(replace(p_name, ' ', '_'), 20) AS folder FROM part""")
def q_template_fill(spark: SparkSession, sf: str) -> DataFrame:
    names = {"{PART}": F.lower(F.trim("p_name")), "{DONOR_PART}": F.coalesce(merging.falsy(F.col("p_brand")), F.lit("part"))}
    filled = text.filled(F.lit("remove the {PART} from {DONOR_PART}"), names)
    return table(spark, sf, "part").select("p_partkey", filled.alias("instruction"), F.left(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(20)).alias("folder"))
