"""Catalogues, conformance, records and arrays as jobs read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetforge.functions import text
from facetforge.operators import atlas, gates, geometry, merging, meshes, ordering, selecting
from facetforge.plans.registry import query, table
from facetforge.sources import arrays, records, sinks

#: Ends of paths, in the order in which they are listed.
PATTERNS = [r"\.html$", r"/[0-9]+/?$", r"\?.*$", r"#.*$"]


@query(r"""WITH p AS (SELECT url AS path, CASE WHEN regexp_matches(url, '\.html$') THEN 0 WHEN regexp_matches(url, '/[0-9]+/?$') THEN 1 WHEN regexp_matches(url, '\?.*$') THEN 2 WHEN regexp_matches(url, '#.*$') THEN 3 END AS pattern,
  split_part(url, '/', 4) AS task FROM pages), q AS (SELECT DISTINCT path, pattern, task FROM p WHERE pattern IS NOT NULL AND task <> 'es' AND NOT regexp_matches(path, 'ref=x$'))
SELECT path, pattern, task, row_number() OVER (PARTITION BY pattern ORDER BY path) AS place FROM q""")
def q_catalog_order(spark: SparkSession, sf: str) -> DataFrame:
    """Paths pattern by pattern, each pattern's in the order of their signs; one task's folder and passing files left out."""
    paths = table(spark, sf, "pages").select(F.col("url").alias("path")).distinct()
    rows = records.by_pattern(paths, "path", PATTERNS).withColumn("task", F.coalesce(F.get(F.split("path", "/"), 3), F.lit("")))
    rows = rows.where((F.col("task") != "es") & ~F.col("path").rlike("ref=x$"))
    return ordering.numbered(rows, "path", name="place", by=("pattern",)).select("path", "pattern", "task", "place")


@query("""WITH f AS (SELECT l_orderkey AS sha, count(*) AS n, count(DISTINCT l_linenumber) AS labels, round(sum(l_extendedprice), 2) AS area FROM lineitem GROUP BY l_orderkey),
o AS (SELECT o_orderkey AS sha, o_custkey FROM orders WHERE o_orderstatus <> 'P')
SELECT o.sha, n AS n_faces, area, row_number() OVER (PARTITION BY o_custkey ORDER BY area DESC, o.sha) AS place FROM o JOIN f ON f.sha = o.sha WHERE n = labels""")
def q_conformance(spark: SparkSession, sf: str) -> DataFrame:
    """Assets with as many labels as faces, with their areas, ranked among their owner's."""
    faces = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("sha"), F.col("l_linenumber").alias("fidx"), "l_extendedprice")
    known = faces.select("sha", "fidx", F.lit(1).alias("label")).distinct()
    counted = faces.groupBy("sha").agg(F.count("*").alias("n_faces"), F.round(F.sum("l_extendedprice"), 2).alias("area"))
    good = arrays.conforming(faces, known, ["sha"]).select("sha").distinct()
    owner = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("sha"), "o_custkey")
    rows = owner.join(counted.join(good, "sha", "left_semi"), "sha")
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("area"), "sha"))
    return rows.select("sha", "n_faces", "area", place.cast("long").alias("place"))


@query("""WITH m AS (SELECT event_id, event_type AS task, json_extract(props, '$.k')::INTEGER AS k, CASE WHEN event_id % 3 = 0 THEN event_id % 5 END AS vis FROM events)
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'E10' ELSE task END AS task, coalesce(CASE WHEN event_id % 2 = 0 THEN k * 2 END, k) AS k, 'chain' AS source, coalesce(nullif(vis, 0), CASE WHEN event_id % 4 = 1 THEN 3 END)::INTEGER AS vis FROM m""")
def q_struct_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A record with another laid over it; a value that only one of them has stays, and a nested one is looked up in turn."""
    rows = table(spark, sf, "events").select("event_id", "event_type", F.from_json("props", "k int").k.alias("k"))
    i = F.col("event_id")
    meta = F.struct(F.col("event_type").alias("task"), F.col("k").alias("k"), F.when(i % 3 == 0, i % 5).cast("int").alias("vis"), F.when(i % 4 == 1, F.struct(F.lit(3).alias("vis"))).alias("unit"))
    over = F.struct(F.when(i % 2 == 0, "E10").alias("task"), F.when(i % 2 == 0, F.col("k") * 2).alias("k"), F.lit("chain").alias("source"))
    both = rows.select("event_id", meta.alias("meta"), over.alias("over")).select("event_id", merging.laid_over("meta", "over", ["task", "k", "vis", "unit"], ["task", "k", "source"]).alias("m"))
    return both.select("event_id", "m.task", "m.k", "m.source", F.coalesce(F.nullif("m.vis", F.lit(0)), F.col("m.unit.vis")).alias("vis"))


@query("""SELECT event_id, coalesce(CASE WHEN event_type <> 'error' THEN event_type END, 'err') AS match, coalesce(CASE WHEN event_type <> 'error' THEN 'high' END, 'low') AS confidence FROM events""")
def q_json_default(spark: SparkSession, sf: str) -> DataFrame:
    """A model's answer, and a whole record in its place where it can't be read."""
    kind = F.col("event_type")
    said = F.when(kind == "error", F.concat(F.lit("sorry {"), kind)).otherwise(F.concat(F.lit("So: "), F.to_json(F.struct(kind.alias("match"), F.lit("high").alias("confidence"))), F.lit(".")))
    answer = F.from_json(text.braced(said), "match string, confidence string")
    given = F.coalesce(F.when(answer.match.isNotNull(), answer), F.struct(F.lit("err").alias("match"), F.lit("low").alias("confidence")))
    return table(spark, sf, "events").select("event_id", given.alias("j")).select("event_id", "j.match", "j.confidence")


@query("""WITH a AS (SELECT conv_id, list(role ORDER BY turn) AS roles, list(turn ORDER BY turn) AS turns, list(length(text) ORDER BY turn) AS sizes FROM conversations GROUP BY conv_id)
SELECT conv_id, array_to_string(roles[1:3], ',') AS first3, coalesce(list_position(roles, 'assistant'), 0)::INTEGER AS at, array_to_string(list_transform(list_filter(range(1, len(turns) + 1), lambda i: (i - 1) % 2 = 1), lambda i: turns[i]), ',') AS odd,
  array_to_string(list_transform(range(1, len(roles) + 1), lambda i: (i - 1) || '=' || roles[i]), ',') AS pairs, array_to_string(list_sort(list_distinct(roles)), ',') AS kinds,
  array_to_string(list_sort(list_filter(list_distinct(roles), lambda r: r <> 'user')), ',') AS rest, len(list_filter(sizes, lambda s: s > 100)) AS long FROM a""")
def q_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Lists cut, strided, zipped with their places, sorted as sets, and filtered."""
    own = F.array_sort(F.collect_list(F.struct("turn", "role", F.length("text").alias("size"))))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(own.alias("t"))
    roles, turns = F.transform("t", lambda t: t.role), F.transform("t", lambda t: t.turn)
    odd = F.filter(turns, lambda t, i: i % 2 == 1)
    pairs = F.transform(F.arrays_zip(F.sequence(F.lit(0), F.size("t") - 1).alias("i"), roles.alias("r")), lambda z: F.concat_ws("=", z.i, z.r))
    kinds = F.array_sort(F.array_distinct(roles))
    return rows.select(
        "conv_id", F.array_join(F.slice(roles, 1, 3), ",").alias("first3"), F.array_position(roles, "assistant").cast("int").alias("at"), F.array_join(odd, ",").alias("odd"), F.array_join(pairs, ",").alias("pairs"),
        F.array_join(kinds, ",").alias("kinds"), F.array_join(F.array_except(kinds, F.array(F.lit("user"))), ",").alias("rest"), F.size(F.filter("t", lambda t: t.size > 100)).cast("long").alias("long"),
    )


@query("""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings), b AS (SELECT min(x) lx, max(x) hx, min(y) ly, max(y) hy FROM p)
SELECT vec_id, trunc((x - lx) / greatest(hx - lx, 1e-9) * 95)::INTEGER AS u, trunc((x - lx) / greatest(hx - lx, 1e-9) * 95)::INTEGER * 96 + trunc((y - ly) / greatest(hy - ly, 1e-9) * 95)::INTEGER AS cell,
  trunc(least(greatest((x * 3 - floor(x * 3)) * 63, 0), 63))::INTEGER AS wrapped, round(abs(x - y) / greatest(y, 1e-9), 3) AS delta, CASE WHEN x >= y AND x >= z THEN 0 WHEN y >= z THEN 1 ELSE 2 END AS axis,
  round(2 * asin(sqrt(3) / 2 / (2 + abs(z))), 6) AS fov FROM p, b""")
def q_quantise(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of a grid and their numbers, wrapped texels, relative deltas, the longest axis, the field of view."""
    rows = table(spark, sf, "embeddings").select("vec_id", *(F.col("embedding")[i].cast("double").alias(a) for i, a in enumerate(geometry.AXES)))
    box = rows.agg(*(f(a).alias(f"{n}_{a}") for a in "xy" for n, f in (("lo", F.min), ("hi", F.max))))
    rows = rows.join(F.broadcast(box), F.lit(True))  # one row
    u, v = (geometry.cell(F.col(a), F.col(f"lo_{a}"), F.col(f"hi_{a}"), 96) for a in "xy")
    return rows.select(
        "vec_id", u.alias("u"), (u * 96 + v).alias("cell"), atlas.texel(F.col("x") * 3, F.col("y"), 64, 64)[0].alias("wrapped"), F.round(gates.relative(F.col("x"), F.col("y")), 3).alias("delta"),
        meshes.longer(F.col("x"), F.col("y"), F.col("z")).alias("axis"), F.round(geometry.view_angle(2 + F.abs("z")), 6).alias("fov"),
    )


@query("""SELECT event_id, 'good' AS kind, NULL AS exc FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, 'error', right(repeat(props, 400), 1500) FROM events WHERE event_type = 'error'""")
def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Failed rows leave the good ones, and keep the end of what went wrong."""
    rows = table(spark, sf, "events").select("event_id", "event_type", F.repeat("props", 400).alias("exc"))
    good, bad = sinks.split_errors(rows, F.col("event_type") == "error", F.col("exc"), ["event_id"])
    good = good.select("event_id", F.lit("good").alias("kind"), F.lit(None).cast("string").alias("exc"))
    return good.unionByName(bad.select("event_id", F.lit("error").alias("kind"), "exc"))


@query("""SELECT s_suppkey, s_name FROM (SELECT * FROM supplier WHERE s_acctbal > 0 ORDER BY s_suppkey LIMIT 40) ORDER BY md5('5:' || s_suppkey), s_suppkey LIMIT 12""")
def q_first_forty(spark: SparkSession, sf: str) -> DataFrame:
    """The first forty candidates in order, shuffled, and twelve of them."""
    first = table(spark, sf, "supplier").where("s_acctbal > 0").orderBy("s_suppkey").limit(40)
    return first.orderBy(ordering.draw(5, "s_suppkey"), "s_suppkey").limit(12).select("s_suppkey", "s_name")


@query("""WITH s AS (SELECT p_partkey, p_name || ':' || p_type AS spec FROM part) SELECT p_partkey, split_part(spec, ':', 1) AS source, substr(spec, strpos(spec, ':') + 1) AS target,
  array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), '+') AS sane FROM s JOIN part USING (p_partkey)""")
def q_job_specs(spark: SparkSession, sf: str) -> DataFrame:
    """Job specifications cut at their first colon, and names as one word each."""
    rows = table(spark, sf, "part").select("p_partkey", "p_name", F.concat_ws(":", "p_name", "p_type").alias("spec"))
    cut = F.split("spec", ":", 2)
    words = F.transform(F.split(F.lower("p_name"), " "), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 20)))
    return rows.select("p_partkey", F.get(cut, 0).alias("source"), F.get(cut, 1).alias("target"), F.array_join(words, "+").alias("sane"))


@query("""WITH n AS (SELECT conv_id, count(*) FILTER (role = 'user') AS before FROM conversations GROUP BY conv_id), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx FROM conversations)
SELECT r.conv_id, turn, role FROM r JOIN n ON n.conv_id = r.conv_id WHERE idx >= before""")
def q_trailing_after(spark: SparkSession, sf: str) -> DataFrame:
    """What stands behind as many rows as another list of the same key has."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    before = rows.groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("n_before"))
    return selecting.trailing(rows, before, "conv_id", "turn").select("conv_id", "turn", "role")


@query("""WITH n AS (SELECT 'p' || p_partkey || '/' || CASE WHEN p_size % 2 = 0 THEN 'part' ELSE 'donor' END || '_ref.jpg' AS path, coalesce(CASE WHEN p_size % 7 <> 0 THEN lower(trim(p_name)) END, 'part') AS name FROM part),
m AS (SELECT p_partkey, 'p' || p_partkey AS dir, CASE p_partkey % 3 WHEN 0 THEN 'remove the {PART}' WHEN 1 THEN 'replace the {PART} with a {DONOR_PART}' ELSE 'keep it' END AS t FROM part)
SELECT p_partkey, replace(replace(t, '{PART}', coalesce(a.name, 'part')), '{DONOR_PART}', coalesce(b.name, a.name, 'part')) AS instruction FROM m LEFT JOIN n a ON a.path = dir || '/part_ref.jpg' LEFT JOIN n b ON b.path = dir || '/donor_ref.jpg'""")
def q_name_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Instructions with the names that a model gave to two pictures of a pair, which may be missing or broken."""
    part = table(spark, sf, "part")
    kind = F.when(F.col("p_size") % 2 == 0, "part").otherwise("donor")
    said = F.when(F.col("p_size") % 7 != 0, F.concat(F.lit("It is "), F.to_json(F.struct(F.col("p_name").alias("part"))))).otherwise(F.lit("no {idea}"))
    names = part.select(F.concat(F.lit("p"), "p_partkey", F.lit("/"), kind, F.lit("_ref.jpg")).alias("path"), text.named(said).alias("name"))
    template = F.get(F.array(F.lit("remove the {PART}"), F.lit("replace the {PART} with a {DONOR_PART}"), F.lit("keep it")), (F.col("p_partkey") % 3).cast("int"))
    metas = part.select("p_partkey", F.concat(F.lit("p"), "p_partkey").alias("dir"), template.alias("template"))
    for ref in ("part", "donor"):
        own = names.select(F.col("path").alias(f"{ref}_path"), F.col("name").alias(ref))
        metas = metas.join(own, F.concat("dir", F.lit(f"/{ref}_ref.jpg")) == F.col(f"{ref}_path"), "left")
    slots = {"{PART}": F.coalesce("part", F.lit("part")), "{DONOR_PART}": F.coalesce("donor", "part", F.lit("part"))}
    return metas.select("p_partkey", text.filled(F.col("template"), slots).alias("instruction"))


@query("""WITH m AS (SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events) SELECT event_id, k + i AS key, i::INTEGER AS value, CASE WHEN 7 BETWEEN k AND k + 2 THEN 7 - k ELSE -1 END AS seventh FROM m, (VALUES (0), (1), (2)) v(i)""")
def q_map_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Maps whose keys are written as texts, read as numbers; a key that may be missing has a default."""
    k = F.from_json("props", "k int").k
    written = F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit('"'), k + i, F.lit(f'": {i}')) for i in range(3))), F.lit("}"))
    rows = table(spark, sf, "events").select("event_id", F.transform_keys(F.from_json(written, "map<string,int>"), lambda key, _: key.cast("int")).alias("m"))
    return rows.select("event_id", F.coalesce(F.try_element_at("m", F.lit(7)), F.lit(-1)).alias("seventh"), F.explode("m").alias("key", "value"))


@query("""SELECT event_id, 'auto-gate | ' || concat_ws(' | ', CASE WHEN event_id % 3 = 0 THEN 'geo:ok' WHEN event_id % 3 = 1 THEN 'geo:FAIL' END, CASE WHEN event_id % 2 = 0 THEN 'blind-judge observed: ' || left(repeat(props, 20), 140) END) AS note,
  CASE WHEN event_id % 3 = 1 THEN 'fail' WHEN event_id % 2 = 0 THEN 'pass' ELSE 'pending' END AS verdict FROM events""")
def q_notes(spark: SparkSession, sf: str) -> DataFrame:
    """What the gate and the judge said, where they said anything, and the verdict."""
    i = F.col("event_id")
    rows = table(spark, sf, "events").select("event_id", F.when(i % 3 != 2, i % 3 == 0).alias("geo_pass"), F.when(i % 2 == 0, "yes").alias("match"), F.when(i % 2 == 0, F.repeat("props", 20)).alias("observed"))
    return rows.select("event_id", merging.gate_note(F.col("geo_pass"), F.col("observed")).alias("note"), merging.verdict(F.col("match"), F.col("geo_pass")).alias("verdict"))


@query("""WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn FROM events WHERE event_type <> 'error') SELECT event_id, rn FROM r WHERE (rn - 1) % 8 = 3 ORDER BY rn LIMIT 25""")
def q_shard_limit(spark: SparkSession, sf: str) -> DataFrame:
    """A shard's share of the rows first, and of that the first ones."""
    rows = ordering.numbered(table(spark, sf, "events").where("event_type <> 'error'").select("event_id"), "event_id")
    return ordering.sharded(rows, "rn", 8).where("shard = 3").orderBy("rn").limit(25).select("event_id", "rn")


@query("""WITH n AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS own FROM orders GROUP BY o_custkey)
SELECT o_custkey, own[(('0x' || left(md5('9:' || o_custkey), 8))::UBIGINT % len(own) + 1)::BIGINT] AS picked FROM n""")
def q_uniform_pick(spark: SparkSession, sf: str) -> DataFrame:
    """One of each group's rows, each as likely as the others, without gathering the group: the row at a drawn place."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    n = rows.groupBy("o_custkey").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    ranked = rows.withColumn("rn", place).join(n, "o_custkey")
    return ranked.where(F.col("rn") == ordering.drawn(9, F.col("n"), "o_custkey") + 1).select("o_custkey", F.col("o_orderkey").alias("picked"))


@query("""WITH i AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Change the object''s material to ' || p_name WHEN 1 THEN 'Repaint the object in ' || p_name WHEN 2 THEN 'Repaint the object with ' || p_name ELSE 'CHANGE ONLY the top to ' || p_name END || '. Keep the shape.' AS t FROM part),
c AS (SELECT p_partkey, split_part(t, '. Keep', 1) AS t FROM i)
SELECT p_partkey, starts_with(lower(t), 'change only') AS targeted, CASE WHEN starts_with(lower(t), 'change only') THEN t ELSE 'change the material of the {PART} to ' || replace(replace(replace(t, 'Change the object''s material to ', ''), 'Repaint the object in ', ''), 'Repaint the object with ', '') END AS instruction FROM c""")
def q_material_strip(spark: SparkSession, sf: str) -> DataFrame:
    """An instruction without its tail; if it isn't a targeted one, its material in a template."""
    starts = F.array(F.lit("Change the object's material to "), F.lit("Repaint the object in "), F.lit("Repaint the object with "), F.lit("CHANGE ONLY the top to "))
    said = F.concat(F.get(starts, (F.col("p_partkey") % 4).cast("int")), F.col("p_name"), F.lit(". Keep the shape."))
    rows = table(spark, sf, "part").select("p_partkey", text.before(said, ". Keep").alias("t"))
    targeted = F.lower("t").startswith("change only")
    return rows.select("p_partkey", targeted.alias("targeted"), F.when(targeted, F.col("t")).otherwise(F.concat(F.lit("change the material of the {PART} to "), text.without(F.col("t"), text.MATERIALS))).alias("instruction"))
