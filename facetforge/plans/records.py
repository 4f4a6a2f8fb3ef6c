"""Selection, joins, verdicts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetforge.operators import merging, ordering
from facetforge.plans.registry import query, table

#: Quotas of the stratified selection, the most detailed bucket first.
QUOTAS = {"rich": 70, "good": 50, "fair": 50, "plain": 30}
BUCKET_SQL = "CASE WHEN n_chars >= 4000 THEN 'rich' WHEN n_chars >= 2000 THEN 'good' WHEN n_chars >= 800 THEN 'fair' ELSE 'plain' END"


def bucket():
    n = F.col("n_chars")
    return F.when(n >= 4000, "rich").when(n >= 2000, "good").when(n >= 800, "fair").otherwise("plain")


@query(f"""
WITH e AS (SELECT doc_id, lang, source, n_chars, {BUCKET_SQL} AS bucket FROM documents d WHERE lang IN ('en', 'fr', 'de')
  AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY md5('0:' || doc_id), doc_id) AS rn FROM e)
SELECT doc_id, lang, source, n_chars, bucket FROM r
WHERE rn <= CASE bucket WHEN 'rich' THEN 70 WHEN 'good' THEN 50 WHEN 'fair' THEN 50 ELSE 30 END""")
def q_select_stratified(spark: SparkSession, sf: str) -> DataFrame:
    """Eligible rows whose input exists, drawn into buckets up to their quotas."""
    docs = table(spark, sf, "documents").where(F.col("lang").isin("en", "fr", "de")).select("doc_id", "lang", "source", "n_chars")
    there = merging.present(docs.withColumn("bucket", bucket()), table(spark, sf, "labels").select("doc_id"), ["doc_id"])
    return ordering.quota(there, "bucket", QUOTAS, ordering.draw(0, "doc_id"), "doc_id")


@query("SELECT doc_id, n_chars FROM documents WHERE coalesce(CASE WHEN lang = 'en' THEN n_chars END, 0) >= 1000")
def q_asset_gate(spark: SparkSession, sf: str) -> DataFrame:
    score = F.coalesce(F.when(F.col("lang") == "en", F.col("n_chars")), F.lit(0))
    return table(spark, sf, "documents").where(score >= 1000).select("doc_id", "n_chars")


@query("SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def q_semi_membership(spark: SparkSession, sf: str) -> DataFrame:
    passed = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return merging.present(table(spark, sf, "documents").select("doc_id", "source"), passed, ["doc_id"])


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q_resume_anti(spark: SparkSession, sf: str) -> DataFrame:
    return merging.resumed(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels").select("doc_id"), ["doc_id"])


@query("""SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'pending') AS quality, coalesce(l.toxic, -1)::INTEGER AS toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q_left_default(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("pending")).alias("quality"), F.coalesce("toxic", F.lit(-1)).cast("int").alias("toxic"))


JUDGED_SQL = """judged AS (SELECT d.doc_id, d.source, d.n_chars, CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.quality = 1 AND d.n_chars >= 1000 THEN 'yes'
  WHEN l.quality = 1 THEN 'partial' ELSE 'no' END AS match, CASE WHEN l.toxic IS NULL THEN NULL ELSE l.toxic = 0 END AS geo_pass
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
verdicts AS (SELECT *, CASE WHEN coalesce(NOT geo_pass, false) THEN 'fail' WHEN match = 'yes' THEN 'pass' WHEN match = 'partial' THEN 'marginal'
  WHEN match = 'no' THEN 'fail' ELSE 'pending' END AS verdict FROM judged)"""


def judged(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as pairs: the label's quality is the judge's answer, its toxic flag the geometry check."""
    rows = table(spark, sf, "documents").select("doc_id", "source", "n_chars").join(table(spark, sf, "labels"), "doc_id", "left")
    good = F.col("quality") == 1
    match = F.when(F.col("quality").isNull(), None).when(good & (F.col("n_chars") >= 1000), "yes").when(good, "partial").otherwise("no")
    rows = rows.withColumns({"match": match, "geo_pass": F.col("toxic") == 0}).drop("quality", "toxic")
    return rows.withColumn("verdict", merging.verdict(F.col("match"), F.col("geo_pass")))


@query(f"""WITH {JUDGED_SQL}
SELECT doc_id, verdict, concat_ws(' | ', 'judge: ' || match, CASE WHEN NOT geo_pass THEN 'geometry failed' END) AS note FROM verdicts""")
def q_verdict_merge(spark: SparkSession, sf: str) -> DataFrame:
    said = F.concat(F.lit("judge: "), F.col("match"))
    return judged(spark, sf).select("doc_id", "verdict", merging.note(said, F.when(~F.col("geo_pass"), F.lit("geometry failed"))).alias("note"))


@query(f"""WITH {JUDGED_SQL} SELECT source, count(*) FILTER (verdict = 'pass') AS pass, count(*) FILTER (verdict = 'marginal') AS marginal,
count(*) FILTER (verdict = 'fail') AS fail, count(*) FILTER (verdict = 'pending') AS pending FROM verdicts GROUP BY source""")
def q_verdict_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return merging.pivoted(judged(spark, sf), "source", "verdict", ["pass", "marginal", "fail", "pending"])


@query("""SELECT quality, toxic, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY quality), 6) AS share
FROM labels GROUP BY quality, toxic""")
def q_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """How often one label goes with the other: agreement, not accuracy, as the labels are silver."""
    counts = table(spark, sf, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("quality")), 6))


@query("""WITH r AS (SELECT * FROM (SELECT doc_id, source, n_chars, 'v2' AS version FROM documents WHERE lang = 'fr'
  UNION ALL SELECT doc_id, source, n_chars, 'v1' FROM documents WHERE lang = 'en' AND NOT EXISTS (SELECT 1 FROM documents WHERE lang = 'fr')))
SELECT source, arg_max(n_chars, doc_id) AS n_chars, max(doc_id) AS doc_id, min(version) AS version, '{}' AS extra FROM r GROUP BY source""")
def q_scan_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """The second version where there is any row of it, else the first; the last duplicate wins; a missing file is empty."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars", "lang")
    new = docs.where("lang = 'fr'").withColumn("version", F.lit("v2"))
    any_new = new.limit(1).select(F.lit(1).alias("there"))
    old = docs.where("lang = 'en'").withColumn("version", F.lit("v1")).join(F.broadcast(any_new), F.lit(True), "left_anti")
    rows = new.unionByName(old)
    return merging.last_wins(rows.withColumn("id", F.col("doc_id")), "source", "doc_id", "n_chars", "id", "version").withColumnRenamed("id", "doc_id").withColumn("extra", F.lit("{}"))


@query("""WITH p AS (SELECT doc_id, lang FROM documents), i AS (SELECT doc_id, bool_and(ok) AS complete, count(*) AS inputs FROM (
  SELECT d.doc_id, l.doc_id IS NOT NULL AS ok FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
  UNION ALL SELECT doc_id, n_chars >= 500 FROM documents) GROUP BY doc_id)
SELECT p.doc_id, complete, CASE WHEN complete AND lang = 'en' THEN 'before,after,zoom' ELSE 'before,after' END AS panels FROM p JOIN i ON i.doc_id = p.doc_id WHERE inputs = 2""")
def q_all_inputs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    known = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("known"))
    inputs = docs.join(known, "doc_id", "left").select("doc_id", F.coalesce("known", F.lit(False)).alias("ok")).unionByName(docs.select("doc_id", (F.col("n_chars") >= 500).alias("ok")))
    whole = inputs.groupBy("doc_id").agg(F.bool_and("ok").alias("complete"), F.count("*").alias("inputs")).where("inputs = 2")
    base = F.array(F.lit("before"), F.lit("after"))
    panels = F.when(F.col("complete") & (F.col("lang") == "en"), F.concat(base, F.array(F.lit("zoom")))).otherwise(base)
    return docs.join(whole, "doc_id").select("doc_id", "complete", F.array_join(panels, ",").alias("panels"))


@query("""WITH c AS (SELECT conv_id, text AS raw FROM conversations WHERE turn = 0)
SELECT d.doc_id, coalesce(nullif(split_part(d.text, '.', 1), ''), '?') AS instruction, trim(left(c.raw, 40)) AS caption
FROM documents d JOIN labels l ON l.doc_id = d.doc_id JOIN c ON c.conv_id = d.doc_id WHERE nullif(trim(left(c.raw, 40)), '') IS NOT NULL""")
def q_caption_join(spark: SparkSession, sf: str) -> DataFrame:
    """Edit, label and caption must all be there; an empty caption doesn't count."""
    captions = table(spark, sf, "conversations").where("turn = 0").select(F.col("conv_id").alias("doc_id"), F.trim(F.left("text", F.lit(40))).alias("caption"))
    docs = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels").select("doc_id"), "doc_id")
    rows = docs.join(captions.where("nullif(caption, '') is not null"), "doc_id")
    return rows.select("doc_id", F.coalesce(merging.falsy(F.substring_index("text", ".", 1)), F.lit("?")).alias("instruction"), "caption")


@query("""SELECT source, lang, count(*) AS n, 'r1' AS round FROM documents WHERE source NOT IN ('src3', 'src4') AND doc_id % 3 = 0 GROUP BY ALL
UNION ALL SELECT source, lang, count(*), 'r2' FROM documents WHERE source NOT IN ('src5') AND doc_id % 3 = 1 GROUP BY ALL
UNION ALL SELECT source, lang, count(*), 'r3' FROM documents WHERE doc_id % 3 = 2 GROUP BY ALL""")
def q_round_union(spark: SparkSession, sf: str) -> DataFrame:
    """Rounds side by side, tasks that a later round replaced left out."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang").withColumn("round", F.concat(F.lit("r"), F.col("doc_id") % 3 + 1))
    gone = spark.createDataFrame([("r1", "src3"), ("r1", "src4"), ("r2", "src5")], "round string, source string")
    return docs.join(F.broadcast(gone), ["round", "source"], "left_anti").groupBy("source", "lang", "round").agg(F.count("*").alias("n"))  # three rows


@query(f"""WITH {JUDGED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM verdicts WHERE verdict IN ('pass', 'marginal') AND source <> 'src9')
SELECT concat('r3', '/', source, '/', doc_id) AS id, source AS task, verdict, CASE WHEN rn <= 8 THEN concat('models/', doc_id, '.glb') ELSE '' END AS model,
  list_position(['src0', 'src1', 'src2'], source)::INTEGER AS place FROM r""")
def q_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the page: verdicts merged, a replaced task left out, models for the first eight successes of each task."""
    good = judged(spark, sf).where(F.col("verdict").isin("pass", "marginal") & (F.col("source") != "src9"))
    good = ordering.numbered(good, "doc_id", by=("source",))
    model = F.when(F.col("rn") <= 8, F.concat(F.lit("models/"), F.col("doc_id"), F.lit(".glb"))).otherwise("")
    place = F.nullif(F.array_position(F.array(F.lit("src0"), F.lit("src1"), F.lit("src2")), F.col("source")), F.lit(0).cast("bigint")).cast("int")
    return good.select(F.concat_ws("/", F.lit("r3"), "source", "doc_id").alias("id"), F.col("source").alias("task"), "verdict", model.alias("model"), place.alias("place"))


@query("""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents)
SELECT doc_id, ((rn - 1) // 6)::BIGINT AS sheet, printf('S%02dR%d', (rn - 1) // 6, (rn - 1) % 6) AS rid FROM r""")
def q_sheet_chunks(spark: SparkSession, sf: str) -> DataFrame:
    rows = ordering.numbered(table(spark, sf, "documents").select("doc_id"), "doc_id")
    sheet, row = F.floor((F.col("rn") - 1) / 6), (F.col("rn") - 1) % 6
    return rows.select("doc_id", sheet.alias("sheet"), F.format_string("S%02dR%d", sheet, row).alias("rid"))


@query("""WITH r AS (SELECT doc_id, source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents)
SELECT concat(source, '__', doc_id) AS name, source AS task, ((rn - 1) // 6)::BIGINT AS sheet, left(text, 22) AS line1, substr(text, 23, 22) AS line2 FROM r""")
def q_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Contact sheets of six rows for each task, with the label in lines of 22."""
    rows = table(spark, sf, "documents").select("doc_id", "source", F.substring("text", 1, 44).alias("text"))
    rows = ordering.numbered(rows, "doc_id", by=("source",))
    lines = F.transform(F.sequence(F.lit(0), F.lit(1)), lambda i: F.substring("text", i * 22 + 1, F.lit(22)))
    return rows.select(F.concat_ws("__", "source", "doc_id").alias("name"), F.col("source").alias("task"), F.floor((F.col("rn") - 1) / 6).alias("sheet"), lines[0].alias("line1"), lines[1].alias("line2"))


@query("""SELECT 'E/' || event_id AS key, coalesce(nullif(event_type, ''), nullif(props, ''), '?') AS instruction, coalesce(event_type, props, '?') AS shown,
  coalesce(CASE WHEN event_type = 'click' THEN '' ELSE event_type END, '?') AS plain FROM events
UNION ALL SELECT 'C/' || conv_id || '/' || turn, coalesce(nullif(text, ''), '?'), coalesce(text, '?'), coalesce(text, '?') FROM conversations""")
def q_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The judge's manifest over two kinds of pairs, with the three ways that defaults are taken."""
    kind = F.col("event_type")
    events = table(spark, sf, "events").select(
        F.concat(F.lit("E/"), "event_id").alias("key"), F.coalesce(merging.falsy(kind, F.col("props")), F.lit("?")).alias("instruction"),
        F.coalesce(kind, "props", F.lit("?")).alias("shown"), F.coalesce(F.when(kind == "click", "").otherwise(kind), F.lit("?")).alias("plain"),
    )
    text = F.col("text")
    turns = table(spark, sf, "conversations").select(
        F.concat(F.lit("C/"), "conv_id", F.lit("/"), "turn").alias("key"), F.coalesce(merging.falsy(text), F.lit("?")).alias("instruction"),
        F.coalesce(text, F.lit("?")).alias("shown"), F.coalesce(text, F.lit("?")).alias("plain"),
    )
    return events.unionByName(turns)
