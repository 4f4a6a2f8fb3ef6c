"""The numbered queries: each applies its operator to a whole table and derives the columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.llm import additive, bpe, centroids, chaining, langid, packing, phrases, pst, quality, simhash, spotsigs, suffixes, toxicity
from facetforge.llm.common import documents, fold, labels, tuned

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = spotsigs.with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    for text, name in (("text", "own"), ("edited", "changed"), ("next_text", "following")):
        rows = spotsigs.with_signatures(rows, text, name)
    own, changed, following = F.col("own"), F.col("changed"), F.col("following")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), spotsigs.fingerprint(own).alias("fingerprint"),
        spotsigs.fingerprint(changed).alias("edited_fingerprint"), spotsigs.likeness(own, changed).alias("near_edited"),
        spotsigs.likeness(own, following).alias("near_next"), F.size("own").alias("n_signatures"),
        spotsigs.length_partition(F.size("own"), 0.8).alias("length_partition"),
    )


def op2_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive.nearest(tuned(spark).read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's posterior; `source` is the host, the language's section of it the path."""
    found = quality.judged(documents(spark, sf_dir), labels(spark, sf_dir), F.col("source"), F.col("lang"))
    return found.select(
        "doc_id", F.col("source").alias("host"), F.col("lang").alias("path"), F.col("quality_evidence").alias("evidence"),
        F.col("quality_site").alias("site_posterior"), F.col("quality_posterior").alias("posterior"), F.col("quality_keep").alias("keep"),
    )


def op4_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(documents(spark, sf_dir))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identified(documents(spark, sf_dir), fold(F.col("id"), 4) != 2)
    held_out = (fold(F.col("doc_id"), 4) == 2).alias("held_out")
    return found.select("doc_id", held_out, F.col("language_pred").alias("lang_pred"), F.col("language_score").alias("score"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)
    coded = coded.withColumns({"n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids_sha256": F.sha2("ids", 256)})
    decoded = bpe.decode_rows(coded, RANKS)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.judged(documents(spark, sf_dir), labels(spark, sf_dir), fold(F.col("id"), 5) != 0)
    score = F.col("toxicity_score")
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), F.col("toxicity_word").alias("word"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.without_repeats(documents(spark, sf_dir))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x.stop - x.start)
    return found.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.clustered(tuned(spark).read.parquet(f"{sf_dir}/embeddings.parquet")))


def op12_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pst.scored(documents(spark, sf_dir), fold(F.col("doc_id"), 7) != 2)
    held_out = (fold(F.col("doc_id"), 7) == 2).alias("held_out")
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


QUERIES = {"op1_spotsigs": op1_spotsigs, "op2_additive": op2_additive, "op3_quality": op3_quality, "op4_chaining": op4_chaining, "op5_language": op5_language, "op8_toxicity": op8_toxicity, "op6_byte_bpe": op6_byte_bpe, "op7_simhash": op7_simhash, "op9_packing": op9_packing, "op10_suffix_dedup": op10_suffix_dedup, "op11_centroids": op11_centroids, "op12_suffix_tree": op12_suffix_tree, "op13_phrases": op13_phrases}
COMMON = ", ".join(f"'{w}'" for w in sorted(set(spotsigs.ANTECEDENTS)))
#: Signatures of three texts of each document: its own, the edited one and the next document's.
OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next_text
  FROM documents WINDOW o AS (ORDER BY doc_id DESC)
), e AS (
  SELECT *, length(text) AS n_chars, left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) AS edited FROM d
), t AS (
  SELECT doc_id, 0 AS kind, text AS x FROM e UNION ALL SELECT doc_id, 1, edited FROM e UNION ALL SELECT doc_id, 2, next_text FROM e
), w AS (
  SELECT doc_id, kind, list_filter(regexp_split_to_array(lower(x), '[^\\p{{L}}\\p{{N}}]+'), lambda v: v <> '') AS w FROM t
), c AS (
  SELECT *, list_filter(w, lambda v: v NOT IN ({COMMON})) AS c,
    list_filter(range(1, len(w) + 1), lambda i: w[i] IN ({COMMON})) AS p FROM w
), s AS (
  SELECT doc_id, kind, w, list_sort(list_distinct(list_transform(
    list_filter(range(1, len(p) + 1), lambda j: p[j] - j + 2 <= len(c)),
    lambda j: w[p[j]] || ':' || c[p[j] - j + 1] || ':' || c[p[j] - j + 2]))) AS s FROM c
), f AS (
  SELECT doc_id, kind, CASE WHEN len(s) > 0 THEN s ELSE [array_to_string(w, ' ')] END AS s FROM s
), g AS (
  SELECT e.doc_id, n_chars, sha256(edited) AS edited_sha256, a.s AS a, b.s AS b, n.s AS n
  FROM e JOIN f a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN f b ON b.doc_id = e.doc_id AND b.kind = 1 JOIN f n ON n.doc_id = e.doc_id AND n.kind = 2
)
SELECT doc_id, n_chars, edited_sha256, sha256(array_to_string(a, chr(10))) AS fingerprint, sha256(array_to_string(b, chr(10))) AS edited_fingerprint,
  len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b)))::DOUBLE AS near_edited,
  len(list_intersect(a, n)) / (len(a) + len(n) - len(list_intersect(a, n)))::DOUBLE AS near_next,
  len(a)::INTEGER AS n_signatures, floor(ln(len(a)) / ln(1.25) + 1e-9)::INTEGER AS length_partition
FROM g
"""


def op11_sql(size: int = 64, clusters: int = 8, rounds: int = 10) -> str:
    """All rounds one after another, each comparing every vector with every centroid."""
    near = """a{r} AS MATERIALIZED (SELECT vec_id, q, min_by(k, (d, k)) AS k, min(d) AS d FROM (
  SELECT vec_id, q, c.k, list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{r} c) GROUP BY vec_id, q)"""
    move = """u{r} AS (SELECT k, i, sum(x)::HUGEINT AS s, count(*) AS n FROM (SELECT k, unnest(q) AS x, unnest(range({size})) AS i FROM a{r}) GROUP BY k, i),
m{r} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM u{r} GROUP BY k),
c{next} AS MATERIALIZED (SELECT o.k, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m ON m.k = o.k)"""
    steps = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, q) - 1)::INTEGER AS k, q AS c FROM (
  SELECT q, sha256('3:' || vec_id) AS h FROM v WHERE vec_id IS NOT NULL ORDER BY h, q LIMIT {clusters}))"""]
    for r in range(rounds):
        steps += [near.format(r=r), move.format(r=r, next=r + 1, size=size)]
    steps.append(near.format(r=rounds))
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, a.k AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.k = a.k"""


#: crc32 of doc_id as text, bit by bit: after each byte eight steps, marked by -1.
CRC_SQL = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
  lambda ch: list_prepend(ascii(ch)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
  lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""
#: Each token with the one and the two before it, and the tree's states as three joins.
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, {CRC_SQL} % 7 <> 2 AS train,
  list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), t AS MATERIALIZED (SELECT id, train, i, CASE WHEN i <= len(w) THEN w[i] ELSE '' END AS w, CASE WHEN i > 1 THEN w[i - 1] END AS x, CASE WHEN i > 2 THEN w[i - 2] END AS y FROM d, unnest(range(1, len(w) + 2)) r(i)
), c AS MATERIALIZED (SELECT w, count(*) AS c FROM t WHERE train GROUP BY w
), n AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM c
), p AS MATERIALIZED (SELECT t.*, c.c, (coalesce(c.c, 0) + 1) / (n.n + n.v + 1) AS p FROM t LEFT JOIN c ON c.w = t.w, n
), g1 AS MATERIALIZED (SELECT x, w, count(*) AS n, any_value(p) AS p FROM p WHERE train AND x IS NOT NULL GROUP BY x, w
), s1 AS MATERIALIZED (SELECT x, sum(n)::BIGINT AS n, count(*) AS d FROM g1 GROUP BY x HAVING sum(n) >= 16 AND sum(n) * 1048576 >= (SELECT n FROM n) AND sum(n * ln(n / p)) - sum(n) * ln(sum(n)) >= 0.5 * count(*) * ln(sum(n))
), q AS MATERIALIZED (SELECT p.*, s1.x IS NOT NULL AS stays, CASE WHEN s1.x IS NULL THEN p.p ELSE (coalesce(g1.n, 0) + s1.d * p.p) / (s1.n + s1.d) END AS q
  FROM p LEFT JOIN s1 ON s1.x = p.x LEFT JOIN g1 ON g1.x = p.x AND g1.w = p.w
), g2 AS MATERIALIZED (SELECT y, x, w, count(*) AS n, any_value(q) AS q FROM q WHERE train AND stays AND y IS NOT NULL GROUP BY y, x, w
), s2 AS MATERIALIZED (SELECT y, x, sum(n)::BIGINT AS n, count(*) AS d FROM g2 GROUP BY y, x HAVING sum(n) >= 16 AND sum(n) * 1048576 >= (SELECT n FROM n) AND sum(n * ln(n / q)) - sum(n) * ln(sum(n)) >= 0.5 * count(*) * ln(sum(n))
), r AS (SELECT q.*, CASE WHEN s2.x IS NULL THEN q.q ELSE (coalesce(g2.n, 0) + s2.d * q.q) / (s2.n + s2.d) END AS r
  FROM q LEFT JOIN s2 ON s2.x = q.x AND s2.y = q.y LEFT JOIN g2 ON g2.x = q.x AND g2.y = q.y AND g2.w = q.w
), z AS (SELECT id, count(*) AS n_tokens, count(c) AS n_known, sum(round(log10(p) * 1e9)::BIGINT)::BIGINT / 1e9 AS base_score, sum(round(log10(r) * 1e9)::BIGINT)::BIGINT / 1e9 AS score FROM r GROUP BY id)
SELECT d.doc_id, NOT d.train AS held_out, n_tokens, n_known, n.n AS train_tokens, base_score, score FROM d JOIN z ON z.id = d.id, n
"""
#: Every run of one to four words inside a piece, by its text.
OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p
), g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM w, range(1, 5) s(m) WHERE len(w) >= m
), f AS MATERIALIZED (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM g GROUP BY lang, m, phrase HAVING count(*) >= 30
), n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), c AS (SELECT lang, phrase, w, m, f AS a, unnest(range(1, m)) AS k FROM f WHERE m > 1
), s AS (SELECT c.lang, c.phrase, c.w, c.m, a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * a // (l.f + r.f))::BIGINT AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), i AS (SELECT lang, f, unnest(list_transform(range(1, m - z + 2), lambda x: array_to_string(w[x:x + z - 1], ' '))) AS phrase FROM f, range(2, 4) q(z) WHERE m > z
), x AS (SELECT lang, phrase, max(f) AS longer FROM i GROUP BY lang, phrase
), r AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score
  FROM b LEFT JOIN x ON x.lang = b.lang AND x.phrase = b.phrase WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op1_spotsigs": OP1_SQL, "op11_centroids": op11_sql(), "op12_suffix_tree": OP12_SQL, "op13_phrases": OP13_SQL}
