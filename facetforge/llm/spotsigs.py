"""Document fingerprints by SpotSigs, in DataFrame functions only.

A spot is a common word (an antecedent); its signature is the antecedent with the chain of the next content words, common
words left out. Signatures follow the running text and not lists, menus or boilerplate without common words. A document's
set of signatures is its fingerprint; likeness is the Jaccard coefficient of two sets.

Similar documents are found inside partitions of set length: sets of likeness t differ in length by a factor of t at most,
so a document is compared in its own partition and the next. There it is indexed by its rarest signatures, as many as any
set of likeness t must share one of; pairs that meet are pruned by length and then compared.

Defined cases: a text without any chain has one signature, its words (an empty or null text, the empty one); equal sets are
one class and are compared once, so copies make no pairs; rows with a null id come last in the order of documents; rows
with equal ids are ordered by their texts; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetforge.llm.common import Stored

#: The antecedents, common words of English, French, German and Spanish.
ANTECEDENTS = (
    "the a an is are was were be been to of and or in on at for with by from that this it as he she they you we his her its not but "
    "le la les l un une des du de et est sont en dans sur par pour avec qui que au aux ce cette il elle ne pas "
    "der die das ein eine einer den dem des und oder ist sind war zu von mit im in auf für sich nicht als auch es "
    "el los las unos unas y o es son del al con por para su sus se lo como más pero"
).split()
#: Content words in a chain.
CHAIN = 2
SEPARATOR = r"[^\p{L}\p{N}]+"
#: Documents of one range of ids, about; quantiles of ids, between which ranges are even in ids. A table of more than
#: RANGE * MOST documents has larger ranges instead of more, as their heads are ordered in one task.
RANGE, QUANTILES, MOST = 1000, 256, 1 << 20


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATOR), lambda w: w != "")


def with_signatures(rows: DataFrame, text: str, name: str, antecedents: list[str] = ANTECEDENTS) -> DataFrame:
    """The rows with `name`, the sorted set of signatures of the column `text`."""
    common = sorted(set(antecedents))
    w, content, places = f"{name}_w", f"{name}_c", f"{name}_p"
    rows = rows.withColumn(w, words(F.col(text)))
    rows = rows.withColumns(
        {
            content: F.filter(w, lambda x: ~x.isin(common)),
            places: F.filter(F.transform(w, lambda x, i: F.when(x.isin(common), i)), lambda i: i.isNotNull()),
        }
    )
    # Before the j-th antecedent, at place i, stand i - j content words.
    chain = lambda i, j: [F.get(content, i - j + k) for k in range(CHAIN)]
    spots = F.transform(places, lambda i, j: F.when(i - j + CHAIN <= F.size(content), F.concat_ws(":", F.get(w, i), *chain(i, j))))
    rows = rows.withColumn(name, F.array_sort(F.array_distinct(F.filter(spots, lambda s: s.isNotNull()))))
    return rows.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(F.array(F.concat_ws(" ", w)))).drop(w, content, places)


def fingerprint(signatures: Column) -> Column:
    return F.sha2(F.array_join(signatures, "\n"), 256)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard's coefficient of two sets."""
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def with_next(rows: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with `next_text`: of the next row by descending id, of the last row the first's.

    Rows are dealt out by ranges of ids: quantiles, each divided evenly into as many parts as the number of rows asks for.
    Each range is ordered by itself, and gets the first row of the range after it as a guest. Texts are shuffled once.
    """
    many = min(max(1, rows.count() // RANGE), MOST)
    points = [i / min(many, QUANTILES) for i in range(1, min(many, QUANTILES))]
    found = rows.agg(F.percentile_approx(doc_id, points, 10 * QUANTILES) if points else F.lit(None), F.min(doc_id), F.max(doc_id)).first()
    bounds = sorted({found[1], *(found[0] or []), found[2]} - {None})
    parts = -(-many // max(1, len(bounds) - 1))
    # The place from below, then counted down, as the order is descending; rows without an id come last.
    steps = F.array(*(F.lit(b) for b in bounds)).cast("array<double>")
    at = F.greatest(F.size(F.filter(steps, lambda b: b <= F.col(doc_id))), F.lit(1))
    low, high = F.get(steps, at - 1), F.coalesce(F.get(steps, at), F.get(steps, at - 1) + 1)
    place = at * parts + F.least(F.floor((F.col(doc_id) - low) / (high - low) * parts), F.lit(parts - 1))
    ranged = rows.withColumn("range", F.coalesce(-place, F.lit(1)).cast("long"))
    order = [F.desc_nulls_last(doc_id), F.xxhash64(text), F.col(text)]
    # The first row of each range: the largest id, of equal ids the first text.
    largest = ranged.groupBy("range").agg(F.max(doc_id).alias("id"))
    heads = ranged.join(F.broadcast(largest.withColumnRenamed("range", "r")), (F.col("range") == F.col("r")) & F.col(doc_id).eqNullSafe(F.col("id")))
    heads = heads.groupBy("range").agg(F.min(F.struct(F.xxhash64(text).alias("x"), F.col(text).alias("t"))).t.alias("t"))
    # Which range comes next is found without the texts: MOST rows at most.
    around = Window.orderBy("range")
    ends = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = heads.select("range", F.coalesce(F.lead("range").over(around), F.first("range").over(ends)).alias("next"))
    guests = turn.join(heads.withColumnRenamed("range", "next"), "next").select("range", F.col("t").alias(text))
    guests = guests.select("range", text, F.lit(None).cast(rows.schema[doc_id].dataType).alias(doc_id), F.lit(1).alias("guest"))
    both = ranged.withColumn("guest", F.lit(0)).unionByName(guests, allowMissingColumns=True)
    following = F.lead(text).over(Window.partitionBy("range").orderBy("guest", *order))
    return both.withColumn("next_text", following).where("guest = 0").drop("range", "guest")


def length_partition(size: Column, alike: float) -> Column:
    """The partition of a set's length: partitions grow by the factor 1 / alike."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(1 / alike)) + 1e-9).cast("int")


def similar(docs: DataFrame, alike: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, class_id: the smallest doc_id with the same set) and pairs of classes a < b with their likeness."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = Stored(with_signatures(rows, "text", "signatures").select("doc_id", "signatures"), "spots").df
    hashed = rows.select("doc_id", fingerprint(F.col("signatures")).alias("f"), "signatures")
    classes = hashed.groupBy("f").agg(F.min("doc_id").alias("class_id"), F.any_value("signatures").alias("signatures"))
    classes = Stored(classes.withColumn("size", F.size("signatures")), "classes").df
    members = hashed.select("doc_id", "f").join(classes.select("f", "class_id"), "f").select("doc_id", "class_id")
    spots = classes.select("f", "size", F.explode("signatures").alias("s"))
    counts = spots.groupBy("s").agg(F.count("*").alias("often"))
    rank = F.row_number().over(Window.partitionBy("f").orderBy("often", "s"))
    rare = spots.join(counts, "s").withColumn("rank", rank).where(F.col("rank") <= F.col("size") - F.ceil(F.col("size") * alike - 1e-9) + 1)
    rare = rare.withColumn("part", length_partition(F.col("size"), alike))
    near = rare.withColumn("part", F.explode(F.array("part", F.col("part") + 1)))
    a, b = near.alias("a"), rare.alias("b")
    met = (F.col("a.s") == F.col("b.s")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.f") != F.col("b.f"))
    met = met & (F.col("a.size") <= F.col("b.size")) & (F.col("a.size") >= F.col("b.size") * alike - 1e-9)
    pairs = a.join(b, met).select(F.least("a.f", "b.f").alias("x"), F.greatest("a.f", "b.f").alias("y")).distinct()
    one = classes.select(F.col("f").alias("x"), F.col("class_id").alias("a"), F.col("signatures").alias("sa"))
    two = classes.select(F.col("f").alias("y"), F.col("class_id").alias("b"), F.col("signatures").alias("sb"))
    compared = pairs.join(one, "x").join(two, "y").withColumn("likeness", likeness(F.col("sa"), F.col("sb"))).where(F.col("likeness") >= alike - 1e-12)
    return members, compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")
