"""Op 8 [native]: mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources ordered by code point (null last) get repeating weights; together they
are to yield ``share`` of all words, no source more than ``cap`` times its own
(the excess goes to the others by weight: water filling in closed form over the
source table). A source is first taken in complete epochs; the rest of its
target is a weighted sample without replacement: document i gets the key
-ln(u_i) / w_i (u_i from a hash of its id, w_i its quality), and documents are
taken in order of the key until the prefix sum of their sizes reaches the rest;
the document in which the budget ends is taken up to the budget.

The prefix sum never sorts a whole source in one task: the keys of a source of n
documents fall into about sqrt(n) buckets, bucket sums are prefix-summed per
source, and only the documents of the one bucket in which the budget ends (about
sqrt(n) again) are ordered. The buckets are even for any mix of quality weights: a key's place is
its distribution function, the mean of 1 - exp(-w key) over the source's classes of weights
(powers of the square root of two, of which a source has a few dozen at most).
The decision is one row per source (epochs, last bucket, last key, words of the
last document), so what is taken is found by joining documents with that table.

Nulls and edges: a null or wordless text has size 0 and is taken 0 words; a null
source is a source of its own; a null doc_id draws by its text; equal ids draw
equally (repeated rows share what their key gets); an empty table gives no rows;
columns other than doc_id, text and source play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reuse import materialize

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WEIGHTS = (5, 2, 1)
SEED = 8


def size_of(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    """Document quality weight in (0, 1]: fewer symbols per word weigh more."""
    symbols = F.coalesce(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), F.lit(0))
    return F.lit(1.0) / (F.lit(1.0) + symbols / F.greatest(size, F.lit(1)))


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A uniform in (0, 1) from 52 bits of md5 of the id (of the text if null)."""
    name = F.coalesce(doc_id.cast("string"), F.md5(text), F.lit(""))
    bits = F.conv(F.substring(F.md5(F.concat(name, F.lit(f":{seed}"))), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(2.0 ** 52)


def keyed(docs: DataFrame, seed: int = SEED, *carry: str) -> DataFrame:
    """doc_id, source, size, quality and the exponential key of each document (with the columns in carry)."""
    sized = docs.select("doc_id", "source", "text", *carry, size_of(F.col("text")).alias("size"))
    sized = sized.withColumn("quality", quality_of(F.col("text"), F.col("size")))
    key = -F.log(draw(F.col("doc_id"), F.col("text"), seed)) / F.col("quality")
    return sized.select("doc_id", "source", *carry, "size", "quality", key.alias("es_key"))


def source_targets(base: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: n_docs, source_size, weight, target, and its classes of quality weights (w, n)."""
    classes = base.groupBy("source", F.floor(-2 * F.log2("quality")).alias("class")).agg(
        F.count("*").alias("n"), F.sum("size").alias("words"), F.avg("quality").alias("w"))
    src = classes.groupBy("source").agg(F.sum("n").alias("n_docs"), F.sum("words").alias("source_size"),
                                        F.sort_array(F.collect_list(F.struct("w", "n"))).alias("classes"))
    # Windows over the source table, which has one row per source.
    name = Window.orderBy(F.col("source").asc_nulls_last())
    src = src.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(name) - 1) % len(weights) + 1).cast("int")))
    src = src.withColumn("most", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("most") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    src = src.withColumn("level", (F.sum("source_size").over(everything) * F.lit(share)
                                   - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    src = src.withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything))
    target = F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return src.select("source", "n_docs", "source_size", "weight", target.alias("target"), "classes")


def _bucket(key: Column, n: Column, n_docs: Column, classes: Column) -> Column:
    """Bucket 0 .. n-1, increasing with the key; about equally many documents in each."""
    below = F.aggregate(classes, F.lit(0.0), lambda a, c: a + c["n"] * (F.lit(1.0) - F.exp(-key * c["w"])))
    return F.least(n - 1, F.floor(below / n_docs * n)).cast("long")


def decisions(base: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: its target, the complete epochs, and up to which
    bucket and key the fraction goes."""
    src = materialize(source_targets(base, weights, share, cap))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    src = (src.withColumn("epochs", epochs)
           .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
           .withColumn("n_buckets", F.ceil(F.sqrt("n_docs")).cast("long")))
    own = src.select(F.col("source").alias("s"), "rest", "n_buckets", "n_docs", "classes")
    bucket = _bucket(F.col("es_key"), F.col("n_buckets"), F.col("n_docs"), F.col("classes"))
    rows = base.join(own, F.col("source").eqNullSafe(F.col("s"))).withColumn("bucket", bucket)
    hist = rows.groupBy("source", "rest", "bucket").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket")
    hist = hist.withColumn("upto", F.sum("words").over(running))
    ends = materialize(hist.filter(F.col("upto") > F.col("rest")).groupBy("source").agg(
        F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
        .select(F.col("source").alias("cs"), F.col("cut.bucket").alias("cut_bucket"), F.col("cut.before").alias("before")))
    last = rows.join(ends, F.col("source").eqNullSafe(F.col("cs")) & (F.col("bucket") == F.col("cut_bucket")))
    last = last.groupBy("source", "rest", "before", "es_key").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("es_key")) + F.col("before")
    last = last.withColumn("upto", upto).filter(F.col("upto") > F.col("rest"))
    part = F.floor((F.col("rest") - (F.col("upto") - F.col("words"))) / F.col("docs"))
    last = last.groupBy("source").agg(F.min(F.struct("es_key", part.alias("part"))).alias("end")).select(
        F.col("source").alias("ls"), F.col("end.es_key").alias("cut_key"), F.col("end.part").alias("cut_part"))
    out = src.join(ends, F.col("source").eqNullSafe(F.col("cs")), "left").join(last, F.col("source").eqNullSafe(F.col("ls")), "left")
    return materialize(out.select("source", "source_size", "weight", "target", "epochs", "n_buckets", "n_docs", "classes", "cut_bucket", "cut_key", "cut_part"))


def taken_of(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """rows (keyed documents) with source_size, target, the whole copies the mix
    takes, and the words of one more copy that is cut."""
    own = decided.withColumnRenamed("source", "s")
    bucket = _bucket(F.col("es_key"), F.col("n_buckets"), F.col("n_docs"), F.col("classes"))
    at_cut = bucket == F.col("cut_bucket")
    whole = (bucket < F.col("cut_bucket")) | (at_cut & (F.col("es_key") < F.col("cut_key")))
    part = F.when(at_cut & (F.col("es_key") == F.col("cut_key")), F.least("size", "cut_part")).otherwise(0)
    return rows.join(own, F.col("source").eqNullSafe(F.col("s"))).withColumns({
        "copies": F.col("epochs") + F.coalesce(whole, F.lit(False)).cast("long"),
        "part": F.coalesce(part, F.lit(0)).cast("long"),
    }).select(*rows.columns, "source_size", "target", "copies", "part")


def mix_documents(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, part, taken (words)."""
    base = materialize(keyed(docs, seed))
    return taken_of(base, decisions(base, **options)).withColumn("taken", F.col("copies") * F.col("size") + F.col("part")).drop("es_key", "quality")


def mixed_rows(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken; the copy in
    which a budget ends keeps its first words only (wordless texts go)."""
    base = materialize(keyed(docs, seed))
    whole = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("__row"))
    rows = taken_of(keyed(whole, seed, "__row"), decisions(base, **options)).filter("size > 0")
    last = F.col("copies") + F.when(F.col("part") > 0, 1).otherwise(0)
    rows = rows.filter(last > 0).select("__row", "copies", "part", F.explode(F.sequence(F.lit(1), last.cast("int"))).alias("__copy"))
    text = F.col("__row.text")
    first_words = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("part").cast("int")), " ")
    text = F.when(F.col("__copy") > F.col("copies"), first_words).otherwise(text)
    return rows.select(*[text.alias("text") if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns])
