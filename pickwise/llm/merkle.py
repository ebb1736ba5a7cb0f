"""Op 13: Merkle dataset manifest, leaves placed by bitmap rank.

Every row is a leaf; per source the leaves ascend by doc_id, and runs of 16 become
one digest until one is left, the subroot; the subroots of all sources, ordered by
source, become the root in the same way.

Leaf coordinates come from a rank index instead of a sort of the rows. The ids of
a source form a compressed bitmap: 64 ids make a word, only words with a set bit are
stored, and the partial words of all tasks are merged by ``bit_or``. A directory
of popcounts (``DIRECTORY_BITS`` of the word number a level, so that a window sees
at most 2 ** DIRECTORY_BITS rows) gives the leaves before each word; a row's place
is that number plus the popcount of the lower bits of its word. The levels of the tree are
then keyed slot arrays: nodes are grouped by (source, place div 16) into an array
by slot, whose digest is a node of the next level.

A proof holds, level by level, the nodes left and right of the own one. Runs of 16
share everything above them, so paths are joined run by run from the root down and
only the last step makes one row per document.

Skew: bitmap words are partially aggregated; every other grouping has at most 16
or 64 members; rows meet the written word table in an equi-join that adaptive
execution can split. Only the number of leaves of the largest source, the number of
sources and the root come to the driver.

Nulls and edges: a null doc_id ranks before all others and is never tampered with;
a null source is a source that comes first; null values hash as ``-``; rows of one source
that share a doc_id rank by their leaf digest (equal rows are interchangeable);
their places come from one global sort of these rows only. Texts of any
length are hashed whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import with_global_index
from ..functions.reuse import materialize
from .text import lookup_table

RUN_BITS = 4
#: Word numbers have 58 bits; three levels of directory leave at most 2 ** 16 entries and a null above them.
DIRECTORY_BITS, DIRECTORY_LEVELS = 14, 3
#: The word of null ids, below those of all numbers.
NULL_WORD = -(1 << 57) - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows whose crc32 of the id is divisible by this are tampered with in the self-test of the manifest.
TAMPER_MOD = 5
_SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """g (source, null first), doc_id, leaf, seen (leaf after tampering), w and b (word and bit of the id), uid."""
    key = F.col("doc_id").cast("long")
    tampered = F.coalesce(F.crc32(key.cast("string").cast("binary")) % TAMPER_MOD == 0, F.lit(False))
    lowered = F.translate("text", UPPER, LOWER)
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("g"), key.alias("doc_id"),
        leaf_digest(F.col("text")).alias("leaf"), F.when(tampered, leaf_digest(lowered)).alias("seen"),
        F.coalesce(F.shiftright(key, 6), F.lit(NULL_WORD)).alias("w"),
        F.coalesce(key.bitwiseAND(63), F.lit(0)).cast("int").alias("b"), F.monotonically_increasing_id().alias("uid"))


def bitmap_words(rows: DataFrame) -> DataFrame:
    """g, w, bits, n (rows) and more: the further copies of ids with several rows, by bit."""
    words = materialize(rows.groupBy("g", "w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits"), F.count("*").alias("n")))
    crowded = words.filter("n > bit_count(bits)").select("g", "w")
    more = rows.join(crowded.hint("rebalance"), ["g", "w"], "left_semi").groupBy("g", "w", "b").agg(F.count("*").alias("m")) \
        .filter("m > 1").groupBy("g", "w").agg(F.collect_list(F.struct("b", (F.col("m") - 1).alias("m"))).alias("more"))
    return words.join(more.hint("rebalance"), ["g", "w"], "left")


def with_directory(words: DataFrame) -> DataFrame:
    """words with before (leaves of the source in earlier words) and total (leaves of the source)."""
    counts = [words.select("g", F.col("w").alias("k"), "n")]
    up = F.shiftright("k", DIRECTORY_BITS)
    for _ in range(DIRECTORY_LEVELS):
        counts.append(counts[-1].groupBy("g", up.alias("k")).agg(F.sum("n").alias("n")))
    earlier = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    sums = F.coalesce(F.sum("n").over(earlier.partitionBy("g")), F.lit(0))
    top = counts[-1].select("g", "k", sums.alias("before"), F.sum("n").over(Window.partitionBy("g")).alias("total"))
    for level in reversed(counts[:-1]):
        level = level.withColumn("up", up)
        within = F.coalesce(F.sum("n").over(earlier.partitionBy("g", "up")), F.lit(0))
        top = level.select("g", "k", "up", within.alias("within")).join(
            top.select("g", F.col("k").alias("up"), F.col("before").alias("base"), "total"), ["g", "up"]).select(
            "g", "k", (F.col("within") + F.col("base")).alias("before"), "total")
    return words.join(top.withColumnRenamed("k", "w"), ["g", "w"])


def place(rows: DataFrame, words: DataFrame) -> DataFrame:
    """rows with idx, the place of a leaf in its source, and c, the source's number of leaves."""
    lower = F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, b)"))
    extra = F.aggregate(F.filter("more", lambda x: x.b < F.col("b")), F.lit(0).cast("long"), lambda a, x: a + x.m)
    copies = F.exists("more", lambda x: x.b == F.col("b"))
    ranked = rows.join(lookup_table(words), ["g", "w"]).select(
        "g", "doc_id", "leaf", "seen", "uid", F.col("total").alias("c"), F.coalesce(copies, F.lit(False)).alias("copied"),
        (F.col("before") + F.bit_count(lower) + F.coalesce(extra, F.lit(0))).alias("idx"))
    if words.filter("more is not null").isEmpty():
        return ranked
    ranked = materialize(ranked)
    # Rows that share source and id also share idx; in the order of their digests they take the places from there on.
    copied = with_global_index(ranked.filter("copied"), ["g", "idx", "leaf", "uid"], "at")
    first = copied.groupBy("g", "idx").agg(F.min("at").alias("first"))
    copied = copied.join(first.hint("rebalance"), ["g", "idx"]).withColumn("idx", F.col("idx") + F.col("at") - F.col("first"))
    return ranked.filter("not copied").unionByName(copied.select(ranked.columns))


def runs_of(nodes: DataFrame, *extra: str) -> DataFrame:
    """Keyed slot arrays: g, c (nodes of this level), r (place of the run), kids in slot
    order, and h: their digest, or the node itself where it is the only one."""
    kid = F.struct(F.col("idx").bitwiseAND(15).cast("int").alias("slot"), "h", *extra)
    run = nodes.groupBy("g", "c", F.shiftright("idx", RUN_BITS).alias("r")).agg(F.array_sort(F.collect_list(kid)).alias("kids"))
    return materialize(run.withColumn("h", F.when(F.col("c") == 1, F.col("kids")[0].h).otherwise(F.sha2(joined(), 256))))


def joined() -> Column:
    return F.array_join(F.transform("kids", lambda x: x.h), "")


def reduce_levels(nodes: DataFrame, largest: int, *extra: str) -> list[DataFrame]:
    """The runs of every level of the trees of all g, lowest first; the last one's h are the roots."""
    levels = [runs_of(nodes, *extra)]
    while (largest := -(-largest // 16)) > 1:
        nodes = levels[-1].select("g", F.expr("(c + 15) div 16").alias("c"), F.col("r").alias("idx"), "h")
        levels.append(runs_of(nodes))
    return levels


def sides(run: Column, slot: Column, c: Column) -> Column:
    """The nodes before and after a slot of a run, as an array of one entry; none for a lone node."""
    left = F.substring(run, F.lit(1), slot * 64)
    return F.when(c > 1, F.array(F.struct(left.alias("left"), F.substring(run, slot * 64 + 65, F.lit(1024)).alias("right")))) \
        .otherwise(F.array().cast("array<struct<left:string,right:string>>"))


def with_paths(levels: list[DataFrame], found: DataFrame, *rest: str) -> DataFrame:
    """The lowest runs with up, the sides on the way from the run to the top, and the
    columns rest; found is the highest level with up (the way on from each g's root) and rest."""
    for level in reversed(levels[:-1]):
        parent = found.select("g", F.col("r").alias("p"), joined().alias("run"), F.col("c").alias("pc"), "up", *rest)
        found = level.withColumn("p", F.shiftright("r", RUN_BITS)).join(parent, ["g", "p"]).withColumn(
            "up", F.concat(sides(F.col("run"), F.col("r").bitwiseAND(15).cast("int"), F.col("pc")), "up")).select(*level.columns, "up", *rest)
    return found


def own_paths(found: DataFrame, *kid_columns: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per node of the lowest level: its kid_columns and path, the sides from itself to the top."""
    kids = found.select("c", "up", joined().alias("run"), *keep, F.explode("kids").alias("kid"))
    return kids.select(*[F.col("kid")[k].alias(k) for k in kid_columns], *keep,
                       F.concat(sides(F.col("run"), F.col("kid.slot"), F.col("c")), "up").alias("path"))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: leaf, subroot and root of the manifest, the digest of its
    proof, and the root folded from the (for some rows tampered) document."""
    spark = docs.sparkSession
    rows = materialize(leaves(docs))
    words = materialize(with_directory(bitmap_words(rows)))
    largest = words.agg(F.max("total")).first()[0]
    if largest is None:
        return spark.createDataFrame([], _SCHEMA)
    nodes = place(rows, words).withColumnRenamed("leaf", "h")
    levels = reduce_levels(nodes, largest, "doc_id", "seen")
    sources = materialize(with_global_index(levels[-1].select("g", "h"), ["g"], "idx"))
    n = sources.count()
    tree = reduce_levels(sources.select(F.lit("").alias("g"), F.lit(n).cast("long").alias("c"), "idx", "h", F.col("g").alias("source")), n, "source")
    root = tree[-1].first().h
    top = tree[-1].withColumn("up", F.array().cast("array<struct<left:string,right:string>>"))
    above = own_paths(with_paths(tree, top), "source", "h").select(
        F.col("source").alias("g"), F.col("path").alias("up"), F.col("h").alias("subroot"))
    out = own_paths(with_paths(levels, levels[-1].drop("h").join(above, "g"), "subroot"), "doc_id", "h", "seen", keep=("subroot",))
    folded = F.aggregate("path", F.coalesce("seen", "h"), lambda h, x: F.sha2(F.concat(x.left, h, x.right), 256))
    proof = F.array_join(F.transform("path", lambda x: F.concat(x.left, x.right)), "")
    return out.select("doc_id", F.col("h").alias("leaf"), "subroot", F.lit(root).alias("root"), F.sha2(proof, 256).alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
