"""The registered queries of this subpackage: opN_<name>(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, lexical_search, line_dedup, merkle, minhash, mixing, ngram_lm, packing, quality_model, quality_rules, sql
from . import substring_dedup, toxicity, url_lists


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents (five-word shingles, similarity 0.8)."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "class_size", "n_links", "is_kept")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest other vectors of every vec_id divisible by 100."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten or more sources share; a document
    without other lines is left whole."""
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "removed_chars", "text")


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality probability of every document, learned outside the held-out fold."""
    return quality_model.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what is cut as a repetition of earlier ranked text: the number of spans,
    their words and characters, and each as start:length:first_doc_id."""
    return substring_dedup.document_spans(substring_dedup.unit_table(_table(spark, sf_dir, "documents"))).drop("row_id")


#: Dates that the pages table lacks are derived from hashes, within a year from here (2024-01-01 UTC).
YEAR_START, YEAR_SECONDS = 1704067200, 365 * 86400


def _hashed(name, seed: str, modulus: int):
    """A number below modulus from 52 bits of md5."""
    bits = F.conv(F.substring(F.md5(F.concat(name, F.lit(f":{seed}"))), 1, 13), 16, 10).cast("long")
    return bits % modulus


def dated_captures(pages: DataFrame) -> DataFrame:
    """page_id, url and a fetch time derived from the id."""
    at = F.lit(YEAR_START) + _hashed(F.col("page_id").cast("string"), "fetch", YEAR_SECONDS)
    return pages.select("page_id", "url", F.timestamp_seconds(at).alias("fetched"))


def dated_lists(pages: DataFrame) -> DataFrame:
    """Three list logs over all hosts, domains and first path segments of pages:
    hosts come on the list and go, domains stay, prefixes come, go and come back."""
    host = url_lists.host_of(F.col("url"))
    hosts = pages.select(host.alias("key")).filter("key is not null").distinct()
    domains = hosts.select(F.regexp_extract("key", r"([^.]+\.[^.]+)$", 1).alias("key")).filter("key <> ''").distinct()
    first = F.regexp_extract(url_lists.path_of(F.col("url")), "^/([^/]+)", 1)
    paths = pages.select(F.when(first != "", F.concat(host, F.lit("/"), first)).alias("key")).filter("key is not null").distinct()

    def log(keys: DataFrame, name: str, kind: str, *steps: tuple[str, str, int]) -> DataFrame:
        at = F.lit(YEAR_START).cast("long")
        entries = []
        for action, seed, modulus in steps:
            at = at + _hashed(F.col("key"), seed, modulus)
            entries.append(F.struct(F.lit(action).alias("action"), F.timestamp_seconds(at).alias("at")))
        return keys.select(F.lit(name).alias("list_name"), F.lit(kind).alias("kind"), "key", F.explode(F.array(*entries)).alias("e")) \
            .select("list_name", "kind", "key", "e.*")

    return (log(hosts, "malware", "host", ("add", "a", YEAR_SECONDS), ("remove", "r", YEAR_SECONDS // 4))
            .unionByName(log(domains, "adult", "domain", ("add", "a", YEAR_SECONDS)))
            .unionByName(log(paths, "spam", "prefix", ("add", "a", YEAR_SECONDS // 2), ("remove", "r", YEAR_SECONDS // 4),
                             ("add", "b", YEAR_SECONDS // 4))))


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the lists that held its url when it was fetched."""
    pages = _table(spark, sf_dir, "pages")
    found = url_lists.blocked_lists(dated_captures(pages), dated_lists(pages))
    return found.select("page_id", "url", F.unix_seconds("fetched").alias("fetched_s"),
                        F.array_join("blocked_by", ",").alias("blocked_by"), "allowed")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, tokeniser fertility and verdict of every document."""
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document, learned outside the held-out fold."""
    return ngram_lm.score_texts(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of sources takes."""
    return mixing.mix_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 4096 ids."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity probability of every document, learned outside the held-out fold."""
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item."""
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and checked proof of every document."""
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ann": op1_ann,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_model": op3_quality_model,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_url_lists": op5_url_lists,
    "op6_quality_rules": op6_quality_rules,
    "op7_ngram_lm": op7_ngram_lm,
    "op8_mixing": op8_mixing,
    "op9_packing": op9_packing,
    "op10_minhash": op10_minhash,
    "op11_toxicity": op11_toxicity,
    "op12_lexical_search": op12_lexical_search,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": sql.OP2,
    "op4_substring_dedup": sql.OP4,
    "op5_url_lists": sql.OP5,
    "op8_mixing": sql.OP8,
    "op12_lexical_search": sql.OP12,
    "op13_merkle_manifest": sql.OP13,
}
