"""The operators as registered queries, over whole tables and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokecast.llm import bpe, decontaminate, jaccard, language, phrases, quality, ranked_search, recompression, repetition, sharding, token_files, toxicity, url_filter
from spokecast.llm.text import pick
from spokecast.session import scratch_path

SHARDS = 24
SHARD_SEED = 7
RULES = [
    url_filter.Rule("net/", "block"),
    url_filter.Rule("example.net/en/", "allow"),
    url_filter.Rule("example.com/de/", "block"),
    url_filter.Rule("org/fr/", "allow"),
]
#: Fixed value: names of sites whose pages make up the block list.
LISTED_SITES = r"(^|\.)(casino-win|cheap-pills|spam-farm|adult-x|free-bets|ads-track)\."


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary()
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), width=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    block_list = pick(pages, "url").where(url_filter.host_of(F.col("url")).rlike(LISTED_SITES))
    return url_filter.judge(pages, block_list, RULES)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.judged(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>"))), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.predict(documents, language.fit(documents))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.fit(documents, table(spark, sf_dir, "labels"), "quality"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels"), "toxic"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repetition.measure(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"), least=30, top=2000, longest=4, inside=80)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), path, end_id=2)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "search-index")
    ranked_search.build(table(spark, sf_dir, "documents"), path)
    return ranked_search.search(spark, path, table(spark, sf_dir, "benchmark"), k=10).select("item_id", "rank", "doc_id", "score")


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_url_filter": op3_url_filter,
    "op4_sharding": op4_sharding,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_phrases": op11_phrases,
    "op12_token_files": op12_token_files,
    "op13_ranked_search": op13_ranked_search,
}
