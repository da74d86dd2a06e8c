"""The operators over their whole tables, one query each, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.llm import (
    decontamination,
    filter_audit,
    hard_negatives,
    host_rules,
    minhash,
    mixing,
    oracles,
    pieces,
    quality,
    secrets,
    substrings,
    token_files,
    toxicity,
    url_rules,
)
from bronzeflow.workspace import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listed(spans: Column, rules: tuple[secrets.Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["number"]), s["start"], s["stop"])), ",")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = secrets.BASE_RULES + secrets.ADDED_RULES
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"), rules)
    count = lambda n: F.size(F.filter("secrets", lambda s: s["number"] == n)).cast("bigint")
    base = F.filter("secrets", lambda s: s["number"] < len(secrets.BASE_RULES))
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(base, rules), 256).alias("base_sha256"),
        _listed(F.col("secrets"), rules).alias("spans"),
    )


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = host_rules.measure(_table(spark, sf_dir, "documents")).drop("text")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return host_rules.judge(measured).select(*columns)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(_table(spark, sf_dir, "documents"), minhash.NearDedup(shingle=4))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_file(), end_id=2)
    return token_files.read_digests(spark, path)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = substrings.remove_repeats(docs)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _held_out(modulus: int, rest: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % modulus == rest


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").filter(~_held_out(3, 1))
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", _held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draws(_table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "source", "lang", "topic", F.round("rate", 6).alias("rate"), "sampled")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").filter(~_held_out(5, 0))
    scored = quality.score_quality(docs, quality.train(docs, labels))
    return scored.select("doc_id", _held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near matches beside op10_decontamination, whose columns its SQL fixes."""
    found = decontamination.near_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.size("near_items").cast("bigint").alias("n_near_items"), F.array_join("near_items", ",").alias("near_items"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = tokenizer_file("piece_bpe_32k.model")
    encoded = pieces.encode_pieces(_table(spark, sf_dir, "documents").select("doc_id", "text"), file, end_id=2).drop("text")
    return pieces.decode_pieces(encoded, file).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").filter(hard_negatives.all_finite(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.select(F.col("vec_id").alias("id"), label.alias("label"), hard_negatives.quantized(F.col("embedding")).alias("vector"))
    return hard_negatives.mine(vectors, F.col("id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_host_rules,
        op3_near_duplicates,
        op4_token_files,
        op5_substrings,
        op6_toxicity,
        op7_mixing,
        op8_url_rules,
        op9_quality,
        op10_decontamination,
        op10_near_passages,
        op11_filter_audit,
        op12_pieces,
        op13_hard_negatives,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
