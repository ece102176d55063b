"""One query per operator over its whole table, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    bpe,
    centroids,
    fill_middle,
    langid,
    line_dedup,
    lm_scoring,
    mixing,
    order_minhash,
    secret_scan,
    sharding,
    simhash,
    topk,
    toxicity,
)
from daybook.session import new_path

SHARDS = [f"shard-{n:03d}" for n in range(64)]
# the mixture by language, as far as the labels table marks documents as good, and what it marks as poor
TARGETS = {"de": 0.17, "en": 0.45, "es": 0.13, "fr": 0.17, "poor": 0.08}
KEPT = ("de", "en", "es", "fr")  # domains of which no document is dropped


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _fold(of: int, id_col: str = "doc_id") -> Column:
    """The remainder that deals documents into folds, by the checksum of their id as text."""
    return F.crc32(F.col(id_col).cast("string")) % of


def tokenizer() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public tokenizer that the queries use."""
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def quality_domains(labels: DataFrame) -> DataFrame:
    """Ids and domains of the labelled documents: the domain is the label of their quality."""
    return labels.where("quality IN (0, 1)").select(
        "doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("domain")
    )


def language_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Ids and domains of the labelled documents: the language of good ones, ``poor`` for the others."""
    languages = docs.select("doc_id", "lang").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    marked = labels.where("quality IN (0, 1)").select("doc_id", "quality").join(languages, "doc_id")
    return marked.select("doc_id", F.when(F.col("quality") == 1, F.col("lang")).otherwise("poor").alias("domain"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    filters = langid.learn(docs.where(_fold(5) != 0))
    return langid.identify(docs, filters).select(
        "doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_neighbours(_read(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.scores(_read(spark, sf_dir, "documents"), _fold(7) != 2, *tokenizer())
    return scored.select(
        "doc_id", F.coalesce(_fold(7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scorer = toxicity.learn(docs, _read(spark, sf_dir, "labels").where(_fold(5) != 0))
    return toxicity.score(docs, scorer).select(
        "doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_read(spark, sf_dir, "documents"), *tokenizer())


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    mixed, fit = mixing.mix(docs, language_domains(docs, _read(spark, sf_dir, "labels")), TARGETS, kept=KEPT)
    named = [F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(sorted(TARGETS))]
    # the same in every row: tokens wanted of each domain, and expected at the fitted rates
    wanted = [F.lit(float(x)).alias(f"target_{d}") for d, x in zip(sorted(TARGETS), fit.targets)]
    reached = [F.lit(float(x)).alias(f"total_{d}") for d, x in zip(sorted(TARGETS), fit.totals)]
    return mixed.select("doc_id", "n_tokens", *named, "rate", "copies", *wanted, *reached)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return sharding.write(docs, "doc_id", SHARDS, new_path(spark, "shards")).select("doc_id", "slot", "shard")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_read(spark, sf_dir, "documents"))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    numbers = [number(kind).alias(f"n_{name}") for kind, name in enumerate(secret_scan.BASE)]
    base, spans = (secret_scan.as_text(F.col(c)) for c in ("base", "spans"))
    return found.select("doc_id", *numbers, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(_read(spark, sf_dir, "embeddings"))
    digests = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    return found.rows.select(
        F.col("id").alias("vec_id"), "cluster", "distance",
        found.of_cluster(found.inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(found.inertia)).cast("long").alias("inertia"),
        found.of_cluster(digests, "string").alias("centroid_sha256"),
    )


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(_read(spark, sf_dir, "documents"))
    again = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_language_id, op2_line_dedup, op3_simhash, op4_order_minhash, op5_lm_scoring, op6_toxicity, op7_top_k,
        op8_bpe, op9_mixing, op10_sharding, op11_secret_scan, op12_centroids, op13_fill_middle,
    ]
    return {f.__name__: f for f in named}
