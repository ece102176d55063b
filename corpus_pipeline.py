"""From raw documents to token ids: the stages, each on all that the one before it has kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as Parquet and read again as the next
stage's documents; all but the last keep the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, line_dedup, mixing, simhash, toxicity
from daybook.llm.queries import KEPT, TARGETS, language_domains, tokenizer
from daybook.llm.staging import Stages

RUN_CHARS = 5_000_000  # of the last stage: executors' heaps are full by then, so its workers get less memory


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer, learned from the labels, does not take for toxic; labelled ones are scored like all."""
    scorer = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, scorer)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another document keeps for them; ``n_chars`` follows the text."""
    return line_dedup.dedup_lines(docs, counts=False).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document that names it, once."""
    return simhash.keep_one(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says, so that languages and poor texts come near their target shares of all tokens.

    The rate of what the classifier takes for a good text of some language is one or more; the budget grows where that
    asks for more tokens.  No document comes more than ``mixing.MOST`` times.
    """
    labelled = language_domains(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mixed, _ = mixing.mix(docs, labelled, TARGETS, kept=KEPT)
    return mixing.expand(docs, mixed)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with what decoding them gives as a digest: ``doc_id, n_tokens, ids, decoded_sha256``."""
    return bpe.encode(docs, *tokenizer(), run_chars=RUN_CHARS)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_domains),
    ("byte_bpe", encode),
]

# The stages learn models and hash with XXH64, which DuckDB's SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stages.write(stage(spark, docs, sf_dir))
    return docs
