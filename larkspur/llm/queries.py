"""The thin queries of the numbered operators and of the pipeline, with check SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bpe, chat, darts, mixing, negatives, packing, pivots, repeats, tokencount, toxicity, urlrules, warc, whitening

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(mixing.SQL)
def op5_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.systematic_copies(docs).select("doc_id", "size", "source_size", "target", "taken")


@query(urlrules.SQL)
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [*(urlrules.prefix_rule(*r) for r in urlrules.PREFIX_RULES), *urlrules.JUNK_HOSTS]
    return urlrules.judge(table(spark, sf_dir, "pages"), rules, keep=["page_id"])


@query(chat.SQL)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_chats(rows.unionByName(probe)))


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), bpe.vocabulary_path("byte_bpe_50k.json"))


@query()
def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe.vocabulary_path("byte_bpe_50k.json"))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "lang", "text"), model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        "toxic",
    )


@query(pivots.SQL)
def op2_pivot_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return darts.near_duplicates(docs).select("doc_id", "class_id", "kept")


@query()
def op8_induced_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


@query(warc.SQL)
def op11_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


@query()
def op12_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query(negatives.SQL)
def op13_multi_index_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=moved)
