"""A corpus made ready for training: each stage takes what the one before kept, written and read again.

1. language_id: documents in no learned language go, as do those that could as well be in another.
2. near_duplicates: of each class of near duplicates the document with the least id stays.
3. pii: personal data in the texts is masked, and n_chars follows.
4. mixing: documents are drawn to the fitted weights of source, language and topic.
5. bpe: the texts as token ids.

All stages but the last return the columns of documents. Rows with a null id are never taken for near
duplicates. Each row is a document: rows that share an id and have unlike texts stay; of rows of one class that
share its least id the first by text and then by the other columns does. Texts without words are of one
class for each id. Null texts have no language and go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm import bpe, forest, language, mixing, pii
from headway.llm.queries import VOCABULARY
from headway.llm.shared import settle, small_batches, table

#: A document stays if its language has more than this share of the evidence.
LEAST_CERTAINTY = 0.5
#: Powers of the observed shares that make the targets, and the share of all tokens to draw.
MIX_POWER = {"source": 0.8, "lang": 0.8, "topic": 1.0}
MIX_BUDGET = 0.8

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    lang, score = ("_".join([name, *docs.columns]) for name in ("predicted", "score"))
    guessed = language.identify(docs, language.train(docs), lang_pred=lang, score=score)
    kept = guessed.where((F.col(lang) != "und") & (F.col(score) > LEAST_CERTAINTY))
    return kept.withColumn("lang", F.coalesce("lang", lang)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    key, cls, place = ("_".join([name, *docs.columns]) for name in ("key", "class", "place"))
    classes = forest.near_duplicates(docs, keys=True)
    least = classes.where("doc_id = class_id").select("doc_id", F.col("text_key").alias(key), F.col("class_key").alias(cls))
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("doc_id", cls).orderBy("text", *others)
    kept = (
        docs.withColumn(key, forest.text_key(F.col("text")))
        .join(least.distinct(), ["doc_id", key])
        .withColumn(place, F.row_number().over(order))
        .where(F.col(place) == 1)
    )
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    spans = "_".join(["spans", *docs.columns])
    found = pii.find(docs, pii.train(docs), spans_col=spans)
    masked = found.withColumn("text", pii.masked(F.col("text"), F.col(spans)))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.drawn(docs, MIX_POWER, budget=MIX_BUDGET)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    tokens = bpe.encode(docs.select("doc_id", "source", "lang", "text"), VOCABULARY)
    return tokens.select("doc_id", "source", "lang", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
