"""From raw documents to packed training sequences: five stages over the operators in llm/.

Each stage takes what its predecessor kept, and its result is written to the shared folder and
read again, so a lost executor repeats tasks of one stage only. Models are fitted on the stage's
own input. All stages but the last keep the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barscreen.llm import language, mixing, packing, simhash, toxicity
from barscreen.llm.common import fresh, staged
from barscreen.llm.queries import table, tokenizer_path

#: Documents scored as toxic from here on go.
TOXIC = 0.3
#: Documents in which no language has this share go, as do those without letters. Texts of fewer
#: characters than JUDGED are too short to tell languages apart and stay if they hold a letter.
LANGUAGE_SHARE, JUDGED = 0.4, 64


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~toxicity.held_out())
    score = fresh(docs, "_score")
    scored = toxicity.scored(docs, toxicity.fit(docs, labels), name=score)
    return scored.where(F.col(score) < TOXIC).drop(score)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = fresh(docs, "_lang_pred"), fresh(docs, "_lang_score")
    texts = language.fit(docs.where(~language.held_out()))
    found = language.predicted(docs, texts, names=names)
    told = (F.col(names[1]) >= LANGUAGE_SHARE) | (F.length("text") < JUDGED)
    kept = (F.col(names[0]) != language.NONE) & told
    return found.where(kept).drop(*names)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.packed(docs, tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_each),
    ("mixing", mix),
    ("packing", pack),
]
#: SQL can express neither the models nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
