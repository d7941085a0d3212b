"""The registered queries of the training-data operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barscreen.llm import (
    bpe, chat, language, mixing, neighbours, packing, prefix_trie, quality, reputation, search, simhash, toxicity, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(builder: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[builder.__name__] = builder
    return builder


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file; every machine has the package installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.risk_controlled(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.array_join("broken", ",").alias("broken"),
    )


@query
def op2_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionAll(extra)
    return chat.read_back(chat.format_turns(chat.attached(rows), typed=True))


@query
def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    texts = language.fit(docs.where(~language.held_out()))
    found = language.predicted(docs.select("doc_id", "text"), texts, keep_text=False)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query
def op10_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "toxic").where(~toxicity.held_out())
    machine = toxicity.fit(docs, labels)
    return toxicity.scored(docs, machine, keep_text=False).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op4_hilbert_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


#: The contract's rules: host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


@query
def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    drawn = mixing.mixed(table(spark, sf, "documents").select("doc_id", "text", "source", "lang"))
    return drawn.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
        F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"), (F.round("_p", 6) + 0.0).alias("p"),
    )


@query
def op6_nn_descent(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf, "embeddings"))


@query
def op7_url_reputation(spark: SparkSession, sf: str) -> DataFrame:
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    outcomes = table(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")
    rounded = {c: F.round(c, 6) + 0.0 for c in ("bad_rate", "lower_bound")}
    return reputation.judged(table(spark, sf, "pages"), outcomes, rules).withColumns(rounded)


@query
def op9_warc_derivatives(spark: SparkSession, sf: str) -> DataFrame:
    made = warc.derivatives(warc.responses(table(spark, sf, "pages")))
    return made.drop("block", "http_header", "date")


@query
def op11_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op12_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    from public_tokenizers import PATTERN

    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encoded(table(spark, sf, "documents").select("doc_id", "text"), path, PATTERN)
    return bpe.digests(bpe.decoded(coded, path, PATTERN))


@query
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.paths(table(spark, sf, "conversations")))


ORACLES["op1_quality_rules"] = quality.sql()
ORACLES["op11_ranked_search"] = search.SQL
ORACLES["op13_prefix_trie"] = prefix_trie.SQL
ORACLES["op2_chat_format"] = chat.SQL
ORACLES["op5_mixing"] = mixing.sql()
ORACLES["op6_nn_descent"] = neighbours.SQL
ORACLES["op7_url_reputation"] = reputation.SQL.format(rules=", ".join(map(str, URL_RULES)))
ORACLES["op9_warc_derivatives"] = warc.SQL
