"""The registered queries of the subpackage, with SQL where SQL can express them.

Each applies one operator with its production parameters to its whole table and returns a row per
document, page, vector, piece or call; long outputs are returned as digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import sql
from .bpe import decode_documents, encode_documents
from .centroids import cluster_vectors
from .classifier import quality_scores
from .lm import automaton_scores
from .minhash import near_duplicates
from .packing import pack_documents
from .quality import quality_rules
from .registry import ORACLES, QUERIES, query, table
from .substring import repeated_passages
from .toolcalls import link_tool_calls
from .url_labels import labelled_urls
from .urls import judge_urls
from .urls import train as train_urls
from .vectors import near_vectors
from .warc import read_archives, write_archives
from .whitening import whiten

__all__ = ["ORACLES", "QUERIES"]


@query("op1_warc_chunks", sql.WARC)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)


@query("op2_subword_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_bin_slack_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          added_tokens=True)


#: The tools that turns are read as calls of, and what their arguments must be.
TOOLS = {
    "search": {"type": "object", "additionalProperties": False, "required": ["query", "turn"], "properties": {
        "query": {"type": "string", "minLength": 40}, "turn": {"type": "integer", "minimum": 0}}},
    "answer": {"type": "object", "required": ["query", "turn"], "properties": {
        "query": {"type": "string"}, "turn": {"type": "integer", "maximum": 1000}}},
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Turns as tool messages: the table holds no calls of its own, so each user turn is read as a
    call whose arguments hold its text, and the assistant's or a tool's turn after it as the result. Turns of
    other roles, or of none, are messages. A conversation's first question is a search. In conversations of
    odd number each question builds on the one before, in the others the j-th on question (j - 1) / 2."""
    turn, half = F.col("turn"), F.floor(F.col("turn") / 2)
    name = lambda t: F.concat(F.lit("call-"), t.cast("string"))
    asks, answers = (F.coalesce(F.col("role").isin(*r), F.lit(False)) for r in (["user"], ["assistant", "tool"]))
    tree = 2 * F.floor((half - 1) / 2) + F.pmod(turn, F.lit(2))
    parent = F.when(F.col("conv_id") % 2 == 0, tree).otherwise(turn - 2)
    return conversations.select(
        "conv_id", "turn", F.when(asks, "call").when(answers, "result").otherwise("message").alias("kind"),
        name(F.when(asks, turn).when(answers, turn - 1)).alias("call_id"),
        F.when(asks, F.when(half == 0, "search").otherwise("answer")).alias("name"),
        F.when(asks, F.to_json(F.struct(F.col("text").alias("query"), "turn"))).alias("arguments"),
        F.when(asks & (half > 0), F.array(name(parent))).alias("depends_on"),
        F.when(~asks, F.col("text")).alias("content"))


@query("op4_tool_call_linking")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_tool_calls(tool_messages(table(spark, sf_dir, "conversations")), TOOLS)


@query("op5_backoff_automaton")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton_scores(table(spark, sf_dir, "documents"))


@query("op6_grid_order_join", sql.NEAR_VECTORS)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_divergence_rules", sql.RULES)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


@query("op8_longest_match_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    files = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode_documents(table(spark, sf_dir, "documents"), *files)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode_documents(encoded, *files).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_seed_and_extend", sql.PASSAGES)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op10_minhash_near_dedup", sql.NEAR_DUPLICATES)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query("op11_sharded_lloyd", sql.CENTROIDS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


#: Rules (host and path) that go before the model; fixed by the query's contract.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]


@query("op12_url_filter")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES, train_urls(labelled_urls(spark)))


@query("op13_sturm_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
