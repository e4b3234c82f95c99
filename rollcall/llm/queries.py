"""The numbered queries: each applies its operator, with the parameters of production, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import bpe, classifier, decontaminate, html_text, jaccard, merkle, pii, prefix_trie, rules, secret_scan, sql, superminhash, token_store, warc
from rollcall.llm.shared import scratch, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), TOKENIZER)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(table(spark, folder, "documents"))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(table(spark, folder, "documents"))


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.texts(table(spark, folder, "pages"))


def op6_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.verdicts(table(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The table has no capture times; pages count as fetched one second after another, in the order of their ids."""
    fetched = F.timestamp_seconds(F.lit(1_577_836_800) + F.col("page_id"))
    found = warc.history(table(spark, folder, "pages").withColumn("time", fetched))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "range", "row")


def op8_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.checks(table(spark, folder, "documents"), scratch(spark, "token-store"), TOKENIZER, end=2)


def op9_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.predictions(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


def op12_superminhash(spark: SparkSession, folder: str) -> DataFrame:
    return superminhash.components(table(spark, folder, "documents"))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audited(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_jaccard": op4_jaccard,
    "op5_html_text": op5_html_text,
    "op6_rules": op6_rules,
    "op7_warc": op7_warc,
    "op8_token_store": op8_token_store,
    "op9_classifier": op9_classifier,
    "op10_pii": op10_pii,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_superminhash": op12_superminhash,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {
    "op3_decontaminate": decontaminate.ORACLE,
    "op4_jaccard": sql.groups(jaccard.SIZE, jaccard.PERCENT),
    "op6_rules": rules.ORACLE,
    "op11_prefix_trie": sql.TRIE,
    "op12_superminhash": sql.groups(superminhash.SIZE, superminhash.PERCENT, ", doc_id = least_id as kept"),
    "op13_merkle": sql.MERKLE,
}
