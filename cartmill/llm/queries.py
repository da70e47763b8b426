"""One named query for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.llm import (
    alignment, ann, chat, decontaminate, jaccard, langid, line_dedup, merkle, packing, piece_codec, secrets, sharding, urls,
)
from cartmill.llm.oracle import SHARDS
from cartmill.llm.store import keep


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.place(_table(spark, folder, "documents").select("doc_id"), "doc_id", SHARDS)
    return placed.select("doc_id", "slot", "shard")


#: The rules of the contract.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    judged = urls.judge(_table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.overlaps(docs, _table(spark, folder, "benchmark")).drop("text")


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(_table(spark, folder, "documents").select("doc_id", "text"))


def op5_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    out = chat.format_conversations(turns.unionByName(extra))
    read = out.select(
        "conv_id",
        chat.read_back(F.col("formatted")).alias("turns"),
        F.array_join(
            F.transform(
                "loss_spans",
                lambda s: chat.unescape(
                    F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
                ),
            ),
            "",
        ).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, with_ids=False))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(_table(spark, folder, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in ("assign", "access", "hex")],
        F.sha2(secrets.listing(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.listing(F.col("spans")).alias("spans"),
    )


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    # Half of the documents come back without their line feeds.
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    later = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.prove(docs, presented={"text": later}).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    both = piece_codec.decode(piece_codec.encode(docs))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(piece_codec.joined_ids().cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    spelt = F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    aligned = alignment.align(docs).withColumn("groups_sha256", spelt).drop("groups")
    return alignment.score(keep(aligned, "aligned")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_url_filters, op3_decontamination, op4_jaccard_join, op5_multi_index, op6_line_dedup,
        op7_chat_formatting, op8_packing, op9_secret_scan, op10_language_id, op11_merkle_manifest, op12_sentencepiece,
        op13_token_alignment,
    )
}
