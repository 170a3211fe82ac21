"""The corpus operators as queries over whole tables, and their SQL twins."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (
    bpe,
    chat,
    exact_dedup,
    fingerprints,
    near_dedup,
    packing,
    periodic,
    quality,
    shards,
    substrings,
    tokens,
    toxicity,
    whitening,
)
from tillstream.llm.common import read, stored
from tillstream.llm.oracles import oracle_sql

__all__ = ["oracle_sql", "queries"]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
# <|endoftext|> of the word vocabulary.
END_OF_DOCUMENT = 49407
SHARDS = 16


def op1_longest_first_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.place(read(spark, sf_dir, "documents"), SHARDS).withColumns({
        "law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op2_separator_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as flat token files; the scan finds them again and counts their tokens."""
    files = stored(tokens.write_blocks(read(spark, sf_dir, "documents"), WORD_BPE,
                                       END_OF_DOCUMENT), "token-files")
    found = stored(tokens.search(files, END_OF_DOCUMENT), "separators")
    named = files.select("file", "block", F.posexplode("doc_ids").alias("place", "doc_id"))
    return (tokens.count_tokens(found).join(named, ["file", "block", "place"], "left")
            .select("doc_id", "file", "ordinal", "start", "n_tokens", "ended"))


def op3_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the number of other fingerprints that the block tables find within the radius."""
    compared = fingerprints.compare_with_edits(read(spark, sf_dir, "documents"))
    found = fingerprints.count_within_radius(compared.select("fingerprint"))
    return compared.join(found, "fingerprint", "left").withColumn(
        "n_within_radius", F.coalesce("n_within_radius", F.lit(0)))


def op4_super_kmer_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_pack_binary_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read(spark, sf_dir, "documents"), WORD_BPE, with_ids=False)
    return packed.drop("ids")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(read(spark, sf_dir, "documents")).drop("text_key")


def op7_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = quality.fit(documents, read(spark, sf_dir, "labels"))
    return quality.score(documents, model)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"))
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = chat.format_conversations(turns.unionByName(extra))
    back, spans = chat.read_turns(F.col("formatted")), chat.loss_spans(F.col("formatted"))
    out = out.select("conv_id", "formatted", back.alias("turns"),
                     chat.loss_text(F.col("formatted"), spans).alias("loss"))
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said_all, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


def op9_golomb_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(read(spark, sf_dir, "documents")).drop("text_key")


def op10_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(read(spark, sf_dir, "documents"), BYTE_BPE)
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond a long is null."""
    return whitening.whiten(read(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.expr("try_cast(deviation as bigint)"))


def repeated_end(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, for one document in ten with its end repeating a stretch of it."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    unit = words[start:start + period]
    return words[:start] + (unit * (-(-(n - start) // period)))[:n - start]


def op13_grammar_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(read(spark, sf_dir, "documents"), repeated_end)
    return found.withColumns({
        "runs_sha256": F.sha2("runs", 256), "collapsed_sha256": F.sha2("collapsed", 256),
    }).drop("runs", "collapsed")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_longest_first_shards, op2_separator_token_counts, op3_simhash_fingerprints,
        op4_super_kmer_substrings, op5_pack_binary_lengths, op6_simhash_near_dedup,
        op7_pairwise_quality, op8_chat_formatting, op9_golomb_exact_dedup, op10_trie_bpe,
        op11_kneser_ney_toxicity, op12_bit_sliced_whitening, op13_grammar_runs)}
