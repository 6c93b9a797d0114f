"""Registered queries of the training-data operators."""

import public_tokenizers
from pyspark.sql import functions as F

from tallyspark.llm.bpe import round_trip
from tallyspark.llm.exact_dedup import exact_duplicates
from tallyspark.llm.language_id import frozen_statistics, identify_languages
from tallyspark.llm.lexical import build_index, search
from tallyspark.llm.mixing import mix_to_weights
from tallyspark.llm.near_dedup import near_duplicates
from tallyspark.llm.pieces import round_trip as piece_round_trip
from tallyspark.llm.quality import quality_verdicts
from tallyspark.llm.quotations import reply_ordered
from tallyspark.llm.shared import read_table
from tallyspark.llm.sharding import interleaved_shards
from tallyspark.llm.substring_dedup import repeated_windows_removed
from tallyspark.llm.token_files import read_token_files, write_token_files
from tallyspark.llm.whitening import whitened_embeddings


# Target weights of the mixture; labels that are not named weigh 1.
MIXTURE = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 3, "fr": 3, "es": 2},
    "source": {"src0": 3, "src1": 2},
}


def op1_hierarchical_mixture(spark, folder):
    mixed = mix_to_weights(read_table(spark, folder, "documents"), MIXTURE, share=0.6, max_epochs=2)
    return mixed.select("doc_id", "mix_domain", "lang", "source", "mix_epoch")


def op2_quotation_linking(spark, folder):
    return reply_ordered(read_table(spark, folder, "conversations"))


def op3_interleaved_shards(spark, folder):
    return interleaved_shards(read_table(spark, folder, "documents")).drop("source", "fraction")


def op4_ppm_language_id(spark, folder):
    docs = read_table(spark, folder, "documents")
    return identify_languages(docs, frozen_statistics(docs)).drop("bits_per_byte")


def op5_extendible_hash_dedup(spark, folder):
    return exact_duplicates(read_table(spark, folder, "documents")).drop("row_hash")


def op6_order_min_hash(spark, folder):
    return near_duplicates(read_table(spark, folder, "documents")).drop("row_hash")


def op7_byte_level_bpe(spark, folder):
    rank_file = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(read_table(spark, folder, "documents"), rank_file).drop("ids")


def op8_huffman_token_files(spark, folder):
    files = write_token_files(read_table(spark, folder, "documents"),
                              public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_repeated_windows(spark, folder):
    done = repeated_windows_removed(read_table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_line_frequency_rules(spark, folder):
    return quality_verdicts(read_table(spark, folder, "documents")).drop("n_removed_words", "host")


def op11_distinct_chunk_pieces(spark, folder):
    return piece_round_trip(read_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_hybrid_ranked_search(spark, folder):
    index = build_index(read_table(spark, folder, "documents"))
    return search(spark, index, read_table(spark, folder, "benchmark"), k=10)


def op13_shifted_cholesky_whitening(spark, folder):
    whitened, fitted = whitened_embeddings(read_table(spark, folder, "embeddings"), components=32)
    explained = F.array(*[F.lit(float(e)) for e in (fitted.explained if fitted else [])]).cast("array<double>")
    rows = whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select("vec_id", (F.col("place") + 1).alias("component"),
                       F.lit(fitted.centre.n if fitted else 0).cast("bigint").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("place")).alias("explained"),
                       F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"))


QUERIES = {f.__name__: f for f in (
    op1_hierarchical_mixture, op2_quotation_linking, op3_interleaved_shards, op5_extendible_hash_dedup,
    op4_ppm_language_id, op6_order_min_hash, op7_byte_level_bpe, op8_huffman_token_files,
    op9_repeated_windows, op10_line_frequency_rules, op11_distinct_chunk_pieces, op12_hybrid_ranked_search,
    op13_shifted_cholesky_whitening,
)}
