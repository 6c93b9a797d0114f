"""The corpus pipeline: documents through language ID, deduplication, mixing and encoding."""

import public_tokenizers

from tallyspark.llm.bpe import round_trip
from tallyspark.llm.exact_dedup import exact_unique
from tallyspark.llm.language_id import accepted_languages, frozen_statistics
from tallyspark.llm.mixing import apply_mixture, mixture_plan
from tallyspark.llm.near_dedup import near_unique
from tallyspark.llm.queries import MIXTURE
from tallyspark.llm.shared import materialise, read_table


def language(spark, docs, sf_dir):
    """Documents in a language that the byte trees know; trained on the labels of ``docs``."""
    return accepted_languages(docs, frozen_statistics(docs))


def exact(spark, docs, sf_dir):
    """One document of each group of equal texts."""
    return exact_unique(docs)


def near(spark, docs, sf_dir):
    """One document of each class of near-duplicates."""
    return near_unique(docs)


def mix(spark, docs, sf_dir):
    """Nine tenths of the tokens, by the weights of domains, languages and sources, no document
    twice: after deduplication no source is repeated."""
    return apply_mixture(docs, mixture_plan(docs, MIXTURE, share=0.9, max_epochs=1), marks=False)


def encode(spark, docs, sf_dir):
    """Token ids of every document, with digests of the ids and of what they decode to."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near),
          ("mixing", mix), ("bpe", encode)]

# Byte context trees, alignments and merges cannot be written in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
