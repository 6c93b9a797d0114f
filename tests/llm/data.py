"""Documents with every awkward case, and plain versions of what operators compute."""

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that an operator might use itself.
CLASHES = ["shard", "slot", "kept", "node", "bucket", "content", "_row", "_id", "_0", "block", "ref", "hash",
           "lang_pred", "_score", "mix_domain", "_on_source", "tokens", "row_hash", "_text"]

SENTENCE = "The quick brown fox jumps over the lazy dog while nine old owls watch from a tall dark tree"
LONG = " ".join(f"word{i % 977} item{i}" for i in range(12_000))
ROWS = [
    (1, SENTENCE, "en", "src1", 1), (2, SENTENCE.upper(), "en", "src1", 1), (3, SENTENCE, "en", "src2", 1),
    (4, SENTENCE.replace("lazy", "sleepy"), "en", None, 1), (5, None, "en", "src1", None), (6, "", None, "src1", 0),
    (7, " \t\n ", "de", "src0", 4), (8, "12 34 ... !!", "fr", "src0", 1), (9, "naïve café — œuvre 😀 中文", "fr", "src3", 1),
    (None, "a row without an id", "en", "src1", 1), (None, SENTENCE, "en", "src1", 1), (10, LONG, "en", "src0", 1),
    (11, LONG + " tail", "en", "src0", 1), (12, "one", "en", "src9", 1), (12, "one", "en", "src9", 1),
    (13, "a a a a a a a a a a a a", "en", "src2", 1), (14, "x" * 3000, "es", "other", 1),
    (15, "don't 'll it's 'tis we've!\r\n\r\n  end  ", "en", "src1", 1), (16, "Ligne une\nLigne une\n\nfin", "fr", "src1", 1),
]


def awkward(spark, rows=ROWS, clashes=True):
    docs = spark.createDataFrame(rows, SCHEMA)
    if clashes:
        docs = docs.withColumns({c: F.lit("theirs") for c in CLASHES})
    return docs


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def read(spark, folder, name="documents"):
    return spark.read.parquet(f"{folder}/{name}.parquet")
