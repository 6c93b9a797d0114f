"""Token ids in Huffman-coded files: canonical length-limited codes, independent blocks."""

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.arrow import slices_of, utf8_of
from tallyspark.llm.shared import broadcast_if_small, materialise
from tallyspark.sources.writers import shared_folder

MAX_BITS = 16
BLOCK_TOKENS = 1 << 16
CHECKPOINT_TOKENS = 256
CACHED_WORDS = 450_000
CACHED_LENGTH = 64

STORED = "shard int, place long, doc_id long, before long, n_tokens int, ids binary"
BLOCKS = ("shard int, place long, before long, tokens long, doc_ids array<long>, lengths array<int>, "
          "checkpoints binary, bits binary")
DECODED = "shard int, doc_id long, before long, n_tokens long, ids binary"
TAIL = re.compile(rb"([a-z])([.,!?;:]+)$")


class WordTokenizer:
    """Ids of texts by the tokenizers library, each different word encoded once.

    The vocabulary drops white space, never joins across it and lower-cases, so a text's ids
    are those of its words (split at ASCII blanks only; the library deals with all other white
    space) after ASCII lower-casing.  Marks that end a word after a letter are a piece of their
    own, so such a word is put together from two known parts.  A text with an added token of
    the tokenizer file in it, in any case, goes through the library as it is: the library looks
    for those before it lower-cases or splits.  Words are cached in two
    generations of bounded size: what the newer one lacks is looked for in the older one.
    """

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content.decode())
        self.added = [t["content"].encode().lower() for t in json.loads(content).get("added_tokens") or []]
        small = self.library.get_vocab_size() <= 1 << 16
        self.kind, self.code = ("<u2", "H") if small else ("<u4", "I")
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _learn(self, missing: set[bytes]) -> None:
        """Puts the ids of new words into the newer generation."""
        known, older = self.words, self.older
        tails, new = {}, []
        again = missing & older.keys()
        known.update((w, older[w]) for w in again)
        for word in missing - again:
            if (match := TAIL.search(word)) is not None:
                tails[word] = word[:match.end(1)], match[2]
            else:
                new.append(word)
        parts = {part for pair in tails.values() for part in pair if part not in known and part not in missing}
        for part in parts:
            if (ids := older.get(part)) is not None:
                known[part] = ids
            else:
                new.append(part)
        found = self.library.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        known.update(zip(new, [array(self.code, e.ids).tobytes() for e in found]))
        for word, (core, tail) in tails.items():
            known[word] = known[core] + known[tail]

    def ids_of(self, texts: list[bytes], end: int) -> list[bytes]:
        """Ids of each text and the end id, as little-endian unsigned integers of ``kind``."""
        split, whole = [], []
        for place, text in enumerate(texts):
            lower = text.lower()
            if any(token in lower for token in self.added):
                whole.append(place)
                split.append([])
            else:
                split.append(lower.split())
        if len(self.words) > CACHED_WORDS:
            self.older = {w: ids for w, ids in self.words.items() if len(w) <= CACHED_LENGTH}
            self.words = {}
        known = self.words
        missing = set().union(*split).difference(known)
        if missing:
            self._learn(missing)
        last = np.array([end], self.kind).tobytes()
        found = [b"".join([*map(known.__getitem__, words), last]) for words in split]
        for place in whole:
            ids = self.library.encode(texts[place].decode(), add_special_tokens=False).ids
            found[place] = array(self.code, ids).tobytes() + last
        return found


_TOKENIZERS: dict = {}


def _tokenizer(content) -> WordTokenizer:
    name = hash(content.value)
    if name not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[name] = WordTokenizer(content.value)
    return _TOKENIZERS[name]


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits of each id (0: unused) of the best prefix code without a code over ``limit`` bits.

    Package-merge: at every level the leaves are merged with pairs of the level before; how
    many leaves lie among the cheapest 2n - 2 entries, level by level, gives the lengths.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        place = np.argsort(merged, kind="stable")
        levels.append(place < len(leaves))
        merged = merged[place]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    take, own = 2 * len(leaves) - 2, np.zeros(len(leaves), np.uint8)
    for is_leaf in reversed(levels):
        count = int(is_leaf[:take].sum())
        own[:count] += 1
        take = 2 * (take - count)
    lengths[order] = own
    return lengths


class Codebook:
    """Canonical codes from code lengths: shorter codes first, then smaller ids."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.bits = int(self.lengths.max(initial=1))
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        span = 1 << (self.bits - self.lengths[order])
        starts = np.cumsum(span) - span
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = starts >> (self.bits - self.lengths[order])
        self.symbol = np.repeat(order, span)
        self.length = np.repeat(self.lengths[order], span)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(bit stream, bit offset of every 256th token)."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        word = starts >> 5
        window = self.codes[ids] << (64 - lengths - (starts & 31)).astype(np.int64)
        window = window.view(np.uint64)
        size = int(ends[-1] >> 5) + 2
        # The bits of one word are disjoint, so sums are unions; below 2 ** 53 doubles are exact.
        words = np.bincount(word, (window >> np.uint64(32)).astype(np.float64), size)
        words += np.bincount(word + 1, (window & np.uint64(0xFFFFFFFF)).astype(np.float64), size)
        stream = words.astype(np.uint32).astype(">u4").tobytes()[:int(ends[-1] + 7) // 8]
        return stream, starts[::CHECKPOINT_TOKENS].astype("<u4").tobytes()

    def decode(self, streams: list[bytes], checkpoints: list[bytes], counts: list[int]) -> list[np.ndarray]:
        """Ids of several blocks at once: every checkpoint of every block is a lane, and each
        step decodes one token per lane by a table look-up of the next bits."""
        tail = b"\0" * (CHECKPOINT_TOKENS * self.bits // 8 + 8)
        data = np.frombuffer(b"".join([*streams, tail]), np.uint8).astype(np.int64)
        window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        sizes = np.array([len(s) for s in streams], np.int64)
        base = (np.cumsum(sizes) - sizes) * 8
        lanes = [np.frombuffer(c, "<u4").astype(np.int64) for c in checkpoints]
        place = np.concatenate([own + b for own, b in zip(lanes, base)])
        out = np.empty((len(place), CHECKPOINT_TOKENS), np.int32)
        drop, mask = 32 - self.bits, (1 << self.bits) - 1
        for step in range(CHECKPOINT_TOKENS):
            peek = (window[place >> 3] >> (drop - (place & 7))) & mask
            out[:, step] = self.symbol[peek]
            place += self.length[peek]
            np.minimum(place, (len(window) - 1) * 8, out=place)
        flat, result, first = out.ravel(), [], 0
        for own, count in zip(lanes, counts):
            result.append(flat[first * CHECKPOINT_TOKENS:first * CHECKPOINT_TOKENS + count])
            first += len(own)
        return result


def _rows(columns, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def _tokenise(content, end: int):
    """Ids of the documents of a shard (a task), with place and tokens before in the shard."""

    def work(batches):
        tokenizer, shard = _tokenizer(content), TaskContext.get().partitionId()
        size, place, before = int(tokenizer.kind[-1]), 0, 0
        for batch in batches:
            for part in slices_of(batch, "text", 4 << 20):
                data, at = utf8_of(part.column("text"))
                texts = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                ids = tokenizer.ids_of(texts, end)
                counts = np.array([len(i) // size for i in ids], np.int64)
                starts = before + np.cumsum(counts) - counts
                yield _rows([[shard] * len(ids), range(place, place + len(ids)), part.column("doc_id"),
                             starts, counts.astype(np.int32), ids], STORED)
                place, before = place + len(ids), before + int(counts.sum())

    return work


def _count_ids(kind: str):
    def work(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices_of(batch, "ids"):
                found = np.bincount(np.frombuffer(utf8_of(part.column("ids"))[0], kind))
                size = max(len(total), len(found))
                total = np.pad(total, (0, size - len(total))) + np.pad(found, (0, size - len(found)))
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    return work


def _encode_blocks(lengths: bytes, kind: str):
    """Blocks of whole documents that follow each other in a shard."""

    def close(run, codebook):
        shard, place, _, before, _, _ = run[0]
        counts = [r[4] for r in run]
        bits, checkpoints = codebook.encode(np.frombuffer(b"".join([r[5] for r in run]), kind))
        return shard, place, before, sum(counts), [r[2] for r in run], counts, checkpoints, bits

    def work(batches):
        codebook = Codebook(np.frombuffer(lengths, np.uint8))
        run, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
                if run and (held + row[4] > BLOCK_TOKENS or row[0] != run[-1][0] or row[1] != run[-1][1] + 1):
                    yield _rows(zip(close(run, codebook)), BLOCKS)
                    run, held = [], 0
                run.append(row)
                held += row[4]
        if run:
            yield _rows(zip(close(run, codebook)), BLOCKS)

    return work


def write_token_files(docs: DataFrame, tokenizer_file: str, folder: str | None = None, end: int = 1,
                      key: str = "doc_id", text: str = "text") -> str:
    """Writes the ids of all documents in ascending id order; returns the folder.

    ``codebook`` holds the code length of every id, from counts over all documents; ``blocks``
    holds the coded ids: blocks of whole documents (about 65,536 tokens, more if one document
    is longer), each with the documents' ids and token counts, its own bit stream, the bit
    offset of every 256th token, and how many tokens of its shard come before it.  Shard and
    place give the order.  ``ids`` holds the plain ids that the counts are taken from and that
    the blocks are made of; it is not needed any more once the blocks are there.

    Texts are shuffled once, into ranges of document ids.  The tables of a vocabulary have a
    fixed size: counts are gathered and code lengths broadcast.  Tasks hold a few MB of text
    and one block.

    Defined results: NULL counts as the empty text, which has the end id alone; NULL ids come
    first; repeated ids are neighbours, in the order of a hash of their texts; an empty table
    gives files without blocks; extra columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    with open(tokenizer_file, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())
    kind = WordTokenizer(content.value).kind
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")) \
        .withColumn("_h", F.xxhash64("text"))
    (rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
     .mapInArrow(_tokenise(content, end), STORED).write.option("compression", "zstd").parquet(f"{folder}/ids"))
    stored = spark.read.schema(STORED).parquet(f"{folder}/ids")
    found = stored.select("ids").mapInArrow(_count_ids(kind), "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in found), default=0) + 1, np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts).tobytes()
    spark.createDataFrame([(bytearray(lengths),)], "lengths binary").write.parquet(f"{folder}/codebook")
    stored.mapInArrow(_encode_blocks(lengths, kind), BLOCKS).write.parquet(f"{folder}/blocks")
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files: ``start`` counts the ids of all documents
    before this one, ``ids`` are little-endian unsigned 32-bit integers.

    Blocks are decoded independently of each other.  A block knows the ids before it in its
    shard; the ids before a shard are summed over the shards (as many as tasks that wrote).
    """
    lengths = bytes(spark.read.parquet(f"{folder}/codebook").first()["lengths"])

    def work(batches):
        codebook = Codebook(np.frombuffer(lengths, np.uint8))
        for batch in batches:
            for part in slices_of(batch, "bits", 1 << 20):
                sizes = part.column("lengths").to_pylist()
                blocks = codebook.decode(part.column("bits").to_pylist(), part.column("checkpoints").to_pylist(),
                                         part.column("tokens").to_pylist())
                rows = []
                for shard, base, docs, own, ids in zip(
                        part.column("shard").to_pylist(), part.column("before").to_pylist(),
                        part.column("doc_ids").to_pylist(), sizes, blocks):
                    flat, before = ids.astype("<u4").tobytes(), 0
                    for doc_id, n in zip(docs, own):
                        rows.append((shard, doc_id, base + before, n, flat[4 * before:4 * (before + n)]))
                        before += n
                yield _rows(zip(*rows), DECODED)

    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    shards = blocks.groupBy(F.col("shard").alias("_shard")).agg(F.sum("tokens").alias("n"))
    earlier = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialise(shards.select("_shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base")), "shards")
    return blocks.drop("place").mapInArrow(work, DECODED).join(
        broadcast_if_small(bases), F.col("shard") == F.col("_shard")).select(
        "doc_id", (F.col("_base") + F.col("before")).alias("start"), "n_tokens", "ids")
