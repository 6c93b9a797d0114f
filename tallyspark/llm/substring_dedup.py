"""Substring deduplication: Rabin-Karp hashes of every window of words, counted in Spark."""

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.arrow import utf8_of

BLANK_BYTES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
CHAR_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
MASK = (1 << 64) - 1
PART = 1 << 21

HASHES = "bucket int, block int, n int, width int, first long, steps binary"
REPLIES = "block int, bucket int, n int, repeated binary"
RESULT = ("doc_id long, n_words long, n_removed long, "
          "removed array<struct<first:int,last:int>>, kept_text string")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over the whole range (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(8)
def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo 2 ** 64, kept for the usual sizes."""
    size = 1 << max(10, math.ceil(math.log2(max(1, count))))
    if size <= 2 * PART:
        return _powers(base, size)[:count]
    return _powers.__wrapped__(base, size)[:count]


def forget_powers() -> None:
    """Frees the kept powers: a Python worker may go on with another operator's tasks."""
    _powers.cache_clear()


def polynomial(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of many ranges of ``values`` from one running sum.

    The sum of value * base ** place over a range, times base ** -start; base is odd and thus
    has an inverse modulo 2 ** 64, so the hash depends on the values alone.
    """
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(pow(base, -1, 1 << 64), len(values) + 1)[starts]


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(CHAR_BASE))


def word_hashes(data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of all texts in turn, words before each text)."""
    found, counts = [], [np.zeros(1, np.int64)]
    row = 0
    while row < len(at) - 1:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + PART, "right")) - 1)
        body = np.frombuffer(data[at[row]:at[stop]], np.uint8)
        edges = at[row:stop + 1] - at[row]
        inside = ~BLANK_BYTES[body]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cut = edges[:-1][edges[:-1] < len(body)]
        first[cut] = inside[cut]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = edges[1:][edges[1:] > 0] - 1
        last[cut] = inside[cut]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        found.append(mixed(polynomial(_byte_values()[body], CHAR_BASE, starts, ends)
                           + (ends - starts).astype(np.uint64)))
        counts.append(np.diff(np.searchsorted(starts, edges)))
        row = stop
    words = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return words, np.cumsum(np.concatenate(counts))


def window_hashes(words: np.ndarray, before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every window of ``length`` words within one text, in text order."""
    per_text = np.maximum(np.diff(before) - length + 1, 0)
    shift = np.repeat(before[:-1] - (np.cumsum(per_text) - per_text), per_text)
    starts = shift + np.arange(len(shift))
    return mixed(polynomial(words, WORD_BASE, starts, starts + length)), starts


def _ordered(table: pa.Table) -> tuple[pa.Array, bytes, np.ndarray]:
    """The block's documents by id, then text: (ids, text bytes, offsets)."""
    table = table.select(["doc_id", "text"]).sort_by([("doc_id", "ascending"), ("text", "ascending")])
    if table.column("doc_id").null_count:  # pyarrow sorts NULL last; here it comes first
        ids = table.column("doc_id")
        table = pa.concat_tables([table.filter(ids.is_null()), table.filter(ids.is_valid())])
    return table.column("doc_id").combine_chunks(), *utf8_of(table.column("text"))


def _bucket_edges(hashes: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.array([0, len(hashes)])
    heads = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return np.searchsorted(heads, np.arange((1 << bits) + 1))


def _hash_block(length: int, bits: int):
    """Different window hashes of a block, by bucket, as first value and steps."""

    def work(table):
        block = table.column("block")[0].as_py()
        _, data, at = _ordered(table)
        hashes, _ = window_hashes(*word_hashes(data, at), length)
        hashes = np.unique(hashes)
        edges = _bucket_edges(hashes, bits)
        rows = []
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            own = hashes[edges[bucket]:edges[bucket + 1]]
            steps = np.diff(own)
            width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
            packed = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
            rows.append((bucket, block, len(own), width, int(own[:1].view(np.int64)[0]), packed))
        return _table(rows, HASHES)

    return work


def _table(rows, schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _count_bucket(table: pa.Table) -> pa.Table:
    """For every block of a bucket, which of its hashes an earlier block has, too."""
    table = table.sort_by("block")
    parts = []
    for n, width, first, steps in zip(*(table.column(c).to_pylist() for c in ("n", "width", "first", "steps"))):
        own = np.zeros((n, 8), np.uint8)
        own[1:, :width] = np.frombuffer(steps, np.uint8).reshape(-1, width)
        own = own.view("<u8").ravel()
        own[0] = np.int64(first).astype(np.uint64)
        parts.append(np.cumsum(own, dtype=np.uint64))
    hashes = np.concatenate(parts)
    order = np.argsort(hashes, kind="stable")
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[order[1:]] == hashes[order[:-1]]
    repeated = np.zeros(len(hashes), bool)
    repeated[order] = same
    ends = np.cumsum([len(p) for p in parts])
    return _table([(block, bucket, len(p), np.packbits(repeated[e - len(p):e]).tobytes()) for block, bucket, p, e in zip(
        table.column("block").to_pylist(), table.column("bucket").to_pylist(), parts, ends.tolist())], REPLIES)


def _remove(length: int):
    """Applies the replies to a block: windows seen earlier, merged to maximal intervals."""

    def work(docs, replies):
        ids, data, at = _ordered(docs)
        words, before = word_hashes(data, at)
        hashes, starts = window_hashes(words, before, length)
        known, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        earlier = np.zeros(0, bool)
        if replies.num_rows:
            replies = replies.sort_by("bucket")
            earlier = np.concatenate([np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
                                      for n, bits in zip(replies.column("n").to_pylist(),
                                                         replies.column("repeated").to_pylist())])
        repeated = np.ones(len(hashes), bool)
        repeated[first] = earlier
        repeated |= earlier[place] if len(place) else False
        change = np.zeros(len(words) + 1, np.int32)
        np.add.at(change, starts[repeated], 1)
        np.add.at(change, starts[repeated] + length, -1)
        gone = np.cumsum(change[:-1]) > 0
        lost = np.concatenate([[0], np.cumsum(gone)])
        rows = []
        for row, doc_id in enumerate(ids.to_pylist()):
            own = data[at[row]:at[row + 1]].split()
            a, b = int(before[row]), int(before[row + 1])
            spans = []
            if lost[b] > lost[a]:
                mark = gone[a:b]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.view(np.int8), [0]])))
                spans = [{"first": int(s), "last": int(e) - 1} for s, e in zip(edge[::2], edge[1::2])]
                own = [w for w, m in zip(own, mark.tolist()) if not m]
            rows.append((doc_id, b - a, int(lost[b] - lost[a]), spans, b" ".join(own).decode()))
        kinds = [pa.int64(), pa.int64(), pa.int64(),
                 pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])), pa.string()]
        columns = zip(*rows) if rows else [[] for _ in kinds]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                        ["doc_id", "n_words", "n_removed", "removed", "kept_text"])

    return work


def _range_block(docs: DataFrame, key: str, count: int) -> Column:
    """The block of a row: ``count`` ranges of the key with about equally many rows.

    The ranges' lower bounds are gathered (one number per block, as range partitioning itself
    does) and found again by a binary search in plain expressions.
    """
    ids = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))
    if count == 1:
        return F.lit(0)
    ranges = docs.select(ids.alias("id")).repartitionByRange(count, "id").groupBy(F.spark_partition_id()) \
        .agg(F.min("id").alias("least")).select("least").collect()
    bounds = sorted(r["least"] for r in ranges)[1:]
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    table = F.lit(bounds)
    return F.aggregate(F.lit(steps), F.lit(0), lambda below, step: F.when(
        F.get(table, below + step - 1) <= ids, below + step).otherwise(below))


def repeated_windows_removed(docs: DataFrame, length: int = 20, key: str = "doc_id", text: str = "text",
                             block_bytes: int = 12 << 20, bucket_windows: int = 1 << 20) -> DataFrame:
    """Removes every word covered by a window of ``length`` words that also starts earlier.

    Earlier is a smaller id, or the same document and an earlier start; windows are judged on
    the input.  Documents are gathered into blocks of neighbouring ids (about ``block_bytes``
    of text).  A block sends the hashes of all its windows, each different one once, to the
    buckets of the hash range; a bucket counts and answers, per block and hash, whether an
    earlier block has it, with one bit; the block then settles the rest by itself.  So a
    window that a third of all documents hold costs one hash per block.  Hashes have 64 bits:
    the chance that a window is taken for another is 2 ** -64 per pair.

    Returns doc_id, n_words, n_removed, ``removed`` (maximal intervals of word numbers) and
    ``kept_text`` (words joined by one space).  Defined results: NULL and empty texts have no
    words; a NULL id comes before all others; rows with equal ids are ordered by their texts,
    and of repeated rows all but one count as later; an empty table gives an empty result;
    extra columns are ignored.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    bits = max(0, math.ceil(math.log2(max(1, size / 6 / bucket_windows))))
    placed = rows.withColumn("block", _range_block(rows, "doc_id", blocks).cast("int")) \
        .select("block", "doc_id", "text")
    hashes = placed.groupBy("block").applyInArrow(_hash_block(length, bits), HASHES)
    replies = hashes.groupBy("bucket").applyInArrow(_count_bucket, REPLIES)
    return placed.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_remove(length), RESULT)
