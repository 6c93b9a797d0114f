"""Ranked lexical search: short lists term at a time, long lists document at a time."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.arrow import slices_of, utf8_of
from tallyspark.llm.shared import materialise, running_before
from tallyspark.sources.writers import shared_folder

SEGMENT_BYTES = 8 << 20
SEGMENT_DOCS = 1 << 16
WINDOW = 64
SHORT_SHARE = 8
BLOCK_ITEMS = 1000
BROADCAST_ROWS, BROADCAST_ITEMS = 100_000, 1_000_000

INDEX = ("segment long, term string, df int, total long, docs binary, tfs binary, lengths binary, "
         "ids array<long>")
FOUND = "item long, doc_id long, score long"

# The bytes of a term are digits, letters and all bytes above 127.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(32 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms_of(data: bytes) -> list[bytes]:
    """Maximal runs of term characters in UTF-8 text, A-Z lower-cased."""
    return data.translate(_TABLE).split()


def _small(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the largest needs."""
    top = int(values.max(initial=0))
    return values.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def _numbers(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // count}").astype(np.int64) if count else np.zeros(0, np.int64)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of ``values`` (ending at ``ends``) as binary cells."""
    places = np.concatenate([[0], ends]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(values)])


def _segment(part: pa.RecordBatch, segment: int):
    """Record batches of one segment: a row of documents, then a row per term."""
    data, at = utf8_of(part.column("text"))
    vocabulary: dict = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    codes, lengths = [], []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        words = terms_of(data[a:b])
        codes.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
        lengths.append(len(words))
    lengths = np.array(lengths, np.int64)
    rows = len(lengths)
    head = {"segment": [segment], "term": [None], "df": [int((lengths > 0).sum())], "total": [int(lengths.sum())],
            "docs": [None], "tfs": [None], "lengths": [_small(lengths)], "ids": [part.column("doc_id").to_pylist()]}
    schema = pa.schema([("segment", pa.int64()), ("term", pa.string()), ("df", pa.int32()), ("total", pa.int64()),
                        ("docs", pa.large_binary()), ("tfs", pa.large_binary()), ("lengths", pa.binary()),
                        ("ids", pa.list_(pa.int64()))])
    yield pa.RecordBatch.from_pydict(head, schema=schema)
    if not vocabulary:
        return
    keys, tfs = np.unique(np.concatenate(codes) * rows + np.repeat(np.arange(rows), lengths), return_counts=True)
    term, doc = keys // rows, keys % rows
    ends = np.flatnonzero(np.append(term[1:] != term[:-1], True)) + 1
    # Frequencies of one byte are the rule; a segment with a higher one takes wider cells.
    width = "<u1" if tfs.max() < 1 << 8 else "<u4"
    names = pa.array([w.decode() for w in vocabulary], pa.string())
    count = len(ends)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(count, segment)), names, pa.array(np.diff(ends, prepend=0).astype(np.int32)),
         pa.nulls(count, pa.int64()), _binary(doc.astype("<u2"), ends), _binary(tfs.astype(width), ends),
         pa.nulls(count, pa.binary()), pa.nulls(count, pa.list_(pa.int64()))], schema=schema)


def build_index(docs: DataFrame, folder: str | None = None, key: str = "doc_id", text: str = "text") -> str:
    """Writes an inverted index of all documents and returns its folder.

    A segment is about 8 MB of text (or one longer text) of at most 65,536 documents.  It has
    one row with the documents' ids and lengths, and one row per term with the documents that
    hold it, by their number in the segment, and how often.  Nothing is shuffled.

    Defined results: NULL and texts without a term are documents of length 0; every row is a
    document, whatever its id; extra columns are ignored; an empty table gives an empty index.
    """
    folder = folder or shared_folder(docs.sparkSession, "index")

    def work(batches):
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices_of(batch, "text", SEGMENT_BYTES):
                for start in range(0, part.num_rows, SEGMENT_DOCS):
                    yield from _segment(part.slice(start, SEGMENT_DOCS), segment)
                    segment += 1

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows.mapInArrow(work, INDEX).write.option("compression", "zstd").parquet(folder)
    return folder


def _window_tops(docs: np.ndarray, values: np.ndarray, windows: int) -> np.ndarray:
    tops = np.zeros(windows, np.int64)
    if len(docs):
        place = docs // WINDOW
        firsts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        tops[place[firsts]] = np.maximum.reduceat(values, firsts)
    return tops


class PostingList:
    """Documents of a term with what each adds to a score, and the largest addition of every
    window of 64 documents."""

    def __init__(self, docs: np.ndarray, values: np.ndarray, windows: int):
        self.docs, self.values = docs, values
        self.tops = _window_tops(docs, values, windows)
        self.places = np.searchsorted(docs, np.arange(windows + 1) * WINDOW)


def best_of_segment(lists: list[PostingList], size: int, order: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(document number, score) of the k best documents; ``order`` ranks equal scores.

    Term at a time: short lists are summed into accumulators.  These become one more iterator,
    bounded window by window like a list; their k-th sum, or the k-th best window of any list, is
    where the threshold starts.  Document at a time: windows whose bounds add up to less than the threshold are skipped, in the lists
    and in the accumulators alike; the documents of the others are scored whole.
    """
    windows = -(-size // WINDOW)
    short = [x for x in lists if len(x.docs) * SHORT_SHARE <= size]
    long = [x for x in lists if len(x.docs) * SHORT_SHARE > size]
    if short:
        # Sums stay far below 2 ** 53, where doubles are exact.
        sums = np.bincount(np.concatenate([x.docs for x in short]),
                           np.concatenate([x.values for x in short]).astype(np.float64), size)
        docs = np.flatnonzero(sums)
        long.append(PostingList(docs, sums[docs].astype(np.int64), windows))
    if not long:
        return []
    tops = np.array([x.tops for x in long])
    bounds = tops.sum(axis=0)
    # k documents reach the k-th sum; in k windows a document reaches the k-th best top.
    sure = [values for values in (long[-1].values, tops.max(axis=0)) if len(values) >= k]
    threshold = max([1, *(int(np.partition(values, -k)[-k]) for values in sure)])
    best_docs, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for window in np.flatnonzero(bounds >= threshold).tolist():
        if bounds[window] < threshold:
            continue
        scores = np.zeros(WINDOW, np.int64)
        for x in long:
            a, b = x.places[window], x.places[window + 1]
            scores[x.docs[a:b] - window * WINDOW] += x.values[a:b]
        hit = np.flatnonzero(scores >= threshold)
        if len(hit):
            best_docs = np.concatenate([best_docs, hit + window * WINDOW])
            best_scores = np.concatenate([best_scores, scores[hit]])
            if len(best_docs) >= k:
                keep = np.lexsort((order[best_docs], -best_scores))[:k]
                best_docs, best_scores = best_docs[keep], best_scores[keep]
                threshold = max(threshold, int(best_scores[-1]))
    keep = np.lexsort((order[best_docs], -best_scores))[:k] if len(best_docs) else []
    return list(zip(best_docs[keep].tolist(), best_scores[keep].tolist()))


def _search(n_docs: int, n_terms: int, k: int):
    def work(table):
        rows = table.combine_chunks().to_pylist()
        head = next(r for r in rows if r["term"] is None)
        ids = head["ids"]
        size = len(ids)
        windows = -(-size // WINDOW)
        lengths = _numbers(head["tfs"], size)
        if 90 * int(lengths.max(initial=0)) * n_docs < 1 << 63:
            scaled = 90 * lengths * n_docs // max(1, n_terms)
        else:
            scaled = np.array([90 * int(n) * n_docs // n_terms for n in lengths], np.int64)
        spread = 8 * (100 - 90 + scaled)
        # Equal scores rank by id, rows without an id last.
        order = np.empty(size, np.int64)
        order[sorted(range(size), key=lambda i: (ids[i] is None, ids[i] or 0))] = np.arange(size)
        asked = defaultdict(list)
        for r in rows:
            if r["term"] is not None:
                docs = np.frombuffer(r["docs"], "<u2").astype(np.int64)
                tfs = _numbers(r["tfs"], len(docs))
                values = r["weight"] * (1_000_000_000 * tfs // (1000 * tfs + spread[docs]))
                own = PostingList(docs, values, windows)
                for item in r["items"]:
                    asked[item].append(own)
        found = [(item, ids[doc], score) for item, lists in asked.items()
                 for doc, score in best_of_segment(lists, size, order, k)]
        columns = zip(*found) if found else ([], [], [])
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return work


def _item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, item_id, terms) stored: items numbered in blocks of 1,000, with their distinct terms."""

    def work(batches):
        for batch in batches:
            found = [sorted({w.decode() for w in terms_of((t or "").encode())}) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.string()))],
                                             names=["item_id", "terms"])

    rows = items.select(F.col(key).cast("bigint").alias("item_id"), F.col(text).alias("text"))
    rows = rows.mapInArrow(work, "item_id long, terms array<string>")
    numbered = materialise(rows.withColumn("number", F.monotonically_increasing_id()), "items")
    # Numbers without gaps: rows of a stored table counted partition by partition.
    numbered = numbered.withColumn("part", F.shiftright("number", 33))
    return materialise(running_before(numbered, [], "part", ["number"], "item").select("item", "item_id", "terms"), "items")


def search(spark: SparkSession, index: str, items: DataFrame, k: int = 10, key: str = "item_id",
           text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the index that score best for each item.

    Items are asked in blocks of 1,000.  The postings of asked terms meet their weights and the
    items that ask for them, and come together by segment and block: a group holds the postings
    of 8 MB of text at most (or of one longer text).  Each group gives at most k documents an
    item; these are ranked over all segments.  The table of asked terms is broadcast only if it
    was counted to be small.

    Defined results: an item without a term (NULL text too) has no rows; each row of ``items``
    is an item of its own, also with an id twice; documents score once for each row they have;
    equal scores rank by ascending doc_id, NULL last; an empty table or index gives no rows;
    extra columns are ignored.
    """
    postings = spark.read.schema(INDEX).parquet(index)
    heads = postings.filter("term IS NULL")
    total = heads.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n"),
                      F.coalesce(F.sum("total"), F.lit(0)).alias("l")).first()
    asked = _item_terms(items, key, text)
    block = (F.col("item") / BLOCK_ITEMS).cast("bigint")
    asks = materialise(asked.select(block.alias("block"), "item", F.explode("terms").alias("term"))
                       .groupBy("block", "term").agg(F.collect_list("item").alias("items")), "asks")
    size = asks.agg(F.count("*").alias("n"), F.sum(F.size("items")).alias("items")).first()
    small = size["n"] <= BROADCAST_ROWS and (size["items"] or 0) <= BROADCAST_ITEMS

    def near(table):
        return F.broadcast(table) if small else table

    terms = asks.select("term").distinct()
    df = postings.select("term", "df").join(near(terms), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(total["n"]) + 2) / (2 * F.col("df") + 1)))
    weighted = materialise(asks.join(near(df), "term").select("block", "term", "items", weight.alias("weight")), "weights")
    hits = postings.select("segment", "term", "docs", "tfs").join(near(weighted), "term").select(
        "segment", "block", "term", "weight", "docs", "tfs", "items", F.lit(None).cast("array<long>").alias("ids"))
    last = asks.agg(F.max("block")).first()[0] or 0
    documents = heads.select(
        "segment", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last))).alias("block"), F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("weight"),
        F.lit(None).cast("binary").alias("docs"), F.col("lengths").alias("tfs"),
        F.lit(None).cast("array<long>").alias("items"), "ids")
    found = hits.unionByName(documents).groupBy("segment", "block") \
        .applyInArrow(_search(total["n"], total["l"], k), FOUND)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    names = asked.select(F.col("item").alias("_item"), "item_id")
    return ranked.join(names, F.col("item") == F.col("_item")).select("item_id", "rank", "doc_id", "score")
