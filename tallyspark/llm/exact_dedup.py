"""Exact deduplication with an extendible-hash index on shared files."""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.arrow import slices_of, utf8_of
from tallyspark.llm.shared import kept_rows, materialise, row_hash

# The letters that the comparison lower-cases.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

ROWS = "doc_id long, row_hash long, ref long, hash long, body binary, sha256 string, top_id long, copies long"
RESOLVED = "ref long, keep_id long, group_size long, text_sha256 string"


def _local_entries(batches):
    """Every row, pointing (``ref``) at one index entry per different text of its part of a
    batch (16 MB of text, or one longer text).

    Rows that found their text in the part carry no body: a text with very many copies is
    stored once per part.  Equality is equality of bytes; the hash only finds candidates.
    """
    counter = TaskContext.get().partitionId() << 40
    for batch in (part for whole in batches for part in slices_of(whole, "text", 16 << 20)):
        data, at = utf8_of(batch.column("text"))
        data = data.translate(LOWER)
        chains, entries, refs = {}, [], []
        for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            body = data[at[row]:at[row + 1]]
            key = xxhash.xxh64_intdigest(body) - (1 << 63)
            chain = chains.setdefault(key, [])
            entry = next((e for e in chain if e["body"] == body), None)
            if entry is None:
                entry = {"ref": counter, "hash": key, "body": body, "top": None, "n": 0, "row": row}
                counter += 1
                chain.append(entry)
                entries.append(entry)
            entry["n"] += 1
            if doc_id is not None and (entry["top"] is None or doc_id > entry["top"]):
                entry["top"] = doc_id
            refs.append(entry["ref"])
        first = {e["row"]: e for e in entries}
        column = [first.get(row) for row in range(len(refs))]

        def of(name, kind):
            return pa.array([e and e[name] for e in column], kind)

        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("row_hash"), pa.array(refs, pa.int64()), of("hash", pa.int64()),
            of("body", pa.binary()),
            pa.array([e and hashlib.sha256(e["body"]).hexdigest() for e in column], pa.string()),
            of("top", pa.int64()), of("n", pa.int64()),
        ], names=[part.split()[0] for part in ROWS.split(", ")])


def directory(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bucket of every slot, from the bytes that fall into each slot at the greatest depth.

    Starts with one bucket.  As long as a bucket holds more than ``capacity`` bytes its half
    slots become buckets of their own, and the directory doubles when it is not deep enough.
    """
    depth = int(np.log2(len(sizes)))
    bucket = np.full(len(sizes), -1, np.int64)
    for local in range(depth + 1):
        width = len(sizes) >> local
        held = sizes.reshape(-1, width).sum(axis=1)
        fits = (held <= capacity) | (local == depth)
        for start in np.flatnonzero(fits) * width:
            if bucket[start] < 0:
                bucket[start:start + width] = start
    return bucket


def _owner(batches):
    """Resolves index entries that come sorted by hash: chains of equal hashes, split by bytes."""
    current, chain, out = None, [], []

    def close():
        for entry in chain:
            out.extend((ref, entry["top"], entry["n"], entry["sha"]) for ref in entry["refs"])
        chain.clear()

    def rows():
        columns = list(zip(*out)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                           names=[part.split()[0] for part in RESOLVED.split(", ")])
        out.clear()
        return batch

    for batch in batches:
        data, at = utf8_of(batch.column("body"))
        columns = [batch.column(c).to_pylist() for c in ("ref", "hash", "sha256", "top_id", "copies")]
        for row, (ref, key, sha, top, n) in enumerate(zip(*columns)):
            if key != current:
                close()
                current = key
            body = data[at[row]:at[row + 1]]
            entry = next((e for e in chain if e["body"] == body), None)
            if entry is None:
                chain.append({"body": body, "sha": sha, "top": top, "n": n, "refs": [ref]})
            else:
                entry["refs"].append(ref)
                entry["n"] += n
                entry["top"] = max((t for t in (entry["top"], top) if t is not None), default=None)
        if len(out) >= 10_000:
            yield rows()
    close()
    yield rows()


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     capacity: int = 8 << 20, max_depth: int = 16) -> DataFrame:
    """One row per document: the id that its group of equal texts keeps, and the group's size.

    Texts are equal when identical after lower-casing A-Z.  The index is a table in the shared
    folder: one entry per different text of an input batch.  Its directory splits buckets of
    the hash range that hold more than ``capacity`` bytes of different texts, down to
    ``max_depth`` doublings (so it has 2 ** max_depth slots at most, which is what is gathered
    and broadcast; past that depth buckets only grow).  Each bucket goes to one owner task,
    which streams its entries in hash order and holds one chain at a time.

    Defined results: NULL counts as the empty text; the row with the largest id stays, rows
    without an id lose to any; rows that repeat the kept id are kept too, and so is a group
    none of whose rows has an id; an empty table gives an empty result; extra columns are
    ignored.
    """
    spark = docs.sparkSession
    rows = materialise(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                                   row_hash(text).alias("row_hash")).mapInArrow(_local_entries, ROWS), "index")
    entries = rows.filter(F.col("hash").isNotNull())
    slot = F.shiftright("hash", 64 - max_depth) + (1 << (max_depth - 1))
    held = (entries.groupBy("hash").agg(F.max(F.octet_length("body")).alias("size"))
            .groupBy(slot.cast("int").alias("slot")).agg(F.sum("size").alias("size")).collect())
    sizes = np.zeros(1 << max_depth, np.int64)
    for line in held:
        sizes[line["slot"]] = line["size"]
    buckets = directory(sizes, capacity)
    table = materialise(spark.createDataFrame(
        [(s, int(b)) for s, b in enumerate(buckets.tolist())], "slot int, bucket int"), "directory")
    resolved = (
        entries.withColumn("slot", slot.cast("int")).join(F.broadcast(table), "slot")
        .select("bucket", "ref", "hash", "body", "sha256", "top_id", "copies")
        .repartition("bucket").sortWithinPartitions("bucket", "hash").drop("bucket")
        .mapInArrow(_owner, RESOLVED)
    )
    members = rows.select("doc_id", "row_hash", "ref")
    return members.join(resolved, "ref").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", "row_hash")


def exact_unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, unchanged."""
    return kept_rows(docs, exact_duplicates(docs))
