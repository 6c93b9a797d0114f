"""Near-duplicates by Order MinHash, verified by banded alignment."""

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.alignment import FAR, edit_distances
from tallyspark.llm.arrow import slices_of, utf8_of
from tallyspark.llm.shared import kept_rows, materialise, row_hash
from tallyspark.llm.substring_dedup import forget_powers, mixed, polynomial, window_hashes, word_hashes

GRAM_BASE = 0xD6E8FEB86659FD93
PLACE_BITS = 24
CROWD = 128
ITEM_BINS = 1 << 16
OUTLINE_LONGS = 16

SKETCHED = "doc_id long, row_hash long, content binary, n_words int, sketch array<long>"
WORDS = "content binary, words binary"
DISTANCES = "a long, b long, distance long"
RARE = "_node long, items array<long>"
OUTLINES = "_drawn long, outline array<long>"


def _first_of_each(batch: pa.RecordBatch):
    """(content hash of every row, rows with the first text of each content in the batch)."""
    data, at = utf8_of(batch.column("text"))
    data = data.lower()
    bodies = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    contents = [xxhash.xxh3_128_digest(b" ".join(body.split())) for body in bodies]
    first = {}
    for row, content in enumerate(contents):
        first.setdefault(content, row)
    rows = sorted(first.values())
    kept = [bodies[row] for row in rows]
    return contents, rows, b"".join(kept), np.cumsum([0, *map(len, kept)])


def _grams(words: np.ndarray, before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(labelled k-mer hashes, k-mers before each text).

    A text shorter than ``length`` words is one k-mer.  The label is the number of earlier
    occurrences of the k-mer in its text, so repetitions count.
    """
    counts = np.diff(before)
    hashes, _ = window_hashes(words, before, length)
    short = (counts > 0) & (counts < length)
    per_text = np.where(short, 1, np.maximum(counts - length + 1, 0))
    edges = np.concatenate([[0], np.cumsum(per_text)])
    grams = np.empty(edges[-1], np.uint64)
    whole = np.repeat(~short, per_text)
    grams[whole] = hashes
    rows = np.flatnonzero(short)
    grams[edges[rows]] = mixed(polynomial(words, GRAM_BASE, before[rows], before[rows + 1]))
    text = np.repeat(np.arange(len(counts), dtype=np.uint64), per_text)
    key = mixed(grams + mixed(text))
    order = np.argsort(key, kind="stable")
    start = np.ones(len(key), bool)
    start[1:] = key[order[1:]] != key[order[:-1]]
    run = np.flatnonzero(start)
    label = np.empty(len(key), np.uint64)
    label[order] = np.arange(len(key)) - np.repeat(run, np.diff(np.append(run, len(key))))
    return mixed(grams + label * np.uint64(GRAM_BASE)), edges


def order_min_hashes(grams: np.ndarray, edges: np.ndarray, sketches: int, kept: int) -> np.ndarray:
    """Per text and sketch: the ``kept`` k-mers with the smallest hash, hashed in text order."""
    filled = np.flatnonzero(np.diff(edges) > 0)
    out = np.zeros((len(edges) - 1, sketches), np.uint64)
    if not len(filled):
        return out
    starts = edges[:-1][filled]
    place = np.arange(len(grams), dtype=np.uint64) - np.repeat(starts, np.diff(edges)[filled]).astype(np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    place = np.minimum(place, low)
    sentinel = np.uint64(0xFFFFFFFFFFFFFFFF)
    for number in range(sketches):
        salt = int(mixed(np.array([number + 1], np.uint64))[0]) | 1
        rank = mixed(grams * np.uint64(salt)) & ~low | place
        found = []
        for _ in range(kept):
            least = np.minimum.reduceat(rank, starts)
            found.append(least)
            here = least != sentinel
            rank[(starts + (least & low).astype(np.int64))[here]] = sentinel
        found = np.stack(found)
        there = found != sentinel
        spots = np.where(there, found & low, low).astype(np.int64)
        names = np.where(there, grams[np.minimum(starts + spots, len(grams) - 1)], np.uint64(0))
        names = np.take_along_axis(names, np.argsort(spots, axis=0, kind="stable"), axis=0)
        value = np.full(len(filled), number + 1, np.uint64)
        for row in names:
            value = mixed(value * np.uint64(GRAM_BASE) + row)
        out[filled, number] = value
    return out


def allowed(size: int, share: float) -> int:
    """The largest distance of a link whose longer text has ``size`` words."""
    return int(share * size + 1e-9)


@lru_cache(256)
def _segments(size: int, longest: int, share: float) -> tuple[tuple[int, int], ...]:
    """(segment length, segments) of the texts of ``size`` to ``longest`` words that a text of
    ``size`` words can be linked with."""
    found = {}
    for other in range(size, longest + 1):
        edits = allowed(other, share)
        if edits and other - edits <= size:
            length = other // (edits + 1)
            found[length] = max(found.get(length, 0), edits + 1)
    return tuple(found.items())


def segment_keys(words: np.ndarray, longest: int, share: float) -> np.ndarray:
    """Keys of a text; two texts of at most ``longest`` words that are linked share one.

    The longer one starts with edits + 1 segments of one length.  Take the first segment up to
    which there are no more edits than segments before it: it has none itself and exactly as
    many before it as its number, so it is in the other text, moved by no more than that.
    """
    keys = [np.zeros(0, np.uint64)]
    for length, segments in _segments(len(words), longest, share):
        if length > len(words):
            continue
        grams = np.zeros(len(words) - length + 1, np.uint64)
        for i in range(length):
            grams = mixed(grams * np.uint64(GRAM_BASE) + words[i:i + len(grams)])
        for number in range(segments):
            near = grams[max(0, length * number - number):length * number + number + 1]
            keys.append(mixed(near + mixed(np.array([length << 32 | number << 1 | 1], np.uint64))))
    return np.unique(np.concatenate(keys))


def _sketch(gram: int, sketches: int, kept: int, short: int, share: float):
    def work(batches):
        for batch in batches:
            for part in slices_of(batch, "text", 2 << 20):
                contents, rows, data, at = _first_of_each(part)
                words, before = word_hashes(data, at)
                values = order_min_hashes(*_grams(words, before, gram), sketches, kept).view(np.int64)
                counts = np.diff(before)
                values = [v if 0 < n else v[:0] for v, n in zip(values, counts)]
                for i in np.flatnonzero((counts > 0) & (counts <= short)).tolist():
                    keys = segment_keys(words[before[i]:before[i + 1]], short, share)
                    values[i] = np.concatenate([values[i], keys.view(np.int64)])
                where = {row: i for i, row in enumerate(rows)}
                places = [where.get(row) for row in range(len(contents))]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("row_hash"), pa.array(contents, pa.binary()),
                    pa.array([None if i is None else int(counts[i]) for i in places], pa.int32()),
                    pa.array([None if i is None else values[i] for i in places], pa.list_(pa.int64())),
                ], names=[p.split()[0] for p in SKETCHED.split(", ")])
        forget_powers()

    return work


def _word_sequences(batches):
    for batch in batches:
        for part in slices_of(batch, "text", 2 << 20):
            contents, rows, data, at = _first_of_each(part)
            words, before = word_hashes(data, at)
            words = (words >> np.uint64(32)).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                pa.array([contents[row] for row in rows], pa.binary()),
                pa.array([words[a:b].tobytes() for a, b in zip(before[:-1], before[1:])], pa.binary()),
            ], names=["content", "words"])
    forget_powers()


def _align(reach: float):
    def work(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sides = []
                for name in ("words_a", "words_b"):
                    data, at = utf8_of(part.column(name))
                    sides.append([np.frombuffer(data[a:b], "<u4") for a, b in zip(at[:-1].tolist(), at[1:].tolist())])
                pairs = list(zip(*sides))
                caps = [int(reach * max(len(a), len(b)) + 1e-9) for a, b in pairs]
                found = edit_distances(pairs, caps)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(found)],
                                                 names=["a", "b", "distance"])

    return work


def distances(pairs: DataFrame, words: DataFrame, reach: float) -> DataFrame:
    """(a, b, distance) of pairs of texts, exact up to ``reach`` of the longer one, else FAR."""
    first = words.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    second = words.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
    return pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "words_a", "words_b") \
        .mapInArrow(_align(reach), DISTANCES)


def _items(data: bytes) -> np.ndarray:
    """The words of a text, repetitions told apart, as 64-bit hashes."""
    words = np.sort(np.frombuffer(data, "<u4")).astype(np.uint64)
    _, first, again = np.unique(words, return_index=True, return_inverse=True)
    return mixed(words << np.uint64(32) | (np.arange(len(words)) - first[again]).astype(np.uint64))


def _item_bins(batches):
    total = np.zeros(ITEM_BINS, np.int64)
    for batch in batches:
        for data in batch.column("words"):
            total += np.bincount((_items(data.as_py()) % np.uint64(ITEM_BINS)).astype(np.int64), minlength=ITEM_BINS)
    bins = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(total[bins])], names=["bin", "n"])


def rarest_words(words: DataFrame, share: float) -> DataFrame:
    """(_node, items): the rarest words of each text, one more than a link may cost edits.

    Linked texts have all but so many words of the longer one in common, so their rarest words
    in any one order meet.  The order is by counts in 2^16 bins, which come to the driver.
    """
    counts = np.zeros(ITEM_BINS, np.int64)
    for row in words.mapInArrow(_item_bins, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        counts[row["bin"]] = row["n"]

    def work(batches):
        for batch in batches:
            chosen = []
            for data in batch.column("words"):
                items = _items(data.as_py())
                order = np.lexsort((items, counts[(items % np.uint64(ITEM_BINS)).astype(np.int64)]))
                chosen.append(items[order[:allowed(len(items), share) + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(chosen, pa.list_(pa.int64()))],
                                             names=["_node", "items"])

    return words.select("node", "words").mapInArrow(work, RARE)


def _outlines(batches):
    """A bit for each bin of words (repetitions told apart): whether it holds an odd number."""
    bits = 64 * OUTLINE_LONGS
    for batch in batches:
        for part in slices_of(batch, "words", 2 << 20):
            data, at = utf8_of(part.column("words"))
            items, before = _grams(np.frombuffer(data, "<u4").astype(np.uint64) << np.uint64(32), at // 4, 1)
            spot = np.repeat(np.arange(part.num_rows) * bits, np.diff(before)) + (items % np.uint64(bits)).astype(np.int64)
            odd = np.zeros(part.num_rows * OUTLINE_LONGS, np.uint64)
            np.bitwise_xor.at(odd, spot >> 6, np.uint64(1) << (spot & 63).astype(np.uint64))
            ends = pa.array(np.arange(part.num_rows + 1) * OUTLINE_LONGS, pa.int32())
            outlines = pa.ListArray.from_arrays(ends, pa.array(odd.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("node"), outlines], names=["_drawn", "outline"])


def outlines(words: DataFrame) -> DataFrame:
    """(_drawn, outline): 1,024 bits of each node's words, to tell pairs that cannot be links.

    A bit differs only where the words of two texts differ.  An edit takes one word out, puts one
    in or does both, so twice the edit distance is at least the words that only one of the texts
    has plus the difference in length, and those words are at least the bits that differ.
    """
    return words.select("node", "words").mapInArrow(_outlines, OUTLINES)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that a node is linked with over any number of edges.

    Alternates the large-star and small-star steps of Kiveris et al. until nothing changes;
    each round is stored, so lineage stays short, and a few numbers come to the driver.
    """
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "edges")
    state = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint")),
                              F.sum(F.hash("b", "a").cast("bigint"))).first())
        if now == state or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min(F.least("a", "b")).alias("m"))
        large = materialise(both.join(least, F.col("a") == F.col("u")).filter("b > a")
                            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.union(low.select("u", "m")).distinct(), "small-star")


def near_duplicates(docs: DataFrame, similarity: float = 0.8, gram: int = 3, sketches: int = 96,
                    kept: int = 2, short: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, kept, n_words): classes of near-duplicate documents.

    Two texts are linked when their words (blank-separated, ASCII letters in lower case) have an
    edit similarity, 1 - distance / length of the longer, of ``similarity`` or more.  Texts with
    equal words are one node.  Candidates share one of ``sketches`` Order MinHash values: the
    ``kept`` smallest occurrence-labelled k-mers of ``gram`` words, in text order.  At similarity
    0.8 scattered substitutions leave 0.512 of the 3-word k-mers whole (Jaccard 0.34): one value
    is shared with a chance of 0.12, none of 96 with 1 in 100,000; with a substitution at every
    fifth word, the worst spread, 0.4 (0.25) and 1 in 500.  Texts of at most ``short`` words have
    too few k-mers for such odds: they also get ``segment_keys``, of which linked texts always
    share one.  A class is a connected component of links; its id is the smallest document id
    in it, whose row stays.

    Within a bucket a node is aligned with the bucket's first node, not with every other: with one
    such leader first, and with those of its other buckets if that left them in two components.
    Where a bucket of several components holds a node that is no link of its first, all its nodes
    are aligned with the first.  These distances are exact up to twice the limit, and by the triangle inequality
    almost no other pair can be a link once a node is far from the first; the pairs that still
    can (in different components so far) are aligned as well, so that no link is lost, save those
    whose ``outlines`` show that they have too few words in common.  In buckets of over 128 nodes
    such pairs must also share one of their rarest words, as links do.

    Defined results: NULL and empty texts have no words and form one class; texts under
    ``gram`` words are one k-mer; a NULL id is never the class id unless the class has no other;
    repeated rows fall into one class; an empty table gives an empty result; extra columns are
    ignored.
    """
    reach = 2 * (1 - similarity)
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       row_hash(text).alias("row_hash"))
    sketched = materialise(rows.mapInArrow(_sketch(gram, sketches, kept, short, 1 - similarity), SKETCHED), "sketches")
    nodes = materialise(sketched.filter(F.col("sketch").isNotNull()).select("content", "n_words", "sketch")
                        .dropDuplicates(["content"]).withColumn("node", F.monotonically_increasing_id()), "nodes")
    bands = nodes.select("node", F.col("n_words").alias("n"), F.explode("sketch").alias("bucket"))
    leaders = materialise(bands.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("_size"))
                          .filter("_size > 1").select("bucket", "leader"), "leaders")
    members = materialise(bands.join(leaders, "bucket"), "members")

    texts = rows.select("text").mapInArrow(_word_sequences, WORDS)
    needed = nodes.join(members.select("node").distinct(), "node").select("content", "node")
    words = materialise(texts.join(needed, "content").dropDuplicates(["node"]).select("node", "words"), "words")

    pairs = materialise(members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
                        .distinct(), "pairs")
    lengths = nodes.select(F.col("node").alias("_node"), F.col("n_words").alias("_n"))
    limit = F.lit(1 - similarity)

    def within(distance, *sizes):
        return distance <= F.floor(limit * F.greatest(*sizes) + F.lit(1e-9))

    def aligned(pairs, purpose):
        """The pairs with their distances, stored, and whether they are links."""
        found = distances(pairs, words, reach)
        sized = found.join(lengths, F.col("a") == F.col("_node")).withColumnRenamed("_n", "n_a").drop("_node") \
            .join(lengths, F.col("b") == F.col("_node")).withColumnRenamed("_n", "n_b").drop("_node")
        return materialise(sized.select("a", "b", "distance", within(F.col("distance"), "n_a", "n_b").alias("link")), purpose)

    # One leader for every node first; the other pairs only where that left two components.
    nearest = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    first = aligned(nearest, "first")
    roots = components(first.filter("link").select("a", "b"))
    apart = pairs.join(nearest.withColumnRenamed("b", "_b").withColumnRenamed("a", "_a"),
                       (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti")
    for side in ("a", "b"):
        apart = apart.join(roots.select(F.col("node").alias(f"_{side}"), F.col("root").alias(f"_root_{side}")),
                           F.col(side) == F.col(f"_{side}"), "left") \
            .withColumn(f"_root_{side}", F.coalesce(f"_root_{side}", side)).drop(f"_{side}")
    second = aligned(apart.filter("_root_a <> _root_b").select("a", "b"), "second")
    starred = first.union(second)
    linked = materialise(starred.filter("link").select("a", "b"), "links")
    roots = components(linked)

    again = members.join(starred.filter("not link").select(F.col("a").alias("leader"), F.col("b").alias("_far")), "leader") \
        .filter(F.col("node") == F.col("_far")).select("bucket").distinct()
    found = roots.select(F.col("node").alias("_own"), "root")
    again = members.join(again, "bucket").join(found, F.col("node") == F.col("_own"), "left") \
        .groupBy("bucket").agg(F.min(F.coalesce("root", "node")).alias("_low"), F.max(F.coalesce("root", "node")).alias("_high"))
    again = materialise(again.filter("_low <> _high").select("bucket"), "again")
    # Buckets with a node far from their leader, not all in one component by now, need the
    # distance of every node to it.
    open_pairs = members.join(again, "bucket").filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct() \
        .join(starred.select(F.col("a").alias("_a"), F.col("b").alias("_b")), (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti")
    starred = starred.union(aligned(open_pairs, "third"))
    known = starred.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "distance")
    mixed_buckets = members.join(again, "bucket").join(
        known, (F.col("leader") == F.col("_a")) & (F.col("node") == F.col("_b")), "left").join(
        found, F.col("node") == F.col("_own"), "left").select(
        "bucket", "node", "n", F.coalesce("root", "node").alias("root"),
        F.when(F.col("node") == F.col("leader"), 0).otherwise(
            F.least(F.col("distance"), F.floor(F.lit(reach) * F.col("n")) + 1)).alias("least"),
        F.when(F.col("node") == F.col("leader"), 0).otherwise(F.col("distance")).alias("most"))
    mixed_buckets = materialise(mixed_buckets, "mixed")
    others = mixed_buckets.filter("least > 0")
    lively = materialise(others.groupBy("bucket").agg(
        F.count("*").alias("_size"), F.min("root").alias("_low"), F.max("root").alias("_high")).filter("_low <> _high")
        .select(F.col("bucket").alias("_lively"), (F.col("_size") > CROWD).alias("_crowded")), "lively")
    others = materialise(others.join(lively, F.col("bucket") == F.col("_lively")).drop("_lively"), "others")
    drawn = materialise(outlines(words).join(others.select("node").distinct(), F.col("_drawn") == F.col("node"))
                        .drop("node"), "outlines")
    in_crowd = others.filter("_crowded").drop("_crowded")
    meets = in_crowd.groupBy("node", "n", "root").agg(F.collect_set("bucket").alias("buckets"))
    rare = rarest_words(materialise(words.join(in_crowd.select("node").distinct(), "node"), "crowd"), 1 - similarity)
    meets = materialise(meets.join(rare, F.col("node") == F.col("_node")).drop("_node"), "rare") \
        .withColumn("item", F.explode("items")).drop("items")
    calm = others.filter("not _crowded").drop("_crowded").join(drawn, F.col("node") == F.col("_drawn")).drop("_drawn")
    room = F.floor(limit * F.greatest("n", "_n") + F.lit(1e-9))
    fits = (F.col("node") < F.col("_node")) & (F.col("root") != F.col("_root")) & (F.abs(F.col("n") - F.col("_n")) <= room)

    bits = [F.bit_count(F.get("outline", F.lit(i)).bitwiseXOR(F.get("_outline", F.lit(i)))) for i in range(OUTLINE_LONGS)]
    alike = sum(bits[1:], bits[0]) + F.abs(F.col("n") - F.col("_n")) <= 2 * room

    def met(rows, condition):
        """Pairs of nodes in different components that can be links."""
        other = rows.select(*[F.col(c).alias(f"_{c}") for c in rows.columns])
        return rows.join(other, condition & fits).select(F.col("node").alias("a"), F.col("_node").alias("b"))

    rest = met(calm, (F.col("bucket") == F.col("_bucket")) & (F.col("least") - F.col("_most") <= room)
               & (F.col("_least") - F.col("most") <= room) & alike)
    # Rows for each rare word would be long with an outline, so here it is looked up for the pairs found.
    crowd = met(meets, (F.col("item") == F.col("_item")) & F.arrays_overlap("buckets", "_buckets")).distinct()
    sized = drawn.join(lengths, F.col("_drawn") == F.col("_node")).select("_drawn", "outline", F.col("_n").alias("n"))
    other = sized.select(F.col("_drawn").alias("_other"), F.col("outline").alias("_outline"), F.col("n").alias("_n"))
    crowd = crowd.join(sized, F.col("a") == F.col("_drawn")).join(other, (F.col("b") == F.col("_other")) & alike)
    rest = rest.union(crowd.select("a", "b")).distinct()
    later = materialise(distances(rest, words, 1 - similarity).filter(F.col("distance") < FAR).select("a", "b"), "later")
    if later.limit(1).count():
        roots = components(linked.union(later))

    named = nodes.select("content", "node").join(roots, "node", "left") \
        .select(F.col("content"), F.coalesce("root", "node").alias("root"))
    ids = sketched.groupBy("content").agg(F.min("doc_id").alias("least"))
    classes = named.join(ids, "content")
    tops = classes.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("class_id"))
    classes = materialise(classes.join(tops, F.col("root") == F.col("_root")).select("content", "class_id"), "classes")
    return sketched.select("doc_id", "row_hash", "content").join(classes, "content").select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"), "row_hash")


def near_unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, unchanged."""
    return kept_rows(docs, near_duplicates(docs))
