"""Language identification by prediction by partial matching (PPM) over bytes."""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.arrow import slices_of, utf8_of
from tallyspark.llm.shared import broadcast_if_small, materialise

ORDER = 3
GAP = b"\n" * ORDER
SCORED_BYTES = 8
GRAMS = "lang string, k int, gram long, n long"


def held_out(key: Column) -> Column:
    """Documents kept away from training: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int, key: str, text: str, lang: str) -> DataFrame:
    """At most ``per_language`` labelled documents of each language, by a seeded hash.

    Rows are thinned by a threshold on the hash first, where they are read: only the few left
    are shuffled and ranked.
    """
    labelled = docs.filter(~held_out(F.col(key)) & F.col(key).isNotNull() & F.col(text).isNotNull()
                           & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.lit("languages"), F.col(key)), F.lit(1 << 40)).alias("_h"))
    counts = materialise(labelled.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_of")), "languages")
    share = F.lit(float(1 << 40)) * (1.5 * per_language + 50) / F.col("_of")
    thin = labelled.join(broadcast_if_small(counts), F.col("lang") == F.col("_lang")).filter(F.col("_h") < share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "text"))
    return thin.withColumn("_rank", rank).filter(F.col("_rank") <= per_language).select("lang", "text")


def _count_grams(table: pa.Table) -> pa.Table:
    """Contexts of 0 to 3 bytes and the byte after them, with counts, of one language."""
    data, at = utf8_of(table.column("text"))
    body = GAP.join(data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist()))
    codes = np.frombuffer(GAP + body.lower(), np.uint8).astype(np.int64)
    grams, counts, orders = [], [], []
    for k in range(ORDER + 1):
        value = np.zeros(len(codes) - ORDER, np.int64)
        for back in range(k, -1, -1):
            value = (value << 8) | codes[ORDER - back:len(codes) - back]
        found, n = np.unique(value, return_counts=True)
        grams.append(found)
        counts.append(n)
        orders.append(np.full(len(found), k))
    size = sum(map(len, grams))
    return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * size, pa.string()),
                     "k": pa.array(np.concatenate(orders), pa.int32()),
                     "gram": pa.array(np.concatenate(grams)), "n": pa.array(np.concatenate(counts), pa.int64())})


def frozen_statistics(docs: DataFrame, per_language: int = 400, key: str = "doc_id", text: str = "text",
                      lang: str = "lang") -> dict:
    """The languages and their n-gram counts, from the bounded sample."""
    sample = training_sample(docs, per_language, key, text, lang)
    grams = sample.groupBy("lang").applyInArrow(_count_grams, GRAMS).toArrow()
    names = sorted(set(grams.column("lang").to_pylist()))
    index = {name: i for i, name in enumerate(names)}
    return {"languages": names, "name": uuid.uuid4().hex,
            "lang": np.array([index[x] for x in grams.column("lang").to_pylist()], np.int16),
            "k": grams.column("k").to_numpy().astype(np.int8),
            "gram": grams.column("gram").to_numpy(), "n": grams.column("n").to_numpy()}


def _escape(counts: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Probabilities in a context: seen bytes by count, the escape (as likely as the number of
    different bytes seen) shared out by the next shorter context."""
    total, seen = counts.sum(-1, keepdims=True), (counts > 0).sum(-1, keepdims=True)
    below = np.where(total > 0, seen / np.maximum(total + seen, 1), 1.0) * base
    return np.where(counts > 0, counts / np.maximum(total + seen, 1), below)


class ByteTrees:
    """Context trees of all languages as tables.

    A row is a context: one byte, or two or three where all languages together saw it at least
    ``least`` times.  ``pair`` and ``triple`` lead to the row of the longest known context, and
    ``bits[language][row, byte]`` is the exact code length of a byte after that context.
    """

    def __init__(self, stats: dict, least: int = 4):
        self.languages = stats["languages"]
        lang, order, gram, n = stats["lang"], stats["k"], stats["gram"], stats["n"]
        whole = gram[order == ORDER]
        seen = np.unique(np.concatenate([(whole >> (8 * back)) & 255 for back in range(ORDER + 1)]))
        self.symbols = np.zeros(256, np.int64)
        self.symbols[seen] = np.arange(1, len(seen) + 1)
        self.size = size = len(seen) + 1

        def packed(k):
            """(language, context, symbol, count) with contexts written in symbols."""
            rows = order == k
            codes = gram[rows]
            parts = [self.symbols[(codes >> (8 * back)) & 255] for back in range(k, -1, -1)]
            context = np.zeros(len(codes), np.int64)
            for part in parts[:-1]:
                context = context * size + part
            return lang[rows], context, parts[-1], n[rows]

        levels = [packed(k) for k in range(ORDER + 1)]

        def known(k):
            _, context, _, count = levels[k]
            names, place = np.unique(context, return_inverse=True)
            return names[np.bincount(place, count, len(names)) >= least]

        pairs, triples = known(2), known(3)
        triples = triples[np.isin(triples % (size * size), pairs)]
        self.pair = np.tile(np.arange(size, dtype=np.int32), size)
        self.pair[pairs] = size + np.arange(len(pairs), dtype=np.int32)
        last = np.concatenate([np.arange(size), pairs % size])
        self.triple = self.pair.reshape(size, size)[last].copy()
        inner = np.isin(triples // size, pairs)
        triples = triples[inner]
        self.triple[self.pair[triples // size], triples % size] = \
            size + len(pairs) + np.arange(len(triples), dtype=np.int32)
        self.triple = self.triple.ravel()
        self.bits = []
        for number in range(len(self.languages)):
            def dense(k, names):
                own, context, symbol, count = (x[levels[k][0] == number] for x in levels[k])
                place = np.searchsorted(names, context)
                hit = (place < len(names)) & (names[np.minimum(place, len(names) - 1)] == context) \
                    if len(names) else np.zeros(len(context), bool)
                table = np.zeros((len(names), size))
                table[place[hit], symbol[hit]] = count[hit]
                return table

            base = np.full((1, size), 1 / 256)
            zero = _escape(dense(0, np.zeros(1, np.int64)), base)
            one = _escape(dense(1, np.arange(size)), zero)
            two = _escape(dense(2, pairs), one[pairs % size])
            three = _escape(dense(3, triples), two[np.searchsorted(pairs, triples % (size * size))])
            self.bits.append(-np.log2(np.concatenate([one, two, three])).astype(np.float32).ravel())

    def code_lengths(self, data: bytes, at: np.ndarray) -> np.ndarray:
        """Bits of every text (rows) under every language (columns); texts are whole."""
        spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
        body = GAP + GAP.join([*(data[a:b] for a, b in spans), b""])
        symbols = self.symbols[np.frombuffer(body.lower(), np.uint8)]
        pair = self.pair[symbols[:-1] * self.size + symbols[1:]].astype(np.int64)
        row = self.triple[pair[:-1] * self.size + symbols[2:]].astype(np.int64)
        cell = row[:-1] * self.size + symbols[3:]
        lengths = np.diff(at)
        ends = np.cumsum(lengths + ORDER) - ORDER
        out = np.zeros((len(spans), len(self.bits)))
        for number, bits in enumerate(self.bits):
            sums = np.zeros(len(cell) + 1)
            np.cumsum(bits[cell], dtype=np.float64, out=sums[1:])
            out[:, number] = sums[ends] - sums[ends - lengths]
        return out


def _trees(stats: dict) -> ByteTrees | None:
    """The trees of frozen statistics, built once per task and freed with it."""
    return ByteTrees(stats) if stats["languages"] else None


def _predict(trees: ByteTrees | None, part: pa.RecordBatch, text: str) -> list[pa.Array]:
    """Language, score and bits per byte of the texts of a batch."""
    letters = part.column("_has_letter").to_pylist()
    if not trees:
        return [pa.array(["und"] * len(letters), pa.string()), pa.array([0.0] * len(letters), pa.float64()),
                pa.nulls(len(letters), pa.float64())]
    data, at = utf8_of(part.column(text))
    bits = trees.code_lengths(data, at) / np.maximum(np.diff(at), 1)[:, None]
    best, least = bits.argmin(1).tolist(), bits.min(1)
    chance = 1 / np.exp2(-SCORED_BYTES * (bits - least[:, None])).sum(1)
    return [pa.array([trees.languages[b] if known else "und" for b, known in zip(best, letters)], pa.string()),
            pa.array([c if known else 0.0 for c, known in zip(chance.tolist(), letters)], pa.float64()),
            pa.array([m if known else None for m, known in zip(least.tolist(), letters)], pa.float64())]


def _judged(docs: DataFrame, stats: dict, text: str = "text", returned: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (those ``returned``) under numbers, with ``_lang_pred``, ``_score`` and ``_bits_per_byte``, row by row.

    The language of a whole text is the one whose frozen trees code it in the fewest bits.
    The score is the probability of that language, all being equally likely before, for a
    stretch of 8 bytes at the text's mean code lengths: near 1 for a text of one language,
    lower the more a text mixes.

    Defined results: ``und`` with score 0 for a NULL text, one without a letter, or when no
    language was learned; of languages with equal code lengths the first by name; every row
    gives a row, whatever its id; an empty table gives an empty result; labels and other
    columns are passed on unread.
    """
    shared = docs.sparkSession.sparkContext.broadcast(stats)
    kept = [f"_{i}" for i, c in enumerate(docs.columns) if returned is None or c in returned]
    names, body = [*kept, "_lang_pred", "_score", "_bits_per_byte"], f"_{docs.columns.index(text)}"

    def work(batches):
        trees = _trees(shared.value)
        for batch in batches:
            for part in slices_of(batch, body, 2 << 20):
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), *_predict(trees, part, body)], names=names)

    # Columns travel under numbers, so that none can clash with another.
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)],
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_has_letter"))
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField("_lang_pred", T.StringType()),
                           T.StructField("_score", T.DoubleType()), T.StructField("_bits_per_byte", T.DoubleType())])
    return rows.mapInArrow(work, schema)


def identify_languages(docs: DataFrame, stats: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) of every document."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                       held_out(F.col(key)).alias("held_out"))
    return _judged(rows, stats, returned=["doc_id", "held_out"]).select(
        F.col("_0").alias("doc_id"), F.col("_2").alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"),
        F.col("_bits_per_byte").alias("bits_per_byte"))


def accepted_languages(docs: DataFrame, stats: dict, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text is in a known language, by at least ``least_score``."""
    good = _judged(docs, stats).filter((F.col("_lang_pred") != "und") & (F.col("_score") >= least_score))
    return good.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
