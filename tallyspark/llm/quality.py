"""Quality rules: repetition within a document, frequent lines across documents of a host."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import BLANK_RUN, BLANKS, let, materialise, words_of

# The symbols that count as markup, and the window of the repetition rule.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
SALTS = 16


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of five words that occurs twice or more in ``words``.

    Windows are compared by a 64-bit hash.  A text without a repeated window (most of them)
    costs one duplicate test; otherwise the repeated windows are found by sorting, and each
    covers the words up to the next repeated one, five at most.
    """
    count = F.size(words)
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(hashes, lambda h: F.transform(
        F.sequence(F.lit(0), count - WINDOW),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))

    def covered(windows):
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(pairs, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])),
            lambda x: x["i"])))
        gaps = let(starts, lambda p: F.transform(p, lambda at, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(p, i + 1), at + WINDOW) - at)))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    found = let(windows, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0))
                .otherwise(covered(g)))
    return F.when(count < WINDOW, F.lit(0)).otherwise(found).cast("bigint")


def normal_line(line: Column) -> Column:
    """Lower case, blanks at the ends removed, each run of blanks one space."""
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(BLANKS)), BLANK_RUN, " "))


def lines_of(text: Column) -> Column:
    """The lines of a text that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                    lambda line: F.btrim(line, F.lit(BLANKS)) != "")


def _measured(docs, key, host, text):
    """One stored row per document: its figures, and hash and word count of each line."""
    lines = F.transform(lines_of(F.col(text)), normal_line)
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("_text"),
        words_of(F.col(text)).alias("_words"), lines_of(F.col(text)).alias("_lines"),
    ).select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", "host",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.coalesce(F.regexp_count("_text", F.lit(SYMBOLS)), F.lit(0)).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.transform(F.transform("_lines", normal_line), lambda line: F.struct(
            F.xxhash64(line).alias("h"),
            (F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1).alias("n"))).alias("lines"),
    )
    return materialise(rows, "quality")


def frequent_lines(rows: DataFrame, least_docs: int, share: float) -> DataFrame:
    """(host, line hash, docs) of lines that more than ``least_docs`` documents of a host and
    more than ``share`` of its documents hold.  A document counts once for each of its lines."""
    hosts = rows.groupBy(F.col("host").alias("_host")).agg(F.count("*").alias("_of"))
    counted = (
        rows.select("host", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
        .groupBy("host", "h").agg(F.count("*").alias("docs"))
        .filter(F.col("docs") > least_docs)
    )
    return (counted.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
            .filter(F.col("docs") > F.col("_of") * F.lit(share)).select("host", "h", "docs"))


def _removed_lines(rows, frequent):
    """Lines to remove, by row.  Frequent lines are hot keys, so both sides are salted."""
    frequent = frequent.select(F.col("host").alias("_host"), F.col("h").alias("_h"),
                               F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    lines = rows.select("_row", "host", F.explode("lines").alias("line")).withColumn(
        "salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int"))
    return lines.join(frequent, F.col("host").eqNullSafe(F.col("_host"))
                      & (F.col("line.h") == F.col("_h")) & (F.col("salt") == F.col("_salt")))


def quality_verdicts(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text",
                     least_docs: int = 20, share: float = 0.005, left_words: int = 10,
                     left_share: int = 30) -> DataFrame:
    """Figures and verdict of every document.

    ``base_failed``: under ten words, or over 20 % of the words in repeated five-word windows.
    Otherwise lines on more than ``least_docs`` and more than ``share`` of the documents of a
    host are removed (``n_removed_words``), and a document that loses words is rejected when
    fewer than ``left_words`` words or less than ``left_share`` % of its words are left.

    Defined results: a NULL or empty text has no words and no lines and fails the base rules;
    a NULL host is a host of its own; every row is a document, also when its id repeats or is
    NULL; an empty table gives an empty result; extra columns are ignored.  Texts are read
    once and not shuffled: what is stored and joined are hashes and figures.
    """
    rows = _measured(docs, key, host, text)
    removed = (_removed_lines(rows, frequent_lines(rows, least_docs, share))
               .groupBy(F.col("_row").alias("_of_row")).agg(F.sum("line.n").alias("_removed")))
    gone = F.coalesce(F.col("_removed"), F.lit(0)).cast("bigint")
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    depleted = (F.col("n_removed_words") > 0) & (
        (left < left_words) | (left * 100 < F.col("n_words") * left_share))
    return (
        rows.drop("lines").join(removed, F.col("_row") == F.col("_of_row"), "left")
        .withColumn("n_removed_words", gone)
        .withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "kept", "n_removed_words", "host")
    )


def without_frequent_lines(docs: DataFrame, frequent: DataFrame, host: str = "source",
                           text: str = "text") -> DataFrame:
    """``docs`` with the frequent lines (from ``frequent_lines``) taken out of the texts.

    The frequent lines of a host are gathered into one array: there are at most
    1 / ``share`` times the lines of a document of them.
    """
    lists = frequent.groupBy(F.col("host").alias("_host")).agg(F.collect_set("h").alias("_gone"))
    joined = docs.join(lists, F.col(host).eqNullSafe(F.col("_host")), "left")
    kept = F.filter(F.split(F.col(text), "\n"), lambda line: ~F.coalesce(
        F.array_contains(F.col("_gone"), F.xxhash64(normal_line(line))), F.lit(False)))
    return joined.withColumn(text, F.array_join(kept, "\n")).select(*docs.columns)
