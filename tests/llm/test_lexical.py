"""Ranked search against scoring every document (the SQL of the query does the same)."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyspark.llm import lexical
from tallyspark.llm.queries import QUERIES
from tests.llm.data import ROWS, awkward, empty
from tests.llm.test_queries import FOLDER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, score string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for (d, c), size in zip(held, sizes):
            m = 100 - 90 + 90 * size * n // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def rows_of(found):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str)


def test_awkward_documents_and_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", 200)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 2)
    items = [(1, "the quick, QUICK brown fox"), (2, None), (3, "..."), (4, "word1 item5 one"), (4, "café 中文 😀"), (None, "one a"),
             (6, "no such"), (7, "the the a lazy sleepy dog over nine old owls")]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    index = lexical.build_index(awkward(spark).repartition(3))
    got = rows_of(lexical.search(spark, index, asked, k=3))
    want = brute([(r[0], r[1]) for r in ROWS], items, 3)
    assert got == sorted(want, key=str) and {i for i, *_ in got} == {1, 4, 7, None}


def test_empty_index_and_no_items(spark):
    items = spark.createDataFrame([(1, "a word", "x")], ITEMS)
    assert lexical.search(spark, lexical.build_index(empty(spark)), items).count() == 0
    index = lexical.build_index(awkward(spark))
    assert lexical.search(spark, index, items.limit(0)).count() == 0
    assert lexical.search(spark, index, items.withColumn("text", items.text.substr(1, 0))).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(d, "same words here") for d in (9, 3, None, 7, 1, 5)] + [(100, "other")], "doc_id long, text string")
    found = lexical.search(spark, lexical.build_index(docs), spark.createDataFrame([(0, "same here", "")], ITEMS), k=4)
    assert [d for _, _, d, _ in rows_of(found)] == [1, 3, 5, 7]


@pytest.mark.parametrize("seed", range(20))
def test_skipping_loses_no_document(seed):
    """Lists of every length, with many equal scores, against adding everything up."""
    random.seed(seed)
    rng, size, k = np.random.default_rng(seed), 2000, 10
    windows = -(-size // lexical.WINDOW)
    lists = []
    for share in (0.001, 0.004, 0.01, 0.05, 0.2, 0.6, 1.0):
        docs = np.flatnonzero(rng.random(size) < share)
        lists.append(lexical.PostingList(docs, rng.integers(0, 9, len(docs)) * int(2 / share), windows))
    lists = random.sample(lists, random.randrange(1, 8))
    order = rng.permutation(size)
    scores = np.zeros(size, np.int64)
    for x in lists:
        scores[x.docs] += x.values
    want = sorted((-int(s), int(order[d]), d) for d, s in enumerate(scores) if s > 0)[:k]
    assert lexical.best_of_segment(lists, size, order, k) == [(d, -s) for s, _, d in want]


def test_windows_below_the_threshold_are_skipped():
    seen = set()

    class Places(np.ndarray):
        def __getitem__(self, window):
            seen.add(window)
            return super().__getitem__(window)

    docs = np.arange(6400)
    whole = lexical.PostingList(docs, np.where(docs % 640 == 0, 1000, 1), 100)
    whole.places = whole.places.view(Places)
    found = lexical.best_of_segment([whole], 6400, docs, 10)
    assert [d for d, _ in found] == list(range(0, 6400, 640)) and len(seen) <= 20


def test_query_has_ranks_without_gaps(spark):
    rows = QUERIES["op12_hybrid_ranked_search"](spark, FOLDER).collect()
    ranks = {}
    for r in rows:
        ranks.setdefault(r.item_id, []).append(r["rank"])
    assert ranks and all(sorted(v) == list(range(1, 11)) for v in ranks.values())
