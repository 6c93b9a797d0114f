"""Registered queries against their SQL, or against plain versions over whole tables."""

import hashlib
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from tallyspark.llm.bpe import parse_ranks
from tallyspark.llm.oracles import ORACLES
from tallyspark.llm.queries import QUERIES
from tests.compare import differences, duck
from tests.llm.data import WORD, read

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text or "", r.lang, r.source) for r in read(spark, FOLDER).collect()]


def test_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), ORACLES[name], duck(FOLDER)) == ""


@pytest.mark.parametrize("name", [n for n in QUERIES if n.split("_")[0] in ("op1", "op2", "op3", "op10")])
def test_native_queries_have_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_shards_hold_the_mixture(spark, texts):
    rows = QUERIES["op3_interleaved_shards"](spark, FOLDER).collect()
    source = {d: s for d, _, _, s in texts}
    size = {d: (len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t, _, _ in texts}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == size and len(rows) == len(texts)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    sources, mix = Counter(source.values()), Counter((r.shard, source[r.doc_id]) for r in rows)
    for name, whole in sources.items():
        assert all(abs(mix[s, name] - whole / 24) < 2 for s in range(24))


def test_languages_of_documents_never_seen(spark, texts):
    lang = {d: (x, t) for d, t, x, _ in texts}
    rows = QUERIES["op4_ppm_language_id"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    unseen = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == lang[r.doc_id][0] for r in unseen)
    assert right >= 0.97 * len(unseen)


def test_near_duplicates_are_the_linked_texts(spark, texts):
    from tallyspark.llm.alignment import FAR, edit_distances

    voc, groups = {}, {}
    for d, t, _, _ in texts:
        groups.setdefault(tuple(t.encode().lower().split()), []).append(d)
    nodes = [(np.array([voc.setdefault(w, len(voc)) for w in k], int), ids) for k, ids in groups.items()]
    pairs = [(a, b) for a in range(len(nodes)) for b in range(a)]
    caps = [int(0.2 * max(len(nodes[a][0]), len(nodes[b][0])) + 1e-9) for a, b in pairs]
    far = edit_distances([(nodes[a][0], nodes[b][0]) for a, b in pairs], caps)
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), d in zip(pairs, far):
        if d < FAR:
            root[find(a)] = find(b)
    least = {}
    for n, (_, ids) in enumerate(nodes):
        least[find(n)] = min(least.get(find(n), ids[0]), *ids)
    want = {d: least[find(n)] for n, (_, ids) in enumerate(nodes) for d in ids}
    rows = QUERIES["op6_order_min_hash"](spark, FOLDER).collect()
    assert {r.doc_id: r.class_id for r in rows} == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in rows)


def test_bpe_is_what_the_library_gives(spark, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = parse_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for d, t, _, _ in texts:
        ids = library.encode_ordinary(t)
        want[d] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(t.encode()).hexdigest())
    rows = QUERIES["op7_byte_level_bpe"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def test_token_files_hold_what_the_library_gives(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = {}, 0
    for d, t, _, _ in sorted(texts):
        ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        want[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    rows = QUERIES["op8_huffman_token_files"](spark, FOLDER).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == want


def test_repeated_windows(spark, texts):
    seen, want = set(), {}
    for d, t, _, _ in sorted(texts):
        words = WORD.findall(t)
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        want[d] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    rows = QUERIES["op9_repeated_windows"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want
