"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallyspark.llm import (
    bpe, exact_dedup, language_id, mixing, near_dedup, quality, quotations, sharding, substring_dedup, token_files,
)
from tallyspark.llm.alignment import FAR, edit_distances
from tests.llm.data import LONG, ROWS, SENTENCE, WORD, awkward, empty

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
MESSAGES = "conv_id long, turn long, role string, text string"

OPERATORS = {
    "mixing": lambda d: mixing.mix_to_weights(d, {"lang": {"en": 2}}),
    "sharding": sharding.interleaved_shards,
    "language": lambda d: language_id.identify_languages(d, language_id.frozen_statistics(d)),
    "exact": exact_dedup.exact_duplicates,
    "near": near_dedup.near_duplicates,
    "bpe": lambda d: bpe.round_trip(d, RANKS),
    "files": lambda d: token_files.read_token_files(d.sparkSession, token_files.write_token_files(d, WORDS)),
    "windows": substring_dedup.repeated_windows_removed,
    "quality": quality.quality_verdicts,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables_give_empty_results(spark, name):
    assert OPERATORS[name](empty(spark)).count() == 0


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"mixing"}))
def test_one_row_per_row(spark, name):
    rows = OPERATORS[name](awkward(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)


def test_exact_keeps_the_largest_id(spark):
    rows = exact_dedup.exact_duplicates(awkward(spark)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.text_sha256, []).append(r)
    same = by[hashlib.sha256(SENTENCE.lower().encode()).hexdigest()]
    assert {(r.doc_id, r.keep_id, r.kept) for r in same} == {
        (1, 3, False), (2, 3, False), (3, 3, True), (None, 3, False)}
    assert all(r.group_size == 4 for r in same)
    nothing = by[hashlib.sha256(b"").hexdigest()]
    assert {(r.doc_id, r.kept) for r in nothing} == {(5, False), (6, True)}
    kept = exact_dedup.exact_unique(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in rows if r.kept)


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    """Texts in one chain (one hash for all) are still separated, by their bytes."""
    import pyarrow as pa

    def entry(ref, body, top, n):
        return {"ref": ref, "hash": 7, "body": body, "sha256": hashlib.sha256(body).hexdigest(), "top_id": top, "copies": n}

    batch = pa.RecordBatch.from_pylist([entry(1, b"a", 4, 2), entry(2, b"b", 9, 1), entry(3, b"a", None, 3), entry(4, b"a", 5, 1)])
    found = [r for out in exact_dedup._owner([batch]) for r in out.to_pylist()]
    assert {(r["ref"], r["keep_id"], r["group_size"]) for r in found} == {(1, 5, 6), (3, 5, 6), (4, 5, 6), (2, 9, 1)}


def test_directory_splits_overfull_buckets_only():
    sizes = np.array([1, 1, 1, 9, 0, 0, 2, 2])
    assert exact_dedup.directory(sizes, 20).tolist() == [0] * 8
    assert exact_dedup.directory(sizes, 4).tolist() == [0, 0, 2, 3, 4, 4, 4, 4]


def test_near_duplicates_and_copies(spark):
    rows = {(r.doc_id, r.class_id): r for r in near_dedup.near_duplicates(awkward(spark)).collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 1), (None, 1), (10, 10), (11, 10), (5, 5), (6, 5), (7, 5)} <= set(rows)
    assert (12, 12) in rows and (9, 9) in rows and (13, 13) in rows
    kept = near_dedup.near_unique(awkward(spark))
    assert kept.columns == awkward(spark).columns and 4 not in [r.doc_id for r in kept.collect()]


def test_no_link_in_a_bucket_is_lost(spark):
    """Two clusters that share their smallest k-mers with a third text, far from each other."""
    random.seed(5)
    shared = [f"s{i}" for i in range(40)]
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]

    def copy(words):
        words = list(words)
        words[random.randrange(len(words))] = f"z{random.random()}"
        return " ".join(words)

    rows = [(i, copy(shared + a), "en", "s", 1) for i in range(12)] + [(20 + i, copy(shared + b), "en", "s", 1) for i in range(12)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert {r.class_id for r in got.collect() if r.doc_id < 20} == {0}
    assert {r.class_id for r in got.collect() if r.doc_id >= 20} == {20}


@pytest.mark.parametrize("size", [10, 20, 100])
def test_planted_links_are_found(spark, size):
    """Substitutions, insertions and removals, scattered or evenly spread, at 0.8, 0.85 and 0.9."""
    random.seed(size)
    rows = []
    for number in range(360):
        words = [f"p{number}x{i}" for i in range(size)]
        edits = int((0.2, 0.15, 0.1)[number % 3] * size + 1e-9)
        at = random.sample(range(size), edits) if number % 2 else [(2 * i + 1) * size // (2 * edits) for i in range(edits)]
        other = list(words)
        for place in at:
            new, kind = f"z{number}x{place}", number // 6 % 3
            other[place] = "" if kind == 1 else f"{new} {words[place]}" if kind == 2 and 5 * edits < size else new
        rows += [(2 * number, " ".join(words), "en", "s", 1), (2 * number + 1, " ".join(other), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    missed = [n for n in range(360) if not got[2 * n] == got[2 * n + 1] == 2 * n]
    assert len(missed) <= (2 if size > 50 else 0)


def test_crowded_buckets_keep_their_links(spark, monkeypatch):
    """Many short texts around one passage, all in the buckets of its k-mers, linked in pairs."""
    monkeypatch.setattr(near_dedup, "CROWD", 8)
    passage, rows = [f"s{i}" for i in range(10)], []
    for number in range(60):
        words = [f"p{number}x{i}" for i in range(15)]
        rows += [(2 * number, " ".join(passage + words), "en", "s", 1),
                 (2 * number + 1, " ".join(passage + words[:7] + ["z"] + words[8:]), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {n: n // 2 * 2 for n in range(120)}


@pytest.mark.parametrize("crowd", [8, 128])
def test_texts_around_one_passage_are_not_all_aligned(spark, monkeypatch, crowd):
    """Texts that share half their words, and the buckets of those, are linked in pairs only; no
    other two are close enough for a link, and their alignments would grow with the square."""
    asked, plain = [], near_dedup.distances

    def counting(pairs, words, reach):
        asked.append(pairs.count())
        return plain(pairs, words, reach)

    monkeypatch.setattr(near_dedup, "distances", counting)
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    random.seed(7)
    passage, rows = [f"s{i}" for i in range(60)], []
    for number in range(60):
        words = [f"w{i}" for i in random.sample(range(400), 60)]
        rows += [(2 * number, " ".join(passage + words), "en", "s", 1),
                 (2 * number + 1, " ".join(passage + ["z"] + words[1:]), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {n: n // 2 * 2 for n in range(120)}
    assert asked[-1] <= len(rows)


def test_outlines_bound_the_distance(spark):
    random.seed(11)
    texts = [[random.randrange(40) for _ in range(random.randrange(1, 90))] for _ in range(80)]
    for text in texts[:40]:
        copy = list(text)
        for _ in range(random.randrange(1, 6)):
            copy[random.randrange(len(copy)):][:1] = [random.randrange(40)] * random.randrange(2)
        texts.append(copy)
    sides = [np.array(t, "<u4") for t in texts]
    rows = spark.createDataFrame([(i, t.tobytes()) for i, t in enumerate(sides)], "node long, words binary")
    bits = {r[0]: r.outline for r in near_dedup.outlines(rows).collect()}
    pairs = [(a, b) for a in range(len(sides)) for b in range(a)]
    far = edit_distances([(sides[a], sides[b]) for a, b in pairs], [200] * len(pairs))
    for (a, b), distance in zip(pairs, far.tolist()):
        differ = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(bits[a], bits[b]))
        assert differ + abs(len(sides[a]) - len(sides[b])) <= 2 * distance


def test_edit_distances_are_exact_up_to_the_cap():
    random.seed(3)

    def plain(a, b):
        before = list(range(len(b) + 1))
        for i in range(1, len(a) + 1):
            row = [i]
            for k in range(1, len(b) + 1):
                row.append(min(before[k] + 1, row[-1] + 1, before[k - 1] + (a[i - 1] != b[k - 1])))
            before = row
        return before[-1]

    pairs, caps = [], []
    for _ in range(150):
        a = [random.randint(0, 20) for _ in range(random.randint(0, 90))]
        b = [x if random.random() > 0.15 else random.randint(0, 20) for x in a][random.randint(0, 4):]
        pairs.append((np.array(a, int), np.array(b, int)))
        caps.append(int(0.4 * max(len(a), len(b))))
    for (a, b), cap, got in zip(pairs, caps, edit_distances(pairs, caps)):
        want = plain(a.tolist(), b.tolist())
        assert got == (want if want <= cap else FAR)


NASTY = ["'", "'s", "'re", "'LL", " ", "  ", "\n", "\t", "a", "S", "é", "e", "́", "̧", "ß", "İ", "Σ", "1", "٣", "!", "...",
         "　", "\xa0", "😀", "中文", "\x1c", "\x85", "<|endoftext|>", "\r\n", "𝔸", "가", "ᄀ", "ᅡ", "word.", "end!?", "ᲊ"]


def test_bpe_on_nasty_texts():
    with open(RANKS, "rb") as f:
        content = f.read()
    own = bpe.Codec(content)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    random.seed(1)
    texts = ["".join(random.choices(NASTY, k=random.randint(0, 30))) for _ in range(3000)] + ["a" * 5000, "", " "]
    for text, ids in zip(texts, own.encode(texts)):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        flat, ends = own.decode(ids)
        assert flat == text.encode() and (not len(ends) or ends[-1] == len(flat))


def test_word_tokenizer_on_nasty_texts():
    with open(WORDS, "rb") as f:
        own = token_files.WordTokenizer(f.read())
    random.seed(2)
    texts = ["".join(random.choices(NASTY, k=random.randint(0, 30))) for _ in range(3000)]
    found = own.ids_of([t.encode() for t in texts], 1)
    for ids, want in zip(found, own.library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, own.kind).tolist() == [*want.ids, 1]
    library = Tokenizer.from_file(WORDS)
    assert np.frombuffer(own.ids_of([b"Plain text."], 1)[0], own.kind).tolist()[:-1] == library.encode("Plain text.").ids


def test_added_tokens_are_what_a_fresh_library_gives():
    with open(WORDS, "rb") as f:
        own = token_files.WordTokenizer(f.read())
    library = Tokenizer.from_file(WORDS)
    random.seed(4)
    parts = [*NASTY, "<|startoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|endof", "text|>", " hello ", "There."]
    texts = ["hello <|endoftext|> there", "<|ENDOFTEXT|>", "x<|endoftext|>.", "hello <|endoftext|> <|ENDOFTEXT|>"]
    texts += ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(3000)]
    for text, ids in zip(texts, own.ids_of([t.encode() for t in texts], 1)):
        assert np.frombuffer(ids, own.kind).tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("n,top", [(1, 1), (10, 3), (5000, 400), (60_000, 40_000)])
def test_codes_are_short_complete_and_reversible(n, top):
    ids = np.minimum(np.random.default_rng(0).pareto(0.5, n).astype(np.int64), top)
    lengths = token_files.code_lengths(np.bincount(ids)).astype(int)
    used = lengths[lengths > 0]
    assert used.max() <= 16 and sum(2 ** (16 - x) for x in used.tolist()) <= 2 ** 16
    book = token_files.Codebook(lengths)
    bits, checkpoints = book.encode(ids)
    assert all((out == ids).all() for out in book.decode([bits, bits], [checkpoints] * 2, [n, n]))


def test_limited_lengths_cost_the_least():
    """Against a search of all complete codes for six ids and at most four bits."""
    import itertools

    counts = np.array([1, 1, 2, 3, 20, 60])
    best = min(sum(c * x for c, x in zip(counts, code)) for code in itertools.product(range(1, 5), repeat=6)
               if sum(2.0 ** -x for x in code) <= 1)
    assert (counts * token_files.code_lengths(counts, 4)).sum() == best


def test_windows_in_small_blocks(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 90}" for k in range(60)), "en", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    seen, want = set(), {}
    for d, t, *_ in rows:
        words, gone = WORD.findall(t), set()
        for i in range(len(words) - 19):
            key = tuple(words[i:i + 20])
            if key in seen:
                gone.update(range(i, i + 20))
            seen.add(key)
        want[d] = " ".join(w for i, w in enumerate(words) if i not in gone)
    got = substring_dedup.repeated_windows_removed(docs, block_bytes=1500, bucket_windows=100).collect()
    assert {r.doc_id: r.kept_text for r in got} == want
    assert all(sum(s["last"] - s["first"] + 1 for s in r.removed) == r.n_removed for r in got)


def test_language_rules(spark):
    docs = awkward(spark)
    stats = language_id.frozen_statistics(docs)
    rows = {r.doc_id: r for r in language_id.identify_languages(docs, stats).collect()}
    assert all(rows[d].lang_pred == "und" and rows[d].score == 0 for d in (5, 6, 7, 8))
    kept = language_id.accepted_languages(docs, stats)
    assert kept.columns == docs.columns and not {5, 6, 7, 8} & {r.doc_id for r in kept.collect()}


def test_code_lengths_are_exact():
    """The tables give the sum of the step-by-step PPM code lengths."""
    import pyarrow as pa

    text = b"abracadabra abracadabra banana bandana"
    grams = language_id._count_grams(pa.table({"lang": ["x"], "text": [text.decode()]}))
    stats = {"languages": ["x"], "name": "t", "lang": np.zeros(grams.num_rows, np.int16),
             "k": grams.column("k").to_numpy(), "gram": grams.column("gram").to_numpy(), "n": grams.column("n").to_numpy()}
    counts = {}
    for k, gram, n in zip(stats["k"].tolist(), stats["gram"].tolist(), stats["n"].tolist()):
        body = gram.to_bytes(k + 1, "big")
        counts.setdefault(body[:-1], {})[body[-1]] = n
    kept = {c for c, after in counts.items() if len(c) < 2 or sum(after.values()) >= 4}

    def chance(context, byte):
        if context not in kept:
            return chance(context[1:], byte) if context else 1 / 256
        after = counts[context]
        total = sum(after.values()) + len(after)
        if byte in after:
            return after[byte] / total
        return len(after) / total * (chance(context[1:], byte) if context else 1 / 256)

    probe = b"a banana cabra zebra"
    body = language_id.GAP + probe
    want = -sum(np.log2(chance(body[i - 3:i], body[i])) for i in range(3, len(body)))
    got = language_id.ByteTrees(stats).code_lengths(probe, np.array([0, len(probe)]))[0, 0]
    assert abs(got - want) < 1e-3


def test_budgets_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("d1", "en", "a", 10), ("d1", "en", "b", 1000), ("d1", "fr", "c", 1000),
                                    ("d2", "en", "e", 1000)], "domain string, lang string, source string, supply long")
    got = {r.source: r.quota for r in mixing.leaf_budgets(leaves, {}, 0.2, 1).collect()}
    # 602 tokens: 301 a domain; in d1 150 a language; "a" gives its 10, "b" takes the shortage.
    assert got == {"a": 10, "b": 140, "c": 150, "e": 301}
    tight = leaves.withColumn("supply", leaves.supply * (leaves.domain == "d2").cast("long") + 10)
    got = {r.source: r.quota for r in mixing.leaf_budgets(tight, {}, 0.5, 1).collect()}
    assert (got["a"], got["b"], got["c"]) == (10, 10, 10) and got["e"] == 520 - 30


def test_mixture_takes_prefixes_of_epochs(spark):
    rows = [(i, "w " * 10, "en", "src0", 1) for i in range(50)] + [(100 + i, "w " * 10, "en", "src4", 1) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.mix_to_weights(docs, {"source": {"src4": 1, "src0": 1}}, share=0.5, max_epochs=3).collect()
    # 275 of 550 tokens, 137 for each source: two whole epochs of the small one and a prefix.
    small = [r for r in mixed if r.doc_id >= 100]
    assert [sum(r.mix_epoch == e for r in small) for e in range(3)] == [5, 5, 4]
    big = [r for r in mixed if r.doc_id < 100]
    assert len(big) == 14 and len({r.doc_id for r in big}) == 14
    awk = mixing.mix_to_weights(awkward(spark), {}, share=1.0, max_epochs=1)
    assert awk.count() == len(ROWS) and set(awk.columns) >= set(awkward(spark).columns)


def test_quality_rules(spark):
    line = "read our terms and conditions before you use this page"
    own = [f"{' '.join(f'own{i}x{k}' for k in range(30))}\n{line.upper()}  " for i in range(30)]
    rows = [(i, t, "en", "h1", 1) for i, t in enumerate(own)] + [(50, line, "en", "h1", 1), (51, line, "en", "h2", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality.quality_verdicts(docs).collect()}
    assert all(got[i].kept and got[i].n_removed_words == 10 for i in range(30))
    assert not got[50].kept and not got[50].base_failed and got[51].kept
    frequent = quality.frequent_lines(quality._measured(docs, "doc_id", "source", "text"), 20, 0.005)
    cleaned = {r.doc_id: r.text for r in quality.without_frequent_lines(docs, frequent).collect()}
    assert cleaned[0] == own[0].split("\n")[0] and cleaned[50] == "" and cleaned[51] == line
    edge = {r.doc_id: r for r in quality.quality_verdicts(awkward(spark)).collect()}
    assert (edge[13].n_words, edge[13].n_repeat_words, edge[13].base_failed) == (12, 12, True)
    assert edge[16].n_dup_lines == 1 and edge[5].n_words == 0 and edge[10].n_words == len(WORD.findall(LONG))


def test_replies_follow_the_quotations(spark):
    rows = [
        (1, 0, "a", "Hello there\nHow are you?\n\nSecond paragraph."), (1, 1, "b", "> Hello there\n> How  are YOU?\nFine thanks"),
        (1, 2, "a", ">> Hello there\n>> How are you?\n> Fine thanks\ngreat"), (1, 3, "c", "> Second paragraph.\nno idea"),
        (1, 4, "c", "> never said\nhm"), (1, 5, "d", None), (1, 6, "e", "> great\n> no idea\nboth"),
        (None, 0, "d", "x"), (None, 1, "d", "> x\ny"), (2, 1, "a", "> Hello there\nz"), (2, None, "a", "> z"), (2, 1, "a", "> z\nz"),
    ]
    got = quotations.reply_ordered(spark.createDataFrame(rows, MESSAGES)).collect()
    assert len(got) == len(rows)
    one = {r.turn: r for r in got if r.conv_id == 1}
    assert {t: (r.parent, r.root, r.depth) for t, r in one.items()} == {
        0: (None, 0, 0), 1: (0, 0, 1), 2: (1, 0, 2), 3: (0, 0, 1), 4: (None, 4, 0), 5: (None, 5, 0), 6: (2, 0, 3)}
    assert one[2].reply_text == "great" and (one[2].n_quotes, one[2].n_linked) == (2, 2) and one[4].n_linked == 0
    assert {(r.turn, r.parent) for r in got if r.conv_id is None} == {(0, None), (1, 0)}
    assert all(r.parent is None for r in got if r.conv_id == 2)
    assert quotations.reply_ordered(spark.createDataFrame([], MESSAGES)).count() == 0


def test_shards_of_awkward_rows(spark):
    rows = sharding.interleaved_shards(awkward(spark), shards=4).collect()
    counts = [sum(r.shard == s for r in rows) for s in range(4)]
    assert max(counts) - min(counts) <= 1 and all(r.law == "rows" and r.grown_shard is None for r in rows)
    again = sharding.interleaved_shards(awkward(spark).repartition(5), shards=4).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_long_texts_are_encoded_part_by_part(monkeypatch):
    """Cut between a letter or digit and a blank, the parts encode to what the whole does."""
    monkeypatch.setattr(bpe, "PART_LENGTH", 40)
    with open(RANKS, "rb") as f:
        codec = bpe.Codec(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    random.seed(8)
    for _ in range(200):
        text = "".join(random.choice("ab1 '  \n\té,.s中  ") for _ in range(300))
        assert "".join(bpe.parts_of(text)) == text
        assert np.frombuffer(codec.encode([text, "x"])[0], "<u4").tolist() == library.encode_ordinary(text)
    assert len(bpe.parts_of("word " * 100)) > 5 and bpe.parts_of("x" * 100) == ["x" * 100]
