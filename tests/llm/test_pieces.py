"""SentencePiece through distinct chunks, against the library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from tallyspark.llm import pieces
from tallyspark.llm.queries import QUERIES
from tests.llm.data import ROWS, awkward, empty, read
from tests.llm.test_queries import FOLDER

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def digests(library, text):
    ids = library.encode(text or "", add_eos=True)
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_query_is_what_the_library_gives(spark, library):
    want = {r.doc_id: digests(library, r.text) for r in read(spark, FOLDER).collect()}
    rows = QUERIES["op11_distinct_chunk_pieces"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def test_awkward_and_empty_documents(spark, library):
    rows = pieces.round_trip(awkward(spark), MODEL).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(
        (str(d), *digests(library, t)) for d, t, *_ in ROWS)
    assert pieces.round_trip(empty(spark), MODEL).count() == 0
    decoded = pieces.decode_documents(pieces.encode_documents(awkward(spark), MODEL), MODEL).collect()
    assert sorted((str(r.doc_id), r.text) for r in decoded) == sorted((str(d), t or "") for d, t, *_ in ROWS)
    assert {tuple(np.frombuffer(r.ids, "<u4")) for r in decoded if r.doc_id == 5} == {(library.eos_id(),)}


def test_any_run_of_blanks_and_markers(library):
    random.seed(3)
    texts = ["".join(random.choice(" ▁ab\nc  ▁ é😀\x00\tth<s>1") for _ in range(random.randrange(20))) for _ in range(5000)]
    table = pieces.ChunkTable(open(MODEL, "rb").read(), limit=20_000)
    for start in range(0, len(texts), 500):
        part = texts[start:start + 500]
        ids = table.encode(part)
        assert [i.tolist() for i in ids] == library.encode(part, add_eos=True)
        assert table.decode(ids) == library.decode(library.encode(part, add_eos=True))
        assert "".join(f" {c}" for t in part[:50] for c in pieces.chunks_of(t)) == "".join(
            f" {t}".replace("▁", " ") for t in part[:50] if t)


def test_each_distinct_chunk_is_segmented_once(library, monkeypatch):
    table, asked = pieces.ChunkTable(open(MODEL, "rb").read()), []
    learn = table._learn
    monkeypatch.setattr(table, "_learn", lambda missing: (asked.extend(missing), learn(missing)))
    table.encode(["one two one", "two  one"])
    table.encode(["one three two"])
    assert sorted(asked) == [" one", "one", "three", "two"]


@pytest.mark.parametrize("change", [
    lambda m: m.pieces.add(piece="a▁b", score=-1.0), lambda m: setattr(m.normalizer_spec, "remove_extra_whitespaces", True)])
def test_models_that_cross_markers_are_refused(change):
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    change(model)
    with pytest.raises(ValueError):
        pieces.check_model(model.SerializeToString())
