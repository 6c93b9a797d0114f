"""SentencePiece encoding and decoding through a table of distinct chunks."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.arrow import slices_of, utf8_of

MARKER = "▁"
CHUNK = re.compile(" +[^ ]*")
SLICE_BYTES = 4 << 20
TABLE_BYTES = 64 << 20
ENTRY_BYTES = 200

ENCODED = "doc_id long, ids binary"
DECODED = "doc_id long, ids binary, text string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def check_model(content: bytes) -> None:
    """Refuses a model whose pieces could reach over a white space marker.

    Text may be cut before every run of markers only if no piece has a marker after another
    character, and if normalisation leaves all characters but the marker as they are.
    """
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(content)
    spec, trainer = proto.normalizer_spec, proto.trainer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix \
            or not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix:
        raise ValueError("the model's normaliser changes more than white space markers")
    library = SentencePieceProcessor(model_proto=content)
    across = re.compile(f"[^{MARKER}]{MARKER}")
    for i in range(library.vocab_size()):
        if across.search(library.id_to_piece(i)):
            raise ValueError(f"piece {i} crosses a white space marker")
    if library.eos_id() < 0:
        raise ValueError("the model has no end id")


def chunks_of(text: str) -> list[str]:
    """The marked words of a text, each without its first marker.

    A text is read as a marker and itself, blanks as markers; a chunk is a run of markers and
    what follows up to the next marker.  Put end to end, the chunks are the text.
    """
    if not text:
        return []
    text = text.replace(MARKER, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [chunk[1:] for chunk in CHUNK.findall(" " + text)]


class ChunkTable:
    """Distinct chunks with the ids of each, for the length of a task.

    Every distinct chunk is segmented once by the library and stays until the table holds
    ``limit`` bytes; then a new one is begun.
    """

    def __init__(self, content: bytes, limit: int = TABLE_BYTES):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=content)
        size = self.library.vocab_size()
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.end = np.array([self.library.eos_id()], self.kind).tobytes()
        self.limit, self.held = limit, 0
        self.rows: dict[str, bytes] = {}
        self.names = [str(i) for i in range(size)]

    def _learn(self, missing: set[str]) -> None:
        # The library begins every text with a marker, which puts the first one back.  The empty
        # chunk is that marker alone; an empty text would have no marker.
        chunks = [c for c in missing if c]
        found = dict(zip(chunks, self.library.encode(chunks, num_threads=1)))
        if "" in missing:
            found[""] = [self.library.piece_to_id(MARKER)]
        for chunk, ids in found.items():
            self.rows[chunk] = np.array(ids, self.kind).tobytes()
            self.held += ENTRY_BYTES + len(chunk) + len(self.rows[chunk])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text with the end id: the chunks' ids, joined by position."""
        split = [chunks_of(t) for t in texts]
        if self.held > self.limit:
            self.rows, self.held = {}, 0
        missing = set().union(*split).difference(self.rows)
        if missing:
            self._learn(missing)
        known = self.rows.__getitem__
        return [np.frombuffer(b"".join([*map(known, words), self.end]), self.kind) for words in split]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.library.decode([i.tolist() for i in ids])


def _texts(column) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _model(docs: DataFrame, model_file: str):
    """The model file, checked and broadcast: a vocabulary of fixed size."""
    with open(model_file, "rb") as f:
        content = f.read()
    check_model(content)
    return docs.sparkSession.sparkContext.broadcast(content)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))


def encode_documents(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every document: ids with the end id, little-endian unsigned 32 bits.

    A task cuts its texts into marked words, segments each distinct one once and joins the ids
    back by position.  Nothing is shuffled; a task holds 4 MB of text (or one longer text) and
    a table of at most 64 MB and one slice's chunks.

    Defined results: NULL counts as the empty text, which has the end id alone; every row gives
    a row, whatever its id; an empty table gives an empty result; extra columns are ignored; a
    model whose pieces may cross white space markers is refused.
    """
    content = _model(docs, model_file)

    def work(batches):
        table = ChunkTable(content.value)
        for batch in batches:
            for part in slices_of(batch, "text", SLICE_BYTES):
                found = [i.astype("<u4").tobytes() for i in table.encode(_texts(part.column("text")))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.binary())],
                                                 names=["doc_id", "ids"])

    return _rows(docs, key, text).mapInArrow(work, ENCODED)


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids, text) from (doc_id, ids): what the library decodes the ids to."""
    content = _model(encoded, model_file)

    def work(batches):
        table = ChunkTable(content.value)
        for batch in batches:
            for part in slices_of(batch, "ids", SLICE_BYTES):
                data, at = utf8_of(part.column("ids"))
                ids = [np.frombuffer(data[a:b], "<u4") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(table.decode(ids), pa.string())],
                    names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(work, DECODED)


def round_trip(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each document encoded and decoded in one
    pass, with digests of its decimal ids (joined by one blank) and of the decoded text.

    Defined results are those of ``encode_documents``.
    """
    content = _model(docs, model_file)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def work(batches):
        table = ChunkTable(content.value)
        name = table.names.__getitem__
        for batch in batches:
            for part in slices_of(batch, "text", SLICE_BYTES):
                ids = table.encode(_texts(part.column("text")))
                columns = [[len(i) for i in ids], [digest(" ".join(map(name, i.tolist()))) for i in ids],
                           [digest(t) for t in table.decode(ids)]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                     pa.array(columns[2], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs, key, text).mapInArrow(work, DIGESTS)
