"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation."""

import base64
import hashlib
import heapq
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.arrow import slices_of, utf8_of

# Character classes.  A space or blank that is the last before a visible character differs
# from one inside or at the end of a text; so does an apostrophe that opens a contraction.
LETTER, NUMBER, OTHER, BLANK, LAST_BLANK, LAST_SPACE, QUOTE1, QUOTE2, END, PAD = range(10)
# States after a character: nothing open, or the kind of the open token; TAKE1 and TAKE2 have
# one or two letters of a contraction to come.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, AFTER_SPACE, TAKE1, TAKE2 = range(8)
STATES = 8

# White space of the pattern, and the contractions.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

# Ranges that Unicode 16 added, for a Python whose tables are older.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]

CACHED_BYTES = 160 << 20
ENTRY_BYTES = 220
CACHED_LENGTH = 48
PART_LENGTH = 1 << 20
BLOCK = 64


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
                        np.uint8, 0x110000)
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER)):
        for first, last in ranges:
            table[first:last + 1] = kind
    table[WHITE_SPACE] = BLANK
    return table


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, does the character start a token), by class and state."""
    step = np.zeros((10, STATES), np.uint8)
    starts = np.ones((10, STATES), bool)
    for kind, own in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS),
                      (QUOTE1, IN_OTHERS), (QUOTE2, IN_OTHERS), (BLANK, IN_BLANKS)):
        step[kind] = own
        starts[kind, own] = False
        if kind != BLANK:
            starts[kind, AFTER_SPACE] = False
    for kind, take in ((QUOTE1, TAKE1), (QUOTE2, TAKE2)):
        step[kind, [FRESH, IN_LETTERS, IN_NUMBERS, IN_BLANKS]] = take
    step[LETTER, TAKE2], step[LETTER, TAKE1] = TAKE1, FRESH
    starts[LETTER, [TAKE1, TAKE2]] = False
    step[LAST_BLANK] = step[END] = FRESH
    step[LAST_SPACE] = AFTER_SPACE
    step[PAD] = np.arange(STATES)
    return step.ravel(), starts.ravel()


STEP, STARTS = _machine()


def states_before(classes: np.ndarray) -> np.ndarray:
    """The state before each character, by a parallel scan over transition functions.

    A character is a function from state to state, and functions compose associatively: blocks
    of characters are composed side by side, the blocks' functions by doubling, and the states
    inside the blocks follow from the state at their start.
    """
    blocks = -(-len(classes) // BLOCK)
    padded = np.full(blocks * BLOCK, PAD, np.uint8)
    padded[:len(classes)] = classes
    rows = (padded.reshape(blocks, BLOCK).T * np.uint8(STATES)).astype(np.uint8)
    whole = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], blocks, axis=1)
    for row in rows:
        whole = STEP.take(row + whole)
    reach = 1
    while reach < blocks:
        joined = np.take_along_axis(whole[:, reach:], whole[:, :-reach], axis=0)
        whole = np.concatenate([whole[:, :reach], joined], axis=1)
        reach *= 2
    state = np.concatenate([[FRESH], whole[FRESH, :-1]]).astype(np.uint8)
    before = np.empty((BLOCK, blocks), np.uint8)
    for i, row in enumerate(rows):
        before[i] = state
        state = STEP.take(row + state)
    return before.T.ravel()[:len(classes)]


def token_starts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks the characters that start a piece; ``ends`` are the places of text ends."""
    classes = _classes()[codes]
    classes[ends] = END
    after = np.append(classes[1:], END)
    blank = classes == BLANK
    last = blank & (after != BLANK) & (after != END)
    one, two = np.append(codes[1:], 0), np.append(codes[2:], [0, 0])[:len(codes)]
    quote = (codes == 39) & (classes == OTHER)
    if quote.any():
        second, third = after == LETTER, np.append(after[1:], END) == LETTER
        for letters in CONTRACTIONS:
            hit = quote & second & (one == ord(letters[0]))
            if len(letters) == 2:
                hit &= third & (two == ord(letters[1]))
            classes[hit] = QUOTE1 if len(letters) == 1 else QUOTE2
    classes[last] = np.where(codes[last] == 32, LAST_SPACE, LAST_BLANK)
    return STARTS.take(states_before(classes) + classes * np.uint8(STATES))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: the adjacent pair of lowest rank is joined first, leftmost first."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    ends = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def pair(at):
        middle = ends[at]
        return ranks.get(piece[at:ends[middle]]) if middle < n else None

    heap = [(r, at) for at in range(n - 1) if (r := ranks.get(piece[at:at + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        rank, at = heapq.heappop(heap)
        if not alive[at] or pair(at) != rank:
            continue
        middle = ends[at]
        alive[middle] = False
        ends[at] = ends[middle]
        if ends[at] < n:
            before[ends[at]] = at
        for start in (at, before[at]):
            if start >= 0 and (r := pair(start)) is not None:
                heapq.heappush(heap, (r, start))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:ends[at]]])
        at = ends[at]
    return out


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def parts_of(text: str) -> list[str]:
    """Parts of a text of about ``PART_LENGTH`` characters.

    It is cut between a letter or digit and a blank: a piece never has a blank after another
    character, and no piece depends on what stands before it.
    """
    parts, start = [], 0
    while len(text) - start > PART_LENGTH:
        cut = text.find(" ", start + PART_LENGTH)
        while cut > 0 and not text[cut - 1].isalnum():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        parts.append(text[start:cut])
        start = cut
    return [*parts, text[start:]]


class Codec:
    """Ranks with the cache of pieces (encoding) and the flat vocabulary (decoding)."""

    def __init__(self, content: bytes):
        self.ranks = parse_ranks(content)
        self.cache: dict[str, bytes] = {}
        self.held = 0
        words = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            words[rank] = token
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(words), np.uint8)

    def ids_of(self, piece: str) -> bytes:
        ids = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
        if len(piece) <= CACHED_LENGTH:
            if self.held >= CACHED_BYTES:
                self.cache.clear()
                self.held = 0
            self.cache[piece] = ids
            self.held += ENTRY_BYTES + len(piece) + len(ids)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a long text part by
        part, so that the scan's arrays stay small."""
        if all(len(t) <= PART_LENGTH for t in texts):
            return self._encode(texts)
        found = []
        for text in texts:
            found.append(b"".join(self._encode([part])[0] for part in parts_of(text)))
        return found

    def _encode(self, texts: list[str]) -> list[bytes]:
        joined = "\n".join([*texts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64)) - 1
        starts = np.flatnonzero(token_starts(codes, ends))
        known, own = self.cache.get, self.ids_of
        # Ends of texts are pieces of their own; they are skipped when a text is put together.
        firsts = np.searchsorted(starts, np.concatenate([[0], ends[:-1] + 1])).tolist()
        lasts = np.searchsorted(starts, ends).tolist()
        places = [*starts.tolist(), len(joined)]
        pieces = [joined[a:b] for a, b in zip(places, places[1:])]
        return [b"".join([known(p) or own(p) for p in pieces[a:b]]) for a, b in zip(firsts, lasts)]

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids end to end, and the offset at which each id's bytes end."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.places[ids] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))].tobytes(), ends


def encode_documents(docs: DataFrame, rank_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every document: ids as little-endian unsigned 32-bit integers.

    Piece boundaries come from character classes and a scan over transition functions, not
    from a regular expression; each piece is merged once and cached (short pieces only, 160 MB,
    for the length of a task).  The rank file is read by the driver and broadcast: it is a vocabulary of fixed
    size.  Tasks hold a few MB of text at a time, or one text if that is longer.

    Defined results: NULL counts as the empty text, which has no ids; every row gives a row,
    whatever its id; an empty table gives an empty result; extra columns are ignored.
    """
    with open(rank_file, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(batches):
        codec = Codec(content.value)
        for batch in batches:
            for part in slices_of(batch, "text", 2 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(codec.encode(texts), pa.binary())],
                    names=["doc_id", "ids"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, rank_file: str) -> DataFrame:
    """(doc_id, ids, bytes, ends): the bytes of the ids, and where each id's bytes end in them
    (little-endian unsigned 32-bit integers), so that a token leads back to its place."""
    with open(rank_file, "rb") as f:
        content = encoded.sparkSession.sparkContext.broadcast(f.read())

    def work(batches):
        codec = Codec(content.value)
        for batch in batches:
            for part in slices_of(batch, "ids", 4 << 20):
                data, at = utf8_of(part.column("ids"))
                flat, ends = codec.decode(np.frombuffer(data, "<u4"))
                tokens = at // 4
                edge = np.concatenate([[0], ends])[tokens]
                texts = [flat[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
                offsets = [(ends[a:b] - e).astype("<u4").tobytes()
                           for a, b, e in zip(tokens[:-1].tolist(), tokens[1:].tolist(), edge.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.binary()),
                     pa.array(offsets, pa.binary())], names=["doc_id", "ids", "bytes", "ends"])

    return encoded.select("doc_id", "ids").mapInArrow(
        work, "doc_id long, ids binary, bytes binary, ends binary")


def round_trip(docs: DataFrame, rank_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): the ids of each document, and the
    digests of the ids and of the bytes decoded from them, in one pass.

    Defined results are those of ``encode_documents``.
    """
    with open(rank_file, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def digest(data):
        return hashlib.sha256(data).hexdigest()

    def work(batches):
        codec = Codec(content.value)
        for batch in batches:
            for part in slices_of(batch, "text", 2 << 20):
                ids = codec.encode([t or "" for t in part.column("text").to_pylist()])
                flat, ends = codec.decode(np.frombuffer(b"".join(ids), "<u4"))
                counts = np.array([len(i) // 4 for i in ids], np.int64)
                edge = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts), pa.array(ids, pa.binary()),
                     pa.array([digest(i) for i in ids], pa.string()),
                     pa.array([digest(flat[a:b]) for a, b in zip(edge, edge[1:])], pa.string())],
                    names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string")
