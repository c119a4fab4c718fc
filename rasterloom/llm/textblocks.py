"""Blocks of documents as one byte buffer, and their words as arrays of 64-bit hashes.

Words are found and hashed for a whole block at once: a byte's term is a random 64-bit value (equal for both cases
of a letter) times a random odd multiplier of its place in the word, and prefix sums give each word's sum. The
multipliers are unrelated to each other, so regular words (runs, Thue-Morse sequences) do not cancel as they do under
powers of one base. Python never loops over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once, few enough for the processor's cache; longer texts are cut between words.
PIECE = 1 << 17
BLOCK_BYTES = 8 << 20

_MASK = (1 << 64) - 1

#: `[^\x20\x09-\x0D]+`
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[0x30:0x3A] = False
PUNCTUATION[0x41:0x5B] = False
PUNCTUATION[0x61:0x7B] = False
PUNCTUATION[0x80:] = False

FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20

_cache: dict = {}


def _terms(fold: bool = True) -> np.ndarray:
    """The value of each byte; fold: the same for both cases of a letter."""
    if fold not in _cache:
        exact = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        _cache[True], _cache[False] = exact[FOLD], exact
    return _cache[fold]


def _multipliers(most: int) -> np.ndarray:
    """The multipliers of at least the first `most` places in a word; the table grows with the longest word met."""
    have = _cache.get("places")
    if have is None or len(have) < most:
        size = 1 << max(12, (most - 1).bit_length())
        have = _cache["places"] = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the pair (a, b), of arrays or scalars; the order counts."""
    return mix(a * np.uint64(0x9FB21C651E98DF25) + b)


class Block:
    """Some documents: other columns as lists, the texts as one buffer. offsets: n + 1 places in it."""

    def __init__(self, columns: dict[str, list], buffer: np.ndarray, offsets: np.ndarray, null: np.ndarray):
        self.columns, self.buffer, self.offsets, self.null = columns, buffer, offsets, null

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.buffer[self.offsets[i] : self.offsets[i + 1]].tobytes()


def _columns(batch: pa.RecordBatch, text: str) -> tuple[pa.Array, np.ndarray]:
    col = batch.column(batch.schema.get_field_index(text))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    null = np.asarray(col.is_null())
    return col.cast(pa.large_binary()).fill_null(b""), null


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of about `most` bytes of text, at least a document each; null texts count as empty."""
    held: list[tuple[pa.RecordBatch, pa.Array, np.ndarray]] = []
    size = 0

    def close() -> Block:
        rest = {n: [v for b, _, _ in held for v in b.column(i).to_pylist()] for i, n in enumerate(held[0][0].schema.names) if n != text}
        arrays = [np.frombuffer(a.buffers()[2] or b"", np.uint8)[_offsets(a)[0] : _offsets(a)[-1]] for _, a, _ in held]
        ends = []
        base = 0
        for _, a, _ in held:
            o = _offsets(a)
            ends.append(o[1:] - o[0] + base)
            base += int(o[-1] - o[0])
        return Block(rest, np.concatenate(arrays), np.concatenate([[0], *ends]).astype(np.int64), np.concatenate([n for _, _, n in held]))

    for batch in batches:
        if not batch.num_rows:
            continue
        col, null = _columns(batch, text)
        ends = np.cumsum(np.diff(_offsets(col)))
        at = 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            upto = int(np.searchsorted(ends, before + max(1, most - size), "left")) + 1
            upto = min(upto, len(ends))
            held.append((batch.slice(at, upto - at), col.slice(at, upto - at), null[at:upto]))
            size += int(ends[upto - 1]) - before
            at = upto
            if size >= most:
                yield close()
                held, size = [], 0
    if held:
        yield close()
        held = []
    release()


def release() -> None:
    """Gives freed memory back to the system: Python workers live on, and what one stage freed would count in the next."""
    pa.default_memory_pool().release_unused()
    if "trim" not in _cache:
        try:
            _cache["trim"] = ctypes.CDLL(None).malloc_trim
        except (OSError, AttributeError):  # another C library
            _cache["trim"] = lambda _: 0
    _cache["trim"](0)


def _offsets(a: pa.Array) -> np.ndarray:
    return np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)


def spans(block: Block, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """starts and ends (places in the buffer) of all words."""
    buf, offsets = block.buffer, block.offsets
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separators[buf]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    return np.flatnonzero(inside & (~before | first[:n])), np.flatnonzero(inside & (~after | first[1:])) + 1


def words(block: Block, separators: np.ndarray = SPACE, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """starts, ends and hashes of all words, and for each document where its words begin (n + 1). fold: A-Z count as a-z."""
    starts, ends = spans(block, separators)
    return starts, ends, hash_spans(block.buffer, starts, ends, fold), np.searchsorted(starts, block.offsets).astype(np.int64)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """The hashes of spans of the buffer, in ascending order of place and without overlaps; as `words` gives to words."""
    table = _terms(fold)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        upto = int(np.searchsorted(ends, low + PIECE, "right"))
        if upto == at:  # longer than a piece
            hashes[at] = _long_word(buf[low : int(ends[at])], table)
            at += 1
            continue
        s, e = starts[at:upto] - low, ends[at:upto] - low
        high = int(e[-1])
        # places count from the word's begin on; what follows a word up to the next one falls out of the differences
        place = np.ones(high, np.int64)
        place[0] = 0
        place[s[1:]] -= np.diff(s)
        np.cumsum(place, out=place)
        terms = np.take(table, buf[low : low + high], mode="clip")
        terms *= np.take(_multipliers(PIECE), place, mode="clip")
        sums = np.zeros(high + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        hashes[at:upto] = sums[e] - sums[s]
        at = upto
    return mix(hashes + (ends - starts).astype(np.uint64))


def _long_word(piece: np.ndarray, table: np.ndarray) -> np.uint64:
    total = 0
    for k in range(0, len(piece), PIECE):
        part = piece[k : k + PIECE]
        places = mix(np.arange(k + 1, k + len(part) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        total += int(np.sum(table[part] * places, dtype=np.uint64))
    return np.uint64(total & _MASK)


def hash_word(word: bytes) -> int:
    """The hash that `words` gives to one word."""
    b = Block({}, np.frombuffer(word, np.uint8), np.array([0, len(word)]), np.zeros(1, bool))
    return int(words(b, np.zeros(256, bool))[2][0])


def words_of(texts: list[bytes], separators: np.ndarray = SPACE) -> list[np.ndarray]:
    """The word hashes of each of a few texts."""
    offsets = np.cumsum([0, *map(len, texts)])
    b = Block({}, np.frombuffer(b"".join(texts), np.uint8), offsets, np.zeros(len(texts), bool))
    _, _, h, at = words(b, separators)
    return [h[at[i] : at[i + 1]] for i in range(len(texts))]
