"""Words of many texts at once, as 64-bit hashes in numpy.

A word's hash depends on its bytes alone: polynomial over a random value per byte, by prefix
sums (wrapping at 2**64), then a finaliser. Different words of one corpus meet with a
chance of about 2**-64 per compared pair.
"""

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Rows and bytes of one Arrow batch at most; a longer row is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20

U64 = np.uint64
# Text is hashed in pieces of about this many bytes, cut between words, so that memory does
# not follow the length of a text.
PIECE_BYTES = 1 << 18


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes: whole texts and
    postings are wide, and a batch is held several times between the JVM and its Python worker. The settings
    stay, since frames are evaluated later."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Return what this process has freed to the system.

    Idle Python workers stay beside the executor and are taken in turn, so what one batch needed at most would be held by
    all of them until the session ends. Where the C library has no ``malloc_trim``, Arrow's pool alone shrinks.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A Python step on batches that gives back its memory after each batch, and after the last one."""

    @functools.wraps(step)
    def run(batches):
        for out in step(batches):
            yield out
            del out
            give_back()
        give_back()

    return run


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection for each salt)."""
    x = x + U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _table(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


#: Words between ASCII white space.
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words of digits, letters and everything beyond ASCII.
ALPHANUMERIC = _table(lambda b: b >= 0x80 or chr(b).isalnum())
#: A-Z to lower case, all else as it is.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_BYTE = mix(np.arange(256, dtype=U64), 1)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
_powers = {}


def _power(base: int, size: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, PIECE_BYTES + 1), base, dtype=U64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=U64)
        if len(known) <= 4 * PIECE_BYTES:
            _powers[base] = known
    return known[:size]


def spans(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in a byte array."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = table[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _hash_piece(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end = spans(data, table)
    if not len(start):
        return start.astype(U64), start
    total = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=total[1:])
    return mix((total[end] - total[start]) * _power(_INVERSE, len(data))[start]), start


def _pieces(docs: list[bytes], table: np.ndarray) -> Iterator[tuple[bytes, list[int]]]:
    """Joined texts with the number of each text's bytes in the piece; long texts are cut
    between words (a word is never cut)."""
    parts, sizes, size = [], [], 0
    separators = bytes(b for b in range(128) if not table[b])
    for doc in docs:
        if size and size + len(doc) > PIECE_BYTES:
            yield b" ".join([*parts, b""]), sizes
            parts, sizes, size = [], [], 0
        at = 0
        while len(doc) - at > 2 * PIECE_BYTES:
            cut = at + PIECE_BYTES
            while cut < len(doc) and doc[cut] not in separators:
                cut += 1
            if cut >= len(doc):
                break
            yield doc[at:cut] + b" ", [cut - at + 1, -1]
            at = cut
        parts.append(doc[at:] if at else doc)
        sizes.append(len(doc) - at + 1)
        size += len(doc) - at + 1
    if parts:
        yield b" ".join([*parts, b""]), sizes


def hash_words(
    docs: list[bytes], table: np.ndarray, lower: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the index of each text's first word (one more at
    the end)."""
    hashes, counts, open_count = [], [], 0
    for joined, sizes in _pieces(docs, table):
        data = np.frombuffer(joined, dtype=np.uint8)
        if lower:
            data = LOWER[data]
        found, start = _hash_piece(data, table)
        hashes.append(found)
        if sizes[-1] == -1:  # the text goes on in the next piece
            open_count += len(found)
            continue
        border = np.searchsorted(start, np.cumsum(sizes))
        per_text = np.diff(border, prepend=0)
        per_text[0] += open_count
        open_count = 0
        counts.append(per_text)
    first = np.zeros(len(docs) + 1, dtype=np.int64)
    if counts:
        np.cumsum(np.concatenate(counts), out=first[1:])
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=U64)), first


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes (runs over text ends included)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    total = np.zeros(n, dtype=U64)
    factor = 1
    for j in range(width):
        factor = factor * 0x2545F4914F6CDD1D % 2**64
        total += hashes[j : j + n] * U64(factor)
    return mix(total, width)


def shingle_sets(docs: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of each text: hashes, and first index per text.

    Words lie between ASCII white space, A-Z in lower case. A text of fewer words has its
    whole sequence as one shingle; a text without words has none.
    """
    words, first = hash_words(docs, SPACED, lower=True)
    runs = combine(words, width)
    sets = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - begin >= width:
            sets.append(np.unique(runs[begin : end - width + 1]))
        elif end > begin:
            sets.append(combine(words[begin:end], end - begin))
        else:
            sets.append(np.zeros(0, dtype=U64))
    starts = np.zeros(len(docs) + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=starts[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, dtype=U64)), starts


class MinHash:
    """Least values of ``size`` universal hash functions over each set of hashes."""

    def __init__(self, size: int):
        seed = mix(np.arange(2 * size, dtype=U64), 7)
        self.factors = seed[:size] | U64(1)
        self.shifts = seed[size:]

    def signatures(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row per set; an empty set has the largest value everywhere."""
        sets, size = len(starts) - 1, len(self.factors)
        out = np.full((sets, size), U64(2**64 - 1))
        full = np.flatnonzero(np.diff(starts))
        begin = 0
        while begin < len(full):
            # sets of about 2**16 hashes together, so that the work stays in the cache
            until = np.searchsorted(starts[full], starts[full[begin]] + (1 << 16), "left")
            until = max(int(until), begin + 1)
            chosen = full[begin:until]
            low, high = starts[chosen[0]], starts[chosen[-1] + 1]
            part, offsets = hashes[low:high], starts[chosen] - low
            for j, (factor, shift) in enumerate(zip(self.factors, self.shifts)):
                out[chosen, j] = np.minimum.reduceat(part * factor + shift, offsets)
            begin = until
        return out
