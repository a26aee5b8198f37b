"""N-gram language model in a memory-mapped Elias-Fano trie.

Level 1 holds the training words: the sorted 64-bit hashes of all words, so that
a word's number is its place, and their exact counts.  Level n holds n-grams seen
at least MIN_COUNT times (once: all of them) as successors (word numbers) of a context (a node of
level n - 1).  Successors are stored one context after the other, each counted
from the last number of the context before, so that they rise throughout and one
Elias-Fano sequence holds them; contexts and the pointers to their successors
rise too.  A query adds a word number to the base of its context and searches the
sequence there.  Probabilities (absolute discounting) and the mass that a
context leaves to shorter ones are quantised to a byte each.

A level is cut into shards by a hash of the context and a range of words, so a
frequent context is spread.  Tasks count n-grams of their documents in numpy and
send each shard its part as one sorted block; a shard's task adds the blocks up
and writes its file, whole and by renaming.  The driver sees one row of numbers
per shard.  Scoring tasks map the files.

Defined results: a NULL or empty text has only the end token; NULL ids are in
the training fold; repeated rows count as often as they occur; with no training
text every probability is the base's; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocframe.llm.common import map_file, mix64, new_folder, write_file
from assocframe.llm.eliasfano import EliasFano
from assocframe.plans.materialize import materialize

ORDER = 3
MIN_COUNT = 1
DISCOUNT = 0.75
#: Words of so many consecutive numbers of one context share a shard.
WORD_RANGE = 1 << 20
#: Texts of about so many characters are counted or scored at once, and so many counts held by a task before it adds them up.
CHARS_AT_ONCE = 6 << 20
HELD = 5 << 19
#: Not a word, as it is white space.
END = b"\n"

_STEPS = 8.0  # quantised probabilities: code c is 2 ** (-c / _STEPS)


# Counting -------------------------------------------------------------------------


def add_up(context: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with their summed counts."""
    if not len(word):
        return context, word, count
    low, own = (int(x.max()).bit_length() for x in (word, count))
    bits = int(context.max()).bit_length() + low
    if bits > 64:
        order = np.lexsort((word, context))
        context, word, count = context[order], word[order], count[order]
        first = np.flatnonzero(_changes(context) | _changes(word))
        return context[first], word[first], np.add.reduceat(count, first)
    key = context.astype(np.uint64) << np.uint64(low) | word.astype(np.uint64)
    if own == 1:
        key.sort()
        first = np.flatnonzero(_changes(key))
        count = np.diff(np.append(first, len(key)))
    else:
        # Numbers are sorted several times faster than their places, so a count goes along in the same number.
        if bits + own <= 64:
            key = key << np.uint64(own) | count.astype(np.uint64)
            key.sort()
            count = (key & np.uint64((1 << own) - 1)).astype(np.int64)
            key >>= np.uint64(own)
        else:
            order = np.argsort(key, kind="stable")
            key, count = key[order], count[order]
        first = np.flatnonzero(_changes(key))
        count = np.add.reduceat(count, first)
    key = key[first]
    return (key >> np.uint64(low)).astype(np.int64), (key & np.uint64((1 << low) - 1)).astype(np.int64), count


def _changes(x: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before; the first does."""
    out = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def order_of(key: np.ndarray, bits: int) -> np.ndarray:
    """Places that sort unsigned numbers below 2 ** ``bits``.

    Numbers are sorted several times faster than places, so a place goes along in
    the lowest bits; where that hides bits that decide, places are sorted.
    """
    width = max(1, len(key).bit_length())
    mask = np.uint64((1 << width) - 1)
    both = key << np.uint64(64 - bits) & ~mask | np.arange(len(key), dtype=np.uint64)
    both.sort()
    order = (both & mask).astype(np.int64)
    if bits + width > 64:
        there = key[order]
        if (there[1:] < there[:-1]).any():
            return np.argsort(key, kind="stable")
    return order


#: Words of so many bytes are hashed one by one.
_LONG = 32
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_FOUR_BYTES, _BYTE = np.uint64(0xFFFFFFFF), np.uint64(0xFF)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def word_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of parts of ``data``, of all shorter than ``_LONG`` at once."""
    # The eight bytes from each place on.
    eights = np.ndarray(len(data), "<u8", np.append(data, np.zeros(8, dtype=np.uint8)), strides=(1,))
    out = size.astype(np.uint64) + _P5
    short = size < _LONG
    for at in range(0, _LONG - 8, 8):
        rows = np.flatnonzero(short & (size >= at + 8))
        part = _turned(eights[start[rows] + at] * _P2, 31) * _P1
        out[rows] = _turned(out[rows] ^ part, 27) * _P1 + _P4
    rest = size & 7
    rows = np.flatnonzero(short & (rest >= 4))
    part = (eights[start[rows] + (size[rows] & ~7)] & _FOUR_BYTES) * _P1
    out[rows] = _turned(out[rows] ^ part, 23) * _P2 + _P3
    for i in range(3):
        rows = np.flatnonzero(short & (rest & 3 > i))
        part = (eights[start[rows] + (size[rows] & ~3) + i] & _BYTE) * _P5
        out[rows] = _turned(out[rows] ^ part, 11) * _P1
    out = (out ^ out >> np.uint64(33)) * _P2
    out = (out ^ out >> np.uint64(29)) * _P3
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(~short):
        out[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + size[i]])
    return out


_END_HASH = np.uint64(xxhash.xxh64_intdigest(END))


class Tokens:
    """The tokens of some texts: words and one end each, as places in the list of the distinct ones, which rise by hash."""

    def __init__(self, texts: pa.Array) -> None:
        found = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        words = found.values
        _, offsets, data = words.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64 if pa.types.is_large_string(words.type) else np.int32)
        bounds = bounds[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, dtype=np.int64)
        length = np.diff(bounds)
        # White space at the ends of a text leaves empty strings.
        kept = length > 0
        upto = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])
        sizes = np.diff(upto[found.offsets.to_numpy()]) + 1
        self.sizes = sizes
        self.starts = np.cumsum(sizes) - sizes
        hashes = np.full(int(upto[-1]) + len(sizes), _END_HASH)
        is_word = np.ones(len(hashes), dtype=bool)
        is_word[self.starts + sizes - 1] = False
        if upto[-1]:
            hashes[is_word] = word_hashes(np.frombuffer(data, dtype=np.uint8), bounds[:-1][kept], length[kept])
        order = order_of(hashes, 64)
        rising = hashes[order]
        new = _changes(rising)
        self.hashes = rising[new]
        self.places = np.empty(len(order), dtype=np.int64)
        self.places[order] = np.cumsum(new) - 1
        self.end = int(np.searchsorted(self.hashes, _END_HASH))

    def before(self) -> np.ndarray:
        """The token before each one; the first of a text follows an end."""
        out = np.empty_like(self.places)
        out[1:] = self.places[:-1]
        out[self.starts] = self.end
        return out


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of batches of about CHARS_AT_ONCE, with their texts."""
    for batch in batches:
        start = size = 0
        for i, length in enumerate(pc.utf8_length(batch.column(column)).fill_null(0).to_pylist()):
            size += length
            if size >= CHARS_AT_ONCE or i + 1 == batch.num_rows:
                part = batch.slice(start, i + 1 - start)
                yield part, part.column(column)
                start, size = i + 1, 0


_BLOCKS = pa.schema([("shard", pa.int64()), ("block", pa.binary())])


def _blocks(summed: tuple, shard_of) -> Iterator[pa.RecordBatch]:
    """Counts of distinct pairs in order as one block per shard: steps of contexts, words and counts behind each other, by places of bytes, compressed."""
    context, word, count = summed
    for s, rows in _by_shard(shard_of(context, word)):
        numbers = np.concatenate([np.diff(context[rows], prepend=0), word[rows], count[rows]])
        wide = int(numbers.max()) >= 1 << 32
        narrower = numbers.astype(np.uint64 if wide else np.uint32)
        planes = b"".join((narrower >> narrower.dtype.type(8 * i)).astype(np.uint8).tobytes() for i in range(8 if wide else 4))
        block = zstandard.compress(planes, 1) + bytes([wide])
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([block], pa.binary())], schema=_BLOCKS)


def _shard_counts(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = []
    for b in frame["block"]:
        planes = np.frombuffer(zstandard.decompress(b[:-1]), dtype=np.uint8).reshape(8 if b[-1] else 4, -1)
        numbers = np.zeros(planes.shape[1], dtype=np.uint64 if b[-1] else np.uint32)
        for i, plane in enumerate(planes):
            numbers |= plane.astype(numbers.dtype) << numbers.dtype.type(8 * i)
        numbers = numbers.astype(np.int64).reshape(3, -1)
        numbers[0] = np.cumsum(numbers[0])
        parts.append(numbers)
    return add_up(*np.concatenate(parts, axis=1))


# Levels ---------------------------------------------------------------------------


def word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of level 1: a range of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def pair_shard(context: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a higher level: a hash of the context and the range of the word."""
    key = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (word // WORD_RANGE).astype(np.uint64)
    return (mix64(key) % np.uint64(shards)).astype(np.int64)


def _name(level: int, shard: int, kind: str) -> str:
    return f"level{level}-{shard:06d}.{kind}"


@dataclass(frozen=True)
class Level:
    """Where a level is: ``starts`` are the numbers of the first nodes of its shards, and their total."""

    folder: str
    level: int
    starts: np.ndarray

    @property
    def shards(self) -> int:
        return len(self.starts) - 1

    def shard_of_node(self, node: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, node, side="right") - 1

    def by_node(self, node: np.ndarray, kind: str, dtype: str) -> np.ndarray:
        """A value per node from plain files."""
        out = np.zeros(len(node), dtype=np.dtype(dtype).newbyteorder("="))
        for s, rows in _by_shard(self.shard_of_node(node)):
            data = _mapped(f"{self.folder}/{_name(self.level, s, kind)}").view(dtype)
            out[rows] = data[node[rows] - self.starts[s]]
        return out

    def counts(self, node: np.ndarray) -> np.ndarray:
        """The count of each node; a shard's file holds as many bytes a node as its largest count needs."""
        out = np.zeros(len(node), dtype=np.int64)
        for s, rows in _by_shard(self.shard_of_node(node)):
            data = _mapped(f"{self.folder}/{_name(self.level, s, 'counts')}")
            width = len(data) // int(self.starts[s + 1] - self.starts[s])
            out[rows] = data.view(f"<u{width}")[node[rows] - self.starts[s]]
        return out

    def find_words(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        for s, rows in _by_shard(word_shard(hashes, self.shards)):
            if self.starts[s] < self.starts[s + 1]:
                place = _sequences(f"{self.folder}/{_name(1, s, 'trie')}", 1)[0].find(hashes[rows])
                out[rows] = np.where(place >= 0, place + self.starts[s], -1)
        return out

    def find(self, context: np.ndarray, word: np.ndarray, kinds: Sequence[str] = ()) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Nodes of successors of contexts, or -1: a successor search relative to the context's base; and their bytes of ``kinds`` (or 0)."""
        out = np.full(len(context), -1, dtype=np.int64)
        read = {kind: np.zeros(len(context), dtype=np.uint8) for kind in kinds}
        asked = np.flatnonzero((context >= 0) & (word >= 0))
        for s, rows in _by_shard(pair_shard(context[asked], word[asked], self.shards)):
            if self.starts[s] == self.starts[s + 1]:
                continue
            contexts, pointers, successors = _sequences(f"{self.folder}/{_name(self.level, s, 'trie')}", 3)
            rows = asked[rows]
            # Pairs come sorted, so equal contexts stand together and are searched once.
            new = np.concatenate([[True], context[rows][1:] != context[rows][:-1]])
            own = contexts.find(context[rows][new].astype(np.uint64))
            begin, end = (x.astype(np.int64) for x in pointers.access_two(np.maximum(own, 0)))
            base = np.where(begin > 0, successors.access(np.maximum(begin - 1, 0)), np.uint64(0))
            of = np.cumsum(new) - 1
            known = own[of] >= 0
            rows, of = rows[known], of[known]
            place = successors.find(base[of] + word[rows].astype(np.uint64) + np.uint64(1))
            inside = (place >= begin[of]) & (place < end[of])
            rows, place = rows[inside], place[inside]
            out[rows] = place + self.starts[s]
            for kind, values in read.items():
                values[rows] = _mapped(f"{self.folder}/{_name(self.level, s, kind)}")[place]
        return out, read


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard met and its rows in their order; the work does not grow with rows times shards."""
    # Two bytes are sorted by their digits.
    narrow_shard = shard.astype(np.uint16) if len(shard) and int(shard.max()) < 1 << 16 else shard
    order = np.argsort(narrow_shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        yield int(shard[rows[0]]), rows


_MAPPED: dict[str, np.ndarray] = {}
_READ: dict[str, tuple[EliasFano, ...]] = {}
_OPEN_FILES = 4_096


def _mapped(path: str) -> np.ndarray:
    if path not in _MAPPED:
        if len(_MAPPED) >= _OPEN_FILES:
            _MAPPED.clear()
            _READ.clear()
        _MAPPED[path] = map_file(path)
    return _MAPPED[path]


def _sequences(path: str, count: int) -> tuple[EliasFano, ...]:
    if path not in _READ:
        data, at, found = _mapped(path), 0, []
        for _ in range(count):
            sequence, at = EliasFano.read(data, at)
            found.append(sequence)
        _READ[path] = tuple(found)
    return _READ[path]


def successor_sequences(context: np.ndarray, word: np.ndarray) -> tuple[EliasFano, EliasFano, EliasFano]:
    """Contexts, pointers and successors of sorted pairs."""
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, int)
    last = np.append(first[1:], len(context))[: len(first)] - 1
    # The base of a context is the last number of the one before: the sum of the largest successors so far.
    largest = word[last] + 1
    base = np.cumsum(largest) - largest
    rising = word + 1 + np.repeat(base, last - first + 1)
    return (
        EliasFano.build(context[first].astype(np.uint64)),
        EliasFano.build(np.append(first, len(context)).astype(np.uint64)),
        EliasFano.build(rising.astype(np.uint64)),
    )


def narrow(numbers: np.ndarray) -> bytes:
    """Numbers that are not negative, in 1, 2, 4 or 8 bytes each, as the largest needs."""
    most = int(numbers.max()) if len(numbers) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return numbers.astype(f"<u{width}").tobytes()


def pack_mass(node: np.ndarray, mass: np.ndarray) -> bytes:
    """Rising nodes and their mass, compressed: steps and masses by places of bytes."""
    steps = np.diff(node, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8).T
    values = mass.astype("<f4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(steps.tobytes() + values.tobytes(), 1)


def unpack_mass(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.decompress(block), dtype=np.uint8)
    count = len(data) // 12
    steps = np.ascontiguousarray(data[: 8 * count].reshape(8, count).T).view("<i8").ravel()
    values = np.ascontiguousarray(data[8 * count :].reshape(4, count).T).view("<f4").ravel()
    return np.cumsum(steps), values.astype(np.float64)


def quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log2(np.maximum(p, 1e-300)) * _STEPS), 0, 255).astype(np.uint8)


_PROBABILITY = 2.0 ** (-np.arange(256) / _STEPS)


# Training -------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    levels: tuple[Level, ...]
    tokens: int  # training tokens, ends included
    words: int  # distinct training tokens
    min_count: int  # of the n-grams kept, n above 1

    def numbers(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Number (or -1) and count of each distinct token."""
        number = np.full(len(tokens.hashes), -1, dtype=np.int64)
        count = np.zeros(len(number), dtype=np.int64)
        if self.words:
            number = self.levels[0].find_words(tokens.hashes)
            known = np.flatnonzero(number >= 0)
            count[known] = self.levels[0].counts(number[known])
        return number, count

    def nodes(self, tokens: Tokens, number: np.ndarray, count: np.ndarray, upto: int) -> list[np.ndarray]:
        """For each level to ``upto``: the node of the n-gram that ends at each token, or -1.

        ``number`` and ``count`` are those of the distinct tokens; an n-gram is as
        frequent as its rarest word at most, so rarer words are not looked up.
        """
        return [number[tokens.places], *(n.of_tokens() for n in self.looked_up(tokens, number, count, upto))]

    def looked_up(self, tokens: Tokens, number: np.ndarray, count: np.ndarray, upto: int, scored: bool = False) -> list[LookedUp]:
        """The same for levels 2 to ``upto``, each distinct n-gram once; ``scored`` with codes and backoff."""
        found: list[LookedUp] = []
        below = number[tokens.places]
        frequent = np.where(count >= self.min_count, number, -1)
        word = frequent[tokens.places]
        for n in range(2, upto + 1):
            # The context of a token is the node, one level down, that ends at the token before; told apart by its place in these texts.
            if n == 2:
                place, node_at = tokens.before(), frequent
                rows = np.flatnonzero((frequent[place] >= 0) & (word >= 0) & (below >= 0))
            else:
                context = np.full(len(below), -1, dtype=np.int64)
                context[1:] = below[:-1]
                context[tokens.starts] = -1
                rows = np.flatnonzero((context >= 0) & (word >= 0) & (below >= 0))
                # Numbered as their nodes rise, so that files are read from one end to the other.
                order = order_of((found[-1].node + 1).astype(np.uint64), max(1, int(self.levels[n - 2].starts[-1]).bit_length()))
                node_at, rank = found[-1].node[order], np.empty_like(order)
                rank[order] = np.arange(len(order))
                place = np.zeros(len(below), dtype=np.int64)
                place[found[-1].rows] = rank[found[-1].back]
                place[1:] = place[:-1].copy()
            c, w, back = (place[:0], place[:0], rows) if not len(rows) else _distinct_pairs(place[rows], tokens.places[rows])
            kinds = () if not scored else ("codes", "backoff") if n < len(self.levels) else ("codes",)
            node, read = self.levels[n - 1].find(node_at[c], number[w], kinds)
            found.append(LookedUp(len(below), rows, back, node, read))
            below = found[-1].of_tokens()
        return found

    def _word_backoff(self, number: np.ndarray) -> np.ndarray:
        return self.levels[0].by_node(np.maximum(number, 0), "backoff", "<u1") / 255.0

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """n_tokens, n_known, base_score and score of each text."""
        tokens = Tokens(texts)
        number, count = self.numbers(tokens)
        base = (count + 1) / (self.tokens + self.words + 1)
        p = base[tokens.places]
        sums = lambda x: np.add.reduceat(x, tokens.starts) if len(x) else x
        base_score = sums(np.log10(base)[tokens.places])
        # What the context of a token leaves to shorter ones; 1 where it is unknown.
        left = _known(number, self._word_backoff(number), 1.0)[tokens.before()] if self.words else 1.0
        for n, found in enumerate(self.looked_up(tokens, number, count, len(self.levels), scored=True), 2):
            p *= left
            p[found.rows] += _known(found.node, _PROBABILITY[found.read["codes"]], 0.0)[found.back]
            if n < len(self.levels):
                own = np.ones(len(p))
                own[found.rows] = _known(found.node, found.read["backoff"] / 255.0, 1.0)[found.back]
                left = np.concatenate([[1.0], own[:-1]])
                left[tokens.starts] = 1.0
        score = sums(np.log10(np.minimum(p, 1.0)))
        return tokens.sizes, sums((count > 0)[tokens.places].astype(np.int64)), base_score, score


def _known(node: np.ndarray, value: np.ndarray, other: float) -> np.ndarray:
    return np.where(node >= 0, value, other)


@dataclass(frozen=True)
class LookedUp:
    """The n-grams that were looked up: of ``rows`` of ``size`` tokens, at ``back`` among the distinct ones, whose nodes (or -1) are ``node``."""

    size: int
    rows: np.ndarray
    back: np.ndarray
    node: np.ndarray
    read: dict[str, np.ndarray]

    def of_tokens(self) -> np.ndarray:
        out = np.full(self.size, -1, dtype=np.int64)
        out[self.rows] = self.node[self.back]
        return out


def _distinct_pairs(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, and the place of each given pair among them."""
    low = max(1, int(word.max()).bit_length())
    bits = int(context.max()).bit_length() + low
    order = np.lexsort((word, context)) if bits > 64 else order_of(context.astype(np.uint64) << np.uint64(low) | word.astype(np.uint64), bits)
    c, w = context[order], word[order]
    new = _changes(c) | _changes(w)
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.cumsum(new) - 1
    return c[new], w[new], back


def train(texts: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, folder: str | None = None) -> Model:
    """Counts all of ``texts(text)`` and writes the trie."""
    spark = texts.sparkSession
    folder = folder or new_folder(spark, "ngram")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            tokens = Tokens(texts)
            # A hash as two halves, so that all numbers fit signed 64 bits.
            high, low = (tokens.hashes >> np.uint64(32)).astype(np.int64), (tokens.hashes & np.uint64(0xFFFFFFFF)).astype(np.int64)
            return high, low, np.bincount(tokens.places)

        yield from _count(batches, pairs, lambda c, w: word_shard(_whole(c, w), shards))

    def write_words(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        high, low, count = _shard_counts(frame)
        write_file(folder, _name(1, shard, "trie"), EliasFano.build(_whole(high, low)).to_bytes())
        write_file(folder, _name(1, shard, "counts"), narrow(count))
        write_file(folder, _name(1, shard, "backoff"), b"\xff" * len(count))
        return pd.DataFrame({"shard": [shard], "nodes": [len(count)], "tokens": [int(count.sum())]})

    counted = texts.mapInArrow(count_words, "shard bigint, block binary").groupBy("shard")
    made = counted.applyInPandas(write_words, "shard bigint, nodes bigint, tokens bigint").collect()
    levels = [Level(folder, 1, _starts(made, shards))]
    model = Model(tuple(levels), sum(r["tokens"] for r in made), int(levels[0].starts[-1]), min_count)
    for n in range(2, order + 1):
        if not model.words:
            break
        model = _grow(texts, model, n, n == order, min_count, shards, folder)
    return model


def _whole(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)


def _starts(rows: list, shards: int) -> np.ndarray:
    sizes = np.zeros(shards, dtype=np.int64)
    for r in rows:
        sizes[r["shard"]] = r["nodes"]
    return np.concatenate([[0], np.cumsum(sizes)])


def _count(batches: Iterator[pa.RecordBatch], pairs, shard_of) -> Iterator[pa.RecordBatch]:
    """Blocks of what ``pairs`` finds; each pair is sorted once, unless few distinct ones are left to go on with."""
    held: list[tuple] = []
    summed: list[tuple] = []
    size = 0

    def all_summed() -> tuple:
        parts = [*summed, add_up(*(np.concatenate(x) for x in zip(*held, strict=True)))]
        return add_up(*(np.concatenate(x) for x in zip(*parts, strict=True))) if len(parts) > 1 else parts[0]

    for _, texts in _batches(batches, 0):
        held.append(pairs(texts))
        size += len(held[-1][0])
        if size > HELD:
            summed, held = [all_summed()], []
            size = len(summed[0][0])
            if size > HELD // 2:
                yield from _blocks(summed[0], shard_of)
                summed, size = [], 0
    if held:
        summed = [all_summed()]
    if summed:
        yield from _blocks(summed[0], shard_of)


def _grow(texts: DataFrame, model: Model, n: int, last: bool, min_count: int, shards: int, folder: str) -> Model:
    """Adds level n to a model of n - 1 levels; nobody reads counts and mass of the last level."""
    below = model.levels[-1]

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            tokens = Tokens(texts)
            number, count = model.numbers(tokens)
            word = number[tokens.places]
            if n == 2:
                before = tokens.before()
                # A pair is as frequent as its rarer word at most.
                rows = np.flatnonzero((count[before] >= min_count) & (count[tokens.places] >= min_count))
                context = number[before]
            else:
                found = model.nodes(tokens, number, count, n - 1)[-1]
                context = np.full(len(found), -1, dtype=np.int64)
                context[1:] = found[:-1]
                context[tokens.starts] = -1
                # An n-gram is as frequent as the two it is made of at most.
                rows = np.flatnonzero((context >= 0) & (found >= 0))
            return context[rows], word[rows], np.ones(len(rows), dtype=np.int64)

        yield from _count(batches, pairs, lambda c, w: pair_shard(c, w, shards))

    def write_level(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        context, word, count = _shard_counts(frame)
        kept = count >= min_count
        context, word, count = context[kept], word[kept], count[kept]
        distinct, back = np.unique(context, return_inverse=True)
        share = (count - DISCOUNT) / below.counts(distinct)[back]
        trie = b"".join(e.to_bytes() for e in successor_sequences(context, word))
        write_file(folder, _name(n, shard, "trie"), trie)
        write_file(folder, _name(n, shard, "codes"), quantise(share).tobytes())
        if not last:
            write_file(folder, _name(n, shard, "counts"), narrow(count))
            write_file(folder, _name(n, shard, "backoff"), b"\xff" * len(count))
        mass = np.bincount(back, share, len(distinct))
        # The mass that each context gives away here, for the files of the level below.
        home = below.shard_of_node(distinct)
        rows = [{"shard": shard, "nodes": len(count), "home": -1, "block": b""}]
        for s in np.unique(home):
            rows.append({"shard": shard, "nodes": 0, "home": int(s), "block": pack_mass(distinct[home == s], mass[home == s])})
        return pd.DataFrame(rows)

    def write_backoff(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["home"].iloc[0])
        given = np.zeros(int(below.starts[shard + 1] - below.starts[shard]))
        for b in frame["block"]:
            node, mass = unpack_mass(b)
            given[node - below.starts[shard]] += mass
        code = np.clip(np.rint((1 - given) * 255), 1, 255).astype(np.uint8)
        write_file(folder, _name(n - 1, shard, "backoff"), code.tobytes())
        return pd.DataFrame({"home": [shard]})

    counted = texts.mapInArrow(count_pairs, "shard bigint, block binary").groupBy("shard")
    made = materialize(counted.applyInPandas(write_level, "shard bigint, nodes bigint, home bigint, block binary"))
    sizes = made.filter("home < 0").select("shard", "nodes").collect()
    made.filter("home >= 0").groupBy("home").applyInPandas(write_backoff, "home bigint").count()
    level = Level(folder, n, _starts(sizes, shards))
    return Model((*model.levels, level), model.tokens, model.words, min_count)


# Scoring --------------------------------------------------------------------------


def score_documents(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _batches(batches, 2):
            size, known, base, score = model.score(texts)
            numbers = [size, known, np.full(len(size), model.tokens), base, score]
            arrays = [part.column(0), part.column(1), *(pa.array(x, type=t) for x, t in zip(numbers, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, schema)
