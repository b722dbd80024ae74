"""Similar documents by a parity-sketch join, exact at any similarity over one half.

A document's set is its distinct shingles of words; equal sets are one class. Sets A and B link
when ``100 |A & B| >= p |A | B|``, so their symmetric difference is at most ``(100 - p) (|A| + |B|) / (100 + p)``.

Parity sketch. Sizes fall into bands. For a band whose pairs differ in at most ``d`` tokens, every token is
hashed to one bit of ``words`` 64-bit words, and the sketch is the XOR of them all. A token in only
one of two sets flips one bit, so the words in which the sketches differ are no more than the
symmetric difference: a pair that may link differs in at most ``d`` words.

Pigeonhole. With ``words = d + 1 + spare`` at least ``spare + 1`` words of such a pair have no differing token.
All words of a band have one order: first those with the most rare tokens, then those with the most bits. A set whose partners
in the band differ from it in at most ``e <= d`` tokens keeps its first ``e + least`` words. Two sets that may link differ in no more
than the smaller ``e`` of theirs, so they share the keys (band, place, word) of at least ``least`` words: the first in that order
of those that they have in common. Pairs that share fewer are no links. A set has the keys of its own band and,
if a partner may be in the next band, of that one too. Sets so small that ``e`` is 0 link only with equal ones.

Rare are tokens that a bounded sample of the documents doesn't hold twice. Passages that many documents share so give
few keys. What is called rare changes the work, never the links.

Keys lead to links as in ``linking``: candidates are tested by the sizes and by 512-bit parity
sketches, whose Hamming distance is a lower bound too, then verified on the full sets. No link is lost.

Defined cases: NULL text and text without words have an empty set, linked with nothing; a document
with fewer words than a shingle has its whole sequence as its one shingle; rows that repeat a doc_id count
as one document (if their texts differ, they are linked by their id); NULL doc_ids are not
linked and stand for themselves (component NULL); other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.llm import linking
from patronscope.llm.bitmap import bits_of, holds_bits
from patronscope.llm.common import batch, drawn, fmix64, small_batches, stored, texts
from patronscope.llm.linking import SKETCH, SKETCH_DDL, SKETCH_FIELDS, shingles, sketch

#: From one band's smallest size to the next one's; spare words as a share of ``d``.
GROWTH, SPARE = 1.6, 1 / 3
#: Of so many spare words one is not left out, so that links share more keys.
ASKED = 16
#: Documents in which common tokens are sought, and bits of the table that holds them.
SAMPLE_ROWS, COMMON_BITS = 5_000, 1 << 24

SETS = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64())]
    + SKETCH_FIELDS
    + [("keys", pa.list_(pa.int64()))]
)
SETS_DDL = (
    f"doc_id long, n_shingles long, set_a long, set_b long, {SKETCH_DDL}, keys array<bigint>"
)


class Bands:
    """Bands of sizes for a similarity; their bounds grow as sizes are asked for."""

    def __init__(self, percent: int) -> None:
        if not 50 < percent <= 100:
            raise ValueError("a similarity over 50 and up to 100 percent")
        self.percent = percent
        self.starts = [1]

    def start(self, band: int) -> int:
        """The smallest size of a band: no set of an earlier band but the one before can link into it."""
        while len(self.starts) <= band:
            last = self.starts[-1]
            self.starts.append(max(int(GROWTH * last), 100 * last // self.percent) + 1)
        return self.starts[band]

    def band(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.start(len(self.starts))
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def differences(self, band: int) -> int:
        """The largest symmetric difference of a pair whose larger set is in the band."""
        largest = self.start(band + 1) - 1
        return (100 - self.percent) * 2 * largest // (100 + self.percent)

    def own_differences(self, band: int, size: int) -> int:
        """The largest symmetric difference of a pair of a set of the size and one that is no larger than the band's."""
        partner = min(100 * size // self.percent, self.start(band + 1) - 1)
        return (100 - self.percent) * (size + partner) // (100 + self.percent)

    def spare(self, band: int) -> int:
        """Words of a band beyond ``d + 1``."""
        return int(self.differences(band) * SPARE)

    def least(self, band: int) -> int:
        """Keys of a band that two sets that link share at least."""
        return 1 - (-self.spare(band) // ASKED)

    def needed(self) -> linking.Needed:
        """Sizes from which on the larger of two sets is in a band, and the keys that they share."""
        last = self.band(1 << 40)
        return [0, *self.starts[1 : last + 1]], [self.least(band) for band in range(last + 1)]

    def of(self, size: int) -> list[int]:
        """The bands in which a set has keys."""
        own = self.band(size)
        partner = 100 * size // self.percent
        return [own, own + 1] if partner >= self.start(own + 1) else [own]


def _first(place: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))


def places(values: np.ndarray, n: int) -> np.ndarray:
    """The word of each token: chosen by its high bits, so ascending like the tokens."""
    return (((values >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def words(values: np.ndarray, n: int, place: np.ndarray | None = None) -> np.ndarray:
    """A sketch of ``n`` words from ascending hashes; the low bits of a token choose its bit in its word."""
    place = places(values, n) if place is None else place
    first = _first(place)
    out = np.zeros(n, np.uint64)
    out[place[first]] = np.bitwise_xor.reduceat(np.uint64(1) << (values & np.uint64(63)), first)
    return out


@lru_cache(maxsize=256)
def _seeds(band: int, n: int) -> np.ndarray:
    return fmix64(np.arange(n, dtype=np.uint64) + np.uint64(band << 40) + np.uint64(1))


def keys(values: np.ndarray, bands: Bands, rare: np.ndarray) -> list[int]:
    """The keys of a set in its bands; ``rare`` marks its rare tokens."""
    out = []
    for band in bands.of(len(values)):
        own = bands.own_differences(band, len(values))
        if not own:
            continue
        n = bands.differences(band) + 1 + bands.spare(band)
        skip = n - own - bands.least(band)
        place = places(values, n)
        word = words(values, n, place)
        hashes = fmix64(word ^ _seeds(band, n))
        if skip:
            n_rare = np.minimum(np.bincount(place[rare], minlength=n), 65_535).astype(np.uint64)
            # one number to sort by: 16 bits of rare tokens, 7 of bits set, then of the hash. It decides what is
            # equal, and after it the place, as the order must be the same for every set
            rank = n_rare << np.uint64(48) | np.bitwise_count(word).astype(np.uint64) << np.uint64(41)
            order = np.argsort(rank | hashes >> np.uint64(23), kind="stable")
            hashes = hashes[order[skip:]]
        out.append(hashes)
    return np.concatenate(out).view(np.int64).tolist() if out else []


def common_tokens(documents: DataFrame, width: int) -> bytes:
    """A table of bits of the tokens that two different texts of a bounded sample share."""
    docs = linking.documents_of(documents).select("text").where("text is not null")
    some = drawn(docs, F.col("text"), SAMPLE_ROWS, documents.count()).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in texts(b.column(0)):
                values = shingles(text, width).view(np.int64)
                for at in range(0, len(values), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(values[at : at + (1 << 16)])], ["key"])

    tokens = some.mapInArrow(run, "key long").groupBy("key").count()
    return bits_of(tokens.where("count > 1"), COMMON_BITS)


def sets(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """Per document: size, 128-bit digest, sketches and keys of its set."""
    common = documents.sparkSession.sparkContext.broadcast(common_tokens(documents, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, bitmap = Bands(percent), np.frombuffer(common.value, np.uint8)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                columns: list[list] = [[] for _ in SETS]
                for doc_id, text in zip(part.column(0).to_pylist(), texts(part.column(1))):
                    values = shingles(text, width)
                    digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                    row = (doc_id, len(values), *np.frombuffer(digest, np.int64).tolist(), *sketch(values))
                    rare = ~holds_bits(bitmap, values)
                    for column, v in zip(columns, (*row, keys(values, bands, rare) if len(values) else [])):
                        column.append(v)
                yield batch(SETS, columns)

    return linking.documents_of(documents).mapInArrow(run, SETS_DDL)


def similar(documents: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, kept`` of every document.

    ``class_id`` is the smallest doc_id with an equal set, ``component_id`` the smallest that
    links reach; ``kept`` marks the documents that are their component's first.
    """
    percent = round(100 * similarity)
    with small_batches(documents.sparkSession):
        known = stored(sets(documents, width, percent), "parity-sketches")
        named = linking.class_table(known)
        first = linking.first_of_class(known, named)
        classes = stored(first.select("id", "n", *SKETCH), "class-sketches")
        rows = first.select("id", "n", F.explode("keys").alias("key"))
        found = linking.links(rows, classes, documents, width, percent, Bands(percent).needed())
    return linking.grouped(known, named, found)
