"""Phrase collocations per language by SON partitioning.

The input partitions are dealt to ``shards`` shards. A phrase that occurs ``least``
times in all occurs at least ``ceil(least / shards)`` times in some shard, whatever the shards'
sizes: that is the lowered local support.

1. Every shard is mined completely at that support, level by level: words and pairs first, then
   phrases of three words both of whose pairs are candidates, and so on. A shard is as large
   as the cluster makes it: many tasks read its documents and count in chunks, and Spark
   adds the counts up by shard and phrase, so no shard has to fit anywhere.
2. The union of the locally frequent phrases are the candidates, but for those that could not reach
   ``least`` with one less than the local support in every shard where they are not frequent. A second pass
   over the documents counts all of them globally and exactly, by the words themselves.

What one pass tells the next is a table of ``FILTER_BITS`` bits, set at the hashes of the frequent
phrases. Its size doesn't depend on the corpus. A bit that two phrases share, like a hash that
they share in the first pass, only lets a phrase through that the exact count then judges.

Scores, the cut into two parts, the test against longer candidates and the ranks are
DataFrame expressions on the frequent phrases; counts multiply as decimals of 38 digits.

Defined cases: NULL text is empty, NULL ``lang`` is ``und``; a doc_id may be missing or repeated, rows count one by one;
other columns are ignored; no rows, or no phrase that is frequent enough, give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronscope.llm.bitmap import bits_of, holds_bits
from patronscope.llm.common import fmix64, small_batches, stored, texts
from patronscope.llm.hashing import FIRST, word_places
from patronscope.operators.ranking import top_per_group

LEAST = 10
MAX_WORDS = 3
TOP = 2000
SHARDS = 4
COVERED = 50
SCALE = 1_000_000
#: A filter of 16 MB; longer texts than ``CUT_BYTES`` are read in parts that end with a piece.
FILTER_BITS = 1 << 27
CHUNK_WORDS = 1_000_000
CUT_BYTES = 1 << 22
UNKNOWN = "und"

#: Characters that end a piece (fixed values) become points of their own; words end at space and tab.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TO_DOT = bytes(0x2E if b in _ENDS else b for b in bytes(range(256)).lower())
_END = re.compile(rb"[.,;:!?\x0a-\x0d]")


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a piece ends."""
    while len(text) > CUT_BYTES and (end := _END.search(text, CUT_BYTES)):
        yield text[: end.end()]
        text = text[end.end() :]
    yield text


class Chunk:
    """Hashes of the phrases of some documents and, if ``exact``, their words as numbers.

    ``data`` are the documents one after the other, up to ``ends``; ``langs`` are their languages.
    """

    def __init__(self, data: bytes, ends: list[int], langs: list[bytes], exact: bool = True) -> None:
        starts, stops, self._hash = word_places(data)
        raw = np.frombuffer(data, np.uint8)
        self.langs = sorted(set(langs))
        at = {lang: i for i, lang in enumerate(self.langs)}
        lengths = np.diff(np.searchsorted(starts, ends), prepend=0)
        self.lang = np.repeat(np.array([at[x] for x in langs], np.int64), lengths)
        lang_hash = np.array([xxhash.xxh3_64_intdigest(x) for x in self.langs], np.uint64)
        self.hashes = fmix64(lang_hash[self.lang] * np.uint64(FIRST) + self._hash)
        self.inside = self._is_word = raw[starts] != 0x2E
        self.size = 1
        if exact:
            letters = raw[(raw != 0x20) & (raw != 0x09)]
            self.ids, self.words = _numbered(letters, stops - starts)
            self.codes = self.ids

    def grow(self, with_codes: bool = True) -> None:
        """From phrases of ``size`` words at each place to phrases of one more."""
        k = self.size
        n = max(len(self.hashes) - 1, 0)
        self.hashes = fmix64(self.hashes[:n] * np.uint64(FIRST) + self._hash[k : k + n])
        self.inside = self.inside[:n] & self._is_word[k : k + n]
        self.size = k + 1
        if not with_codes:
            return
        codes, v = self.codes[:n], len(self.words)
        if n and int(codes.max()) >= (1 << 62) // (v * len(self.langs)):
            codes = np.unique(codes, return_inverse=True)[1]
        self.codes = codes * v + self.ids[k : k + n]

    def phrases(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A place of every distinct phrase and language among ``places``, and its count."""
        code = self.codes[places]
        n = len(self.langs)
        if len(code) and int(code.max()) >= (1 << 62) // n:
            code = np.unique(code, return_inverse=True)[1]
        code = code * n + self.lang[places]
        order = np.argsort(code)
        code = code[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else order
        return places[order[first]], np.diff(first, append=len(code))

    def texts(self, places: np.ndarray) -> pa.Array:
        """The phrases at some places."""
        own = [self.words.take(pa.array(self.ids[places + i])) for i in range(self.size)]
        return pc.binary_join_element_wise(*own, " ") if self.size > 1 else own[0]


def _numbered(letters: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Numbers of words in the order of their first use, and the words; ``letters`` are theirs without blanks."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    words = pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers).dictionary_encode()
    return words.indices.to_numpy().astype(np.int64), words.dictionary.cast(pa.string())


def _chunks(batches: Iterator[pa.RecordBatch], exact: bool = True) -> Iterator[Chunk]:
    data, ends, langs, size = bytearray(), [], [], 0
    for b in batches:
        for lang, text in zip(texts(b.column(0)), texts(b.column(1))):
            for part in _parts(text):
                own = part.translate(_TO_DOT).replace(b".", b" . ") + b" . "
                data += own
                ends.append(len(data))
                langs.append(lang)
                size += own.count(b" ") + own.count(b"\t")
                if size >= CHUNK_WORDS:
                    yield Chunk(bytes(data), ends, langs, exact)
                    data, ends, langs, size = bytearray(), [], [], 0
    if data:
        yield Chunk(bytes(data), ends, langs, exact)


def _read(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def local_counts(read: DataFrame, sizes: range, shards: int, shorter=None) -> DataFrame:
    """``key, shard, n``: occurrences of the phrases of these sizes in each shard.

    With a filter ``shorter`` of candidates one word shorter, only phrases whose first and last
    words both make such a phrase: others cannot be frequent in the corpus, in whatever shards.
    """

    def counted(hashes: np.ndarray, shard: int) -> Iterator[pa.RecordBatch]:
        # each size by itself and sorted in place: a chunk's phrases of all sizes take much memory
        hashes.sort()
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
        for at in range(0, len(first), 1 << 16):
            part = first[at : at + (1 << 16) + 1]
            n = np.diff(part) if len(part) > 1 << 16 else np.diff(part, append=len(hashes))
            own = hashes[part[: len(n)]].view(np.int64)
            columns = [pa.array(own), pa.array(np.full(len(own), shard, np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "shard", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        bitmap = None if shorter is None else np.frombuffer(shorter.value, np.uint8)
        for chunk in _chunks(batches, exact=False):
            for size in range(1, sizes.stop):
                if size > 1:
                    chunk.grow(with_codes=False)
                if bitmap is not None and size == sizes.start - 1:
                    holds = holds_bits(bitmap, chunk.hashes)
                    likely = holds[:-1] & holds[1:]
                if size >= sizes.start:
                    keep = chunk.inside if bitmap is None else chunk.inside & likely
                    yield from counted(chunk.hashes[keep], shard)
            del chunk  # before the next one is built

    counts = read.mapInArrow(run, "key long, shard int, n long")
    # chunks are counted already and most of their phrases are rare: straight to the shuffle
    return counts.repartition("key").groupBy("key", "shard").agg(F.sum("n").alias("n"))


def possible(counts: DataFrame, least: int, shards: int) -> DataFrame:
    """``key`` of the locally frequent phrases that can be frequent in all the corpus."""
    support = -(-least // shards)
    frequent = counts.where(F.col("n") >= support).groupBy("key")
    frequent = frequent.agg(F.sum("n").alias("n"), F.count("*").alias("in_shards"))
    return frequent.where(F.col("n") + (support - 1) * (shards - F.col("in_shards")) >= least).select("key")


def candidates(read: DataFrame, least: int, max_words: int, shards: int) -> bytes:
    """The filter of all phrases that can be frequent."""
    spark = read.sparkSession
    counts = local_counts(read, range(1, min(max_words, 2) + 1), shards)
    union = shorter = bits_of(possible(counts, least, shards), FILTER_BITS)
    for size in range(3, max_words + 1):
        shared = spark.sparkContext.broadcast(shorter)
        counts = local_counts(read, range(size, size + 1), shards, shared)
        shorter = bits_of(possible(counts, least, shards), FILTER_BITS)
        union = (np.frombuffer(union, np.uint8) | np.frombuffer(shorter, np.uint8)).tobytes()
        shared.unpersist()
    return union


def global_counts(read: DataFrame, union: bytes, max_words: int) -> DataFrame:
    """``lang, phrase, n`` of every candidate, exactly; a NULL phrase has all words of a language."""
    shared = read.sparkSession.sparkContext.broadcast(union)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        names = ["lang", "phrase", "n"]
        for chunk in _chunks(batches):
            langs = pa.array(chunk.langs, pa.binary()).cast(pa.string())
            total = np.bincount(chunk.lang[chunk.inside], minlength=len(langs))
            none = pa.nulls(len(langs), pa.string())
            yield pa.RecordBatch.from_arrays([langs, none, pa.array(total)], names)
            for size in range(1, max_words + 1):
                if size > 1:
                    chunk.grow()
                keep = chunk.inside.copy()
                keep[keep] = holds_bits(bitmap, chunk.hashes[keep])
                places, n = chunk.phrases(np.flatnonzero(keep))
                for at in range(0, len(places), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    own = langs.take(pa.array(chunk.lang[places[part]]))
                    columns = [own, chunk.texts(places[part]), pa.array(n[part])]
                    yield pa.RecordBatch.from_arrays(columns, names)
                del keep, places, n
            del chunk  # before the next one is built

    counts = read.mapInArrow(run, "lang string, phrase string, n long")
    # chunks are counted already: straight to the shuffle
    return counts.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _slice(start: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", start, size), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of the frequent phrases by their lowest-scoring cut."""
    part = frequent.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    cuts = frequent.withColumn("words", F.split("phrase", " ")).where(F.size("words") > 1)
    cuts = cuts.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", _slice(F.lit(1), F.col("k")))
    cuts = cuts.withColumn("rest", _slice(F.col("k") + 1, F.size("words")))
    left = part.withColumnsRenamed({"part": "first", "f": "l"})
    right = part.withColumnsRenamed({"part": "rest", "f": "r"})
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    count = {x: F.col(x).cast("decimal(15,0)") for x in "alr"}
    both = both.withColumn("top", F.lit(SCALE).cast("decimal(8,0)") * (count["a"] * count["a"]))
    both = both.withColumn("below", count["l"] * count["r"])
    score = F.expr("top div below").cast("long")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "words"))
    return both.groupBy("lang", "phrase").agg(lowest.alias("x")).select("lang", "phrase", "x.*")


def uncovered(phrases: DataFrame) -> DataFrame:
    """Without phrases that lie in a longer one with at least ``COVERED`` percent of their count."""
    inner = phrases.where(F.size("words") > 2).select(
        "lang", "a", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("n")
    )
    inner = inner.select(
        "*", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)).alias("start")
    )
    inner = inner.select("lang", _slice(F.col("start"), F.col("n")).alias("phrase"), "a")
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = phrases.join(longest, ["lang", "phrase"], "left")
    return kept.where(F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("a")))


def collocations(
    documents: DataFrame,
    least: int = LEAST,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    shards: int = SHARDS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases."""
    read = _read(documents)
    with small_batches(documents.sparkSession):
        union = candidates(read, least, max_words, shards)
        counted = global_counts(read, union, max_words)
        counted = stored(counted.where((F.col("n") >= least) | F.col("phrase").isNull()), "phrases")
    frequent = counted.where("phrase is not null").withColumnRenamed("n", "a")
    totals = counted.where("phrase is null").select("lang", "n")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = top_per_group(uncovered(scored(frequent)), "lang", order, top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"
    )
