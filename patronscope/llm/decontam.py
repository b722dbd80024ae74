"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are runs of ASCII digits, letters (A-Z as a-z) and characters above U+007F. The
items become one automaton over word numbers; each document's words are streamed through
it while it tracks the longest run of words that an item holds. Words in no item reset
the automaton, so only runs of known words need its steps. A run of ``window`` words, or
a whole item of fewer words, is a hit.

Scale. Items are dealt to automata of about ``WORDS_PER_AUTOMATON`` words by a hash of their
text; equal texts are one item with several ids. ``AT_ONCE`` automata are built, broadcast and
held at a time: a larger benchmark takes several passes over the documents, which carry
the matches so far in a written table. Documents are never shuffled.

Defined cases: NULL text has no words; items without words or with NULL text match
nothing; a NULL item_id is the text ''; an item_id that repeats counts once per document;
repeated documents are judged row by row; other columns are ignored by ``hits`` and kept by
``decontaminate``; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.llm.automaton import SuffixAutomaton
from patronscope.llm.common import batch, free, stored, texts

WINDOW = 10
WORDS_PER_AUTOMATON = 100_000
AT_ONCE = 4
#: Lower-cases A-Z and turns every ASCII byte that is in no word into a space.
_FOLD = bytes(
    b if b >= 128 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz"
    else b + 32 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    else 32
    for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Matcher:
    """One automaton, the numbers of its words and the shortest run that can be a hit."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int) -> None:
        self.numbers: dict[bytes, int] = {}
        automaton = SuffixAutomaton(window)
        ids: dict[tuple[int, ...], list[str]] = {}
        for item_id, text in items:
            numbered = tuple(self.numbers.setdefault(w, len(self.numbers)) for w in words(text))
            if numbered:
                ids.setdefault(numbered, []).append(item_id)
        for numbered, own in ids.items():
            automaton.add(own, numbered)
        shortest = min(map(len, ids), default=window)
        shortest = min(shortest, window)
        self.automaton, self.shortest = automaton.finish(), shortest

    def match(self, found_words: list[bytes], hit: bytearray) -> tuple[set[str], int]:
        """Marks hit words; returns the ids of the items found and the longest run."""
        n = len(found_words)
        if n < self.shortest or not self.numbers:
            return set(), 0
        numbered = np.fromiter(map(self.numbers.get, found_words, repeat(-1)), np.int32, n)
        unknown = np.flatnonzero(numbered < 0)
        starts = np.concatenate(([0], unknown + 1))
        ends = np.concatenate((unknown, [n]))
        long_enough = np.flatnonzero(ends - starts >= self.shortest)
        found: set[int] = set()
        longest = 0
        for i in long_enough:
            a, b = int(starts[i]), int(ends[i])
            longest = max(longest, self.automaton.scan(numbered[a:b].tolist(), hit, a, found))
        return {item_id for k in found for item_id in self.automaton.items[k][0]}, longest


def matchers(benchmark: DataFrame, window: int = WINDOW) -> Iterator[list]:
    """Broadcast matchers over blocks of the benchmark, at most ``AT_ONCE`` together."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("string").alias("text"),
    ).where("text is not null")
    # a word and its separator are two bytes at least
    size = items.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = max(1, -(-size // (2 * WORDS_PER_AUTOMATON)))
    for first in range(0, blocks, AT_ONCE):
        out = []
        for block in range(first, min(first + AT_ONCE, blocks)):
            own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
            rows = sorted((r.item_id, r.text.encode()) for r in own.collect())
            out.append(spark.sparkContext.broadcast(Matcher(rows, window)))
        yield out


class Carried:
    """What earlier passes found in a document, kept beside it in one binary column."""

    SEPARATOR = b"\0"

    @staticmethod
    def read(data: bytes | None, n_words: int) -> tuple[bytearray, set[str], int]:
        """Hit words, ids of the items found and the longest run."""
        if data is None:
            return bytearray(n_words), set(), 0
        longest, hit, ids = zlib.decompress(data).split(Carried.SEPARATOR, 2)
        marks = bytearray(x - 48 for x in hit)
        found = {bytes.fromhex(x.decode()).decode() for x in ids.split(b",")[1:]}
        return marks, found, int(longest)

    @staticmethod
    def write(hit: bytearray, found: set[str], longest: int) -> bytes | None:
        if not longest:
            return None
        ids = b"".join(b"," + x.encode().hex().encode() for x in sorted(found))
        marks = bytes(x + 48 for x in hit)
        return zlib.compress(Carried.SEPARATOR.join([b"%d" % longest, marks, ids]), 1)


Judge = Callable[[bytes | None, bytes | None], tuple[int, bytearray, set[str], int]]


def matched(documents: DataFrame, benchmark: DataFrame, window: int) -> tuple[DataFrame, str, Judge]:
    """The documents with a column of what all passes but the last found, its name, and the last pass.

    That pass is a function of a text and that column's value; it returns the number of words, the
    hit words, the ids of the items found and the longest run.
    """

    def judge_by(blocks: list) -> Judge:
        def judge(text: bytes | None, before: bytes | None) -> tuple[int, bytearray, set[str], int]:
            w = words(text)
            hit, found, longest = Carried.read(before, len(w))
            for block in blocks:
                ids, run = block.value.match(w, hit)
                found, longest = found | ids, max(longest, run)
            return len(w), hit, found, longest

        return judge

    name = free(documents, "matched")
    documents = documents.withColumn(name, F.lit(None).cast("binary"))
    at, last = documents.columns.index("text"), len(documents.columns) - 1
    passes = matchers(benchmark, window)
    blocks = next(passes)
    for following in passes:
        judge = judge_by(blocks)

        def carry(batches: Iterator[pa.RecordBatch], judge: Judge = judge) -> Iterator[pa.RecordBatch]:
            for b in batches:
                both = zip(texts(b.column(at)), b.column(last).to_pylist())
                found = [Carried.write(*judge(text, before)[1:]) for text, before in both]
                yield b.set_column(last, b.schema.field(last), pa.array(found, b.schema.field(last).type))

        documents = stored(documents.mapInArrow(carry, documents.schema), "matched")
        for block in blocks:
            block.unpersist()
        blocks = following
    return documents, name, judge_by(blocks)


HITS_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_items", pa.int64()),
        ("items_sha256", pa.string()),
        ("contaminated", pa.bool_()),
        ("longest_match", pa.int64()),
    ]
)
HITS_DDL = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
    "contaminated boolean, longest_match long"
)


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: its words, those inside an item's window, and the items found."""
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    docs, _, judge = matched(docs, benchmark, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[] for _ in HITS_SCHEMA]
            rows = zip(b.column(0).to_pylist(), texts(b.column(1)), b.column(2).to_pylist())
            for doc_id, text, before in rows:
                n_words, hit, found, longest = judge(text, before)
                sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
                n_hit = sum(hit)
                row = (doc_id, n_words, n_hit, len(found), sha, n_hit > 0, longest)
                for c, v in zip(columns, row):
                    c.append(v)
            yield batch(HITS_SCHEMA, columns)

    return docs.mapInArrow(run, HITS_DDL)


def _without(text: bytes, hit: bytearray) -> bytes:
    """``text`` without its runs of hit words; what stood around a run is kept."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out, at, i = [], 0, 0
    while i < len(hit):
        if not hit[i]:
            i += 1
            continue
        j = i
        while j + 1 < len(hit) and hit[j + 1]:
            j += 1
        out.append(text[at : spans[i][0]])
        at = spans[j][1]
        i = j + 1
    return b"".join(out) + text[at:]


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
) -> DataFrame:
    """The documents without the spans that repeat benchmark items.

    A span of ``window`` words or more (or a whole short item) is cut out of the text. A
    document of which more than ``max_coverage`` of the words were hit is dropped. All
    columns are kept; ``n_chars``, where there is one, follows the text.
    """
    source = documents.withColumn("text", F.col("text").cast("string"))
    source, name, judge = matched(source, benchmark, window)
    at, last = source.columns.index("text"), len(source.columns) - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, keep = texts(b.column(at)), []
            for i, (text, before) in enumerate(zip(out, b.column(last).to_pylist())):
                n_words, hit, _, _ = judge(text, before)
                n_hit = sum(hit)
                keep.append(n_hit <= max_coverage * n_words)
                if n_hit and keep[-1]:
                    out[i] = _without(text, hit)
            column = pa.array(out, pa.binary()).cast(b.schema.field(at).type)
            changed = b.set_column(at, b.schema.field(at), column)
            yield changed.filter(pa.array(keep, pa.bool_()))

    result = source.mapInArrow(cut, source.schema).drop(name)
    if "n_chars" in result.columns:
        kind = documents.schema["n_chars"].dataType
        result = result.withColumn("n_chars", F.char_length("text").cast(kind))
    return result
