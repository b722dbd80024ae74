"""Packing documents into sequences with lexical retrieval.

1. Every document is tokenized once, an end id is added and the ids are written as 16-bit
   numbers. The same pass counts in how many documents each id occurs; summed over the
   corpus that is a table of at most ``VOCABULARY_SIZE`` rows, which gives every shard the
   same BM25 weights.
2. Documents are dealt at random to shards of about ``SHARD_TOKENS`` ids. A shard holds a BM25
   inverted index of its documents. A seed (the unused document that is first by id)
   opens a sequence; its unused neighbours, best first, fill the window greedily. The
   neighbour that no longer fits is cut, and its rest seeds the next sequence, so only a
   shard's last sequence is padded, and it is laid out in pieces of power-of-two length.

Long documents fill windows of their own. Every id lies in exactly one piece.

Defined cases: NULL text is empty and has only the end id; NULL doc_ids and repeated rows
are packed row by row; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.llm import tokens
from patronscope.llm.common import batch, stored

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 1_500_000
#: Terms of a seed that are looked up, those of the largest weight, and BM25's constants.
QUERY_TERMS = 12
K1, B = 1.2, 0.75

IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n_docs", pa.binary())])
IDS_DDL = "doc_id long, ids binary, n_docs binary"
PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PIECES_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, ids binary"
)


def tokenized(documents: DataFrame, vocabularies: str) -> DataFrame:
    """``doc_id, ids`` per document, and rows with ``n_docs``: documents per id, by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabularies).encode
        end = np.array([END_ID], "<u2").tobytes()
        n_docs = np.zeros(tokens.VOCABULARY_SIZE, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = [encode(t) + end if t else end for t in part.column(1).to_pylist()]
                for x in ids:
                    n_docs[term_counts(np.frombuffer(x, "<u2"))[0]] += 1
                yield batch(IDS, [part.column(0).to_pylist(), ids, [None] * len(ids)])
        yield batch(IDS, [[None], [None], [n_docs.tobytes()]])

    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return docs.mapInArrow(run, IDS_DDL)


def documents_per_id(rows: DataFrame) -> np.ndarray:
    """Sums the tasks' counts in Spark; the result has one row per id of the vocabulary."""

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(tokens.VOCABULARY_SIZE, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.frombuffer(x.as_py(), np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    counts = rows.where("n_docs is not null").select("n_docs").mapInArrow(parts_of, "id long, n long")
    out = np.zeros(tokens.VOCABULARY_SIZE, np.int64)
    for r in counts.groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r.id] = r.n
    return out


def term_counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of a document, ascending, and how often each occurs."""
    x = np.sort(ids, kind="stable")  # a radix sort, as ids have 16 bits
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return x[first], np.diff(np.append(first, len(x)))


class Shard:
    """A BM25 inverted index over the documents of one shard."""

    def __init__(self, ids: list[np.ndarray], weight: np.ndarray, mean_length: float) -> None:
        terms, owners, scores = [], [], []
        self.queries = []
        for i, x in enumerate(ids):
            term, count = term_counts(x)
            norm = K1 * (1 - B + B * len(x) / mean_length)
            score = (weight[term] * count * (K1 + 1) / (count + norm)).astype(np.float32)
            terms.append(term)
            owners.append(np.full(len(term), i, np.int32))
            scores.append(score)
            best = np.argsort(-score, kind="stable")[:QUERY_TERMS]
            self.queries.append(term[best])
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        self.owners, self.scores = np.concatenate(owners)[order], np.concatenate(scores)[order]
        self.cuts = np.searchsorted(term[order], np.arange(tokens.VOCABULARY_SIZE + 1))
        self.n = len(ids)

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents that share a query term with the seed, best first."""
        spans = [slice(self.cuts[t], self.cuts[t + 1]) for t in self.queries[seed]]
        owners = np.concatenate([self.owners[s] for s in spans])
        total = np.bincount(owners, np.concatenate([self.scores[s] for s in spans]), self.n)
        total[used] = 0
        found = np.flatnonzero(total)
        return found[np.argsort(-total[found], kind="stable")]


def sequences(lengths: list[int], shard: Shard, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); each id once, in full windows."""
    n = len(lengths)
    done = np.zeros(n, np.int64)
    used = np.zeros(n, bool)
    sizes = np.array(lengths)
    seed, first_unused = None, 0
    while True:
        if seed is None:
            while first_unused < n and used[first_unused]:
                first_unused += 1
            if first_unused == n:
                return
            seed = first_unused
            used[seed] = True
        # what the seed fills by itself
        while sizes[seed] - done[seed] >= window:
            yield [(seed, int(done[seed]), window)]
            done[seed] += window
        rest = int(sizes[seed] - done[seed])
        if not rest:
            seed = None
            continue
        row, room = [(seed, int(done[seed]), rest)], window - rest
        done[seed] += rest
        opener, seed = seed, None
        for other in shard.neighbours(opener, used):
            take = int(min(room, sizes[other]))
            used[other] = True
            row.append((int(other), 0, take))
            done[other], room = take, room - take
            if not room:
                if sizes[other] > take:
                    seed = int(other)
                break
        while room:  # no neighbours left: whatever comes next by id
            while first_unused < n and used[first_unused]:
                first_unused += 1
            if first_unused == n:
                break
            take = int(min(room, sizes[first_unused]))
            used[first_unused] = True
            row.append((first_unused, 0, take))
            done[first_unused], room = take, room - take
            if not room and sizes[first_unused] > take:
                seed = first_unused
        if not room:
            yield row
            continue
        # the shard's last window: lengths of powers of two need no padding
        size, flat = window - room, row
        while size:
            power = 1 << (size.bit_length() - 1)
            left, head, tail = power, [], []
            for doc, start, length in flat:
                cut = min(left, length)
                if cut:
                    head.append((doc, start, cut))
                if length > cut:
                    tail.append((doc, start + cut, length - cut))
                left -= cut
            yield head
            flat, size = tail, size - power
        return


def _pack(weight, mean_length: float, window: int, with_ids: bool):
    def pack(table: pa.Table) -> pa.Table:
        shard_no = table.column("shard")[0].as_py()
        table = table.sort_by("doc_id")
        doc_ids = table.column("doc_id").to_pylist()
        ids = [np.frombuffer(x, "<u2") for x in table.column("ids").to_pylist()]
        shard = Shard(ids, weight.value, mean_length)
        columns: list[list] = [[] for _ in PIECES]
        for number, row in enumerate(sequences([len(x) for x in ids], shard, window)):
            offset = 0
            for doc, start, length in row:
                data = ids[doc][start : start + length].astype("<u4").tobytes()
                values = (
                    doc_ids[doc],
                    start,
                    length,
                    zlib.crc32(data),
                    len(ids[doc]),
                    (shard_no << 32) + number,
                    offset,
                    data if with_ids else None,
                )
                offset += length
                for c, v in zip(columns, values):
                    c.append(v)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)

    return pack


def pack(
    documents: DataFrame,
    vocabularies: str | None = None,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece of a document, with its place in a sequence.

    ``vocabularies`` is the folder of the tokenizer files, on every executor.
    """
    spark = documents.sparkSession
    rows = stored(tokenized(documents, vocabularies or tokens.folder()), "token-ids")
    docs = rows.where("ids is not null").select("doc_id", "ids")
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length("ids") / 2)).first()
    if not n:
        return spark.createDataFrame([], PIECES_DDL)
    holders = documents_per_id(rows)
    weight = spark.sparkContext.broadcast(np.log1p((n - holders + 0.5) / (holders + 0.5)))
    shards = -(-int(size) // shard_tokens)
    # by id and content, so that a repeated id is no hot shard
    shard = F.pmod(F.xxhash64("doc_id", F.crc32("ids")), F.lit(shards))
    by_shard = docs.withColumn("shard", shard).groupBy("shard")
    return by_shard.applyInArrow(_pack(weight, size / n, window, with_ids), PIECES_DDL)
