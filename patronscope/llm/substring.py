"""Removal of repeated passages by Rabin-Karp hashes of every word window.

A window is ``WIDTH`` neighbouring words of one document. Every word covered by a window
whose words also start earlier (in a smaller doc_id, or earlier in the same document) goes.

1. Documents are dealt by hash to groups of about ``GROUP_BYTES`` of text. Each group keeps the first
   window of each hash and sends the hashes, in order of place, to buckets chosen by a
   second hash, with the documents that they are from.
2. A bucket sorts its hashes; of equal ones that of the earliest document stays. What goes back to
   each group is one bit per hash it sent.
3. Each group, with its documents again, repeats step 1, reads the bits and merges the
   repeated windows into maximal intervals of words.

A passage that very many documents share is sent once per group, not per document. A
bucket has the hashes of about ``BUCKET_BYTES`` of text. A group sends a row to each bucket that it has a
hash for, so the rows are never more than the windows. Hash
and bucket together identify a window: false matches are expected to number (windows x
buckets) / 2 ** 64 / buckets, below one for 10 ** 13 windows.

Defined cases: NULL text has no words; NULL doc_ids come before all others; rows that repeat
a doc_id are separate documents in the order of a hash of their texts, so a repeated row counts as a copy;
other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.llm.common import fmix64, parts, texts
from patronscope.llm.hashing import FIRST, SECOND, hashed, window_hashes

WIDTH = 20
GROUP_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20

SENT = pa.schema(
    [("bucket", pa.int32()), ("group", pa.int32()), ("hashes", pa.binary()), ("runs", pa.binary())]
)
SENT_DDL = "bucket int, group int, hashes binary, runs binary"
#: Neighbouring hashes of one document: its place among all documents, and their number.
RUN = np.dtype([("known", "u1"), ("id", "<i8"), ("text", "<i8"), ("n", "<u4")])
MARKS = pa.schema([("group", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])
MARKS_DDL = "group int, bucket int, bits binary"
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("text", pa.string()),
    ]
)
RESULT_DDL = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string, "
    "removed array<struct<start: bigint, end: bigint>>, text string"
)


def grouped(documents: DataFrame) -> tuple[DataFrame, int]:
    """The documents with a hash of the text and their ``group``, and the number of buckets."""
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(-(-size // GROUP_BYTES), parts(docs), 2)
    group = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    found = docs.withColumns({"text_hash": F.xxhash64("text"), "group": group})
    return found, max(-(-size // BUCKET_BYTES), parts(docs))


class Windows:
    """The windows of a group's documents, in order of (doc_id, hash of the text, start)."""

    def __init__(self, table: pa.Table, width: int, buckets: int) -> None:
        ids = table.column("doc_id").to_pylist()
        data = texts(table.column("text").combine_chunks())
        by = table.column("text_hash").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, by[i]))
        self.ids = [ids[i] for i in order]
        documents = np.array([(ids[i] is not None, ids[i] or 0, by[i], 0) for i in order], RUN)
        self.data = [data[i] or b"" for i in order]
        hashes, starts, at = [], [], 0
        self.bounds = [0]
        for text in self.data:
            h = hashed(text.split())
            hashes.append(h)
            if len(h) >= width:
                starts.append(np.arange(at, at + len(h) - width + 1))
            at += len(h)
            self.bounds.append(at)
        values = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        #: places of the windows, as the number of their first word in the group
        self.places = np.concatenate(starts) if starts else np.empty(0, np.int64)
        first = fmix64(window_hashes(values, width, FIRST))[self.places]
        second = fmix64(window_hashes(values, width, SECOND))[self.places]
        # equal windows next to each other, the earliest first
        by_hash = np.argsort(first, kind="stable")
        run = first[by_hash]
        begins = np.ones(len(run), bool)
        begins[1:] = run[1:] != run[:-1]
        #: for each window the number of the first window with its hash
        self.leader = np.empty(len(run), np.int64)
        self.leader[by_hash] = by_hash[begins][np.cumsum(begins) - 1] if len(run) else 0
        leaders = np.flatnonzero(self.leader == np.arange(len(run)))
        bucket = ((second[leaders] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        by_bucket = np.argsort(bucket, kind="stable")
        #: the windows sent to each bucket, in order of place
        self.sent = leaders[by_bucket]
        self.hashes = first[self.sent]
        bucket = bucket[by_bucket]
        self.cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        document = np.searchsorted(self.bounds, self.places[self.sent], "right") - 1
        new = np.ones(len(bucket), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (document[1:] != document[:-1])
        begins = np.flatnonzero(new)
        #: the documents of the hashes, and where those of each bucket begin
        self.runs = documents[document[begins]]
        self.runs["n"] = np.diff(np.append(begins, len(bucket)))
        self.run_cuts = np.searchsorted(begins, self.cuts)


def _send(width: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        w = Windows(table, width, buckets)
        full = np.flatnonzero(np.diff(w.cuts))
        group = table.column("group")[0].as_py()
        blobs = [w.hashes[w.cuts[b] : w.cuts[b + 1]].tobytes() for b in full]
        runs = [w.runs[w.run_cuts[b] : w.run_cuts[b + 1]].tobytes() for b in full]
        groups = np.full(len(full), group, np.int32)
        return pa.table([full.astype(np.int32), groups, blobs, runs], schema=SENT)

    return send


def _judge(table: pa.Table) -> pa.Table:
    """Bits of the hashes that an earlier document of another group has too."""
    blobs = table.column("hashes").to_pylist()
    sizes = [len(b) // 8 for b in blobs]
    hashes = np.frombuffer(b"".join(blobs), np.uint64)
    runs = np.frombuffer(b"".join(table.column("runs").to_pylist()), RUN)
    place = np.empty(len(runs), np.int64)
    place[np.lexsort((runs["text"], runs["id"], runs["known"]))] = np.arange(len(runs))
    order = np.lexsort((np.repeat(place, runs["n"]), hashes))
    again = np.zeros(len(hashes), bool)
    again[order[1:]] = hashes[order[1:]] == hashes[order[:-1]]
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    own = [again[a:b] for a, b in zip(cuts, cuts[1:])]
    some = np.array([i for i, x in enumerate(own) if x.any()], np.int64)
    rows = [
        table.column("group").take(some),
        table.column("bucket").take(some),
        pa.array([np.packbits(own[i]).tobytes() for i in some], pa.binary()),
    ]
    return pa.table(rows, schema=MARKS)


def _remove(width: int, buckets: int, with_text: bool):
    def remove(docs: pa.Table, marks: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return RESULT.empty_table()
        w = Windows(docs, width, buckets)
        repeated = w.leader != np.arange(len(w.leader))
        elsewhere = np.zeros(len(w.leader), bool)
        for bucket, bits in zip(marks.column("bucket").to_pylist(), marks.column("bits").to_pylist()):
            a, b = w.cuts[bucket], w.cuts[bucket + 1]
            elsewhere[w.sent[a:b]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        repeated |= elsewhere[w.leader] if len(repeated) else repeated
        edge = np.zeros(w.bounds[-1] + 1, np.int64)
        edge[w.places[repeated]] += 1
        edge[w.places[repeated] + width] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        columns: list[list] = [[] for _ in RESULT]
        for doc_id, data, a, b in zip(w.ids, w.data, w.bounds, w.bounds[1:]):
            own, words = gone[a:b], data.split()
            n_removed = int(own.sum())
            spans = []
            if n_removed:
                change = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0]))))
                spans = [{"start": s, "end": e} for s, e in change.reshape(-1, 2).tolist()]
                words = [x for x, out in zip(words, own.tolist()) if not out]
            kept = b" ".join(words)
            row = (doc_id, b - a, n_removed, hashlib.sha256(kept).hexdigest(), spans, None)
            for c, v in zip(columns, row if not with_text else (*row[:5], kept.decode())):
                c.append(v)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT)

    return remove


def remove_repeats(documents: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """Per document: words, removed words and intervals, the kept text and its digest."""
    docs, buckets = grouped(documents)
    by_group = docs.groupBy("group")
    sent = by_group.applyInArrow(_send(width, buckets), SENT_DDL)
    marks = sent.groupBy("bucket").applyInArrow(_judge, MARKS_DDL)
    both = by_group.cogroup(marks.groupBy("group"))
    return both.applyInArrow(_remove(width, buckets, with_text), RESULT_DDL)
