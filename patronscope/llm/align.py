"""Alignment of two tokenizers over the same bytes by merge-path partitioning.

Every text is encoded by a byte-level vocabulary (A) and by a sentence-piece vocabulary (B). Both
give end offsets of tokens in bytes, ascending; the A and B ends of a batch of texts, one text
after the other, are two sorted lists to be merged. The path of that merge is cut at equally spaced
diagonals: a binary search on each finds how many A and B ends come before it, so all pieces
are the same amount of work, however long a text is, and independent of each other. A piece emits
the overlaps in it: the places where an A and a B token end together. A run of equal ends
that a diagonal cuts is stitched by moving the cut behind the run, and the tokens
left open at a piece's edge become one group with those that follow.

Places where both end cut the tokens into groups; the A-B pairs that end there are links.
Two tokens that end together are one the end of the other's bytes, so the vocabularies alone
bound the pairs that can occur: ``possible_pairs`` (half a million for the files here), however
large the corpus. The counts of pairs, summed in Spark, are broadcast under that bound
and give each document its sums.

Defined cases: a text that is NULL or empty, or whose tokens don't join to a space and the text,
has no tokens; repeated rows are repeated, each counting; other columns are ignored; no rows
give no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.llm import tokens
from patronscope.llm.common import batch, stored

PIECES_FILE = "piece_bpe_32k.model"
#: Ends merged by one piece, and bytes of text after which a batch is merged.
PIECE_WORK = 1 << 16
BATCH_BYTES = 1 << 20

ROWS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("links", pa.binary()),
        ("pairs", pa.binary()),
        ("counts", pa.binary()),
    ]
)
ROWS_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "links binary, pairs binary, counts binary"
)
RESULT_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


class Vocabularies:
    """Both encoders, and what their ids stand for."""

    def __init__(self, folder: str) -> None:
        import sentencepiece

        self.encode_a = tokens.encoder(folder, special=False).ids
        b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECES_FILE))
        self.encode_b = lambda texts: b.encode(texts, num_threads=1)
        a_bytes = tokens.ranks(folder)
        self.a = [b""] * tokens.VOCABULARY_SIZE
        for data, i in a_bytes.items():
            self.a[i] = data
        names = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b = [
            bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.a_size = np.array([len(x) for x in self.a])
        self.b_size = np.array([len(x) for x in self.b])
        # the text of an id and what follows it: the next one, or the end of its half of a group
        self.text = [b"%d%c" % (i, c) for n, end in ((len(self.a), 124), (len(self.b), 59)) for i in range(n) for c in (44, end)]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A and B ids of each text; none where they don't join to a space and the text."""
        none = np.empty(0, np.int64)
        out = [(none, none)] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        for i, b in zip(some, self.encode_b([texts[i] for i in some])):
            own = " " + texts[i]
            a = self.encode_a(own).astype(np.int64)
            data = own.encode()
            if b"".join(map(self.b.__getitem__, b)) == data and b"".join(map(self.a.__getitem__, a.tolist())) == data:
                out[i] = a, np.array(b, np.int64)
        return out


@lru_cache(maxsize=1)
def vocabularies(folder: str) -> Vocabularies:
    return Vocabularies(folder)


def possible_pairs(known: Vocabularies) -> int:
    """How many id pairs can end together: one token's bytes end the other's."""
    by_bytes: list[dict[bytes, int]] = [{}, {}]
    for of, names in zip(by_bytes, (known.a, known.b)):
        for name in names:
            of[name] = of.get(name, 0) + 1
    of_a, of_b = by_bytes
    total = 0
    for own, other, same in ((of_a, of_b, True), (of_b, of_a, False)):
        for name, n in own.items():
            for at in range(0 if same else 1, len(name)):
                total += n * other.get(name[at:], 0)
    return total


def diagonal_cuts(a: np.ndarray, b: np.ndarray, work: int) -> list[tuple[int, int]]:
    """Cuts ``(i, j)`` of the merge of two sorted lists, ``work`` steps apart, A first on ties.

    On the diagonal ``i + j = d`` a binary search finds the ``i`` whose A and B ends come first. The cut then
    moves behind the values equal to the last one, so no common end is divided.
    """
    n, m = len(a), len(b)
    cuts = [(0, 0)]
    for d in range(work, n + m, work):
        low, high = max(0, d - m), min(d, n)
        while low < high:
            i = (low + high) // 2
            if a[i] <= b[d - i - 1]:
                low = i + 1
            else:
                high = i
        i, j = low, d - low
        last = max(a[i - 1] if i else -1, b[j - 1] if j else -1)
        i, j = int(np.searchsorted(a, last, "right")), int(np.searchsorted(b, last, "right"))
        if (i, j) > cuts[-1]:
            cuts.append((i, j))
    if (n, m) > cuts[-1]:
        cuts.append((n, m))
    return cuts


def overlaps(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places ``i`` and ``j`` of all pairs with ``a[i] == b[j]``, in pieces of equal work."""
    cuts = diagonal_cuts(a, b, work)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for (i0, j0), (i1, j1) in zip(cuts, cuts[1:]):
        own, other = a[i0:i1], b[j0:j1]
        low, high = np.searchsorted(other, own, "left"), np.searchsorted(other, own, "right")
        n = high - low
        i = np.repeat(np.arange(i0, i1), n)
        # the places of each run, one after the other
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n) + j0
        left.append(i)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _closes(n: int, common: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks the tokens after which a group ends: the last of those at each common end."""
    out = np.zeros(n, bool)
    out[np.searchsorted(ends, common, "right") - 1] = True
    return out


def aligned(encoded: list[tuple[np.ndarray, np.ndarray]], known: Vocabularies, work: int = PIECE_WORK):
    """Per text: number of groups, digest of the groups, links as ``a << 16 | b``."""
    a, b = (np.concatenate([x[k] for x in encoded]) for k in (0, 1))
    ends_a, ends_b = np.cumsum(known.a_size[a]), np.cumsum(known.b_size[b])
    i, j = overlaps(ends_a, ends_b, work)
    common = np.unique(ends_a[i])
    last_a, last_b = _closes(len(a), common, ends_a), _closes(len(b), common, ends_b)
    # a group's A ids stand before its B ids
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
    shown = np.empty(len(a) + len(b), np.int64)
    shown[place_a] = 2 * a + last_a
    shown[place_b] = 2 * (len(known.a) + b) + last_b
    links = (a[i].astype(np.uint32) << np.uint32(16)) | b[j].astype(np.uint32)
    cut_a = np.cumsum([len(x) for x, _ in encoded])
    cut_b = np.cumsum([len(x) for _, x in encoded])
    cut_links = np.searchsorted(i, cut_a, "left")
    cut_groups = np.concatenate([[0], np.cumsum(last_a)])[cut_a]
    before, groups_before, links_before = 0, 0, 0
    for n, groups, till in zip((cut_a + cut_b).tolist(), cut_groups.tolist(), cut_links.tolist()):
        digest = ""
        if n > before:
            text = b"".join(map(known.text.__getitem__, shown[before:n].tolist()))
            digest = hashlib.sha256(text[:-1]).hexdigest()
        yield groups - groups_before, digest, links[links_before:till]
        before, groups_before, links_before = n, groups, till


def _merged(texts: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Texts in lists of about ``BATCH_BYTES``."""
    kept, size = [], 0
    for row in texts:
        kept.append(row)
        size += len(row[1] or "")
        if size >= BATCH_BYTES or len(kept) >= 2048:
            yield kept
            kept, size = [], 0
    if kept:
        yield kept


def links(documents: DataFrame, folder: str) -> DataFrame:
    """Per document its counts, digest and links; and rows with the pair counts of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies(folder)
        pairs, counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        rows = (
            (d.as_py(), t.as_py()) for x in batches for d, t in zip(x.column(0), x.column(1))
        )
        for some in _merged(rows):
            encoded = known.encode([t for _, t in some])
            columns: list[list] = [[] for _ in ROWS]
            found = []
            for (doc_id, _), (a, b), (groups, digest, own) in zip(some, encoded, aligned(encoded, known)):
                found.append(own)
                values = (doc_id, len(a), len(b), groups, len(own), digest, own.tobytes(), None, None)
                for column, v in zip(columns, values):
                    column.append(v)
            yield batch(ROWS, columns)
            own, n = np.unique(np.concatenate(found), return_counts=True)
            pairs, back = np.unique(np.concatenate([pairs, own]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), len(pairs)).astype(np.int64)
        if len(pairs):
            yield batch(ROWS, [[None]] * 6 + [[None], [pairs.tobytes()], [counts.tobytes()]])

    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return docs.mapInArrow(run, ROWS_DDL)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n``: links of every id pair in the whole corpus."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for pairs, counts in zip(x.column(0), x.column(1)):
                pair = np.frombuffer(pairs.as_py(), np.uint32).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair), pa.array(np.frombuffer(counts.as_py(), np.int64))], ["pair", "n"]
                )

    counts = rows.where("pairs is not null").select("pairs", "counts")
    return counts.mapInArrow(own, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align(documents: DataFrame, folder: str | None = None) -> DataFrame:
    """Per document: tokens, groups and links, links of their B id's highest count, sum of counts.

    ``folder`` holds the vocabulary files, on every executor.
    """
    spark = documents.sparkSession
    rows = stored(links(documents, folder or tokens.folder()), "alignments")
    known = vocabularies(folder or tokens.folder())
    bound = possible_pairs(known)
    found = pair_counts(rows).limit(bound + 1).toArrow()
    if found.num_rows > bound:
        raise ValueError("more pairs than the vocabularies allow")
    order = np.argsort(found["pair"].to_numpy())
    pairs, counts = found["pair"].to_numpy()[order].astype(np.uint32), found["n"].to_numpy()[order]
    highest = np.zeros(1 << 16, np.int64)
    np.maximum.at(highest, pairs & np.uint32(0xFFFF), counts)
    table = spark.sparkContext.broadcast((pairs, counts, counts == highest[pairs & np.uint32(0xFFFF)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        for x in batches:
            n_best, count_sum = [], []
            for own in x.column("links"):
                at = np.searchsorted(pairs, np.frombuffer(own.as_py(), np.uint32))
                n_best.append(int(best[at].sum()))
                count_sum.append(int(counts[at].sum()))
            columns = [*x.columns[:5], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), x.column(5)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT_DDL.split(", ")])

    own = rows.where("links is not null").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"
    )
    return own.mapInArrow(run, RESULT_DDL)
