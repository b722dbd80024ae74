"""Near-duplicate documents by a chosen-path set similarity join.

A document's set is its distinct shingles of words. Equal sets are one class, whose
smallest doc_id stands for it; only these representatives are joined.

Chosen path. Independent trees branch the representatives by minwise tokens: at each level a
tree takes the minimum of the set under some of ``POOL`` hash functions, and documents that
agree stay together in a node. After ``DEPTH`` levels the documents of a node are compared with each
other, whatever their number: first each with the node's smallest, which joins the copies of a group; then
all of the node that are not in one component yet, large nodes in blocks of bounded size
(see ``linking``). So a pair with the least similarity s that meets in a tree is always compared, it meets with
probability s ** DEPTH, and the number of trees follows from the recall asked for. Pairs that sizes and
parity sketches allow are confirmed on the full sets of both texts.

Links go through components by alternating large-star and small-star steps, each written to
the shared folder, until nothing changes.

Defined cases: NULL text and text without words have an empty set, linked with nothing; a
document with fewer words than a shingle has its whole sequence as its one shingle; rows that repeat a
doc_id count as one document (if their texts differ, they are linked by their id); NULL
doc_ids are not linked, stand for themselves (component NULL) and are kept; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.llm import linking
from patronscope.llm.common import batch, fmix64, small_batches, stored, texts
from patronscope.llm.hashing import FIRST
from patronscope.llm.linking import SKETCH, SKETCH_DDL, SKETCH_FIELDS, components, shingles, sketch, word_list

__all__ = ["components", "n_trees", "near_duplicates", "shingles", "word_list"]

POOL = 64
DEPTH = 5
RECALL = 0.9995

SETS = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64())]
    + SKETCH_FIELDS
    + [("nodes", pa.list_(pa.int64()))]
)
SETS_DDL = (
    f"doc_id long, n_shingles long, set_a long, set_b long, {SKETCH_DDL}, nodes array<bigint>"
)


def n_trees(recall: float, similarity: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**DEPTH))


def _choices(trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers of the minwise functions, and the functions each tree takes in turn."""
    random = np.random.default_rng(20)
    multipliers = random.integers(1 << 62, 1 << 63, POOL, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return multipliers, np.array([random.permutation(POOL)[:DEPTH] for _ in range(trees)])


def _paths(values: np.ndarray, multipliers: np.ndarray, turns: np.ndarray) -> list[int]:
    """The node of a set in each tree."""
    least = np.full(POOL, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 4096):
        some = values[None, at : at + 4096] * multipliers[:, None]
        np.minimum(least, some.min(axis=1), out=least)
    key = np.arange(len(turns), dtype=np.uint64)
    for level in range(DEPTH):
        key = fmix64(key * np.uint64(FIRST) + least[turns[:, level]] + np.uint64(1))
    return key.view(np.int64).tolist()


def sets(documents: DataFrame, width: int, similarity: float, recall: float = RECALL) -> DataFrame:
    """Per document: size, 128-bit digest and sketch of its set, and its nodes in all trees."""
    multipliers, turns = _choices(n_trees(recall, similarity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[] for _ in SETS]
            for doc_id, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                values = shingles(text, width)
                digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                a, c = np.frombuffer(digest, np.int64).tolist()
                nodes = _paths(values, multipliers, turns) if len(values) else None
                for column, v in zip(columns, (doc_id, len(values), a, c, *sketch(values), nodes)):
                    column.append(v)
            yield batch(SETS, columns)

    return linking.documents_of(documents).mapInArrow(run, SETS_DDL)


def near_duplicates(
    documents: DataFrame, width: int = 5, similarity: float = 0.8, recall: float = RECALL
) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, kept`` of every document.

    ``class_id`` is the smallest doc_id with an equal set, ``component_id`` the smallest that
    links reach; ``kept`` marks the documents that are their component's first.
    """
    with small_batches(documents.sparkSession):
        known = stored(sets(documents, width, similarity, recall), "shingle-sets")
        named = linking.class_table(known)
        first = linking.first_of_class(known, named)
        classes = stored(first.select("id", "n", *SKETCH), "class-sketches")
        rows = first.select("id", "n", F.explode("nodes").alias("key"))
        found = linking.links(rows, classes, documents, width, round(100 * similarity))
    return linking.grouped(known, named, found)
