"""Links between similar documents, from candidate keys to components.

Shared by the operators that join documents on their sets of shingles. An operator gives every
class of equal sets some keys, so that similar classes are likely (or sure) to share one. From there:

1. Keys of one class are dropped; every other class of a key is paired with the key's smallest
   class. Keys that a sample shows to be very frequent are paired by a combined aggregate, not
   by a shuffle on the key.
2. Confirmed pairs link classes; components of links are what needs no more comparing.
3. What is left under a key with several components is compared exhaustively, but for pairs of one component:
   keys of more than ``BLOCK`` classes in blocks, every two blocks in a task of their own.

So a large group of copies costs a pair per copy, and no pair of classes that share a key
is left uncompared. Before texts move, pairs are tested by sketches: the parities of the set's
tokens in 512 cells, and for larger sets in as many cells as tokens or more. Cells in which two sketches differ each need a token that
only one set has, so their number is a lower bound of the symmetric difference and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronscope.llm.common import fmix64, stored, texts
from patronscope.llm.hashing import FIRST, window_hashes, word_hashes

Needed = tuple[list[int], list[int]]
BLOCK = 1024
NARROW = [f"s{i}" for i in range(8)]
SKETCH = [*NARROW, "wide"]
SKETCH_FIELDS = [*((s, pa.int64()) for s in NARROW), ("wide", pa.binary())]
SKETCH_DDL = ", ".join([*(f"{s} long" for s in NARROW), "wide binary"])
#: A key is frequent if a sample of one row in ``SAMPLED`` holds it so often.
SAMPLED, FREQUENT, MOST_FREQUENT = 16, 64, 10_000


def word_list(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case; they end at ASCII white space."""
    return text.lower().split() if text else []


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    values = word_hashes(text.lower()) if text else np.empty(0, np.uint64)
    if not len(values):
        return values
    if len(values) < width:
        return fmix64(window_hashes(values, len(values), FIRST) + np.uint64(len(values)))
    return np.unique(fmix64(window_hashes(values, width, FIRST)))


def parities(values: np.ndarray, cells: int) -> np.ndarray:
    """Parities of the tokens in a power of two of cells, 64 in a number."""
    odd = np.bincount((values & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch(values: np.ndarray) -> list:
    """Eight numbers with the parities in 512 cells; for a set of more tokens also a wide sketch, else NULL."""
    if len(values) <= 512:
        return [*parities(values, 512).tolist(), None]
    wide = parities(values, 1 << (len(values) - 1).bit_length())
    return [*np.bitwise_xor.reduce(wide.reshape(-1, 8)).tolist(), wide.tobytes()]


def wide_difference(a: bytes, b: bytes) -> int:
    """In how many cells two wide sketches differ; the larger one is folded to the other's cells."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)))
    return int(np.bitwise_count(x ^ y).sum())


def documents_of(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def fits(a: Column, b: Column, percent: int) -> Column:
    """Whether the sizes of two sets allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and sketches allow: ``|A - B| <= (100 - p) (|A| + |B|) / (100 + p)``."""
    left, right = (
        classes.select(
            F.col("id").alias(x), F.col("n").alias(f"n_{x}"), *[F.col(s).alias(f"{s}_{x}") for s in SKETCH]
        )
        for x in "ab"
    )
    differ = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in NARROW), F.lit(0))
    both = pairs.join(left, "a").join(right, "b")
    allowed = (100 + percent) * differ <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    both = both.where(fits(F.col("n_a"), F.col("n_b"), percent) & allowed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            a, b, n, m, wide_a, wide_b = (c.to_pylist() for c in x.columns)
            keep = [
                v is None or w is None or (100 + percent) * wide_difference(v, w) <= (100 - percent) * (i + j)
                for i, j, v, w in zip(n, m, wide_a, wide_b)
            ]
            yield x.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "n_a", "n_b", "wide_a", "wide_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity: ``100 * common >= percent * union``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = lru_cache(maxsize=64)(lambda text: shingles(text, width))
        for b in batches:
            keep = []
            for x, y in zip(texts(b.column(2)), texts(b.column(3))):
                x, y = full(x), full(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # one row per id, as pairs stand for ids; equal ids differ in text only by mistake
    docs = documents_of(documents).withColumnRenamed("doc_id", "id").where("id is not null and text is not null")
    with_a = pairs.join(docs.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(docs.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, root`` of every linked id; ``root`` is the smallest id of its component.

    Alternating large-star and small-star steps, each written to the shared folder, until
    nothing changes.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, before = stored(edges.where("u != v").distinct(), "edges"), None
    while True:
        either = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = either.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = either.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        before = after


def shared_keys(rows: DataFrame) -> DataFrame:
    """``key, id, need, first``: rows of the keys of two or more ids; ``first`` is the key's smallest id."""
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLED)) == 0).groupBy("key").count()
    often = some.where(F.col("count") >= FREQUENT).orderBy(F.desc("count")).limit(MOST_FREQUENT)
    often = [r.key for r in often.select("key").collect()]
    own = W.partitionBy("key")
    rest, found = rows, []
    if often:  # at most MOST_FREQUENT numbers
        table = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in often], "key long"))
        rest = rows.join(table, "key", "left_anti")
        hot = rows.join(table, "key")
        first = hot.groupBy("key").agg(F.min("id").alias("first"))
        found = [hot.join(F.broadcast(first), "key")]
    rest = rest.select("key", "id", "need", F.min("id").over(own).alias("first"), F.count("*").over(own).alias("size"))
    found.append(rest.where("size > 1").drop("size"))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


class _Group:
    """Rows of one key and two blocks, as arrays, and the pairs among them that may be links."""

    def __init__(self, percent: int, columns: list[np.ndarray]) -> None:
        self.percent = percent
        self.own, self.id, self.part, self.n = columns[3:7]
        self.marks = np.stack([c.view(np.uint64) for c in columns[7:]], axis=1)
        self.blocks = columns[1][0], columns[2][0]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """One id, others, and the larger size of each two."""
        i, j = self.blocks
        left = np.flatnonzero(self.own == i)
        right = left if i == j else np.flatnonzero(self.own == j)
        for at, x in enumerate(left.tolist()):
            others = right[at + 1 :] if i == j else right
            others = others[self.part[others] != self.part[x]]
            n, m = self.n[x], self.n[others]
            others = others[100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)]
            if not len(others):
                continue
            differ = np.bitwise_count(self.marks[others] ^ self.marks[x]).sum(axis=1, dtype=np.int64)
            allowed = (100 + self.percent) * differ <= (100 - self.percent) * (n + self.n[others])
            others = others[allowed]
            yield np.full(len(others), self.id[x]), self.id[others], np.maximum(n, self.n[others])


def block_pairs(rows: DataFrame, percent: int, needed: Needed) -> DataFrame:
    """Pairs of ids of different parts that share enough keys, and that sizes and sketches allow.

    ``rows`` has ``key, size, id, part, n`` and the sketch; ``size`` is the number of rows of the key.
    """
    sizes, numbers = needed
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id", "key"), n_blocks).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    group = [F.col("key"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
    dealt = dealt.select(*group, "own", "id", "part", F.col("n").cast("long"), *NARROW)
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for b in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if not b.num_rows:
                continue
            if kept is not None:
                columns = [np.concatenate(x) for x in zip(kept, columns)]
            changes = np.zeros(len(columns[0]) - 1, bool)
            for c in columns[:3]:
                changes |= c[1:] != c[:-1]
            cuts = [0, *(np.flatnonzero(changes) + 1).tolist()]
            yield from found([[c[x:y] for c in columns] for x, y in zip(cuts, cuts[1:])])
            kept = [c[cuts[-1] :] for c in columns]
        if kept is not None:
            yield from found([kept])

    def found(groups: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for g in groups:
            for a, b, larger in _Group(percent, g).pairs():
                if len(a):
                    need = np.array(numbers)[np.searchsorted(sizes, larger, "right") - 1]
                    columns = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(need)]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b", "need"])

    pairs = dealt.mapInArrow(run, "a long, b long, need long").where("a != b")
    shared = pairs.groupBy("a", "b").agg(F.count("*").alias("keys"), F.max("need").alias("need"))
    return shared.where("keys >= need").select("a", "b")


def links(
    rows: DataFrame,
    classes: DataFrame,
    documents: DataFrame,
    width: int,
    percent: int,
    needed: Needed = ([0], [1]),
) -> DataFrame:
    """Links that join all classes into components that share a key and reach the similarity.

    ``rows`` has ``key, id, n``, ``classes`` ``id, n`` and the sketch. ``needed`` are sizes, ascending from 0, and how many keys
    two sets that link share at least, if the larger one has that size or more.
    """
    sizes, numbers = needed
    band = F.size(F.filter(F.array(*[F.lit(s).cast("long") for s in sizes]), lambda s: s <= F.col("n")))
    need = F.element_at(F.array(*[F.lit(min(x, 1 << 30)).cast("int") for x in numbers]), band).alias("need")
    rows = stored(shared_keys(rows.select("key", "id", need)), "shared-keys")
    firsts = rows.where("first != id").groupBy(F.col("first").alias("a"), F.col("id").alias("b"))
    # the first of a key is not first in all keys that two sets share: half of them will do here
    tested = firsts.agg(F.count("*").alias("keys"), F.max("need").alias("need")).where("2 * keys >= need")
    tested = tested.select("a", "b")
    tested = stored(likely(tested, classes, percent), "pairs")
    found = stored(confirmed(tested, documents, width, percent), "links")
    roots = components(found)
    parts = rows.select("key", "id").join(roots, "id", "left")
    parts = parts.select("key", "id", F.coalesce("root", "id").alias("part"))
    several = parts.groupBy("key").agg(
        F.count("*").alias("size"), F.min("part").alias("low"), F.max("part").alias("high")
    )
    several = several.where("low != high").select("key", "size")
    left = parts.join(several, "key").join(classes.drop("wide"), "id")
    more = block_pairs(left, percent, needed).join(tested, ["a", "b"], "left_anti")
    more = stored(likely(more, classes, percent), "pairs")
    more = stored(confirmed(more, documents, width, percent), "links")
    return found.unionByName(more)


def class_table(known: DataFrame) -> DataFrame:
    """``set_a, set_b, class_id``: the smallest doc_id of each set that is not empty.

    A table of its own: a set that many documents share is then a join Spark can split.
    """
    full = known.where("n_shingles > 0 and doc_id is not null")
    return stored(full.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("class_id")), "classes")


def first_of_class(known: DataFrame, named: DataFrame) -> DataFrame:
    """The row of each class that stands for it, ``doc_id`` as ``id`` and ``n_shingles`` as ``n``."""
    first = named.withColumnRenamed("class_id", "doc_id")
    rows = known.where("n_shingles > 0").join(first, ["doc_id", "set_a", "set_b"], "left_semi")
    return rows.withColumnsRenamed({"doc_id": "id", "n_shingles": "n"}).drop("set_a", "set_b")


def grouped(known: DataFrame, named: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, kept`` of every document.

    ``component_id`` is the smallest doc_id that links reach; ``kept`` marks the documents that
    are their component's first. NULL doc_ids stand for themselves, empty sets are linked with nothing.
    """
    own = known.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    # an id that stands for several rows links their classes
    full = known.where("n_shingles > 0 and doc_id is not null")
    repeated = full.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    mixed = own.where("n_shingles > 0").join(repeated, "doc_id", "left_semi")
    mixed = mixed.select(F.col("class_id").alias("a"), F.col("doc_id").alias("b")).where("a != b")
    roots = components(found.unionByName(mixed))
    class_id = F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
    own = own.withColumn("class_id", F.when(F.col("doc_id").isNotNull(), class_id))
    linked = own.join(roots.withColumnRenamed("id", "class_id"), "class_id", "left")
    component = F.coalesce("root", "class_id")
    return linked.select(
        "doc_id",
        "n_shingles",
        "class_id",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
