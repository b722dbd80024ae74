"""Quality classifier from compression with two zstandard dictionaries.

One dictionary is built from texts labelled good, one from texts labelled bad. A text is cut
into blocks of ``BLOCK`` bytes, each compressed on its own with either dictionary (so that a
long text can't teach the compressor itself); the sizes are summed over the whole text.
The normalised difference of the two sizes says which class a text is closer to. How well
it compresses by itself, over its own length, is measured the same way, because junk that
repeats itself fits either dictionary. A logistic curve over these two measures, fitted by
Newton's method, turns them into a score between 0 and 1.

The dictionaries and the curve learn from about ``PER_CLASS`` labelled texts of either
class, drawn by a hash of the id, of which at most ``SAMPLE_BYTES`` are used; every text is then
scored whole.

Defined cases: NULL and blank text scores the share of good labels among the blank texts drawn,
or 0 without any; NULL labels and NULL ids teach nothing; without labels of both classes
every text scores the share of good ones (0.5 without labels); an id with several labels
counts once per label; repeated rows and extra columns are kept by ``score``, but
for a column of that name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronscope.llm.common import crc32_mod, drawn, texts

PER_CLASS = 2_500
SAMPLE_BYTES = 8 << 20
#: Longer texts are not drawn for the sample.
SAMPLE_TEXT_BYTES = 1 << 16
DICTIONARY_BYTES = 112 << 10
BLOCK = 1024
LEVEL = 3
ACCEPT = 0.3


@dataclass(frozen=True)
class Model:
    """What a worker needs to score texts."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    blank: float


@lru_cache(maxsize=2)
def _compressors(good: bytes, bad: bytes):
    def one(data: bytes | None):
        how = {"level": LEVEL, "write_content_size": False, "write_checksum": False}
        if data is None:
            return zstandard.ZstdCompressor(**how)
        content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=content, **how)

    return one(good), one(bad), one(None)


def measures(text: bytes, good: bytes, bad: bytes) -> tuple[float, float, float]:
    """Normalised size difference, own compressibility, and the two together."""
    with_good, with_bad, plain = _compressors(good, bad)
    a = b = 0
    for at in range(0, len(text), BLOCK):
        block = text[at : at + BLOCK]
        a += len(with_good.compress(block))
        b += len(with_bad.compress(block))
    difference = (b - a) / max(a, b)
    own = len(plain.compress(text)) / len(text)
    return difference, min(own, 1.5), difference * min(own, 1.5)


def _features(x: np.ndarray) -> np.ndarray:
    d, own, both = x.T
    short = np.minimum(own, 1.0)
    return np.column_stack([np.ones(len(x)), 8 * d, short, short**2, 4 * both, 8 * np.abs(d)])


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a small ridge."""
    f = _features(x)
    w = np.zeros(f.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        slope = f.T @ (y - p) - 1e-2 * w
        bend = (f * (p * (1 - p))[:, None]).T @ f + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(samples: list[bytes]) -> bytes:
    """Blocks from all over the samples, as many as the dictionary holds."""
    blocks = [t[i : i + BLOCK] for t in samples for i in range(0, len(t), BLOCK)]
    step = max(1, len(blocks) * BLOCK // DICTIONARY_BYTES)
    return b"\n".join(blocks[::step])[:DICTIONARY_BYTES]


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Learns from ``doc_id, text`` of documents and ``doc_id, quality`` of labels.

    The labels are drawn first; only the drawn ones meet the documents, as a broadcast table of
    ``4 * PER_CLASS`` rows at most, so no text is shuffled.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    known = known.where("doc_id is not null and quality in (0, 1)")
    n = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    good, bad = n.get(1, 0), n.get(0, 0)
    some = [
        drawn(known.where(F.col("quality") == label), F.col("doc_id"), PER_CLASS, n.get(label, 0))
        for label in (0, 1)
    ]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    short = documents.select("doc_id", text.alias("text")).where(F.octet_length("text") <= SAMPLE_TEXT_BYTES)
    rows = short.join(F.broadcast(some[0].unionByName(some[1])), "doc_id").collect()
    found: dict[int, list[bytes]] = {0: [], 1: []}
    size = {0: 0, 1: 0}
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.text))
    while rows:
        r = rows.pop()
        data = r.text.encode()
        size[r.quality] += len(data)
        if size[r.quality] <= SAMPLE_BYTES:
            found[r.quality].append(data)
    share = (len(found[1]) + 0.5) / (len(found[0]) + len(found[1]) + 1)
    empty = [sum(not t.strip() for t in found[label]) for label in (0, 1)]
    blank = empty[1] / sum(empty) if sum(empty) else 0.0
    for label in found:
        found[label] = [t for t in found[label] if t.strip()]
    if not found[0] or not found[1]:
        flat = float(np.log(share / (1 - share)))
        return Model(b"", b"", (flat, 0.0, 0.0, 0.0, 0.0, 0.0), blank)
    # either half of the texts is measured with dictionaries of the other
    x, y = [], []
    for half in (0, 1):
        books = [_dictionary(found[label][1 - half :: 2] or found[label]) for label in (1, 0)]
        for label in (0, 1):
            own = found[label][half::2]
            x += [measures(text, *books) for text in own]
            y += [label] * len(own)
    books = [_dictionary(found[label]) for label in (1, 0)]
    weights = _fit(np.array(x), np.array(y, float))
    # the sample holds equal parts at most; the intercept takes the corpus's share
    weights[0] += np.log(good / bad) - np.log(max(sum(y), 1) / max(len(y) - sum(y), 1))
    return Model(*books, tuple(weights.tolist()), blank)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of the documents and ``score``."""
    documents = documents.drop("score")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")
    schema = documents.withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            data = texts(b.column(at))
            known = [i for i, t in enumerate(data) if t and t.strip()]
            out = np.full(len(data), model.blank)
            if known:
                x = np.array([measures(data[i], model.good, model.bad) for i in known])
                z = np.clip(_features(x) @ np.array(model.weights), -30, 30)
                out[known] = 1 / (1 + np.exp(-z))
            columns = [*b.columns, pa.array(out)]
            yield pa.RecordBatch.from_arrays(columns, [*b.schema.names, "score"])

    return documents.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)


def held_out() -> Column:
    return crc32_mod("doc_id", 5) == 0


def learnable(labels: DataFrame) -> DataFrame:
    """The labels of documents that are not held out."""
    return labels.select("doc_id", "quality").where(~held_out())
