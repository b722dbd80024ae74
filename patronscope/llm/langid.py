"""Language identification with averaged hashed subword embeddings and a linear softmax.

A text is read in lower case as words of letters; its subwords are the byte n-grams of
``SIZES`` within a word and its two edges, hashed to ``BUCKETS`` rows of an embedding table. The mean
of a text's rows goes through a linear layer and a softmax. Both are trained by stochastic
gradient descent in numpy on a bounded sample of labelled texts. The temperature of the softmax
and the bounds below which a prediction is rejected are set on a part of the sample that the
training doesn't see. The temperature minimises a loss with smoothed labels, which stays finite where languages are
easily told apart. Each class of lengths has its own bound: rejected are scores below the one that
keeps ``PRECISION`` of the rest right, and those lower than all but ``UNLIKELY`` of the right answers.

As the layer is linear, the product of the embedding table with it is one small table of logits per
bucket; scoring a text is one look-up and sum per subword over the whole text.

Defined cases: text that is NULL or has no letters is ``und`` with score 0 and is rejected;
so is every text where nothing could be learned; NULL labels teach nothing; NULL ids
count as '' for the fold; repeated rows are repeated; other columns are kept by
``predict``, but for ones named like its results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronscope.llm.common import crc32_mod, drawn, texts

SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 16
DIMENSIONS = 16
SAMPLE_ROWS = 2_000
#: Longer texts are not drawn for the sample, which so stays below 130 MB.
SAMPLE_TEXT_BYTES = 1 << 16
#: Subwords of one training text, drawn from the whole text.
TEXT_SUBWORDS = 400
STEPS, RATE = 24_000, 0.5
#: Subwords of the short texts that the calibration adds.
SHORT = (6, 12, 25, 50)
#: Where the length classes begin after the first: each is judged by the longest draw that it covers.
LENGTHS = (*SHORT[1:], 4 * SHORT[-1])
PRECISION, UNLIKELY = 0.99, 0.01
#: Share of the labels' weight that the loss of the temperature gives to the other languages.
SMOOTHED = 0.01
UNKNOWN = "und"
#: Bytes that are no letters become spaces; what is above ASCII stays.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def subwords(text: bytes) -> np.ndarray:
    """Buckets of all subwords of a text in lower case."""
    data = b" " + b" ".join(text.translate(_LETTERS).split()) + b" "
    x = np.frombuffer(data, np.uint8).astype(np.uint32)
    out, code = [], x
    space = x == 32
    for size in range(1, max(SIZES) + 1):
        n = len(x) - size + 1
        if n <= 0:
            break
        if size > 1:
            code = code[:n] * np.uint32(257) + x[size - 1 :]
        if size in SIZES:
            # a space may only be the first or the last byte
            keep = ~space[:n] if size == 1 else np.ones(n, bool)
            for inner in range(1, size - 1):
                keep &= ~space[inner : inner + n]
            mixed = (code[keep] + np.uint32(size)) * np.uint32(2654435761)
            out.append(mixed >> np.uint32(16))
    return np.concatenate(out).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # logits per bucket
    bias: np.ndarray
    temperature: float
    least: tuple[float, ...]  # by length: the sizes of SHORT, then whole texts

    def bound(self, n: int) -> float:
        """The least accepted score of a text of ``n`` subwords."""
        return self.least[int(np.searchsorted(LENGTHS, n, "right"))]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """Trains on ``(language, text in lower case)``."""
    random = np.random.default_rng(seed)
    languages = tuple(sorted({lang for lang, _ in rows}))
    samples = []
    for lang, text in rows:
        found = subwords(text.encode())
        if len(found):
            samples.append((languages.index(lang), found))
    if not samples:
        return None
    order = random.permutation(len(samples))
    cut = max(1, len(samples) // 5)
    checked, learned = order[:cut], order[cut:] if len(order) > cut else order
    embedding = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, epochs = 0, -(-STEPS // len(learned))
    total = epochs * len(learned)
    for _ in range(epochs):
        for i in random.permutation(learned):
            language, found = samples[i]
            if len(found) > TEXT_SUBWORDS:
                found = random.choice(found, TEXT_SUBWORDS)
            rate = RATE * (1 - steps / total)
            steps += 1
            mean = embedding[found].mean(axis=0)
            slope = _softmax(mean @ layer + bias)
            slope[language] -= 1
            back = layer @ slope
            layer -= rate * np.outer(mean, slope)
            bias -= 0.1 * rate * slope
            # every subword has its share of the mean
            np.subtract.at(embedding, found, (rate / len(found)) * back)
    table = embedding @ layer
    # short draws from the texts, of which the model must be less certain, and whole texts
    rows, truth = [], np.array([samples[i][0] for i in checked])
    for size in (*SHORT, None):
        draws = [samples[i][1] if size is None else random.choice(samples[i][1], size) for i in checked]
        rows.append(np.array([table[few].mean(axis=0) + bias for few in draws]))
    logits, every = np.concatenate(rows), np.tile(truth, len(rows))
    others = SMOOTHED / max(len(languages) - 1, 1)

    def loss(t: float) -> float:
        log_p = np.log(_softmax(logits.astype(np.float64) * t) + 1e-300)
        own = log_p[np.arange(len(every)), every]
        return -float(((1 - SMOOTHED - others) * own + others * log_p.sum(axis=1)).mean())

    temperature = float(min(2.0 ** np.arange(-5, 5, 0.125), key=loss))
    least = []
    for own in rows:
        p = _softmax(own * temperature)
        right, score = p.argmax(axis=1) == truth, p.max(axis=1)
        order = np.argsort(score)
        precise = np.cumsum(right[order][::-1])[::-1] >= PRECISION * np.arange(len(score), 0, -1)
        bound = score[order][int(precise.argmax())] if precise.any() else 1.0
        unlikely = np.quantile(score[right], UNLIKELY) if right.any() else 1.0
        least.append(float(max(bound if not precise[0] else 0.0, unlikely)))
    return Model(languages, table.astype(np.float32), bias, temperature, tuple(least))


def train(documents: DataFrame) -> Model | None:
    """Learns from ``text`` and ``lang`` of a bounded sample, drawn by a hash of the text."""
    known = documents.select(
        F.lower(F.col("text").cast("string")).alias("text"), F.col("lang").cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & (F.octet_length("text") <= SAMPLE_TEXT_BYTES))
    rows = drawn(known, F.col("text"), SAMPLE_ROWS, known.count()).collect()
    return fit(sorted((r.lang, r.text) for r in rows))


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """All columns, and ``lang_pred, score, rejected``."""
    spark = documents.sparkSession
    documents = documents.drop("lang_pred", "score", "rejected")
    names = documents.columns
    schema = documents.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")).schema
    shared = spark.sparkContext.broadcast(model)
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            langs, scores, least = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows), np.ones(b.num_rows)
            has_letter = b.column(n + 1).to_pylist()
            for i, text in enumerate(texts(b.column(n))):
                if model is None or not has_letter[i]:
                    continue
                found = subwords(text)
                logits = model.bias.astype(np.float64)
                if len(found):
                    logits = logits + model.table[found].mean(axis=0, dtype=np.float64)
                p = _softmax(logits * model.temperature)
                best = int(p.argmax())
                langs[i], scores[i] = model.languages[best], min(float(p[best]), 1.0)
                least[i] = model.bound(len(found))
            rejected = [x == UNKNOWN or bool(s < y) for x, s, y in zip(langs, scores, least)]
            columns = [*b.columns[:n], pa.array(langs), pa.array(scores), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score", "rejected"])

    text = F.col("text").cast("string")
    read = documents.select(
        "*", F.lower(text), F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    )
    return read.mapInArrow(run, schema)


def held_out() -> Column:
    return crc32_mod("doc_id", 3) == 1
