"""Packing: exact ids, each once, little padding, neighbours together."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from patronscope.llm import packing, queries, tokens


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = [
    "plain words here",
    " leading space",
    "trailing ",
    "two  spaces\n\nand lines\n next\tx",
    "a b   c",
    "éèß Ünï 漢字 😀 mixed,text's don't I'LL",
    "<|endoftext|> inside<|endoftext|>text <|x",
    "123 4567 a1b2 ___ *** &&& ٣٤",
    "x" * 5000,
    "\x1c\x85 \x0b\x0c odd",
    " ",
    "",
]


def test_ids_equal_the_tokenizer(tokenizer, sf, spark):
    encoder = tokens.Encoder(tokens.folder())
    given = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    pick = random.Random(1)
    mixed = ["".join(pick.choice("ab,.! \n\té'1") for _ in range(40)) for _ in range(300)]
    for text in TEXTS + given + mixed:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == want, text


def check(rows, docs, tokenizer, window):
    """Every id of every document lies in one piece, sequences have no gaps."""
    want = {}
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.setdefault(doc_id, []).append(ids)
    pieces, rows_of = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        rows_of[r.sequence_id].append(r)
    assert set(pieces) == set(want)
    for doc_id, own in pieces.items():
        assert sum(r.length for r in own) == sum(map(len, want[doc_id]))
        if len(want[doc_id]) == 1:
            ids, at = want[doc_id][0], 0
            for r in sorted(own, key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
                data = np.array(ids[at : at + r.length], "<u4").tobytes()
                assert r.ids_crc32 == zlib.crc32(data)
                at += r.length
    padding = 0
    for own in rows_of.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_query_on_the_table(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert check(queries.op8_packing(spark, sf).collect(), docs, tokenizer, 2048) == 0


def test_edge_rows(spark, tokenizer):
    docs = [*enumerate(TEXTS), (50, None), (3, TEXTS[3]), (None, "no id"), (51, "long " * 3000)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, shard int, ids string")
    assert check(packing.pack(df, window=64, shard_tokens=500).collect(), docs, tokenizer, 64) == 0
    assert packing.pack(df.limit(0)).collect() == []


def test_neighbours_share_sequences(spark):
    pick = random.Random(2)
    topics = [
        "river lake ocean water boat fish swim wave".split(),
        "piano guitar music song singer concert drum opera".split(),
        "bread cheese butter soup salad dinner kitchen cook".split(),
        "engine wheel truck highway driver fuel brake motor".split(),
        "doctor nurse hospital patient medicine surgery health fever".split(),
        "judge court lawyer crime trial prison police justice".split(),
    ]
    docs = [(i, " ".join(pick.choice(topics[i % 6]) for _ in range(30))) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = packing.pack(df, window=256).collect()
    kinds = defaultdict(list)
    for r in rows:
        kinds[r.sequence_id].append(r.doc_id % 6)
    same = sum(max(map(k.count, set(k))) for k in kinds.values())
    assert same > 0.6 * len(rows)


def test_shards_use_every_document_once():
    pick = random.Random(3)
    ids = [np.array([pick.randrange(50) for _ in range(pick.choice([1, 5, 40, 300]))]) for _ in range(200)]
    shard = packing.Shard(ids, np.ones(tokens.VOCABULARY_SIZE), 60.0)
    seen = defaultdict(int)
    for row in packing.sequences([len(x) for x in ids], shard, 64):
        assert sum(r[2] for r in row) <= 64
        for doc, start, length in row:
            assert start == seen[doc]
            seen[doc] += length
    assert [seen[i] for i in range(200)] == [len(x) for x in ids]
