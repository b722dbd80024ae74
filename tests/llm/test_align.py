"""Alignment of two tokenizers against a plain walk over the bytes."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from patronscope.llm import align, queries, tokens

FOLDER = tokens.folder()


def byte_of():
    """The byte of each character in which the vocabulary writes bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


def plain(texts):
    """Rows of the result, in the order of the texts, from the tokenizers' own tokens."""
    a_tokenizer = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    a_tokenizer.encode_special_tokens = True
    b_tokenizer = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")
    byte = byte_of()
    rows, links = [], []
    for text in texts:
        own, groups = [], []
        a_ids = b_ids = []
        if text:
            a = a_tokenizer.encode(" " + text, add_special_tokens=False)
            a_bytes = [bytes(byte[c] for c in t) for t in a.tokens]
            b_ids = b_tokenizer.encode(text)
            b_names = [b_tokenizer.id_to_piece(i) for i in b_ids]
            b_bytes = [
                bytes([int(n[3:5], 16)]) if b_tokenizer.is_byte(i) else n.replace("▁", " ").encode()
                for i, n in zip(b_ids, b_names)
            ]
            a_ids = a.ids
            if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_ids = b_ids = []
        if a_ids:
            left, right, i, j, at_a, at_b = [], [], 0, 0, 0, 0
            while i < len(a_ids) or j < len(b_ids):
                if j == len(b_ids) or (i < len(a_ids) and at_a + len(a_bytes[i]) <= at_b + len(b_bytes[j])):
                    at_a += len(a_bytes[i])
                    left.append(a_ids[i])
                    i += 1
                else:
                    at_b += len(b_bytes[j])
                    right.append(b_ids[j])
                    j += 1
                if at_a == at_b:
                    groups.append((left, right))
                    own.append((left[-1], right[-1]))
                    left, right = [], []
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append([len(a_ids), len(b_ids), len(groups), len(own), hashlib.sha256(shown.encode()).hexdigest() if groups else ""])
        links.append(own)
    count = Counter(p for own in links for p in own)
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    return [
        (*r[:4], sum(count[p] == highest[p[1]] for p in own), sum(count[p] for p in own), r[4])
        for r, own in zip(rows, links)
    ]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


TEXTS = [
    None, "", " ", "  ", "a", "plain words and more plain words", "a  b", " lead", "trail ", "\n x\t\ty\r\n", "▁x ▁",
    "<|endoftext|> <s>x</s> <unk> <0x41>", "\x00a", "Ünïcödé é́ ﬁ Å", "　a　", "\U0001f600 emoji \U0001f468‍\U0001f469",
    "你好 世界", "it's don't we'll 12345 3.14", "x" * 3000, "ab " * 30_000, "مرحبا", "a b", "  q \x85 r",
]


def test_odd_texts(spark):
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(None, "a", 2, "y"), (4, "a", 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, pair string")
    want = [(r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows]))]
    assert got(align.align(docs)) == sorted(want, key=repr)


def test_query_on_the_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, *w) for (d, _), w in zip(docs, plain([t for _, t in docs]))]
    assert got(queries.op11_token_alignment(spark, sf)) == sorted(want, key=repr)


def test_no_rows(spark):
    assert got(align.align(spark.createDataFrame([], "doc_id long, text string"))) == []


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1000])
def test_pieces_of_any_size_give_the_same_overlaps(work):
    random = np.random.default_rng(work)
    for _ in range(60):
        # steps of 0 are tokens without bytes
        a, b = (np.cumsum(random.integers(0, 4, random.integers(0, 40))) for _ in range(2))
        i, j = align.overlaps(a, b, work)
        want = [(x, y) for x in range(len(a)) for y in range(len(b)) if a[x] == b[y]]
        assert sorted(zip(i.tolist(), j.tolist())) == want
        cuts = align.diagonal_cuts(a, b, work)
        assert cuts[-1] == (len(a), len(b)) and cuts == sorted(set(cuts))


def test_pieces_are_equal_work():
    a, b = np.arange(1, 90_001, 1), np.arange(3, 90_001, 3)
    cuts = align.diagonal_cuts(a, b, 1000)
    steps = [i1 + j1 - i0 - j0 for (i0, j0), (i1, j1) in zip(cuts, cuts[1:])]
    assert max(steps) <= 1002 and len(steps) == 120


def test_small_pieces_give_the_same_groups():
    known = align.vocabularies(FOLDER)
    encoded = known.encode(["some words, and then some more", None, "l'été \U0001f600"])
    whole = [(n, d, x.tolist()) for n, d, x in align.aligned(encoded, known)]
    assert whole == [(n, d, x.tolist()) for n, d, x in align.aligned(encoded, known, 2)] and whole[1] == (0, "", [])


def test_the_vocabularies_bound_the_pairs():
    class Two:
        a, b = [b"a", b"ba", b"c"], [b"a", b"ba", b"cba", b"x", b"a"]

    ends = sum(x.endswith(y) or y.endswith(x) for x in Two.a for y in Two.b)
    assert align.possible_pairs(Two) == ends == 8
    assert align.possible_pairs(align.vocabularies(FOLDER)) < 600_000


def test_ids_equal_the_tokenizer(spark, sf):
    texts = [t for t in TEXTS if t] + [
        r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.text
    ]
    random = np.random.default_rng(1)
    letters = [*"ab 1.\n'\t", "  ", "é", "世", "\U0001f600", "́", "’s", " ", "<|endoftext|>", " <|", " "]
    texts += ["".join(random.choice(letters, random.integers(1, 40))) for _ in range(3000)]
    for special in (True, False):
        tokenizer = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
        tokenizer.encode_special_tokens = not special
        encode = tokens.encoder(FOLDER, special).ids
        for t in texts:
            assert encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
