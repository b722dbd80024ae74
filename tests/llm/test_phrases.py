"""Phrase collocations against counting every phrase."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from patronscope.llm import hashing, phrases


def plain(rows, least, max_words, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        totals[lang] += 0
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            inside = [
                b
                for q, b in found.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= 50 * a for b in inside):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Ünï", "été", "A\x00b", "x-y", "\U0001f600", " ", "İ"]
    fixed = ["new york city", "New  York\tcity", "in the end of", "once upon a time"]
    rows = []
    for i in range(300):
        parts = [pick.choice(words) for _ in range(pick.randrange(30))] + [pick.choice(fixed)]
        pick.shuffle(parts)
        text = "".join(p + pick.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for p in parts)
        rows.append((pick.choice(["en", "en", "de", None, ""]), text))
    return rows + [("en", None), ("fr", ""), (None, None), ("de", "one")] + [("en", "same row again, same row again")] * 40


@pytest.mark.parametrize("least, max_words, top, shards", [(10, 3, 2000, 4), (3, 4, 7, 5), (6, 2, 50, 1), (2, 5, 99, 9)])
def test_equals_counting_everything(spark, least, max_words, top, shards):
    rows = corpus(least)
    docs = spark.createDataFrame([(i % 50, *r, 1, "x") for i, r in enumerate(rows)], "doc_id long, lang string, text string, a int, phrase string")
    found = got(phrases.collocations(docs, least, max_words, top, shards))
    assert found == plain(rows, least, max_words, top) and found


def test_one_very_long_text_in_parts(spark, monkeypatch):
    text = "the quick fox. the quick dog, a lazy dog; " * 30_000
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    assert got(phrases.collocations(docs)) == plain([("en", text)], 10, 3, 2000)
    data = text.encode()
    monkeypatch.setattr(phrases, "CUT_BYTES", 1000)
    parts = list(phrases._parts(data))
    assert b"".join(parts) == data and all(p[-1:] in b".,;" for p in parts[:-1]) and max(map(len, parts)) < 1100


def test_small_chunks_give_the_same(monkeypatch):
    rows = corpus(1)
    batch = pa.RecordBatch.from_pydict(
        {"lang": [r[0] or "und" for r in rows], "text": [r[1] or "" for r in rows]}
    )

    def counted(size):
        monkeypatch.setattr(phrases, "CHUNK_WORDS", size)
        total = Counter()
        for chunk in phrases._chunks(iter([batch])):
            for k in (1, 2, 3):
                if k > 1:
                    chunk.grow()
                places, n = chunk.phrases(np.flatnonzero(chunk.inside))
                for i, phrase, c in zip(places.tolist(), chunk.texts(places).to_pylist(), n.tolist()):
                    total[chunk.langs[chunk.lang[i]], phrase] += c
        return total

    assert counted(50) == counted(10**9)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "lang string, text string")
    read = phrases._read(docs)
    everything = b"\xff" * (phrases.FILTER_BITS // 8)
    counts = phrases.global_counts(read, everything, 3).where("phrase is not null and n >= 10")
    exact = phrases.global_counts(read, phrases.candidates(read, 10, 3, 4), 3).where("phrase is not null and n >= 10")
    assert got(counts) == got(exact) and counts.count() > 20


def test_products_beyond_64_bits(spark):
    n = 9_000_000_000_123
    rows = [("en", "a", n), ("en", "b", n + 5), ("en", "a b", n - 7)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, a long")
    row = phrases.scored(frequent).first()
    assert row.score == 1_000_000 * (n - 7) ** 2 // (n * (n + 5)) and (row.l, row.r) == (n, n + 5)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert phrases.collocations(docs).collect() == []


def test_words_are_hashed_without_being_numbered():
    texts = ["Ab.c,  d\te \u00e9\u00c9! x y", "", "a", ". .", "ab c ab c", "\u2003wide\u2003 a\x00b"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de", "und", "en", "de", "en"], "text": texts})
    (bare,), (full,) = phrases._chunks(iter([batch]), exact=False), phrases._chunks(iter([batch]))
    assert not hasattr(bare, "ids")
    for size in (1, 2, 3):
        if size > 1:
            bare.grow(with_codes=False)
            full.grow()
        assert bare.hashes.tolist() == full.hashes.tolist() and bare.inside.tolist() == full.inside.tolist()
        places, n = full.phrases(np.flatnonzero(full.inside))
        own = zip(full.lang[places].tolist(), full.texts(places).to_pylist(), n.tolist())
        found = {(full.langs[lang].decode(), phrase): c for lang, phrase, c in own}
        assert len(set(full.hashes[places].tolist())) == len(found)
        want = Counter()
        for lang, text in zip(["en", "de", "und", "en", "de", "en"], texts):
            for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
                words = re.findall(r"[^\x20\x09]+", piece)
                want.update((lang, " ".join(words[i : i + size])) for i in range(len(words) - size + 1))
        assert found == want


def test_word_places_of_a_long_text_in_pieces(monkeypatch):
    text = b" a bb\tccc  " * 50
    starts, ends, hashes = hashing.word_places(text)
    monkeypatch.setattr(hashing, "PIECE", 7)
    for whole, pieces in zip((starts, ends, hashes), hashing.word_places(text)):
        assert whole.tolist() == pieces.tolist()
    assert [text[a:b] for a, b in zip(starts, ends)] == text.split()


def test_memory_of_a_chunk(monkeypatch):
    """What a task of the first pass takes beside its batches, one chunk after the other."""
    taken = []
    counts = SimpleNamespace(groupBy=lambda *_: SimpleNamespace(agg=lambda *_: None))
    read = SimpleNamespace(mapInArrow=lambda run, _: taken.append(run) or SimpleNamespace(repartition=lambda _: counts))
    monkeypatch.setattr(phrases, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 6)))
    monkeypatch.setattr(phrases, "F", SimpleNamespace(sum=lambda _: SimpleNamespace(alias=lambda _: None)))
    phrases.local_counts(read, range(1, 3), 4)
    pick = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in row) for row in pick.integers(0, 200_000, (22_000, 100)).tolist()]
    given = [pa.RecordBatch.from_pydict({"lang": ["en"] * 1000, "text": texts[i : i + 1000]}) for i in range(0, 22_000, 1000)]
    found = 0
    tracemalloc.start()
    try:
        for b in taken[0](iter(given)):
            found += pa.compute.sum(b.column(2)).as_py()
            assert set(b.column(1).to_pylist()) == {2} and b.num_rows <= 1 << 16
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 22_000 * (100 + 99)
    assert peak < 100 * phrases.CHUNK_WORDS
