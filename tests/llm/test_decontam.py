"""Decontamination against a brute-force search of every window."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from patronscope.llm import decontam, queries

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def folded(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return WORDS.findall(lower)


def brute(docs, items, window):
    windows = {}
    for item_id, text in items:
        w = folded(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item_id)
    sizes = {len(k) for k in windows}
    out = []
    for doc_id, text in docs:
        w = folded(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                ids = windows.get(tuple(w[i : i + size]))
                if ids:
                    hit |= set(range(i, i + size))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def test_random_texts(spark, monkeypatch):
    pick = random.Random(1)
    text = lambda n: " ".join(pick.choice(["a", "B", "c,", "é", "7"]) for _ in range(n))
    items = [(i, text(pick.randint(0, 9))) for i in range(12)] + [(3, "a b"), (50, None), (51, "")]
    docs = [(i, text(pick.randint(0, 60))) for i in range(60)] + [(7, None), (7, ""), (None, "a b c")]
    items += [(60, items[0][1]), (61, items[5][1])]  # equal texts
    for words, at_once in ((100_000, 4), (8, 50), (20, 2)):  # one automaton, several, several passes
        monkeypatch.setattr(decontam, "WORDS_PER_AUTOMATON", words)
        monkeypatch.setattr(decontam, "AT_ONCE", at_once)
        assert got(decontam.hits(*frames(spark, docs, items), window=5)) == brute(docs, items, 5)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab ", max_size=25), max_size=6), st.text("abc ", max_size=60), st.integers(1, 5))
def test_matcher(items, text, window):
    items = list(enumerate(items))
    matcher = decontam.Matcher([(str(i), t.encode()) for i, t in items], window)
    w = decontam.words(text.encode())
    hit = bytearray(len(w))
    found, _ = matcher.match(w, hit)
    row = brute([(0, text)], items, window)[0]
    assert (sum(hit), len(found)) == (row[2], row[3])
    assert hashlib.sha256(",".join(sorted(found)).encode()).hexdigest() == row[4]


def test_query_on_the_table(spark, sf):
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(*c[t]).collect()]
    c = {"documents": ("doc_id", "text"), "benchmark": ("item_id", "text")}
    assert got(queries.op9_decontamination(spark, sf)) == brute(read("documents"), read("benchmark"), 10)


def test_empty_tables(spark):
    docs, items = frames(spark, [], [])
    assert got(decontam.hits(docs, items)) == []
    docs, items = frames(spark, [(1, "a b")], [])
    assert got(decontam.hits(docs, items)) == brute([(1, "a b")], [], 10)


def test_spans_are_cut_out(spark):
    item = "one two three four five six seven eight nine ten eleven"
    ddl = "doc_id long, text string, item_id string, n_chars long"
    docs = spark.createDataFrame(
        [
            (1, f"Keep  this, {item.upper()}! and a longer rest of words that stays in the text", "x", 0),
            (2, f"{item} and", "x", 0),
            (3, "clean\ttext", None, 0),
            (4, None, None, None),
        ],
        ddl,
    )
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontam.decontaminate(docs, items).collect()}
    assert set(rows) == {1, 3, 4}
    assert rows[1].text == "Keep  this, ! and a longer rest of words that stays in the text"
    assert rows[1].n_chars == len(rows[1].text) and rows[3].text == "clean\ttext"
    assert rows[4].text is None
