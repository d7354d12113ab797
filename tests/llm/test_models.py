from __future__ import annotations

import random
import zlib

import pytest

from tickloom.llm import compression, langid

KINDS = {"en": "the house of cards and the street with ", "fr": "le chien est dans la maison avec ", "de": "der hund ist nicht im haus und "}


def text_of(rng, lang, n=30):
    words = KINDS[lang].split()
    return " ".join(rng.choice(words) for _ in range(n))


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture
def spoken(spark):
    rng = random.Random(1)
    rows = [(i, text_of(rng, lang := rng.choice(list(KINDS))), lang) for i in range(300)]
    rows += [(1000, None, "en"), (1001, "", "fr"), (1002, "123 !! 4", None), (None, text_of(rng, "de"), None), (1003, "é " * 30_000, None)]
    rows += [(5, rows[5][1], rows[5][2])] * 2
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS id", "'q' AS score")


def test_languages_of_held_out_texts(spoken):
    rows, df = spoken
    model = langid.fit(langid.training_sample(df))
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows)
    by_id = {r.id: r for r in got}
    for i, text, lang in rows[:300]:
        assert by_id[i].lang_pred == lang
        assert 0.5 < by_id[i].score <= 1
    for i in (1000, 1001, 1002):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[None].lang_pred == "de"
    assert by_id[1003].lang_pred in KINDS


def test_held_out_rows_and_labels_are_not_learned_from(spoken, spark):
    rows, df = spoken
    ids = {r.id for r in langid.training_sample(df).collect()}
    assert ids and not any(is_held_out(i) for i in ids)
    changed = [(i, t, "xx" if i is not None and is_held_out(i) else lang) for i, t, lang in rows]
    other = spark.createDataFrame(changed, "doc_id long, text string, lang string")
    assert langid.fit(langid.training_sample(other)).languages == ("de", "en", "fr")


def test_texts_of_a_batch_do_not_touch_each_other(spoken):
    import numpy as np

    texts = [b"", b"a", b"ab", b"", b"abc", b"abcd\xc3\xa9", b"x" * 50]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    table = np.random.default_rng(0).normal(size=(langid.BUCKETS, 3))
    total, number = langid._sums(table, data, offsets)
    for k, t in enumerate(texts):
        alone, n = langid._sums(table, np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert n[0] == number[k] and np.allclose(alone[0], total[k])


def test_no_language_learned_and_empty_tables(spark, empty):
    assert langid.fit(langid.training_sample(empty)) is None
    assert langid.predict(empty, None).count() == 0
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.predict(df, langid.fit(langid.training_sample(df))).collect()] == [(1, "und", 0.0, True)]


@pytest.fixture
def judged(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        text = text_of(rng, "en", 60)
        rows.append((i, text if good else " ".join(w.upper() + rng.choice(["!!", "$$$", "%%%"]) for w in text.split())))
        labels.append((i, int(good)))
    rows += [(1000, None), (1001, ""), (None, rows[0][1]), (1002, "word " * 50_000)]
    labels += [(1000, 1), (7777, 0), (None, 1), (3, None), (5, 7)]
    return rows, labels, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_of_held_out_texts(judged):
    rows, labels, docs, marks = judged
    model = compression.learn(docs, marks)
    got = {r.id: r.score for r in compression.score(docs.selectExpr("*", "1 AS id", "2 AS score"), model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    told = dict(labels[:400])
    held = [i for i in told if is_held_out(i)]
    right = sum((got[i] >= compression.GOOD) == bool(told[i]) for i in held)
    assert right / len(held) > 0.95
    assert got[1000] == got[1001]


def test_sample_is_bounded_and_leaves_out_the_held_out_part(judged):
    _, _, docs, marks = judged
    sample = compression.training_sample(docs, marks, docs_per_class=10, chars=50).collect()
    assert len(sample) == 20 and all(len(r.text) <= 50 and not is_held_out(r.id) for r in sample)


def test_one_class_or_no_labels_give_a_constant(judged, empty, spark):
    _, _, docs, marks = judged
    for usable in (marks.where("quality = 1"), marks.where("false")):
        model = compression.learn(docs, usable)
        assert len({r.score for r in compression.score(docs, model).collect()}) == 1
    assert compression.score(empty, compression.learn(empty, marks)).count() == 0


def test_samples_are_bounded_in_rows_however_often_an_id_repeats(spark):
    many = [(4, f"text {k} of one id", "en") for k in range(3000)] + [(k, f"some text {k}", "en") for k in range(100, 160)]
    docs = spark.createDataFrame(many, "doc_id long, text string, lang string").repartition(6)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in [4, 4, *range(100, 160)]], "doc_id long, quality int, toxic int")
    found = compression.training_sample(docs, labels, 10)
    rows = found.collect()
    assert len(rows) <= 20 and len({(r.id, r.label) for r in rows}) == len(rows)
    spoken = langid.training_sample(docs, 10).collect()
    assert 0 < len(spoken) <= 10 and len({r.id for r in spoken}) == len(spoken)
    assert [r.text for r in langid.training_sample(docs.where("doc_id = 4"), 10).collect()] == ["text 0 of one id"]


def test_every_language_is_learned_and_shares_the_rows(spark):
    rows = [(10 * k + j, f"text {k} {j}", f"l{k}") for k in range(300) for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.training_sample(docs, rows=600).collect()
    assert len({r.lang for r in found}) > 290 and len(found) <= 600
    with pytest.raises(ValueError):
        langid.training_sample(docs, rows=299)


def test_long_texts_are_learned_from_all_over(spark):
    text = "a" * 5000 + "b" * 5000 + "c" * 5000
    docs = spark.createDataFrame([(k, text) for k in range(40)], "id long, text string")
    pieces = [r[0] for r in docs.select(compression.sampled_text(docs.text, docs.id, 1000)).collect()]
    assert all(len(p) <= 1000 for p in pieces) and {c for p in pieces for c in p} == set("abc\n")
    short = docs.selectExpr("id", "'short' AS text")
    assert {r[0] for r in short.select(compression.sampled_text(short.text, short.id, 1000)).collect()} == {"short"}
