from __future__ import annotations

from collections import Counter

from conftest_words import split_words

from tickloom.llm import divergence


def base(text):
    words = split_words(text)
    text = text or ""
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if split_words(line)]
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
        n < 20 or 100 * len(inside) > 30 * n,
    )


def test_base_columns_agree_with_plain_counting(docs, corpus):
    got = divergence.judge(docs).collect()
    want = Counter((i, *base(t)) for i, t, _, _ in corpus)
    assert Counter(tuple(r[:7]) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)


def test_symbols_lines_and_odd_characters(spark):
    texts = ["a#b\na#b\n\n \na#b ", "<|>" * 30, "\x00\x1f é x 中文\n中文", "x " * 40, "A\r\nA\r\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' AS lang")
    got = {r.id: tuple(r[1:7]) for r in divergence.judge(df).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_text_unlike_its_language_is_rejected_and_short_text_is_not_judged(spark):
    rows = [(i, f"the cat of house {i} and the dog of street are in the garden of town " * 1 + " ".join(f"word{i}x{k}" for k in range(40)), "en") for i in range(60)]
    rows += [(100, " ".join(f"Zq{k}%%% #{k}|" for k in range(60)), "en"), (101, "$$$ %%% " * 8 + " ".join(f"q{k}" for k in range(10)), "en"), (102, rows[0][1], None)]
    got = {r.id: r for r in divergence.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(60))
    assert not got[100].kept and not got[100].base_failed and got[100].class_distance > 0.2
    assert got[101].word_distance is None and got[101].class_distance is None
    assert got[102].kept and got[102].word_distance is None


def test_empty_table(empty):
    assert divergence.judge(empty).count() == 0


def test_every_language_is_judged_however_many_and_small(spark):
    good = "the cat of house and the dog of street are in the garden of town with some more words here "
    junk = " ".join(f"Zq{k}%%% #{k}|" for k in range(60))
    rows = [(10 * k + j, good + " ".join(f"word{k}x{j}y{i}" for i in range(30)), f"l{k}") for k in range(90) for j in range(3)]
    rows += [(10_000 + k, junk + f" {k}", f"l{k}") for k in range(0, 90, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.id: r for r in divergence.judge(df).collect()}
    assert all(r.class_distance is not None for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {10_000 + k for k in range(0, 90, 9)}
    # Languages with words enough of their own, more than a list of fixed length would hold.
    own = divergence.judge(df, divergence.DivergenceRules(least_reference_words=50)).where("word_distance IS NULL")
    assert own.count() == 0


def test_large_tables_by_language_are_joined_without_a_broadcast(spark, docs, monkeypatch):
    want = sorted(map(str, divergence.judge(docs).collect()))
    monkeypatch.setattr(divergence, "SMALL_ROWS", 0)
    assert sorted(map(str, divergence.judge(docs).collect())) == want
