from __future__ import annotations

import math
import random
import re
from collections import Counter

from conftest_words import split_words

from tickloom.llm import divergence

KINDS = [str.islower, str.isupper, str.isdigit, str.isspace]


def distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    total = sum(x * math.log2(2 * x / (x + y)) for a, b in ((p, q), (q, p)) for x, y in zip(a, b) if x) / 2
    return math.sqrt(max(total, 0))


def classes(text):
    out = [0] * 7
    for c in text:
        kinds = [k(c) for k in KINDS]
        out[kinds.index(True) if any(kinds) else 5 if c in divergence.SYMBOLS else 4] += 1
    return out


def test_distances_of_repeated_rows_agree_with_plain_counting(spark):
    """Every copy of a row had the hits of all copies."""
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(200)]
    weights = [1 / (k + 1) for k in range(200)]
    rows = []
    for i in range(90):
        text = " ".join(rng.choices(vocab, weights, k=rng.randint(60, 120)))
        rows += [(None if i % 10 == 0 else i, text, rng.choice(["en", "fr"]))] * rng.choice([1, 1, 2, 3, 5])
    rows += [(500, rows[0][1], "en"), (500, rows[0][1], "fr")]
    rules = divergence.DivergenceRules(repeat_percent=100, least_reference_words=1)
    counts = {lang: Counter(w for _, t, k in rows if k == lang for w in split_words(t)) for lang in ("en", "fr")}
    common = {k: sorted(c, key=lambda w: (-c[w], w))[:20] for k, c in counts.items()}

    def hits(text, lang):
        words = Counter(split_words(text))
        found = [words[w] for w in common[lang]]
        return [*found, words.total() - sum(found)]

    refs = {k: ([sum(x) for x in zip(*[hits(t, k) for _, t, n in rows if n == k])],
                [sum(x) for x in zip(*[classes(t) for _, t, n in rows if n == k])]) for k in common}
    want = sorted((i or -1, round(distance(classes(t), refs[k][1]), 6), round(distance(hits(t, k), refs[k][0]), 6)) for i, t, k in rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = divergence.judge(df, rules).collect()
    assert sorted((r.id or -1, round(r.class_distance, 6), round(r.word_distance, 6)) for r in got) == want


def plain_limits(found, rules):
    """found: (lang, n_terms, distance) of documents that pass the base rules."""
    def quantile(values, share):
        steps = sorted(math.ceil(v * divergence.STEPS) for v in values)
        return next(s for k, s in enumerate(steps) if k + 1 >= share * len(steps)) / divergence.STEPS

    def limit(values):
        if len(values) < rules.least_class_values:
            return None
        low, mid = quantile(values, 0.05), quantile(values, 0.25)
        return mid + rules.spread * (mid - low)

    def of(lang, n):
        size = n.bit_length()
        alike = {(k, d) for k, m, d in found if m.bit_length() == size}
        own = limit([d for k, d in alike if k == lang])
        own = limit([d for _, d in alike]) if own is None else own
        own = rules.most_word_distance if own is None else own
        return max(own, rules.least_limit, rules.noise * math.sqrt(rules.common_words / (8 * math.log(2) * n)))

    return of


def languages(rng, n, least=40):
    """(id, text, lang): words of each language by falling frequency, two in five of them common."""
    rows = []
    for i in range(n):
        lang = ("aa", "bb", "cc")[i % 3 if i % 2 else 0]
        common = [f"{lang}{k}" for k in range(60)]
        weights = [1 / (k + 1) for k in range(60)]
        words = [rng.choices(common, weights)[0] if rng.random() < 0.4 else f"{lang}x{rng.randrange(10**6)}" for _ in range(rng.randint(least, 400))]
        rows.append((i, " ".join(w.title() + rng.choice(["", ",", "."]) for w in words), lang))
    return rows


def test_words_of_another_language_are_rejected_and_limits_agree_with_plain_counting(spark):
    rng = random.Random(5)
    rows = languages(rng, 1500)
    # Every tenth document goes under another language.
    other = {"aa": ["bb", "cc"], "bb": ["aa"], "cc": ["aa"]}
    rows = [(i, t, rng.choice(other[k]) if i % 10 == 0 else k) for i, t, k in rows]
    rules = divergence.DivergenceRules()
    got = {r.id: r for r in divergence.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6), rules).collect()}
    swapped = [got[i] for i in range(0, 1500, 10)]
    true = [got[i] for i in range(1500) if i % 10]
    assert sum(not r.kept for r in swapped) >= 0.9 * len(swapped)
    assert sum(not r.kept for r in true) <= 0.02 * len(true)
    langs = {i: k for i, _, k in rows}
    sizes = {i: len(t.split()) for i, t, _ in rows}
    of = plain_limits([(langs[i], sizes[i], r.word_distance) for i, r in got.items() if not r.base_failed], rules)
    for i, r in got.items():
        assert abs(r.word_limit - of(langs[i], sizes[i])) < 1e-9
        assert r.kept == (not r.base_failed and r.word_distance <= r.word_limit and r.class_distance <= rules.most_class_distance)


def test_a_third_of_all_rows_in_copies_moves_no_limit_over_the_others(spark):
    rng = random.Random(6)
    rows = languages(rng, 400)
    near = rows[0][1].split()
    rows += [(1000 + k, rows[1][1], rows[1][2]) for k in range(150)]
    rows += [(2000 + k, " ".join([*near[:-1], f"end{k}"]), rows[0][2]) for k in range(250)]
    got = {r.id: r for r in divergence.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(not got[i].kept for i in range(400)) <= 8


def test_words_are_lower_case_and_without_marks(spark):
    texts = ["The CAT, the (cat); don't!", None, "... --", "É 12a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(divergence.terms_of(df.text)).collect()]
    assert got == [["the", "cat", "the", "cat", "don", "t"], [], [], ["é", "12a"]]


def test_character_classes_are_counted_on_what_is_left_of_a_text(spark):
    """The whole text was searched six times."""
    texts = ["aB3 \t\n#*$%&|<>", "\x00\x01\x7f!\"'()+,./:;=?@[\\]^_`{}~-", "é中\U0001f600ß aa\x0b\x0c\r\x85\xa0Z", "", None, "zz 99 ZZ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' AS lang")
    out = divergence.base_columns(docs, "doc_id", "text", "lang")
    signs = {"symbol": "#*$%&|<>", "mark": "!\"'()+,./:;=?@[\\]^_`{}~-", "space": " \t\n\x0b\x0c\r", "digit": "0123456789"}
    for r in out.collect():
        text = texts[r.id] or ""
        assert {n: r[n] for n in signs} == {n: sum(c in s for c in text) for n, s in signs.items()}
        assert r.upper == sum("A" <= c <= "Z" for c in text)
        assert (r.chars, r.ascii) == (len(text), sum(c < "\x80" for c in text))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"regexp_replace\((?:coalesce\()?text#", plan)) == 1
