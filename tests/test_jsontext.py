"""One value replaced in a JSON text, against Python's reader."""

from __future__ import annotations

import json
import random

from tickloom.functions.jsontext import value_spans, value_text, with_values
from tickloom.operators.manifests import rewrite_lines
from pyspark.sql import functions as F


def moved(spark, lines):
    df = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "k int, line string")
    return [(r.line, r.source_ref) for r in rewrite_lines(df, "new").orderBy("k").collect()]


def test_everything_else_stays_as_written(spark):
    big = "7" * 48
    lines = [
        '{"a":1.0,"source-ref":"x/images/1.jpg","b":%s,"c":1e400,"d":1.10}' % big,
        '{ "source-ref" :\t"x/images/2" ,\n "a" : 1, "a" : 2 }',
        '{"in":{"source-ref":"no"},"list":[{"source-ref":"no"},"source-ref","}],"],"source-ref":"images/é😀"}',
        '{"q":"a \\" b, {","source\\u002dref":"images\\/3"}',
    ]
    want = [
        '{"a":1.0,"source-ref":"new/images/1.jpg","b":%s,"c":1e400,"d":1.10}' % big,
        '{ "source-ref" :\t"new/images/2" ,\n "a" : 1, "a" : 2 }',
        '{"in":{"source-ref":"no"},"list":[{"source-ref":"no"},"source-ref","}],"],"source-ref":"new/images/é😀"}',
        '{"q":"a \\" b, {","source\\u002dref":"new/images/3"}',
    ]
    assert moved(spark, lines) == list(zip(want, ["new/images/1.jpg", "new/images/2", "new/images/é😀", "new/images/3"]))


def test_of_a_path_given_twice_the_last_counts(spark):
    line = '{"source-ref":"images/1","a":1,"source-ref":"images/2"}'
    assert moved(spark, [line]) == [('{"source-ref":"new/images/2","a":1,"source-ref":"new/images/2"}', "new/images/2")]


def test_lines_without_a_path_stay(spark):
    lines = ['{"a":1.0}', "no json", '["source-ref"]', '{"source-ref":5}', '{"source-ref":null}', '{"source-ref":"images/1"', "", None]
    assert moved(spark, lines) == [(line, None) for line in lines]


def test_long_strings_and_many_escapes(spark):
    text = json.dumps("\\\"\n" * 20_000 + "x" * 2_000_000)
    line = '{"t":%s,"source-ref":"images/1","u":%s}' % (text, text)
    assert moved(spark, [line]) == [(line.replace('"images/1"', '"new/images/1"'), "new/images/1")]


def test_random_objects_agree_with_a_reader_of_pairs(spark):
    rng = random.Random(4)

    def value(depth):
        kind = rng.randrange(7 if depth < 3 else 5)
        text = "".join(rng.choices('ab"\\{}[]:,\n é', k=rng.randint(0, 6)))
        if kind == 5:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        if kind == 6:
            return {rng.choice(["k", "x", text]): value(depth + 1) for _ in range(rng.randint(0, 3))}
        return [text, 1.5, -3, True, None][kind]

    def written(pairs):
        space = lambda: rng.choice(["", " ", "\n ", "\t"])
        body = ",".join(
            f"{space()}{json.dumps(k, ensure_ascii=rng.random() < 0.5)}{space()}:{space()}{json.dumps(v, indent=rng.choice([None, 1]))}{space()}"
            for k, v in pairs
        )
        return "{" + body + "}"

    rows = [[(rng.choice(["k", "k", "x", 'q"', ""]), value(0)) for _ in range(rng.randint(0, 5))] for _ in range(300)]
    df = spark.createDataFrame([(i, written(r)) for i, r in enumerate(rows)], "i int, t string")
    spans = value_spans(F.col("t"), "k")
    got = df.select("i", "t", spans.alias("s"), value_text(F.col("t"), spans).alias("v"), with_values(F.col("t"), spans, F.lit('n"w')).alias("new"))
    for r in got.collect():
        pairs = json.loads(r.t, object_pairs_hook=list)
        values = [v for k, v in pairs if k == "k"]
        assert [json.loads(r.t[a:b], object_pairs_hook=list) for a, b in r.s] == values
        assert r.v == (values[-1] if values and isinstance(values[-1], str) else None)
        assert json.loads(r.new, object_pairs_hook=list) == [(k, 'n"w' if k == "k" else v) for k, v in pairs]
        kept = "".join(x for x, _ in zip([r.t[a:b] for a, b in zip([0] + [s.hi for s in r.s], [s.lo for s in r.s] + [len(r.t)])], range(99)))
        assert len(r.new) == len(kept) + len(r.s) * len('"n\\"w"')
