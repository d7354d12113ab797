"""Operator 1: quality rules by distribution divergence. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.components import cut
from tickloom.llm.words import words_of

SYMBOLS = "#*$%&|<>"
GRAM = 8
#: Lower-case letters are what is left of ASCII, control characters included; other is not ASCII.
CLASSES = ("lower", "upper", "digit", "space", "mark", "symbol", "other")
#: Documents without a language have a reference of their own.
NONE = ""


@dataclass(frozen=True)
class DivergenceRules:
    """Bounds of the base rules and of the divergence from the reference of a language.

    A document below the least sizes is not judged by that histogram. A language with
    `least_reference_words` is its own reference; documents of a smaller one are held against the
    character classes of all documents together, and not judged by words.

    The distance of words allowed follows from the distances found: documents are put in size classes
    (doubling numbers of words), and in each class of a language the lower quarter of the distances is
    carried on by `spread` times its distance from the lowest twentieth. Documents of another language
    lie above and hardly move these two, up to half of a class and more. A class with under
    `least_class_values` different distances takes the limit of that size in all languages, or
    `most_word_distance`. No limit is below `least_limit`, nor below `noise` times what a sample of that
    many words from the reference itself is expected to differ.
    """

    least_words: int = 20
    repeat_percent: int = 30
    common_words: int = 20
    least_reference_words: int = 2_000
    least_chars: int = 200
    least_hist_words: int = 40
    most_class_distance: float = 0.2
    most_word_distance: float = 0.42
    spread: float = 4.0
    least_class_values: int = 50
    least_limit: float = 0.2
    noise: float = 1.15


#: Steps of a distance in which quantiles are counted.
STEPS = 1_000
#: Rows up to which a table by language is broadcast; a larger one is joined by shuffle.
SMALL_ROWS = 200_000


def base_columns(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(id, lang, text, words) with the base counts and the sizes of the character classes.

    One pass over the rows, without a shuffle. A null text has no words and all counts 0.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit(NONE)).alias("lang"), text.alias("text")
    )
    out = out.withColumn("words", words_of(F.col("text")))
    out = out.withColumn("n_words", F.size("words").cast("long"))
    # Hashes of 1, 2, 4 and 8 words from each place on, each from two of half the length.
    grams = F.transform("words", lambda w: F.xxhash64(w))
    for half in (1, 2, 4):
        out = out.withColumn("grams", grams)
        behind = F.slice("grams", half + 1, F.greatest(F.size("grams") - half, F.lit(0)))
        grams = F.zip_with("grams", behind, lambda a, b: F.xxhash64(a, b))
    out = out.withColumn("grams", grams)
    out = out.withColumn(
        "grams", F.when(F.col("n_words") >= GRAM, F.slice("grams", 1, F.greatest(F.col("n_words").cast("int") - GRAM + 1, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    )
    keyed = F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    out = out.withColumn("keyed", F.when(repeats, keyed))
    same = F.expr(
        "filter(keyed, (x, k) -> (k > 0 AND keyed[k - 1].h = x.h) OR (k + 1 < size(keyed) AND keyed[k + 1].h = x.h))"
    )
    out = out.withColumn("starts", F.when(F.col("keyed").isNotNull(), F.sort_array(F.transform(same, lambda x: x["i"]))))
    covered = F.expr(
        f"aggregate(transform(starts, (x, k) -> IF(k = 0, {GRAM}, least({GRAM}, x - starts[k - 1]))), 0L, (a, x) -> a + x)"
    )
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    out = out.withColumn("lines", lines)

    # What is left of the text without lower-case letters, then also without space, is short: only the
    # first two patterns go over much.
    out = out.withColumn("rest", F.regexp_replace("text", "[a-z]+", ""))
    out = out.withColumn("few", F.regexp_replace("rest", r"[\x20\x09-\x0D]+", ""))

    def size(text: str | Column) -> Column:
        return F.length(text).cast("long")

    def among(chars: str) -> Column:
        return size("few") - size(F.regexp_replace("few", chars, ""))

    chars, letters = size("text"), size("text") - size("rest")
    counts = {
        "upper": among("[A-Z]+"),
        "digit": among("[0-9]+"),
        "space": size("rest") - size("few"),
        "symbol": among("[#*$%&|<>]+"),
        "mark": among(r"[!\"'()+,./:;=?@\[\\\]^_`{}~-]+"),
    }
    counts["ascii"] = letters + counts["space"] + among(r"[\x00-\x7F]+")
    out = out.select(
        "id", "lang", "text", "words", "n_words",
        *[c.alias(n) for n, c in counts.items()],
        chars.alias("chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return out


def _classes() -> list[Column]:
    """Sizes of CLASSES from the counted columns; together they are all characters."""
    named = F.col("upper") + F.col("digit") + F.col("space") + F.col("mark") + F.col("symbol")
    return [
        F.col("ascii") - named, F.col("upper"), F.col("digit"), F.col("space"), F.col("mark"), F.col("symbol"),
        F.col("chars") - F.col("ascii"),
    ]


def terms_of(text: Column) -> Column:
    """Words for histograms: lower-case, without ASCII marks; empty for a text without any."""
    marks = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), marks), lambda w: w != "")


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts."""
    p_sum = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    q_sum = F.aggregate(q, F.lit(0.0), lambda a, x: a + x)
    pair = F.zip_with(p, q, lambda a, b: F.struct((a / p_sum).alias("a"), (b / q_sum).alias("b")))

    def part(x: Column) -> Column:
        mid = (x["a"] + x["b"]) / 2
        left = F.when(x["a"] > 0, x["a"] * F.log2(x["a"] / mid)).otherwise(0.0)
        right = F.when(x["b"] > 0, x["b"] * F.log2(x["b"] / mid)).otherwise(0.0)
        return (left + right) / 2

    total = F.aggregate(pair, F.lit(0.0), lambda acc, x: acc + part(x))
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def judge(docs: DataFrame, rules: DivergenceRules = DivergenceRules(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance, word_distance, word_limit) for every row.

    A document fails the base rules if it has few words or many of its words are in repeated
    windows. Documents that pass make the references: for each language the shares of character
    classes and of its most frequent words (lower-case, without marks; all other words are one share).
    A document is kept if it passes the base rules, its classes lie within the allowed distance of its
    language's and its words within the limit that DivergenceRules describes. Languages with too few
    words for a reference of their own are held against the classes of all documents. Histograms of too
    short documents, and words of languages without a reference, have a null distance and do not count
    against a document. Documents with a null language are a language of their own. Repeated rows are
    judged alike, and their distance counts once for a limit.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NONE)).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    # Names a row's text in joins by id, so rows that repeat an id stay apart.
    key = F.xxhash64("text", F.length("text")).alias("text_key")
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    base = base_columns(rows, "id", "text", "lang").select(
        "id", "lang", key, "n_words", (F.col("chars") - F.col("space")).alias("word_chars"), F.col("symbol").alias("n_symbols"),
        "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "chars",
        F.array(*_classes()).cast("array<double>").alias("classes"),
    )
    common = cut(_common_words(rows, rules))
    found = _found_words(rows.select("id", "lang", key, "text"), common, rules.common_words)
    found = found.select(F.col("id").alias("f_id"), F.col("lang").alias("f_lang"), F.col("text_key").alias("f_key"), "hits", "n_terms")
    same = F.col("id").eqNullSafe(F.col("f_id")) & (F.col("lang") == F.col("f_lang")) & (F.col("text_key") == F.col("f_key"))
    joined = base.join(found, same, "left").drop("f_id", "f_lang", "f_key", "text_key")
    joined = joined.withColumn("hits", F.coalesce("hits", F.array_repeat(F.lit(0.0), rules.common_words)))
    other = F.coalesce("n_terms", F.lit(0)).cast("double") - F.aggregate("hits", F.lit(0.0), lambda a, x: a + x)
    joined = cut(joined.withColumn("hits", F.concat("hits", F.array(other))))

    good = joined.where(~F.col("base_failed"))
    sums = [F.sum(F.get("classes", F.lit(k))).alias(f"c{k}") for k in range(len(CLASSES))]
    sums += [F.sum(F.get("hits", F.lit(k))).alias(f"w{k}") for k in range(rules.common_words + 1)]
    shares = cut(good.groupBy("lang").agg(F.sum("n_words").alias("ref_words"), *sums))
    # Seven numbers: the character classes of all documents that pass.
    pool = shares.agg(F.sum("ref_words").alias("n"), *[F.sum(f"c{k}").alias(f"c{k}") for k in range(len(CLASSES))]).first()
    known = (pool["n"] or 0) >= rules.least_reference_words
    pooled = F.array(*[F.lit(float(pool[f"c{k}"])) for k in range(len(CLASSES))]) if known else F.lit(None).cast("array<double>")
    shares = shares.where(F.col("ref_words") >= rules.least_reference_words).select(
        F.col("lang").alias("ref_lang"),
        F.array(*[f"c{k}" for k in range(len(CLASSES))]).alias("ref_classes"),
        F.array(*[f"w{k}" for k in range(rules.common_words + 1)]).alias("ref_hits"),
    )
    judged = joined.join(_small(shares), F.col("lang") == F.col("ref_lang"), "left")
    judged = judged.withColumn(
        "class_distance", F.when(F.col("chars") >= rules.least_chars, _distance(F.col("classes"), F.coalesce("ref_classes", pooled)))
    ).withColumn(
        "word_distance", F.when((F.col("n_terms") >= rules.least_hist_words) & F.col("ref_lang").isNotNull(), _distance(F.col("hits"), F.col("ref_hits")))
    ).withColumn("size_class", F.floor(F.log2(F.col("n_terms"))))
    judged = cut(judged.select(
        "id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "class_distance", "word_distance", "n_terms", "size_class",
    ))
    by_lang, by_size = _limits(judged, rules)
    judged = judged.join(_small(by_lang), ["lang", "size_class"], "left").join(F.broadcast(by_size), "size_class", "left")
    # The expected divergence of a sample of n words from k shares is about (k - 1) / (8 n ln 2) bits.
    expected = F.sqrt(F.lit(rules.common_words / (8 * math.log(2))) / F.col("n_terms"))
    limit = F.greatest(F.coalesce("lang_limit", "size_limit", F.lit(rules.most_word_distance)), F.lit(rules.least_limit), rules.noise * expected)
    far = (F.coalesce("class_distance", F.lit(0.0)) > rules.most_class_distance) | (
        F.col("word_distance").isNotNull() & (F.col("word_distance") > limit)
    )
    return judged.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance",
        F.when(F.col("word_distance").isNotNull(), limit).alias("word_limit"),
    )


def _limits(judged: DataFrame, rules: DivergenceRules) -> tuple[DataFrame, DataFrame]:
    """(lang, size_class, lang_limit) and (size_class, size_limit): at most 64 rows for each language,
    and 64. Different distances are counted in steps, so running sums go over STEPS rows of a class."""
    step = F.ceil(F.col("word_distance") * STEPS)
    values = judged.where(~F.col("base_failed") & F.col("word_distance").isNotNull()).select("lang", "size_class", "word_distance").distinct()
    counts = cut(values.groupBy("lang", "size_class", step.alias("step")).agg(F.count("*").alias("n")))

    def limit(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        rows = rows.groupBy(*keys, "step").agg(F.sum("n").alias("n"))
        rows = rows.withColumn("up_to", F.sum("n").over(Window.partitionBy(*keys).orderBy("step")))
        rows = rows.withColumn("all", F.sum("n").over(Window.partitionBy(*keys))).where(F.col("all") >= rules.least_class_values)
        low, mid = [F.min(F.when(F.col("up_to") >= share * F.col("all"), F.col("step"))) / STEPS for share in (0.05, 0.25)]
        return rows.groupBy(*keys).agg((mid + rules.spread * (mid - low)).alias(name))

    return limit(counts, ["lang", "size_class"], "lang_limit"), limit(counts, ["size_class"], "size_limit")


def _small(table: DataFrame) -> DataFrame:
    """The table with a hint to broadcast it, if its counted rows are few."""
    return F.broadcast(table) if table.count() <= SMALL_ROWS else table


def _found_words(rows: DataFrame, common: DataFrame, n: int) -> DataFrame:
    """(id, lang, text_key, hits, n_terms): how often a text has each common word of its language, by
    place, and the number of its words.

    The texts' words are joined with the common words and counted where they are read, so one row for
    each document is shuffled. Rows that repeat id, language and text
    are counted together; a space, which is no word, stands once in each of them and tells how many
    they are.
    """
    words = rows.select("id", "text_key", "lang", terms_of(F.col("text")).alias("terms"))
    words = words.select("id", "text_key", "lang", F.size("terms").alias("n_terms"), F.explode(F.concat(F.array(F.lit(" ")), "terms")).alias("word"))
    marks = common.select("lang", F.lit(" ").alias("word"), F.lit(0).alias("place")).distinct()
    met = words.join(_small(common.unionByName(marks)), ["lang", "word"])
    hits = [F.count_if(F.col("place") == k).alias(f"h{k}") for k in range(n + 1)]
    counted = met.groupBy("id", "lang", "text_key").agg(F.max("n_terms").alias("n_terms"), *hits)
    shares = [F.col(f"h{k + 1}") / F.col("h0") for k in range(n)]
    return counted.select("id", "lang", "text_key", "n_terms", F.array(*shares).alias("hits"))


def _common_words(rows: DataFrame, rules: DivergenceRules) -> DataFrame:
    """(lang, word, place): the most frequent words of each language. Words are counted where they are
    read, before they are shuffled."""
    words = rows.select("lang", F.explode(terms_of(F.col("text"))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count("*").alias("n")).where("n > 1")
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    listed = counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= rules.common_words)
    return listed.select("lang", "word", "place")
