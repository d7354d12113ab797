"""Changing a JSON text in place: what is not changed stays as it was written, character by character."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A string, a mark, white space, or anything else up to the next of these. The quantifiers never give
# back what they took, so long strings need no stack.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKEN = _STRING + r"|[{}\[\],:]|\s++|[^\"{}\[\],:\s]++"
_SPANS = "array<struct<lo: int, hi: int>>"


def value_spans(text: Column, key: str) -> Column:
    """Where the values of a key of the outermost object lie: (lo, hi), counted in characters from 0.

    One entry for each time the key is given, in order; keys of inner objects do not count, and the
    key may be written with escapes. Empty for a text that is no JSON object; NULL for NULL.
    """
    possible = (text.contains(json.dumps(key)) | text.contains("\\")) & F.json_object_keys(text).isNotNull()
    none = F.array().cast(_SPANS)
    return F.when(text.isNull(), F.lit(None)).when(possible, _scanned(text, key)).otherwise(none)


def is_plain(text: Column, key: str) -> Column:
    """Whether the key is spelled out once in the whole text, without escapes, belongs to the outermost
    object and has a string for its value, in one of the two usual spacings. Then a pattern finds it,
    and no scan is needed."""
    if not re.fullmatch(r"[\w-]+", key):
        return F.lit(False)
    quoted = json.dumps(key)
    string = text.contains(f'{quoted}:"') | text.contains(f'{quoted}: "')
    once = F.substring_index(text, quoted, 2) == text
    escaped = text.contains("\\u00") & text.rlike(r"\\u00[2-7]")
    return F.coalesce(string & once & ~escaped & F.array_contains(F.json_object_keys(text), key), F.lit(False))


def plain_value_text(text: Column, key: str) -> Column:
    """`value_text` for texts that are `is_plain`."""
    return F.from_json(text, f"`{key}` string")[key]


def with_plain_value(text: Column, key: str, value: Column) -> Column:
    """`with_values` for texts that are `is_plain`."""
    found = "(" + re.escape(json.dumps(key)) + r": ?)" + _STRING
    literal = F.regexp_replace(_quoted(value), r"([\\$])", r"\\$1")
    return F.when(value.isNull(), text).otherwise(F.regexp_replace(text, F.lit(found), F.concat(F.lit("$1"), literal)))


def _scanned(text: Column, key: str) -> Column:
    """Spans found by reading the text token by token."""
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))

    def step(s: Column, token: Column) -> Column:
        end = s["at"] + F.length(token)
        blank = F.trim(F.translate(token, "\t\n\r", "   ")) == ""
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        depth = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        outside = s["depth"] == 1
        name_next = F.when(blank, s["name_next"]).otherwise(
            ((s["depth"] == 0) & (token == "{")) | (outside & (token == ","))
        )
        is_name = s["name_next"] & outside & token.startswith('"')
        # 1: the key was read, 2: its value follows or is being read.
        seen = (
            F.when(is_name, F.when(_decoded(token) == F.lit(key), 1).otherwise(0))
            .when(outside & (token == ":") & (s["seen"] == 1), 2)
            .when((outside & (token == ",")) | (outside & closes), 0)
            .otherwise(s["seen"])
        )
        inside = (s["seen"] == 2) & (seen == 2) & ~blank
        first = inside & (s["lo"] < 0)
        done = (s["seen"] == 2) & (seen != 2)
        return F.struct(
            end.alias("at"),
            depth.alias("depth"),
            name_next.alias("name_next"),
            seen.alias("seen"),
            F.when(done, -1).when(first, s["at"]).otherwise(s["lo"]).alias("lo"),
            F.when(inside, end).otherwise(s["hi"]).alias("hi"),
            F.when(done, F.concat(s["spans"], F.array(F.struct(s["lo"].alias("lo"), s["hi"].alias("hi")))))
            .otherwise(s["spans"])
            .alias("spans"),
        )

    start = F.struct(
        F.lit(0).alias("at"),
        F.lit(0).alias("depth"),
        F.lit(False).alias("name_next"),
        F.lit(0).alias("seen"),
        F.lit(-1).alias("lo"),
        F.lit(-1).alias("hi"),
        F.array().cast(_SPANS).alias("spans"),
    )
    return F.aggregate(tokens, start, step, lambda s: s["spans"])


def _decoded(token: Column) -> Column:
    """The text of a JSON string."""
    bare = F.substr(token, F.lit(2), F.length(token) - 2)
    return F.when(token.contains("\\"), F.from_json(F.concat(F.lit('{"k":'), token, F.lit("}")), "k string")["k"]).otherwise(bare)


def _quoted(value: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(value))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def value_text(text: Column, spans: Column) -> Column:
    """The last of the given values as text, if it is a string; readers that meet a key twice mostly
    go by the last. NULL for another value and where there is none."""
    last = F.try_element_at(spans, F.lit(-1))
    raw = F.substr(text, last["lo"] + 1, last["hi"] - last["lo"])
    return F.when(raw.startswith('"'), _decoded(raw))


def with_values(text: Column, spans: Column, value: Column) -> Column:
    """The text with all given values replaced by a string value; unchanged where `value` is NULL."""
    quoted = _quoted(value)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        before = F.substr(text, s["at"] + 1, span["lo"] - s["at"])
        return F.struct(span["hi"].alias("at"), F.concat(s["out"], before, quoted).alias("out"))

    made = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(value.isNull() | (F.size(spans) < 1), text).otherwise(made)
