"""Flatten the business attribute struct into (key, value) rows with built-ins.

A field is either null, a scalar (``True``, ``u'free'``, ``2``) or the text of
a small dictionary (``{'romantic': False, 'casual': True}``). Scalars give
one entry named after the field; dictionary text gives one entry per key, named
``field_key``. The text is read as the Python literal that it is (escapes, commas
and braces inside quotes, nested values, which stay JSON text); text that is no
literal falls back to its ``'key': value`` pairs, where a pair without a colon
gives no entry. Values lose Python quoting (``u'free'`` -> ``free``), are
trimmed and upper-cased; null and ``None`` stay null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR = r"'([^']*)'\s*:\s*([^,}]*)"
QUOTED = r"^u?'(.*)'$"

# One token of a Python literal: a string, a bracket, colon or comma, anything else.
# Loops are possessive, so that long strings need no deep matching.
TOKEN = (r"""(?s)[uU]?'[^'\\]*+(?:\\.[^'\\]*+)*+'|[uU]?"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
         r"""|[{}\[\]():,]|[^\s{}\[\]():,'"]++""")
NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
# Characters that no JSON text holds: between tokens, and for an escaped backslash.
_GAP, _BACK = "\x02", "\x01"


def _json_string(t: Column) -> Column:
    """A Python string token as a JSON string. Escapes that JSON lacks become their
    code; an unknown escape keeps its backslash, as in Python."""
    b = F.regexp_extract(t, r"""(?s)^[uU]?['"](.*)['"]$""", 1)
    b = F.replace(b, F.lit("\\\\"), F.lit(_BACK))
    b = F.regexp_replace(b, r"\\(['\"])", "$1")
    b = F.regexp_replace(b, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    for python, code in (("a", "0007"), ("v", "000b")):
        b = F.replace(b, F.lit("\\" + python), F.lit("\\u" + code))
    b = F.regexp_replace(b, r"\\([^nrtbfuU0-7])", _BACK + "$1")
    for raw, code in (('"', '"'), ("\t", "t"), ("\n", "n"), ("\r", "r")):
        b = F.replace(b, F.lit(raw), F.lit("\\" + code))
    return F.concat(F.lit('"'), F.replace(b, F.lit(_BACK), F.lit("\\\\")), F.lit('"'))


def _json_token(t: Column) -> Column:
    out = F.when(t.rlike(r"""^[uU]?['"]"""), _json_string(t))
    for python, json in (("True", "true"), ("False", "false"), ("None", "null"), ("(", "["), (")", "]")):
        out = out.when(t == python, json)
    return out.when(t.rlike(r"^[{}\[\]:,]$") | t.rlike(NUMBER), t).otherwise("?")


def literal_json(c: Column) -> Column:
    """JSON text of a Python literal (dictionaries, lists, tuples of two or more,
    strings, numbers, True, False, None). Text that is no such literal gives text
    that is no JSON, or null; octal and eight-digit escapes count as such."""
    tokens = F.regexp_extract_all(c, F.lit(TOKEN), 0)
    t = F.array_join(F.transform(tokens, _json_token), _GAP)
    t = F.regexp_replace(t, f",{_GAP}([}}\\]])", "$1")  # a comma before the end
    t = F.regexp_replace(t, f'(^|[{{,]{_GAP})([^"{_GAP}]+){_GAP}:', f'$1"$2"{_GAP}:')  # keys that are no strings
    rest = F.regexp_replace(c, TOKEN, "")
    return F.when(F.trim(rest) == "", F.replace(t, F.lit(_GAP), F.lit(" ")))


def literal_variant(c: Column) -> Column:
    """A Python literal as VARIANT; null for text that is none."""
    return F.try_parse_json(literal_json(c))


def attribute_fields(df: DataFrame, col: str) -> list[str]:
    """Field names of the attribute struct, read from the schema (no job)."""
    return list(df.schema[col].dataType.fieldNames())


def clean_value(c: Column) -> Column:
    v = F.upper(F.trim(F.regexp_replace(F.trim(c), QUOTED, "$1")))
    return F.when(v == "NONE", F.lit(None).cast("string")).otherwise(v)


def _field_entries(struct_col: str, field: str) -> Column:
    v = F.col(struct_col)[field]
    nested = F.startswith(F.trim(v), F.lit("{"))
    read = F.try_variant_get(literal_variant(v), "$", "map<string,string>")
    keys = F.regexp_extract_all(v, F.lit(PAIR), 1)
    vals = F.regexp_extract_all(v, F.lit(PAIR), 2)
    pairs = F.transform(
        F.arrays_zip(keys.alias("k"), vals.alias("v")),
        lambda p: F.struct(F.concat(F.lit(field + "_"), F.trim(p["k"])).alias("key"),
                           clean_value(p["v"]).alias("val")))
    read_pairs = F.transform(F.map_entries(read), lambda p: F.struct(
        F.concat(F.lit(field + "_"), F.trim(p["key"])).alias("key"), clean_value(p["value"]).alias("val")))
    pairs = F.coalesce(read_pairs, pairs)
    scalar = F.array(F.struct(F.lit(field).alias("key"), clean_value(v).alias("val")))
    return F.when(v.isNotNull() & nested, pairs).otherwise(scalar)


def attribute_entries(df: DataFrame, struct_col: str) -> Column:
    """array<struct<key, val>> of every flattened entry of one row."""
    fields = attribute_fields(df, struct_col)
    return F.flatten(F.array(*[_field_entries(struct_col, f) for f in fields]))
