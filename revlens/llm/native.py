"""Column expressions over words and lines, JVM built-ins only.

``let`` binds a computed array to a name inside one expression, so it is
evaluated once however often the body uses it.
"""

from __future__ import annotations

#: The six blanks between words, as SQL string.
BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def words(text: str) -> str:
    """Array of the words of a string column, empty for null."""
    return f"array_remove(split(coalesce({text}, ''), concat('[', {BLANKS}, ']+')), '')"


def count_chars(text: str, chars: str) -> str:
    """How many characters of ``chars`` (none special in a class) a string has."""
    return f"cast(char_length(regexp_replace({text}, '[^{chars}]+', '')) as bigint)"


def is_blank(text: str) -> str:
    return f"ltrim({BLANKS}, {text}) = ''"


def hashes(v: str) -> str:
    """Array of the 64-bit hashes of an array of words."""
    return f"transform({v}, one_word -> xxhash64(one_word))"


def runs(h: str) -> str:
    """Hashes of the neighbours in an array of hashes: of the pairs of words for
    hashes of words, of 3-word windows for those of pairs. Empty if none."""
    n = f"greatest(size({h}) - 1, 0)"
    return f"zip_with(slice({h}, 1, {n}), slice({h}, 2, {n}), (x, y) -> xxhash64(x, y))"


def _high(n: str) -> str:
    """Mask of the bits left beside a position in an array of ``n`` windows."""
    return f"~(shiftleft(1L, length(bin(cast({n} as bigint)))) - 1L)"


def sorted_places(q: str) -> str:
    """Array ``q`` of window hashes as sorted longs, each a hash in the high bits
    and its position in just as many low bits as the array needs, so equal windows
    stand side by side. Empty when no window comes twice. (48 hash bits are left
    at 20,000 words.)"""
    pack = f"transform({q}, (x, i) -> (x & high) | i)"
    return (f"CASE WHEN size(array_distinct({q})) = size({q}) THEN array() "
            f"ELSE sort_array({let('high', _high(f'size({q})'), pack)}) END")


def covered(s: str) -> str:
    """Words that lie in a 3-word window found twice or more, of the longs of
    ``sorted_places``."""
    n = f"size({s}) - 1"
    near = (f"filter(arrays_zip(slice({s}, 1, {n}), slice({s}, 2, {n})), "
            "x -> ((x.`0` ^ x.`1`) & high) = 0L)")
    places = let("m", near, "sort_array(array_distinct(concat(transform(m, x -> x.`0` & ~high), "
                            "transform(m, x -> x.`1` & ~high))))")
    spread = ("aggregate(p, struct(-3L as at, 0L as n), "
              "(a, x) -> struct(x as at, a.n + least(3L, x - a.at) as n), a -> a.n)")
    body = let("high", _high(f"size({s})"), let("p", places, spread))
    return f"CASE WHEN size({s}) = 0 THEN 0L ELSE {body} END"
