"""Text cleaning as Spark column expressions.

Every step is ``Column -> Column`` and runs on the JVM; only Unicode NFKC, which
Spark has no expression for, goes through one Arrow function.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable
from itertools import product

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import patterns as P
from textloom.functions.binding import bind, contains_any
from textloom.functions.validation import is_garbage

# changed characters that a Python task gathers before they become Arrow data
PIECE_CHARS = 1 << 20


def _replace(text: Column, step: tuple[str, str]) -> Column:
    pattern, replacement = step
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def _replace_where(
    text: Column, may_match: Callable[[Column], Column], step: tuple[str, str]
) -> Column:
    """Apply ``step`` only where a cheaper test says that it may match at all."""
    return bind(text, lambda t: F.when(may_match(t), _replace(t, step)).otherwise(t))


def _replace_if(text: Column, needles: Iterable[str], step: tuple[str, str]) -> Column:
    """Apply ``step`` only to texts holding one of ``needles``: a byte search is much cheaper."""
    return _replace_where(text, lambda t: contains_any(t, needles), step)


def py_strip(text: Column) -> Column:
    """Strip all Unicode whitespace (Spark's one-argument ``trim`` only strips U+0020)."""
    return F.btrim(text, F.lit(P.STRIP_CHARS))


def _changed(text: str | None) -> str | None:
    """NFKC of a text that it changes, else null; most texts are normal already, which is quick to tell."""
    if text is None or text.isascii():
        return None
    normal = unicodedata.normalize("NFKC", text)
    return None if normal == text else normal


def _changed_each(texts: list[str | None] | None) -> list[str | None] | None:
    """The same for all strings of a list, whole if any of them changes."""
    changed = list(map(_changed, texts or ()))
    if all(c is None for c in changed):
        return None
    return [t if c is None else c for t, c in zip(texts, changed)]


def _size(value: str | list[str | None] | None) -> int:
    return sum(map(_size, value)) if isinstance(value, list) else len(value or "")


def _mapped(values: pa.Array, change: Callable, kind: pa.DataType) -> pa.Array:
    """``change`` of each value, of which few are Python objects at any time: a batch may hold thousands of long texts."""
    pieces, piece, chars = [], [], 0
    for value in values:
        piece.append(change(value.as_py()))
        chars += _size(piece[-1])
        if chars >= PIECE_CHARS:
            pieces.append(pa.array(piece, kind))
            piece, chars = [], 0
    pieces.append(pa.array(piece, kind))
    return pa.concat_arrays(pieces)


@F.arrow_udf(T.StringType())
def _nfkc_batch(texts: pa.Array) -> pa.Array:
    return _mapped(texts, _changed, pa.string())


def nfkc(text: Column) -> Column:
    """Unicode NFKC, one Arrow batch at a time.

    Texts of one-byte characters are normal and do not leave the JVM; of the others,
    only those that change come back.
    """
    beyond_ascii = bind(text, lambda t: F.when(F.octet_length(t) != F.length(t), t))
    return F.coalesce(_nfkc_batch(beyond_ascii), text)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _nfkc_lists(lists: pa.Array) -> pa.Array:
    return _mapped(lists, _changed_each, pa.list_(pa.string()))


def nfkc_each(lists: Column) -> Column:
    """NFKC of every string of an array; a Python function cannot be called inside ``transform``."""
    beyond_ascii = bind(lists, lambda ts: F.when(F.exists(ts, lambda t: F.octet_length(t) != F.length(t)), ts))
    return F.coalesce(_nfkc_lists(beyond_ascii), lists)


def drop_special_tokens(text: Column) -> Column:
    return _replace_if(text, "<[", P.SPECIAL_TOKENS)


def drop_urls(text: Column) -> Column:
    www = ["".join(letters) + "." for letters in product("wW", repeat=3)]
    return _replace_if(text, ["@", "://", *www], P.URL_EMAIL)


def drop_control(text: Column) -> Column:
    return _replace(text, P.CONTROL)


def drop_technical(text: Column) -> Column:
    return _replace_if(text, "[{", P.TECHNICAL)


def squeeze_repeats(text: Column) -> Column:
    """Five or more of one character become three."""
    return _replace(text, P.REPEATS)


def drop_empty_pairs(text: Column) -> Column:
    return _replace_if(text, P.QUOTES + P.OPENERS, P.EMPTY_PAIRS)


def drop_lonely_marks(text: Column) -> Column:
    return _replace_if(text, P.QUOTES + P.OPENERS + P.CLOSERS, P.LONELY_MARKS)


def fix_punctuation(text: Column) -> Column:
    text = _replace_where(
        text, lambda t: F.regexp_like(t, F.lit(P.HAS_SPACE_BEFORE_PUNCT)), P.SPACE_BEFORE_PUNCT
    )
    for step in (P.SPACE_AFTER_PUNCT, P.SPACE_AFTER_DOT, P.SPACE_AFTER_DASH):
        text = _replace(text, step)
    return text


def fix_whitespace(text: Column) -> Column:
    text = _replace_if(text, ["".join(pair) for pair in product(" \t", repeat=2)], P.BLANK_RUNS)
    text = _replace_if(text, ["\n\n"], P.NEWLINE_RUNS)
    return py_strip(text)


def clean_normalized(text: Column) -> Column:
    """The JVM part of the chain, for text that already is NFKC.  The order is normative."""
    for step in (
        drop_special_tokens,
        drop_urls,
        drop_control,
        drop_technical,
        squeeze_repeats,
        drop_empty_pairs,
        drop_lonely_marks,
        fix_punctuation,
        fix_whitespace,
    ):
        text = step(text)
    return text


def within(text: Column, max_chars: int | None) -> Column:
    """Whether a text is no longer than a limit, if there is one."""
    return F.lit(True) if max_chars is None else F.length(text) <= max_chars


def clean_text(text: Column, max_chars: int | None = None) -> Column:
    """The whole cleaning chain; null and garbage texts, and those over a given limit, become ``''``."""
    usable = text.isNotNull() & within(text, max_chars) & ~is_garbage(text)
    return F.when(usable, clean_normalized(nfkc(text))).otherwise(F.lit(""))
