"""Text predicates as Spark column expressions.

Characters of a class are counted as the length lost when runs of them are
removed, which visits each run once instead of each character.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import patterns as P
from textloom.functions.binding import bind


def _count_outside(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are not in the class ``chars``."""
    return F.length(F.regexp_replace(text, F.lit(f"(?U)[{chars}]++"), F.lit("")))


def is_garbage(text: Column) -> Column:
    """Shorter than 2, too few letters, or too many characters that are neither alphanumeric nor space."""
    n = F.length(text)
    size = F.nullif(n, F.lit(0))

    def ratios(non_letters: Column) -> Column:
        special = _count_outside(text, P.ALNUM + P.SPACE)
        few_letters = (n - non_letters) / size < P.MIN_LETTER_RATIO
        # special characters are non-letters, so count them only where non-letters alone pass the bound
        many_specials = (non_letters / size > P.MAX_SPECIAL_RATIO) & (special / size > P.MAX_SPECIAL_RATIO)
        return few_letters | many_specials

    return (n < 2) | bind(_count_outside(text, P.LETTER), ratios)


def is_valid(text: Column, threshold: float = P.VALID_RATIO) -> Column:
    """Long enough, and the share of unusual characters is small."""
    n = F.length(text)
    size = F.nullif(n, F.lit(0))
    weird = _count_outside(text, P.WEIRD_ALLOWED)
    return (n >= P.MIN_VALID_CHARS) & (F.lit(1.0) - weird / size >= threshold)


def code_hits(text: Column) -> Column:
    """Whole-word programming keywords plus braces, square brackets and semicolons."""
    word = f"[{P.WORD}]"
    starts = "".join(sorted({w[0] for w in P.CODE_WORDS}))
    # the look-ahead rejects most positions by one table lookup
    pattern = (
        f"(?=[{starts}{P.CODE_MARKS}])"
        f"(?:(?<!{word})(?:{'|'.join(P.CODE_WORDS)})(?!{word})|[{P.CODE_MARKS}])"
    )
    return F.regexp_count(text, F.lit(pattern))


def looks_like_code(text: Column, min_hits: int = P.MIN_CODE_HITS) -> Column:
    return code_hits(text) >= min_hits
