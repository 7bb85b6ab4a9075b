"""Text normalisation and tokens as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache
import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .numeric import as_col

# Fixed values
#: White space of any script, as a character class.
BLANK = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
SPACE = BLANK + "+"
WORD = r"[\p{L}\p{N}_]{2,}"
DROPPED_PUNCTUATION = "~,!?\"':;)("
HALF_WIDTH = ",.“”"
FULL_WIDTH = "，。\"\""
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def strip(c) -> Column:
    """Text without white space at both ends."""
    return F.regexp_replace(as_col(c), f"^{SPACE}|{SPACE}\\z", "")


def tokens(c) -> Column:
    """Words between runs of white space."""
    return F.filter(F.split(as_col(c), SPACE), lambda t: t != "")


def word_tokens(c) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(as_col(c)), F.lit(WORD), F.lit(0))


def chars(c) -> Column:
    return F.filter(F.split(F.lower(as_col(c)), ""), lambda t: t != "")


def ngrams(words: Column, n: int, joiner: str = " ") -> Column:
    """All n-grams of a token array in order."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), joiner))


def counted(items: Column) -> Column:
    """(item, c) of the distinct items of an array, by a sort inside the row. Arrays of one entry hold what is read more than
    once, so that it is worked out once."""

    def runs(s: Column) -> Column:
        places = F.when(F.size(s) > 0, F.sequence(F.lit(1), F.size(s))).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda p: (p == 1) | (F.get(s, p - 1) != F.get(s, p - 2)))

        def lengths(b: Column) -> Column:
            end = lambda j: F.coalesce(F.get(b, j + 1), F.size(s) + 1)
            return F.transform(b, lambda p, j: F.struct(F.get(s, p - 1).alias("item"), (end(j) - p).cast("long").alias("c")))

        return F.get(F.transform(F.array(starts), lengths), F.lit(0))

    return F.get(F.transform(F.array(F.sort_array(items)), runs), F.lit(0))


def normalize_basic(c) -> Column:
    """Lower case, a set of punctuation and all digits removed, a space before ``?``, ``!`` and ``.``."""
    dropped = F.regexp_replace(F.lower(as_col(c)), "[" + re.escape(DROPPED_PUNCTUATION) + "]", "")
    return F.regexp_replace(F.regexp_replace(dropped, "[0-9]+", ""), "([?!.])", " $1")


def strip_accents(c) -> Column:
    """Accents removed by a fixed table of Latin letters; input is lower case."""
    return F.translate(as_col(c), ACCENTED, PLAIN)


def _letters_only(c: Column) -> Column:
    # by plain replacements where they do: a pattern that is met at every gap between words takes most of the time
    for mark in ".!?":
        c = F.replace(c, F.lit(mark), F.lit(" " + mark))
    other = "".join(x for x in map(chr, range(128)) if not re.match("[a-zA-Z.!? ]", x))
    c = F.translate(c, other, " " * len(other))
    return F.regexp_replace(F.regexp_replace(c, "[^\\x00-\\x7F]+", " "), " {2,}", " ")


def normalize_ascii(c) -> Column:
    """Lower case, accents stripped, space before sentence marks, all else than letters and marks becomes a space."""
    return _letters_only(strip_accents(F.lower(strip(c))))


MARKS = "[̀-ͯ҃-֑҇-ֽً-ٟ᪰-᫿᷀-᷿⃐-⃰︠-︯]"


#: Runs of so many characters that need no decomposition are passed over before a text is looked through for those that do.
WIDE_GAP = 1024


def _char_class(ranges) -> str:
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


@cache
def _bare_letters() -> tuple[str, str, str, str]:
    """Characters that decompose into one character and dropped marks, what is left of them, a pattern of those of which two or
    more are left, and one of the wide gaps between these. Dropped marks stand at the end of the first, without a counterpart."""
    one, left, more, gone = [], [], [], []
    for code in (c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000):
        letter = chr(code)
        parts = unicodedata.normalize("NFD", letter)
        rest = re.sub(MARKS, "", parts)
        if not rest:
            gone.append(letter)
        elif len(rest) > 1 or unicodedata.combining(rest):
            more.append(code)
        elif rest != letter:
            one.append(letter)
            left.append(rest)
    ranges = []
    for code in more:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    edges = [-1, *(code for pair in ranges for code in pair), sys.maxunicode + 1]
    gaps = [(a + 1, b - 1) for a, b in zip(edges[::2], edges[1::2]) if b - a > WIDE_GAP]
    return "".join(one + gone), "".join(left), _char_class(ranges), _char_class(gaps)


def strip_marks(c) -> Column:
    """Canonical decomposition with all combining marks dropped, for letters outside the fixed table. Texts with characters of
    which more than one is left, or with marks that stay and may change places, are decomposed whole; all others stay in the JVM."""
    one, left, more, plain = _bare_letters()
    text = as_col(c)
    # the pattern is long and slow, so it sees only what is left without the characters of the gaps
    hard = F.regexp_replace(text, plain + "+", "").rlike(more)
    return F.when(hard, _decomposed(F.when(hard, text))).otherwise(F.translate(text, one, left))


@F.pandas_udf(T.StringType())
def _decomposed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else re.sub(MARKS, "", unicodedata.normalize("NFD", t)))


def normalize_ascii_full(c) -> Column:
    return _letters_only(strip_marks(F.lower(strip(c))))


def half_to_full(c) -> Column:
    """Comma and full stop to their full-width forms, curly quotes to straight ones."""
    return F.translate(as_col(c), HALF_WIDTH, FULL_WIDTH)


def to_text(c) -> Column:
    """UTF-8 bytes to text; bytes that are not valid are dropped, all in the JVM. Replacement characters that belong to the text
    are written in another way while those of the invalid bytes are dropped."""
    raw = as_col(c).cast("string")
    mark = "\ufffd"
    safe = F.replace(F.replace(raw, F.lit("\x01"), F.lit("\x01a")), F.lit(mark), F.lit("\x01b"))
    kept = F.replace(F.make_valid_utf8(safe), F.lit(mark), F.lit(""))
    whole = F.replace(F.replace(kept, F.lit("\x01b"), F.lit(mark)), F.lit("\x01a"), F.lit("\x01"))
    return F.coalesce(F.try_validate_utf8(raw), whole)


def substitute(c, mapping: Mapping[str, str]) -> Column:
    """Replace phrases without regard to case, in the order of the mapping."""
    out = as_col(c)
    for phrase, value in mapping.items():
        out = F.regexp_replace(out, "(?i)" + re.escape(phrase), value.replace("\\", "\\\\").replace("$", "\\$"))
    return out


def restore(c, mapping: Mapping[str, str]) -> Column:
    """Undo ``substitute``: put the phrase back in place of its marker."""
    out = as_col(c)
    for phrase, value in mapping.items():
        out = F.replace(out, F.lit(value), F.lit(phrase))
    return out
