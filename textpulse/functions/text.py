"""Text expressions. All of them stay inside JVM expressions; there is no Python UDF."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from textpulse.schemas import TAG_PREFIX_TO_POS

# Patterns.
PUNCTUATION = r"[^\w\s]"
PUNCTUATION_UNICODE = r"[^\p{L}\p{N}_\s]"
SURFACE_TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
ALPHANUMERIC = r"^[\p{L}\p{N}]+$"
WHITE_SPACE = " \t\n\x0b\f\r"
MIN_LEXICAL_LENGTH = 3


def clean_text(text: Column, unicode: bool = False) -> Column:
    """Remove punctuation, then lower-case.

    The default keeps ASCII word characters only; ``unicode=True`` keeps the letters
    and digits of every script.
    """
    pattern = PUNCTUATION_UNICODE if unicode else PUNCTUATION
    return F.lower(F.regexp_replace(text, pattern, ""))


def word_count(text: Column) -> Column:
    """Pieces between single spaces; empty pieces count, tabs and newlines do not split."""
    return F.size(F.split(text, " "))


def lower_words(text: Column) -> Column:
    """The words ``pyspark.ml.feature.Tokenizer`` gives, as an SQL expression.

    Leading and inner empty words are kept and trailing ones dropped; an empty text
    has one empty word and a text of white space only has none.
    """
    words = F.split(F.rtrim(F.lower(text), F.lit(WHITE_SPACE)), r"\s")
    none = F.array().cast("array<string>")
    return F.when(text.rlike(r"^\s++$"), none).otherwise(words)


def ngrams(words: Column, n: int) -> Column:
    """Runs of ``n`` words joined by a space; fewer than ``n`` words give an empty array.

    The word array is zipped with itself shifted, so the work is linear in its length.
    """
    length = F.greatest(F.size(words) - (n - 1), F.lit(0))
    runs = F.slice(words, 1, length)
    for shift in range(1, n):
        shifted = F.slice(words, shift + 1, length)
        runs = F.zip_with(runs, shifted, lambda run, word: F.concat(run, F.lit(" "), word))
    return runs


def surface_tokens(text: Column) -> Column:
    """Case-preserving tokens: runs of letters and digits, and single other marks."""
    return F.regexp_extract_all(text, F.lit(SURFACE_TOKEN), F.lit(0))


def is_lexical_word(word: Column) -> Column:
    """True for alphanumeric words of three characters or more."""
    return word.rlike(ALPHANUMERIC) & (F.length(word) >= MIN_LEXICAL_LENGTH)


def lexicon_pos(tag: Column) -> Column:
    """Lexicon part of speech for a tag, from its two-letter prefix; null when unmapped."""
    table = F.create_map(*[F.lit(x) for x in chain(*TAG_PREFIX_TO_POS.items())])
    return F.try_element_at(table, F.substring(tag, 1, 2))


def name_heads(names: Column) -> Column:
    """The part of every name before its first dot."""
    return F.transform(names, lambda name: F.substring_index(name, ".", 1))
