"""Text cleaning and n-gram expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of the text cleaning; each match becomes one space.
URL_PATTERN = (
    r"(https?|ftp|file)://[-a-zA-Z0-9+&@#/%?=~_|!:,.;]*[-a-zA-Z0-9+&@#/%=~_|]"
)
REF_OPEN_PATTERN = r"<ref[^>]*>"
REF_CLOSE_PATTERN = r"</ref>"
LOOSE_APOSTROPHE_PATTERN = r"'(?![a-z])|(?<![a-z])'"
SEPARATOR_PATTERN = r"[^a-z']+"


def clean_text(text: Column) -> Column:
    """Lower-case text without URLs, reference tags and apostrophes outside words."""
    for pattern in (URL_PATTERN, REF_OPEN_PATTERN, REF_CLOSE_PATTERN, LOOSE_APOSTROPHE_PATTERN):
        text = F.regexp_replace(text, pattern, " ")
    return text


def tokens(text: Column) -> Column:
    """Words of cleaned text, in order."""
    return F.array_remove(F.split(text, SEPARATOR_PATTERN), "")


def ngram_total(words: Column, nmax: int) -> Column:
    """How many grams of 1..nmax words a word array yields."""
    size = F.size(words)
    return sum(
        (F.greatest(size - (n - 1), F.lit(0)) for n in range(1, nmax + 1)), F.lit(0)
    ).cast("bigint")


def proper_prefixes(word: Column) -> Column:
    """Prefixes of a word shorter than the word itself."""
    length = F.char_length(word)
    return F.when(
        length > 1,
        F.transform(F.sequence(F.lit(1), length - 1), lambda n: F.substring(word, F.lit(1), n)),
    )


def head_words(gram: Column) -> Column:
    """A gram without its last word."""
    return F.regexp_extract(gram, r"^(.*) [^ ]*$", 1)


def last_word(gram: Column) -> Column:
    return F.substring_index(gram, " ", -1)
