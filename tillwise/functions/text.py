"""Text cleaning and tokenising column expressions (T1-T4), all JVM-side.

Tokens follow the default bag-of-words rule: lower-cased runs of at least
two letters, digits or underscores (Unicode classes, so accented words stay
whole).  Stop words are removed before n-grams are formed, so a bigram can
join two words that had a stop word between them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two cleaning patterns (each run of matched characters
# becomes one space, no trimming) and the Portuguese stop words.
SPECIAL_CHARS = "[/<>()|\\+\\-\\$%&#@'*\"]+"
PUNCTUATION = "[,.:;!?]+"
STOP_WORDS = ["em", "sao", "ao", "de", "da", "do", "das", "no", "ou",
              "a", "o", "os", "as", "um", "uns", "uma", "umas"]
TOKEN_PATTERN = "([\\p{L}\\p{N}_]{2,})"


def clean_special(text: Column) -> Column:
    """Special characters, then punctuation, each run -> one space."""
    return F.regexp_replace(F.regexp_replace(text, SPECIAL_CHARS, " "), PUNCTUATION, " ")


def tokens(text: Column) -> Column:
    """Lower-case word tokens of two or more word characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 1)


def drop_stop_words(toks: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Remove stop words, keep order and duplicates."""
    stop = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(toks, lambda t: ~F.array_contains(stop, t))


def bigrams(toks: Column) -> Column:
    """T4: adjacent pairs joined by one space (empty for fewer than two tokens)."""
    n = F.size(toks)
    return F.when(n >= 2, F.zip_with(F.slice(toks, 1, n - 1), F.slice(toks, 2, n - 1),
                                     lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(
        F.array().cast("array<string>"))


def terms(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Unigrams followed by bigrams of the cleaned, stop-word-free tokens.

    Cleaning (T1) only turns non-word characters into spaces, so it never
    changes the runs of word characters the tokenizer extracts: the tokens of
    the cleaned text equal the tokens of the raw text, and the two whole-text
    regex passes are skipped here (``clean_special`` still gives T1's output).
    """
    toks = drop_stop_words(tokens(text), stop_words)
    # bind the token array to a lambda variable so the regex runs once per
    # text (inlining ``toks`` in concat/size/slice would evaluate it six times)
    return F.element_at(F.transform(F.array(toks), lambda t: F.concat(t, bigrams(t))), 1)
