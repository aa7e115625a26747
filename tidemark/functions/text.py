"""Text cutting and tokenizing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The review stop words.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've",
    "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "she's", "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "that'll",
    "these", "those", "am", "is", "are", "was", "were", "be",
]

# Characters cut from both ends of a corpus token.
EDGE_MARKS = ".,<>()-[]:;?!"
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Every character that counts as blank between corpus tokens.
BLANKS = "[\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"

# A letter a-z followed by any letter, digit or underscore.
WORDLIKE = "[A-Za-z][\\p{L}\\p{N}_]"


def tokenize(text: Column) -> Column:
    """Lower-case runs of ASCII letters, in order.

    Non-letters become blanks before lowering, so no non-ASCII letter folds into one.
    """
    letters = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^a-zA-Z]+", " "))
    return F.array_remove(F.split(letters, " "), "")


def without_stop_words(tokens: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Drop stop words; repeated words stay repeated."""
    return F.filter(tokens, lambda w: ~w.isin(*stop_words))


def split_on_space(text: Column) -> Column:
    """Split on single spaces; empty tokens stay."""
    return F.split(text, " ", -1)


def strip_tags(text: Column) -> Column:
    """Remove every ``<...>``."""
    return F.regexp_replace(text, "<[^>]+>", "")


def header(line: Column) -> Column:
    """The first ``<...>`` of a line, or the empty string."""
    return F.regexp_extract(line, "<[^>]+>", 0)


def body(line: Column) -> Column:
    """From the first ``>`` (kept) up to ``</doc>``.

    Without ``</doc>`` the last character is cut; without ``>`` nothing is left.
    """
    start = F.instr(line, ">")
    end = F.instr(line, "</doc>")
    stop = F.when(end > 0, end).otherwise(F.length(line))
    size = F.greatest(stop - start, F.lit(0))
    return F.when(start > 0, F.substr(line, start, size)).otherwise(F.lit(""))


def corpus_tokens(line: Column) -> Column:
    """Tokens for the corpus vocabulary: blank-separated, lowered, edge marks cut, two characters or more."""
    words = F.transform(
        F.split(body(line), BLANKS), lambda w: F.trim(F.lower(w), F.lit(EDGE_MARKS))
    )
    return F.filter(words, lambda w: F.length(w) > 1)


def corpus_word(piece: Column) -> Column:
    """The token that ``corpus_tokens`` makes of a piece between blanks, null for none."""
    word = F.trim(F.lower(piece), F.lit(EDGE_MARKS))
    return F.when(F.length(word) > 1, word)


def counted_tokens(line: Column) -> Column:
    """Tokens for counting: space-separated, word-like, lowered, punctuation cut, three characters or more."""
    wordlike = F.filter(F.split(body(line), " ", -1), lambda w: w.rlike(WORDLIKE))
    words = F.transform(wordlike, lambda w: F.trim(F.lower(w), F.lit(ASCII_PUNCTUATION)))
    return F.filter(words, lambda w: F.length(w) > 2)


def counted_word(piece: Column) -> Column:
    """The token that ``counted_tokens`` makes of a piece between spaces, null for none."""
    word = F.trim(F.lower(piece), F.lit(ASCII_PUNCTUATION))
    return F.when(piece.rlike(WORDLIKE) & (F.length(word) > 2), word)


def unquote(text: Column) -> Column:
    """Remove double quotes."""
    return F.replace(text, F.lit('"'), F.lit(""))


def hour_of(stamp: Column) -> Column:
    """The two-digit hour of ``date HH:MM:SS`` text."""
    return F.split_part(F.split_part(stamp, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))
