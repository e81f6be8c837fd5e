"""Post text: cleaning, tokens, keyword matching.

Character classes are spelled out because ``\\w`` and ``\\s`` mean ASCII to Java's regex engine while
posts are written in any script.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Unicode white space (with the four separator controls) and word characters.
SPACE = r"\x1C-\x1F\p{IsWhite_Space}"
WORD = r"\p{L}\p{N}_"

URL_PATTERN = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
# Two patterns that each start with a plain character are faster than one with a choice.
MENTION_PATTERN = rf"@[{WORD}]+"
HASHTAG_PATTERN = rf"#([{WORD}]+)"
SPACES_PATTERN = rf"[{SPACE}]+"
# A token keeps combining marks, so that decomposed letters and vowel signs do not split a word.
TOKEN_PATTERN = rf"([{WORD}\p{{M}}]+)"


def strip_markup(text: Column) -> Column:
    """Lower-case, drop URLs and mentions, unwrap hashtags; NULL becomes ``''``."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, URL_PATTERN, "")
    out = F.regexp_replace(out, MENTION_PATTERN, "")
    return F.regexp_replace(out, HASHTAG_PATTERN, "$1")


def clean_text(text: Column) -> Column:
    """`strip_markup`, then white space collapsed to single blanks and trimmed.

    Tokens do not depend on the last step, which touches every word; scoring leaves it out.
    """
    return F.trim(F.regexp_replace(strip_markup(text), SPACES_PATTERN, " "))


def tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Words of a text without markup, less stop words and punctuation."""
    words = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 1)
    # A literal list becomes a hash set, so the test costs the same for 8 words and for 800.
    return F.filter(words, lambda w: ~w.isin(*stop_words)) if stop_words else words


def filtered_text(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """The kept tokens joined back with blanks."""
    return F.array_join(tokens(text, stop_words), " ")


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    """True where the text holds at least one keyword, ignoring case."""
    lowered = F.lower(text)
    hits = [F.contains(lowered, F.lit(k.lower())) for k in keywords]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def keyword_tags(text: Column, keywords: Sequence[str]) -> Column:
    """The keywords found in the text, ignoring case, in list order and original spelling."""
    lowered = F.lower(text)
    found = [F.when(F.contains(lowered, F.lit(k.lower())), F.lit(k)) for k in keywords]
    if not found:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*found))
