"""Text expressions: words, topics and prompt text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words left out of the trending words, English first, then
# colloquial Tunisian.
STOP_WORDS = (
    "the", "and", "this", "that", "with", "from", "for",
    "what", "your", "would", "want", "have", "when", "they", "there", "which",
    "about", "like", "just", "more", "here", "actually", "https", "what's",
    "most", "being", "thing", "were", "ever",
    "eli", "mta3", "ala", "fama", "haka", "bech", "fi",
    "ken", "houwa", "hiyya", "mouch", "bara", "aya",
)
LONGEST_SKIPPED_WORD = 3

# What Python's str.strip() removes: Unicode white space and the four
# information separators.
_EDGE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def words(title: Column, content: Column) -> Column:
    """Lower-cased words of title and content; ASCII punctuation separates."""
    text = F.lower(F.concat_ws(" ", title, content))
    return F.split(text, r"[\p{Punct}\s]+")


def is_trend_word(word: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Whether a word is long enough and no stop word."""
    return ~word.isin(*stop_words) & (F.length(word) > LONGEST_SKIPPED_WORD)


def clean_topic(topic: Column) -> Column:
    """Topic in lower case without surrounding spaces."""
    return F.lower(F.trim(topic))


def prompt_text(title: Column, content: Column) -> Column:
    """Title, blank line, content; missing parts are empty, edges stripped."""
    joined = F.concat(
        F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(content, F.lit(""))
    )
    return F.trim(joined, F.lit(_EDGE_SPACE))


def unescape_ampersand(url: Column) -> Column:
    return F.replace(url, F.lit("&amp;"), F.lit("&"))
