"""Text rules as column expressions. All of them run on whole texts inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four information separators
SPACE = r"\s\x{1c}-\x{1f}"


def collapse_spaces(text: Column) -> Column:
    """Runs of the space character become one space; other white space stays."""
    return F.regexp_replace(text, " +", " ")


def strip(text: Column) -> Column:
    """Cut white space of any kind from both ends."""
    return F.regexp_replace(text, rf"(?U)\A[{SPACE}]+|[{SPACE}]+\z", "")


def cap_runs(text: Column) -> Column:
    """No character, line breaks included, more than three times in a row."""
    return F.regexp_replace(text, r"(?s)(.)\1{3,}", "$1$1$1")


def normalise(text: Column) -> Column:
    """Lower case, single spaces, stripped, runs capped at three."""
    return cap_runs(strip(collapse_spaces(F.lower(text))))


def split_spaces(text: Column) -> Column:
    """Tokens between single spaces; two spaces in a row give an empty token."""
    return F.split(text, " ", -1)


def split_words(text: Column) -> Column:
    """Tokens between runs of any white space, never empty."""
    return F.filter(F.split(strip(text), rf"(?U)[{SPACE}]+", -1), lambda t: t != "")


def tag_list(line: Column) -> Column:
    """Tags of one line: split at each space, every tag stripped."""
    return F.transform(split_spaces(line), strip)


def position_of(text: Column, part: str) -> Column:
    """0-based place of the first occurrence, null when there is none."""
    found = F.locate(part, text)
    return F.when(found > 0, found - 1)


def slug(name: Column) -> Column:
    """A name as a URL part: spaces to underscores, apostrophes percent-encoded."""
    return F.replace(F.replace(name, F.lit(" "), F.lit("_")), F.lit("'"), F.lit("%27"))


def page_url(name: Column, prefix: str, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), slug(name), F.lit(suffix))


def all_matches(text: Column, pattern: str, group: int = 1) -> Column:
    """One captured group of every match."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


# Patterns of the page cleaner, applied from first to last; the order matters.
# The two page markers.
PAGE_HEAD = r"Gameplay\[\]Playstyle"
PAGE_TAIL = "NewPP"


def html_words(html: Column) -> Column:
    """array<string> of the words of a page: tags, digits, edit marks and punctuation removed."""
    steps = [
        (r"<[^\n][^>\n]*>", ""),
        (r"\n|\t|'s|'", ""),
        (rf"\A(?d).*?{PAGE_HEAD}", ""),
        (r"(?U)\d+", ""),
        # a word that ends in [] always matches from its first character
        (rf"(?U)(?<![^{SPACE}])[^{SPACE}]*\[\]", ""),
        ("-", ""),
        (rf"(?U)[^\p{{L}}\p{{N}}_{SPACE}]", " "),
        (rf"(?s){PAGE_TAIL}.*", ""),
    ]
    text = html
    for pattern, put in steps:
        text = F.regexp_replace(text, pattern, put)
    return split_spaces(F.lower(collapse_spaces(strip(text))))


def remove_words(tokens: Column, words: Sequence[str]) -> Column:
    """Tokens that are not in a fixed word list, order and repeats kept."""
    return F.filter(tokens, lambda t: ~t.isin(*words))
