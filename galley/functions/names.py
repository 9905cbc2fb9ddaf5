"""Names of people and slugs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that say that a display name holds several people.
SEVERAL = ("-and-", " and ", " &amp; ", ",")

WORD = r"\p{L}\p{N}_"
_NOT_IN_NAMES = rf"^(?:by-|By-|By |by )|[^{WORD} ^'.\-]|_|\p{{Nd}}"


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def truthy(c: Column) -> Column:
    """The text, or null if it is empty."""
    return F.nullif(c, F.lit(""))


def similarity_key(name: Column) -> Column:
    """Letters (and numerals that are no digits) alone, in lower case."""
    return F.lower(F.regexp_replace(name, r"[^\p{L}\p{N}]|\p{Nd}", ""))


def _cleaned(name: Column) -> Column:
    return strip(F.regexp_replace(name, _NOT_IN_NAMES, ""))


def clean_author(name: Column) -> Column:
    """One person's display name: before any `@`, dots before two word characters as spaces, leading
    `by` and odd characters off, tokens capitalised without touching their tails."""
    c = F.replace(F.split_part(name, F.lit("@"), F.lit(1)), F.lit("&amp;"), F.lit("&"))
    c = _cleaned(F.regexp_replace(c, rf"\.(?=[{WORD}]{{2}})", " "))
    capital = F.transform(F.split(c, " ", -1), lambda t: F.concat(F.upper(t.substr(1, 1)), t.substr(F.lit(2), F.length(t))))
    return F.array_join(capital, " ")


def clean_authors(name: Column) -> Column:
    """Several people's names in one text, as an array; pieces may be empty."""
    pieces = F.split(name, rf",|&|(?<![{WORD}])and(?![{WORD}])", -1)
    return F.transform(pieces, _cleaned)


def holds_several(name: Column) -> Column:
    out = F.lit(False)
    for mark in SEVERAL:
        out = out | F.contains(name, F.lit(mark))
    return F.coalesce(out, F.lit(False))


def split_display_name(name: Column) -> tuple[Column, Column]:
    """(first, last), parted at the last space; nulls if there is none."""
    at = F.length(name) - F.length(F.substring_index(name, " ", -1))
    has = F.contains(name, F.lit(" "))
    return F.when(has, name.substr(F.lit(1), at - 1)), F.when(has, F.substring_index(name, " ", -1))


def build_display_name(first: Column, last: Column) -> Column:
    return truthy(F.concat_ws(" ", truthy(first), truthy(last)))


def slug(c: Column) -> Column:
    """Lower-case ASCII letters and digits, other runs as one hyphen, none at the ends; '' for null."""
    low = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "-")
    return F.regexp_replace(low, "^-|-$", "")


def byline_key(c: Column) -> Column:
    return F.lower(F.translate(c, ".-_ ", ""))


def shingles(key: Column, k: int = 3) -> Column:
    """Distinct runs of k characters; a shorter text is its own and only one."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(key) - (k - 1), F.lit(1))), lambda i: key.substr(i, F.lit(k)))
    return F.array_distinct(runs)


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both.cast("double") / (F.size(a) + F.size(b) - both)
