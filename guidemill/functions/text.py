"""Normal forms of titles and channel names.

Folding to plain letters needs Unicode decomposition, which Spark SQL has no function for: one Arrow function does it, everything after it is built-in.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: Titles that say nothing: fixed values.
EMPTY_TITLES = [
    "", "n a", "na", "none", "unknown", "tba", "to be announced", "no information", "no information available", "no programme information",
    "no program information", "no programme information available", "no program information available", "no epg", "no epg information", "no event",
    "no event information", "not available", "unavailable", "schedule unavailable", "programme unavailable", "program unavailable", "no data",
    "no schedule", "epg not available", "programme information not available", "program information not available",
]
#: A title of this form says nothing either: fixed value.
EMPTY_TITLE = r"^(no|not)\s+((programme|program|event|epg|schedule)\s+)?(information\s*)?(available|unavailable)?$"

#: Endings of catalogue ids that aren't part of a name: fixed value.
CATALOGUE_ENDING = r"(?i)\.(?:us(?:\d+|_locals\d+)?|uk\d*|in\d*|ie\d*|ca\d*|au\d*|nz\d*|ch\d*|es\d*)$"


@pandas_udf(StringType())
def plain(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks."""

    def one(x):
        if x is None or x.isascii():
            return x
        return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))

    return text.map(one)


@pandas_udf(StringType())
def compat(text: pd.Series) -> pd.Series:
    """Compatibility composition (NFKC)."""
    return text.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


@pandas_udf(StringType())
def repair_encoding(text: pd.Series) -> pd.Series:
    """UTF-8 that was read as a one-byte encoding, read again, at most twice and only if that leaves fewer signs of it."""
    marks = "ÃÂâðï�"

    def one(x):
        for _ in range(2):
            if x is None or x.isascii():
                break
            count = sum(x.count(m) for m in marks)
            tries = []
            for name in ("latin-1", "cp1252"):
                try:
                    tries.append(x.encode(name).decode("utf-8"))
                except UnicodeError:
                    continue
            better = [y for y in tries if sum(y.count(m) for m in marks) < count]
            if not better:
                break
            x = better[0]
        return x

    return text.map(one)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normal_title(title: Column, folded: bool = False) -> Column:
    """Plain small letters and digits with single spaces, & as and; null: empty. folded: the title has been through plain()."""
    text = F.coalesce(title, F.lit(""))
    text = text if folded else plain(text)
    return F.trim(F.regexp_replace(F.replace(F.lower(text), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def is_informative(title: Column, folded: bool = False) -> Column:
    text = normal_title(title, folded)
    return ~text.isin(EMPTY_TITLES) & ~text.rlike(EMPTY_TITLE)


def split_camel(text: Column) -> Column:
    """A space between a small letter or digit and a capital, and before the last capital of a run that a small letter follows."""
    return F.regexp_replace(F.regexp_replace(text, "([a-z0-9])([A-Z])", "$1 $2"), "([A-Z]+)([A-Z][a-z])", "$1 $2")


def id_to_name(guide_id: Column) -> Column:
    """A readable name of a guide id: without a catalogue's ending, camel case split, + as plus, without the word dummy."""
    text = F.regexp_replace(F.trim(guide_id), CATALOGUE_ENDING, "")
    text = F.regexp_replace(F.replace(split_camel(text), F.lit("+"), F.lit(" plus ")), r"[._/\\-]+", " ")
    return squeeze(F.regexp_replace(text, r"(?i)\bdummy\b", " "))


def tokens(text: Column, without: list[str] = (), folded: bool = False) -> Column:
    """The words of a title's normal form in order, with repeats, less those of `without`."""
    words = F.filter(F.split(normal_title(text, folded), " "), lambda x: x != "")
    return F.filter(words, lambda x: ~x.isin(list(without))) if without else words


def strict_key(words: Column) -> Column:
    return F.array_join(words, " ")


def compact_key(words: Column) -> Column:
    return F.array_join(words, "")


def bag_key(words: Column) -> Column:
    """Sorted words, repeats kept."""
    return F.array_join(F.array_sort(words), " ")


def acronym(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda x: F.substring(x, 1, 1)), "")


def icon_key(text: Column) -> Column:
    return F.lower(squeeze(F.coalesce(text, F.lit(""))))
