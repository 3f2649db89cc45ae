"""Words, tokens and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = r"\s+"


def words(text: Column) -> Column:
    """Array of the parts between whitespace; blanks at either end give an empty word."""
    return F.split(text, WHITESPACE)


def first_token(text: Column, separator: str = " ") -> Column:
    """The part before the first separator, the whole text when there is none."""
    return F.substring_index(text, separator, 1)


def tagged(result: Column, **metadata: Column) -> Column:
    """One annotation: a tag and a map that describes the tagged text."""
    entries = [part for name, value in metadata.items() for part in (F.lit(name), value)]
    return F.struct(result.alias("result"), F.create_map(*entries).alias("metadata"))


def annotate_words(text: Column, rules: dict[str, str], other: str = "X") -> Column:
    """Array of annotations, one per word; `rules` maps a tag to the pattern a word must match."""

    def annotate(word: Column) -> Column:
        tag = F.lit(other)
        for name, pattern in reversed(rules.items()):
            tag = F.when(word.rlike(pattern), F.lit(name)).otherwise(tag)
        return tagged(tag, word=word)

    return F.transform(words(text), annotate)
