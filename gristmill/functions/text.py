"""Text expressions: tags, tokens, patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """True for null, empty and all-blank text."""
    return text.isNull() | (F.length(F.trim(text)) == 0)


def normalise_tag(tag: Column) -> Column:
    """Trimmed, upper case and with exactly the leading ``#`` it may lack: ``ai`` and ``#AI`` agree."""
    clean = F.upper(F.trim(tag))
    return F.when(clean.startswith("#"), clean).otherwise(F.concat(F.lit("#"), clean))


def normalise_label(label: Column) -> Column:
    return F.lower(F.trim(label))


def tokens(text: Column, pattern: str = r"\W+", lower: bool = True) -> Column:
    """Non-empty pieces of ``text`` between matches of ``pattern``."""
    source = F.lower(text) if lower else text
    return F.array_remove(F.split(source, pattern), "")


def runs(sorted_pieces: Column) -> Column:
    """The distinct pieces of a sorted array with how often each occurs, as ``(term, tf)``.

    Counting inside the row needs no shuffle of (document, term) pairs. The array should be
    a column of its own, since it is read many times.
    """
    size = F.size(sorted_pieces)
    starts = F.filter(
        F.sequence(F.lit(1), size),
        lambda i: (i == 1) | (F.element_at(sorted_pieces, i) != F.element_at(sorted_pieces, F.greatest(i - 1, F.lit(1)))),
    )
    ends = F.concat(F.slice(starts, F.lit(2), size), F.array(size + 1))
    counted = F.zip_with(
        starts,
        ends,
        lambda start, end: F.struct(
            F.element_at(sorted_pieces, start).alias("term"), (end - start).cast("long").alias("tf")
        ),
    )
    return F.when(size > 0, counted)


def words(text: Column) -> Column:
    """Lower-case words between blanks."""
    return tokens(text, pattern=r"\s+")


def contains_pattern(text: Column, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive search for a regular expression, or for the text itself if ``literal``.

    Missing text does not match.
    """
    if literal:
        found = F.contains(F.lower(text), F.lower(F.lit(pattern)))
    else:
        found = text.rlike("(?iu)" + pattern)
    return F.coalesce(found, F.lit(False))
