"""Text functions built from Spark SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Put between a separator and the letter after it, so that Spark's `initcap`,
# which starts words at spaces only, sees a word start there. Three control
# characters in this order do not occur in names.
_WORD_START = "\u0001\u0002\u0001 "
# Letters without an upper case of one letter, as sharp s and the ligatures, stay as they
# are at the start of a word; for the time of title-casing, characters of a private area
# stand for them, which have no case.
_NO_UPPER = "".join(c for c in map(chr, range(0x80, 0xFFFF)) if len(c.title()) > 1)
_PRIVATE = "".join(chr(0x10F000 + n) for n in range(len(_NO_UPPER)))


def pg_initcap(text: Column) -> Column:
    """Title case in which every non-alphanumeric character ends a word.

    `F.initcap` ends words at spaces only: it gives ``Nando's`` and ``A-b``
    where SQL databases following PostgreSQL give ``Nando'S`` and ``A-B``.
    """
    marked = F.regexp_replace(
        text, r"(?<=[^\p{L}\p{N} ])(?=[\p{L}\p{N}])", _WORD_START
    )
    # A capital sigma would become its final form at the end of a word; a small one is
    # kept, and is capital at the start of a word either way.
    plain = F.translate(marked, _NO_UPPER + "Σ", _PRIVATE + "σ")
    titled = F.replace(F.initcap(plain), F.lit(_WORD_START), F.lit(""))
    return F.translate(titled, _PRIVATE, _NO_UPPER)


def _segment(text: Column, size: Column, number: int, distance: int, shift: int = 0) -> Column:
    """Hash of the segment `number` that a text of `size` characters has, read from `text`
    with a shift; null where it would reach over an end."""
    start = F.floor(size * number / (distance + 1)).cast("int") + shift
    width = F.floor(size * (number + 1) / (distance + 1)).cast("int") + shift - start
    inside = (start >= 0) & (start + width <= F.length(text)) & (size >= 0)
    return F.when(inside, F.xxhash64(size, F.lit(number), F.substring(text, start + 1, width)))


def segment_keys(text: Column, distance: int) -> Column:
    """Keys of the text's segments, one more than there may be edits."""
    return F.array(*(_segment(text, F.length(text), n, distance) for n in range(distance + 1)))


def shifted_segment_keys(text: Column, distance: int) -> Column:
    """Keys of what may be a segment of a text within `distance` edits: for each length that
    text may have, and each shift of its segments.

    Two texts within the distance share a key of `segment_keys` of the one and of these of
    the other: an edit changes one segment at most, so one is left, moved by the letters that
    edits before it have added or taken away. Those behind it make up the rest of the
    difference in length, and both together are no more than the distance.
    """
    return F.array_distinct(
        F.array_compact(
            F.array(
                *(
                    _segment(text, F.length(text) - added, n, distance, shift)
                    for added in range(-distance, distance + 1)
                    for shift in range(-distance, distance + 1)
                    if abs(shift) + abs(added - shift) <= distance
                    for n in range(distance + 1)
                )
            )
        )
    )
