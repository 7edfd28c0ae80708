"""Timestamps written in several layouts within one column."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five layouts in which source systems write dates.
# Slashes and dashes with the day first are read day-first.
MIXED_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "yyyy/MM/dd HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
    "MMM dd, yyyy hh:mm a",
)


def _shape(layout: str) -> str:
    """Regular expression of the texts a layout can read."""

    def part(run: re.Match) -> str:
        letters = run[0]
        if not letters[0].isalpha():
            return re.escape(letters)
        if letters[0] == "a" or len(letters) > 2 and letters[0] == "M":
            return r"\p{L}+"
        return rf"\d{{{len(letters)}}}"

    return "^" + re.sub(r"([A-Za-z])\1*|[^A-Za-z]+", part, layout) + "$"


def parse_mixed_timestamp(
    text: Column, layouts: Sequence[str] = MIXED_LAYOUTS
) -> Column:
    """First layout that fits wins; text which fits none, and null, give null.

    The result is a TIMESTAMP_NTZ. A layout is tried on texts of its shape only,
    since a failed attempt costs far more than the look at the shape. The text is read as UTC and turned back into
    a wall-clock time by adding seconds to the epoch, so the session time zone
    and its daylight-saving gaps play no part.
    """
    seconds = F.coalesce(
        *(
            F.when(
                text.rlike(_shape(layout)),
                F.unix_seconds(
                    F.try_to_timestamp(
                        F.concat(text, F.lit(" +0000")), F.lit(f"{layout} xx")
                    )
                ),
            )
            for layout in layouts
        )
    )
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, epoch)
