"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def space_tokens(text: Column) -> Column:
    """Split on single spaces; inner empty tokens stay, trailing ones go.

    Text of nothing but spaces has no tokens; empty text has one empty token.
    """
    trimmed = F.rtrim(text)
    none = F.array().cast("array<string>")
    return F.when((trimmed == "") & (text != ""), none).otherwise(F.split(trimmed, " "))


def letter_counts(text: Column, letters: Sequence[str]) -> list[Column]:
    """One double column ``n_<letter>`` per letter: how often it occurs, case-sensitively.

    Letters are single ASCII characters, so byte lengths count them exactly.
    """
    return [
        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(letter), F.lit(""))))
        .cast("double")
        .alias(f"n_{letter}")
        for letter in letters
    ]
