"""Repeatable random draws.

Every draw is a pure function of (tag, seed, id), so the same rows come out
whatever the partitioning and however often a lost task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = "0123456789abcdef"


def digest(tag: str, seed: int, ident: Column) -> Column:
    """32 hex digits from which up to four draws can be cut."""
    return F.md5(F.concat(F.lit(f"{tag}:{seed}:"), ident.cast("string")))


def draw(hex32: Column, slot: int) -> Column:
    """Whole number below 2**32 from one of the four quarters of a digest."""
    return F.conv(F.substring(hex32, 8 * slot + 1, 8), 16, 10).cast("bigint")


def wide_draw(hex32: Column) -> Column:
    """Whole number below 2**60, for picking among very many rows."""
    return F.conv(F.substring(hex32, 1, 15), 16, 10).cast("bigint")


def whole_between(number: Column, low: int, high: int) -> Column:
    """Both ends included."""
    return (number % (high - low + 1) + low).cast("int")


def money_between(number: Column, low: int, high: int) -> Column:
    """Amount with two decimals, both ends included."""
    return (number % (100 * (high - low) + 1) + 100 * low) / F.lit(100.0)


def one_of(number: Column, values: Sequence[str]) -> Column:
    choices = F.array(*[F.lit(v) for v in values])
    return F.element_at(choices, (number % len(values) + 1).cast("int"))


def words_from(hex32: Column, words: Sequence[str], count: int) -> list[Column]:
    """``count`` words, each chosen by one hex digit from a list of sixteen."""
    choices = F.array(*[F.lit(w) for w in words])
    return [
        F.element_at(choices, F.instr(F.lit(HEX_DIGITS), F.substring(hex32, i + 1, 1)))
        for i in range(count)
    ]
