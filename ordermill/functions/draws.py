"""Repeatable pseudo-random column expressions.

Every value is a hash of (seed, tag, key columns), so it does not depend on partitioning, a lost
task recomputes the same rows, and any table can recompute a value of another from its key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Syllables of the customer last names.
SYLLABLES = ["BAR", "OUGHT", "ABLE", "PRI", "PRES", "ESE", "ANTI", "CALLY", "ATION", "EING"]

_PER_HASH = 12  # base-26 digits taken from one hash
_SPAN = 26**_PER_HASH
_BASE26 = "0123456789ABCDEFGHIJKLMNOP"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ALPHANUMERIC = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


class Draw:
    """Draws for one table row: ``Draw(seed, "item", col("i_id")).number("im", 1, 10000)``."""

    def __init__(self, seed: int, table: str, *keys: Column):
        self.seed, self.table, self.keys = seed, table, keys

    def at(self, *more: Column) -> "Draw":
        """Draws for an element below this row, such as an order line."""
        return Draw(self.seed, self.table, *self.keys, *more)

    def bits(self, tag: str, *more: Column) -> Column:
        return F.xxhash64(F.lit(self.seed), F.lit(f"{self.table}.{tag}"), *self.keys, *more)

    def below(self, tag: str, n: Column | int, *more: Column) -> Column:
        n = n if isinstance(n, Column) else F.lit(n)
        return F.pmod(self.bits(tag, *more), n.cast("bigint"))

    def number(self, tag: str, low: int, high: int) -> Column:
        return F.lit(low).cast("bigint") + self.below(tag, high - low + 1)

    def fixed(self, tag: str, decimals: int, low: float, high: float) -> Column:
        """Evenly drawn number with so many decimals, both ends included."""
        scale = 10**decimals
        return self.number(tag, round(low * scale), round(high * scale)) / F.lit(float(scale))

    def permuted(self, x: Column, n: int, tag: str, rounds: int = 24) -> Column:
        """A drawn permutation of 0..n-1, applied to ``x``.

        Swap or not: a round pairs each number with its mirror image at a drawn centre, and a hash
        of the pair says whether the two change places. Any n will do, and nothing is listed.
        """
        def turn(v: Column, r: Column) -> Column:
            mirrored = F.pmod(self.below(f"{tag}.centre", n, r) - v, F.lit(n).cast("bigint"))
            swap = F.pmod(self.bits(f"{tag}.swap", r, F.greatest(v, mirrored)), F.lit(2)) == 1
            return F.when(swap, mirrored).otherwise(v)

        return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("bigint"), turn)

    def letters(self, tag: str, shortest: int, longest: int) -> Column:
        """Lower-case letters, twelve from each hash."""
        blocks = F.sequence(F.lit(1), F.lit(-(-longest // _PER_HASH)))
        text = F.array_join(
            F.transform(blocks, lambda n: F.lpad(F.conv(self.below(tag, _SPAN, n).cast("string"), 10, 26), _PER_HASH, "0")), ""
        )
        length = self.number(f"{tag}#", shortest, longest).cast("int")
        return F.substring(F.translate(text, _BASE26, _LETTERS), F.lit(1), length)

    def digits(self, tag: str, length: int) -> Column:
        return F.lpad(self.below(tag, 10**length).cast("string"), length, "0")

    def alphanumeric(self, tag: str, length: Column) -> Column:
        """Letters of both cases and digits; one hash each, for short texts of small tables."""
        one = lambda n: F.substring(F.lit(_ALPHANUMERIC), (F.lit(1) + self.below(tag, 62, n)).cast("int"), F.lit(1))
        picked = F.transform(F.sequence(F.lit(1), length.cast("int")), one)
        return F.when(length > 0, F.array_join(picked, "")).otherwise("")

    def one_in_ten(self, tag: str, number: Column) -> Column:
        """True for exactly one of each ten consecutive numbers, counted from one."""
        number = number - 1
        block = F.floor(number / 10)
        return F.pmod(number, F.lit(10)) == F.pmod(F.xxhash64(F.lit(self.seed), F.lit(f"{self.table}.{tag}"), *self.keys[:-1], block), F.lit(10))

    def subset(self, tag: str, count: Column, domain: int) -> Column:
        """``count`` different numbers of 1..domain; ``domain`` must be a prime."""
        start, step = self.below(f"{tag}@", domain), F.lit(1) + self.below(f"{tag}+", domain - 1)
        numbers = F.transform(F.sequence(F.lit(0), count.cast("int")), lambda n: F.lit(1) + (start + n * step) % domain)
        return F.slice(numbers, F.lit(1), count.cast("int"))

    def arrangement(self, tag: str, words: list[str], most: int) -> Column:
        """0..most of three words, in drawn order without repetition."""
        a, b, c = words
        orders = [[a, b, c], [a, c, b], [b, a, c], [b, c, a], [c, a, b], [c, b, a]]
        table = F.array(*[F.array(*[F.lit(w) for w in order]) for order in orders])
        picked = F.element_at(table, (F.lit(1) + self.below(f"{tag}!", 6)).cast("int"))
        return F.slice(picked, F.lit(1), self.below(f"{tag}#", most + 1).cast("int"))


def nurand(a: Column, x_to_y: Column, constant: int | Column, low: int, high: int) -> Column:
    """Non-uniform number: ``a`` is even on 0..A, ``x_to_y`` even on low..high."""
    shift = constant if isinstance(constant, Column) else F.lit(constant)
    return (a.bitwiseOR(x_to_y) + shift) % F.lit(high - low + 1) + F.lit(low)


def last_name(number: Column) -> Column:
    """Three syllables for the three digits of 0..999."""
    table = F.array(*[F.lit(s) for s in SYLLABLES])

    def syllable(n: Column) -> Column:
        return F.get(table, n.cast("int"))

    return F.concat(syllable(F.floor(number / 100)), syllable(F.floor(number / 10) % 10), syllable(number % 10))
