"""Few changed keys on large tables, without an exchange of the rows that do not change.

The changed keys become a filter of bits, a single value of known size that every task of a scan
holds. Rows whose bit is not set cannot match and pass as they are; the others, the changed ones
and a few more, are joined with the changes themselves. The filter has one size whatever the data:
the more keys it holds, the more rows take the join, and the result is always that of a plain join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A megabyte: with a million changed keys, one unchanged row in nine takes the join.
FILTER_BITS = 1 << 23
_WORD = 64


def _place(keys: list[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def key_filter(base: DataFrame, changed: DataFrame, keys: list[str], bits: int = FILTER_BITS) -> Column:
    """Whether the key of a row of ``base`` may be among those of ``changed``; never false for one that is.

    Keys are compared in the types of ``base``. Null keys follow the rule of joins: they match nothing, whatever the filter says.
    """
    places = changed.select(_place([F.col(k).cast(base.schema[k].dataType) for k in keys], bits).alias("place"))
    return among_places(places, _place([F.col(k) for k in keys], bits), bits)


def among_places(places: DataFrame, place: Column, bits: int) -> Column:
    """Whether ``place`` is a value of the column ``place`` of ``places``; all are numbers from 0 to below ``bits``, a multiple of 64."""
    set_bits = places.groupBy(F.floor(F.col("place") / _WORD).alias("id")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(place % {_WORD} as int))")).alias("word")
    )
    every = places.sparkSession.range(0, bits // _WORD, 1, 1).join(set_bits, "id", "left")
    words = every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("bigint")).alias("word"))))["word"].alias("words"))
    word = F.get(words.scalar(), F.floor(place / _WORD).cast("int"))
    return F.getbit(word, (place % _WORD).cast("int")) == 1


def possible(base: DataFrame, changed: DataFrame, keys: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """``base`` without most of the rows that no key of ``changed`` has: what a join with it need shuffle."""
    return base.where(key_filter(base, changed, keys, bits))


def laid_over(base: DataFrame, changes: DataFrame, keys: list[str], change: Callable[[DataFrame], DataFrame], bits: int = FILTER_BITS) -> DataFrame:
    """``base`` with ``change`` applied to its rows left-joined with ``changes`` (at most one per key).

    ``change`` must give a row without a partner back as it was.
    """
    may = key_filter(base, changes, keys, bits)
    joined = base.where(may).join(changes, keys, "left")
    return base.where(~may).unionByName(change(joined).select(base.columns))


def without_keys(base: DataFrame, gone: DataFrame, keys: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """``base`` without the rows whose key is in ``gone``."""
    may = key_filter(base, gone, keys, bits)
    return base.where(~may).unionByName(base.where(may).join(gone.select(*keys), keys, "left_anti").select(base.columns))


def overlay(base: DataFrame, changed: DataFrame, keys: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """``base`` with the rows of ``changed`` in place of those with the same key."""
    new = changed.select(*keys, F.struct(*base.columns).alias("_new"))
    hit = F.col("_new").isNotNull()
    return laid_over(base, new, keys, lambda rows: rows.select(
        *[F.when(hit, F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name) for name in base.columns]), bits)
