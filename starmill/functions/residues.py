"""Exact sums of products of any size, from remainders.

A product of many counts soon has more digits than a decimal. Its remainders by a few primes below
2^31 are longs, however large it is, and sums of remainders are remainders of sums; from them
the whole number follows at the end, in few rows, by the Chinese remainder theorem.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from math import prod

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Enough for a sum over 2^63 rows of seven counts below 2^63 and a measure below 2^52.
BITS = 7 * 63 + 63 + 52 + 1


@lru_cache(maxsize=1)
def primes() -> tuple[int, ...]:
    """The largest primes below 2^31 whose product has more than ``BITS`` bits."""
    small = [n for n in range(2, 46342) if all(n % d for d in range(2, int(n ** 0.5) + 1))]
    found, n = [], 2 ** 31
    while prod(found).bit_length() <= BITS:
        n -= 1
        if all(n % d for d in small):
            found.append(n)
    return tuple(found)


def with_product(df: DataFrame, factors: Sequence[Column], name: str) -> DataFrame:
    """Add the remainders of a product of whole numbers, as columns ``name`` and a number.

    A factor at a time, so that no expression is longer than one multiplication.
    """
    columns = [f"{name}{i}" for i in range(len(primes()))]
    df = df.withColumns(dict.fromkeys(columns, F.lit(1).cast("long")))
    for factor in factors:  # remainders are below 2^31
        df = df.withColumns({c: F.col(c) * F.pmod(factor.cast("long"), F.lit(p)) % p for c, p in zip(columns, primes())})
    return df


def remainder_sums(name: str, factor: Column) -> Column:
    """An aggregate: remainders of the sum over rows of the product ``name`` times one more number."""
    return F.array(*[
        F.pmod(F.sum((F.col(f"{name}{i}") * F.pmod(factor.cast("long"), F.lit(p)) % p).cast("decimal(19,0)")), F.lit(p)).cast("long")
        for i, p in enumerate(primes())])


def _whole(remainders: Sequence[int]) -> int:
    modulus = prod(primes())
    total = sum(r * (modulus // p) * pow(modulus // p, -1, p) for r, p in zip(remainders, primes())) % modulus
    return total if total <= modulus // 2 else total - modulus


def with_whole_numbers(df: DataFrame, columns: Sequence[str], places: int = 0) -> DataFrame:
    """Columns of remainders as the numbers they stand for, in text, with ``places`` decimal places."""

    def text(remainders: list[int] | None) -> str | None:
        if remainders is None:
            return None
        value = _whole(remainders)
        digits = str(abs(value)).rjust(places + 1, "0")
        return "-" * (value < 0) + (f"{digits[:-places]}.{digits[-places:]}" if places else digits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [pa.array(map(text, a.to_pylist()), pa.string()) if n in columns else a
                      for n, a in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    fields = [T.StructField(f.name, T.StringType()) if f.name in columns else f for f in df.schema]
    return df.mapInArrow(run, T.StructType(fields))
