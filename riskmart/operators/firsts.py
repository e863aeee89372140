"""First row per key without a shuffle of all wide rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 1 << 16  # of 64 bits each: half a megabyte, whatever the number of keys
_HIT, _PLACE = "_may_repeat", "_place"


def by_window(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key; every row is shuffled but for those that a task sees to be later (a window group limit).

    The plan for few columns: Catalyst prunes the rows to what is asked of the result.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(_PLACE, first).where(f"{_PLACE} = 1").drop(_PLACE)


def may_repeat(rows: DataFrame, keys: list[str]) -> Column:
    """True for every row whose key occurs more than once in `rows`, and for few others.

    Hashes of repeated keys set bits of a sieve of fixed size, which comes to all tasks as a scalar subquery. Only the
    keys are read and shuffled, as eight bytes each. A hash shared by chance lets a row through.
    """
    repeated = rows.select(F.xxhash64(*keys).alias("hash")).groupBy("hash").agg(F.count("*").alias("rows")).where("rows > 1")
    bits = repeated.selectExpr(f"pmod(hash, {64 * WORDS}) div 64 as word", "shiftleft(1L, cast(pmod(hash, 64) as int)) as bits")
    every = rows.sparkSession.range(WORDS).selectExpr("id as word", "0L as bits")
    words = bits.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    sieve = words.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("sieve"))
    own = F.xxhash64(*keys)
    word = F.get(sieve.scalar(), F.shiftright(F.pmod(own, F.lit(64 * WORDS)), 6).cast("int"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(own, F.lit(64)).cast("int"))
    return word.bitwiseAND(mask) != 0


def first_rows(rows: DataFrame, keys: list[str], order: list[Column],
               prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """The first row per key of `prepare(rows)`, for wide rows of which few share their key.

    Rows whose key is alone go to the result as they are; only the others are shuffled, by key. `prepare` makes rows
    from rows one by one, may drop some and keeps `keys`; it runs once on each row. `rows` are read three times, once
    for the keys alone, so they should be a source or a stored table. With many repeated keys the sieve fills and all
    rows are shuffled, as in `by_window`.
    """
    shared = may_repeat(rows, keys)
    alone = prepare(rows.where(~shared))
    return alone.unionByName(by_window(prepare(rows.where(shared)), keys, order))
