"""Rows whose key may be among wanted ones, picked out before a shuffle.

The wanted keys are marked in ``BITS`` bits by their hash and every task is told the bits, at most 16 MB however many keys there are.  What is
left are all rows with a wanted key and few others (those whose hash meets a mark), so it stands before an exact join or filter and changes no result.
It is a filter, so Spark takes it down to the scan that the key comes from.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27
STRETCH = 1 << 15       # bits of one ``bitmap_construct_agg``


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS)) + 1


def _number(four: Column) -> Column:
    """Four bytes as an unsigned number."""
    return F.conv(F.hex(four), 16, 10).cast("long")


def marks(wanted: DataFrame, key: str) -> DataFrame:
    """One row: the stretches of marked bits in order, each as words of eight bytes, null where none is marked.  Each key is sent once, as a number,
    to its stretch."""
    at = wanted.filter(F.col(key).isNotNull()).select(_place(F.col(key)).alias("__at"))
    some = (at.select(F.bitmap_bucket_number("__at").alias("__stretch"), F.bitmap_bit_position("__at").alias("__bit")).repartition("__stretch")
            .groupBy("__stretch").agg(F.bitmap_construct_agg("__bit").alias("__bits")))
    four = lambda i: _number(F.substring(F.col("__bits"), i, F.lit(4)))     # noqa: E731
    words = F.transform(F.sequence(F.lit(0), F.lit(STRETCH // 64 - 1)), lambda i: F.shiftleft(four(i * 8 + 1), 32).bitwiseOR(four(i * 8 + 5)))
    every = wanted.sparkSession.range(1, BITS // STRETCH + 1).withColumnRenamed("id", "__stretch").join(some.select("__stretch", words.alias("__words")),
                                                                                                        "__stretch", "left")
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("__stretch", "__words"))), lambda s: s["__words"]).alias("__words"))


def narrowed(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str, marked: DataFrame | None = None) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``wanted``'s ``wanted_key`` (a null key never is); keys of different types stay as they are.
    ``marked``: the ``marks`` of the wanted keys, if they are kept for several narrowings."""
    if rows.schema[key].dataType != wanted.schema[wanted_key].dataType:
        return rows
    at = _place(F.col(key))
    bit = F.bitmap_bit_position(at).cast("int")
    words = F.element_at((marks(wanted, wanted_key) if marked is None else marked).scalar(), F.bitmap_bucket_number(at).cast("int"))
    byte = F.shiftright(bit, 3)         # a word's first byte is its highest
    place = (F.lit(7) - byte % 8) * 8 + bit % 8
    return rows.filter(F.col(key).isNotNull() & (F.getbit(F.element_at(words, F.shiftright(bit, 6) + 1), place) == 1))
