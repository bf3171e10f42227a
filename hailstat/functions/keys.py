"""Row keys as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the stored key format.
REGIONS = 8
REGION_DIGITS = 4
DIGEST_DIGITS = 12
MIN_MD5_PREFIX = 8
MAX_MD5_PREFIX = 32
WORD = 2**32 - 1


def _folded(text: Column, chars: Column) -> Column:
    """The hash of a text from its characters; only texts beyond ASCII are tested for surrogates."""
    def unit(acc: Column, char: Column) -> Column:
        return (acc * 31 + F.ascii(char)).bitwiseAND(F.lit(WORD))

    def step(acc: Column, char: Column) -> Column:
        point = F.ascii(char)
        high = F.lit(0xD800) + F.shiftright(point - 0x10000, 10)
        low = F.lit(0xDC00) + (point - 0x10000) % 1024
        pair = (acc * 31 + high).bitwiseAND(F.lit(WORD)) * 31 + low
        return F.when(point < 0x10000, acc * 31 + point).otherwise(pair).bitwiseAND(F.lit(WORD))

    start = F.lit(0).cast("bigint")
    return F.when(F.octet_length(text) == F.char_length(text), F.aggregate(chars, start, unit)).otherwise(F.aggregate(chars, start, step))


def string_hash(text: Column) -> Column:
    """The JVM string hash, as an unsigned 32-bit number.

    A polynomial in 31 over UTF-16 units: a character beyond the basic plane counts as its two surrogates.
    """
    return _folded(text, F.split(text, ""))


def with_hash(df: DataFrame, text: Column, *columns: Callable[[Column, Column], Column]) -> DataFrame:
    """``df`` and columns made from a text and its hash.

    The text, its characters and the hash are columns on the way, so that each is made once a row however
    often it is used.
    """
    own = ("__text", "__chars", "__hash")
    made = df.withColumn(own[0], text).withColumn(own[1], F.split(own[0], ""))
    made = made.withColumn(own[2], _folded(F.col(own[0]), F.col(own[1])))
    return made.select(*(c for c in made.columns if c not in own), *(build(F.col(own[0]), F.col(own[2])) for build in columns))


def region_of(number: Column, regions: int = REGIONS) -> Column:
    """The region of a hash: sign bit cleared, modulo the region count."""
    return (number.bitwiseAND(F.lit(0x7FFFFFFF)) % regions).cast("int")


def with_salted_key(df: DataFrame, text: Column, name: str, regions: int = REGIONS) -> DataFrame:
    """``df`` with ``salted_key`` of a text that is made once."""
    return with_hash(df, text, lambda t, h: _salted(t, region_of(h, regions)).alias(name))


def _salted(text: Column, region_: Column) -> Column:
    return F.concat(F.lpad(region_.cast("string"), REGION_DIGITS, "0"), F.substring(F.md5(text), 1, DIGEST_DIGITS))


def region(text: Column, regions: int = REGIONS) -> Column:
    """The pre-split region of a key."""
    return region_of(string_hash(text), regions)


def salted_key(text: Column, regions: int = REGIONS) -> Column:
    """Region number with leading zeros, then the first hex digits of the MD5."""
    return _salted(text, region(text, regions))


def prefix_of(number: Column) -> Column:
    """The 15 bits of a hash that are put before a hash-prefixed key."""
    return number.bitwiseAND(F.lit(0x7FFF)).cast("int")


def hash_prefix(text: Column) -> Column:
    """The 15-bit number put before a hash-prefixed key."""
    return prefix_of(string_hash(text))


def prefixed(text: Column, prefix: Column) -> Column:
    """Two big-endian bytes of a prefix, then the text, as binary."""
    return F.concat(F.unhex(F.lpad(F.hex(prefix), 4, "0")), F.encode(text, "UTF-8"))


def hash_prefixed_key(*columns: Column) -> Column:
    """Two big-endian bytes of ``hash_prefix``, then the joined columns, as binary."""
    text = plain_key(*columns)
    return prefixed(text, hash_prefix(text))


def md5_prefixed_key(separator: str, length: int, *columns: Column) -> Column:
    """At least 8 and at most 32 hex digits of the MD5 of the joined columns, then the columns."""
    text = F.concat_ws(separator, *columns)
    digits = min(max(length, MIN_MD5_PREFIX), MAX_MD5_PREFIX)
    return F.concat_ws(separator, F.substring(F.md5(text), 1, digits), text)


def plain_key(*columns: Column) -> Column:
    return F.concat(*[c.cast("string") for c in columns])


def business_key(id_: Column, time_text: Column) -> Column:
    """``id_yyyyMMddHHmmss`` from a ``yyyy-MM-dd HH:mm:ss`` text; null without a clock part."""
    day, clock = (F.split_part(time_text, F.lit(" "), F.lit(i)) for i in (1, 2))
    stamp = F.concat(F.replace(day, F.lit("-"), F.lit("")), F.replace(clock, F.lit(":"), F.lit("")))
    return F.when(F.contains(time_text, F.lit(" ")), F.concat(id_, F.lit("_"), stamp))


def timed_key(id_: Column, time: Column) -> Column:
    """``business_key`` of a timestamp column."""
    return F.concat(id_, F.lit("_"), F.date_format(time, "yyyyMMddHHmmss"))
