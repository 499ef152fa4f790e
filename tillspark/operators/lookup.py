"""Left joins from a large table to a table unique on its key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark.functions.rows import literal_rows
from tillspark.operators.bitmap import WORD, words_of
from tillspark.sources.staging import stage, stage_counted, written_rows

# A lookup table of up to this many narrow rows is sent to every executor.
BROADCAST_ROWS = 200_000
# A key is hot when it holds more than one row in this many, so that at most
# this many keys can be hot, whatever the data.
HOT_SLOTS = 2_000
# Constant rows, such as unknown members, that a written table may be extended by.
CONSTANTS = 8
# Rows that need no partner from the shuffled side are dealt over this many.
SPREAD = 1 << 20
# The most bits of a packed table (16 MB), and the most different rows it may hold.
PACKED_BITS = 1 << 27
PACKED_ROWS = 4_095


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_by: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
    hot_slots: int = HOT_SLOTS,
    measured_on: DataFrame | None = None,
    at_most: int | None = None,
    hot_keys: Sequence | None = None,
) -> DataFrame:
    """All rows of `left` with the columns `right` holds for their key, or nulls.

    `right` holds each key once. A small one is broadcast: one the caller knows
    to have `at_most` so many rows, or one found to be small when it is staged
    and counted. For a large one the hot keys of `left` are found first; the few
    rows of `right` they need are broadcast, and only the remaining rows are
    matched by a shuffle. Rows already matched, and rows without a key, are
    dealt out by `spread_by` (columns that differ between rows), so no key
    gathers in a task. `measured_on` names a cheaper frame with the same keys on
    the same rows, for a `left` that would be computed again to count its keys;
    `hot_keys` are its hot keys, if they are known.
    """
    if at_most is None or (at_most > broadcast_rows and hot_keys is None):
        right, at_most = stage_counted(right, "lookup")
    if at_most <= broadcast_rows:
        return left.join(F.broadcast(right), on, "left")

    extra = [c for c in right.columns if c != on]
    if hot_keys is None:
        rows = left if measured_on is None else measured_on
        limit = rows.count() / hot_slots
        busy = rows.groupBy(on).count().where(F.col("count") > limit).select(on)
    else:
        kind = T.StructType([T.StructField(on, left.schema[on].dataType)])
        busy = left.sparkSession.createDataFrame([(key,) for key in hot_keys], kind)
    # At most `hot_slots` keys can each hold more than 1/hot_slots of the rows.
    hot = stage(right.join(F.broadcast(busy), on, "left_semi"), "hot")
    settled = left.join(
        F.broadcast(hot.select(on, F.struct(*extra).alias("_hot"))), on, "left"
    )
    done = F.col("_hot").isNotNull() | F.col(on).isNull()
    dealt = settled.withColumn(
        "_deal", F.when(done, 1 + F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD))).otherwise(0)
    )
    rest = right.select(
        on, F.lit(0).cast("long").alias("_deal"), F.struct(*extra).alias("_rest")
    )
    found: list[Column] = [
        F.coalesce(F.col("_hot")[c], F.col("_rest")[c]).alias(c) for c in extra
    ]
    return dealt.join(rest, [on, "_deal"], "left").select(*left.columns, *found)


def rows_at_most(right: DataFrame) -> int | None:
    """Rows of a lookup table that is a projection or a part of one staged table, with constant
    rows at most; None if it reads anything else. Not for tables that explode what they read."""
    rows = written_rows(right)
    return None if rows is None else rows + CONSTANTS


def hot_values(rows: DataFrame, columns: Sequence[str], hot_slots: int = HOT_SLOTS) -> dict[str, list]:
    """The values of each column that may hold more than one row in `hot_slots`, in one scan.

    A mergeable sketch of the most frequent values, `hot_slots` at most of each column; which
    ones are named decides how rows are dealt, not what comes out.
    """
    tracked = 8 * hot_slots
    sketches = [
        F.expr(f"approx_top_k(`{c}`, {hot_slots}, {tracked})").alias(c) for c in columns
    ]
    found = rows.agg(F.count(F.lit(1)).alias("_rows"), *sketches).first()
    limit = found["_rows"] / hot_slots
    return {
        c: [x["item"] for x in found[c] or [] if x["item"] is not None and x["count"] > limit]
        for c in columns
    }


def lookup_all(
    left: DataFrame,
    sides: Sequence[tuple[DataFrame, str]],
    spread_by: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
    hot_slots: int = HOT_SLOTS,
) -> DataFrame:
    """`lookup` in several tables (right, key), each a part of a written one, one after the other.

    The hot keys of all of them are found in one scan of `left`, which must be written too,
    and only if some table is too large to be sent and is no numbering of whole numbers in
    their order, which goes as a bitmap. Tables that are sent come first: keys nobody reads
    afterwards then take no part in the shuffles for the others. Columns do not come in the
    order of `sides`.
    """
    sized = [(right, on, rows_at_most(right)) for right, on in sides]
    is_large = lambda rows: rows is None or rows > broadcast_rows
    ordered = {on: ranked(right, on) for right, on, rows in sized if is_large(rows)}
    shuffled = [on for on, numbers in ordered.items() if numbers is None]
    hot = hot_values(left, shuffled, hot_slots) if shuffled else {}
    out = left
    for right, on, rows in sorted(sized, key=lambda side: side[1] in shuffled):
        if ordered.get(on) is not None:
            out = numbered(out, ordered[on], on)
        else:
            out = lookup(
                out, right, on, spread_by, broadcast_rows, hot_slots, left, rows, hot.get(on)
            )
    return out


@dataclass(frozen=True)
class Packed:
    """A lookup table by dense whole-number key: a code of `bits` bits a key, in `words` from
    the key `low` to `high`, and the different rows by code. Code 0: no such key."""

    words: Column
    low: int
    high: int
    bits: int
    rows: DataFrame


def packed(right: DataFrame, on: str, most_bits: int = PACKED_BITS) -> Packed | None:
    """`right`, unique on the long `on`, in one value of at most 16 MB; None if it does not fit.

    Made for attributes of dimensions: few different rows, keys numbered without gaps. None also
    if a key comes twice, has another type, or there are more than PACKED_ROWS different rows.
    """
    if right.schema[on].dataType != T.LongType():
        return None
    extra = [c for c in right.columns if c != on]
    if any(isinstance(right.schema[c].dataType, T.MapType) for c in extra):
        return None
    ends = right.agg(F.min(on).alias("low"), F.max(on).alias("high")).first()
    if ends["low"] is None or ends["high"] - ends["low"] >= most_bits:
        return None
    distinct = right.where(F.col(on).isNotNull()).select(*extra).distinct()
    found = distinct.limit(PACKED_ROWS + 1).collect()
    bits = next((b for b in (1, 2, 4, 8, 16) if len(found) < 1 << b))
    span = ends["high"] - ends["low"] + 1
    if len(found) > PACKED_ROWS or span * bits > most_bits:
        return None
    kind = T.StructType([T.StructField("_code", T.LongType()), *distinct.schema.fields])
    numbered = [(at, *row) for at, row in enumerate(found, start=1)]
    codes = literal_rows(right.sparkSession, numbered, kind)
    renamed = codes.withColumnsRenamed({c: f"_c_{c}" for c in extra})
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in extra], F.lit(True)
    )
    coded = right.where(F.col(on).isNotNull()).join(F.broadcast(renamed), same)
    held = WORD // bits
    place = F.col(on) - ends["low"]
    shift = F.pmod(place, F.lit(held)).cast("int")
    put = lambda value, by: F.call_function("shiftleft", value, by)
    words = stage(
        coded.groupBy(F.floor(place / held).alias("word")).agg(
            F.bit_or(put(F.col("_code"), shift * bits)).alias("bits"),
            (F.bit_count(F.bit_or(put(F.lit(1).cast("long"), shift))) == F.count(F.lit(1))).alias("once"),
        ),
        "packed",
    )
    if words.where(~F.col("once")).limit(1).count():
        return None
    return Packed(words_of(words, span // held + 1), ends["low"], ends["high"], bits, codes)


def unpacked(left: DataFrame, pack: Packed, on: str) -> DataFrame:
    """All rows of `left` with the columns the packed table holds for their key, or nulls.

    Nothing is shuffled, and no key is hot."""
    held = WORD // pack.bits
    place = F.col(on).cast("long") - pack.low
    word = F.get(pack.words, F.floor(place / held).cast("int"))
    shift = (F.pmod(place, F.lit(held)) * pack.bits).cast("int")
    code = F.call_function("shiftrightunsigned", word, shift).bitwiseAND(
        F.lit((1 << pack.bits) - 1).cast("long")
    )
    inside = F.col(on).between(pack.low, pack.high)
    coded = left.withColumn("_code", F.when(inside, code))
    return coded.join(F.broadcast(pack.rows), "_code", "left").drop("_code")


def join_attributes(
    left: DataFrame, right: DataFrame, on: str, key: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The inner join of `left` and `right` where `on` equals `key`, without `key`.

    Both may repeat or miss keys. Few rows are sent; attributes of more go packed, if they can, and
    `left` is neither shuffled for them nor loses its order.
    """
    if right.count() <= broadcast_rows:
        right = F.broadcast(right)
    elif isinstance(left.schema[on].dataType, T.IntegralType):
        pack = packed(right.withColumn("_held", F.lit(True)), key)
        if pack is not None:
            return unpacked(left, pack, on).where("_held").drop("_held")
    return left.join(right, F.col(on) == F.col(key)).drop(key)


@dataclass(frozen=True)
class Ranked:
    """Numbers given to whole-number keys in their order: a bit a key in `words`, from the key
    `low` to `high`, and in `before` the number before the first one of each word."""

    name: str
    words: Column
    before: Column
    low: int
    high: int


def ranked(right: DataFrame, on: str, most_bits: int = PACKED_BITS // 2) -> Ranked | None:
    """`right` (`on` and a number) in two values of at most 8 MB each; None if it does not fit.

    Made for the surrogate keys of natural keys that are whole numbers. None also unless both
    columns are longs, and if a key comes twice or numbers skip one or leave the order of the
    keys within a word of 64.
    """
    if right.columns[:1] != [on] or [f.dataType for f in right.schema] != [T.LongType()] * 2:
        return None
    name = right.columns[1]
    right = right.where(F.col(on).isNotNull())
    ends = right.agg(F.min(on).alias("low"), F.max(on).alias("high")).first()
    if ends["low"] is None or ends["high"] - ends["low"] >= most_bits:
        return None
    place = F.col(on) - ends["low"]
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(WORD)).cast("int")
    )
    words = stage(
        right.groupBy(F.floor(place / WORD).alias("word")).agg(
            F.bit_or(bit).alias("bits"), (F.min(name) - 1).alias("before"),
            (F.bit_count(F.bit_or(bit)) == F.count(F.lit(1))).alias("once"),
        ),
        "ranked",
    )
    if words.where(~F.col("once")).limit(1).count():
        return None
    count = (ends["high"] - ends["low"]) // WORD + 1
    starts = words.select("word", F.col("before").alias("bits"))
    found = Ranked(name, words_of(words, count), words_of(starts, count), ends["low"], ends["high"])
    told = numbered(right.select(on, F.col(name).alias("_told")), found, on)
    if told.where(~F.col("_told").eqNullSafe(F.col(name))).limit(1).count():
        return None
    return found


def numbered(left: DataFrame, numbers: Ranked, on: str) -> DataFrame:
    """All rows of `left` with the number of their key, or null. Nothing is shuffled."""
    inside = F.col(on).cast("long").between(numbers.low, numbers.high)
    place = F.when(inside, F.col(on).cast("long")) - numbers.low
    at = F.floor(place / WORD).cast("int")
    shift = F.pmod(place, F.lit(WORD)).cast("int")
    word = F.get(numbers.words, at)
    up_to = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), WORD - 1 - shift)
    number = F.get(numbers.before, at) + F.bit_count(word.bitwiseAND(up_to))
    return left.withColumn(numbers.name, F.when(F.bit_get(word, shift) == 1, number))


def lookup_attributes(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_by: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
    measured_on: DataFrame | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """`lookup` of attributes by surrogate key: too many rows to be sent go packed, if they can."""
    if at_most is None or at_most > broadcast_rows:
        pack = packed(right, on)
        if pack is not None:
            return unpacked(left, pack, on)
    return lookup(
        left, right, on, spread_by, broadcast_rows, measured_on=measured_on, at_most=at_most
    )
