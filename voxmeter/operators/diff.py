"""Differences between two copies of a dataset.

Both copies are tagged, cut into one row per field and brought together by one range exchange, so they share its split
points. Within a partition the rows are sorted by key, field, side and value, and two sort aggregates run over them once:
a two-pointer merge that skips repeated values, keeps the state of a single field of a key, and closes it when the next
one begins. The state is of fixed size: on each side the number of distinct values, an order-free digest of them, and the
greatest one. A key whose rows disagree among themselves is so compared as a set, whatever their number.

A key that holds more rows than a partition should would land in one range. Such keys, found by a frequent-items sketch
over the key column alone, and the null key lose their repeated values before the shuffle and are dealt to several ranges
each, by a hash of field and value: equal values stay together, and the digests of the parts add up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import col

#: A key is hot when it holds more than this share of all rows of both copies; its values are dealt to SALTS parts.
HOT_SHARE, SALTS = 0.002, 256
#: Counters of the sketch; every key over 1/SKETCH_ITEMS of the rows is in it.
SKETCH_ITEMS = 4096


def _tagged(df: DataFrame, key: str, fields: Sequence[str], side: int) -> DataFrame:
    """(_key, _side, _f, _v): one row per row and field, values as text."""
    values = F.array(*(F.struct(F.lit(i).cast("short").alias("_f"), col(f).cast("string").alias("_v")) for i, f in enumerate(fields)))
    return df.select(col(key).alias("_key"), F.lit(side).cast("byte").alias("_side"), F.inline(values))


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than share of df's rows; at most 1/share of them, nulls aside.

    One aggregation over the key column; only the sketch's answer, bounded by SKETCH_ITEMS, comes to the driver.
    """
    row = df.agg(F.expr(f"approx_top_k({key}, {min(int(1 / share), SKETCH_ITEMS // 2)}, {SKETCH_ITEMS})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in row["top"] or [] if x["item"] is not None and x["count"] > max(1, share * row["n"])]


def _merged(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The state of each field of a key (or of a part of it): distinct values, their digest and the greatest, by side."""
    order = [*by, "_f", "_side", "_v"]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*order)
    # a greatest text is kept as an object, so these aggregates run over the sorted rows instead of hashing them
    once = placed.groupBy(*order).agg(F.max("_v").alias("_x"))
    state = []
    for side, name in ((0, "l"), (1, "r")):
        own = F.col("_side") == side
        state += [
            F.count_if(own).alias(f"_n{name}"),
            F.coalesce(F.bit_xor(F.when(own, F.xxhash64("_x"))), F.lit(0).cast("long")).alias(f"_h{name}"),
            F.max(F.when(own, F.col("_x"))).alias(f"_x{name}"),
        ]
    return once.groupBy(*by, "_f").agg(*state)


def diff_copies(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str], left_name: str = "left", right_name: str = "right") -> DataFrame:
    """One row per key and finding: (key, finding, left_value, right_value).

    finding is `only_in_<left_name>`, `only_in_<right_name>`, or the name of a field whose values differ. Values are
    compared as text and are equal only as the same sequence of code points; null equals null and nothing else, not the
    empty text. Repeated rows of a key count once. Where the rows of a key disagree within a copy, the field differs
    unless both copies hold the same set of values (by number and 64-bit digest); left_value and right_value are then the
    greatest values. A null key is a key like any other and equals itself. Further columns of either copy are ignored;
    empty copies give only `only_in_` rows.
    """
    both = _tagged(left, key, fields, 0).unionByName(_tagged(right, key, fields, 1))
    hot = hot_keys(left.select(col(key).alias("_key")).unionByName(right.select(col(key).alias("_key"))), "_key")
    dealt = F.col("_key").isNull() | F.col("_key").isin(hot)
    cold = both.where(F.col("_key").isNotNull() & ~F.col("_key").isin(hot))
    # repeated values are dropped before the shuffle, so that a key of one text a billion times over is a few rows
    parts = _merged(both.where(dealt).distinct().withColumn("_salt", F.pmod(F.xxhash64("_f", "_v"), F.lit(SALTS)).cast("short")), ["_key", "_salt"])
    whole = parts.groupBy("_key", "_f").agg(*(
        f(c).alias(c) for name in "lr" for f, c in ((F.sum, f"_n{name}"), (F.bit_xor, f"_h{name}"), (F.max, f"_x{name}"))
    ))
    merged = _merged(cold, ["_key"]).unionByName(whole)
    in_left, in_right, first = F.col("_nl") > 0, F.col("_nr") > 0, F.col("_f") == 0
    same = (F.col("_nl") == F.col("_nr")) & (F.col("_hl") == F.col("_hr")) & F.col("_xl").eqNullSafe(F.col("_xr"))
    names = F.element_at(F.array(*map(F.lit, fields)), F.col("_f").cast("int") + 1)
    finding = F.when(in_left & in_right & ~same, names).when(first & ~in_right, f"only_in_{left_name}").when(first & ~in_left, f"only_in_{right_name}")

    def value(side: str) -> Column:
        return F.when(in_left & in_right, F.col(f"_x{side}"))

    return merged.select(F.col("_key").alias(key), finding.alias("finding"), value("l").alias("left_value"), value("r").alias("right_value")).where("finding IS NOT NULL")
