"""Exact distinct counts that can be merged (A-6, A-7, A-8).

A count of distinct ids can't be added up over days; the sets behind it can be
united. A state row holds the ids of one group that fall into one bucket of
32,768 neighbouring numbers, in the smaller of two forms:

* ``positions``: the places of the ids in their bucket, 16 bits each, up to
  ``POSITIONS`` of them (as many take the room of a bitmap);
* ``bitmap``: 4,096 bytes, one bit a place, for fuller buckets.

Ids that are spread thinly over a day therefore cost what the ids cost, and ids
given out in order cost one bit. States unite by group and bucket, so a group
that holds most of the rows is spread over its buckets; no group has more than
32,768 places a bucket however often its ids occur. Several counts in one report
need no copy of the rows for each (no Expand): each has its own states.

Ids are whole numbers; NULL ids aren't counted; a group with NULL ids only has no
state. Nothing is estimated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: So many 16-bit positions take as much room as a bitmap.
POSITIONS = 2048
BUCKET = "bucket"


def states(rows: DataFrame, by: list[str], column: str) -> DataFrame:
    """``by``, ``bucket``, ``positions``, ``bitmap``: the distinct ids of each group."""
    if not isinstance(rows.schema[column].dataType, T.IntegralType):
        raise TypeError(f"{column} is {rows.schema[column].dataType.simpleString()}: distinct states need whole numbers")
    wide = F.col(column).cast("long")
    places = (rows.where(F.col(column).isNotNull())
              .select(*by, F.bitmap_bucket_number(wide).alias(BUCKET), F.bitmap_bit_position(wide).cast("short").alias("place"))
              .distinct())  # map-side first: however often an id occurs, it travels once a task
    lists = places.groupBy(*by, BUCKET).agg(F.array_sort(F.collect_list("place")).alias("places"))
    full = F.size("places") > POSITIONS
    # the second grouping is by the same columns and needs no exchange
    return (lists.select(*by, BUCKET, F.when(~full, F.col("places")).alias("positions"),
                         F.explode_outer(F.when(full, F.col("places"))).alias("place"))
            .groupBy(*by, BUCKET)
            .agg(F.first("positions").alias("positions"), F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))
            .select(*by, BUCKET, "positions", F.when(F.col("positions").isNull(), F.col("bits")).alias("bitmap")))


def merged(found: DataFrame, by: list[str], count: str) -> DataFrame:
    """``by`` and the number of distinct ids over all states of a group.

    States travel in their stored form: the exchange comes before they are
    opened, and the two groupings behind it need no other.
    """
    opened = (found.repartition(*by, BUCKET)
              .select(*by, BUCKET, "bitmap", F.explode_outer("positions").alias("place")))
    united = (opened.groupBy(*by, BUCKET)
              .agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("a"), F.bitmap_or_agg("bitmap").alias("b"))
              .select(*by, BUCKET, F.explode(F.array("a", "b")).alias("bits"))
              .groupBy(*by, BUCKET).agg(F.bitmap_or_agg("bits").alias("bits")))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(count))
