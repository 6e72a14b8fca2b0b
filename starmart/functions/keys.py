"""Surrogate and snapshot keys (X-1, X-2, SCD-2).

All of them are ``md5`` over the text form of the natural key, computed
JVM-side so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.columns import as_col

# Separator between the parts of a composite key. The reference concatenates
# without one, which collides as soon as the parts are not fixed-width
# (e.g. "1" || "23" == "12" || "3"); we keep a separator.
KEY_SEPARATOR = "|"


def text(c) -> Column:
    return as_col(c).cast("string")


def surrogate_key(*cols) -> Column:
    """``md5(cast(k as text))`` for one column; ``md5(a || '|' || b ...)`` for several.

    Like SQL ``||``, a NULL part makes the whole key NULL (``concat``, not
    ``concat_ws``), so a missing part fails the not-null test instead of
    silently producing a key.
    """
    if len(cols) == 1:
        return F.md5(text(cols[0]))
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(text(c))
    return F.md5(F.concat(*parts))


def scd_id(key, updated_at) -> Column:
    """Snapshot row id: ``md5(coalesce(key,'') || '|' || coalesce(updated_at,''))``."""
    return F.md5(F.concat(F.coalesce(text(key), F.lit("")), F.lit("|"),
                          F.coalesce(text(updated_at), F.lit(""))))


def packed(key) -> Column:
    """A key for a shuffle: the 16 bytes of an md5, any other text as it is."""
    digest = F.unhex(as_col(key))
    is_digest = F.lower(F.hex(digest)).eqNullSafe(as_col(key))
    return F.struct(F.when(is_digest, digest).alias("digest"), F.when(~is_digest, as_col(key)).alias("text"))


def unpacked(key) -> Column:
    """The text of a :func:`packed` key."""
    return F.coalesce(F.lower(F.hex(as_col(key)["digest"])), as_col(key)["text"])
