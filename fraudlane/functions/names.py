"""Names derived from a user name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def database_name(user: str | Column) -> Column:
    """The part before the last ``@``, each run of non-word characters as one underscore."""
    value = F.col(user) if isinstance(user, str) else user
    before_at = F.regexp_extract(value, r"(?s)^(.+)@[^@]*$", 1)
    local_part = F.when(before_at != "", before_at).otherwise(value)
    return F.regexp_replace(local_part, r"(?U)\W+", "_")


def catalog_name(user: str | Column) -> Column:
    """The initials of the first two parts; a name of one part gives one initial."""
    parts = F.split(database_name(user), "_")
    initials = [F.substring(F.get(parts, F.lit(i)), 1, 1) for i in (0, 1)]
    named = F.concat(F.concat_ws("", *initials), F.lit("_catalog"))
    return F.when(parts.isNotNull(), named)
