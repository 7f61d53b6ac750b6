"""The order in which boxes come to turn: by score, then by a hash of the id.

Ties are not broken by the id itself. Ids follow the order of tiles, so neighbours with equal scores would
wait for each other in long chains; by a hash such chains stay short.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIE_DIGITS = 15     # hexadecimal digits of the md5 of the id's text that are compared


def ranked_score(score: Column) -> Column:
    """The score as a double; null and NaN come after every number."""
    value = score.cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(float("-inf"))).otherwise(value)


def at_least(score: Column, threshold: float) -> Column:
    """Whether the score reaches the threshold; null and NaN never do."""
    return ranked_score(score) >= threshold


def tie_of(ident: Column) -> Column:
    return F.conv(F.substring(F.md5(ident.cast("string")), 1, TIE_DIGITS), 16, 10).cast("long")
