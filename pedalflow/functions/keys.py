"""Station key normalisation.

The station list keys stations with text such as ``2``, ``001 a``,
``020 ampliacion`` or ``140 ampliación`` while trips carry integers.  Comparing
the two directly either fails (ANSI cast error) or silently loses every
suffixed station.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def station_number(key: Column) -> Column:
    """Leading number of a station key: ``'001 a'`` -> 1, ``'020 ampliacion'`` -> 20.

    Returns NULL for text without a leading number instead of failing.
    """
    digits = F.regexp_extract(F.trim(key.cast("string")), r"^0*([0-9]+)", 1)
    return F.when(digits != "", digits).try_cast("long")


def exact_station_number(key: Column) -> Column:
    """Whole key as a number, NULL for suffixed keys: reproduces the as-coded loss."""
    return F.trim(key.cast("string")).try_cast("long")
