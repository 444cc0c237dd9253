"""Numbers out of text that may hold anything."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(text: Column, kind: str) -> Column:
    """``text`` as an integer type, null where it is none or does not fit.

    A failed ``try_cast`` raises and catches an error inside the task; looking
    first keeps a dirty feed as fast as a clean one.
    """
    text = F.trim(text)
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text).try_cast(kind)
