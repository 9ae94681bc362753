"""License names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftloom.constants import LICENSE_ALIASES
from siftloom.functions.text import lookup, lower_strip


def normalize_license(c: Column) -> Column:
    name = lower_strip(c)
    return F.coalesce(lookup(name, LICENSE_ALIASES), name)
