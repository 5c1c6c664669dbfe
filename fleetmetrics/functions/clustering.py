"""A curve through machine and time, along which neighbours in both stay close.

The bits of a machine's bucket and of the time of day are taken in turn (Morton
order). A stretch of the curve is then a box of some machines and some hours.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Machines hash to 2 ** BITS buckets, and a day has as many steps.
BITS = 16
DAY_SECONDS = 86_400


def bucket(machine: Column) -> Column:
    return F.pmod(F.xxhash64(machine), F.lit(1 << BITS)).cast("int")


def _spread(bits: Column) -> Column:
    """The lowest 16 bits moved to the even places."""
    found = bits.cast("long")
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        found = F.shiftleft(found, shift).bitwiseOR(found).bitwiseAND(F.lit(mask).cast("long"))
    return found


def curve(machine: Column, moment: Column) -> Column:
    """The place of a reading on the curve of its day."""
    seconds = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    step = F.floor(seconds.cast("long") * (1 << BITS) / DAY_SECONDS)
    return F.shiftleft(_spread(bucket(machine)), 1).bitwiseOR(_spread(step))
