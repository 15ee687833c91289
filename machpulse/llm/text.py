"""Column helpers shared by the text operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def whole(text) -> Column:
    """The text; empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text) -> Column:
    """Runs of ``[^\\x20\\x09-\\x0D]``, in order; none for a null text."""
    return F.array_remove(F.split(whole(text), SPACES, -1), "")


def ascii_lower(text) -> Column:
    """A-Z become a-z; every other character stays, unlike ``lower``."""
    return F.translate(whole(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def low_half(number) -> Column:
    """The lower 32 bits of a long, as a long that sums without overflow."""
    return number.bitwiseAND(F.lit(0xFFFFFFFF))


def high_half(number) -> Column:
    return F.shiftrightunsigned(number, 32)
