"""Words of a text, as all operators here read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that separate words; bytes.split() separates at the same six.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: A-Z to a-z; bytes.lower() does the same, str.lower() does more.
ASCII_LOWER = {upper: upper + 32 for upper in range(65, 91)}


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; null has none."""
    return text.encode().split() if text else []


def word_count(text: Column) -> Column:
    """How many words a text has; null has none."""

    @F.pandas_udf("long")
    def count(texts):
        return texts.map(lambda t: len(words(t)))

    return count(text)
