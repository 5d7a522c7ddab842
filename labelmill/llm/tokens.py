"""Words and tokens of texts, counted and hashed on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A token: an unbroken run of letters, digits or underscores, or of other signs that aren't white space.
TOKEN = r"(?U)[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
#: The same for Python's re.
TOKEN_PY = r"\w+|[^\w\s]+"
#: What stands between words: everything but letters and digits.
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"


def n_tokens(text: Column) -> Column:
    """Tokens of a text; 0 for null and blank."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0))


def words(text: Column) -> Column:
    """Lower-case words (runs of letters and digits); empty for null and blank."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-case words, in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))
