"""Text cleaning used by the staging models (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions._util import as_col

# A zero-width split point after every character that is not a letter or a
# digit: each piece then starts at a word boundary of the warehouse's
# title-case rule ("e-wallet" -> "E-Wallet", "o'neil" -> "O'Neil").
_WORD_START = r"(?<=[^\p{L}\p{N}])"


def strip(c) -> Column:
    """``trim``: removes spaces only, on both sides (tabs are kept)."""
    return F.trim(as_col(c))


def norm(c) -> Column:
    """``lower(trim(x))`` normalisation for codes and e-mail."""
    return F.lower(F.trim(as_col(c)))


def initcap_alnum(c) -> Column:
    """Title case where a word starts after any non-alphanumeric character.

    Spark's ``initcap`` only splits on whitespace; this splits with a
    look-behind and upper-cases the first character of every piece.  NULL in,
    NULL out; no Python runs per row.
    """
    pieces = F.split(F.lower(as_col(c)), _WORD_START)
    return F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                               F.substr(w, F.lit(2)))),
        "")


def clean_title(c) -> Column:
    """``initCap(trim(x))``."""
    return initcap_alnum(F.trim(as_col(c)))
