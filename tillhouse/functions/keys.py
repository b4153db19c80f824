"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions._util import as_col

# Fixed values of the key format.
NULL_TOKEN = "_null_"
SEPARATOR = "|"


def _escaped(c: Column) -> Column:
    # Backslash, the separator and the underscore are prefixed with a backslash,
    # so no value can imitate the separator or the NULL token.
    return F.regexp_replace(c.cast("string"), r"([\\|_])", r"\\$1")


def surrogate_key(*cols) -> Column:
    """md5 over the parts, NULL parts as ``_null_``, parts joined by ``|``.

    ``concat_ws`` skips NULLs, hence the coalesce first.  128-bit md5 keeps the
    birthday bound far away at 1e9+ rows; it equals DuckDB's ``md5`` so the
    oracle can reproduce every key.
    """
    parts = [F.coalesce(_escaped(as_col(c)), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
