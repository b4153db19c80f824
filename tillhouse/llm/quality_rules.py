"""Operator 4: quality rules.

A table of thresholds is compiled into one Spark projection: word and line
counts, symbol, stop-word and line ratios are built-in expressions of the text
column; no user function runs and nothing is shuffled, so the operator costs
one scan at any size and a hot source or long text moves no data.

Defined results: null and empty texts have no words (``n_words`` 0, all counts
0) and fail; repeated rows each get their own row; other columns of the input
are passed through under any name, those of the helper columns included, unless
they clash with an output column, where the output column replaces them; an empty
table gives an empty one; very long texts are measured whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import SPACES, WORD_GAP, at, numbered

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that was for it with as on be at by this are from or an not a "
    "le la les de des du et un une en que qui dans est pour pas par avec au "
    "der die das und ist von mit den ein eine zu nicht auf im des dem auch "
    "el los las y que en un una por con del se para su es al"
).split()
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie in [low, high]; ``from_words``: only judged in texts
    of at least so many words (ratios of a few words say nothing)."""
    metric: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: The threshold table.
RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", high=0.25),
    Rule("shouting_lines", high=0.5, from_words=10),
    Rule("stop_words_per_word", low=0.02, from_words=30),
    Rule("dup_lines_per_line", high=0.3, from_words=30),
    Rule("distinct_words_per_root", low=1.0, from_words=30),
    Rule("ellipsis_lines_per_line", high=0.3),
    Rule("bullet_lines_per_line", high=0.9),
)


def _measures(text: Column) -> list[tuple[str, Column]]:
    """First projection: arrays that several metrics share."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, WORD_GAP), lambda w: w != "")
    return [("_t", t), ("_words", words),
            ("_lines", F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != ""))]


def _repeat_words() -> Column:
    """Words in 5-word windows found twice or more, from ``_win`` (a hash of
    each window).  Texts without a repeated window (a hash-set test) end there;
    else equal windows become neighbours by sorting (hash, place), and the
    places of the repeated ones, in order, cover min(5, gap) words each."""
    n = F.size("_win")
    pairs = F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.sort_array(F.transform(
        F.filter(F.transform("_pairs", lambda p, k: F.struct(
            p["i"].alias("i"),
            (((k > 0) & (F.get("_pairs", F.greatest(k - 1, F.lit(0)))["h"] == p["h"]))
             | ((k < n - 1) & (F.get("_pairs", k + 1)["h"] == p["h"]))).alias("r"))),
            lambda s: F.coalesce(s["r"], F.lit(False))),
        lambda s: s["i"]))
    return pairs, places


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base counts and every metric of the table."""
    out = df.select("*", *[c.alias(k) for k, c in _measures(F.col(text))])
    out = out.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    out = out.withColumn("_win", F.when(F.size("_h") >= 5, F.transform(
        F.sequence(F.lit(0), F.size("_h") - 5),
        lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(5)]))).otherwise(F.array().cast("array<bigint>")))
    pairs, places = _repeat_words()
    out = out.withColumn("_pairs", F.when(F.size(F.array_distinct("_win")) < F.size("_win"), pairs))
    out = out.withColumn("_places", F.when(F.col("_pairs").isNotNull(), places))
    covered = F.aggregate("_places", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
                          lambda acc, i: F.struct((i + 5).alias("end"),
                                                  (acc["n"] + i + 5 - F.greatest(acc["end"], i)).alias("n")),
                          lambda acc: acc["n"])
    size = lambda c: F.size(c).cast("long")
    chars = lambda c: F.length(c).cast("long")
    out = out.withColumns({
        "n_words": size("_words"),
        "word_chars": chars(F.translate("_t", SPACES, "")),
        "n_symbols": chars("_t") - chars(F.translate("_t", SYMBOLS, "")),
        "n_lines": size("_lines"),
        "n_dup_lines": size("_lines") - size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covered.cast("long"), F.lit(0).cast("long")),
        "_stop": F.regexp_count(F.lower("_t"), F.lit(r"(?<![^\x20\x09-\x0D])(?:" + "|".join(dict.fromkeys(STOP_WORDS)) + r")(?![^\x20\x09-\x0D,.;:!?])")),
        "_distinct": F.size(F.array_distinct("_h")),
        "_shout": F.size(F.filter("_lines", lambda x: (x == F.upper(x)) & (x != F.lower(x)) & (F.length(x) >= 10))),
        "_dots": F.size(F.filter("_lines", lambda x: x.endswith("...") | x.endswith("…"))),
        "_bullets": F.size(F.filter("_lines", lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•"))),
    })
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return out.withColumns({
        "mean_word_chars": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "stop_words_per_word": per("_stop", "n_words"),
        "dup_lines_per_line": per("n_dup_lines", "n_lines"),
        "shouting_lines": per("_shout", "n_lines"),
        "ellipsis_lines_per_line": per("_dots", "n_lines"),
        "bullet_lines_per_line": per("_bullets", "n_lines"),
        # distinct words grow at least like a root of the length in running text
        "distinct_words_per_root": F.when(F.col("n_words") > 0, F.col("_distinct") / F.pow(F.col("n_words"), 0.4)).otherwise(F.lit(0.0)),
    })


def verdict(rules=RULES) -> Column:
    """The threshold table as one boolean expression."""
    ok = F.lit(True)
    for r in rules:
        x, one = F.col(r.metric), F.lit(True)
        if r.low is not None:
            one = one & (x >= r.low)
        if r.high is not None:
            one = one & (x <= r.high)
        ok = ok & ((F.col("n_words") < r.from_words) | one)
    return ok


METRICS = ("mean_word_chars", "symbols_per_word", "stop_words_per_word", "dup_lines_per_line",
           "shouting_lines", "ellipsis_lines_per_line", "bullet_lines_per_line", "distinct_words_per_root")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``df`` plus base counts, ``n_lines``, metrics, ``base_failed`` and ``kept``."""
    own = (*BASE, "n_lines", *METRICS, "base_failed", "kept")
    out = measured(numbered(df), at(df, text))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules)).select(
        *[F.col(at(df, c)).alias(c) for c in df.columns if c not in own], *own)
