"""Operator 7: line dedup by a deletion-neighbourhood join [native].

Two lines are near duplicates when the word sequences differ by at most one
edit: a word inserted, deleted or replaced.  A line goes when an earlier line
of the corpus, by (doc_id, line number), is equal or near; the earliest stays.

1. Lines become (hash, first place) by a partially aggregated minimum, so
   equal lines, however many, meet as one row.
2. Lines at one edit agree in the words before and after it.  Only distinct
   lines that share all but one of two parts, then of four, with another
   distinct line go on (``_parts``: exact, not a heuristic).
3. Those emit their deletion variants, the line itself and the line without
   each word, as hashed keys (running exclusive ors, so a line costs its
   length); variants that another line has are joined through the key's
   earliest line, and, where a key has several lines, through every pair of
   lines in different positions of the order only as far as needed (below).
4. The edit distance is verified on the words themselves.

A key's lines are all at most two edits apart.  Verified pairs of a key:
every line against the earliest line that emitted the key with the same
deleted position or whole (lines equal after deleting the same position are
one replacement apart, and a whole line and a variant are one insertion
apart), so a hot key costs one pair per line, not all pairs, and still finds
an earlier near line whenever there is one.

Equal lines go from ``exact_words`` words on; the queries take every line that
has a word.  Blank lines stay, as the layout of the rest.  Near lines need
``min_words`` words in the longer of the two: with five, four in five words or
more agree, as at the 80 % of the other operators, while one word in four or
fewer changes what a line says.  A line of ``min_words`` - 1 words is thus near
only to one of a word more, and emits no variant but itself.  Everything runs
as DataFrame functions.

Defined results: null texts stay null, empty ones empty; a text whose every
line with a word goes keeps its blank lines; rows of equal or null doc_id are ordered by their text as well, and equal rows count once, the first
occurrence inside keeping the line in each of them; an empty table stays empty;
a very long text or line is split whole; other columns are passed through under
any name, but those named n_lines, n_exact or n_near, which the counts replace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import at, let, numbered, running, store


def _plain(text):
    """The lines of ``text`` with one space between their words and none around them: equal for equal words."""
    odd = text.startswith(" ") | text.endswith(" ")
    for gap in ("  ", " \n", "\n ", "\t", "\x0b", "\x0c", "\r"):
        odd |= text.contains(gap)
    spaced = F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")
    return F.split(F.when(odd, F.trim(F.regexp_replace(spaced, " ?\n ?", "\n"))).otherwise(text), "\n")


def _count(text, mark: str):
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def _lines(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """(id, tag, no, line, n) of every line of ``min_words`` words; tag tells rows of one id apart by their text."""
    d = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("tag"), _plain(F.col(text)).alias("ls"))
    # outer: Spark would add a filter for the others that splits the text again
    x = d.select("id", "tag", F.posexplode_outer("ls").alias("no", "line")).where(F.octet_length("line") >= 2 * min_words - 1)
    x = x.select("*", (_count(F.col("line"), " ") + 1).alias("n"))
    return x.where(F.col("n") >= min_words) if min_words > 1 else x


def _shortest(min_words: int, exact_words: int) -> int:
    return max(1, min(exact_words, min_words - 1))


def _place():
    return F.struct("id", "tag", "no")


def _hash():
    return [F.xxhash64(F.lit(1), "line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2")]


def _parts(g: int, least: int):
    """Keys that lines at one edit, of ``least`` words or more, share.  Of g parts of u words (u = n // g,
    and (n - 1) // g where that differs, so that lengths n and n - 1 have one in
    common) the edit lies in one, and the words of the others stand where they
    stood, counted from the start before it and from the end after it: for some
    k the first k * u words and the last (g - 1 - k) * u words agree."""
    unit, shorter = (F.floor(n / g).cast("int") for n in (F.col("n"), F.greatest(F.col("n") - 1, F.lit(least))))
    cut = lambda size: F.call_function("substring_index", F.col("line"), F.lit(" "), size)
    keys = lambda u: [F.xxhash64(F.lit(k), u, cut(u * k), cut(u * (k + 1 - g))) for k in range(g)]
    return F.when(unit == shorter, F.array(*keys(unit))).otherwise(F.array(*keys(unit), *keys(shorter)))


def _variants(min_words: int):
    """(at, v) of a line: the hash of its words (at 0), and where it has
    ``min_words``, of those without the word at each place, from 1 on.  A hash
    is the exclusive or of its words' hashes by position, so what is left
    after a word is that of the words before it and of those behind it moved up."""
    xor, zero = (lambda x, y: x.bitwiseXOR(y)), F.lit(0).cast("long")
    n = F.col("n")

    def of(moved, before, behind):
        return F.transform(F.sequence(F.lit(0), F.when(n >= min_words, n).otherwise(0)), lambda i: F.struct(i.alias("at"), xor(behind, F.when(
            i == 0, F.element_at(before, -1)).otherwise(xor(F.coalesce(F.get(before, i - 2), zero), F.get(moved, i - 1)))).alias("v")))
    # before: of the words up to each, where they stand and moved up; with the total of the moved ones the rest cancels out
    return let(F.split("line", " "), lambda ws: let(F.transform(ws, lambda w, i: F.xxhash64(w, i - 1)), lambda moved: let(
        running(F.zip_with(F.transform(ws, lambda w, i: F.xxhash64(w, i)), moved, xor), xor, zero), lambda before: let(
            F.aggregate(moved, zero, xor), lambda behind: of(moved, before, behind)))))


def _met(keyed: DataFrame, key: str, line: str) -> DataFrame:
    """The rows of ``keyed`` whose key another line has too."""
    met = keyed.groupBy(key).agg(F.min(line).alias("p"), F.max(line).alias("q")).where("p < q").select(key)
    return keyed.join(met, key)


def _meeting(lines: DataFrame, *place: str) -> DataFrame:
    """The ``place`` of lines that share a key of ``parts`` with another line."""
    return _met(lines.select(*place, "h1", F.explode("parts").alias("part")), "part", "h1").select(*place).distinct()


def _found(docs: DataFrame, doc_id: str, text: str, min_words: int, exact_words: int) -> tuple[DataFrame, DataFrame]:
    """(h1, h2, first, times) of each distinct line, and (h1, h2, first, near) of those with an earlier line at one edit."""
    least = max(1, min_words - 1)
    parts = F.when(F.col("n") >= least, _parts(2, least))
    lines = _lines(docs, doc_id, text, _shortest(min_words, exact_words)).select(*_hash(), "id", "tag", "no", parts.alias("parts"))
    first = store(lines.groupBy("h1", "h2").agg(
        F.min(_place()).alias("first"), F.first("parts").alias("parts"), F.count("*").alias("times")), "first")
    near = _meeting(first.select("h1", "first.*", "parts"), "id", "tag", "no")
    # the words of those, from the place where they stand first
    by_doc = near.groupBy("id", "tag").agg(F.collect_list("no").alias("nos"))
    d = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    texts = d.join(by_doc, (d["id"].eqNullSafe(by_doc["id"])) & (d["tag"] == by_doc["tag"])).select(
        d["id"], d["tag"], _plain(F.col("text")).alias("ls"), "nos")
    some = texts.select("id", "tag", "ls", F.explode("nos").alias("no")).select(
        "id", "tag", "no", F.get("ls", F.col("no")).alias("line")).distinct()
    some = store(some.withColumn("n", _count(F.col("line"), " ") + 1), "some")
    # the same test with smaller parts
    fine = some.select("id", "tag", "no", _parts(4, least).alias("parts"), F.xxhash64("line").alias("h1"))
    met = _meeting(fine, "id", "tag", "no").select(F.struct("id", "tag", "no").alias("there"))
    some = store(some.join(met, _place().eqNullSafe(met["there"]), "left_semi"), "lines")
    # deletion neighbourhood: position 0 is the whole line, all that one too short to be the longer emits; few variants are another line's too
    emitted = store(some.select(_place().alias("place"), "n", F.xxhash64("line").alias("own"), F.explode(_variants(min_words)).alias("x")).select(
        "place", "n", "own", F.col("x.at").alias("at"), F.col("x.v").alias("v")), "variants")
    emitted = store(_met(emitted, "v", "own").drop("own"), "shared")
    # the earliest line of each key, per way to meet: same deleted position, or whole against variant
    as_replaced = emitted.where("at > 0").select("place", F.xxhash64("v", "at", "n").alias("key"), F.lit(True).alias("small"), F.lit(True).alias("large"))
    as_inserted = emitted.select("place", F.xxhash64("v").alias("key"), (F.col("at") == 0).alias("small"), (F.col("at") > 0).alias("large"))
    met = as_replaced.unionByName(as_inserted)
    least = met.groupBy("key").agg(F.min(F.when(F.col("small"), F.col("place"))).alias("s"),
                                   F.min(F.when(F.col("large"), F.col("place"))).alias("l"),
                                   F.min("place").alias("p"), F.max("place").alias("q")).where("p < q").drop("p", "q")
    pairs = met.join(least, "key").select("place", F.explode(F.array(
        F.when(F.col("small"), F.col("l")), F.when(F.col("large"), F.col("s")))).alias("other"))
    pairs = pairs.where(F.col("other") < F.col("place")).distinct()
    # verify on the words
    a = some.select(_place().alias("place"), F.split("line", " ").alias("wa"), *_hash())
    b = some.select(_place().alias("other"), F.split("line", " ").alias("wb"))
    best = (pairs.join(a, "place").join(b, "other").where(within_one_edit(F.col("wa"), F.col("wb")))
                 .groupBy("h1", "h2", F.col("place").alias("first")).agg(F.min("other").alias("near")))
    return first.drop("parts"), best


def duplicate_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 5, exact_words: int = 4) -> DataFrame:
    """(h1, h2, first, near): each distinct line's hash, its first place
    and the place of the earliest earlier line at one edit (null: none)."""
    first, best = _found(docs, doc_id, text, min_words, exact_words)
    return first.drop("times").join(best.drop("first"), ["h1", "h2"], "left")


def within_one_edit(a, b):
    """Whether two word arrays are at most one inserted, deleted or replaced
    word apart: after the common start, the rests agree but for their first words."""
    least = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(0), least), lambda i: (i == least) | (F.get(a, i) != F.get(b, i)))
    at = F.get(differ, F.lit(0))
    rest = lambda x, skip: F.slice(x, at + 1 + skip, F.size(x))
    more = F.size(a) - F.size(b)
    return F.when(a == b, True).when(more == 0, rest(a, 1) == rest(b, 1)).when(
        more == 1, rest(a, 1) == rest(b, 0)).when(more == -1, rest(a, 0) == rest(b, 1)).otherwise(False)


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 5, exact_words: int = 4) -> DataFrame:
    """``docs`` with duplicate lines taken out of ``text``, plus n_lines,
    n_exact and n_near (lines that went, by kind)."""
    own = ("n_lines", "n_exact", "n_near")
    given, docs, doc_id, text = docs, numbered(docs), at(docs, doc_id), at(docs, text)
    first, best = _found(docs, doc_id, text, min_words, exact_words)
    # only lines that stand twice or have a near one can go
    found = (first.where("times > 1").select("h1", "h2", "first", F.lit(False).alias("near"))
                  .unionByName(best.withColumn("near", F.lit(True)))
                  .groupBy("h1", "h2").agg(F.min("first").alias("first"), F.max("near").alias("near")))
    lines = _lines(docs, doc_id, text, _shortest(min_words, exact_words)).select(*_hash(), "id", "tag", "no")
    several = lines.join(found, ["h1", "h2"]).select(
        "id", "tag", "no", (_place() > F.col("first")).alias("exact"), "near")
    gone = several.where("exact or near").groupBy(F.col("id").alias("_id"), F.col("tag").alias("_tag")).agg(
        F.collect_set(F.struct("no", "exact")).alias("_gone"))
    out = docs.withColumn("_t", F.xxhash64(text))
    out = out.join(gone, out[doc_id].eqNullSafe(gone["_id"]) & (out["_t"] == gone["_tag"]), "left")
    none = F.array().cast("array<struct<no:int,exact:boolean>>")
    out = out.withColumn("_gone", F.coalesce("_gone", none)).withColumn("_nos", F.transform("_gone", lambda g: g["no"]))
    # the numbers of the lines that stay, in order
    rest = let(F.split(text, "\n"), lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("_nos")), lambda i: F.get(ls, i)), "\n"))
    out = out.withColumns({
        "n_lines": F.coalesce(_count(F.col(text), "\n") + 1, F.lit(0)).cast("long"),
        "n_exact": F.size(F.filter("_gone", lambda g: g["exact"])).cast("long"),
        "n_near": F.size(F.filter("_gone", lambda g: ~g["exact"])).cast("long"),
        text: F.when(F.size("_nos") > 0, rest).otherwise(F.col(text)),
    })
    return out.select(*[F.col(at(given, c)).alias(c) for c in given.columns if c not in own], *own)
