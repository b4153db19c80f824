"""Operator 10: substring dedup by content-defined chunks.

The words of a text are joined by single spaces; a gear rolling hash over the
last 16 bytes cuts the result where it is least within REACH bytes, or after
MOST bytes.  Boundaries so depend on nearby bytes only: an insertion moves no
later one, and a text that repeats with a short period is cut at the same place
of each period.  Chunks are deduplicated by their 128-bit digest; neighbouring
chunks of a text that other documents hold too form a run.  A passage's first
and last words lie in chunks whose boundaries also depend on other text, so its
run is shorter than the passage.  A cut depends on the 32 bytes before and the
16 after it, so a passage that began 32 bytes before the last cut ahead of the
run, or ended 16 after the next one behind it, would have that cut in common
too: a run is reported when it and the words up to there are more than
``min_words``.  Each of its chunks is kept in the first document that
holds it, so a run is returned in pieces, cut where that document begins or
ends to be this one.

Data flow: one scan emits (digest, doc, place) rows; a partially aggregated
minimum and maximum document per digest meets them again in a join, which
adaptive execution splits where a digest is hot; only chunks of two documents
or more survive.  Runs are formed per document from those.

Defined results: a stretch that repeats one unit of up to REACH bytes is one
chunk however long, and shared where another document repeats that unit; null
and empty texts have no chunk; rows with a null doc_id
are not reported; rows of equal doc_id are one document, and identical rows
count once; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import SPACES, mix

REACH, MOST = 16, 128
BACK = 2 * REACH     # bytes before a cut that it depends on: REACH values, each of 16 bytes
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def boundaries(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places after which a byte array is cut, from 0 on; the ends of its chunks;
    and the bytes at each chunk's end that stand for it.  The rolling value of byte
    i is the sum of GEAR[data[i - j]] << 2j over the last 16 bytes, built by
    doubling; a cut stands after a byte whose value no other within REACH bytes is
    below.  Equal least values so near are equal bytes that repeat with a period of
    REACH or less: such text is cut once in each period, and its equal neighbouring
    pieces are one chunk, which one of them stands for."""
    n = len(data)
    if n == 0:
        return np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        h[width:] = h[width:] + (h[:-width] << np.uint32(2 * width))
    low = np.full(n + REACH, 0xFFFFFFFF, np.uint32)  # least of the REACH values from i on
    low[:n] = h
    for width in (1, 2, 4, 8):
        low[:-width] = np.minimum(low[:-width], low[width:])
    cut = np.zeros(n, bool)
    cut[:n - 1] = h[:n - 1] <= low[1:n]               # REACH values after i
    cut[REACH:] &= h[REACH:] <= low[:max(0, n - REACH)]       # and before it
    cut[:REACH] = False
    cuts = np.concatenate([[0], np.nonzero(cut)[0] + 1, [n]])
    at, size = cuts[:-1], np.diff(cuts)
    same = np.append(False, (size[1:] == size[:-1]) & (size[1:] <= REACH))    # equal to the piece before
    for u in np.unique(size[same]).tolist():
        differ = np.append(0, np.cumsum(data[u:] != data[:-u]))
        w = np.nonzero(same & (size == u))[0]
        same[w] = differ[at[w]] == differ[at[w] - u]
    last = np.append(~same[1:], True)
    ends, units = cuts[1:][last], size[last]
    starts = np.append(0, ends[:-1])
    wide = (units > MOST).nonzero()[0]
    if len(wide):
        more = [np.arange(a + MOST, c, MOST) for a, c in zip(starts[wide], ends[wide])]
        units[wide] -= [len(x) * MOST for x in more]
        where = np.repeat(wide, [len(x) for x in more])
        ends, units = np.insert(ends, where, np.concatenate(more)), np.insert(units, where, MOST)
    return cuts, ends, units


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per chunk of the text's words, joined by single spaces: digest
    (d1, d2), doc_id, copy (a hash of the text), place = k << 32 | number of the
    first word begun in it, and info = words begun in it | before it << 32 | after
    it << 48, where before and after are as far as a passage can reach that has this
    chunk's near cut, but not the next one beyond, in common with another text."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"d1 long, d2 long, doc_id {d.schema['doc_id'].dataType.simpleString()}, copy long, place long, info long"

    def work(batches):
        names = ["d1", "d2", "doc_id", "copy", "place", "info"]
        for batch in batches:
            texts = batch.column(1)
            digests, rows, places, infos, copies = [], [], [], [], []
            for i in range(batch.num_rows):
                if not (t := texts[i].as_py()) or not t.strip(SPACES):
                    continue
                raw = b" ".join(t.encode("utf-8", "surrogatepass").split())
                data = np.frombuffer(raw, np.uint8)
                cuts, cut, units = boundaries(data)
                gap = data == 32
                begins = ~gap
                begins[1:] &= gap[:-1]
                at = np.append(0, cut[:-1])
                words = np.append(0, np.cumsum(begins))             # begun before a byte
                n = words[cut] - words[at]
                far = cuts[np.maximum(np.searchsorted(cuts, at) - 1, 0)]
                before = words[at] - words[np.maximum(far - BACK, 0)]
                far = cuts[np.minimum(np.searchsorted(cuts, cut, "right"), len(cuts) - 1)]
                after = words[np.minimum(far + REACH, len(data))] - words[cut]
                digests += [xxhash.xxh3_128_digest(raw[b - u:b]) for u, b in zip(units.tolist(), cut.tolist())]
                places.append((np.arange(len(at), dtype=np.int64) << 32) | words[at])
                infos.append(n | (np.minimum(before, 0x7FFF) << 32) | (np.minimum(after, 0x7FFF) << 48))
                rows += [i] * len(cut)
                copies.append(np.full(len(cut), xxhash.xxh3_64_intdigest(raw) >> 1, np.int64))
            if rows:
                both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column(0).take(pa.array(rows)),
                    *[pa.array(np.concatenate(x)) for x in (copies, places, infos)]], names=names)

    return d.mapInArrow(work, schema)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """One row per piece of a passage that other documents repeat: doc_id, start,
    end (words counted from 0, end exclusive), n_words, n_chunks, first_doc_id
    (smallest doc_id that holds one of its chunks), duplicate (false where this
    document is the first to hold the chunks and so keeps them).  A passage is
    one piece, or several where that changes from chunk to chunk."""
    c = chunks(docs, doc_id, text).where("doc_id is not null")
    shared = (c.groupBy("d1", "d2").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"))
               .where("first_doc_id < last").drop("last"))
    bits = lambda shift, mask=0x7FFF: F.shiftright("info", shift).bitwiseAND(F.lit(mask))
    dup = (c.join(shared, ["d1", "d2"]).dropDuplicates(["doc_id", "copy", "place"])
            .select("doc_id", "copy", "first_doc_id", F.shiftright("place", 32).alias("k"),
                    F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("start"),
                    bits(0, 0xFFFFFFFF).alias("n_words"), bits(32).alias("before"), bits(48).alias("after")))
    dup = dup.withColumn("duplicate", F.col("doc_id") != F.col("first_doc_id"))
    # a row's number in its text, less its rank: equal within a run, and within a piece of one flag
    rank = lambda *by: F.col("k") - F.row_number().over(Window.partitionBy("doc_id", "copy", *by).orderBy("k"))
    pieces = dup.withColumns({"run": rank(), "piece": rank("duplicate")}).groupBy("doc_id", "copy", "run", "duplicate", "piece").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n_words")).alias("end"),
        F.sum("n_words").alias("n_words"), F.count("*").alias("n_chunks"), F.min("first_doc_id").alias("first_doc_id"),
        F.min("k").alias("k"), F.min_by("before", "k").alias("before"), F.max_by("after", "k").alias("after"))
    whole = Window.partitionBy("doc_id", "copy", "run")
    out = pieces.withColumn("reach", F.sum("n_words").over(whole) + F.min_by("before", "k").over(whole) + F.max_by("after", "k").over(whole))
    return (out.where(F.col("reach") > min_words)
               .select("doc_id", "start", "end", "n_words", "n_chunks", "first_doc_id", "duplicate"))
