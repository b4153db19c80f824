"""Operator 2: benchmark decontamination.

MinHash containment search partitioned by set size.  Test items are split into
bands of doubling shingle counts; a document is seen, for a band of block
length B, as windows of two neighbouring blocks of B shingles, so that an item
of at most B + 1 shingles always lies whole in one window however long the
document is, and window and item are sets of like size.  A window is a
candidate of an item when one of ``hashes`` MinHash values agrees.  With a
containment of 0.8 the Jaccard similarity of item and window is at least 0.18,
so a pair is missed with probability (1 - 0.18) ** 48 < 0.0001.  Candidates
are verified by exact containment of the item's distinct shingles in the whole
document.

The items travel to the tasks in blocks of at most ``block_items`` items and
about ``block_chars`` characters; a larger benchmark takes more passes, one
for each block.  Documents never move: no shuffle, no skew, and a lost
executor only repeats its scans.

Defined results: null or empty texts match nothing; an item of under five
words is one shingle of its whole sequence; repeated items or documents give a
row each; items with a null id give rows with a null ``item_id``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import U, mix, shingle_set, shingles_of, word_hashes
from tillhouse.llm.memo import make_room

HASHES = 48


def band_of(n: int) -> int:
    """Block length of the band of an item of n shingles: the power of two >= n - 1."""
    return 1 << max(0, n - 2).bit_length() if n > 1 else 1


class Index:
    """MinHash values of one block of items."""

    def __init__(self, items: list[tuple[object, str | None]], size: int, percent: int, hashes: int = HASHES):
        self.size, self.percent, self.hashes = size, percent, hashes
        self.ids, self.sets = [], []
        for i, text in items:
            s = shingle_set(text, size)
            if len(s):
                self.ids.append(i)
                self.sets.append(s)
        self.seeds = mix(np.arange(1, hashes + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
        keys: dict[int, list[tuple[int, int]]] = {}
        for n, s in enumerate(self.sets):
            for k in range(hashes):
                keys.setdefault(band_of(len(s)), []).append((int(mix(s ^ self.seeds[k]).min()) ^ k, n))
        self.bands = {b: (np.array([k for k, _ in sorted(v)], np.uint64), np.array([n for _, n in sorted(v)]))
                      for b, v in keys.items()}
        # a small bit table rules most window values out before the search
        self.seen = {}
        for b, (k, _) in self.bands.items():
            self.seen[b] = np.zeros(1 << 20, bool)
            self.seen[b][(k & U((1 << 20) - 1)).astype(np.int64)] = True

    def search(self, docs: list[np.ndarray]) -> list[tuple[int, int, float]]:
        """(document, item, containment) of the verified pairs of a batch."""
        found: set[tuple[int, int]] = set()
        docs_n = np.array([len(d) for d in docs])
        if not self.bands or not docs_n.sum():
            return []
        every = np.concatenate(docs)
        low = min(self.bands)
        # blocks of the shortest band start anew in each document
        counts = -(-docs_n // low)
        first = np.cumsum(docs_n) - docs_n
        start = np.repeat(first - (np.cumsum(counts) - counts) * low, counts) + np.arange(counts.sum()) * low
        for k in range(self.hashes):
            least = np.minimum.reduceat(mix(every ^ self.seeds[k]), start)
            n, at = counts, least
            b = low
            while b <= max(self.bands):
                owner = np.repeat(np.arange(len(docs)), n)
                if b in self.bands:
                    same = np.append(owner[1:] == owner[:-1], False)
                    window = np.where(same, np.minimum(at, np.append(at[1:], U(0))), at) ^ U(k)
                    hit = np.nonzero(self.seen[b][(window & U((1 << 20) - 1)).astype(np.int64)])[0]
                    if len(hit):
                        keys, items = self.bands[b]
                        lo = np.searchsorted(keys, window[hit], "left")
                        hi = np.searchsorted(keys, window[hit], "right")
                        for h, x, y in zip(hit[hi > lo], lo[hi > lo], hi[hi > lo]):
                            found.update((int(owner[h]), int(i)) for i in items[x:y])
                b *= 2
                if b > max(self.bands):
                    break
                # pairs of blocks of one document become its blocks of twice the length
                place = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                at = np.minimum.reduceat(at, np.nonzero(place % 2 == 0)[0])
                n = -(-n // 2)
        out = []
        sets: dict[int, np.ndarray] = {}
        for d, i in sorted(found):
            if d not in sets:
                sets[d] = np.unique(docs[d])
            q = self.sets[i]
            where = np.searchsorted(sets[d], q)
            both = int((sets[d][np.minimum(where, len(sets[d]) - 1)] == q).sum())
            if 100 * both >= self.percent * len(q):
                out.append((d, i, both / len(q)))
        return out


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", size: int = 5, percent: int = 80,
                  hashes: int = HASHES, block_items: int = 20_000, block_chars: int = 40_000_000) -> DataFrame:
    """Pairs (doc_id, item_id, containment): the distinct shingles of the item
    that the document holds are at least ``percent`` % of the item's."""
    q = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item_text"))
    many, chars = q.agg(F.count("*"), F.coalesce(F.sum(F.length("item_text")), F.lit(0))).first()
    blocks = max(1, math.ceil(many / block_items), math.ceil(chars / block_chars))
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("doc_text"))
    schema = T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType),
                           T.StructField("item_id", q.schema["item_id"].dataType),
                           T.StructField("containment", T.DoubleType())])
    spark, out = docs.sparkSession, None
    for block in range(blocks):
        part = q if blocks == 1 else q.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(blocks)) == block)
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in part.collect()], size, percent, hashes))

        def work(batches, index=index):
            make_room("decontaminate")
            ix = index.value
            names = ["doc_id", "item_id", "containment"]
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1).to_pylist()
                for a in range(0, len(texts), 500):
                    got = ix.search([shingles_of(word_hashes(t), ix.size) for t in texts[a:a + 500]])
                    if got:
                        yield pa.RecordBatch.from_arrays([
                            ids.take(pa.array([a + x for x, _, _ in got])),
                            pa.array([ix.ids[i] for _, i, _ in got]).cast(kind), pa.array([c for _, _, c in got])], names=names)

        from pyspark.sql.pandas.types import to_arrow_type
        kind = to_arrow_type(schema["item_id"].dataType)
        found = d.mapInArrow(work, schema)
        out = found if out is None else out.unionByName(found)
    return out
