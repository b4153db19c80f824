"""Operator 9: exact Jaccard join of word n-gram sets by universe partition.

Sets of a size band are compared through ``segments``: every shingle hash
belongs to one of m segments.  Two sets with Jaccard >= p % differ in at most
H shingles, so with thresholds e_i (0: segment equal, 1: equal up to one
deletion) and sum(e_i + 1) > H at least one segment agrees (pigeonhole).  Each
set therefore emits one key per exact segment and, for the segments that the
cost model gives e = 1, its keys after each single deletion; sets that share
a key are candidates and are verified exactly.

* Bands: scheme j compares a larger set of size in [L_j, L_j+1) with smaller
  ones from p % of L_j on; a set emits in its own scheme and the next.
* Cost-based allocation: the number of e = 1 segments of a scheme is the one
  with the least expected emissions, including what empty segments cost
  (``Scheme``).  At 80 % that is one segment with deletions in the two schemes
  of the smallest sets (least partner of 4 and 5 shingles) and none in any
  other: a segment of k shingles emits k + 1 keys to cover two differences,
  which two exact segments cover with two keys.
* Slack: schemes have ``spare_empty + spare_hot`` segments more than needed.
  A set may leave out so many empty segments and so many of its most frequent
  segments; a similar pair still shares one that neither leaves out.  This
  keeps common passages from meeting by the thousand and loses no link.  Sets
  with more empty segments refine them by the prefix filter (the first
  n - ceil(p n) + 1 shingles in hash order), which is exact too.
* Exact copies collapse first: keys carry a class (hash of the whole set).
* Links, not pairs: in each key's group, members are first verified against
  the group's hub, the class that shares the most; then only pairs from
  different components so far remain.  A group of k near copies costs k
  verifications, and components come out exactly.  Keys that many classes of
  different components still share don't pair them all.  A class that is not
  similar to the hub is similar to another one only where both differ from the
  hub in the same shingles, so classes meet again by a prefix filter on those
  differences (``_residuals``), a fifth or a quarter of a class's size, taken
  from the rare ones on (``_common``): else a passage that many dissimilar
  classes hold and the hub lacks would bring all of them together again.
* Candidates are first compared by size and by 2,048-bit bitmaps, which rule
  out most pairs exactly, before their texts are fetched.

Keys travel as binary blocks of (key, class); a key that repeats in a task's
block many times (a hot one) is sent on spread over all partitions, with one
marker to the key's partition.

Defined results: null, empty and blank texts have n_shingles 0 and are their
own component; texts of one to four words are one shingle of the whole
sequence; repeated rows and rows of equal doc_id are all returned; a row with
a null doc_id links through its text like others, and has a null component_id
only if no member of its component has an id.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import U, connected_components, mix, partitions, shingle_set, ship, store
from tillhouse.llm.memo import make_room

RATIO = 1.3          # width of a size band
FLUSH = 1_500_000    # keys a task holds before it sends a block
HOT = 200            # times a key repeats in a block before it is spread
BITMAP = 2048        # bits of a set's bitmap
FEW = 16             # classes of a key that are compared with each other directly
COMMON = 1 << 16     # cells that count how many crowded classes have a shingle


class Scheme:
    """Segments of one size band, for similarity percent p."""

    def __init__(self, j: int, low: int, high: int, percent: int):
        self.j, self.low, self.high = j, low, high
        self.least = -(-percent * low // 100)
        need = 2 * (high - 1) * (100 - percent) // (100 + percent) + 1   # H + 1
        best = None
        for deleted in {*range(min(8, need // 2 + 1)), (need + 1) // 2}:
            spare_empty = spare_hot = 0
            for _ in range(6):  # more segments are emptier, and need more slack
                m = max(1, need + spare_empty + spare_hot - deleted)
                k = self.least / m
                exact = max(0, need + spare_empty + spare_hot - 2 * deleted)
                if exact == 0:
                    m = deleted
                    break
                spare_empty = math.ceil(1.3 * exact * math.exp(-k))
                spare_hot = 1 + exact // 10 if exact >= 6 else 0
            if exact == 0 and 2 * deleted < need:
                continue
            if exact:  # the last round's slack is paid for in full
                exact = max(exact, need + spare_empty + spare_hot - 2 * deleted)
                m = exact + deleted
            k = self.least / m
            refined = (exact * math.exp(-k) if exact < 6 else 0) + deleted * (1 + k) * math.exp(-k)
            cost = exact + deleted * (k + 1) + 4 * refined * (1 + (100 - percent) * self.least / 100)
            if best is None or cost < best[0]:
                best = (cost, exact, deleted, spare_empty, spare_hot)
        _, self.exact, self.deleted, self.spare_empty, self.spare_hot = best
        self.m = self.exact + self.deleted
        self.salt = mix(np.array([j + 1], np.uint64))[0]


@lru_cache
def schemes(percent: int, largest: int = 1 << 27) -> list[Scheme]:
    """Schemes of all sizes in which two different sets can be similar."""
    low, out = next(n for n in range(2, 1000) if 100 * (n - 1) >= percent * n), []
    while low < largest:
        high = max(low + 1, int(low * RATIO))
        out.append(Scheme(len(out), low, high, percent))
        low = high
    return out


def _finish(sums: np.ndarray, segment: np.ndarray, count, s: Scheme, plain: int) -> np.ndarray:
    """Keys of segment contents; the top 8 bits are the scheme (128 at most)
    and whether frequent keys of the kind may be left out."""
    k = mix(sums + U(0x9E3779B97F4A7C15) * (segment.astype(np.uint64) + U(1)) + U(0xC2B2AE3D27D4EB4F) * count.astype(np.uint64) + s.salt)
    return (k >> U(8)) | U((s.j << 1 | plain) << 56)


def keys_of(x: np.ndarray, percent: int) -> np.ndarray:
    """All keys of a sorted set of shingle hashes."""
    n, out = len(x), []
    prefix = x[:n - (-(-percent * n // 100)) + 1]
    for s in schemes(percent):
        if not s.least <= n < s.high:
            if s.least > n:
                break
            continue
        h = np.sort(mix(x ^ s.salt))                # a segment's are neighbours
        segment = ((h >> U(32)) * U(s.m) >> U(32)).astype(np.int64)
        part = mix(h + U(1))
        count = np.bincount(segment, minlength=s.m)
        full = np.nonzero(count)[0]
        sums = np.zeros(s.m, np.uint64)
        sums[full] = np.add.reduceat(part, (np.cumsum(count) - count)[full])
        ids = np.arange(s.m)
        exact = ids < s.exact
        some, refine = exact & (count > 0), list(ids[exact & (count == 0)])
        own = np.sort(_finish(sums[some], ids[some], count[some], s, 1))
        if len(refine) <= s.spare_empty:            # leave the empty ones out, then the least keys
            own, refine = own[s.spare_empty - len(refine):], []
        out.append(own)
        if s.deleted:
            own = ~exact & (count > 0)
            out.append(_finish(sums[own], ids[own], count[own], s, 0))
            cut = np.nonzero(segment >= s.exact)[0]
            less = count[segment[cut]] - 1
            left = sums[segment[cut]] - part[cut]
            rest = less > 0
            out.append(_finish(left[rest], segment[cut][rest], less[rest], s, 0))
            refine += list(ids[~exact & (count <= 1)])
        if refine:  # an empty segment agrees with too much: once for each prefix shingle
            at = np.repeat(np.array(refine), len(prefix))
            out.append(_finish(np.tile(mix(prefix + U(7)), len(refine)), at, np.zeros(len(at), np.int64), s, 0))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def class_of(x: np.ndarray) -> int:
    """Hash of a whole set, as a signed 64-bit integer."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(x.tobytes()), "<i8")[0])


# ---- stage functions --------------------------------------------------------
def _block(keys: np.ndarray, values: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Blocks (bucket, rows of key and values); the first value is the class."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.nonzero(np.append(True, keys[1:] != keys[:-1]))[0]
    times = np.diff(np.append(first, len(keys)))
    bucket = (mix(keys) % U(buckets)).astype(np.int64)
    hot = np.repeat(times > HOT, times)
    marks = first[times > HOT]                  # one marker of each goes where the key belongs
    mark_bucket = bucket[marks]
    bucket[hot] = -1 - (values[hot, 0] % buckets)
    keys, values, bucket = (np.concatenate(x) for x in (
        (keys, keys[marks]), (values, values[marks]), (bucket, mark_bucket)))
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.nonzero(np.append(True, bucket[1:] != bucket[:-1]))[0]
    ends = np.append(cut[1:], len(bucket))
    rows = np.column_stack([keys.view(np.int64), values])[order]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int64()),
                                       pa.array([rows[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary())],
                                      names=["bucket", "block"])


def _emit(percent: int, size: int, buckets: int):
    def send(keys, classes):
        return _block(np.concatenate(keys), np.concatenate(classes)[:, None], buckets)

    def work(batches):
        make_room("ngram_join")
        keys, classes, held, seen = [], [], 0, set()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                x = shingle_set(t, size)
                if not len(x) or (c := class_of(x)) in seen:
                    continue
                seen.add(c)
                k = keys_of(x, percent)
                keys.append(k)
                classes.append(np.full(len(k), c, np.int64))
                held += len(k)
                if held > FLUSH:
                    yield send(keys, classes)
                    keys, classes, held = [], [], 0
        if held:
            yield send(keys, classes)
    return work


def _shared(*names: str):
    """Rows (key, class, ...) of keys that two classes have, from the blocks of a
    partition; with a component, of keys that two components have."""
    by = names.index("component") if "component" in names else 1

    def rows(table):
        return pa.RecordBatch.from_arrays([pa.array(table[:, i]) for i in range(len(names))], names=names)

    def work(batches):
        held = []
        for batch in batches:
            buckets = batch.column(0).to_pylist()
            for i, b in enumerate(buckets):
                table = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64).reshape(-1, len(names))
                if b < 0:
                    yield rows(table)               # repeated within a task: shared for certain
                else:
                    held.append(table)
        if held:
            table = np.concatenate(held)
            held.clear()
            table = table[np.lexsort((table[:, 1], table[:, 0]))]
            table = table[np.append(True, (table[1:, :2] != table[:-1, :2]).any(1))]
            # keys of one class go; a lone marker may too, as all rows of its spread key are out already
            first = np.append(True, table[1:, 0] != table[:-1, 0])
            at = np.nonzero(first)[0]
            several = np.minimum.reduceat(table[:, by], at) < np.maximum.reduceat(table[:, by], at)
            yield rows(table[several[np.cumsum(first) - 1]])
    return work


def _info(percent: int, size: int):
    def work(batches):
        import zstandard
        make_room("ngram_join")
        zipper = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ns, cs = [], []
            bits, zips = [], []
            for t in batch.column(1).to_pylist():
                x = shingle_set(t, size)
                ns.append(len(x))
                cs.append(class_of(x) if len(x) else None)
                b = np.zeros(BITMAP, bool)
                b[(x >> U(20)).astype(np.int64) % BITMAP] = True
                bits.append(np.packbits(b).tobytes())
                zips.append(zipper.compress((t or "").encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(cs, pa.int64()), pa.array(bits, pa.binary()),
                                              pa.array(zips, pa.binary())], names=["doc_id", "n_shingles", "class", "bits", "zip"])
    return work


def _possible(percent: int):
    """Pairs (a, b, na, nb, za, zb) that their bitmaps don't rule out: bitmaps
    differ in no more places than the sets in elements."""
    def work(batches):
        for batch in batches:
            if batch.num_rows:
                za, zb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for i in (4, 5))
                total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
                keep = (100 + percent) * np.bitwise_count(za ^ zb).sum(1) <= (100 - percent) * total
                yield batch.select([0, 1]).filter(pa.array(keep))
    return work


def _cell(x: np.ndarray) -> np.ndarray:
    return (x >> U(24)).astype(np.int64) % COMMON


def _common(size: int):
    """(cell, n): how many texts' shingles fall into each of ``COMMON`` cells."""
    def work(batches):
        import zstandard
        unzip, n = zstandard.ZstdDecompressor(), np.zeros(COMMON, np.int64)
        for batch in batches:
            for z in batch.column(0).to_pylist():
                n += np.bincount(_cell(shingle_set(unzip.decompress(z).decode("utf-8", "surrogatepass"), size)), minlength=COMMON)
        cells = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n[cells])], names=["cell", "n"])
    return work


def _ranks(texts: DataFrame, size: int) -> np.ndarray:
    """For each cell the binary logarithm of its count, 64 kB whatever the input:
    shingles are ordered by it, then by hash.  Any order loses nothing, one that
    puts common shingles last lets few classes meet."""
    counts = texts.select("zip").mapInArrow(_common(size), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(COMMON, np.uint8)
    for cell, n in counts.collect():
        out[cell] = n.bit_length()
    return out


def _residuals(percent: int, size: int, buckets: int, ranks: np.ndarray = np.zeros(COMMON, np.uint8)):
    """Blocks of keys (hub and shingle) from (class, hub, other, component, zx,
    zh) rows: the first of the differences D of each class x from its hub h, x's
    own shingles before those that x lacks, each by ``ranks``, then hash.  Where classes x
    and o are similar and o is not similar to h, D_x and D_o share a shingle (o
    differs from h in more shingles than from x).  The first shared one is early
    in both: those before it tell x from o, so there are (100 - p) n / p of them at
    most; of x's own shingles, where there are n - p n + 1, it is one of so many,
    as x and o share one of the first so many of each in this order.  And for
    classes of the hub's component, or similar to h (verified against it), which
    need to meet only those that are not: (100 + p) d_o > (100 - p) (n_o + n_h), so D_o and D_x share
    over (d_x + (100 - p) (n_h - n_x) / (100 + p)) / 2 elements.  Each side thus
    sends a fifth or a quarter of its size, however far it is from h.

    Rows also hold the component, the numbers of shingles (size) and own ones
    (own), and the parities of the shingles in 128 places (odd0, odd1): two
    classes differ in no fewer shingles than these do."""
    def ordered(x):
        return x[np.argsort(ranks[_cell(x)], kind="stable")]

    def work(batches):
        import zstandard
        unzip = zstandard.ZstdDecompressor()
        read = lru_cache(500)(lambda z: shingle_set(unzip.decompress(z).decode("utf-8", "surrogatepass"), size))

        def send():
            times = [len(t) for t, _ in held]
            return _block(np.concatenate([t for t, _ in held]), np.repeat(np.array([v for _, v in held], np.int64), times, 0), buckets)

        held, tokens = [], 0
        for batch in batches:
            classes, hubs, others, components = (batch.column(i).to_pylist() for i in range(4))
            for i, (c, hub, other, component) in enumerate(zip(classes, hubs, others, components)):
                x, h = read(batch.column(4)[i].as_py()), read(batch.column(5)[i].as_py())
                own = np.setdiff1d(x, h, True)
                d = np.concatenate([ordered(own), ordered(np.setdiff1d(h, x, True))])
                odd = np.packbits((np.bincount((x >> U(40)).astype(np.int64) % 128, minlength=128) % 2).astype(bool)).view(np.int64)
                row = (c, component, len(x), len(own), *odd.tolist())
                far = (100 + percent) * len(d) > (100 - percent) * (len(x) + len(h))
                many, plain = (100 - percent) * len(x) // percent + 1, len(x) - (-(-percent * len(x) // 100)) + 1
                if plain <= len(own):
                    many = min(many, plain)
                if not (other and far):
                    least = ((100 + percent) * len(d) + (100 - percent) * (len(h) - len(x))) // (2 * (100 + percent)) + 1
                    many = min(many, max(0, len(d) - least + 1))
                held.append((mix(d[:many] ^ mix(np.array([hub], np.int64).view(np.uint64))), row))
                tokens += len(held[-1][0])
                if tokens > FLUSH // 6:
                    yield send()
                    held, tokens = [], 0
        if held:
            yield send()
    return work


def _verify(percent: int, size: int):
    def work(batches):
        import zstandard
        memo: dict[int, np.ndarray] = {}
        for batch in batches:
            unzip = zstandard.ZstdDecompressor()
            a, b = (batch.column(i).to_pylist() for i in (0, 1))
            keep = []
            for i in range(len(a)):
                pair = []
                for c, col in ((a[i], 2), (b[i], 3)):
                    x = memo.get(c)
                    if x is None:
                        if len(memo) > 2000:
                            memo.clear()
                        x = memo[c] = shingle_set(unzip.decompress(batch.column(col)[i].as_py()).decode("utf-8", "surrogatepass"), size)
                    pair.append(x)
                x, y = sorted(pair, key=len)
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))
    return work


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                       percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): one row per input row;
    n_links counts verified links found of its set, not all links of it."""
    spark: SparkSession = ship(docs.sparkSession)
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    parts = partitions(spark)

    info = store(d.mapInArrow(_info(percent, size), f"doc_id {kind}, n_shingles long, class long, bits binary, zip binary"), "info")
    blocks = d.select("text").mapInArrow(_emit(percent, size, 4 * parts), "bucket long, block binary")
    found = store(blocks.repartition(parts, "bucket").mapInArrow(_shared("key", "class"), "key long, class long"), "shared")

    # leave out, per class and scheme, the most frequent of its exact keys within the slack
    freq = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows = found.join(freq, "key").withColumn("scheme", F.shiftright("key", 57).bitwiseAND(F.lit(127)))
    plain = F.shiftright("key", 56).bitwiseAND(F.lit(1)) == 1
    per = Window.partitionBy("class", "scheme", "plain")
    spare = F.element_at(F.array(*[F.lit(s.spare_hot) for s in schemes(percent)]), (F.col("scheme") + 1).cast("int"))
    rows = (rows.withColumn("plain", plain)
                .withColumn("rank", F.row_number().over(per.orderBy(F.desc("n"), "key")))
                .withColumn("score", F.sum("n").over(per))
                .where(~F.col("plain") | (F.col("n") <= 8) | (F.col("rank") > spare))
                .select("key", "class", "score"))
    rows = store(rows, "kept")

    # members against the hub of each key
    hubs = rows.groupBy("key").agg(F.max_by("class", F.struct("score", "class")).alias("hub"))
    star = store(rows.join(hubs, "key").where("class <> hub")
                 .select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct(), "star")

    # texts of the classes that share a key, one for each class
    wanted = rows.select("class").distinct()
    heads = info.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits")).join(wanted, "class")
    heads = store(heads, "heads")
    texts = store(info.where("class is not null").select("class", "zip").dropDuplicates(["class"]).join(wanted, "class", "left_semi"), "texts")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        a, b = (heads.select(F.col("class").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"z{x}")) for x in "ab")
        near = (pairs.join(a.drop("za"), "a").join(b.drop("zb"), "b")
                .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)"))
        near = (near.join(a.select("a", "za"), "a").join(b.select("b", "zb"), "b").select("a", "b", "na", "nb", "za", "zb")
                    .mapInArrow(_possible(percent), "a long, b long"))
        ta, tb = (texts.select(F.col("class").alias(x), F.col("zip").alias(f"z{x}")) for x in "ab")
        both = near.join(ta, "a").join(tb, "b").select("a", "b", "za", "zb")
        return store(both.mapInArrow(_verify(percent, size), "a long, b long"), name)

    links = verified(star, "star-links")
    part = connected_components(links)
    # what is left: pairs of different components that share a key
    # of each component the class with the most links; a key's hub is that of its largest component, or its smallest class
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    centres = part.join(ends, "node").groupBy("component").agg(F.count("*").alias("members"), F.max_by("node", F.struct("links", "node")).alias("centre"))
    nodes = (heads.select("class", F.col("n").alias("size")).join(part.withColumnRenamed("node", "class"), "class", "left")
                  .join(centres, "component", "left")
                  .select("class", F.coalesce("component", "class").alias("component"), F.struct(
                      F.coalesce("members", F.lit(1)).alias("members"), (-F.col("size")).alias("size"),
                      F.coalesce("centre", "class").alias("class"), F.coalesce("component", "class").alias("component")).alias("hub")))
    of = rows.select("key", "class").join(nodes, "class")
    many = of.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q"), F.count("*").alias("n"), F.max("hub").alias("hub"))
    of = store(of.drop("hub").join(many.where("p < q").select("key", "n", "hub"), "key"), "open")
    x, y = (of.where(F.col("n") <= FEW).select("key", F.col("class").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    rest = x.join(y, "key").where("ca <> cb and a < b").select("a", "b")
    # keys of many classes: their classes meet again through their differences from the key's hub
    crowd = of.where((F.col("n") > FEW) & (F.col("class") != F.col("hub.class"))).select(
        "class", F.col("hub.class").alias("hub"), (F.col("component") != F.col("hub.component")).alias("other"), "component").distinct()
    crowd = store(crowd, "crowd")
    near = crowd.where("other").select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b"))
    ranks = _ranks(texts.join(crowd.select("class").distinct(), "class", "left_semi"), size)
    # by class last, so that the classes of a hot hub are spread over all tasks
    crowd = crowd.join(texts.select(F.col("class").alias("hub"), F.col("zip").alias("zh")), "hub").join(texts.withColumnRenamed("zip", "zx"), "class")
    blocks = crowd.select("class", "hub", "other", "component", "zx", "zh").mapInArrow(_residuals(percent, size, 4 * parts, ranks), "bucket long, block binary")
    columns = ("key", "class", "component", "size", "own", "odd0", "odd1")
    differ = store(blocks.repartition(parts, "bucket").mapInArrow(_shared(*columns), ", ".join(f"{c} long" for c in columns)), "differ")
    x, y = (differ.select("key", *[F.col(k).alias(f"{c}_{k}") for k in columns[1:]]) for c in "xy")
    met = (x.join(y, "key").where("x_class < y_class and x_component <> y_component").where(
        f"{100 + percent} * greatest(abs(x_own - y_own) + abs(x_size - x_own - y_size + y_own), bit_count(x_odd0 ^ y_odd0) + bit_count(x_odd1 ^ y_odd1))"
        f" <= {100 - percent} * (x_size + y_size)")
           .select(F.col("x_class").alias("a"), F.col("y_class").alias("b")))
    rest = rest.unionByName(met).unionByName(near).distinct().join(star, ["a", "b"], "left_anti")
    links = store(links.unionByName(verified(store(rest, "rest"), "rest-links")), "links")

    part = connected_components(links).withColumnRenamed("node", "class")
    ends = links.select(F.col("a").alias("class")).unionByName(links.select(F.col("b").alias("class")))
    degree = ends.groupBy("class").agg(F.count("*").alias("n_links"))
    heads = info.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("low"))
    heads = heads.join(part, "class", "left").withColumn("component", F.coalesce("component", "class"))
    lows = heads.groupBy("component").agg(F.min("low").alias("component_id"))
    named = heads.join(lows, "component").select("class", "component_id").join(degree, "class", "left")
    return info.join(named, "class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))

