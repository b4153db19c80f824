"""Operator 12: cross-tokenizer alignment.

A is a byte-level BPE file of the ``tokenizers`` library, B a sentencepiece
model.  Each text is encoded by both; the cumulative byte ends of either
side's tokens are dictionaries from end to index, the intersection of their keys
is sorted, and each pair of neighbouring common ends slices both id lists into a
group.  Inside a group no other end is common, so each end of either side ends
one link, an overlap of two tokens' byte ranges.

A text is aligned in units that start at a space or a line feed after another
character.  Both tokenizers end a token there (A by its word cut; B because no
piece of the model has a space or line feed after another character, which is
checked when the model is opened), so units are aligned alone, each distinct one
once, and a text's groups are those of its units in order.

How many documents hold an id pair linked is counted over the whole corpus:

1. Each task packs neighbouring documents into blocks (``block_chars``
   characters).  A block's distinct pairs are a row each, with the number of
   its documents that hold them, and so are its documents, whose pairs are
   indices into that list, as bytes.  Spark reads, sorts and sends many rows at
   once, so none holds a whole block.  The table is stored in the shared folder.
2. The pairs of all blocks are summed (one row for each block and pair, so a pair
   that every document has costs one row a block), and marked if they are the
   most frequent of their A id.
3. Counts go back to the blocks by pair, meet each block's documents, and
   their sums follow.

No group is larger than a block or B's vocabulary; nothing reaches the driver.

Defined results: texts that are null or empty, or that one side does not give
back byte for byte, have no tokens (zeros and an empty group column); strings of
special tokens are plain text; repeated rows and repeated keys count as a
document each; an empty table gives an empty one.  Only the key column and the
results are returned, so other columns cannot clash; very long texts are blocks
of their own.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import distinct, store
from tillhouse.llm.memo import Memo, fewer_collections, give_back, slices

UNIT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
AT_ONCE = 50_000                 # units aligned in one go
SLICE = 500_000                  # characters of a block whose units are held at once
UNITS = 96 << 20                 # bytes of aligned units a worker keeps
PORTION = 200_000                # tokens whose bytes are compared at once
SHIFT = 32                       # a pair is the A id, shifted, and the B id


#: Fields of a solved unit.
*COUNTS, TEXT, PAIRS = map(itemgetter, range(6))


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """The common ends of two ascending lists of cumulative ends, and each
    one's exclusive index on both sides: these slice the tokens into groups."""
    of_a = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1)))
    of_b = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1)))
    common = sorted(of_a.keys() & of_b.keys())
    return common, [of_a[e] for e in common], [of_b[e] for e in common]


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends and indices of all token pairs whose byte ranges overlap.  Inside a
    slice the overlap of two tokens ends where the first of them does, and each
    end of either side ends exactly one overlap."""
    ends = distinct(np.concatenate([a_ends, b_ends]))
    return ends, np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def spelled(ids: np.ndarray, sizes: np.ndarray, spellings: np.ndarray, whole: np.ndarray) -> bool:
    """Whether the tokens' bytes are ``whole``; sizes and spellings (one after the other) are by id."""
    first, at = np.cumsum(sizes) - sizes, 0
    for k in range(0, len(ids), PORTION):
        part = ids[k:k + PORTION]
        n = sizes[part]
        ends = np.cumsum(n)
        got = spellings[np.repeat(first[part] - ends + n, n) + np.arange(ends[-1])]
        if not np.array_equal(got, whole[at:at + len(got)]):
            return False
        at += len(got)
    return at == len(whole)


def joined(names: pa.Array, ends, mark: str) -> pa.Array:
    """The names up to each end, joined."""
    at = pa.array(np.concatenate([[0], np.asarray(ends, np.int64)]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(at, names), mark)


class Aligner:
    """Both tokenizers and the aligned units of one Python worker."""

    _open: dict[tuple[str, str], "Aligner"] = {}

    @classmethod
    def get(cls, path_a: str, path_b: str) -> "Aligner":
        if (path_a, path_b) not in cls._open:
            cls._open[path_a, path_b] = cls(path_a, path_b)
        return cls._open[path_a, path_b]

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        # the printable stand-ins of byte-level BPE: printable bytes are themselves, the others follow from 256 on
        same = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in same]
        byte = {chr(x): x for x in same} | {chr(256 + i): x for i, x in enumerate(rest)}
        self.a_bytes = {i: bytes([byte[c] for c in t]) for t, i in self.a.get_vocab(False).items() if all(c in byte for c in t)}
        self.b_bytes, whole = {}, []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes[i] = bytes([int(piece[3:-1], 16)])
            else:
                self.b_bytes[i] = piece.replace("▁", " ").encode()
                whole.append(piece.replace("▁", " "))
        spellings = [[t.get(i, b"") for i in range(max(max(t) + 1, n))] for t, n in (
            (self.a_bytes, self.a.get_vocab_size(True)), (self.b_bytes, self.b.vocab_size()))]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in xs]) for xs in spellings)
        # all tokens' bytes one after the other
        self.a_raw, self.b_raw = (np.frombuffer(b"".join(xs), np.uint8) for xs in spellings)
        self.names = pa.array([str(i) for i in range(max(map(len, spellings)))])
        self.by_unit = not any(re.search(r"\S[ \n]", p) or "\n" in p for p in whole)
        self.space = self.b.piece_to_id("▁")
        self.units = Memo(UNITS)
        fewer_collections()

    def solve(self, units: list[str]):
        """(n_a, n_b, number of groups, number of links, groups as text, pairs
        as 64-bit integers) of each unit; None where a side does not give
        the unit's bytes back.  The units are aligned in one go, as one text."""
        a_ids = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        # the model puts a space before a text that is not empty; a unit that starts with a line feed loses it again
        b_ids = self.b.encode([u if u[0] != " " else u[1:] for u in units], num_threads=1)
        b_ids = [b if u[0] == " " and u != " " else [self.space] if u == " " else b[1:] if b[:1] == [self.space] else []
                 for u, b in zip(units, b_ids)]
        raw = [u.encode("utf-8", "surrogatepass") for u in units]
        out: list[tuple | None] = [None] * len(units)
        good = range(len(units))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
        whole = np.frombuffer(b"".join(raw), np.uint8)
        if not (spelled(a, self.a_sizes, self.a_raw, whole) and spelled(b, self.b_sizes, self.b_raw, whole)):
            good = [i for i in good if self.equal(a_ids[i], b_ids[i], raw[i])]
            if not good:
                return out
            a, b = (np.fromiter(chain.from_iterable([ids[i] for i in good]), np.int64) for ids in (a_ids, b_ids))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        common, a_cuts, b_cuts = groups(a_ends, b_ends)
        texts = pc.binary_join_element_wise(joined(self.names.take(pa.array(a)), a_cuts, ","),
                                            joined(self.names.take(pa.array(b)), b_cuts, ","), "|")
        ends, left, right = links(a_ends, b_ends)
        pairs = (a[left] << SHIFT | b[right]).tobytes()
        stops = np.cumsum([len(raw[i]) for i in good])
        g_at, l_at = np.searchsorted(common, stops, "right").tolist(), np.searchsorted(ends, stops, "right").tolist()
        g, n = 0, 0
        for i, g_end, n_end, text in zip(good, g_at, l_at, joined(texts, g_at, ";").to_pylist()):
            out[i] = (len(a_ids[i]), len(b_ids[i]), g_end - g, n_end - n, text, pairs[8 * n:8 * n_end])
            g, n = g_end, n_end
        return out

    def equal(self, a_ids: list[int], b_ids: list[int], raw: bytes) -> bool:
        """Whether both sides give the bytes of a unit back."""
        return all(b"".join([table.get(i, b"") for i in ids]) == raw
                   for ids, table in ((a_ids, self.a_bytes), (b_ids, self.b_bytes)))

    @classmethod
    def forget(cls) -> None:
        """Drop the aligned units of this worker, which later steps do not need, and give their memory back."""
        held = [x for x in cls._open.values() if x.units.young or x.units.old]
        for aligner in held:
            aligner.units = Memo(UNITS)
        if held:
            give_back()

    def texts(self, texts: list[str | None]):
        """For each text the solved units, or nothing if it has no tokens."""
        self.units.trim()
        rows = [([] if not t else UNIT.findall(" " + t) if self.by_unit else [" " + t]) for t in texts]
        new = self.units.missing(set().union(*rows))
        for at in range(0, len(new), AT_ONCE):
            part = new[at:at + AT_ONCE]
            for unit, value in zip(part, self.solve(part)):
                self.units.put(unit, value, 4 * len(unit) + (len(value[4]) + len(value[5]) if value else 0))
        held = self.units.young
        for row in rows:
            found = list(map(held.__getitem__, row))
            yield found if all(found) else []          # a solved unit is a tuple, others are None


ROW = T.StructType([
    T.StructField("block", T.LongType()),
    # a distinct pair of the block: its place in their ascending order (rows without are documents), how many documents hold it
    T.StructField("pos", T.IntegerType()), T.StructField("pair", T.LongType()), T.StructField("docs", T.IntegerType()),
    # a document of the block
    T.StructField("key", T.LongType()), *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")],
    T.StructField("groups_sha256", T.StringType()),
    T.StructField("at", T.BinaryType()),                        # places of its distinct pairs
    T.StructField("times", T.BinaryType())])                    # its links with each


def packed(values: np.ndarray, top: int, ends: np.ndarray) -> pa.Array:
    """The values up to each end as bytes, in the smallest unsigned type that holds ``top``."""
    values = values.astype(np.min_scalar_type(top))
    offsets = (np.concatenate([[0], ends]) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def blocks(df: DataFrame, path_a: str, path_b: str, key: str, text: str, block_chars: int) -> DataFrame:
    """A batch for each run of documents with about ``block_chars`` characters:
    a row for each distinct pair, then one for each document."""
    def work(batches):
        number, aligner = 0, Aligner.get(path_a, path_b)
        for batch in batches:
            keys, column = batch.column(0), batch.column(1)
            for lo, hi in slices(column, block_chars):
                own, totals, shas = [], ([], [], [], []), []
                for a, b in slices(column.slice(lo, hi - lo), SLICE):
                    for units in aligner.texts(column.slice(lo + a, b - a).to_pylist()):
                        codes, times = np.unique(np.frombuffer(b"".join(map(PAIRS, units)), np.int64), return_counts=True)
                        own.append((codes, times.astype(np.int32)))
                        for k, total in enumerate(totals):
                            total.append(sum(map(COUNTS[k], units)))
                        shas.append(hashlib.sha256(";".join(map(TEXT, units)).encode()).hexdigest() if units else "")
                ends, times = np.cumsum([len(c) for c, _ in own]), np.concatenate([n for _, n in own])
                codes = np.concatenate([c for c, _ in own])
                own.clear()
                pairs, at, held = np.unique(codes, return_inverse=True, return_counts=True)
                block = np.full(len(pairs) + hi - lo, TaskContext.get().partitionId() << 32 | number)
                of_pairs = np.arange(len(pairs), dtype=np.int32), pairs, held.astype(np.int32)
                of_docs = (keys.slice(lo, hi - lo), *totals, shas, packed(at, len(pairs), ends),
                           packed(times, int(times.max(initial=0)), ends))
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block),
                     *[pa.concat_arrays([pa.array(x), pa.nulls(hi - lo, kind)]) for x, kind in zip(of_pairs, kinds[1:4])],
                     *[pa.concat_arrays([pa.nulls(len(pairs), kind), x if isinstance(x, pa.Array) else pa.array(x, kind)])
                       for x, kind in zip(of_docs, kinds[4:])]], names=ROW.names)

    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in ROW]
    return df.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")).mapInArrow(work, ROW)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold each pair linked, and whether
    no pair of its A id is held by more.  A window's group has at most as many
    rows as B has ids."""
    count = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", SHIFT)))
    return count.select("pair", "count", (F.col("count") == most).alias("best"))


def align(df: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
          block_chars: int = 4_000_000) -> DataFrame:
    """One row per document: ``key``, n_a, n_b, n_groups, n_links, n_best,
    count_sum and groups_sha256."""
    table = store(blocks(df, path_a, path_b, key, text, block_chars), "blocks")
    pairs, docs = table.where("pos is not null").select("block", "pos", "pair", "docs"), table.where("pos is null")
    known = (pairs.select("block", "pos", "pair").join(pair_counts(pairs), "pair")
                  .select(F.col("block").alias("of"), "pos", (F.shiftleft("count", 1) + F.col("best").cast("long")).alias("known")))
    own = T.StructType([T.StructField(key, T.LongType()),
                        *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
                        T.StructField("groups_sha256", T.StringType())])

    def finish(docs, pairs):
        Aligner.forget()
        n = pairs.num_rows
        known = np.empty(n, np.int64)
        known[pairs.column("pos").to_numpy()] = pairs.column("known").to_numpy()
        at, times = (b"".join(docs.column(c).to_pylist()) for c in ("at", "times"))
        at = np.frombuffer(at, np.min_scalar_type(n))
        times = np.frombuffer(times, f"u{len(times) // max(1, len(at)) or 1}").astype(np.int64)
        cuts = np.concatenate([[0], np.cumsum(pc.binary_length(docs.column("at")).to_numpy()) // at.itemsize])
        best, total = (np.diff(np.concatenate([[0], np.cumsum(times * x[at])])[cuts]) for x in (known & 1, known >> 1))
        columns = [docs.column(c) for c in ("key", "n_a", "n_b", "n_groups", "n_links")]
        return pa.Table.from_arrays([*columns, pa.array(best), pa.array(total), docs.column("groups_sha256")], names=own.names)

    rows = docs.select("block", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times")
    return rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(finish, own)
