"""Operator 8: byte-level BPE encoding and decoding.

Each partition runs DuckDB in its own process: the bytes of every distinct
pre-token are token-position rows, joined with the merge table; a recursive
query contracts each word's leftmost pair of minimum rank until no pair can be
merged, and an ordered join with the vocabulary turns ids back into bytes.  A
partition solves each distinct pre-token once; texts then only look pieces up.
Rows go in and out as columns; Python makes no list of ids on the way.

Nothing is shuffled.  Memory of a task: the batch, plus a table of solved
pieces (``Memo``) of at most ``CACHE`` bytes.  Pre-tokens of more than
``LONG`` bytes (a text of 100,000 letters is one) would need one step of the
recursion for each merge; they are merged with a heap of pairs instead, by the
same rule.

Defined results: null is the empty text (0 tokens, digest of nothing); lone
surrogates can't occur in Parquet strings; repeated rows each get a row.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillhouse.llm.memo import Memo, fewer_collections, make_room

CHUNK = 60_000      # distinct pre-tokens solved by one recursive query, and
CHUNK_BYTES = 1_500_000  # their bytes; one pre-token may exceed it alone
CACHE = 192 << 20   # bytes of solved pieces a worker keeps
LONG = 600          # bytes

PIECE = re.compile(r" ?[^ \n]+|\n")
#: White space that touches a space, a line feed or an end of the text.
RUN = re.compile(r"\s(?:(?=[ \n])|\Z|(?<=[ \n]\s)|(?<=\A\s))")

STEP = """
with recursive step as (
  select false as done, word, pos, npos, tok, nxt from start
  union all (
  with pairs as materialized (
         select s.*, g.merged::bigint * 65536 + s.pos as k
         from step s left join merges g on g.l = s.tok and g.r = s.nxt where not done),
       best as (select word, min(k) as k from pairs group by word),
       act as materialized (
         select b.word, b.k, x.npos as gone, y.npos as after, y.nxt as follows
         from best b left join pairs x on x.word = b.word and x.k = b.k
                     left join pairs y on y.word = x.word and y.pos = x.npos)
  select a.k is null, p.word, p.pos,
         case when p.k = a.k then a.after else p.npos end,
         case when p.k = a.k then (a.k >> 16)::int else p.tok end,
         case when p.k = a.k then a.follows
              when p.npos = (a.k & 65535) then (a.k >> 16)::int else p.nxt end
  from pairs p join act a on a.word = p.word
  where p.pos is distinct from a.gone))
select word, tok from step where done order by word, pos"""

DECODE = "select v.bytes from tokens t join vocabulary v on v.id = t.id order by t.pos"


def _portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of at most CHUNK items of at most CHUNK_BYTES together."""
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and (i - start == CHUNK or held + n > CHUNK_BYTES):
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def _join(values, ends: np.ndarray, mark) -> list:
    """The values up to each end, joined."""
    import pyarrow.compute as pc
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)
    return pc.binary_join(lists, pa.scalar(mark, values.type)).to_pylist()


class Bpe:
    """Rank file, merge table and DuckDB connection of one Python worker."""

    _open: dict[tuple[str, str], "Bpe"] = {}

    @classmethod
    def get(cls, path: str, pattern: str) -> "Bpe":
        make_room("byte_bpe", cls.close)
        if (path, pattern) not in cls._open:
            cls._open[path, pattern] = cls(path, pattern)
        return cls._open[path, pattern]

    @classmethod
    def close(cls) -> None:
        """Drop the solved pieces, tables and connections of this worker."""
        for bpe in cls._open.values():
            bpe.memo = Memo(CACHE)
            bpe.db.close()
        cls._open.clear()

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        self.split = regex.compile(pattern).findall
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = {v: k for k, v in self.ranks.items()}
        rows = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items()
                for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        left, right, merged = np.array(rows, np.int32).T
        self.db = duckdb.connect()
        self.db.execute("set threads = 1; set memory_limit = '300MB'; set temp_directory = ''")
        merge_rows = pa.table({"l": left, "r": right, "merged": merged})  # noqa: F841 - read by name
        self.db.execute("create table merges as select * from merge_rows")
        vocab_rows = pa.table({"id": pa.array(list(self.tokens), pa.int32()),  # noqa: F841
                               "bytes": pa.array(list(self.tokens.values()), pa.binary())})
        self.db.execute("create table vocabulary as select * from vocab_rows")
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.names = pa.array([str(i) for i in range(max(self.tokens) + 1)])
        self.memo = Memo(CACHE)
        fewer_collections()

    # -- pieces -> ids ---------------------------------------------------------
    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens, one after the other, and where each ends."""
        whole = [(i, r) for i, w in enumerate(words) if (r := self.ranks.get(w)) is not None]
        found = [np.array(whole, np.int32).reshape(-1, 2).T]
        known, todo = {i for i, _ in whole}, []
        for i, w in enumerate(words):
            if i in known:
                continue
            if len(w) > LONG:
                ids = self.heap(w)
                found.append(np.array([[i] * len(ids), ids], np.int32))
            else:
                todo.append(i)
        for a, b in _portions([len(words[i]) for i in todo]):
            part = todo[a:b]
            lens = np.array([len(words[i]) for i in part])
            tok = self.byte[np.frombuffer(b"".join([words[i] for i in part]), np.uint8)]
            ends = np.cumsum(lens)
            pos = np.arange(len(tok)) - np.repeat(ends - lens, lens)
            last = np.zeros(len(tok), bool)
            last[ends - 1] = True
            start = pa.table({  # noqa: F841 - read by name
                "word": np.repeat(np.array(part, np.int32), lens), "pos": pos.astype(np.int32),
                "npos": np.where(last, -1, pos + 1).astype(np.int32), "tok": tok,
                "nxt": np.where(last, -1, np.roll(tok, -1)).astype(np.int32)})
            got = self.db.sql(STEP).to_arrow_table()
            found.append(np.stack([got["word"].to_numpy(), got["tok"].to_numpy()]))
        word, tok = np.concatenate(found, 1)
        return tok[np.argsort(word, kind="stable")], np.cumsum(np.bincount(word, minlength=len(words)))

    def solve(self, words: list[bytes]) -> list[list[int]]:
        """Ids of distinct pre-tokens, by the recursive query."""
        flat, ends = self.ids(words)
        flat, ends = flat.tolist(), ends.tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def heap(self, word: bytes) -> list[int]:
        """The same contraction for one very long pre-token."""
        n, rank, text = len(word), self.ranks.get, [word[i:i + 1] for i in range(len(word))]
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i, 2) for i in range(n - 1) if (r := rank(word[i:i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            r, i, size = heapq.heappop(queue)
            if text[i] is None or (j := nxt[i]) >= n or len(text[i]) + len(text[j]) != size or rank(text[i] + text[j]) != r:
                continue
            text[i] += text[j]
            text[j], nxt[i] = None, nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            for a in (prev[i], i):
                if a >= 0 and (b := nxt[a]) < n and (q := rank(text[a] + text[b])) is not None:
                    heapq.heappush(queue, (q, a, len(text[a]) + len(text[b])))
        return [self.ranks[t] for t in text if t is not None]

    # -- texts -----------------------------------------------------------------
    def parts(self, text: str) -> list[str]:
        """Pieces that split alike alone and in the text: a single space or
        newline between two other characters always starts a new pre-token.
        Texts with other runs of white space stay whole."""
        return [text] if RUN.search(text) else PIECE.findall(text)

    def learn(self, parts: set[str]) -> None:
        """Solve unseen parts together."""
        new = self.memo.missing(parts)
        if not new:
            return
        cut = [self.split(p) for p in new]
        words = list(dict.fromkeys(chain.from_iterable(cut)))
        flat, ends = self.ids([w.encode() for w in words])
        texts = _join(self.names.take(pa.array(flat)), ends, ",")
        solved = dict(zip(words, zip(texts, np.diff(ends, prepend=0).tolist(), self.bytes(flat, ends))))
        for p, ws in zip(new, cut):
            value = solved[ws[0]] if len(ws) == 1 else (
                ",".join([solved[w][0] for w in ws]), sum([solved[w][1] for w in ws]), b"".join([solved[w][2] for w in ws]))
            self.memo.put(p, value, len(p) + len(value[0]) + len(value[2]))

    def bytes(self, flat: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of the ids up to each end: an ordered join of token rows."""
        out, starts = [], np.concatenate([[0], ends])
        for a, b in _portions(np.diff(starts).tolist()):
            lo, hi = starts[a], starts[b]
            tokens = pa.table({"pos": np.arange(hi - lo, dtype=np.int32), "id": flat[lo:hi].astype(np.int32)})  # noqa: F841 - read by name
            out += _join(self.db.sql(DECODE).to_arrow_table()["bytes"], starts[a + 1:b + 1] - lo, b"")
        return out

    def decode(self, docs: list[list[int]]) -> list[bytes]:
        """Bytes of each list of ids."""
        return self.bytes(np.array([i for d in docs for i in d], np.int32), np.cumsum([len(d) for d in docs], dtype=np.int64))

    def encode(self, texts: list[str | None]) -> Iterator[list[tuple[str, int, bytes]]]:
        """For each text the solved parts it consists of."""
        self.memo.trim()
        rows = [self.parts(t) if t else [] for t in texts]
        self.learn(set().union(*rows))
        young = self.memo.young
        for r in rows:
            yield [young[p] for p in r]


def _batches(column: pa.Array, chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows of bounded size; one text may exceed it alone."""
    start, size = 0, 0
    for i, n in enumerate(column.to_numpy(zero_copy_only=False).tolist()):
        if size and size + (n or 0) > chars:
            yield start, i
            start, size = i, 0
        size += n or 0
    if start < len(column):
        yield start, len(column)


def _run(df: DataFrame, text: str, path: str, pattern: str, fields: list[T.StructField], row) -> DataFrame:
    own = {f.name for f in fields}
    keep = [c for c in df.columns if c != text and c not in own]
    schema = T.StructType([f for f in df.select(*keep).schema.fields] + fields)

    def work(batches):
        import pyarrow.compute as pc
        bpe = Bpe.get(path, pattern)
        for batch in batches:
            texts = batch.column(len(keep))
            for a, b in _batches(pc.fill_null(pc.utf8_length(texts), 0)):
                cols = list(zip(*[row(parts) for parts in bpe.encode(texts.slice(a, b - a).to_pylist())]))
                arrays = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                arrays += [pa.array(c, t) for c, t in zip(cols, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(f.dataType) for f in fields]
    return df.select(*keep, text).mapInArrow(work, schema)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, plus ``ids`` array<int> and ``n_tokens``."""
    return _run(df, text, path, pattern,
                [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())],
                lambda ps: ([int(i) for s, _, _ in ps for i in s.split(",")], sum(n for _, n, _ in ps)))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``bytes`` (binary) decoded from ``ids``; null ids decode to nothing."""
    keep = [c for c in df.columns if c not in (ids, "bytes")]
    schema = T.StructType(df.select(*keep).schema.fields + [T.StructField("bytes", T.BinaryType())])

    def work(batches):
        bpe = Bpe.get(path, pattern)
        for batch in batches:
            got = bpe.decode([x or [] for x in batch.column(len(keep)).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(got, pa.binary())],
                                             names=[f.name for f in schema])

    return df.select(*keep, ids).mapInArrow(work, schema)


def digests(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, plus n_tokens, ids_sha256 and decoded_sha256:
    encodes and decodes without building id arrays."""
    def row(ps):
        a, b, n = hashlib.sha256(), hashlib.sha256(), 0
        a.update(",".join([s for s, _, _ in ps]).encode())
        b.update(b"".join([x for _, _, x in ps]))
        n = sum([k for _, k, _ in ps])
        return n, a.hexdigest(), b.hexdigest()

    return _run(df, text, path, pattern,
                [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                 T.StructField("decoded_sha256", T.StringType())], row)
