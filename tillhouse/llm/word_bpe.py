"""Operator 11: BPE encoding and decoding with a segment tree.

A word's symbols are the leaves' left ends: leaf i holds the rank of the merge
of symbol i with the symbol after it, packed with i, so that the smallest value
is the lowest rank and, among equal ranks, the leftmost place.  The root of the
tree is therefore the next merge.  A merge changes three leaves, each in a
logarithmic number of steps, until the root holds no merge.

The rules come from a file of the ``tokenizers`` library (merges, vocabulary,
word-end mark, added tokens, normaliser, pre-tokenizer); the library itself only
normalises and cuts words, the merges and the decoding are done here.  White
space is dropped by the word cut and never takes part in the normaliser's
compositions, so each run of other characters is solved once and remembered.

Nothing is shuffled.  Memory of a task: a slice of texts and the remembered
runs, bounded by bytes (``Memo``).  A run of any length is encoded whole: n
symbols cost O(n log n).

Defined results: null is the empty text (no ids; digests of nothing); strings of
the added tokens inside a text become those tokens, as in the library; repeated
rows each get a row; an empty table gives an empty one; columns named like an
output are replaced, all others pass through; rows of equal content get equal
results, so there are no ties to break.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.memo import Memo, fewer_collections, text_columns

#: The Unicode white space (``\\s`` of the normaliser and the word cut).
SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
RUNS = re.compile("[^" + "".join(map(chr, SPACES)) + "]+")

#: Fixed value: normaliser and word cut under which a text may be cut at white
#: space; with any other pair a text is solved as a whole.
CUT_AT_SPACE = (
    ["NFC", "Replace", "Lowercase"],
    "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")

#: The same cut for printable ASCII in lower case, which byte-level BPE leaves as it is.
ASCII_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall

PLACES = 40                     # bits of a place in a packed leaf
NONE = 1 << 62                  # no merge
SHORT = 64                      # symbols of a word up to which words are merged side by side


class MergeTree:
    """Segment tree over the ranks of adjacent pairs of one word's symbols."""

    def __init__(self, symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]], made: list[int]):
        self.ids, self.ranks, self.made = symbols, ranks, made
        n = len(symbols)
        self.after, self.before = list(range(1, n + 1)), list(range(-1, n - 1))
        self.size = 1 << max(n - 2, 0).bit_length()
        self.tree = tree = [NONE] * (2 * self.size)
        for i in range(n - 1):
            got = ranks.get((symbols[i], symbols[i + 1]))
            if got is not None:
                tree[self.size + i] = got[0] << PLACES | i
        for i in range(self.size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def update(self, place: int, value: int) -> None:
        """Set one leaf and the minima above it."""
        tree, i = self.tree, self.size + place
        tree[i] = value
        while i > 1:
            i >>= 1
            low = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == low:
                break
            tree[i] = low

    def pair(self, place: int) -> int:
        """The leaf of a symbol and the one after it."""
        j = self.after[place]
        got = self.ranks.get((self.ids[place], self.ids[j])) if j < len(self.ids) else None
        return NONE if got is None else got[0] << PLACES | place

    def run(self) -> list[int]:
        """Merge until the root holds no merge; the symbols that are left."""
        ids, after, before, tree = self.ids, self.after, self.before, self.tree
        n = len(ids)
        while (root := tree[1]) != NONE:
            i = root & (1 << PLACES) - 1
            j = after[i]
            ids[i] = self.made[root >> PLACES]
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            if j < n - 1:
                self.update(j, NONE)
            self.update(i, self.pair(i))
            if (h := before[i]) >= 0:
                self.update(h, self.pair(h))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out


def merge_side_by_side(words: list[list[int]], leaves, made: np.ndarray) -> list[list[int]]:
    """``MergeTree`` of many short words at once: a row for each word, and each
    step takes the root of every row that still has a merge.

    ``leaves(left, right, places)`` packs the ranks of pairs; -1 is no symbol."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    n, longest = len(words), int(lens.max())
    size = 1 << (longest - 1).bit_length()
    ids = np.full((n, longest + 1), -1, np.int64)
    ids[:, :longest][np.arange(longest) < lens[:, None]] = np.fromiter(
        (x for w in words for x in w), np.int64, int(lens.sum()))
    after = np.tile(np.arange(1, longest + 2), (n, 1))
    before = np.tile(np.arange(-1, longest), (n, 1))
    tree = np.full((n, 2 * size), NONE, np.int64)
    tree[:, size:size + longest] = leaves(ids[:, :-1], ids[:, 1:], np.arange(longest))
    for i in range(size - 1, 0, -1):
        tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])

    def update(rows, places, values):
        at = size + places
        tree[rows, at] = values
        for _ in range(size.bit_length() - 1):
            at = at >> 1
            tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

    rows = np.arange(n)
    while len(rows := rows[tree[rows, 1] != NONE]):
        root = tree[rows, 1]
        i = root & (1 << PLACES) - 1
        j = after[rows, i]
        k = after[rows, j]
        ids[rows, i], ids[rows, j] = made[root >> PLACES], -1
        after[rows, i], before[rows, k] = k, i
        update(rows, j, NONE)
        update(rows, i, leaves(ids[rows, i], ids[rows, k], i))
        h = before[rows, i]
        some = h >= 0
        r, h, i = rows[some], h[some], i[some]
        update(r, h, leaves(ids[r, h], ids[r, i], h))
    left = ids >= 0
    ends, flat = np.cumsum(left.sum(axis=1)).tolist(), ids[left].tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def joined(parts: list[tuple[int, str, str]]) -> tuple[int, str, str]:
    """The solved text that consists of solved parts."""
    if not parts:
        return 0, "", ""
    counts, ids, back = zip(*parts)
    return sum(counts), " ".join(ids), " ".join(back)


class WordBpe:
    """Rules of one file, and what a Python worker has solved by them."""

    _open: dict[str, "WordBpe"] = {}

    @classmethod
    def get(cls, path: str) -> "WordBpe":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec.get("added_tokens") or []
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "fuse_unk")
               if model.get(k)]
        odd += [k for t in added for k in ("single_word", "lstrip", "rstrip", "normalized") if t.get(k)]
        if model["type"] != "BPE" or odd or spec.get("decoder") or spec.get("post_processor"):
            raise ValueError(f"{path}: not a plain BPE file ({', '.join(odd) or model['type']})")
        self.vocab, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in added}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        self.made = [self.vocab[a + b] for a, b in pairs]
        self.ranks = {(self.vocab[a], self.vocab[b]): (r, 0) for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.base = max(self.tokens) + 2
        codes = np.array([self.code(a, b) for a, b in self.ranks], np.int64)
        order = np.argsort(codes)
        self.codes, self.code_ranks = codes[order], np.array([r for r, _ in self.ranks.values()], np.int64)[order]
        tok = Tokenizer.from_file(path)
        self.normal = tok.normalizer.normalize_str if tok.normalizer else lambda s: s
        self.cut = tok.pre_tokenizer.pre_tokenize_str if tok.pre_tokenizer else lambda s: [(s, None)]
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        added_names = re.compile(f"({'|'.join(names)})" if names else "(?!)")
        self.find, self.split = added_names.search, added_names.split
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        found = ([n["type"] for n in norm.get("normalizers", [])],
                 ((pre.get("pretokenizers") or [{}])[0].get("pattern") or {}).get("Regex"))
        self.by_run = found == CUT_AT_SPACE and not any(re.search(r"\s", s) for s in self.special)
        self.runs, self.words = Memo(160 << 20), Memo(160 << 20)
        fewer_collections()

    def code(self, left, right):
        return (left + 1) * self.base + right + 1

    def leaves(self, left, right, places):
        """Packed ranks of pairs of ids, as ``MergeTree`` holds them."""
        code = self.code(left, right)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.code_ranks[at] << PLACES | places, NONE)

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of words as the pre-tokenizer gives them."""
        vocab, end = self.vocab, self.end
        out = [[*[vocab[c] for c in w[:-1]], vocab[w[-1] + end]] for w in words]
        groups: dict[int, list[int]] = {}
        for i, symbols in enumerate(out):
            if len(symbols) > SHORT:
                out[i] = MergeTree(symbols, self.ranks, self.made).run()
            elif len(symbols) > 1:
                groups.setdefault((len(symbols) - 1).bit_length(), []).append(i)
        made = np.array(self.made, np.int64)
        for at in groups.values():
            for i, ids in zip(at, merge_side_by_side([out[i] for i in at], self.leaves, made)):
                out[i] = ids
        return out

    def words_of(self, runs: list[str]) -> list[list[str]]:
        """The words of runs without added tokens."""
        if not self.by_run:
            return [[word for word, _ in self.cut(self.normal(r))] for r in runs]
        out = [ASCII_WORDS(r.lower()) if r.isascii() and r.isprintable() else [] for r in runs]
        rest = [i for i, ws in enumerate(out) if not ws]
        # the others are normalised and cut together, with spaces between
        text = self.normal(" ".join([runs[i] for i in rest]))
        parts = text.split(" ")
        if len(parts) != len(rest):
            parts = [self.normal(runs[i]) for i in rest]
            text = " ".join(parts)
        cut = self.cut(text)
        at = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), [s for _, (s, _) in cut], "right")
        for (word, _), i in zip(cut, at.tolist()):
            out[rest[i]].append(word)
        return out

    def solved_words(self, words: set[str]) -> None:
        """Remember (count, ids as text, decoded text) of each word."""
        new = self.words.missing(words)
        for word, ids in zip(new, self.merge(new)):
            text, back = " ".join(map(str, ids)), self.decode(ids)
            self.words.put(word, (len(ids), text, back), 4 * len(word) + len(text) + 2 * len(back))

    def solved(self, runs: list[str]):
        """(count, ids as text, decoded text) of runs, or of whole texts where
        runs can't be told apart."""
        some = [self.split(r) for r in runs] if self.find(" ".join(runs)) else [[r] for r in runs]
        cut = [[p for p in parts if p] for parts in some]
        words = self.words_of([p for parts in cut for p in parts if p not in self.special])
        self.solved_words({w for ws in words for w in ws})
        held, of = self.words.young, iter(words)
        for parts in cut:
            found = [x for p in parts for x in ([(1, str(self.special[p]), p)] if p in self.special else [held[w] for w in next(of)])]
            yield found[0] if len(found) == 1 else joined(found)

    def decode(self, ids) -> str:
        """The text the library's ``decode(ids, skip_special_tokens=False)``
        gives without a decoder: the tokens with spaces between; ids that
        the file does not have are left out."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])

    def solve(self, texts: list[str | None]):
        """(count, ids as text, decoded text) of each text."""
        self.runs.trim()
        self.words.trim()
        rows = [([] if not t else RUNS.findall(t) if self.by_run else [t]) for t in texts]
        new = self.runs.missing(set().union(*rows))
        for run, value in zip(new, self.solved(new)):
            self.runs.put(run, value, 4 * len(run) + len(value[1]) + 2 * len(value[2]))
        held = self.runs.young
        for row in rows:
            yield joined([held[r] for r in row])


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, plus ``ids`` array<int> and ``n_tokens``."""
    def make():
        def run(texts):
            found = list(WordBpe.get(path).solve(texts))
            return [[int(i) for i in ids.split()] for _, ids, _ in found], [n for n, _, _ in found]
        return run

    return text_columns(df, text, [T.StructField("ids", T.ArrayType(T.IntegerType())),
                                   T.StructField("n_tokens", T.LongType())], make)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``, the text that ``ids`` decode to; null ids to ''."""
    @F.pandas_udf(T.StringType())
    def back(column):
        rules = WordBpe.get(path)
        return column.map(lambda x: rules.decode([] if x is None else x))

    return df.withColumn(out, back(F.col(f"`{ids}`")))


def digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, plus n_tokens, ids_sha256 (ids joined by one
    space) and decoded_sha256 (of the decoded text in UTF-8)."""
    def make():
        def sha(text):
            return hashlib.sha256(text.encode()).hexdigest()

        def run(texts):
            return zip(*[(n, sha(ids), sha(back)) for n, ids, back in WordBpe.get(path).solve(texts)])
        return run

    return text_columns(df, text, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                                   T.StructField("decoded_sha256", T.StringType())], make)
