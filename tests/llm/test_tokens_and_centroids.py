"""Operators 11 to 13 against brute force and the tokenizer libraries, with nulls,
empty and long texts, ties and repeated rows, empty tables, clashing columns."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

ODD = [" ", "\n", "\t", "  ", "\r\n", "\r", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<0x0A>", "'s", "'LL", "é", "é",
       "İ", "Σ", "ß", "the", "日本語", "\U0001F44D\U0001F3FD", "1234", "!!", "\x1c", "\xa0", "　", "word", "▁",
       "क्षि", "\x0b", "\n\n", "    ", "):", "ing", "ﬁ", "́", "wordwordword"]


def odd_texts(n, seed=1):
    r = random.Random(seed)
    out = ["".join(r.choice(ODD) for _ in range(r.randrange(0, 16))) for _ in range(n)]
    return out + [None, "", " ", "\n", "a ", "ab" * 9000, "lorem ipsum dolor " * 2500, "same text here", "same text here"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, -1, "kept", "x") for i, t in enumerate(odd_texts(400))] + [(None, "no id", -1, "kept", "x"), (3, "twice", -1, "kept", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, block string, pairs string").repartition(5)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---- operator 11 --------------------------------------------------------------
def test_word_bpe_matches_the_library(odd):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from tillhouse.llm.word_bpe import decode, digests, encode
    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    out = digests(odd, path)
    assert sorted(out.columns) == sorted(["doc_id", "block", "pairs", "n_tokens", "ids_sha256", "decoded_sha256"])
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect())
    want, texts = Counter(), Counter()
    for r in odd.collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want[r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(text)] += 1
        texts[r["doc_id"], tuple(ids), text] += 1
    assert got == want
    both = decode(encode(odd, path), path)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in both.collect()) == texts
    none = digests(odd.where("false"), path)
    assert none.columns == out.columns and none.count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_segment_tree_takes_the_leftmost_lowest_rank(seed):
    import numpy as np

    from tillhouse.llm.word_bpe import NONE, PLACES, MergeTree, merge_side_by_side
    r = random.Random(seed)
    pairs, top = [], 5                       # symbols 0..4, then one new symbol a merge
    for _ in range(40):
        p = (r.randrange(top), r.randrange(top))
        if p not in pairs:
            pairs.append(p)
            top += 1
    ranks = {p: (i, 0) for i, p in enumerate(pairs)}
    made = list(range(5, top))

    def brute(w):
        w = list(w)
        while found := [(pairs.index(p), i) for i, p in enumerate(zip(w, w[1:])) if p in ranks]:
            rank, i = min(found)
            w[i:i + 2] = [made[rank]]
        return w

    def leaves(left, right, places):
        look = np.vectorize(lambda a, b, i: ranks[a, b][0] << PLACES | i if (a, b) in ranks else NONE, otypes=[np.int64])
        return look(left, right, np.broadcast_to(places, left.shape))

    words = [[r.randrange(5) for _ in range(r.randrange(2, 30))] for _ in range(150)]
    want = [brute(w) for w in words]
    assert [MergeTree(list(w), ranks, made).run() for w in words] == want
    assert merge_side_by_side(words, leaves, np.array(made)) == want


def test_memo_bounds_change_no_result():
    import public_tokenizers as P

    from tillhouse.llm.memo import Memo
    from tillhouse.llm.word_bpe import WordBpe
    rules = WordBpe(P.path("word_bpe_49k.json"))
    texts = [t for t in odd_texts(60, 5)]
    full = list(rules.solve(texts))
    rules.runs, rules.words = Memo(4000), Memo(4000)
    assert [x for t in texts for x in rules.solve([t])] == full
    assert rules.runs.held < 200_000


# ---- operator 12 --------------------------------------------------------------
def brute_alignment(rows):
    """Whole texts through the libraries, every pair of tokens compared."""
    import public_tokenizers as P

    from tillhouse.llm.alignment import Aligner
    al = Aligner.get(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    docs = []
    for key, t in rows:
        item = (0, 0, [], [])
        if t:
            raw = (" " + t).encode()
            a, b = al.a.encode(" " + t, add_special_tokens=False).ids, al.b.encode(t)
            sides = []
            for ids, table in ((a, al.a_bytes), (b, al.b_bytes)):
                at, out = 0, []
                for i in ids:
                    out.append((i, at, at + len(table[i])))
                    at += len(table[i])
                sides.append(out)
            if all(b"".join(table[i] for i in ids) == raw for ids, table in ((a, al.a_bytes), (b, al.b_bytes))):
                common = sorted({e for _, _, e in sides[0]} & {e for _, _, e in sides[1]})
                groups = ["|".join(",".join(str(i) for i, _, e in side if s < e <= c) for side in sides) for s, c in zip([0, *common], common)]
                low, found = 0, []
                for i, x, y in sides[0]:
                    while sides[1][low][2] <= x:
                        low += 1
                    k = low
                    while k < len(sides[1]) and sides[1][k][1] < y:
                        found.append((i, sides[1][k][0]))
                        k += 1
                item = (len(a), len(b), groups, found)
        docs.append((key, item))
    count = Counter(p for _, item in docs for p in set(item[3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return Counter((key, n_a, n_b, len(g), len(l), sum(count[p] == most[p[0]] for p in l), sum(count[p] for p in l),
                    sha(";".join(g)) if n_a else "") for key, (n_a, n_b, g, l) in docs)


def aligned(df, **kw):
    import public_tokenizers as P

    from tillhouse.llm.alignment import align
    return align(df, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), **kw)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("chars", [200, 4_000_000])
def test_alignment_equals_brute_force(odd, chars):
    out = aligned(odd, block_chars=chars)
    assert out.columns == COLUMNS
    got = Counter(tuple(r[c] for c in COLUMNS) for r in out.collect())
    assert got == brute_alignment([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_alignment_of_driver_texts_and_empty_tables(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = Counter(tuple(r[c] for c in COLUMNS) for r in aligned(docs).collect())
    assert got == brute_alignment([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert aligned(odd.where("false")).collect() == []
    blank = odd.where("text is null or text = ''")
    assert Counter(map(tuple, aligned(blank).collect())) == Counter((r["doc_id"], 0, 0, 0, 0, 0, 0, "") for r in blank.collect())


def test_groups_and_links():
    import numpy as np

    from tillhouse.llm.alignment import groups, links
    a, b = np.array([1, 4, 6, 9]), np.array([2, 3, 4, 9])
    assert groups(a, b) == ([4, 9], [2, 4], [3, 4])
    ends, left, right = links(a, b)
    assert list(zip(left.tolist(), right.tolist())) == [(0, 0), (1, 0), (1, 1), (1, 2), (2, 3), (3, 3)]


# ---- operator 13 --------------------------------------------------------------
def brute_clusters(rows, dims=64, k=16, rounds=3):
    import math
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]))
    centres = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(kept, at) if c == n]
            if mine:
                centres[n] = [sum(col) // len(mine) for col in zip(*mine)]
    at = assign()
    total = Counter()
    for d, c in at:
        total[c] += d
    return Counter((i, c, d, total[c], sum(total.values()), sha(",".join(map(str, centres[c])))) for (i, _), (d, c) in zip(kept, at))


VEC = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def clustered(df, **kw):
    from tillhouse.llm.centroids import cluster
    out = cluster(df, **kw)
    assert out.columns == VEC
    return Counter(tuple(r) for r in out.collect())


def vectors(seed, n, spread=1.0):
    r = random.Random(seed)
    middles = [[r.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    return [(i, [m + r.gauss(0, spread) for m in r.choice(middles)]) for i in range(n)]


def test_clusters_equal_brute_force(spark):
    rows = vectors(1, 300, 0.2)
    v = rows[0][1]
    rows += [(300, None), (301, []), (302, v[:63]), (303, v + [0.0]), (304, [None] + v[1:]), (305, [float("nan")] + v[1:]),
             (306, [float("inf")] + v[1:]), (307, [float("-inf")] + v[1:]), (5, rows[5][1]), (5, rows[9][1]), (None, v), (308, [0.0] * 64),
             (309, [-1e-9] * 64), (310, [9999.25] * 64)]
    rows += [(400 + i, rows[20][1]) for i in range(60)]                          # a group of equal vectors
    df = spark.createDataFrame([(i, x, 1, [0], "y") for i, x in rows],
                               "vec_id long, embedding array<double>, cluster int, point array<int>, far string").repartition(4)
    assert clustered(df) == brute_clusters(rows)
    assert clustered(df.where("vec_id < 9"), pivots=3) == brute_clusters([r for r in rows if r[0] is not None and r[0] < 9])  # fewer than k
    assert clustered(df.where("vec_id = 300")) == Counter()
    assert clustered(df.where("false")) == Counter()


def test_ties_go_to_the_smaller_centroid(spark):
    rows = [(i, [(i % 4) / 64.0] * 64) for i in range(64)]                       # four points, sixteen centres
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert clustered(df) == brute_clusters(rows)


def test_too_large_components_are_an_error(spark):
    from tillhouse.llm.centroids import cluster
    df = spark.createDataFrame([(1, [2.0 ** 30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="no exact 64-bit distance"):
        cluster(df).collect()


def test_pivots_spare_distances_and_lose_none():
    import numpy as np

    from tillhouse.llm.centroids import _distances, nearest
    rows = np.floor(64 * np.array([v for _, v in vectors(2, 400, 0.05)])).astype(np.int64)
    centres = rows[:16].copy()
    at, best, measured = nearest(rows, _distances(rows, centres[:8]), centres, _distances(centres, centres[:8]))
    full = ((rows[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (at == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert measured < 0.6 * full.size


def test_clusters_of_driver_vectors_match_sql(spark):
    import duckdb

    from tillhouse.llm.oracles import OP13
    from tillhouse.llm.queries import op13_centroid_clusters
    con = duckdb.connect()
    con.execute("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    rel = con.execute(OP13)
    at = [[d[0] for d in rel.description].index(c) for c in VEC]
    want = Counter(tuple(r[i] for i in at) for r in rel.fetchall())
    got = Counter(tuple(r[c] for c in VEC) for r in op13_centroid_clusters(spark, "/root/testdata/sf0.001").collect())
    assert got == want and got


def test_alignment_holds_a_slice_of_a_block_at_once(spark, monkeypatch):
    """A block's documents are aligned in slices; the block and its pairs are the same, and later steps drop the units."""
    from types import SimpleNamespace

    import public_tokenizers as P
    import pyarrow as pa

    from tillhouse.llm import alignment
    paths = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    texts = odd_texts(60, 9) + ["plain words here " * 40] * 3 + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    taken = SimpleNamespace(select=lambda *_: SimpleNamespace(mapInArrow=lambda work, _: work))
    monkeypatch.setattr(alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    calls, whole = [], alignment.Aligner.texts
    monkeypatch.setattr(alignment.Aligner, "texts", lambda self, ts: calls.append(sum(len(t or "") for t in ts)) or whole(self, ts))

    def run():
        calls.clear()
        return [b.to_pylist() for b in alignment.blocks(taken, *paths, "doc_id", "text", 4_000_000)([batch])]
    want = run()
    assert len(calls) == len(want) == 1
    longest = max(len(t or "") for t in texts)
    monkeypatch.setattr(alignment, "SLICE", longest)
    assert run() == want
    assert len(calls) > 2 and max(calls) <= longest
    aligner = alignment.Aligner.get(*paths)
    assert aligner.units.young
    alignment.Aligner.forget()
    assert not aligner.units.young and not aligner.units.old


def test_worker_memory_of_other_operators_is_dropped():
    import numpy as np
    import public_tokenizers

    from tillhouse.llm import memo
    from tillhouse.llm import quality_classifier as q
    from tillhouse.llm.bpe import Bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    memo._KEPT.clear()
    Bpe._open.clear()
    first = list(Bpe.get(path, public_tokenizers.PATTERN).encode(["some words here", None]))
    kept = Bpe.get(path, public_tokenizers.PATTERN)
    assert kept is Bpe.get(path, public_tokenizers.PATTERN) and len(kept.memo.young)
    x = q.pooled(["Some words"], np.ones((q.ROWS, q.DIM), np.float32))
    assert not Bpe._open and not kept.memo.young and q._MEMO
    assert (x == q.pooled(["Some words"], np.ones((q.ROWS, q.DIM), np.float32))).all() and q._MEMO
    assert list(Bpe.get(path, public_tokenizers.PATTERN).encode(["some words here", None])) == first
    assert not q._MEMO
    memo.make_room("another")
    assert not Bpe._open and not memo._KEPT


def test_shingles_are_word_sequences_mixed_once(monkeypatch):
    import numpy as np

    from tillhouse.llm import common
    r = random.Random(4)
    for words in [[r.choice("abc") for _ in range(n)] for n in (1, 2, 4, 5, 6, 40, 300)]:
        got = common.shingles_of(common.word_hashes(" ".join(words)))
        want = [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))]
        assert len(set(zip(want, got.tolist()))) == len(set(want)) == len(set(got.tolist()))
        assert (common.shingle_set(" ".join(words)) == np.unique(got)).all()
    calls, mix = [], common.mix
    monkeypatch.setattr(common, "mix", lambda x: calls.append(1) or mix(x))
    common.shingles_of(common.word_hashes("a b c d e f"))
    assert len(calls) == 1
    assert not len(common.shingle_set(None)) and common.distinct(np.array([3, 1, 3])).tolist() == [1, 3]


@pytest.mark.parametrize("portion", [1, 3, 1000])
def test_alignment_compares_all_bytes_at_once(monkeypatch, portion):
    import numpy as np
    import pyarrow as pa

    from tillhouse.llm import alignment
    monkeypatch.setattr(alignment, "PORTION", portion)
    table = [b"", b"ab", b"c", b"", b"def"]
    sizes, raw = np.array([len(x) for x in table]), np.frombuffer(b"".join(table), np.uint8)
    for ids in ([1, 2, 4, 1], [4], [0, 1, 3], [0], []):
        whole = b"".join(table[i] for i in ids)
        for other in {whole, whole[:-1], whole + b"c", b"x" + whole[1:], b""}:
            assert alignment.spelled(np.array(ids, np.int64), sizes, raw, np.frombuffer(other, np.uint8)) == (other == whole)
    assert alignment.joined(pa.array(["7", "8", "9"]), [2, 3], ",").to_pylist() == ["7,8", "9"]
    assert alignment.joined(pa.array([], pa.string()), [], ",").to_pylist() == []


def test_alignment_stores_no_row_that_holds_a_block(spark, monkeypatch):
    """Spark reads thousands of rows at once: one may grow with a document, not with its block."""
    from types import SimpleNamespace

    import public_tokenizers as P
    import pyarrow as pa

    from tillhouse.llm import alignment
    texts = odd_texts(300, 11)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    taken = SimpleNamespace(select=lambda *_: SimpleNamespace(mapInArrow=lambda work, _: work))
    monkeypatch.setattr(alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))

    def largest(chars):
        out = list(alignment.blocks(taken, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), "doc_id", "text", chars)([batch]))
        return len(out), max(b.slice(i, 1).nbytes for b in out for i in range(b.num_rows))
    (many, alone), (one, together) = largest(1), largest(4_000_000)
    assert many > 100 and one == 1
    assert together <= 2 * alone           # an index into a longer list may take two bytes for one


def test_alignment_packs_indices_and_counts_of_any_width(spark):
    import numpy as np

    from tillhouse.llm.alignment import packed
    for top, width in ((0, 1), (255, 1), (256, 2), (65_535, 2), (65_536, 4), (1 << 32, 8)):
        got = packed(np.array([0, top, 1], np.int64), top, np.array([2, 2, 3])).to_pylist()
        assert [np.frombuffer(x, f"u{width}").tolist() for x in got] == [[0, top], [], [1]]
    texts = ["word " * 300, "other " * 700, "one", "", None, "word other " * 200] + odd_texts(40, 12)
    rows = list(enumerate(texts))
    for chars in (1, 4_000_000):
        out = aligned(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), block_chars=chars)
        assert Counter(tuple(r[c] for c in COLUMNS) for r in out.collect()) == brute_alignment(rows)
