"""Each operator against brute force on small tables with the hard cases: nulls,
empty and long texts, ties and repeated rows, empty tables, clashing columns."""

import base64
import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

WORDS = [f"w{i}" for i in range(400)] + ["Äpfel", "naïve", "the", "and"]


def text_of(seed, n, per_line=12):
    r = random.Random(seed)
    ws = [r.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(ws[i:i + per_line]) for i in range(0, n, per_line))


BASE = text_of(1, 300)
LONG = text_of(2, 12_000)
ROWS = [
    (1, BASE), (2, BASE), (3, BASE.replace("w7 ", "w8 ", 1)), (4, None), (5, ""), (6, " \n\t "), (7, "one two"),
    (8, "one two"), (9, LONG), (10, LONG + "\n" + text_of(3, 30)), (11, text_of(4, 200)), (12, text_of(4, 200).upper()),
    (12, text_of(5, 40)), (13, "Mail a.b@c-d.example.com or +1 (743) 555-3824, ip 10.0.0.255 and 4111 1111 1111 1111."),
    (14, "1.2.3.4.5.6.7.256 x@y a@b.c%d@e.f +12 4111111111111112"), (None, text_of(6, 60)), (15, "a" * 3000),
    (16, "x\n" * 50 + BASE[:700]), (17, "  double  spaces\r\nand\ttabs  "), (18, "ok ok ok ok ok ok ok ok ok ok ok ok"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", 0.5, "k") for i, t in ROWS], "doc_id long, text string, lang string, score double, kept string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def shingles(t):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(t)]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_quality_rules(docs, empty):
    from tillhouse.llm.quality_rules import quality_rules
    got = sorted((r["doc_id"] or 0, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
                 for r in quality_rules(docs).collect())
    want = []
    for i, t in ROWS:
        t = t or ""
        w = words(t)
        c = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        cover = {k + j for k in range(len(w) - 4) if c[tuple(w[k:k + 5])] > 1 for j in range(5)}
        ls = [x for x in t.split("\n") if words(x)]
        want.append((i or 0, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(ls) - len(set(ls)), len(cover),
                     len(w) < 10 or 100 * len(cover) > 20 * len(w)))
    assert got == sorted(want)
    assert quality_rules(empty).count() == 0


def test_bpe_matches_the_library(docs, empty):
    import public_tokenizers as P
    import tiktoken

    from tillhouse.llm.bpe import decode, digests, encode
    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((i or 0, (ids := own.encode_ordinary(t or "")) and len(ids) or 0, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ROWS)
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in digests(docs, path, P.PATTERN).collect())
    assert got == want
    back = decode(encode(docs, path, P.PATTERN), path, P.PATTERN).select("doc_id", "bytes").collect()
    assert sorted((r["doc_id"] or 0, bytes(r["bytes"])) for r in back) == sorted((i or 0, (t or "").encode()) for i, t in ROWS)
    assert digests(empty, path, P.PATTERN).count() == 0


def test_bpe_pieces_and_bounds(monkeypatch):
    """Pieces join to the text; ids stay the library's when the table of solved pieces drops entries all the time and queries are small."""
    import public_tokenizers
    import tiktoken

    from tillhouse.llm import bpe
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 300)
    own = bpe.Bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    own.memo.half = 2_000
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    r = random.Random(4)
    marks = ["a", "Haus", "42", "'s", " ", " ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "\x1c", "!?", "\u4e2d\u6587", "z" * 500, "q" * 700]
    texts = ["".join(r.choice(marks) for _ in range(r.randrange(40))) for _ in range(300)] + [BASE, LONG, " a", "a ", "\n", "a\n\nb", "a\nb c"]
    assert all("".join(own.parts(t)) == t for t in texts if t)
    seen = set()
    for at in range(0, len(texts), 7):
        part = texts[at:at + 7]
        seen.update(p for t in part for p in own.parts(t))
        for t, solved in zip(part, own.encode(part)):
            assert [int(i) for s, _, _ in solved for i in s.split(",")] == library.encode_ordinary(t)
            assert b"".join(d for _, _, d in solved) == t.encode()
    assert len(own.memo.young) + len(own.memo.old) < len(seen)


def test_bpe_keeps_ids_in_columns(monkeypatch):
    """Learning pieces makes no list of ids; texts that stay whole are those with other runs of white space."""
    import public_tokenizers

    from tillhouse.llm import bpe
    own = bpe.Bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    words = [b"the", b"xqzzyvw", "\u4e2dnaïve".encode(), b"z" * 700, b"unforeseeably", b"the"]
    flat, ends = own.ids(words)
    lists = own.solve(words)
    assert flat.tolist() == [i for ids in lists for i in ids] and ends.tolist() == [sum(map(len, lists[:i + 1])) for i in range(len(lists))]
    assert own.decode([*lists, [], lists[0]]) == [*words, b"", b"the"] and own.decode([]) == []
    assert own.ids([])[0].tolist() == [] and own.solve([]) == []
    monkeypatch.setattr(own, "solve", lambda words: 1 / 0)
    monkeypatch.setattr(own, "decode", lambda docs: 1 / 0)
    assert [[p[1] for p in t] for t in own.encode(["the the", None, ""])] == [[1, 1], [], []]
    r = random.Random(1)
    for _ in range(3000):
        t = "".join(r.choice("ab \n\t\u00a0\x1c\r") for _ in range(r.randrange(9)))
        assert bool(bpe.RUN.search(t)) == bool(re.search(r"[ \n]\s|\s[ \n]|\A\s|\s\Z", t)), repr(t)


def test_ngram_join_components(docs, empty):
    from tillhouse.llm.ngram_join import similar_components
    sets = [(i, shingles(t)) for i, t in ROWS]
    group = list(range(len(ROWS)))
    for a in range(len(ROWS)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                group = [group[b] if g == group[a] else g for g in group]
    low = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            low[group[k]] = min(i, low.get(group[k], i))
    want = sorted((i or 0, len(s), (low.get(group[k]) or 0)) for k, (i, s) in enumerate(sets))
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in similar_components(docs).collect())
    assert got == want
    assert similar_components(empty).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_of_crowded_keys(spark, monkeypatch, seed):
    """Near copies around the threshold, copies of far ones, and texts that share most of a
    passage: classes that the first hub does not match still find each other."""
    from tillhouse.llm import ngram_join
    monkeypatch.setattr(ngram_join, "FEW", 2)
    r = random.Random(seed)
    base, texts = [r.choice(WORDS) for _ in range(90)], []

    def edited(ws, times):
        ws = list(ws)
        for _ in range(times):
            at = r.randrange(len(ws))
            ws[at:at + r.choice([0, 1, 1, 1])] = [f"n{r.randrange(10 ** 6)}"] * r.choice([0, 1, 1])
        return ws
    for _ in range(90):
        far = edited(base, r.randrange(7))
        texts += [far, edited(far, 2)] if r.random() < 0.4 else [far]
    for _ in range(60):
        texts.append(base[20:60] + [f"o{r.randrange(10 ** 6)}" for _ in range(r.randrange(1, 12))])
    sets = [shingles(" ".join(t)) for t in texts]
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    low = {g: group.index(g) for g in group}
    assert len(low) > 10
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_components(docs).collect()}
    assert got == {i: low[g] for i, g in enumerate(group)}


def test_ngram_residuals_are_short_and_keep_every_link(monkeypatch):
    """Of far classes too a quarter of the set at most is sent, in blocks of bounded size; only what two components share is read."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    from tillhouse.llm import ngram_join
    monkeypatch.setattr(ngram_join, "FLUSH", 6000)
    r = random.Random(4)
    base, texts = [f"b{i}" for i in range(100)], []
    for kept in (0, 30, 50, 70, 85, 92):
        for _ in range(12):
            at = r.randrange(100 - kept + 1)
            ws = [f"n{r.randrange(10 ** 6)}" for _ in range(r.randrange(5, 120 - kept))]
            other = [*ws[:-2], "x", "y", "z"]
            texts += [" ".join(base[at:at + kept] + w) for w in (ws, other)]
    zipped = [zstandard.compress(t.encode()) for t in texts]
    columns = ("key", "class", "component", "size", "own", "odd0", "odd1")
    ids = list(range(1, len(texts) + 1))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array([0] * len(ids)), pa.array([True] * len(ids)), pa.array(ids), pa.array(zipped),
         pa.array([zstandard.compress(" ".join(base).encode())] * len(ids))], names=["class", "hub", "other", "component", "zx", "zh"])
    sent = list(ngram_join._residuals(80, 5, 3)([batch]))
    tables = [np.frombuffer(x, np.int64).reshape(-1, len(columns)) for b in sent for x in b.column(1).to_pylist()]
    assert len(sent) > 1 and max(b.column(1).nbytes for b in sent) < 2 * 1000 * 8 * len(columns)
    rows = np.concatenate(tables)
    sets, hub = [shingles(t) for t in texts], shingles(" ".join(base))
    keys = {c: set(rows[rows[:, 1] == c, 0].tolist()) for c in ids}
    assert all(len(keys[c]) <= len(x) // 4 + 1 for c, x in zip(ids, sets))
    met, pairs = [], [(a, b) for a in ids for b in ids if a < b]
    near = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    for a, b in pairs:
        x, y = sets[a - 1], sets[b - 1]
        if near(x, y) and not (near(x, hub) and near(y, hub)):
            met.append((a, b))
            assert keys[a] & keys[b], (a, b)
    assert len(met) > 30
    shared = np.concatenate([np.stack([c.to_numpy() for c in out.columns], 1) for out in ngram_join._shared(*columns)(sent)])
    times = Counter(shared[:, 0].tolist())
    assert min(times.values()) >= 2 and set(times) == {k for k, n in Counter(rows[:, 0].tolist()).items() if n > 1}


def test_ngram_residuals_start_with_rare_shingles(spark):
    """Dissimilar classes that share a passage which their hub lacks don't all meet in it; similar ones still do."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    from tillhouse.llm import ngram_join
    r, texts = random.Random(8), []
    core, passage = [f"c{i}" for i in range(80)], [f"p{i}" for i in range(50)]
    for _ in range(80):
        own = [f"n{r.randrange(10 ** 6)}" for _ in range(60)]
        texts += [" ".join(core + passage + own + [end]) for end in ("x y", "z")]
    hub, ids = zstandard.compress(" ".join(core + [f"h{i}" for i in range(90)]).encode()), list(range(1, len(texts) + 1))
    zipped = [zstandard.compress(x.encode()) for x in texts]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array([0] * len(ids)), pa.array([True] * len(ids)), pa.array(ids), pa.array(zipped), pa.array([hub] * len(ids))],
        names=["class", "hub", "other", "component", "zx", "zh"])

    def classes_by_key(*ranks):
        out = {}
        for sent in ngram_join._residuals(80, 5, 3, *ranks)([batch]):
            for block in sent.column(1).to_pylist():
                for key, c in np.frombuffer(block, np.int64).reshape(-1, 7)[:, :2].tolist():
                    out.setdefault(key, set()).add(c)
        return out
    ranks = ngram_join._ranks(spark.createDataFrame([(bytearray(z),) for z in zipped], "zip binary").repartition(3), 5)
    assert ranks.nbytes == ngram_join.COMMON and ranks.max() == 8         # 160 classes have each shingle of the passage
    assert max(map(len, classes_by_key().values())) == len(ids)           # in the order of hashes alone all meet
    found = classes_by_key(ranks)
    assert max(map(len, found.values())) <= 4
    assert all(any({a, a + 1} <= cs for cs in found.values()) for a in ids[::2])


def test_ngram_schemes_keep_every_link():
    """Random pairs at exactly the threshold share a key, in every size band."""
    import numpy as np

    from tillhouse.llm.ngram_join import keys_of
    r = np.random.default_rng(3)
    for n in [5, 6, 7, 9, 10, 13, 17, 20, 26, 33, 50, 75, 120, 300, 900]:
        for _ in range(30):
            x = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
            gone = int(r.integers(0, n // 5 + 1))
            more = 0
            while 100 * (n - gone) >= 80 * (n + more + 1) and r.random() < 0.9:
                more += 1
            y = np.unique(np.concatenate([r.permutation(x)[gone:], r.integers(0, 1 << 63, more).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both >= 80 * (len(x) + len(y) - both) and not np.array_equal(x, y):
                assert len(np.intersect1d(keys_of(x, 80), keys_of(y, 80))), (n, gone, more)


def test_ngram_schemes_pay_for_their_slack():
    """In every scheme some segment agrees that the slack does not cover."""
    from tillhouse.llm.ngram_join import RATIO, schemes
    for percent in (50, 80, 90):
        low = next(n for n in range(2, 1000) if 100 * (n - 1) >= percent * n)
        for s in schemes(percent):
            high = max(low + 1, int(low * RATIO))
            need = 2 * (high - 1) * (100 - percent) // (100 + percent) + 1
            assert s.least == -(-percent * low // 100)
            assert s.exact + 2 * s.deleted >= need + s.spare_empty + s.spare_hot, (percent, s.j)
            low = high


def test_line_dedup(docs, empty):
    from tillhouse.llm.line_dedup import line_dedup
    rows = [(1, "a b c d e f\nshort one\na b c d e f"), (2, "a b c X e f\nnew line with six words"), (3, "a b c d e f g\nnew line with words six"),
            (4, "b c d e f\n" + text_of(9, 25, 25)), (5, None), (6, ""), (7, "short one\nq r s t u v w x\nq r s t u v w x y z"), (8, "a  b\tc d e f")]
    d = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").withColumn("n_near", F.lit(9))
    got = {r["doc_id"]: (r["text"], r["n_exact"], r["n_near"]) for r in line_dedup(d).collect()}
    assert got[1] == ("a b c d e f\nshort one", 1, 0)
    assert got[2] == ("new line with six words", 0, 1)          # one word replaced
    assert got[3] == ("new line with words six", 0, 1)          # one word more; a swap is two edits
    assert got[4] == (text_of(9, 25, 25), 0, 1)                 # one word less
    assert got[5] == (None, 0, 0) and got[6] == ("", 0, 0)
    assert got[7] == (rows[6][1], 0, 0)                         # short lines stay; two words more is far
    assert got[8] == ("", 1, 0)                                 # equal but for white space
    assert line_dedup(empty).count() == 0
    assert line_dedup(docs).count() == len(ROWS)


def test_line_dedup_takes_short_lines(spark, tmp_path):
    """op7 and the pipeline's stage against brute force, over lines of none to seven words."""
    import corpus_pipeline as P
    from tillhouse.llm.queries import op7_line_dedup
    r = random.Random(4)
    texts = ["\n".join(" ".join(r.choice("abcd") for _ in range(r.randrange(8))) for _ in range(6)) for _ in range(50)]
    spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(b) < 5 or len(b) - len(a) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    seen, want, short = [], {}, 0
    for i, t in enumerate(texts):
        kept, exact, close = [], 0, 0
        for line in t.split("\n"):
            ws = line.split()
            gone = "exact" if ws and ws in seen else "near" if any(near(ws, x) for x in seen) else ""
            exact, close = exact + (gone == "exact"), close + (gone == "near")
            short += gone == "near" and len(ws) == 4
            kept += [] if gone else [line]
            if ws:
                seen.append(ws)
        want[i] = (6, exact, close, "\n".join(kept))
    assert short
    got = {x["doc_id"]: x for x in op7_line_dedup(spark, str(tmp_path)).collect()}
    assert {i: (x["n_lines"], x["n_exact"], x["n_near"], x["text_sha256"]) for i, x in got.items()} == {
        i: (n, e, c, hashlib.sha256(t.encode()).hexdigest()) for i, (n, e, c, t) in want.items()}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {x["doc_id"]: x["text"] for x in P.lines(spark, docs, str(tmp_path)).collect()}
    assert left == {i: t for i, (_, _, _, t) in want.items() if t.strip() or not texts[i].strip()}


def test_line_dedup_joins_only_variants_that_lines_share(spark, monkeypatch):
    """Deletion variants by brute force, over lines with repeated words and all kinds of white space."""
    from tillhouse.llm import line_dedup
    stored, store = {}, line_dedup.store
    monkeypatch.setattr(line_dedup, "store", lambda df, name: stored.setdefault(name, store(df, name)))
    r = random.Random(6)

    def spaced(ws):
        return r.choice(["", " ", "\t"]) + "".join(w + r.choice([" ", " ", "  ", "\t", "\x0b ", "\r"]) for w in ws)
    lines = [[r.choice("abc") + str(r.randrange(3)) for _ in range(r.randrange(5, 9))] for _ in range(60)]
    lines += [[f"u{i}x{j}" for j in range(40)] for i in range(20)]
    lines += [x[:at] + r.choice([[], ["new"]]) + x[at + 1:] for x in lines[-20:-10] for at in [r.randrange(40)]]
    texts = ["\n".join(map(spaced, lines[i:i + 5])) for i in range(0, len(lines), 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    line_dedup.line_dedup(docs).collect()
    places = {(x["id"], x["no"]): tuple(x["line"].split(" ")) for x in stored["lines"].collect()}
    assert all(list(ws) == lines[5 * d + no] for (d, no), ws in places.items())
    emitted = {(p, at): ws[:at - 1] + ws[at:] if at else ws for p, ws in places.items() for at in range(len(ws) + 1)}
    of = {}
    for (p, _), v in emitted.items():
        of.setdefault(v, set()).add(places[p])
    want = sorted((*p, at) for (p, at), v in emitted.items() if len(of[v]) > 1)
    got = {(x["place"]["id"], x["place"]["no"], x["at"]): x["v"] for x in stored["shared"].collect()}
    assert sorted(got) == want and 10 < len(want) < len(emitted) / 2
    assert len(set(got.values())) == len({emitted[(d, no), at] for d, no, at in want})


def test_decontaminate(docs, empty):
    from tillhouse.llm.decontaminate import decontaminate
    spark = docs.sparkSession
    cut = " ".join(words(LONG)[5000:5040])
    items = [(1, cut), (2, " ".join(words(BASE)[10:30])), (3, None), (4, ""), (5, "one two"), (6, text_of(77, 40)),
             (7, " ".join(words(LONG)[100:400])), (8, cut.upper()), (None, cut)]
    q = spark.createDataFrame(items, "item_id long, text string")
    want = {(i, j) for i, t in ROWS for j, b in items if shingles(b) and 100 * len(shingles(b) & shingles(t)) >= 80 * len(shingles(b))}
    for blocks in ({}, {"block_items": 3}):
        got = [(r["doc_id"], r["item_id"]) for r in decontaminate(docs, q, **blocks).collect()]
        assert set(got) == want and len(got) == len(want)
    assert decontaminate(empty, q).count() == 0 and decontaminate(docs, q.where("false")).count() == 0


def test_pii_base_spans(docs, empty):
    from tillhouse.llm.pii import find_pii, train
    got = {r["doc_id"]: r for r in find_pii(docs, train(docs)).collect()}
    assert [got[13][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [1, 1, 1, 1]
    t = dict(ROWS)[13]
    spans = [("email", "a.b@c-d.example.com"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (743) 555-3824")]
    assert got[13]["spans"].startswith(",".join(f"{k}:{t.index(x)}:{t.index(x) + len(x)}" for k, x in spans))
    emails = re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", dict(ROWS)[14])
    assert emails == ["a@b.c", "%d@e.f"]  # the second starts where the first ends
    assert [got[14][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [2, 1, 0, 0]
    assert got[4]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[4]["spans"] == ""
    many = docs.sparkSession.createDataFrame([(1, " ".join(f"u{i}@m.example.com" for i in range(700)))], "doc_id long, text string")
    row = find_pii(many, {}).first()
    at = [m.span() for m in re.finditer(r"\S+", many.first()["text"])]
    assert row["base_sha256"] == hashlib.sha256(",".join(f"email:{a}:{b}" for a, b in at).encode()).hexdigest()
    assert find_pii(empty, train(empty)).count() == 0


def test_warc_round_trip(spark, tmp_path):
    from tillhouse.llm.warc import archive_pages, payload_chunks, payload_digests, plan_records, read_archives, write_archives
    rows = [(1, "u1", b"x" * 700_000), (2, "u2", b"x" * 700_000), (3, "u3", b""), (4, None, b""), (5, "u5", "é\r\n\r\nWARC/1.1\r\n".encode()),
            (5, "u5", "é\r\n\r\nWARC/1.1\r\n".encode()), (None, "u", b"lone"), (7, "u7", b"y")]
    pages = spark.createDataFrame(rows, "page_id long, uri string, payload binary").repartition(2)
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or 0, r["intact"]) for r in archive_pages(pages, str(tmp_path / "a")).collect())
    seen, want = set(), []
    for i, _, p in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        low = min((j for j, _, q in rows if q == p and j is not None), default=None)
        first = p not in seen
        seen.add(p)
        want.append((i or 0, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first else "revisit", 0 if first else low, True))
    assert got == sorted(want)
    manifest = write_archives(plan_records(payload_digests(pages)), payload_chunks(pages, 100_000), str(tmp_path / "b"))
    parts = sorted((r["page_id"] or 0, r["chunk_no"], bytes(r["data"])) for r in read_archives(manifest, chunk=100_000).where("record_type = 'response'").collect())
    assert b"".join(d for i, _, d in parts if i == 1) == b"x" * 700_000 and max(len(d) for _, _, d in parts) <= 100_000
    assert archive_pages(pages.where("false"), str(tmp_path / "c")).count() == 0


def test_warc_copies_move_once(spark, tmp_path, monkeypatch):
    """Many copies of a payload and of a page, over several tasks: one response each,
    revisits in blocks; columns named like the helpers' are not read."""
    from tillhouse.llm import warc
    monkeypatch.setattr(warc, "BLOCK", 7)
    rows = [(100 - i, None, b"z" * 5000) for i in range(60)] + [(200, "u", b"again")] * 40 + [(None, "v", b"again"), (None, "v", None)]
    pages = spark.createDataFrame(rows, "page_id long, uri string, payload binary").withColumns({
        c: F.lit("x") for c in ("digest", "kind", "block", "data", "n")}).repartition(3)
    got = warc.archive_pages(pages, str(tmp_path / "a"), chunk=1000).collect()
    assert len(got) == len(rows) and all(r["intact"] for r in got)
    assert [(r["page_id"], r["payload_bytes"]) for r in got if r["record_type"] == "response" and r["payload_bytes"] == 5000] == [(41, 5000)]
    z = [r for r in got if r["payload_bytes"] == 5000]
    assert sorted(r["page_id"] for r in z) == list(range(41, 101)) and {r["refers_to"] for r in z if r["page_id"] > 41} == {41}
    again = [(r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["payload_bytes"] == 5]
    assert sorted(again, key=str) == sorted([(200, "response", None)] + [(200, "revisit", 200)] * 39 + [(None, "revisit", 200)], key=str)
    per_task = warc.payload_chunks(pages, 1000, candidates=True).where("page_id between 41 and 100").count()
    assert per_task < warc.payload_chunks(pages, 1000).where("page_id between 41 and 100").count() == 300


def test_chunks_find_shared_passages(spark):
    from tillhouse.llm.chunk_dedup import repeated_passages
    rows, caught = [], set()
    for k in range(60):
        passage = text_of(1000 + k, 55)
        rows += [(2 * k, text_of(2000 + k, 40 + k) + " " + passage + " " + text_of(3000 + k, 80)), (2 * k + 1, text_of(4000 + k, 90) + "\n" + passage)]
        caught |= {2 * k, 2 * k + 1}
    rows += [(500 + k, text_of(5000 + k, 200)) for k in range(60)] + [(900, None), (901, ""), (None, rows[0][1])]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == caught
    assert {r["doc_id"] for r in got if not r["duplicate"]} == set(range(0, 120, 2))
    assert repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_each_chunk_is_kept_by_one_document(spark):
    """A passage of documents 2 and 3 next to one that document 1 also holds: each stays once."""
    from tillhouse.llm.chunk_dedup import chunks, repeated_passages
    early, late = text_of(51, 90), text_of(52, 90)
    rows = [(1, text_of(53, 60) + " " + early + " " + text_of(54, 60)), (2, early + " " + late + " " + text_of(55, 60)),
            (3, text_of(56, 60) + " " + early + " " + late), (4, text_of(57, 80) + " " + late + " " + text_of(58, 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeated_passages(docs).collect()
    gone = {(r["doc_id"], w) for r in got if r["duplicate"] for w in range(r["start"], r["end"])}
    held, kept = {}, set()
    for r in chunks(docs).collect():
        held.setdefault((r["d1"], r["d2"]), set()).add(r["doc_id"])
        if (r["doc_id"], r["place"] & 0xFFFFFFFF) not in gone:
            kept.add((r["d1"], r["d2"]))
    shared = {d for d, ids in held.items() if len(ids) > 1}
    assert len(shared) > 20 and shared <= kept
    assert {r["doc_id"] for r in got if not r["duplicate"]} == {1, 2} and {r["doc_id"] for r in got if r["duplicate"]} == {2, 3, 4}
    words_gone = {i: sum(d == i for d, _ in gone) for i in (1, 2, 3, 4)}
    assert words_gone[1] == 0 and 70 < words_gone[2] <= 90 and words_gone[3] > 150 and 70 < words_gone[4] <= 90


def test_chunks_find_barely_long_and_periodic_passages(spark):
    """Passages of 51 words, and of one to four short words again and again."""
    from tillhouse.llm.chunk_dedup import boundaries, repeated_passages
    r, passages = random.Random(8), []
    for k in range(300):
        passages.append(text_of(10_000 + k, 51))
    for k in range(150):
        unit = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(1, 4))) for _ in range(1 + k % 4)]
        passages.append(" ".join((unit * 80)[:r.choice([51, 80])]))
    rows = []
    for k, passage in enumerate(passages):
        rows += [(2 * k, text_of(20_000 + k, r.randrange(1, 60)) + " " + passage + " " + text_of(30_000 + k, r.randrange(1, 60))),
                 (2 * k + 1, text_of(40_000 + k, r.randrange(1, 60)) + "\n" + passage + " " + text_of(50_000 + k, r.randrange(1, 60)))]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == set(range(2 * len(passages)))
    import numpy as np
    for t in ("", "a", "ab" * 40, "a" * 3000, "x" * 200 + BASE + "abc " * 900, BASE):
        cuts, ends, units = boundaries(np.frombuffer(t.encode(), np.uint8))
        at = [0, *ends.tolist()]
        assert "".join(t[b - u:b] * ((b - a) // u) for a, b, u in zip(at, at[1:], units.tolist())) == t
        assert max(units, default=0) <= 128 and len(ends) < len(t) / 16 + 3


def test_quality_classifier(spark):
    from tillhouse.llm.quality_classifier import quality_scores
    good = [(i, text_of(i, 60)) for i in range(150)]
    junk = [(i, " ".join(w + "$$$" for w in words(text_of(i, 60)))) for i in range(150, 300)]
    rows = good + junk + [(400, None), (401, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("predicted", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(None, 1)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] < 300]
    assert len(held) > 20 and sum((r["predicted"] == 1) == (r["doc_id"] < 150) for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == len(rows)
    assert {r["score"] for r in quality_scores(docs, labels.where("false")).collect()} == {0.5}
    assert quality_scores(docs.where("false"), labels).count() == 0


def test_license_scan(docs, empty):
    from tillhouse.llm.license_scan import license_scan, train
    spark = docs.sparkSession
    model = train(docs)
    rows = [(1, BASE + "\nReleased under the MIT License.\n" + BASE), (2, "Licensed under CC BY-NC 4.0."), (3, None), (4, ""),
            (5, "This work is licensed under the GNU General Public License, version 3."), (6, "He lost his license after the accident and could not work.")]
    got = {(r["doc_id"], r["family"]) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {(1, "MIT"), (2, "CC-BY-NC"), (5, "GPL")}
    assert license_scan(docs, model).count() == 0 and license_scan(empty, train(empty)).count() == 0


NAMED = {
    "SPDX-License-Identifier: GPL-3.0-only": {"GPL"}, "SPDX-License-Identifier: BSD-2-Clause": {"BSD"},
    "SPDX-License-Identifier: LGPL-2.1-or-later": {"LGPL"}, "SPDX-License-Identifier: EPL-2.0": {"EPL"}, "MIT OR Apache-2.0": {"MIT", "Apache-2.0"},
    "MIT License or the Apache License, Version 2.0": {"MIT", "Apache-2.0"}, "SPDX-License-Identifier: (MIT OR GPL-2.0-only)": {"MIT", "GPL"},
    "Dual licensed under the Eclipse Public License and the GNU General Public License": {"EPL", "GPL"},
    "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.": {"AGPL"},
    "Text is available under the Creative Commons Attribution-ShareAlike 4.0 International License.": {"CC-BY-SA"},
    "Released under the MIT license, see LICENSE.": {"MIT"}, "Covered by the Mozilla Public License, version 2.0.": {"MPL"},
    "This module is licensed under the Apache License, Version 2.0.": {"Apache-2.0"}, "Distributed under the ISC License.": {"ISC"},
}
#: Licences that training has not seen.
UNSEEN = ("WTFPL", "Boost Software", "Unicode", "Foo Public", "NVIDIA", "Eiffel Forum", "Blue Oak Model", "Proprietary Enterprise", "Intel Simplified", "Zend")


def test_license_scan_of_known_and_unknown_licences(spark):
    """Families that training has not seen stay unknown, each family on a line is named; scan() against a plain version; the sample is bounded and has no copies."""
    import numpy as np

    from tillhouse.llm import license_scan as L
    r = random.Random(3)
    model = L.Model([w for t in (BASE, LONG) for _, w in L.windows(t)])
    assert 0.1 <= model.least <= 0.95
    unknown = [f.format(n) for n in UNSEEN for f in L.NOTICES]
    lines = [(t, fs) for t, fs in NAMED.items()] + [(t, set()) for t in unknown] + [(" ".join(r.choices(WORDS, k=30)), set()) for _ in range(300)]
    lines += [("As a oure.", set()), ("under the law", set()), ("This software", set()), ("All rights reserved.", set()), ("er ging mit or ohne", set())]
    # the same notices with other text around them
    lines += [(" ".join([*r.choices(WORDS, k=4), t, *r.choices(WORDS, k=4)]), fs) for t, fs in NAMED.items()]
    r.shuffle(lines)
    text = "\n".join(t for t, _ in lines)
    got = {(no, f) for _, no, f, _, _ in model.scan([text])}
    want = {(no, f) for no, (_, fs) in enumerate(lines) for f in fs}
    assert len(got & want) >= 0.99 * len(got) and len(got & want) >= 0.95 * len(want)
    plain = set()
    for no, w in L.windows(text):
        h = L._hashes(w)
        z = model.logits([L._features(h)])
        if 1 - model.soft(z / model.temperature)[0, 0] >= model.least:
            mine = set(L._pairs(h).tolist())
            for f, ts in model.templates.items():
                if any(mine & set(own.tolist()) and len(mine & set(t.tolist())) >= 0.5 * min(max(len(mine), 6), len(t)) for t, own in ts):
                    plain.add((no, f))
    assert got == plain
    assert all(len(np.unique(t)) == len(t) for ts in model.templates.values() for t, _ in ts)
    rows = [(BASE,)] * 50 + [(f"Text {i} " + BASE,) for i in range(20)] + [(LONG,), (None,), ("",)]
    seen = []

    class Kept(L.Model):
        def __init__(self, negatives):
            seen.extend(negatives)

    whole, L.Model = L.Model, Kept
    try:
        L.train(spark.createDataFrame(rows, "text string"), longest=len(LONG) - 1)
    finally:
        L.Model = whole
    assert len(seen) == 21 * len(L.windows(BASE))


CLASHES = ("_t", "_h", "_words", "_nos", "_id", "_gone", "_m_email", "base", "extra", "added", "row", "class", "had", "in_0", "score", "n_lines_")


def test_helper_names_do_not_clash(spark):
    """Columns named like helpers pass through op4, op5 and op7; those named like an output are replaced."""
    from tillhouse.llm.line_dedup import line_dedup
    from tillhouse.llm.pii import find_pii, train
    from tillhouse.llm.quality_rules import quality_rules
    plain = spark.createDataFrame(ROWS, "doc_id long, text string")
    named = plain.select(*[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHES],
                         "*", F.lit("x").alias("kept"), F.lit("x").alias("spans"), F.lit("x").alias("n_near"))
    weights = train(plain)
    for run, replaced in ((quality_rules, "kept"), (lambda d: find_pii(d, weights), "spans"), (line_dedup, "n_near")):
        want, got = run(plain), run(named)
        assert sorted(got.columns) == sorted(set(named.columns) | set(want.columns))
        rows = got.collect()
        assert Counter(str([r[c] for c in want.columns]) for r in rows) == Counter(str(list(r)) for r in want.collect())
        assert all(r[c] == c + ("-" if r["doc_id"] is None else str(r["doc_id"])) for r in rows for c in CLASHES)
        assert "x" not in {r[replaced] for r in rows}


def test_pipeline_stages_judge_rows(spark, tmp_path):
    """Every stage after the classifier against brute force: null, empty and repeated rows and ids, clashing names, an empty table."""
    import corpus_pipeline as P
    item = text_of(77, 30)
    rows = [(1, BASE), (1, BASE), (None, BASE), (2, BASE.replace("w7 ", "w8 ", 1)), (3, text_of(31, 80)), (3, text_of(32, 80) + " " + item),
            (None, text_of(33, 60) + "\n" + item), (None, text_of(34, 60)), (4, None), (4, None), (5, ""), (5, ""), (6, "one two"), (7, "one two"),
            (8, text_of(35, 80)), (None, text_of(36, 50)), (None, text_of(36, 50)), (9, text_of(37, 3000))]
    docs = spark.createDataFrame([(i, t, None if t is None else len(t), f"{k}") for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, n_chars int, row string")
    docs = docs.withColumns({c: F.col("row") for c in ("component_id", "class", "had", "in_0", "score", "n_exact")}).repartition(3)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def kept(df):
        got = df.collect()
        assert df.columns == docs.columns and all(r[c] == r["row"] for r in got for c in ("component_id", "class", "had", "in_0", "score", "n_exact"))
        return sorted(int(r["row"]) for r in got)

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    got = kept(P.near_duplicates(spark, docs, str(tmp_path)))
    assert len(got) == len(set(group))
    for g in set(group):
        members = [k for k in range(len(rows)) if group[k] == g]
        low = min((rows[k][0] is None, rows[k][0] or 0) for k in members)
        assert [(rows[k][0] is None, rows[k][0] or 0) for k in got if k in members] == [low]
    leaks = [k for k in range(len(rows)) if 100 * len(sets[k] & shingles(item)) >= 80 * len(shingles(item))]
    assert leaks == [5, 6] and kept(P.benchmark(spark, docs, str(tmp_path))) == [k for k in range(len(rows)) if k not in leaks]
    left = {int(r["row"]): r for r in P.lines(spark, docs, str(tmp_path)).collect()}
    assert all(r["n_chars"] is None or r["n_chars"] == len(r["text"]) for r in left.values())
    # a null id comes first: row 2 keeps the lines that rows 0, 1 and 3 repeat
    assert {2, 8, 9, 10, 11, 12} <= set(left) and not {0, 1, 3, 13} & set(left) and left[2]["text"] == BASE
    tokens = P.tokens(spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["decoded_sha256"]) for r in tokens) == sorted(
        (i or 0, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    for stage in (P.lines, P.benchmark, P.tokens):
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs.count()
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        new = spark.read.parquet(str(tmp_path / name))
        if name != P.STAGES[-1][0]:
            assert new.columns == docs.columns
        assert new.count() <= left
        left, docs = new.count(), new
    assert left > 50


def test_classifier_holds_one_number_a_word():
    import numpy as np
    import xxhash

    from tillhouse.llm import quality_classifier as q
    q._MEMO.clear()
    text = "The the THE naïve Äpfel 12,5 -- x_y a1B2 ... ▁ the"
    got = q.token_rows(text)
    low = [re.sub(r"[^\w]+", "", w.lower()) for w in text.split()]
    assert got.tolist() == [[xxhash.xxh3_64_intdigest(w) % q.WORDS for w in low],
                            [q.WORDS + xxhash.xxh3_64_intdigest(q._shape(w)) % q.SHAPES for w in text.split()]]
    assert len(q._MEMO) == len(set(text.split())) and all(isinstance(v, int) for v in q._MEMO.values())
    assert q.token_rows(None).shape == q.token_rows(" \n").shape == (2, 0) and q.token_rows("a").dtype == np.int64
