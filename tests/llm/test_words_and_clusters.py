"""Spelling variants, BPE and centroid clusters against brute force and the library they must agree with."""

import hashlib
import re
import sys
import unicodedata
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plazaworks.llm import bisector, bpe, variants

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# ---- spelling variants ----------------------------------------------------


def counted(rows, typo_every=199, shortest=6, least=5):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % typo_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= shortest:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def variants_of(n, times=5):
    heads = defaultdict(list)  # words one edit apart share what is left when a letter of each, or of one, is gone
    for w in n:
        for left in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            heads[left].append(w)
    near = defaultdict(set)
    for group in heads.values():
        for a in group:
            near[a].update(b for b in group if one_apart(a, b))
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def found(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_variants_of_whole_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    want = variants_of(counted([tuple(r) for r in docs.collect()]))
    assert len(want) > 500 and any(r[1] for r in want)
    assert found(variants.spelling_variants(docs)) == want


def test_variants_of_random_words(spark):
    """Few letters, so that every word has many near ones, at every place, in chains of forms."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aé÷"), rng.integers(5, 8))) for _ in range(900)]
    rows = [(i, " ".join([w] * int(rng.choice([5, 6, 30, 160, 900])))) for i, w in enumerate(words)]
    want = variants_of(counted(rows))
    assert any(r[2] not in (r[0], r[1]) for r in want)  # a chain of two forms at least
    assert found(variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_variants_of_a_hot_beginning(spark, monkeypatch):
    """Words that all begin alike are cut into slices; every pair is still counted once."""
    monkeypatch.setattr(variants, "BLOCK", 64)
    rows = [(f"prefix{a}{b}{c}", 5 + k) for k, (a, b, c) in enumerate((a, b, c) for a in "abcdefgh" for b in "abcdefgh" for c in "abcde")]
    near = variants.near_words(spark.createDataFrame(rows, "word string, n long"))
    assert variants._units(spark.createDataFrame(rows, "word string, n long")).where("slice > 0").count() > 0
    got = {(r["word"], r["n_near"], r["form"], r["form_n"]) for r in near.collect()}
    n = dict(rows)
    want = set()
    for w in n:
        close = [x for x in n if one_apart(w, x)]
        best = min(close, key=lambda x: (-n[x], x))
        want.add((w, len(close), best, n[best]))
    assert got == want


def test_variants_of_odd_rows(spark):
    long = "ab" * 3000
    rows = [(None, "Rivers " * 5), (1, None), (2, ""), (3, " ".join([long, long + "c"] * 6)), (4, "riverz, RIVERS; rivers!" * 30), (4, "riverz, RIVERS; rivers!" * 30), (5, "Äpfelchen äpfelchen " * 6)]
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n int, word string, form string")
    assert found(variants.spelling_variants(docs)) == variants_of(counted(rows))
    empty = variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


# ---- BPE ------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def own():
    return bpe.read_vocabulary(VOCABULARY)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def odd_texts():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    marks = [c for c in points if unicodedata.combining(c)]
    rng = np.random.default_rng(3)
    letters = [*map(chr, range(32, 0x250)), *map(chr, range(0x370, 0x530)), "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "'S", "'ll", " \n", "\x1c", "\x85", "ſ", "İ", "ΑΣ ", "가", "각"]
    some = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(1500)]
    stacked = ["".join(points[rng.integers(len(points))] + marks[rng.integers(len(marks))] + marks[rng.integers(len(marks))] for _ in range(6)) for _ in range(1500)]
    whole = ["".join(points), " ".join(points), "a".join(points), "a" * 3001, "aab" * 2000, "the " * 9000, "<|endoftext|>" * 3, "", " "]
    return some + stacked + whole


def test_encoder_agrees_with_the_library(library, own):
    texts = odd_texts()
    got = list(bpe.Encoder(own, remembered=5000).encode(texts))
    for text, (ids, decoded) in zip(texts, got, strict=True):
        want = expected(library, text)
        assert (np.frombuffer(ids, "<u4").tolist(), decoded.decode()) == want, text[:80]
        assert bpe.decode(want[0], own) == want[1]


def test_whole_documents_agree_with_the_library(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in bpe.digests(docs, VOCABULARY).collect():
        ids, text = expected(library, rows[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_merges_that_make_lower_pairs_go_one_at_a_time(own):
    """A made-up vocabulary in which one merge makes a pair of lower rank: 'cab' again and again."""
    tokens = ["a", "b", "c", "ab", "ca", "abc"]
    v = own._replace(
        first=np.array([[0] * 256, [0] * 256], np.int32), tokens=tokens,
        keys=np.array([0 * 6 + 1, 2 * 6 + 0, 3 * 6 + 2]), ranks=np.array([2, 1, 0], np.int32), made=np.array([5, 4, 3], np.int32), alone=np.array([False, False, True]),
    )
    v.first[:, ord("a")], v.first[:, ord("b")], v.first[:, ord("c")] = 0, 1, 2
    # leftmost 'ab' merges, then its 'abc' before the next 'ab'; 'ca' goes before any 'ab'
    assert bpe.encode_words([b"abcbab", b"abab", b"cab"], v)[0].tolist() == [5, 1, 3]


def test_encoding_odd_rows(spark, library):
    rows = [(None, None), (1, None), (2, ""), (3, "Hello  World"), (3, "Hello  World"), (None, "x" * 20000), (4, "word " * 50000)]
    docs = spark.createDataFrame([(i, t, 7, "z") for i, t in rows], "doc_id long, text string, n_tokens int, ids string")
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids"], r["decoded"]) for r in bpe.encode(docs, VOCABULARY).collect())
    want = sorted((str(i), len(e[0]), e[0], e[1]) for i, t in rows for e in [expected(library, t)])
    assert got == want
    assert bpe.encode(docs.limit(0), VOCABULARY).count() == 0


def test_word_patterns_by_reach_find_the_same_words(own):
    """A text's words are found by the pattern of its largest code point, which tries no range beyond it."""
    letters, numbers = (bpe._class(k, new, sys.maxunicode) for k, new in (("L", bpe.NEW_LETTERS), ("N", bpe.NEW_NUMBERS)))
    want = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{bpe.BLANKS}{letters}{numbers}]+").findall
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for most, pattern in zip(bpe.REACHES, own.words, strict=True):
        within = [c for c in points if ord(c) <= most]
        for text in ["".join(within), " ".join(within), "a".join(within), "it's !'s 'll'd 're''ve I'm '5't x'"]:
            assert re.findall(pattern, text) == want(text)
        assert all(int(c, 16) <= most for c in re.findall(r"\\U([0-9a-f]{8})", pattern))


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


# ---- centroid clusters ----------------------------------------------------


def clusters_of(rows, k, dims, rounds, seed=2):
    kept = [(i, [floor(256 * Fraction(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min((apart(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, v), (_, j) in zip(kept, assign(), strict=True):
            groups[j].append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if groups[j] else c for j, c in enumerate(centroids)]
    placed = assign()
    fit = lambda x: x if x < 2**63 else None
    whole = sum(d for d, _ in placed)
    inertia = Counter()
    for d, j in placed:
        inertia[j] += d
    big = {j for d, j in placed if d >= 2**63}
    return sorted(
        (str(i), j, fit(d), None if j in big else fit(inertia[j]), None if big else fit(whole), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(kept, placed, strict=True)
    )


def placed(df):
    return sorted((str(r["vec_id"]), *list(r)[1:]) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


def test_clusters_with_ties_and_repeats(spark):
    """A coarse grid: many vectors stand as near to one centroid as to another, and many are equal."""
    rng = np.random.default_rng(11)
    rows = [(int(i % 90), [float(x) for x in rng.integers(-2, 3, 4) / 256]) for i in range(300)]
    assert placed(bisector.clusters(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 12, 4, 4)) == clusters_of(rows, 12, 4, 4)


def test_clusters_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [0.5, -0.25]), (None, [0.1, -0.2]), (7, [0.0, 0.0]), (7, [0.0, 0.0]), (8, [-0.001, 0.001]), (9, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame([(i, v, 3, "c") for i, v in rows], "vec_id long, embedding array<float>, cluster int, distance string")
    want = clusters_of([(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 3, 2, 2)
    assert placed(bisector.clusters(table, 3, 2, 2)) == want and len(want) == 5
    for none in (table.limit(0), table.where("vec_id < 7")):
        got = bisector.clusters(none, 3, 2, 2)
        assert got.count() == 0 and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("size", [2.0**20, 2.0**40, 1e30, 1e300])
def test_clusters_of_huge_vectors(spark, size):
    """Numbers that no long holds are exact still; a distance too large for one is null."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=3) * (size if i % 3 == 0 else 1)]) for i in range(60)] + [(99, [1.7e308, -1.7e308, 0.0])] * (size > 1e100)
    assert placed(bisector.clusters(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 3, 3)) == clusters_of(rows, 5, 3, 3)


def test_tournament_finds_the_nearest():
    rng = np.random.default_rng(8)
    centroids = rng.integers(-5, 5, (17, 3))
    x = rng.integers(-6, 6, (500, 3))
    holder, distance = bisector.nearest(x, bisector.tournament(centroids.tolist()))
    apart = ((x[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    assert (holder == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
