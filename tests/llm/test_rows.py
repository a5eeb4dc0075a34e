"""Rows that share an id or have none, columns that clash, and the order of training."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from plazaworks.llm import bpe, consensus, decontaminate, ring, subspace  # noqa: F401
from plazaworks.llm.common import written


def test_vectors_that_share_an_id(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((10, 16))
    rows = [(int(rng.integers(0, 25)), (base[i % 10] + 0.2 * rng.standard_normal(16)).tolist()) for i in range(80)]
    rows += [rows[0], rows[1], (None, rows[2][1]), (None, rows[2][1]), (7, None), (7, [0.0] * 16)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, node int, component int")
    sound = [n for n, (i, v) in enumerate(rows) if i is not None and v and any(v)]
    x = np.array([rows[n][1] for n in sound])
    near = x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1)) >= 0.9
    links = near.sum(axis=1) - 1
    root = np.array([rows[n][0] for n in sound])
    for _ in sound:
        root = np.where(near, root[None, :], root.max() + 1).min(axis=1)
    want = [(rows[n][0], int(k), int(r), rows[n][0] == r) for n, k, r in zip(sound, links, root, strict=True)]
    want += [(None, 0, None, True)] * 2 + [(7, 0, 7, True)] * 2
    got = [tuple(r) for r in subspace.linked_vectors(table).select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert max(links) > 3 and len(set(root.tolist())) > 3


def words(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w for w in re.split("[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+", lowered) if w]


ITEM = "the quick brown fox jumps over the lazy dog while nine zebras watch quietly"
ROWS = [
    (5, "other words only"), (5, f"before {ITEM.upper()} after"), (None, ITEM), (None, "nothing here"), (None, None), (6, ""), (6, "short item"), (7, " ".join(ITEM.split()[:9])),
    (8, " ".join(ITEM.split()[2:12]) + " x " + " ".join(ITEM.split()[3:])), (9, "word " * 20000 + ITEM), (5, f"before {ITEM.upper()} after"),
]
BENCHMARK = [("i1", ITEM), ("i2", "short item"), ("i2", "short item"), (None, "x"), ("i3", None), ("i4", "")]


def hits(text, items, width=10):
    w, spots, found = words(text), set(), set()
    for item, phrase in items:
        t = words(phrase)
        for i in range(max(1, len(t) - width + 1)) if t else ():
            window = t[i : i + width]
            for at in range(len(w) - len(window) + 1):
                if w[at : at + len(window)] == window:
                    spots.update(range(at, at + len(window)))
                    if item is not None:
                        found.add(item)
    return len(w), len(spots), found


@pytest.fixture
def contaminated(spark):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in ROWS], "doc_id long, text string, row string, n_hit int")
    items = [(None if i is None else int(i[1:]), t) for i, t in BENCHMARK]
    return docs, spark.createDataFrame(items, "item_id long, text string"), items


def test_rows_keep_their_own_hits(contaminated):
    docs, benchmark, items = contaminated
    want = []
    for i, t in ROWS:
        n, spots, found = hits(t, items)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        want.append((i, n, spots, len(found), digest, spots > 0))
    got = [tuple(r) for r in decontaminate.contamination(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_rows_without_an_id_leave_the_pipeline(contaminated, spark, tmp_path):
    docs, benchmark, items = contaminated
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = P.drop_benchmark(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(((i, t) for i, t in ROWS if not hits(t, items)[1]), key=str)


def test_training_order_reaches_the_shards(spark):
    """Every row of the mix keeps its place; in each shard the places rise with the position that the mix gave."""
    rows = [(i, f"doc {i} " + "w " * (i % 7 + 1), f"s{i % 4}", i, "a") for i in range(200)] + [(None, "no id", "s1", 0, "b"), (3, "again", "s1", 0, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, training_position int, taken_id string")
    mixed = written(P.mix_sources(spark, docs, ""), "mixed")
    assert mixed.columns == docs.columns
    out = P.shard(spark, mixed, "")
    assert out.count() == mixed.count() and out.select("training_part", "training_row").distinct().count() == mixed.count()
    places = mixed.select("doc_id", F.col("_metadata.file_name").alias("training_part"), F.col("_metadata.row_index").alias("training_row"))
    both = out.join(places.withColumnRenamed("doc_id", "d"), ["training_part", "training_row"])
    assert both.where(~F.col("doc_id").eqNullSafe(F.col("d"))).count() == 0
    # the mix is sorted: its first rows stand earlier than its last ones
    from plazaworks.llm import curriculum

    first = {r["doc_id"]: r["position"] for r in curriculum.mix(docs.select("doc_id", "text", "source")).where("passes = 1").collect()}
    order = [r["doc_id"] for r in out.orderBy("training_part", "training_row").collect() if r["doc_id"] in first and r["doc_id"] not in (None, 3)]
    position = [first[d] for d in order]
    assert position == sorted(position) and len(position) > 20
    # rows that were never written have no place
    assert P.shard(spark, docs, "").where("training_row is not null").count() == 0


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_ring_against_brute_force(spark, shards):
    """With room for all, rows stand with the next point clockwise; without, counts differ by one at most."""
    rows = [(i if i % 11 else None, "x" * (i % 5)) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = {r["doc_id"]: r["p"] for r in docs.select("doc_id", F.xxhash64("doc_id").alias("p")).collect()}
    points = ring.ring(shards)
    free = ring.bounded_ring(docs, shards, slack=1000.0).collect()
    assert all(r["shard"] == ring.owner_of(places[r["doc_id"]], points) for r in free)
    tight = ring.bounded_ring(docs, shards).collect()
    counts = [sum(r["shard"] == s for r in tight) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 700
    for found in (free, tight):
        for s in range(shards):
            slots = sorted(r["slot"] for r in found if r["shard"] == s)
            assert slots == list(range(len(slots)))
    # a row moves on only where its own shard is full
    cap = max(counts)
    for r in tight:
        own = ring.owner_of(places[r["doc_id"]], points)
        assert r["shard"] == own or counts[own] >= cap - 1


def page(body):
    return consensus.Page(f"<html><body>{body}</body></html>")


STORY = "".join(f"<p>Sentence number {i} of the story, long enough to count as text of its own.</p>" for i in range(8))


def test_a_winner_that_holds_little_does_not_take_the_page():
    p = page(f'<div class="content">small</div><div class="story">{STORY}</div>')
    paths = sorted({x for x, _, _ in p.blocks})
    for winners in (paths, paths[::-1], [x for x in paths if "content" in x], []):
        assert consensus.main_text(p, winners).count("Sentence number") == 8
        assert "small" not in consensus.main_text(p, winners)


def test_a_winner_takes_the_page_it_fits():
    p = page(f'<div class="story">{STORY}</div><div class="extra"><p>More of it, but not much.</p></div>')
    story = next(x for x, _, _ in p.blocks if "story" in x)
    assert consensus.main_text(p, [story]).count("Sentence number") == 8
    assert consensus.main_text(page(""), [story]) == ""


@pytest.mark.parametrize("large", [1, 3, 1000])
def test_pages_of_large_and_small_hosts(spark, monkeypatch, large):
    """One host has two thirds of the pages; how hosts are dealt does not change a text."""
    monkeypatch.setattr(consensus, "LARGE_HOSTS", large)
    body = lambda n: f'<html><body><div class="menu"><a href="#">Home</a></div><div class="story-{n % 3}">{STORY}<p>Page {n}.</p></div></body></html>'
    rows = [(i if i % 7 else None, f"http://{'big.example' if i % 3 else f'h{i % 13}.example'}/p{i}", body(i)) for i in range(90)]
    rows += [(1, None, body(1)), (2, "no url", body(2)), (3, "http://big.example/x", None), (3, "http://big.example/x", None), (4, "http://h1.example", "<p>" + "long text of a page " * 20000 + "</p>")]
    pages = spark.createDataFrame([(*r, "x", 0) for r in rows], "page_id long, url string, html string, host string, winners int")
    got = consensus.extract_main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(rows)
    out = [tuple(r) for r in got.collect()]
    assert sum(t.count("Sentence number") == 8 and "Home" not in t for _, _, t, _ in out) == 92
    assert all(n == len(t) for _, _, t, n in out) and sum(not t for _, _, t, _ in out) == 2
    assert any(n > 300_000 for _, _, _, n in out)
    assert consensus.extract_main_text(pages.limit(0)).count() == 0
