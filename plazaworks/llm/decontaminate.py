"""Benchmark decontamination with a distributed positional inverted index."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import partial
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, rows_of, written

WINDOW = 10  # words
ANCHORS = 3  # rarest terms of a window whose posting lists are intersected
FILTER_BITS = 20  # the filter sent to the tasks has 2^20 places, however large the benchmark


def _places(words: list[bytes]) -> np.ndarray:
    flat = np.empty(len(words), object)
    flat[:] = words
    return (pd.util.hash_array(flat, categorize=False) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _hash_terms(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for terms in batches:
        yield pd.Series(_places([t.encode("utf-8", "surrogatepass") for t in terms]))


def term_filter(terms: DataFrame) -> bytes:
    """One bit per hash place that a term (column ``term``) falls on; at most 2^20 numbers come to the driver."""
    place = F.pandas_udf(_hash_terms, "long")
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[[r[0] for r in terms.select(place("term").alias("p")).distinct().collect()]] = True
    return np.packbits(bits).tobytes()


def _n_words(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([len(alnum_words(t)) for t in batch], dtype="int64")


def _windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        ids, terms = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = [w.decode("utf-8", "surrogatepass") for w in alnum_words(text)]
            own = [words[i : i + width] for i in range(max(1, len(words) - width + 1))] if words else []
            ids += [item] * len(own)
            terms += own
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.list_(pa.string()))], names=["item_id", "terms"])


def windows_of(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, terms, phrase): the windows of every item; a shorter item is one window, one without words has none."""
    found = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(partial(_windows, width=width), "item_id long, terms array<string>")
    return found.withColumn("phrase", F.concat_ws(" ", "terms")).distinct()


def _counts(batches: Iterator[pa.RecordBatch], bits: bytes) -> Iterator[pa.RecordBatch]:
    known, total = np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool), Counter()
    for batch in rows_of(batches):
        for text in batch.column(0).to_pylist():
            if words := alnum_words(text):
                total.update(compress(words, known[_places(words)]))
        if len(total) > 200_000:
            yield _counted(total)
            total.clear()
    yield _counted(total)


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([t.decode("utf-8", "surrogatepass") for t in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])


def _postings(batches: Iterator[pa.RecordBatch], bits: bytes) -> Iterator[pa.RecordBatch]:
    known = np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool)
    for batch in rows_of(batches):
        terms, ids, lists = [], [], []
        known_ids = batch.column(0).is_valid().to_pylist()
        for row, (valid, text) in enumerate(zip(known_ids, batch.column(1).to_pylist(), strict=True)):
            words = alnum_words(text)
            if not valid or not words:
                continue
            own = defaultdict(list)
            for at in np.flatnonzero(known[_places(words)]).tolist():
                own[words[at]].append(at)
            terms += [t.decode("utf-8", "surrogatepass") for t in own]
            ids += [row] * len(own)
            lists += own.values()
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), batch.column(0).take(pa.array(ids, pa.int32())), pa.array(lists, pa.list_(pa.int32()))], names=["term", "doc_id", "positions"])


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, doc_id, positions) of the given terms in all documents, written to the shared folder.

    Documents are told apart by doc_id, of any type; one without it is left out.
    """
    bits = term_filter(terms)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("doc_id", "text").mapInArrow(partial(_postings, bits=bits), f"term string, doc_id {kind}, positions array<int>"), "index")


def anchored(docs: DataFrame, windows: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """(phrase, terms, anchors): every distinct window with its rarest terms and their offsets, rarest first.

    A term's rarity is its number of places in the whole corpus.
    """
    spots = windows.select("phrase", "terms").distinct().select("phrase", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "term"))
    vocabulary = spots.select("term").distinct()
    counts = docs.select("text").mapInArrow(partial(_counts, bits=term_filter(vocabulary)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    ranked = spots.drop("n").join(counts, "term", "left").groupBy("phrase").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset"))).alias("r")
    )
    rare = F.slice("r", 1, anchors)
    # a window in which no document can stand has a term without places
    return ranked.where("r[0].n > 0").select("phrase", F.size("r").alias("len"), F.transform(rare, lambda x: F.struct(x["term"].alias("term"), x["offset"].alias("offset"))).alias("anchors"))


def _candidates(index: DataFrame, windows: DataFrame, anchors: int, slack: int | None) -> DataFrame:
    """(doc_id, phrase, len, start): places where the anchors' lists agree, intersected from the rarest on.

    Without ``slack`` lists are shifted by the offset in the window and must
    meet; with it the other anchors may stand anywhere within the window's
    length plus ``slack``.
    """
    first = windows.select("*", F.col("anchors")[0]["term"].alias("term"), F.col("anchors")[0]["offset"].alias("offset"))
    found = first.join(index, "term").select("phrase", "len", "anchors", "doc_id", F.explode("positions").alias("at"), "offset")
    found = found.withColumn("start", F.col("at") - F.col("offset")).drop("at")
    for k in range(1, anchors):
        # a window with fewer words goes on with its last anchor
        own = F.col("anchors")[F.least(F.lit(k), F.size("anchors") - 1)]
        found = found.select("phrase", "len", "anchors", "doc_id", "start", "offset", own["term"].alias("term"), own["offset"].alias("other"))
        joined = found.join(index, ["term", "doc_id"])
        if slack is None:
            meets = F.array_contains("positions", F.col("start") + F.col("other"))
        else:
            reach = F.col("len") + F.lit(slack) - 1
            meets = F.exists("positions", lambda p: F.abs(p - F.col("start") - F.col("offset")) <= reach)
        found = joined.where(meets).select("phrase", "len", "anchors", "doc_id", "start", "offset")
    return found.select("doc_id", "phrase", "len", (F.col("start") + (0 if slack is None else F.col("offset"))).alias("start"))


def _confirm(batches: Iterator[pa.RecordBatch], slack: int | None) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        ids, phrases, starts, ends = [], [], [], []
        for doc, (text, wanted) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("text", "wanted")), strict=True)):
            words = alnum_words(text)
            for w in wanted:
                terms = w["phrase"].encode("utf-8", "surrogatepass").split()
                spans = [w["start"]] if slack is None and words[max(0, w["start"]) : w["start"] + len(terms)] == terms and w["start"] >= 0 else []
                length = len(terms)
                if slack is not None:
                    length += slack
                    need = Counter(terms)
                    spans = [s for s in range(max(0, w["start"] - length + 1), w["start"] + 1) if not need - Counter(words[s : s + length])][:1]
                for s in spans:
                    ids.append(doc)
                    phrases.append(w["phrase"])
                    starts.append(s)
                    ends.append(min(len(words), s + length))
        kept = [n for n in batch.schema.names if n not in ("text", "wanted")]
        rows = [batch.column(n).take(pa.array(ids, pa.int32())) for n in kept]
        yield pa.RecordBatch.from_arrays([*rows, pa.array(phrases, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=[*kept, "phrase", "start", "end"])


def matches(docs: DataFrame, windows: DataFrame, anchors: int = ANCHORS, slack: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, columns to ``keep``, phrase, start, end): occurrences of windows in documents, in words from 0, the end excluded.

    Without ``slack`` the exact phrases; with it the proximity matches, places
    where all words of a window stand in any order within its length plus
    ``slack`` words.
    """
    texts = docs.select("doc_id", *keep, "text")
    kinds = "".join(f"{c} {texts.schema[c].dataType.simpleString()}, " for c in ("doc_id", *keep))
    rare = written(anchored(texts, windows, anchors), "anchored")
    index = build_index(texts, rare.select(F.explode("anchors.term").alias("term")).distinct())
    found = _candidates(index, rare, anchors, slack).groupBy("doc_id").agg(F.collect_set(F.struct("phrase", "start")).alias("wanted"))
    return texts.join(found, "doc_id").mapInArrow(partial(_confirm, slack=slack), f"{kinds}phrase string, start int, end int").distinct()


ROW = ["_row", "_check"]


def row_key() -> list[Column]:
    """128 bits of a row's doc_id and text, so that rows that share an id or have none keep their own hits.

    The index goes by the first half; what it finds is confirmed on each text
    and then told apart by both.
    """
    named = F.col("doc_id").cast("string")
    return [F.xxhash64(F.lit(half), named, F.isnull("doc_id"), "text").alias(n) for half, n in enumerate(ROW)]


def row_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(row key, n_hit, n_items, items) of the rows of ``docs`` that hold a window of ``windows``."""
    first, second = row_key()
    found = matches(docs.select(first.alias("doc_id"), second, "text"), windows, keep=ROW[1:])
    found = written(found.withColumnRenamed("doc_id", ROW[0]), "matches")
    hits = found.select(*ROW, F.explode(F.sequence("start", F.col("end") - 1)).alias("at")).distinct().groupBy(*ROW).agg(F.count(F.lit(1)).alias("n_hit"))
    items = found.select(*ROW, "phrase").distinct().join(windows.where("item_id is not null").select("phrase", "item_id"), "phrase").select(*ROW, F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy(*ROW).agg(F.count(F.lit(1)).alias("n_items"), F.concat_ws(",", F.array_sort(F.collect_list("item"))).alias("items"))
    return hits.join(items, ROW, "left")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Hit words and items of every row of ``docs`` (doc_id, text) against ``benchmark`` (item_id, text).

    Columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. A word
    is hit if it stands inside an occurrence of any window of any item. Windows
    are searched in the index from their rarest term on, and candidates are
    confirmed on the words of the text. Null or empty texts have no words, null
    or empty items no windows. Every row is searched by itself: rows that share
    a doc_id, or have none, have the hits of their own text. Repeated items count
    once. Other columns are ignored.
    """
    windows = written(windows_of(benchmark, width), "windows")
    rows = docs.select("doc_id", *row_key(), F.pandas_udf(_n_words, "long")("text").alias("n_words"))
    out = rows.join(row_hits(docs, windows), ROW, "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with all their columns; null texts hold none."""
    windows = written(windows_of(benchmark, width), "windows")
    hit = row_hits(docs, windows).select(*[F.col(n).alias(f"{n}_hit") for n in ROW])
    same = [k == F.col(f"{n}_hit") for k, n in zip(row_key(), ROW, strict=True)]
    return docs.join(hit, same[0] & same[1], "left_anti")
