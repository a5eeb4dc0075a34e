"""Spelling variants: words of a vocabulary that are one letter apart, by a bit-sliced position index."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = "[^A-Za-zÀ-ÿ]+"
BLOCK = 4096  # words of a block of the index
LETTERS = 1 << 16  # letters of a block, so that long words make small blocks
CELLS = 1 << 16  # 64-bit words of a set of query rows


def vocabulary(docs: DataFrame, typo_every: int = 199, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of the runs of letters of ``docs`` (doc_id, text).

    A run loses the letter at h % length where ``typo_every`` divides h, the
    crc32 of its document's id and the run; words are counted after that.
    """
    run = F.col("run")
    # most runs are in lower case already, and shorter ones cannot become words
    runs = docs.select("doc_id", F.explode(F.split(F.col("text").cast("string"), BETWEEN)).alias("run")).where(F.char_length("run") >= shortest)
    runs = runs.select("doc_id", F.when(run.rlike("[A-Z]"), F.translate(run, UPPER, LOWER)).otherwise(run).alias("run"))
    runs = runs.select("run", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run)).alias("h"))
    at = (F.col("h") % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    words = runs.select(F.when(F.col("h") % typo_every == 0, cut).otherwise(run).alias("word")).where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


class Index(NamedTuple):
    """Bitsets over the words of a block: bit w of ``bits[slot[p, c]]`` says whether word w has letter c at position p."""

    bits: np.ndarray  # (sets, 64-bit words); set 0 is empty
    slot: np.ndarray  # (positions, 256)
    exact: np.ndarray  # words of the shorter length of their unit
    longer: np.ndarray  # words of one letter more


def _bitset(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words, the first flag lowest."""
    wide = -(-flags.shape[-1] // 64) * 64
    padded = np.zeros((*flags.shape[:-1], wide), np.uint8)
    padded[..., : flags.shape[-1]] = flags
    return np.packbits(padded, axis=-1, bitorder="little").view("<u8").astype(np.uint64)


def build_index(letters: np.ndarray, sizes: np.ndarray, short: int) -> Index:
    """Index of words given as rows of letters (0 after their end), of ``short`` or ``short`` + 1 letters."""
    used = [np.unique(column[column > 0]) for column in letters.T]
    slot = np.zeros((letters.shape[1] + 2, 256), np.int32)
    sets, n = [np.zeros((1, len(letters)), bool)], 1
    for p, present in enumerate(used):
        slot[p, present] = np.arange(n, n + len(present))
        n += len(present)
        sets.append(letters[:, p][None, :] == present[:, None])
    return Index(_bitset(np.concatenate(sets)), slot, _bitset(sizes == short), _bitset(sizes == short + 1))


def within_one(query: np.ndarray, short: int, half: int, index: Index) -> np.ndarray:
    """Bitsets of the words of the index one edit from each query that begin with the same ``half`` letters.

    ``query`` holds words of one length as rows of letters. All words of the
    block are followed at once: ``zero`` are those equal so far, and beside it
    stand those with one error so far, at the position that the error shifts
    them to. A query of ``short`` letters finds words of the same length with
    another letter, and longer ones with one more; a query of one letter more
    finds the shorter ones.
    """
    shape = (len(query), index.bits.shape[1])
    zero = np.full(shape, np.uint64(0xFFFFFFFFFFFFFFFF))
    other, more, less = (np.zeros(shape, np.uint64) for _ in range(3))
    same = None
    equal = query.shape[1] == short
    for i in range(query.shape[1]):
        here = index.bits[index.slot[i, query[:, i]]]
        if equal:
            more = (more | zero) & index.bits[index.slot[i + 1, query[:, i]]]  # the word has a letter more before this one
            other = (other & here) | (zero & ~here)  # another letter at this position
        else:
            less = (less & index.bits[index.slot[i - 1, query[:, i]]]) | zero if i else zero.copy()  # the word lacks this letter
        zero &= here
        if i + 1 == half:
            same = zero.copy()
    found = (other & index.exact) | ((more | zero) & index.longer) if equal else less & index.exact
    return found & same


def _matrix(words: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)


def _pairs(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, word) of every bit."""
    row, cell = np.nonzero(found)
    bits = np.unpackbits(found[row, cell].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return row[at], cell[at] * 64 + bit


class _Block:
    """Units of one side and one shorter length; answers are kept per query."""

    def __init__(self, short: int, back: bool):
        self.short, self.back = short, back
        self.half = short - short // 2 if back else short // 2  # letters that a pair of this side has in common
        self.units: list[int] = []
        self.words: list[bytes] = []
        self.counts: list[int] = []
        self.queries: list[tuple[int, bytes]] = []

    def answers(self) -> Iterator[tuple[bytes, int, int, bytes]]:
        """(query, number of near words, largest count, its word) of every query with a near word."""
        if not self.words or not self.queries:
            self.queries = []
            return
        sizes = np.array([len(w) for w in self.words])
        index = build_index(_matrix(self.words, self.short + 1), sizes, self.short)
        counts, units = np.array(self.counts, np.int64), np.array(self.units)
        forward = [w[::-1] for w in self.words] if self.back else self.words
        names = np.array(forward, f"S{self.short + 1}")
        order = np.lexsort((names, -counts))  # best words first
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        step = max(1, CELLS // index.bits.shape[1])
        for size in (self.short, self.short + 1):
            mine = [q for q in self.queries if len(q[1]) == size]
            for at in range(0, len(mine), step):
                part = mine[at : at + step]
                row, word = _pairs(within_one(_matrix([q for _, q in part], size), self.short, self.half, index))
                keep = np.array([u for u, _ in part])[row] == units[word]
                if self.back and len(row):  # pairs that begin alike are found by the other side
                    head = self.short // 2
                    begins = np.array([q[::-1][:head] for _, q in part], f"S{head}")
                    keep &= begins[row] != names.astype(f"S{head}")[word]
                row, word = row[keep], word[keep]
                if len(row):
                    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                    best = order[np.minimum.reduceat(place[word], first)]
                    for r, total, b in zip(row[first].tolist(), np.diff(np.append(first, len(row))).tolist(), best.tolist(), strict=True):
                        q = part[r][1]
                        yield q[::-1] if self.back else q, total, int(counts[b]), forward[b]
        self.queries = []


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of the queries of each unit; rows come sorted by unit, and within one the words of the index first."""
    out: list[tuple[bytes, int, int, bytes]] = []
    block, unit, last = _Block(0, False), -1, None
    for batch in batches:
        short, back, queried, counts = (batch.column(n).to_pylist() for n in ("short", "back", "queried", "n"))
        keys, slices, words = (batch.column(n).to_pylist() for n in ("key", "slice", "word"))
        for s, b, k, j, q, n, word in zip(short, back, keys, slices, queried, counts, words, strict=True):
            now = (s, b, k, j)
            if now != last:
                unit, last = unit + 1, now
                room = max(64, min(BLOCK, LETTERS // s))
                if (block.short, block.back) != (s, b) or len(block.words) + len(block.queries) >= room:
                    out += block.answers()
                    block = _Block(s, b)
            letters = word.encode("latin-1")
            letters = letters[::-1] if b else letters
            if q:
                block.queries.append((unit, letters))
                if len(block.queries) >= 2 * BLOCK:
                    out += block.answers()
            else:
                block.units.append(unit)
                block.words.append(letters)
                block.counts.append(n)
        if len(out) >= 1 << 14:
            yield _answer_batch(out)
            out = []
    out += block.answers()
    if out:
        yield _answer_batch(out)


def _answer_batch(rows: list[tuple[bytes, int, int, bytes]]) -> pa.RecordBatch:
    words, totals, counts, best = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([w.decode("latin-1") for w in words]), pa.array(totals, pa.int64()), pa.array(counts, pa.int64()), pa.array([w.decode("latin-1") for w in best])],
        names=["word", "n_near", "form_n", "form"],
    )


def _units(words: DataFrame) -> DataFrame:
    """Index rows and query rows of all units: short, back, key, slice, queried, word, n.

    Two words one edit apart, the shorter of them of m letters, begin with the
    same m // 2 letters or end with the same others. So each word stands, on
    either side, with the words of its own length and one more, and with those
    of its length and one less. A unit that holds more words than a block is
    cut into slices of the index, each of which gets all its queries.
    """
    size = F.char_length("word")
    places = F.array(*[F.struct((size - less).alias("short"), F.lit(back).alias("back")) for less in (0, 1) for back in (False, True)])
    rows = words.select("word", "n", F.explode(places).alias("p")).select("word", "n", "p.short", "p.back")
    half = F.floor(F.col("short") / 2).cast("int")
    key = F.when(F.col("back"), F.right(F.col("word"), F.col("short") - half)).otherwise(F.left(F.col("word"), half))
    rows = rows.select("word", "n", "short", "back", key.alias("key"))
    room = F.greatest(F.lit(64), F.least(F.lit(BLOCK), F.floor(F.lit(LETTERS) / F.col("short"))))
    unit = ["short", "back", "key"]
    large = rows.groupBy(*unit).agg(F.ceil(F.count(F.lit(1)) / F.first(room)).cast("int").alias("slices")).where("slices > 1")
    rows = rows.join(large, unit, "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    index = rows.select(*unit, F.pmod(F.xxhash64("word"), F.col("slices")).cast("int").alias("slice"), F.lit(False).alias("queried"), "word", "n")
    queries = rows.select(*unit, F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(True).alias("queried"), "word", "n")
    return index.union(queries)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of the words of ``words`` (word, n) that have a near word; form is the one of largest n."""
    unit = ["short", "back", "key", "slice"]
    dealt = _units(words).repartition(*unit).sortWithinPartitions(*unit, "queried")
    found = dealt.mapInArrow(_search, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.form").alias("form"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of the words of ``links`` (word, form), following forms to the last.

    Every round doubles the steps followed. Counts grow along a chain, so there
    are no circles, and the number of rounds is that of the logarithm of the
    longest chain.
    """
    reached = links.select("word", F.col("form").alias("root"))
    while True:
        after = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reached.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = written(step, "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        reached = step.select("word", "root")


def spelling_variants(docs: DataFrame, times: int = 5) -> DataFrame:
    """Words of ``docs`` (doc_id, text) with the form they are probably a variant of: word, form, root, n, n_near, form_n.

    Two words are near where one letter more, less or other parts them. A word's
    form is its near word of largest count (the smallest in code-point order of
    equals) where that is at least ``times`` its own; the root is the last form
    of the chain. Only words with all their near words counted are compared, in
    blocks of bounded size: no pairs are listed beyond a block and no word or
    document is left out.

    Null and empty texts have no words; a null doc_id stands for empty text
    where a run's checksum is made. Repeated rows count again. Very long runs
    make small blocks. Without words the result is empty. Other columns are
    ignored.
    """
    words = written(vocabulary(docs), "words")
    near = near_words(words)
    far = F.col("form_n") >= times * F.col("n")
    joined = words.join(near, "word", "left")
    joined = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("form")).alias("form"), F.when(far, F.col("form_n")).alias("form_n")), "near")
    out = joined.join(roots(joined.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
