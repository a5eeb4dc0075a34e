"""Labelled samples and hashed text features shared by the two classifiers."""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5  # rows whose checksum is 0 modulo this are held out
BLOCK = 8192  # words hashed at once


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row never teaches: its doc_id's checksum modulo 5 is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_chars: int, fill: bool = False) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` rows a class, in the order of a hash of doc_id.

    With ``fill``, a class that has fewer labels leaves its room to the other.
    Only rows that are not held out and texts of at most ``most_chars``
    characters teach; the sample is the one thing brought to the driver, and its
    size is at most 2 x per_class x most_chars.
    """
    room = [per_class, per_class]
    if fill:
        few = [min(n, per_class) for n in class_totals(labels, label)]
        room = [few[y] if few[y] < per_class else 2 * per_class - few[1 - y] for y in (0, 1)]
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col(label).cast("int").alias("y")).distinct()
    short = docs.where((F.length("text") > 0) & (F.length("text") <= most_chars)).select("doc_id", "text")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("y")]
    # some labelled rows have no short text: more ids than rows are drawn
    drawn = [known.where(F.col("y") == y).orderBy(*order).limit(2 * room[y]) for y in (0, 1)]
    rows = []
    for y, ids in enumerate(drawn):
        rows += short.join(ids, "doc_id").orderBy(*order, "text").limit(room[y]).select("text", "y").collect()
    return [(r["text"], r["y"]) for r in rows]


def class_totals(labels: DataFrame, label: str) -> tuple[int, int]:
    """Number of labelled rows of either class that are not held out, one at least."""
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out()).agg(*[F.count_if(F.col(label) == y) for y in (0, 1)]).first()
    return max(1, known[0]), max(1, known[1])


def char_ngrams(words: list[str], shortest: int, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of words between boundary marks, word after word, and their number per word.

    Some thousand words are hashed at once, so that what is made on the way stays small.
    """
    parts = [_char_ngrams(words[i : i + BLOCK], shortest, longest, buckets) for i in range(0, len(words), BLOCK)]
    return np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts])


def _char_ngrams(words: list[str], shortest: int, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one block of words: one array of code points, shifted against itself."""
    lengths = np.array([len(w) + 2 for w in words])
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters up to the word's end
    padded = np.concatenate([codes, np.zeros(longest, np.uint64)])
    value, ids = np.zeros(len(codes), np.uint64), []
    for n in range(1, longest + 1):
        value = (value + padded[n - 1 : n - 1 + len(codes)]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        if n >= shortest:
            ids.append((value + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32))
    there = room[:, None] >= np.arange(shortest, longest + 1)
    grams = (np.stack(ids, axis=1)[there] % np.uint64(buckets)).astype(np.int32)
    return grams, np.add.reduceat(there.sum(1), np.cumsum(lengths) - lengths)


def word_bucket(word: str, buckets: int) -> int:
    return crc32(word.encode("utf-8", "surrogatepass"), 0x9E37) % buckets
