"""BPE encoding and decoding: merge rounds over the symbols of many words in one flat array."""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import rows_of

#: Words of which a task remembers the ids; when there are more it forgets them and starts anew.
REMEMBERED = 1 << 18
#: Largest code points of the texts that have a word pattern of their own: ASCII, two bytes, all.
REACHES = (0x7F, 0xFFFF, sys.maxunicode)
#: Rank of a pair that does not merge.
NEVER = np.int32(2**31 - 1)

# What the tokenizer's Unicode version has beyond Python's, and the blanks of its patterns.
BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEW_LOWER_RANGES = ((0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B))
# Marks newer than the tokenizer's tables of combining classes: they neither move nor combine when texts are composed.
UNMOVED = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA), (0x1715, 0x1715),
    (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50),
    (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930), (0x1193D, 0x1193E),
    (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45),
    (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF),
    (0x1E4EC, 0x1E4EF),
)


class Vocabulary(NamedTuple):
    """What encoding and decoding need of a tokenizer file; its size is that of the file, whatever the corpus."""

    first: np.ndarray  # (2, 256): symbol of a byte inside a word, and at its end
    keys: np.ndarray  # sorted: left symbol * number of symbols + right symbol
    ranks: np.ndarray  # rank of the pair with this key
    made: np.ndarray  # symbol that the merge of a rank makes
    alone: np.ndarray  # by rank: whether the merge can make pairs of a lower rank, so that only one is done in a round
    tokens: list[str | None]  # text of every id
    special: dict[str, int]  # texts that are one id wherever they stand
    words: tuple[str, ...]  # pattern of a word in texts up to each of REACHES


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable, else the next one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(256 + hidden.index(b)) if b in set(hidden) else chr(b) for b in range(256)]


def _class(kind: str, new: Sequence[tuple[int, int]], most: int) -> str:
    """Pattern of all code points of a general category up to ``most``, as ranges."""
    found = [c for c in range(most + 1) if unicodedata.category(chr(c))[0] == kind]
    found = np.array(sorted(found + [c for a, b in new for c in range(a, min(b, most) + 1)]))
    cuts = np.flatnonzero(np.diff(found) > 1)
    ends = zip(found[np.append(0, cuts + 1)].tolist(), found[np.append(cuts, -1)].tolist(), strict=True)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ends)


@lru_cache(maxsize=len(REACHES))
def word_pattern(most: int = sys.maxunicode) -> str:
    """Contractions, runs of letters, single numbers, runs of other signs, in texts of code points up to ``most``.

    Contractions come after letters and numbers, with which none begins.  A
    class of characters looks code points of two bytes up in a map and tries
    its ranges beyond them one by one, at the end of every word; a pattern that
    ends at two bytes has none to try.
    """
    letters, numbers = _class("L", NEW_LETTERS, most), _class("N", NEW_NUMBERS, most)
    return f"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^{BLANKS}{letters}{numbers}]+"


def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a tokenizer file: byte-level BPE with word ends, NFC, blanks made one, lower case.

    Files of other kinds are refused.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, end = spec["model"], spec["model"].get("end_of_word_suffix")
    steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
    if not end or spec["decoder"] or spec["post_processor"] or spec["truncation"] or spec["padding"] or steps != ["NFC", "Replace", "Lowercase"] or model.get("dropout"):
        raise ValueError("not a byte-level BPE with word ends")
    ids = model["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens: list[str | None] = [None] * (1 + max(*ids.values(), *special.values()))
    for token, i in [*ids.items(), *special.items()]:
        tokens[i] = token
    letters = byte_letters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left, right = (np.array([ids[p[side]] for p in pairs], np.int64) for side in (0, 1))
    made = np.array([ids[a + b] for a, b in pairs], np.int32)
    keys = left * len(tokens) + right
    order = np.argsort(keys)
    rank = np.arange(len(pairs))
    lowest = np.full(len(tokens), len(pairs))  # lowest rank of the pairs that a symbol is part of
    np.minimum.at(lowest, left, rank)
    np.minimum.at(lowest, right, rank)
    first = np.array([[ids[c] for c in letters], [ids[c + end] for c in letters]], np.int32)
    return Vocabulary(first, keys[order], rank[order].astype(np.int32), made, lowest[made] <= rank, tokens, special, tuple(map(word_pattern, REACHES)))


def pair_ranks(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Rank of each pair of symbols, by binary search over the sorted keys."""
    key = left.astype(np.int64) * len(vocabulary.tokens) + right
    at = np.minimum(np.searchsorted(vocabulary.keys, key), len(vocabulary.keys) - 1)
    return np.where(vocabulary.keys[at] == key, vocabulary.ranks[at], NEVER)


def encode_words(words: Sequence[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Ids of each word, given as its bytes (none is empty).

    The symbols of all words lie in one array. In each round every word merges
    its pairs of lowest rank, from the left and without overlap, which is the
    order in which one merge after the other would be done: a merge makes pairs
    of higher ranks only. Where a vocabulary has merges of which that is not
    true, a word does only the leftmost of them in a round. Words without a pair
    that merges leave the array.
    """
    out: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
    if not words:
        return out
    sizes = np.array([len(w) for w in words])
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(sizes)
    sym = vocabulary.first[0][raw]
    sym[ends - 1] = vocabulary.first[1][raw[ends - 1]]
    word = np.repeat(np.arange(len(words)), sizes)
    rank = np.full(len(sym), NEVER)
    inner = np.flatnonzero(word[1:] == word[:-1])
    rank[inner] = pair_ranks(sym[inner], sym[inner + 1], vocabulary)
    while len(sym):
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        sizes = np.diff(np.append(starts, len(sym)))
        least = np.minimum.reduceat(rank, starts)
        over = least == NEVER
        if over.any():
            for k in np.flatnonzero(over):
                out[word[starts[k]]] = sym[starts[k] : starts[k] + sizes[k]]
            keep = np.repeat(~over, sizes)
            sym, word, rank, sizes, least = sym[keep], word[keep], rank[keep], sizes[~over], least[~over]
            if not len(sym):
                break
            starts = np.cumsum(sizes) - sizes
        hit = np.flatnonzero(rank == np.repeat(least, sizes))
        # of a run of hits side by side ('aaaa') every second one overlaps the one before it
        begins = np.flatnonzero(np.append(True, np.diff(hit) > 1))
        nth = np.arange(len(hit)) - np.repeat(begins, np.diff(np.append(begins, len(hit))))
        hit = hit[nth % 2 == 0]
        lone = vocabulary.alone[rank[hit]]
        if lone.any():
            again = np.append(False, word[hit][1:] == word[hit][:-1])
            hit = hit[~(lone & again)]
        sym[hit] = vocabulary.made[rank[hit]]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        at = hit - np.arange(len(hit))  # where the merged symbols stand once the right ones are gone
        sym, word, rank = sym[keep], word[keep], rank[keep]
        for spot in (at, at - 1):  # pairs with the symbol after and the one before
            spot = spot[(spot >= 0) & (spot < len(sym))]
            last = spot == len(sym) - 1
            follows = spot[~last][word[spot[~last]] == word[spot[~last] + 1]]
            rank[spot[np.isin(spot, follows, invert=True)]] = NEVER
            rank[follows] = pair_ranks(sym[follows], sym[follows + 1], vocabulary)
    return out


@lru_cache(maxsize=1)
def _unmoved() -> re.Pattern:
    return re.compile("([" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in UNMOVED) + "])")


def composed(text: str) -> str:
    """The text in normal form C, by the tokenizer's tables."""
    if text.isascii():
        return text
    return "".join(unicodedata.normalize("NFC", part) for part in _unmoved().split(text))


def lower_case(text: str) -> str:
    """Each code point in lower case by itself, whatever stands beside it (so a sigma at the end of a word stays one)."""
    if text.isascii():
        return text.lower()
    table = _lower_table()
    return text.replace("Σ", "σ").lower().translate(table) if any(ord(c) in table for c in set(text)) else text.replace("Σ", "σ").lower()


@lru_cache(maxsize=1)
def _lower_table() -> dict[int, int]:
    return NEW_LOWER | {c: c + by for a, b, by in NEW_LOWER_RANGES for c in range(a, b + 1)}


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The tokens' own texts parted by blanks: the file names no decoder that would join them. Unknown ids are left out."""
    return " ".join(t for i in ids if 0 <= i < len(vocabulary.tokens) and (t := vocabulary.tokens[i]) is not None)


class Encoder:
    """Encodes texts of one task, remembering the ids of words up to a bound."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.vocabulary, self.remembered = vocabulary, remembered
        self.find = [re.compile(words).findall for words in vocabulary.words]
        self.beyond = re.compile("[\U00010000-\U0010ffff]").search
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True)) + ")").split if vocabulary.special else None
        self.tokens = [(t or "").encode() for t in vocabulary.tokens]
        # word -> its ids as bytes, and its decoded text as decode() gives it
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def words_of(self, text: str) -> list[str]:
        """The words of a text in order; special texts are words of their own."""
        parts = self.cut(text) if self.cut and "<" in text else [text]
        out: list[str] = []
        for n, part in enumerate(parts):
            if n % 2:
                out.append(part)
            elif part:
                plain = lower_case(composed(part))
                out += self.find[0 if plain.isascii() else 2 if self.beyond(plain) else 1](plain)
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Work out the ids of words not seen before, all at once."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.remembered:
            self.known.clear()
            new = list(words)
        special = self.vocabulary.special
        plain = [w for w in new if w not in special]
        rows = encode_words([w.encode() for w in plain], self.vocabulary) + [np.array([special[w]], np.int32) for w in new if w in special]
        if not rows:
            return
        flat = np.concatenate(rows)
        ids, texts = flat.astype("<u4").tobytes(), [self.tokens[i] for i in flat.tolist()]
        stop = np.cumsum([len(r) for r in rows]).tolist()
        for w, a, b in zip(plain + [w for w in new if w in special], [0, *stop], stop, strict=False):
            self.known[w] = ids[4 * a : 4 * b], b" ".join(texts[a:b])

    def encode(self, texts: Sequence[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """Of each text its ids, as little-endian unsigned 32-bit numbers, and its decoded text in UTF-8."""
        words = [self.words_of(t) if t else [] for t in texts]
        self.learn(set().union(*words))
        for row in words:
            found = [self.known[w] for w in row]
            yield b"".join([f[0] for f in found]), b" ".join([f[1] for f in found])


def _chunks(texts: Sequence[str | None], most: int = 1 << 20) -> Iterator[slice]:
    """Runs of texts of about a million characters, one text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(t or "") + 1
    if size:
        yield slice(start, len(texts))


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary, digests: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary.value)
    for batch in rows_of(batches):
        keys, texts = batch.column(0), batch.column(1).to_pylist()
        for part in _chunks(texts):
            rows = list(encoder.encode(texts[part]))
            counts = pa.array([len(ids) // 4 for ids, _ in rows], pa.int64())
            if digests:
                columns = [pa.array([hashlib.sha256(r[side]).hexdigest() for r in rows]) for side in (0, 1)]
            else:
                columns = [pa.array([np.frombuffer(ids, "<u4").astype(np.int32) for ids, _ in rows], pa.list_(pa.int32())), pa.array([d.decode() for _, d in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([keys.slice(part.start, part.stop - part.start), counts, *columns], names=["doc_id", "n_tokens", "a", "b"])


def _run(docs: DataFrame, path: str, digests: bool, schema: str) -> DataFrame:
    # a vocabulary's size is that of its file; the path is read where the driver runs and need not be known to the executors
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(partial(_encoded, vocabulary=vocabulary, digests=digests), schema)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Ids and decoded text of every row of ``docs`` (doc_id, text): doc_id, n_tokens, ids, decoded.

    ``path`` is a tokenizer file on the driver. Texts are taken whole, in one
    pass without a shuffle; a task holds about a million characters of texts and
    a bounded number of known words. A null or empty text has no ids and an empty
    decoded text. Rows are taken one by one: null and repeated doc_ids, repeated
    texts and other columns do not matter. A special text of the file
    (``<|endoftext|>``) is its own id wherever it stands. Among pairs of one rank
    the leftmost merges first. A very long run of letters costs a round of its
    length for every rank that occurs in it.
    """
    return _run(docs, path, False, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``encode``, with checksums for ids and text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _run(docs, path, True, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
