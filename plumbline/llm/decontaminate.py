"""Benchmark decontamination by the CGK embedding (Chakraborty, Goldenberg, Koucky: Streaming algorithms for
embedding and computing edit distance in the low distance regime, STOC 2016).

A text leaks an item if some stretch of it is within `EDITS` word edits per item word. Windows of an item's size
are embedded by a random walk that copies symbols and moves on by a random bit per step and symbol: few edits
change few places of the embedding. Repeated bit-sampling hashes of the embedding bring windows and items together;
the number of repetitions follows from a target recall, measured on items with as many random edits as are allowed.
Pairs that meet are verified by the exact edit distance to the best stretch around the window.

Only windows that could hold an item are embedded. By the q-gram lemma a stretch within k edits of an item of n
words shares at least n - 2 - 3k three-word grams with it, at places shifted by at most k. Windows start where
such a gram puts an item's first word, and those around which too few grams agree are left out: a filter that loses
nothing. Items are read in blocks of bounded size; documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import ascii_words, keep_rows, map_batches

EDITS = 0.2  # allowed edits per item word; items under 6 words must be met exactly
MIN_WORDS = 3  # shorter items are common phrases: only a text that is nothing else leaks them
RECALL = 0.99  # of windows with as many edits as allowed, for each item length
SAMPLED = 3  # places of the embedding in one hash
BLOCK = 20_000  # items in memory at a time; more are read in further passes over the documents
_GRAM = 3
# Scripts that put no blanks between words: Thai, Lao, Burmese, Khmer, kana and Han. There each character is a word.
_UNSPACED = re.compile("[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uABFF\uF900-\uFAFF\U00020000-\U0003FFFF]")


def allowed(n: int) -> int:
    return int(EDITS * n) if n >= 6 else 0


def words_of(text: str | None) -> list[bytes]:
    """Words as of `ascii_words`; in scripts without blanks each character is one."""
    text = text or ""
    return ascii_words(text if text.isascii() else _UNSPACED.sub(r" \g<0> ", text))


def edit_window(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of `text` nearest to `item`; the first to end among equals."""
    n = len(text)
    cost, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    steps = np.arange(n + 1)
    for symbol in item:
        change = np.empty(n + 1, np.int64)
        change[0] = cost[0] + 1
        source = np.empty(n + 1, np.int64)
        source[0] = origin[0]
        diagonal, above = cost[:-1] + (text != symbol), cost[1:] + 1
        change[1:] = np.minimum(diagonal, above)
        source[1:] = np.where(diagonal <= above, origin[:-1], origin[1:])
        # Words of the text that the item lacks: the least of (cost - place) so far, carried along.
        slack = change - steps
        best = np.minimum.accumulate(slack)
        holder = np.maximum.accumulate(np.where(slack == best, steps, 0))
        cost, origin = best + steps, source[holder]
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


def _mix(*parts) -> np.ndarray:
    value = np.uint64(0x9E3779B97F4A7C15)
    for part in parts:
        value = (value ^ np.asarray(part).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        value = value ^ (value >> np.uint64(31))
    return value


def embed_keys(rows: np.ndarray, lengths: np.ndarray, repeats: int, sampled: int = SAMPLED) -> np.ndarray:
    """Hash keys (row, repetition) of the CGK embeddings of padded symbol rows (symbols are >= -1, pad is -2).

    Step j of repetition r writes the symbol under the pointer and moves on if the bit of (r, j, symbol) is set;
    the pad never moves. A key mixes `sampled` places drawn from the first 2n steps, by which time
    the walk has left most rows of n symbols.
    """
    count, width = rows.shape
    padded = np.column_stack([rows, np.full(count, -2, rows.dtype)])
    pointer = np.zeros((count, repeats), np.int64)
    keys = np.zeros((count, repeats), np.uint64)
    each = np.arange(repeats)
    places = np.stack([_mix(each, i, 77) for i in range(sampled)])  # (sampled, repeats)
    wanted = (places[:, None, :] % (2 * lengths.astype(np.uint64))[None, :, None]).astype(np.int64)
    line = np.arange(count)[:, None]
    for step in range(2 * int(lengths.max())):
        symbol = padded[line, pointer]
        hits = (wanted == step).sum(axis=0)
        if hits.any():
            # Symbols at sampled steps; the walk meets them in the same order for equal lengths.
            mixed = _mix(keys, symbol + 3, hits)
            keys = np.where(hits > 0, mixed, keys)
        move = (_mix(each[None, :], step, symbol + 3) >> np.uint64(40)) & np.uint64(1)
        pointer = np.minimum(pointer + move.astype(np.int64) * (symbol != -2), lengths[:, None])
    return keys


def repetitions(lengths: list[int], recall: float = RECALL, sampled: int = SAMPLED) -> int:
    """How many hashes are needed so that windows with all allowed edits are met with this probability.

    Measured on random rows of each length (up to 16 lengths, evenly chosen) with random edits; doubled until
    the recall is reached, at every length.
    """
    rng = np.random.default_rng(5)
    chosen = sorted(set(lengths))
    chosen = [chosen[i] for i in sorted(set(np.linspace(0, len(chosen) - 1, 16).astype(int)))] if chosen else []
    repeats = 8
    pairs = []
    for n in chosen:
        originals = np.arange(64)[:, None] * 100_000 + np.arange(n)
        edited = []
        for row in originals:
            row = row.tolist()
            for _ in range(allowed(n)):
                at, kind = int(rng.integers(len(row))), int(rng.integers(3))
                if kind == 0:
                    row[at] = -1
                elif kind == 1 and len(row) > 1:
                    del row[at]
                else:
                    row.insert(at, -1)
            # A window has the item's size: it is cut, or goes on with what follows.
            edited.append((row + [-1] * n)[:n])
        pairs.append((originals, np.array(edited), np.full(64, n)))
    while pairs:
        met = [(embed_keys(a, n, repeats) == embed_keys(b, n, repeats)).any(axis=1).mean() for a, b, n in pairs]
        if min(met) >= recall:
            break
        repeats *= 2
    return repeats


@dataclass
class Items:
    """One block of items, with the table of their grams and their keys."""

    ids: list[int]
    words: list[np.ndarray]
    whole: dict[tuple[bytes, ...], list[int]]  # the items that are too short for grams
    vocabulary: dict[bytes, int]
    pairs: np.ndarray  # sorted codes of the two words that a gram begins with
    grams: np.ndarray  # sorted codes of three words in a row
    gram_item: np.ndarray
    gram_place: np.ndarray
    repeats: int
    keys: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]], recall: float = RECALL) -> Items:
        vocabulary: dict[bytes, int] = {}
        ids, words, whole = [], [], {}
        for item_id, text in rows:
            found = words_of(text)
            if item_id is not None and len(found) >= MIN_WORDS:
                ids.append(item_id)
                words.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in found]))
            elif item_id is not None and found:
                whole.setdefault(tuple(found), []).append(item_id)
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(w[:-2] << 31 | w[1:-1] for w in words)]))
        codes = [_gram_codes(w, pairs) for w in words]
        item = np.repeat(np.arange(len(words)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, int)
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        lengths = [len(w) for w in words]
        repeats = repetitions(lengths, recall)
        keys = embed_keys(*_padded(words), repeats) if words else np.zeros((0, repeats), np.uint64)
        return cls(ids, words, whole, vocabulary, pairs, flat[order], item[order], place[order], repeats, keys)

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """(item, edits, item words, start, end) for every item that some stretch of the text leaks."""
        get, found = self.vocabulary.get, words_of(text)
        if len(found) < MIN_WORDS:
            return [(item, 0, len(found), 0, len(found)) for item in self.whole.get(tuple(found), ())]
        if not len(self.grams):
            return []
        words = np.array([get(w, -1) for w in found], np.int64)
        codes = _gram_codes(words, self.pairs)
        low = np.searchsorted(self.grams, codes, "left")
        count = np.searchsorted(self.grams, codes, "right") - low
        count[codes < 0] = 0
        if not count.any():
            return []
        at = np.repeat(np.arange(len(codes)), count)
        row = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        item, shift = self.gram_item[row], at - self.gram_place[row]
        return list(self._verified(words, self._met(words, *self._dense(item, shift))))

    def _dense(self, item: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (item, shift) around which enough grams agree (q-gram lemma)."""
        n = np.array([len(w) for w in self.words])[item]
        k = np.where(n >= 6, (EDITS * n).astype(np.int64), 0)
        code = item.astype(np.int64) << 40 | (shift + (1 << 30))
        order = np.argsort(code, kind="stable")
        code, item, shift, n, k = code[order], item[order], shift[order], n[order], k[order]
        near = np.searchsorted(code, code + 2 * k, "right") - np.searchsorted(code, code - 2 * k, "left")
        first = np.append(True, code[1:] != code[:-1])
        keep = first & (near >= n - (_GRAM - 1) - _GRAM * k)
        return item[keep], shift[keep]

    def _met(self, words: np.ndarray, item: np.ndarray, shift: np.ndarray) -> list[tuple[int, int]]:
        """(item, shift) of the windows that share a key with their item."""
        met = []
        for at in range(0, len(item), 4096):
            own, start = item[at : at + 4096], shift[at : at + 4096]
            n = np.array([len(self.words[i]) for i in own])
            place = start[:, None] + np.arange(n.max())
            inside = (place >= 0) & (place < len(words))
            rows = np.where(inside, words[np.clip(place, 0, len(words) - 1)], -1)
            rows[np.arange(n.max())[None, :] >= n[:, None]] = -2
            hit = (embed_keys(rows, n, self.repeats) == self.keys[own]).any(axis=1)
            met += zip(own[hit].tolist(), start[hit].tolist())
        return met

    def _verified(self, words: np.ndarray, met: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
        regions: dict[int, list[list[int]]] = {}
        for item, shift in sorted(met):
            n, k = len(self.words[item]), allowed(len(self.words[item]))
            a, b = max(0, shift - 2 * k), min(len(words), shift + n + 2 * k)
            own = regions.setdefault(item, [])
            if own and a <= own[-1][1]:
                own[-1][1] = max(b, own[-1][1])
            else:
                own.append([a, b])
        for item, own in regions.items():
            n = len(self.words[item])
            found = []
            for a, b in own:
                edits, start, end = edit_window(self.words[item], words[a:b])
                found.append((edits, a + start, a + end))
            edits, start, end = min(found)
            if edits <= allowed(n):
                yield self.ids[item], edits, n, start, end


def _gram_codes(words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """One number per three words in a row; -1 where no item holds one of the words or the first two in a row.

    The first two are named by their place in `pairs`, so that no number of words overflows.
    """
    if len(words) < _GRAM or not len(pairs):
        return np.full(max(0, len(words) - _GRAM + 1), -1, np.int64)
    a, b, c = words[:-2], words[1:-1], words[2:]
    first = a << 31 | b
    at = np.minimum(np.searchsorted(pairs, first), len(pairs) - 1)
    return np.where((a < 0) | (b < 0) | (c < 0) | (pairs[at] != first), -1, at << 31 | c)


def _padded(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words])
    rows = np.full((len(words), lengths.max()), -2, np.int64)
    for row, own in zip(rows, words):
        row[: len(own)] = own
    return rows, lengths


def item_blocks(benchmark: DataFrame, block: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """The distinct (item_id, text) of the benchmark in blocks of at most `block`; rows with a null are left out."""
    items = (
        benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
        .where("item_id is not null and text is not null")
        .distinct()
    )
    more = items
    while True:
        rows = [tuple(r) for r in more.orderBy("item_id", "text").limit(block).collect()]
        if rows:
            yield rows
        if len(rows) < block:
            return
        item, text = rows[-1]
        more = items.where((F.col("item_id") > item) | ((F.col("item_id") == item) & (F.col("text") > text)))


def find_leaks(documents: DataFrame, benchmark: DataFrame, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, edits, item_words, first_word, last_word, similarity) of every leak.

    One row per row of `documents` and distinct (item_id, text) that it leaks: the stretch with the fewest edits (the first of
    equals), in words of the document from 0; characters are words in scripts without blanks. Items under MIN_WORDS
    words are leaked only by texts that are nothing else. Null and empty texts leak nothing; without items the result
    is empty. Repeated rows and ids keep their rows, a null doc_id stays null, other columns are not read.
    """
    columns = [
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int64()), ("item_words", pa.int64()),
        ("first_word", pa.int64()), ("last_word", pa.int64()), ("similarity", pa.float64()),
    ]
    schema = (
        "doc_id bigint, item_id bigint, edits bigint, item_words bigint, first_word bigint, last_word bigint, "
        "similarity double"
    )
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = None
    for block_rows in item_blocks(benchmark, block):
        def start(items=Items.of(block_rows, recall)):
            def work(ids, texts):
                found = [
                    (doc_id, item, edits, n, a, b - 1, 1.0 - edits / n)
                    for doc_id, text in zip(ids, texts)
                    for item, edits, n, a, b in items.leaks(text)
                ]
                return list(zip(*found)) if found else [[]] * len(columns)

            return work

        part = map_batches(rows, schema, columns, start)
        out = part if out is None else out.unionByName(part)
    return documents.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(documents: DataFrame, benchmark: DataFrame, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """The rows of `documents`, all columns as they are, that leak no item. Rows without text stay."""
    for block_rows in item_blocks(benchmark, block):
        def start(items=Items.of(block_rows, recall)):
            return lambda texts: [not items.leaks(t) for t in texts]

        documents = keep_rows(documents, "text", start)
    return documents
