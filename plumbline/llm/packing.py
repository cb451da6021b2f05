"""Packing of tokenized documents into sequences by best-two-fit.

A bin is filled greedily with the longest pieces that fit; then its smallest piece is replaced by two others that
fill the widened gap better, if there are such. Lengths lie between 1 and the sequence length, so all that
packing has to know is how many pieces have each length: a table of at most `capacity` counts, whatever the corpus
holds. A bin's pattern is repeated as often as the counts allow, so the plan has few patterns. Spark then deals
the pieces to the places of the plan: each piece has a rank among those of its length, each place a range of
ranks. Only lengths and counts reach the driver, and no task holds more than its own rows.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections import Counter
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import map_batches
from plumbline.session import Checkpoints

CAPACITY = 2_048
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"  # the same vocabulary for two libraries
END_ID = 0
_CHUNK = 1_000_000  # characters encoded at a time


class IdEncoder:
    """Ids of whole texts as arrays of unsigned 32-bit numbers: those of `tokenizers` for each text at once.

    Ids are cut before a single blank, unless a token of the vocabulary goes on over it (as some do where blanks and
    no-break spaces alternate). So the distinct words of many texts are encoded once, in one run whose words are
    told apart by the blank in front, and each text's ids are gathered from them. `tiktoken` does it, which gives the
    same ids from the same vocabulary faster; texts that hold the name of a special token go through `tokenizers`,
    texts with blanks in a row or at an end, or what a token with a blank inside says, are encoded whole.
    """

    def __init__(self, path: str | None = None, ranks: str | None = None) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        lines = Path(ranks or public_tokenizers.path(RANKS)).read_bytes().splitlines()
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )
        self.blank = np.zeros(max(merges.values()) + 1, bool)
        self.blank[[rank for token, rank in merges.items() if token.startswith(b" ")]] = True
        # What a text must hold for a token to go on over a single blank; blanks in a row are looked for anyway.
        inner = {t.decode("utf-8", "ignore") for t in merges if b" " in t[1:] and b"  " not in t}
        self.inner = [t for t in inner if not any(o != t and o in t for o in inner)]

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.plain.encode_ordinary(text), "<u4")

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [
            self.encode(t)
            if not t or "  " in t or t[0] == " " or t[-1] == " " or any(s in t for s in self.special)
            or any(s in t for s in self.inner)
            else None
            for t in texts
        ]
        easy = [i for i, ids in enumerate(out) if ids is None]
        if not easy:
            return out
        lists = pc.split_pattern(pa.array([texts[i] for i in easy], pa.large_string()), " ")
        ends = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
        coded = lists.flatten().dictionary_encode()
        word = coded.indices.to_numpy()
        ids = np.array(self.plain.encode_ordinary(" " + " ".join(coded.dictionary.to_pylist())), "<u4")
        starts = np.flatnonzero(self.blank[ids])
        counts = np.diff(np.append(starts, len(ids)))
        if len(starts) != len(coded.dictionary):
            raise ValueError("the vocabulary does not cut before every blank")
        begins = np.append(0, ends[:-1])
        heads = [self.encode(texts[i][: (texts[i] + " ").index(" ")]) for i in easy]
        counts = counts[word]
        counts[begins] = 0  # the first word has no blank in front: its ids come from `heads`
        total = np.cumsum(counts)
        flat = ids[np.arange(total[-1]) + np.repeat(starts[word] - (total - counts), counts)]
        for i, head, a, b in zip(easy, heads, total[begins], total[ends - 1]):
            out[i] = np.concatenate([head, flat[a:b]])
        return out


@lru_cache(maxsize=1)
def encoder(path: str | None = None, ranks: str | None = None) -> IdEncoder:
    """One encoder a Python worker."""
    return IdEncoder(path, ranks)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than `capacity`."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def tokenize(
    documents: DataFrame, capacity: int = CAPACITY, path: str | None = None, ranks: str | None = None
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every whole text's ids and the end id.

    A null text counts as empty; its one piece is the end id.
    """

    def start():
        end = np.array([END_ID], "<u4")

        def work(ids, texts):
            rows, at = [], 0
            while at < len(texts):
                part, chars = [], 0
                while at + len(part) < len(texts) and chars < _CHUNK:
                    part.append(texts[at + len(part)] or "")
                    chars += len(part[-1])
                for doc_id, found in zip(ids[at:], encoder(path, ranks).encode_all(part)):
                    data = np.append(found, end)
                    for piece, (first, n) in enumerate(cut(len(data), capacity)):
                        rows.append((doc_id, piece, first, n, zlib.crc32(data[first : first + n].tobytes())))
                at += len(part)
            return list(zip(*rows)) if rows else [[]] * 5

        return work

    return map_batches(
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint",
        [
            ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
        ],
        start,
    )


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Best-two-fit over lengths: (times, {length: pieces}) of bins that use up `counts` exactly."""
    left = dict(counts)
    lengths = sorted(left)
    plan = []
    while lengths:
        content, gap, below = {}, capacity, len(lengths)
        # Greedy: the longest piece that still fits, as often as there are pieces and room.
        while gap and (below := bisect.bisect_right(lengths, gap, 0, below)):
            longest = lengths[below - 1]
            content[longest] = min(gap // longest, left[longest])
            gap -= content[longest] * longest
            below -= 1
        smallest = min(content)
        room = gap + smallest
        if gap and len(lengths) > 1 and room > smallest:
            for n, k in content.items():
                left[n] -= k
            left[smallest] += 1
            two = _two_within(lengths, left, room)
            left[smallest] -= 1
            for n, k in content.items():
                left[n] += k
            if two and sum(two) > smallest:
                content[smallest] -= 1
                for n in two:
                    content[n] = content.get(n, 0) + 1
                content = {n: k for n, k in content.items() if k}
        times = min(left[n] // k for n, k in content.items())
        plan.append((times, content))
        for n, k in content.items():
            left[n] -= times * k
        lengths = [n for n in lengths if left[n]]
    return plan


def _two_within(lengths: list[int], left: dict[int, int], room: int) -> tuple[int, int] | None:
    """The two free pieces with the largest sum of at most `room`."""
    free = np.array([n for n in lengths if left[n] > 0 and n < room])
    if not len(free):
        return None
    single = np.array([left[int(n)] for n in free]) < 2
    partner = np.searchsorted(free, room - free, "right") - 1
    partner[(partner == np.arange(len(free))) & single] -= 1
    sums = np.where(partner >= 0, free + free[partner], 0)
    best = int(sums.argmax())
    return (int(free[best]), int(free[partner[best]])) if sums[best] else None


def _slots(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, pieces per bin, first sequence, offset), sorted: the places of the plan."""
    rows, used, sequence = [], Counter(), 0
    for times, content in plan:
        offset = 0
        for n in sorted(content, reverse=True):
            rows.append((n, used[n], content[n], sequence, offset))
            used[n] += times * content[n]
            offset += n * content[n]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Every piece lies in exactly one sequence; a sequence is filled from 0 without gaps, up to `capacity`.
    `pieces` must give the same rows when it is read twice. Lengths outside 1 to `capacity` are refused.
    """
    # Ranks in parts, so that a length that very many pieces have is not one task.
    total = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in total}
    if any(n is None or not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    parts = max(16, sum(counts.values()) // 50_000)
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int")
    dealt = pieces.withColumn("part", part)
    sizes = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("place", F.row_number().over(order) - 1).join(offsets, ["length", "part"])
    slots = _slots(plan_bins(counts, capacity))
    keys = slots[:, 0] << 48 | slots[:, 1]

    def start():
        def work(doc, piece, begin, length, crc, rank):
            n, rank = np.array(length, np.int64), np.array(rank, np.int64)
            at = np.searchsorted(keys, n << 48 | rank, "right") - 1
            own = slots[at]
            inner = rank - own[:, 1]
            return [
                doc, piece, begin, length, crc, own[:, 3] + inner // own[:, 2], own[:, 4] + inner % own[:, 2] * n,
            ]

        return work

    return map_batches(
        ranked.select(
            "doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("before")).alias("rank")
        ),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
        [
            ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
            ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ],
        start,
    )


def pack_documents(
    documents: DataFrame, capacity: int = CAPACITY, path: str | None = None, ranks: str | None = None
) -> DataFrame:
    """Tokenize and pack; the pieces' lengths, not their ids, are kept in the checkpoint folder in between."""
    pieces = Checkpoints(documents.sparkSession).write(tokenize(documents, capacity, path, ranks))
    return pack(pieces, capacity)
