"""Two tokenizers' tokens of the same text, aligned into the smallest groups that begin and end together.

Two tokens overlap if they share bytes. Every token points to the overlapping token that ends farthest to the right;
replacing each pointer by its pointer's pointer doubles the steps, so after a logarithmic number of passes over whole
arrays every token names the last token of its component, which labels the group. Many texts are aligned at once:
no component crosses the end of a text, because all tokens end there.

How often an id pair is linked is counted over the corpus, by documents. The pairs of a block of documents are written
once, as numbers into the list of the block's distinct pairs. Only these lists are shuffled to be counted and to
fetch the counts, so a pair that every document holds is one row a block, and documents meet the answers by block.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices
from plumbline.session import Checkpoints

RANKS_A, MODEL_B = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
BLOCK = 1 << 20  # bytes of text of a block, if it has more than one document
_AT_ONCE = 1 << 18  # bytes of text that are ids in Python at a time
_LINKS = 1 << 21  # links that are spelled out at a time
_BITS = 21  # of an id in a pair's number, and of a text's number in its block
_ID = (1 << _BITS) - 1


class Aligner:
    """Ids and byte ends of a text by both tokenizers."""

    def __init__(self, ranks: str | None = None, model: str | None = None) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        lines = Path(ranks or public_tokenizers.path(RANKS_A)).read_bytes().splitlines()
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # Strings of special tokens are plain text here: there are none.
        self.first = tiktoken.Encoding(
            "first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )
        self.second = sentencepiece.SentencePieceProcessor(model_file=model or public_tokenizers.path(MODEL_B))
        self.bytes_a = [b""] * (max(merges.values()) + 1)
        for token, rank in merges.items():
            self.bytes_a[rank] = token
        self.bytes_b = [self._piece(i) for i in range(self.second.get_piece_size())]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << _BITS:
            raise ValueError(f"ids of {_BITS} bits at most")
        self.size_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.size_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # How an id is written in a group's spelling: followed by a comma or by what ends its side of the group.
        spelled = [f"{i}{mark}" for mark in ",|" for i in range(len(self.bytes_a))]
        spelled += [f"{i}{mark}" for mark in ",;" for i in range(len(self.bytes_b))]
        self.spelled = np.array(spelled, object)

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of both; none for an empty text and for texts that the tokens' bytes do not give back."""
        out_a, out_b = [], []
        none = np.zeros(0, np.int64)
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= _AT_ONCE):
                size += len(texts[end])
                end += 1
            part = texts[at:end]
            for text, b in zip(part, self.second.encode(part, num_threads=1)):
                a = self.first.encode_ordinary(" " + text) if text else []
                raw = (" " + text).encode()
                if (
                    not text
                    or b"".join(map(self.bytes_a.__getitem__, a)) != raw
                    or b"".join(map(self.bytes_b.__getitem__, b)) != raw
                ):
                    a, b = none, none
                out_a.append(np.array(a, np.int64))
                out_b.append(np.array(b, np.int64))
            at = end
        return out_a, out_b


@lru_cache(maxsize=1)
def aligner(ranks: str | None = None, model: str | None = None) -> Aligner:
    """One a Python worker."""
    return Aligner(ranks, model)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For the tokens of A, then those of B, the token of B that ends their component, by pointer jumping.

    `ends_a` and `ends_b` are increasing and have the last entry in common.
    """
    n = len(ends_a)
    # The token of the other side that holds a token's last byte is its farthest-right overlapping one.
    over_a = np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    own = n + np.arange(len(ends_b))
    step = np.concatenate([n + over_a, np.where(ends_a[over_b] > ends_b, over_b, own)])
    while True:
        doubled = step[step]
        if (doubled == step).all():
            return step - n
        step = doubled


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as counted, one after the other."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - counts), counts)


def _merged(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, in order, with the sum of their times."""
    order = np.argsort(key)
    key, times = key[order], times[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[starts], np.add.reduceat(times, starts) if len(starts) else times


def links(
    a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray, text_of: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, times): the distinct linked id pairs of each text, and how many token pairs they are.

    Groups are numbered from 0 through all texts, `text_of` names each one's text. Ids that repeat within a group are one
    with a number of times before pairs are spelled out, and those come some at a time.
    """
    key_a, times_a = _merged(group_a << _BITS | a, np.ones(len(a), np.int64))
    key_b, times_b = _merged(group_b << _BITS | b, np.ones(len(b), np.int64))
    head = (text_of[key_a >> _BITS] << _BITS | key_a & _ID) << _BITS
    first_b = np.searchsorted(key_b, np.arange(len(text_of) + 1) << _BITS)
    first, partners = first_b[key_a >> _BITS], np.diff(first_b)[key_a >> _BITS]
    done = np.cumsum(partners)
    found, at = [], 0
    while at < len(partners):
        end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + _LINKS, "right")))
        right = _ranges(first[at:end], partners[at:end])
        found.append(_merged(
            np.repeat(head[at:end], partners[at:end]) | key_b[right] & _ID,
            np.repeat(times_a[at:end], partners[at:end]) * times_b[right],
        ))
        at = end
    key, times = (np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*found)) if found else (a, a)
    if len(found) > 1:
        key, times = _merged(key, times)
    return key >> 2 * _BITS, key & (1 << 2 * _BITS) - 1, times


def align(own: Aligner, texts: list[str]) -> tuple[dict[str, np.ndarray | list], np.ndarray, np.ndarray, np.ndarray]:
    """Counts and spelled groups per text, and the texts' linked pairs."""
    ids_a, ids_b = own.encode(texts)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.concatenate([np.zeros(0, np.int64), *ids]) for ids in (ids_a, ids_b))
    last = terminals(np.cumsum(own.size_a[a]), np.cumsum(own.size_b[b])) if len(a) else np.zeros(0, np.int64)
    last_a, last_b = last[: len(a)], last[len(a) :]
    ends = np.unique(last_b)  # a group is named by the token of B that ends it
    group_a, group_b = np.searchsorted(ends, last_a), np.searchsorted(ends, last_b)
    text_of = np.repeat(np.arange(len(texts)), n_b)[ends]
    size_a, size_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
    n_links = np.bincount(text_of, size_a * size_b, len(texts)).astype(np.int64)
    # In a group's spelling the tokens of A come first; positions count what lies before.
    code = np.empty(len(a) + len(b), np.int64)
    before_b, after_a = np.cumsum(size_b) - size_b, np.cumsum(size_a)
    final_a = np.append(group_a[1:] != group_a[:-1], True)[: len(a)]
    final_b = np.append(group_b[1:] != group_b[:-1], True)[: len(b)]
    code[np.arange(len(a)) + before_b[group_a]] = a + final_a * len(own.bytes_a)
    code[np.arange(len(b)) + after_a[group_b]] = 2 * len(own.bytes_a) + b + final_b * len(own.bytes_b)
    cuts = np.append(0, np.cumsum(n_a + n_b))
    digests = [
        hashlib.sha256("".join(own.spelled[code[s:e]].tolist())[:-1].encode()).hexdigest() if e > s else ""
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist())
    ]
    counted = {
        "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text_of, minlength=len(texts)), "n_links": n_links,
        "groups_sha256": digests,
    }
    return counted, *links(a, group_a, b, group_b, text_of)


_COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
_DOCS = [(n, pa.string() if n == "groups_sha256" else pa.int64()) for n in _COLUMNS]
_TABLE = pa.schema([
    ("block", pa.int64()), ("docs", pa.list_(pa.struct(_DOCS))), ("pairs", pa.list_(pa.int64())),
    ("n_docs", pa.list_(pa.int64())), ("begins", pa.binary()), ("place", pa.binary()), ("times", pa.binary()),
])
_DOCS_DDL = ": {}, ".join(_COLUMNS).format(*["bigint"] * 5) + ": string"
_TABLE_DDL = (
    f"block bigint, docs array<struct<{_DOCS_DDL}>>, pairs array<bigint>, n_docs array<bigint>, begins binary, "
    "place binary, times binary"
)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of documents, about BLOCK bytes at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for part in slices(batch, BLOCK):
            if texts and size + part.nbytes > BLOCK:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids += part.column(0).to_pylist()
            texts += [t or "" for t in part.column(1).to_pylist()]
            size += part.nbytes
    if texts:
        yield ids, texts


def aligned_blocks(documents: DataFrame, ranks: str | None = None, model: str | None = None) -> DataFrame:
    """One row per block of documents: what is counted per document, and the documents' links.

    `pairs` are the block's distinct pairs and `n_docs` how many of its documents hold each; document i holds the pairs
    `place[begins[i]:begins[i + 1]]`, each `times` times. These three are arrays of numbers as bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        own = aligner(ranks, model)
        for number, (ids, texts) in enumerate(_grouped(batches)):
            counted, text, pair, times = align(own, texts)
            place, pairs = pd.factorize(pair)
            begins = np.searchsorted(text, np.arange(len(texts) + 1))
            docs = pa.StructArray.from_arrays(
                [pa.array(v, t) for v, (_, t) in zip([ids, *(counted[n] for n in _COLUMNS[1:])], _DOCS)],
                names=list(_COLUMNS),
            )
            n_docs = np.bincount(place, minlength=len(pairs))
            lists = [pa.ListArray.from_arrays([0, len(v)], pa.array(v)) for v in (docs, pairs, n_docs)]
            short = not len(times) or int(times.max()) < 1 << 16
            blobs = [begins.astype("<i8"), place.astype("<i4"), times.astype("<u2" if short else "<i8")]
            arrays = [pa.array([task + number]), *lists, *(pa.array([v.tobytes()], pa.binary()) for v in blobs)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_TABLE)
            pa.default_memory_pool().release_unused()

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _TABLE_DDL)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents a pair is linked, and whether no other of its A id is in more."""
    asked = blocks.select(F.inline(F.arrays_zip("pairs", "n_docs"))).toDF("pair", "n_docs")
    counts = asked.groupBy("pair").agg(F.sum("n_docs").cast("bigint").alias("n"))
    first = F.shiftright("pair", _BITS)
    highest = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", first).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


_SCORED = pa.schema([
    *((n, pa.string() if n == "groups_sha256" else pa.int64()) for n in _COLUMNS),
    ("n_best", pa.int64()), ("count_sum", pa.int64()),
])


def align_documents(documents: DataFrame, ranks: str | None = None, model: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) per row of `documents`.

    Null and empty texts, and texts that the tokens of either side do not give back byte by byte, have no tokens: zeros
    and an empty digest. Every row is a document of its own, also if ids or rows repeat; a null doc_id stays null. Other
    columns are not read, an empty table gives no rows.
    """
    kept = Checkpoints(documents.sparkSession)
    blocks = kept.write(aligned_blocks(documents, ranks, model))
    counts = kept.write(pair_counts(blocks))
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counts, "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("at", "n", "best"))).alias("answers")  # at most the pairs of a block
    )
    told = blocks.select("block", "docs", "begins", "place", "times").join(answers, "block", "left")
    ddl = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'bigint'}" for f in _SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs, answer = batch.column(1)[row].values, batch.column(5)[row].values
                begins, place, times = (batch.column(i)[row].as_py() for i in (2, 3, 4))
                begins, place = np.frombuffer(begins, "<i8"), np.frombuffer(place, "<i4")
                times = np.frombuffer(times, "<u2" if len(times) == 2 * len(place) else "<i8").astype(np.int64)
                held = [docs.field(n) for n in _COLUMNS]
                best, sums = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
                if len(place):
                    text = np.repeat(np.arange(len(docs)), np.diff(begins))
                    np.add.at(best, text, times * answer.field("best").to_numpy(zero_copy_only=False)[place])
                    np.add.at(sums, text, times * answer.field("n").to_numpy()[place])
                yield pa.RecordBatch.from_arrays([*held, pa.array(best), pa.array(sums)], schema=_SCORED)

    return told.mapInArrow(run, ddl)
