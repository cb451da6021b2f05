"""Token alignment against a walk over the byte ends of both tokenizations."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import alignment, queries


def byte_decoder():
    """The characters that byte-level entries are written in, and their bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        self.decoder = byte_decoder()

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.decoder[c] for c in self.a.id_to_token(i)))
             for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
            return [], []
        return a, b

    def groups(self, text):
        a, b = self.tokens(text)
        ends = []
        for side in (a, b):
            at, own = 0, []
            for _, token in side:
                at += len(token)
                own.append(at)
            ends.append(own)
        out, last = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            out.append(tuple(
                [i for (i, _), end in zip(side, own) if last < end <= cut] for side, own in zip((a, b), ends)
            ))
            last = cut
        return out


def plain_result(texts):
    own = Plain()
    groups = [own.groups(t) for t in texts]
    pairs = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    held = Counter(p for c in pairs for p in c)
    most = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for g, c in zip(groups, pairs):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
            sum(k for p, k in c.items() if held[p] == most[p[0]]), sum(k * held[p] for p, k in c.items()),
            hashlib.sha256(spelled.encode()).hexdigest() if g else "",
        ))
    return out


def texts():
    rng = random.Random(5)
    letters = ["a", "e", "th", "ing", " ", " ", "  ", "\n", "é", "ü", "中", "文", "한", "𝄞", "1", "23", "<s>", "<|endoftext|>",
               "<0x41>", "▁", " ", "!", "\t", "ﬁ", "\x00", "Ω", "का"]
    out = [None, "", " ", "a", "  two  blanks ", "plain words in a row", "中文字", "𝄞𝄞𝄞𝄞 𝄞", "x" * 3000, "▁a"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(120)]
    return out + ["plain words in a row"] * 3 + [" ".join(f"word{i % 97}" for i in range(3000))]


def test_alignment_against_brute_force(frame, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 2_000)
    monkeypatch.setattr(alignment, "_LINKS", 50)
    rows = [(i if i % 10 else None, t, "x", 1) for i, t in enumerate(texts())]
    docs = frame(rows, "doc_id bigint, text string, block string, pairs int")
    found = alignment.align_documents(docs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    want = [(r[0], *w) for r, w in zip(rows, plain_result(texts()))]
    assert sum(w[1] > 0 for w in want) > 40 and sum(w[1] == 0 for w in want) > 20
    assert any(w[1] > 0 and w[4] > w[1] for w in want)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_terminals_against_a_walk():
    rng = np.random.default_rng(1)
    for _ in range(200):
        end = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, end + 1, rng.integers(0, 40)), end)) for _ in range(2))
        got = alignment.terminals(a, b)
        shared = np.intersect1d(a, b)
        want = np.searchsorted(b, shared[np.searchsorted(shared, np.concatenate([a, b]))])
        assert (got == want).all()


def test_groups_of_many_tokens_are_spelled_out_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 30, 400), rng.integers(0, 20, 300)
    ga, gb = np.sort(np.append(rng.integers(0, 7, 393), range(7))), np.sort(np.append(rng.integers(0, 7, 293), range(7)))
    text_of = np.array([0, 0, 1, 2, 2, 2, 5])
    want = Counter((int(text_of[g]), int(x) << alignment._BITS | int(y))
                   for x, g in zip(a, ga) for y, h in zip(b, gb) if g == h)
    for most in (1, 37, 1 << 21):
        monkeypatch.setattr(alignment, "_LINKS", most)
        text, pair, times = alignment.links(a, ga, b, gb, text_of)
        assert dict(zip(zip(text.tolist(), pair.tolist()), times.tolist())) == want


def test_empty_table_and_texts_without_tokens(frame):
    schema = "doc_id bigint, text string"
    assert alignment.align_documents(frame([], schema)).count() == 0
    got = alignment.align_documents(frame([(1, None), (1, ""), (None, "▁")], schema)).collect()
    assert len(got) == 3 and all(r["groups_sha256"] == "" and r["count_sum"] == r["n_a"] == r["n_best"] == 0 for r in got)


def test_query_returns_the_contract(spark, frame, tmp_path):
    frame([(i, t) for i, t in enumerate(texts())], "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_token_alignment"](spark, str(tmp_path))
    assert got.dtypes == [(n, "bigint") for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [
        ("groups_sha256", "string")]
    assert got.agg(F.sum("n_links")).first()[0] == sum(w[3] for w in plain_result(texts()))
