"""Toxicity: bags of subwords averaged into a linear softmax (Bojanowski et al., Enriching Word Vectors with
Subword Information, 2017; Joulin et al., Bag of Tricks, 2017), with both layers trained together in NumPy.

A word's vector is the mean of the vectors of its character n-grams and of the word itself, all hashed to a
fixed number of buckets, so a misspelling never seen shares most n-grams with its model. A window of words is the
mean of its words' vectors, and the softmax is linear in it. A long text holds few toxic words, which a mean
over all of it would drown; so each text is cut into windows of at most `WINDOW` words and judged by its most
toxic one. In training the windows of a document share its weight, equally at first; later those of a toxic
document share it by a softmax of what the model says of them (Ilse et al., Attention-based Deep Multiple Instance
Learning, 2018), for most of its windows are clean.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import labelled, map_batches, shares

HELD_OUT = (4, 2)  # crc32 of the id modulo 4 is 2: never learnt from
MAX_LABELLED = 2_500  # labelled documents per label value that a fit looks at
MAX_CHARS = 20_000  # labelled documents longer than this are not learnt from; scoring has no such limit
BUCKETS, SIZE, WINDOW = 1 << 17, 8, 16
GRAMS = (3, 4, 5)
EPOCHS, BATCH, RATE, DECAY = 5, 64, 0.02, 0.5
FIRST = 0.5  # share of the steps in which all windows of a toxic document are to blame alike
MIN_STEPS = 200  # of the optimizer, however few documents there are
MIN_DOCS = 5  # a subword of fewer sampled documents keeps a zero vector: it can only be learnt by heart
THRESHOLD = 0.3
SCALE = 10.0  # of window means; it only rescales the rate of learning
_CACHE = 300_000  # words whose value a task remembers
_CHUNK = 2_000_000  # characters whose words are held at a time
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits of any script."""
    return _WORD.findall((text or "").lower())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts): for each word in turn the buckets of itself and of its character n-grams.

    A word is marked at both ends, so that prefixes and suffixes have n-grams of their own.
    """
    joined = "\n".join(f"<{w}>" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum(codes == 10)  # the number of the word at each place
    owners, hashes = [np.arange(len(words))], [
        np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    ]
    for n in GRAMS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        whole = (ends[n - 1 :][:m] == ends[:m]) & (codes[:m] != 10)
        mixed = np.full(m, n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ codes[i : i + m]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        owners.append(ends[:m][whole])
        hashes.append(mixed[whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    buckets = (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64)[order]
    return buckets, np.bincount(owner, minlength=len(words))


def windows(n: int, size: int = WINDOW) -> np.ndarray:
    """Starts that cut `n` words into windows of nearly equal length, at most `size` words."""
    pieces = max(1, -(-n // size))
    return np.arange(pieces) * n // pieces


@dataclass
class ToxicityModel:
    """`lift[b]` is what bucket b adds to the logit of label 1 against 0 for a window made of it alone."""

    lift: np.ndarray
    bias: float

    def top_windows(self, texts: list[str | None]) -> np.ndarray:
        return np.array(self.lifter()(texts))

    def scorer(self):
        """A function from a list of texts to their scores, 0 to 1."""
        lifts = self.lifter()
        return lambda texts: (1 / (1 + np.exp(-(self.bias + np.array(lifts(texts), float))))).tolist()

    def lifter(self):
        """A function from a list of texts to the lift of their most toxic windows; it remembers words."""
        known: dict[str, float] = {}

        def learn(words: set[str]) -> None:
            if len(known) + len(words) > _CACHE:
                known.clear()
            new = [w for w in words if w not in known]
            if new:
                buckets, counts = subwords(new)
                starts = np.cumsum(counts) - counts
                known.update(zip(new, (np.add.reduceat(self.lift[buckets], starts) / counts).tolist()))

        def score(words: list[str]) -> float:
            # A window always has WINDOW places; those that a short text or a repeated word leaves empty
            # count as zero vectors.
            if len(words) <= WINDOW:
                return sum(map(known.__getitem__, dict.fromkeys(words))) / WINDOW
            cuts = [*windows(len(words)).tolist(), len(words)]
            parts = (set(words[a:b]) for a, b in zip(cuts, cuts[1:]))
            return max(sum(map(known.__getitem__, part)) for part in parts) / WINDOW

        def work(texts: list[str | None]) -> list[float]:
            scores, at = [], 0
            while at < len(texts):
                part, chars = [], 0
                while at < len(texts) and chars < _CHUNK:
                    part.append(words_of(texts[at]))
                    chars += len(texts[at] or "")
                    at += 1
                learn(set().union(*part))
                scores += map(score, part)
            return scores

        return work


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return np.arange(counts.sum()) + shift


def train(texts: list[str], labels: np.ndarray, weight: np.ndarray) -> ToxicityModel:
    """Adam on both layers at once, over batches drawn with a fixed seed."""
    vocabulary: dict[str, int] = {}
    places = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int64) for t in texts]
    base = float((weight * labels).sum() / weight.sum())
    bias = np.array([0.0, np.log(base / (1 - base))])
    if not vocabulary:
        return ToxicityModel(np.zeros(BUCKETS), float(bias[1]))
    buckets, counts = subwords(list(vocabulary))
    starts = np.cumsum(counts) - counts
    # Only buckets that enough documents have are learnt; the others stay zero but count in the means.
    seen = np.zeros(BUCKETS, np.int64)
    for p in places:
        own = np.unique(p)
        seen[np.unique(buckets[_ranges(starts[own], counts[own])])] += 1
    learnt = seen[buckets] >= MIN_DOCS
    owner = np.repeat(np.arange(len(counts)), counts)[learnt]
    buckets, n_learnt = buckets[learnt], np.bincount(owner, minlength=len(counts))
    starts = np.cumsum(n_learnt) - n_learnt

    rng = np.random.default_rng(11)
    params = [
        rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32) * (seen >= MIN_DOCS)[:, None],
        rng.normal(0, 0.5, (SIZE, 2)).astype(np.float32),
        bias.astype(np.float32),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    weight = weight / weight.mean()
    used = [i for i in range(len(texts)) if len(places[i])]
    batches = -(-len(used) // BATCH)
    epochs = max(EPOCHS, -(-MIN_STEPS // batches))  # few documents are gone through more often
    step, n_steps = 0, epochs * batches
    for _ in range(epochs):
        shuffled = rng.permutation(used)
        for at in range(0, len(shuffled), BATCH):
            step += 1
            docs = shuffled[at : at + BATCH]
            embedding, output, bias = params
            words, place = np.unique(np.concatenate([places[i] for i in docs]), return_inverse=True)
            lengths = np.array([len(places[i]) for i in docs])
            cuts = [windows(n) for n in lengths]
            # Of a word repeated in a window only the first place counts.
            window = np.concatenate([c + o for c, o in zip(cuts, np.cumsum(lengths) - lengths)])
            n_windows = np.array([len(c) for c in cuts])
            doc = np.repeat(np.arange(len(docs)), n_windows)
            grams = buckets[_ranges(starts[words], n_learnt[words])]
            gram_word = np.repeat(np.arange(len(words)), n_learnt[words])
            vectors = _sum_by(gram_word, embedding[grams], len(words)) / counts[words][:, None]
            sizes = np.diff(np.append(window, len(place)))
            once = np.zeros(len(place), np.float32)
            once[np.unique(np.repeat(np.arange(len(window)), sizes) * len(words) + place, return_index=True)[1]] = 1
            mean = np.add.reduceat(vectors[place] * once[:, None], window) * (SCALE / WINDOW)
            logits = mean @ output + bias
            lift = logits[:, 1] - logits[:, 0]
            p = 1 / (1 + np.exp(-lift))
            share = 1 / n_windows[doc]  # the windows of a document share its weight
            if step > FIRST * n_steps:
                share = np.where(labels[docs][doc] == 1, _blame(lift, doc, n_windows), share)
            error = ((p - labels[docs][doc]) * share * weight[docs][doc] / len(docs)).astype(np.float32)
            d_logits = np.column_stack([-error, error])
            d_mean = (d_logits @ output.T) * (SCALE / WINDOW)
            d_place = np.repeat(d_mean, sizes, axis=0) * once[:, None]
            d_word = _sum_by(place, d_place, len(words)) / counts[words][:, None]
            grads = [_sum_by(grams, d_word[gram_word], BUCKETS), mean.T @ d_logits, d_logits.sum(0)]
            rate = RATE * (1 - (step - 1) / n_steps)
            for param, grad, (m, v) in zip(params, grads, moments):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            params[0] *= 1 - rate * DECAY
    embedding, output, bias = params
    lift = (embedding @ (output[:, 1] - output[:, 0])).astype(np.float64) * SCALE
    model = ToxicityModel(lift, 0.0)
    top = model.top_windows(texts)
    slope, bias = _logistic(top, labels, weight)
    return ToxicityModel(lift * slope, bias)


def _blame(lift: np.ndarray, doc: np.ndarray, n_windows: np.ndarray) -> np.ndarray:
    """The softmax of the windows' lifts within each document."""
    top = np.maximum.reduceat(lift, np.cumsum(n_windows) - n_windows)
    e = np.exp(lift - top[doc])
    return e / np.bincount(doc, e)[doc]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, intercept) by damped Newton steps: what the most toxic window says about its document."""
    slope, base = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + base, -30, 30)))
        g, h = weight * (y - p), weight * p * (1 - p) + 1e-9
        a = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        move = np.linalg.solve(a, [(g * x).sum(), g.sum()])
        slope, base = max(0.0, slope + 0.5 * move[0]), base + 0.5 * move[1]
    return float(slope), float(base)


def _sum_by(group: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each of n groups."""
    return np.column_stack([np.bincount(group, rows[:, k], n) for k in range(rows.shape[1])]).astype(np.float32)


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", held_out: tuple[int, int] = HELD_OUT,
    max_labelled: int = MAX_LABELLED, max_chars: int = MAX_CHARS,
) -> ToxicityModel:
    """Learn from at most `max_labelled` documents per label value, each of at most `max_chars` characters.

    Without labels, or with one value only, every score is that value's share smoothed by one row of
    each kind. Null texts count as empty.
    """
    counts = shares(labels, label, *held_out)

    def constant(no: float, yes: float) -> ToxicityModel:
        return ToxicityModel(np.zeros(BUCKETS), float(np.log((yes + 1) / (no + 1))))

    if not (counts[0] and counts[1]):
        return constant(counts[0], counts[1])
    chosen = labelled(labels, label, *held_out, max_labelled)
    rows = (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .where(F.length("text") <= max_chars)
        .join(F.broadcast(chosen), "doc_id")  # at most 2 * max_labelled rows
        .select("text", "y")
        .limit(4 * max_labelled)  # copies of a document id may not make the sample larger than that
        .collect()
    )
    rows = sorted((r["text"], r["y"]) for r in rows)
    y = np.array([r[1] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return constant(len(y) - y.sum(), y.sum())
    each = np.array([counts[0], counts[1]], float) / [np.sum(y == 0), np.sum(y == 1)]
    return train([r[0] for r in rows], y, each[y.astype(int)])


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score): one row per row of `documents`, whole texts; empty or null texts get the base score."""

    def start():
        score = model.scorer()
        return lambda ids, texts: [ids, score(texts)]

    return map_batches(
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
        "doc_id bigint, score double", [("doc_id", pa.int64()), ("score", pa.float64())], start,
    )
