"""Quality rules as a ledger: every rule is evaluated once, and policies are masks over its bits.

A row of the ledger holds what was measured of a text and one number whose bit i says that rule i fails. Which rules
count is a policy, a mask under a version name; to apply another one, or to ask what a rule does under it, the
texts are not read again. Ablations count rows per distinct number first (at most 2 to the number of rules), and
read everything off these counts by bitwise operations.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import map_batches
from plumbline.session import Checkpoints

WINDOW = 5
SYMBOLS, BLANKS = b"#*$%&|<>", b" \t\n\r\x0b\x0c"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A name, and from the measures' columns the condition under which a text fails."""

    name: str
    fails: Callable[[Mapping[str, Column]], Column]


# The place of a rule is its bit; new rules go to the end, so that ledgers stay readable.
RULES = (
    Rule("few_words", lambda m: m["n_words"] < 10),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > 3 * m["n_words"]),
    Rule("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 15 * m["n_words"]),
    Rule("repeated_lines", lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
)
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "1": ("few_words", "repeated_windows", "symbols", "short_words", "long_words", "repeated_lines"),
}
LATEST = "1"


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both parts are."""
    if not len(left):
        return left
    return pd.factorize(left * (right.max() + 1) + right)[0].astype(np.int64)


def repeated_words(codes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text, the words in windows of five that its words hold twice or more; `text` names each word's text."""
    n = len(codes) - WINDOW + 1
    if n < 1:
        return np.zeros(n_texts, np.int64)
    two = _paired(codes[:-1], codes[1:])
    five = _paired(_paired(two[:-2], two[2:])[:n], codes[WINDOW - 1 :])
    starts = np.flatnonzero(text[:n] == text[WINDOW - 1 :])
    window = _paired(five[starts], text[starts])
    often = np.bincount(window)[window] > 1 if len(window) else np.zeros(0, bool)
    opens = np.bincount(starts[often], minlength=len(codes))
    closes = np.bincount(starts[often] + WINDOW, minlength=len(codes) + 1)[: len(codes)]
    return np.bincount(text[np.cumsum(opens - closes) > 0], minlength=n_texts)


def measure(texts: Sequence[str | None]) -> list[np.ndarray]:
    """The measures of whole texts, in the order of `MEASURES`; a null text has no words."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    split = [t.split() for t in raw]
    n_words = np.array([len(w) for w in split], np.int64)
    n_symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in raw], np.int64)
    blanks = np.array([len(t) - len(t.translate(None, BLANKS)) for t in raw], np.int64)
    word_chars = np.array([len(t or "") for t in texts], np.int64) - blanks
    lines = [[line for line in t.split(b"\n") if line.strip()] for t in raw]
    n_lines = np.array([len(part) for part in lines], np.int64)
    n_dup_lines = n_lines - np.array([len(set(part)) for part in lines], np.int64)
    words = pa.array([w for part in split for w in part], pa.large_binary())
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    n_repeat = repeated_words(codes, np.repeat(np.arange(len(raw)), n_words), len(raw))
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat, n_lines]


def ledger(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, measures, failures): one row per row of `documents`, bit i of `failures` set if rule i fails.

    A null or empty text has no words and is measured like any other; a null doc_id stays null, repeated ids and
    rows keep their rows, an empty table gives an empty ledger. Other columns are not read.
    """
    if len(rules) > 63:
        raise ValueError("a ledger holds at most 63 rules")
    fields = [("doc_id", pa.int64())] + [(m, pa.int64()) for m in MEASURES]
    measured = map_batches(
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
        ", ".join(f"{name} bigint" for name, _ in fields), fields,
        lambda: lambda ids, texts: [ids, *measure(texts)],
    )
    columns = {m: F.col(m) for m in MEASURES}
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(rule.fails(columns), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0)))
    return measured.withColumn("failures", bits)


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    places = {rule.name: i for i, rule in enumerate(rules)}
    return sum(1 << places[name] for name in set(names))


def rejected(policy: str, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a ledger's row fails any rule of the policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(policies[policy], rules))) != 0


def judge(ledger_rows: DataFrame, policy: str = LATEST) -> DataFrame:
    """The ledger with base_failed and kept; a row that fails the base policy is never kept."""
    return ledger_rows.withColumn("base_failed", rejected("base")).withColumn(
        "kept", ~(F.col("base_failed") | rejected(policy))
    )


def ablations(
    ledger_rows: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """(policy, rule, n_rows, n_failed, n_alone, n_kept, n_kept_without) for every rule of every policy.

    n_failed rows fail the rule, n_alone only this one of the policy; n_kept_without rows would be kept without it.
    An empty ledger gives zeros.
    """
    counts = ledger_rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    bits, n = F.col("failures"), F.col("n")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("bigint")

    rows = []
    for policy, names in policies.items():
        all_bits = mask(names, rules)
        for name in names:
            own = mask([name], rules)
            rows.append(
                F.struct(
                    F.lit(policy).alias("policy"), F.lit(name).alias("rule"), total(F.lit(True)).alias("n_rows"),
                    total(bits.bitwiseAND(F.lit(own)) != 0).alias("n_failed"),
                    total(bits.bitwiseAND(F.lit(all_bits)) == own).alias("n_alone"),
                    total(bits.bitwiseAND(F.lit(all_bits)) == 0).alias("n_kept"),
                    total(bits.bitwiseAND(F.lit(all_bits & ~own)) == 0).alias("n_kept_without"),
                )
            )
    return counts.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def stored_ledger(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger as a table in the checkpoint folder: no later policy or ablation reads a text."""
    return Checkpoints(documents.sparkSession).write(ledger(documents, rules))
