"""The rule ledger against rules applied text by text."""

import random
import re

from plumbline.llm import queries, rule_ledger

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(often), len(lines),
    )


def plain_failures(n, chars, symbols, dup, repeat, lines):
    fails = [n < 10, 100 * repeat > 20 * n, 10 * symbols > 3 * n, chars < 2 * n, chars > 15 * n, 100 * dup > 50 * lines]
    return sum(1 << i for i, f in enumerate(fails) if f)


def texts():
    rng = random.Random(3)
    out = [None, "", " \t\n\x0b\x0c\r", "a", "  b\x1cc 　", "one\none\n one\n\n", "# * $ % & | < >", "a b c d e " * 3]
    for _ in range(60):
        words = [rng.choice(["a", "b", "é", "ß𝄞", "#x", "long" * 9]) for _ in range(rng.randrange(40))]
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t", "  "]) for w in words))
    return out + out[:5]


def test_ledger_against_brute_force(frame):
    rows = [(i if i % 9 else None, t, "x", i) for i, t in enumerate(texts())]
    docs = frame(rows, "doc_id bigint, text string, failures string, n_words int")
    want = sorted(((i, *(m := plain_measures(t)), plain_failures(*m)) for i, t, _, _ in rows), key=repr)
    found = rule_ledger.stored_ledger(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    judged = rule_ledger.judge(found).collect()
    assert all(r["base_failed"] == bool(r["failures"] & 3) and r["kept"] == (r["failures"] == 0) for r in judged)
    assert {r["kept"] for r in judged} == {True, False}
    base = rule_ledger.judge(found, "base").collect()
    assert all(r["kept"] != r["base_failed"] for r in base)


def test_ablations_against_brute_force(frame):
    docs = frame([(i, t) for i, t in enumerate(texts())], "doc_id bigint, text string")
    failures = [plain_failures(*plain_measures(t)) for t in texts()]
    got = {(r["policy"], r["rule"]): tuple(r)[2:] for r in rule_ledger.ablations(rule_ledger.ledger(docs)).collect()}
    assert len(got) == 2 + 6
    for (policy, rule), row in got.items():
        every, own = rule_ledger.mask(rule_ledger.POLICIES[policy]), rule_ledger.mask([rule])
        assert row == (
            len(failures), sum(f & own > 0 for f in failures), sum(f & every == own for f in failures),
            sum(f & every == 0 for f in failures), sum(f & (every & ~own) == 0 for f in failures),
        )
    empty = rule_ledger.ablations(rule_ledger.ledger(docs.limit(0))).collect()
    assert len(empty) == 8 and all(tuple(r)[2:] == (0,) * 5 for r in empty)


def test_windows_do_not_cross_texts_and_long_texts_are_whole(spark, frame):
    long = " ".join(f"w{i}" for i in range(200_000)) + " w0 w1 w2 w3 w4"
    docs = frame([(1, "a b c d e"), (2, "a b c d e"), (3, long), (4, "x" * 500_000)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in rule_ledger.ledger(docs).collect()}
    assert [got[i]["n_repeat_words"] for i in (1, 2, 3, 4)] == [0, 0, 10, 0]
    assert got[4]["word_chars"] == 500_000


def test_query_returns_the_contract(spark, frame, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts())]
    frame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_quality_rules"](spark, str(tmp_path))
    assert got.columns[:8] == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = {i: plain_measures(t) for i, t in rows}
    assert {r["doc_id"]: tuple(r)[1:6] for r in got.collect()} == {i: m[:5] for i, m in want.items()}
