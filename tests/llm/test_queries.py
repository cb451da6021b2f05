"""Every registered query and the pipeline on tables of odd rows, and on empty ones."""

import zlib

import numpy as np
import pytest

from plumbline.llm import queries

CONTRACT = {
    "op1_html_text": ["page_id", "url", "text", "n_chars"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_token_counts": ["source", "lang", "tokenizer", "n_docs", "n_tokens"],
    "op4_embedding_links": ["vec_id", "n_links", "component_id", "kept"],
    "op5_decontamination": ["doc_id", "item_id"],
    "op6_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op7_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_simhash": ["doc_id", "fingerprint", "component_id"],
    "op9_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op10_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op11_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op12_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
}
SCHEMAS = {
    # Extra columns have names that the operators use themselves.
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, cell int, fp bigint, "
                 "kept boolean, length int, block int, key string, part int, place int, y int, words string",
    "labels": "doc_id bigint, quality int, toxic int, y int, text string",
    "pages": "page_id bigint, url string, html string, host string, text string, blocks string, digest string",
    "embeddings": "vec_id bigint, embedding array<float>, label int, name string, cell int, key string, parts string, rank int",
    "benchmark": "item_id bigint, text string, edits int",
}


def odd_tables():
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(80)]
    texts += ["", None, " \n\t", "x", texts[3], texts[3] + " more", "a " * 60_000, "y" * 100_000, "e\u0301 中文 \x00 \U0001d11e",
              "all rights reserved " * 3, "SPDX-License-Identifier: MIT OR (GPL-2.0"]
    tail = (1, 0.5, 1, 2, True, 3, 4, "k", 5, 6, 7, "w")
    documents = [(i if i % 13 else None, t, None if i % 7 == 0 else "en", "s") + tail for i, t in enumerate(texts)]
    documents += documents[5:8]  # repeated rows
    labels = [(i, i % 2, int(i % 5 == 0), 9, "t") for i in range(0, 90)] + [(None, 1, None, 9, "t"), (4, None, 1, 9, "t"), (6, 0, 0, 9, "t"), (6, 1, 1, 9, "t")]
    page = "<html><nav>menu</nav><article><p>main {}</p></article></html>"
    pages = [(i, f"https://a{i % 3}.example.net/en/{i}", page.format(i), "h", "t", "b", "d") for i in range(12)]
    pages += [(None, None, None, "h", "t", "b", "d"), (99, "no scheme", "", "h", "t", "b", "d"), (98, "x://", "<p>open</p>" * 3, "h", "t", "b", "d"), pages[0]]
    x = rng.normal(size=(120, 6)).round(2)
    embeddings = [(i, v.tolist(), int(i % 3), "n", 1, "k", "p", 2) for i, v in enumerate(x)]
    embeddings += [(200, None, 1, "n", 1, "k", "p", 2), (250, [None] * 6, 1, "n", 1, "k", "p", 2), (300, [0.0] * 6, None, "n", 1, "k", "p", 2),
                   (None, [1.0] * 6, 1, "n", 1, "k", "p", 2), (350, [1.0, 2.0], 1, "n", 1, "k", "p", 2), embeddings[50], embeddings[50]]
    benchmark = [(1, texts[0], 0), (2, None, 0), (None, "a b c", 0), (3, "", 0), (1, texts[0], 0)]
    return {"documents": documents, "labels": labels, "pages": pages, "embeddings": embeddings, "benchmark": benchmark}


@pytest.fixture(scope="module", params=["odd", "empty"])
def folder(request, spark, tmp_path_factory):
    path = tmp_path_factory.mktemp(request.param)
    rows = odd_tables()
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows[name] if request.param == "odd" else [], schema).write.parquet(f"{path}/{name}.parquet")
    return str(path), rows if request.param == "odd" else {n: [] for n in SCHEMAS}


def test_every_operator_has_one_query():
    assert set(queries.QUERIES) == set(CONTRACT)


@pytest.mark.parametrize("name", list(CONTRACT))
def test_query_on_odd_and_empty_tables(spark, folder, name):
    path, rows = folder
    found = queries.QUERIES[name](spark, path)
    assert found.columns[: len(CONTRACT[name])] == CONTRACT[name]
    got = found.collect()
    if name in ("op2_toxicity", "op7_quality", "op8_simhash", "op9_license_scan", "op11_quality_rules", "op12_token_alignment"):
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d[0]) for d in rows["documents"])
    if name in ("op1_html_text", "op6_url_filters"):
        assert sorted(str(r["page_id"]) for r in got) == sorted(str(p[0]) for p in rows["pages"])
    if name == "op1_html_text":
        assert all(r["n_chars"] == len(r["text"]) for r in got)
    if name == "op4_embedding_links":
        assert sorted(str(r["vec_id"]) for r in got) == sorted(str(v[0]) for v in rows["embeddings"])
    if name in ("op2_toxicity", "op7_quality"):
        modulus, own = (4, 2) if name == "op2_toxicity" else (5, 0)
        for r in got:
            assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
            assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % modulus == own)
    if name == "op8_simhash":
        assert all(len(r["fingerprint"]) == 16 for r in got)
    if name == "op5_decontamination":
        assert {r["item_id"] for r in got} == ({1} if rows["documents"] else set())
    if name == "op10_packing":
        ends = {}
        for r in got:
            ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for places in ends.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 2048


def test_pipeline_on_odd_and_empty_tables(spark, folder):
    """Every stage keeps the columns of its documents but the last, and nothing crashes from end to end."""
    import corpus_pipeline

    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns
    packed = corpus_pipeline.run(spark, path)
    assert packed.columns == CONTRACT["op10_packing"]
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == kept
    assert kept <= {d[0] for d in rows["documents"]}
