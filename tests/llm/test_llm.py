"""The ten operators against brute force, on small frames with nulls, empty texts, ties and repeated rows."""

import random
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plumbline.llm import (
    decontaminate,
    html_text,
    licenses,
    packing,
    quality,
    simhash,
    token_counts,
    toxicity,
    url_rules,
    vector_links,
)
from plumbline.session import ensure_checkpoint_dir

WORDS = "the of and to in that it is with for as was on are by an be this have from or had not but what all were".split()


def clean(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ing", "ed", "er"]) for _ in range(n))


# op1


def brute_cover(streams, run, pages, share):
    distinct = list(dict.fromkeys(map(tuple, streams)))
    needed = max(pages, int(np.ceil(share * len(distinct))))
    seen = {}
    for i, s in enumerate(distinct):
        for j in range(len(s) - run + 1):
            seen.setdefault(s[j : j + run], set()).add(i)
    marks = []
    for s in streams:
        mark = np.zeros(len(s), bool)
        for j in range(len(s) - run + 1):
            if len(seen[tuple(s[j : j + run])]) >= needed:
                mark[j : j + run] = True
        marks.append(mark)
    return marks


def test_suffix_array_covers_what_brute_force_covers():
    rng = np.random.default_rng(0)
    for _ in range(100):
        streams = [[str(x) for x in rng.integers(0, 3, rng.integers(0, 15))] for _ in range(rng.integers(1, 8))]
        streams += streams[:1]
        run = int(rng.integers(1, 7))
        got, want = html_text.repeated(streams, run, 2, 0.1), brute_cover(streams, run, 2, 0.1)
        assert all((a == b).all() for a, b in zip(got, want))


def test_blocks_of_a_page():
    page = (
        "<html><head><title>T</title></head><body><nav><ul><li>menu</ul></nav><div class='cookie-banner'>We <b>bake</b>"
        "</div><main><article><header><h1>Title &amp; x</h1></header><p>One <span class='ad'>buy<span>!</span></span>two"
        "<p>Three<aside>side</aside><form>f<input></form><ul><li>a<li class=share>s<li>b</ul>"
        "<section id='comments'><p>hi</section><footer>by</footer></article></main><script>x</script></body></html>"
    )
    assert [t for r, t in html_text.blocks_of(page) if r == html_text.ARTICLE] == ["Title & x", "One two", "Three", "a", "b"]
    assert html_text.blocks_of(None) == html_text.blocks_of("") == html_text.blocks_of("<!-- x") == []
    assert html_text.blocks_of("a < b &lt;i&gt;  c<p>d") == [("open", "a < b <i> c"), ("open", "d")]


@pytest.mark.parametrize("page", [
    "<article class='post tag-social'>the text</article>",
    "<article class='category-notices'>the text</article>",
    "<div class='content no-sidebar'><article>the text</article></div>",
    "<div id='form-page'><article>the text</article></div>",
    "<div class='has-comments'><main>the text</main></div>",
    "<article><p class='share-price'>the text</p><div class='social-share'>like it</div></article>",
    "<article class='promo'>the text</article>",
    "<main class='search'>the text</main>",
    "<div class='sidebar-left'><article>other news</article></div><article>the text</article>",
    "<div class='page-with-sidebar'><div itemprop='articleBody' class='form'>the text</div></div>",
    "<article>the text<div class='related-posts'><article>more</article></div><article class='comment'>no</article></article>",
])
def test_class_names_do_not_speak_against_article_markup(page):
    assert [t for r, t in html_text.blocks_of(page) if r == html_text.ARTICLE] == ["the text"]


@pytest.mark.parametrize("page", [
    "<a " * 400_000, "<article>x" + "<a " * 400_000, "<div>" * 100_000 + "x", "<div>" * 50_000 + "</p>" * 100_000,
    "<b><div class='ad'>" * 30_000 + "</i>" * 30_000, "<!-- " * 200_000, "<script>" * 100_000, '<a "' * 200_000 + ">",
    "<svg " * 200_000 + ">", "&amp" * 200_000, "<p>" * 200_000, "< " * 500_000,
])
def test_bad_long_pages_are_read_in_linear_time(page):
    start = time.process_time()
    html_text.blocks_of(page)
    assert time.process_time() - start < 10


def test_pages_without_an_article_lose_what_their_host_repeats(frame):
    bar = "home news sports weather money travel contact"
    rows = [(i, f"https://a.example/{i}", f"<div>{bar}</div><div>story number {i} is told once {i * 7}</div>") for i in range(6)]
    rows += [(7, None, None), (8, "x", ""), (None, "https://a.example/z", "<article><p>kept</p></article>")]
    df = frame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("clash"))
    found = {r["page_id"]: r["text"] for r in html_text.extract_text(df, shard=4).collect()}
    assert found[3] == "story number 3 is told once 21" and found[7] == found[8] == "" and found[None] == "kept"
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_article_blocks_that_a_host_repeats_go_by_the_suffix_array(frame):
    rng = random.Random(5)
    notice, line = "Sign up to our letter and get the news", "Licensed under the Apache License , Version 2.0 ."
    page = "<nav>menu</nav><article><h1>{}</h1><p>{}</p>{}</article>"
    stories = [(f"Story {i}", clean(rng, 60)) for i in range(40)]

    def host(name, bodies):
        return [(f"http://{name}/{i}", b) for i, b in enumerate(bodies)]

    end = f"<p>{notice}</p><p>Share this</p>"
    copies = [(f"Copy {i}", " ".join([stories[0][1]] * 2), "") for i in range(40)]
    stories[7] = ("Brief", "Rain again")  # the notice is most of what its article says
    served = (
        host("all.example", [page.format(*s, end) for s in stories] + [page.format(*stories[0], end)] * 100)
        + host("half.example", [page.format(*s, f"<p>{line}</p>" if i % 2 else "") for i, s in enumerate(stories)])
        + host("few.example", [page.format(*s, end) for s in stories[:10]])
        + host("copies.example", [page.format(*c) for c in copies])
        + host("same.example", [page.format(*stories[1], end)] * 50)
    )
    df = frame([(i, u, h) for i, (u, h) in enumerate(served)], "page_id bigint, url string, html string")
    found = {r["url"]: r["text"] for r in html_text.extract_text(df).collect()}
    assert len(found) == len(served)
    whole = ["\n".join(s) for s in stories]
    assert [found[f"http://all.example/{i}"] for i in range(40)] == whole  # no copy counts twice, none keeps it
    assert all(found[f"http://all.example/{40 + i}"] == whole[0] for i in range(100))
    assert found["http://half.example/3"] == f"{whole[3]}\n{line}" and found["http://half.example/4"] == whole[4]
    assert found["http://few.example/3"] == f"{whole[3]}\n{notice}\nShare this"
    assert found["http://copies.example/3"] == f"{copies[3][0]}\n{copies[3][1]}"
    assert found["http://same.example/3"] == f"{whole[1]}\n{notice}\nShare this"


def test_furniture_of_articles_against_brute_force():
    rng = np.random.default_rng(3)
    hits = 0
    for _ in range(600):
        common = [" ".join(rng.choice(list("abc"), rng.integers(1, 6))) for _ in range(3)]
        articles = {
            tuple(str(rng.choice(common)) if rng.random() < 0.3 else " ".join(rng.choice(list("abcdefgh"), rng.integers(1, 9)))
                  for _ in range(rng.integers(1, 7)))
            for _ in range(rng.integers(1, 9))
        }
        articles = sorted(map(list, articles))
        needed = max(2, int(np.ceil(0.4 * len(articles))))
        marks = brute_cover([" ".join(a).split() for a in articles], 2, 2, 0.4)
        held, apart = {}, {}
        for a, mark in zip(articles, marks):
            owner = np.repeat(np.arange(len(a)), [len(b.split()) for b in a])
            for b in {b for i, b in enumerate(a) if mark[owner == i].all()}:
                held[b] = held.get(b, 0) + 1
                apart[b] = apart.get(b, 0) + (2 * mark.sum() < len(mark))
        want = sorted(b for b in held if held[b] >= needed and 2 * apart[b] > held[b])
        assert html_text.article_furniture(articles, 2, 2, 0.4) == want
        hits += bool(want)
    assert hits > 20


def test_furniture_is_taken_from_an_article(frame):
    found = ["Share this", "Sign up to our letter now"]
    articles = {
        "a b": ["a", found[1], "b"], "a Share this b": ["a", found[0], "b"], "a": ["a", *found], "b": [found[0], found[1], found[0], "b"],
        "Share this Sign up to our letter now": found, "a c": ["a", found[0], found[0], "c"],
    }
    df = frame([(a, found) for a in articles.values()] + [(["a", found[1]], None)], "a array<string>, f array<string>")
    got = [" ".join(r[0]) for r in df.select(html_text.without_furniture(F.col("a"), F.col("f"), 6)).collect()]
    assert got == [*articles, f"a {found[1]}"]


def test_articles_of_a_large_host_are_dealt_to_shards(frame, monkeypatch):
    monkeypatch.setattr(html_text, "SHARD_ARTICLES", 40)
    monkeypatch.setattr(html_text, "KNOWN", 3)  # copies are told apart after the shuffle too
    sizes, inner = [], html_text.deal_articles

    def deal_articles(read):
        dealt = inner(read)
        sizes.extend(dealt.collect())
        return dealt

    monkeypatch.setattr(html_text, "deal_articles", deal_articles)
    rng = random.Random(6)
    stories, notice = [clean(rng, 30) for _ in range(130)], "read more of our news on the front page"
    rows = [(i, "http://big.example/", f"<article><p>{stories[i % 130]}</p><p>{notice}</p></article>") for i in range(520)]
    df = frame(rows, "page_id bigint, url string, html string").repartition(4)
    found = {r["page_id"]: r["text"] for r in html_text.extract_text(df).collect()}
    assert [tuple(r) for r in sizes] == [("big.example", 2)]  # 130 / 50: shards are not cut below 50 articles
    assert found == {i: stories[i % 130] for i in range(520)}


def test_pages_with_the_same_furniture_are_one_stream(frame, monkeypatch):
    menu = "<nav>one two three four five six seven</nav>"
    rows = [(i, f"http://h.example/{i}", f"{menu}<article>text {i}</article>") for i in range(60)]
    rows += [(100 + i, None if i % 2 else "http://h.example/x", f"<p>same page {i % 3}</p>") for i in range(30)]
    sizes, inner = [], html_text.deal

    def deal(streams, shard):
        dealt = inner(streams, shard)
        sizes.extend(r["count"] for r in dealt.groupBy("host", "shard").count().collect())
        return dealt

    monkeypatch.setattr(html_text, "deal", deal)
    df = frame(rows, "page_id bigint, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.extract_text(df, shard=4).collect()}
    assert sum(sizes) == 7  # the menu and three pages at the host, three pages without one
    assert len(found) == 90 and found[7] == "text 7"
    assert all(found[100 + i] == f"same page {i % 3}" for i in range(30))


# op2 and op7


def test_subwords_are_those_of_each_word_alone():
    buckets, counts = toxicity.subwords(["idiot", "a", "ab"])
    alone = [toxicity.subwords([w])[0].tolist() for w in ("idiot", "a", "ab")]
    assert buckets.tolist() == sum(alone, []) and counts.tolist() == [len(a) for a in alone]


def test_toxicity_finds_misspellings_and_leaves_clean_texts(spark, frame):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = clean(rng, rng.randrange(5, 120)).split()
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["worthless", "pathetic", "disgusting"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = frame(rows, "doc_id bigint, text string")
    marks = frame(labels + [(1, None), (None, 1), (2, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(docs, marks)
    score = model.scorer()
    assert score([clean(rng, 60) + " worthles pathetiic", clean(rng, 60)])[0] > 0.3 > score([clean(rng, 60)])[0]
    more = frame([(1, None), (1, ""), (None, "x" * 50_000)], "doc_id bigint, text string").withColumn("score", F.lit("x"))
    scored = toxicity.score_toxicity(more, model).collect()
    assert len(scored) == 3 and all(0 <= r["score"] <= 1 for r in scored)
    held = [(y, s) for (i, y), (_, t) in zip(labels, rows) for s in score([t]) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((s >= 0.3) == bool(y) for y, s in held) >= 0.95 * len(held)
    constant = toxicity.fit_toxicity(docs, marks.limit(0))
    assert constant.scorer()(["a", None]) == [0.5, 0.5]


def test_quality_rules_compile_to_the_same_scores(spark, frame):
    rng = random.Random(5)
    rows = []
    for i in range(500):
        text = clean(rng, rng.randrange(5, 80)).capitalize() + "."
        if i % 5 == 0:
            text = rng.choice([text.upper() + "!!", " ".join(w + "%%%" for w in text.split()), (text.split()[0] + " ") * 40])
        rows.append((i, text, int(i % 5 != 0)))
    docs = frame([r[:2] for r in rows], "doc_id bigint, text string")
    marks = frame([(r[0], r[2]) for r in rows] + [(None, 0), (3, None)], "doc_id bigint, quality int")
    model = quality.fit_quality(docs, marks)
    assert model.rules
    scores = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum((scores[i] >= 0.3) == bool(y) for i, _, y in held) >= 0.95 * len(held)
    stats = docs.select("doc_id", *(c.alias(n) for n, c in quality.statistics(F.col("text")).items())).toPandas()
    x = {n: stats[n].to_numpy() for n in quality.NAMES}
    logit = model.intercept + sum(w * rule.mask(x, len(stats)) for rule, w in model.rules)
    for i, want in zip(stats["doc_id"], 1 / (1 + np.exp(-logit))):
        assert scores[i] == pytest.approx(want)
    odd = frame([(1, None), (1, ""), (None, "a " * 20_000)], "doc_id bigint, text string")
    assert quality.score_quality(odd, model).where("score between 0 and 1").count() == 3
    assert list(quality.statistics(F.lit(""))) == quality.NAMES


# op3


def test_ledger_is_idempotent_and_revises(spark, frame):
    folder = f"{ensure_checkpoint_dir(spark)}/ledger-test-{random.random()}"
    ledger = token_counts.TokenLedger(spark, folder).create()
    schema = "doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint, op string"
    one = frame([(1, "a", "en", "t", 5, "upsert"), (1, "a", "en", "t", 5, "upsert"), (2, "a", "en", "t", 7, "upsert"),
                 (3, None, "en", "t", None, "upsert"), (None, "a", "en", "t", 9, "upsert"), (4, "a", "en", "t", 1, "x")], schema)
    two = frame([(1, None, None, "t", None, "delete"), (2, "b", "en", "t", 10, "upsert"), (9, None, None, "t", None, "delete")], schema)
    totals = lambda: {tuple(r)[:3]: tuple(r)[3:] for r in ledger.totals().collect()}
    assert ledger.commit(1, one) and not ledger.commit(1, one)
    assert totals() == {("a", "en", "t"): (2, 12), (None, "en", "t"): (1, 0)}
    assert ledger.commit(2, two) and not ledger.commit(2, two) and not ledger.commit(1, two)
    assert totals() == {("b", "en", "t"): (1, 10), (None, "en", "t"): (1, 0)}
    assert ledger.commit(3, one.limit(0)) and len(totals()) == 2
    with pytest.raises(ValueError):
        ledger.commit(0, one)


# op4


def test_vector_links_against_brute_force(spark, frame, monkeypatch):
    monkeypatch.setattr(vector_links, "BLOCK", 20)  # a crowded cell is cut into blocks
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 16))
    near = base[:40] + rng.normal(scale=0.08, size=(40, 16))
    hot = base[0] + rng.normal(scale=0.05, size=(70, 16))
    x = np.concatenate([base, near, hot, np.repeat(base[5:6], 30, 0), 3 * base[6:7]]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [1.0, None] + [0.0] * 14),
           (1004, [1.0]), (1005, []), (None, [1.0] * 16)]
    got = {r["vec_id"]: r for r in vector_links.link_vectors(frame(rows + odd, "vec_id bigint, embedding array<float>")).collect()}
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    links = y @ y.T >= 0.9
    np.fill_diagonal(links, False)
    found = sum(got[i]["n_links"] for i in range(len(x)))
    assert found >= 0.9 * links.sum() and all(got[i]["n_links"] <= links[i].sum() for i in range(len(x)))
    root = np.arange(len(x))
    for _ in range(20):
        for a, b in zip(*np.nonzero(links)):
            root[a] = min(root[a], root[b])
    assert np.mean([got[i]["component_id"] == root[i] for i in range(len(x))]) >= 0.98
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(1000, 1006))
    assert got[None]["component_id"] is None and not got[None]["kept"] and len(got) == len(rows) + 7
    # Vectors of any length link among themselves, and a vec_id is no vector: two rows of one id may differ.
    short = [(7, [1.0, 2.0]), (9, [2.0, 4.0]), (8, [-1.0, 2.0]), (8, [5.0, 5.0]), (8, [5.0, 5.5]), (3, [0.0, -1.0])]
    short += [(i + 100, v.tolist()) for i, v in enumerate(base[:3])]
    found = vector_links.link_vectors(frame(short, "vec_id bigint, embedding array<double>")).collect()
    assert sorted(map(tuple, found)) == sorted([
        (7, 3, 7, True), (9, 3, 7, False), (8, 0, 8, True), (8, 3, 7, False), (8, 3, 7, False), (3, 0, 3, True),
        (100, 0, 100, True), (101, 0, 101, True), (102, 0, 102, True)])
    assert vector_links.link_vectors(frame([], "vec_id bigint, embedding array<float>")).count() == 0


# op5


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_leaks_against_brute_force(spark, frame):
    rng = random.Random(3)
    names = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(names) for _ in range(n))) for i, n in enumerate([3, 5, 8, 12, 20])]
    docs = []
    for i in range(120):
        words = [rng.choice(names) for _ in range(rng.randrange(0, 30))]
        leak = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, 6)):
            leak[rng.randrange(len(leak))] = rng.choice(names)
        at = rng.randrange(len(words) + 1)
        docs.append((i, " ".join(words[:at] + leak + words[at:])))
    odd = [(500, None), (501, ""), (None, items[4][1]), (3, items[2][1].upper())]
    bench = frame(items + [(None, "a b c d"), (9, None), (10, "two words"), items[0]], "item_id bigint, text string")
    found = decontaminate.find_leaks(frame(docs + odd, "doc_id bigint, text string"), bench, block=3).collect()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found if r["doc_id"] not in (None, 3)}
    want = {}
    for i, text in docs:
        words = text.split()
        for item, body in items:
            own = body.split()
            k = decontaminate.allowed(len(own))
            best = min((edit_distance(own, words[a:b]) for a in range(len(words)) for b in range(a + 1, len(words) + 1)
                        if abs(b - a - len(own)) <= k), default=99)
            if best <= k and i != 3:
                want[i, item] = best
    assert got == want and len(want) > 40
    assert any(r["doc_id"] is None and r["item_id"] == 4 for r in found)
    kept = decontaminate.without_leaks(frame(docs + odd, "doc_id bigint, text string"), bench)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs + odd[:2]} - {i for i, _ in got} - {3}
    assert decontaminate.find_leaks(frame(docs, "doc_id bigint, text string"), bench.limit(0)).count() == 0


def test_leaks_of_short_items_and_scripts_without_blanks(frame):
    chinese = "今天天气很好我们去公园散步吧"
    bench = frame([(1, chinese), (2, "Two words"), (3, "ไทยแลนด์"), (4, "one"), (5, "ok"), (5, "ok"), (6, " . ")], "item_id bigint, text string")
    docs = [(1, chinese), (2, "前面" + chinese.replace("公", "花") + "后面"), (3, "two  WORDS."), (4, "two words more"), (5, "xไทยแลนด์"),
            (6, "one two words"), (7, "OK"), (8, "今天下雨了"), (9, " . "), (None, "one")]
    found = decontaminate.find_leaks(frame(docs, "doc_id bigint, text string"), bench).collect()
    assert sorted(((r["doc_id"] or 0, r["item_id"], r["edits"]) for r in found)) == [
        (0, 4, 0), (1, 1, 0), (2, 1, 1), (3, 2, 0), (5, 3, 0), (7, 5, 0)]


def test_gram_codes_of_any_number_of_words_are_exact():
    rng = np.random.default_rng(4)
    big = 2**31 - 1
    items = [rng.choice([0, 1, 2, 2**21, 2**22 + 1, big], 9).astype(np.int64) for _ in range(30)]
    pairs = np.unique(np.concatenate([w[:-2] << 31 | w[1:-1] for w in items]))
    known = {tuple(w[i : i + 3].tolist()) for w in items for i in range(7)}
    codes = {}
    for w in items:
        for i, code in enumerate(decontaminate._gram_codes(w, pairs).tolist()):
            assert code >= 0 and codes.setdefault(code, tuple(w[i : i + 3].tolist())) == tuple(w[i : i + 3].tolist())
    assert len(codes) == len(known)
    text = rng.choice([-1, 0, 1, 2, 2**21, 5, big], 2000).astype(np.int64)
    for i, code in enumerate(decontaminate._gram_codes(text, pairs).tolist()):
        assert (codes.get(code) == tuple(text[i : i + 3].tolist())) == (tuple(text[i : i + 3].tolist()) in known)


# op6


def test_url_rules_against_brute_force(frame):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
             ("org", "/fr/x", "block"), ("a.org", "/", "block"), ("a.org", "/", "allow"), (None, "/", "block"), ("", "/", "block")]
    hosts = ["net", "x.net", "example.net", "EXAMPLE.net", "notexample.net", "a.example.com", "example.com.", "a.org", "b.a.org",
             "xa.org", "org", "a-b.org", "net.", ".net", "example.net:80", ""]
    paths = ["", "/", "/en/", "/en/1?x=/de/", "/de/2#f", "/fr/", "/fr/xy", "/fr", "?q", "#h/en/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "net/en/", "://net/", "http://net/", "a://b://net/"]
    df = frame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string").withColumn("rule", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in url_rules.judge_urls(df, frame(rules, "host string, path string, verdict string"), salts=3).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:cut].lower()
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
                if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, 0, None, "allow"))
        assert got[i] == (host, path, best[3], best[4]), u


# op8


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark, frame):
    rng = random.Random(6)
    fps = sorted({rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1, 1, 3, 7})
    for f in list(fps[:30]):
        fps += [f ^ 1 << rng.randrange(64), f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64), f ^ 7]
    fps = sorted(set(fps))
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    pairs = {(r["fp"], r["other"]) for r in simhash.close_pairs(frame([(s,) for s in signed], "fp bigint")).collect()}
    want = {tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    assert pairs == want
    texts = [clean(rng, n) for n in (0, 1, 2, 3, 4, 50, 400)] + [None, "", "É é\x0bA b\x1cC \u00a0 x"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    rows = [(5, "a b c d"), (2, "A b  c\nd"), (9, None), (7, ""), (7, ""), (None, "a b c d"), (8, clean(rng, 80))]
    got = simhash.near_duplicates(frame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in got) == [(-1, 2), (2, 2), (5, 2), (7, 7), (7, 7), (8, 8), (9, 7)]
    assert simhash.near_duplicates(frame([], "doc_id bigint, text string")).count() == 0


# op9


def test_license_scan_against_brute_force(frame):
    rng = random.Random(8)
    pool = "cc by general public license all rights reserved mit the é of".split()
    rows = [(i, rng.choice([" ", "-", ". ", "\n"]).join(rng.choice(pool) for _ in range(rng.randrange(40)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "CC-BY\u00e9 cc BY"), (None, "SPDX-License-Identifier: MIT OR GPL-2.0\nx")]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(frame(rows, "doc_id bigint, text string")).collect()}
    for i, text in rows:
        words = "".join(c if c >= "\x80" or c.isalnum() else " " for c in "".join(
            c.lower() if "A" <= c <= "Z" else c for c in text or "")).split(" ")
        words = [w for w in words if w]
        places = [(j, label) for p, label in licenses.BASE_PHRASES.items() for j in range(len(words))
                  if words[j : j + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min((j for j, _ in places), default=None)
        assert r["last_word"] == max((j for j, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
    assert got[None]["labels"] == "gpl,mit" and got[None]["expressions"] == ["MIT OR GPL-2.0"]


@pytest.mark.parametrize(("text", "value", "names"), [
    ("MIT OR GPL-3.0-only", 0.1, {"mit", "gpl"}), ("MIT AND GPL-3.0", 0.7, {"mit", "gpl"}),
    ("GPL-2.0 WITH Classpath-exception-2.0", 0.35, {"gpl"}), ("MIT OR GPL-3.0 AND AGPL-3.0", 0.1, {"mit", "gpl", "agpl"}),
    ("(MIT OR GPL-3.0) AND AGPL-3.0", 0.8, {"mit", "gpl", "agpl"}), ("(MIT", 0.1, {"mit"}), ("MIT AND", 0.1, {"mit"}),
    ("MIT ) x", 0.1, {"mit"}),
])
def test_license_expressions(text, value, names):
    found = licenses.evaluate(text)
    assert found.restriction == pytest.approx(value) and found.names == names


def test_license_scan_of_a_long_text_full_of_phrases():
    """Words are counted once over the whole text, not anew for each of its many places."""
    scan = licenses.LicenseScanner(licenses.BASE_PHRASES, licenses.NOTICE_PHRASES).scan
    n = 300_000
    words, places, first, last, base, labels, _, _ = scan("x general public license " + "cc by é " * n)
    assert (words, places, first, last) == (4 + 3 * n, n + 1, 1, 4 + 3 * (n - 1))
    assert base == labels == "cc-by,gpl"


def test_license_expressions_without_a_license():
    assert licenses.evaluate("OR MIT") is None and licenses.evaluate("") is None
    for words in ("the parties agree", "see below", "A or B", "version 2", "2.0", "none"):
        assert licenses.evaluate(words) is None, words
    assert licenses.evaluate("MIT or the other").names == {"mit"}


@pytest.mark.parametrize(("name", "own"), [
    ("GPLv3+", "gpl"), ("Apache-2.0", "apache"), ("LicenseRef-Own-1", "licenseref-own-1"), ("Sleepycat-1.0", "sleepycat"),
    ("CC-BY-NC-SA-4.0", "cc-by-nc-sa"), ("0BSD", "0bsd"), ("BSD-3-Clause", "bsd"),
])
def test_names_of_licenses(name, own):
    assert licenses.is_license(name) and licenses.family(name) == own
    assert licenses.evaluate(name).names == {own}


# op10


def test_ids_are_those_of_the_tokenizer():
    encoder, rng = packing.IdEncoder(), random.Random(3)
    parts = ["a", "it's", "'s", "\n", "\t", "\u00a0", "x\n", "\n\n", "é", "日本", ".", "...", "12a", "\u2028", "\x1c", "\x85",
             "<|endoftext|>", " ", "  ", "Foo"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "  "]) for _ in range(rng.randrange(12))) for _ in range(800)]
    for text, ids in zip(texts, encoder.encode_all(texts)):
        assert encoder.tokenizer.encode(text, add_special_tokens=False).ids == ids.tolist(), repr(text)


def test_ids_where_a_token_goes_on_over_a_blank():
    encoder, rng = packing.IdEncoder(), random.Random(4)
    spaces = [" ", "\u00a0", "\u00a0 ", " \u00a0", "\n", "\t", "\u3000", "\u2003"]
    texts = ["a" + "".join(rng.choice(spaces) for _ in range(rng.randrange(1, 12))) + "b c" for _ in range(500)]
    texts += ["a" + " \u00a0" * n + tail for n in range(1, 20) for tail in ("", " b", "b")]
    for text, ids in zip(texts, encoder.encode_all(texts)):
        assert encoder.tokenizer.encode(text, add_special_tokens=False).ids == ids.tolist(), repr(text)
    assert encoder.encode_all(["a \u00a0 \u00a0 \u00a0 b"])[0].tolist() == [64, 11504, 5624, 275]


def test_plan_uses_every_piece_once_and_is_tight():
    rng = random.Random(2)
    counts = {}
    for _ in range(3000):
        n = min(100, int(rng.expovariate(1 / 30)) + 1)
        counts[n] = counts.get(n, 0) + 1
    plan, used = packing.plan_bins(counts, 100), {}
    for times, content in plan:
        assert times > 0 and sum(n * k for n, k in content.items()) <= 100
        for n, k in content.items():
            used[n] = used.get(n, 0) + times * k
    assert used == counts
    assert sum(t for t, _ in plan) <= 1.01 * sum(n * k for n, k in counts.items()) / 100 + 1
    assert packing.plan_bins({}) == []
    assert [packing.cut(n, 10) for n in (1, 10, 25)] == [[(0, 1)], [(0, 10)], [(0, 5), (5, 10), (15, 10)]]


def test_packing_round_trip(spark, frame):
    rng = random.Random(1)
    rows = [(i, clean(rng, rng.randrange(0, 60))) for i in range(200)] + [(5, "again"), (None, None), (7, ""), (8, clean(rng, 3000))]
    got = packing.pack_documents(frame(rows, "doc_id bigint, text string"), capacity=64).collect()
    encoder = packing.IdEncoder()
    want = []
    for doc_id, text in rows:
        ids = np.append(np.array(encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4"), 0).astype("<u4")
        for piece, (at, n) in enumerate(packing.cut(len(ids), 64)):
            want.append((doc_id or -1, piece, at, n, zlib.crc32(ids[at : at + n].tobytes())))
    assert sorted((r["doc_id"] or -1, *tuple(r)[1:5]) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 64
    assert len(bins) <= 1.02 * sum(w[3] for w in want) / 64 + 1
    assert packing.pack_documents(frame([], "doc_id bigint, text string")).count() == 0


# pipeline


def test_pipeline_stages_keep_columns_and_take_effect(spark, frame):
    import corpus_pipeline

    rng = random.Random(9)
    text = clean(rng, 60)
    other = clean(rng, 60)
    rows = [(4, text, "x"), (2, text.upper(), "x"), (2, text.upper(), "x"), (None, text, "x"), (6, other, "y")]
    rows += [(2, other, "z"), (8, "", "v"), (9, None, "v"), (9, clean(rng, 60), "w")]
    docs = frame(rows, "doc_id bigint, text string, extra string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["extra"]) for r in kept.collect()) == [
        (-1, "x"), (2, "x"), (2, "z"), (8, "v"), (9, "w")]
    unique = docs.where("extra in ('x', 'v')").dropDuplicates(["doc_id"])
    assert sorted((r["doc_id"] or -1) for r in corpus_pipeline.drop_near_duplicates(spark, unique, "").collect()) == [-1, 2, 8]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "toxicity", "near_duplicates", "decontamination", "packing"]
