"""Main text of HTML pages: suffix arrays over the pages of a host find its boilerplate, and markup says how much a run must
repeat before it goes.

A page is read into blocks, each inside an article, inside furniture (menus, notices, adverts, forms, comments, ...),
or in the open. The token streams of a host are concatenated and sorted as suffixes; runs of at least `MIN_RUN` tokens
that begin suffixes of many distinct streams are boilerplate. Every page has its text from that:

* What a page marks up as its article is one stream, and markup speaks for it. It loses the blocks that runs on at least
  `ARTICLE_SHARE` of the host's distinct articles cover as a whole, such as a notice in plain paragraphs, if
  most of these say more else: copies of one article, with changes, stay whole.
* What is outside is another stream. A page without an article keeps the tokens in the open that no run on `MIN_SHARE` of
  the distinct streams covers. Furniture goes.

Equal streams of a host count as one, so a page that is served twice isn't taken for boilerplate. Distinct streams are dealt
by hash to shards, each with a suffix array of its own, so neither a host that holds a third of all pages nor a page served
very often is one task; boilerplate is on so many pages that every shard sees it. Article text is shuffled once, and equal
articles of a host once a task.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from hashlib import blake2b
from html import unescape
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import map_batches
from plumbline.llm.url_rules import split_url
from plumbline.operators.skew import spread_join
from plumbline.session import Checkpoints

MIN_RUN = 6  # tokens
MIN_PAGES, MIN_SHARE = 3, 0.1  # distinct pages of the shard with a run, at least so many and such a share
SHARD = 2_000  # distinct streams of one host in one suffix array
MIN_ARTICLES, ARTICLE_SHARE = 20, 0.75  # the same for a run inside articles, where markup speaks against its being boilerplate
SHARD_ARTICLES, SHARD_BYTES, FEW_ARTICLES = 500, 4 << 20, 50  # distinct articles in one array, less if long, never so few
KNOWN = 50_000  # articles a task remembers, so as not to send them twice
TASK_BYTES = 16 << 20  # of articles that one task judges, in several arrays

# Fixed values of HTML: elements without content, with raw content, that end a block, and that hold furniture.
_RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|textarea|select|button|title"
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_REPEATED = frozenset("li tr td th dt dd option".split())  # the next one ends the one before
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("head nav footer aside form menu dialog fieldset search".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
# Parts of class names and ids; the second list only counts outside an article, where it can't name its title.
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices notification "
    "newsletter subscribe subscription popup modal overlay share sharing social related recommended recommendations "
    "comment comments commentlist reply replies respond disqus widget toolbar pagination pager login "
    "signup signin search disclaimer alert copyright skip paywall tracking form".split()
)
_OUTER_WORDS = frozenset("header head masthead top topbar bottom logo branding site-header page-header".split())
# What may follow such a word in a longer name, and what makes a name say something else: `sidebar-left` is a sidebar,
# `no-sidebar`, `tag-social`, `share-price` and `form-page` are not what their parts name.
_CARRIERS = frozenset(
    "area author bar block body bottom box btn button buttons card cards container content count entry footer form "
    "header heading icon icons inner item items label left link links list main menu message meta outer panel posts "
    "primary row secondary section slot text thread title toggle top trail unit widget wrap wrapper x".split()
)
_SAID = frozenset("no not has have is are with without tag category cat term topic type format page layout".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?:\s[^>]*)?(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+|[^>]*)>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_BEGIN = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/]+)")
_PARTS = re.compile(r"[A-Za-z][a-z]*|[0-9]+")

ARTICLE, OPEN, FURNITURE = "article", "open", "furniture"


def _names_furniture(names: str, words: frozenset[str]) -> bool:
    """Does a class name or id end with one of `words`, or begin with one and go on with carriers only?"""
    for token in names.split():
        parts = [p.lower() for p in _PARTS.findall(token)]
        if token.lower() in words:
            return True
        if not parts or _SAID.intersection(parts):
            continue
        if parts[-1] in words or (
            parts[0] in words and all(p in words or p in _CARRIERS or p.isdigit() for p in parts[1:])
        ):
            return True
    return False


def _kind(name: str, attrs: str, inside: bool) -> str | None:
    """ARTICLE or FURNITURE if the element starts such a region; no class name speaks against article markup.

    An article inside an article may be a comment or a teaser, and is furniture if its class says so.
    """
    if name in _FURNITURE or (name == "header" and not inside):
        return FURNITURE
    found = {}
    if attrs and not attrs.isspace():
        for m in _ATTRIBUTE.finditer(attrs):
            key = m[1] or m[5]
            found.setdefault(key.lower(), unescape(m[2] or m[3] or m[4] or ""))
    role = found.get("role", "").strip().lower()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or role in _ROLES:
        return FURNITURE
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return FURNITURE
    marked = name == "main" or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
    if name not in ("html", "body") and not marked and (name != "article" or inside):
        names = f"{found.get('class', '')} {found.get('id', '')}"
        if names != " " and (_names_furniture(names, _WORDS) or (not inside and _names_furniture(names, _OUTER_WORDS))):
            return FURNITURE
    if name == "article" or marked:
        return ARTICLE
    return None


def blocks_of(html: str | None) -> list[tuple[str, str]]:
    """(region, text) of the blocks in page order: references decoded, white space runs as one blank, trimmed.

    Scripts, styles, comments and other markup are gone. Elements left open end with what holds them.
    An `article` wins over a `main` around it: then only what is inside articles is article.
    """
    html = html or ""
    blocks: list[tuple[str, str]] = []
    pieces: list[str] = []
    aside: list[str] = []  # furniture inside a block, such as <span class="ad">, does not cut it
    stack: list[tuple[str, str | None]] = []  # open elements that may hold blocks, and the region each starts
    opened: Counter[str] = Counter()  # names on the stack
    furniture, articles, mains, at = 0, 0, 0, 0

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                blocks.append((ARTICLE if articles else "main" if mains else OPEN, text))
            pieces.clear()
        if aside:
            text = " ".join(unescape("".join(aside)).split())
            if text:
                blocks.append((FURNITURE, text))
            aside.clear()

    def pop() -> None:
        nonlocal furniture, articles, mains
        name, kind = stack.pop()
        opened[name] -= 1
        furniture -= kind == FURNITURE
        if kind == ARTICLE:
            if name == "article":
                articles -= 1
            else:
                mains -= 1

    # Behind the last `>` a tag or comment that begins never ends, and the rest of the page is part of it.
    if unfinished := _BEGIN.search(html, html.rfind(">") + 1):
        html = html[: unfinished.start()]
    for m in _TOKEN.finditer(html, 0, html.rfind(">") + 1):
        if m.start() > at:
            (aside if furniture else pieces).append(html[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            (aside if furniture else pieces).append(" ")
            continue
        if name not in _BLOCKS:
            if name not in _VOID and not m["close"]:
                kind = _kind(name, m["attrs"], bool(articles or mains)) if m["attrs"].strip() else None
                kind = None if kind == ARTICLE else kind
                if (kind or furniture) and not m["attrs"].endswith("/"):  # such as <span class="ad">
                    stack.append((name, kind))
                    opened[name] += 1
                    furniture += kind == FURNITURE
            elif m["close"] and opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        flush()
        if name == "hr":
            continue
        if m["close"]:
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if stack and stack[-1][0] in ("p", "head"):  # a block ends an open paragraph, and the head
            pop()
        if stack and stack[-1][0] == name and name in _REPEATED:
            pop()
        kind = _kind(name, m["attrs"], bool(articles or mains))
        stack.append((name, kind))
        opened[name] += 1
        furniture += kind == FURNITURE
        if kind == ARTICLE:
            if name == "article":
                articles += 1
            else:
                mains += 1
    (aside if furniture else pieces).append(html[at:])
    flush()
    best = ARTICLE if any(r == ARTICLE for r, _ in blocks) else "main"
    return [(ARTICLE if r == best else OPEN if r == "main" else r, t) for r, t in blocks]


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): suffixes sorted by their first `depth` or more tokens, and for each the number of
    its class of equal beginnings, by prefix doubling."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    n, length = len(tokens), 1
    order = np.argsort(rank, kind="stable")
    while length < depth:
        step = min(length, depth - length)
        behind = np.full(n, -1, np.int64)
        behind[: n - step] = rank[step:]
        order = np.lexsort((behind, rank))
        changed = np.append(0, (np.diff(rank[order]) != 0) | (np.diff(behind[order]) != 0))
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(changed)
        rank, length = new, length + step
    return order, rank[order]


def repeated(streams: list[list[str]], min_run: int, min_pages: int, min_share: float) -> list[np.ndarray]:
    """For each stream which tokens a run covers that begins suffixes of enough distinct streams.

    Equal streams count as one page. Streams are concatenated with separators that equal nothing.
    """
    distinct: dict[tuple[str, ...], int] = {}
    page_of = [distinct.setdefault(tuple(s), len(distinct)) for s in streams]
    pages = list(distinct)
    total = sum(map(len, pages))
    if not total:
        return [np.zeros(len(s), bool) for s in streams]
    known: defaultdict[str, int] = defaultdict(count().__next__)
    flat, owner = np.empty(total + len(pages), np.int64), np.empty(total + len(pages), np.int64)
    at, starts = 0, []
    for i, page in enumerate(pages):
        starts.append(at)
        flat[at : at + len(page)] = list(map(known.__getitem__, page))
        flat[at + len(page)] = -1 - i  # a separator of its own: no run goes across pages
        owner[at : at + len(page) + 1] = i
        at += len(page) + 1
    order, group = suffix_array(flat, min_run)
    # Distinct pages in each class of suffixes with the same first tokens.
    pair = np.sort(group * len(pages) + owner[order], kind="stable")
    pair = pair[np.append(True, np.diff(pair) != 0)]
    n_pages = np.bincount(pair // len(pages), minlength=group.max() + 1)
    needed = max(min_pages, int(np.ceil(min_share * len(pages))))
    begins = np.sort(order[n_pages[group] >= needed])
    # A separator makes its suffix the only one of its class, so runs lie within pages.
    marks = np.zeros(len(flat) + 1, np.int64)
    np.add.at(marks, begins, 1)
    np.add.at(marks, np.minimum(begins + min_run, len(flat)), -1)
    covered = np.cumsum(marks)[:-1] > 0
    return [covered[starts[p] : starts[p] + len(s)] for p, s in zip(page_of, streams)]


def _unique_text(blocks: list[tuple[list[str], bool]], covered: np.ndarray, min_run: int) -> str:
    """The open blocks without what boilerplate covers of them.

    A run may go on into a block for a few words that the block merely begins or ends with; those stay, unless
    they are the whole block.
    """
    out, at = [], 0
    for tokens, is_open in blocks:
        marks = covered[at : at + len(tokens)]
        at += len(tokens)
        if not is_open or marks.all():
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
        kept = np.ones(len(tokens), bool)
        for first, end in zip(edges[::2], edges[1::2]):
            kept[first:end] = end - first < min_run
        if kept.any():
            out.append(" ".join(t for t, k in zip(tokens, kept) if k))
    return "\n".join(out)


def deal(streams: DataFrame, shard: int) -> DataFrame:
    """`streams`, distinct by (host, digest), with the shard of its host that each is in."""
    # Rounded down: a shard holds `shard` streams to twice as many, none so few that boilerplate goes uncounted.
    large = (
        streams.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > shard).select("host", F.floor(F.col("n") / shard).cast("int").alias("shards"))
    )
    return spread_join(streams, large, ["host"], "left").withColumn(
        "shard", F.pmod(F.xxhash64("digest"), F.coalesce("shards", F.lit(1)))
    )


def deal_articles(read: DataFrame) -> DataFrame:
    """(host, shards): hosts whose distinct articles are too much for one suffix array; at most one in 100 articles."""
    sizes = read.where("has_article").groupBy("host", "article_digest").agg(F.max("n_bytes").alias("n_bytes"))
    n = F.count(F.lit(1))
    shards = F.least(n / FEW_ARTICLES, F.greatest(n / SHARD_ARTICLES, F.sum("n_bytes") / SHARD_BYTES))
    return sizes.groupBy("host").agg(F.floor(shards).cast("int").alias("shards")).where("shards > 1")


def article_furniture(articles: list[list[str]], min_run: int, min_articles: int, min_share: float) -> list[str]:
    """The blocks that are furniture of the host, in the order of the texts, found in its distinct articles (lists of blocks).

    Runs on enough articles cover such a block in as many of them; common runs can make up a block that is nowhere
    else. Articles that are copies of one with changes repeat most of their text, so most of those in which the block is
    covered must be covered by less than half.
    """
    streams = [[b.split() for b in a] for a in articles]
    marks = repeated([[t for b in a for t in b] for a in streams], min_run, min_articles, min_share)
    holders: Counter[str] = Counter()
    apart: Counter[str] = Counter()
    for blocks, tokens, covered in zip(articles, streams, marks):
        if covered.any():
            ends = np.cumsum([len(t) for t in tokens])
            found = {b for b, t, end in zip(blocks, tokens, ends) if covered[end - len(t) : end].all()}
            holders.update(found)
            if 2 * covered.sum() < len(covered):
                apart.update(found)
    needed = max(min_articles, int(np.ceil(min_share * len(articles))))
    return sorted(b for b, n in holders.items() if n >= needed and 2 * apart[b] > n)


def without_furniture(article: Column, furniture: Column, min_run: int) -> Column:
    """`article` without the blocks in `furniture`, those of less than a run only beside others; whole if nothing were left."""

    def found(block: Column) -> Column:
        return F.coalesce(F.array_contains(furniture, block), F.lit(False))

    def stays(block: Column, i: Column) -> Column:
        beside = found(F.get(article, i - 1)) | found(F.get(article, i + 1))
        return ~(found(block) & ((F.size(F.split(block, " ")) >= min_run) | beside))

    left = F.filter(article, stays)
    return F.when(furniture.isNull() | (F.size(left) == 0), article).otherwise(left)


_FIELDS = {
    "page_id": ("bigint", pa.int64()), "url": ("string", pa.string()), "host": ("string", pa.string()),
    "has_article": ("boolean", pa.bool_()), "article": ("array<string>", pa.list_(pa.string())),
    "article_digest": ("binary", pa.binary()), "n_bytes": ("bigint", pa.int64()),
    "blocks": ("array<string>", pa.list_(pa.string())), "opened": ("array<boolean>", pa.list_(pa.bool_())),
}


def parse(pages: DataFrame, columns: list[str], once: bool = False) -> DataFrame:
    """`columns` of the blocks of `pages`: article, its digest and bytes, other blocks and which of them are in the open.

    With `once` pages with an article only, and of equal articles of a host no more than a task forgets.
    """

    def read():
        seen: set[tuple[str, bytes]] = set()

        def work(ids, urls, hosts, htmls):
            rows = []
            for page_id, url, host, html in zip(ids, urls, hosts, htmls):
                blocks = blocks_of(html)
                article = [t for r, t in blocks if r == ARTICLE]
                whole = "\n".join(article).encode()
                digest = blake2b(whole, digest_size=16).digest()
                if once:
                    if not article or (host, digest) in seen:
                        continue
                    if len(seen) >= KNOWN:
                        seen.clear()
                    seen.add((host, digest))
                other = [(t, r == OPEN) for r, t in blocks if r != ARTICLE]
                row = {
                    "page_id": page_id, "url": url, "host": host, "has_article": bool(article), "article": article,
                    "article_digest": digest, "n_bytes": len(whole), "blocks": [t for t, _ in other],
                    "opened": [o for _, o in other],
                }
                rows.append([row[c] for c in columns])
            return list(zip(*rows)) if rows else [[]] * len(columns)

        return work

    host, _ = split_url(F.col("url"))
    return map_batches(
        pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", host.alias("host"), "html"),
        ", ".join(f"{c} {_FIELDS[c][0]}" for c in columns), [(c, _FIELDS[c][1]) for c in columns], read,
    )


def extract_text(
    pages: DataFrame, min_run: int = MIN_RUN, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
    shard: int = SHARD, min_articles: int = MIN_ARTICLES, article_share: float = ARTICLE_SHARE,
) -> DataFrame:
    """(page_id, url, host, text, has_article): one row per row of `pages`.

    text: the blocks joined by line feeds; empty for a null or empty html. Pages with a null URL share the
    empty host.
    """
    tables = Checkpoints(pages.sparkSession)
    read = tables.write(
        parse(pages, ["page_id", "url", "host", "has_article", "article_digest", "n_bytes", "blocks", "opened"])
        .withColumn("digest", F.sha2(F.to_json(F.struct("blocks", "opened")), 256))
    )

    def judge(table: pa.Table) -> pa.Table:
        found = article_furniture(table["article"].to_pylist(), min_run, min_articles, article_share)
        row = [[table[c][0].as_py()] for c in ("host", "shard")] + [[found]] if found else [[]] * 3
        return pa.table([pa.array(c, f.type) for c, f in zip(row, verdict)], schema=verdict)

    verdict = pa.schema([("host", pa.string()), ("shard", pa.int64()), ("furniture", pa.list_(pa.string()))])
    n_bytes = read.agg(F.sum("n_bytes")).first()[0] or 0
    large = F.broadcast(tables.write(deal_articles(read)))

    def dealt_articles(parsed: DataFrame) -> DataFrame:
        return parsed.join(large, "host", "left").withColumn(
            "shard", F.pmod(F.xxhash64("article_digest"), F.coalesce("shards", F.lit(1)))
        )

    articles = (
        dealt_articles(parse(pages, ["host", "article_digest", "article"], once=True))
        .repartition(1 + n_bytes // TASK_BYTES, "host", "shard")  # what follows needs no other shuffle
        .groupBy("host", "shard", "article_digest").agg(F.first("article").alias("article"))
    )
    # A row a shard at most, so that it is broadcast if not very large: its size is known when it is written.
    furniture = tables.write(
        articles.groupBy("host", "shard").applyInArrow(judge, "host string, shard bigint, furniture array<string>")
    )
    own = parse(pages, ["page_id", "url", "host", "has_article", "article", "article_digest"]).where("has_article")
    left = without_furniture(F.col("article"), F.col("furniture"), min_run)
    settled = spread_join(dealt_articles(own), furniture, ["host", "shard"], "left").select(
        "page_id", "url", "host", F.array_join(left, "\n").alias("text"), "has_article"
    )

    streams = tables.write(
        read.groupBy("host", "digest").agg(
            F.first("blocks").alias("blocks"), F.first("opened").alias("opened"),
            F.min("has_article").alias("has_article"),
        )
    )
    dealt = deal(streams, shard)

    def clean(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        tokens = [[(b.split(), o) for b, o in zip(r["blocks"], r["opened"])] for r in rows]
        marks = repeated([[t for b, _ in page for t in b] for page in tokens], min_run, min_pages, min_share)
        picked = [
            (r["host"], r["digest"], _unique_text(t, m, min_run))
            for r, t, m in zip(rows, tokens, marks)
            if not r["has_article"]
        ]
        columns = list(zip(*picked)) if picked else [[]] * len(out)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    out = pa.schema([("host", pa.string()), ("digest", pa.string()), ("text", pa.string())])
    cleaned = dealt.select("host", "shard", "digest", "blocks", "opened", "has_article").groupBy(
        "host", "shard"
    ).applyInArrow(clean, "host string, digest string, text string")
    unmarked = read.where(~F.col("has_article")).select("page_id", "url", "host", "digest")
    texts = spread_join(unmarked, cleaned, ["host", "digest"])
    return settled.unionByName(texts.select("page_id", "url", "host", "text", F.lit(False).alias("has_article")))
