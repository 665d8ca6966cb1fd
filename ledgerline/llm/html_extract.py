"""Main text of web pages, with a suffix array over the pages of a host.

A page is read into blocks in page order, each with what its markup says: *main* (inside
an article or main element), *out* (inside menus, headers, footers, sidebars, adverts,
forms, notices, reader comments), *doubt* (main, but in a box with a listed word as a piece
of a class or id, as ``article-header``) or *open* (markup doesn't tell).  The pages of a host are
concatenated into one token stream with a separator after each page.  Sorting its suffixes
by their first ``RUN`` tokens (prefix doubling) brings equal ones together: substrings of
``RUN`` tokens or more that occur on ``MIN_PAGES`` distinct pages and on ``MIN_SHARE`` of
them are boilerplate.  From open and doubtful blocks such runs are cut; what is unique
stays.  Out blocks are always removed, also on a host with one page.

Main blocks are judged by the same suffixes, more strictly, since articles quote and copy each other: a block
that runs inside the articles cover wholly goes if these runs stand in ``MAIN_SHARE`` of the host's
different articles, ``MAIN_PAGES`` at least (equal articles count once).  An article that such blocks make
up by more than half is a copy of others and stays whole.

A page with main blocks gives those and its doubtful ones; any other page gives its open blocks.

Pages are read where they lie; their blocks, without markup, are shuffled once.  A host of more than
``GROUP_BYTES`` is dealt to several groups by a hash of the page, every other host is one group: a suffix
array's memory is bounded and a host with a third of all pages spreads over many tasks.  Repeats count over the
whole host all the same, so that the texts are those of one array over all its pages.  The groups of a large host
are read four times from the one shuffle:

1. which articles they hold; of equal ones in several groups the lowest group counts it, pages meet by their hash;
2. the suffix array of each group lists the runs on half of the least share of its pages or articles.  A run that
   no group lists stands on fewer than the least share of the host's, so that none is missed; what listed counts and
   the most that silent groups can add don't bring to the least is dropped;
3. every group counts those that are left, and the counts are added;
4. what has the least number on the host is cut.

The table of large hosts is broadcast up to ``BROADCAST_HOSTS`` rows and joined beyond.

Defined cases: a null or empty html gives an empty text; a null URL makes its own host;
rows that repeat a page are each extracted, and count as one page for what repeats; markup
that is cut off or not closed ends with the page.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from hashlib import blake2b
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpointed
from ledgerline.llm.url_filter import host_of

RUN_DOUBLINGS = 3
RUN = 1 << RUN_DOUBLINGS
MIN_PAGES, MIN_SHARE = 2, 0.1
MAIN_PAGES, MAIN_SHARE = 5, 0.8
GROUP_BYTES = 16 << 20
BROADCAST_HOSTS = 50_000

# Element names of HTML, and class words of boilerplate.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
search section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUT = frozenset("""nav header footer aside form script style noscript template head title button select textarea
svg iframe object canvas audio video dialog menu""".split())
OUT_CLASSES = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter
notice notices notification pagination pager popup promo promoted promotion related replies reply share sharing
sidebar skip social sponsor sponsored subscribe subscription toolbar widget""".split())
OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Elements that end when one of these opens.
CLOSES = {"p": BLOCKS - {"html", "body"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"},
          "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
SCOPES = frozenset("article aside body div footer form header html main nav section table td th ul ol".split())
CUT_TAG = re.compile(r"<[a-zA-Z/!][^<>]*\Z")
CLASS_WORDS = re.compile(r"[^a-z0-9]+")

MAIN_BLOCK, OPEN_BLOCK, OUT_BLOCK, DOUBT_BLOCK = 0, 1, 2, 3

# Numbers of a run: in a group, and on the host.
LISTED = ("pages", "articles", "page_slack", "article_slack")
LEAST = ("least_pages", "least_articles")
COUNTED = ("pages", "articles", *LEAST)


class _Reader(HTMLParser):
    """Collects (kind, text) of the blocks of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool, bool]] = []  # name, inside main, inside out, in doubt
        self.blocks: list[tuple[int, str]] = []
        self.held: list[str] = []

    def _state(self) -> tuple[bool, bool, bool]:
        return self.stack[-1][1:] if self.stack else (False, False, False)

    def flush(self) -> None:
        text = " ".join("".join(self.held).split())
        self.held.clear()
        if text:
            main, out, doubt = self._state()
            kind = OUT_BLOCK if out else OPEN_BLOCK if not main else DOUBT_BLOCK if doubt else MAIN_BLOCK
            self.blocks.append((kind, text))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            if tag in BLOCKS:
                self.flush()
            elif tag == "br":
                self.held.append(" ")
            return
        # A tag that is left open ends where its like or a block begins.
        while self.stack and tag in CLOSES.get(self.stack[-1][0], ()):
            self._pop()
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if tag in CLOSES.get(name, ()):
                while len(self.stack) > i:
                    self._pop()
                break
            if name in SCOPES:
                break
        if tag in BLOCKS or tag in OUT:
            self.flush()
        a = {k: (v or "").lower() for k, v in attrs}
        said = a.get("class", "") + " " + a.get("id", "")
        outside = tag in OUT or "hidden" in a or a.get("role") in OUT_ROLES
        pieces = False
        if tag not in ("html", "body", "main"):
            outside |= not OUT_CLASSES.isdisjoint(said.split())
            pieces = not OUT_CLASSES.isdisjoint(CLASS_WORDS.split(said))
        main, out, doubt = self._state()
        begins = (tag in ("article", "main") or a.get("role") in ("main", "article")
                  or a.get("itemprop") == "articlebody") and not outside
        if begins and not any(x[0] not in ("div", "section", "span", "p") and x[2] for x in self.stack):
            out = False  # an unclosed box before the article doesn't hold it
        if main and tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.stack[-1][0] in ("header", "hgroup"):
            out = False  # the article's own heading
        self.stack.append((tag, main or begins, out or outside, pieces or (doubt and not begins)))

    def _pop(self) -> None:
        if self.stack[-1][0] in BLOCKS or self.stack[-1][0] in OUT:
            self.flush()
        self.stack.pop()

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in ("article", "main") and tag not in ("body", "html"):
                return  # a stray end tag doesn't close the article

    def handle_data(self, data: str) -> None:
        self.held.append(data)


def read_blocks(html: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the blocks of a page, white space within one made a single space."""
    reader = _Reader()
    reader.feed(CUT_TAG.sub("", html or ""))
    reader.close()
    while reader.stack:
        reader._pop()
    reader.flush()
    return reader.blocks


def ranked_suffixes(stream: np.ndarray) -> np.ndarray:
    """The rank of each suffix by its first RUN tokens, equal ones alike, by prefix doubling.

    ``stream`` holds token numbers, with a number of its own after each page.
    """
    n = len(stream)
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    for k in range(RUN_DOUBLINGS):
        step = 1 << k
        both = rank * (n + 1)  # one key of the two halves
        both[:max(0, n - step)] += rank[step:] + 1
        order = np.argsort(both)
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(both[order]) != 0)])
    return rank


def pages_of_runs(rank: np.ndarray, page: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``places`` as a suffix array, for each the number of its run there, and for each run its distinct pages."""
    if not len(places):
        return places, np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = rank[places] * (int(page.max()) + 2) + page[places]
    order = np.argsort(both)
    suffixes = places[order]  # the suffix array, equal beginnings by page
    same = np.diff(rank[suffixes]) == 0
    other = np.diff(both[order]) != 0
    group = np.concatenate([[0], np.cumsum(~same)])
    return suffixes, group, np.bincount(group, np.concatenate([[1], other])).astype(np.int64)


def covered_by_runs(rank: np.ndarray, page: np.ndarray, least: float, starts: np.ndarray | None = None) -> np.ndarray:
    """Which tokens stand in substrings of RUN tokens that ``least`` distinct pages share.

    ``page`` is the number of each token's page; ``starts``: where such a substring may begin (default: anywhere).
    """
    suffixes, group, distinct = pages_of_runs(rank, page, np.arange(len(rank)) if starts is None else starts)
    return _covered(suffixes[distinct[group] >= least], len(rank))


def _covered(found: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` tokens stand in runs that begin at ``found``."""
    edge = np.bincount(found, minlength=n + RUN) - np.bincount(found + RUN, minlength=n + RUN)[:n + RUN]
    return np.cumsum(edge)[:n] > 0


def _whole(marks: np.ndarray) -> np.ndarray:
    """Where a run lies in marked tokens only."""
    held = _sums(marks)
    return np.nonzero(held[RUN:] - held[:-RUN] == RUN)[0]


def find_runs(stream: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which row of ``runs``, distinct rows of RUN token numbers, begins at each token; -1: none.

    Prefix doubling again, on the parts of these runs only; what isn't one of their tokens is -1 or less.
    """
    n = len(stream)
    if not len(runs):
        return np.full(n, -1, np.int64)
    known, part = np.unique(runs, return_inverse=True)
    part = part.reshape(runs.shape)
    numbers = np.full(max(int(stream.max(initial=0)), int(known[-1])) + 1, -1, np.int64)
    numbers[known] = np.arange(len(known))
    at = np.where(stream >= 0, numbers[np.maximum(stream, 0)], -1)
    for k in range(RUN_DOUBLINGS):
        step, size = 1 << k, len(known)
        known, part = np.unique(part[:, 0::2] * size + part[:, 1::2], return_inverse=True)
        part = part.reshape(len(runs), -1)
        live = np.nonzero((at[:max(0, n - step)] >= 0) & (at[step:] >= 0))[0]
        both = at[live] * size + at[live + step]
        place = np.minimum(np.searchsorted(known, both), len(known) - 1)
        at = np.full(n, -1, np.int64)
        at[live] = np.where(known[place] == both, place, -1)
    row = np.empty(len(known), np.int64)
    row[part[:, 0]] = np.arange(len(runs))
    return np.where(at >= 0, row[at], -1)


def covered_tokens(stream: np.ndarray, page: np.ndarray, pages: int) -> np.ndarray:
    """Which tokens stand in substrings of RUN tokens that enough of the ``pages`` pages share."""
    return covered_by_runs(ranked_suffixes(stream), page, max(MIN_PAGES, MIN_SHARE * pages))


def extract_host(pages: list[tuple[str, str | None]]) -> list[tuple[str, int]]:
    """Main text, and removed tokens that repeat on the host, of (name, html) pages; equal names are one page."""
    return cut_repeats([(name, read_blocks(html)) for name, html in pages])


class Tokens(NamedTuple):
    """The token stream of pages."""

    stream: np.ndarray  # token numbers, with a number of its own below 0 after each page
    row: np.ndarray  # the page of each token, as it was given
    inside: np.ndarray  # whether it is in a main block
    begins: np.ndarray  # of each block
    ends: np.ndarray
    words: pa.Array  # by token number


def number_tokens(kinds: np.ndarray, texts: pa.Array, blocks: np.ndarray) -> Tokens:
    """``kinds`` and ``texts`` of the blocks of all pages, ``blocks`` of each page."""
    split = pc.split_pattern(texts, " ")
    size = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    block_row = np.repeat(np.arange(len(blocks)), blocks)
    ends = np.cumsum(size) + block_row
    place = np.arange(len(coded)) + np.repeat(block_row, size)
    row = np.repeat(np.arange(len(blocks)), np.bincount(block_row, size, len(blocks)).astype(np.int64) + 1)
    stream = -1 - row
    stream[place] = coded.indices.to_numpy(zero_copy_only=False)
    inside = np.zeros(len(row), bool)
    inside[place] = np.repeat(kinds == MAIN_BLOCK, size)
    return Tokens(stream, row, inside, ends - size, ends, coded.dictionary)


def cut_repeats(pages: list[tuple[str, list[tuple[int, str]]]]) -> list[tuple[str, int]]:
    """The same for pages that are read: (name, blocks)."""
    read = [blocks for _, blocks in pages]
    names: dict[str, int] = {}
    articles: dict[tuple, int] = {}
    page = np.array([names.setdefault(name, len(names)) for name, _ in pages], np.int64)
    mains = [tuple(text for kind, text in blocks if kind == MAIN_BLOCK) for blocks in read]
    article = np.array([articles.setdefault(main, len(articles)) if main else -1 for main in mains], np.int64)
    tokens = number_tokens(np.array([kind for blocks in read for kind, _ in blocks], np.int64),
                           pa.array([text for blocks in read for _, text in blocks], pa.string()),
                           np.array([len(blocks) for blocks in read], np.int64))
    rank = ranked_suffixes(tokens.stream)
    repeated = covered_by_runs(rank, page[tokens.row], max(MIN_PAGES, MIN_SHARE * len(names)))
    common = np.zeros(len(rank), bool)
    if len(articles) >= MAIN_PAGES:
        common = covered_by_runs(rank, article[tokens.row], max(MAIN_PAGES, MAIN_SHARE * len(articles)), _whole(tokens.inside))
    return kept_texts(read, tokens, repeated, common)


def kept_texts(read: list[list[tuple[int, str]]], tokens: Tokens, repeated: np.ndarray, common: np.ndarray) -> list[tuple[str, int]]:
    """Main text and removed tokens that repeat, of pages whose ``repeated`` tokens and those of ``common`` runs are marked."""
    marks, repeated, common = repeated, _sums(repeated), _sums(common)
    spans = list(zip(tokens.begins.tolist(), tokens.ends.tolist()))
    out, at = [], 0
    for blocks in read:
        has_main = any(kind in (MAIN_BLOCK, DOUBT_BLOCK) for kind, _ in blocks)
        own = [(spans[at + i], kind) for i, (kind, _) in enumerate(blocks)]
        main_tokens = sum(b - a for (a, b), kind in own if kind == MAIN_BLOCK)
        template = [kind == MAIN_BLOCK and common[b] - common[a] == b - a for (a, b), kind in own]
        copied = 2 * sum(b - a for ((a, b), _), t in zip(own, template) if t) > main_tokens
        kept, boilerplate = [], 0
        for (kind, text), t in zip(blocks, template):
            a, b = spans[at]
            at += 1
            again = int(repeated[b] - repeated[a])
            if kind == DOUBT_BLOCK or (kind == OPEN_BLOCK and not has_main):
                boilerplate += again
                if again:
                    text = " ".join(w for w, x in zip(text.split(" "), marks[a:b]) if not x)
                if text:
                    kept.append(text)
            elif kind == MAIN_BLOCK and (copied or not t):
                kept.append(text)
            else:
                boilerplate += again
        out.append(("\n".join(kept), boilerplate))
    return out


def _sums(marks: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(marks)])


def _read(batches):
    for b in batches:
        read = [read_blocks(h) for h in b.column("html").to_pylist()]
        mains = ["\n".join(t for k, t in x if k == MAIN_BLOCK) for x in read]  # no block has a line end
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("key", "url", "host", "group", "place")),
             pa.array([blake2b(m.encode(), digest_size=16).digest() if m else None for m in mains], pa.binary()),
             pa.array([[k for k, _ in x] for x in read], pa.list_(pa.int32())),
             pa.array([[t for _, t in x] for x in read], pa.list_(pa.string()))],
            names=["key", "url", "host", "group", "place", "article", "kinds", "texts"])


def _cut(batches):
    """Blocks of the pages in order of their groups -> main texts."""
    group, held, rows, kind = None, [], [], None

    def done():
        texts = cut_repeats(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string()),
             pa.array([t for t, _ in texts], pa.string()), pa.array([len(t) for t, _ in texts], pa.int64()),
             pa.array([n for _, n in texts], pa.int64())],
            names=["key", "url", "text", "n_chars", "n_repeated"])

    for b in batches:
        kind = b.schema.field("key").type
        columns = ("key", "url", "host", "group", "place", "kinds", "texts")
        for key, url, host, part, place, kinds, texts in zip(*(b.column(c).to_pylist() for c in columns)):
            if held and (host, part) != group:
                yield done()
                held, rows = [], []
            group = host, part
            held.append((place, list(zip(kinds, texts))))
            rows.append((key, url))
    if held:
        yield done()


def _articles(batches):
    for b in batches:
        yield b.select(["host", "group", "article"]).filter(b.column("article").is_valid())


def _tokens(pages: pa.Table) -> Tokens:
    kinds, texts = (pages.column(c).combine_chunks() for c in ("kinds", "texts"))
    return number_tokens(kinds.flatten().to_numpy(zero_copy_only=False), texts.flatten(),
                         pc.list_value_length(texts).to_numpy(zero_copy_only=False))


def _numbered(pages: pa.Table, articles: pa.ChunkedArray) -> tuple[np.ndarray, int, np.ndarray]:
    """Numbers of the pages, how many there are, and numbers of the articles that this group counts (others: -1)."""
    names, page = np.unique(pages.column("place").to_numpy(), return_inverse=True)
    article = pc.index_in(pages.column("article"), articles.drop_null(), skip_nulls=True)
    return page, len(names), pc.fill_null(article, -1).to_numpy().astype(np.int64)


def _runs_of(grams: pa.ChunkedArray, tokens: Tokens) -> np.ndarray:
    """For each token which of ``grams``, runs as texts, begins there; -1: none."""
    words = pc.split_pattern(grams.combine_chunks().cast(tokens.words.type), " ").flatten()
    runs = pc.fill_null(pc.index_in(words, tokens.words), -1).to_numpy(zero_copy_only=False).reshape(-1, RUN).astype(np.int64)
    here = np.nonzero((runs >= 0).all(axis=1))[0]
    at = find_runs(tokens.stream, runs[here])
    return np.where(at >= 0, here[at], -1) if len(here) else at


def _to_list(share: float, n: int) -> int:
    """On how many of a group's ``n`` pages or articles a run must stand to be listed."""
    return max(1, math.ceil(share * n / 2))


def _list_runs(pages: pa.Table, owned: pa.Table) -> pa.Table:
    """The runs on enough pages or articles of a group with their counts, and a row without a run: how many it has.

    The slack is how many a run may stand on that isn't listed.
    """
    if not pages.num_rows:
        return _run_table("", pa.nulls(0, pa.string()), [[] for _ in LISTED], LISTED)
    tokens = _tokens(pages)
    page, n_pages, article = _numbered(pages, owned.column("article"))
    n_articles = len(np.unique(article[article >= 0]))
    least_pages, least_articles = _to_list(MIN_SHARE, n_pages), _to_list(MAIN_SHARE, n_articles)
    rank = ranked_suffixes(tokens.stream)
    suffixes, run, on_pages = pages_of_runs(rank, page[tokens.row], _whole(tokens.stream >= 0))
    first = suffixes[np.concatenate([[0], np.nonzero(np.diff(run))[0] + 1])] if len(suffixes) else suffixes
    of_article = article[tokens.row]
    whole = _whole(tokens.inside)
    suffixes, run, distinct = pages_of_runs(rank, of_article, whole[of_article[whole] >= 0])
    by_rank = np.zeros(len(rank), np.int64)
    by_rank[rank[suffixes]] = distinct[run]
    in_articles = by_rank[rank[first]]
    listed = (on_pages >= least_pages) | (in_articles >= least_articles)
    places = first[listed]
    words = tokens.words.take(pa.array(tokens.stream[places[:, None] + np.arange(RUN)].ravel()))
    grams = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.arange(len(places) + 1) * RUN, pa.int32()), words), " ").cast(pa.string())
    slack = [np.full(len(grams) + 1, least - 1) for least in (least_pages, least_articles)]
    return _run_table(pages.column("host")[0].as_py(), pa.concat_arrays([grams, pa.nulls(1, pa.string())]),
                      [np.append(on_pages[listed], n_pages), np.append(in_articles[listed], n_articles), *slack], LISTED)


def _run_table(host: str, grams: pa.Array | pa.ChunkedArray, numbers: list, names: tuple) -> pa.Table:
    return pa.Table.from_arrays([pa.repeat(host, len(grams)), grams, *(pa.array(x, pa.int64()) for x in numbers)], names=["host", "gram", *names])


def _count_runs(pages: pa.Table, asked: pa.Table) -> pa.Table:
    """On how many pages and articles of a group the runs stand that are asked for; ``asked`` also has its articles."""
    runs = asked.filter(asked.column("gram").is_valid())
    grams = runs.column("gram")
    if not pages.num_rows or not len(grams):
        return _run_table("", pa.nulls(0, pa.string()), [[] for _ in COUNTED], COUNTED)
    tokens = _tokens(pages)
    page, n_pages, article = _numbered(pages, asked.column("article"))
    at = _runs_of(grams, tokens)
    places = np.nonzero(at >= 0)[0]
    on_pages = np.bincount(np.unique(at[places] * n_pages + page[tokens.row[places]]) // n_pages, minlength=len(grams))
    places = np.intersect1d(places, _whole(tokens.inside), assume_unique=True)
    of_article = article[tokens.row[places]]
    places, of_article, n = places[of_article >= 0], of_article[of_article >= 0], len(article) + asked.num_rows
    in_articles = np.bincount(np.unique(at[places] * n + of_article) // n, minlength=len(grams))
    seen = np.nonzero(on_pages)[0]
    runs = runs.take(pa.array(seen))
    return _run_table(pages.column("host")[0].as_py(), runs.column("gram"),
                      [on_pages[seen], in_articles[seen], *(runs.column(c).to_numpy() for c in LEAST)], COUNTED)


def _cut_runs(pages: pa.Table, runs: pa.Table) -> pa.Table:
    """Main texts of a group's pages by the runs that repeat on its host."""
    texts = []
    if pages.num_rows:
        tokens = _tokens(pages)
        at = _runs_of(runs.column("gram"), tokens)
        repeats, common = (np.append(runs.column(c).to_numpy(), False).astype(bool)[at] for c in ("repeated", "common"))
        inside = np.zeros(len(at), bool)
        inside[_whole(tokens.inside)] = True
        read = [list(zip(k, t)) for k, t in zip(pages.column("kinds").to_pylist(), pages.column("texts").to_pylist())]
        texts = kept_texts(read, tokens, *(_covered(np.nonzero(x)[0], len(at)) for x in (repeats, common & inside)))
    return pa.table({
        "key": pages.column("key"), "url": pages.column("url"), "text": pa.array([t for t, _ in texts], pa.string()),
        "n_chars": pa.array([len(t) for t, _ in texts], pa.int64()), "n_repeated": pa.array([n for _, n in texts], pa.int64())})


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text, n_chars, n_repeated (removed tokens that repeat on the host) per input row."""
    u = F.col(f"`{url}`")
    slim = pages.select(F.col(f"`{key}`").alias("key"), u.alias("url"), F.col(f"`{html}`").alias("html"))
    slim = slim.withColumn("host", F.coalesce(host_of(F.col("url")), F.lit(""))) \
        .withColumn("place", F.xxhash64("key", "url"))
    kind = slim.schema["key"].dataType.simpleString()
    large = checkpointed(slim.groupBy(F.col("host").alias("of")).agg(
        F.ceil(F.sum(F.octet_length("html")) / GROUP_BYTES).alias("groups")).where(F.col("groups") > 1))
    hosts = large.count()
    if hosts <= BROADCAST_HOSTS:
        large = F.broadcast(large)
    of = F.col("host") == F.col("of")
    read = f"key {kind}, url string, host string, group long, place long, article binary, kinds array<int>, texts array<string>"
    columns = ("key", "url", "host", "group", "place", "html")
    out = f"key {kind}, url string, text string, n_chars long, n_repeated long"
    small = slim.join(large, of, "left_anti").withColumn("group", F.lit(0).cast("long")).select(*columns).mapInArrow(_read, read)
    cut = small.drop("article").repartition("host", "group").sortWithinPartitions("host", "group", "place").mapInArrow(_cut, out)
    if hosts:
        dealt = slim.join(large, of).withColumn("group", F.expr("pmod(place, groups)")).select(*columns).mapInArrow(_read, read)
        cut = cut.unionByName(_cut_large(dealt.repartition("host", "group"), large, out))
    return cut.withColumnRenamed("key", key)


def _cut_large(blocks: DataFrame, large: DataFrame, out: str) -> DataFrame:
    """Main texts of hosts of several groups; ``blocks`` lie by group, and every step reads this one shuffle."""

    def step(function, asked: DataFrame, schema: str) -> DataFrame:
        return blocks.groupBy("host", "group").cogroup(asked.groupBy("host", "group")).applyInArrow(function, schema)

    def to_groups(runs: DataFrame) -> DataFrame:
        return runs.join(large, F.col("host") == F.col("of")) \
            .withColumn("group", F.explode(F.expr("sequence(0L, groups - 1)"))).drop("of", "groups")

    def schema(names: tuple) -> str:
        return ", ".join(["host string", "gram string", *(f"{n} long" for n in names)])

    owned = blocks.mapInArrow(_articles, "host string, group long, article binary") \
        .groupBy("host", "article").agg(F.min("group").alias("group")).select("host", "group", "article")
    listed = step(_list_runs, owned, schema(LISTED)).groupBy("host", "gram").agg(*(F.sum(c).alias(c) for c in LISTED))
    whole = Window.partitionBy("host")
    for c in LISTED:  # what a host has in all
        listed = listed.withColumn(f"all_{c}", F.sum(F.when(F.col("gram").isNull(), F.col(c))).over(whole))
    asked = listed.select(
        "host", "gram", F.greatest(F.lit(MIN_PAGES), F.ceil(MIN_SHARE * F.col("all_pages"))).alias("least_pages"),
        F.greatest(F.lit(MAIN_PAGES), F.ceil(MAIN_SHARE * F.col("all_articles"))).alias("least_articles"),
        F.expr("pages + all_page_slack - page_slack").alias("most_pages"),
        F.expr("articles + all_article_slack - article_slack").alias("most_articles")) \
        .where("gram is not null and (most_pages >= least_pages or most_articles >= least_articles)") \
        .select("host", "gram", *LEAST)
    counted = step(_count_runs, to_groups(asked).unionByName(owned, allowMissingColumns=True), schema(COUNTED)) \
        .groupBy("host", "gram", *LEAST).agg(F.sum("pages").alias("pages"), F.sum("articles").alias("articles")) \
        .select("host", "gram", F.expr("pages >= least_pages").alias("repeated"), F.expr("articles >= least_articles").alias("common")) \
        .where("repeated or common")
    return step(_cut_runs, to_groups(counted), out)
