"""Main text of web pages: markup structure and a suffix array per host.

A page is read into blocks of text. Elements say of some blocks what they are: inside ``article``
or ``main`` they are main text; inside menus, headers, footers, sidebars, notices, adverts, forms
and reader comments (by element, role, class or id) they are marked boilerplate. Raw text of scripts,
styles and the like is no text.

All blocks, marked ones too, are the word streams of a host's pages, and of every run of ``RUN`` words
it is found on how many distinct pages of the host it is. Marked blocks go by their mark alone (a menu
or footer that only one page has is still none of its text), but their runs count: of a page
without any article element the runs that no other page has stay, so a footer in a plain ``div`` goes
if other pages have it as a ``footer``; what is left of a mostly covered block goes too. In an article
only a block wholly covered by runs on nearly all pages of the host goes (a template line); a
passage that some articles share stays.

The pages of a host with up to ``RANGE_BYTES`` of html are in one block of the exchange (not to be mixed
up with blocks of text), where the word streams are concatenated and their suffixes sorted (prefix
doubling up to ``RUN`` words): neighbouring suffixes with a common prefix of ``RUN`` words are
occurrences of one run. A larger host is dealt into pieces by a hash of the page, which are blocks of their own, each
with its suffix array; the counts of a run are added up over the pieces (see ``exchange``), where a run goes
by a 64-bit hash of host and words:

1. pieces send their number of pages, whether one has open text outside any article, and nominate the runs on
   ``NOMINATE`` of their pages; per host and range of hashes, a run stays that can still be on ``TEMPLATE_SHARE`` of the
   host's pages if it is on all but ``NOMINATE`` of them in the other pieces. A run that stays was nominated
   by pieces with two thirds of the pages, so a host has no more of them than about four pages' words;
2. pieces get these runs and send their counts, or those of all their runs if a page of the host has open text;
   buckets of the hash space add them up;
3. pieces remove by the totals.

So a page's text depends on its host's pages alone, however the pages are dealt. They are parsed and
shuffled once; the three steps read the same exchange.

Result text: character references decoded, white space (Unicode) inside a block made one space,
trimmed, empty blocks left out, blocks joined by two line breaks in page order. A line break
element is white space.

Edge cases: null or empty html gives an empty text; a page without markup is one block. A null url is
a host of its own. Repeated rows (same page_id and url) are one page for counting distinct pages, and
each gets its result. Unclosed elements end with their parent. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import exchange as X
from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of
from pricestream.sources.tables import read_table

#: Words of a run; share and number of pages of a template line.
RUN = 8
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.8, 5
#: Share of a piece's pages from which a run is nominated; pieces of a host per range of hashes and per copy of its list.
NOMINATE, SHARED_PIECES = 0.4, 64
#: Bytes of html in a piece of a host, and that a page has at least for the dealing.
RANGE_BYTES, PAGE_BYTES = 2 << 20, 64

# Kinds of elements.
MAIN_ELEMENTS = frozenset("article main".split())
BOILERPLATE_ELEMENTS = frozenset("nav footer aside form dialog menu".split())
RAW_ELEMENTS = frozenset("script style noscript template iframe svg math object textarea select option button "
                         "title head canvas audio video".split())
BLOCK_ELEMENTS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre section summary "
    "table tbody td tfoot th thead tr ul".split())
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these ends an open one of the same set.
SELF_ENDING = {e: s for s in ({"p"}, {"li"}, {"dt", "dd"}, {"td", "th"}, {"tr"}) for e in s}
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words of a class or id that mark boilerplate.
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adbox sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs footer sidebar cookie cookies consent gdpr notice banner popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended comment comments discussion disqus "
    "reply replies pagination pager toolbar widget masthead skip".split())

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|$)", re.I)
MARKED, MAIN, OPEN = 2, 1, 0


def _is_boilerplate(name: str, attributes: str, in_main: bool) -> bool:
    if name in BOILERPLATE_ELEMENTS or (name == "header" and not in_main):
        return True
    if not attributes.strip():
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if key in ("class", "id") and name not in ("html", "body"):
            if not BOILERPLATE_WORDS.isdisjoint(re.split(r"[^a-z]+", value)) or (
                    "header" in re.split(r"[^a-z]+", value) and not in_main):
                return True
        elif (key == "role" and value in BOILERPLATE_ROLES) or (key == "aria-hidden" and value == "true") or (
                key == "style" and re.search(r"display\s*:\s*none", value)):
            return True
    return bool(_HIDDEN.search(_ATTRIBUTE.sub(" ", attributes)))


def blocks_of(html: str) -> list[tuple[int, str]]:
    """(kind, text) of the blocks in page order: MARKED as boilerplate by an element, MAIN or OPEN."""
    out, text, stack = [], [], []  # stack: (name, main before, boilerplate before)
    main = boilerplate = False
    at, end = 0, len(html)

    def close_block():
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                out.append((MARKED if boilerplate else MAIN if main else OPEN, joined))

    def add(raw: str):
        if raw:
            text.append(unescape(raw) if "&" in raw else raw)

    while at < end:
        m = _MARKUP.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:  # comment, doctype
            continue
        name = name.lower()
        if m.group(1):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name in BLOCK_ELEMENTS:
                close_block()
            if depth is not None:
                if any(e[0] in BLOCK_ELEMENTS for e in stack[depth:]) or boilerplate != stack[depth][2]:
                    close_block()
                main, boilerplate = stack[depth][1:]
                del stack[depth:]
            continue
        attributes = m.group(3)
        if name in RAW_ELEMENTS and name != "head":
            if not attributes.endswith("/"):
                over = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = over.end() if over else end
            text.append(" ")
            continue
        if name == "head":
            over = re.compile(r"</head\b[^>]*>|<body\b", re.I).search(html, at)
            if over:
                at = over.end() if over.group().startswith("</") else over.start()
            continue
        if name == "br":
            text.append(" ")
        if name in BLOCK_ELEMENTS:
            close_block()
            same = SELF_ENDING.get(name)
            if same or name not in ("p", "li"):
                # a block ends an open paragraph; an item ends an open item of its kind
                for i in range(len(stack) - 1, -1, -1):
                    open_name = stack[i][0]
                    if open_name == "p" or (same and open_name in same):
                        main, boilerplate = stack[i][1:]
                        del stack[i:]
                        break
                    if open_name in BLOCK_ELEMENTS:
                        break
        if name in VOID_ELEMENTS or attributes.endswith("/"):
            continue
        stack.append((name, main, boilerplate))
        if not boilerplate:
            if _is_boilerplate(name, attributes, main):
                close_block()
                boilerplate = True
            elif name in MAIN_ELEMENTS:
                main = True
    close_block()
    return out


def suffix_groups(tokens: np.ndarray, page: np.ndarray, row: np.ndarray, run: int = RUN) -> tuple[np.ndarray, ...]:
    """The places where a run of ``run`` words starts inside one row, the number of the run at each, and on how many distinct
    pages each run occurs. Suffixes are sorted by doubling the compared length."""
    n = len(tokens)
    if n < run:
        return (np.zeros(0, np.int64),) * 3
    # numbers of words below n are ranks as they are
    rank = (tokens if tokens.max() < n else np.unique(tokens, return_inverse=True)[1]).astype(np.int64) + 1
    length = 1
    order = np.argsort(rank, kind="stable") if run == 1 else None
    while length < run:
        step = min(length, run - length)
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:]
        key = rank * (n + 2) + after
        # only the last order is read, by places within one rank
        order = np.argsort(key, kind="stable" if length + step == run else None)
        key = key[order]
        fresh = np.ones(n, np.int64)
        fresh[1:] = key[1:] != key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        length += step
    # neighbours in suffix order with one rank are occurrences of one run
    inside = np.zeros(n, bool)
    inside[:n - run + 1] = row[run - 1:] == row[:n - run + 1]
    at = order[inside[order]]
    group, where = rank[at], page[at]
    if (page[1:] < page[:-1]).any():  # a repeated row apart from the first
        by = np.lexsort((where, group))
        group, where, at = group[by], where[by], at[by]
    first = np.ones(len(at), bool)
    first[1:] = group[1:] != group[:-1]
    new_page = first.copy()
    new_page[1:] |= where[1:] != where[:-1]
    number = np.cumsum(first) - 1
    return at, number, np.bincount(number, new_page).astype(np.int64) if len(at) else np.zeros(0, np.int64)


def suffix_runs(tokens: np.ndarray, page: np.ndarray, run: int = RUN, row: np.ndarray | None = None) -> np.ndarray:
    """For every place, on how many distinct pages the run of ``run`` words starting there occurs
    (0 where a row ends first; each page is a row if not given)."""
    at, number, pages = suffix_groups(tokens, page, page if row is None else row, run)
    out = np.zeros(len(tokens), np.int64)
    out[at] = pages[number]
    return out


def _covered(starts: np.ndarray, run: int) -> np.ndarray:
    edge = np.zeros(len(starts) + run, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + run, -1)
    return np.cumsum(edge)[:len(starts)] > 0


def main_texts(pages: list[list[tuple[int, str]]], numbers: list[int], seen_on: np.ndarray | None = None,
               n_pages: int | None = None) -> list[str]:
    """Main text of each page of one host, given its blocks; ``numbers`` tells distinct pages. For a piece of
    a host, ``seen_on`` has for every word on how many pages of the host its run is, of ``n_pages`` (empty: no run counts)."""
    words = [text.split(" ") for blocks in pages for _, text in blocks]
    size = np.array([len(w) for w in words], np.int64)
    owner = np.repeat(np.arange(len(pages)), [len(b) for b in pages])
    if seen_on is None:
        n_pages = len(set(numbers))
        flat = [w for ws in words for w in ws]
        tokens = np.asarray(pa.array(flat, pa.large_string()).dictionary_encode().indices)
        row = np.repeat(owner, size)
        seen_on = suffix_runs(tokens, np.asarray(numbers)[row], row=row) if flat else np.zeros(0, np.int64)
    if not len(seen_on):
        seen_on = np.zeros(int(size.sum()), np.int64)
    repeated = _covered(seen_on >= 2, RUN)
    template = _covered(seen_on >= max(TEMPLATE_PAGES, TEMPLATE_SHARE * n_pages), RUN)
    ends = np.cumsum(size)
    out, k = [], 0
    for blocks in pages:
        has_main = any(kind == MAIN for kind, _ in blocks)
        kept = []
        for kind, text in blocks:
            a, b = int(ends[k] - size[k]), int(ends[k])
            if kind == MAIN:
                if not template[a:b].all():
                    kept.append(text)
            elif kind == OPEN and not has_main:
                own = repeated[a:b]
                if not own.any():
                    kept.append(text)
                elif 2 * own.sum() < b - a:
                    kept.append(" ".join(w for w, gone in zip(words[k], own.tolist()) if not gone))
            k += 1
        out.append("\n\n".join(kept))
    return out


def host_of(url: str | None) -> str | None:
    if url is None:
        return None
    try:
        return urlsplit(url).hostname or ""
    except ValueError:
        return ""


class Runs(NamedTuple):
    """Runs of a piece: start of each occurrence and its place in ``keys``; number of words; hashes of the distinct runs in
    order, and on how many pages of the piece each is."""
    at: np.ndarray
    place: np.ndarray
    n_words: int
    keys: np.ndarray
    pages: np.ndarray


def _piece_words(pages: list[list[tuple[int, str]]], numbers: list[int], host: str | None) -> tuple:
    """Words of a piece, distinct page and row of each, and the hash of the run that starts at each."""
    w = W.split_words(pa.array([" ".join(text for _, text in blocks) for blocks in pages], pa.large_string()))
    seed = xxhash.xxh3_64_intdigest("" if host is None else "host " + host)
    row = W.doc_of(w.offsets)
    hashes = W.window_hashes(W.word_hashes(w.vocab, seed)[w.codes], RUN) if len(w.codes) >= RUN else np.zeros(0, np.uint64)
    return w, np.asarray(numbers, np.int64)[row], row, hashes


def piece_runs(pages: list[list[tuple[int, str]]], numbers: list[int], host: str | None) -> Runs:
    """All runs of a piece, by its suffix array."""
    w, page, row, hashes = _piece_words(pages, numbers, host)
    at, number, seen = suffix_groups(w.codes, page, row)
    # a run's occurrences are neighbours in ``at``: the first one names it
    key = hashes[at[np.flatnonzero(np.diff(number, prepend=-1))]]
    order = np.argsort(key, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Runs(at, place[number], len(w.codes), key[order], seen[order])


def listed_runs(pages: list[list[tuple[int, str]]], numbers: list[int], host: str | None, listed: np.ndarray) -> Runs:
    """The runs of a piece that are among the sorted hashes ``listed``."""
    if not len(listed):
        none = np.zeros(0, np.int64)
        return Runs(none, none, 0, listed, none)
    w, page, _, hashes = _piece_words(pages, numbers, host)
    at = np.flatnonzero(W.starts_in_one_text(w.offsets, RUN))
    place = np.minimum(np.searchsorted(listed, hashes[at]), len(listed) - 1)
    found = listed[place] == hashes[at]
    at, place = at[found], place[found]
    once = np.unique(np.stack([place, page[at]]), axis=1)[0]  # a run counts once a page
    present, code = np.unique(place, return_inverse=True)
    return Runs(at, code, len(w.codes), listed[present], np.bincount(np.searchsorted(present, once), minlength=len(present)))


def can_be_template(keys: np.ndarray, pages: np.ndarray, piece_pages: np.ndarray, host_pages: int) -> np.ndarray:
    """Distinct ``keys`` that may be on the pages a template line needs. Each nomination has the run's pages in its
    piece and the piece's pages; in a piece that does not nominate it, a run is on under ``NOMINATE`` of the pages."""
    distinct, number = np.unique(keys, return_inverse=True)
    sure, covered = np.bincount(number, pages), np.bincount(number, piece_pages)
    return distinct[sure + NOMINATE * (host_pages - covered) >= max(TEMPLATE_PAGES, TEMPLATE_SHARE * host_pages) - 1e-6]


class Deal(NamedTuple):
    """Blocks of the exchange: whole hosts in the first ``whole``, then the pieces of each larger host."""
    whole: int
    first: dict  # larger host -> its first block
    pieces: dict  # larger host -> number of its blocks
    n: int

    def block(self, host: str | None, page: int) -> int:
        if host in self.first:
            return self.first[host] + ((page % (1 << 64)) * self.pieces[host] >> 64)
        return xxhash.xxh3_64_intdigest("" if host is None else "host " + host) % self.whole


def deal(df: DataFrame) -> Deal:
    """Blocks for a frame with url and html, in proportion to the bytes of html."""
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + F.lit(PAGE_BYTES)

    def hosts(batches):
        for batch in batches:
            host = pa.array([host_of(u) for u in batch.column("url").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([host, batch.column("size")], ["host", "size"])

    sized = df.select("url", size.cast("long").alias("size"))
    total = int(sized.agg(F.sum("size")).first()[0] or 0)
    # a host in pieces gives the same texts, so a small table is dealt to all shuffle partitions
    target = min(RANGE_BYTES, -(-total // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    sums = sized.mapInArrow(hosts, "host string, size long").groupBy("host").agg(F.sum("size").alias("size"))
    # at most total / target rows, and one for all whole hosts
    large = F.when(F.col("size") > target, F.struct("host"))
    rows = sums.groupBy(large.alias("large")).agg(F.sum("size").alias("size")).collect()
    pieces = {r.large.host: -(-r.size // target) for r in rows if r.large is not None}
    whole = max(1, -(-sum(r.size for r in rows if r.large is None) // max(target, 1)))
    first, n = {}, whole
    for host in sorted(pieces, key=lambda h: (h is not None, h or "")):
        first[host], n = n, n + pieces[host]
    return Deal(whole, first, pieces, n)


_TYPES = {"block": pa.int32(), "bucket": pa.int32(), "n": pa.int64(), "payload": pa.binary()}
_MESSAGE = "block int, bucket int, n long, payload binary"


def _messages(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [[], [], [], []]
    return pa.table({k: pa.array(c, t) for (k, t), c in zip(_TYPES.items(), cols)})


_SIZES = {"first": pa.int32(), "n": pa.int64(), "pieces": pa.int64(), "is_open": pa.binary()}
_NOMINATION = "first int, bucket int, n long, k long, payload binary"


def _nominations(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [[]] * 5
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.table({f.split()[0]: pa.array(c, t) for f, c, t in zip(_NOMINATION.split(", "), cols, types)})


def _rows(tab: pa.Table) -> list[tuple]:
    return list(zip(*(tab.column(c).to_pylist() for c in _TYPES)))


def _pages(tab: pa.Table) -> tuple[list, list[int]]:
    """Blocks of text and distinct number of each page."""
    numbers: dict = {}
    return ([[(int(k), t) for k, t in zip(kinds, text.split("\n"))] for kinds, text in zip(
                tab.column("kinds").to_pylist(), tab.column("text").to_pylist())],
            [numbers.setdefault(x, len(numbers)) for x in zip(
                tab.column("page_id").to_pylist(), tab.column("url").to_pylist())])


def _open(kinds: str) -> bool:
    """Whether a page has open text and no article."""
    return str(OPEN) in kinds and str(MAIN) not in kinds


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``df`` without its html, and text (string) and n_chars (long)."""
    prepare(df.sparkSession)
    columns = [c for c in df.columns if c != html_col]
    raw = carry(df, page_id=id_col, url=url_col, html=html_col)
    dealt = deal(raw)
    whole, n = dealt.whole, dealt.n
    shared = df.sparkSession.sparkContext.broadcast(tuple(dealt))  # a row for each piece at most
    names = ["page_id", "url", "rest"]

    def parse(batches):
        to = Deal(*shared.value)
        for batch in batches:
            for part in W.slices(batch, "html", 4 << 20):
                hosts = [host_of(u) for u in part.column("url").to_pylist()]
                blocks = [blocks_of(h or "") for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names],
                     pa.array([to.block(h, p) for h, p in zip(hosts, part.column("page").to_pylist())], pa.int32()),
                     pa.array([to.first.get(h, -1) for h in hosts], pa.int32()), pa.array(hosts, pa.string()),
                     pa.array(["".join(str(k) for k, _ in b) for b in blocks], pa.string()),
                     pa.array(["\n".join(t for _, t in b) for b in blocks], pa.string())],
                    [*names, "block", "first", "host", "kinds", "text"])

    pages = raw.withColumn("page", F.xxhash64("page_id", "url")).mapInArrow(parse, schema_of(
        raw, *names, block="int", first="int", host="string", kinds="string", text="string"))
    by_block = pages.repartition(n, "block").groupBy("block")

    def send_size(tab: pa.Table) -> pa.Table:
        block, host = tab.column("block")[0].as_py(), tab.column("host")[0].as_py()
        if block < whole:
            return pa.table({k: pa.array([], t) for k, t in _SIZES.items()})
        n_pages = len(set(zip(tab.column("page_id").to_pylist(), tab.column("url").to_pylist())))
        is_open = any(map(_open, tab.column("kinds").to_pylist()))
        row = (tab.column("first")[0].as_py(), n_pages, Deal(*shared.value).pieces[host], bytes([is_open]))
        return pa.table({k: pa.array([v], t) for (k, t), v in zip(_SIZES.items(), row)})

    def nominate(tab: pa.Table) -> pa.Table:
        block, home = tab.column("block")[0].as_py(), tab.column("first")[0].as_py()
        host = tab.column("host")[0].as_py()
        if block < whole:
            return _nominations([])
        blocks, numbers = _pages(tab)
        runs, n_pages, out = piece_runs(blocks, numbers, host), len(set(numbers)), []
        use = runs.pages >= NOMINATE * n_pages - 1e-6
        keys, seen = runs.keys[use], runs.pages[use]
        cut = X.bucket_bounds(keys, -(-Deal(*shared.value).pieces[host] // SHARED_PIECES))
        for b in np.flatnonzero(np.diff(cut)):
            part = slice(cut[b], cut[b + 1])
            out.append((home, int(b), n_pages, int(cut[b + 1] - cut[b]),
                        X.join_fields(X.pack_sorted(keys[part]), X.pack(seen[part]))))
        return _nominations(out)

    def choose(tab: pa.Table) -> pa.Table:
        sizes = tab.column("k").to_pylist()
        fields = [X.split_fields(p) for p in tab.column("payload").to_pylist()]
        keys = can_be_template(np.concatenate([X.unpack_sorted(f[0], k) for f, k in zip(fields, sizes)]),
                               np.concatenate([X.unpack(f[1], k) for f, k in zip(fields, sizes)]),
                               np.repeat(tab.column("n").to_numpy(), sizes), tab.column("host_pages")[0].as_py())
        return pa.table({"first": tab.column("first").slice(0, 1), "chosen": pa.array([keys.tobytes()], pa.binary())})

    def together(tab: pa.Table) -> pa.Table:
        keys = np.sort(np.concatenate([np.frombuffer(p, np.uint64) for p in tab.column("chosen").to_pylist()]))
        return pa.table({"first": tab.column("first").slice(0, 1), "chosen": pa.array([keys.tobytes()], pa.binary())})

    def asked(tab: pa.Table, payload: bytes) -> tuple[list, list[int], Runs]:
        """A piece's blocks and page numbers, and the runs that are counted over all pieces of its host: all if a page of
        the host has open text, else the host's list."""
        blocks, numbers = _pages(tab)
        host = tab.column("host")[0].as_py()
        return blocks, numbers, (piece_runs(blocks, numbers, host) if payload[0] else
                                 listed_runs(blocks, numbers, host, np.frombuffer(payload, np.uint64, offset=1)))

    def send_runs(tab: pa.Table, host: pa.Table) -> pa.Table:
        if not tab.num_rows or tab.column("block")[0].as_py() < whole:  # a piece may have no page
            return _messages([])
        memo, = _rows(host)
        if memo[3] == b"\0":  # no open text and an empty list
            return _messages([memo])
        *_, keys, count = asked(tab, memo[3])[2]
        cut, out = X.bucket_bounds(keys, n), [memo]
        for b in np.flatnonzero(np.diff(cut)):
            part = slice(cut[b], cut[b + 1])
            out.append((memo[0], int(b), int(cut[b + 1] - cut[b]),
                        X.join_fields(X.pack_sorted(keys[part]), X.pack_counts(count[part]))))
        return _messages(out)

    def add_runs(tab: pa.Table) -> pa.Table:
        got = _rows(tab)
        if got[0][1] < 0:
            return _messages(got)
        fields = [X.split_fields(p) for *_, p in got]
        size = [k for _, _, k, _ in got]
        _, inverse = np.unique(np.concatenate([X.unpack_sorted(f[0], k) for f, k in zip(fields, size)]), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([X.unpack_counts(f[1], k) for f, k in zip(fields, size)]))[inverse]
        cut = np.cumsum([0, *size])
        return _messages([(block, bucket, k, X.pack_counts(total[a:a + k]))
                          for (block, bucket, k, _), a in zip(got, cut)])

    def piece_texts(tab: pa.Table, answers: list[tuple]) -> list[str]:
        memo, *totals = sorted(answers, key=lambda r: r[1])
        blocks, numbers, runs = asked(tab, memo[3])
        total = np.concatenate([np.zeros(0, np.uint64), *[X.unpack_counts(p, k) for _, _, k, p in totals]])
        if len(total) != len(runs.keys):
            raise RuntimeError(f"answers for {len(total)} runs, asked for {len(runs.keys)}")
        seen_on = np.zeros(runs.n_words, np.int64)
        seen_on[runs.at] = total.astype(np.int64)[runs.place]
        return main_texts(blocks, numbers, seen_on, memo[2])

    def remove(tab: pa.Table, answers: pa.Table) -> pa.Table:
        if tab.column("block")[0].as_py() >= whole:
            text = piece_texts(tab, _rows(answers))
        else:
            hosts = tab.column("host").combine_chunks().dictionary_encode(null_encoding="encode").indices
            order = np.argsort(np.asarray(hosts), kind="stable")
            tab, cut = tab.take(pa.array(order)), np.cumsum(np.bincount(np.asarray(hosts)))
            text = [t for a, b in zip([0, *cut], cut) for t in main_texts(*_pages(tab.slice(a, b - a)))]
        text = pa.array(text, pa.string())
        return pa.table([*[tab.column(c) for c in names], text, pc.utf8_length(text).cast(pa.int64())],
                        names=[*names, "text", "n_chars"])

    sizes = by_block.applyInArrow(send_size, "first int, n long, pieces long, is_open binary")
    hosts = sizes.groupBy("first").agg(F.sum("n").alias("host_pages"), F.max("pieces").alias("pieces"), F.max("is_open").alias("is_open"))
    chosen = by_block.applyInArrow(nominate, _NOMINATION).join(hosts.select("first", "host_pages"), "first")
    chosen = chosen.groupBy("first", "bucket").applyInArrow(choose, "first int, chosen binary")
    chosen = chosen.groupBy("first").applyInArrow(together, "first int, chosen binary")
    # a copy of a host's list for every SHARED_PIECES pieces, which then goes to each: a host with most of the pages is many tasks
    lists = hosts.join(chosen, "first", "left").select(
        "first", "host_pages", "pieces", F.concat("is_open", F.coalesce("chosen", F.lit(b""))).alias("payload"),
        F.explode(F.expr(f"sequence(0L, (pieces - 1) div {SHARED_PIECES})")).alias("part")).repartition("first", "part")
    memos = lists.withColumn("piece", F.explode(F.expr(
        f"sequence(part * {SHARED_PIECES}, least(pieces, (part + 1) * {SHARED_PIECES}) - 1)"))).select(
        F.expr("cast(first + piece as int)").alias("block"), F.expr("cast(-1 - first - piece as int)").alias("bucket"),
        F.col("host_pages").alias("n"), "payload")
    totals = by_block.cogroup(memos.groupBy("block")).applyInArrow(send_runs, _MESSAGE)
    totals = totals.groupBy("bucket").applyInArrow(add_runs, _MESSAGE)
    done = by_block.cogroup(totals.groupBy("block")).applyInArrow(
        remove, schema_of(raw, *names, text="string", n_chars="long"))
    return restore(done, columns, ["text", "n_chars"], page_id=id_col, url=url_col)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    return extract_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
