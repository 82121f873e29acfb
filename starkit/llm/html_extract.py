"""Main text of web pages, by a suffix array of each host.

A page becomes blocks of text with the elements they lie in; scripts, styles,
comments and markup are gone, character references decoded.  Blocks in elements
that hold no main text (menus, headers, footers, side bars, notices, adverts,
forms, comments) go, and where a page marks its article, only blocks inside it
can stay.  Of these, boilerplate goes:

* A block of ``MIN_RUN`` tokens or more on more than half of the host's distinct
  pages, inside an article at the same place (counted from its start or its end) on them.
* A block covered by runs that are on many of the host's articles.  The token
  streams of all its pages are concatenated, and a suffix array over them
  (ranks doubled until suffixes are ordered by ``MIN_RUN`` tokens) shows the
  runs repeated on distinct articles.  Inside a marked article the runs must
  also lie outside the articles of that many: an article may repeat itself
  or another.  A page's title stays.

Pages that share their longest block, of those not on most of the host's pages,
are copies of one article and count once, so what copies share is no boilerplate.

All is counted over the whole host, so the text of a page does not depend on how
many pages lie together.  A host with many pages or much text is dealt over groups by
a hash of the article, so no group exceeds ``GROUP_PAGES`` pages or about
``GROUP_CHARS`` characters on average; an article with more is dealt over groups of
its own.  Each group has a suffix array and sends the runs that are on more than
``1 / SLACK`` of its articles, and the counts of the groups are added up, an article of several groups
once.  What a group did not send is below that share there, so a sum tells most
runs from those of too few articles; where it doesn't, every run of the host is sent.

Defined results: null or empty html gives an empty text; a null url or one
without a host makes pages of the empty host; repeated rows give the same
text; a very long page is read whole and thins out its group, which holds
about so many characters; an empty table gives an empty result; other columns
are untouched.
"""

from __future__ import annotations

import html as html_lib
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cache, lru_cache, reduce
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batches_of, packed, saved, small, tidy
from starkit.llm.url_filters import host_and_path

GROUP_PAGES, GROUP_CHARS = 128, 2_000_000
MIN_RUN = 8             # tokens
MIN_PAGES = 3           # distinct pages or articles that boilerplate must be on,
MIN_SHARE = 0.3         # and share of the host's articles, of a run
SLACK = 8               # 1 / SLACK is below MIN_SHARE, so a run on that share of the host's articles is sent by a group
PAGES = 256             # pages that Python holds at once outside of a group
PIECE_CHARS = 200_000   # characters whose tokens are found at once, unless a page has more
ROUNDS = 3              # shares of the groups that are shuffled one after the other, for less disk
HOSTS = 2_000           # hosts up to which their runs, about 10 kB a host, are broadcast

#: Elements of HTML by their role.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "select", "title", "canvas", "audio", "video"}
DROPPED = RAW | {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "head", "label", "fieldset", "figcaption"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
MARKED = {"article", "main"}
KEPT = {"html", "body"} | MARKED
#: Words in a class or id that mark what is not main text.
NOT_MAIN = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie", "cookies",
            "consent", "disclaimer", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
            "notification", "pagination", "popup", "promo", "promotion", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "social",
            "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget", "reactions", "discussion", "responses"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
TITLE = re.compile(r"<title[^>]*>(.*?)(?:</title|\Z)", re.I | re.S)
WORD = re.compile(r"\w+|[^\w\s]")


#: Parts of a class name that speak about another element.
ABOUT = {"has", "no", "with", "without", "enabled", "disabled"}


@lru_cache(10_000)
def _not_main(attributes: str) -> bool:
    if not attributes:
        return False
    if HIDDEN.search(attributes):
        return True
    for m in NAMES.finditer(attributes):
        for name in next(filter(None, m.groups()), "").lower().split():
            parts = SPLIT.split(name)
            if ABOUT.isdisjoint(parts) and not NOT_MAIN.isdisjoint(parts):
                return True
    return False


#: Where no element is open: its name, whether it is dropped, whether it is in an article.
NO_ELEMENT = ("", False, False)


def blocks(page) -> list[tuple[str, bool, bool]]:
    """(text, dropped, in a marked article) of the blocks of a page."""
    if not isinstance(page, str):
        return []
    out, text = [], []
    open_: list[tuple[str, bool, bool]] = []  # element, whether it is dropped, whether it is in an article
    raw, at = "", 0

    def flush() -> None:
        if not text:  # between two tags
            return
        joined = " ".join(html_lib.unescape("".join(text)).split())
        text.clear()
        if joined:
            _, dropped, inside = open_[-1] if open_ else NO_ELEMENT
            out.append((joined, dropped, inside))

    for m in TOKEN.finditer(page):
        closing, name, attributes = m.groups()
        if raw:  # only its own end tag ends a raw element
            if closing and name.lower() == raw:
                raw, at = "", m.end()
            continue
        start, end = m.span()
        if start > at:
            text.append(page[at: start])
        at = end
        if not name:
            continue
        name = name.lower()
        if closing:
            depth = len(open_) - 1
            while depth >= 0 and open_[depth][0] != name:
                depth -= 1
            if depth >= 0:
                if text and (name not in INLINE or open_[depth][1]):
                    flush()
                del open_[depth:]
        elif name in VOID:
            if text and name not in INLINE:
                flush()
        elif name in RAW:
            flush()
            if page[end - 2: end] != "/>":
                raw = name
        else:
            _, dropped, inside = open_[-1] if open_ else NO_ELEMENT
            titles = name == "header" and inside  # of an article: its title
            drop = dropped or not titles and name not in KEPT and (name in DROPPED or _not_main(attributes))
            if text and (name not in INLINE or drop and not dropped):
                flush()
            if name == "p":  # a paragraph ends where the next begins
                for i in range(len(open_) - 1, -1, -1):
                    if open_[i][0] not in INLINE:
                        if open_[i][0] == "p":
                            del open_[i:]
                        break
                _, dropped, inside = open_[-1] if open_ else NO_ELEMENT
                drop = dropped or _not_main(attributes)
            if name not in INLINE or page[end - 2: end] != "/>":
                open_.append((name, drop, inside or name in MARKED and not drop))
    if not raw and at < len(page):
        text.append(page[at:])
    flush()
    return out


def title(page) -> str:
    found = TITLE.search(page) if isinstance(page, str) else None
    return " ".join(html_lib.unescape(found[1]).split()) if found else ""


def candidates(page: list[tuple[str, bool, bool]]) -> tuple[list[int], bool]:
    """The blocks of a page that can be main text, and whether it marks its article."""
    marked = any(inside and not dropped for _, dropped, inside in page)
    return [k for k, (_, dropped, inside) in enumerate(page) if not dropped and (inside or not marked)], marked


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def sizes(page: list[tuple[str, bool, bool]]) -> list[int]:
    """Tokens of the blocks of a page, or their words if these are enough for a run: each has a token or more."""
    words = [text.count(" ") + 1 for text, _, _ in page]
    return [n if n >= MIN_RUN else len(WORD.findall(text)) for n, (text, _, _) in zip(words, page)]


def place_keys(page: list[tuple[str, bool, bool]], sizes: list[int]) -> list[tuple[int, ...]]:
    """Of each candidate of a page the keys by which it is counted: its text,
    inside a marked article with its place from the start and from the end; none
    for a text shorter than a run.  ``sizes`` are the tokens of all its blocks, or enough of them."""
    kept, marked = candidates(page)
    out = []
    for i, k in enumerate(kept):
        if sizes[k] < MIN_RUN:
            out.append(())
            continue
        text = _hash(page[k][0])
        out.append((_hash(f"{i}\0{text}"), _hash(f"{i - len(kept)}\0{text}")) if marked else (text,))
    return out


def page_hash(page: list[tuple[str, bool, bool]]) -> int:
    return _hash("\n".join(text for text, _, _ in page))


def on_most_pages(pages: list[list[tuple[str, bool, bool]]], keys: list[list[tuple[int, ...]]]) -> set[int]:
    """Keys of the blocks that are on more than half of the distinct pages of a host."""
    distinct: dict[int, set[int]] = {}
    for page, of in zip(pages, keys):
        distinct.setdefault(page_hash(page), set()).update(*of)
    count = Counter(key for page in distinct.values() for key in page)
    return {key for key, n in count.items() if n >= MIN_PAGES and 2 * n > len(distinct)}


def whole_runs(page: np.ndarray, run: int) -> np.ndarray:
    """Whether the run at each token ends on its page."""
    last = max(0, len(page) - run + 1)
    return np.append(page[run - 1:] == page[:last], np.zeros(len(page) - last, bool))


def suffixes(stream: np.ndarray, page: np.ndarray, article: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the suffixes of the concatenated streams, doubled until they order by
    ``run`` tokens, and the suffix array of those that begin with a whole run, equal
    starts by article: neighbours of one rank begin with the same run."""
    n, span, rank = len(stream), 1, stream
    while span < run:
        step = min(span, run - span)
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        _, rank = np.unique(rank * (rank.max(initial=0) + 2) + after, return_inverse=True)
        span += step
    order = np.lexsort((article, rank))
    return rank, order[whole_runs(page, run)[order]]


def articles_of(order: np.ndarray, rank: np.ndarray, article: np.ndarray) -> np.ndarray:
    """On how many distinct articles each rank is, of the suffixes in ``order``."""
    r, a = rank[order], article[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (a[1:] != a[:-1])
    return np.bincount(r, weights=new, minlength=len(rank) + 1)


def covered(starts: np.ndarray, n: int, run: int) -> np.ndarray:
    """Which of ``n`` tokens lie in the runs that begin at ``starts``."""
    return np.cumsum((np.bincount(starts, minlength=n + 1) - np.bincount(starts + run, minlength=n + 1))[:-1]) > 0


def repeated_runs(stream: np.ndarray, page: np.ndarray, article: np.ndarray, outside: np.ndarray, run: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of the concatenated streams lie in a run of ``run`` tokens
    that is on at least ``least`` distinct articles, and which in one that is
    ``outside`` on as many.  ``page``, ``article`` and ``outside`` are those of each token."""
    rank, order = suffixes(stream, page, article, run)
    often = (articles_of(o, rank, article) >= least for o in (order, order[outside[order]]))
    anywhere, out = (covered(order[x[rank[order]]], len(stream), run) for x in often)
    return anywhere, out


def longest_own(texts: list[str], common: list[bool], page: list[tuple[str, bool, bool]]) -> str:
    """What names the article of a page: the longest of its candidates that isn't common, else all its text."""
    own = [text for text, c in zip(texts, common) if not c]
    return max(own, key=len) if own else "\n".join(text for text, _, _ in page)


def main_texts(pages: list, most: Iterable[int] | None = None, run: int = MIN_RUN, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> list[str]:
    """Main texts of pages of one host.  ``most`` has the keys of the blocks on
    most of its pages; without it these are all its pages."""
    parsed = [blocks(p) for p in pages]
    ids: dict[str, int] = {}
    streams = [[[ids.setdefault(t, len(ids)) for t in WORD.findall(text)] for text, _, _ in b] for b in parsed]
    keys = [place_keys(b, [len(x) for x in tokens]) for b, tokens in zip(parsed, streams)]
    most = on_most_pages(parsed, keys) if most is None else set(most)
    common = [[not most.isdisjoint(k) for k in page] for page in keys]
    seen: dict[str, int] = {}
    article = []
    for b, is_common in zip(parsed, common):
        article.append(seen.setdefault(longest_own([b[k][0] for k in candidates(b)[0]], is_common, b), len(seen)))
    page = np.repeat(np.arange(len(parsed)), [len(b) for b in parsed])  # of each block
    first_block = np.searchsorted(page, np.arange(len(parsed)))
    size = np.array([len(x) for tokens in streams for x in tokens], np.int64)
    anywhere = boilerplate = np.zeros(len(size))
    if size.any():
        outside = np.array([dropped or not inside for b in parsed for _, dropped, inside in b])
        stream = np.fromiter((t for tokens in streams for x in tokens for t in x), np.int64, size.sum())
        block = np.repeat(np.arange(len(size)), size)
        hits = repeated_runs(stream, page[block], np.array(article)[page[block]], outside[block], run, max(min_pages, min_share * len(seen)))
        anywhere, boilerplate = (np.bincount(block, weights=hit, minlength=len(size)) for hit in hits)
    return [_text(b, is_common, (boilerplate if candidates(b)[1] else anywhere)[start:], size[start:], title(html))
            for html, b, is_common, start in zip(pages, parsed, common, first_block)]


def _text(page: list[tuple[str, bool, bool]], common: list[bool], repeated: np.ndarray, size: np.ndarray, name: str) -> str:
    """The blocks that stay, of a page's: by the repeated tokens and all tokens of each."""
    return "\n".join(page[k][0] for k, c in zip(candidates(page)[0], common)
                     if not c and (repeated[k] < 0.9 * max(1, size[k]) or page[k][0] == name))


def _extract(pages: pd.DataFrame) -> pd.DataFrame:
    text = main_texts(pages["html"].tolist())
    return pd.DataFrame({"page_id": pages["page_id"].array, "url": pages["url"].array, "text": text, "n_chars": [len(t) for t in text]})


PARSED = ("host string, groups long, page_id string, url string, name string, text string, marks binary, marked boolean, chars long, page long, "
          "own array<long>, own_size array<int>, counted array<boolean>")

#: The keys of candidate ``i`` of a parsed page by its hash ``h``, as place_keys has them; what counts them needs no column of their own.
KEYS = "if(marked, array(xxhash64(h, i), xxhash64(h, i - size(own))), array(h))"


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pages as blocks, with hash and length of each candidate, and whether it is as long as a run."""
    for batch in batches:
        rows = []
        for host, groups, page_id, url, html in batch.itertuples(index=False):
            page = blocks(html)
            kept, marked = candidates(page)
            tokens = sizes(page)
            text = "\n".join(text for text, _, _ in page)  # a block has no line break inside
            rows.append((host, groups, page_id, url, title(html), text, bytes(dropped + 2 * inside for _, dropped, inside in page), marked,
                         len(text), _hash(text), [_hash(page[k][0]) for k in kept], [len(page[k][0]) for k in kept], [tokens[k] >= MIN_RUN for k in kept]))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in PARSED.split(", ")])


def _page(text: str, marks: bytes) -> list[tuple[str, bool, bool]]:
    return [(block, bool(m & 1), bool(m & 2)) for block, m in zip(text.split("\n"), marks)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits spread over all of them, different ones differently, and 0 as 0 (the steps of splitmix64)."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def code_points() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point whether it belongs to a word, and its number in a hash, 0 if it is white space."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    word, number = np.zeros(len(every), bool), mixed(np.arange(1, len(every) + 1, dtype=np.uint64))
    for pattern, of, value in ((r"\w+", word, True), (r"\s+", number, 0)):
        for m in re.finditer(pattern, every):
            of[m.start(): m.end()] = value
    return word, number


def _piece_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.intp)
    word, number = (of.take(codes) for of in code_points())
    begins = number != 0
    begins[1:] &= ~(word[1:] & word[:-1])  # each other sign is a token of its own
    starts, index = np.flatnonzero(begins), np.arange(len(codes))
    place = index - np.maximum.accumulate(index * begins)  # in its token
    factors = mixed(np.arange(1, place.max() + 2, dtype=np.uint64)) | np.uint64(1)
    sums = np.cumsum(number * factors.take(place))[np.append(starts[1:], len(codes)) - 1]
    of_block = np.diff(np.searchsorted(starts, np.flatnonzero(codes == ord("\n"))), prepend=0, append=len(starts))
    return mixed(np.diff(sums, prepend=np.uint64(0))), np.repeat(np.arange(len(of_block)), of_block)


def token_hashes(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, those of ``WORD``, of the blocks of texts, and the block of
    each, counted over all texts.  A text has its blocks joined by line breaks, without white
    space around them, or is empty and has none.  A hash adds up the numbers of
    the characters, each times a factor of its place."""
    hashes, blocks_, piece, chars, before = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [], 0, 0
    for text in chain(filter(None, texts), (None,)):
        if piece and (text is None or chars + len(text) > PIECE_CHARS):
            hashed, block = _piece_hashes("\n".join(piece))
            hashes.append(hashed)
            blocks_.append(block + before)
            piece, chars, before = [], 0, before + int(block[-1]) + 1
        if text is not None:
            piece.append(text)
            chars += len(text)
    return np.concatenate(hashes), np.concatenate(blocks_)


def run_hashes(hashes: np.ndarray, run: int = MIN_RUN) -> np.ndarray:
    """A hash of the run at each token, of the hashes of the tokens."""
    last = max(0, len(hashes) - run + 1)
    out = np.zeros(last, np.uint64)
    for k in range(run):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k: k + last]
    return out.view(np.int64)


def _runs(every: bool):
    """applyInPandas function: of a group the runs that are on more than 1 / SLACK of its
    articles, or ``every`` one, each with the articles it is on and those where it is
    outside; and a row of its own (run 0, ``head``) with all articles.  ``slack`` is what
    a run that isn't sent has at most."""
    def run(pages: pd.DataFrame) -> pd.DataFrame:
        marks = pages["marks"].tolist()
        hashed, block = token_hashes(pages["text"])
        page = np.repeat(np.arange(len(marks)), [len(m) for m in marks])[block]
        of, articles = pd.factorize(pages["article"])
        outside = (np.frombuffer(b"".join(marks), np.uint8) != 2)[block]  # dropped, or not in a marked article
        stream = pd.factorize(hashed)[0].astype(np.int64)
        slack = 0 if every else len(articles) // SLACK
        rank, order = suffixes(stream, page, of[page], MIN_RUN)
        n, out = (articles_of(o, rank, of[page]).astype(np.int64) for o in (order, order[outside[order]]))
        first = order[np.flatnonzero(np.diff(rank[order], prepend=-1))]  # a suffix of each rank
        first = first[n[rank[first]] > slack]
        at = rank[first]
        sent = pd.DataFrame({"head": False, "run": run_hashes(hashed)[first], "n": n[at], "out": out[at]})
        head = pd.DataFrame({"head": [True], "run": [0], "n": [len(articles)], "out": [0]})
        return pd.concat([head, sent]).assign(host=pages["host"].iloc[0], hot=pages["hot"].iloc[0], article=pages["split"].iloc[0], slack=slack)[
            ["host", "hot", "article", "head", "run", "n", "out", "slack"]]
    return run


def group_runs(dealt: DataFrame, every: bool) -> DataFrame:
    return dealt.groupBy("host", "hot", "split", "salt").applyInPandas(
        _runs(every), "host string, hot boolean, article long, head boolean, run long, n long, out long, slack long")


def in_rounds(dealt: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The results of ``work`` on all groups, of a share of them at a time."""
    share = F.pmod(F.xxhash64("host", "split", "salt"), F.lit(ROUNDS))
    return reduce(DataFrame.unionByName, [saved(work(dealt.filter(share == k)), "runs") for k in range(ROUNDS)])


def run_sums(runs: DataFrame) -> DataFrame:
    """(host, run, n, out, slack) over the groups; an article of several groups counts once."""
    of_split = runs.filter("hot").groupBy("host", "article", "run").agg(F.max("out").alias("out"))
    of_split = of_split.select("host", "run", F.lit(1).cast("long").alias("n"), "out", F.lit(0).cast("long").alias("slack"))
    found = runs.filter("not hot").select("host", "run", "n", "out", "slack").unionByName(of_split)
    return found.groupBy("host", "run").agg(*[F.sum(c).alias(c) for c in ("n", "out", "slack")])


def frequent_runs(dealt: DataFrame) -> DataFrame:
    """Per host the sorted hashes of the runs on enough of its distinct articles, ``often``,
    and of those ``outside`` on as many."""
    runs = in_rounds(dealt, lambda groups: group_runs(groups, False))
    heads = runs.filter("head").groupBy("host").agg(
        (F.coalesce(F.sum(F.when(~F.col("hot"), F.col("n"))), F.lit(0)) + F.count_distinct(F.when(F.col("hot"), F.col("article")))).alias("articles"),
        F.sum("slack").alias("all_slack"))
    heads = saved(heads.select("host", "all_slack", F.greatest(F.lit(float(MIN_PAGES)), F.lit(MIN_SHARE) * F.col("articles")).alias("least")), "host-articles")
    sums = run_sums(runs.filter("not head")).join(small(heads), "host").withColumn("missing", F.col("all_slack") - F.col("slack"))
    sums = saved(sums.filter("n + missing >= least"), "run-sums")
    open_ = "n < least or (out < least and out + missing >= least)"
    unclear = saved(sums.filter(open_).select("host", "run", "least"), "unclear-runs")
    if not unclear.isEmpty():
        dealt, wanted = dealt.join(small(unclear.select("host").distinct()), "host", "left_semi"), small(unclear.select("host", "run"))
        again = in_rounds(dealt, lambda groups: group_runs(groups, True).filter("not head").join(wanted, ["host", "run"], "left_semi"))
        counted = run_sums(again).join(unclear, ["host", "run"]).select("host", "run", "n", "out", "least")
        sums = saved(sums.filter(f"not ({open_})").select("host", "run", "n", "out", "least").unionByName(counted), "run-sums")
    lists = [F.sort_array(F.collect_list(F.when(F.col(c) >= F.col("least"), F.col("run")))).alias(name) for c, name in (("n", "often"), ("out", "outside"))]
    return saved(sums.groupBy("host").agg(*lists), "host-runs")


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Main texts of parsed pages, by which candidates are common and the runs that count."""
    for batch in batches:
        counted = [len(runs) > 0 for runs in batch["runs"]]  # of other pages no token counts
        hashed, block = token_hashes(batch["text"][counted])
        first = np.cumsum([0] + [len(m) if c else 0 for m, c in zip(batch["marks"], counted)])  # block of each page
        size, ends = np.bincount(block, minlength=first[-1]), np.searchsorted(block, first)
        found, hit = run_hashes(hashed), np.zeros(len(hashed), bool)
        for runs, start, end in zip(batch["runs"], ends, ends[1:] - MIN_RUN + 1):
            if start < end:  # runs that end on the page
                of = found[start: end]
                hit[start: end] = runs[np.minimum(np.searchsorted(runs, of), len(runs) - 1)] == of
        repeated = np.bincount(block, weights=covered(np.flatnonzero(hit), len(hashed), MIN_RUN), minlength=first[-1])
        out = []
        for text, marks, name, common, c, k in zip(batch["text"], batch["marks"], batch["name"], batch["common"], counted, first):
            none = np.zeros(len(marks), np.int64)
            out.append(_text(_page(text, marks), list(common), repeated[k:] if c else none, size[k:] if c else none, name))
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": out, "n_chars": [len(t) for t in out]})


@tidy
def host_blocks(pages: DataFrame) -> DataFrame:
    """Per host ``most``: the keys of the blocks on more than half of its distinct
    pages, so at most twice the blocks of its average page."""
    of_page = F.expr(f"flatten(transform(own, (h, i) -> if(counted[i], {KEYS}, cast(array() as array<bigint>))))")
    keys = pages.select("host", "page", F.explode(F.concat(of_page, F.array(F.lit(None).cast("long")))).alias("key"))  # a null key a page
    counts = saved(keys.distinct().groupBy("host", "key").agg(F.count("*").alias("n")), "block-counts")
    total = small(saved(counts.filter("key is null").select("host", F.col("n").alias("total")), "host-pages"))  # a row for each large host
    often = counts.filter((F.col("n") >= MIN_PAGES) & F.col("key").isNotNull()).join(total, "host").filter("2 * n > total")
    return often.groupBy("host").agg(F.collect_list("key").alias("most"))


@tidy
def host_texts(rows: DataFrame) -> DataFrame:
    """The result for the pages of hosts that are dealt over ``groups``."""
    rows = rows.select("host", "groups", F.col("page_id").cast("string"), "url", "html").sortWithinPartitions("host")  # what pages share lies close, for compression
    pages = saved(rows.mapInPandas(_parsed, PARSED), "pages")
    common = f"transform(own, (h, i) -> coalesce(counted[i] and arrays_overlap(most, {KEYS}), false))"
    article = "array_max(filter(transform(own, (h, i) -> struct(own_size[i] as size, -i as place, h as text, common[i] as common)), x -> not x.common)).text"
    pages = pages.join(small(host_blocks(pages), HOSTS), "host", "left").withColumn("common", F.expr(common))
    pages = pages.withColumn("article", F.coalesce(F.expr(article), F.col("page")))

    parts = F.greatest(F.ceil(F.count("*") / GROUP_PAGES), F.ceil(F.sum("chars") / GROUP_CHARS)).alias("parts")
    hot = saved(pages.groupBy("host", "article").agg(parts).filter("parts > 1"), "large-articles")
    dealt = pages.join(small(hot), ["host", "article"], "left").withColumn("hot", F.col("parts").isNotNull())
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("page_id", "url", "page"), F.coalesce("parts", F.lit(1)))).otherwise(F.pmod(F.xxhash64("article"), "groups"))
    split = F.when(F.col("hot"), F.col("article")).otherwise(0)
    dealt = dealt.select("host", "hot", split.alias("split"), salt.alias("salt"), "article", "text", "marks")
    found = small(frequent_runs(dealt), HOSTS)
    none = F.array().cast("array<long>")
    runs = F.coalesce(F.when(F.col("marked"), F.col("outside")).otherwise(F.col("often")), none)
    pages = pages.join(found, "host", "left").select("page_id", "url", "name", "text", "marks", "common", runs.alias("runs"))
    out = pages.mapInPandas(_texts, "page_id string, url string, text string, n_chars long")
    return out.withColumn("page_id", F.col("page_id").cast("long"))


def extract(pages: DataFrame) -> DataFrame:
    """Per row page_id, url, text and n_chars."""
    rows = packed(pages).select(F.col("__row.page_id").cast("long").alias("page_id"), F.col("__row.url").alias("url"), F.col("__row.html").alias("html"))
    rows = rows.withColumn("host", host_and_path(F.col("url"))[0])
    hosts = rows.groupBy("host").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("html")), F.lit(0)).alias("chars"))
    groups = F.greatest(F.ceil(F.col("n") / GROUP_PAGES), F.ceil(F.col("chars") / GROUP_CHARS), F.lit(1))
    hosts = saved(hosts.select("host", groups.alias("groups")).filter("groups > 1"), "large-hosts")
    one = rows.join(small(hosts), "host", "left_anti").select("host", "page_id", "url", "html")
    out = one.groupBy("host").applyInPandas(_extract, "page_id long, url string, text string, n_chars long")
    if hosts.isEmpty():
        return out
    with batches_of(pages.sparkSession, PAGES):
        return out.unionByName(host_texts(rows.join(small(hosts), "host")))
