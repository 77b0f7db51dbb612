"""Main text of pages: markup says what is article and what is not, and a host's suffix array settles the rest.

A page with an article or main element has its text there, less the menus, forms, adverts and comments inside it. On other pages,
blocks that no element marks are doubtful. The token streams of a host's pages are concatenated: all blocks but those of articles,
and those of articles too that LEAST_ARTICLES articles have. The suffixes are put in order by prefix doubling; the common prefixes of
neighbours give the longest substring that begins at a token and occurs on enough articles. Substrings of LONG tokens and more cover what they
repeat. A doubtful block is boilerplate, and goes whole, if substrings cover it that each occur on SHARE of the
host's distinct articles and on LEAST_ARTICLES at least. A block inside an article goes if the substrings are on STRICT_SHARE of them and on
STRICT_LEAST. Other blocks are kept whole. Near copies, found by minhashes of the pages' texts, are one article.

A large host is sorted in shards of bounded size. A long substring that repeats only across shards is found by exchanging
the windows of LONG tokens that begin it, so the outcome does not depend on the shards.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.shingles import mixed
from starloom.llm.urlrules import host_and_path
from starloom.session import materialize

LONG = 6  # tokens of a repeated substring
SHARE = 0.5  # of a host's distinct articles, that boilerplate is on
LEAST_ARTICLES = 3  # distinct articles that boilerplate is on
STRICT_SHARE, STRICT_LEAST = 0.8, 5  # the same for boilerplate inside an article element
NEVER = 2**62  # more articles than any host has
HASHES = 24  # minhashes of a page's text
BAND = 4  # minhashes that two pages share to be compared
ALIKE = 15  # minhashes that near copies share
SHARD_TOKENS = 200_000

# Fixed values of HTML: elements without an end tag, elements that begin a block, elements that hold no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form head header iframe input label map menu nav noembed noframes noscript object "
    "option picture script select style svg template textarea title video".split()
)
RAW = "script|style|noscript|template|iframe|textarea|svg|title"
# Words of a class, id or role that mark an element as no part of the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies consent dialog disqus "
    "discussion footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion "
    "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget widgets".split()
)
# Words that turn the mark after them into a setting of the page ("no-sidebar").
SETTINGS = frozenset("no not non without has have with is hide hidden show toggle enable disable".split())
_RAW = frozenset(RAW.split("|"))
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in _RAW}
_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_TAG_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""")
_JUDGED = frozenset(("class", "id", "role", "itemprop", "hidden", "aria-hidden"))
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ARTICLE, OUTSIDE, DOUBTFUL = 1, 0, 2


def _marked(value: str) -> bool:
    """Whether one of the names in a class, id or role says that the element is no part of the article."""
    for name in value.lower().split():
        words = re.split(r"[^a-z0-9]+", name)
        if not MARKS.isdisjoint(words) and SETTINGS.isdisjoint(words):
            return True
    return False


def _marks(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is left out for its attributes, and whether they name the main text."""
    out = main = False
    for found in _ATTRIBUTE.finditer(attributes):
        kind = found.group(1).lower()
        if kind not in _JUDGED:
            continue
        value = (found.group(2) or "").strip("\"'")
        if kind == "hidden" or kind == "aria-hidden" and value.strip().lower() == "true":
            out = True
        elif kind == "itemprop" and "articlebody" in value.lower().split() or kind == "role" and value.strip().lower() == "main":
            main = True
        elif kind in ("class", "id", "role") and name not in ("html", "body", "main") and _marked(value):
            out = True
    return out, main


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it is an end tag, attributes) of the tags; comments, declarations and elements of raw text have no name.

    A quote counts only as the value of an attribute, and only if another one ends it. Every character is looked at a bounded number
    of times, however broken the markup is; a tag that never ends reaches to the end of the page.
    """
    last = {q: page.rfind(q) for q in "\"'"}
    raw_ends: dict[str, int] = {}
    at = page.find("<")
    while 0 <= at < len(page) - 1:
        letter = page[at + 1]
        if letter in "!?":
            if page.startswith("<!--", at):
                close = page.find("-->", at + 4)
                end = close + 3 if close >= 0 else len(page)
            else:
                close = page.find(">", at)
                end = close + 1 if close >= 0 else len(page)
            yield at, end, "", False, ""
            at = page.find("<", end)
            continue
        ends = letter == "/"
        name = _NAME.match(page, at + 1 + ends)
        if not name:
            at = page.find("<", at + 1)
            continue
        end = look = name.end()
        while True:
            stop = _TAG_STOP.search(page, look)
            if not stop:
                end, attributes = len(page), page[name.end() :]
                break
            if stop.group() == ">":
                end, attributes = stop.end(), page[name.end() : stop.start()]
                break
            look = stop.end()
            before = stop.start() - 1
            while before > at and page[before].isspace():
                before -= 1
            if page[before] == "=" and look <= last[stop.group()]:
                look = page.index(stop.group(), look) + 1
        kind = name.group().lower()
        if kind in _RAW and not ends:
            if not attributes.endswith("/"):
                if end > raw_ends.get(kind, -1):
                    close = _RAW_END[kind].search(page, end)
                    raw_ends[kind] = close.end() if close else len(page)
                end = raw_ends[kind]
            yield at, end, "", False, ""
        else:
            yield at, end, kind, ends, attributes
        at = page.find("<", end)


# What leaves an element out: nothing, its own mark, or what it is.
_IN, _BY_MARK, _BY_KIND = 0, 1, 2


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(status, text) of a page's blocks in order: white space is one blank, character references are decoded.

    Classes of the elements around the main text decide nothing about it, nor does a form around it: an article or main element
    within them counts if it holds more words than all that would count without it.
    """
    found, inner = _read(page, -1)
    if inner:
        counted = sum(t.count(" ") + 1 for s, t in found if s == ARTICLE)
        words, which = max((n, -k) for k, n in inner.items())
        if words > counted:
            found = _read(page, -which)[0]
    return found


def _read(page: str, freed: int) -> tuple[list[tuple[int, str]], dict[int, int]]:
    """The blocks, if what is around the article or main element at ``freed`` does not count; and the words of such elements that
    are left out by what is around them, by where they begin."""
    found: list[tuple[int, str]] = []
    # Element, left out for what, within the main text, where the outermost article or main element begins that is left out by others.
    stack: list[tuple[str, int, bool, int]] = []
    parts: list[str] = []
    is_open: dict[str, int] = {}
    inner: dict[int, int] = {}
    out, main, lost, any_main = _IN, False, -1, False

    def flush() -> None:
        text = "".join(parts)
        parts.clear()
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            found.append((OUTSIDE if out else ARTICLE if main else DOUBTFUL, text))
            if lost >= 0:
                inner[lost] = inner.get(lost, 0) + text.count(" ") + 1

    def drop(first: int) -> None:
        for e in stack[first:]:
            is_open[e[0]] -= 1
        del stack[first:]

    at = 0
    for start, end, name, ends, attributes in tags(page):
        if start > at:
            parts.append(page[at:start])
        at = end
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in VOID:
            if name in BLOCKS:
                flush()
            continue
        if ends:
            if not is_open.get(name):
                continue
            k = len(stack) - 1
            while stack[k][0] != name:
                k -= 1
            if any(e[0] in BLOCKS for e in stack[k:]):
                flush()
            drop(k)
        else:
            if name in BLOCKS or name in LEFT_OUT:
                flush()
            closes = _CLOSES.get(name)
            if closes and stack and stack[-1][0] in closes:
                drop(len(stack) - 1)
            elif name in BLOCKS:  # a block ends a paragraph that was left open, with what is inline in it
                k = len(stack)
                while k and stack[k - 1][0] not in BLOCKS:
                    k -= 1
                if k and stack[k - 1][0] == "p":
                    drop(k - 1)
            marked, named = _marks(name, attributes) if attributes else (False, False)
            upper_out, upper_main, lost = stack[-1][1:] if stack else (_IN, False, -1)
            is_main = named or name in ("article", "main")
            if start == freed:
                upper_out, lost = _IN, -1
            own = _BY_MARK if marked or name == "form" else _BY_KIND if name in LEFT_OUT else _IN
            if is_main and not own and upper_out == _BY_MARK and lost < 0:
                lost = start
            left_out = max(upper_out, own)
            within = upper_main or not left_out and is_main
            any_main = any_main or within
            if own:
                lost = -1
            if not attributes.rstrip().endswith("/") or name in BLOCKS:
                stack.append((name, left_out, within, lost))
                is_open[name] = is_open.get(name, 0) + 1
        out, main, lost = stack[-1][1:] if stack else (_IN, False, -1)
    parts.append(page[at:])
    flush()
    if any_main:
        found = [(s if s != DOUBTFUL else OUTSIDE, t) for s, t in found]
    return found, inner


_BLOCK = T.ArrayType(T.StructType().add("status", "integer").add("text", "string"))


_SEEDS = np.random.default_rng(11).integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _minhashes(text: str, known: dict[str, int]) -> list[int] | None:
    """Minhashes of a text's runs of LONG tokens, or of all of a shorter text; none of an empty one."""
    numbers = []
    for t in text.split():
        if (n := known.get(t)) is None:
            n = known[t] = zlib.crc32(t.encode())
        numbers.append(n)
    if not numbers:
        return None
    if len(numbers) < LONG:
        numbers += [0] * (LONG - len(numbers))
    hashes = _window_hashes(np.array(numbers, dtype=np.uint64))
    return [int(((hashes * seed) >> np.uint64(33)).min()) for seed in _SEEDS]


def _print(block: str) -> int | None:
    if block.count(" ") + 1 < LONG:
        return None
    return int.from_bytes(hashlib.blake2b(block.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the page by the article's text, whether that settles the page, the other blocks, and minhashes of what may be its text.

    ``prints`` are hashes of the article's blocks of LONG tokens and more, null for shorter ones.
    """
    kind = pa.list_(pa.struct([("status", pa.int32()), ("text", pa.string())]))
    for batch in batches:
        for at in range(0, len(batch), 128):
            some = batch.slice(at, 128)
            texts, settled, others, sizes, hashes, prints = [], [], [], [], [], []
            known: dict[str, int] = {}
            for page in some.column(4).fill_null("").to_pylist():
                found = blocks_of(page)
                rest = [{"status": s, "text": t} for s, t in found if s != ARTICLE]
                texts.append("\n".join(t for s, t in found if s == ARTICLE))
                prints.append([_print(t) for s, t in found if s == ARTICLE])
                settled.append(all(b["status"] != DOUBTFUL for b in rest))
                others.append(rest)
                sizes.append(sum(b["text"].count(" ") + 1 for b in rest))
                hashes.append(_minhashes(texts[-1] or "\n".join(b["text"] for b in rest if b["status"] == DOUBTFUL), known))
            made = [pa.array(texts, pa.string()), pa.array(settled, pa.bool_()), pa.array(others, kind), pa.array(sizes, pa.int64()), pa.array(hashes, pa.list_(pa.int32())), pa.array(prints, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*some.columns[:4], *made], names=["row", "id", "url", "host", "article", "settled", "others", "tokens", "hashes", "prints"])


def _articles(parsed: DataFrame) -> DataFrame:
    """row, host, same: near copies on a host have the same number, and pages without text none.

    Pages that share a band of minhashes are compared with the first of them.
    """
    pages = materialize(parsed.where("hashes is not null").select("row", "host", "hashes"), "minhashes")
    slices = [F.xxhash64(F.lit(i), F.slice("hashes", i + 1, BAND)) for i in range(0, HASHES, BAND)]
    bands = pages.select("row", "host", F.explode(F.array(*slices)).alias("band"))
    firsts = bands.groupBy("host", "band").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = bands.join(materialize(firsts, "bands"), ["host", "band"]).where("row <> first").select("row", "first").distinct()
    met = met.join(pages.select("row", "hashes"), "row").join(pages.select(F.col("row").alias("first"), F.col("hashes").alias("theirs")), "first")
    equal = F.size(F.filter(F.zip_with("hashes", "theirs", lambda a, b: a == b), lambda x: x))
    links = materialize(met.where(equal >= ALIKE).select("row", "first"), "links")
    numbers = links.groupBy("row").agg(F.min("first").alias("same"))
    for _ in range(3):  # what a page and the first ones it is like are called, by turns
        back = links.join(numbers, "row").groupBy(F.col("first").alias("at")).agg(F.min("same").alias("least"))
        named = links.join(back, F.col("first") == F.col("at")).groupBy("row").agg(F.min("least").alias("same"))
        own = back.select(F.col("at").alias("row"), F.least("at", "least").alias("same"))
        numbers = materialize(named.unionByName(own).groupBy("row").agg(F.min("same").alias("same")), "articles")
    return materialize(pages.select("row", "host").join(numbers, "row", "left").select("row", "host", F.coalesce("same", "row").alias("same")), "same")


def _streams(table: pa.Table) -> tuple[list[list[list[str]]], np.ndarray, np.ndarray, np.ndarray]:
    """Tokens by page and block; all tokens as numbers that are equal for equal tokens anywhere; page and place of each."""
    pages = [[b["text"].split(" ") for b in row or []] for row in table["blocks"].to_pylist()]
    flat = [t for page in pages for block in page for t in block]
    known: dict[str, int] = {}
    for t in flat:
        if t not in known:
            known[t] = int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "little")
    numbers = np.array([known[t] for t in flat], dtype=np.uint64)
    counts = [sum(map(len, page)) for page in pages]
    page = np.repeat(np.arange(len(pages)), counts)
    left = np.concatenate([np.arange(n, 0, -1) for n in counts] or [np.empty(0, np.int64)])
    return pages, numbers, page, left


def _suffix_array(numbers: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and how many tokens each has in common with the one before it; a suffix ends with its page.

    Ranks by ever longer prefixes, until all differ or the longest suffix is passed; the ranks then give the common prefixes.
    """
    n = len(numbers)
    rank = np.unique(numbers, return_inverse=True)[1].astype(np.int64)
    ranks, size = [rank], 1
    while size < left.max() and rank.max() + 1 < n:
        after = np.full(n, -1, dtype=np.int64)
        after[: n - size] = rank[size:]
        after[left <= size] = -1
        rank = np.unique(rank * (n + 2) + after + 1, return_inverse=True)[1].astype(np.int64)
        ranks.append(rank)
        size *= 2
    order = np.argsort(rank, kind="stable")
    one, other = order[:-1], order[1:]
    rest = np.minimum(left[one], left[other])
    common = np.zeros(n, dtype=np.int64)
    h = np.zeros(n - 1, dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = np.minimum(one + h, n - 1), np.minimum(other + h, n - 1)
        equal = (h < rest) & (ranks[k][x] == ranks[k][y])
        h = np.where(equal, np.minimum(h + (1 << k), rest), h)
    common[1:] = h
    return order, common


def _ranges(values: np.ndarray, best: np.ufunc, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least or greatest of ``values`` from first to last, both included."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(best(table[-1][:-half], table[-1][half:]))
    level = np.frexp(last - first + 1)[1] - 1
    out = np.empty(len(first), dtype=values.dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = best(table[k][first[at]], table[k][last[at] - (1 << k) + 1])
    return out


def _longest(order: np.ndarray, common: np.ndarray, article: np.ndarray, need: int) -> np.ndarray:
    """Length of the longest substring at each token that begins on ``need`` different articles too; ``article`` by token, -1 for none.

    For every suffix in order, the nearest ones behind and before it so that ``need`` articles lie between them; what all of these have in
    common is a repeated substring of each.
    """
    n, colours = len(order), article[order].tolist()
    reach, counts, distinct, r = np.full(n, n, dtype=np.int64), {}, 0, 0
    if need > len(set(colours) - {-1}):
        return np.zeros(n, dtype=np.int64)
    for at in range(n):
        while distinct < need and r < n:
            c = colours[r]
            r += 1
            if c >= 0:
                seen = counts.get(c, 0)
                counts[c] = seen + 1
                distinct += not seen
        if distinct < need:
            break
        reach[at] = r - 1
        c = colours[at]
        if c >= 0:
            counts[c] -= 1
            distinct -= not counts[c]
    shared = np.zeros(n, dtype=np.int64)
    some = np.flatnonzero((reach < n) & (reach > np.arange(n)))
    shared[some] = _ranges(common, np.minimum, some + 1, reach[some])
    place = np.arange(n)
    around = _ranges(shared, np.maximum, np.minimum(np.searchsorted(reach, place), place), place)
    nearest = np.searchsorted(reach, place, side="right") - 1  # the last suffix with enough articles up to this one
    some = np.flatnonzero(nearest >= 0)
    around[some] = np.maximum(around[some], _ranges(common, np.minimum, nearest[some] + 1, some))
    longest = np.empty(n, dtype=np.int64)
    longest[order] = around
    return longest


def _covered(longest: np.ndarray) -> np.ndarray:
    """Whether substrings of LONG tokens and more cover a token."""
    starts = np.flatnonzero(longest >= LONG)
    cover = np.zeros(len(longest) + 1, dtype=np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + longest[starts], -1)
    return np.cumsum(cover)[: len(longest)] > 0


def _judged(blocks: list[dict], words: list[list[str]], covered: np.ndarray, strictly: np.ndarray) -> tuple[str, list[str]]:
    """The doubtful blocks that repeated substrings do not cover whole, and the blocks of the article that they do."""
    kept, gone, at = [], [], 0
    for block, tokens in zip(blocks, words, strict=True):
        end = at + len(tokens)
        if block["status"] == DOUBTFUL and not covered[at:end].all():
            kept.append(block["text"])
        elif block["status"] == ARTICLE and strictly[at:end].all():
            gone.append(block["text"])
        at = end
    return "\n".join(kept), gone


def _window_hashes(numbers: np.ndarray) -> np.ndarray:
    value = np.zeros(max(0, len(numbers) - LONG + 1), dtype=np.uint64)
    for k in range(LONG):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + numbers[k : k + len(value)])
    return value


def _sorted_shard(table: pa.Table) -> pa.Table:
    """Per page its doubtful text and the blocks that its article loses, and for hosts of several shards the windows of LONG tokens."""
    pages, numbers, page, left = _streams(table)
    article = table["same"].fill_null(-1).to_numpy()[page]
    need, strict = table["need"][0].as_py(), table["strict"][0].as_py()
    runs = [np.zeros(len(numbers), dtype=np.int64)] * 2
    if len(numbers):
        order, common = _suffix_array(numbers, left)
        runs = [_longest(order, common, article, k) for k in (need, strict)]
    covers = [_covered(r) for r in runs]
    ends = np.concatenate([[0], np.cumsum(np.bincount(page, minlength=len(pages)))]).astype(int)
    hashes = _window_hashes(numbers)
    several = table["shards"][0].as_py() > 1
    texts, gone, windows = [], [], []
    for i, (blocks, words) in enumerate(zip(table["blocks"].to_pylist(), pages, strict=True)):
        a, b = ends[i], ends[i + 1]
        text, lost = _judged(blocks or [], words, covers[0][a:b], covers[1][a:b])
        texts.append(text)
        gone.append(lost)
        windows.append(hashes[a : max(a, b - LONG + 1)].view(np.int64).tolist() if several else [])
    return pa.table(
        {
            "row": table["row"], "host": table["host"], "same": table["same"], "doubtful": pa.array(texts, pa.string()),
            "gone": pa.array(gone, pa.list_(pa.string())), "windows": pa.array(windows, pa.list_(pa.int64())),
        }
    )


def _settled_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for pages of several shards, with the windows that are on enough articles of all shards."""
    for batch in batches:
        texts, gone = [], []
        for blocks, windows, *repeated in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True):
            words = [b["text"].split(" ") for b in blocks or []]
            covers = []
            for known in repeated:
                runs = np.zeros(sum(map(len, words)), dtype=np.int64)
                if windows and known:
                    runs[: len(windows)] = np.where(np.isin(np.array(windows, np.int64), np.array(known, np.int64)), LONG, 0)
                covers.append(_covered(runs))
            text, lost = _judged(blocks or [], words, *covers)
            texts.append(text)
            gone.append(lost)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(gone, pa.list_(pa.string()))], names=["row", "again", "gone_again"]
        )


def _reopened(parsed: DataFrame, same: DataFrame) -> DataFrame:
    """row, more: the blocks of a page's article that LEAST_ARTICLES different articles of its host have."""
    prints = parsed.where("host <> ''").select("row", "host", F.posexplode("prints").alias("place", "print")).where("print is not null")
    seen = prints.join(same.select("row", "same"), "row").select("host", "print", "same").distinct()
    common = seen.groupBy("host", "print").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_ARTICLES).select("host", "print")
    places = prints.join(materialize(common, "prints"), ["host", "print"]).groupBy("row").agg(F.array_sort(F.collect_list("place")).alias("places"))
    block = lambda i: F.struct(F.lit(ARTICLE).alias("status"), F.element_at(F.split("article", "\n"), i + 1).alias("text"))
    found = parsed.select("row", "article").join(materialize(places, "places"), "row").select("row", F.transform("places", block).alias("more"))
    return materialize(found, "reopened")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id and url as given, text (blocks joined by a line feed) and n_chars.

    A null or empty page has an empty text. A notice inside the article elements of most articles of a host goes too. Near copies count as one article, so they do not make each other boilerplate. Nothing is
    boilerplate on pages without a host. Rows that repeat are extracted each; other columns are not looked at.
    """
    given = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    given = given.select("row", "id", "url", host_and_path(F.col("url"))[0].alias("host"), "html")
    shape = given.drop("html").schema.add("article", "string").add("settled", "boolean").add("others", _BLOCK).add("tokens", "long").add("hashes", T.ArrayType(T.IntegerType()))
    parsed = materialize(given.mapInArrow(_parsed, shape.add("prints", T.ArrayType(T.LongType()))), "blocks")
    same = _articles(parsed)
    more = _reopened(parsed, same)

    # Pages without a host have nothing in common: no number of articles is enough for them.
    enough = lambda least, share: F.when(F.col("host") != "", F.greatest(F.lit(least), F.ceil(F.col("articles") * share))).otherwise(F.lit(NEVER)).cast("long")
    need = same.select("host", "same").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    need = need.select("host", enough(LEAST_ARTICLES, SHARE).alias("need"), enough(STRICT_LEAST, STRICT_SHARE).alias("strict"))
    added = F.aggregate("more", F.lit(0).cast("long"), lambda n, b: n + F.size(F.split(b["text"], " ")))
    sizes = parsed.select("row", "host", "tokens").join(more, "row", "left").select("host", (F.col("tokens") + F.coalesce(added, F.lit(0))).alias("tokens"))
    totals = sizes.groupBy("host").agg(F.sum("tokens").alias("n")).join(need, "host", "left")
    shards = F.greatest(F.lit(1), F.ceil(F.col("n") / SHARD_TOKENS)).cast("int").alias("shards")
    hosts = materialize(totals.select("host", shards, *[F.coalesce(k, F.lit(NEVER)).alias(k) for k in ("need", "strict")]), "shards")
    blocks = F.concat("others", F.coalesce("more", F.array().cast(_BLOCK))).alias("blocks")
    dealt = parsed.select("row", "host", "others", "settled").join(more, "row", "left").select("row", "host", blocks, (~F.col("settled") | F.col("more").isNotNull()).alias("open"))
    dealt = dealt.join(hosts, "host").join(same.select("row", "same"), "row", "left").withColumn("shard", F.expr("cast(pmod(xxhash64(row), shards) as int)"))
    result = "row long, host string, same long, doubtful string, gone array<string>, windows array<long>"
    done = dealt.select("row", "host", "same", "blocks", "shards", "need", "strict", "shard").groupBy("host", "shard").applyInArrow(_sorted_shard, result)
    done = materialize(done, "runs")

    # Windows of large hosts that lie on enough articles of all shards.
    spread = done.where(F.size("windows") > 0).select("row", "host", "same", F.explode("windows").alias("window"))
    counts = spread.where("same is not null").select("host", "window", "same").distinct().groupBy("host", "window").agg(F.count("*").alias("n"))
    repeated = counts.join(hosts, "host").where("n >= need").select("host", "window", (F.col("n") >= F.col("strict")).alias("strictly"))
    mine = spread.join(materialize(repeated, "windows"), ["host", "window"]).groupBy("row")
    mine = mine.agg(F.collect_set("window").alias("repeated"), F.collect_set(F.when(F.col("strictly"), F.col("window"))).alias("strictly"))
    again = dealt.where("open").select("row", "blocks").join(done.where(F.size("windows") > 0).select("row", "windows"), "row").join(mine, "row", "left")
    again = again.select("row", "blocks", "windows", "repeated", "strictly").mapInArrow(_settled_again, "row long, again string, gone_again array<string>")
    again = materialize(again, "again")

    # Settled pages are joined only with the blocks that their articles lose.
    lost = done.where(F.size("gone") > 0).select("row", "gone").join(again.where(F.size("gone_again") > 0).select("row", "gone_again"), "row", "full")
    lost = materialize(lost.select("row", F.coalesce("gone_again", "gone").alias("gone")), "lost")
    left_over = F.array_join(F.filter(F.split("article", "\n"), lambda b: ~F.array_contains("gone", b)), "\n")
    settled = parsed.where("settled").select("row", "id", "url", "article").join(lost, "row", "left")
    settled = settled.select("id", "url", F.when(F.col("gone").isNull(), F.col("article")).otherwise(left_over).alias("text"))
    rest = parsed.where("not settled").select("row", "id", "url", "article").join(done.select("row", "doubtful"), "row").join(again.select("row", "again"), "row", "left")
    text = F.concat_ws("\n", F.nullif("article", F.lit("")), F.nullif(F.coalesce("again", "doubtful"), F.lit("")))
    out = settled.union(rest.select("id", "url", text.alias("text")))
    out = out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
    return out.withColumn("n_chars", F.length("text").cast("long"))
