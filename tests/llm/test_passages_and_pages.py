"""Benchmark passages against a full edit distance, URL rules against a plain loop, page texts against a plain reading."""

import html
import os
import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from starloom.llm import decontam, htmltext, urlrules


def edits(pattern, text):
    """Fewest edits of pattern to any stretch of text: a row of the table at a time, insertions as a running minimum."""
    letters, at = np.array([ord(c) for c in text], dtype=np.int64), np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype=np.int64)
    for i, a in enumerate(pattern, 1):
        row = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (letters != ord(a)))])
        row = np.minimum.accumulate(row - at) + at
    return int(row.min())


def plain(text):
    return re.sub(r"[^a-z0-9\x80-\U0010ffff]+", " ", text.lower()).strip()


def test_planted_passages(spark, documents):
    rng = random.Random(4)
    vocabulary = ["the", "of", "and", "in", "Été", "straße", *["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(200)]]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, prose(rng.randint(6, 60))) for i in range(30)] + [(100, "too short"), (101, None), (102, ""), (103, prose(30))]
    items.append((104, items[3][1]))
    bench = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, start int")

    def spoiled(text, rate):
        out = list(text)
        for _ in range(int(rate * len(text))):
            k = rng.randrange(len(out))
            out[k : k + 1] = rng.choice([[], ["z"], [out[k], "q"]])
        return "".join(out)

    rows = []
    for k in range(120):
        item = items[k % 30][1]
        rate = [0, 0.02, 0.04, 0.2, None][k % 5]
        middle = "" if rate is None else spoiled(item.upper() if k % 7 == 0 else item.replace(" ", " * \n"), 0) if rate == 0 else spoiled(item, rate)
        rows.append((k, f"{prose(rng.randint(0, 300))}. {middle}. {prose(rng.randint(0, 300))}"))
    rows += [(200, None), (201, ""), (202, prose(3000) + " " + items[0][1]), (202, items[0][1]), (None, items[1][1])]
    got = decontam.leaks(documents(*rows), bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    texts = {i: t or "" for i, t in rows if i is not None and i != 202}
    for i, t in texts.items():
        for item_id, item in items:
            p = plain(item or "")
            if len(p) < decontam.LEAST:
                assert ((i, item_id) in found) == bool(p and f" {p} " in f" {plain(t)} ")
            elif (n := edits(p, plain(t))) <= 0.05 * len(p) - 1:
                assert (i, item_id) in found, (i, item_id, n, len(p))
            elif n > 0.6 * len(p):
                assert (i, item_id) not in found
    assert {(202, 0), (None, 1), (3, 3), (3, 104)} - {(3, 3), (3, 104)} <= found
    for r in got:
        if r.doc_id is not None and r.doc_id < 200 and r.passage_chars == r.item_chars:
            assert edits(plain(dict(items)[r.item_id]), plain(texts[r.doc_id][r.start : r.end])) <= r.edits


def test_short_items_are_found_as_whole_words(spark, documents):
    rng = random.Random(12)
    words = ["a", "été", "b1", "ÉTÉ", "straße", "x", "yy", "日本", "a-b"]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))) for k in range(60)]
    items += [(60, "..."), (61, ""), (62, None), (63, "a"), (64, "A!")]
    items = [(k, t) for k, t in items if len(plain(t or "").encode()) < decontam.LEAST]
    rows = [(k, rng.choice(["", " ", "* "]) + rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 60))) + rng.choice(["", ".", " "])) for k in range(80)]
    rows += [(100, None), (101, ""), (102, "a"), (103, "ab ba"), (104, "a " * 300_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.leaks(documents(*rows), bench).where("doc_id <> 104").collect()
    assert len(got) == len(set(got))
    folded = lambda t: re.sub(r"[^a-z0-9\x80-\U0010ffff]", " ", t.lower())  # noqa: E731  a letter for a letter
    expected = set()
    for i, t in rows[:-1]:
        for item_id, item in items:
            if p := plain(item or ""):
                for found in re.finditer("(?=(?<![^ ])(" + re.escape(p).replace("\\ ", " +") + ")(?![^ ]))", folded(t or "")):
                    expected.add((i, item_id, found.start(1), found.end(1)))
    assert {(r.doc_id, r.item_id, r.start, r.end) for r in got} == expected and len(expected) > 100
    assert all(r.edits == 0 and r.passage_chars == r.item_chars for r in got)
    many = decontam.leaks(documents(*rows), bench).where("doc_id = 104").groupBy("item_id").count().collect()
    assert {r["count"] for r in many if r.item_id in (63, 64)} == {300_000}


def test_length_of_a_passage_is_a_parameter(spark, documents):
    rng = random.Random(9)
    item = " ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(80))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents((1, "x y z " + item[150:240] + " and more"), (2, item[150:190]))
    assert decontam.leaks(docs, bench).collect() == []
    assert [r.doc_id for r in decontam.leaks(docs, bench, passage=80).collect()] == [1]
    for wrong in (10, 160):
        with pytest.raises(ValueError, match="passage"):
            decontam.leaks(docs, bench, passage=wrong)


def test_a_part_of_a_long_item_is_found(spark, documents):
    rng = random.Random(9)
    item = " ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(80))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontam.leaks(documents((1, "x y z " + item[150:400] + " and more"), (2, item[150:190])), bench).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 1)] and 120 <= got[0].passage_chars < 300
    assert decontam.leaks(documents(), bench).collect() == []
    assert decontam.leaks(documents((1, item)), bench.limit(0)).collect() == []


def test_stretches_of_long_items_are_found_wherever_they_begin(spark, documents):
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 8))) for _ in range(n))
    items = {i: words(60)[: 260 + i].strip() for i in range(30)}
    rows, asked = [], []
    for offset in range(30):
        for size in (120, 125, 130, 135, 149):
            for spoilt in (0, 3, 6):
                at = min(30 * rng.randint(0, 3) + offset, len(items[offset]) - size)
                stretch = list(items[offset][at : at + size])
                for _ in range(spoilt):
                    k = rng.randrange(len(stretch))
                    stretch[k : k + 1] = rng.choice([[], ["z"], [stretch[k], "q"]])
                before, middle = words(20), "".join(stretch)
                rows.append((len(rows), f"{before} z{middle}z {words(20)}"))
                asked.append((offset, at, size, spoilt, len(before) + 2, len(middle)))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontam.leaks(documents(*rows), bench).collect()}
    missed = [asked[i][:4] for i in range(len(rows)) if (i, asked[i][0]) not in found]
    assert not missed, (len(missed), len(rows), missed[:5])
    assert len(found) == len(rows)
    for (i, _), r in found.items():
        _, _, size, _, begin, length = asked[i]
        # Six edits reach a few letters beyond the stretch, more where some of those agree by chance.
        assert abs(r.start - begin) <= 24 and abs(r.end - begin - length) <= 24 and r.edits <= 6
        assert 120 <= r.passage_chars <= size + 48


def test_a_text_that_repeats_itself_takes_bounded_memory(monkeypatch):
    index = decontam.indexed([(1, "ab " * 100), (2, "ab " * 60 + "cd " * 20)])
    text, _, stops = decontam.folded(np.frombuffer(b"ab " * 20_000 + b"x " + b"ab " * 20_000, np.uint8), np.array([120_002]))
    want = decontam._bands(index, text, stops)
    assert [(i, low) for _, i, low, _ in want] == [(0, -288), (1, -168)]
    monkeypatch.setattr(decontam, "MOST_HITS", 10_000)
    monkeypatch.setattr(decontam, "STRETCH", 997)
    tracemalloc.start()
    assert decontam._bands(index, text, stops) == want
    assert tracemalloc.get_traced_memory()[1] < 20e6  # all hits together are some hundred megabytes
    tracemalloc.stop()
    assert decontam.verified(index, text, 0, *want[0][2:]) == [(0, 299, 0, 299)]


def test_bands_do_not_depend_on_the_stretches(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, 6))) for _ in range(40)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, prose(rng.randint(8, 80))) for i in range(20)]
    texts = [prose(rng.randint(0, 60)) + " " + rng.choice(items)[1] + " " + prose(rng.randint(0, 300)) for _ in range(60)] + ["", "a"]
    joined = [t.encode() for t in texts]
    text, _, stops = decontam.folded(np.frombuffer(b"".join(joined), np.uint8), np.cumsum([len(t) for t in joined]))
    index = decontam.indexed(items)
    want = decontam._bands(index, text, stops)
    assert len(want) >= 60
    for hits, stretch in ((50, 10**6), (10**6, 100), (7, 33)):
        monkeypatch.setattr(decontam, "MOST_HITS", hits)
        monkeypatch.setattr(decontam, "STRETCH", stretch)
        assert decontam._bands(index, text, stops) == want


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("a.com", "", "block"), ("b.com", "/x.y+", "allow"), ("same.net", "/p", "allow"), ("p.same.net", "/", "block")]
URLS = [
    "http://example.org/es/1", "https://www.EXAMPLE.org/en/17?x=://", "http://notexample.org/es/", "http://example.org", "http://example.org?x=/es/", "http://a.com", "http://a.com/q#z",
    "http://xa.com/", "http://b.com/x.y+z", "http://b.com/xzy", "ftp://casino.site/", "http://best-casino.org/", "http://m.free-bets.net/a", "http://casinos24.net/", None, "", "example.org/es/",
    "a://b://example.org/es/", "http://p.same.net/p", "://example.org/es/", "http://example.org:80/es/", "http:///es/", "http://u.example.org/es", "http://example.org/es/\nx", "http://A.com/",
]


def by_loop(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x.group().lower(), m.group(1)), m.group(2)) if m else ("", "")
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    own = any(re.search(rf"(?:^|[.-]){t}[.-]", host) for _, tokens in urlrules.UNWANTED for t in tokens)
    return host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else "block" if own else "allow"


def test_rules_are_those_of_a_loop(spark):
    pages = spark.createDataFrame([(i, u, "x", 3) for i, u in enumerate(URLS)] + [(None, URLS[0], "x", 3)], "page_id long, url string, rule string, row int")
    rules = urlrules.listed(spark, RULES).unionByName(urlrules.unwanted(spark))
    got = urlrules.judged(pages, rules).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == by_loop(URLS[r.page_id]), URLS[r.page_id]
    assert urlrules.judged(pages.limit(0), rules).collect() == []


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in htmltext.main_text(pages).collect()}
    for p in pages.collect():
        article = re.search(r"<article>(.*?)</article>", p.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, want, len(want))


PAGES = {
    "marked": ("<body><header>Site</header><div class='sidebar'><p>Side</p></div><main><h1>T &amp; x</h1><p>One\n two<br>three<p>Four <b>bold</b>"
               "<aside>no</aside><form>f<input></form><script>if (a<b) '</p>'</script><div class=\"cookie-notice\">no</div><section id=comments><p>hi</p></section>"
               "<!-- <p>no</p> --><ul><li>a<li>b&#33;</ul></main><footer>no</footer></body>", "T & x\nOne two three\nFour bold\na\nb!"),
    "cut": ("<article><p>text goes <b>on and on", "text goes on and on"),
    "cut in a tag": ("<article><p>text <a href='x", "text"),
    "cut behind a sign": ("<article>1 < 2 <", "1 < 2 <"),
    "no page": (None, ""),
    "empty": ("", ""),
    "setting of the page": ("<div class='layout no-sidebar'><article><p>One<p>Two</article></div><div class='has-comments with-header'><p>more</div>", "One\nTwo"),
    "form around all": ("<form id='aspnetForm'><div id=header>Site</div><article><p>One</p><form><p>vote</form></article><p>Log in</p></form>", "One"),
    "marked around": ("<div class='site-header widget'><nav>menu</nav><main><h1>Title</h1><p>Long text of the page</main></div><div class=teaser><article>Short</article></div>", "Title\nLong text of the page"),
    "comments": ("<article><p>One two three four</p></article><section id=comments><article><p>I think</p></article><article><p>No</p></article></section>", "One two three four"),
    "aside is no form": ("<aside><article><p>One two three four</p></article></aside><article>Five</article>", "Five"),
    "other attributes": ("<article data-x='class=\"sidebar\"'><p title='id=ad'>One</p><p title=\"a > b\">Two</p><p don't>Three</p><p title=\"x>Four</p></article>", "One\nTwo\nThree\nFour"),
    "raw text": ("<article>a<script>'</article>'</script>b<STYLE>x</Style >c<script/>d<textarea>e", "abcd"),
    "text only": ("just some\ttext &lt;here&gt;", "just some text <here>"),
}


def test_markup(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.x/", h, "t", 1) for i, (h, _) in enumerate(PAGES.values())], "page_id long, url string, html string, text string, same int")
    got = {r.page_id: r.text for r in htmltext.main_text(pages).collect()}
    assert got == {i: want for i, (_, want) in enumerate(PAGES.values())}
    assert htmltext.main_text(pages.limit(0)).collect() == []


@pytest.mark.parametrize("broken", ["<a ", "<a '", "<a=\"", "<a b=\"", "<", "</", "<!", "<!--", "<script>", "<script ", "<p title=' ", "<title", "<a\n\n\n'", "<div class=\"ad ", "<div></p>", "<b></i>", "<p><b></div>", "<article>", "<li><form>"])
def test_broken_markup_takes_linear_time(broken):
    began = time.perf_counter()
    htmltext.blocks_of("<article><p>One</p>" + broken * (5_000_000 // len(broken)) + "\"'")
    assert time.perf_counter() - began < 30


@pytest.mark.parametrize("shard", [40, 10**6])
def test_repeated_runs_go_and_unique_ones_stay(spark, monkeypatch, shard):
    monkeypatch.setattr(htmltext, "SHARD_TOKENS", shard)
    frame = "<div>All rights belong to the owners of this small site</div>"
    own = [f"<p>story {i} tells of {i * 7} things that nobody else has {i} written</p>" for i in range(12)]
    rows = [(i, "http://one.x/a", f"<body>{o}{frame}</body>") for i, o in enumerate(own)]
    rows += [(50, "http://one.x/b", rows[0][2]), (51, "http://two.x/", f"<body>{own[3]}{frame}</body>"), (None, None, "<p>alone here</p>")]
    got = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = [re.sub("<[^>]*>", "", o) for o in own]
    assert got == {**dict(enumerate(text)), 50: text[0], 51: f"{text[3]}\n{re.sub('<[^>]*>', '', frame)}", None: "alone here"}


@pytest.mark.parametrize("shard", [300, 10**6])
def test_near_copies_and_shared_quotes_stay(spark, monkeypatch, shard):
    monkeypatch.setattr(htmltext, "SHARD_TOKENS", shard)
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(n))
    menu, frame, quote, licence, article = prose(12), prose(10), prose(25), prose(8), [prose(60), prose(40)]
    shown = lambda host, i, parts: (i, f"http://{host}/{i}", "<body>" + "".join(f"<div>{t}</div>" for t in [menu, *parts, frame]) + "</body>")
    want = {i: [prose(30), prose(40) + (f" {licence} " if i < 8 else " ") + prose(5), *([quote] if i < 3 else []), prose(20)] for i in range(20)}
    want |= {i: [*article, prose(10)] for i in range(20, 30)}  # an article beside ten comments
    rows = [shown("one.x", i, parts) for i, parts in want.items()]
    copies = {i: [*article, prose(10)] for i in range(30, 36)}  # a host that has nothing but near copies
    rows += [shown("two.x", i, parts) for i, parts in copies.items()]
    rows += [(i, None, f"<p>{quote}</p><p>{prose(10)}</p>") for i in range(40, 46)]
    got = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, parts in want.items():
        assert got[i] == "\n".join(parts), i
    for i, parts in copies.items():
        assert got[i] == "\n".join([menu, *parts, frame]), i
    assert all(got[i].startswith(quote) for i in range(40, 46))


def test_suffix_array_against_sorted_suffixes():
    rng = np.random.default_rng(6)
    for round_ in range(60):
        sizes = rng.integers(0, 25, rng.integers(1, 8))
        pages = [rng.integers(0, rng.integers(1, 5), n).tolist() for n in sizes]
        if round_ % 3 == 0:
            pages += pages[:2]
        flat = [t for p in pages for t in p]
        if not flat:
            continue
        suffixes = [tuple(p[k:]) for p in pages for k in range(len(p))]
        page = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        left = np.array([len(s) for s in suffixes])
        order, common = htmltext._suffix_array(np.array(flat, np.uint64), left)
        ordered = [suffixes[k] for k in order]
        assert ordered == sorted(suffixes)
        assert common.tolist() == [0, *(len(os.path.commonprefix([a, b])) for a, b in zip(ordered, ordered[1:], strict=False))]
        article = rng.integers(-1, 5, len(pages))[page]
        for need in (2, 3, 4, 2**62):
            got = htmltext._longest(order, common, article, need)
            for s, n in zip(suffixes, got.tolist(), strict=True):
                on = lambda k, s=s: len({c for t, c in zip(suffixes, article.tolist(), strict=True) if c >= 0 and t[:k] == s[:k] and len(t) >= k})
                assert n == max([k for k in range(1, len(s) + 1) if on(k) >= need], default=0)


@pytest.mark.parametrize("shard", [60, 10**6])
def test_notices_inside_articles_go(spark, monkeypatch, shard):
    monkeypatch.setattr(htmltext, "SHARD_TOKENS", shard)
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(n))
    notice, quote, short = prose(14), prose(30), "Share this"
    parts = {i: [short, prose(40), *([quote] if i < 12 else []), prose(30)] for i in range(20)}
    rows = [(i, "http://one.x/", "<article>" + "".join(f"<p>{t}</p>" for t in [*p, notice]) + "</article><p>out</p>") for i, p in parts.items()]
    rows += [(100 + i, f"http://few.x/{i}", f"<article><p>{prose(30)}</p><p>{notice}</p></article>") for i in range(4)]  # too few articles to tell
    rows += [(200, None, f"<article><p>{notice}</p></article>")]
    got = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: got[i] for i in parts} == {i: "\n".join(p) for i, p in parts.items()}
    assert all(got[100 + i].endswith("\n" + notice) for i in range(4)) and got[200] == notice
