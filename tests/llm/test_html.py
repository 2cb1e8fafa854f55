import numpy as np
from epispark.llm import op5_html_extraction as H


def test_markup():
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var a = "</p>";</script></head>
    <body class="search"><header>top</header><nav><ul><li>menu</ul></nav><div class="x-ad">buy</div><!-- <article> -->
    <article><header><h1>A &amp; B</h1></header><p><b>first   line<br>more<p>a&lt;b &copy; &#233;<div id=comments><p>said</div>
    <form><input value=">">f</form><section>last <i>w</i>ord</section><aside>side</aside></article>
    <footer>end</footer></body></html>"""
    blocks, declared = H.parse(page)
    assert declared and blocks == ["A & B", "first line more", "a<b © é", "last word"]


def test_broken_markup():
    assert H.parse("")[0] == [] and H.parse("plain & simple < 3")[0] == ["plain & simple < 3"]
    assert H.parse("<article><p>one</p><p>two <a href='x")[0] == ["one", "two"]
    assert H.parse("<div class=menu>left open <article><p>text</p></article>")[0] == ["text"]
    assert H.parse("<p>a<script>never closed <p>b")[0] == ["a"]
    assert H.parse("<article><p>" + "x " * 100000 + "</article>")[0] == [" ".join(["x"] * 100000)]


def test_elements_left_open_inside_an_article():
    for page, want in [
            ("<article><p class=share>Share<p>Body one</p><p>Body two</p></article>", ["Body one", "Body two"]),
            ("<article><ul><li class=share>Share<li>Body one<li>two</ul><p>three</article>", ["Body one", "two", "three"]),
            ("<article><ul><li class=share>Share<ul><li>in it</ul><li>Body</ul></article>", ["Body"]),
            ("<article><dl><dt class=ad>Ad<dd>Body<dt id=ads>Ad<dt>term</dl>end</article>", ["Body", "term", "end"]),
            ("<article><table><tr><td class=promo>x<td>one<tr class=ad><td>x<tr><td>two</table>end</article>", ["one", "two", "end"]),
            ("<article><p class=share>Share<div>Body</div></article>", ["Body"]),
            ("<article><p class=share>a <span>Share</span> <b>b</b><h2>Body</h2></article>", ["Body"]),
            ("<article><div><nav>Menu</div><p>Body</p></article>", ["Body"]),
            ("<article><section><form><div>f</div></section>Body</article><article>two</article>", ["Body", "two"]),
            ("<article><p>one</p><aside>left open</article><article><p>two</p></article>", ["one", "two"]),
            ("<article><p>one <span class=ad>left open</p><p>two</p></article>", ["one", "two"]),
            ("<article><div class=share><table><tr><td>x</div><p>Body</article>", ["Body"]),
            ("<article><div class=share><div>x</div>y</div>Body</article>", ["Body"]),
            ("<article><nav><table><tr><td>x</article>", []),
            ("<html><head><meta charset=x><title>t</title><body><p>Body", ["Body"]),
            ("<p>Body</article>", ["Body"])]:
        assert H.parse(page)[0] == want, page


def test_many_open_elements():
    page = "<article>" + "<div>" * 100_000 + "</section></p></b>" * 50_000 + "text</article>"
    assert H.parse(page)[0] == ["text"]


def brute(pages, run, min_pages):
    holders = {}
    for k, blocks in enumerate(pages):
        w = " ".join(blocks).split(" ")
        for i in range(len(w) - run + 1):
            holders.setdefault(tuple(w[i:i + run]), set()).add(k)
    return {g for g, p in holders.items() if len(p) >= max(min_pages, -(-len(pages) // 2))}


def test_suffix_ranks_against_brute_force():
    rng = np.random.default_rng(1)
    token = rng.integers(0, 3, 200).astype(np.uint64)
    at = np.array([0, 50, 50, 120, 200])
    rank = H.suffix_ranks(token, at, 4)
    page = np.repeat(np.arange(4), np.diff(at))
    grams = {}
    for i in range(200):
        inside = i + 4 <= 200 and page[i] == page[min(i + 3, 199)]
        assert (rank[i] >= 0) == inside
        if inside:
            assert grams.setdefault(tuple(token[i:i + 4]), rank[i]) == rank[i]
    assert len(set(grams.values())) == len(grams)


def test_run_counts_against_brute_force():
    rng = np.random.default_rng(2)
    notice = "this notice stands on many pages of the host"
    pages = [[f"w{x}" for x in rng.integers(0, 50, 12)] + ([notice] if k % 3 else []) for k in range(12)]
    grams, often = H.run_counts(pages, 4)
    got = {int(g) for g, n in zip(grams, often) if n >= 6}
    want = brute(pages, 4, 5)
    assert got == {int(H._gram_hashes(H._tokens([[" ".join(g)]])[0], 4)[0]) for g in want} and want


def plain(data, run=8, min_pages=5):
    """The whole of ``extract`` without Spark: one rule over all contents of a host."""
    parsed = [(i, u, *H.parse(h or "")) for i, u, h in data]
    contents = {}
    for _, u, blocks, _ in parsed:
        host = (u or "").split("/")[2].lower() if "://" in (u or "") else ""
        if host:
            contents.setdefault(host, set()).add(" ".join(blocks))
    out = []
    for i, u, blocks, declared in parsed:
        host = (u or "").split("/")[2].lower() if "://" in (u or "") else ""
        own = contents.get(host, set())
        holders = {}
        w = " ".join(blocks).split(" ")
        cover = [False] * len(w)
        for k in range(len(w) - run + 1):
            g = " ".join(w[k:k + run])
            if g not in holders:
                holders[g] = sum(f" {g} " in f" {c} " for c in own)
            if holders[g] >= min_pages and 2 * holders[g] >= len(own):
                cover[k:k + run] = [True] * run
        kept, at = [], 0
        for block in blocks:
            ws = block.split(" ")
            gone = cover[at:at + len(ws)]
            at += len(ws)
            if not any(gone) or (declared and not all(gone)):
                kept.append(block)
            elif not all(gone):
                kept.append(" ".join(x for x, g in zip(ws, gone) if not g))
        out.append((i, u, "\n".join(kept)))
    return sorted(out, key=repr)


def test_against_a_plain_run_with_and_without_shards(spark):
    """Long and short repeats in part of the contents, copies, very long pages: one answer at every size of shard."""
    import random
    rng = random.Random(4)
    notice = " ".join(f"n{k}" for k in range(60))               # a repeat longer than a window
    part = " ".join(f"q{k}" for k in range(12))
    data = []
    for k in range(130):
        host = "abc"[k % 3]
        body = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 30))]
        blocks = [" ".join(body)] + ([notice] if rng.random() < 0.7 else []) + ([f"{part} own{k}"] if rng.random() < 0.5 else [])
        rng.shuffle(blocks)
        tag = "article" if k % 4 == 0 else "div"
        data.append((k, f"https://{host}.example/{k}", f"<{tag}>" + "".join(f"<p>{b}</p>" for b in blocks) + f"</{tag}>"))
    data += [(500 + k, "https://a.example/copy", data[3][2]) for k in range(40)]
    long = " ".join(f"v{rng.randrange(9)}" for _ in range(60_000))
    data += [(900, "https://b.example/long", f"<div>{long}</div><div>{notice}</div>"), (901, "https://b.example/long2", f"<p>{notice} " * 300)]
    want = plain(data)
    for shard_pages in (512, 9, 3):
        got = sorted(((r.page_id, r.url, r.text) for r in H.extract(rows(spark, data), shard_pages=shard_pages).collect()), key=repr)
        assert got == want, shard_pages


def test_names_inside_an_article():
    """Names of an article's own parts do not remove them; those of other parts do."""
    for page, want in [
            ('<article><h2 id="related-work">Related work</h2><p>Body</p></article>', ["Related work", "Body"]),
            ('<article><section id="social-effects"><h2>Social effects</h2><p>One</p></section></article>', ["Social effects", "One"]),
            ('<article><p class="market-share">A third</p></article>', ["A third"]),
            ('<article><div class="search-and-rescue">At sea</div></article>', ["At sea"]),
            ('<article><h2 id="comments">Comments</h2><p>Body</p></article>', ["Comments", "Body"]),
            ('<article><p>Body</p><div class="share-buttons">Share</div><ul class="related-posts"><li>Other</ul></article>', ["Body"]),
            ('<article><p>Body</p><section id="comments"><p>Said</p></section><div class="wide ad-slot-2">Buy</div></article>', ["Body"]),
            ('<div id="market-share">x</div><article>Body</article>', ["Body"])]:
        assert H.parse(page)[0] == want, page


def rows(spark, data):
    return spark.createDataFrame([(i, u, h, 1, 2, "x") for i, u, h in data],
                                 "page_id long, url string, html string, shard int, grams int, host string").repartition(3)


def test_repeated_runs_go_and_unique_ones_stay(spark):
    notice = "we use small files to make this site work better for all of you"
    data = [(k, f"https://a.example/{k}", f"<div>{notice}</div><div>first{k} second{k} third{k}</div>") for k in range(40)]
    data += [(100 + k, f"https://b.example/{k}", f"<p>{notice}</p>") for k in range(3)]            # too few pages to judge
    data += [(200 + k, f"https://c.example/{k}", f"<article><p>page {k}: {notice}</p><p>{notice}</p></article>") for k in range(6)]
    data += [(300 + k, None, f"<p>{notice}</p>") for k in range(9)]
    for shard_pages in (512, 10):
        got = {r.page_id: r for r in H.extract(rows(spark, data), shard_pages=shard_pages).collect()}
        assert len(got) == len(data)
        for i, u, _ in data:
            want = (f"first{i} second{i} third{i}" if i < 100 else notice if i < 200 else
                    f"page {i - 200}: {notice}" if i < 300 else notice)
            assert (got[i].text, got[i].n_chars, got[i].url) == (want, len(want), u), i


def article(k):
    return f"<article><p>{' '.join(f'a{k}x{j}' for j in range(20))}</p><p>{' '.join(f'b{k}x{j}' for j in range(20))}</p></article>"


def test_copies_of_an_article_are_content(spark):
    notice = "we use small files to make this site work better for all of you"
    data = [(k, f"https://a.example/{k}", f"<nav>n{k}</nav>" + article(0 if k < 5 else k)) for k in range(10)]    # 5 copies of 10
    data += [(100, "https://b.example/x", article(1))] * 9                                                       # repeated rows
    data += [(200 + k, f"https://c.example/{k}", f"<p>{notice}</p><p>own{k % 6} text{k % 6}</p>") for k in range(240)]  # six contents
    # six contents in many copies and more single pages: half of the pages and shards, not half of the contents
    data += [(1000 + k, f"https://d.example/{k}", f"<p>{notice}</p><p>own{k % 6}</p>" if k < 540 else f"<p>alone{k} here</p>")
             for k in range(560)]
    for shard_pages in (512, 10):
        got = sorted((r.page_id, r.text) for r in H.extract(rows(spark, data), shard_pages=shard_pages).collect())
        want = []
        for i, _, html in data:
            blocks = H.parse(html)[0]
            want.append((i, "\n".join(blocks[1:] if 200 <= i < 1000 else blocks)))
        assert got == sorted(want), shard_pages


def test_odd_pages(spark):
    data = [(1, None, None), (2, "", ""), (3, "not a url", "<p>x"), (None, "http://h.example/", "<p>y"), (5, "http://H.example/", "<p>é"),
            (5, "http://h.example/", "<p>é"), (6, "http://h.example/", "<nav>n")]
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in H.extract(rows(spark, data)).collect()))
    assert got == [(0, "y", 1), (1, "", 0), (2, "", 0), (3, "x", 1), (5, "é", 1), (5, "é", 1), (6, "", 0)]
    assert H.extract(rows(spark, data).limit(0)).collect() == []
