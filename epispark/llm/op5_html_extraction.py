"""Main text of web pages, by markup and by a suffix array over each host.

Markup.  Scripts, styles, forms, menus, headers, footers, sidebars, notices,
adverts and comments are left out by element, role or class name; where a page
has an <article> (or <main>), only what stands in it is read.  Block elements
cut the rest into blocks, white space in a block becomes one space, character
references are decoded.  Elements end as HTML says: at their own end tag, at a
start tag that implies it (p, li, dd, dt, option, rt, rp, parts of tables, the
head) or at the end tag of an element around them, also when they are left out.

A class, id or role names such a part anywhere outside a declared article; inside
one all its words must belong to such names (``share-buttons``, but not
``market-share``), and the id of a heading, which is made from its text, says nothing.

Host suffix array.  The token streams of a host's pages are laid end to end
and their suffixes sorted by their first ``run`` tokens (prefix doubling).
Pages with the same tokens are one content, which is laid there once: copies
of an article are content.  Suffixes that agree form an interval; a run of
``run`` or more tokens is boilerplate if its windows of ``run`` tokens each stand
in at least ``min_pages`` contents and in half of all contents of the host.
Tokens covered by boilerplate runs are removed and unique runs stay; inside a
declared article only blocks covered whole go, since an article may quote.

A host with many contents is dealt by their digests into shards of about
``shard_pages``; each has a suffix array of its own.  A window in half of a
host's contents is in half of the contents of some shard (or the sum would be
less), so the windows that half of a shard holds are all that can be; they are
then counted over all shards of the host.  One rule holds for every size.

Plan.  The parsed pages are written once.  Tasks drop contents they have met
before the contents are shuffled by host and shard, so a page that comes often
travels a few times; windows come to their shard or pages as one row each,
ahead of them.  Only pages of hosts with boilerplate are shuffled again.

Defined cases: null or empty html gives an empty text; a null or malformed
url is a host of its own kind in which nothing counts as repeated; repeated
rows are pages of their own and one content; articles that differ in a word
are different contents; an empty table gives no rows; columns other than
the id, the url and the html are not read.  Markup cut off in the middle of a
tag loses that tag alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, joined, partitions, saved, shingle_hashes, slices, span_hashes, strings

_TAG = re.compile(r"<(?:!--.*?(?:-->|$)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?:>|$))", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg"}
_CHROME = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "header", "head"}
_MAIN = {"article", "main"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
           "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
           "var", "wbr"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_CELLS = {"td", "th", "caption", "table", "button"}     # end tags inside do not end what is around them
_LISTS = {"ul", "ol", "menu", "dl", "section", "article", "main", "aside", "nav", "form", "blockquote", "fieldset", "details",
          "figure", "header", "footer", *_CELLS}
_OUTER = {"article", "main", "body", "html", "table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "button"}
_PARTS = {"tr", "td", "th", "caption", "colgroup"}
_IN_HEAD = {"meta", "link", "base", "basefont", "bgsound", "noframes"}
#: start tag -> the open elements that it ends, and within which they are looked for
_IMPLIED = {
    **dict.fromkeys(("address", "article", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset",
                     "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
                     "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul"), ({"p"}, _CELLS)),
    "li": ({"li"}, _LISTS), "dd": ({"dd", "dt"}, _LISTS), "dt": ({"dd", "dt"}, _LISTS),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table"}), "th": ({"td", "th", "caption", "colgroup"}, {"table"}),
    "tr": (_PARTS, {"table"}), **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", *_PARTS}, {"table"})),
}
#: names of parts that are not the article
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|consent|contentinfo|cookies?|"
    r"disqus|footer|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|popup|promo|promoted|related|share|sharing|"
    r"sidebar|social|sponsor|sponsored|subscribe|widget|complementary|search)(?:$|[\s_-])", re.I)
#: words that stand beside them in names
_BESIDE = re.compile(
    r"(?:article|bar|block|box|button|buttons|container|content|form|group|header|inner|item|items|js|left|link|links|list|"
    r"main|area|nav|outer|page|panel|post|posts|right|section|site|slot|thread|title|top|unit|bottom|wrap|wrapper|x|[0-9]+)$", re.I)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


class _Open:
    """The open elements, outermost first, and where those of each name stand."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.where: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str) -> None:
        self.where.setdefault(name, []).append(len(self.names))
        if name not in _INLINE:
            self.blocks.append(len(self.names))
        self.names.append(name)

    def cut(self, size: int) -> None:
        while len(self.names) > size:
            name = self.names.pop()
            self.where[name].pop()
            if name not in _INLINE:
                self.blocks.pop()

    def last(self, names) -> int:
        return max((self.where[n][-1] for n in names if self.where.get(n)), default=-1)

    def start(self, name: str) -> None:
        """Ends what the start tag implies."""
        names, within = _IMPLIED.get(name, ((), ()))
        if any(self.where.get(n) for n in names):
            least = self.last(within - names)
            self.cut(min((self.where[n][-1] for n in names if self.where.get(n) and self.where[n][-1] > least),
                         default=len(self.names)))

    def end(self, name: str, left_out: int) -> None:
        """The end tag of the innermost element of the name, if it may end what is open in it."""
        if not self.where.get(name):
            return
        at = self.where[name][-1]
        if at == left_out or name in _OUTER:
            ends = True
        elif name in _INLINE:
            ends = self.blocks[-1] < at if self.blocks else True
        else:
            ends = self.last(_LISTS if name == "li" else _CELLS) < at
        if ends:
            self.cut(at)


def parse(html: str) -> tuple[list[str], bool]:
    """The blocks of a page's main part, and whether the page declares it."""
    blocks: list[tuple[bool, str]] = []
    run: list[str] = []
    open_ = _Open()
    skip = -1                   # where in ``open_`` the element being left out stands
    declared = False
    at = 0

    def main() -> bool:
        return bool(open_.where.get("article") or open_.where.get("main"))

    def close() -> None:
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                blocks.append((main(), text))
            run.clear()

    while at < len(html):
        cut = html.find("<", at)
        if cut < 0:
            if skip < 0:
                run.append(html[at:])
            break
        if cut > at:
            if skip >= 0 and open_.names[skip] == "head" and len(open_.names) == skip + 1 and html[at:cut].strip():
                open_.cut(skip)                         # text ends a head that was left open
                skip = -1
            if skip < 0:
                run.append(html[at:cut])
        tag = _TAG.match(html, cut)
        if not tag:
            nxt = html[cut + 1:cut + 2]
            if nxt == "/" or nxt.isalpha():             # a tag with an open quote: to the next bracket
                end = html.find(">", cut)
                at = len(html) if end < 0 else end + 1
            else:
                if skip < 0:
                    run.append("<")
                at = cut + 1
            continue
        at = tag.end()
        if tag[2] is None:
            continue
        name, closing, attrs = tag[2].lower(), bool(tag[1]), tag[3] or ""
        if name in _RAW and not closing:
            if not attrs.endswith("/"):
                end = re.compile(f"</{re.escape(name)}\\b[^>]*(?:>|$)", re.I).search(html, at)
                at = end.end() if end else len(html)
            if name not in _INLINE:
                close()
            continue
        if skip < 0:
            if name not in _INLINE:
                close()
            elif name == "br":
                run.append(" ")
        if closing:
            open_.end(name, skip)
        else:
            if skip >= 0 and ((open_.names[skip] == "head" and name not in _IN_HEAD) or
                              (name in _MAIN and name != open_.names[skip] and not main() and not _named(attrs))):
                open_.cut(skip)                         # an article ends whatever was left open before it
            open_.start(name)
        if skip >= len(open_.names):
            skip = -1
            close()
        if closing or name in _VOID:
            continue
        if skip < 0:
            if ((name in _CHROME and not (name == "header" and main())) or
                    (attrs and name not in ("html", "body") and _named(attrs, name, main()))):
                close()
                skip = len(open_.names)
            elif name in _MAIN:
                declared = True
        open_.push(name)
    close()
    return [t for inside, t in blocks if inside or not declared], declared


def _named(attrs: str, element: str = "", inside: bool = False) -> bool:
    """Whether the attributes name a part that is not the article."""
    for a in _ATTR.findall(attrs):
        value = a[1] or a[2] or a[3]
        if not inside:
            if _NAMES.search(value):
                return True
        elif not (a[0].lower() == "id" and element in _HEADINGS):
            for name in value.split():
                words = [w for w in re.split(r"[_-]+", name) if w]
                told = [bool(_NAMES.search(w)) for w in words]
                if any(told) and all(t or _BESIDE.match(w) for t, w in zip(told, words)):
                    return True
    return False


def _tokens(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all pages end to end, and where each page begins."""
    words = [[w for b in blocks for w in b.split(" ")] for blocks in pages]
    data, off = joined([w.encode() for p in words for w in p])
    at = np.zeros(len(pages) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in words], out=at[1:])
    return span_hashes(data, off[:-1], off[1:], seed=5), at


def suffix_ranks(token: np.ndarray, at: np.ndarray, run: int) -> np.ndarray:
    """Rank of every suffix by its first ``run`` (a power of two) tokens; -1
    where its page ends before.  Equal ranks: an interval of the suffix array."""
    rank = np.unique(token, return_inverse=True)[1].astype(np.int64)
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(token))
    width = 1
    while width < run:
        both = np.flatnonzero(left >= 2 * width)
        code = rank[both] * (int(rank.max(initial=0)) + 1) + rank[both + width]
        rank = np.full(len(token), -1, dtype=np.int64)
        rank[both] = np.unique(code, return_inverse=True)[1]
        width *= 2
    return rank


def run_counts(pages: list[list[str]], run: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs, and how many of the pages hold each."""
    token, at = _tokens(pages)
    rank = suffix_ranks(token, at, run) if len(token) >= run else np.zeros(0, dtype=np.int64)
    where = np.flatnonzero(rank >= 0)
    if not len(where):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    page = np.repeat(np.arange(len(pages)), np.diff(at))[where]
    seen = np.unique(rank[where] * len(pages) + page)
    first = where[np.unique(rank[where], return_index=True)[1]]
    return _gram_hashes(token, run)[first], np.unique(seen // len(pages), return_counts=True)[1]


def _gram_hashes(token: np.ndarray, run: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return shingle_hashes(token, run)


def content(blocks: list[str]) -> bytes:
    """Digest of a page's tokens."""
    return hashlib.blake2b(" ".join(blocks).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def without(blocks: list[str], declared: bool, grams: np.ndarray, run: int) -> list[str]:
    """The blocks without the tokens that boilerplate runs cover."""
    token, _ = _tokens([blocks])
    if len(token) < run:
        return blocks
    hit = np.flatnonzero(np.isin(_gram_hashes(token, run), grams))
    if not len(hit):
        return blocks
    cover = np.zeros(len(token) + 1, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + run, -1)
    covered = np.cumsum(cover)[:-1] > 0
    out, i = [], 0
    for block in blocks:
        words = block.split(" ")
        gone = covered[i:i + len(words)]
        i += len(words)
        if not gone.any() or (declared and not gone.all()):
            out.append(block)
        elif not gone.all():
            out.append(" ".join(w for w, g in zip(words, gone) if not g))
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Rows that lie sorted by ``keys``, group by group."""
    key, parts = None, []
    for b in batches:
        tags = list(zip(*(b.column(k).to_pylist() for k in keys)))
        start = 0
        for i in range(1, len(tags) + 1):
            if i == len(tags) or tags[i] != tags[start]:
                if parts and tags[start] != key:
                    yield key, parts
                    parts = []
                key = tags[start]
                parts.append(b.slice(start, i - start))
                start = i
    if parts:
        yield key, parts


def _contents(parsed: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, shard, digest, tokens): the contents, each as often as tasks have
    met it; the tokens are compressed for the shuffle."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()            # an entry for each page of the task, at most
        for b in batches:
            take = []
            for i, x in enumerate(zip(b.column("host").to_pylist(), b.column("digest").to_pylist())):
                if x not in seen:
                    seen.add(x)
                    take.append(i)
            new = b.take(pa.array(take, pa.int64()))
            pack = zstd.ZstdCompressor(level=3).compress
            yield pa.RecordBatch.from_arrays(
                [new.column("host"), new.column("digest"),
                 pa.array([pack(" ".join(x).encode()) for x in new.column("blocks").to_pylist()], pa.binary())], ["host", "digest", "tokens"])

    rows = parsed.where("host <> ''").select("host", "digest", "blocks").mapInArrow(once, "host string, digest binary, tokens binary")
    return attach(rows, hosts, ["host"]).select("host", F.pmod(F.xxhash64("digest"), "shards").cast("int").alias("shard"), "digest", "tokens")


def _unpacked(tokens: bytes) -> list[str]:
    """The token stream of a content, as one block."""
    text = zstd.ZstdDecompressor().decompress(tokens).decode()
    return [text] if text else []


def repeated_runs(parsed: DataFrame, run: int, min_pages: int, shard_pages: int) -> DataFrame:
    """(host, gram): the windows of ``run`` tokens that at least ``min_pages``
    and half of a host's contents hold."""
    own = parsed.where("host <> ''").groupBy("host", "digest").agg(F.count("*").alias("pages"))
    hosts = saved(own.groupBy("host").agg(F.count("*").alias("contents"), F.sum("pages").alias("n"))
                  .where(F.col("contents") >= min_pages)
                  .withColumn("shards", F.ceil(F.col("contents") / F.lit(shard_pages)).cast("int")), "html-hosts")
    n = partitions(parsed)
    dealt = _contents(parsed, hosts.select("host", "shards", "n"))

    def half(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows that at least half of a shard's contents hold, and in how many."""
        for (host, _), parts in _groups(batches, ["host", "shard"]):
            at: dict[bytes, tuple[int, int]] = {}
            for k, b in enumerate(parts):
                for i, d in enumerate(b.column("digest").to_pylist()):
                    at.setdefault(d, (k, i))
            pages = [_unpacked(parts[k].column("tokens")[i].as_py()) for k, i in at.values()]
            grams, often = run_counts(pages, run)
            keep = 2 * often >= len(pages)
            yield pa.RecordBatch.from_arrays([pa.array([host] * int(keep.sum()), pa.string()), pa.array(grams[keep].view(np.int64)),
                                              pa.array(often[keep], pa.int64())], ["host", "gram", "often"])

    placed = dealt.repartition(n, "host", "shard").sortWithinPartitions("host", "shard")
    found = saved(placed.mapInArrow(half, "host string, gram long, often long"), "html-windows")
    sized = found.join(hosts, "host")
    enough = F.col("often") >= F.greatest(F.lit(min_pages), F.ceil(F.col("contents") / 2))
    single = sized.where((F.col("shards") == 1) & enough).select("host", "gram")
    # hosts of several shards: what half of one of them holds is counted in all; hosts without such windows are done
    wanted = sized.where("shards > 1").groupBy("host", "shards").agg(F.sort_array(F.collect_set("gram")).alias("grams"))
    ask = wanted.select("host", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(None).cast("binary").alias("digest"),
                        F.lit(None).cast("binary").alias("tokens"), "grams")
    again = hosts.join(wanted.select("host"), "host", "left_semi").select("host", "shards", "n")
    several = _contents(parsed, again).withColumn("grams", F.lit(None).cast("array<long>"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (host, _), parts in _groups(batches, ["host", "shard"]):
            grams = parts[0].column("grams")[0].as_py()         # sorted ahead of the contents
            if not grams:
                continue
            grams, seen = np.sort(np.array(grams, dtype=np.int64).view(np.uint64)), set()
            often = np.zeros(len(grams), dtype=np.int64)
            for b in parts:
                for d, tokens in zip(b.column("digest").to_pylist(), b.column("tokens").to_pylist()):
                    if d is not None and d not in seen:
                        seen.add(d)
                        token, _ = _tokens([_unpacked(tokens)])
                        if len(token) >= run:
                            often += np.isin(grams, _gram_hashes(token, run))
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(grams), pa.string()), pa.array(grams.view(np.int64)),
                                              pa.array(often)], ["host", "gram", "often"])

    both = several.unionByName(ask).repartition(n, "host", "shard").sortWithinPartitions(
        "host", "shard", F.col("digest").isNotNull(), "digest")
    counts = both.mapInArrow(count, "host string, gram long, often long").groupBy("host", "gram").agg(F.sum("often").alias("often"))
    return single.unionByName(counts.join(hosts, "host").where(enough).select("host", "gram"))


def extract(pages: DataFrame, run: int = 8, min_pages: int = 5, shard_pages: int = 512,
            id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text (blocks joined by newlines), n_chars."""
    host = F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).withColumn("host", F.coalesce(host, F.lit("")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            found = [parse(t) for t in strings(part.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("host", "page_id", "url")),
                 pa.array([b for b, _ in found], pa.list_(pa.string())), pa.array([d for _, d in found], pa.bool_()),
                 pa.array([content(b) for b, _ in found], pa.binary())],
                ["host", "page_id", "url", "blocks", "declared", "digest"])

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _groups(batches, ["host", "part"]):
            grams = np.array(parts[0].column("grams")[0].as_py() or [], dtype=np.int64).view(np.uint64)
            for b in parts:
                b = b.filter(pa.array([d is not None for d in b.column("declared").to_pylist()], pa.bool_()))
                if b.num_rows:
                    kept = [without(blocks, declared, grams, run)
                            for blocks, declared in zip(b.column("blocks").to_pylist(), b.column("declared").to_pylist())]
                    texts = ["\n".join(x) for x in kept]
                    yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    parsed = saved(rows.mapInArrow(read, "host string, page_id long, url string, blocks array<string>, declared boolean, digest binary"),
                   "html-parsed", compression="zstd")
    runs = saved(repeated_runs(parsed, run, min_pages, shard_pages), "html-runs")
    named = runs.select("host").distinct()
    # a part of a host has about shard_pages of its pages
    sizes = parsed.groupBy("host").agg(F.count("*").alias("n")).join(named, "host") \
                  .select("host", F.ceil(F.col("n") / F.lit(shard_pages)).cast("int").alias("shards"), "n")
    sizes = saved(sizes, "html-sizes")
    grams = runs.groupBy("host").agg(F.collect_list("gram").alias("grams")).join(sizes, "host")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("page_id", "long"), ("url", "string"), ("blocks", "array<string>"), ("declared", "boolean"))]
    ahead = grams.select("host", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("part"), *none, "grams")
    dealt = attach(parsed.drop("digest"), sizes, ["host"]).select(
        "host", F.pmod(F.xxhash64("page_id", "url", F.size("blocks")), "shards").cast("int").alias("part"), "page_id", "url", "blocks", "declared",
        F.lit(None).cast("array<long>").alias("grams"))
    stripped = (dealt.unionByName(ahead).repartition(partitions(pages), "host", "part")
                .sortWithinPartitions("host", "part", F.col("declared").isNotNull())
                .mapInArrow(strip, "page_id long, url string, text string"))
    whole = parsed.join(named, "host", "left_anti").select("page_id", "url", F.array_join("blocks", "\n").alias("text"))
    return whole.unionByName(stripped).withColumn("n_chars", F.length("text").cast("long"))
