"""Main text of web pages, with boilerplate found by substrings that a host repeats."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import materialize

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg canvas object xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
SKIPPED = frozenset("head nav footer aside menu button select option dialog audio video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that an element of the same sort ends where its end tag is missing.
CLOSED_BY = {
    "p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"},
}
#: Parts of class names and ids that mark what isn't the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted recommended related replies reply "
    "respond search share sharing sidebar signup site-header skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Parts of names that say what an element has or lacks, not what it is.
ABOUT = frozenset("has have with no not non without hide hides".split())
#: Elements that are the page or its article, whatever parts their names have.
WHOLE = frozenset("html body main".split())
ROLES = frozenset("banner navigation contentinfo complementary search form alert dialog menu menubar".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z|[\"'][^>]*>?)"
    r"|<[!?][^>]*>?",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#\s]+)")


def _named(tag: str, value: str) -> bool:
    """Whether a class or id says that its element isn't the article. An article only is by a
    whole name (``comment``), not by a part of one (``post-with-comments``)."""
    for name in value.split():
        parts = set(re.split(r"[-_]+", name))
        if name in NAMES or (tag != "article" and parts & NAMES and not parts & ABOUT):
            return tag not in WHOLE
    return False


def _zone(tag: str, attrs: str, in_main: bool) -> str:
    """What an element opens: ``skip``, ``name`` (skipped for its name or as a form, unless it
    is most of the page), ``main``, ``head`` (of an article), or nothing new."""
    if tag in SKIPPED:
        return "skip"
    if tag == "header":
        return "head" if in_main else "skip"
    role = ""
    named = tag == "form"
    if attrs.strip(" /"):
        for name, *values in ATTRIBUTE.findall(attrs):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id"):
                named = named or _named(tag, value)
            elif name == "role":
                role = value
                if value in ROLES:
                    return "skip"
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                return "skip"
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return "skip"
            elif name == "itemprop" and value == "articlebody":
                role = "main"
    if named:
        return "name"
    return "main" if tag in ("article", "main") or role == "main" else ""


def blocks(page: str) -> list[tuple[str, str]]:
    """The page's blocks as (zone, text): ``main`` inside of a declared article, ``skip`` in
    anything that declares itself not to be one, ``open`` elsewhere. References are decoded and
    white space is one space; empty blocks are left out.

    An element that only its name or its being a form speaks against is skipped unless it holds
    more than half of the page's words, and declared articles outside of it less than a tenth
    of its own."""
    out: list[tuple[str, str, tuple[int, ...]]] = []  # with the named elements around
    stack: list[tuple[str, str]] = []  # tag, zone it opened
    zones = {"skip": 0, "name": 0, "main": 0, "head": 0, "heading": 0}
    named: list[int] = []  # open elements with a name against them, by number
    numbers = 0
    text: list[str] = []

    def flush() -> None:
        if text:
            words = "".join(text).split()
            text.clear()
            if words:
                skipped = zones["skip"] or (zones["head"] and not zones["heading"])
                out.append(("skip" if skipped else "main" if zones["main"] else "open", " ".join(words), tuple(named)))

    def pop_to(depth: int) -> None:
        for _, zone in stack[depth:]:
            if zone:
                zones[zone] -= 1
            if zone == "name":
                named.pop()
        del stack[depth:]

    at, size = 0, len(page)
    while at < size:
        m = MARKUP.search(page, at)
        if m is None:
            text.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            text.append(html.unescape(page[at : m.start()]))
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            flush()
        elif tag == "br":
            text.append(" ")
        if m["end"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
            continue
        if tag in RAW:
            if not m["attrs"].endswith("/") or tag in ("script", "style"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
                at = close.end() if close else size
            continue
        for depth in range(len(stack) - 1, -1, -1):
            if tag in CLOSED_BY.get(stack[depth][0], ()):
                pop_to(depth)
                break
            if stack[depth][0] in BLOCK and stack[depth][0] not in CLOSED_BY:
                break
        if tag in VOID or m["attrs"].endswith("/"):
            continue
        zone = _zone(tag, m["attrs"], zones["main"] > 0)
        if not zone and tag in HEADINGS:
            zone = "heading"
        if zone:
            zones[zone] += 1
        if zone == "name":
            numbers += 1
            named.append(numbers)
        stack.append((tag, zone))
    flush()
    if not numbers:
        return [(z, t) for z, t, _ in out]
    sizes = [(z, t.count(" ") + 1, set(inside)) for z, t, inside in out if z != "skip"]
    total = sum(n for _, n, _ in sizes)
    held: dict[int, int] = {}
    for _, n, inside in sizes:
        for k in inside:
            held[k] = held.get(k, 0) + n
    most = {k for k, n in held.items() if 2 * n > total and 10 * sum(m for z, m, inside in sizes if z == "main" and not inside) < n}
    return [(z if most.issuperset(inside) else "skip", t) for z, t, inside in out]


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


def suffix_keys(host: str, tokens: list[str], least: int) -> list[int]:
    """The first ``least`` tokens of each suffix of a stream, as keys within the host. Two
    suffixes share a key where their common prefix is that long; a shorter stream has one key."""
    starts = range(max(1, len(tokens) - least + 1)) if tokens else ()
    seed = xxhash.xxh64_intdigest(host)
    return [_signed(xxhash.xxh64_intdigest("\x1f".join(tokens[i : i + least]), seed)) for i in starts]


PARSED = "page_id long, url string, host long, content long, has_main boolean, text string, open array<string>, keys array<long>"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def article_of(found: list[tuple[str, str]]) -> tuple[list[str], list[str], list[str]]:
    """A page's declared article, the blocks that have to be told apart without one, and the
    other blocks that its host's repetition is looked for in. A declared article with less than
    a quarter of the words that nothing speaks against outside of it is a teaser beside the
    text, so such a page has none."""
    words = {z: sum(t.count(" ") + 1 for y, t in found if y == z) for z in ("main", "open")}
    if words["main"] and 4 * words["main"] >= words["open"]:
        return [t for z, t in found if z == "main"], [], [t for z, t in found if z != "main"]
    return [], [t for z, t in found if z != "skip"], []


def parse_pages(pages: DataFrame, least: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("host", "content", "has_main", "text", "open", "keys")}
            for url, page in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                found = blocks(page or "")
                main, rest, around = article_of(found)
                host = host_of(url)
                out["host"].append(_signed(xxhash.xxh64_intdigest(host)))
                out["content"].append(_signed(xxhash.xxh64_intdigest("\n".join(t for z, t in found if z != "skip"))))
                out["has_main"].append(bool(main))
                out["text"].append("\n".join(main) if main else None)
                out["open"].append(None if main else rest)
                out["keys"].append(suffix_keys(host, [w for t in around or rest for w in t.split(" ")], least))
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()))
            cols = [pa.array(v, t) for v, t in zip(out.values(), kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["page_id", "url", *out])

    picked = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return picked.mapInArrow(run, PARSED)


def repeated_keys(parsed: DataFrame, share: float, pages: int, most_sent: int = 1_000_000) -> DataFrame:
    """``(key)``: suffix keys that at least ``pages`` pages of different content of a host have,
    and the ``share`` of its different contents. Copies of a page count once, so they don't make
    their own text boilerplate. Pages are counted by partial aggregates."""
    hosts = parsed.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("contents"))
    rows = parsed.select("host", "content", F.explode(F.array_distinct("keys")).alias("key")).distinct()
    counts = rows.groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= pages)
    hosts = hosts.where(F.col("contents") >= pages)
    hosts = F.broadcast(hosts) if hosts.limit(most_sent + 1).count() <= most_sent else hosts.hint("merge")
    return counts.join(hosts, "host").where(F.col("n") >= share * F.col("contents")).select("key")


def unique_runs(texts: list[str], covered: set[int], least: int) -> str:
    """The blocks without their covered tokens. ``covered`` holds the suffixes whose first
    ``least`` tokens are repeated. A run of covered tokens counts in a block if it is that long
    there or is the whole block; such runs go where they make up half of the block, so that
    running text keeps a phrase or a quotation that others have too."""
    gone: set[int] = {i for s in covered for i in range(s, s + least)}
    out, at = [], 0
    for t in texts:
        words = t.split(" ")
        runs: list[tuple[bool, list[str]]] = []
        for k, w in enumerate(words):
            hit = at + k in gone
            if not runs or runs[-1][0] != hit:
                runs.append((hit, []))
            runs[-1][1].append(w)
        at += len(words)
        if len(runs) == 1:
            out += [t] * (not runs[0][0])
            continue
        # a repeated run counts in a block only by its tokens there: it may begin in another
        lost = [r for hit, r in runs if hit and len(r) >= least]
        if 2 * sum(map(len, lost)) < len(words):
            out.append(t)
            continue
        out.append(" ".join(w for hit, r in runs if not hit or len(r) < least for w in r))
    return "\n".join(out)


def extract(pages: DataFrame, least: int = 8, share: float = 0.02, support: int = 3, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars, repeated_tokens)`` for every row.

    A host's suffix array over the token streams of its pages is kept in shards: suffixes meet
    by host and their first ``least`` tokens, so equal keys are an interval of the array with
    common prefixes of that length. An interval with suffixes of ``support`` pages of different
    content, and of the ``share`` of the host's contents, marks boilerplate. The streams are
    what no page declares to be its article. Text in a declared article is the page's text,
    without the parts that declare themselves menus, notices, comments and the like, and isn't
    removed for being repeated: articles quote each other. A page without a declared article
    gives its remaining blocks without the runs that its host repeats.

    Null or empty pages give an empty text; a null url is a host of its own; repeated rows,
    null ids and broken markup are handled row by row; very long pages are one row's work; an
    empty table gives none. ``repeated_tokens`` counts what the host's repetition removed.
    """
    parsed = materialize(parse_pages(pages, least, id_col, url_col, html_col), "pages").withColumn("row", F.monotonically_increasing_id())
    done = parsed.where("has_main").select("page_id", "url", "text", F.lit(0).cast("long").alias("repeated_tokens"))
    loose = materialize(parsed.where("not has_main").select("row", "page_id", "url", "open", "keys"), "loose")
    keys = materialize(repeated_keys(parsed, share, support), "keys")
    # a run on very many pages is one key on one side and many rows on the other, which
    # adaptive execution splits
    places = loose.select("row", F.posexplode("keys").alias("place", "key"))
    hits = places.join(keys, "key", "left_semi").groupBy("row").agg(F.collect_list("place").alias("places"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lost = [], []
            for open_blocks, places in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                before = sum(t.count(" ") + 1 for t in open_blocks or ())
                texts.append(unique_runs(open_blocks or [], set(places or ()), least))
                lost.append(before - sum(t.count(" ") + 1 for t in texts[-1].split("\n") if t))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(lost, pa.int64())], names=["page_id", "url", "text", "repeated_tokens"])

    rest = loose.join(hits, "row", "left").select("page_id", "url", "open", "places")
    rest = rest.mapInArrow(finish, "page_id long, url string, text string, repeated_tokens long")
    both = done.unionByName(rest)
    return both.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "repeated_tokens")
