import random

import pytest
from pyspark.sql import types as T

from gridloom.llm.html_extract import article_of, blocks, extract, host_of, suffix_keys, unique_runs

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("page_id", T.LongType()), ("url", T.StringType()), ("html", T.StringType()), ("text", T.StringType()), ("row", T.LongType()))])


def main_text(page):
    main, rest, _ = article_of(blocks(page))
    return "\n".join(main or rest)


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""),
        ("plain  text &amp; more&#33;", "plain text & more!"),
        ("<article><h1>T&eacute;</h1><p><b>a\n b<br>c<p>d <i>e</i>f</article><footer>x</footer>", "Té\na b c\nd ef"),
        ("<nav>m</nav><div class='top-ad'>buy</div><main><p>a<aside>s</aside><p>b<div id=comments>c</div></main>", "a\nb"),
        ("<article>a<script>var t='</p></article>';</script><style>p{}</style>b<!-- c --></article>d", "ab"),
        ("<article><header><h2>Title</h2><p>by me</header><p>x</article>", "Title\nx"),
        ("<body><p>one<p>two<form>no</form><ul><li>three<li>four</ul>", "one\ntwo\nthree\nfour"),
        ("<article><p class=notice>n<p>a &lt;b&gt; &am</article", "a <b> &am"),
        ("<div role=navigation>n</div><div hidden>h</div><div style='display: none'>i</div><p>x < y", "x < y"),
        ("<ARTICLE><P>a</P></NAV></ARTICLE>", "a"),
        ("<p title='a>b'>c</p><p title=\"un>closed>d", "c\nclosed>d"),
    ],
)
def test_blocks(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize(
    "page,want",
    [
        ("<body class='no-sidebar'><p>the text", "the text"),
        ("<html class='login'><body id=search><main class='content has-sidebar'><p>the text</main>", "the text"),
        ("<article class='post has-comments'>the text</article>", "the text"),
        ("<article class='post-comments-open'>the text</article>", "the text"),
        ("<div class='with-sidebar'><p>the text</div><p>and more of it here", "the text\nand more of it here"),
        ("<p>about<div class='social-policy'><h1>policy</h1><p>a long text of it</div>", "about\npolicy\na long text of it"),
        ("<body><form><p>a plain page<div class=ad>buy</div></form>", "a plain page"),
        ("<main><p>a b c d<div class='comments-area'>one two three four five six</div></main>", "a b c d"),
        ("<p>a sentence with <a class='social-link'>a link</a> in it", "a sentence with a link in it"),
    ],
)
def test_names_do_not_hide_the_page(page, want):
    assert main_text(page) == want


def test_hosts():
    assert [host_of(u) for u in ("https://A.b.c:80/x", "//h/p", "http://u:p@h.org?q", None, "nonsense")] == ["a.b.c", "h", "h.org", "", ""]


def test_shared_keys_are_common_prefixes():
    a, b = "x a b c d e f g h y".split(), "z a b c d e f g h w".split()
    same = set(suffix_keys("h", a, 8)) & set(suffix_keys("h", b, 8))
    assert len(same) == 1 and not set(suffix_keys("h", a, 8)) & set(suffix_keys("g", b, 8))
    assert unique_runs(["a b c d", "e f g h i j k l m n"], {0}, 6) == "e f g h i j k l m n"


def test_host_boilerplate(spark):
    menu = "home news sport weather shop about contact help imprint privacy"
    page = lambda t: f"<body><div>{menu}</div><div>{t}</div><div>all rights reserved by the owners of this very site forever</div>"
    own = [f"story number {i} tells " + " ".join(f"thing{i}x{k}" for k in range(9 + i)) + " of the year" for i in range(4)]
    rows = [(i, f"http://h.org/{i}", page(t), "clash", 1) for i, t in enumerate(own)]
    rows += [(10, "http://other.org/", page("lonely page with its own text here"), None, None), (11, None, None, None, None), (12, "http://h.org/x", "", None, None)]
    rows += [(13, "http://copy.org/1", page("the same story on two pages of a host"), None, None), (14, "http://copy.org/2", page("the same story on two pages of a host"), None, None), (None, "u", "<p>x", None, None)]
    got = {r["page_id"]: r for r in extract(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for i, t in enumerate(own):
        assert got[i]["text"] == t and got[i]["n_chars"] == len(t) and got[i]["repeated_tokens"] == 21
    assert got[10]["text"].split("\n")[1] == "lonely page with its own text here" and menu in got[10]["text"]
    assert got[11]["text"] == got[12]["text"] == "" and got[None]["text"] == "x"
    assert "the same story on two pages of a host" in got[13]["text"] and got[13]["text"] == got[14]["text"]
    assert extract(spark.createDataFrame([], SCHEMA)).collect() == []


def plain_extract(rows, least, share, support):
    """Every token string of every page compared with those of all pages of its host."""
    pages = {}
    for i, url, page in rows:
        found = blocks(page or "")
        main, rest, around = article_of(found)
        stream = [w for t in around or rest for w in t.split(" ")]
        pages[i] = (host_of(url), main, rest, stream, tuple(t for z, t in found if z != "skip"))
    out = {}
    for i, (host, main, rest, stream, _) in pages.items():
        others = [(set(tuple(s[k : k + least]) for k in range(max(1, len(s) - least + 1))), content) for h, _, _, s, content in pages.values() if h == host]
        contents = len({c for _, c in others})
        gone = set()
        for k in range(max(1, len(stream) - least + 1)):
            n = len({c for held, c in others if tuple(stream[k : k + least]) in held})
            if stream and n >= support and n >= share * contents:
                gone |= set(range(k, k + least))
        kept, at = [], 0
        for t in [] if main else rest:
            words = t.split(" ")
            hit = [at + k in gone for k in range(len(words))]
            at += len(words)
            runs = [0] * len(words)  # length of the covered run around each word
            for k in range(len(words)):
                lo = hi = k
                while hit[k] and lo > 0 and hit[lo - 1]:
                    lo -= 1
                while hit[k] and hi + 1 < len(words) and hit[hi + 1]:
                    hi += 1
                runs[k] = hi - lo + 1 if hit[k] else 0
            lost = [r >= least or r == len(words) for r in runs]
            if 2 * sum(lost) < len(words):
                lost = [False] * len(words)
            if not all(lost):
                kept.append(" ".join(w for w, x in zip(words, lost) if not x))
        out[i] = "\n".join(main or kept)
    return out


@pytest.mark.parametrize("share", [0.02, 0.15])
def test_against_all_pairs_of_pages(spark, share):
    rng = random.Random(5)
    phrases = [" ".join(rng.choice("abcdef") + rng.choice("gh") for _ in range(rng.randint(1, 9))) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choice(phrases) if rng.random() < 0.6 else f"w{i}x{rng.randint(0, 99)}" for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 5))]
        tag = rng.choice(["div", "p", "li", "article", "nav"])
        page = None if i % 17 == 0 else "".join(f"<{tag}>{t}</{tag}>" for t in parts)
        rows.append((i, f"http://h{i % 3 if i % 2 else 0}.org/{i}", page))
    rows += [(100 + i, r[1], r[2]) for i, r in enumerate(rows[:9])]  # copies
    want = plain_extract(rows, 4, share, 3)
    got = extract(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3), least=4, share=share).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert sum(r["repeated_tokens"] > 0 for r in got) > 10


def test_two_pages_are_no_boilerplate(spark):
    rows = [(i, "http://h.org/", f"<p>the very same story told by two pages of this host with {i} changes", None, None) for i in range(2)]
    rows += [(10 + i, "http://h.org/", f"<p>nothing in common {i}", None, None) for i in range(5)]
    assert all(r["repeated_tokens"] == 0 for r in extract(spark.createDataFrame(rows, SCHEMA)).collect())


def test_teasers_are_no_article():
    page = "<div><p>the long text of the page is here and goes on for many words<p>and on and on it goes</div><article>read more</article>"
    assert main_text(page).split("\n")[0].startswith("the long text") and "read more" in main_text(page)


def test_articles_may_quote_each_other(spark):
    quote = "a long passage that both of the articles on this host have word by word in common"
    rows = [(i, f"http://q.org/{i}", f"<nav>menu</nav><article><p>{quote}</p><p>own {i}</p></article>", None, None) for i in range(3)]
    for r in extract(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r["text"] == f"{quote}\nown {r['page_id']}"
