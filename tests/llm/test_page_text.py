"""Main text of pages: markup cases, the suffix array against a plain search, and made pages."""

import html as markup
import random
from collections import Counter

import pytest
from odd_rows import SF, words

from creamline.llm import page_text
from creamline.llm.page_text import blocks_of, main_text

PAGE = "page_id long, url string, html string"


@pytest.mark.parametrize(("page", "text"), [
    ("", ""),
    ("<article><p>A</article>", "A"),
    ("<nav>menu</nav><article><h1> T\n t </h1><p>One<br>two <b>three</b></p><p>a&amp;b &copy</article><footer>f</footer>", "T t\n\nOne two three\n\na&b ©"),
    ("<article><p><b>unclosed<br><p>next</article>", "unclosed\n\nnext"),
    ("<article><header><h1>Own head</h1></header><p>x</p><section id='comments'><p>first!</p></section></article>", "Own head\n\nx"),
    ("<article><p>x</p><aside>side</aside><form>in <input value=a></form><script>var a='<p>no</p>'</script><style>p{}</style></article>", "x"),
    ("<article><p>x</p><div class='ad-box'><div>deep</div> ad</div><p>y</p>", "x\n\ny"),
    ("<article><p>x</p><div class='cookie-notice'>c</div><div class='shadow'>kept</div></article>", "x\n\nkept"),
    ("<main><p>only main</p></main><p>outside</p>", "only main"),
    ("<body><div class='NavBar'>m</div><div><p>free text</p></div></body>", "free text"),
    ("<article><article class='comment'>no</article>yes</article>", "yes"),
    ("<article>a<!-- hidden -->b<p hidden>h</p></article>", "ab"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n\n2\n\n3"),
    ("<article><p>cut", "cut"),
])
def test_markup(page, text):
    assert main_text(blocks_of(page)) == text


def plain_hits(pages):
    """(host, stream words, at) whose next eight words another stream of the host holds too."""
    streams = {(page_text_host(u), tuple(w for t, m in blocks_of(h or "") if m != page_text.ARTICLE for w in page_text._WORDS.findall(t.lower()))) for _, u, h in pages}
    where = {}
    for host, s in streams:
        for at in range(len(s) - page_text.LEAST + 1):
            where.setdefault((host, s[at : at + page_text.LEAST]), set()).add(s)
    return {
        (host, s, at) for host, s in streams for at in range(len(s) - page_text.LEAST + 1)
        if len(where[host, s[at : at + page_text.LEAST]]) > 1
    }


def page_text_host(url):
    return (url or "").split("//")[-1].split("/")[0].lower() if "//" in (url or "") else ""


def made_pages(n=60):
    """Pages of three hosts without an article element; their menu and notice repeat, their bodies do not."""
    rng, out, want = random.Random(1), [], {}
    for i in range(n):
        host = ["big.example", "big.example", "small.example"][i % 3]
        menu, notice = words(len(host), 12), words(100 + len(host), 15)
        # unlike neighbours of the menu and the notice: what is alike there would count as part of the repeat
        body = [f"a{i}x{k} {words(1000 + 3 * i + k, rng.randint(12, 40))} z{i}x{k}" for k in range(3)]
        out.append((i, f"http://{host}/{i}", f"<body><div>{menu}</div><div><p>{body[0]}<p>{body[1]}<div>{body[2]}</div></div><div>{notice}</div>"))
        want[i] = "\n\n".join(body)
    out.append((n, "http://alone.example/", f"<div>{words(5, 30)}</div>"))
    want[n] = words(5, 30)
    return out, want


def test_repeats_of_a_host_leave_its_open_pages(spark):
    pages, want = made_pages()
    got = {r.page_id: r.text for r in page_text.texts(spark.createDataFrame(pages, PAGE)).collect()}
    assert got == want


def test_suffix_array_finds_what_a_plain_search_finds(spark):
    pages, _ = made_pages(21)
    pages += [(100 + i, "http://big.example/x", f"<p>{words(7, 9)} {words(50 + i, 4)}</p>") for i in range(9)] + [pages[0]]
    frame = spark.createDataFrame(pages, PAGE)
    streams = page_text.word_streams(frame)
    hits = page_text.repeated(page_text.suffix_array(streams)).groupBy("page").count().collect()
    plain = Counter((host, s) for host, s, _ in plain_hits(pages))
    assert sorted(r["count"] for r in hits) == sorted(plain.values())


def test_awkward_pages(spark):
    rows = [
        (1, None, None), (None, None, "<p>x</p>"), (2, "odd", ""), (3, "http://h/", "<article>" + "<p>é word</p>" * 20_000 + "</article>"),
        (3, "http://h/", "plain &lt;text&gt;"), (3, "http://h/", "plain &lt;text&gt;"), (4, "http://h/", "<" * 500),
    ]
    frame = spark.createDataFrame(rows, PAGE).selectExpr("*", "'mine' AS host", "1 AS page", "'x' AS text", "2 AS hits")
    got = Counter((r.page_id, r.url, r.text) for r in page_text.texts(frame).collect())
    assert sum(got.values()) == len(rows)
    assert got[(3, "http://h/", "plain <text>")] == 2 and got[(1, None, "")] == 1 and got[(None, None, "x")] == 1
    assert got[(3, "http://h/", "\n\n".join(["é word"] * 20_000))] == 1
    assert page_text.texts(frame.limit(0)).collect() == []


def test_given_pages_give_their_articles(spark):
    frame = spark.read.parquet(f"{SF}/pages.parquet")
    import re

    want = {}
    for r in frame.collect():
        inside = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S).group(1)
        blocks = [" ".join(markup.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        want[r.page_id] = "\n\n".join(b for b in blocks if b)
    got = {r.page_id: r.text for r in page_text.op13_html_extraction(spark, SF).collect()}
    assert got == want


def boxed_pages(n=12):
    """Articles of two hosts with an unmarked note in a box of their own, the same on all of a host, and a copied article."""
    out, want = [], {}
    for i in range(n):
        host = ["big.example", "small.example"][i % 2]
        note, body = words(len(host), 14), [words(2000 + 4 * i + k, 20) for k in range(3)]
        flow = [f"<p>{b}</p>" for b in body]
        flow.insert(i % 4, f"<div class='x7'><p>{note}</p></div>")
        if i % 3 == 0:  # a line that many articles hold beside the note
            flow.insert(i % 4 + 1, f"<p>{words(5, 9)}")
            body.insert(i % 4, words(5, 9))
        out.append((i, f"http://{host}/{i}", f"<nav>{words(9, 12)}</nav><article><h1>Title {i}</h1>{''.join(flow)}</article><footer>{words(i, 9)}</footer>"))
        want[i] = "\n\n".join([f"Title {i}", *body])
    lead, rest, box = words(60, 12), words(61, 30), words(62, 12)
    for k in range(2):  # one article at two addresses, an own ending each; a sidebar shows its lead
        page = f"<article><h1>Copied</h1><div class='lead'>{lead}</div><p>{rest}</p><p>{words(70 + k, 9)}</p><div class='own'>{box}</div><p>{rest}</p></article>"
        out.append((n + k, f"http://big.example/copy/{k}", page))
        want[n + k] = "\n\n".join(["Copied", lead, rest, words(70 + k, 9), box, rest])
    out.append((n + 2, "http://big.example/side", f"<article><p>{words(80, 20)}</p></article><aside>{lead}</aside>"))
    want[n + 2] = words(80, 20)
    return out, want


def test_repeats_of_a_host_leave_unmarked_boxes_of_its_articles(spark):
    pages, want = boxed_pages()
    got = {r.page_id: r.text for r in page_text.texts(spark.createDataFrame(pages, PAGE)).collect()}
    assert got == want


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("others", [0, 1])
def test_a_repeat_needs_other_words_on_both_sides(spark, parts, others):
    rows = spark.range(9000 + others).selectExpr(
        "'h' AS host", "CAST('g' AS BINARY) AS gram", "id AS page", "0 AS at", "true AS open", "CAST(id >= 9000 AS LONG) AS left", "id AS right"
    )
    few = rows.filter("page < 2 OR page >= 9000").withColumn("gram", rows.gram.substr(1, 0))
    both = rows.unionAll(few).repartitionByRange(parts, "host", "gram", "page").sortWithinPartitions("host", "gram", "page", "at")
    assert page_text.repeated(both).count() == 9001 * others


@pytest.mark.parametrize(("page", "marks"), [
    ("<article><p>a b c<div>d</div></article>", [page_text.ARTICLE, page_text.BOX]),
    ("<article><h1>t</h1><div class='body'><p>a b<div class='body'>c</div></div><div>d</div></article>", [page_text.ARTICLE] * 2 + [page_text.BOX] * 2),
    ("<article><div>a</div><div>b</div><div class='x'>c</div><div>d</div></article>", [page_text.ARTICLE] * 2 + [page_text.BOX, page_text.ARTICLE]),
    ("<article><p>a<div class='ad'>b</div><blockquote>c</blockquote></article><div>d</div>", [page_text.ARTICLE, page_text.MARKED, page_text.ARTICLE, page_text.OPEN]),
    ("<article><p>a</p><div>b c</div><section>d</section></article>", [page_text.ARTICLE, page_text.BOX, page_text.BOX]),
    ("<div><article><section>a<article>b b</article>", [page_text.BOX, page_text.ARTICLE]),
])
def test_marks_of_flow_and_boxes(page, marks):
    assert [mark for _, mark in blocks_of(page)] == marks


def test_boxes_without_words_are_kept():
    page = blocks_of("<article>*** --- ***<div>+</div></article>")
    assert page_text._streams("h", page)[1] == {"host": "h/article", "stream": b"", "runs": [], "open": True}
    assert main_text(page) == "*** --- ***\n\n+"
