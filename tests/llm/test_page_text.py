import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm.page_blocks import read_page
from millrace.llm.page_text import LEAST_PAGES, extract_text, main_text, templates
from millrace.llm.queries import QUERIES

COLUMNS = "page_id long, url string, html string, host string, text int"


def alone(source):
    return main_text(read_page(source), frozenset(), frozenset())


def prose(rng, n):
    return " ".join(rng.choice("ab cd efg hij klmn opq rstu".split()) + str(rng.randrange(90)) for _ in range(n)).capitalize() + "."


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a<b>b</b>c <i>d</i>\n e&nbsp;f</p>", "abc d e f"),
    ("<article><h1>T&amp;T</h1><p>one<p>two<br>three</article>", "T&T one two three"),
    ("<body><nav>menu</nav><header>top</header><article><header><h1>T</h1></header>x</article><footer>f</footer>", "T x"),
    ("<article>a<!-- no <p>x</p> -->b<script>var t='</p>';</script>c</article>", "abc"),
    ("<article><p>a &lt; b < c &#233;&#xe9; &copy</p><style>p{}</style></article>", "a < b < c éé ©"),
    ("<article><p>x</p><div class='ad'>buy</div><div id='comments'><p>reader</p></div><p>y</p></article>", "x y"),
    ("<article><p>x</p><form><p>name</p><input></form><aside>side</aside><p hidden>no</p></article>", "x"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one two a b"),
    ("<article><p>cut off <a hre", "cut off"), ("<article><p title='x>y'>quoted</p></article>", "quoted"),
    ('<article><p title="x>lone quote</p></article>', "lone quote"),
    ("<body class='has-sidebar'><main><p>x</p></main><div role='complementary'>y</div>", "x"),
    ("<div><p>Long text of the page, in a sentence.</p></div><div><a href=x>link one</a> <a href=y>link two</a></div>", "Long text of the page, in a sentence."),
])
def test_a_page_by_itself(source, text):
    assert alone(source) == text


def test_deep_and_broken_pages():
    assert alone("<div>" * 3000 + "deep" + "</div>" * 10) == "deep"
    assert alone("</p></div><<<>>><p <p>x</nope></p>") is not None
    assert alone("<p>" + "w " * 200_000 + "</p>") == " ".join(["w"] * 200_000)


def unmarked(rng, i, host, text):
    """A page without telling names: a template around the text."""
    links = "".join(f'<li><a href="/{rng.randrange(99)}">{prose(rng, 2)}</a></li>' for _ in range(6))
    return (
        f'<html><body><div class="x1"><p>Welcome to {host}, the best of all sites.</p></div><div class="x2"><ul>{links}</ul></div>'
        f'<div class="x3"><p>Published by the staff of {host}</p>{"".join(f"<p>{t}</p>" for t in text)}<p>Did you like this text?</p></div>'
        f'<div class="x4"><p>{prose(rng, 3)}</p><p>All rights reserved.</p></div></body></html>'
    )


@pytest.fixture(scope="module")
def site():
    rng = random.Random(4)
    rows, expected = [], {}
    for i in range(120):
        host = f"h{i % 3}.example"
        text = [prose(rng, rng.randrange(20, 60)) for _ in range(rng.randrange(1, 6))]
        rows.append((i, f"http://{host.upper()}/p{i}", unmarked(rng, i, host, text), "clash", 1))
        expected[i] = " ".join(text)
    return rows, expected


def test_template_of_unmarked_pages(spark, site):
    rows, expected = site
    got = extract_text(spark.createDataFrame(rows, COLUMNS))
    assert got.columns == ["page_id", "url", "text"]
    assert {r["page_id"]: r["text"] for r in got.collect()} == expected


def test_classes_against_whole_vectors(spark, site):
    """The template's texts are those whose vector over the pages is that of an element."""
    rows, _ = site
    pages = [(url.split("/")[2].lower(), read_page(source)) for _, url, source, _, _ in rows]
    expected = {}
    for host in {h for h, _ in pages}:
        mine = [p for h, p in pages if h == host]
        texts, tags = defaultdict(Counter), defaultdict(Counter)
        for i, page in enumerate(mine):
            for b in page.blocks:
                texts[b.token()][i] += 1
            for path, n in page.paths.items():
                tags[path][i] += n
        often = [v for v in tags.values() if len(v) >= LEAST_PAGES and 2 * len(v) > len(mine)]
        expected[host] = {t for t, v in texts.items() if v in often and 2 * len(v) > len(mine)}
        assert len(expected[host]) == 4
    frame = spark.createDataFrame(rows, COLUMNS).select(F.xxhash64(F.lower(F.split("url", "/")[2])).alias("host"), "html")
    names = {r[0]: r[1] for r in spark.createDataFrame([(h,) for h in expected], "h string").select(F.xxhash64("h"), "h").collect()}
    got = {names[r["host"]]: {x % (1 << 64) for x in r["fixed"]} for r in templates(frame).collect()}
    assert got == expected


def test_copies_are_not_a_template(spark):
    rng = random.Random(5)
    text = [prose(rng, 40), prose(rng, 30)]
    body = "<html><body><nav>m</nav><article>" + "".join(f"<p>{t}</p>" for t in text) + "</article></body></html>"
    rows = [(i, "http://copies.example/", body, None, None) for i in range(50)]
    rows += [(100 + i, "http://copies.example/", body.replace("<article>", f"<article><h1>{i}</h1>"), None, None) for i in range(50)]
    for row in extract_text(spark.createDataFrame(rows, COLUMNS)).collect():
        number = f"{row['page_id'] - 100} " if row["page_id"] >= 100 else ""
        assert row["text"] == number + " ".join(text)


def test_joined_templates(spark, site, monkeypatch):
    rows, expected = site
    monkeypatch.setattr("millrace.llm.page_text.BROADCAST_BYTES", -1)
    got = extract_text(spark.createDataFrame(rows, COLUMNS))
    assert {r["page_id"]: r["text"] for r in got.collect()} == expected


def test_odd_pages(spark):
    rows = [(None, None, None, None, None), (1, None, "<p>x</p>", "h", 2), (1, None, "<p>x</p>", "h", 2), (2, "no scheme", "", None, None),
            (3, "http://a/", "<p>" + "long " * 50_000 + "</p>", None, 3), (4, "http://a/", "   ", None, None)]
    got = sorted((str(r["page_id"]), r["text"][:9]) for r in extract_text(spark.createDataFrame(rows, COLUMNS)).collect())
    assert got == [("1", "x"), ("1", "x"), ("2", ""), ("3", "long long"), ("4", ""), ("None", "")]
    assert extract_text(spark.createDataFrame([], COLUMNS)).count() == 0


def test_query(spark, sf):
    rows = {r["page_id"]: r for r in QUERIES["op13_main_text"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert rows.keys() == {p["page_id"] for p in pages}
    for page in pages:
        inside = page["html"].split("<article>")[1].split("</article>")[0]
        whole = " ".join(b.text for b in read_page(f"<p>{inside}").blocks)
        assert rows[page["page_id"]]["text"] == whole
        assert rows[page["page_id"]]["n_chars"] == len(whole)
