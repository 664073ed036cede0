"""Main text of pages: markup, repeats on a host, and the query against a plain reading of the pages."""

import html
import random
import re

import pytest

from headway.llm import maintext
from headway.llm.maintext import blocks_of, candidates, main_text
from headway.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def text_of(page):
    return main_text(blocks_of(page), [])


def sentence(rng, n=30):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &amp;amp; text", "plain &amp; text"),
        ("<p>a<p>b <b>c</b>d<br>e", "a\n\nb cd e"),
        ("<article><h1>T</h1><p><b>x.<br><p>y</article><p>z", "T\n\nx.\n\ny"),
        ("<article>a<aside>no</aside>b<footer>no</footer></article>", "a\n\nb"),
        ("<header><h1>Site</h1></header><article><header><h1>T</h1></header>x</article>", "T\n\nx"),
        ("<main><p>m</p><div class='comments'><article class=comment>no</article></div></main>", "m"),
        ("<main>no<article>yes</article></main>", "yes"),
        ("<body class='has-sidebar'><div class=sidebar>no</div><div class='post-content'>yes</div>", "yes"),
        ("<article><p>a<div class='advert box'><p>no<p>no</div><p>b<span hidden>no</span>", "a\n\nb"),
        ("<article><p class=notice>no<b>no<p>yes</article>", "yes"),
        ("<article>a<script>var t='</p>';</SCRIPT >b<style>p{}</style><!-- > -- x -->c<!---->d", "abcd"),
        ("<article>a < b &lt;p&gt; &quo &am &amp &nbsp; x\n\ty</article>", "a < b <p> &quo &am & x y"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e<ul><li>f</ul></ul>", "a b\n\nc\n\nd\n\ne\n\nf"),
        ("<article title='a > b'>x</article", "x"),
        ("<article>cut off <a href='/x", "cut off"),
        ("<div><a href=/>Home</a> <a href=/n>News</a></div><div>text <a>link</a></div>", "text link"),
        ("<article><form><input value=x><select><option>no</select></form>a</article>", "a"),
        ("<title>no</title><textarea><p>no</textarea><p>yes<script>unclosed <p>no", "yes"),
        ("<nav>only menus</nav>", ""),
        ("</div></b></article><article></p>a</b>", "a"),
    ],
)
def test_markup(page, text):
    assert text_of(page) == text


def test_strange_pages_in_good_time():
    n = 50_000
    for page in ["<b>" * n + "x" + "</i>" * n, "<p class='ad" * n, "<" * n, "<!--" * n, "&" * n, "<a b=\"" * n, "<div>" * n + "x"]:
        assert isinstance(text_of(page), str)
    assert text_of("<article><p>" + "word " * 500_000) == ("word " * 500_000).strip()


def run(spark, rows):
    out = maintext.with_main_text(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["page_id", "url", "html", "text"]
    return sorted(((r.page_id, r.text) for r in out.collect()), key=repr)


def test_repeats_on_a_host(spark):
    """Without telling markup, what distinct pages of a host share goes; other hosts may have it."""
    rng = random.Random(4)
    menu = "".join(f"<div>{w}</div>" for w in sentence(rng, 14).split())
    notice, rare = sentence(rng, 40), sentence(rng, 20)
    bodies = [[sentence(rng, rng.randint(9, 60)) for _ in range(3)] for _ in range(6)]
    page = lambda b: f"<div>{menu}</div>" + "".join(f"<p>{t}</p>" for t in b) + f"<div>{notice}</div><div>Tail {rng.random()}</div>"
    rows = [(i, f"http://one.example/{i}", page(b)) for i, b in enumerate(bodies[:4])]
    rows += [(4, "http://two.example/", page(bodies[4])), (5, "http://three.example/", f"<p>{rare}</p>")]
    rows += [(6, "http://four.example/", f"<p>{rare}</p>")]
    got = dict(run(spark, rows))
    for i, body in enumerate(bodies[:4]):
        assert got[i].split("\n\n")[:-1] == body and got[i].split("\n\n")[-1].startswith("Tail")
    assert notice in got[4] and got[5] == got[6] == rare


def test_marked_articles_lose_only_what_is_usual_on_the_host(spark):
    rng = random.Random(9)
    passage, notice, quoted = sentence(rng, 30), sentence(rng, 30), sentence(rng, 12)
    rows = []
    for i in range(8):
        inside = (f"<p>{notice}" if i < 6 else "") + (f"<p>{passage}" if i < 3 else "") + (f"<p>{quoted}" if i == 7 else "")
        rows.append((i, "https://h.example/x", f"<article><p>own {i} {sentence(rng, 40)}{inside}</article><aside>{quoted}</aside>"))
    rows += [(i, f"https://{i % 3}.example/", f"<article>{i} {sentence(rng, 40)}<p>{notice}</article>") for i in range(10, 16)]
    for i, text in run(spark, rows):
        assert (notice in text) == (i >= 10) and (passage in text) == (i < 3) and (quoted in text) == (i == 7)
        assert text.startswith("own" if i < 8 else str(i))


def test_copies_and_repeated_rows(spark):
    """Copies of an article are one page: nothing of them is boilerplate."""
    rng = random.Random(2)
    body = "".join(f"<p>{sentence(rng)}</p>" for _ in range(4))
    rows = [(1, "http://h/a", body)] * 3 + [(i, f"http://h/{i}", f"{body}<p>{i}</p>") for i in range(2, 5)]
    got = run(spark, rows)
    assert [t for _, t in got] == [text_of(r[2]) for r in sorted(rows)]


def test_nulls_and_empty_tables(spark):
    rows = [(None, None, None), (1, None, "<p>a"), (1, None, "<p>a"), (2, "not a url", ""), (3, "http://h", None)]
    assert run(spark, rows) == [(1, "a"), (1, "a"), (2, ""), (3, ""), (None, "")]
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "u", "<p>x", "old", 7)], SCHEMA + ", text string, page int")
    assert maintext.with_main_text(df).collect() == [(1, "u", "<p>x", "x", 7)]


def test_suffix_prefixes_cover_every_repeat():
    """Whatever two streams share by whole blocks, 8 words or more, is covered but for less than a block's half."""
    rng = random.Random(7)
    for _ in range(200):
        shared = [sentence(rng, rng.randint(1, 25)) for _ in range(rng.randint(1, 6))]
        if sum(t.count(" ") + 1 for t in shared) < maintext.LONG:
            continue
        pages = ["".join(f"<p>{t}" for t in [sentence(rng, 9), *shared, sentence(rng, 9)]) for _ in range(2)]
        a, b = (list(maintext.suffixes(blocks_of(p))) for p in pages)
        common = {s[0] for s in b}
        covered = set()
        for prefix, _, at, n in a:
            if prefix in common:
                covered |= set(range(at, at + n))
        assert covered == set(range(9, 9 + sum(t.count(" ") + 1 for t in shared)))


def test_repeats_within_longer_blocks(spark):
    """What pages share need not begin or end with a block, nor lie among the open blocks of the other page."""
    rng = random.Random(12)
    shared, quoted, beside = sentence(rng, 30), sentence(rng, 30), sentence(rng, 30)
    around = lambda text: f"{sentence(rng, 9)} {text} {sentence(rng, 9)}"
    own = [sentence(rng, 60) for _ in range(4)]
    rows = [(i, f"http://h.example/{i}", f"<p>{own[i]}<p>{around(shared)}") for i in range(2)]
    rows += [(2, "http://h.example/2", f"<p>{own[2]}<p>{around(quoted)}<p>{around(beside)}")]
    rows += [(3, "http://h.example/3", f"<article><p>{own[3]} {quoted} {own[3]}</article><aside>{around(beside)}</aside>")]
    got = dict(run(spark, rows))
    assert [got[i] for i in range(3)] == own[:3]
    assert got[3] == f"{own[3]} {quoted} {own[3]}"


def test_every_word_begins_a_suffix():
    """Any 8 words that two open streams share are found, wherever in a block, or over blocks, they lie."""
    rng = random.Random(13)
    for _ in range(200):
        shared = sentence(rng, rng.randint(8, 20))
        pages = []
        for _ in range(2):
            at = rng.randint(1, 30)
            words = f"{sentence(rng, at)} {shared} {sentence(rng, rng.randint(1, 30))}".split()
            cuts = {rng.randrange(len(words)) for _ in range(rng.randint(0, 4))}
            pages.append((at, "".join(("<p>" if i in cuts else " ") + w for i, w in enumerate(words))))
        (at, a), (_, b) = pages
        common = {s[0] for s in maintext.suffixes(blocks_of(b))}
        covered = {w for prefix, _, i, n in maintext.suffixes(blocks_of(a)) if prefix in common for w in range(i, i + n)}
        assert covered >= set(range(at, at + shared.count(" ") + 1))


def test_query(spark, sf_dir):
    """The pages' articles hold paragraphs, a heading and line breaks only."""
    got = QUERIES["op13_html_extraction"](spark, sf_dir)
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    want = []
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        parts = [html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))) for p in re.split("</?(?:p|h1)>", article)]
        text = "\n\n".join(" ".join(p.split()) for p in parts if p.strip())
        want.append((r.page_id, r.url, text, len(text)))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert candidates([]) == []
