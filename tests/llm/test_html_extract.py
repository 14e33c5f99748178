import random
import time
import html as entities
import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

from valuescope.llm import html_extract as he


def _article(page):
    """Text of a page that marks its article and has only flat paragraphs in it."""
    inside = re.search(r"<article>(.*?)(?:</article>|<\w*$|</\w*$|$)", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)(?:>|$)", inside)
    lines = [" ".join(entities.unescape(re.sub(r"<[^>]*>|<[^>]*$", " ", b)).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_equals_plain_reading_of_the_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in he.extract(pages).collect()}
    wanted = {r["page_id"]: _article(r["html"]) for r in pages.collect()}
    assert got == {k: (t, len(t)) for k, t in wanted.items()}


LONG = "This paragraph of the article is long enough to be a surge in the distribution of text lengths."


def test_boilerplate_goes_and_the_article_stays():
    page = f"""<html><head><title>T</title></head><body class="has-sidebar">
    <header><h2>Site</h2></header><div id="top-menu"><p>Menu one</p></div>
    <div class="cookie-notice">{LONG}</div><div class='content'><h1>Head &amp; tail</h1><p>{LONG}</p><p>Short.</p>
    <div class="ad-box">{LONG}</div><form><p>{LONG}</p></form><ul><li>one &lt;1&gt;<li>two&nbsp;&#x41;</ul><p>{LONG} 2</div>
    <section id="comments"><p>{LONG}</p></section><aside>{LONG}</aside><script>var x = "<p>{LONG}</p>"</script>
    <footer>{LONG}</footer></body></html>"""
    assert he.main_text(page).split("\n") == ["Head & tail", LONG, "Short.", "one <1>", "two A", LONG + " 2"]


def test_surge_and_dive_without_any_marks():
    links = "".join(f"<div><a href=x>Link number {i} of the page</a></div>" for i in range(9))
    page = f"<div>Home</div>{links}<h1>Title</h1><p>{LONG}</p><p>Tiny.</p><p>{LONG}</p>{links}<div>End</div>"
    assert he.main_text(page) == f"Title\n{LONG}\nTiny.\n{LONG}"


def test_short_lines_inside_an_article_without_marks_stay():
    links = "".join(f"<div><a href=x>Link number {i} of the page</a></div>" for i in range(9))
    lists = {
        "items": [f"item {i}" for i in range(40)], "six": [f"item {i}" for i in range(6)],
        "verse": [f"line {i} of a verse" for i in range(12)],
    }
    for short in lists.values():
        for tag in ("li", "td", "p", "div"):
            items = "".join(f"<{tag}>{x}</{tag}>" for x in short)
            page = f"{links}<h1>Title</h1><p>{LONG}</p>{items}<p>{LONG} 2</p>{items}<p>{LONG} 3</p>{links}<p>{LONG} 4</p>"
            assert he.main_text(page).split("\n") == ["Title", LONG, *short, LONG + " 2", *short, LONG + " 3"]


def test_odd_markup():
    cases = {
        None: "", "": "", "plain text": "plain text", "<p>tiny": "tiny", "<!-- x": "", "<p title=\"a>b\">q</p>": "q",
        "<div class='cookie-wrap'><main><p>in</p></main></div>": "in", "<article><p>a<br>b  c\n d</p></article><p>x</p>": "a b c d",
        "<article>1 < 2 &amp &am</article>": "1 < 2 & &am", "<article><article class=comment>no</article>yes</article>": "yes",
        "<article><p>whole<p>cut</arti": "whole\ncut", "<article><style>p{}</style><script>if (a<b) {}</script>t</article>": "t",
        "<article><pre>a\n  b</pre></article>": "a b", "<ARTICLE><P CLASS=NOTICE>n<P>t</ARTICLE>": "t",
    }
    assert {k: he.main_text(k) for k in cases} == cases


def test_very_long_pages_and_awkward_rows(spark):
    many = "<article>" + "".join(f"<p>paragraph {i} of many</p>" for i in range(20_000)) + "</article>"
    schema = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType()),
                         StructField("text", StringType()), StructField("_k", StringType())])
    rows = spark.createDataFrame([(1, "u", many, "x", "y"), (1, "u", many, "x", "y"), (2, None, "", "x", "y"),
                                  (None, None, None, None, None)], schema)
    got = he.extract(rows)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by = sorted((r["page_id"] or 0, r["n_chars"], r["text"].count("\n")) for r in got.collect())
    assert by[0] == (0, 0, 0) and by[1] == by[2] and by[1][2] == 19_999 and by[3] == (2, 0, 0)
    assert he.extract(rows.limit(0)).count() == 0


def test_text_of_a_marked_article_is_not_lost():
    page = ('<article><h2 class="section-header">Title here</h2><p>First paragraph.</p><div class="related-work"><p>Related '
            'work section.</p></div><math>x+1</math><div class="ad">Buy</div><p>End</p></article><p>Outside.</p>')
    assert he.main_text(page) == "Title here\nFirst paragraph.\nRelated work section.\nx+1\nEnd"
    links = "".join(f"<p><a href=x>Link {i}</a></p>" for i in range(9))
    assert he.main_text(f"<p>{LONG}</p><article><p>a</p>{links}<p>b</p></article>{links}<article>c</article>").split("\n") == [
        "a", *(f"Link {i}" for i in range(9)), "b", "c"]


def test_short_lines_after_the_last_surge_stay():
    links = "".join(f"<p><a href=x>Link number {i}</a></p>" for i in range(9))
    for tail in (["one", "two", "three"], [f"item {i}" for i in range(30)]):
        items = "".join(f"<p>{x}</p>" for x in tail)
        assert he.main_text(f"{links}<p>{LONG}</p><p>{LONG}</p>{items}").split("\n") == [LONG, LONG, *tail]
        assert he.main_text(f"{items}<p>{LONG}</p>{links}{items}").split("\n") == [*tail, LONG]


def _plain(lines, window=3, surge=90, gap=4):
    """The method over (text, is link text) lines, by trying every stretch border."""
    weight = [0 if link else len(t) for t, link in lines]
    high = [i for i in range(len(lines)) if sum(weight[max(0, i - window // 2):i + window // 2 + 1]) >= surge]
    if not high:
        return [t for (t, _), w in zip(lines, weight) if w]
    groups = [[high[0], high[0]]]
    for a, b in zip(high, high[1:]):
        between = weight[a + 1:b]
        zeros = max((len(z) for z in "".join("01"[w > 0] for w in between).split("1")), default=0)
        if len(between) >= gap and (zeros > gap or 2 * between.count(0) > len(between)):
            groups.append([b, b])
        groups[-1][1] = b
    first, last = max(groups, key=lambda g: sum(weight[g[0]:g[1] + 1]))
    inside = [i for i in range(first, last + 1) if weight[i]]
    first, last = inside[0], inside[-1]
    while near := [i for i in range(max(0, first - gap), first) if weight[i]]:
        first = near[0]
    while near := [i for i in range(last + 1, min(len(lines), last + gap + 1)) if weight[i]]:
        last = near[-1]
    return [t for t, _ in lines[first:last + 1]]


def test_pages_without_marks_equal_the_plain_method():
    rng = random.Random(12)
    for n in range(300):
        made = [("w" * rng.choice([3, 12, 40, 95, 200]) + str(i), rng.random() < rng.choice([0.1, 0.5])) for i in range(rng.randrange(1, 40))]
        html = "".join(f"<p><a href=x>{t}</a></p>" if link else f"<div>{t}</div>" for t, link in made)
        assert he.main_text(html).split("\n") == (_plain(made) or [""]), n


def test_deep_nesting_takes_linear_time():
    begin = time.process_time()
    assert he.main_text("<div>x" * 100_000).count("x") == 100_000
    assert he.main_text("<div class=ad><article>y" + "</b></i>" * 50_000 + "<section>" * 50_000) == "y"
    assert time.process_time() - begin < 8
