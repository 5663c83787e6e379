from pyspark.sql import functions as F

from thermocline.llm import html_extract
from thermocline.llm.html_extract import article


def page(k, body, site="a"):
    return f"""<!DOCTYPE html><html><head><title>t{k}</title><script>var t="</p>";x({k})</script><style>p{{}}</style></head><body>
<nav><ul>{''.join(f'<li><a href="/{x}">w{x}</a></li>' for x in range(k % 4))}</ul></nav><!-- c {k} --><div class="ad">buy {k % 3}</div>
<div class="{site}"><h1>Head {k}</h1>{body}</div><div id="comments"><p>nice {k}</p></div><footer>&copy; {site}</footer></body></html>"""


def rows():
    out = [(k, f"http://A.example/{k}", page(k, f"<p>First&nbsp;line {k} &amp; more<p><b>bold</b> text\n here {k}<br>after</p><ul><li>one<li>two</ul>", "story")) for k in range(12)]
    return out + [(100, None, page(1, "<p>alone</p>")), (101, "x", None), (102, "http://b.example/", ""), (103, "http://b.example/", "no tags at all &lt;"), (104, "http://a.example/cut", page(3, "<p>cut here &am", "story").split("</div><div id")[0]), (0, "http://a.example/0", page(0, "<p>again</p>", "story")), (105, "http://c.example/", "<p>" + "long text " * 50_000), (106, "http://d.example", "<body><article><p>in</p><aside>out</aside><form>f</form></article>rest")]


def test_pages(spark):
    frame = spark.createDataFrame([(*r, "old", "s") for r in rows()], "page_id long, url string, html string, text string, slot string")
    out = html_extract.extract(frame)
    assert out.columns == ["page_id", "url", "html", "slot", "text"]
    got = {}
    for r in out.collect():
        got.setdefault(r["page_id"], set()).add(r["text"])
    for k in range(1, 12):
        assert got[k] == {f"Head {k}\n\nFirst line {k} & more\n\nbold text here {k} after\n\none\n\ntwo"}
    assert "Head 0\n\nagain" in got[0] and len(got[0]) == 2
    assert got[101] == {""} and got[102] == {""} and got[103] == {"no tags at all <"}
    assert got[104] == {"Head 3\n\ncut here &am"} and got[106] == {"in"}
    assert got[105] == {" ".join(["long text"] * 50_000)}
    assert html_extract.extract(frame.limit(0)).count() == 0


def slot(spark, pages, path):
    """The first slot found for pages (one host), and the number of path."""
    frame = spark.createDataFrame([("a", p) for p in pages], "host string, html string")
    return int(html_extract.host_slots(frame).first()["slot"].split()[0]), html_extract.path_id(path)


def test_slot_is_deduced(spark):
    found, story = slot(spark, [r[2] for r in rows() if r[0] < 12], "/html/body/div[class=story]")
    assert found == story


def token(path, n, print_, total=None, run=0):
    """A tag at path, or a run of text in it."""
    above, _, label = path.rpartition("/")
    return dict(id=html_extract.path_id(path), run=run, parent=html_extract.path_id(above) if above else 0, label=label, hides=False, n_pages=n, n_total=total or n, print_a=print_, print_b=0, chars=0)


def numbers(*paths):
    return [html_extract.path_id(p) for p in paths]


def test_classes_nest():
    tokens = [token("/html", 9, 1), token("/html/body", 9, 1), token("/html/body/ul/li", 9, 2, 30), token("/html/body/ul/li/div", 9, 2, 30), token("/html/body/ul", 9, 1)]
    assert html_extract.template(tokens) == [(0, numbers("/html", "/html/body", "/html/body/ul")), (*numbers("/html/body/ul"), numbers("/html/body/ul/li", "/html/body/ul/li/div"))]


def test_classes_are_large():
    tokens = [token("/html", 9, 1), token("/html/body", 9, 1), token("/html/body/p", 8, 2), token("/html/body/div", 7, 3), token("/html/body/div", 7, 3, run=5)]
    assert html_extract.template(tokens) == [(0, numbers("/html", "/html/body")), (*numbers("/html/body"), numbers("/html/body/div"))]


def test_hides():
    assert article('<div class="side-bar sidebar">x</div><p>y</p><div role="navigation">z</div><textarea>q', "") == "y"
    assert article("<p>a<script>if (a<b) '</p>'</script>b", "") == "ab"


def layout(outer, k):
    return f"<html><body><div class='top'>Our site</div><{outer} class='post'><h1><a href='/{k}'>Head {k}</a></h1><div class='lead'>Lead {k}</div><div class='entry-content'><p>{f'Body {k} ' * 40}</p></div></{outer.split()[0]}></body></html>"


def test_heading_lead_and_body_are_read(spark):
    rows = [(k + 100 * i, f"http://{i}.example/{k}", layout(outer, k)) for i, outer in enumerate(("article", "div", "section")) for k in range(6)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 18
    for r in got:
        k = r["page_id"] % 100
        assert r["text"] == f"Head {k}\n\nLead {k}\n\n" + " ".join([f"Body {k}"] * 40)


def test_pages_that_are_all_alike_keep_their_text(spark):
    rows = [(k, f"http://a.example/{k}", layout("div", 1)) for k in range(6)]
    got = {r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {"Our site\n\nHead 1\n\nLead 1\n\n" + " ".join(["Body 1"] * 40)}


def test_only_valid_classes_are_template():
    tokens = [token("/html", 9, 1), token("/html/body", 9, 1), token("/html/body/div", 9, 2, 18), token("/html/body/div", 9, 2, 18, run=7), token("/html/body/div/h1", 9, 1)]
    assert html_extract.template(tokens) == [(0, numbers("/html", "/html/body")), (*numbers("/html/body"), numbers("/html/body/div"))]


def test_one_class_a_token_gives_no_slot(spark):
    """Without classes no template is left: the slots come through them."""
    pages = [layout("div", k) for k in range(6)]
    frame = spark.createDataFrame([("a", p) for p in pages], "host string, html string")
    counted = html_extract.occurrences(html_extract.once_each(frame)).where("n_pages >= 3").collect()
    rows_ = [{**r.asDict(), "repeated": 0, "fixed": 0} for r in counted]
    assert html_extract.text_slots(rows_)[0] > 0
    assert html_extract.text_slots([{**r, "print_a": k} for k, r in enumerate(rows_)]) == []


def plain_page(k, comments):
    said = "".join(f"<div class='d1'><span>Reader {k}{j}</span><p>I think that {k} and {j} are {'rather ' * 8} wrong</p></div>" for j in range(comments))
    return f"<html><body><div class='a'><a href='/'>Home</a> Welcome to us</div><div class='c7'>Buy number {k % 3} now, {'cheap ' * 6}</div><h1>Head {k}</h1><div class='b'>" + "".join(f"<p>{f'Body {k} {j} ' * 12}</p>" for j in range(2 + k % 3)) + f"<div class='c8'>Order {k % 2} today</div><p>The end of {k}</p></div><div class='discussion'><div>Said by readers</div>{said}</div><div class='z'>Imprint {k}</div></body></html>"


def test_layout_without_names(spark):
    pages = [(k, f"http://plain.example/{k}", plain_page(k, 1 + k % 4)) for k in range(8)]
    pages += [(100 + k, "http://plain.example/again", plain_page(0, 1)) for k in range(40)]
    got = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(got) == 48
    for r in got:
        k = r["page_id"] if r["page_id"] < 100 else 0
        body = [" ".join([f"Body {k} {j}"] * 12) for j in range(2 + k % 3)]
        assert r["text"] == "\n\n".join([f"Head {k}", *body, f"The end of {k}"]), r["text"]


def test_deep_pages(spark):
    deep = [f"<html><body>{'<div>' * 60_000}<h1>Head {k}</h1><p>{f'Body {k} ' * 30}</p></body></html>" for k in range(3)]
    got = html_extract.extract(spark.createDataFrame([(k, "http://a.example/", p) for k, p in enumerate(deep)], "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {k: f"Head {k}\n\n" + " ".join([f"Body {k}"] * 30) for k in range(3)}


def test_wrappers_with_layout_names_are_read(spark):
    wrappers = ["content with-sidebar", "no-sidebar", "site has-header", "container no-comments", "search-results page", "search", "widget"]
    body = lambda k: f"<h1>Head {k}</h1><p>{f'Body {k} ' * 30}</p><div class='sidebar'>aside {k}</div><div class='site-footer'>foot</div>"
    rows = [(k + 100 * i, f"http://{i}.example/{k}", f"<body><div>Skip</div><div class='{w}'>{body(k)}</div></body>") for i, w in enumerate(wrappers) for k in range(4)]
    rows += [(9000 + k + 100 * i, f"http://w{i}.example/{k}", f"<body><div class='{w}'><article>{body(k)}</article></div></body>") for i, w in enumerate(wrappers) for k in range(4)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    for r in got:
        k = r["page_id"] % 100
        assert r["text"] == f"Head {k}\n\n" + " ".join([f"Body {k}"] * 30), r


def test_marks_of_single_pages():
    assert article("<p class='notice'>a</p>", "") == "a"
    assert article("<body><div class='related'><article>in</article></div><div class='search'>out</div>", "") == "in"
    assert article("<body><article>in</article><div class='comments'><article>said</article></div>", "") == "in"
    assert article("<body><div class='search'>found</div>", "") == "found"
    assert article("<div class='post-comments'>x</div><div class='sidebar-2'>y</div><p>z", "") == "z"


def test_given_pages_without_their_names(spark):
    """The given pages have the same texts when no tag or class names the article, the menu, the advert or the footer."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    plain = F.col("html")
    for a, b in (("<article>", '<div class="q">'), ("</article>", "</div>"), ("<nav>", '<div class="n">'), ("</nav>", "</div>"), ('class="ad"', 'class="c7"'), ("<footer>", '<div class="z">'), ("</footer>", "</div>")):
        plain = F.replace(plain, F.lit(a), F.lit(b))
    hosts = pages.groupBy(html_extract.host_of(F.col("url")).alias("h")).count().where("count >= 3").select("h")
    shared = pages.join(hosts, html_extract.host_of(F.col("url")) == F.col("h"), "left_semi")
    named = {r["page_id"]: r["text"] for r in html_extract.extract(shared).collect()}
    assert named and {r["page_id"]: r["text"] for r in html_extract.extract(shared.withColumn("html", plain)).collect()} == named
