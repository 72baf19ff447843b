import random
import time

from tidemark.llm import site_style
from tidemark.llm.site_style import Page, extract

SCHEMA = "page_id bigint, url string, html string, text string, nodes string"


def text(source):
    return "\n".join(Page(source).main(set()))


def test_article_without_what_surrounds_it():
    page = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
    <!-- c --><div class="ad">Buy</div><article class="post"><header><h1>Title &amp; more</h1></header><p>One<br>two <b>bold</b>
      text&nbsp;end<p>Second &lt;p&gt; &copy;<ul><li>a<li>b</ul><aside>side</aside><form><input>Name</form><blockquote>said</blockquote>
    <section id="comments"><h2>Comments</h2><p>first!</p></section></article><div class="sidebar">s</div><footer>foot</footer>"""
    assert text(page) == "Title & more\nOne two bold text end\nSecond <p> ©\na\nb\nsaid"


def test_odd_pages():
    assert text("") == "" and text("plain  text &amp; more") == "plain text & more"
    assert text("<p>a < b and <p>c") == "a < b and\nc"
    assert text("<article><p>cut <b>off <a hre") == "cut off"
    assert text("<article><p>x</article></div></p><p>y") == "x"
    assert text("<div hidden>no</div><div style='display: none'>no</div><div role=navigation>no</div><p>yes") == "yes"
    assert text("<article>a<article>comment</article>b</article>") == "a\nb"
    assert text("<script>never closed <p>x") == "" and text("<!-- never closed <p>x") == ""
    assert text("<div>" * 3000 + "deep") == "deep"


def test_branches_that_repeat_over_a_site_are_cut(spark):
    rows = []
    for i in range(30):
        body = f"<div class=wrap><div class=top>Welcome to the site</div><div class=body><p>Story {i} begins</p><p>and ends {i * 7}</p></div><div class=end>All rights</div></div>"
        rows.append((i, f"http://site.org/{i}", body, "t", "n"))
    same = "<div class=wrap><div class=body><p>same story</p></div></div>"
    rows += [(100 + i, f"http://copies.org/{i}", same, "t", "n") for i in range(20)]
    rows += [(200, None, "<p>lone</p>", "t", "n"), (201, "http://e.org/", None, "t", "n"), (201, "http://e.org/", None, "t", "n")]
    out = extract(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(map(tuple, out.collect()), key=lambda r: r[0])
    want = [(i, u, f"Story {i} begins\nand ends {i * 7}" if i < 30 else "same story" if i < 200 else "lone" if i == 200 else "") for i, u, *_ in rows]
    assert got == [(i, u, t, len(t)) for i, u, t in want]
    assert extract(spark.createDataFrame([], SCHEMA)).collect() == []


def site(n, copies=0):
    """Pages with an article of a classed body, some of them copies of one page, and boilerplate that no word names."""
    rows = []
    for i in range(n):
        story = 0 if i < copies else i
        rows.append((i, f"http://big.org/{i}", f"<div class=q1>Welcome</div><article class=x><h1>Title {story}</h1><div class=q2><p>Text {story}</p></div>"
                     f"<div class=q3>{f'Only {i}' if alone(i, copies) else 'Read more here'}</div></article>", "t", "n"))
    return rows


def alone(i, copies):
    return i >= copies and i % 10 == 5


def texts(spark, rows):
    return {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_copies_and_page_counts_do_not_make_bodies_unimportant(spark):
    few, many = texts(spark, site(40, 30)), texts(spark, site(400, 300))
    for out, n, copies in ((few, 40, 30), (many, 400, 300)):
        for i in range(n):
            story = 0 if i < copies else i
            # What a page alone holds in an unimportant node stays.
            assert out[i] == f"Title {story}\nText {story}" + (f"\nOnly {i}" if alone(i, copies) else "")
    assert few[39] == many[339].replace("339", "39")


def brute(rows):
    """Importance and repeated contents straight from the pages' elements."""
    pages = [Page(r[2] or "") for r in rows]
    tree = {}
    for page in {p.whole: p for p in pages}.values():
        for node, layout, content in set(page.seen):
            tree.setdefault(node, ([], []))
            tree[node][0].append(layout)
            tree[node][1].append(content)
    gone = set()
    for node, kinds in tree.items():
        importance = max(1 - sum(v.count(x) ** 2 for x in set(v)) / len(v) ** 2 for v in kinds)
        if importance < site_style.UNIMPORTANT:
            contents = kinds[1]
            gone |= {site_style.held(node, c) for c in set(contents) if contents.count(c) >= max(3, 0.1 * len(contents))}
    return {r[0]: "\n".join(p.main(gone)) for r, p in zip(rows, pages)}, gone


def test_equals_a_brute_force_tree(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        parts = [f"<div class=a{rng.randrange(3)}><p>{rng.choice(['same', 'same', 'same', str(i)])}</p><ul><li>x<li>{i % 4}</ul></div>" for _ in range(rng.randint(1, 4))]
        rows.append((i, "http://one.org/x", f"<body><div class=top>Hello</div>{''.join(parts)}<div class=w><div class=z>end</div>{rng.random()}</div>", "t", "n"))
    rows += [(100 + k, *rows[k][1:]) for k in range(20)]
    wanted, gone = brute(rows)
    assert texts(spark, rows) == wanted and gone


def test_parsing_takes_time_in_proportion_to_the_page():
    def took(n):
        source = "<div>" * n + "".join(f"<p>{k}" for k in range(n)) + '<a "' * n
        began = time.process_time()
        Page(source)
        return time.process_time() - began

    took(200)
    assert took(8000) < 40 * max(took(1000), 0.01)
