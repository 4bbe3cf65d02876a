import json
import random

from regpanel.llm import op8_html as x

PAGE = ("<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><a href=/>home {i}</a></nav><div class='ad'>buy {i}</div>"
        "<article><h1>Title {i}</h1><p>First &amp; only {i}<br>line<p>second&nbsp;{i}</p><div class=tagline>read more stories</div>"
        "<section id='comments'><p>troll {i}</p></section></article><footer>&copy; {i}</footer><script>var t='</p>';</script></body></html>")


def expected(i, tagline):
    return f"Title {i}\nFirst & only {i} line\nsecond {i}" + ("\nread more stories" if tagline else "")


def test_template_text_of_a_host_is_left_out(spark):
    many = [(i, f"http://many.org/{i}", PAGE.replace("{i}", str(i))) for i in range(20)]
    few = [(100 + i, f"http://few.org/{i}", PAGE.replace("{i}", str(i))) for i in range(2)]
    pages = spark.createDataFrame(many + few, "page_id long, url string, html string").repartition(6)
    got = {r.page_id: r.text for r in x.extract_main_text(pages).collect()}
    assert all(got[i] == expected(i, False) for i in range(20))
    # Two pages are no evidence for a template.
    assert all(got[100 + i] == expected(i, True) for i in range(2))


def test_a_constant_paragraph_takes_no_varying_one_with_it(spark):
    # The constant <p> stands alone, before or after the story, or next to it, always under the story's own label.
    forms = {"before.org": "<p>Same notice</p><h1>T {i}</h1><p>story {i} told</p><p>end of story {i}</p>",
             "after.org": "<p>story {i} told</p><p>end of story {i}</p><h1>T {i}</h1><p>Same notice</p>",
             "beside.org": "<h1>T {i}</h1><p>story {i} told</p><p>Same notice</p><p>end of story {i}</p>"}
    rows = [(100 * k + i, f"http://{host}/{i}", f"<body><article>{form}</article>".replace("{i}", str(i)))
            for k, (host, form) in enumerate(forms.items()) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in x.extract_main_text(pages).collect()}
    for i in range(10):
        assert got[i] == got[200 + i] == f"T {i}\nstory {i} told\nend of story {i}"
        assert got[100 + i] == f"story {i} told\nend of story {i}\nT {i}"


def test_template_is_told_by_its_share_of_the_pages(spark):
    # 36 of 40 pages have the notice, two altered it, two lack it; half of them share another text.
    def page(i):
        notice = "" if i < 2 else f"<p>Other notice {i}</p>" if i < 4 else "<p>Same notice</p>"
        return f"<body><article>{notice}<h1>T {i}</h1><p>story {i} told</p>" + ("<p>Half of them</p>" if i % 2 else "") + "</article>"

    rows = [(i, f"http://hot.org/{i}", page(i)) for i in range(40)]
    # The same without an article: one altered text beside the body does not widen the content root.
    html = "<body><div class=page><div class=left><p>{l}</p></div><div class=body><p>{a}</p><p>{b}</p></div></div></body>"
    rows += [(100 + i, "http://plain.org/", html.replace("{l}", "Always the same " * 9 + ("!" if i == 5 else "")).replace("{a}", f"story number {i} " * 20)
              .replace("{b}", f"its end {i}")) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    got = {r.page_id: r.text for r in x.extract_main_text(pages).collect()}
    for i in range(40):
        assert got[i] == (f"Other notice {i}\n" if i in (2, 3) else "") + f"T {i}\nstory {i} told" + ("\nHalf of them" if i % 2 else "")
        assert got[100 + i] == " ".join(f"story number {i} ".split() * 20) + f"\nits end {i}"


def test_surplus_slots_do_not_depend_on_grouping():
    parts = []
    for i in range(12):
        rng = random.Random(i)
        children = "".join(f"<p class={rng.choice('uvw')}>always {j % 5}</p><div class={rng.choice('xyz')}>{i} {j} varies</div>" for j in range(40))
        parts.append(json.dumps(x.skeleton(x.tree(f"<body><div class=top><p>menu</p></div><div class=page>{children}</div>"))))
    expected = x.wrapper(x.merged(parts))
    assert json.loads(expected[0])[-1] == "div.page"
    for k in (3, 6, 9):
        assert x.wrapper(x.merged([x.merged(parts[:k]), x.merged(parts[k:][::-1])])) == expected


def test_copies_are_not_a_template(spark):
    pages = spark.createDataFrame([(i, "http://copies.org/x", PAGE.replace("{i}", "7")) for i in range(12)], "page_id long, url string, html string")
    assert {r.text for r in x.extract_main_text(pages).collect()} == {expected(7, True)}


def test_content_root_without_an_article_element(spark):
    html = ("<body><div class=top><p>Same words here</p></div><div class=page><div class=left><p>Always the same</p></div>"
            "<div class=body><p>{a}</p><p>{b}</p></div></div></body>")
    rows = [(i, "http://plain.org/", html.replace("{a}", f"long story number {i} " * 20).replace("{b}", f"its end {i}")) for i in range(12)]
    got = {r.page_id: r.text for r in x.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == " ".join(f"long story number {i} ".split() * 20) + f"\nits end {i}" for i in range(12))


def test_single_pages():
    cases = {"": "", "<p>x": "x", "plain &lt;b&gt; text": "plain <b> text", "<table><tr><td>a<td>b</table><p>z": "a\nb\nz",
             "<body><header>H</header><main><h1>T</h1><div class='share-buttons'>s</div><p>a&nbsp;&amp; b<br>c <i>d</i>e</p><ul><li>1<li>2</ul></main><aside>n</aside>": "T\na & b c de\n1\n2",
             "<article>a<article class=comment>no</article></article>": "a", "<div class=cookie-notice>we use</div><p>t</p><form>f</form>": "t",
             "<article><p>cut &am": "cut &am", "<article><p><b>open<p>next</b> end</article>": "open\nnext end", "<p>a</p\n>b": "a\nb"}
    for html, text in cases.items():
        assert x.main_text(html, None) == text, html
    deep = "<div>" * 5000 + "<p>deep</p>" + "</div>" * 5000
    assert x.main_text(deep, None) == "deep"
    assert x.skeleton(x.tree("<b>" * 3000 + "t"))


def test_deep_nesting_keeps_what_follows_and_its_chrome():
    for n in (140, 200, 3000):
        deep = "<div>" * n + "{}" + "</div>" * n
        page = "<body><div class=wrap><article>" + deep.format("text") + "<p>after</p></article></div><p>outside</p>"
        assert x.main_text(page, None) == "text\nafter"
        inner = "<nav>menu</nav><p>one<p>two <b>bold</b><div class=ad>buy</div><ul><li>1<li>2</ul><footer>f</footer>end"
        assert x.main_text("<article>" + deep.format(inner) + "<p>after</p></article><p>outside</p>", None) == "one\ntwo bold\n1\n2\nend\nafter"
        assert x.main_text("<p>outside</p>" + deep.format("<article><p>in</p></article>side"), None) == "in"
        assert x.main_text("<article>" + "<b><i>" * n + "in<p>line" + "</i></b>" * n + "</article><p>outside", None) == "in\nline"


def test_template_text_past_a_deep_nesting(spark):
    html = "<article>" + "<div>" * 200 + "<p>Same notice</p><h1>T {i}</h1><nav>menu</nav><p>story {i} told</p>" + "</div>" * 200 + "<p>after {i}</p></article>"
    rows = [(i, "http://deep.org/", html.replace("{i}", str(i))) for i in range(10)]
    got = {r.page_id: r.text for r in x.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"T {i}\nstory {i} told\nafter {i}" for i in range(10))


def test_simple_tree_matching():
    def n(label, *children):
        return [label, 1, "-", 0, 0, list(children)]
    a = n("a", n("b", n("c")), n("d"), n("e", n("f"), n("g")))
    b = n("a", n("x"), n("b", n("c"), n("h")), n("e", n("g")))
    assert x.matched(a, b) == 5 and x.matched(a, n("z")) == 0
    out = x.merge(json.loads(json.dumps(a)), b)
    assert [c[0] for c in out[5]] == ["x", "b", "d", "e"] or [c[0] for c in out[5]] == ["b", "x", "d", "e"]


def test_merging_does_not_depend_on_grouping():
    parts = [json.dumps(x.skeleton(x.tree(PAGE.replace("{i}", str(i))))) for i in range(9)]
    assert x.wrapper(x.merged(parts)) == x.wrapper(x.merged([x.merged(parts[:4]), x.merged(parts[4:][::-1])]))


def test_edge_rows(spark):
    rows = [(1, None, None, "c"), (2, "http://a/", None, "c"), (None, None, "<p>x</p>", "c"), (3, "http://a/", "", "c"), (3, "http://a/", "", "c"),
            (4, "http://long/", "<article>" + "<p>word</p>" * 20_000, "c"), (5, "nohost", "<p>" + "y " * 200_000, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.n_chars) for r in x.extract_main_text(pages).collect()), key=str)
    assert got == sorted([(1, None, 0), (2, "http://a/", 0), (None, None, 1), (3, "http://a/", 0), (3, "http://a/", 0), (4, "http://long/", 99_999), (5, "nohost", 399_999)], key=str)
    assert x.extract_main_text(pages.limit(0)).collect() == []
