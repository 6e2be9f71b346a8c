import html
import re

import numpy as np
import pytest

from siftworks.llm import html_text
from siftworks.llm.html_text import common_subsequence, main_text
from siftworks.llm.queries import QUERIES


def test_pages_of_the_table_against_their_known_layout(spark):
    """Every page of the table holds one article element: its blocks, cut out by patterns."""
    sf = "/root/testdata/sf0.01"
    want = {}
    for p in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1|div|li|ul)[^>]*>", article)]
        want[p.page_id] = "\n\n".join(b for b in blocks if b)
    got = {r.page_id: r for r in QUERIES["op8_html"](spark, sf).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; &lt;b&gt;", "plain & <b>"),
        ("<p>a<p>b <b>c</b><br>d\n e", "a\n\nb c d e"),
        ("<nav>x</nav><main><h1>T</h1><p>a</p><aside>no</aside><p>b</p></main><footer>f</footer>", "T\n\na\n\nb"),
        ('<article><p>a</p><div class="ad">buy</div><p>b</p></article><div class="comments">c</div>', "a\n\nb"),
        ('<article>a<span class="share"> tweet </span>b</article>', "a\n\nb"),
        ("<article><header>h</header><form>f</form><p>x</p></article>", "x"),
        ('<body class="with-sidebar"><p>t</p></body>', "t"),
        ('<div class="cookie-notice">c</div><div class="content-with-sidebar">t</div>', "t"),
        ('<script>var a="</p><p>x"</script><style>p{}</style><p>t</p><!-- <p>no</p> -->', "t"),
        ("<ul><li>a<li>b</ul></div><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
        ("<title>t</title><p>x &copy; &#233; &unknown; &nbsp;y", "x © é &unknown; y"),
        ("<p>1 < 2 and <b", "1 < 2 and"),
    ],
)
def test_markup(page, text):
    assert main_text(page) == text


def naive_lcs(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
    return best[-1, -1]


def test_common_subsequence_against_the_table_of_lengths():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (rng.integers(0, 5, rng.integers(0, 14)).tolist() for _ in range(2))
        at = common_subsequence(a, b)
        assert at == sorted(set(at)) and len(at) == naive_lcs(a, b)
        left = iter(b)
        assert all(a[i] in left for i in at)


def page(body):
    return f"<html><body><div>Site name</div><div>Top links</div>{body}<div>Contact us</div></body></html>"


ROWS = [
    (1, "http://h.org/a/1", page("<p>First story.</p>")),
    (2, "http://h.org/a/2", page("<p>Second story.</p><p>More of it.</p>")),
    (3, "http://h.org/a/3", page("<article><p>Third.</p></article>")),
    (4, "http://other.org/", page("<p>Alone.</p>")),
    (5, "http://twin.org/x", page("<p>Same.</p>")),
    (5, "http://twin.org/x", page("<p>Same.</p>")),
    (6, None, None),
    (7, "http://h.org/a/1#z", "<p>" + "long " * 100_000),
]


def test_template_lines_go_where_no_markup_explains_them(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "page_id long, url string, html string, text int")
    got = {}
    for r in html_text.extract(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
    whole = "Site name\n\nTop links\n\n{}\n\nContact us"
    assert got[2] == ["Second story.\n\nMore of it."] and got[3] == ["Third."]
    assert got[4] == [whole.format("Alone.")], "no neighbour"
    assert got[5] == [whole.format("Same.")] * 2, "an equal page tells nothing"
    assert got[6] == [""] and len(got[7][0]) == 499_999
    assert html_text.extract(df.limit(0)).count() == 0
