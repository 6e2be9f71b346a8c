"""Columns of any name pass through the operators: each name an operator works with, in either case of letters."""

import pytest

from llm_fixtures import docs  # noqa: F401
from siftworks.llm import html_text, licenses, line_dedup, mixing, quality

TEXT = "a line of words\nanother line here"
NAMES = {
    "lines": (lambda df: line_dedup.drop_common_lines(df, min_docs=2), "_ta _tb _lines _drop _a _b _h _pos __ta"),
    "quality": (lambda df: quality.kept_by(quality.Policy("none", 1, ()), quality.with_failed(quality.measure(df))), "_words _windows _bare _lines _row _q_words _q_row"),
    "licenses": (licenses.scan, "_d _b _body d b body"),
    "mixing": (lambda df: mixing.Mix(df).repeat(df).dropDuplicates(["doc_id"]), "_src _key _last _epochs _copy _range cut size"),
    "html": (lambda df: html_text.extract(df, "source", "text", "main"), "_a _b _shared _lines host path place"),
}


@pytest.mark.parametrize("upper", [False, True])
@pytest.mark.parametrize("operator", NAMES)
def test_columns_of_any_name_stay(spark, docs, operator, upper):
    apply, names = NAMES[operator]
    names = [n.upper() if upper else n for n in names.split()]
    df = docs((1, TEXT), (2, TEXT), (3, "other words only")).selectExpr("*", *[f"{i} AS `{n}`" for i, n in enumerate(names)])
    rows = apply(df).collect()
    assert {r.doc_id for r in rows} <= {1, 2, 3} and rows
    assert all([r[n] for n in names] == list(range(len(names))) for r in rows)


def test_captions_and_dialogs_of_an_article_stay():
    page = "<body><nav>Menu</nav><article><p>One.</p><figure><img src=x><figcaption>Caption here</figcaption></figure><object>Fallback</object></article></body>"
    assert html_text.main_text(page) == "One.\n\nCaption here\n\nFallback"
