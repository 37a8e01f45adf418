"""Bodies of press pages: nested divs and several paragraphs."""

import pytest

from quantloom.plans import catalog
from quantloom.sources import readers

CASES = [
    ("<p>One</p><p>two</p>", "One\ntwo", "One\ntwo"),
    ("<div>a<div>b</div></div> <p>c</p>\n<p> </p>", "a\nb\nc", "a\nb\nc"),
    ("<div><div/>x</div>y", "x\ny", "x\ny"),
    ("a<!-- </div> --><script>'</div>'</script>b 1 < 2", "a\nb 1 < 2", "a\nb 1 < 2"),
    ("<p>One &amp; <b>two</b></p>", "One & two", "One &\ntwo"),
    ("", "", ""),
]


@pytest.mark.parametrize("split_inline", [False, True])
def test_bodies_are_whole(spark, split_inline):
    pages = [(str(k), f'<div>before</div><div class="body__content">{body}</div><div>after</div></div>') for k, (body, *_) in enumerate(CASES)]
    df = spark.createDataFrame([*pages, ("open", '<div class="body__content"><p>no end')], "url string, html string")
    got = {r.slug: r.text for r in readers.extract_press(df, split_inline=split_inline).collect()}
    assert got == {str(k): c[1 + split_inline] for k, c in enumerate(CASES)} | {"open": "no end"}


def test_the_query_splits_at_every_tag(spark, tmp_path):
    html = '<div class="body__content"><p>One <b>two</b></p><div>three</div><p>four</p></div>'
    spark.createDataFrame([(1, "http://a/s", html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    (r,) = catalog.QUERIES["i8_press_pages"](spark, str(tmp_path)).collect()
    assert r.text == "One\ntwo\nthree\nfour"
