import pytest

from renewlens.llm import html_text as H


@pytest.mark.parametrize("begin, end", [("<div>", "</div>"), ("<div><b>x</b><i>y</i>", "</div>"), ("<span><p>z</p>", "")])
def test_pages_nested_deeper_than_pythons_stack(spark, begin, end):
    pages = [(i, f"http://deep.example.com/{i}", "<body>" + begin * 3000 + f"deep {i}" + end * 3000, "c") for i in range(3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, skeleton string")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert all(got[i].endswith(f"deep {i}") for i in range(3))
