from renewlens.llm import html_text as H

PARAGRAPHS = [f"Paragraph {k} of the one article that is copied again and again." for k in range(6)]


def test_articles_that_a_host_holds_many_copies_of_stay_whole(spark):
    def rows(host, pages):
        return [(i, f"http://{host}.example.com/{i}", p, "c") for i, p in pages]

    def page(paragraphs, tag):
        return f"<body><{tag}><h1>Headline</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + f"</{tag}></body>"

    def letter(i, copy):
        body = PARAGRAPHS if copy else [f"Paragraph {k} of story {i}, which no other page tells at such length." for k in range(4)]
        return "<body><article>" + "".join(f"<p>{p}</p>" for p in body) + "</article><div><p>All rights reserved</p></div><p>Letter</p></body>"

    exact = rows("exact", [(i, page(PARAGRAPHS, "article")) for i in range(20)])
    loose = rows("loose", [(100 + i, page(PARAGRAPHS, "div")) for i in range(20)])
    near = rows("near", [(200 + i, page(PARAGRAPHS[:5] + [f"Edited {i}."], "article")) for i in range(20)])
    mixed = rows("mixed", [(300 + i, letter(i, i % 5 > 0).replace("<p>Letter", "<p>Join us") if i < 30 else letter(i, False).replace("<p>Letter", "<p>Join us")) for i in range(40)])
    inner = rows("inner", [(400 + i, f"<body><article><p>Story {i} is told here at length, {'as it was ' * 5}.</p><p>Sign our letter</p></article></body>") for i in range(10)])
    df = spark.createDataFrame(exact + loose + near + mixed + inner, "page_id long, url string, html string, skeleton string").repartition(3)
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    whole = "\n".join(["Headline", *PARAGRAPHS])
    for i in range(20):
        assert got[i] == got[100 + i] == whole
        assert got[200 + i] == "\n".join(["Headline", *PARAGRAPHS[:5], f"Edited {i}."])
    assert all(got[300 + i] == "\n".join(PARAGRAPHS) for i in range(30) if i % 5)
    assert all(got[400 + i].startswith(f"Story {i} ") and "letter" not in got[400 + i] for i in range(10))
