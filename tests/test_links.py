from recordlens.operators.links import json_props, manifest_files, page_archives, page_links

HTML = ('<a href="/files/a.zip">A</a> <a href=\'data/b.ZIP?x=1&amp;y=2\'>B</a> '
        'see https://cdn.example.org/c.zip and /d/e.zip?v=3 <a href="https://other.example.org/page">P</a>')


def test_page_links_and_archives(spark):
    pages = spark.createDataFrame([(1, "https://host.example.com/dir/index.html?q=1", HTML)],
                                  "page_id long, url string, html string")
    links = {r.link for r in page_links(pages).collect()}
    assert "https://host.example.com/files/a.zip" in links
    assert "https://host.example.com/dir/data/b.ZIP?x=1&y=2" in links      # relative + entity decoded
    assert "https://cdn.example.org/c.zip" in links
    assert "https://host.example.com/d/e.zip?v=3" in links                 # root-relative text candidate
    assert "https://other.example.org/page" in links
    archives = {r.link for r in page_archives(page_links(pages)).collect()}
    assert archives == links - {"https://other.example.org/page"}


def test_manifest_files(spark):
    docs = [
        ('{"bulkDataProductBags":[{"bulkDataFileBag":{"fileDataBag":['
         '{"fileName":"g_patent.zip","fileDownloadURI":"/dl/g_patent.zip","fileSize":"120"},'
         '{"fileName":"notes.txt","fileDownloadURI":"/dl/notes.txt","fileSize":"5"},'
         '{"fileName":"","fileDownloadURI":"/dl/x.zip"},'
         '{"fileName":"g_inventor.ZIP","fileDownloadURI":"https://h.example.org/g_inventor.ZIP","fileSize":""}]}}]}',),
        ('{"bulkDataProductBag":[{"productFileBag":{"fileDataBag":['
         '{"fileName":"g_location.zip","fileDownloadURI":"/dl/g_location.zip","fileSize":7}]}}]}',),
        ('{"other": 1}',),
        ('not json',),
    ]
    df = spark.createDataFrame(docs, "doc string")
    rows = sorted(tuple(r) for r in manifest_files(df, "doc", "https://base.example.org").collect())
    assert rows == [("g_inventor.ZIP", "https://h.example.org/g_inventor.ZIP", None),
                    ("g_location.zip", "https://base.example.org/dl/g_location.zip", 7),
                    ("g_patent.zip", "https://base.example.org/dl/g_patent.zip", 120)]
    only = [r.name for r in manifest_files(df, "doc", "https://b", name_pattern="inventor").collect()]
    assert only == ["g_inventor.ZIP"]


def test_json_props(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "s": "x"}'), (2, '{"k": "bad"}'), (3, "nope")], "id long, p string")
    got = {r.id: (r.k, r.s) for r in json_props(df, "p", {"k": "int", "s": "string"}, keep=("id",)).collect()}
    assert got == {1: (5, "x"), 2: (None, None), 3: (None, None)}


def test_archive_links_with_odd_paths(spark):
    links = ["https://h/a b/x.zip", "https://h/a|b/{c}.ZIP?x=1", "https://h/x.zip#top", "https://h/x.zip.html", "https://x.zip", "https://h/q?f=x.zip", "/x.zip"]
    got = [r.link for r in page_archives(spark.createDataFrame([(x,) for x in links], "link string")).collect()]
    assert got == [links[0], links[1], links[2], links[6]]


def test_simple_links_resolve_like_urljoin(spark):
    import html
    from urllib.parse import urljoin
    bases = ["https://host.example.com/dir/index.html?q=1", "http://h", "https://h/a/b/#x"]
    hrefs = ["/a/b.zip", "/a/../b", "/a/./b", "//other/x", "rel", "rel/x?y#z", "https://o/x", "https://o", "https://o/?", "https://o/a#", "/p?", "/p;", "/p?a;b", "#f",
             "?q=2", "mailto:x@y", "/a&amp;b", "https://o/a/../b", " /sp ", "/x y|{z}", "HTTP://O/x", "/..", "/a/.."]
    pages = [(i * 100 + k, b, f'<a href="{h}">') for i, b in enumerate(bases) for k, h in enumerate(hrefs)]
    got = {r.page_id: r.link for r in page_links(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i, b in enumerate(bases):
        for k, h in enumerate(hrefs):
            assert got[i * 100 + k] == urljoin(b, html.unescape(h.strip())), (b, h)


def test_manifest_empty_lists_and_zero_size(spark):
    doc = ('{"bulkDataProductBags":[],"bulkDataProductBag":[{"bulkDataFileBag":{"fileDataBag":[]},"productFileBag":{"fileDataBag":['
           '{"fileName":"a.zip","fileDownloadURI":"/a.zip","fileSize":"0"}]}}]}')
    got = manifest_files(spark.createDataFrame([(doc,)], "doc string"), "doc", "https://b").collect()
    assert [tuple(r) for r in got] == [("a.zip", "https://b/a.zip", 0)]


def test_page_links_plan_has_one_python_step(spark):
    pages = spark.createDataFrame([(1, "https://h/x", HTML)], "page_id long, url string, html string")
    plan = page_links(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
