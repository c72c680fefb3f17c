from pyspark.sql import functions as F

from parcelframe.sources import pages

PAGE = """<html><body><h1 class="big head-title"> A &amp; B </h1>
<div class="col-item"><div class="infor-note">first</div><div class="infor-data">x</div></div>
<div class="col-item"><div class="infor-note"><b>2</b> tỷ</div><div class="infor-data">90 m2</div></div>
<div class="opt-huongnha opt"><div>label</div><span class="value-item">Đông</span></div>
<div class="description-content"><div><div>deep</div> inner</div> tail<script>var a = 1;</script></div>
<div class="features"><ul><li>garage</li><li>garden <b>big</b></li></ul></div>
<div class="carousel"><div class="item"><img class="p" src="a.jpg"></div><div class="item"><img src="b.jpg"/></div></div>
<div class="nearby-schools"><div class="item"><div class="name">S1</div><div class="distance">1 km</div></div></div>
<div class="property-list"><div class="row-item"><p><a href="/1">x</a><a href="/9">y</a></p></div><div class="row-item">none</div></div>
<div class="posting-date">not closed"""


def _page(spark):
    return spark.createDataFrame([(1, PAGE), (2, "")], "id int, html string")


def test_listing_fields(spark):
    first, second = pages.extract_fields(_page(spark), keep=["id"]).orderBy("id").collect()
    assert first["title"] == "A & B"
    assert (first["price"], first["area"]) == ("2 tỷ", "90 m2")
    assert first["direction"] == "Đông"
    assert first["street"] == ""
    assert set(second.asDict().values()) == {2, ""}


def test_details_keep_nested_and_unclosed_content(spark):
    first, second = pages.extract_details(_page(spark), keep=["id"]).orderBy("id").collect()
    assert first["description"] == "deep inner tail"
    assert first["posting_date"] == "not closed"
    assert first["features"] == ["garage", "garden big"]
    assert first["image_urls"] == ["a.jpg", "b.jpg"]
    assert (second["features"], second["image_urls"]) == ([], [])


def test_links_and_amenities(spark):
    links = pages.extract_links(_page(spark), keep=["id"]).collect()
    assert [(r["id"], r["position"], r["link"]) for r in links] == [(1, 0, "/1"), (1, 1, "")]
    near = pages.extract_amenities(_page(spark)).first()["nearby_amenities"]
    assert [p.asDict() for p in near["schools"]] == [{"name": "S1", "distance": "1 km"}]
    assert near["parks"] == [] and len(near) == 5


MESSY = """<HTML><!-- <h1 class='head-title'>old</h1> --><div class="infor-note">1</div><script>"<div class='infor-note'>no</div>"</script>
<H1 class='head-title'>Nh&agrave; &#259;n</H1><DIV CLASS='col-item'><div class=infor-note>a</div></DIV><div class='x col-item y'><div class='infor-note'>2&nbsp;t&#7927;</div></div>
<div class="opt-duong"><p><span class="value-item">deep</span></p><span class="value-item">5m</span></div>
<div class="features"><li>stray</li><ul><li>a<ul><li>nested</li></ul></li><li>b</ul></div><div class="carousel"><img src="logo"><div class="item"><img src='x.jpg'><img></div></div>
<div class="row-item"><a href="/ad">ad</a></div><div class="property-list"><div class="row-item"><a href='/1?a=1&amp;b=2'>x</a></div><p><div class="row-item"><a href="/2"></a></div></div>"""


def test_structure_case_quotes_comments_and_entities(spark):
    page = spark.createDataFrame([(1, MESSY), (2, None)], "id int, html string")
    first, second = pages.extract_fields(page, keep=["id"]).orderBy("id").collect()
    assert (first["title"], first["price"], first["street"]) == ("Nhà ăn", "2 tỷ", "5m")
    assert set(second.asDict().values()) == {2, ""}
    details = pages.extract_details(page, keep=["id"]).orderBy("id").first()
    assert details["features"] == ["anested", "b"] and details["image_urls"] == ["x.jpg"]
    links = pages.extract_links(page, keep=["id"]).collect()
    assert [r["link"] for r in links][0] == "/1?a=1&b=2" and "/ad" not in [r["link"] for r in links]


def test_deep_nesting(spark):
    page = spark.createDataFrame([("<div>" * 20_000 + "<h1 class='head-title'>x</h1>",)], "html string")
    assert pages.extract_fields(page).first()["title"] == "x"


def test_counted_elements_close_one_by_one(spark):
    html = "<div><div><div><div class='description-content'>a</div></div>b</div><p><span>c</p><div class='posting-date'>d</div>e</div>"
    html += "<div><div class='contact-name'><div><div>f</div></div>g</div></div><div class='contact-phone'><img>h<br>i &lt;b&gt; < j"
    found = pages.extract_details(spark.createDataFrame([(7, html), (8, None)], "kept int, html string"), keep=["kept"]).orderBy("kept").collect()
    assert found[0][:5] == (7, "a", "d", "fg", "h\ni <b> < j")
    assert found[1][:] == (8, "", "", "", "", [], [])


def test_more_rules_than_one_fold_takes_and_clashing_names(spark):
    html = "".join(f"<div class='c{i:03}'><b title='class=c000'>{i}</b></div>" for i in range(70))
    rules = {f"f{i}": pages.path_text(("div", pages.has_class(f"c{i:03}")), ("b", "")) for i in range(70)}
    df = spark.createDataFrame([(1, 2, html)], "tokens int, shown int, html string")
    row = pages.extract_fields(df, rules=rules, keep=["tokens", "shown"]).first()
    assert row[:2] == (1, 2) and row[2:] == tuple(str(i) for i in range(70))


def test_plans_hold_no_python(spark):
    for use in (pages.extract_fields, pages.extract_links, pages.extract_details, pages.extract_amenities):
        assert "Python" not in use(_page(spark))._jdf.queryExecution().executedPlan().toString()


def test_tidy_pages_are_not_folded_and_give_the_same(spark, monkeypatch):
    tidy = """<!DOCTYPE html><html><body><!-- <div> --><h1 class='head-title'>A &amp; B</h1><div class="col-item"><div class="infor-note">1<br>&lt;2</div></div>
    <div class="description-content"><p title="x">a<script>"</div>"</script></p><DIV>b</DIV>c</div><div class="features"><ul><li>d</li><li><b>e</b></li></ul></div>
    <div class="carousel"><div class="item"><img src='f.jpg'/></div></div><div class="nearby-schools"><div class="item"><p><span class="no"></span></p>
    <div class="name">g</div></div></div><div class="property-list"><div class="row-item"><b><a href="/1?a&amp;b">h</a></b></div></div></body></html>"""
    pages_ = [tidy, tidy.replace("</p>", ""), tidy.replace("<li>d</li>", "<li>d"), tidy.replace("<b>e</b>", "<li>e</li>"), tidy.replace('title="x"', 'title="a>b"')]
    pages_ += [tidy.replace("<DIV>b</DIV>", "<div class='description-content'>b</div>"), "<b>" * 33 + tidy + "</b>" * 33, tidy.replace("</h1>", "</h2>"), "", None]
    df = spark.createDataFrame(list(enumerate(pages_)), "id int, html string").coalesce(1)
    uses = (pages.extract_fields, pages.extract_details, pages.extract_amenities, pages.extract_links)

    def found():
        return [[str(r) for r in use(df, keep=["id"]).orderBy("id").collect()] for use in uses]

    paths = [(("div", pages.has_class("description-content")),)]
    folded = [r["id"] for r in pages._scan(df, "html", ["id"], paths)[0].filter("tokens is not null").select("kept.id").orderBy("id").collect()]
    assert folded == [1, 2, 3, 4, 5, 6, 7]
    fast = found()
    monkeypatch.setattr(pages, "_TIDY", "(?!)")
    assert found() == fast
