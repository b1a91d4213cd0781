"""A4/L25 on hand-written listing pages (FIXTURES §7)."""

from bizlens.sources import pages as P

LISTING = """<html><head><script>var s = "</p><article class='product_pod'>";</script></head><body>
<section>
<article class="product_pod">
  <h3><a href="../../catalogue/a-light-in-the-attic_1000/index.html" title="A Light in the Attic">A Light...</a></h3>
  <p class="star-rating Three"></p>
  <div class="product_price"><p class="price_color">£51.77</p>
  <p class="instock availability">
      <i class="icon-ok"></i>
        In stock
  </p></div>
</article>
<article class="product_pod">
  <h3><a href="../../catalogue/tipping_999/index.html" title="Tipping &amp; the Velvet">Tipping...</a></h3>
  <p class="star-rating Seven"></p>
  <p class="price_color">Â£53.74</p>
</article>
<!-- <article class="product_pod"><h3><a href="x/index.html" title="Hidden">x</a></h3></article> -->
<article class="product_pod">
  <h3><a href="../../catalogue/no-price_5/index.html">No title attribute</a></h3>
  <p class="star-rating One"></p>
</article>
</section></body></html>"""

DETAIL_OK = """<html><body><ul class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/b">Books</a></li>
<li><a href="/p">Poetry</a></li><li class="active">A Light in the Attic</li></ul></body></html>"""
DETAIL_SHORT = """<html><body><ul class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/b">Books</a></li>
</ul></body></html>"""


def test_extract_records(spark):
    pages = spark.createDataFrame([
        (1, "http://books.example.com/catalogue/page-1.html", LISTING),
        (2, "http://books.example.com/catalogue/a-light-in-the-attic_1000/index.html", DETAIL_OK),
        (3, "http://books.example.com/catalogue/tipping_999/index.html", DETAIL_SHORT),
    ], "page_id long, url string, html string")
    recs = {r["title"]: r for r in P.extract_records(pages).collect()}
    assert set(recs) == {"A Light in the Attic", "Tipping & the Velvet", "N/A"}
    a = recs["A Light in the Attic"]
    assert (a.price, a.rating, a.availability, a.category) == (51.77, 3, "In stock", "Poetry")
    t = recs["Tipping & the Velvet"]
    assert (t.price, t.rating, t.availability, t.category) == (53.74, 0, "Unknown", "Unknown")
    n = recs["N/A"]
    assert (n.price, n.rating, n.category) == (None, 1, "Unknown")
    s = P.records_summary(P.extract_records(pages)).first()
    assert (s.records, s.avg_price, s.avg_rating, s.categories) == (3, 52.76, 1.3, 2)


def test_page_records(spark):
    html = ('<html lang="de"><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul>'
            '<li><a href="/a">a</a></li><li><a href="/b">b</a></li></ul></nav><!-- <h1>no</h1> -->'
            '<article><h1>Fish &amp; Chips</h1><p>one two<br><p>three</p></article>')
    pages = spark.createDataFrame([(7, "https://x.example.com/de/1", html)], "page_id long, url string, html string")
    r = P.page_records(pages).first()
    assert (r.host, r.lang, r.title, r.nav_links, r.paragraphs, r.words) == \
        ("x.example.com", "de", "Fish & Chips", 2, 2, 6)


def test_noise_that_is_never_closed_runs_to_the_end(spark):
    for tail in ("<!-- open <p>two</p>", "<script>var t='<p>two</p>';", "<style>p{}<p>two</p>"):
        df = spark.createDataFrame([(1, "http://h/x", f"<html lang=\"en\"><article><p>one</p>{tail}")], "page_id long, url string, html string")
        assert P.page_records(df).first().paragraphs == 1
