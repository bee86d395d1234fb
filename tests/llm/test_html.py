import pandas as pd
from pyspark.sql import functions as F

from ledgerlake.llm import html as H
from tests.llm.helpers import prose

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_article_with_everything_around_it(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
    <header>Site</header><nav><ul><li>One<li>Two</ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>hidden</p> -->
    <article><h1>A &amp; B&nbsp;C</h1><p>one
      <b>two</b>three<br>four<p>five &lt;six&gt; &#233;<form>name <input></form><div class="ad">buy</div><ul><li>i<li>j</ul>
    <section id="comments"><p>first!</p></section></article><aside>also</aside><footer>&copy; x</footer></body></html>"""
    got = texts(spark, [(1, "http://h/", page), (2, None, None), (3, "x", ""), (4, "http://h/", "plain &amp; text")])
    assert got == {1: "A & B C\none twothree four\nfive <six> é\ni\nj", 2: "", 3: "", 4: "plain & text"}


def test_host_template_is_left_out_where_no_article_is_marked(spark):
    page = "<html><body><div><a>Home</a></div><div>Welcome to our site</div><h1>T{0}</h1><p>{1}</p><p>All rights reserved</p></body></html>"
    rows = [(k, "https://a.example/x", page.format(k, prose(10, k))) for k in range(8)]
    rows.append((99, "https://single.example/", page.format(99, "alone")))
    got = texts(spark, rows)
    for k in range(8):
        assert got[k] == f"T{k}\n{prose(10, k)}"
    assert got[99] == "Home\nWelcome to our site\nT99\nalone\nAll rights reserved"


def test_equal_articles_on_a_host_stay(spark):
    page = "<body><nav>menu</nav><article><h1>Same</h1><p>the same text</p></article></body>"
    got = texts(spark, [(k, "http://h.example/", page) for k in range(20)])
    assert set(got.values()) == {"Same\nthe same text"} and len(got) == 20


def test_classes_nest_by_position():
    rows = [(1, False, 10, 10, 5, 1.0), (2, False, 10, 10, 5, 9.0), (3, True, 10, 10, 5, 8.0),  # root class
            (4, False, 6, 12, 7, 3.0), (5, False, 6, 12, 7, 3.5), (6, True, 6, 12, 7, 4.0),  # in one gap of the root
            (7, True, 6, 6, 8, 3.0)]  # alone: no class
    t = pd.DataFrame(rows, columns=["token", "is_text", "pages", "total", "vector", "place"])
    skeleton, text = H.nested(t)
    assert sorted(skeleton) == [1, 2, 4, 5] and sorted(text) == [3, 6]


def test_broken_and_very_long_pages(spark):
    long = "<article>" + "".join(f"<p>{prose(20, k)}" for k in range(3000))
    rows = [(1, "u", long), (2, "u", "<p>a</b></div><p>b<"), (3, "u", "<script>never closed <p>x"), (4, "u", "a < b & c"), (None, "u", "<p>n")]
    got = texts(spark, rows)
    assert got[1].count("\n") == 2999 and got[2] == "a\nb<" and got[3] == "" and got[4] == "a < b & c" and got[None] == "n"


def test_empty_table_clashing_columns_and_query(spark, tmp_dir):
    df = spark.createDataFrame([(1, "http://h/", "<p>é 😀</p>")], SCHEMA).withColumn("text", F.lit("t")).withColumn("host", F.lit("h"))
    assert H.extract(df).first()["text"] == "é 😀"
    assert H.extract(df.limit(0)).count() == 0
    df.write.parquet(f"{tmp_dir}/pages.parquet")
    assert H.op7_html(spark, tmp_dir).first()["n_chars"] == 3


def test_host_template_inside_articles_goes(spark):
    page = "<body><main><p>Read us daily</p><article><h1>T{0}</h1>{1}<p>Tell your friends</p></article>" \
           "<article><h2>More</h2><p>Old story</p></article></main></body>"
    paras = [[prose(8, 100 * k + j) for j in range(1 + k % 3)] for k in range(9)]
    rows = [(k, "https://a.example/x", page.format(k, "".join(f"<p>{p}</p>" for p in paras[k]))) for k in range(9)]
    got = texts(spark, rows + [(99, "https://single.example/", page.format(99, "<p>alone</p>"))])
    for k in range(9):
        assert got[k] == "\n".join([f"T{k}", *paras[k]])
    assert got[99] == "Read us daily\nT99\nalone\nTell your friends\nMore\nOld story"


def test_skeleton_tells_equal_texts_apart(spark):
    # the template's line stands before the heading; an article that quotes it keeps it
    page = "<body><article><p>Share this</p><h1>T{0}</h1><p>{1}</p>{2}</article></body>"
    rows = [(k, "http://h.example/", page.format(k, prose(9, k), "<p>Share this</p>" if k == 2 else "")) for k in range(7)]
    got = texts(spark, rows)
    assert got[2] == f"T2\n{prose(9, 2)}\nShare this" and got[3] == f"T3\n{prose(9, 3)}"


def test_copies_never_make_an_article_a_template(spark):
    page = "<body><nav>menu {2}</nav><div>Welcome</div><h1>{0}</h1>{1}</body>"
    same = "".join(f"<p>{prose(9, j)}</p>" for j in range(4))
    whole = "\n".join(["Welcome", "Same", *(prose(9, j) for j in range(4))])
    mirror = [(k, "http://mirror.example/", page.format("Same", same, k)) for k in range(12)]
    half = [(100 + k, "http://half.example/", page.format("Same", same, k)) for k in range(12)]
    half += [(200 + k, "http://half.example/", page.format(f"T{k}", f"<p>{prose(9, 50 + k)}</p>", k)) for k in range(6)]
    # every row twice: no page cancels itself in a vector
    twice = [(300 + k, "http://twice.example/", page.format(f"T{k}", f"<p>{prose(9, 70 + k)}</p>", k)) for k in range(4)] * 2
    got = texts(spark, mirror + half + twice)
    assert {got[k] for k in range(12)} == {whole}
    assert {got[100 + k] for k in range(12)} == {whole.removeprefix("Welcome\n")}
    assert all(got[200 + k] == f"T{k}\n{prose(9, 50 + k)}" for k in range(6))
    assert all(got[300 + k] == f"T{k}\n{prose(9, 70 + k)}" for k in range(4))


def test_inside_an_article_only_whole_class_words_count(spark):
    page = """<body><div class="entry-header">outside</div><article><div class="entry-header"><h1>Title</h1></div><p>Body text</p>
    <section id="related-work"><p>Others did this</p></section><div class="ad">buy</div><div class="big comments">first</div></article></body>"""
    assert texts(spark, [(1, "http://h/", page)])[1] == "Title\nBody text\nOthers did this"


def test_pages_are_read_in_linear_time():
    import time
    reader, start = H.Reader(), time.time()
    deep = list(reader.events("<div>" * 100_000 + "x"))
    assert deep[-1][4] == "x" and all(isinstance(e[1], int) for e in deep)
    for page in ("<a " * 100_000, "<a '\"" * 60_000, "<b>" * 50_000 + "<li></li>" * 50_000, "</x>" * 100_000, "<p><div>" + "<b>" * 50_000 + "<hr>" * 50_000):
        list(reader.events(page))
    assert time.time() - start < 60


def test_quoted_values_and_unclosed_tags():
    events = lambda html: [(e[0], e[4]) for e in H.Reader().events(html)]
    assert events('<a href="x>y">t') == [("open", ""), ("text", "t")]
    assert events("a <b t='>\"'>c") == [("text", "a "), ("open", ""), ("text", "c")]
    assert events("a <b 'c") == [("text", "a <b 'c")]
    assert events("<i " + " ".join(f"x{k}" for k in range(90)) + ">t")[-1] == ("text", "t")
