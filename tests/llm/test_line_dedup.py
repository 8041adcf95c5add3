from plateflow.llm.line_dedup import drop_boilerplate

SITE = [(k, f"https://A.example.com/{k}", f"<html><nav><li>Home</li></nav><p>Story {k}</p><p>Odd</p></html>") for k in range(8)]
LONE = [(50, "http://b.example.com/", "<p>Home</p><p>Story</p>")]
ODD = [
    (60, None, "<p>Home</p>"),
    (61, "not a url", None),
    (None, "https://user@a.example.com:80/x?q#f", "<!-- Home --><script>Home</script>New<br>Home<BR/> "),
]
SCHEMA = "page_id long, url string, html string"


def test_lines_of_a_site(spark):
    pages = spark.createDataFrame(SITE + LONE + ODD, SCHEMA)
    rows = {r.page_id: r for r in drop_boilerplate(pages).collect()}
    assert all(rows[k].kept_text == f"Story {k}" for k in range(8))
    assert rows[0].host == "a.example.com" == rows[None].host and rows[0].host_pages == 9
    assert (rows[50].kept_text, rows[50].n_dropped) == ("Home\nStory", 0)
    assert (rows[60].host, rows[60].kept_text) == ("", "Home")
    assert (rows[61].kept_text, rows[61].n_lines) == ("", 0)
    assert (rows[None].kept_text, rows[None].n_lines, rows[None].n_dropped) == ("New", 2, 1)


def test_names_that_clash(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(SITE, SCHEMA)
    names = ["host", "lines", "kept", "page_lines", "site_lines", "boilerplate", "Kept_Text"]
    rows = drop_boilerplate(pages.select("*", *(F.lit("x").alias(n) for n in names))).collect()
    assert rows[0].lines == "x" and {r.host for r in rows} == {"a.example.com"}


def test_no_pages(spark):
    assert drop_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0
