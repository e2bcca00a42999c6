from waypost.llm.html_text import extract_text


def test_sharing_decides_outside_the_article_and_copies_keep_their_text(spark):
    with_article = "<p>Menu line</p><p>Lead {}</p><article><p>Same story</p></article>"
    plain = "<p>Menu line</p><p>Body of the copies</p>"
    rows = [
        (1, "http://a.org/1", with_article.format("one")),
        (2, "http://a.org/2", with_article.format("two")),
        (3, "http://b.org/x?p=1", plain),
        (4, "http://b.org/x?p=2", plain),
        (5, "http://b.org/y", "<p>Menu line</p><p>Another</p>"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    text = {r.page_id: r.text for r in extract_text(frame).collect()}
    assert text[1] == "Lead one\nSame story" and text[2] == "Lead two\nSame story"
    assert text[3] == text[4] == "Body of the copies" and text[5] == "Another"
