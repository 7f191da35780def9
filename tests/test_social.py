"""Posts, counts, channels and messages with missing parts."""

import pytest
from pyspark.sql import functions as F

from mereweave.operators import social as s


@pytest.mark.parametrize(("shown", "want"), [("1.2K", 1200), ("3m", 3_000_000), ("1,234", 1234), ("", 0), ("soon", 0), ("xK", 0), (None, 0), (" 7 ", 7)])
def test_counts(spark, shown, want):
    assert spark.createDataFrame([(shown,)], "c string").select(s.parse_count(F.col("c"))).first()[0] == want


def test_posts(spark):
    full = '<div data-testid="User-Name"><p>Ann</p><p>@ann1</p></div><div data-testid="tweetText">One &amp; two<br>three</div><div data-testid="like"><span>2K</span></div><a href="/ann/status/12?x">x</a>'
    df = spark.createDataFrame([(1, full), (2, '<div data-testid="tweetText">only</div>'), (3, '<div data-testid="like"><span>2</span></div>'), (4, None)], "id int, html string")
    got = {r.id: r for r in s.posts(df, "html").collect()}
    assert set(got) == {1, 2}
    assert (got[1].text, got[1].likes, got[1].retweets, got[1].author_name, got[1].author_username, got[1].post_id, got[1].created_at) == ("One & two\nthree", 2000, None, "Ann", "ann1", "12", None)
    assert (got[2].text, got[2].likes, got[2].author_name, got[2].url) == ("only", None, None, None)


def test_messages(spark):
    schema = "channel long, username string, id long, text string, caption string, photo boolean, video boolean, document string, audio string, from_name string, sender_title string, pinned boolean"
    rows = [(1, "c", 1, None, "cap", True, True, "f.txt", "", None, "Chan", True), (1, None, 2, "", None, None, None, None, None, None, None, None), (1, "", 3, "t", "cap", False, False, None, None, None, None, False)]
    got = [tuple(r) for r in s.message_documents(spark.createDataFrame(rows, schema)).collect()]
    assert got == [("telegram:channel:1:message:1", "cap\n[Photo attached]\n[Video attached]\n[Document: f.txt]\n[Audio: Untitled]", "Chan", "pinned", "https://t.me/c/1"), ("telegram:channel:1:message:3", "t", "Unknown", "message", None)]
