"""Site rules: what is found, what is not, nulls."""

import pytest
from pyspark.sql import functions as F

from mereweave.operators import sites as s


def one(spark, column, html, url):
    return spark.createDataFrame([(html, url)], "html string, url string").select(column(F.col("html"), F.col("url"))).first()[0]


@pytest.mark.parametrize(
    ("site", "html", "url", "want"),
    [
        (s.NewsSite("n.example"), None, None, {}), (s.NewsSite("n.example"), "", "https://n.example/x", {"content_type": "page"}),
        (s.NewsSite("n.example"), '<meta name="author" content="Ann"><a class="category-link">C</a><div class="tags"><a>%s</a><a>ok</a></div>' % ("x" * 50), "https://n.example/announcements/1", {"content_type": "news", "author": "Ann", "category": "C", "tags": "ok"}),
        (s.NewsSite("n.example"), "<h1>Fund</h1>$5 deadline: June 1 2024", "https://n.example/funding/1", {"content_type": "grant_program", "grant_amount": "$5", "application_deadline": "June 1 2024"}),
        (s.PortalSite("p.example"), '<nav class="breadcrumb"></nav>', "https://guides.p.example/1", {"content_type": "guide"}), (s.MeetingSite("m.example"), "<p>Status</p><span>status: Done, Status: so</span>", "https://m.example/projects/1", {"content_type": "project", "project_status": "status: Done,  so"}),
        (s.MeetingSite("m.example"), '<meta property="notion:page_id" content="77"><p>nobody named</p>', "https://m.example/weekly-meetups/1", {"content_type": "meeting", "meeting_type": "weekly", "notion_page_id": "77"}),
    ],
)
def test_metadata(spark, site, html, url, want):
    assert one(spark, site.metadata, html, url) == want


def test_links_of_nothing(spark):
    for site in (s.NewsSite("n.example"), s.PortalSite("p.example"), s.MeetingSite("m.example")):
        assert one(spark, site.page_links, None, "https://n.example/") == []


def test_wanted(spark):
    df = spark.createDataFrame([("https://n.example/a.pdf",), ("https://n.example/LOGIN",), ("https://n.example/a",), ("https://p.example/",), ("https://p.example/a/b",)], "u string")
    assert [r[0] for r in df.select(s.NewsSite("n.example").wanted(F.col("u"))).collect()] == [False, False, True, True, True]
    assert [r[0] for r in df.select(s.PortalSite("p.example").wanted(F.col("u"))).collect()] == [True, True, True, False, True]
