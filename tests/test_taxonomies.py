"""Tags and categories: order, own names, nulls."""

import pytest
from pyspark.sql import functions as F

from mereweave.functions import taxonomies as x


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


def test_forum_tags(spark):
    df = spark.createDataFrame([("A VOTE on Carbon trade", ["zeta", None, "governance"]), (None, None), ("ours", ["b", "a"])], "t string, g array<string>")
    got = [r[0] for r in df.select(x.forum_tags(F.col("t"), F.col("g"), own="ours")).collect()]
    assert got == [["ecocredit", "governance", "marketplace", "zeta"], [], ["a", "b", "tokenomics"]]


def test_article_tags_keep_the_order_of_the_list(spark):
    assert one(spark, x.article_tags(F.col("t")), t="Regenerative agriculture and governance") == ["governance", "community", "agriculture"]


def test_message_tags(spark):
    df = spark.createDataFrame([("Eco vote", "dev-NEWS", "My Guild", True, False, None), (None, None, None, None, None, None)], "t string, c string, g string, a boolean, e boolean, p boolean")
    got = [r[0] for r in df.select(x.message_tags(*[F.col(c) for c in "tcgaep"])).collect()]
    assert got == [["announcement", "development", "ecological", "governance", "guild:my-guild", "has-attachments"], []]


@pytest.mark.parametrize(("name", "want"), [("GitHub_forum_x", "technical"), ("x_forum_medium_", "forum"), ("a vote", "governance"), ("credit", "registry"), ("github", "other"), (None, "other")])
def test_file_category(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(x.file_category(F.col("n"))).first()[0] == want
