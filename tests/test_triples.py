"""Triples of extractions: labels by the last writer, linked ends, predicates, literals, nulls."""

import pytest
from pyspark.sql import functions as F

from mereweave.operators import triples as t

SCHEMA = """rid string, memory_rid string, kind string, confidence double, version string, tokens long, cost double, created string, source_url string,
 entities array<struct<rid: string, type: string, name: string, confidence: double>>, statements array<struct<rid: string, subject: string, predicate: string, object: string, kind: string, confidence: double>>"""


def test_last_writer_links_ends(spark):
    rows = [
        ("orn:x:1", "orn:m:1", "unified", 0.5, "v1", 3, 0.25, "2024-01-02", "https://a.example/1", [("orn:e:late", "Person", "Ann  Lee", 0.9), ("orn:e:blank", None, " ", None)], [("orn:s:1", "ann lee", "works_for", "Blue Lake", None, None)]),
        ("orn:x:2", "orn:m:2", "unified", 0.5, "v1", 3, 0.25, "2024-01-01", None, [("orn:e:early", "Person", "ANN LEE", 0.1), ("orn:e:lake", "Lake", "Blue Lake", 0.2)], [("orn:s:2", "ANN LEE", "is Near-to it!", None, "fact", 0.7), ("orn:s:3", "nobody", "holds", 'say "hi"\n', None, None)]),
        ("orn:x:3", "orn:m:3", None, None, None, None, None, "2024-01-03", None, None, None),
    ]
    got = {tuple(r) for r in t.export(spark.createDataFrame(rows, SCHEMA), "b#").collect()}
    assert ("<b#e/late>", "schema:worksFor", "<b#e/lake>") in got  # the normal form belongs to the later extraction
    assert ("<b#e/early>", "kg:isNear-toIt", '""') in got  # the spelling as written to the only one who wrote it
    assert ("<b#s/3>", "kg:subjectText", '"nobody"') in got and ("<b#s/3>", "kg:objectText", '"say \\"hi\\"\\n"') in got
    assert {p for s, p, _ in got if s == "<b#s/1>"} >= {"kg:subjectEntity", "kg:objectEntity", "prov:hadPrimarySource"}
    assert ("<b#e/blank>", "rdf:type", "kg:Entity") in got and ("<b#e/lake>", "rdf:type", "kg:Entity") in got
    assert ("<b#x/3>", "rdf:type", "prov:Activity") in got and not any(p == "prov:hadPrimarySource" for s, p, _ in got if s == "<b#x/2>")
    assert t.export(spark.createDataFrame([], SCHEMA), "b#").collect() == []


@pytest.mark.parametrize(("name", "want"), [("part_of", "schema:isPartOf"), ("is_related_to", "kg:isRelatedTo"), ("Allows Users", "kg:allowsUsers"), ("a__b", "kg:aB"), ("x", "kg:x"), (None, "kg:"), ("dé-jà vu", "kg:d-jVu")])
def test_predicates(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(t.predicate(F.col("n"))).first()[0] == want
