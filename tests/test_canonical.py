"""Canonical JSON: the standard's examples, numbers that read back, key order, and what has no canonical form."""

import json
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mereweave.functions import canonical as c


@pytest.mark.parametrize(
    ("bits", "text"),
    [
        ("0000000000000000", "0"), ("8000000000000000", "0"), ("0000000000000001", "5e-324"), ("8000000000000001", "-5e-324"), ("7fefffffffffffff", "1.7976931348623157e+308"), ("4340000000000000", "9007199254740992"),
        ("c340000000000000", "-9007199254740992"), ("4430000000000000", "295147905179352830000"), ("44b52d02c7e14af5", "9.999999999999997e+22"), ("44b52d02c7e14af6", "1e+23"), ("44b52d02c7e14af7", "1.0000000000000001e+23"),
        ("444b1ae4d6e2ef4e", "999999999999999700000"), ("444b1ae4d6e2ef4f", "999999999999999900000"), ("444b1ae4d6e2ef50", "1e+21"), ("3eb0c6f7a0b5ed8c", "9.999999999999997e-7"), ("3eb0c6f7a0b5ed8d", "0.000001"),
        ("41b3de4355555553", "333333333.3333332"), ("41b3de4355555557", "333333333.33333343"), ("becbf647612f3696", "-0.0000033333333333333333"), ("43143ff3c1cb0959", "1424953923781206.2"),
    ],
)
def test_numbers_of_the_standard(bits, text):
    assert c.number(struct.unpack(">d", bytes.fromhex(bits))[0]) == text


def test_example_of_the_standard():
    text = r'{"numbers": [333333333.33333329, 1E30, 4.50, 2e-3, 0.000000000000000000000000001], "string": "€$\u000F\u000aA' + "'" + r'\u0042\u0022\u005c\\\"\/", "literals": [null, true, false]}'
    want = '{"literals":[null,true,false],"numbers":[333333333.3333333,1e+30,4.5,0.002,1e-27],"string":"€$\\u000f\\nA\'B\\"\\\\\\\\\\"/"}'
    assert c.canonical_text(text) == want


def test_keys_are_ordered_by_utf16():
    text = json.dumps({"€": "Euro Sign", "\r": "Carriage Return", "דּ": "Hebrew Letter Dalet With Dagesh", "1": "One", "\U0001f600": "Emoji: Grinning Face", "\u0080": "Control", "ö": "Latin Small Letter O With Diaeresis"})
    assert list(json.loads(c.canonical_text(text)).values()) == ["Carriage Return", "One", "Control", "Latin Small Letter O With Diaeresis", "Euro Sign", "Emoji: Grinning Face", "Hebrew Letter Dalet With Dagesh"]


@settings(max_examples=300, deadline=None)
@given(st.floats(allow_nan=False, allow_infinity=False))
def test_numbers_read_back(x):
    assert float(c.number(x)) == x


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers(-(2**53), 2**53) | st.floats(allow_nan=False, allow_infinity=False) | st.text(alphabet=st.characters(exclude_categories=["Cs"])), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(alphabet=st.characters(exclude_categories=["Cs"])), x, max_size=4), max_leaves=12))
def test_equal_values_have_one_form(value):
    text = c.canonical(value)
    assert c.canonical(json.loads(text)) == text
    assert c.canonical_text(json.dumps(value, indent=3)) == text == c.canonical_text(text)


@pytest.mark.parametrize("text", [None, "", "{", "NaN", "[Infinity]", "1e999", '"\\ud800"', "1" * 400, "[" * 100_000])
def test_what_has_no_form(text):
    assert c.canonical_text(text) is None


def test_hashes_in_columns(spark):
    df = spark.createDataFrame([(1, '{"b": 1.0, "a": [1E2, "é"]}'), (2, "plain"), (3, None), (4, "{broken")], "id int, t string")
    got = {r.id: r.h for r in df.select("id", c.content_hashes("t").alias("h")).collect()}
    sha = lambda s: __import__("hashlib").sha256(s.encode()).hexdigest()
    assert got[1].canonical == sha('{"a":[100,"é"],"b":1}') and got[1].spaced == sha('{"a": [100.0, "\\u00e9"], "b": 1.0}')
    assert got[2].canonical == got[2].spaced == sha("plain") and got[3].canonical is None and got[4].canonical == sha("{broken")
    assert df.select(c.canonical_json("t").alias("c")).first()[0] == '{"a":[100,"é"],"b":1}'
