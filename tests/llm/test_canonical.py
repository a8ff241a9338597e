import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filigree.llm import canonical as C

SAME = [
    ("ﬁnal", "final"), ("été", "été"), ("di﻿s​mis­sed", "dismissed"), ("Ｈｅllo　w", "Hello w"), ("recordеd ѕales", "recorded sales"),
    ("ё", "ë"), ("a​́", "á"), ("x y z", "x y z"), ("one\r\ntwo", "one\ntwo"), ("Ον", "Ov"), ("mi͏llion", "million"), ("，", ","), ("ﬀﬂ", "fffl"),
]
DIFFERENT = [("A", "a"), ("x²", "x2"), ("café", "cafe"), ("“q”", '"q"'), ("a-b", "a–b"), ("10", "l0"), ("a b", "a\nb"), ("a b", "ab"), ("rn", "m")]


@pytest.mark.parametrize("a,b", SAME)
def test_unseen_differences_fold(a, b):
    assert C.canonical_text(a) == C.canonical_text(b)


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_seen_differences_stay(a, b):
    assert C.canonical_text(a) != C.canonical_text(b)


def test_null_and_empty():
    assert C.canonical_text(None) is None and C.canonical_text("") == ""


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=("Cs",))))
def test_idempotent_and_composed(text):
    form = C.canonical_text(text)
    assert C.canonical_text(form) == form
    assert unicodedata.is_normalized("NFC", form)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abeео́̈​Ａﬁ é "))
def test_composition_does_not_matter(text):
    assert C.canonical_text(unicodedata.normalize("NFD", text)) == C.canonical_text(unicodedata.normalize("NFC", text))


def _pairs(spark, rows, extra=""):
    df = spark.createDataFrame(rows, "doc_id bigint, text string" + extra)
    return sorted(tuple(r) for r in C.lookalike_pairs(df, "doc_id", "text", 5).collect())


def test_pairs_of_classes_and_copies(spark):
    rows = [(1, "recorded"), (2, "recorded"), (3, "recordеd"), (4, "r​ecorded"), (5, "Recorded"), (6, None), (7, "abc"), (8, "аbc"), (3, "recordеd"), (None, "recorded")]
    assert _pairs(spark, rows) == [(1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]


def test_empty_table_and_clashing_columns(spark):
    assert _pairs(spark, []) == []
    df = spark.createDataFrame([(1, "recorded", "x", "y", "z"), (2, "recordеd", "x", "y", "z")], "doc_id bigint, text string, form string, raw string, key string")
    assert [tuple(r) for r in C.lookalike_pairs(df, "doc_id").collect()] == []
    assert [tuple(r) for r in C.lookalike_pairs(df, "doc_id", min_chars=0).collect()] == [(1, 2)]
    assert C.canonicalize(df, "text", "raw").where("doc_id = 2").first()["raw"] == "recorded"


def test_very_long_text(spark):
    long = "abе " * 200_000
    assert _pairs(spark, [(1, long), (2, long.replace("е", "e"))]) == [(1, 2)]
