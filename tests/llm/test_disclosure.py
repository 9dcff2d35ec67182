from __future__ import annotations

from . import brute
import pytest
from .conftest import EDGE_TEXTS, PROSE, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import disclosure

TRICKY = [
    "a@b.c_d@e.f g@h i@j..k x@a-.b- %@%.c @x.y a@b.c@d.e .@.a.b",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.256 000.0001.255.0255 1..2.3.4 9.9.9.9. 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 0000000000000 00000000000000000000 4111111111111111-",
    "+1 (386) 555-3733 +12345678 ++49 30 1234567 +1 555 . +(1)2345678901 +1234567890123456 +1.2.3.4-5-6-7-8-9)",
    "+49 1.2.3.4 5678 9012 é1.1.1.1é mail: é@é.é a.b+c%d-e_f@ä.com Ω4111111111111111Ω",
    "1" * 4000 + " " + "a" * 4000 + " " + "a.b" * 2000 + "@" + "c.d" * 2000,
    "7" + " 7" * 3000 + "+" + "(" * 3000,
    "".join(f"m{i}@x.org 10.0.{i % 300}.1 é" for i in range(700)),
]


def base(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = disclosure.with_base(df).withColumn("base", disclosure._bare(F.col("matches")))
    out = found.select("id", *(disclosure.n_of(k) for k in disclosure.KINDS), disclosure.span_list(F.col("base"))).collect()
    return [tuple(r)[1:] for r in sorted(out)]


def want(text):
    found = brute.personal(text)
    return (*found[:4], found[5])


def test_base_spans_of_tricky_texts(spark):
    assert base(spark, TRICKY) == [want(t) for t in TRICKY]


@given(st.lists(st.text(alphabet="a1.@+- (0é4%", max_size=80), min_size=30, max_size=30))
@settings(max_examples=8, deadline=None)
def test_base_spans_of_random_texts(spark, texts):
    assert base(spark, texts) == [want(t) for t in texts]


def corpus():
    """An alias that stands only by one address, a word that often does, and plain words."""
    docs = [f"The {name} wrote from {name}@mail.example.com about Blauvogel and the Harbour number {k}." for k, name in enumerate(["max"] * 6)]
    docs += [f"Nothing of note in the harbour on day {w}." for w in ("one", "two", "three", "four", "five", "six", "seven", "eight")]
    docs += [f"The boat left and the {w} stayed." for w in ("captain", "cook", "mate", "cat")]
    docs += [f"They wrote from home about the number of {w} boats." for w in "red green blue white black grey pink old new big".split()]
    return list(enumerate(docs))


def test_disclosing_terms(spark):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    found = {r.term: r.disclosure for r in disclosure.disclosing_terms(docs, least=0.0).collect()}
    # 28 documents, 6 with the address; "harbour" stands in 6 of them and in 14 of all.
    from math import log2

    assert found["blauvogel"] == pytest.approx(1.0)
    assert found["harbour"] == pytest.approx(1 + log2(6 / 14) / log2(28 / 6))
    assert "captain" not in found and "mail" not in found


def test_support_counts_different_texts(spark):
    docs = [(k, "Write to max@mail.example.com, also called Blauvogel.") for k in range(9)] + [(20 + k, f"text {k}") for k in range(9)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(disclosure.disclosing_terms(docs)) == []


def test_sanitised_texts(spark):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    found = dict(rows(disclosure.sanitise(docs)))
    assert found[0] == "The  wrote from [EMAIL] about  and the Harbour number 0."
    assert found[9] == corpus()[9][1] and found[15] == corpus()[15][1]


def test_overlapping_spans_are_masked_once(spark):
    texts = ["a +49 1.2.3.4 5678 9012 b", "x 4111 1111 1111 1111 y", "none"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert dict(rows(disclosure.sanitise(docs))) == {0: "a [PHONE] b", 1: "x [CARD] y", 2: "none"}


def test_many_spans(spark):
    docs = spark.createDataFrame([(1, "é".join(f" m{i}@x.org " for i in range(600)))], "doc_id bigint, text string")
    assert rows(disclosure.sanitise(docs)) == [(1, "é".join([" [EMAIL] "] * 600))]


def test_special_cases(spark, edge_documents, no_documents):
    found = disclosure.spans(edge_documents)
    got = rows(found, "doc_id", disclosure.span_list(F.col("base")))
    assert got == sorted(((i, brute.personal(t)[5]) for i, t in EDGE_TEXTS), key=repr)
    clean = disclosure.sanitise(edge_documents)
    assert clean.dtypes == edge_documents.dtypes
    assert rows(clean, "doc_id", "text", "n_chars", "n", "bucket") == rows(edge_documents, "doc_id", "text", "n_chars", "n", "bucket")
    assert rows(disclosure.sanitise(no_documents)) == []


def test_rows_that_share_an_id_are_told_apart(spark):
    docs = [(1, PROSE), (1, "mail a@b.com"), (None, "mail a@b.com"), (None, PROSE)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(disclosure.sanitise(docs)) == sorted([(1, PROSE), (1, "mail [EMAIL]"), (None, "mail [EMAIL]"), (None, PROSE)], key=repr)


def test_terms_count_wherever_they_stand_in_a_text(spark):
    """A name at the top of a letter, the address at its end, in two texts of a large corpus."""
    filler = " ".join(["the day was long and nobody spoke of it"] * 10)
    docs = [f"Blauvogel. {filler} Letter {w}. Write to max@mail.example.com" for w in ("one", "two")]
    docs += [f"text {chr(97 + i % 26) * 3}{chr(97 + i // 26 % 26) * 3}{chr(97 + i // 676) * 3}" for i in range(9000)]
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    assert {r.term for r in disclosure.disclosing_terms(docs).collect()} >= {"blauvogel"}


def test_words_of_a_single_text_are_chance(spark):
    docs = [f"text {chr(97 + i % 26) * 3}{chr(97 + i // 26) * 3}" for i in range(600)] + ["Blauvogel is max@mail.example.com"]
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    assert rows(disclosure.disclosing_terms(docs)) == []
