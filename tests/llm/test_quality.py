from __future__ import annotations

from . import brute
import numpy as np
from .conftest import EDGE_TEXTS, PROSE, SECOND, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import quality


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4))
@settings(max_examples=60, deadline=None)
def test_repeated_words(texts):
    code = np.array([w for t in texts for w in t], np.int32)
    starts = np.cumsum([0, *map(len, texts)])
    want = [brute.quality(" ".join(map(str, t)))["n_repeat_words"] for t in texts]
    assert quality.repeated_words(code, starts).tolist() == want


def test_line_rules():
    assert quality.line_fault("Home | News | Sports | Contact") == "navigation"
    assert quality.line_fault("word*** other### third%%% more$$$") == "symbols"
    assert quality.line_fault("WIN NOW!! CALL US TODAY!!") == "shouting"
    assert quality.line_fault("By going on you accept our cookie policy.") == "boilerplate"
    assert quality.line_fault("Read more") == "punctuation"
    for line in (PROSE, "It did.", "He said: “Go!”", "a line of prose that was cut in the middle of", "3 - 2 = 1, as they say."):
        assert quality.line_fault(line) is None


def test_special_cases(edge_documents, no_documents):
    found = rows(quality.measure(edge_documents), "doc_id", "n_words", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert len(found) == len(EDGE_TEXTS)
    by_id = {r[0]: r for r in found}
    for doc, text in EDGE_TEXTS:
        if doc is not None:
            base = brute.quality(text)
            assert by_id[doc][1:5] == (base["n_words"], base["n_dup_lines"], base["n_repeat_words"], base["base_failed"])
    assert [by_id[i][5] for i in (1, 2, 3, 4, 5, 6, 8, 10, 11, 12)] == [True, True, False, False, False, False, True, False, False, False]
    assert rows(quality.measure(no_documents)) == []


def test_clean_keeps_columns_and_drops_failing_lines(spark, edge_documents, no_documents):
    found = quality.clean(edge_documents)
    assert found.dtypes == edge_documents.dtypes
    assert [r[0] for r in rows(found, "doc_id")] == [1, 2, 8, 8, None]
    text = "\n".join(["Home | News | Sports | Contact", PROSE, "", SECOND, "Read more"])
    one = spark.createDataFrame([(1, text, len(text))], "doc_id bigint, text string, n_chars bigint")
    want = PROSE + "\n" + SECOND
    assert rows(quality.clean(one)) == [(1, want, len(want))]
    assert rows(quality.clean(no_documents)) == []


def test_texts_that_lose_too_much_go(spark):
    menu = ("Home | News | Sports | Contact", "About | Staff | History | Jobs", "Help | Search | Privacy | More", "Up | Down | Left | Right")
    data = [(k, "\n".join([PROSE, *menu[:k]])) for k in range(5)]
    found = quality.measure(spark.createDataFrame(data, "doc_id bigint, text string"))
    assert rows(found, "doc_id", "n_failed_lines", "base_failed", "kept") == [(k, k, False, k < 4) for k in range(5)]


def test_words_are_parted_by_all_white_space(spark):
    """A clean text whose words are parted by tabs or doubled blanks is kept like the same one with blanks."""
    lines = ["one of the men on the pier", "said that the boats came back", "and nobody spoke of it again for days"] * 3
    for gap in ("\t", "\x0b", "\x0c", "\r", "  ", "\t "):
        text = "\n".join(f"{i} " + x.replace(" ", gap) for i, x in enumerate(lines))
        assert all(quality.line_fault(x) is None for x in text.split("\n"))
        found = quality.measure(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
        assert found.n_failed_lines == 0 and found.n_lines == 9
    assert quality.line_fault("Read\tmore") == "punctuation"
    assert quality.line_fault("Home\t|\tNews\t|\tSports") == "navigation"
    assert quality.line_fault("Read  the   news") == "punctuation"
