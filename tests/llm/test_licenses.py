from __future__ import annotations

from . import brute
from .conftest import EDGE_TEXTS, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import licenses

TEXTS = [
    "MIT License, mit-license; MITlicense mit\nlicense limit license mit licenses",
    "Released under the MIT License.",
    "GNU General Public License and the Apache License. general public license",
    "Licensed under CC BY-NC 4.0.",
    "Licensed under CC BY 4.0.",
    "Licensed under the GNU Lesser General Public License.",
    "This work is licensed under the GNU General Public License, version 3.",
    "licensed under the apache\nlicense",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction",
    "nothing of the kind",
    None,
    "",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)


def plain(texts, percent=90):
    """Labels by comparing every template with the window at every word."""
    known = []
    for label, text in licenses.TEMPLATES:
        n = len(text.split())
        known.append((label, set(text.split()), n + n * licenses.SLACK_PERCENT // 100))
    out = []
    for text in texts:
        words = brute.TERM.findall(brute.lower(text or ""))
        labels, score = set(), 0.0
        for label, own, width in known:
            wider = [(t, w - width) for _, t, w in known if own < t]
            for s in range(len(words)):
                common = len(own & set(words[s : s + width]))
                if 100 * common < percent * len(own):
                    continue
                around = [(t, len(t & set(words[max(0, s - d) : s + width + d]))) for t, d in wider]
                if not any(n * len(own) >= common * len(t) for t, n in around):
                    labels.add(label)
                    score = max(score, common / len(own))
        base = brute.licenses(text)
        labels |= set(base[4].split(",")) - {""}
        out.append((",".join(sorted(labels)), 1.0 if base[1] else score))
    return out


def check(spark, texts, percent=90):
    from pyspark.sql import functions as F

    found = licenses.scan(frame(spark, texts), percent).select("*", F.array_join("base", ",").alias("b"), F.array_join("labels", ",").alias("l"))
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "b", "l", "score").collect()]
    want = [(i, *brute.licenses(t), *more) for i, (t, more) in enumerate(zip(texts, plain(texts, percent)))]
    assert sorted(got) == want


def test_labels(spark):
    check(spark, TEXTS)
    assert [x[0] for x in plain(TEXTS)[3:7]] == ["cc-by-nc", "cc-by", "lgpl", "gpl"] or plain(TEXTS)[5][0] == "gpl,lgpl"


def test_lower_threshold(spark):
    check(spark, TEXTS, 60)


@given(st.lists(st.lists(st.sampled_from("licensed under the gnu public license cc by nc 4 0 mit x".split()), max_size=14), min_size=20, max_size=20))
@settings(max_examples=5, deadline=None)
def test_random_blocks(spark, blocks):
    check(spark, [" ".join(b) for b in blocks], 70)


def test_special_cases(spark, edge_documents, no_documents):
    found = rows(licenses.scan(edge_documents), "doc_id", "n_words", "n_base", "score")
    want = [(i, brute.licenses(t)[0], 0, 0.0) for i, t in EDGE_TEXTS]
    assert found == sorted(want, key=repr)
    assert rows(licenses.scan(no_documents)) == []


def test_repeated_rows_and_ids(spark):
    data = [(1, TEXTS[1]), (1, TEXTS[1]), (1, "other"), (None, TEXTS[1]), (None, None)]
    found = rows(licenses.scan(spark.createDataFrame(data, "doc_id bigint, text string")), "doc_id", "labels")
    assert found == sorted([(1, ["mit"]), (1, ["mit"]), (1, []), (None, ["mit"]), (None, [])], key=repr)


def query(spark, texts, folder):
    from ledgerline.llm.queries import op7_license_scan

    frame(spark, texts).write.parquet(f"{folder}/documents.parquet")
    return {r.doc_id: (r.labels.split(",") if r.labels else [], r.score) for r in op7_license_scan(spark, str(folder)).collect()}


def test_wrapped_notices(spark, tmp_path):
    """The query finds every template wrapped at any width, in comments, and beside other paragraphs."""
    import textwrap

    known = list(licenses.TEMPLATES)
    texts = ["\n".join(textwrap.wrap(text, width)) for width in (24, 72) for _, text in known]
    texts += ["Some code\n *\n" + "\n".join(f" * {x}" for x in textwrap.wrap(text, 24)) + "\n *\n\nmore" for _, text in known]
    found = query(spark, texts, tmp_path)
    for i, text in enumerate(texts):
        assert known[i % len(known)][0] in found[i][0] and found[i][1] == 1.0
    want = plain(texts)
    assert [(",".join(found[i][0]), found[i][1]) for i in range(len(texts))] == want


def test_scattered_words_are_no_notice(spark, tmp_path):
    """All words of a notice in one text, line or paragraph, but apart from each other."""
    import random

    rng, filler = random.Random(4), "the quick brown fox sees a lazy dog near our old mill".split()
    texts = []
    for _, text in licenses.TEMPLATES:
        words = text.split()
        rng.shuffle(words)
        texts.append(" ".join(w for word in words for w in (word, *rng.choices(filler, k=6))))
    texts.append("Licensed under CC BY-NC 4.0.\n" + " ".join(filler) + " nd " + " ".join(filler))
    found = query(spark, texts, tmp_path)
    base = [brute.licenses(text)[4] for text in texts]
    assert [",".join(found[i][0]) for i in range(len(texts) - 1)] == base[:-1]
    assert found[len(texts) - 1] == (["cc-by-nc"], 1.0)


def test_a_long_line_with_a_notice_at_every_place(spark):
    check(spark, ["released under the mit license " * 200, "x " * 3000 + "licensed under cc by 4 0", "mit " * 2000])
