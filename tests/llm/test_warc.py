from __future__ import annotations

import gzip
import io
import random
import zlib

from . import brute
import pytest
from .conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import warc

SAME = "<p>" + "same page " * 200 + "</p>"


@given(st.lists(st.tuples(st.integers(0, 99), st.text(max_size=3000)), min_size=1, max_size=5), st.booleans())
@settings(max_examples=50, deadline=None)
def test_records_are_read_from_one_stream(pages, members):
    """From a single gzip member as from a member per record."""
    made = [warc.response_record(i, "http://a/", text.encode(), "2020-01-01T00:00:00Z")[0] for i, text in pages]
    data = b"".join(map(gzip.compress, made)) if members else gzip.compress(b"".join(made))
    found = list(warc.records(io.BytesIO(data)))
    assert [(f["WARC-Record-ID"], b.partition(b"\r\n\r\n")[2].decode()) for f, b in found] == [
        (f"<urn:page:{i}>", text) for i, text in pages
    ]


def test_a_large_record_is_inflated_in_steps():
    payload = b"\x00" * 5_000_000 + random.Random(1).randbytes(3_000_000)
    record, _ = warc.response_record(1, "u", payload, "d")
    ((_, block),) = warc.records(io.BytesIO(gzip.compress(record)))
    assert block.endswith(payload)


def test_a_cut_archive_is_an_error():
    record, _ = warc.response_record(1, "u", b"x" * 5000, "d")
    for data in (gzip.compress(record)[:-20], gzip.compress(record[:-9])):
        with pytest.raises((EOFError, zlib.error)):
            list(warc.records(io.BytesIO(data)))


def pages(spark, data):
    return spark.createDataFrame(data, "page_id bigint, url string, html string, digest string, number int").repartition(4)


DATA = [(i, f"http://x/{i}", SAME if i % 3 == 0 else f"<p>{i}</p>", "x", i) for i in range(60)]
DATA += [(100, None, None, None, None), (101, "", "", None, 1), (102, "http://y/\r\nz", "é" * 999, "x", 1)]


@pytest.mark.parametrize("limit", [256 << 20, 4000])
def test_round_trip(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", limit)
    found = warc.archive_pages(pages(spark, DATA), f"file://{tmp_path}/w").cache()
    want = brute.archived([(r[0], r[2]) for r in DATA])
    assert rows(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    # Every member is a gzip file of its own at the place that the index names.
    for row in found.collect():
        data = open(row.archive.removeprefix("file://"), "rb").read()[row.offset : row.offset + row.length]
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: " + row.record_type.encode())
    files = list((tmp_path / "w").iterdir())
    assert not [f for f in files if f.name.startswith(".")]
    # Read by any gzip reader, a normalised file is its records one after the other.
    total = sum(len(list(warc.records(f.open("rb")))) for f in files if f.name.startswith("records-") and f.suffix == ".gz")
    assert total == len(DATA)


def test_repeated_and_missing_ids(spark, tmp_path):
    data = [(5, "u", SAME, "x", 1), (5, "u", SAME, "x", 1), (4, "u", SAME, "x", 1), (None, "v", SAME, "x", 1), (None, "v", "a", "x", 1)]
    found = rows(warc.archive_pages(pages(spark, data), f"file://{tmp_path}/w"), "page_id", "record_type", "refers_to")
    want = [(5, "response", None), (5, "response", None), (4, "revisit", 5), (None, "revisit", 5), (None, "response", None)]
    assert found == sorted(want, key=repr)


def test_no_pages(spark, tmp_path):
    assert rows(warc.archive_pages(pages(spark, []), f"file://{tmp_path}/w")) == []
