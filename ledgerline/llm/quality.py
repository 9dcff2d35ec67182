"""Line-first cleaning: rules judge each line, failing lines go, texts that lose too much are rejected.

A line is a part between ``\\n`` characters; its words are parted by blanks, tabs and
the other white space of ``\\x09-\\x0D``. Lines without words are neither judged nor
counted. Line rules, the first that holds names the reason:

``navigation``   a quarter or more of its words are only separators such as ``|``
``symbols``      a tenth or more of its non-blank characters are mark-up symbols
``shouting``     five words or more and no small letter
``boilerplate``  it holds one of ``BOILERPLATE`` and has at most 30 words
``punctuation``  fewer than ``SHORT_LINE`` words and no closing punctuation mark

A text is rejected when it fails the base rules (fewer than 20 words, or more than
30 % of its words stand in repeated runs of eight), or when the lines that pass
hold less than ``KEEP_SHARE`` of its non-blank characters. Null texts count as
empty ones and are rejected. Repeated rows are judged each by itself; other
columns are passed on by ``clean`` and ignored by ``measure``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import SPACE_ONLY, codes, slices, words

LEAST_WORDS = 20
RUN = 8
MOST_REPEATED_PERCENT = 30
SHORT_LINE = 5
KEEP_SHARE = 0.5
SLICE_BYTES = 4 << 20  # of text at once; its lines stand in memory several times
SYMBOLS = b"#*$%&|<>"
# Separators of menus, phrases of boilerplate, closing marks.
SEPARATORS = frozenset("| || » « › ‹ • · / \\ > >> < << - – — → ← :: ~".split())
BOILERPLATE = (
    "accept all cookies", "all rights reserved", "cookie policy", "enable javascript", "javascript is disabled",
    "lorem ipsum", "privacy policy", "sign up for our newsletter", "subscribe to our", "terms of service",
    "terms of use", "this site uses cookies", "use of cookies", "we use cookies",
)
CLOSING = tuple(".!?…:;。！？؟।")
CLOSERS = "\"')]}»”’›*"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_BLANKS = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OTHER_BLANKS = re.compile(r"[\x09-\x0D]|\x20\x20")
_NOT_SYMBOL = re.compile("[^" + re.escape(SYMBOLS.decode()) + "]+")
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)), re.IGNORECASE)

MEASURES = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, n_lines bigint, n_failed_lines bigint, kept_share double"
)


def line_fault(line: str) -> str | None:
    """Why ``line`` (with a word, blanks trimmed) fails, or None."""
    marks = len(_NOT_SYMBOL.sub("", line))
    n_words = line.count(" ") + 1
    if marks or any(c in line for c in "»«›‹•·/\\–—→←:~-") or _OTHER_BLANKS.search(line):
        parts = _WORD.findall(line)
        n_words = len(parts)
        if n_words >= 3 and 4 * sum(p in SEPARATORS for p in parts) >= n_words:
            return "navigation"
        if 10 * marks >= sum(map(len, parts)):
            return "symbols"
    if n_words >= 5 and line.isupper():
        return "shouting"
    if n_words <= 30 and _BOILERPLATE.search(line):
        return "boilerplate"
    if n_words < SHORT_LINE and not line.rstrip(CLOSERS).endswith(CLOSING):
        return "punctuation"
    return None


def _lines(text: str) -> tuple[list[str], int, int, int, int]:
    """Lines that pass, number of judged and failed lines, non-blank characters before and after."""
    passed, judged, failed, before, after = [], 0, 0, 0, 0
    for line in text.split("\n"):
        bare = line.strip(_BLANKS)
        if not bare:
            continue
        judged += 1
        chars = len(bare) - sum(map(bare.count, _BLANKS))
        before += chars
        if line_fault(bare):
            failed += 1
        else:
            passed.append(line)
            after += chars
    return passed, judged, failed, before, after


def repeated_words(code: np.ndarray, starts: np.ndarray, run: int = RUN) -> np.ndarray:
    """For each text the number of words in runs of ``run`` words that it holds twice or more."""
    n = len(code) - run + 1
    covered = np.zeros(len(code) + 1, np.int64)
    if n > 0:
        row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        inside = row[:n] == row[run - 1 :]
        h = row[:n].astype(np.uint64)
        with np.errstate(over="ignore"):
            for k in range(run):
                h = (h + code[k : k + n].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        ordered = np.sort(h[inside])
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.searchsorted(twice, h)
            at = np.flatnonzero(inside & (twice[np.minimum(at, len(twice) - 1)] == h))
            # Equal hashes are compared word by word.
            full = np.column_stack([row[at], *(code[at + k] for k in range(run))])
            _, inverse, counts = np.unique(full, axis=0, return_inverse=True, return_counts=True)
            at = at[counts[inverse.ravel()] > 1]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + run, -1)
    hit = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
    return hit[starts[1:]] - hit[starts[:-1]]


def _measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base figures of each text."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    flat, starts = words(texts, SPACE_ONLY)
    code, _ = codes(flat)
    chars = np.concatenate(([0], np.cumsum(pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64))))
    raw = texts.buffers()
    ends = np.frombuffer(raw[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    at = np.flatnonzero(_SYMBOL[data[ends[0] : ends[-1]]]) + ends[0]
    symbols = np.searchsorted(at, ends)
    split = pc.split_pattern(texts, "\n")
    lines = split.flatten()
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    line, values = codes(lines)
    blank = pc.binary_length(pc.ascii_trim_whitespace(values)).to_numpy(zero_copy_only=False) == 0
    full = ~blank[line] if len(values) else np.zeros(0, bool)
    row, line = row[full], line[full]
    distinct = np.unique(row.astype(np.int64) * (len(values) + 1) + line) // (len(values) + 1)
    n = len(texts)
    return {
        "n_words": np.diff(starts),
        "word_chars": chars[starts[1:]] - chars[starts[:-1]],
        "n_symbols": np.diff(symbols),
        "n_dup_lines": np.bincount(row, minlength=n) - np.bincount(distinct, minlength=n),
        "n_repeat_words": repeated_words(code, starts),
    }


def _verdicts(texts: pa.Array) -> tuple[dict[str, np.ndarray], list[str]]:
    found = _measures(texts)
    judged = [_lines(text) for text in pc.fill_null(texts, "").to_pylist()]
    before = np.array([x[3] for x in judged], np.float64)
    after = np.array([x[4] for x in judged], np.float64)
    found["base_failed"] = (found["n_words"] < LEAST_WORDS) | (
        100 * found["n_repeat_words"] > MOST_REPEATED_PERCENT * found["n_words"]
    )
    found["kept_share"] = after / np.maximum(before, 1)
    found["kept"] = ~found["base_failed"] & (found["kept_share"] >= KEEP_SHARE)
    found["n_lines"] = np.array([x[1] for x in judged], np.int64)
    found["n_failed_lines"] = np.array([x[2] for x in judged], np.int64)
    return found, ["\n".join(x[0]) for x in judged]


def measure(documents: DataFrame) -> DataFrame:
    """Figures and verdict of every document, see ``MEASURES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in MEASURES.split(", ")]
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found, _ = _verdicts(part.column("text"))
                columns = [part.column("doc_id"), *(pa.array(found[k]) for k in names[1:])]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, MEASURES)


def clean(documents: DataFrame) -> DataFrame:
    """The documents kept, with all columns; ``text`` holds the lines that passed, ``n_chars`` (if there) its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found, texts = _verdicts(part.column("text"))
                at = part.schema.get_field_index("text")
                part = part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
                yield part.filter(pa.array(found["kept"]))

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in documents.schema.fields])
    out = documents.mapInArrow(run, schema)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out
