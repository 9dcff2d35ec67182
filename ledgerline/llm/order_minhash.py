"""Document fingerprints by Order MinHash, with Spark's built-in functions only.

A text's symbols are its words, runs without white space, long ones cut at
``SYMBOL`` characters. A k-mer is a run of ``KMER`` symbols, or all of a shorter
text; equal k-mers of a text are numbered in text order, so that a text of
repetitions is not one k-mer.

A numbered k-mer has one 64-bit hash. Slot j of ``SLOTS`` orders them by the
distance of the hash from j / ``SLOTS`` of the range upwards, and round from the end
to the beginning, takes the ``TUPLE`` first, puts them back into text order and
hashes the tuple of k-mers. So a slot changes when its k-mers change or their
order does. The fingerprint lists the slots' hashes; two texts are alike by the
share of slots that are equal, which falls with their edit distance.

Everything of a text is done on its row: hashes are packed with their places into
whole numbers, so that sorting arrays numbers k-mers and orders them by hash. A
text's words are never rows of a table, and none is shuffled.

Null texts count as empty. A text without words has an empty fingerprint, which is
like itself only. Equal texts have equal fingerprints. ``edited`` gives each
document the beginning of the next one, in descending ``doc_id`` and, where ids
repeat, by hash of the text; rows equal in both are one document there and have
equal results. A null id comes last. Further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, release
from ledgerline.llm.ranks import numbered

SYMBOL = 16
KMER = 3
TUPLE = 2
SLOT_BITS = 6
SLOTS = 1 << SLOT_BITS
HASH_CHARS = 4  # hexadecimal digits of a slot in the fingerprint

_SYMBOLS = rf"[^\x20\x09-\x0D]{{1,{SYMBOL}}}"


def _at(array: str, place: Column) -> Column:
    return F.get(F.col(array), place)


def with_fingerprint(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with the fingerprint of the text column ``text``, never null.

    Every array is a column of its own and used more than once, so that Spark does
    not compute it anew for each element of the next.
    """
    own = rows.withColumn("_symbols", F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(_SYMBOLS), F.lit(0)))
    size = F.size("_symbols")
    # Bits that a place, counted from 1, takes in a packed number; 0 marks a slot.
    bits = F.length(F.bin(F.greatest(size, F.lit(1)).cast("bigint") + 1))
    own = own.withColumn("_bits", bits).withColumn("_n", F.when(size == 0, 0).otherwise(F.greatest(size - (KMER - 1), F.lit(1))))
    kmer = lambda i: F.xxhash64(*(_at("_symbols", i + k) for k in range(KMER)))
    places = F.when(F.col("_n") == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.col("_n") - 1))
    own = own.withColumn("_kmers", F.transform(places, kmer)).drop("_symbols")

    # Places in order of their k-mers: equal ones stand together, in text order.
    own = own.withColumn("_mask", F.expr("shiftleft(1L, _bits) - 1"))
    pack = "(({value}) & ~_mask) | ({place} + 1)"
    own = own.withColumn("_by_kmer", F.sort_array(F.expr(f"transform(_kmers, (h, i) -> {pack.format(value='h', place='i')})")))
    place = "cast(({}) & _mask as int) - 1"
    at = "get(_kmers, " + place + ")"
    # How many equal k-mers stand before: they are the ones next before, so their number is found by halving.
    equal = at.format("get(_by_kmer, i - o - b)") + " = " + at.format("x")
    number = (
        f"if(i > 0 and {at.format('get(_by_kmer, i - 1)')} = {at.format('x')}, "
        f"aggregate(transform(sequence(_bits, 0, -1), e -> shiftleft(1, e)), 0, (o, b) -> if(i - o - b >= 0 and {equal}, o + b, o)), 0)"
    )
    value = f"xxhash64({at.format('x')}, {number})"
    own = own.withColumn(
        "_by_hash", F.sort_array(F.expr(f"transform(_by_kmer, (x, i) -> {pack.format(value=value, place=place.format('x'))})"))
    ).drop("_by_kmer")
    # Where the slots begin: their marks are sorted among the hashes.
    marks = F.array(*(F.lit(((j << (64 - SLOT_BITS)) + (1 << 63)) % (1 << 64) - (1 << 63)) for j in range(SLOTS)))
    own = own.withColumn("_marked", F.sort_array(F.concat("_by_hash", marks)))
    starts = F.expr("filter(transform(_marked, (x, i) -> if(x & _mask = 0, i, null)), i -> i is not null)")
    own = own.withColumn("_starts", starts).drop("_marked")
    # The k-mers of a slot's tuple in text order.
    spot = "cast(get(_by_hash, (s - j + {}) % _n) & _mask as int) - 1"
    chosen = "array_sort(array(" + ", ".join(spot.format(t) for t in range(TUPLE)) + "))"
    tuple_hash = f"xxhash64(transform({chosen}, p -> get(_kmers, p)))"
    slots = F.expr(f"transform(_starts, (s, j) -> lower(right(lpad(hex({tuple_hash}), 16, '0'), {HASH_CHARS})))")
    fingerprint = F.when(F.col("_n") == 0, F.lit("")).otherwise(F.array_join(slots, ""))
    return own.withColumn(out, fingerprint).drop("_kmers", "_by_hash", "_starts", "_bits", "_mask", "_n")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal slots of two fingerprints; two empty ones are alike."""
    width = HASH_CHARS
    pieces = [F.when(F.substring(a, j * width + 1, width) == F.substring(b, j * width + 1, width), 1).otherwise(0) for j in range(SLOTS)]
    same = reduce(lambda x, y: x + y, pieces) / F.lit(float(SLOTS))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(same)


def _key(doc_id: str) -> Column:
    """What tells documents apart: the id, if any, and the hash of the text."""
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col("print").cast("string"))


def _rows(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("text").alias("print"), F.length("text").cast("bigint").alias("n_chars"))


def neighbours(documents: DataFrame) -> DataFrame:
    """``key`` of each different document, ``to_key`` of the one before it, and ``takes``, half of that one's characters.

    Ids, hashes and lengths are all that is sorted, by ranges.
    """
    keys = materialize(
        _rows(documents).select("doc_id", "print", "n_chars").distinct()
        # Sorted upwards by the negative id; a null id, the last, goes on by itself.
        .withColumns({"all": F.lit(0), "last": F.col("doc_id").isNull(), "down": -F.col("doc_id")}),
        "ring-keys",
    )
    placed, scratch = numbered(keys, "all", "last", "down", "print")
    ring = materialize(placed.select(_key("doc_id").alias("key"), "n_chars", "place", "group_size"), "ring")
    release(keys, *scratch)
    before = ring.select(
        F.col("key").alias("to_key"), F.floor(F.col("n_chars") / 2).cast("int").alias("takes"),
        F.pmod(F.col("place") + 1, F.col("group_size")).alias("place"),
    )
    found = materialize(ring.select("key", "place").join(before, "place").drop("place"), "ring-links")
    release(ring)
    return found


def edited(documents: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, those of its edited text and of the next document, and the texts' likeness.

    The edited text has the last half of the characters replaced by the first as
    many of the next document. Texts meet their place in the ring in one shuffle,
    which also serves to keep their own half; the halves that they give away are
    the other. Fingerprints are written before they are compared, so that a
    condition on the likeness does not compute them again.
    """
    links = neighbours(documents)
    rows = with_fingerprint(_rows(documents), "text", "fingerprint")
    # Both uses below read all of these columns, or else Spark would shuffle the texts for each.
    rows = rows.select(_key("doc_id").alias("key"), "n_chars", "fingerprint", "text").join(links, "key")
    given = F.substring(F.col("text"), F.lit(1), F.least("takes", F.col("n_chars").cast("int"))).alias("given")
    gives = rows.select("to_key", given, F.col("fingerprint").alias("next_fingerprint"))
    # Rows that repeat give the same.
    gives = gives.groupBy("to_key").agg(F.first("given").alias("given"), F.first("next_fingerprint").alias("next_fingerprint"))
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    own = rows.select("key", "n_chars", "fingerprint", kept.alias("kept"))
    both = own.join(gives, F.col("key") == F.col("to_key"))
    doc_id = F.nullif(F.substring_index("key", ":", 1), F.lit("")).cast("bigint").alias("doc_id")
    both = both.select(doc_id, "n_chars", "fingerprint", "next_fingerprint", F.concat("kept", "given").alias("edited"))
    both = with_fingerprint(both, "edited", "edited_fingerprint").withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    found = materialize(both, "fingerprints")
    release(links)
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
