"""Personal data and the terms that give it away, with Spark's built-in functions only.

1. Base spans: e-mail, IP, card and phone patterns, of which those that fail the
   range, Luhn or length check are dropped. Positions come from splitting the text
   at the pattern: lengths of gaps and matches add up to code point offsets.
2. Co-occurrence: all words of a text, wherever they stand, go with each entity (kind
   and value) found in it. Of N different texts n(e) hold the entity, n(t) the term
   and n(e, t) both; copies count once. A term tells
   PMI(e; t) = log2(n(e, t) N / (n(e) n(t))) of the entity's -log2(n(e) / N) bits.
   The share it tells is its disclosure; 1 means that the term occurs only where
   the entity does.
3. Confidence: n(e, t) / n(t) times (``DOUBT`` / V) ** (1 / n(e, t)), V being the
   number of different terms of the corpus, is a lower bound of the term's true
   share, the exact one where the term stands only with the entity. A pair is
   evidence if the disclosure by this bound is ``CERTAIN`` of the level asked for
   at least. Any text with an entity has words found nowhere else, which the bound
   leaves out as chance; in large corpora two texts in common can be enough.
4. Terms whose disclosure of any entity reaches ``REMOVE`` are removed, those that
   reach ``GENERALISE`` become ``[TERM]``, wherever they stand.

Candidates are counted over all documents; the term tables pass through joins and
Spark broadcasts them only by their size. Null and empty texts have no span.
Repeated rows get the same spans each; ids may repeat or be null, rows are found
again by id and text hash. Other columns are passed on by ``sanitise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize

RUN = 256  # matches summed at once
MANY_SPANS = 64
DOUBT = 0.1
CERTAIN = 1 / 3
REMOVE = 0.97
GENERALISE = 0.9
LEAST_LETTERS = 3

# The patterns by kind. Possessive repeats, look-behinds and the least
# number of a card's digits only leave out what would fail, so that long runs are
# passed once and few matches are left to check.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for the pattern to be tried.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_IN_RANGE = rf"^(?:{_BYTE}\.){{3}}{_BYTE}$"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term_generalised": "[TERM]", "term_removed": ""}
KINDS = tuple(PATTERNS)

_FOUND = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = _digits(value)
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    return {
        "email": F.lit(True),
        "ip": value.rlike(IP_IN_RANGE),
        "card": n.between(13, 19) & luhn(value),
        "phone": n.between(9, 15),
    }[kind]


def _with_matches(rows: DataFrame, out: str, pattern: Column, kind: str, where: Column) -> DataFrame:
    """``rows`` with the matches of ``pattern`` in ``text`` as ``out``; none where the condition does not hold.

    Pairs of gap and match are a column of their own, as lambdas run what stands
    in them for each element.
    """
    gaps = F.split("text", pattern, -1)
    values = F.regexp_extract_all("text", pattern, F.lit(0))
    pairs = F.zip_with(values, gaps, lambda v, gap: F.struct(v.alias("value"), gap.alias("before")))
    pairs = F.filter(pairs, lambda x: x["value"].isNotNull())

    def add(acc: Column, row: Column) -> Column:
        start = acc["at"] + F.length(row["before"])
        end = start + F.length(row["value"])
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), row["value"].alias("value")
        )
        return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

    def join(acc: Column, part: Column) -> Column:
        moved = F.transform(
            part["out"], lambda s: s.withField("start", s["start"] + acc["at"]).withField("end", s["end"] + acc["at"])
        )
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    # Places are summed in runs of matches and then over the runs, as every append copies its array.
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out"))
    runs = F.sequence(F.lit(1), F.size("pairs"), F.lit(RUN))
    parts = F.transform(runs, lambda i: F.aggregate(F.slice("pairs", i, F.lit(RUN)), zero, add))
    found = F.aggregate(parts, zero, join, lambda acc: acc["out"])
    none = F.array().cast(_FOUND)
    rows = rows.withColumn("pairs", F.when(where, pairs))
    return rows.withColumn(out, F.when(F.size("pairs") > 0, found).otherwise(none)).drop("pairs")


def with_base(rows: DataFrame) -> DataFrame:
    """``rows`` with the valid matches of all kinds in ``text`` as ``matches``, by kind as listed and place."""
    for kind, pattern in PATTERNS.items():
        hint = F.instr("text", HINTS[kind]) > 0 if HINTS[kind] else F.col("text").rlike("[0-9]")
        rows = _with_matches(rows, kind, F.lit(pattern), kind, hint)

    def valid(kind: str) -> Column:
        return F.filter(kind, lambda m: _valid(kind, m["value"]))

    return rows.withColumn("matches", F.concat(*map(valid, KINDS))).drop(*KINDS)


def _rows(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, the text's hash ``print``, whether the text was null, and the other columns in ``row``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    others = [F.col(f"`{c}`") for c in documents.columns if c not in ("doc_id", "text")]
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("print"),
        F.col("text").isNull().alias("no_text"), F.struct(*others, F.lit(0).alias("")).alias("row"),
    )


def entity_texts(documents: DataFrame) -> DataFrame:
    """``print``, the ``entities`` and the words, ``terms``, of every different text that has an entity."""
    rows = with_base(_rows(documents)).where(F.size("matches") > 0)
    entity = lambda m: F.concat_ws(":", m["kind"], F.lower(m["value"]))
    # Parts of personal data are no terms.
    blank = F.lit("|".join([*PATTERNS.values(), r"[^\p{L}]+"]))
    words = F.split(F.lower(F.regexp_replace("text", blank, F.lit(" "))), r"[^\p{L}]+")
    rows = rows.select(
        "print",
        F.array_distinct(F.transform("matches", entity)).alias("entities"),
        F.filter(F.array_distinct(words), lambda w: F.length(w) >= LEAST_LETTERS).alias("terms"),
    )
    return rows.groupBy("print").agg(F.first("entities").alias("entities"), F.first("terms").alias("terms"))


def term_rows(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``print`` and each distinct word of the text, ``term``."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    return _rows(documents).select("doc_id", "print", F.explode(words).alias("term")).where(F.length("term") >= LEAST_LETTERS)


def _disclosure(n_et: Column, n_t: Column, total: int) -> Column:
    """The share of an entity's bits that a term of ``n_t`` texts tells; an entity of every text has none."""
    share = 1 + F.log2(n_et / n_t) / _bits(total)
    return F.when(F.col("n_e") >= total, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), share))


def _bits(total: int) -> Column:
    return -F.log2(F.col("n_e") / F.lit(float(max(total, 1))))


def _surely(n_et: Column, n_t: Column, total: int, terms: int) -> Column:
    """The disclosure by the lower bound of a term's share, where ``terms`` terms are tried."""
    return _disclosure(n_et * F.pow(F.lit(DOUBT / max(terms, 1)), 1 / n_et), n_t, total)


def disclosing_terms(documents: DataFrame, least: float = GENERALISE) -> DataFrame:
    """Terms whose disclosure of some entity is at least ``least``, and surely a part of it: ``term``, ``disclosure``, the largest."""
    texts = materialize(entity_texts(documents), "entity-texts")
    total = _rows(documents).select("print").distinct().count()
    n_terms = term_rows(documents).agg(F.approx_count_distinct("term", 0.02)).first()[0]

    def evident(n_et: Column, n_t: Column) -> Column:
        return (_disclosure(n_et, n_t, total) >= least) & (_surely(n_et, n_t, total, n_terms) >= CERTAIN * least)

    # An entity counts if a term that stands in just its texts would be evidence.
    entities = texts.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    entities = materialize(entities.where(evident(F.col("n_e"), F.col("n_e"))), "entities")
    most = entities.agg(F.max("n_e")).first()[0]
    if most is None:
        return materialize(documents.sparkSession.createDataFrame([], "term string, disclosure double"), "terms")
    own = texts.select("print", F.explode("entities").alias("entity")).join(entities, "entity").select("print", "entity", "n_e")
    own = materialize(own, "entity-places")
    # A term occurs in no fewer texts than those with any entity, also one that does not count. That bounds its
    # disclosure from above, so common words need not be paired with entities or counted in all texts.
    near = texts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_near"))
    largest = F.lit(float(most))
    bound = F.when(F.lit(most >= total), F.lit(True)).otherwise(
        F.log2(F.col("n_near")) <= F.log2(largest) + (1 - least) * (F.log2(F.lit(float(total))) - F.log2(largest)) + 1e-9
    )
    near = materialize(near.where(bound), "near")
    rows = texts.join(own.select("print").distinct(), "print", "left_semi").select("print", F.explode("terms").alias("term"))
    pairs = rows.join(near, "term").join(own, "print").groupBy("entity", "term").agg(
        F.count("*").alias("n_et"), F.first("n_e").alias("n_e"), F.first("n_near").alias("n_near")
    )
    pairs = materialize(pairs.where(evident(F.col("n_et"), F.col("n_near"))), "pairs")
    candidates = materialize(pairs.select("term").distinct(), "candidates")
    counts = term_rows(documents).join(candidates, "term").groupBy("term").agg(F.count_distinct("print").alias("n_t"))
    told = pairs.join(counts, "term").where(evident(F.col("n_et"), F.col("n_t")))
    told = told.groupBy("term").agg(F.max(_disclosure(F.col("n_et"), F.col("n_t"), total)).alias("disclosure"))
    return materialize(told, "terms")


def spans(documents: DataFrame, remove: float = REMOVE) -> DataFrame:
    """``doc_id``, ``text``, ``base`` and ``terms`` spans (``kind``, ``start``, ``end``) of every row, and the ``row`` itself."""
    terms = disclosing_terms(documents)
    own = (
        term_rows(documents).join(terms, "term").groupBy("doc_id", "print")
        .agg(
            F.collect_set("term").alias("terms"),
            F.collect_set(F.when(F.col("disclosure") >= remove, F.col("term"))).alias("removed"),
        )
    )
    own = materialize(own, "own-terms")
    rows = _rows(documents).alias("d").join(
        own.alias("o"), F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("d.print") == F.col("o.print")), "left"
    ).select("d.*", "terms", "removed")
    rows = with_base(rows).withColumn("base", _bare(F.col("matches"))).drop("matches")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    rows = _with_matches(rows, "found", pattern, "", F.col("terms").isNotNull())
    outside = F.filter(
        "found", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    )
    kind = lambda m: F.when(F.array_contains("removed", F.lower(m["value"])), "term_removed").otherwise("term_generalised")
    found = F.transform(outside, lambda m: F.struct(kind(m).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    found = F.array_sort(found)
    return rows.select("doc_id", "text", "no_text", "row", "base", found.alias("terms"))


def _bare(matches: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def span_list(found: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def n_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")


def with_masked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``clean``: the text, each span of ``base`` and ``terms`` replaced by its label.

    Where spans overlap the one that starts first goes in full. A substring is
    sought from the text's beginning; with many spans the text is taken apart once.
    """
    by_start = F.array_sort(
        F.transform(
            F.concat("base", "terms"),
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus"), s["kind"].alias("kind")),
        )
    )
    labels = F.create_map(*(F.lit(x) for pair in LABELS.items() for x in pair))
    many = F.size("by_start") > MANY_SPANS

    def piece(start: Column, n: Column) -> Column:
        return F.when(many, F.array_join(F.slice("letters", start + 1, n), "")).otherwise(F.substring("text", start + 1, n))

    def add(acc: Column, s: Column) -> Column:
        end = -s["minus"]
        gap = piece(acc["at"], F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = F.struct(end.alias("at"), F.array_append(F.array_append(acc["out"], gap), labels[s["kind"]]).alias("out"))
        longer = F.struct(F.greatest(acc["at"], end).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], new).otherwise(longer)

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), piece(acc["at"], F.greatest(F.length("text") - acc["at"], F.lit(0))))

    rows = rows.withColumn("by_start", by_start)
    rows = rows.withColumn("letters", F.when(many, F.split("text", "")))
    clean = F.when(F.size("by_start") == 0, F.col("text")).otherwise(F.aggregate("by_start", zero, add, finish))
    return rows.withColumn("clean", clean).drop("by_start", "letters")


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents with all columns, personal data masked and disclosing terms removed or generalised.

    ``n_chars``, if there, is the new length. Null texts stay null.
    """
    found = with_masked(spans(documents))
    found = found.withColumn("clean", F.when(~F.col("no_text"), F.col("clean")))
    new = {"doc_id": F.col("doc_id"), "text": F.col("clean"), "n_chars": F.length("clean")}
    kinds = dict(documents.dtypes)
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).cast(kinds[c]).alias(c) for c in documents.columns))
