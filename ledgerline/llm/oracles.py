"""DuckDB SQL of the text operators' queries, where SQL can express them.

Packing and token counts need a tokenizer, block classification, disclosure and
line rules a procedure: those are tested against brute force.
"""

from __future__ import annotations

from ledgerline.llm.licenses import PERCENT, PHRASES, SLACK_PERCENT, TEMPLATES
from ledgerline.llm.collocations import ABSORBED_PERCENT, LEAST, RANKED
from ledgerline.llm.merkle import HASHED, RUN, TAMPERED_OF
from ledgerline.llm.sharding import HASH_BITS, LIMIT

_SPLIT = "'[ \\x09-\\x0D]+'"
_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _terms(text: str) -> str:
    """Words of digits, small letters and non-ASCII characters, as a list."""
    lower = _ASCII_LOWER.format(f"coalesce({text}, '')")
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _words(text: str) -> str:
    lower = _ASCII_LOWER.format(f"coalesce({text}, '')")
    return f"regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+')"


_SHARDS = f"""
WITH rows AS (
    SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {HASH_BITS // 4}) AS BIGINT) AS hash
    FROM documents
), levels AS (
    SELECT rows.*, d AS depth, hash >> ({HASH_BITS} - d) AS prefix FROM rows, range(0, {HASH_BITS} + 1) t(d)
), sums AS (
    SELECT *, sum(bytes) OVER w AS shard_bytes, count(*) OVER w AS shard_rows
    FROM levels WINDOW w AS (PARTITION BY depth, prefix)
), ends AS (
    SELECT *, row_number() OVER (PARTITION BY hash, doc_id ORDER BY depth) AS k
    FROM sums WHERE shard_bytes <= {LIMIT} OR shard_rows = 1
)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INTEGER), '0') END AS shard,
       CAST(depth AS INTEGER) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows
FROM ends WHERE k = 1
"""

_ARCHIVE = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
named AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM payloads),
firsts AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM named)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND largest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND largest <> page_id THEN largest END AS refers_to
FROM firsts
"""

_phrases = ", ".join(f"('{phrase}', '{label}')" for phrase, label in PHRASES.items())
_templates = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
_LICENSES = f"""
WITH phrases(phrase, label) AS (VALUES {_phrases}),
given(template, label, notice) AS (VALUES {_templates}),
templates AS (
    SELECT template, label, list_distinct(string_split(notice, ' ')) AS own,
           len(string_split(notice, ' ')) + len(string_split(notice, ' ')) * {SLACK_PERCENT} // 100 AS width FROM given
),
docs AS (SELECT doc_id, {_terms('text')} AS words FROM documents),
starts AS (
    SELECT doc_id, words, unnest(range(0, len(words))) AS spot FROM docs WHERE list_contains(words, 'license')
), places AS (
    SELECT doc_id, spot, label FROM starts JOIN phrases
    ON list_slice(words, spot + 1, spot + len(string_split(phrase, ' '))) = string_split(phrase, ' ')
), base AS (
    SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list_distinct(list(label)) AS labels
    FROM places GROUP BY doc_id
), near AS (
    SELECT doc_id, words, templates.* FROM docs JOIN templates ON 100 * len(list_intersect(own, words)) >= {PERCENT} * len(own)
), found AS (
    SELECT *, len(list_intersect(own, list_slice(words, spot + 1, spot + width))) AS common
    FROM (SELECT *, unnest(range(0, len(words))) AS spot FROM near)
    WHERE 100 * len(list_intersect(own, list_slice(words, spot + 1, spot + width))) >= {PERCENT} * len(own)
), wider AS (
    SELECT a.template, b.own AS more, b.width - a.width AS d FROM templates a JOIN templates b
    ON len(b.own) > len(a.own) AND len(list_intersect(a.own, b.own)) = len(a.own)
), covered AS (
    SELECT DISTINCT doc_id, template, spot FROM found JOIN wider USING (template)
    WHERE len(list_intersect(more, list_slice(words, greatest(spot - d, 0) + 1, spot + width + d))) * len(own) >= common * len(more)
), kept AS (
    SELECT doc_id, label, common / len(own) AS containment FROM found ANTI JOIN covered USING (doc_id, template, spot)
), method AS (
    SELECT doc_id, list_distinct(list(label)) AS labels, max(containment) AS score FROM kept GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(method.labels, [])))), ',') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(score, 0) END AS DOUBLE) AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN method USING (doc_id)
"""

_JACCARD = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words('text')} AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ')
                                 ELSE words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] END AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 1))) AS i FROM docs WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 90 * (x.n + y.n - common)
), reach AS (
    SELECT doc_id AS node, doc_id AS other FROM docs
    UNION
    SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (doc_id)
JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""

_OVERLAP = f"""
WITH docs AS (SELECT doc_id, {_terms('text')} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_terms('text')} AS words FROM benchmark),
phrases AS (
    SELECT DISTINCT item_id, list_slice(words, i, i + 12) AS phrase
    FROM (SELECT *, unnest(range(1, greatest(2, len(words) - 11))) AS i FROM items WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT len(phrase) AS n FROM phrases),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs),
hits AS (
    SELECT doc_id, i, n, item_id FROM places JOIN sizes ON i + n - 1 <= len(words)
    JOIN phrases ON phrase = list_slice(words, i, i + n - 1)
), covered AS (
    SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
    FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_MERKLE = f"""
WITH RECURSIVE rows AS (
    SELECT doc_id, source, lang, n_chars, text, CAST(doc_id AS VARCHAR) AS name,
           {_ASCII_LOWER.format('text')} AS small FROM documents
), checked AS (
    -- The checksum of the id's digits, bit by bit.
    SELECT *, xor(4294967295, list_reduce(list_concat([4294967295], flatten([[ord(c), 0, 0, 0, 0, 0, 0, 0] for c in string_split(name, '')])),
           lambda crc, b: xor(xor(crc, b) >> 1, 3988292384 * (xor(crc, b) & 1)))) AS crc FROM rows
), hashed AS (
    SELECT *, sha256(concat({{fields}}, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
           sha256(concat({{fields}}, coalesce(strlen(small) || ':' || small, '-'))) AS changed FROM checked
), leafs AS (
    SELECT doc_id, leaf, CASE WHEN crc % {TAMPERED_OF} = 0 THEN changed ELSE leaf END AS start,
           dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY source) AS size, row_number() OVER () AS id
    FROM hashed
), nodes AS (
    SELECT tree, 0 AS level, place, size, leaf AS hash FROM leafs
    UNION ALL
    SELECT tree, level + 1, place // {RUN}, (any_value(size) + {RUN - 1}) // {RUN}, sha256(string_agg(hash, '' ORDER BY place))
    FROM nodes WHERE size > 1 GROUP BY tree, level, place // {RUN}
), tops AS (SELECT tree, hash FROM nodes WHERE size = 1
), above AS (
    SELECT 0 AS level, tree AS place, (SELECT count(*) FROM tops) AS size, hash FROM tops
    UNION ALL
    SELECT level + 1, place // {RUN}, (any_value(size) + {RUN - 1}) // {RUN}, sha256(string_agg(hash, '' ORDER BY place))
    FROM above WHERE size > 1 GROUP BY level, place // {RUN}
), steps AS (
    SELECT id, level, n.place < own AS before, string_agg(hash, '' ORDER BY n.place) AS hashes
    FROM (SELECT id, tree, level, place // CAST({RUN} ** level AS BIGINT) AS own
          FROM leafs, (SELECT DISTINCT level FROM nodes)) l JOIN nodes n USING (tree, level)
    WHERE n.size > 1 AND n.place // {RUN} = own // {RUN} AND n.place <> own GROUP BY ALL
    UNION ALL
    SELECT id, 100 + level, n.place < own, string_agg(hash, '' ORDER BY n.place)
    FROM (SELECT id, level, tree // CAST({RUN} ** level AS BIGINT) AS own
          FROM leafs, (SELECT DISTINCT level FROM above)) l JOIN above n USING (level)
    WHERE n.size > 1 AND n.place // {RUN} = own // {RUN} AND n.place <> own GROUP BY ALL
), levels AS (
    -- A run of one has no siblings but its own parent.
    SELECT DISTINCT id, level FROM leafs JOIN nodes USING (tree) WHERE nodes.size > 1
    UNION ALL SELECT DISTINCT id, 100 + level FROM leafs, above WHERE above.size > 1
), paths AS (
    SELECT id, list(coalesce(lo, '') || '|' || coalesce(hi, '') ORDER BY level) AS path FROM levels
    LEFT JOIN (SELECT id, level, any_value(hashes) FILTER (WHERE before) AS lo,
                      any_value(hashes) FILTER (WHERE NOT before) AS hi FROM steps GROUP BY id, level) USING (id, level)
    GROUP BY id
), folds AS (
    SELECT leafs.*, tops.hash AS subroot, (SELECT hash FROM above WHERE size = 1) AS root,
           sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
           list_reduce(list_concat([start], coalesce(path, [])),
                       lambda acc, x: sha256(concat(split_part(x, '|', 1), acc, split_part(x, '|', 2)))) AS folded_root
    FROM leafs JOIN tops USING (tree) LEFT JOIN paths USING (id)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folds
""".format(fields=", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in HASHED[:-1]))

_PHRASE_COUNTS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array({_ASCII_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, unnest([list_slice(w, i, i + k - 1) for i in range(1, len(w) - k + 2)]) AS g FROM words, range(1, 4) t(k)
), f AS (SELECT lang, g, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
candidates AS (SELECT lang, g, n AS a FROM f WHERE len(g) > 1 AND n >= {LEAST}),
cuts AS (
    SELECT c.lang, c.g, a, k, x.n AS l, y.n AS r,
           CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, len(g))) AS k FROM candidates) c
    JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
    JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, len(c.g))
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
longer AS (
    SELECT lang, g, max(a) AS most FROM (
        SELECT lang, list_slice(g, 1, 2) AS g, a FROM candidates WHERE len(g) = 3
        UNION ALL SELECT lang, list_slice(g, 2, 3), a FROM candidates WHERE len(g) = 3) GROUP BY ALL
), ranked AS (
    SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM best LEFT JOIN longer USING (lang, g)
    WHERE most IS NULL OR 100 * most < {ABSORBED_PERCENT} * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang) QUALIFY rank <= {RANKED}
"""

ORACLES: dict[str, str] = {
    "op3_extendible_sharding": _SHARDS,
    "op4_warc_normaliser": _ARCHIVE,
    "op7_license_scan": _LICENSES,
    "op9_ngram_jaccard_join": _JACCARD,
    "op10_benchmark_decontamination": _OVERLAP,
    "op11_merkle_manifest": _MERKLE,
    "op12_phrase_collocations": _PHRASE_COUNTS,
}
