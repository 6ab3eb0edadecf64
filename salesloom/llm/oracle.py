"""SQL twins of the operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from salesloom.llm import quality

WORDS = (
    "list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')")

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {WORDS.format(text='''translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')''')} AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
        THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)
        AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
                      FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
         JOIN n nx ON nx.doc_id = a JOIN n ny ON ny.doc_id = b
    WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id,
       d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN component c USING (doc_id)
"""


def _distance(p: str, q: str) -> str:
    term = "CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p}[i] + {q}[i]) / 2)) ELSE 0 END"
    both = " + ".join(term.format(x=f"{v}[i]", p=p, q=q) for v in (p, q))
    return f"sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), lambda i: ({both}) / 2)), 0))"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_LISTED = "CASE lang " + " ".join(
    f"WHEN '{k}' THEN {_list(ws)}" for k, ws in quality.COMMON_WORDS.items()) + " END"

QUALITY = f"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (
    SELECT *, {WORDS.format(text='text')} AS w, length(text) AS chars,
           list_filter(string_split(text, chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM t),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g
    FROM w, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS times FROM windows),
         (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY doc_id),
c AS (
    SELECT w.doc_id, lang, len(w) AS n_words,
           length(array_to_string(w, '')) AS word_chars,
           chars - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, chars,
           chars - length(regexp_replace(text, '\\p{{Lu}}+', '', 'g')) AS upper,
           chars - length(regexp_replace(text, '[0-9]+', '', 'g')) AS digit,
           chars - length(regexp_replace(text, '[.,;:!?''"()\\[\\]-]+', '', 'g')) AS mark,
           list_transform({_LISTED}, lambda v: len(list_filter(w, lambda x: x = v))) AS listed,
           len(list_filter(w, lambda x: list_contains({_list(quality.SIGNS)}, x))) AS signs
    FROM w LEFT JOIN repeated r ON r.doc_id = w.doc_id),
h AS (
    SELECT *, CASE WHEN chars > 0 THEN list_transform(
               [upper, digit, mark, n_symbols, chars - word_chars,
                greatest(word_chars - upper - digit - mark - n_symbols, 0)],
               lambda x: CAST(x AS DOUBLE) / (upper + digit + mark + n_symbols + chars - word_chars
                 + greatest(word_chars - upper - digit - mark - n_symbols, 0))) END AS p,
           CASE WHEN n_words > 0 THEN list_transform(
               list_append(list_append(listed, signs), n_words - list_sum(listed) - signs),
               lambda x: CAST(x AS DOUBLE) / n_words) END AS q
    FROM c),
r AS (
    SELECT lang AS language,
           [{', '.join(f'avg(p[{i + 1}])' for i in range(len(quality.CLASSES)))}] AS rp,
           [{', '.join(f'avg(q[{i + 1}])' for i in range(quality.WORD_SLOTS + 1))}] AS rq
    FROM h WHERE n_words >= {quality.LEAST_WORDS} GROUP BY lang),
d AS (
    SELECT h.*, {_distance('p', 'rp')} AS class_distance,
           CASE WHEN n_words >= {quality.GUARD_WORDS} THEN {_distance('q', 'rq')} END AS word_distance,
           n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words
             > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed
    FROM h LEFT JOIN r ON language IS NOT DISTINCT FROM lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(class_distance, 0) <= {quality.MOST_CLASS_DISTANCE}
         AND coalesce(word_distance, 0) <= {quality.MOST_WORD_DISTANCE} AS kept,
       round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM d
"""

# SHA-1 as text, then its bits, then a letter for each five of them.
ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
             sha1(html) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
          lpad(to_base(instr('0123456789abcdef', hex[i]) - 1, 2), 4, '0')), '') AS bits FROM h),
five AS (SELECT list_transform(range(0, 32), lambda i: lpad(to_base(i, 2), 5, '0')) AS known),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[list_position(known, bits[5 * i + 1:5 * i + 5])]), '')
          AS payload_digest FROM b, five),
o AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM o
"""

COLLOCATIONS = """
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
g AS (SELECT lang, w[i:i + k - 1] AS g
      FROM w, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i), (SELECT unnest([1, 2, 3]) AS k)
      WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY lang, g),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT lang, g, f AS a FROM f WHERE len(g) > 1 AND f >= 10),
around AS (SELECT lang, g[i:i + 1] AS g, max(a) AS longer
           FROM c, (SELECT unnest([1, 2]) AS i) WHERE len(g) = 3 GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN around USING (lang, g)
         WHERE len(g) = 3 OR 100 * coalesce(longer, 0) < 50 * a),
cuts AS (SELECT kept.lang, kept.g, a, k, x.f AS l, y.f AS r,
                CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
         FROM kept JOIN (SELECT unnest([1, 2]) AS k) ON k < len(g)
              JOIN f x ON x.lang = kept.lang AND x.g = kept.g[1:k]
              JOIN f y ON y.lang = kept.lang AND y.g = kept.g[k + 1:]),
best AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM cuts
         QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
     JOIN n USING (lang)
WHERE rank <= 2000
"""

_TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

RANKED_SEARCH = f"""
WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY doc_id),
a AS (SELECT count(*) AS N_docs, CAST(sum(n) AS BIGINT) AS L FROM d),
m AS (SELECT doc_id, 100 - 25 + ((25 * n * N_docs) // L) AS m FROM d, a),
w AS (SELECT term, CAST(floor(1000 * ln((2 * N_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM p, a GROUP BY term, N_docs),
q AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

QUERIES = {"op1_minhash_dedup": NEAR_DUPLICATES, "op4_quality": QUALITY, "op11_ranked_search": RANKED_SEARCH,
           "op12_warc": ARCHIVES, "op13_collocations": COLLOCATIONS}
