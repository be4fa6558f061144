"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_NAME_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce({_BLANK_WORDS.format(_LOWER)}, []) AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), both_have AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM both_have JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * k >= 75 * (na.n + nb.n - k)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, root) AS (
    SELECT doc_id, doc_id FROM d
    UNION
    SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""

OP2 = f"""
WITH d AS (
    SELECT doc_id, coalesce({_NAME_WORDS}, []) AS w FROM documents
), i AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_NAME_WORDS} AS w FROM benchmark
), iw AS (
    SELECT DISTINCT item, w[k:k + 12] AS p
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 11, 2))) AS k FROM i WHERE len(w) > 0)
), lens AS (SELECT DISTINCT len(p) AS m FROM iw
), dw AS (
    SELECT doc_id, k, m, w[k:k + m - 1] AS p
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, lens WHERE len(w) >= m)
), hits AS (
    SELECT doc_id, k, m, item FROM dw JOIN iw USING (p)
), words AS (
    SELECT doc_id, count(DISTINCT x) AS n_hit
    FROM (SELECT doc_id, unnest(range(k, k + m)) AS x FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = f"""
WITH d AS (
    SELECT doc_id, coalesce({_BLANK_WORDS.format('text')}, []) AS w FROM documents
), win AS (
    SELECT doc_id, k, md5(array_to_string(w[k:k + 49], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM d WHERE len(w) >= 50)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS x
    FROM win JOIN (SELECT h, min(doc_id) AS first_doc FROM win GROUP BY h) USING (h)
    WHERE first_doc < doc_id
), every AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS x FROM d
), kept AS (
    SELECT doc_id, count(*) FILTER (gone.x IS NOT NULL) AS n_removed,
           string_agg(word, ' ' ORDER BY e.x) FILTER (gone.x IS NULL) AS text
    FROM every e LEFT JOIN gone USING (doc_id, x) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP7 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), r AS (
    SELECT query_id, vec_id, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP9 = """
WITH u AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0
                         THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), h AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(regexp_replace(coalesce(rest, ''), '^[^/?#]*', ''), '^[^?#]*') AS path
    FROM u
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), hits AS (
    SELECT h.host, h.path, rule_host || rule_path AS rule, verdict,
           row_number() OVER (PARTITION BY h.host, h.path
                              ORDER BY length(rule_host || rule_path) DESC) AS n
    FROM (SELECT DISTINCT host, path FROM h) h JOIN rules
      ON (h.host = rule_host OR h.host LIKE '%.' || rule_host) AND starts_with(h.path, rule_path)
)
SELECT page_id, h.host, h.path, rule, coalesce(verdict, 'allow') AS verdict
FROM h LEFT JOIN (SELECT * FROM hits WHERE n = 1) x ON h.host = x.host AND h.path = x.path
"""

OP11 = rf"""
WITH RECURSIVE bytes_of AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), runs AS (
    SELECT doc_id, run, count(*) AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
    WHERE length(run) >= 7 GROUP BY doc_id, run
), checked AS (
    SELECT run, k, CASE WHEN x IS NOT NULL THEN xor(list_reduce(list_concat([4294967295],
        list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) END AS h
    FROM (SELECT run, k, hex(doc_id || ':' || run) AS x FROM runs), bytes_of
), words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k
          FROM checked)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), less AS (
    SELECT word, i, word[:i - 1] || word[i + 1:] AS short
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS other FROM less a JOIN less b USING (i, short) WHERE a.word <> b.word
    UNION SELECT l.word, w.word FROM less l JOIN words w ON w.word = l.short
    UNION SELECT w.word, l.word FROM less l JOIN words w ON w.word = l.short
), near AS (
    SELECT p.word, p.other, w.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
           row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.other) AS place
    FROM pairs p JOIN words w ON w.word = p.other
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
           CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN (SELECT * FROM near WHERE place = 1) t USING (word)
), walk(word, reached) AS (
    SELECT word, word FROM formed
    UNION ALL SELECT k.word, f.form FROM walk k JOIN formed f ON f.word = k.reached WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, k.reached AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk k ON k.word = f.word JOIN formed last ON last.word = k.reached AND last.form IS NULL
"""

OP12 = r"""
WITH steps_of AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), turns AS (
    SELECT conv_id, md5(length(r) || ':' || r || t) AS said, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t
          FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
    SELECT conv_id, xor(list_reduce(list_concat([4294967295],
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT))),
               lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), steps_of
), rebuilt AS (
    SELECT c.conv_id, t.said, t.words, t.place - 4 AS place
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, t.said, t.words, t.place FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
), ways AS (
    SELECT conv_id, coalesce(said, []) AS said, coalesce(words, []) AS words
    FROM convs LEFT JOIN (
        SELECT conv_id, list(said ORDER BY place) AS said, list(words ORDER BY place) AS words
        FROM rebuilt GROUP BY conv_id) USING (conv_id)
), nodes AS (
    SELECT way, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS words,
           coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends
    FROM (SELECT said[1:depth] AS way, depth, conv_id, words[depth] AS w, len(said) AS n
          FROM (SELECT *, unnest(range(0, len(said) + 1)) AS depth FROM ways))
    GROUP BY way, depth
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id,
           (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.way[1:n.depth] = n.way) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.way = n.way[1:n.depth - 1]
)
SELECT v.conv_id, v.depth, any_value(v.parent_conv_id) AS parent_conv_id, any_value(v.n_convs) AS n_convs,
       any_value(v.n_children) AS n_children, count(*) FILTER (x.n_children = 0) AS n_leaves,
       CAST(sum((x.n_convs - 1) * coalesce(x.words, 0)) AS BIGINT) AS saved_tokens,
       sha256(any_value(v.ends)) AS ends_sha256
FROM linked v JOIN linked x ON x.depth >= v.depth AND x.way[1:v.depth] = v.way
GROUP BY v.conv_id, v.depth
"""

OP13 = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n, row_number() OVER () AS place,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER same = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm ORDER BY n DESC, doc_id, place)
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_ngram_jaccard_join": OP1,
        "op2_decontamination": OP2,
        "op5_substring_dedup": OP5,
        "op7_maxscore_search": OP7,
        "op9_url_filter": OP9,
        "op11_spelling_variants": OP11,
        "op12_prefix_trie": OP12,
        "op13_exact_dedup": OP13,
    }
