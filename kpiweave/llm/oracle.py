"""DuckDB twins of the queries of this folder that SQL can express."""

from __future__ import annotations

OP1_WARC = """
WITH p AS (
    SELECT page_id, COALESCE(html, '') AS html FROM pages
), d AS (
    SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
           sha256(html) AS payload_digest
    FROM p
), h AS (
    SELECT *, MIN(page_id) OVER (PARTITION BY payload_digest) AS holder FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > holder THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > holder THEN holder END AS refers_to
FROM h
"""

_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _lower(text: str) -> str:
    return f"translate(COALESCE({text}, ''), {_ABC})"


_ALNUM = rf"regexp_extract_all({_lower('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANK = r"[^\x20\x09-\x0D]+"

OP2_DECONTAMINATE = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents
), i AS (
    SELECT item_id, {_ALNUM} AS w FROM benchmark WHERE item_id IS NOT NULL
), win AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n,
           array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS p
    FROM i, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(s)
    WHERE len(w) > 0
), lens AS (
    SELECT DISTINCT n FROM win
), dwin AS (
    SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS p
    FROM d, lens, unnest(range(1, len(w) - n + 2)) AS t(s)
), hit AS (
    SELECT r, s, n, item_id FROM dwin JOIN win USING (n, p)
), words AS (
    SELECT r, COUNT(DISTINCT s + j) AS n_hit
    FROM hit, unnest(range(0, n)) AS t(j) GROUP BY r
), items AS (
    SELECT r, COUNT(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items,
       sha256(COALESCE(ids, '')) AS items_sha256,
       COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP8_SUBSTRINGS = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(COALESCE(text, ''), '{_BLANK}') AS w
    FROM documents
), win AS (
    SELECT r, doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) AS p
    FROM d, unnest(range(1, len(w) - 48)) AS t(s)
), dup AS (
    SELECT r, s FROM (SELECT *, MIN(doc_id) OVER (PARTITION BY p) AS f FROM win)
    WHERE f < doc_id
), gone AS (
    SELECT DISTINCT r, s + j AS i FROM dup, unnest(range(0, 50)) AS t(j)
), kept AS (
    SELECT r, string_agg(x.word, ' ' ORDER BY x.i) AS k, COUNT(*) AS n
    FROM (SELECT r, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)) AS x
    ANTI JOIN gone USING (r, i)
    GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - COALESCE(n, 0) AS BIGINT) AS n_removed,
       sha256(COALESCE(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP12_SEARCH = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents
), n AS (
    SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0
), total AS (
    SELECT COUNT(*) AS docs, SUM(n) AS terms FROM n
), q AS (
    SELECT i, item_id, unnest(list_distinct(w)) AS t
    FROM (SELECT row_number() OVER () AS i, item_id, {_ALNUM} AS w FROM benchmark)
), tf AS (
    SELECT r, t, COUNT(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d)
    WHERE t IN (SELECT t FROM q) GROUP BY r, t
), wt AS (
    SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
    FROM tf, total GROUP BY t, docs
), s AS (
    SELECT i, item_id, doc_id, r,
           CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT)
               AS score
    FROM q JOIN tf USING (t) JOIN wt USING (t) JOIN n USING (r), total
    GROUP BY ALL
), k AS (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS FIRST) AS place_no
    FROM s WHERE score > 0
)
SELECT item_id, CAST(place_no AS INTEGER) AS rank, doc_id, score FROM k WHERE place_no <= 50
"""


def _crc32(text: str) -> str:
    """Bit by bit, the lowest first, over the bytes of an ASCII text."""
    bits = f"flatten([[(ascii(c) >> k) & 1 FOR k IN range(8)] FOR c IN string_split({text}, '')])"
    step = "CASE WHEN xor(a & 1, b) = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    start = "[CAST(4294967295 AS BIGINT)]"
    return f"xor(list_reduce(list_concat({start}, {bits}), lambda a, b: {step}), 4294967295)"


def _encoded(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"COALESCE(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    columns = ("doc_id", "source", "lang", "n_chars", text)
    return f"sha256({' || '.join(_encoded(c) for c in columns)})"


def _tree(name: str, levels: int) -> str:
    """From ``{name}_0`` (g, p, n, h): the runs of each level, and the last nodes."""
    out = []
    for k in range(levels):
        out.append(
            f"""{name}_run_{k} AS (
    SELECT g, p // 8 AS run, string_agg(h, '' ORDER BY p) AS s, any_value(n) AS n
    FROM {name}_{k} WHERE n > 1 GROUP BY g, p // 8
), {name}_{k + 1} AS (
    SELECT g, run AS p, (n + 7) // 8 AS n, sha256(s) AS h FROM {name}_run_{k}
    UNION ALL SELECT g, p, n, h FROM {name}_{k} WHERE n = 1
)"""
        )
    return ",\n".join(out)


def _walk(name: str, start: str, levels: int, first: int = 0) -> str:
    """From ``walk_{first}``: the siblings in the runs of a tree, and the node they lead to."""
    out = []
    for k in range(levels):
        place = f"({start} // {8**k})"
        left = f"substr(s, 1, 64 * ({place} % 8))"
        right = f"substr(s, 64 * ({place} % 8) + 65)"
        out.append(
            f"""walk_{first + k + 1} AS (
    SELECT w.* EXCLUDE (siblings, node),
           CASE WHEN s IS NULL THEN siblings ELSE siblings || {left} || {right} END AS siblings,
           CASE WHEN s IS NULL THEN node ELSE sha256({left} || node || {right}) END AS node
    FROM walk_{first + k} AS w LEFT JOIN {name}_run_{k} AS r
        ON w.{'lang' if name == 'l' else 'one'} IS NOT DISTINCT FROM r.g AND {place} // 8 = r.run
)"""
        )
    return ",\n".join(out)


_UP, _OVER = 7, 3  # levels: enough for 8**7 documents of one lang, and 8**3 langs

OP13_MANIFEST = f"""
WITH leaves AS (
    SELECT doc_id, lang, {_leaf('text')} AS leaf, {_leaf(f"translate(text, {_ABC})")} AS lowered,
           {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 AS chosen
    FROM documents
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
           COUNT(*) OVER (PARTITION BY lang) AS n
    FROM leaves
), l_0 AS (
    SELECT lang AS g, p, n, leaf AS h FROM numbered
), {_tree("l", _UP)}, t_0 AS (
    SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS p, COUNT(*) OVER () AS n, h,
           g AS lang
    FROM l_{_UP}
), {_tree("t", _OVER)}, walk_0 AS (
    SELECT doc_id, d.lang, leaf, d.p AS place_no, t_0.p AS top, 0 AS one, t_0.h AS subroot, '' AS siblings,
           CASE WHEN chosen THEN lowered ELSE leaf END AS node
    FROM numbered AS d JOIN t_0 ON d.lang IS NOT DISTINCT FROM t_0.lang
), {_walk("l", "place_no", _UP)}, {_walk("t", "top", _OVER, _UP)}
SELECT doc_id, leaf, subroot, t.h AS root, sha256(siblings) AS proof_sha256, node AS folded_root,
       node = t.h AS verified
FROM walk_{_UP + _OVER}, t_{_OVER} AS t
"""

ORACLE = {
    "op1_warc": OP1_WARC,
    "op2_decontaminate": OP2_DECONTAMINATE,
    "op8_substrings": OP8_SUBSTRINGS,
    "op12_search": OP12_SEARCH,
    "op13_manifest": OP13_MANIFEST,
}
