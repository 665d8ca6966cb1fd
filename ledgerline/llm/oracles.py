"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from ledgerline.llm.decontaminate import LEAST, LITERALS, UNITS, WINDOW

_SPACE = r"[\x20\x09-\x0D]"

WARC_SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, url, sha256(body) AS payload_digest, octet_length(encode(body))::BIGINT AS payload_bytes FROM p),
     r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR page_id IS NOT DISTINCT FROM low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 100 OR page_id IS NOT DISTINCT FROM low THEN NULL ELSE low END AS refers_to,
       url AS target_uri
FROM r
"""


def url_sql(rules, hosts) -> str:
    rule_rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    host_rows = ", ".join(f"('{h}')" for h in hosts)
    return f"""
WITH rules(host, path, verdict) AS (VALUES {rule_rows}), blocked(host) AS (VALUES {host_rows}),
     u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
     fit AS (SELECT u.page_id, u.host AS uh, u.path AS up, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
                    arg_max(r.verdict, length(r.host || r.path)) AS verdict
             FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
             GROUP BY ALL)
SELECT u.page_id, u.host, u.path, f.rule,
       coalesce(f.verdict, CASE WHEN EXISTS (SELECT 1 FROM blocked b WHERE u.host = b.host OR ends_with(u.host, '.' || b.host))
                                THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN (SELECT DISTINCT * FROM fit) f ON u.page_id = f.page_id AND u.host = f.uh AND u.path = f.up
"""


def canonical_sql(text: str) -> str:
    t = f"coalesce({text}, '')"
    name = r"([^\x20\x09-\x0D.!?:;] )(\p{Lu}\p{Ll}+)"
    for _ in range(2):
        t = f"regexp_replace({t}, '{name}', '\\1' || chr(1) || '\\2', 'g')"
    number = r"(^|[\x20\x09-\x0D])([\p{Sc}+(\-]?[0-9][^\x20\x09-\x0D]*)"
    t = f"regexp_replace({t}, '{number}', '\\1' || chr(2) || '\\2', 'g')"
    unit = r"(\x02[^\x20\x09-\x0D]+ )(" + "|".join(UNITS) + r")($|[^\p{L}\p{N}])"
    t = f"regexp_replace({t}, '{unit}', '\\1' || chr(3) || '\\2\\3', 'g')"
    return f"lower(regexp_replace({t}, '[^\\p{{L}}\\p{{M}}\\p{{N}}\\x01-\\x03\\x20\\x09-\\x0D]+', '', 'g'))"


def leaks_sql(documents: str) -> str:
    """(doc_id, item_id, ...) of leaks in a relation with doc_id and text."""
    def tokens(source: str, key: str) -> str:
        return f"""SELECT {key}, text, list_filter(regexp_split_to_array({canonical_sql('text')}, '{_SPACE}+'), lambda x: x <> '') AS raw
                   FROM {source}"""

    tmpl = "list_transform(raw, lambda x: CASE WHEN x < chr(4) THEN x[1] ELSE x END)"
    return f"""
WITH dt AS MATERIALIZED (SELECT doc_id, text, raw, {tmpl} AS tmpl FROM ({tokens(documents, 'doc_id')})),
     bt AS MATERIALIZED (SELECT item_id, raw, {tmpl} AS tmpl, least(len(raw), {WINDOW}) AS size FROM ({tokens('benchmark', 'item_id')})
                         WHERE len(raw) >= {LITERALS}),
     bw0 AS (SELECT item_id, raw, tmpl, size, unnest(range(1, len(raw) - size + 2)) AS p FROM bt),
     bw1 AS (SELECT item_id, size, p, tmpl[p:p + size - 1] AS w, list_filter(raw[p:p + size - 1], lambda x: x < chr(4)) AS slots FROM bw0),
     bw AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY item_id) AS item_windows FROM bw1 WHERE size - len(slots) >= {LITERALS}),
     sizes AS (SELECT DISTINCT size FROM bw),
     dw0 AS (SELECT doc_id, text, raw, tmpl, size, unnest(range(1, len(raw) - size + 2)) AS p FROM dt, sizes WHERE len(raw) >= size),
     dw AS (SELECT doc_id, text, p, tmpl[p:p + size - 1] AS w, list_filter(raw[p:p + size - 1], lambda x: x < chr(4)) AS slots FROM dw0),
     met AS MATERIALIZED (SELECT DISTINCT d.doc_id, d.text, b.item_id, b.item_windows, d.p, b.p AS ip, b.slots AS isl, d.slots AS dsl
             FROM dw d JOIN bw b ON d.w = b.w),
     slots AS (SELECT doc_id, text, item_id, p - ip AS off, p, unnest(isl) AS i, unnest(dsl) AS d FROM met),
     votes AS (SELECT doc_id, text, item_id, off, i, d, count(*) AS n FROM slots WHERE i <> d GROUP BY ALL),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text, item_id, off, i ORDER BY n DESC, d) AS a,
                       row_number() OVER (PARTITION BY doc_id, text, item_id, off, d ORDER BY n DESC, i) AS b FROM votes),
     bad AS (SELECT DISTINCT s.doc_id, s.text, s.item_id, s.off, s.p FROM slots s JOIN ranked r
             ON s.doc_id IS NOT DISTINCT FROM r.doc_id AND s.text = r.text AND s.item_id IS NOT DISTINCT FROM r.item_id
                AND s.off = r.off AND s.i = r.i AND s.d = r.d AND (r.a > 1 OR r.b > 1)),
     counted AS (SELECT m.*, m.p - m.ip AS off FROM met m WHERE NOT EXISTS (
                 SELECT 1 FROM bad b WHERE m.doc_id IS NOT DISTINCT FROM b.doc_id AND m.text = b.text
                 AND m.item_id IS NOT DISTINCT FROM b.item_id AND m.p - m.ip = b.off AND m.p = b.p)),
     lined AS (SELECT doc_id, text, item_id, item_windows, off, count(*) AS n_windows FROM counted GROUP BY ALL),
     pairs AS (SELECT DISTINCT doc_id, text, item_id, off, unnest(isl) AS i, unnest(dsl) AS d FROM counted),
     agree AS (SELECT doc_id, text, item_id, off, count(*) FILTER (WHERE i <> d) AS changed FROM pairs GROUP BY ALL)
SELECT l.doc_id, l.item_id, l.item_windows::INT AS item_windows, max(l.n_windows) AS n_windows, min(coalesce(a.changed, 0))::INT AS changed_slots
FROM lined l LEFT JOIN agree a ON l.doc_id IS NOT DISTINCT FROM a.doc_id AND l.text = a.text AND l.item_id IS NOT DISTINCT FROM a.item_id AND l.off = a.off
WHERE l.n_windows >= least({LEAST}, l.item_windows)
GROUP BY l.doc_id, l.item_id, l.item_windows
"""


# crc32 by its table of 256 entries, computed here; levenshtein() counts bytes, so every letter becomes one byte.
SPELLING_SQL = r"""
WITH RECURSIVE
table0 AS (SELECT i, i AS c, 0 AS step FROM range(256) r(i)
           UNION ALL
           SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1 FROM table0 WHERE step < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM table0 WHERE step = 8),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc,
                unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
         FROM documents),
uses AS (SELECT doc, run, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (SELECT run, k, xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(range(1, length(hex(encode(doc || ':' || run))), 2),
                   lambda p: ('0x' || substr(hex(encode(doc || ':' || run)), p, 2))::BIGINT)),
               lambda crc, byte: xor(crc // 256, tab[(xor(crc, byte) % 256) + 1])), 4294967295) AS h
           FROM uses, crc_table),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
vocabulary AS MATERIALIZED (
    SELECT word, sum(k)::BIGINT AS n,
           translate(word, 'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ',
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!"#$%&()*+,-./:;<=>?@[\]^_`{') AS bytes
    FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
halves AS (SELECT word, n, bytes, size, side, CASE WHEN side = 0 THEN left(bytes, size // 2) ELSE right(bytes, size - size // 2) END AS part
           FROM vocabulary, (VALUES (0), (1)) s(side), (VALUES (0), (1)) l(less), LATERAL (SELECT length(bytes) - less AS size) z),
near AS (SELECT DISTINCT a.word, b.word AS other, b.n AS other_n
         FROM halves a JOIN halves b ON a.size = b.size AND a.side = b.side AND a.part = b.part AND a.word <> b.word
         WHERE levenshtein(a.bytes, b.bytes) = 1),
best AS (SELECT word, count(*) AS n_near, min({'m': -other_n, 'w': other}) AS b FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
                 CASE WHEN -b.m >= 2 * v.n THEN b.w END AS form, CASE WHEN -b.m >= 2 * v.n THEN (-b.m)::BIGINT END AS form_n
          FROM vocabulary v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON c.at = e.word WHERE e.form IS NULL
"""


def centroid_sql(k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64) -> str:
    numbers = f"range(1, {size + 1})"
    steps, centroids = [], "start"
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT row, any_value(vec_id) AS vec_id, any_value(z) AS z, min({{'d': d, 'c': c}}) AS best FROM (
    SELECT v.row, v.vec_id, v.z, m.c, list_sum(list_transform({numbers}, lambda j: (v.z[j] - m.z[j]) * (v.z[j] - m.z[j])))::BIGINT AS d
    FROM kept v, {centroids} m) GROUP BY row)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT best.c AS c, j, sum(z[j])::BIGINT AS s, count(*)::BIGINT AS n FROM a{r}, {numbers} t(j) GROUP BY ALL),
m{r} AS MATERIALIZED (SELECT o.c, coalesce(f.z, o.z) AS z FROM {centroids} o LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS z FROM s{r} GROUP BY c) f USING (c))""")
            centroids = f"m{r}"
    all_steps = ",\n".join(steps)
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS z FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
start AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, z) - 1 AS c, z FROM (
    SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, z FROM kept ORDER BY h, z LIMIT {k})),
{all_steps},
total AS (SELECT best.c AS c, sum(best.d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY best.c)
SELECT a.vec_id, a.best.c::INT AS cluster, a.best.d AS distance, t.cluster_inertia, (SELECT sum(cluster_inertia) FROM total)::BIGINT AS inertia,
       sha256(array_to_string(m.z, ',')) AS centroid_sha256
FROM a{rounds} a JOIN total t ON a.best.c = t.c JOIN {centroids} m ON a.best.c = m.c
"""
