"""SQL twins of the text queries, for an independent engine over the same tables.

Statements are plain set operations: all pairs, all windows, recursion over links. They say what a
query returns, not how it finds it.
"""

from __future__ import annotations

LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    return rf"regexp_extract_all({LOWER.format(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP2 = f"""
WITH items AS (SELECT item_id, {words('text')} AS w FROM benchmark),
windows AS (
    SELECT item_id, least(10, len(w)) AS width,
           unnest([w[i:i + least(10, len(w)) - 1] FOR i IN generate_series(1, len(w) - least(10, len(w)) + 1)]) AS gram
    FROM items WHERE len(w) > 0),
docs AS (SELECT doc_id, {words('text')} AS w FROM documents),
widths AS (SELECT DISTINCT width FROM windows),
starts AS (
    SELECT doc_id, width, w, unnest(generate_series(1, len(w) - width + 1)) AS p
    FROM docs, widths WHERE len(w) >= width),
found AS (
    SELECT doc_id, p, s.width, item_id FROM starts s
    JOIN windows x ON x.width = s.width AND x.gram = s.w[p:p + s.width - 1]),
hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(p, p + width - 1)) AS place FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

# Five hex digits are twenty bits, four digits of base 32.
DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, {5 * i + 1}, 5) AS BIGINT) >> {15 - 5 * k}) & 31 AS INTEGER) + 1, 1)"
    for i in range(8) for k in range(4)
)
OP3 = f"""
WITH pages_ AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT payload, min(page_id) AS original FROM pages_ GROUP BY payload)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {DIGITS} AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM pages_ JOIN firsts USING (payload)"""

REACH = """
reach(a, b) AS (
    SELECT a, b FROM links
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)"""

OP7 = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {words('text')} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN generate_series(1, greatest(1, len(w) - 4))]) AS s
    FROM docs WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
    SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
    WHERE c.n * 5 >= 4 * (x.n + y.n - c.n)),
same AS (
    SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE c.n = x.n AND c.n = y.n),
{REACH},
least_of AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a),
copy_of AS (SELECT a AS doc_id, min(b) AS b FROM same GROUP BY a),
counted AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(l.b, doc_id)) AS class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
       least(doc_id, coalesce(c.b, doc_id)) AS copy_of, doc_id = least(doc_id, coalesce(l.b, doc_id)) AS kept
FROM docs LEFT JOIN least_of l USING (doc_id) LEFT JOIN copy_of c USING (doc_id) LEFT JOIN counted USING (doc_id)"""

OP9 = f"""
WITH RECURSIVE fine AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM fine x JOIN fine y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
{REACH},
least_of AS (SELECT a AS vec_id, min(b) AS b FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN least_of USING (vec_id) LEFT JOIN counted USING (vec_id)"""


def filled(name: str, rows: str, by: str, weight: str, cap: str, total: str, out: str) -> str:
    """Water filling: of the rows in the order of cap / weight the largest level is shared."""
    over = f"PARTITION BY {by} ORDER BY {cap} / {weight}, {weight}, {cap}"
    return f"""
{name}_steps AS (
    SELECT *, ({total} - coalesce(sum({cap}) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum({weight}) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM {rows}),
{name} AS (
    SELECT * EXCLUDE (level), least({cap}, greatest(max(level) OVER (PARTITION BY {by}), 0) * {weight}) AS {out} FROM {name}_steps)"""


OP5 = f"""
WITH rows_ AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
           (CAST('0x' || substr(md5('0:' || CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
    FROM documents),
classed AS (SELECT *, CAST(floor(log2(size + 1)) AS INTEGER) AS class FROM rows_),
classes AS (SELECT src, class, CAST(sum(size) AS DOUBLE) AS words FROM classed GROUP BY ALL),
sources AS (
    SELECT src, sum(words) AS source_size, 3 * sum(words) AS cap, 1 AS one,
           ([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[CAST((row_number() OVER (ORDER BY src) - 1) % 3 AS INTEGER) + 1] AS weight,
           sum(sum(words)) OVER () AS total
    FROM classes GROUP BY src),
{filled('targets', 'sources', 'one', 'weight', 'cap', 'total', 'target')},
parts AS (
    SELECT c.src, class, words, source_size, target, 3 * words AS cap,
           greatest(words, 1) / (1 + 0.125::DOUBLE * class) AS part FROM classes c JOIN targets USING (src)),
{filled('shares', 'parts', 'src', 'part', 'cap', 'target', 'given')},
copies AS (
    SELECT *, floor(CASE WHEN words > 0 THEN given / words ELSE 0 END + 1e-9::DOUBLE) AS whole,
           CASE WHEN words > 0 THEN given / words ELSE 0 END AS expected FROM shares),
chances AS (
    SELECT *, CASE WHEN expected - whole > 1e-9::DOUBLE THEN expected - whole ELSE 0 END AS chance,
           target - sum(whole * words) OVER (PARTITION BY src) AS open FROM copies),
drawn AS (
    SELECT r.*, source_size, target, whole, chance, open, u / (1 - u) * (1 - chance) / CASE WHEN chance > 0 THEN chance END AS odds
    FROM classed r JOIN chances USING (src, class)),
ranked AS (
    SELECT *, CASE WHEN chance > 0 THEN sum(CASE WHEN chance > 0 THEN size ELSE 0 END) OVER (PARTITION BY src ORDER BY odds / (1 + odds) NULLS LAST) END AS spent
    FROM drawn)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target,
       CAST(size * (whole + CASE WHEN chance > 0 AND spent - size / 2 <= open THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranked"""


def url_model(order: int = 4) -> str:
    """Both smoothed models for every gram, context by context."""
    parts, previous = [], "SELECT gram, 1 / 256::DOUBLE AS pa, 1 / 256::DOUBLE AS pr FROM (SELECT DISTINCT gram FROM grams)"
    for k in range(order + 1):
        tail = f"substr(gram, {order + 1 - k}, {k + 1})"
        parts.append(f"""
tails{k} AS (
    SELECT {tail} AS tail, substr(gram, {order + 1 - k}, {k}) AS context, CAST(sum(label) AS DOUBLE) AS a, CAST(sum(1 - label) AS DOUBLE) AS r
    FROM grams WHERE label IS NOT NULL AND NOT held GROUP BY 1, 2),
contexts{k} AS (
    SELECT context, sum(a) AS na, sum(r) AS nr, count(*) FILTER (a > 0) AS ta, count(*) FILTER (r > 0) AS tr FROM tails{k} GROUP BY 1),
p{k} AS (
    SELECT gram, CASE WHEN na > 0 THEN (coalesce(a, 0) + ta * pa) / (na + ta) ELSE pa END AS pa,
           CASE WHEN nr > 0 THEN (coalesce(r, 0) + tr * pr) / (nr + tr) ELSE pr END AS pr
    FROM ({previous}) p LEFT JOIN tails{k} t ON t.tail = {tail}
    LEFT JOIN contexts{k} c ON c.context = substr(gram, {order + 1 - k}, {k}))""")
        previous = f"SELECT * FROM p{k}"
    return ",".join(parts)


def rule_case(rules: list[tuple[str, str, str]]) -> str:
    whens = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
        for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    )
    return f"CASE {whens} END"


def op4(rules: list[tuple[str, str, str]]) -> str:
    host = LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")
    return f"""
WITH parted AS (
    SELECT page_id, url, {host} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS (SELECT *, {rule_case(rules)} AS fit FROM parted),
once AS (
    SELECT url, max(CASE WHEN starts_with(fit, 'allow') THEN 1 WHEN starts_with(fit, 'block') THEN 0 END) AS label,
           CAST('0x' || substr(md5(url), 1, 8) AS BIGINT) % 5 = 0 AS held
    FROM ruled WHERE url IS NOT NULL GROUP BY url),
grams AS (
    SELECT url, label, held, substr(repeat(chr(2), 4) || url || chr(3), i, 5) AS gram
    FROM (SELECT *, unnest(generate_series(1, length(url) + 1)) AS i FROM once)),
{url_model()},
scores AS (
    SELECT url, label, held, sum(ln(pa) - ln(pr)) / count(*) AS score FROM grams JOIN p4 USING (gram) GROUP BY ALL),
cells AS (
    SELECT CAST(floor(score * 1000) AS BIGINT) AS cell, sum(label) AS yes, sum(1 - label) AS no FROM scores WHERE held AND label IS NOT NULL GROUP BY 1),
gains AS (
    SELECT (cell + coalesce(lag(cell) OVER (ORDER BY cell) + 1, cell)) / 2.0::DOUBLE AS cell, 1 - coalesce(sum(yes) OVER b, 0) / sum(yes) OVER () + coalesce(sum(no) OVER b, 0) / sum(no) OVER () AS gain,
           sum(yes) OVER () AS y, sum(no) OVER () AS n
    FROM cells WINDOW b AS (ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT coalesce((SELECT cell / 1000.0::DOUBLE FROM gains WHERE y > 0 AND n > 0 ORDER BY gain DESC, abs(cell) LIMIT 1), 0.0::DOUBLE) AS threshold)
SELECT page_id, host, path, substr(fit, 7) AS rule,
       CASE WHEN fit IS NOT NULL THEN substr(fit, 1, 5) WHEN coalesce(score, 0) >= threshold THEN 'allow' ELSE 'block' END AS verdict,
       round(coalesce(score, 0), 9) AS score
FROM ruled LEFT JOIN scores USING (url), cut"""


#: The checksum's steps: a byte is added by xor, then eight shifts (-1) follow.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
        FOR c IN string_split({0}, '')])), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""

OP12 = f"""
WITH turns AS (
    SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
           octet_length(encode(coalesce(text, ''))) AS size
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest, size) AS digests, list(size ORDER BY turn NULLS FIRST, digest, size) AS sizes
    FROM turns GROUP BY conv_id),
opened AS (
    SELECT o.conv_id, o.digests, o.sizes, p.digests AS first_digests, p.sizes AS first_sizes,
           CAST({CRC32.format("CAST(o.conv_id AS VARCHAR)")} % 9 AS BIGINT) AS h
    FROM own o LEFT JOIN own p ON p.conv_id = o.conv_id - o.conv_id % 5),
rebuilt AS (
    SELECT conv_id, array_to_string(list_concat(coalesce(first_digests, [])[1:h], digests[h + 1:]), '') AS sequence,
           list_concat(coalesce(first_sizes, [])[1:h], sizes[h + 1:]) AS sizes
    FROM opened),
members AS (
    SELECT conv_id, d, substr(sequence, 1, 32 * d) AS node, sizes[d] AS size, d = len(sizes) AS ended
    FROM (SELECT *, unnest(generate_series(0, len(sizes))) AS d FROM rebuilt)),
nodes AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * coalesce(any_value(size), 0) AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends
    FROM members GROUP BY node, d),
children AS (SELECT substr(node, 1, 32 * (d - 1)) AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
subtrees AS (
    SELECT substr(node, 1, 32 * a) AS node, sum(saved) AS saved, count(*) FILTER (childless) AS leaves
    FROM (SELECT x.*, c.n IS NULL AS childless, unnest(generate_series(0, d)) AS a FROM nodes x LEFT JOIN children c USING (node))
    GROUP BY 1)
SELECT x.conv_id, d AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM nodes x LEFT JOIN children c USING (node) JOIN subtrees s USING (node)
LEFT JOIN (SELECT node, conv_id FROM nodes) p ON x.d > 0 AND p.node = substr(x.node, 1, 32 * (x.d - 1))"""


def oracles(rules: list[tuple[str, str, str]]) -> dict[str, str]:
    """The twins by query name; ``rules`` are those of the URL filter."""
    return {
        "op2_decontaminate": OP2, "op3_warc": OP3, "op4_url_filter": op4(rules), "op5_mix": OP5, "op7_jaccard_join": OP7,
        "op9_near_vectors": OP9, "op12_prefix_trie": OP12,
    }
