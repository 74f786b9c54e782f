"""DuckDB SQL of the queries that SQL can express."""

_DECONTAMINATION = r"""
WITH doc_words AS (
    SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
item_words AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark WHERE item_id IS NOT NULL),
item_windows AS (
    SELECT DISTINCT item, least(10, len(words)) AS width,
        array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS gram
    FROM item_words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS s(i)
    WHERE len(words) > 0),
widths AS (SELECT DISTINCT width FROM item_windows),
doc_windows AS (
    SELECT rid, width, i, array_to_string(words[i : i + width - 1], ' ') AS gram
    FROM doc_words, widths, unnest(generate_series(1, len(words) - width + 1)) AS s(i)),
found AS (SELECT rid, width, i, item FROM doc_windows JOIN item_windows USING (width, gram)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit
    FROM found, unnest(generate_series(i, i + width - 1)) AS s(p) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""


# Kind, role, pattern, group, least characters, what a match must hold, roles it needs.
_KINDS = (
    ("assign", "secret", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, (), ()),
    ("access", "access", r"AKIA[A-Z0-9]+", 0, 16, (), ()),
    ("hex", "secret", r"[0-9a-f]+", 0, 32, (), ()),
    ("key_id", "access", r"""(?i)(access_?key_?id|client_?id|user_?name|login|account_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.=-]+)""", 2, 3, (), ("secret",)),
    ("blob", "secret", r"[A-Za-z0-9+/]{40,}", 0, 40, ("[A-Z]", "[a-z]", "[0-9]"), ("access",)),
    ("endpoint", "endpoint", r"""(?i)(https?|sftp|s3|postgresql|postgres|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]+""", 0, 1, (), ("access", "secret")),
)


def _secret_parts() -> str:
    found = []
    for listed, (kind, role, pattern, group, least, holds, needs) in enumerate(_KINDS):
        quoted = "'" + pattern.replace("'", "''") + "'"
        held = "".join(f" AND regexp_matches(whole, '{one}')" for one in holds)
        found.append(f"""
    SELECT rid, '{kind}' AS kind, {listed} AS listed, '{role}' AS role, start,
        start + length(whole) AS stop, {len(needs)} AS needs,
        {str(list(needs)) + "::VARCHAR[]"} AS needed
    FROM (
        SELECT rid, whole, value,
            sum(length(gap)) OVER before + sum(length(whole)) OVER before - length(whole) AS start
        FROM (
            SELECT rid, unnest(gaps[1 : len(wholes)]) AS gap, unnest(wholes) AS whole,
                unnest(found_values) AS value, unnest(range(len(wholes))) AS place
            FROM (
                SELECT rid, string_split_regex(text, {quoted}) AS gaps,
                    regexp_extract_all(text, {quoted}) AS wholes,
                    regexp_extract_all(text, {quoted}, {group}) AS found_values
                FROM docs))
        WINDOW before AS (PARTITION BY rid ORDER BY place))
    WHERE length(value) >= {least}{held}""")
    return "\n    UNION ALL".join(found)


_SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({_secret_parts()}),
linked AS (
    SELECT a.rid, a.kind, a.listed, a.start, a.stop FROM parts a JOIN parts b
        ON a.rid = b.rid AND a.needs > 0 AND list_contains(a.needed, b.role)
        AND abs(a.start - b.start) <= 400
    GROUP BY a.rid, a.kind, a.listed, a.start, a.stop, a.needs HAVING count(DISTINCT b.role) = a.needs),
spans AS (
    SELECT rid, kind, listed, start, stop, needs = 0 AS base FROM parts WHERE needs = 0
    UNION ALL SELECT *, false FROM linked),
listed AS (
    SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign,
        count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, listed)
            FILTER (base) AS base,
        string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, listed) AS spans
    FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (rid)
"""

_TOP_K = """
WITH vectors AS (
    SELECT row_number() OVER () AS rid, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings WHERE embedding IS NOT NULL
        AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS other,
        CASE WHEN len(q.v) = 0 THEN 0 ELSE CAST(list_dot_product(q.v, c.v) AS BIGINT) END AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND len(q.v) = len(c.v) AND q.rid <> c.rid),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST, other) AS place
    FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM ranked WHERE place <= 5
"""


def _crc32(text: str) -> str:
    """Of an ASCII text, bit by bit."""
    octets = f"[ord({text}[i])::BIGINT FOR i IN range(1, len({text}) + 1)]"
    shifted = "lambda c, _i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    one = f"lambda crc, octet: list_reduce(list_prepend(xor(crc, octet), range(8)), {shifted})"
    return f"(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, {octets}), {one}))"


def _leaf(n_chars: str) -> str:
    """The digest of a row, with ``n_chars`` as given."""
    texts = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    parts = (f"coalesce(strlen({text}) || ':' || {text}, '-')" for text in texts)
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, leaves: str) -> str:
    """All levels of the trees over ``leaves`` (tree, rank, size, digest)."""
    return f"""{name} AS (
    SELECT tree, 0 AS level, rank AS place, size AS width, digest FROM {leaves}
    UNION ALL
    SELECT tree, any_value(level) + 1, place // 2, (any_value(width) + 1) // 2,
        sha256(string_agg(digest, '' ORDER BY place))
    FROM {name} WHERE width > 1 GROUP BY tree, place // 2)"""


_MERKLE = f"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS rid, doc_id, lang AS tree, {_leaf("n_chars")} AS digest,
        CASE WHEN crc32 % 7 = 0 THEN {_leaf("n_chars::HUGEINT + 1")} ELSE {_leaf("n_chars")} END AS claim
    FROM documents LEFT JOIN (
        SELECT id, {_crc32("id")} AS crc32
        FROM (SELECT DISTINCT doc_id::VARCHAR AS id FROM documents WHERE doc_id IS NOT NULL))
        ON id = doc_id::VARCHAR),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest, rid) - 1 AS rank,
        count(*) OVER (PARTITION BY tree) AS size
    FROM docs),
{_tree("below", "ranked")},
subroots AS (
    SELECT tree AS name, '' AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS rank,
        count(*) OVER () AS size, digest
    FROM below WHERE width = 1),
{_tree("above", "subroots")},
levels AS (
    SELECT rid, level, (rank >> level) AS place, width, 0 AS part, ranked.tree
    FROM ranked JOIN (SELECT DISTINCT tree, level, width FROM below WHERE width > 1) b
        ON ranked.tree IS NOT DISTINCT FROM b.tree
    UNION ALL
    SELECT rid, level, (s.rank >> level), width, 1, ''
    FROM ranked JOIN subroots s ON ranked.tree IS NOT DISTINCT FROM s.name,
        (SELECT DISTINCT level, width FROM above WHERE width > 1)),
nodes AS (SELECT 0 AS part, * FROM below UNION ALL SELECT 1, * FROM above),
steps AS (
    SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY l.part, l.level) AS step,
        l.place % 2 AS side, n.digest AS sibling
    FROM levels l LEFT JOIN nodes n ON n.part = l.part AND n.tree IS NOT DISTINCT FROM l.tree
        AND n.level = l.level AND n.place = xor(l.place, 1)),
proofs AS (
    SELECT rid, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof, max(step) AS last
    FROM steps GROUP BY rid),
folded AS (
    SELECT rid, claim AS digest, 0 AS step FROM docs
    UNION ALL
    SELECT f.rid, sha256(CASE WHEN side = 1 THEN coalesce(sibling, '') || digest
        ELSE digest || coalesce(sibling, '') END), s.step
    FROM folded f JOIN steps s ON s.rid = f.rid AND s.step = f.step + 1)
SELECT r.doc_id, r.digest AS leaf, b.digest AS subroot, a.digest AS root,
    coalesce(proof, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = a.digest AS verified
FROM ranked r JOIN below b ON b.width = 1 AND b.tree IS NOT DISTINCT FROM r.tree
JOIN above a ON a.width = 1 LEFT JOIN proofs p USING (rid)
JOIN folded f ON f.rid = r.rid AND f.step = coalesce(p.last, 0)
"""

_TRIE = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said
    FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
    SELECT conv_id, list({{'role': role, 'said': said}}
        ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || said)) AS own
    FROM turns GROUP BY conv_id),
heads AS (SELECT conv_id, own, {_crc32("id")} % 6 AS h FROM (SELECT *, conv_id::VARCHAR AS id FROM lists)),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.own[1:h], []), c.own[h + 1:]) AS path
    FROM heads c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
    SELECT conv_id, d, path[1:d] AS node, len(path) AS turns
    FROM rebuilt, unnest(range(0, len(path) + 1)) AS s(d)),
nodes AS (
    SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs,
        string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = d) AS ends
    FROM prefixes GROUP BY d, node),
children AS (SELECT d - 1 AS d, node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
        CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(node[d].said) END AS saved
    FROM nodes n LEFT JOIN children USING (d, node)),
sums AS (
    SELECT a AS d, node[1:a] AS node, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
    FROM counted, unnest(range(0, d + 1)) AS s(a) GROUP BY ALL)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves,
    CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(coalesce(c.ends, '')) AS ends_sha256
FROM counted c JOIN sums ON sums.d = c.d AND sums.node = c.node
LEFT JOIN nodes p ON p.d = c.d - 1 AND p.node = c.node[1:c.d - 1] AND c.d > 0
"""

ORACLE: dict[str, str] = {
    "op3_decontamination": _DECONTAMINATION,
    "op10_secret_scan": _SECRETS,
    "op11_exact_top_k": _TOP_K,
    "op12_merkle_manifest": _MERKLE,
    "op13_prefix_trie": _TRIE,
}
