"""DuckDB SQL for the rows of the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"regexp_extract_all(coalesce({_LOWERED}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACE = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH doc AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_PLAIN} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, len(part) AS k, array_to_string(part, ' ') AS s FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(1, len(w) - 9) + 1), lambda i: w[i:i + 9])) AS part FROM item WHERE len(w) > 0)),
place AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
hit AS (SELECT p.doc_id, p.i, v.k, v.item_id FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM place, (SELECT DISTINCT k FROM win) WHERE i + k - 1 <= len(w)) p
    JOIN win v ON v.s = p.s AND v.k = p.k),
word AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
    sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""

#: Phrases of notices, and such as hint at boilerplate.
_NOTICES = "all rights reserved|terms of use|terms of service|privacy policy|uses cookies|use cookies|click here|read more|lorem ipsum"
_HINTS = "licensed under|released under|cookie|cookies|javascript|sign in|sign up|log in|login|subscribe|copyright"
_LOW = "translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _phrase_words(phrases: str) -> str:
    """How many words of a line lie in these phrases."""
    return f"coalesce(list_sum(list_transform(regexp_extract_all({_LOW}, '\\b(?:{phrases})\\b'), lambda x: len(string_split(x, ' ')))), 0)"


_UNSPACED = r"regexp_extract_all(line, '[^\x20\x09-\x0D]+')"


def _count(x: str, characters: str) -> str:
    """How many of these characters x has."""
    return f"len({x}) - len(translate({x}, '{characters}', ''))"


_DIVIDED = " + ".join(f"(len(line) - len(replace(line, ' {c} ', ''))) / 3" for c in "|>/»·•")
#: What makes a line look like markup or shouting.
_MARKS = r"!?#*$%&<>{}\^~=_"
_ADJACENT = "len(list_filter(range(1, n), lambda i: lw[i] = lw[i + 1]))"

OP2 = f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, {_SPACE} AS w FROM documents),
line AS (SELECT *, len(lw) AS n FROM (SELECT doc_id, pos, line, {_UNSPACED} AS lw FROM
    (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM doc)) WHERE len(lw) > 0),
judged AS (SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS again,
    {_DIVIDED} >= greatest(2, n / 6)
    OR {_phrase_words(_NOTICES)} > 0 AND 8 * {_phrase_words(_NOTICES)} >= n
    OR 3 * {_phrase_words(_NOTICES + "|" + _HINTS)} > n
    OR n >= 3 AND {_count("line", _MARKS)} >= 0.3::DOUBLE * n
    OR n >= 5 AND {_count("line", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")} > 2 * ({_count("line", "abcdefghijklmnopqrstuvwxyz")})
    OR n >= 6 AND 2 * {_ADJACENT} >= n - 1 AS fails FROM line),
lost AS (SELECT doc_id, count(*) FILTER (WHERE again) AS n_dup, coalesce(sum(n) FILTER (WHERE again OR fails), 0) AS lost FROM judged GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM doc)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
again AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat FROM (SELECT doc_id, unnest(range(i, i + 3)) AS pos FROM twice) GROUP BY doc_id),
counted AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: len(x))), 0) AS BIGINT) AS word_chars,
    CAST({_count("text", "#*$%&|<>")} AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
    CASE WHEN len(w) > 0 THEN CAST(coalesce(lost, 0) AS DOUBLE) / len(w) ELSE 0 END AS lost_share
    FROM doc LEFT JOIN lost USING (doc_id) LEFT JOIN again USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_share <= 0.3::DOUBLE AS kept FROM counted
"""

#: kind, least length, group that is measured, pattern: in the order of kinds.
_SECRETS = (
    ("assign", 6, 2, """([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", 20, 0, "AKIA[A-Z0-9]+"),
    ("hex", 24, 0, "[0-9a-f]+"),
    ("github", 34, 0, "gh[oprsu]_[A-Za-z0-9]{30,}"),
    ("slack", 25, 0, "xox[abprs]-[A-Za-z0-9-]{20,}"),
    ("stripe", 24, 0, "[rs]k_live_[A-Za-z0-9]{16,}"),
    ("jwt", 29, 0, "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    ("pem", 27, 0, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
_PARTS = " UNION ALL ".join(
    f"""SELECT doc_id, source, {i} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, '{pattern}', 0) AS m,
    regexp_extract_all(t, '{pattern}', {group}) AS v, list_transform(string_split_regex(t, '{pattern}'), lambda x: len(x)) AS g FROM doc"""
    for i, (kind, least, group, pattern) in enumerate(_SECRETS)
)
_SPAN = "kind || ':' || s || ':' || e"

OP5 = f"""
WITH doc AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
part AS ({_PARTS}),
place AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM part),
begun AS (SELECT *, list_sum(g[1:i]) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS s FROM place WHERE len(v[i]) >= least),
span AS (SELECT doc_id, source, rank, kind, CAST(s AS BIGINT) AS s, CAST(s + len(m[i]) AS BIGINT) AS e, v[i] AS secret FROM begun),
held AS (SELECT secret, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS n_owners, count(*) AS n_repositories
    FROM (SELECT DISTINCT secret, source, doc_id FROM span) GROUP BY secret),
judged AS (SELECT *, n_owners >= 3 OR n_owners >= 2 AND n_repositories >= 10 AS copied FROM held),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg({_SPAN}, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg({_SPAN}, ',' ORDER BY s, rank) AS spans,
    count(*) FILTER (copied) AS n_copied, count(*) FILTER (NOT copied) AS n_live, max(n_owners) AS most_owners, max(n_repositories) AS most_repositories
    FROM span JOIN judged USING (secret) GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(n_copied, 0) AS n_copied, coalesce(n_live, 0) AS n_live, coalesce(most_owners, 0) AS most_owners,
    coalesce(most_repositories, 0) AS most_repositories
FROM doc LEFT JOIN per USING (doc_id)
"""

OP8 = f"""
WITH sized AS (SELECT doc_id, source, CAST(len({_SPACE}) AS BIGINT) AS size FROM documents),
total AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][place % 3 + 1] AS weight, source_size * 3.0::DOUBLE AS cap FROM total),
levelled AS (SELECT *, row_number() OVER o AS turn, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed WINDOW o AS (ORDER BY cap / weight, place)),
aimed AS (SELECT source, source_size, coalesce(least(cap, weight * (SELECT min_by(level, turn) FROM levelled WHERE cap > level * weight)), cap) AS target FROM levelled),
placed AS (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start FROM sized),
used AS (SELECT doc_id, p.source, size, source_size, target, start, CAST(round(target) AS BIGINT) AS t FROM placed p JOIN aimed a ON p.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, source, size, source_size, target, CAST(list_sum(list_transform(range(0, 4),
    lambda j: greatest(0, least(start + j * source_size + size, t) - (start + j * source_size)))) AS BIGINT) AS taken FROM used
"""

OP10 = f"""
WITH doc AS (SELECT doc_id, {_SPACE} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc)),
bad AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least_id FROM win) WHERE doc_id > least_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM bad),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM doc),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY pos) AS text FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

_LETTERS = rf"regexp_extract_all(coalesce({_LOWERED}, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"


def _share(n: str, total: str) -> str:
    return f"1 + (1000000000::HUGEINT * ({n} + 5)) // ({total} + 5 * v)"


OP11 = f"""
WITH doc AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LETTERS} AS w FROM documents),
occ AS (SELECT r, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM doc),
cnt AS (SELECT lang, source, term, count(*) AS c FROM occ SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
tot AS (SELECT lang, source, coalesce(sum(c), 0) AS total FROM grp LEFT JOIN cnt USING (lang, source) GROUP BY lang, source),
p AS (SELECT k.lang, t.source, k.term, coalesce(c, 0) AS c, {_share("coalesce(c, 0)", "t.total")} AS p, {_share("n", "s.total")} AS q
    FROM tot t JOIN kept k ON k.lang = t.lang JOIN size s ON s.lang = t.lang LEFT JOIN cnt ON cnt.lang = t.lang AND cnt.source = t.source AND cnt.term = k.term),
apart AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL),
part AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM part)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

_USABLE = "list_bool_and(list_transform({0}, lambda x: x IS NOT NULL AND isfinite(x)))"
_SQUARED = "list_sum(list_transform(range(1, 65), lambda i: (a.e[i] - c.e[i]) * (a.e[i] - c.e[i])))"


def _op12(rounds: int = 10) -> str:
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE len(embedding) = 64 AND {_USABLE.format("embedding")})""",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e FROM (SELECT sha256('3:' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT 8))",
    ]
    for i in range(rounds + 1):
        near = f"min(CAST({_SQUARED} AS HUGEINT) * 8 + c.c)"
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, CAST(near % 8 AS INTEGER) AS c, CAST(near // 8 AS BIGINT) AS d FROM (SELECT r, {near} AS near FROM v a, c{i} c GROUP BY r))")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN (SELECT c, list(x ORDER BY place) AS e FROM
    (SELECT c, place, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM (SELECT c, unnest(range(1, 65)) AS place, unnest(e) AS x FROM v JOIN a{i} USING (r)) GROUP BY c, place) GROUP BY c) m ON m.c = c.c)""")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, a.c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.e, ',')) AS centroid_sha256 FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c ON c.c = a.c
"""


OP13 = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE {_USABLE.format("embedding")} AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
scored AS (SELECT q.r, q.vec_id AS query_id, c.r AS other, c.vec_id, list_dot_product(q.e, c.e) AS score FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS FIRST, other) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

ORACLE_SQL = {"op1_decontamination": OP1, "op2_quality_rules": OP2, "op5_secrets": OP5, "op8_mixing": OP8, "op10_repeats": OP10, "op11_divergence": OP11, "op12_clusters": _op12(), "op13_neighbours": OP13}
