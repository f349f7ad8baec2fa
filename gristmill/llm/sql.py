"""SQL that gives the rows of the registered queries, over whole tables.

Operator 10 has none: cutting a window out of a text at every byte takes minutes even on the small tables.
"""

from __future__ import annotations

import math

from gristmill.llm.licenses import PHRASES, TEMPLATES, THRESHOLD
from gristmill.llm.line_edits import EDITS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
PLAIN = r"regexp_extract_all(translate({}, '" + UPPER + "', '" + LOWER + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def components(nodes: str, links: str) -> str:
    """Ends a WITH RECURSIVE: every node with the smallest one that links reach; ``links`` goes both ways."""
    return f"""reach AS (SELECT DISTINCT id AS a, id AS b FROM {nodes}
      UNION SELECT reach.a, l.b FROM reach JOIN {links} AS l ON reach.b = l.a),
    roots AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""


NEAR_DUPLICATES = f"""WITH RECURSIVE
    worded AS (SELECT doc_id AS id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
    sets AS (SELECT id, list_distinct(CASE WHEN len(w) < 2 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM worded),
    members AS (SELECT id, len(s) AS n, unnest(s) AS m FROM sets),
    pairs AS (SELECT x.id AS a, y.id AS b FROM members x JOIN members y ON x.m = y.m AND x.id < y.id
        AND x.n * 100 >= y.n * 80 AND y.n * 100 >= x.n * 80
        GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
    {components('sets', 'links')}
    SELECT id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, component_id = id AS kept
    FROM sets JOIN roots USING (id)"""

VECTORS = f"""WITH RECURSIVE
    doubles AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    usable AS (SELECT id, label, v, sqrt(list_inner_product(v, v)) AS size FROM doubles
        WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL)) = 0
        AND len(list_filter(v, lambda x: NOT isfinite(x))) = 0 AND list_max(list_transform(v, lambda x: abs(x))) > 0),
    pairs AS (SELECT x.id AS a, y.id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.id < y.id AND len(x.v) = len(y.v)
        WHERE list_inner_product(x.v, y.v) / (x.size * y.size) >= 0.98),
    links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
    {components('doubles', 'links')},
    degrees AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
    SELECT roots.id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, component_id = roots.id AS kept
    FROM roots LEFT JOIN degrees ON roots.id = degrees.id"""


def _repeats(texts: str, unit: str, window: str, width: int, counts: str, kept: str) -> str:
    """Units of each text with the hash of the window that starts there; covered are those of windows that start twice."""
    return f"""WITH {texts},
    keyed AS (SELECT id, unnest(list_transform(range(1, n + 1), lambda j: {unit})) AS u,
        unnest(list_transform(range(1, n + 1), lambda j: CASE WHEN j + {width - 1} <= n THEN hash({window}) END)) AS k,
        unnest(range(1, n + 1)) AS j FROM cut),
    twice AS (SELECT k FROM keyed WHERE k IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
    marked AS (SELECT id, j, u, max(CASE WHEN twice.k IS NOT NULL THEN j END)
        OVER (PARTITION BY id ORDER BY j ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
        FROM keyed LEFT JOIN twice ON keyed.k = twice.k),
    runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY id ORDER BY j), false) AS starts FROM marked),
    found AS (SELECT id, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
        CAST(count(*) FILTER (WHERE starts) AS BIGINT) AS n_spans, {kept} AS kept_sha256 FROM runs GROUP BY id)
    SELECT cut.id AS doc_id, CAST(cut.n AS BIGINT) AS {counts}, coalesce(n_removed, 0) AS n_removed,
        coalesce(n_spans, 0) AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256
    FROM cut LEFT JOIN found ON cut.id = found.id"""


PASSAGES = _repeats(
    f"""cut AS (SELECT doc_id AS id, {WORDS.format("coalesce(text, '')")} AS w, len(w) AS n FROM documents)""",
    "w[j]", "array_to_string(w[j:j + 34], ' ')", 35, "n_words",
    "sha256(coalesce(string_agg(u, ' ' ORDER BY j) FILTER (WHERE NOT gone), ''))",
)

def _licenses() -> str:
    places, labels = [], []
    for phrase, label in PHRASES.items():
        words = phrase.split()
        equal = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words))
        places.append(f"list_filter(range(1, len(w) + 1), lambda i: {equal})")
        labels.append(f"CASE WHEN len({places[-1]}) > 0 THEN '{label}' END")
    templates = []
    for label, wording in TEMPLATES.items():
        words = sorted(set(wording.split()))
        need = math.ceil(THRESHOLD * len(words) - 1e-9)
        listed = ", ".join(f"'{word}'" for word in words)
        templates.append(f"('{label}', [{listed}], {len(words)}, {need})")
    joined = " || ".join(f"coalesce({p}, [])" for p in places)
    reach = max(len(wording.split()) for wording in TEMPLATES.values())
    return f"""WITH base AS (SELECT doc_id, {PLAIN.format("coalesce(text, '')")} AS w FROM documents),
    placed AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, {joined} AS places,
        list_filter([{", ".join(labels)}], lambda x: x IS NOT NULL) AS phrases FROM base),
    lines AS (SELECT doc_id, i, len({PLAIN.format('line')}) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
    ends AS (SELECT doc_id, n, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS e FROM lines),
    blocks AS (SELECT doc_id, list_distinct(w[e - n + 1:e + {reach}]) AS b FROM ends JOIN base USING (doc_id) WHERE n > 0),
    templates(label, t, size, need) AS (VALUES {", ".join(templates)}),
    matched AS (SELECT doc_id, label, max(CAST(len(list_intersect(b, t)) AS DOUBLE) / size) AS share
        FROM blocks, templates WHERE len(b) >= need AND len(list_intersect(b, t)) >= need GROUP BY 1, 2),
    more AS (SELECT doc_id, list(label) AS labels, max(share) AS share FROM matched GROUP BY 1)
    SELECT doc_id, n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) - 1 AS BIGINT) AS first_word,
        CAST(list_max(places) - 1 AS BIGINT) AS last_word, array_to_string(list_sort(phrases), ',') AS base_labels,
        array_to_string(list_sort(list_distinct(phrases || coalesce(more.labels, []))), ',') AS labels,
        CASE WHEN len(phrases) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
    FROM placed LEFT JOIN more USING (doc_id)"""


LICENSES = _licenses()

#: levenshtein() counts bytes: every letter beyond ASCII becomes one unused byte first. Of two lines within two edits
#: one third of the shorter stands in the longer.
SPARE = "".join(f" || chr({i})" for i in [*range(1, 9), 11, 12, *range(14, 32)])[4:]
EDITS_OF = "".join(f"WHEN n >= {least} THEN {edits} " for least, edits in reversed(EDITS))
LINES = f"""WITH split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS number
        FROM documents WHERE text IS NOT NULL),
    lines AS (SELECT doc_id, number, trim(line, ' ' || chr(9) || chr(13)) AS line FROM split),
    odd AS (SELECT string_agg(c, '' ORDER BY c) AS letters FROM (
        SELECT DISTINCT unnest(regexp_extract_all(line, '[^\\x00-\\x7F]')) AS c FROM lines)),
    classes AS (SELECT line, length(line) AS n, min((doc_id, number)) AS first FROM lines WHERE line <> '' GROUP BY 1),
    plain AS MATERIALIZED (SELECT line, n, first, CASE {EDITS_OF}ELSE 0 END AS edits,
        translate(line, coalesce((SELECT letters FROM odd), ''), {SPARE}) AS p FROM classes),
    pairs AS (SELECT x.line AS a, y.line AS b, x.first AS fa, y.first AS fb, x.p AS pa, y.p AS pb, x.edits FROM plain x
        JOIN (SELECT *, unnest([0, 1, 2]) AS gap FROM plain) y ON y.n - y.gap = x.n
        WHERE y.gap <= x.edits AND x.edits > 0 AND x.line <> y.line AND (contains(y.p, substr(x.p, 1, x.n // 3))
            OR contains(y.p, substr(x.p, x.n // 3 + 1, x.n // 3)) OR contains(y.p, substr(x.p, 2 * (x.n // 3) + 1)))),
    near AS (SELECT a, b, fa, fb FROM pairs WHERE levenshtein(pa, pb) <= edits),
    later AS (SELECT a AS line FROM near WHERE fb < fa UNION SELECT b FROM near WHERE fa < fb),
    judged AS (SELECT doc_id, number, first IS NOT NULL AND (later.line IS NOT NULL OR (doc_id, number) > first) AS goes
        FROM lines LEFT JOIN classes USING (line) LEFT JOIN later USING (line)),
    found AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_removed,
        coalesce(string_agg(CAST(number AS VARCHAR), ',' ORDER BY number) FILTER (WHERE goes), '') AS removed
    FROM judged GROUP BY doc_id)
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
    FROM documents LEFT JOIN found USING (doc_id)"""


def _centroids(size: int = 64, clusters: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> str:
    """The rounds written out: distances to all centroids, the nearest, then the floor of each mean."""
    order = f"sha256('{seed}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x"
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
        WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {order}) - 1 AS c, x FROM kept ORDER BY {order} LIMIT {clusters})"""]
    far = "list_sum(list_transform(range(1, len(kept.x) + 1), lambda i: (kept.x[i] - k.x[i]) * (kept.x[i] - k.x[i])))"
    for turn in range(rounds + 1):
        parts.append(f"""a{turn} AS MATERIALIZED (SELECT r, min((CAST({far} AS BIGINT), k.c)) AS best
        FROM kept, c{turn} AS k GROUP BY r)""")
        if turn < rounds:
            parts.append(f"""s{turn} AS (SELECT a{turn}.best[2] AS c, unnest(x) AS e, generate_subscripts(x, 1) AS i
        FROM kept JOIN a{turn} USING (r)),
    m{turn} AS (SELECT c, i, sum(e) AS s, count(*) AS n FROM s{turn} GROUP BY 1, 2),
    f{turn} AS (SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM m{turn} GROUP BY 1),
    c{turn + 1} AS MATERIALIZED (SELECT k.c, coalesce(f.x, k.x) AS x FROM c{turn} k LEFT JOIN f{turn} f ON k.c = f.c)""")
    return f"""WITH {", ".join(parts)},
    placed AS (SELECT r, best[1] AS d, best[2] AS c FROM a{rounds}),
    inertias AS (SELECT c, CAST(sum(d) AS BIGINT) AS t FROM placed GROUP BY 1)
    SELECT kept.vec_id, CAST(placed.c AS INTEGER) AS cluster, placed.d AS distance, inertias.t AS cluster_inertia,
        (SELECT CAST(sum(d) AS BIGINT) FROM placed) AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
    FROM kept JOIN placed USING (r) JOIN inertias USING (c) JOIN c{rounds} AS k USING (c)"""


SQL = {
    "op1_minhash_near_dedup": NEAR_DUPLICATES,
    "op3_substring_dedup": PASSAGES,
    "op6_embedding_near_dedup": VECTORS,
    "op7_license_scan": LICENSES,
    "op8_line_dedup": LINES,
    "op11_centroid_clustering": _centroids(),
}
