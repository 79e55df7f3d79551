"""The named queries' answers as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from flowengine.llm.queries import URL_RULES


def _url_filter() -> str:
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    return f"""
        WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
        rest AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0
                            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ),
        parsed AS (
            SELECT page_id, row_number() OVER () AS i,
                   translate(regexp_extract(rest, '^[^/?#]*'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rest
        ),
        fits AS (
            SELECT i, rule_host || rule_path AS rule, rule_verdict,
                   row_number() OVER (PARTITION BY i
                                      ORDER BY length(rule_host || rule_path) DESC,
                                               rule_host || rule_path DESC) AS n
            FROM parsed JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host))
             AND starts_with(path, rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM parsed LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (i)
    """


_USABLE = """
    embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

_EXACT_TOPK = f"""
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE}
    ),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, max(list_dot_product(q.v, c.v))::BIGINT AS score
        FROM whole q JOIN whole c
          ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        GROUP BY ALL
    )
    SELECT query_id,
           (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER
           AS rank, vec_id, score
    FROM scored QUALIFY rank <= 10
"""

_EMBEDDING_NEAR_DEDUP = f"""
    WITH RECURSIVE rows AS (
        SELECT row_number() OVER () AS i, vec_id, label, embedding::DOUBLE[] AS v,
               vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE} AS able
        FROM embeddings
    ),
    links AS (
        SELECT a.i AS a, b.i AS b FROM rows a JOIN rows b
          ON a.able AND b.able AND a.label = b.label AND a.i <> b.i AND len(a.v) = len(b.v)
         AND list_dot_product(a.v, b.v) >= 0.93 * sqrt(list_dot_product(a.v, a.v))
                                                * sqrt(list_dot_product(b.v, b.v))
        WHERE list_dot_product(a.v, a.v) > 0 AND list_dot_product(b.v, b.v) > 0
    ),
    reached AS (
        SELECT i AS start, i FROM rows
        UNION
        SELECT r.start, l.b FROM reached r JOIN links l ON r.i = l.a
    ),
    lowest AS (
        SELECT start, min(vec_id) AS component_id
        FROM reached JOIN rows USING (i) GROUP BY start
    ),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id,
           vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM rows JOIN lowest ON rows.i = lowest.start LEFT JOIN counted ON counted.a = rows.i
"""

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_LINE_DEDUP = f"""
    WITH rows AS (
        SELECT row_number() OVER () AS i, doc_id, text, string_split(text, chr(10)) AS parts
        FROM documents
    ),
    identities AS (
        SELECT i, dense_rank() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS document
        FROM rows
    ),
    lines AS (
        SELECT i, unnest(range(len(parts))) AS place, unnest(parts) AS line FROM rows
        WHERE text IS NOT NULL
    ),
    trimmed AS (
        SELECT i, document, place, trim(line, {_BLANKS}) AS line
        FROM lines JOIN identities USING (i)
    ),
    parsed AS (
        SELECT i, document, place, string_split_regex(line, '{_SPACE}+') AS raw,
               string_split_regex(regexp_replace(line, '{_WORD}*[0-9]{_WORD}*', '<*>', 'g'),
                                  '{_SPACE}+') AS tokens
        FROM trimmed WHERE line <> ''
    ),
    known AS (
        SELECT i, document, place, n, tokens[1:3] AS start, fixed >= 0.8 * n AS parsed,
               CASE WHEN n >= 3 AND fixed >= 0.8 * n THEN tokens ELSE raw END AS own
        FROM (SELECT *, len(tokens) AS n,
                     len(list_filter(tokens, lambda x: x <> '<*>')) AS fixed FROM parsed)
        WHERE n >= 3 OR length(array_to_string(raw, ' ')) >= 32
    ),
    firsts AS (
        SELECT n, start, parsed, own, min(document) AS first FROM known GROUP BY ALL
    ),
    likes AS (
        SELECT x.n, x.start, x.parsed, x.own, min(y.first) AS first
        FROM firsts x JOIN firsts y ON x.n = y.n AND x.start = y.start AND y.first < x.first
        WHERE x.parsed AND y.parsed AND x.n >= 3
          AND len(list_filter(list_zip(x.own, y.own), lambda z: z[1] = z[2] AND z[1] <> '<*>'))
              >= 0.8 * x.n
        GROUP BY ALL
    ),
    templates AS (
        SELECT n, start, parsed, own, min(first) AS first
        FROM (SELECT * FROM firsts UNION ALL SELECT * FROM likes) GROUP BY ALL
    ),
    dropped AS (
        SELECT k.i, list(k.place) AS gone FROM known k JOIN templates t
          ON k.n = t.n AND k.start = t.start AND k.parsed = t.parsed AND k.own = t.own
        WHERE k.document > t.first GROUP BY k.i
    )
    SELECT doc_id,
           CASE WHEN gone IS NULL THEN text ELSE array_to_string(
               list_filter(parts, lambda part, k: NOT list_contains(gone, k - 1)), chr(10))
           END AS text,
           CASE WHEN text IS NULL THEN 0 ELSE len(parts) END AS n_lines,
           coalesce(len(gone), 0) AS n_dropped
    FROM rows LEFT JOIN dropped USING (i)
"""

_SOURCE_MIXING = f"""
    WITH sized AS (
        SELECT row_number() OVER () AS i, doc_id, source,
               len(regexp_extract_all(coalesce(text, ''), '{_WORD}+')) AS size,
               md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS mark
        FROM documents
    ),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
               row_number() OVER (ORDER BY source NULLS LAST) AS no
        FROM sized GROUP BY source
    ),
    levels AS (
        SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                   - coalesce(sum(2 * source_size) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING
                                                         AND 1 PRECEDING), 0))
                  / sum(weight) OVER (filling ROWS BETWEEN CURRENT ROW
                                      AND UNBOUNDED FOLLOWING) AS level
        FROM sources WINDOW filling AS (ORDER BY source_size / weight, no)
    ),
    targets AS (
        SELECT source, source_size,
               least((2 * source_size)::DOUBLE, max(level) OVER () * weight) AS target
        FROM levels
    ),
    quotas AS (
        SELECT t.*, no, floor(target + 0.5)::BIGINT AS quota
        FROM targets t JOIN sources s ON s.source IS NOT DISTINCT FROM t.source
    ),
    placed AS (
        SELECT s.*, t.source_size, t.target, t.no, t.quota,
               coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY mark, size, s.doc_id, i
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS start
        FROM sized s JOIN quotas t ON s.source IS NOT DISTINCT FROM t.source
    ),
    line AS (
        SELECT *, ((quota + 1023) // 1024)::BIGINT AS blocks,
               coalesce(sum(quota) OVER (ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING
                                         AND 1 PRECEDING), 0)::HUGEINT AS low,
               sum(quota) OVER ()::HUGEINT AS every
        FROM quotas
    ),
    points AS (
        SELECT slot, (slot % 4294967296) * 1640531527 % 4294967296 AS point
        FROM (SELECT unnest(range(sum(blocks)::BIGINT)) AS slot FROM line)
    ),
    ranked AS (
        SELECT slot, no, blocks, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS rank
        FROM points JOIN line ON point >= low * 4294967296 // every
                             AND point < (low + quota) * 4294967296 // every
    ),
    late AS (
        SELECT no, unnest(range(had, blocks)) AS rank
        FROM (SELECT l.no, blocks, count(r.no) AS had
              FROM line l LEFT JOIN ranked r USING (no, blocks) GROUP BY ALL)
    ),
    slots AS (
        SELECT slot, no, rank FROM ranked WHERE rank < blocks
        UNION ALL
        SELECT (SELECT sum(blocks) FROM line)::BIGINT + rank, no, rank FROM late
    ),
    stretches AS (
        SELECT i, no, start + epoch * source_size AS a,
               least(start + epoch * source_size + size, quota) AS b
        FROM placed, (VALUES (0), (1)) AS t(epoch) WHERE size > 0
    ),
    pieces AS (
        SELECT i, no, unnest(range((a // 1024)::BIGINT, ((b - 1) // 1024 + 1)::BIGINT)) AS rank
        FROM stretches WHERE a < b
    ),
    scheduled AS (
        SELECT i, min(slot) AS first_slot, count(*) AS n_slots
        FROM pieces JOIN slots USING (no, rank) GROUP BY i
    )
    SELECT doc_id, size, source_size, target,
           (greatest(least(quota - start, size), 0)
            + greatest(least(quota - source_size - start, size), 0))::BIGINT AS taken,
           first_slot, coalesce(n_slots, 0) AS n_slots
    FROM placed LEFT JOIN scheduled USING (i)
"""


def _weight(deviations: str, groups: str, rows: str) -> str:
    between = (f"(({deviations}) / greatest({groups} - 1, 1) - max(good) * (1 - max(good)))"
               f" * {groups} / {rows}")
    return (f"least(greatest(CASE WHEN {between} > 0 THEN max(good) * (1 - max(good))"
            f" / ({between}) - 1 ELSE 1e6 END, 1.0), 1e6)::DOUBLE")


_SHAPES = "coalesce(text, '')"
for _letters, _kind in (("[a-zß-öø-ÿ]+", "a"), ("[A-ZÀ-ÖØ-Þ]+", "A"), ("[0-9]+", "0")):
    _SHAPES = f"regexp_replace({_SHAPES}, '{_letters}', '{_kind}', 'g')"

_QUALITY = f"""
    WITH texts AS (
        SELECT row_number() OVER () AS i, doc_id, source AS host, lang AS path,
               length(coalesce(text, '')) AS chars,
               string_split_regex(trim(coalesce(text, ''), {_BLANKS}), '{_SPACE}+') AS words,
               string_split_regex(trim({_SHAPES}, {_BLANKS}), '{_SPACE}+') AS shapes
        FROM documents
    ),
    named AS (
        SELECT i, list_concat(shapes, [
            'length ' || least(chars // len(words), 15), 'variety ' || (len(list_distinct(words)) * 16 // len(words)),
            'words ' || floor(log2(len(words)))::BIGINT]) AS names FROM texts
    ),
    cells AS (
        SELECT DISTINCT i, ('0x' || substr(md5(name), 1, 3))::INTEGER AS cell
        FROM (SELECT i, unnest(names) AS name FROM named)
    ),
    known AS (
        SELECT doc_id, sum(good) AS good, sum(1 - good) AS bad
        FROM (SELECT DISTINCT doc_id, quality AS good FROM labels
              WHERE doc_id IS NOT NULL AND quality IS NOT NULL) GROUP BY doc_id
    ),
    rows AS (
        SELECT i, t.doc_id, host, path, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
        FROM texts t LEFT JOIN known k ON t.doc_id = k.doc_id
    ),
    labelled AS (SELECT * FROM rows WHERE good + bad > 0),
    totals AS (SELECT coalesce(sum(good), 0) AS goods, coalesce(sum(bad), 0) AS bads FROM labelled),
    counts AS (SELECT cell, sum(good) AS g, sum(bad) AS b FROM cells JOIN labelled USING (i) GROUP BY cell),
    sums AS (
        SELECT r.i, sum(ln((coalesce(g, 0) - good + 1) / (goods - good + 2)::DOUBLE)
                        - ln((coalesce(b, 0) - bad + 1) / (bads - bad + 2)::DOUBLE)) AS added
        FROM rows r JOIN cells USING (i) LEFT JOIN counts USING (cell) CROSS JOIN totals GROUP BY r.i
    ),
    paths AS (SELECT host, path, sum(good + bad) AS n, sum(good) AS k FROM labelled GROUP BY ALL),
    hosts AS (SELECT host, sum(n) AS host_n, sum(k) AS host_k FROM paths GROUP BY ALL),
    everything AS (SELECT coalesce(sum(host_n), 0) AS all_n, coalesce(sum(host_k), 0) AS all_k,
                          count(*) AS hosts,
                          (coalesce(sum(host_k), 0) + 1) / (coalesce(sum(host_n), 0) + 2)::DOUBLE AS good
                   FROM hosts),
    spread AS (
        SELECT {_weight('sum(host_n * (host_k / host_n::DOUBLE - good) ** 2)',
                        'max(hosts)', 'max(all_n)')} AS host_weight
        FROM hosts CROSS JOIN everything
    ),
    placed AS (
        SELECT p.*, good, (host_k + host_weight * good) / (host_n + host_weight) AS host_prior
        FROM paths p JOIN hosts h ON p.host IS NOT DISTINCT FROM h.host
        CROSS JOIN everything CROSS JOIN spread
    ),
    path_spread AS (
        SELECT {_weight('sum(n * (k / n::DOUBLE - host_prior) ** 2)', 'count(*)', 'sum(n)')}
               AS path_weight FROM placed
    ),
    based AS (
        SELECT r.*, added, (all_k - r.good + 1) / (all_n - r.good - r.bad + 2)::DOUBLE AS every
        FROM rows r JOIN sums USING (i) CROSS JOIN everything
    ),
    losses AS (
        SELECT share, round(sum(good * ln(1 + exp(-logit)) + bad * ln(1 + exp(logit))), 6) AS loss
        FROM (SELECT good, bad, share,
                     ln(every / (1 - every)) + least(greatest(added, -600), 600) * share AS logit
              FROM based, (SELECT unnest(range(1, 21)) / 20.0::DOUBLE AS share) WHERE good + bad > 0)
        GROUP BY share
    ),
    best AS (SELECT share FROM losses ORDER BY loss, share LIMIT 1),
    scored AS (
        SELECT b.doc_id, b.host, b.path, added * share AS evidence,
               (coalesce(k, 0) - b.good + path_weight * (
                   (coalesce(host_k, 0) - b.good + host_weight * every)
                   / (coalesce(host_n, 0) - b.good - b.bad + host_weight)))
               / (coalesce(n, 0) - b.good - b.bad + path_weight) AS prior
        FROM based b
        LEFT JOIN paths p ON b.host IS NOT DISTINCT FROM p.host AND b.path IS NOT DISTINCT FROM p.path
        LEFT JOIN hosts h ON b.host IS NOT DISTINCT FROM h.host
        CROSS JOIN spread CROSS JOIN path_spread CROSS JOIN best
    ),
    judged AS (
        SELECT *, round(1 / (1 + exp(-(ln(prior / (1 - prior)) + evidence))), 6) AS quality
        FROM scored
    )
    SELECT doc_id, host, path, round(evidence, 6) AS evidence, round(prior, 6) AS prior, quality,
           quality >= 0.5 AS kept
    FROM judged
"""


#: Common table expressions with the table of CRC-32 for each byte.
_CRC_TABLE = """crc_steps(i, v, k) AS (
        SELECT i, i, 0 FROM range(256) t(i)
        UNION ALL
        SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1
        FROM crc_steps WHERE k < 8
    ),
    crc AS (SELECT list(v ORDER BY i) AS t FROM crc_steps WHERE k = 8),"""

_MERKLE_MANIFEST = f"""
    WITH RECURSIVE {_CRC_TABLE}
    marked AS (
        SELECT row_number() OVER () AS i, d.*, coalesce(xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(
                    string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 5 = 0, false)
            AS marked
        FROM documents d, crc
    ),
    texts AS (
        SELECT *, text AS original, CASE WHEN marked THEN translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS copied
        FROM marked
    ),
    digests AS (
        SELECT doc_id, coalesce('=' || source, '') AS tree,
               sha256(head || coalesce(strlen(original) || ':' || original, '-')) AS leaf,
               sha256(head || coalesce(strlen(copied) || ':' || copied, '-')) AS claimed
        FROM (
            SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
            FROM texts
        )
    ),
    leaves AS (
        SELECT *, row_number() OVER (PARTITION BY tree
                                     ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos,
               count(*) OVER (PARTITION BY tree) AS n
        FROM digests
    ),
    nodes(tree, level, pos, n, digest) AS (
        SELECT tree, 0, pos, n, leaf FROM leaves
        UNION ALL
        SELECT tree, level + 1, pos // 16, (any_value(n) + 15) // 16,
               sha256(string_agg(digest, '' ORDER BY pos))
        FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 16
    ),
    subroots AS (
        SELECT tree, level, digest, row_number() OVER (ORDER BY tree) - 1 AS pos,
               count(*) OVER () AS n
        FROM nodes WHERE n = 1
    ),
    upper(level, pos, n, digest) AS (
        SELECT 0, pos, n, digest FROM subroots
        UNION ALL
        SELECT level + 1, pos // 16, (any_value(n) + 15) // 16,
               sha256(string_agg(digest, '' ORDER BY pos))
        FROM upper WHERE n > 1 GROUP BY level, pos // 16
    ),
    above AS (
        SELECT a.level, a.pos,
               coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lft,
               coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS rgt
        FROM upper a JOIN upper b ON a.level = b.level AND a.pos // 16 = b.pos // 16
        WHERE a.n > 1 GROUP BY a.level, a.pos
    ),
    steps AS (
        SELECT a.tree, a.level, a.pos,
               coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lft,
               coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS rgt
        FROM nodes a JOIN nodes b
          ON a.tree = b.tree AND a.level = b.level AND a.pos // 16 = b.pos // 16
        WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos
        UNION ALL
        SELECT s.tree, s.level + u.level, x.pos, u.lft, u.rgt
        FROM subroots s JOIN above u ON u.pos = s.pos // (16 ** u.level)::BIGINT
        CROSS JOIN (SELECT 0 AS pos) x
    ),
    folded(tree, first, claimed, level, place, proof) AS (
        SELECT tree, pos, claimed, 0, pos, '' FROM leaves
        UNION ALL
        SELECT f.tree, f.first, sha256(s.lft || f.claimed || s.rgt), f.level + 1, f.place // 16,
               f.proof || s.lft || s.rgt
        FROM folded f JOIN steps s ON s.tree = f.tree AND s.level = f.level AND s.pos = f.place
    ),
    ends AS (
        SELECT tree, first, arg_max(claimed, level) AS folded_root,
               sha256(arg_max(proof, level)) AS proof_sha256
        FROM folded GROUP BY tree, first
    )
    SELECT l.doc_id, l.leaf, s.digest AS subroot, u.digest AS root, e.proof_sha256,
           e.folded_root, e.folded_root = u.digest AS verified
    FROM leaves l JOIN subroots s USING (tree) JOIN ends e ON e.tree = l.tree AND e.first = l.pos
    CROSS JOIN (SELECT digest FROM upper WHERE n = 1) u
"""


def _words(text: str) -> str:
    lowered = (
        f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


_BENCHMARK_DECONTAMINATION = f"""
    WITH items AS (
        SELECT item_id::VARCHAR AS item, {_words("text")} AS w FROM benchmark
    ),
    phrases AS (
        SELECT DISTINCT item, list_slice(w, s, s + 9) AS phrase FROM (
            SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s
            FROM items WHERE len(w) > 0
        )
    ),
    words AS (
        SELECT row_number() OVER () AS i, doc_id, {_words("text")} AS w FROM documents
    ),
    found AS (
        SELECT i, s, n, item
        FROM (
            SELECT i, s, n, list_slice(w, s, s + n - 1) AS phrase
            FROM (SELECT i, w, n, unnest(range(1, len(w) - n + 2)) AS s
                  FROM words CROSS JOIN (SELECT DISTINCT len(phrase) AS n FROM phrases) sizes)
        ) JOIN phrases USING (phrase)
    ),
    hits AS (
        SELECT i, count(DISTINCT place) AS n_hit
        FROM (SELECT i, unnest(range(s, s + n)) AS place FROM found) GROUP BY i
    ),
    named AS (
        SELECT i, list(item ORDER BY item) AS named
        FROM (SELECT DISTINCT i, item FROM found WHERE item IS NOT NULL) GROUP BY i
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(len(named), 0) AS n_items,
           sha256(coalesce(array_to_string(named, ','), '')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated
    FROM words LEFT JOIN hits USING (i) LEFT JOIN named USING (i)
"""

_SPELLING_VARIANTS = f"""
    WITH RECURSIVE {_CRC_TABLE}
    runs AS (
        SELECT doc_id, run, count(*) AS c
        FROM (
            SELECT doc_id, unnest(regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
            FROM documents
        ) WHERE length(run) >= 6 GROUP BY doc_id, run
    ),
    hashed AS (
        SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
            string_split(coalesce(doc_id::VARCHAR, 'null') || ':' || run, ''),
            lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT]
                           ELSE [195::BIGINT, ord(x)::BIGINT - 64] END))),
            lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS h
        FROM runs, crc
    ),
    words AS (
        SELECT word, sum(c)::BIGINT AS n
        FROM (
            SELECT c, CASE WHEN h % 199 = 0
                      THEN substr(run, 1, (h % length(run))::INT)
                           || substr(run, (h % length(run))::INT + 2)
                      ELSE run END AS word
            FROM hashed
        ) WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
    ),
    places AS (SELECT word, n, unnest(range(0, length(word))) AS j FROM words),
    masks AS (
        SELECT word, n, substr(word, 1, j) || '*' || substr(word, j + 2) AS mask FROM places
    ),
    shorter AS (
        SELECT DISTINCT p.word, p.n, w.word AS near, w.n AS near_n
        FROM places p JOIN words w ON w.word = substr(p.word, 1, j) || substr(p.word, j + 2)
    ),
    near AS (
        SELECT a.word, b.word AS near, b.n AS near_n
        FROM masks a JOIN masks b ON a.mask = b.mask AND a.word <> b.word
        UNION ALL SELECT word, near, near_n FROM shorter
        UNION ALL SELECT near, word, n FROM shorter
    ),
    best AS (
        SELECT word, count(*) AS n_near,
               first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
        FROM near GROUP BY word
    ),
    formed AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near,
               CASE WHEN near_n >= 5 * n THEN near END AS form,
               CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
        FROM words LEFT JOIN best USING (word)
    ),
    chains(word, root, form) AS (
        SELECT word, word, form FROM formed
        UNION ALL
        SELECT c.word, f.word, f.form FROM chains c JOIN formed f ON f.word = c.form
    )
    SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
    FROM formed f JOIN chains c ON c.word = f.word AND c.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    """Left out: what rests on 64-bit xxHash, on a vocabulary's merges or on n-gram profiles."""
    return {
        "op1_exact_topk": _EXACT_TOPK,
        "op2_embedding_near_dedup": _EMBEDDING_NEAR_DEDUP,
        "op3_line_dedup": _LINE_DEDUP,
        "op4_source_mixing": _SOURCE_MIXING,
        "op7_quality": _QUALITY,
        "op8_url_filter": _url_filter(),
        "op11_merkle_manifest": _MERKLE_MANIFEST,
        "op12_benchmark_decontamination": _BENCHMARK_DECONTAMINATION,
        "op13_spelling_variants": _SPELLING_VARIANTS,
    }
