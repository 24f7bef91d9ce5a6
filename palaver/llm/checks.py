"""DuckDB SQL of the queries that SQL can express: sharding, repeated windows, search, fill-in-middle, licences, clusters."""

from __future__ import annotations

from palaver.llm import license_scan

DRAW = "(('0x' || substr(md5(key || ':{shard}'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0"
CRC_POLYNOMIAL = 0xEDB88320


def rendezvous(shards: int) -> str:
    """One score per shard and row, and CRC-32 of the text's bytes by a table of 256 steps."""
    scores = [f"-1.0 / ln({DRAW.format(shard=i)})" for i in range(shards + 1)]
    step = f"CASE WHEN c & 1 = 1 THEN xor(c >> 1, {CRC_POLYNOMIAL}) ELSE c >> 1 END"
    return f"""
    WITH crc_table AS (SELECT list(list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: {step}) ORDER BY b) AS t
        FROM (SELECT unnest(generate_series(0, 255)) AS b)),
    keyed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS data, coalesce(doc_id::VARCHAR, 'null') AS key FROM documents),
    crc AS (SELECT doc_id, key, length(data) // 2 + 8 AS size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(data, '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32 FROM keyed, crc_table),
    drawn AS (SELECT *, [{', '.join(scores[:shards])}] AS s, {scores[shards]} AS grown FROM crc),
    won AS (SELECT doc_id, size, text_crc32, list_position(s, list_max(s)) - 1 AS shard,
        grown > list_max(s) AS moves, substr(md5(key || '/' || size || '/' || text_crc32), 1, 3) AS cell FROM drawn)
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
           row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
           CASE WHEN moves THEN {shards} ELSE shard END::INTEGER AS grown_shard FROM won"""


def repeated_windows(size: int) -> str:
    return rf"""
    WITH texts AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS MATERIALIZED (SELECT r, i, array_to_string(ws[i:i + {size - 1}], ' ') AS k
        FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - {size - 1})) AS i FROM texts)),
    again AS (SELECT r, i FROM windows WHERE k IN (SELECT k FROM windows GROUP BY k HAVING count(*) > 1)),
    gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + {size - 1})) AS p FROM again),
    placed AS (SELECT r, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM texts),
    kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n FROM placed ANTI JOIN gone USING (r, p) GROUP BY r)
    SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(words, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (r)"""


def top_k(k: int, every: int) -> str:
    return f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= {k}"""


def fill_in_middle() -> str:
    h = [f"('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT" for i in range(4)]
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
    x AS (SELECT doc_id, t, length(t)::BIGINT AS n, {h[0]} % (length(t) + 1) AS a, {h[1]} % (length(t) + 1) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {h[2]} % 100 >= 90 THEN 'plain'
             WHEN {h[3]} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
    p AS (SELECT *, substr(t, 1, least(a, b)) AS pre, substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS mid,
        substr(t, greatest(a, b) + 1) AS suf FROM x)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN greatest(a, b) - least(a, b) END::BIGINT AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
           sha256(pre || mid || suf) AS restored_sha256 FROM p"""


def quoted(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def licences() -> str:
    """Every block against every template."""
    sets = license_scan.Templates(license_scan.TEMPLATES, license_scan.CONTAINED)
    templates = ", ".join(f"('{label}', {quoted(s)}, {len(s)}, {n})" for label, s, n in zip(sets.labels, sets.sets, sets.needs))
    phrases = ", ".join(f"({quoted(license_scan.plain_words(p))}, '{label}')" for p, label in license_scan.PHRASES.items())
    w = sets.stride
    return rf"""
    WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
    phrases(p, label) AS (VALUES {phrases}), templates(label, words, n, need) AS (VALUES {templates}),
    found AS (SELECT r, label, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1:i + len(p)] = p)) AS pos FROM texts, phrases),
    base AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM found GROUP BY r),
    blocks AS (SELECT r, list_distinct(ws[j * {w} + 1:j * {w} + {2 * w}]) AS b FROM (
        SELECT r, ws, unnest(range(greatest(ceil(len(ws) / {w}.0)::BIGINT - 1, 1))) AS j FROM texts)),
    met AS (SELECT r, label, len(list_intersect(words, b)) / n::DOUBLE AS contained FROM blocks, templates WHERE len(list_intersect(words, b)) >= need),
    own AS (SELECT r, list(DISTINCT label) AS labels, max(contained) AS best FROM met GROUP BY r)
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
           coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ','), '') AS labels,
           (CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END)::DOUBLE AS score
    FROM texts LEFT JOIN base USING (r) LEFT JOIN own USING (r)"""


def clusters(width: int, scale: int, k: int, rounds: int) -> str:
    """All rounds one after the other."""
    parts = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR)) - 1 AS c, e FROM v
        QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR)) <= {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, v.e, c{i}.c, c{i}.e AS centre, list_sum(list_transform(list_zip(v.e, c{i}.e),
            lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{i}
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c{i}.c) = 1)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.e, old.e) AS e FROM c{i} old LEFT JOIN (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS e FROM (
                SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{i}) GROUP BY c, i)
            GROUP BY c) m USING (c))""")
    return f"""WITH {', '.join(parts)}
    SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
           (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(centre, ',')) AS centroid_sha256 FROM a{rounds}"""


SQL: dict[str, str] = {
    "op1_rendezvous_shards": rendezvous(24),
    "op8_repeated_windows": repeated_windows(35),
    "op9_maxscore": top_k(20, 20),
    "op11_piece_table": fill_in_middle(),
    "op12_license_join": licences(),
    "op13_hadamard_centroids": clusters(64, 1024, 8, 10),
}
