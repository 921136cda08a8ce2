"""DuckDB statements of the queries that SQL can express.

Tokenizers, trained models, splitters, packings and tree scoring are none; tests hold those queries
against brute force, round trips or held-out accuracy.
"""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_INTEGERS = "list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))"


def _words(text: str, pattern: str) -> str:
    return f"coalesce(regexp_extract_all({_LOWER.format(text)}, '{pattern}'), [])"


_BENCHMARK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ALPHABET = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"


def _base32(hex_: str) -> str:
    """Every five hexadecimal digits are four characters."""
    groups = [f"CAST('0x' || substr({hex_}, {5 * g + 1}, 5) AS BIGINT)" for g in range(8)]
    return " || ".join(
        f"substr({_ALPHABET}, CAST((({n}) >> {shift}) & 31 AS INTEGER) + 1, 1)" for n in groups for shift in (15, 10, 5, 0)
    )


SQL: dict[str, str] = {
    "op2_jaccard_join": rf"""
        WITH RECURSIVE texts AS (
            SELECT row_number() OVER () AS r, doc_id, {_words("text", r"[^\x20\x09-\x0D]+")} AS w FROM documents
        ), places AS (
            SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM texts WHERE len(w) > 0
        ), grams AS MATERIALIZED (
            SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g FROM places
        ), sizes AS (
            SELECT r, count(*) AS n FROM grams GROUP BY r
        ), links AS MATERIALIZED (
            SELECT a.r AS a, b.r AS b
            FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r
            JOIN sizes x ON x.r = a.r JOIN sizes y ON y.r = b.r
            GROUP BY a.r, b.r, x.n, y.n
            HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
        ), reached(r, m) AS (
            SELECT r, r FROM texts UNION SELECT reached.r, links.b FROM reached JOIN links ON reached.m = links.a
        )
        SELECT t.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
        FROM texts t JOIN reached ON reached.r = t.r JOIN texts o ON o.r = reached.m LEFT JOIN sizes s ON s.r = t.r
        GROUP BY t.r, t.doc_id
    """,
    "op3_decontamination": rf"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id, {_words("text", _BENCHMARK_WORD)} AS w FROM documents
        ), items AS (
            SELECT CAST(item_id AS VARCHAR) AS item, {_words("text", _BENCHMARK_WORD)} AS w
            FROM benchmark
        ), starts AS (
            SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS i
            FROM items WHERE len(w) > 0
        ), windows AS MATERIALIZED (
            SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM starts
        ), lengths AS (
            SELECT DISTINCT n FROM windows
        ), runs AS (
            SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, lengths WHERE len(w) >= n
        ), hits AS MATERIALIZED (
            SELECT r, item, runs.n, i
            FROM runs JOIN windows ON windows.n = runs.n AND windows.p = array_to_string(w[i:i + runs.n - 1], ' ')
        ), covered AS (
            SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r
        ), named AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM texts LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
    """,
    "op7_exact_topk": f"""
        WITH usable AS (
            SELECT row_number() OVER () AS turn, vec_id, {_INTEGERS} AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), pairs AS (
            SELECT q.turn, q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM usable q JOIN usable c ON q.turn <> c.turn AND len(q.v) = len(c.v)
            WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY turn ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op9_warc_records": f"""
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
        ), newest AS (
            SELECT payload, max(page_id) AS last FROM payloads GROUP BY payload
        )
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_base32("digest")} AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM last AND last IS NOT NULL THEN 'revisit' ELSE 'response' END
                   AS record_type,
               CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
        FROM payloads JOIN newest USING (payload)
    """,
    "op12_spelling_variants": rf"""
        WITH RECURSIVE bytes AS MATERIALIZED (
            SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                        ORDER BY i) AS crc
            FROM range(256) t(i)
        ), runs AS (
            SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
        ), counted AS (
            SELECT doc_id, run, count(*) AS n, concat(doc_id, ':', run) AS label FROM runs WHERE length(run) >= 6 GROUP BY ALL
        ), summed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                [4294967295] || list_transform(range(1, strlen(label) + 1),
                                               lambda i: CAST('0x' || substr(hex(encode(label)), 2 * i - 1, 2) AS BIGINT)),
                lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS h
            FROM counted, bytes
        ), words AS MATERIALIZED (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                   CAST(sum(n) AS BIGINT) AS n
            FROM summed GROUP BY 1 HAVING sum(n) >= 5 AND length(word) >= 6
        ), cuts AS MATERIALIZED (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), near AS MATERIALIZED (
            SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
            UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word
        ), best AS (
            SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other,
                   max(n) AS other_n
            FROM near GROUP BY word
        ), forms AS MATERIALIZED (
            SELECT w.word, CASE WHEN other_n >= 5 * w.n THEN other END AS form, w.n,
                   coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
            FROM words w LEFT JOIN best USING (word)
        ), paths AS (
            SELECT word, word AS root, form AS next FROM forms
            UNION ALL SELECT p.word, f.word, f.form FROM paths p JOIN forms f ON p.next = f.word
        )
        SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n FROM forms f JOIN paths p ON p.word = f.word AND p.next IS NULL
    """,
    "op13_hard_negatives": """
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS MATERIALIZED (
            SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label = o.label AS same, o.vec_id,
                   CAST(coalesce(list_sum(list_transform(list_zip(a.v, o.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
            FROM kept a JOIN kept o ON a.r <> o.r AND len(a.v) = len(o.v) WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT * FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.vec_id AS positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor, p.vec_id, p.score ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
               n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
         AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY rank <= 3
    """,
}
