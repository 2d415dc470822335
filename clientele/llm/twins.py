"""SQL twins of the text queries that SQL can express, for DuckDB."""

from __future__ import annotations

#: crc(s, hx, pos, c): the unsigned crc32 of each s of ``hashed(s)`` is c xor 4294967295 where pos = length(hx).
_CRC = """
crc_bits(b, k, c) AS (
    SELECT b, 0, b FROM range(256) AS every_byte(b)
    UNION ALL
    SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc_bits WHERE k < 8
), crc_table AS (
    SELECT b, c FROM crc_bits WHERE k = 8
), crc(s, hx, pos, c) AS (
    SELECT s, hex(encode(s)), 0, 4294967295 FROM hashed
    UNION ALL
    SELECT s, hx, pos + 2, xor(crc.c // 256, crc_table.c)
    FROM crc JOIN crc_table ON crc_table.b = xor(crc.c % 256, CAST('0x' || substr(hx, pos + 1, 2) AS BIGINT))
    WHERE pos < length(hx)
), checksums AS (
    SELECT s, xor(c, 4294967295) AS h FROM crc WHERE pos = length(hx)
)"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = rf"unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"

OP12 = f"""
WITH RECURSIVE corpus AS (
    SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents
), target AS (
    SELECT {_PLAIN_WORDS} AS w FROM benchmark
), hashed AS (
    SELECT w AS s FROM corpus UNION SELECT w FROM target
), {_CRC}, buckets AS (
    SELECT s AS w, h % 10000 AS bucket FROM checksums
), in_corpus AS (
    SELECT bucket, count(*) AS n FROM corpus JOIN buckets USING (w) GROUP BY bucket
), in_target AS (
    SELECT bucket, count(*) AS n FROM target JOIN buckets USING (w) GROUP BY bucket
), sums AS (
    SELECT (SELECT count(*) FROM corpus) + 10000 AS all_corpus, (SELECT count(*) FROM target) + 10000 AS all_target
), gains AS (
    SELECT c.bucket, CAST(floor(1000 * ln(
        (CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * CAST(all_corpus AS DOUBLE)
        / ((CAST(c.n AS DOUBLE) + 1) * CAST(all_target AS DOUBLE)))) AS BIGINT) AS gain
    FROM in_corpus c LEFT JOIN in_target t ON t.bucket = c.bucket CROSS JOIN sums
), weights AS (
    SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
    FROM corpus JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
            (CAST(CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE))
            / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
    FROM documents d LEFT JOIN weights USING (doc_id)
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

OP13 = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, {_LOWER.format("run")} AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
    SELECT DISTINCT doc_id || ':' || run AS s FROM runs
), {_CRC}, words AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
        sum(n) AS n
    FROM runs JOIN checksums ON s = doc_id || ':' || run GROUP BY 1
), vocabulary AS (
    SELECT word, CAST(n AS BIGINT) AS n FROM words WHERE length(word) >= 5 AND n >= 3
), gaps AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), pairs AS (
    SELECT a.word, b.word AS near FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT g.word, v.word FROM gaps g JOIN vocabulary v ON v.word = g.rest
    UNION
    SELECT v.word, g.word FROM gaps g JOIN vocabulary v ON v.word = g.rest
), ordered AS (
    SELECT p.word, near, b.n AS near_n, a.n AS own,
        count(*) OVER (PARTITION BY p.word) AS n_near,
        row_number() OVER (PARTITION BY p.word ORDER BY b.n DESC, encode(near)) AS place
    FROM pairs p JOIN vocabulary a ON a.word = p.word JOIN vocabulary b ON b.word = near
), forms AS (
    SELECT word, n_near, CASE WHEN near_n >= 2 * own THEN near END AS form, CASE WHEN near_n >= 2 * own THEN near_n END AS form_n
    FROM ordered WHERE place = 1
), steps(word, at_word) AS (
    SELECT word, form FROM forms WHERE form IS NOT NULL
    UNION ALL
    SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.at_word WHERE f.form IS NOT NULL
), ends AS (
    SELECT s.word, s.at_word AS root FROM steps s LEFT JOIN forms f ON f.word = s.at_word WHERE f.form IS NULL
)
SELECT v.word, form, coalesce(root, v.word) AS root, v.n, coalesce(n_near, 0) AS n_near, form_n
FROM vocabulary v LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)
"""


def sql_twins() -> dict[str, str]:
    return {"op12_importance_resampling": OP12, "op13_spelling_variants": OP13}
