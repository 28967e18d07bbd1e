"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

# SHA-1 in base 32: eight times five hexadecimal digits give four characters each.
WARC = """
WITH digested AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex
    FROM pages
), named AS (
    SELECT page_id, payload_bytes,
        array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(hex, 1 + 5 * (k // 4)::INT, 5))::INT >> (15 - 5 * (k % 4))::INT) & 31), 1)),
            '') AS payload_digest
    FROM digested
), best AS (
    SELECT payload_digest, payload_bytes, max(page_id) AS page_id FROM named GROUP BY ALL
)
SELECT n.page_id, n.payload_bytes, n.payload_digest,
    CASE WHEN n.page_id = b.page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN n.page_id <> b.page_id THEN b.page_id END AS refers_to
FROM named n JOIN best b USING (payload_digest, payload_bytes)
"""

DECONTAMINATION = r"""
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents
), i AS (
    SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark
), item_starts AS (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k
    FROM i WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS passage FROM item_starts
), doc_starts AS (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
    FROM d CROSS JOIN (SELECT DISTINCT n FROM windows)
), found AS (
    SELECT doc_id, k, s.n, passage
    FROM (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS passage FROM doc_starts) s
    JOIN (SELECT DISTINCT passage FROM windows) USING (passage)
), hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found JOIN windows USING (passage))
    GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

JACCARD = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * c >= 75 * (x.n + y.n - c)
), twoway AS (
    SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, b.b FROM reach r JOIN twoway b ON b.a = r.y
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach r ON r.x = d.doc_id
GROUP BY ALL
"""

SUBSTRINGS = r"""
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), s AS (
    SELECT doc_id, k, md5_number(array_to_string(w[k:k + 34], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM d WHERE len(w) >= 35)
), repeated AS (
    SELECT h FROM s GROUP BY h HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS p FROM s JOIN repeated USING (h)
), listed AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
    FROM listed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

def _crc_step(code: int) -> int:
    for _ in range(8):
        code = code >> 1 ^ (0xEDB88320 if code & 1 else 0)
    return code


# CRC-32 of a column of hexadecimal digits, byte by byte with the table of all bytes.
_CRC_TABLE = str([_crc_step(byte) for byte in range(256)])


def _crc32(hexadecimal: str) -> str:
    step = f"xor(c >> 8, {_CRC_TABLE}[1 + (xor(c, b) & 255)])"
    pairs = f"list_transform(regexp_extract_all({hexadecimal}, '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({pairs}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


# The walk is a recursion: numbers that a pass carries beyond the rows are passed on again.
def _one_pass(number: str, rounds: int = 6) -> str:
    """Columns ``lo`` and ``hi`` after every round, as nested selects over ``number``."""
    digest = "(('0x' || substr(sha256('2024:{k}:' || {digit}), 1, 15))::BIGINT)"
    select = f"SELECT *, {number} % w AS lo, {number} // w AS hi FROM {{source}}"
    for k in range(rounds):
        if k % 2 == 0:
            moved = f"(lo + {digest.format(k=k, digit='hi')}) % w AS lo, hi"
        else:
            moved = f"lo, (hi + {digest.format(k=k, digit='lo')}) % h AS hi"
        select = f"SELECT * EXCLUDE (lo, hi), {moved} FROM ({select})"
    return select


SHARDING = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, coalesce(text, '') AS text FROM documents
), crc AS (
    SELECT *, {_crc32('hex(text)')} AS text_crc32 FROM d
), ranked AS (
    SELECT doc_id, size, text_crc32, count(*) OVER () AS n,
        row_number() OVER (ORDER BY doc_id NULLS LAST, text_crc32, size) - 1 AS number
    FROM crc
), sides AS (
    SELECT *, ceil(sqrt(n))::BIGINT AS w, ceil(n / ceil(sqrt(n)))::BIGINT AS h FROM ranked
), walk AS (
    SELECT * EXCLUDE (lo, hi), hi * w + lo AS place FROM ({_one_pass('number').format(source='sides')})
    UNION ALL
    SELECT * EXCLUDE (lo, hi, place), hi * w + lo AS place
    FROM ({_one_pass('place').format(source='(SELECT * FROM walk WHERE place >= n)')})
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law,
    (place % 8)::INT AS shard, (place // 8)::BIGINT AS slot, NULL::INT AS grown_shard
FROM walk WHERE place < n
"""

RESAMPLING = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), dw AS (
    SELECT doc_id, unnest(w) AS word FROM d
), bw AS (
    SELECT unnest(w) AS word FROM b
), hashed AS (
    SELECT word, {_crc32('hex(word)')} % 10000 AS bucket
    FROM (SELECT word FROM dw UNION SELECT word FROM bw)
), s AS (
    SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (word) GROUP BY bucket
), t AS (
    SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (word) GROUP BY bucket
), gain AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000))))::BIGINT AS gain
    FROM s FULL JOIN t USING (bucket)
), summed AS (
    SELECT doc_id, sum(gain)::BIGINT AS total
    FROM dw JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT doc_id, len(w)::BIGINT AS n_features,
        coalesce(floor(total::DOUBLE / nullif(len(w), 0)), 0)::BIGINT AS weight,
        (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE AS h
    FROM d LEFT JOIN summed USING (doc_id)
), ranked AS (
    SELECT *, weight + floor(-1000 * ln(-ln(h / 4294967296)))::BIGINT AS score FROM scored
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
        count(*) OVER (PARTITION BY n_features >= 20) AS n
    FROM ranked
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank
FROM placed
"""

ORACLES: dict[str, str] = {
    "op12_sharding": SHARDING,
    "op13_resampling": RESAMPLING,
    "op8_substring_dedup": SUBSTRINGS,
    "op1_ngram_jaccard": JACCARD,
    "op3_decontamination": DECONTAMINATION,
    "op2_warc": WARC,
}
