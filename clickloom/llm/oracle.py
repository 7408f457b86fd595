"""DuckDB SQL for the queries that SQL can express.

The others are tested against brute-force versions: segmentation (op1), Jaccard
components (op2), XXH64 fingerprints (op4), positions of leftmost matches (op5),
and fitted models (op6, op8).
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLAIN = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

#: CRC-32 of a text's bytes, as a macro-like expression over the table of the ``crc`` recursion.
_CRC_TABLE = """crc(i, k, c) AS (
            SELECT i, 0, i FROM range(256) AS r(i)
            UNION ALL
            SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
        ),
        tab AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8)"""


def _crc(ascii_text: str) -> str:
    points = f"list_transform(string_split({ascii_text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {points}), {step}), 4294967295)"


def _after(edit: str, cost: str, line: str, then: str, allowed: str = "true") -> str:
    """A least repair (cost, audit, lines) that begins with ``edit`` and goes on as ``then``."""
    total = f"CASE WHEN {allowed} THEN {then}.c + {cost} ELSE 1000000000 END"
    return f"{{'c': {total}, 'a': '{edit}' || {then}.a, 'x': {line} || {then}.x}}"


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _row_options(state: int) -> str:
    """Least repairs from a row on, before insertions: delete, keep or rename."""
    to, role = (3, "assistant") if state == 2 else (2, "user")
    stays, extra = "fault NOT IN (1, 2)", "CASE WHEN fault = 3 THEN 1 ELSE 0 END"
    line = "role || ':' || text || chr(10)"
    options = [_after("D", "3", "''", f"b{state}")]
    options.append(_after("R", f"2 + {extra}", f"'{role}:' || text || chr(10)", f"b{to}", stays))
    for initial, target in {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[state]:
        options.append(_after("K", extra, line, f"b{target}", f"{stays} AND left(role, 1) = '{initial}'"))
    return _least(*options)


_USER, _ASSISTANT = "'user:' || chr(10)", "'assistant:' || chr(10)"

ORACLE: dict[str, str] = {
    "op3_decontamination": f"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
        items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
        item_windows AS (
            SELECT DISTINCT item, least(len(ws), 10) AS size, array_to_string(ws[k:k + 9], ' ') AS win
            FROM (SELECT item, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS k FROM items WHERE len(ws) > 0)
        ),
        doc_windows AS (
            SELECT rid, k, size, array_to_string(ws[k:k + size - 1], ' ') AS win
            FROM (SELECT rid, ws, size, unnest(generate_series(1, len(ws) - size + 1)) AS k
                  FROM docs, (SELECT DISTINCT size FROM item_windows) WHERE len(ws) >= size)
        ),
        hits AS (SELECT rid, k, d.size AS size, item FROM doc_windows d JOIN item_windows USING (size, win)),
        hit_words AS (
            SELECT rid, count(DISTINCT place) AS n_hit
            FROM (SELECT rid, unnest(generate_series(k, k + size - 1)) AS place FROM hits) GROUP BY rid
        ),
        hit_items AS (
            SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
    """,
    "op7_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ),
        f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM f
    """,
    # on the supplied pages the main text is what the article element holds
    "op9_html_text": r"""
        WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages),
        t AS (
            SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS body FROM a
        ),
        u AS (
            SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(
                body, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM t
        )
        SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM u
    """,
    "op10_quality_rules": rf"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT rid, doc_id, text, {_PLAIN} AS ws FROM d),
        tri AS (
            SELECT rid, k, array_to_string(ws[k:k + 2], ' ') AS win
            FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 2)) AS k FROM w WHERE len(ws) >= 3)
        ),
        again AS (SELECT rid, k FROM (SELECT rid, k, count(*) OVER (PARTITION BY rid, win) AS n FROM tri) WHERE n > 1),
        rep AS (
            SELECT rid, count(DISTINCT place) AS n_repeat_words
            FROM (SELECT rid, unnest(generate_series(k, k + 2)) AS place FROM again) GROUP BY rid
        ),
        lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
        full_lines AS (SELECT rid, line FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        dup AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY rid),
        m AS (
            SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(n_lines, 0) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
                   length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
            FROM w LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid)
        ),
        r AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                   CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                   + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
                   + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
                   + CASE WHEN 10 * n_upper > 3 * n_letters THEN 16 ELSE 0 END
                   + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
                   + CASE WHEN word_chars > 15 * n_words THEN 64 ELSE 0 END
                   + CASE WHEN n_words > 1000000 THEN 128 ELSE 0 END AS BIGINT) AS failed_bits
            FROM m
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               (failed_bits & 119) = 0 AS kept, failed_bits
        FROM r
    """,
    "op12_conversation_repair": f"""
        WITH RECURSIVE {_CRC_TABLE},
        source AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS m
            FROM conversations, tab
        ),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
                   CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN m = 3 THEN 2 ELSE 1 END)) AS copy
            FROM source WHERE m <> 0
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i,
                   regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
            FROM damaged
        ),
        counted AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
        judged AS (
            SELECT *, CASE WHEN last = '' THEN 1 WHEN nth > 1 THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                   left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
            FROM counted
        ),
        faults AS (
            SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        ),
        ends AS (
            SELECT {{'c': 0, 'a': '', 'x': ''}} AS b0, {{'c': 4, 'a': 'II', 'x': {_USER} || {_ASSISTANT}}} AS b1,
                   {{'c': 2, 'a': 'I', 'x': {_ASSISTANT}}} AS b2, {{'c': 0, 'a': '', 'x': ''}} AS b3
        ),
        repairs AS (
            SELECT conv_id, n AS i, b0, b1, b2, b3 FROM faults, ends
            UNION ALL
            SELECT conv_id, i, {_least("o0", _after("I", "2", _USER, "u"))}, {_least("o1", _after("I", "2", _USER, "u"))}, u,
                   {_least("o3", _after("I", "2", _USER, "u"))}
            FROM (
                SELECT *, {_least("o2", _after("I", "2", _ASSISTANT, "o3"))} AS u
                FROM (
                    SELECT r.conv_id, r.i - 1 AS i, {_row_options(0)} AS o0, {_row_options(1)} AS o1, {_row_options(2)} AS o2, {_row_options(3)} AS o3
                    FROM repairs r JOIN judged j ON r.conv_id IS NOT DISTINCT FROM j.conv_id AND r.i = j.i
                )
            )
        ),
        results AS (
            SELECT f.*, b0.c AS cost, b0.a AS audit, sha256(left(b0.x, greatest(0, length(b0.x) - 1))) AS repaired_sha256
            FROM faults f JOIN repairs r ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = 0
        )
        SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
               coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN results r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
    """,
    "op13_periodic_runs": f"""
        WITH RECURSIVE {_CRC_TABLE},
        d AS (
            SELECT row_number() OVER () AS rid, doc_id, {_PLAIN.replace("(text,", "(coalesce(text, ''),")} AS w,
                   {_crc("CAST(doc_id AS VARCHAR)")} AS h
            FROM documents, tab
        ),
        e AS (SELECT rid, doc_id, w, h, len(w) AS n, h // 10 AS g FROM d),
        f AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM e WHERE h % 10 = 0 AND n > 0),
        texts AS (
            SELECT rid, doc_id, list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) AS w FROM f
            UNION ALL SELECT rid, doc_id, w FROM e WHERE h IS NULL OR h % 10 <> 0 OR n = 0
        ),
        words AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM texts),
        pairs AS (
            SELECT x.rid, x.i, y.i - x.i AS q FROM words x JOIN words y
            ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
        ),
        stretches AS (
            SELECT rid, q, min(i) AS start, count(*) + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pairs)
            GROUP BY rid, q, island HAVING count(*) + q >= greatest(6, 4 * q)
        ),
        runs AS (SELECT rid, start, length, min(q) AS period FROM stretches GROUP BY rid, start, length),
        per_doc AS (
            SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
                   min({{'l': -length, 's': start, 'p': period}}) AS best
            FROM runs GROUP BY rid
        ),
        dropped AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
        kept AS (
            SELECT rid, string_agg(word, ' ' ORDER BY i) AS collapsed
            FROM words ANTI JOIN dropped USING (rid, i) GROUP BY rid
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length, best.p AS period,
               1000 * -best.l // best.p AS exponent_milli,
               sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM texts LEFT JOIN per_doc USING (rid) LEFT JOIN kept USING (rid)
    """,
}
