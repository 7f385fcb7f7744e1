"""DuckDB SQL for the operators on conversations' structure and on shards."""

# CRC-32 of a text, byte by byte through a table of 256 remainders; ``tab`` has to be in scope.
CRC_TABLE = """tab AS (
        SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))
            ORDER BY n) AS t
        FROM range(256) r(n))"""


def crc32(text: str) -> str:
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    folded = f"list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, x: xor(c >> 8, t[1 + xor(c & 255, x)]))"
    return f"xor({folded}, 4294967295)"


def _way(edit: str, cost: str, after: str, line: str | None = None) -> str:
    """An edit put in front of what is cheapest after it."""
    lines = f"{after}.r" if line is None else f"list_prepend({line}, {after}.r)"
    return f"{{'c': {cost} + {after}.c, 'a': '{edit}' || {after}.a, 'r': {lines}}}"


_WORST = "{'c': 1000000000::BIGINT, 'a': '', 'r': []::VARCHAR[]}"
_LINE = "role || ':' || text"


def _row(state: int) -> str:
    """The cheapest way to treat a row from a state; of equally cheap ones the ASCII-least."""
    follower, role, initial = (2, "user", "u") if state != 2 else (3, "assistant", "a")
    ways = [_way("D", "2", f"g{state}")]
    keep = _way("K", "cut", f"g{follower}", _LINE)
    ways.append(f"CASE WHEN NOT gone AND initial = '{initial}' THEN {keep} ELSE {_WORST} END")
    if state == 0:
        ways.append(f"CASE WHEN NOT gone AND initial = 's' THEN {_way('K', 'cut', 'g1', _LINE)} ELSE {_WORST} END")
    again = _way("R", "1 + cut", f"g{follower}", f"'{role}:' || text")
    ways.append(f"CASE WHEN NOT gone THEN {again} ELSE {_WORST} END")
    return f"list_sort([{', '.join(ways)}])[1] AS h{state}"


def _inserted(state: int, after: str) -> str:
    role = "assistant" if state == 2 else "user"
    return f"list_sort([h{state}, {_way('I', '5', after, chr(39) + role + ':' + chr(39))}])[1]"


_END = (
    "{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]} AS g0, "
    "{'c': 10::BIGINT, 'a': 'II', 'r': ['user:', 'assistant:']} AS g1, "
    "{'c': 5::BIGINT, 'a': 'I', 'r': ['assistant:']} AS g2, "
    "{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]} AS g3"
)

REPAIR = rf"""
    WITH RECURSIVE {CRC_TABLE},
    src AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
        FROM conversations, tab),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS one FROM src)),
    placed AS (
        SELECT *,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(role, 1, 64), md5(role),
                substr(text, 1, 64), md5(text)) AS p,
            NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
            NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open,
            substr(role, 1, 1) AS initial
        FROM damaged),
    known AS (SELECT *, p > min(p) OVER (PARTITION BY conv_id, role, text) AS seen FROM placed),
    turns AS (
        SELECT *, blank OR seen AS gone, CASE WHEN open THEN 5 ELSE 0 END AS cut,
            lag(initial) OVER (PARTITION BY conv_id ORDER BY p) || initial NOT IN ('su', 'ua', 'au') AS illegal
        FROM known),
    dp AS (
        SELECT conv_id, count(*) + 1 AS p, {_END} FROM turns GROUP BY conv_id
        UNION ALL
        SELECT conv_id, p, {_inserted(0, 'g2')} AS g0, {_inserted(1, 'g2')} AS g1, g2, {_inserted(3, 'h2')} AS g3
        FROM (
            SELECT *, {_inserted(2, 'h3')} AS g2
            FROM (
                SELECT turns.conv_id, turns.p, {', '.join(_row(s) for s in range(4))}
                FROM dp JOIN turns ON turns.conv_id IS NOT DISTINCT FROM dp.conv_id AND turns.p = dp.p - 1))),
    figures AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE seen AND NOT blank) AS duplicate,
            count(*) FILTER (WHERE open AND NOT gone) AS truncated, count(*) FILTER (WHERE illegal) AS illegal
        FROM turns GROUP BY conv_id)
    SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
        coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, coalesce(g0.c, 0)::BIGINT AS cost, coalesce(g0.a, '') AS audit,
        sha256(coalesce(array_to_string(g0.r, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) ids
    LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM ids.conv_id
    LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM ids.conv_id AND dp.p = 1
"""

SHARDING = f"""
    WITH RECURSIVE {CRC_TABLE},
    rows AS (
        SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {crc32("coalesce(text, '')")} AS text_crc32
        FROM documents, tab),
    numbered AS (
        SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, size, text_crc32) - 1 AS number FROM rows),
    n AS (SELECT count(*) AS n FROM rows),
    sides AS (SELECT n, a, (n + a - 1) // a AS b FROM (
        SELECT n, (SELECT min(x) FROM range(1, n + 2) r(x) WHERE x * x >= n) AS a FROM n)),
    walk AS (
        SELECT number, 0 AS i, number // b AS x, number % b AS y, n, a, b FROM numbered, sides
        UNION ALL
        SELECT number, i + 1, y,
            (x + ('0x' || substr(md5('42:' || (i % 8) || ':' || y), 1, 15))::BIGINT) % CASE i % 2 WHEN 0 THEN a ELSE b END,
            n, a, b
        FROM walk WHERE i = 0 OR i % 8 <> 0 OR x * b + y >= n),
    placed AS (SELECT number, x * b + y AS place FROM walk WHERE i > 0 AND i % 8 = 0 AND x * b + y < n)
    SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (place % 8)::INTEGER AS shard,
        place // 8 AS slot, NULL::INTEGER AS grown_shard
    FROM numbered JOIN placed USING (number)
"""
