"""The queries of this folder that SQL can express, as DuckDB statements over the same tables."""

from __future__ import annotations

from boardlens.llm.chat import DEFAULT

WORDS = r"len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def crc32(text: str) -> str:
    """CRC-32 of a string of ASCII characters, bit by bit."""
    one = "list_reduce(range(8), lambda c, k: xor(c // 2, CASE WHEN c % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END), xor(a, b))"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda a, b: {one}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _chat() -> str:
    def escaped(column: str) -> str:
        for plain, code in DEFAULT.codes():
            column = f"replace({column}, {_quoted(plain)}, {_quoted(code)})"
        return column

    marks = len(DEFAULT.begin) + len(DEFAULT.middle) + len(DEFAULT.end)
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
    coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '') AS learnt,
    CAST(sum({marks} + length({escaped("role")}) + length({escaped("text")})) AS BIGINT) AS formatted_chars FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars FROM c"""


_MIX = f"""
WITH d AS (SELECT doc_id, source, CAST({WORDS.format("coalesce(text, '')")} AS BIGINT) AS size,
    CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 15) AS BIGINT) AS key FROM documents),
s AS (SELECT source, n, 2 * CAST(n AS DOUBLE) AS cap, ([3, 1, 2])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source)),
r AS (SELECT *, row_number() OVER o AS k, (1.5::DOUBLE * (SELECT sum(n) FROM s) - (sum(cap) OVER o - cap)) / ((SELECT sum(w) FROM s) - (sum(w) OVER o - w)) AS level
  FROM s WINDOW o AS (ORDER BY cap / w, source ROWS UNBOUNDED PRECEDING)),
g AS (SELECT source, n, least(cap, (SELECT min_by(level, k) FROM r WHERE cap >= level * w) * w) AS target FROM s),
p AS (SELECT *, CASE WHEN n > 0 THEN CAST(floor(target / n) AS BIGINT) ELSE 0 END AS whole FROM g),
c AS (SELECT source, key, m, sum(m) OVER (PARTITION BY source ORDER BY key) AS upto
  FROM (SELECT source, key, sum(size) AS m FROM d GROUP BY source, key HAVING sum(size) > 0)),
e AS (SELECT c.source, c.key, upto <= target - whole * n OR upto - m <= target - whole * n AND 2 * (target - whole * n - (upto - m)) >= m AS more
  FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source)
SELECT d.doc_id, d.size, p.n AS source_size, p.target, d.size * (p.whole + CASE WHEN e.more THEN 1 ELSE 0 END) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source AND d.key = e.key"""

_TRIE = f"""
WITH own AS (SELECT conv_id, list({{'id': md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')),
      'words': {WORDS.format("coalesce(text, '')")}}} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
built AS (SELECT o.conv_id, list_concat(coalesce(f.turns, [])[:o.h], o.turns[o.h + 1:]) AS turns
  FROM (SELECT *, CAST({crc32("CAST(conv_id AS VARCHAR)")} % 4 AS BIGINT) AS h FROM own) o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 20),
steps AS (SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM built),
paths AS (SELECT conv_id, n, depth, list_reduce(list_transform(turns[:depth], lambda t: t.id), lambda a, b: a || b, '') AS path,
    CASE WHEN depth > 0 THEN turns[depth].words ELSE 0 END AS words,
    CASE WHEN depth > 0 THEN list_reduce(list_transform(turns[:depth - 1], lambda t: t.id), lambda a, b: a || b, '') END AS above FROM steps),
nodes AS (SELECT path, any_value(above) AS above, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM paths GROUP BY path, depth),
kids AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
below AS (SELECT left(x.path, CAST(32 * d.depth AS BIGINT)) AS path, CAST(sum(x.saved) AS BIGINT) AS saved_tokens, count(*) FILTER (k.path IS NULL) AS n_leaves
  FROM nodes x LEFT JOIN kids k ON k.path = x.path, LATERAL (SELECT unnest(range(x.depth + 1)) AS depth) d GROUP BY 1)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens, x.ends_sha256
FROM nodes x JOIN below b ON b.path = x.path LEFT JOIN kids k ON k.path = x.path LEFT JOIN nodes p ON p.path = x.above"""


def _repair() -> str:
    fate = crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')") + " % 20"
    least = lambda *cells: f"list_sort([{', '.join(cells)}])[1]"
    cell = lambda cost, audit: f"{{'c': CAST({cost} AS BIGINT), 'a': {audit}}}"
    put = lambda k: cell(f"x[{k}].c + 5", f"x[{k}].a || 'I'")
    drop = lambda k: cell(f"x[{k}].c + 2", f"x[{k}].a || 'D'")
    stays = "CASE WHEN e.f = 1 THEN 1000000 WHEN e.f = 3 THEN 5 ELSE 0 END"

    def turned(k: int, role: str) -> str:
        return cell(f"x[{k}].c + {stays} + CASE WHEN e.i = '{role}' THEN 0 ELSE 1 END", f"x[{k}].a || CASE WHEN e.i = '{role}' THEN 'K' ELSE 'R' END")

    def closed(cells: str) -> str:  # cells: cheapest edits so far that end with nothing, s, u, a
        for _ in range(2):
            cells = f"list_transform([{cells}], lambda x: [x[1], x[2], {least('x[3]', put(1), put(2), put(4))}, {least('x[4]', put(3))}])[1]"
        return cells

    system = cell(f"x[1].c + {stays} + CASE WHEN e.i = 's' THEN 0 ELSE 1000000 END", "x[1].a || 'K'")
    after = f"[{drop(1)}, {least(drop(2), system)}, {least(drop(3), turned(1, 'u'), turned(2, 'u'), turned(4, 'u'))}, {least(drop(4), turned(3, 'a'))}]"
    step = f"{{'i': '', 'f': 0, 's': list_transform([{closed('b.s')}], lambda x: {after})[1]}}"
    step = f"list_transform([e0], lambda e: {step})[1]".replace("[e0]", "[e]")
    begin = f"{{'i': '', 'f': 0, 's': [{cell(0, repr(''))}, {', '.join([cell(1000000, repr(''))] * 3)}]}}"
    return f"""
WITH hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {fate} AS fate FROM conversations),
kept AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k FROM kept),
q AS (SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS f, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM r),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate,
    count(*) FILTER (f = 3) AS truncated, count(*) FILTER (k > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'i': i, 'f': CASE f WHEN 2 THEN 1 ELSE f END, 's': CAST([] AS STRUCT(c BIGINT, a VARCHAR)[])}} ORDER BY k) AS turns FROM q GROUP BY conv_id),
w AS (SELECT *, list_reduce(turns, lambda b, e: {step}, {begin}).s AS s FROM c),
z AS (SELECT *, list_transform([{closed("s")}], lambda x: {least("x[1]", "x[4]")})[1] AS best FROM w),
l AS (SELECT conv_id, audit, p, substr(audit, p, 1) AS letter, length(translate(left(audit, p), 'I', '')) AS k,
    length(translate(left(audit, p), 'D', '')) AS j, length(translate(audit, 'D', '')) % 2 AS odd
  FROM (SELECT conv_id, best.a AS audit, CAST(unnest(range(1, length(best.a) + 1)) AS BIGINT) AS p FROM z)),
t AS (SELECT l.conv_id, string_agg(CASE WHEN letter = 'K' THEN q.role WHEN (j - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN letter = 'I' THEN '' ELSE q.text END, chr(10) ORDER BY p) AS said
  FROM l LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM l.conv_id AND q.k = l.k WHERE letter <> 'D' GROUP BY l.conv_id)
SELECT o.conv_id, coalesce(z.gaps, 0) AS gaps, coalesce(z.blank, 0) AS blank, coalesce(z.duplicate, 0) AS duplicate, coalesce(z.truncated, 0) AS truncated,
  coalesce(z.illegal, 0) AS illegal, coalesce(z.best.c, 0) AS cost, coalesce(z.best.a, '') AS audit, sha256(coalesce(t.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM o.conv_id"""


def statements() -> dict[str, str]:
    return {"op7_chat_formatting": _chat(), "op11_conversation_trie": _TRIE, "op12_source_mixing": _MIX, "op13_conversation_repair": _repair()}
