"""DuckDB SQL for the registered queries that SQL can express over whole tables."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op10_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
m AS (SELECT DISTINCT m FROM p),
t AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS k
      FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, m WHERE len(w) >= m)),
h AS (SELECT t.doc_id, t.i, t.m, p.item_id FROM t JOIN p ON t.m = p.m AND t.k = p.k),
hw AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS j FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS s
       FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hw.n, 0)::BIGINT AS n_hit, coalesce(hi.n, 0)::BIGINT AS n_items,
       coalesce(hi.s, sha256('')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)""",
}
SQL["op5_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
       lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.c) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY ALL"""
SQL["op4_embedding_neardup"] = r"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
g AS (SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0
      AND len(list_filter(x, lambda y: y <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.vec_id),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT r.vec_id, coalesce(max(n.n), 0)::BIGINT AS n_links, min(r.c) AS component_id, min(r.c) = r.vec_id AS kept
FROM r LEFT JOIN n ON n.a = r.vec_id GROUP BY r.vec_id"""
SQL["op11_chat_format"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(role) + length(text) + 20 + length(regexp_replace(role || text, '[^\\<]', '', 'g')) AS written FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(written)::BIGINT AS formatted_chars, 0::BIGINT AS n_attachments, sum(ceil(length(text) / 4))::BIGINT AS n_tokens
FROM e GROUP BY conv_id"""
_TERMS = _WORDS.replace("x60\\x7B", "x40\\x5B-\\x60\\x7B")
SQL["op12_ranked_search"] = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
v AS (SELECT doc_id, t, any_value(n) AS n, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d)
      WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
f AS (SELECT t, floor(1000 * ln((2 * s.n + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM v, s GROUP BY t, s.n),
i AS (SELECT doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * v.n * s.n) // s.l)) AS impact FROM v, s),
r AS (SELECT item_id, doc_id, sum(times * weight * impact)::BIGINT AS score FROM q JOIN f USING (t) JOIN i USING (t) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 20"""

# a state is (cost, edits, repaired text) or null; states: nothing yet, after the system turn, the user, the assistant
_BEST = "list_min(list_filter([{}], lambda c: c IS NOT NULL))"
_STEP = "CASE WHEN {x} IS NOT NULL AND {when} THEN {{'c': {x}.c + {cost}, 'e': {x}.e || '{edit}', 'o': {x}.o || {out}}} END"


def _offer(x: str, cost: str, edit: str, out: str, when: str = "true") -> str:
    return _STEP.format(x=x, cost=cost, edit=edit, out=out, when=when)


#: crc32 of an ASCII string: bytes from the left, eight shifts each
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda k: ascii(k)::BIGINT)), "
        "lambda x, y: list_reduce(list_prepend(xor(x, y), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
        "lambda p, q: xor(p >> 1, (p & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)")


def _repair() -> str:
    keep = lambda x, initial: _offer(x, "cut", "K", "line", f"ok AND initial = '{initial}'")
    turn = lambda x, role: _offer(x, "2 + cut", "R", f"chr(10) || '{role}:' || text", "ok")
    gone = lambda x: _offer(x, "3", "D", "''")
    best = {
        "z0": gone("z"),
        "s0": _BEST.format(", ".join([gone("s"), keep("z", "s")])),
        "u0": _BEST.format(", ".join([gone("u"), *(f(x, y) for x in "zsa" for f, y in ((keep, "u"), (turn, "user")))])),
        "a0": _BEST.format(", ".join([gone("a"), keep("u", "a"), turn("u", "assistant")])),
    }
    user = _BEST.format(", ".join(["u0", *(_offer(x, "2", "I", "chr(10) || 'user:'") for x in ("z0", "s0", "a0"))]))
    assistant = _BEST.format(", ".join(["a0", _offer("u1", "2", "I", "chr(10) || 'assistant:'")]))
    return rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      {_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS what FROM conversations),
x AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
      CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE what > 0),
y AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
      rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM x),
r AS (SELECT conv_id, turn, i, role, text, left(role, 1) AS initial, chr(10) || role || ':' || text AS line,
      CASE WHEN trimmed = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated'
      ELSE '' END AS fault FROM y),
t AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS ok, (fault = 'truncated')::INTEGER AS cut,
      left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || initial AS pair FROM r),
p AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'e': '', 'o': ''}} AS z, NULL::STRUCT(c INTEGER, e VARCHAR, o VARCHAR) AS s,
      {{'c': 2, 'e': 'I', 'o': chr(10) || 'user:'}} AS u,
      {{'c': 4, 'e': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS a FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, z0, s0, u1, {assistant} FROM (SELECT *, {user} AS u1 FROM (
    SELECT p.conv_id, t.i, {", ".join(f"{v} AS {n}" for n, v in best.items())}
    FROM p JOIN t ON p.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = p.i + 1))),
e AS (SELECT conv_id, list_min(list_filter([z, a], lambda c: c IS NOT NULL)) AS b
      FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
      count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM t GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, b.c::BIGINT AS cost, b.e AS audit,
       sha256(substr(b.o, 2)) AS repaired_sha256
FROM e LEFT JOIN g ON e.conv_id IS NOT DISTINCT FROM g.conv_id"""


SQL["op13_conversation_repair"] = _repair()
