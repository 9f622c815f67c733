"""DuckDB SQL with the same rows and column names as the queries."""

from __future__ import annotations

from corpusloom.llm import quality
from corpusloom.llm.secrets import RULES


def _secret_spans(rule, place: int) -> str:
    # RE2 has no lookbehind; the match starts at the first place of a run anyway.
    pattern = rule.pattern.removeprefix("(?<![0-9a-f])").replace("'", "''")
    return f"""
    SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, i,
           list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s,
           length(hits[i]) AS n
    FROM (SELECT doc_id, hits, gaps, vals, unnest(range(1, len(hits) + 1)) AS i
          FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS hits,
                       regexp_extract_all(t, '{pattern}', {rule.value}) AS vals,
                       string_split_regex(t, '{pattern}') AS gaps FROM d))
    WHERE length(vals[i]) >= {rule.least}"""


OP5 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_secret_spans(r, i) for i, r in enumerate(RULES))}),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
               count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               string_agg(concat_ws(':', kind, s::BIGINT, (s + n)::BIGINT), ',' ORDER BY s, place) AS spans
        FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
"""

OP8 = r"""
WITH ids AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
             FROM documents),
l AS (SELECT r, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM ids),
k AS (SELECT r, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, count(*) AS n_lines, count(common.key) AS n_dropped,
                coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (common.key IS NULL), '') AS kept_text
         FROM k LEFT JOIN common USING (key) GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM kept JOIN ids USING (r)
"""

# The digest in base32: 160 bits as 32 groups of five.
OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS hex FROM p),
bits AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
             right(bin(16 + instr('0123456789abcdef', hex[i]) - 1), 4)), '') AS b FROM d),
e AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i:
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * b[5*i+1]::INT + 8 * b[5*i+2]::INT
             + 4 * b[5*i+3]::INT + 2 * b[5*i+4]::INT + b[5*i+5]::INT]), '') AS payload_digest FROM bits),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS top FROM e)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM m
"""

OP4 = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT r, vec_id, list_transform(v, lambda x: floor(256 * x::DOUBLE)) AS v FROM e),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM w q JOIN w c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM t WHERE rank <= 5
"""


_VOTES = " || ".join(
    f"CASE WHEN ({r.when}) AND ({r.bad}) THEN 'b' WHEN ({r.when}) AND ({r.good}) THEN 'g' ELSE '-' END"
    for r in quality.RULES
)
_EACH = range(1, len(quality.RULES) + 1)
_PRIOR = quality.Prior()


def _chance(rates: str, vote: str, other: str) -> str:
    each = (f"CASE p.v[{j}] WHEN '{vote}' THEN {rates}[{j}] WHEN '{other}' THEN 1 - {rates}[{j}] ELSE 1 END" for j in _EACH)
    return "(1::DOUBLE * " + " * ".join(each) + ")"


_GOOD_SHARE = (
    f"(good * {_chance('on_good', 'g', 'b')}) / (good * {_chance('on_good', 'g', 'b')}"
    f" + (1 - good) * {_chance('on_bad', 'b', 'g')})"
)


def _inside(x: str) -> str:
    return f"least(greatest({x}, {quality.EDGE}::DOUBLE), 1 - {quality.EDGE}::DOUBLE)"


def _rate(j: int, believed: float, vote: str, mass: str) -> str:
    hit = f"list_sum(list_transform(w, lambda p: CASE WHEN p.v[{j}] = '{vote}' THEN {mass} ELSE 0::DOUBLE END))"
    voted = f"list_sum(list_transform(w, lambda p: CASE WHEN p.v[{j}] <> '-' THEN {mass} ELSE 0::DOUBLE END))"
    return _inside(f"({_PRIOR.weight * believed}::DOUBLE + {hit}) / ({_PRIOR.weight}::DOUBLE + {voted})")


def _listed(values) -> str:
    return f"[{', '.join(values)}]"


OP11 = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS MATERIALIZED (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[ 	-
]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ 	-
]')) AS ls FROM d),
windows AS (
  SELECT r, i, ws[i:i + 4] AS w FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM s WHERE len(ws) >= 5)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest(range(5)) AS k FROM twice) GROUP BY r),
f AS (
  SELECT s.r, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS n_letters,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_capitals,
    len(ls) AS n_word_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    len(list_filter(ls, lambda l: regexp_matches(l, '[.!?][ 	-
]*\z'))) AS n_ended_lines,
    len(list_distinct(ws)) AS n_distinct_words,
    len(list_filter(ws, lambda w: regexp_matches(w, '\p{{L}}'))) AS n_letter_words,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_echoes,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM s LEFT JOIN covered USING (r)),
voted AS MATERIALIZED (SELECT *, {_VOTES} AS votes FROM f),
counted AS (SELECT votes, count(*)::DOUBLE AS n FROM voted GROUP BY votes),
patterns AS MATERIALIZED (SELECT list({{'v': string_split(votes, ''), 'n': n}} ORDER BY votes) AS ps FROM counted),
em AS (
  SELECT 0 AS i, {_PRIOR.good}::DOUBLE AS good,
    {_listed([f"{_PRIOR.right_on_good}::DOUBLE"] * len(_EACH))} AS on_good,
    {_listed([f"{_PRIOR.right_on_bad}::DOUBLE"] * len(_EACH))} AS on_bad
  UNION ALL
  SELECT i + 1,
    {_inside(f"({_PRIOR.weight * _PRIOR.good}::DOUBLE + list_sum(list_transform(w, lambda p: p.g))) / ({_PRIOR.weight}::DOUBLE + list_sum(list_transform(w, lambda p: p.n)))")},
    {_listed(_rate(j, _PRIOR.right_on_good, 'g', 'p.g') for j in _EACH)},
    {_listed(_rate(j, _PRIOR.right_on_bad, 'b', '(p.n - p.g)') for j in _EACH)}
  FROM (SELECT i, list_transform(ps, lambda p: {{'v': p.v, 'n': p.n, 'g': p.n * ({_GOOD_SHARE})}}) AS w
        FROM em CROSS JOIN patterns WHERE i < {quality.ITERATIONS})),
fitted AS (SELECT * FROM em WHERE i = {quality.ITERATIONS}),
posterior AS (
  SELECT array_to_string(p.v, '') AS votes, {_GOOD_SHARE} AS quality
  FROM (SELECT unnest(ps) AS p, good, on_good, on_bad FROM patterns CROSS JOIN fitted))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND quality >= 0.5 AS kept,
       votes, round(quality, 4) AS quality
FROM voted JOIN posterior USING (votes)
"""


def _round(i: int) -> str:
    """Assignment to the centroids of round `i`."""
    return f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, c, list_sum(list_transform(list_zip(e.v, c{i}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM e CROSS JOIN c{i}) GROUP BY r)"""


def _move(i: int) -> str:
    """The centroids after round `i`: floored means, or where they were."""
    return f"""s{i} AS (
  SELECT c, j, sum(x) AS s, count(*) AS n FROM (
    SELECT a{i}.c, unnest(e.v) AS x, unnest(range(1, 65)) AS j FROM a{i} JOIN e USING (r)) GROUP BY c, j),
m{i} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))"""


OP13 = f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM e QUALIFY c < 40),
{", ".join(f"{_round(i)}, {_move(i)}" for i in range(5))}, {_round(5)}
SELECT vec_id, a5.c::INTEGER AS cluster, d AS distance,
       sum(d) OVER (PARTITION BY a5.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM a5 JOIN e USING (r) JOIN c5 ON c5.c = a5.c
"""


def _fill(state: int) -> tuple[str, int]:
    return ("assistant", 4) if state == 3 else ("user", 3)


def _taken(row: str, cost: str, letter: str, state: str, line: str = "") -> str:
    """The best way on from `state` after one more edit."""
    kept = f"[{line}] || {row}[{state}].o" if line else f"{row}[{state}].o"
    return f"{{'c': {row}[{state}].c + {cost}, 'a': '{letter}' || {row}[{state}].a, 'o': {kept}}}"


def _on_row(state: int) -> str:
    """Delete, keep or set the role of a row; states 1 to 4 are none, system, user, assistant."""
    legal = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}[state]
    role, to = _fill(state)
    choices = [f"[{_taken('f', '3', 'D', str(state))}]"]
    for initial, after in legal.items():
        keep = _taken("f", "worn", "K", str(after), "role || ':' || text")
        choices.append(f"CASE WHEN NOT gone AND role[1:1] = '{initial}' THEN [{keep}] ELSE [] END")
    rerole = _taken("f", "worn + 2", "R", str(to), f"'{role}:' || text")
    choices.append(f"CASE WHEN NOT gone THEN [{rerole}] ELSE [] END")
    return f"list_sort({' || '.join(choices)})[1]"


def _with_insert(state: int, row: str) -> str:
    role, to = _fill(state)
    line = f"'{role}:'"
    return f"list_sort([b[{state}], {_taken(row, '2', 'I', str(to), line)}])[1]"


# The bitwise form of the checksum: 3988292384 is its polynomial, reversed.
OP12 = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(
          string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
          lambda c: list_transform(range(8), lambda i: (ord(c)::BIGINT >> i) & 1))),
        lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END),
      4294967295::BIGINT) % 20 AS fate FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy FROM keyed WHERE fate <> 0),
placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS conv,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut FROM damaged),
rows AS MATERIALIZED (
  SELECT *, blank OR again AS gone, CASE WHEN cut THEN 1 ELSE 0 END AS worn,
    lag(role[1:1]) OVER (PARTITION BY conv ORDER BY i) || role[1:1] AS pair FROM placed),
facts AS (
  SELECT conv, any_value(conv_id) AS conv_id, count(*) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
    count(*) FILTER (NOT gone AND cut) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv),
steps AS (
  SELECT conv, n AS i, [
    {{'c': 0, 'a': '', 'o': []::VARCHAR[]}}, {{'c': 4, 'a': 'II', 'o': ['user:', 'assistant:']}},
    {{'c': 2, 'a': 'I', 'o': ['assistant:']}}, {{'c': 0, 'a': '', 'o': []::VARCHAR[]}}] AS f FROM facts
  UNION ALL
  SELECT conv, i - 1, [{_with_insert(1, 'w')}, {_with_insert(2, 'w')}, w[3], w[4]] FROM (
    SELECT conv, i, b, [b[1], b[2], {_with_insert(3, 'b')}, {_with_insert(4, 'b')}] AS w FROM (
      SELECT conv, steps.i, [{", ".join(map(_on_row, range(1, 5)))}] AS b FROM steps JOIN rows USING (conv, i)))),
best AS (SELECT conv, f[1] AS f FROM steps WHERE i = 0),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(f.c, 0)::BIGINT AS cost,
       coalesce(f.a, '') AS audit, sha256(coalesce(array_to_string(f.o, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN facts ON ids.conv_id IS NOT DISTINCT FROM facts.conv_id LEFT JOIN best USING (conv)
"""

LLM_ORACLE = {
    "op4_exact_topk": OP4,
    "op11_quality_rules": OP11,
    "op12_conversation_repair": OP12,
    "op13_centroid_clustering": OP13,
    "op5_secret_scan": OP5,
    "op7_warc": OP7,
    "op8_line_dedup": OP8,
}
