"""DuckDB SQL twins of the queries that SQL can express, over the same tables.

They compute the results from their definitions, not by the operators' methods: no fingerprints,
bands, seeds or trees.
"""

from __future__ import annotations

import math

from . import decontaminate, licenses, quality_rules, secrets


def _words(text: str = "coalesce(text, '')") -> str:
    return rf"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _normal(text: str = "coalesce(text, '')") -> str:
    return rf"list_filter(string_split_regex(lower({text}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP1 = f"""
WITH d AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT hex, max(page_id) AS best FROM d GROUP BY hex)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(list_transform(range(8), lambda g: CAST('0x' || substr(d.hex, CAST(5 * g + 1 AS INT), 5) AS BIGINT)),
         lambda v: substr('{_B32}', CAST((v >> 15) & 31 AS INT) + 1, 1) || substr('{_B32}', CAST((v >> 10) & 31 AS INT) + 1, 1)
                || substr('{_B32}', CAST((v >> 5) & 31 AS INT) + 1, 1) || substr('{_B32}', CAST(v & 31 AS INT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM best THEN NULL ELSE best END AS refers_to
FROM d JOIN b ON d.hex = b.hex
"""


def _spans(kind: int, rx: str, keep: str = "true") -> str:
    """Rows (doc_id, kind, start, stop) of the matches of a pattern; m is the match, v its value (group 2 of ASSIGN)."""
    group = 2 if kind == 0 else 0
    q = _quote(rx)
    return f"""
SELECT doc_id, {kind} AS kind, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start,
       CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS BIGINT) AS stop,
       m[i] AS token
FROM (SELECT doc_id, m, v, string_split_regex(text, {q}) AS g, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT doc_id, text, regexp_extract_all(text, {q}) AS m, regexp_extract_all(text, {q}, {group}) AS v FROM t) WHERE len(m) > 0)
WHERE {keep}"""


def _tail(z: str) -> str:
    x = f"least(greatest(abs({z}), 1e-6), 37.0)"
    q = f"((1 - exp(-1.4 * {x})) * exp(-{x} * {x} / 2) / ({1.135 * math.sqrt(2 * math.pi)!r} * {x}))"
    return f"(CASE WHEN {z} >= 0 THEN {q} ELSE 1 - {q} END)"


def _charset(alphabet: str, need: tuple[str, ...]) -> str:
    return " AND ".join([f"regexp_matches(token, '^[{alphabet}]+$')"] + [f"regexp_matches(token, '[{n}]')" for n in need])


_RULES = (_charset("0-9a-f", ("0-9", "a-f")), _charset("0-9A-F", ("0-9", "A-F")), _charset("A-Z2-7", ("2-7", "A-Z")),
          _charset("a-z0-9", ("0-9", "a-z")), _charset("A-Za-z0-9+/_-", ("0-9", "a-z", "A-Z")))
_ENC = "CASE " + " ".join(f"WHEN {rule} THEN {i}" for i, rule in enumerate(_RULES)) + " END"
_ABC = "[" + ", ".join(f"'{e[2]}'" for e in secrets.ENCODINGS) + "]"
_LIKE = "[" + ", ".join(f"{e[3]}" for e in secrets.ENCODINGS) + "]"
OP2 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS ({_spans(0, secrets.ASSIGN, "length(v[i]) >= 12")} UNION ALL {_spans(1, secrets.ACCESS)} UNION ALL {_spans(2, secrets.HEX)}),
tok AS (SELECT * FROM ({_spans(3, secrets.TOKEN)}) k WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.doc_id = k.doc_id AND b.start <= k.start AND b.stop >= k.stop)),
e AS (SELECT *, {_ENC} AS enc FROM tok),
c AS (SELECT doc_id, start, stop, CAST(length(({_ABC})[enc + 1]) AS DOUBLE) AS k, ({_LIKE})[enc + 1] AS likeness,
      list_transform(string_split(translate(token, '_-', '/+'), ''), lambda x: CAST(instr(({_ABC})[enc + 1], x) - 1 AS DOUBLE)) AS codes
      FROM e WHERE enc IS NOT NULL),
s AS (SELECT *, CAST(len(codes) AS DOUBLE) AS n, list_sum(codes) / len(codes) AS mean,
      list_transform(codes, lambda x: CASE WHEN x >= k / 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS high,
      list_transform(list_distinct(codes), lambda x: CAST(len(list_filter(codes, lambda y: y = x)) AS DOUBLE)) AS counts FROM c),
r AS (SELECT *, k / n * list_sum(list_transform(counts, lambda x: x * x)) - n AS chi, list_sum(high) AS n1,
      1.0 + list_sum(list_transform(range(2, len(high) + 1), lambda i: abs(high[i] - high[i - 1]))) AS runs,
      list_sum(list_transform(range(2, len(codes) + 1), lambda i: (codes[i] - mean) * (codes[i - 1] - mean))) AS lag,
      list_sum(list_transform(codes, lambda x: (x - mean) * (x - mean))) AS spread FROM s),
z AS (SELECT *, (pow(chi / (k - 1), 1.0 / 3) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1))) AS z_chi,
      2 * n1 * (n - n1) / n + 1 AS run_mean, CASE WHEN spread > 0 THEN lag / spread ELSE 1.0 END * sqrt(n) AS z_serial,
      ((k - 1) + n * (likeness - 1) - chi) / sqrt(2 * (k - 1) + 4 * n * (likeness - 1)) AS z_text FROM r),
y AS (SELECT *, CASE WHEN (run_mean - 1) * (run_mean - 2) / (n - 1) > 0
      THEN (runs - run_mean) / sqrt((run_mean - 1) * (run_mean - 2) / (n - 1)) ELSE 9.0 END AS z_runs FROM z),
p AS (SELECT doc_id, start, stop, n, greatest({_tail("z_text")}, 1e-300) AS p_text,
      greatest(-(ln(greatest({_tail("z_chi")}, 1e-300)) + ln(greatest(2 * {_tail("abs(z_runs)")}, 1e-300))
        + ln(greatest(2 * {_tail("abs(z_serial)")}, 1e-300))), 0.0) AS x FROM y),
bins AS (SELECT *, CAST(least(greatest(floor(-4 * log10(CASE WHEN exp(-x) * (1 + x + x * x / 2) < {secrets.ALPHA} THEN 1.0
         ELSE p_text * (avg(n) OVER ()) / n END)), 0), {secrets.BINS}) AS INT) AS bin FROM p),
lev AS (SELECT bin FROM (SELECT bin, sum(count(*)) OVER (ORDER BY bin DESC) AS r, sum(count(*)) OVER () AS m FROM bins GROUP BY bin)
        WHERE m * pow(10.0, -bin / 4.0) <= {secrets.FDR} * r),
found AS (SELECT doc_id, kind, start, stop FROM base UNION ALL
          SELECT doc_id, 3, start, stop FROM bins WHERE bin >= (SELECT min(bin) FROM lev)),
f AS (SELECT *, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || stop AS s FROM found)
SELECT t.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(s, ',' ORDER BY start, kind, stop) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(s, ',' ORDER BY start, kind, stop), '') AS spans
FROM t LEFT JOIN f ON t.doc_id = f.doc_id GROUP BY t.doc_id
"""

_TEMPLATES = ", ".join(f"({i}, {_quote(name)}, {_quote(text)})" for i, (name, text) in enumerate(licenses.TEMPLATES))


def _shingles(words: str) -> str:
    return (f"list_distinct(list_transform(range(1, len({words}) - {licenses.SHINGLE - 2}), "
            f"lambda i: array_to_string({words}[i:i + {licenses.SHINGLE - 1}], ' ')))")


OP5 = f"""
WITH t AS (SELECT template_id, license_id, {_shingles("w")} AS s FROM (
       SELECT template_id, license_id, {_normal("text")} AS w FROM (VALUES {_TEMPLATES}) v(template_id, license_id, text))),
u AS (SELECT template_id, license_id, len(s) AS step, unnest(s) AS shingle FROM t),
d AS (SELECT doc_id, {_normal()} AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i + 1:i + {licenses.SHINGLE}], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(0, len(w) - {licenses.SHINGLE - 1})) AS i FROM d)),
h AS (SELECT DISTINCT doc_id, template_id, license_id, step, shingle, unnest(list_distinct([i // step, greatest(i // step - 1, 0)])) AS k
      FROM x JOIN u USING (shingle)),
g AS (SELECT doc_id, license_id, template_id, k * step AS start_word, CAST(count(*) AS DOUBLE) / step AS share
      FROM h GROUP BY doc_id, license_id, template_id, step, k HAVING CAST(count(*) AS DOUBLE) / step >= {licenses.CONTAINMENT})
SELECT doc_id, license_id, max(share) AS containment, CAST(arg_min(template_id, (-share, template_id, start_word)) AS INT) AS template_id,
       CAST(arg_min(start_word, (-share, template_id, start_word)) AS INT) AS start_word, count(*) AS n_windows
FROM g GROUP BY doc_id, license_id
"""

OP6 = f"""
WITH d AS (SELECT doc_id, {_words()} AS w FROM documents),
u AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)),
f AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY g) AS first FROM u),
c AS (SELECT DISTINCT doc_id, p + k AS pos FROM f, range(50) r(k) WHERE first < doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
k AS (SELECT x.doc_id, count(c.pos) AS n_removed, string_agg(word, ' ' ORDER BY x.pos) FILTER (WHERE c.pos IS NULL) AS kept
      FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.pos = c.pos GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

_L, _T = decontaminate.STRETCH, decontaminate.TOLERANCE
_SPAN = min(m[-1] + 1 for m in decontaminate.MASKS)
OP7 = f"""
WITH d AS (SELECT doc_id, {_normal()} AS w FROM documents),
i AS (SELECT item_id, {_normal()} AS v FROM benchmark),
dw AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS a FROM d),
iw AS (SELECT item_id, len(v) AS m, unnest(v) AS word, unnest(range(len(v))) AS b FROM i WHERE len(v) >= {_SPAN}),
e AS (SELECT doc_id, item_id, n, m, a - b AS diag, b FROM dw JOIN iw USING (word)),
g AS (SELECT doc_id, item_id, n, m, diag, list(b) AS bs FROM e GROUP BY ALL HAVING count(*) >= least({_L}, m) - {_T}),
s AS (SELECT *, least({_L}, m) AS size, unnest(range(greatest(0, -diag), least(m, n - diag) - least({_L}, m) + 1)) AS lo FROM g),
k AS (SELECT doc_id, item_id, size, len(list_filter(bs, lambda b: (b >= lo) AND (b < lo + size))) AS same FROM s)
SELECT doc_id, item_id, CAST(max(same) AS INT) AS matched_words, CAST(max(size) AS INT) AS stretch_words
FROM k WHERE same >= size - CASE WHEN size >= {_L} THEN {_T} ELSE 0 END GROUP BY doc_id, item_id
"""

_FURNITURE = "|".join(quality_rules.BOILERPLATE + quality_rules.PLACEHOLDER)
OP9 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_words()} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
u AS (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d)),
f AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM u),
r AS (SELECT doc_id, count(DISTINCT p + k) AS n_repeat_words FROM f, range(8) q(k) WHERE c > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i, lines FROM d),
lv AS (SELECT *, {_words("line")} AS v FROM l),
lw AS (SELECT *, list_filter(v[2:], lambda x: regexp_matches(x, '^[|<>»›·•/\\-]+$')) AS bars,
       regexp_extract_all(lower(line), '{_FURNITURE}') AS phrases FROM lv),
g AS (SELECT doc_id, sum(length(line)) AS line_chars, coalesce(sum(length(line)) FILTER (WHERE NOT (
        len(list_filter(v, lambda x: regexp_matches(x, '(?:[#*$%&|<>]{{3,}}|!!+)$'))) > len(v) * {quality_rules.NOISY_SHARE}
        OR (len(bars) > len(v) * {quality_rules.SEPARATOR_SHARE}
            AND (len(bars) > 1 OR len(list_filter(bars, lambda x: regexp_matches(x, '[|»›]'))) > 0))
        OR (len(phrases) > 0 AND len(string_split(array_to_string(phrases, ' '), ' ')) >= len(v) * {quality_rules.FURNITURE_SHARE})
        OR list_position(lines, line) <> i)), 0) AS kept_chars
      FROM lw GROUP BY doc_id),
b AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(kept_chars, 0) AS kept_chars, coalesce(line_chars, 0) AS line_chars
      FROM d LEFT JOIN r ON d.doc_id = r.doc_id LEFT JOIN g ON d.doc_id = g.doc_id),
v AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND kept_chars >= line_chars * {quality_rules.KEEP_SHARE} AS kept FROM v
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_words()}) AS BIGINT) AS size, md5(coalesce(text, '')) AS mark FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3) + 1] AS BIGINT) AS weight,
      3 * source_size AS cap FROM s),
f AS (SELECT *, CAST(cap AS DOUBLE) / weight AS fill FROM w),
l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
             / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS level
      FROM f WINDOW b AS (ORDER BY fill, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT arg_min(level, (fill, source)) FILTER (WHERE fill >= level) AS final_level FROM l),
t AS (SELECT source, source_size, CASE WHEN fill >= level THEN (SELECT final_level FROM m) * weight
             ELSE CAST(cap AS DOUBLE) END AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 1.0 END AS rate FROM t)
SELECT d.doc_id, d.size, r.source_size, r.target,
       d.size * (CAST(floor(r.rate) AS BIGINT) + CASE WHEN
         CAST(('0x' || substr(md5('mix-2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.mark), 1, 13)) AS BIGINT)
         / 4503599627370496.0 < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
qt AS (SELECT q, item_id, term, count(*) AS c FROM (SELECT q, item_id, unnest(t) AS term FROM q) GROUP BY ALL),
w AS (SELECT q, item_id, term, c * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM qt JOIN df USING (term), s),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * len(t) * n_docs) // n_terms) AS m FROM d, s),
p AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM w JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM o WHERE rank <= 10
"""

OP12 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_words(_AZ)} AS w FROM documents),
g AS (SELECT r, unnest(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM d),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
e AS (SELECT a, b FROM shared JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b GROUP BY d.r, d.doc_id
"""

# CRC-32 of the decimal digits of a conversation's id, bit by bit; the polynomial is the fixed one of that checksum
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, x: list_reduce(list_prepend(xor(c, x), CAST(range(8) AS BIGINT[])),
    lambda k, i: CASE WHEN k % 2 = 1 THEN xor(k >> 1, CAST(3988292384 AS BIGINT)) ELSE k >> 1 END)), CAST(4294967295 AS BIGINT))"""
_N_WORDS = f"len({_words()})"
OP13 = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
                  sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS sym, {_N_WORDS} AS words
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS len, ({_CRC}) % 4 AS h FROM t GROUP BY conv_id),
k AS (SELECT c.conv_id, c.len, c.h, c.conv_id - c.conv_id % 20 AS base, least(c.h, coalesce(b.len, 0)) AS given
      FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20),
s AS (SELECT k.conv_id, pos, sym, words FROM k JOIN t ON t.conv_id = base AND pos < h
      UNION ALL SELECT k.conv_id, pos - h + given, sym, words FROM k JOIN t ON t.conv_id = k.conv_id AND pos >= h),
p AS (SELECT conv_id, CAST(pos + 1 AS BIGINT) AS depth, words,
             sha256(string_agg(sym, ',') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)) AS name FROM s
      UNION ALL SELECT conv_id, 0, 0, 'root' FROM k),
l AS (SELECT conv_id, max(depth) AS last FROM p GROUP BY conv_id),
r AS (SELECT name, depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
             sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE last = depth), '')) AS ends_sha256
      FROM p JOIN l USING (conv_id) GROUP BY name, depth),
u AS (SELECT r.name, o.name AS parent, q.conv_id AS parent_conv_id FROM r
      LEFT JOIN p o ON o.conv_id = r.conv_id AND o.depth = r.depth - 1 LEFT JOIN r q ON q.name = o.name),
ch AS (SELECT parent AS name, count(*) AS n_children FROM u WHERE parent IS NOT NULL GROUP BY parent),
v AS (SELECT a.name, CAST(sum(CASE WHEN ch.name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
             CAST(sum((x.n_convs - 1) * x.words) AS BIGINT) AS saved_tokens
      FROM r x JOIN p a ON a.conv_id = x.conv_id AND a.depth <= x.depth LEFT JOIN ch ON ch.name = x.name GROUP BY a.name)
SELECT conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, ends_sha256
FROM r JOIN u USING (name) JOIN v USING (name) LEFT JOIN ch USING (name)
"""

# op3 needs XXH64, op4 a tokenizer, op8 a fitted model: tests/llm compares them with plain Python
ORACLE_SQL = {"op1_warc": OP1, "op2_secret_scan": OP2, "op5_license_scan": OP5, "op6_substring_dedup": OP6,
              "op7_decontamination": OP7, "op9_quality_rules": OP9, "op10_mixing": OP10, "op11_ranked_search": OP11,
              "op12_ngram_jaccard_join": OP12, "op13_conversation_trie": OP13}
