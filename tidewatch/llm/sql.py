"""DuckDB SQL for the llm queries that SQL can express.

Written from the definitions, not from the Spark code.  The other queries are
held against brute-force versions in tests/llm.
"""
from __future__ import annotations

from tidewatch.llm import packing, pii, quality, secrets

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce({0}, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _spans(name: str, kind: str, rank: int, pattern: str, source: str = "documents") -> str:
    """CTE of (doc_id, kind, k, s, e, m): all matches of a pattern in texts."""
    p = pattern.replace("'", "''")
    return f"""
{name}_raw AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '{p}')) AS m, unnest(regexp_split_to_array(text, '{p}')) AS g,
         generate_subscripts(regexp_split_to_array(text, '{p}'), 1) AS i
  FROM {source} WHERE regexp_matches(text, '{p}')),
{name} AS (
  SELECT doc_id, '{kind}' AS kind, {rank} AS k, m,
         CAST(sum(length(g) + length(coalesce(m, ''))) OVER w - length(coalesce(m, '')) AS BIGINT) AS s,
         CAST(sum(length(g) + length(coalesce(m, ''))) OVER w AS BIGINT) AS e
  FROM {name}_raw WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)
  QUALIFY m IS NOT NULL)"""


def _entropy(cls: secrets.EntropyClass, rank: int) -> str:
    run = r"[0-9a-fA-F]{20,}" if cls.kind == "entropy_hex" else r"[A-Za-z0-9+/_=-]{24,}"
    name = cls.kind
    needs = " AND ".join(f"regexp_matches(m, '{n}')" for n in cls.needs)
    allow = " AND ".join("NOT regexp_matches(m, '" + a.replace("'", "''") + "')" for a in secrets.ALLOW)
    # A hex run counts only if no other letter or digit touches it.
    free = ("" if name != "entropy_hex" else
            " AND NOT regexp_matches(coalesce(substr(d.text, c.s, CASE WHEN c.s > 0 THEN 1 ELSE 0 END), ''), '[0-9A-Za-z]')"
            " AND NOT regexp_matches(substr(d.text, c.e + 1, 1), '[0-9A-Za-z]')")
    return _spans(name + "_run", name, rank, run) + f""",
{name}_cand AS (SELECT c.* FROM {name}_run c JOIN documents d USING (doc_id) WHERE {needs} AND {allow}{free}),
{name}_win AS (
  SELECT doc_id, s AS org, s + i AS s, s + i + {cls.window} AS e
  FROM (SELECT *, unnest(range(0, length(m) - {cls.window} + 1)) AS i FROM {name}_cand)
  WHERE list_entropy(string_split(substr(m, CAST(i AS INT) + 1, {cls.window}), '')) >= {cls.min_bits} - 1e-9),
{name}_island AS (
  SELECT *, sum(CASE WHEN s <= before THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, org ORDER BY s) AS g
  FROM (SELECT *, lag(e) OVER (PARTITION BY doc_id, org ORDER BY s) AS before FROM {name}_win)),
{name} AS (SELECT doc_id, '{name}' AS kind, {rank} AS k, min(s) AS s, max(e) AS e FROM {name}_island GROUP BY doc_id, org, g)"""


_ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
           r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_A = _ASSIGN.replace("'", "''")
OP1 = f"""
WITH {_spans('assign_all', 'assign', 0, _ASSIGN)},
{_spans('access_all', 'access', 1, 'AKIA[A-Z0-9]+')},
{_spans('hex_all', 'hex', 2, '[0-9a-f]+')},
{_entropy(secrets.CLASSES[0], 3)},
{_entropy(secrets.CLASSES[1], 4)},
base AS (
  SELECT doc_id, kind, k, s, e FROM assign_all WHERE length(regexp_extract(m, '{_A}', 2)) >= 8
  UNION ALL SELECT doc_id, kind, k, s, e FROM access_all WHERE length(m) >= 16
  UNION ALL SELECT doc_id, kind, k, s, e FROM hex_all WHERE length(m) >= 32),
every AS (SELECT * FROM base UNION ALL SELECT * FROM entropy_hex UNION ALL SELECT * FROM entropy_b64),
b AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS t FROM base GROUP BY doc_id),
f AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS t FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.t, '')) AS base_sha256, coalesce(f.t, '') AS spans
FROM documents d LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id)
"""


def _dp(levels: int) -> str:
    steps = ["b0 AS (SELECT 0 AS j, 0::HUGEINT AS t, 0::HUGEINT AS cost, []::BIGINT[] AS bounds)"]
    for b in range(1, levels + 1):
        steps.append(f"""b{b} AS (
  SELECT h.j, any_value(h.t) AS t, min(p.cost + (h.t - p.t) * h.n) AS cost,
         arg_min(list_append(p.bounds, h.n), (p.cost + (h.t - p.t) * h.n) * 1000000 + p.j) AS bounds
  FROM h JOIN b{b - 1} p ON p.j < h.j GROUP BY h.j)""")
    last = " UNION ALL ".join(f"SELECT {b} AS lv, j, bounds FROM b{b}" for b in range(1, levels + 1))
    steps.append(f"best AS (SELECT bounds FROM ({last}) WHERE j = (SELECT max(j) FROM h) AND lv = least({levels}, (SELECT max(j) FROM h)))")
    return ",\n".join(steps)


OP3 = f"""
WITH total AS (SELECT doc_id, CAST(len({_SPACE_WORDS.format('text')}) AS BIGINT) AS n FROM documents),
seq AS (SELECT doc_id, piece, piece * {packing.MAX_LEN} AS start_token, least({packing.MAX_LEN}, n - piece * {packing.MAX_LEN}) AS n_tokens
        FROM (SELECT doc_id, n, unnest(range(0, (n - 1) // {packing.MAX_LEN} + 1)) AS piece FROM total WHERE n > 0)),
h AS (SELECT n_tokens AS n, row_number() OVER (ORDER BY n_tokens) AS j, CAST(sum(count(*)) OVER (ORDER BY n_tokens) AS HUGEINT) AS t FROM seq GROUP BY n_tokens),
{_dp(packing.BUCKETS)},
placed AS (SELECT seq.*, list_min(list_filter(bounds, lambda b: b >= n_tokens)) AS bucket, substr(md5(doc_id || ':' || piece), 1, {packing.SHARD_CHARS}) AS shard FROM seq, best),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY shard, doc_id, piece) - 1 AS r, greatest({packing.BATCH_TOKENS} // bucket, 1) AS per FROM placed)
SELECT doc_id, piece, start_token, n_tokens, bucket, r // per AS batch, r % per AS slot FROM ranked
"""


OP9 = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS.format('text')} AS w FROM documents),
items AS (SELECT item_id, {_ALNUM_WORDS.format('text')} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM sized),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, n FROM dw JOIN iw USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS t FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _quality() -> str:
    names = list(dict.fromkeys(r.measure for r in quality.RULES))
    steps = quality.STEPS

    # The sketch returns the value at rank ceil(p * n), n without nulls.
    def q(m, p):
        return f"list_sort(list({m}))[CAST(ceil({p}::DOUBLE * count({m})) AS BIGINT)]"

    shares = [1 - p for p in steps[:0:-1]] + list(steps)
    quart = ", ".join(f"[{', '.join(q(m, p) for p in shares)}] AS {m}_q" for m in names)
    pick = ", ".join(f"CASE WHEN g.n >= {quality.MIN_GROUP} THEN g.{m}_q WHEN l.n >= {quality.MIN_GROUP} THEN l.{m}_q ELSE a.{m}_q END AS {m}_q" for m in names)
    fails = []
    for r in quality.RULES:
        mid, sign = len(steps), -1 if r.low else 1
        away = [f"(({r.measure}_q[{mid + sign * i}] - {r.measure}_q[{mid}]) * {sign})" for i in range(len(steps))]
        body = away[-1]
        for i in range(len(steps) - 2, 0, -1):
            body = f"CASE WHEN {away[i + 1]} <= greatest({quality.TAIL_RATIO}::DOUBLE * {away[i]}, {r.floor}::DOUBLE) THEN {body} ELSE {away[i]} END"
        edge = f"{r.measure}_q[{mid}] + greatest(({body}) * {1 + r.reach}::DOUBLE, {r.floor}::DOUBLE) * {sign}"
        fails.append(f"CASE WHEN {r.measure} {'<' if r.low else '>'} {edge} THEN '{r.measure}_{'low' if r.low else 'high'}' END")
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_SPACE_WORDS.format('text')} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE c > 1) GROUP BY doc_id),
m AS (SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
      FROM d LEFT JOIN rep USING (doc_id)),
x AS (SELECT *, n_symbols / greatest(word_chars, 1) AS symbol_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
             n_repeat_words / greatest(n_words, 1) AS repeat_share, word_chars / greatest(n_words, 1) AS word_length FROM m),
g AS (SELECT lang, source, count(*) AS n, {quart} FROM x GROUP BY lang, source),
l AS (SELECT lang, count(*) AS n, {quart} FROM x GROUP BY lang),
a AS (SELECT {quart} FROM x),
bounds AS (SELECT g.lang, g.source, {pick} FROM g LEFT JOIN l ON g.lang IS NOT DISTINCT FROM l.lang, a),
v AS (SELECT x.*, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
             list_filter([{', '.join(fails)}], lambda f: f IS NOT NULL) AS f
      FROM x JOIN bounds b ON x.lang IS NOT DISTINCT FROM b.lang AND x.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND len(f) = 0 AS kept,
       array_to_string(f, ',') AS failed_rules FROM v
"""


OP10 = _quality()


def _pii() -> str:
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    ip = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    card = r"[0-9]([\x20-]?[0-9])+"
    phone = r"\+[0-9][\x20().0-9-]+[0-9]"
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN (length({digits}) - i) % 2 = 1 "
            f"THEN CASE WHEN substr({digits}, i, 1)::INT > 4 THEN substr({digits}, i, 1)::INT * 2 - 9 ELSE substr({digits}, i, 1)::INT * 2 END "
            f"ELSE substr({digits}, i, 1)::INT END)) % 10 = 0")
    return f"""
WITH {_spans('email_all', 'email', 0, email)},
{_spans('ip_all', 'ip', 1, ip)},
{_spans('card_all', 'card', 2, card)},
{_spans('phone_all', 'phone', 3, phone)},
ents AS (
  SELECT doc_id, kind, k, s, e, m FROM email_all
  UNION ALL SELECT doc_id, kind, k, s, e, m FROM ip_all WHERE list_max(list_transform(string_split(m, '.'), lambda p: coalesce(TRY_CAST(p AS HUGEINT), 256))) <= 255
  UNION ALL SELECT doc_id, kind, k, s, e, m FROM card_all WHERE length({digits}) BETWEEN 16 AND 19 AND {luhn}
  UNION ALL SELECT doc_id, kind, k, s, e, m FROM phone_all WHERE length({digits}) BETWEEN 8 AND 15),
named AS (SELECT ents.*, kind || ':' || CASE WHEN kind IN ('card', 'phone') THEN {digits} ELSE lower(m) END AS value,
                 kind || ':' || CASE kind WHEN 'email' THEN lower(regexp_extract(m, '@(.*)$', 1)) WHEN 'ip' THEN regexp_extract(m, '^([0-9]+\\.[0-9]+)', 1)
                   WHEN 'card' THEN substr({digits}, 1, 6) ELSE substr({digits}, 1, 3) END AS general,
                 greatest(s - {pii.WINDOW}, 0) AS a, least(e + {pii.WINDOW}, length(text)) AS b, length(text) AS n, text
          FROM ents JOIN documents USING (doc_id)),
side AS (SELECT doc_id, value, general, a AS org, s - a AS n, a > 0 AS cut_l, false AS cut_r, substr(text, a + 1, s - a) AS x FROM named
         UNION ALL SELECT doc_id, value, general, e, b - e, false, b < n, substr(text, e + 1, b - e) FROM named),
raw AS (SELECT *, unnest(regexp_extract_all(x, '[\\p{{L}}\\p{{M}}]{{4,}}')) AS t, unnest(regexp_split_to_array(x, '[\\p{{L}}\\p{{M}}]{{4,}}')) AS g,
               generate_subscripts(regexp_split_to_array(x, '[\\p{{L}}\\p{{M}}]{{4,}}'), 1) AS i, row_number() OVER () AS sid FROM side),
term AS (SELECT *, sum(length(g) + length(coalesce(t, ''))) OVER (PARTITION BY sid ORDER BY i) AS e FROM raw),
near AS (SELECT doc_id, value, general, lower(t) AS t, CAST(org + e - length(t) AS BIGINT) AS s, CAST(org + e AS BIGINT) AS e FROM term
         WHERE t IS NOT NULL AND NOT (e = length(t) AND cut_l) AND NOT (e = n AND cut_r)),
n_te AS (SELECT value, general, t, count(DISTINCT doc_id) AS n_te FROM near GROUP BY ALL),
n_tg AS (SELECT general, t, count(DISTINCT doc_id) AS n_tg FROM near GROUP BY ALL HAVING count(DISTINCT doc_id) >= {pii.MIN_SUPPORT}),
n_value AS (SELECT value, count(DISTINCT doc_id) AS n_e FROM named GROUP BY value),
n_general AS (SELECT general, count(DISTINCT doc_id) AS n_g FROM named GROUP BY general),
n_term AS (SELECT t, count(*) AS n_t FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]{{4,}}'))) AS t FROM documents) GROUP BY t),
judged AS (SELECT *, (n_te + {pii.PRIOR}::DOUBLE * (n_tg / greatest(n_t, n_tg)) * (n_e / n_g)) / (greatest(n_t, n_tg) + {pii.PRIOR}::DOUBLE) AS share
           FROM n_te JOIN n_tg USING (general, t) JOIN n_value USING (value) JOIN n_general USING (general) JOIN n_term USING (t)),
told AS (SELECT DISTINCT general, t FROM judged, (SELECT count(*) AS n FROM documents)
         WHERE share >= {pii.GENERALISE_SHARE}::DOUBLE - 1e-9 AND log2(share * n / n_e) >= -log2(n_g / n) - 1e-9),
{_spans('word', 'term', 4, '[\\p{L}\\p{M}]{4,}', '(SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM named JOIN told USING (general)))')},
every AS (SELECT doc_id, kind, k, s, e FROM ents UNION ALL
          SELECT doc_id, kind, k, s, e FROM word
          WHERE EXISTS (SELECT 1 FROM told JOIN named USING (general) WHERE told.t = lower(word.m) AND named.doc_id = word.doc_id)
            AND NOT EXISTS (SELECT 1 FROM ents WHERE ents.doc_id = word.doc_id AND ents.s < word.e AND word.s < ents.e)),
f AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS t, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 4) AS bt,
             {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in (*pii.KINDS, 'term'))} FROM every GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in (*pii.KINDS, 'term'))}, sha256(coalesce(bt, '')) AS base_sha256, coalesce(t, '') AS spans
FROM documents d LEFT JOIN f USING (doc_id)
"""


ORACLE_SQL = {"op1_secret_scan": OP1, "op3_packing": OP3, "op4_pii": _pii(), "op9_decontamination": OP9, "op10_quality_rules": OP10}

# CRC-32 of a decimal id: per byte an exclusive or, then eight shifts by the
# reflected polynomial (-1 marks a shift).
_CRC32 = """xor(4294967295::UBIGINT, list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)::UBIGINT)"""


def _digest(n_chars: str) -> str:
    def field(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({c}::VARCHAR), ':', {c}::VARCHAR) END"
    return "sha256(concat(" + ", ".join(field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + "))"


def _tree(name: str, start: str) -> str:
    """CTE (key, lvl, idx, n, digest): all nodes of the trees over ``start``
    (key, idx, n, digest); n counts the nodes of the level."""
    return f"""
{name} AS (
  SELECT key, 0 AS lvl, idx, n, digest FROM {start}
  UNION ALL
  SELECT key, lvl + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY idx)) FROM {name}
  WHERE n > 1 GROUP BY key, lvl, idx // 2)"""


OP11 = f"""
WITH RECURSIVE leaf AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS key, {_digest('n_chars')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_CRC32.format('doc_id::VARCHAR')} % 7 = 0 THEN {_digest('(n_chars::BIGINT + 1)')} ELSE {_digest('n_chars')} END AS other FROM documents),
base AS (SELECT r, doc_id, leaf, other, key, leaf AS digest, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx,
                count(*) OVER (PARTITION BY key) AS n FROM leaf),
{_tree('low', 'base')},
sub AS (SELECT '' AS key, key AS lang, digest, row_number() OVER (ORDER BY key) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
{_tree('high', 'sub')},
steps AS (
  SELECT r, lvl AS depth, idx_at, (SELECT digest FROM low s WHERE s.key = x.key AND s.lvl = x.lvl AND s.idx = xor(x.idx_at, 1)) AS sib
  FROM (SELECT b.r, b.key, l.lvl, b.idx >> l.lvl AS idx_at FROM base b JOIN (SELECT DISTINCT key, lvl FROM low WHERE n > 1) l USING (key)) x
  UNION ALL
  SELECT r, 1000 + lvl, idx_at, (SELECT digest FROM high s WHERE s.lvl = x.lvl AND s.idx = xor(x.idx_at, 1))
  FROM (SELECT b.r, l.lvl, sub.idx >> l.lvl AS idx_at FROM base b JOIN sub ON sub.lang = b.key JOIN (SELECT DISTINCT lvl FROM high WHERE n > 1) l ON true) x),
path AS (
  SELECT r, list(CASE WHEN sib IS NULL THEN '' WHEN idx_at % 2 = 1 THEN 'L' || sib ELSE 'R' || sib END ORDER BY depth) AS p,
         coalesce(string_agg(sib, '' ORDER BY depth), '') AS sibs FROM steps GROUP BY r),
folded AS (
  SELECT b.doc_id, b.leaf, sub.digest AS subroot, (SELECT digest FROM high WHERE n = 1) AS root, sha256(coalesce(sibs, '')) AS proof_sha256,
         list_reduce(list_prepend(b.other, coalesce(p, [])), lambda acc, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || acc ELSE acc || x[2:] END)) AS folded_root
  FROM base b JOIN sub ON sub.lang = b.key LEFT JOIN path USING (r))
SELECT *, folded_root = root AS verified FROM folded
"""

OP12 = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS UBIGINT) % (len(u) + 1) AS c1, CAST('0x' || h[9:16] AS UBIGINT) % (len(u) + 1) AS c2,
         CAST('0x' || h[17:24] AS UBIGINT) % 100 AS form_at, CAST('0x' || h[25:32] AS UBIGINT) % 100 AS order_at FROM units),
cut AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS pre, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS suf,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR form_at >= 90 THEN 'plain'
              WHEN order_at < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid) ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

ORACLE_SQL |= {"op11_merkle_manifest": OP11, "op12_fill_in_middle": OP12}
