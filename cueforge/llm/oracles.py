"""DuckDB SQL for what SQL can express of the training-data operators' results."""

from __future__ import annotations

from .katz import K

_TEXT = "coalesce(text, '')"


def crc32_sql(values: str) -> str:
    """Unsigned CRC-32 of a list of byte values: eight shifts a byte, by nested folds."""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {values}), lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295::BIGINT)"


def _bytes_sql(hexed: str) -> str:
    return f"list_transform(range(1, length({hexed}) + 1, 2), lambda i: ('0x' || substring({hexed}, i, 2))::BIGINT)"


def _le4(n: str) -> str:
    """Little-endian 32-bit bytes of a number, as hex digits."""
    return " || ".join(f"printf('%02x', ({n} >> {8 * k}) & 255)" for k in range(4))


#: A key's CRC of its decimal digits.
KEY_CRC = crc32_sql("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)")

MEDIA = f"""
WITH p AS (SELECT doc_id, strlen({_TEXT}) AS n, {_TEXT} || repeat(' ', CAST(CASE WHEN strlen({_TEXT}) = 0 THEN 192 ELSE (192 - strlen({_TEXT}) % 192) % 192 END AS BIGINT)) AS t FROM documents),
 h AS (SELECT doc_id, n, t, strlen(t) AS size, hex(encode(t)) AS x FROM p),
 m AS (SELECT *, substring(x, length(x) - 31) AS tail, unhex('52494646' || {_le4('(36 + size)')} || '57415645666d7420' || {_le4('16')} || '01000100' || {_le4('8000')} || {_le4('8000')} || '0100080064617461' || {_le4('size')}) || encode(t) AS media FROM h),
 b AS (SELECT doc_id, i, ('0x' || substring(x, 2 * i - 1, 2))::INT AS v FROM (SELECT doc_id, x, unnest(range(1, size + 1)) AS i FROM h)),
 f AS (SELECT doc_id, avg(v - 128) AS mean, sqrt(avg((v - 128) * (v - 128))) AS rms, count(*) FILTER ((v < 128) <> (before < 128)) AS crossings FROM (SELECT *, lag(v) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM b) GROUP BY doc_id),
 e AS (SELECT doc_id, -sum(k / n * log2(k / n)) AS entropy FROM (SELECT doc_id, v, count(*)::DOUBLE AS k, sum(count(*)) OVER (PARTITION BY doc_id) AS n FROM b GROUP BY doc_id, v) GROUP BY doc_id)
SELECT m.doc_id, CAST(m.n AS BIGINT) AS n_bytes, CAST(m.size AS BIGINT) AS payload_bytes, sha256(m.t) AS payload_sha256, {crc32_sql(_bytes_sql('m.tail'))} AS tail_crc32,
 CAST(m.size + 44 AS BIGINT) AS media_bytes, sha256(m.media) AS media_sha256,
 'mean=' || printf('%.6f', f.mean) || ';rms=' || printf('%.6f', f.rms) || ';crossings=' || f.crossings || ';entropy=' || printf('%.6f', e.entropy) AS feature
FROM m JOIN f ON m.doc_id = f.doc_id JOIN e ON m.doc_id = e.doc_id"""

EDITS = f"""
WITH o AS (SELECT doc_id, {_TEXT} AS t, coalesce(lead({_TEXT}) OVER w, first_value({_TEXT}) OVER (ORDER BY doc_id DESC)) AS nxt FROM documents WINDOW w AS (ORDER BY doc_id DESC))
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(CASE WHEN length(t) < 3 THEN t ELSE substring(t, 1, length(t) - length(t) // 3) || substring(nxt, 1, length(t) // 3) END) AS edited_sha256 FROM o"""

_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) <= 3 AND coalesce(TRY_CAST(p AS HUGEINT), 0) <= 255)) = 4"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", "length(d) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 0 THEN substring(d, i, 1)::INT ELSE substring(d, i, 1)::INT * 2 - 9 * CAST(substring(d, i, 1)::INT > 4 AS INT) END)) % 10 = 0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 8 AND 15"),
}


def _spans_sql(kind: str, place: int, pattern: str, good: str) -> str:
    """Spans of one kind: a match begins after all pieces between matches, and all matches, before it."""
    return f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, start, start + length(m) AS stop FROM (SELECT doc_id, ms[i] AS m, regexp_replace(ms[i], '[^0-9]', '', 'g') AS d,
  list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda g: length(g))), 0) AS start
  FROM (SELECT doc_id, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gaps FROM p) WHERE len(ms) > 0)) WHERE {good}"""


BASE_SPANS = f"""
WITH p AS (SELECT doc_id, {_TEXT} AS t FROM documents), s AS ({" UNION ALL ".join(_spans_sql(kind, place, *own) for place, (kind, own) in enumerate(_KINDS.items()))}),
 a AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in _KINDS)}, string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY place, start) AS spans FROM s GROUP BY doc_id)
SELECT p.doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in _KINDS)}, sha256(coalesce(spans, '')) AS base_sha256 FROM p LEFT JOIN a USING (doc_id)"""


def _discounts_sql(name: str, counts: str) -> str:
    """<name>_d (r, d): Good-Turing discounts of the counts c of a table, of the largest K that gives proper ones."""
    return f"""{name}_n AS (SELECT r, (SELECT count(*) FROM {counts} WHERE c = r)::DOUBLE AS n FROM (SELECT unnest(range(1, {K + 2})) AS r)),
 {name}_k AS (SELECT k.r AS k, a.r, a.n, b.n AS n2, ((a.r + 1) * b.n / nullif(a.n, 0) / a.r - o.over) / nullif(1 - o.over, 0) AS d, o.over FROM {name}_n k JOIN {name}_n a ON a.r <= k.r JOIN {name}_n b ON b.r = a.r + 1
  JOIN (SELECT x.r AS k, (x.r + 1) * y.n / nullif(z.n, 0) AS over FROM {name}_n x JOIN {name}_n y ON y.r = x.r + 1 JOIN {name}_n z ON z.r = 1 WHERE x.r <= {K}) o ON o.k = k.r),
 {name}_b AS (SELECT max(k) AS k FROM (SELECT k FROM {name}_k GROUP BY k HAVING min(n) > 0 AND min(n2) > 0 AND min(over) < 1 AND min(d) > 0 AND max(d) <= 1 AND min(d) < 1)),
 {name}_d AS (SELECT r, coalesce((SELECT d FROM {name}_k x, {name}_b y WHERE x.k = y.k AND x.r = {name}_n.r), 1.0) AS d FROM {name}_n WHERE r <= {K})"""


_LEFT = "CASE WHEN {0} <= 1e-12 THEN 1 / ({1} + 1) ELSE {0} / {1} END"
_KEEP = "CASE WHEN {0} <= 1e-12 THEN {1} / ({1} + 1) ELSE 1.0 END"
#: The whole bigram model and its scores. '</s>' and '<s>' after a line end are no words.
KATZ = f"""
WITH w AS (SELECT doc_id, {KEY_CRC} % 10 = 0 AS held_out, list_append(regexp_extract_all(translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), chr(10) || '</s>') AS words FROM documents),
 tok AS (SELECT doc_id, held_out, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS w, unnest(list_prepend(chr(10) || '<s>', words[1:len(words) - 1])) AS h FROM w),
 uni AS (SELECT w, count(*)::DOUBLE AS c FROM tok WHERE NOT held_out GROUP BY w), tot AS (SELECT sum(c) AS n, count(*) AS v FROM uni), {_discounts_sql('u', 'uni')},
 ul AS (SELECT coalesce(sum(c * (1 - d)), 0) AS lost FROM uni JOIN u_d ON c = r), um AS (SELECT n, v, {_LEFT.format('lost', 'n')} AS unknown, {_KEEP.format('lost', 'n')} AS keep FROM tot, ul),
 up AS (SELECT w, c, coalesce(d, 1) * c / n * keep AS p FROM uni LEFT JOIN u_d ON c = r, um),
 bi AS (SELECT h, w, count(*)::DOUBLE AS c FROM tok WHERE NOT held_out GROUP BY h, w), {_discounts_sql('b', 'bi')},
 hs AS (SELECT h, sum(bi.c) AS total, sum(bi.c * (1 - coalesce(d, 1))) AS lost, sum(up.p) AS mass FROM bi JOIN up ON bi.w = up.w LEFT JOIN b_d ON bi.c = r GROUP BY h),
 hp AS (SELECT h, total, {_KEEP.format('lost', 'total')} AS keep, ({_LEFT.format('lost', 'total')}) / (1 - mass) AS alpha FROM hs),
 bp AS (SELECT bi.h, bi.w, coalesce(d, 1) * bi.c / total * keep AS p FROM bi JOIN hp ON bi.h = hp.h LEFT JOIN b_d ON bi.c = r)
SELECT tok.doc_id, any_value(tok.held_out) AS held_out, count(*) AS n_tokens, count(up.c) AS n_known, CAST(any_value(um.n) AS BIGINT) AS train_tokens,
 round(sum(log10((coalesce(up.c, 0) + 0.1::DOUBLE) / (um.n + 0.1::DOUBLE * (um.v + 1)))), 3) AS base_score,
 round(sum(log10(coalesce(bp.p, coalesce(hp.alpha, 1) * coalesce(up.p, um.unknown)))), 3) AS score
FROM tok CROSS JOIN um LEFT JOIN up ON tok.w = up.w LEFT JOIN bp ON tok.h = bp.h AND tok.w = bp.w LEFT JOIN hp ON tok.h = hp.h GROUP BY tok.doc_id"""
