"""DuckDB SQL for the operators that SQL can express over the whole tables."""

from __future__ import annotations

from duotower.llm import quality
from duotower.llm.url_filter import rules_sql

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _quality_sql() -> str:
    blank = r"[\x20\x09-\x0D]"
    q = lambda s: "'" + s.replace("'", "''") + "'"
    rests, prev = [], "text"
    for k, c in enumerate(quality._CLASSES):
        rests.append(f"c{k} AS (SELECT *, regexp_replace({prev}, {q(c)}, '', 'g') AS r{k} FROM {'w' if not k else f'c{k - 1}'})")
        prev = f"r{k}"
    n = len(quality._CLASSES)
    lens = ["length(text)", *[f"length(r{k})" for k in range(n)]]
    classes = ", ".join([f"{a} - {b}" for a, b in zip(lens, lens[1:])] + [lens[-1]])
    common = " ".join(f"WHEN {q(lang)} THEN [{', '.join(q(x) for x in ws)}]" for lang, ws in quality.COMMON_WORDS.items())
    known = ", ".join(q(x) for x in quality.COMMON_WORDS)

    def js(a, b):
        share = lambda h: f"list_transform({h}, lambda x: x / list_sum({h}))"
        part = lambda u, v: f"(CASE WHEN {u} > 0 THEN {u} * log2({u} / (({u} + {v}) / 2)) ELSE 0 END)"
        z = f"list_zip({share(a)}, {share(b)})"
        return f"sqrt(greatest(0, list_sum(list_transform({z}, lambda z: {part('z[1]', 'z[2]')} / 2 + {part('z[2]', 'z[1]')} / 2))))"

    def summed(col, size, judged):
        return "[" + ", ".join(f"coalesce(sum({col}[{k + 1}]) FILTER (WHERE {judged}), 0)" for k in range(size)) + "]"

    return rf"""WITH d AS (SELECT row_number() OVER () AS uid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
{", ".join(rests)},
g AS (SELECT uid, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS gram FROM (SELECT uid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
tw AS (SELECT uid, i FROM (SELECT *, count(*) OVER (PARTITION BY uid, gram) AS n FROM g) WHERE n > 1),
cov AS (SELECT uid, count(DISTINCT p) AS n FROM (SELECT uid, unnest([i, i + 1, i + 2]) AS p FROM tw) GROUP BY uid),
m AS (SELECT c.uid, doc_id, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
             [{classes}] AS classes, CASE lang {common} ELSE [] END AS cw, list_transform(ws, lambda x: lower(x)) AS low
      FROM c{n - 1} c LEFT JOIN cov ON c.uid = cov.uid),
h AS (SELECT *, list_transform(cw, lambda c: len(list_filter(low, lambda x: x = c))) AS hits,
             n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
j AS (SELECT *, list_append(hits, n_words - coalesce(list_sum(hits), 0)) AS common,
             NOT base_failed AND list_sum(classes) >= {quality.GUARD_CHARS} AND coalesce(lang IN ({known}), false) AS by_chars,
             NOT base_failed AND n_words >= {quality.GUARD_WORDS} AND coalesce(lang IN ({known}), false) AS by_words FROM h),
ref AS (SELECT lang, {summed('classes', n + 1, 'by_chars')} AS rc, {summed('common', quality.N_COMMON + 1, 'by_words')} AS rw FROM j WHERE by_chars OR by_words GROUP BY lang),
s AS (SELECT j.*, CASE WHEN by_chars THEN {js('classes', 'rc')} ELSE 0 END AS cd, CASE WHEN by_words THEN {js('common', 'rw')} ELSE 0 END AS wd FROM j LEFT JOIN ref ON j.lang = ref.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND cd <= {quality.MAX_CHAR_DISTANCE} AND wd <= {quality.MAX_WORD_DISTANCE} AS kept FROM s"""


def _decontaminate_sql() -> str:
    return rf"""WITH d AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS ws FROM benchmark),
win AS (SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[i:i + 9], ' ') AS w
        FROM (SELECT item, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM b WHERE len(ws) > 0)),
pos AS (SELECT uid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
        FROM (SELECT d.uid, d.ws, l.n, unnest(range(1, len(d.ws) - l.n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) l)),
hit AS (SELECT pos.uid, pos.i, pos.n, win.item FROM pos JOIN win ON pos.n = win.n AND pos.w = win.w),
words AS (SELECT uid, count(DISTINCT p) AS n_hit FROM (SELECT uid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY uid),
items AS (SELECT uid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hit GROUP BY uid)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (uid) LEFT JOIN items USING (uid)"""


def _near_join_sql() -> str:
    return rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS} AS ws FROM documents),
s AS (SELECT DISTINCT uid, array_to_string(ws[i:i + 4], ' ') AS sh
      FROM (SELECT uid, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT uid, count(*) AS n FROM s GROUP BY uid),
p AS (SELECT a.uid AS u, b.uid AS v, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.uid < b.uid GROUP BY a.uid, b.uid),
e AS (SELECT u, v FROM p JOIN n x ON p.u = x.uid JOIN n y ON p.v = y.uid WHERE 5 * c >= 4 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
links AS (SELECT u AS uid, count(*) AS k FROM both_ways GROUP BY u),
r(uid, node) AS (SELECT uid, uid FROM d UNION SELECT r.uid, w.v FROM r JOIN both_ways w ON r.node = w.u),
class AS (SELECT r.uid, min(d.doc_id) AS class_id FROM r JOIN d ON r.node = d.uid GROUP BY r.uid)
SELECT d.doc_id, class.class_id, coalesce(links.k, 0) AS n_links
FROM d JOIN class ON d.uid = class.uid LEFT JOIN links ON d.uid = links.uid"""


def _warc_sql() -> str:
    """The digest's 40 hex digits are 8 numbers of 20 bits, each of which gives 4 base-32 digits."""
    digits = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {b}) & 31)::INTEGER + 1, 1)"
                         for g in range(8) for b in (15, 10, 5, 0))
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS r FROM pages),
d AS (SELECT page_id, html, strlen(html) AS n, sha1(html) AS h, row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, r DESC) AS k,
             first(page_id) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, r DESC) AS top FROM p)
SELECT page_id, n AS payload_bytes, {digits} AS payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN top END AS refers_to FROM d"""


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": _quality_sql(), "op5_ngram_jaccard": _near_join_sql(), "op4_url_filters": rules_sql(), "op7_decontamination": _decontaminate_sql(),
            "op13_warc": _warc_sql()}
