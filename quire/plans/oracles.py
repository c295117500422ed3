"""SQL for the queries of rules.py, and for those of catalog.py that sequential rules decide."""

from __future__ import annotations

from ..functions import text as T
from . import catalog as C
from . import rules as R

STRIP = r"regexp_replace(regexp_replace({}, '^\s+', ''), '\s+$', '')"
RTRIM = r"regexp_replace({}, '\s+$', '')"


def lines(of: str, key: str = "doc_id") -> str:
    """CTE l(key, i, line, s) of the table of."""
    return f"l AS (SELECT *, {STRIP.format('line')} AS s FROM (SELECT {key}, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM {of}))"


def given(text: str) -> str:
    return f"t AS (SELECT doc_id, source, {text} AS text FROM documents)"


NUMBERED = "numbered AS (SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents)"
STRUCTURAL = r"^$|^<!-- Page|^#|^>|^- |^\* |^\||^[0-9]+[.)]\s|^```|^---|^\*\*\*|^[A-Z][A-Z\s]{5,}$"
ROMAN = r"(?i)^m{0,4}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$"
WORDS = "[" + ", ".join(f"'{w}'" for w in T.CAPS_WORDS) + "]"
MARKS = "[●•◆▪▸►‣⬥]"


def paragraphs(text: str) -> str:
    joined = f"""CASE WHEN regexp_matches({RTRIM.format('a.cur')}, '[.!?"”]$') AND regexp_matches({STRIP.format('x.cur')}, '^\\p{{Lu}}') AND length({RTRIM.format('a.cur')}) > 40
 THEN {{'done': a.done || a.cur || chr(10), 'cur': x.cur}}
 WHEN right({RTRIM.format('a.cur')}, 1) = '-' AND regexp_matches({STRIP.format('x.cur')}, '^\\p{{Ll}}') THEN {{'done': a.done, 'cur': left({RTRIM.format('a.cur')}, length({RTRIM.format('a.cur')}) - 1) || {STRIP.format('x.cur')}}}
 ELSE {{'done': a.done, 'cur': {RTRIM.format('a.cur')} || ' ' || {STRIP.format('x.cur')}}} END"""
    return rf"""WITH {given(text)},
f AS (SELECT doc_id, text, regexp_extract(text, '(?s)\A[^\S\n]*---[^\S\n]*(?:\n.*?)??\n[^\S\n]*---[^\S\n]*(?:\n|\z)') AS front FROM t),
b AS (SELECT doc_id, front, substr(text, length(front) + 1) AS text FROM f),
{lines('b', 'doc_id, front')},
k AS (SELECT *, regexp_matches(s, '{STRUCTURAL}') AS st, regexp_matches(s, '{STRUCTURAL}') AND NOT regexp_matches(line, '^\s*(?:[-*]\s|[0-9]+[.)]\s)') AS al FROM l),
n AS (SELECT *, sum(CASE WHEN st OR coalesce(pal, true) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (SELECT *, lag(al) OVER (PARTITION BY doc_id ORDER BY i) AS pal FROM k)),
g AS (SELECT doc_id, front, g, list_reduce(list({{'done': '', 'cur': line}} ORDER BY i), lambda a, x: {joined}) AS r FROM n GROUP BY doc_id, front, g)
SELECT doc_id, md5(front || string_agg(r.done || r.cur, chr(10) ORDER BY g)) AS text_md5 FROM g GROUP BY doc_id, front"""


PAGES = rf"""pg AS (SELECT source AS book_id, n AS page_pdf, (CASE n % 4 WHEN 0 THEN n || ' ' || upper(source) || ' TALES' WHEN 1 THEN upper(source) || ' TALES ' || n WHEN 2 THEN upper(source) || ' TALES' ELSE '' END) || chr(10) || text
 || (CASE n % 4 WHEN 2 THEN chr(10) || n WHEN 3 THEN chr(10) || n || chr(10) || (n + 1) ELSE '' END) AS text FROM numbered)"""


def banded(pages: str) -> str:
    """Lines of pages with whether they are numbers, their ranks from either end, and what stands beside a number at either end."""
    return rf"""{lines(pages, 'book_id, page_pdf')},
q AS (SELECT *, (regexp_full_match(s, '[0-9]{{1,4}}') AND regexp_matches(s, '[1-9]')) OR (s <> '' AND regexp_matches(s, '{ROMAN}')) AS bare,
 CASE WHEN s <> '' THEN count(*) FILTER (WHERE s <> '') OVER (PARTITION BY book_id, page_pdf ORDER BY i) END AS h, CASE WHEN s <> '' THEN count(*) FILTER (WHERE s <> '') OVER (PARTITION BY book_id, page_pdf ORDER BY i DESC) END AS f FROM l)"""


MARKER = rf"""WITH {NUMBERED}, {PAGES}, {banded('pg')},
c AS (SELECT *, NOT bare AND NOT contains(s, '|') AND NOT regexp_matches(s, '^(#{{1,6}}\s|>|!\[)') AS can,
 regexp_extract(s, '^([0-9]{{1,4}})\s+(\S.*)$', 1) AS lf, regexp_extract(s, '^([0-9]{{1,4}})\s+(\S.*)$', 2) AS lr, regexp_extract(s, '^(.*\S)\s+([0-9]{{1,4}})$', 2) AS tf, regexp_extract(s, '^(.*\S)\s+([0-9]{{1,4}})$', 1) AS tr FROM q),
d AS (SELECT * REPLACE (CASE WHEN can AND regexp_matches(lf, '[1-9]') AND regexp_matches(lr, '\p{{L}}') THEN lr END AS lr, CASE WHEN can AND regexp_matches(tf, '[1-9]') AND regexp_matches(tr, '\p{{L}}') THEN tr END AS tr) FROM c),
e AS (SELECT book_id, page_pdf, 'h' AS band, unnest([s, lr, tr]) AS line FROM d WHERE h <= 3 AND NOT bare UNION ALL SELECT book_id, page_pdf, 'f', unnest([s, lr, tr]) FROM d WHERE f <= 3 AND NOT bare),
kn AS (SELECT book_id, band, line FROM e WHERE line IS NOT NULL GROUP BY ALL HAVING count(DISTINCT page_pdf) >= 3),
hs AS (SELECT book_id, list(line) FILTER (WHERE band = 'h') AS hl, list(line) FILTER (WHERE band = 'f') AS fl FROM kn GROUP BY book_id),
j AS (SELECT d.*, s <> '' AND list_contains(coalesce(hl, []), s) AS kh, s <> '' AND list_contains(coalesce(fl, []), s) AS kf,
 lr IS NOT NULL AND list_contains(coalesce(hl, []), lr) AS lh, tr IS NOT NULL AND list_contains(coalesce(hl, []), tr) AS th, lr IS NOT NULL AND list_contains(coalesce(fl, []), lr) AS lff, tr IS NOT NULL AND list_contains(coalesce(fl, []), tr) AS tff FROM d LEFT JOIN hs USING (book_id)),
a AS (SELECT *, CASE WHEN h <= 3 AND NOT kh AND lh <> th THEN CASE WHEN lh THEN lf ELSE tf END END AS fh, CASE WHEN f <= 3 AND NOT kf AND lff <> tff THEN CASE WHEN lff THEN lf ELSE tf END END AS ff FROM j),
pr AS (SELECT book_id, page_pdf, coalesce(CASE WHEN count(*) FILTER (WHERE bare) <= 1 THEN coalesce(arg_min(s, i) FILTER (WHERE bare AND h <= 3), arg_min(s, i) FILTER (WHERE bare AND f <= 3)) END, arg_min(fh, i) FILTER (WHERE fh IS NOT NULL), arg_min(ff, i) FILTER (WHERE ff IS NOT NULL)) AS page_printed FROM a GROUP BY book_id, page_pdf),
o AS (SELECT *, NOT regexp_matches(s, '^#{{1,6}}\s') AND (bare OR kh OR fh IS NOT NULL) AND coalesce(h <= 3, false) AS oh, NOT regexp_matches(s, '^#{{1,6}}\s') AND (bare OR kf OR ff IS NOT NULL) AND coalesce(f <= 3, false) AS o2 FROM a),
w AS (SELECT *, sum(CASE WHEN s = '' OR oh THEN 0 ELSE 1 END) OVER u AS sh, sum(CASE WHEN s <> '' AND oh THEN 1 ELSE 0 END) OVER u AS nh, sum(CASE WHEN s = '' OR o2 THEN 0 ELSE 1 END) OVER v AS sf, sum(CASE WHEN s <> '' AND o2 THEN 1 ELSE 0 END) OVER v AS nf FROM o
 WINDOW u AS (PARTITION BY book_id, page_pdf ORDER BY i), v AS (PARTITION BY book_id, page_pdf ORDER BY i DESC)),
bd AS (SELECT book_id, page_pdf, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT (sh = 0 AND (s <> '' OR nh < 3)) AND NOT (sf = 0 AND (s <> '' OR nf < 3))) AS body FROM w GROUP BY book_id, page_pdf)
SELECT book_id, page_pdf, page_printed, md5(regexp_replace(coalesce(body, ''), '\A\n+|\n+\z', '', 'g')) AS body_md5 FROM bd JOIN pr USING (book_id, page_pdf)"""

TITLE = "CASE WHEN coalesce(try_cast(substr(source, 4) AS INT), 0) % 2 = 1 AND n % 2 = 0 THEN 'p. ' || n ELSE 'Chapter ' || n || ': ' || regexp_extract(text, '^([A-Za-z]+ [A-Za-z]+)', 1) END"
BOOKMARKS = f"{NUMBERED}, bm AS (SELECT source AS book_id, n AS ord, 1 + n % 2 AS level, {STRIP.format(TITLE)} AS title, CASE WHEN n % 5 = 0 THEN 0 ELSE n END AS page_pdf FROM numbered WHERE n % 3 = 1)"
USEFUL = r"us AS (SELECT book_id, count(*) FILTER (WHERE page_pdf > 0) > 0 AND 2 * count(*) FILTER (WHERE regexp_matches(title, '(?i)^(?:p\.?\s*)?[0-9]+\s*$')) <= count(*) AS useful FROM bm GROUP BY book_id)"

SQL_WORDS = """al AS (SELECT source AS book_id, doc_id, unnest(w) AS text, unnest(range(len(w))) AS k FROM (SELECT source, doc_id, list_filter(regexp_split_to_array(text, '[ \\n]'), lambda x: x <> '') AS w FROM documents)),
tk AS (SELECT book_id, doc_id * 1000001 + k // 288 AS page_pdf, k % 288 AS i, text FROM al),
w AS (SELECT book_id, page_pdf, i, text, page_pdf % 2 = 0 AS two, CASE WHEN page_pdf % 2 = 0 THEN 72.0 + (i % 3) * 75 + (CASE WHEN i >= 144 THEN 245 ELSE 0 END) ELSE 72.0 + (i % 6) * 78 END::DOUBLE AS x0,
 CASE WHEN page_pdf % 2 = 0 THEN 72.0 + floor((i % 144) / 3) * 13 + (i % 3) * 0.5 ELSE 72.0 + floor(i / 6) * 13 + (i % 2) * 0.5 END::DOUBLE AS y FROM tk),
sp AS (SELECT *, x0 + CASE WHEN two THEN 70.0 ELSE 76.0 END AS x1 FROM w),
r0 AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY book_id, page_pdf ORDER BY y, x0) <= 3 THEN 0 ELSE 1 END AS b FROM sp),
r AS (SELECT *, sum(b) OVER (PARTITION BY book_id, page_pdf ORDER BY y, x0) AS row FROM r0),
ct AS (SELECT book_id, page_pdf, count(*) AS n_words, max(row) AS n FROM r GROUP BY ALL),
xs AS (SELECT book_id, page_pdf, k, 612.0::DOUBLE / 2 - 612.0::DOUBLE * 0.15 + 2.0 * k AS x FROM ct, range(92) t(k)),
hit AS (SELECT DISTINCT xs.book_id, xs.page_pdf, k, row FROM xs JOIN r ON xs.book_id = r.book_id AND xs.page_pdf = r.page_pdf AND r.x0 < x AND x < r.x1),
fr AS (SELECT xs.book_id, xs.page_pdf, xs.k, any_value(x) AS x, any_value(n) - count(hit.row) AS free, any_value(n) AS n, any_value(n_words) AS n_words FROM xs JOIN ct USING (book_id, page_pdf) LEFT JOIN hit ON hit.book_id = xs.book_id AND hit.page_pdf = xs.page_pdf AND hit.k = xs.k GROUP BY xs.book_id, xs.page_pdf, xs.k),
be AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id, page_pdf ORDER BY free DESC, k) AS o FROM fr) WHERE o = 1),
iv AS (SELECT r.book_id, r.page_pdf, row, r.x0, max(r.x1) OVER (PARTITION BY r.book_id, r.page_pdf, row ORDER BY r.x0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach, r.x1, be.x FROM r JOIN be USING (book_id, page_pdf)),
rw AS (SELECT book_id, page_pdf, row, bool_or(coalesce(reach < x AND x0 > x AND x0 - reach >= 6, false)) AS g, bool_and(x1 < x - 2) AS lo, bool_and(x0 > x + 2) AS ro, bool_or(x1 < x - 2) AS la, bool_or(x0 > x + 2) AS ra FROM iv GROUP BY ALL),
cn AS (SELECT book_id, page_pdf, count(*) FILTER (WHERE g) AS g, count(*) FILTER (WHERE lo) AS lo, count(*) FILTER (WHERE ro) AS ro, greatest(count(*) FILTER (WHERE la), count(*) FILTER (WHERE ra)) AS wide FROM rw GROUP BY ALL),
gt AS (SELECT book_id, page_pdf, CASE WHEN n_words >= 30 AND n >= 8 AND free >= 0.75 * n AND ((g >= 6 AND g >= 0.2 * n) OR (lo >= 5 AND ro >= 5 AND lo >= 0.15 * n AND ro >= 0.15 * n) OR (g >= 5 AND wide >= 20) OR (lo >= 3 AND ro >= 3 AND wide >= 25 AND g + least(lo, ro) >= 5)) THEN x END AS gutter FROM be JOIN cn USING (book_id, page_pdf))"""

REFS = r"""ref AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS ref_no, alt, regexp_replace(regexp_replace(trim(inn), '\s+("[^"]*"|''[^'']*'')$', ''), '^<([^>]*)>.*$', '\1') AS target, i + 1 AS line FROM
 (SELECT doc_id, i, unnest(regexp_extract_all(line, '!\[([^\]]*)\]\(([^()]*)\)', 1)) AS alt, unnest(regexp_extract_all(line, '!\[([^\]]*)\]\(([^()]*)\)', 2)) AS inn, generate_subscripts(regexp_extract_all(line, '!\[([^\]]*)\]\(([^()]*)\)'), 1) AS j FROM l WHERE contains(line, '!['))),
loc AS (SELECT *, CASE WHEN target <> '' AND NOT regexp_matches(target, '^(//|#)') AND NOT regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]+:') THEN regexp_replace(replace(target, '%20', ' '), '^(\./)+', '') END AS path FROM ref),
fil AS (SELECT doc_id, 'img/a ' || doc_id || '.png' AS path, n_chars AS bytes FROM documents WHERE doc_id % 2 = 0)"""
WITH_REFS = "concat(text, chr(10), '![figure ', doc_id, '](./img/a%20', doc_id, '.png)', chr(10), '![x](https://example.org/a.png \"t\")')"
STRIPPED = """dg AS (SELECT doc_id, target FROM loc LEFT JOIN fil USING (doc_id, path) WHERE path IS NOT NULL AND fil.bytes IS NULL),
sr AS (SELECT t.doc_id, t.text, list(target) FILTER (WHERE target IS NOT NULL) AS g, count(target) AS n_stripped FROM t LEFT JOIN dg USING (doc_id) GROUP BY t.doc_id, t.text)"""
STRIP_TEXT = "list_reduce(list_prepend(text, coalesce(g, [])), lambda a, x: regexp_replace(a, '!\\[[^\\]]*\\]\\(' || regexp_escape(x) || '\\)', '<!-- missing image: ' || x || ' -->', 'g'))"


def words_or_sentinel(stem: str, words: str, to: str, text: str) -> str:
    """A stem and the letters behind it parted, but for whole words: all are marked first, the words' marks are taken back."""
    marked = f"regexp_replace({text}, '\\b{stem}([a-z]+)', '{stem}\x01\\1\x02', 'g')"
    return f"replace(replace(regexp_replace({marked}, '{stem}\x01({words})\x02', '{stem}\\1', 'g'), '{stem}\x01', '{to}'), '\x02', '')"


def spaces(text: str) -> str:
    for stem, words, to in (("off", T.OFF_WORDS, "off "), ("stuff", T.STUFF_WORDS, "stuff "), ("self", T.SELF_WORDS, "self-")):
        text = words_or_sentinel(stem, words, to, text)
    return text


HEAD_SOURCE = "l AS (SELECT doc_id, unnest(string_split(x, chr(10))) AS line, unnest(range(len(string_split(x, chr(10))))) AS i FROM (SELECT doc_id, '# a' || chr(10) || text || chr(10) || '## b' || chr(10) || '```' || chr(10) || '# c' || chr(10) || '```' AS x FROM documents))"

NORMAL = STRIP.format(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '^[0-9]+\s*', ''), '\s*[0-9]+$', ''), '\s*\|\s*[0-9A-Za-z_]*$', ''), '^[0-9A-Za-z_]+\s*\|\s*', '')")
FOLIO = C._DUCK_FOLIO
STREAM = f"""{NUMBERED}, pages AS (SELECT source AS book_id, n AS page_pdf, upper(source) || ' STUDIES' || chr(10) || text || chr(10) || {FOLIO} AS text FROM numbered)"""
FURNITURE = rf"""WITH {STREAM}, {banded('pages')},
e AS (SELECT book_id, 'h' AS kind, {NORMAL} AS key FROM q WHERE h <= 3 UNION ALL SELECT book_id, 'f', {NORMAL} FROM q WHERE f <= 3),
b AS (SELECT book_id, count(*) AS m FROM pages GROUP BY book_id),
k AS (SELECT book_id, kind, key FROM e JOIN b USING (book_id) WHERE length(key) > 3 GROUP BY book_id, kind, key, m HAVING count(*) >= greatest(3, 0.15 * m)),
ks AS (SELECT book_id, list(key) FILTER (WHERE kind = 'h') AS hk, list(key) FILTER (WHERE kind = 'f') AS fk FROM k GROUP BY book_id),
j AS (SELECT q.*, m, coalesce(h <= 3, false) AS top, coalesce(f <= 3, false) AS low, (coalesce(h <= 3, false) AND list_contains(coalesce(hk, []), {NORMAL})) OR (coalesce(f <= 3, false) AND list_contains(coalesce(fk, []), {NORMAL})) AS furn FROM q JOIN b USING (book_id) LEFT JOIN ks USING (book_id)),
x AS (SELECT *, (top OR low) AND (regexp_matches(s, '^[0-9]{{1,4}}$') OR regexp_matches(s, '(?i)^[ivxlc]{{1,7}}$')) AS num, (top OR low) AND regexp_matches(s, '^(?:[0-9]{{1,4}}\s*\|\s*[A-Z].*|[A-Z][A-Z\s'',]+\|\s*[0-9]{{1,4}})$') AS pipe, s <> '' AND regexp_matches(s, '{ROMAN}') AS rom FROM j),
ro AS (SELECT book_id, count(DISTINCT lower(s)) AS n_rom FROM x WHERE num AND NOT furn AND rom GROUP BY book_id),
r AS (SELECT book_id, page_pdf, arg_min(s, (CASE WHEN low THEN 0 ELSE 1 END) * 1000000 + i) FILTER (WHERE num AND NOT furn AND (regexp_matches(s, '^[0-9]+$') OR rom AND coalesce(n_rom, 0) >= 2)) AS page_printed,
 string_agg(CASE WHEN f = 1 THEN regexp_replace(line, '\s+[0-9]{{1,4}}\s*$', '') ELSE line END, chr(10) ORDER BY i) FILTER (WHERE NOT furn AND NOT num AND NOT pipe) AS body, any_value(m) AS m FROM x LEFT JOIN ro USING (book_id) GROUP BY book_id, page_pdf)"""

ORACLES = {
    "folio_capture": f"{FURNITURE} SELECT r.book_id, r.page_pdf, CASE WHEN m >= 5 THEN page_printed END AS page_printed, md5(CASE WHEN m >= 5 THEN coalesce(body, '') ELSE text END) AS body_md5 FROM r JOIN pages USING (book_id, page_pdf)",
    "paginated_recurring": rf"""WITH {STREAM}, {banded('pages')},
b AS (SELECT book_id, page_pdf, 'head' AS band, s FROM q WHERE h <= 3 UNION ALL SELECT book_id, page_pdf, 'foot', s FROM q WHERE f <= 3),
x AS (SELECT book_id, page_pdf, band, unnest([s, regexp_extract(s, '^[0-9]{{1,4}}\s+(\S.*)$', 1), regexp_extract(s, '^(.*\S)\s+[0-9]{{1,4}}$', 1)]) AS line FROM b WHERE NOT regexp_matches(s, '^[0-9]{{1,4}}$'))
SELECT book_id, band, line, count(DISTINCT page_pdf) AS n_pages FROM x WHERE regexp_matches(line, '[A-Za-z]') GROUP BY book_id, band, line HAVING count(DISTINCT page_pdf) >= 3""",
    "spaced_letters": rf"WITH {given(R.SPACED)}, m AS (SELECT doc_id, text, regexp_extract_all(text, '\b[A-Za-z](?:\s{{1,3}}[A-Za-z]){{3,}}\b') AS f FROM t) SELECT doc_id, md5(list_reduce(list_prepend(text, f), lambda a, x: replace(a, x, replace(x, ' ', '')))) AS text_md5 FROM m",
    "joined_caps": rf"""WITH RECURSIVE {given(R.CAPS)}, {lines('t')},
e AS (SELECT *, length(s) <= 80 AND length(regexp_replace(s, '\P{{L}}', '', 'g')) > 0 AND length(regexp_replace(s, '\P{{Lu}}', '', 'g')) >= 0.8 * length(regexp_replace(s, '\P{{L}}', '', 'g')) AS ok FROM l),
p AS (SELECT doc_id, i, ok, unnest(regexp_extract_all(line, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+')) AS p, generate_subscripts(regexp_extract_all(line, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+'), 1) AS j FROM e),
tok AS (SELECT DISTINCT p AS w FROM p WHERE ok AND regexp_full_match(p, '[A-Z]{{6,}}')),
d AS (SELECT DISTINCT unnest({WORDS}) AS k),
seg(w, pos, cuts, parts) AS (SELECT w, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS VARCHAR[]) FROM tok UNION ALL SELECT w, pos + length(k), list_prepend(pos, cuts), list_append(parts, substr(w, pos + 1, length(k))) FROM seg JOIN d ON substr(lower(w), pos + 1, length(k)) = k),
best AS (SELECT w, parts FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY len(parts), cuts) AS o FROM seg WHERE pos = length(w)) WHERE o = 1 AND len(parts) >= 2 AND len(list_filter(parts, lambda x: length(x) = 1)) <= 1),
g AS (SELECT doc_id, i, string_agg(CASE WHEN ok AND parts IS NOT NULL THEN array_to_string(parts, ' ') ELSE p END, '' ORDER BY j) AS line FROM p LEFT JOIN best ON p = w GROUP BY doc_id, i)
SELECT l.doc_id, md5(string_agg(coalesce(g.line, ''), chr(10) ORDER BY l.i)) AS text_md5 FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id""",
    "bullets": rf"""WITH {given(R.BULLETS)}, {lines('t')},
k AS (SELECT *, list_filter(list_transform(regexp_split_to_array(line, '{MARKS}'), lambda y: {STRIP.format('y')}), lambda y: y <> '') AS items, len(regexp_extract_all(line, '{MARKS}')) AS n FROM l),
j AS (SELECT doc_id, string_agg(CASE WHEN n >= 2 AND len(items) >= 2 THEN '- ' || array_to_string(items, chr(10) || '- ') ELSE line END, chr(10) ORDER BY i) AS text FROM k GROUP BY doc_id)
SELECT doc_id, md5(regexp_replace(text, '(?m)^(\s*){MARKS}\s*', '\1- ', 'g')) AS text_md5 FROM j""",
    "contents_lines": rf"""WITH {given(R.CONTENTS)}, {lines('t')},
k AS (SELECT *, list_filter(list_transform(string_split(regexp_replace(s, '(\s)([ivxlc]+|[0-9]{{1,3}})(\s+[A-Z]|\s*$)', '\1\2' || chr(1) || '\3', 'g'), chr(1)), lambda y: regexp_extract(y, '([A-Z][A-Za-z\s'':,\-]+?\s+(?:[ivxlc]+|[0-9]{{1,3}}))$', 1)), lambda y: y <> '') AS items, len(regexp_extract_all(s, '[A-Z][A-Za-z\s'':,\-]+?\s+(?:[ivxlc]+|[0-9]{{1,3}})')) AS n FROM l)
SELECT doc_id, md5(string_agg(CASE WHEN length(s) > 60 AND n >= 3 AND len(items) >= 3 THEN array_to_string(list_transform(items, lambda y: '- ' || regexp_replace(y, '\s+(\S+)$', ' ... \1')), chr(10)) ELSE line END, chr(10) ORDER BY i)) AS text_md5 FROM k GROUP BY doc_id""",
    "front_matter": paragraphs(R.FRONT),
    "paragraphs": paragraphs("text"),
    "marker_folios": MARKER,
    "useful_contents": f"WITH {BOOKMARKS}, {USEFUL} SELECT * FROM us",
    "render_contents": rf"""WITH {BOOKMARKS}, {USEFUL}
SELECT book_id, '## Table of Contents' || chr(10) || chr(10) || string_agg(repeat('  ', level - 1) || '- ' || title || ' (p. ' || page_pdf || ')', chr(10) ORDER BY ord) || chr(10) AS contents
FROM bm JOIN us USING (book_id) WHERE useful AND title <> '' AND page_pdf > 0 AND NOT regexp_matches(title, '(?i)^(?:p\.?\s*)?[0-9]+\s*$') GROUP BY book_id""",
    "broken_contents": rf"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Contents' || chr(10) || 'One ..... 1' || chr(10) || '- Two ... 2' || chr(10) || 'Figure 3' || chr(10) || '- Table . 4' || chr(10) || 'words that stay' ELSE 'One ..... 1' || chr(10) || text END AS text FROM documents), {lines('t')}
SELECT doc_id, count(*) FILTER (WHERE s <> '') >= 5 AND 2 * count(*) FILTER (WHERE regexp_matches(s, '^(?:-\s+)?.+?\s+(?:\.{{2,}}|…)\s*[0-9]+\s*$') OR regexp_matches(s, '(?i)^-\s+(?:Figure|Table|Chapter|Part|Section)\s*\.*\s*[0-9]+\s*$') OR regexp_matches(s, '(?i)^-?\s*(?:Figure|Table|Chapter|Part|Section)\s+[0-9]+\s*$')) >= count(*) FILTER (WHERE s <> '') AS is_contents FROM l GROUP BY doc_id""",
    "bookmark_headings": rf"""WITH {NUMBERED},
p AS (SELECT source AS book_id, n AS page_pdf, text, regexp_extract(text, '^([A-Za-z]+ [A-Za-z]+)', 1) AS m, split_part(text, chr(10), 1) AS l1,
 n % 3 = 1 AND n % 5 <> 0 AND NOT (coalesce(try_cast(substr(source, 4) AS INT), 0) % 2 = 1 AND n % 2 = 0) AS marked FROM numbered),
k AS (SELECT *, marked AND m <> '' AND length(replace(m, ' ', '')) >= 4 AND NOT regexp_matches(substr(l1, length(m) + 1), '^[\p{{L}}\p{{N}}]') AS ok, regexp_replace(regexp_replace(substr({RTRIM.format('l1')}, length(m) + 1), '^[ \t.,:;\-]+', ''), '\s+$', '') AS rest FROM p)
SELECT book_id, page_pdf, ok AS promoted, md5(CASE WHEN ok THEN '## ' || m || CASE WHEN rest <> '' THEN chr(10) || chr(10) || rest ELSE '' END || substr(text, length(l1) + 1) ELSE text END) AS text_md5 FROM k""",
    "gutters": f"WITH {SQL_WORDS} SELECT book_id, page_pdf, gutter FROM gt",
    "column_text": f"""WITH {SQL_WORDS},
ln AS (SELECT r.book_id, r.page_pdf, x0 >= gutter AS side, row, string_agg(text, ' ' ORDER BY round_even(y, 0), x0) AS line FROM r JOIN gt USING (book_id, page_pdf) WHERE gutter IS NOT NULL GROUP BY ALL),
co AS (SELECT book_id, page_pdf, side, string_agg(line, chr(10) ORDER BY row) AS text FROM ln GROUP BY ALL),
two AS (SELECT book_id, page_pdf, true AS two_columns, string_agg(text, chr(10) || chr(10) ORDER BY side) || chr(10) AS text FROM co GROUP BY book_id, page_pdf),
one AS (SELECT r.book_id, r.page_pdf, false AS two_columns, string_agg(text, chr(10) ORDER BY round_even(y, 0), x0, text) || chr(10) AS text FROM r JOIN gt USING (book_id, page_pdf) WHERE gutter IS NULL GROUP BY r.book_id, r.page_pdf)
SELECT book_id, page_pdf, two_columns, md5(text) AS text_md5 FROM (SELECT * FROM two UNION ALL SELECT * FROM one)""",
    "table_grids": r"""WITH t AS (SELECT source, doc_id, regexp_extract_all(text, '[^ \t\n\r\f]+') AS w FROM documents),
k AS (SELECT source, doc_id, w, unnest(range(0, CAST(ceil(len(w) / 52.0) * 52 AS BIGINT))) AS k FROM t),
x AS (SELECT source AS book_id, doc_id * 1000001 + k // 52 AS page_pdf, k % 52 // 13 AS g, k % 13 AS m, 'c' || replace(coalesce(w[k + 1], ''), '|', '\|') AS t FROM k),
y AS (SELECT book_id, page_pdf, g, least(m // 4, 2) AS r, CASE WHEN m = 12 THEN 1 ELSE m % 4 END AS c, string_agg(t, ' ' ORDER BY m) AS t FROM x GROUP BY ALL),
l AS (SELECT book_id, page_pdf, g * 3 + r AS r, '| ' || string_agg(t, ' | ' ORDER BY c) || ' |' AS line FROM y GROUP BY ALL),
b AS (SELECT book_id, page_pdf, string_agg(CASE WHEN r = 0 THEN line || chr(10) || '|---|---|---|---|' ELSE line END, chr(10) ORDER BY r) AS body FROM l GROUP BY ALL)
SELECT book_id, page_pdf, CAST(100 AS DOUBLE) AS start_y, CAST(354 AS DOUBLE) AS end_y,
'**TABLE ' || (page_pdf % 9 + 1) || CASE WHEN page_pdf % 2 = 0 THEN ' — Figures of the year' ELSE '' END || '**' || chr(10) || chr(10) || body AS markdown FROM b""",
    "nav_page_entries": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
k AS (SELECT *, regexp_extract(x, '[A-Za-z]+') AS a, regexp_extract(x, '^[A-Za-z]+ ([A-Za-z]+)', 1) AS b FROM l WHERE regexp_matches(x, '[A-Za-z]')),
s AS (SELECT *, sum(CASE WHEN i % 3 = 1 THEN 1 ELSE 0 END) OVER w AS opened, coalesce(sum(CASE WHEN i % 3 = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS closed FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
d AS (SELECT *, opened - closed + 1 AS total, least(0, min(opened - closed + 1 - CASE WHEN i % 3 = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i)) AS low FROM s)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS ord, greatest(1, total - low) AS depth, trim(a || ' & ' || b) AS label,
CASE WHEN i % 2 = 0 THEN 'd' || doc_id || '.xhtml' ELSE 'OEBPS/e ' || doc_id || '.xhtml' END AS doc, CASE WHEN i % 2 = 0 THEN 'l' || i END AS anchor FROM d""",
    "planned_headings": r"""WITH l AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
c AS (SELECT *, trim(regexp_replace(x, '[^A-Za-z0-9 ]+', '', 'g')) AS own, regexp_replace(x, '[&<>]', '', 'g') AS plain, min(CASE WHEN i % 2 = 1 THEN 2 + (i // 2) % 2 END) OVER (PARTITION BY source) AS least FROM l),
h AS (SELECT *, i % 4 = 1 OR (i % 4 = 3 AND own <> '') AS headed, 'h' || (3 + (i // 2) % 2 - least) AS tag FROM c),
p AS (SELECT *, '<p id="l' || i || '">' || CASE i % 4 WHEN 3 THEN own WHEN 1 THEN '<a id="a' || i || '"/>' || plain ELSE plain END || '</p>' AS para FROM h),
m AS (SELECT source, doc_id, count(*) FILTER (WHERE headed) AS n, string_agg(CASE WHEN headed AND i % 4 = 3 THEN '<' || tag || '>' || upper(own) || '</' || tag || '>' WHEN headed THEN '<' || tag || '>Part ' || i || '</' || tag || '>' || para ELSE para END, '' ORDER BY i) AS body FROM p GROUP BY source, doc_id),
s AS (SELECT source FROM m GROUP BY source HAVING sum(n) > 0)
SELECT m.source AS book_id, 'd' || doc_id AS name, n AS n_injected, CASE WHEN s.source IS NULL THEN NULL ELSE 'nav' END AS heading_source, md5('<body>' || body || '</body>') AS markup_md5 FROM m LEFT JOIN s ON m.source = s.source""",
    "text_gates": rf"""WITH d AS (SELECT source, CASE WHEN coalesce(try_cast(substr(source, 4) AS INT), 0) % 5 = 0 AND doc_id % 20 <> 0 THEN '' ELSE text END AS text FROM documents),
p AS (SELECT source, text, regexp_replace(regexp_replace(text, '(?s)<!--.*?-->|[#*_`|]+', ' ', 'g'), '(?m)^-{{3,}}$', ' ', 'g') AS b FROM d),
s AS (SELECT source, count(*) AS total, count(*) FILTER (WHERE regexp_matches(text, '\S')) AS with_text, min(CASE WHEN length(b) < 500 THEN 1.0 ELSE greatest(0.0, 1 - (len(regexp_extract_all(b, '(?i)[a-z][0-9][a-z]')) + len(regexp_extract_all(b, '(?i)[a-z]vv[a-z]'))) * 10000.0::DOUBLE / length(b) / 2) END) AS score FROM p GROUP BY source)
SELECT source, total, with_text, CASE WHEN with_text < 0.1 * total THEN 'scanned' WHEN score < 0.5 THEN 'low quality' ELSE 'ok' END AS status FROM s""",
    "finalized_assets": rf"""WITH t AS (SELECT doc_id, concat(text, chr(10), '![a](./img/a%20', doc_id, '.png) ![b](b.png)') AS text FROM documents), {lines('t')}, {REFS}, {STRIPPED},
n AS (SELECT doc_id, count(*) AS n_refs FROM ref GROUP BY doc_id)
SELECT doc_id, n_refs, n_stripped, CAST(0 AS BIGINT) AS n_dangling, CASE WHEN n_stripped > 0 THEN n_stripped || ' reference(s) to missing images were taken out' END AS warning, md5({STRIP_TEXT}) AS text_md5 FROM sr JOIN n USING (doc_id)""",
    "image_refs": f"WITH t AS (SELECT doc_id, {WITH_REFS} AS text FROM documents), {lines('t')}, {REFS} SELECT doc_id, ref_no, alt, target, line FROM ref",
    "dangling_refs": f"WITH t AS (SELECT doc_id, {WITH_REFS} AS text FROM documents), {lines('t')}, {REFS} SELECT doc_id, ref_no, target, line FROM loc LEFT JOIN fil USING (doc_id, path) WHERE path IS NOT NULL AND bytes IS NULL",
    "strip_dangling": f"WITH t AS (SELECT doc_id, {WITH_REFS} AS text FROM documents), {lines('t')}, {REFS}, {STRIPPED} SELECT doc_id, n_stripped, md5({STRIP_TEXT}) AS text_md5 FROM sr",
    "asset_manifest": f"WITH t AS (SELECT doc_id, {WITH_REFS} AS text FROM documents), {lines('t')}, {REFS} SELECT fil.doc_id, fil.path, any_value(bytes) AS bytes, CAST(count(target) AS INTEGER) AS n_references FROM fil LEFT JOIN loc USING (doc_id, path) GROUP BY fil.doc_id, fil.path",
    "asof_events": "SELECT l.event_id, l.user_id, r.event_id AS before_id FROM (SELECT * FROM events WHERE event_id % 2 = 0) l ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_id % 2 = 1 GROUP BY user_id, ts) r ON l.user_id = r.user_id AND l.ts >= r.ts",
    "event_hours": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY ALL",
    "clean_title": "SELECT page_id, " + STRIP.format(f"regexp_replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1) || [', 4th Edition', ' V3.1', ' (Second Edition)', ': Revised and Updated'][(page_id % 4 + 1)::INT], '{T.title_marks()}', '')") + " AS title FROM pages",
    "ligatures": r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(text, 'fi', 'ﬁ'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬁ', 'fi'), 'ﬀ', 'ff'), 'ﬂ', 'fl'),
 '([\p{L}\p{N}_]*(?:fi|ff|fl))\s+([a-z]{1,8})($|[^\p{L}\p{N}_])', '\1\2\3', 'g'), '\bTh\s+e\b', 'The', 'g'), '\bth\s+e\b', 'the', 'g'), '\x{AD}\s+', '', 'g')) AS text_md5 FROM documents""",
    "missing_spaces": f"SELECT doc_id, {spaces("'offthe office stuffin selfmade selfish ' || text")} AS text FROM documents",
    "heading_count": rf"""WITH {HEAD_SOURCE}, f AS (SELECT *, regexp_matches(line, '^\s*```') AS fence FROM l),
g AS (SELECT *, sum(fence::INT) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM f)
SELECT doc_id, CAST(count(*) FILTER (WHERE NOT fence AND n % 2 = 0 AND regexp_matches(line, '^#{{1,6}}\s+\S')) AS INTEGER) AS n_headings FROM g GROUP BY doc_id""",
    "list_pages": rf"""WITH t AS (SELECT doc_id, text FROM documents), {lines('t')},
c AS (SELECT * FROM l WHERE s <> '' AND NOT starts_with(s, '<!-- ')),
n AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE length(s) < 80 AND NOT regexp_matches(s, '[.!?:;]$')) AS short, avg(length(s)) AS mean FROM c GROUP BY doc_id),
o AS (SELECT doc_id, i, lower(substr(s, 1, 1)) AS c FROM c WHERE regexp_matches(s, '^\p{{L}}') AND NOT regexp_matches(s, '^\p{{Ll}}') AND lower(regexp_extract(s, '^([A-Za-z]*)', 1)) NOT IN ('and', 'as', 'at', 'by', 'for', 'from', 'in', 'into', 'of', 'on', 'or', 'the', 'to', 'with', 'vs', 'see')),
p AS (SELECT doc_id, count(*) AS m, count(*) FILTER (WHERE b <= c) AS up FROM (SELECT *, lag(c) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM o) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n >= 10 AND short >= 0.8 * n AND mean < 50 AND ((coalesce(m, 0) >= 8 AND up >= 0.75 * (m - 1)) OR mean < 25), false) AS is_list FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN p ON p.doc_id = d.doc_id""",
    "split_caps": rf"""WITH t AS (SELECT doc_id, 'NOTES ON' || chr(10) || 'SLOW RIVERS' || chr(10) || 'AND TIDES' || chr(10) || text AS text FROM documents), {lines('t')},
c AS (SELECT *, regexp_matches(s, '^[A-Z][A-Z\s:&,\-'']{{0,40}}$') AND length(s) <= 40 AS caps FROM l),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM c WHERE caps),
r AS (SELECT *, sum(length(s) + 1) OVER (PARTITION BY doc_id, island ORDER BY i DESC) AS room FROM g)
SELECT doc_id, CAST(min(i) AS INTEGER) AS line_no, string_agg(s, ' ' ORDER BY i) AS line FROM r WHERE room <= 80 GROUP BY doc_id, island HAVING count(*) > 1""",
    "promote_headings": rf"""WITH t AS (SELECT doc_id, 'CHAPTER 1' || chr(10) || text || chr(10) || chr(10) || 'A LONG HEADING IN CAPITALS' || chr(10) AS text FROM documents), {lines('t')},
m AS (SELECT *, s = '' OR starts_with(s, '<!-- Page') OR starts_with(s, '#') AS mark FROM l),
w AS (SELECT *, coalesce(lag(mark) OVER o, true) OR coalesce(lead(mark) OVER o, true) AS apart FROM m WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
v AS (SELECT *, CASE WHEN mark THEN 0 WHEN regexp_matches(s, '(?i)^(Chapter|Part)\s+([0-9]+|[IVXLC]+)') AND len(regexp_split_to_array(s, '\s+')) <= 10 THEN 2
 WHEN apart AND length(s) < 80 AND regexp_matches(s, '^[A-Z][A-Z\s0-9:,\-&]{{4,79}}$') AND length(regexp_replace(s, '[^A-Za-z]', '', 'g')) > 0.6 * length(s) THEN CASE WHEN length(s) < 20 THEN 3 ELSE 2 END ELSE 0 END AS level FROM w)
SELECT doc_id, CAST(i AS INTEGER) AS line_no, level, repeat('#', level) || ' ' || s AS line FROM v WHERE level > 0""",
}
