"""DuckDB SQL for the queries that SQL can express without hashes or searches."""

from __future__ import annotations

from plinth.llm import quality

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Components of links (a, b), both ways: (a, least) of every linked id.
_REACH = """reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, least(a, min(b)) AS m FROM reach GROUP BY a)"""

OP1 = f"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS MATERIALIZED (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM ok p JOIN ok q ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e) AND list_cosine_similarity(p.e, q.e) >= 0.9),
{_REACH},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(m, vec_id) AS component_id, coalesce(m, vec_id) = vec_id AS kept FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id"""

OP5 = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents),
u AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
x AS (SELECT doc_id, n, i, concat_ws(' ', word, lead(word, 1) OVER q, lead(word, 2) OVER q, lead(word, 3) OVER q, lead(word, 4) OVER q) AS s FROM u WINDOW q AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, s FROM x WHERE i <= greatest(n - 4, 1)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
j AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM s p JOIN s q ON p.s = q.s AND p.doc_id <> q.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM j JOIN c p ON p.doc_id = a JOIN c q ON q.doc_id = b WHERE 100 * j.n >= 85 * (p.n + q.n - j.n)),
{_REACH}
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_shingles, coalesce(m, d.doc_id) AS component_id, coalesce(m, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id"""

#: The characters of each class, by the class's number; what else is ASCII is class 5.
_CHARS = {0: "a-z", 1: "A-Z", 2: "0-9", 3: r"\x20\x09-\x0D", 4: ".,;:!?''\"()\\-", 6: "#*$%&|<>", 7: r"^\x00-\x7F"}


def _kept_chars(k: int) -> str:
    shown = _CHARS[k]
    return f"length(regexp_replace(t, '[{shown[1:] if shown.startswith('^') else '^' + shown}]', '', 'g'))"


def _quality() -> str:
    q = quality
    listed = ", ".join(f"('={lang}', '{word}', {i})" for lang, words in q.COMMON.items() for i, word in enumerate(words.split()[: q.WORD_BINS - 1]))
    langs = ", ".join(f"'={lang}'" for lang in q.COMMON)
    ranks = sum(1 / (i + 1) for i in range(q.WORD_BINS - 1))
    often = [q.PRIOR_LISTED / (i + 1) / ranks for i in range(q.WORD_BINS - 1)] + [1 - q.PRIOR_LISTED]
    others = ", ".join(f"({k}, {q.PRIOR_CHARS * s!r})" for k, s in q.PRIOR_OTHERS.items())
    no_letters = " ".join(f"WHEN {k} THEN {s!r}" for k, s in q.NO_LETTERS.items())
    chars = ", ".join(f"{_kept_chars(k) if k in _CHARS else 'length(t) - ' + ' - '.join(_kept_chars(c) for c in _CHARS)}" for k in range(q.CLASSES))

    def reference(name: str, which: str) -> str:
        return f"""{name}_sum AS (SELECT g, kind, bin, sum(CASE WHEN {which} THEN h.n ELSE 0 END) AS n FROM hist h JOIN base USING (k) WHERE NOT base_failed GROUP BY ALL),
{name}_letters AS (SELECT g, sum(n) AS letters FROM {name}_sum WHERE kind = 'c' AND bin IN (0, 1, 7) GROUP BY g),
{name} AS (SELECT s.g, s.kind, s.bin, s.n + CASE WHEN s.kind = 'w' THEN pw.n WHEN s.bin NOT IN (0, 1, 7) THEN pc.n
  ELSE {q.PRIOR_CHARS} * {q.PRIOR_LETTERS} * CASE WHEN letters > 0 THEN s.n / letters ELSE CASE s.bin {no_letters} END END END AS n
  FROM {name}_sum s JOIN {name}_letters USING (g) LEFT JOIN prior_chars pc ON s.kind = 'c' AND pc.bin = s.bin LEFT JOIN prior_words pw ON s.kind = 'w' AND pw.bin = s.bin)"""

    def apart(name: str, refs: str, least_words: int) -> str:
        return f"""{name}_p AS (SELECT k, kind, h.n / sum(h.n) OVER (PARTITION BY k, kind) AS p, r.n / sum(r.n) OVER (PARTITION BY k, kind) AS q
  FROM hist h JOIN {refs} r USING (g, kind, bin) JOIN base USING (k) WHERE CASE kind WHEN 'c' THEN word_chars >= {q.LEAST_CHARS} ELSE n_words >= {least_words} END),
{name} AS (SELECT k, kind, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d FROM {name}_p GROUP BY k, kind)"""

    return f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce('=' || lang, '') AS g, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d),
u AS (SELECT k, g, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
x AS (SELECT k, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM u WINDOW o AS (PARTITION BY k ORDER BY i)),
y AS (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM x WHERE c IS NOT NULL),
z AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM y WHERE n > 1) GROUP BY k),
counts AS (SELECT w.k, doc_id, g, t, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda s: length(s))), 0) AS BIGINT) AS word_chars,
  CAST({_kept_chars(6)} AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(z.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN z USING (k)),
base AS (SELECT * EXCLUDE (g), n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED} * n_words AS base_failed FROM counts),
chars AS (SELECT k, g, unnest([{chars}]) AS n, unnest(range({q.CLASSES})) AS bin FROM d),
listed(g, word, bin) AS (VALUES {listed}),
hits AS (SELECT k, bin, count(*) AS n FROM u JOIN listed ON listed.g = u.g AND listed.word = trim(translate(u.word, '{_UPPER}', '{_LOWER}'), '.,;:!?"''()') GROUP BY k, bin),
dense AS (SELECT k, g, n_words, unnest(range({q.WORD_BINS})) AS bin FROM counts WHERE g IN ({langs})),
words AS (SELECT dense.k, g, bin, CASE WHEN bin < {q.WORD_BINS - 1} THEN coalesce(hits.n, 0) ELSE n_words - coalesce(sum(hits.n) OVER (PARTITION BY dense.k), 0) END AS n FROM dense LEFT JOIN hits USING (k, bin)),
hist AS (SELECT k, g, 'c' AS kind, bin, n FROM chars UNION ALL SELECT k, g, 'w', bin, n FROM words),
prior_chars(bin, n) AS (VALUES {others}), prior_words AS (SELECT unnest({[q.PRIOR_WORDS * x for x in often]!r}) AS n, unnest(range({q.WORD_BINS})) AS bin),
{reference('first', 'TRUE')},
{apart('one', 'first', q.FIRST_COMMON_WORDS)},
far AS (SELECT DISTINCT k FROM one WHERE d > CASE kind WHEN 'c' THEN {q.FIRST_CHARS_APART} ELSE {q.FIRST_WORDS_APART} END),
{reference('second', 'k NOT IN (SELECT k FROM far)')},
{apart('two', 'second', q.LEAST_COMMON_WORDS)},
v AS (SELECT k, max(CASE WHEN kind = 'c' THEN d END) AS c, max(CASE WHEN kind = 'w' THEN d END) AS w FROM two GROUP BY k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (coalesce(v.c, 0) / {q.MOST_CHARS_APART}) ** 2 + (coalesce(v.w, 0) / {q.MOST_WORDS_APART}) ** 2 <= 1 AS kept,
  round(v.c, 6) AS chars_apart, round(v.w, 6) AS words_apart FROM base LEFT JOIN v USING (k)"""


OP3 = _quality()
