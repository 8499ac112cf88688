"""DuckDB SQL of the queries that SQL can express; the others are held to brute force in tests/llm.

The recipe is written out here on purpose: the SQL shares no constant with the operator.
"""

_MIXING = r"""
WITH rows AS (
  SELECT doc_id, coalesce(source, 'none') AS source, coalesce(lang, 'und') AS lang,
         CASE WHEN source IN ('src0','src1','src2','src3','src4') THEN 'web'
              WHEN source IN ('src5','src6','src7','src8','src9') THEN 'news'
              WHEN source IN ('src10','src11','src12','src13','src14') THEN 'books'
              WHEN source IN ('src15','src16','src17','src18','src19') THEN 'reference'
              ELSE 'other' END AS domain,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens
  FROM documents),
leaves AS (
  SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, 2 * sum(tokens)::HUGEINT AS cap
  FROM rows GROUP BY ALL HAVING sum(tokens) > 0),
d0 AS (
  SELECT domain, sum(cap) AS cap, CASE domain WHEN 'web' THEN 50 WHEN 'news' THEN 20 WHEN 'books' THEN 20 WHEN 'reference' THEN 10 ELSE 5 END AS w,
         ((SELECT sum(tokens) FROM leaves) * 3) // 4 AS b
  FROM leaves GROUP BY domain),
d1 AS (
  SELECT *, cap * sum(w) OVER (ORDER BY cap::DOUBLE / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= w * (b - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
  FROM d0),
d AS (
  SELECT domain, CASE WHEN filled THEN cap ELSE (w * (b - coalesce(sum(cap) FILTER (filled) OVER (), 0))) // sum(w) FILTER (NOT filled) OVER () END AS give
  FROM d1),
l0 AS (
  SELECT leaves.domain, lang, sum(cap) AS cap, CASE lang WHEN 'en' THEN 40 WHEN 'de' THEN 20 WHEN 'fr' THEN 20 WHEN 'es' THEN 20 ELSE 5 END AS w, any_value(d.give) AS b
  FROM leaves JOIN d USING (domain) GROUP BY leaves.domain, lang),
l1 AS (
  SELECT *, cap * sum(w) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= w * (b - coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
  FROM l0),
l AS (
  SELECT domain, lang, CASE WHEN filled THEN cap ELSE (w * (b - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY domain), 0)))
         // sum(w) FILTER (NOT filled) OVER (PARTITION BY domain) END AS give
  FROM l1),
s0 AS (SELECT leaves.*, 10 AS w, l.give AS b FROM leaves JOIN l USING (domain, lang)),
s1 AS (
  SELECT *, cap * sum(w) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= w * (b - coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
  FROM s0),
s AS (
  SELECT domain, lang, source, tokens AS held,
         CASE WHEN filled THEN cap ELSE (w * (b - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY domain, lang), 0)))
         // sum(w) FILTER (NOT filled) OVER (PARTITION BY domain, lang) END AS give
  FROM s1),
plan AS (SELECT domain, lang, source, (give // held)::INTEGER AS whole, give % held AS rest FROM s),
placed AS (
  SELECT *, md5('17|' || (whole + 1)::VARCHAR || '|' || coalesce(doc_id::VARCHAR, 'null'))[1:15] AS place
  FROM rows JOIN plan USING (domain, lang, source)),
summed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place RANGE UNBOUNDED PRECEDING)
            - sum(tokens) OVER (PARTITION BY domain, lang, source, place) AS before
  FROM placed),
cut AS (
  SELECT domain, lang, source, max(place) AS last FROM summed WHERE before < rest AND rest > 0 AND tokens > 0 GROUP BY ALL),
chosen AS (
  SELECT summed.*, cut.last, whole + (cut.last IS NOT NULL AND place <= cut.last)::INTEGER AS times
  FROM summed LEFT JOIN cut USING (domain, lang, source)),
epochs AS (SELECT *, unnest(range(1, times + 1))::INTEGER AS epoch FROM chosen WHERE times > 0)
SELECT doc_id, domain, lang, source, epoch, tokens,
       CASE WHEN epoch > whole AND place = last THEN least(tokens, rest - before)::BIGINT ELSE tokens END AS taken
FROM epochs
"""

_TRIE = r"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT DISTINCT c, c - c % 20 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
               lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 4 AS h
  FROM turns),
rebuilt AS (
  SELECT heads.c, i, role, text FROM heads JOIN turns ON turns.c = base AND i <= h
  UNION ALL
  SELECT heads.c, i - h + (SELECT count(*) FROM turns t WHERE t.c = base AND t.i <= h), role, text FROM heads JOIN turns ON turns.c = heads.c AND i > h),
paths AS (
  SELECT heads.c, coalesce(list({r: role, t: text} ORDER BY i) FILTER (i IS NOT NULL), []) AS path
  FROM heads LEFT JOIN rebuilt ON rebuilt.c = heads.c GROUP BY heads.c),
prefixes AS (SELECT c, len(path) AS size, d, path[1:d] AS node FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)),
nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d), '')) AS ends,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d].t, '[^\x20\x09-\x0D]+')) END AS words
  FROM prefixes GROUP BY node, d),
kids AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
shown AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS children FROM nodes LEFT JOIN kids USING (node)),
up AS (SELECT node[1:k] AS node, sum((n - 1) * words) AS saved, count(*) FILTER (children = 0) AS leaves
       FROM (SELECT *, unnest(range(d + 1)) AS k FROM shown) GROUP BY 1)
SELECT x.conv_id, x.d::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, x.children AS n_children, up.leaves::BIGINT AS n_leaves,
       up.saved::BIGINT AS saved_tokens, x.ends AS ends_sha256
FROM shown x JOIN up USING (node) LEFT JOIN nodes p ON x.d > 0 AND p.node = x.node[1:x.d - 1]
"""

_SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
summed AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT,
           flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda s: CASE WHEN ord(s) < 128 THEN [ord(s)::BIGINT] ELSE [195::BIGINT, ord(s)::BIGINT - 64] END))),
           lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) AS h
  FROM summed),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
cut AS (SELECT word, n, k, word[:k - 1] || word[k + 1:] AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS k FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT cut.word, words.word, words.n FROM cut JOIN words ON words.word = cut.rest
  UNION
  SELECT words.word, cut.word, cut.n FROM cut JOIN words ON words.word = cut.rest),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * words.n THEN other END AS form, CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
way AS (
  SELECT word, form, word AS root FROM forms
  UNION
  SELECT way.word, forms.form, forms.word FROM way JOIN forms ON forms.word = way.form)
SELECT forms.word, forms.form, way.root, n, n_near, form_n FROM forms JOIN way ON way.word = forms.word AND way.form IS NULL
"""

ORACLE_SQL: dict[str, str] = {"op8_mixing": _MIXING, "op11_prefix_trie": _TRIE, "op13_spelling": _SPELLING}
