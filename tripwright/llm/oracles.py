"""DuckDB twins of the queries that SQL can express, over the tables as views."""

from __future__ import annotations

from tripwright.llm import collocations, quality_rules, spelling


def _quality_rules() -> str:
    q = quality_rules
    cutoffs = ", ".join(f"('{rule}', {cutoff}::DOUBLE)" for rule, held in q.CUTOFFS.items() for cutoff in held)
    steps = ", ".join(f"({at}, {share}::DOUBLE)" for at, share in enumerate(q.STEPS))
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT r, pos, array_to_string(words[pos:pos + {q.WINDOW - 1}], ' ') AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - {q.WINDOW - 2})) AS pos FROM split)
), twins AS (
  SELECT r, pos FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1
), covered AS (
  SELECT r, sum(least({q.WINDOW}, coalesce(later - pos, {q.WINDOW}))) AS n_repeat_words
  FROM (SELECT r, pos, lead(pos) OVER (PARTITION BY r ORDER BY pos) AS later FROM twins) GROUP BY r
), counted AS (
  SELECT r, doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(text) - length(replace(text, '!', '')) AS n_bangs,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)
), measured AS (
  SELECT *, n_symbols / greatest(n_words, 1) AS symbols_per_word, n_bangs / greatest(n_words, 1) AS bangs_per_word,
    n_capitals / greatest(word_chars, 1) AS capitals_per_char, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
    n_repeat_words / greatest(n_words, 1) AS repeat_share, word_chars / greatest(n_words, 1) AS chars_per_word
  FROM counted
), worst AS (
  SELECT doc_id, min(quality) = 1 AS good FROM labels GROUP BY doc_id HAVING min(quality) IS NOT NULL
), labelled AS (
  SELECT measured.*, good, ('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::BIGINT % {q.FOLDS} = 0 AS proposing
  FROM measured JOIN worst USING (doc_id)
), cutoffs(rule, cutoff) AS (VALUES {cutoffs}), steps(step, share) AS (VALUES {steps}),
proposers AS (SELECT * FROM labelled WHERE proposing AND good),
proposed AS (
  UNPIVOT (SELECT r, {", ".join(q.CUTOFFS)} FROM proposers) ON {", ".join(q.CUTOFFS)} INTO NAME rule VALUE value
), passing AS (
  SELECT rule, cutoff, count(value) FILTER (value > cutoff) AS n FROM cutoffs LEFT JOIN proposed USING (rule) GROUP BY ALL
), path AS (
  SELECT step, rule, min(cutoff) AS cutoff FROM passing, steps, (SELECT count(*) AS total FROM proposers)
  WHERE total > 0 AND n <= share * total GROUP BY ALL
), every AS (
  UNPIVOT (SELECT r, {", ".join(q.CUTOFFS)} FROM measured) ON {", ".join(q.CUTOFFS)} INTO NAME rule VALUE value
), rejecting AS (
  SELECT r, min(step) AS step FROM every JOIN path USING (rule) WHERE value > cutoff GROUP BY r
), holdout AS (
  SELECT lang, good, step FROM labelled LEFT JOIN rejecting USING (r) WHERE NOT proposing
), own AS (
  SELECT lang FROM holdout GROUP BY lang HAVING count(*) FILTER (good) >= {q.LEAST_LABELS}
  ORDER BY count(*) FILTER (good) DESC, lang LIMIT {q.MAX_STRATA}
), held AS (
  SELECT coalesce(own.lang, '{q.POOLED}') AS stratum, good, step FROM holdout LEFT JOIN own ON holdout.lang = own.lang
), tested AS (
  SELECT stratum, steps.step, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad,
    count(*) FILTER (good AND held.step <= steps.step) AS good_out,
    count(*) FILTER (NOT good AND held.step <= steps.step) AS bad_out
  FROM held, steps WHERE steps.step IN (SELECT step FROM path) OR EXISTS (SELECT 1 FROM proposers) GROUP BY ALL
), chances AS (
  SELECT *, CASE WHEN good_out >= n_good * {q.RISK} THEN 1 ELSE list_sum(list_transform(range(0, good_out + 1), lambda i: exp(
      lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({q.RISK}) + (n_good - i) * ln(1 - {q.RISK})))) END AS chance,
    (SELECT count(DISTINCT stratum) FROM held WHERE good) AS n_strata
  FROM tested
), taken AS (
  SELECT stratum, arg_max(step, (bad_out / greatest(n_bad, 1) - good_out / n_good, -step)) AS step_taken
  FROM (SELECT *, bool_and(chance <= {q.MISS} / n_strata) OVER (PARTITION BY stratum ORDER BY step) AS passed FROM chances)
  WHERE passed GROUP BY stratum
), judged AS (
  SELECT measured.*, coalesce(own.lang, '{q.POOLED}') AS stratum, step,
    n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED} * n_words AS base_failed
  FROM measured LEFT JOIN own ON measured.lang = own.lang LEFT JOIN rejecting USING (r)
)
SELECT doc_id, {", ".join(f"{name}::BIGINT AS {name}" for name in q.COUNTS)}, base_failed,
  NOT base_failed AND NOT coalesce(step <= step_taken, false) AS kept, stratum, step_taken::INTEGER AS step_taken
FROM judged LEFT JOIN taken USING (stratum)"""


def _spelling() -> str:
    q = spelling
    return f"""
WITH table_of AS (  -- of CRC-32, by its polynomial
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM range(0, 256) t(i))
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS id,
    translate(unnest(regexp_extract_all(text, '{q.RUN}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS bytes FROM runs WHERE length(run) >= {q.LEAST_CHARS} GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(0, length(bytes) // 2), lambda i: ('0x' || substr(bytes, (2 * i + 1)::BIGINT, 2))::BIGINT),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295)) AS h
  FROM counted, table_of
), words AS (
  SELECT CASE WHEN h % {q.LOSING} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word,
    sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {q.LEAST_CHARS} AND sum(n) >= {q.LEAST_COUNT}
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (  -- one replaced, or one more in the first word, then the other way round
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), near AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most FROM pairs GROUP BY word
), named AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {q.TIMES} * n THEN most END AS form_n,
    CASE WHEN most >= {q.TIMES} * n THEN (SELECT min(other) FROM pairs WHERE pairs.word = words.word AND other_n = most) END AS form
  FROM words LEFT JOIN near USING (word)
), chain AS (
  WITH RECURSIVE steps AS (
    SELECT word, word AS root, 0 AS step FROM named
    UNION ALL SELECT steps.word, form, step + 1 FROM steps JOIN named ON steps.root = named.word WHERE form IS NOT NULL
  ) SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM named JOIN chain USING (word)"""


def _collocations() -> str:
    q = collocations
    exact = f"({q.SCALE}::HUGEINT * a * a) // (l::HUGEINT * r)"
    return f"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)
), split AS (
  SELECT p, lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS words FROM pieces
), placed AS (
  SELECT p, lang, unnest(words) AS w1, unnest(range(1, len(words) + 1)) AS i FROM split
), following AS (
  SELECT lang, w1, lead(w1) OVER w AS w2, lead(w1, 2) OVER w AS w3 FROM placed WINDOW w AS (PARTITION BY p ORDER BY i)
), grams AS (
  SELECT lang, 1 AS size, w1 AS phrase FROM following
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM following WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM following WHERE w3 IS NOT NULL
), f AS (
  SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND f >= {q.LEAST_COUNT}
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(words[1:k], ' ') AS one, array_to_string(words[k + 1:], ' ') AS rest
  FROM candidates, (VALUES (1), (2)) t(k) WHERE k < size
), counted AS (
  SELECT cuts.*, x.f AS l, y.f AS r FROM cuts
  JOIN f x ON x.lang = cuts.lang AND x.phrase = one AND x.size = k
  JOIN f y ON y.lang = cuts.lang AND y.phrase = rest AND y.size = cuts.size - k
), least AS (
  SELECT *, {exact} AS score FROM counted QUALIFY row_number() OVER (PARTITION BY lang, size, phrase ORDER BY {exact}, k) = 1
), inside AS (
  SELECT lang, pair, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS pair FROM candidates WHERE size = 3)
  GROUP BY ALL
), kept AS (
  SELECT least.* FROM least LEFT JOIN inside ON inside.lang = least.lang AND pair = phrase AND size = 2
  WHERE longer IS NULL OR 100 * longer < {q.COVERED} * a
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {q.TOP}"""


LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _decontamination(window: int = 10) -> str:
    words = r"regexp_extract_all(translate(text, %s), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % LOW
    ahead = f"ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({words}, []) AS words FROM documents
), items AS (
  SELECT row_number() OVER () AS r, coalesce(item_id::VARCHAR, 'null') AS item, {words} AS words FROM benchmark
), doc_words AS (
  SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs
), item_words AS (
  SELECT r, item, least(len(words), {window}) AS size, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM items
), windows AS (
  SELECT DISTINCT item, size, array_to_string(ten, ' ') AS phrase FROM (
    SELECT item, size, list(word) OVER (PARTITION BY r ORDER BY i {ahead}) AS ten FROM item_words) WHERE len(ten) = size
), doc_windows AS (
  SELECT r, i, size, array_to_string(ten[1:size], ' ') AS phrase FROM (
    SELECT r, i, list(word) OVER (PARTITION BY r ORDER BY i {ahead}) AS ten FROM doc_words), (SELECT DISTINCT size FROM windows)
  WHERE len(ten) >= size
), found AS (
  SELECT r, i, item, size FROM doc_windows JOIN windows USING (size, phrase)
), hit AS (
  SELECT r, count(DISTINCT at_word) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS at_word FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""


def _suffix_dedup(size: int = 200) -> str:
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
), parts AS (  -- so that a row holds the bytes of {size} starts and no whole text
  SELECT r, n, low, substr(h, (2 * low + 1)::BIGINT, {4 * size}) AS part FROM (SELECT *, unnest(range(0, greatest(n - {size - 1}, 0), {size})) AS low FROM docs)
), starts AS (
  SELECT r, low + ahead AS i, md5(substr(part, (2 * ahead + 1)::BIGINT, {2 * size})) AS digest
  FROM (SELECT *, unnest(range(0, {size})) AS ahead FROM parts) WHERE low + ahead + {size} <= n
), again AS (
  SELECT digest FROM starts GROUP BY digest HAVING count(*) > 1
), marked AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM starts JOIN again USING (digest)
), runs AS (
  SELECT r, min(i) AS low, max(i) + {size} AS high FROM (
    SELECT r, i, sum((before IS NULL OR i > before + {size})::INT) OVER (PARTITION BY r ORDER BY i) AS run FROM marked)
  GROUP BY r, run
), gaps AS (
  SELECT r, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS low, low AS high FROM runs
  UNION ALL SELECT r, coalesce(last, 0), n FROM docs LEFT JOIN (SELECT r, max(high) AS last FROM runs GROUP BY r) USING (r)
), kept AS (
  SELECT r, string_agg(substr(h, (2 * low + 1)::BIGINT, (2 * (high - low))::BIGINT), '' ORDER BY low) AS h FROM gaps JOIN docs USING (r) GROUP BY r
), sums AS (
  SELECT r, sum(high - low) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(kept.h)) AS kept_sha256
FROM docs JOIN kept USING (r) LEFT JOIN sums USING (r)"""


ORACLES: dict[str, str] = {
    "op6_decontamination": _decontamination(),
    "op9_suffix_dedup": _suffix_dedup(),
    "op11_collocations": _collocations(),
    "op12_quality_rules": _quality_rules(),
    "op13_spelling_variants": _spelling(),
}
