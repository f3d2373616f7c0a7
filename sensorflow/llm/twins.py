"""DuckDB SQL for the operators that SQL can express, over whole tables.

Line dedup, quality rules, URL rules and vocabulary, mixing, and vector codes. Token files, near-duplicates, tiling, tree matching and the
language model cannot be said in SQL; substring dedup could, but a row per window of every text is too slow on whole tables.
"""

from __future__ import annotations

from sensorflow.llm import codes, mixing, rules, urls

BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _lower(value: str) -> str:
    return f"translate({value}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def line_dedup(min_documents: int = 10) -> str:
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
exploded AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
keyed AS (SELECT r, i, line, {_lower(f"trim(line, {BLANKS})")} AS key FROM exploded),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= {min_documents}),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM keyed
         WHERE key NOT IN (SELECT key FROM common) GROUP BY r)
SELECT doc_id, len(lines) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def quality_rules() -> str:
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: trim(l, {BLANKS}) <> '') AS lines FROM documents),
exploded AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs),
windows AS (SELECT r, i, list(w) OVER eight AS win, count(*) OVER eight AS n FROM exploded
            WINDOW eight AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS seen FROM windows WHERE n = 8) WHERE seen > 1),
steps AS (SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS step FROM twice),
repeats AS (SELECT r, sum(step)::BIGINT AS n FROM steps GROUP BY r),
base AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, list_sum(list_transform(words, lambda w: length(w))) AS chars, len(lines) AS n_lines,
         length(text) - length(translate(text, '{rules.SYMBOLS}', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN repeats USING (r))
SELECT doc_id, n_words, coalesce(chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words,
       n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words
            OR 2 * n_dup_lines > n_lines OR 2 * coalesce(chars, 0) < 3 * n_words OR coalesce(chars, 0) > 25 * n_words) AS kept
FROM base
"""


def url_filter() -> str:
    ordered = sorted(urls.RULES, key=lambda r: (-len(r.text), r.text))

    def fits(rule: urls.HostRule) -> str:
        return f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')"

    rule = " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in ordered)
    action = " ".join(f"WHEN {fits(r)} THEN '{r.action}'" for r in ordered)

    def found(term: str) -> str:
        return rf"regexp_matches(url, '(^|[^\p{{L}}\p{{N}}]){term}($|[^\p{{L}}\p{{N}}])')"

    terms = [(t, urls.SOFT_LIMIT) for t in urls.STRICT] + list(urls.SOFT)
    weight = " + ".join(f"{n} * {found(t)}::INT" for t, n in terms)
    return rf"""
WITH parts AS (
  SELECT page_id, {_lower("coalesce(url, '')")} AS url, regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') AS rest FROM pages),
split AS (
  SELECT page_id, url, {_lower("regexp_extract(rest, '^([^/?#]*)', 1, 's')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM parts)
SELECT page_id, host, path, CASE {rule} END AS rule,
       coalesce(CASE {action} END, CASE WHEN {weight} >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM split
"""


def mixed(repeats: int = mixing.REPEATS) -> str:
    shown = "coalesce('=' || CAST({0} AS VARCHAR), 'null')"
    key = f"md5('/' || {shown.format('doc_id')} || '/' || {shown.format('source')} || '/' || md5(coalesce(text, '')))"
    weights = ", ".join(str(float(w)) for w in mixing.WEIGHTS)
    return rf"""
WITH docs AS (SELECT doc_id, source, {key} AS key, len({WORDS})::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, {repeats} * source_size AS cut,
         list_extract([{weights}]::DOUBLE[], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::BIGINT) AS weight
  FROM sources),
levels AS (
  SELECT *, (SELECT sum(source_size) FROM sources)::DOUBLE AS total,
         coalesce(sum(cut) OVER (ORDER BY cut / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before,
         sum(weight) OVER (ORDER BY cut / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM ranked),
level AS (SELECT min_by((total - before) / rest, (cut / weight, source IS NULL, source)) AS level FROM levels
          WHERE (total - before) / rest * weight <= cut),
goal AS (SELECT source, source_size, least(cut::DOUBLE, level * weight) AS target FROM levels, level),
entries AS (SELECT key, source, sum(size) AS size FROM docs GROUP BY key, source),
placed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key) AS through FROM entries),
copies AS (
  SELECT key, size, copy, (copy * source_size + through)::DOUBLE / target AS finish
  FROM placed JOIN goal ON placed.source IS NOT DISTINCT FROM goal.source, (SELECT unnest(range({repeats})) AS copy) WHERE target > 0),
running AS (SELECT key, sum(size) OVER (ORDER BY finish, key, copy ROWS UNBOUNDED PRECEDING) AS spent FROM copies),
taken AS (SELECT key, count(*) AS copies FROM running WHERE spent <= (SELECT sum(size) FROM docs) GROUP BY key)
SELECT doc_id, size, source_size, target, (size * coalesce(copies, 0))::BIGINT AS taken, docs.source AS source, coalesce(copies, 0)::BIGINT AS copies
FROM docs LEFT JOIN taken USING (key) JOIN goal ON docs.source IS NOT DISTINCT FROM goal.source
"""


def vector_codes() -> str:
    """Lloyd's rounds as one step after another; lengths are those of the most common multiple of the parts."""
    wide = f"(SELECT wide // {codes.PARTS} FROM size)"
    steps = [f"""
WITH finite AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT len(v) AS wide FROM finite WHERE len(v) > 0 AND len(v) % {codes.PARTS} = 0
         GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1),
kept AS (SELECT * FROM finite WHERE len(v) = (SELECT wide FROM size)),
flat AS (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM kept),
points AS MATERIALIZED (
  SELECT r, i // {wide} AS part, i % {wide} AS place,
         greatest(least(floor({codes.SCALE} * x::DOUBLE), {codes.LIMIT}), -{codes.LIMIT})::BIGINT AS x FROM flat),
seeds AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM kept),
book0 AS MATERIALIZED (SELECT part, entry, place, x AS c FROM points JOIN seeds USING (r) WHERE entry < {codes.ENTRIES})"""]
    for turn in range(codes.ROUNDS + 1):
        steps.append(f"""
far{turn} AS (SELECT r, part, entry, sum((x - c) * (x - c))::BIGINT AS d FROM points JOIN book{turn} USING (part, place) GROUP BY ALL),
own{turn} AS MATERIALIZED (SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM far{turn} GROUP BY r, part)""")
        if turn < codes.ROUNDS:
            steps.append(f"""
mean{turn} AS (SELECT part, entry, place, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
               FROM points JOIN own{turn} USING (r, part) GROUP BY ALL),
book{turn + 1} AS MATERIALIZED (SELECT part, entry, place, coalesce(m, c) AS c FROM book{turn} LEFT JOIN mean{turn} USING (part, entry, place))""")
    last = codes.ROUNDS
    return ",".join(steps) + f"""
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{last}) AS codebooks_sha256
FROM kept JOIN (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
                FROM own{last} GROUP BY r) USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_source_mixing": mixed(),
        "op4_url_filter": url_filter(),
        "op5_quality_rules": quality_rules(),
        "op9_line_dedup": line_dedup(),
        "op13_vector_codes": vector_codes(),
    }
