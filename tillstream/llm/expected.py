"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WHITE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

EXACT = f"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{_WHITE}', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

# Shares come down level by level: children in the order of capacity per weight; from
# the first whose share by weight fits, all get that share, the ones before it are full.


def _level(name: str, above: str, keys: str, parent: str, weight: str) -> str:
    join = f"USING ({parent})" if parent else "ON true"
    pot = f"PARTITION BY {parent}" if parent else ""
    return f"""
{name}_n AS (
  SELECT {keys}, sum(capacity)::BIGINT AS capacity, {weight} AS weight
  FROM leaf GROUP BY {keys}
),
{name}_r AS (
  SELECT n.*, a.budget AS pot,
         coalesce(sum(n.capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           ::BIGINT AS gone,
         sum(n.weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS ws
  FROM {name}_n n JOIN {above} a {join}
  WINDOW o AS ({pot} ORDER BY n.capacity / n.weight, {keys})
),
{name}_f AS (
  SELECT *, CASE WHEN (pot - gone) * weight < capacity * ws
                 THEN struct_pack(rest := pot - gone, ws := ws) END AS fit
  FROM {name}_r
),
{name} AS (
  SELECT {keys}, coalesce((lv.rest * weight) // lv.ws, capacity)::BIGINT AS budget
  FROM (
    SELECT *, first_value(fit IGNORE NULLS) OVER ({pot} ORDER BY capacity / weight, {keys}
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv
    FROM {name}_f
  )
)"""


MIX = f"""
WITH doc AS (
  SELECT doc_id, lang, source, text,
    coalesce(CASE TRY_CAST(nullif(regexp_extract(source, '^src([0-9]{{1,9}})$', 1), '') AS INT) % 3
      WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' END, 'unknown') AS k1,
    coalesce(lang, 'unknown') AS k2, coalesce(source, 'unknown') AS k3,
    len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS tokens
  FROM documents
),
leaf AS (
  SELECT k1, k2, k3, sum(tokens)::BIGINT AS held, 2 * sum(tokens)::BIGINT AS capacity
  FROM doc GROUP BY k1, k2, k3
),
total AS (SELECT least(sum(held) * 3 // 5, sum(capacity))::BIGINT AS budget FROM leaf),
{_level("l1", "total", "k1", "", "CASE k1 WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END")},
{_level("l2", "l1", "k1, k2", "k1", "CASE k2 WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END")},
{_level("l3", "l2", "k1, k2, k3", "k1, k2", "CASE k3 WHEN 'src0' THEN 3 ELSE 2 END")},
plan AS (
  SELECT k1, k2, k3,
         CASE WHEN held > 0 THEN least(budget // held, 2) ELSE 0 END AS whole,
         CASE WHEN held > 0 THEN budget % held ELSE 0 END AS rest
  FROM l3 JOIN leaf USING (k1, k2, k3)
),
placed AS (
  SELECT d.*, p.whole, p.rest,
    substr(md5(concat_ws('|', '42', p.whole::VARCHAR, d.doc_id::VARCHAR,
                         md5(coalesce(d.text, '')))), 1, 15) AS place
  FROM doc d JOIN plan p USING (k1, k2, k3)
),
run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY k1, k2, k3 ORDER BY place, doc_id, tokens
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent
  FROM placed
),
picked AS (
  SELECT *, whole + CASE WHEN rest > 0 AND spent <= rest THEN 1 ELSE 0 END AS epochs FROM run
)
SELECT doc_id, lang, source, tokens, unnest(range(epochs::BIGINT)) AS epoch
FROM picked WHERE epochs > 0
"""

_DRAW = "('0x' || substr(sha256('7:' || doc_id), {at}, 8))::BIGINT"

FILL_IN_MIDDLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
         {_DRAW.format(at=1)} AS h1, {_DRAW.format(at=9)} AS h2,
         {_DRAW.format(at=17)} AS h3, {_DRAW.format(at=25)} AS h4
  FROM documents
),
cuts AS (
  SELECT *, len(units)::BIGINT AS n,
         least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
),
parts AS (
  SELECT *, array_to_string(list_slice(units, 1, low), '') AS p,
         array_to_string(list_slice(units, low + 1, high), '') AS m,
         array_to_string(list_slice(units, high + 1, n), '') AS s
  FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

EXPECTED = {"op12_fill_in_middle": FILL_IN_MIDDLE, "op2_mixing": MIX, "op9_exact_dedup": EXACT}
