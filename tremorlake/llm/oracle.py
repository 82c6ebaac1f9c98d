"""DuckDB texts of the operators that SQL can express, from the same fixed values."""

from __future__ import annotations

from tremorlake.llm import license_scan, merkle, secret_scan, vector_codes

_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT doc_id, i, line, trim({_LOWER.format(x='line')}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM lines),
frequent AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT d.*, f.k IS NOT NULL AS gone FROM keyed d LEFT JOIN frequent f ON d.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

EXACT_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20"""

_TEMPLATES = ", ".join(f"({i}, {_quoted(label)}, {base}, {_quoted(phrase)})" for i, (label, phrase, base) in enumerate(license_scan.all_templates()))

LICENSE_SCAN = rf"""
WITH t(tpl, label, base, phrase) AS (VALUES {_TEMPLATES}),
places AS (
  SELECT tpl, label, base, len(w) - 1 AS n_pairs, i - 1 AS place, w[i] AS a, w[i + 1] AS b
  FROM (SELECT *, unnest(range(1, len(w))) AS i FROM (SELECT *, string_split(phrase, ' ') AS w FROM t))),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format(x="coalesce(text, '')")}, '{license_scan.WORD}') AS w FROM documents),
pairs AS (SELECT doc_id, i - 1 AS pos, w[i] AS a, w[i + 1] AS b FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)),
votes AS (
  SELECT doc_id, tpl, label, base, n_pairs, pos - place AS diag, bit_or(CAST(1 AS BIGINT) << CAST(place AS INT)) AS mask
  FROM pairs JOIN places USING (a, b) GROUP BY ALL),
begun AS (SELECT *, CASE WHEN diag - lag(diag) OVER (PARTITION BY doc_id, tpl ORDER BY diag) <= {license_scan.MERGE_GAP} THEN 0 ELSE 1 END AS begins FROM votes),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id, tpl ORDER BY diag) AS span FROM begun),
spans AS (
  SELECT doc_id, label, base, n_pairs, tpl, span, bit_count(bit_or(mask)) AS covered,
         count(*) FILTER (bit_count(mask) = n_pairs) AS whole, min(diag) FILTER (bit_count(mask) = n_pairs) AS low,
         max(diag) FILTER (bit_count(mask) = n_pairs) AS high
  FROM numbered GROUP BY ALL),
judged AS (SELECT *, CAST(covered AS DOUBLE) / n_pairs AS share,
                  CASE WHEN base THEN whole > 0 ELSE CAST(covered AS DOUBLE) / n_pairs >= {license_scan.MIN_COVER} END AS ok FROM spans)
SELECT d.doc_id, len(any_value(d.w)) AS n_words, CAST(coalesce(sum(whole) FILTER (base), 0) AS BIGINT) AS n_base,
       min(low) FILTER (base) AS first_word, max(high) FILTER (base) AS last_word,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (base AND ok)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (ok)), ','), '') AS labels,
       coalesce(max(share) FILTER (ok), 0.0) AS score
FROM d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id"""


def _found(kind: int, pattern: str, value: str, ok: str) -> str:
    """(doc_id, owner, start, kind, stop, value) of a kind's matches: what stands between them gives their places."""
    p = _quoted(pattern)
    return f"""
  SELECT doc_id, owner, head AS start, {kind} AS kind, head + len(hit) AS stop, {value} AS value FROM (
    SELECT doc_id, owner, hits[i] AS hit,
           CAST(list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS head
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
      SELECT doc_id, owner, regexp_split_to_array(text, {p}) AS gaps, regexp_extract_all(text, {p}) AS hits FROM d)))
  WHERE {ok}"""


_ASSIGN_VALUE = f"regexp_extract(hit, {_quoted(secret_scan.ASSIGN)}, 2)"
#: Without the look-behind, which only spares attempts within a run.
_TOKEN = "[A-Za-z0-9+/_-]{20,}"

SECRET_SCAN = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text FROM documents),
base AS ({_found(0, secret_scan.ASSIGN, _ASSIGN_VALUE, f"len({_ASSIGN_VALUE}) >= {secret_scan.ASSIGN_MIN}")}
  UNION ALL {_found(1, secret_scan.ACCESS, "hit", f"len(hit) >= {secret_scan.ACCESS_MIN}")}
  UNION ALL {_found(2, secret_scan.HEX, "hit", f"len(hit) >= {secret_scan.HEX_MIN}")}),
extra AS ({_found(3, _TOKEN, "hit", f"len(regexp_replace(hit, '[^0-9]', '', 'g')) >= {secret_scan.TOKEN_MIN_DIGITS} AND regexp_matches(hit, '[A-Za-z]')")}),
spans AS (
  SELECT * FROM base UNION ALL
  SELECT * FROM extra e WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = e.doc_id AND e.start < b.stop AND b.start < e.stop)),
owners AS (SELECT value, count(DISTINCT owner) AS n_owners FROM spans GROUP BY value),
judged AS (SELECT s.*, n_owners <= {secret_scan.MAX_OWNERS} AS live FROM spans s JOIN owners USING (value)),
kept AS (SELECT *, CASE kind {' '.join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(secret_scan.KINDS))} END || ':' || start || ':' || stop AS written
         FROM judged WHERE kind < 3 OR live)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(written, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(written, ',' ORDER BY start, kind), '') AS spans,
       count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id GROUP BY d.doc_id"""


def _merkle_field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(strlen(CAST({x} AS VARCHAR)), ':', CAST({x} AS VARCHAR)) END"


def _merkle_leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join(map(_merkle_field, [*merkle.FIELDS[:-1], text])) + "))"


#: crc32 as SQL: 32 steps of one bit for each byte would be long, so the 256 remainders are a table made from the polynomial.
_CRC = """
bits AS (SELECT i, 0 AS step, CAST(i AS BIGINT) AS r FROM range(256) t(i)
  UNION ALL SELECT i, step + 1, CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END FROM bits WHERE step < 8),
remainders AS (SELECT list(r ORDER BY i) AS of_byte FROM bits WHERE step = 8)"""


def _crc32(x: str) -> str:
    """Unsigned crc32 of a text of digits and minus signs."""
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({x}, ''), lambda c: CAST(ascii(c) AS BIGINT))), "
            "lambda a, b: xor(a // 256, of_byte[xor(a, b) % 256 + 1])), 4294967295)")


MERKLE_MANIFEST = f"""
WITH RECURSIVE {_CRC},
rows AS (SELECT *, {_merkle_leaf('text')} AS leaf, {_merkle_leaf("replace(text, chr(10), '')")} AS tampered FROM documents),
numbered AS (SELECT *, row_number() OVER () AS row, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM rows),
ids AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL),
picked AS (SELECT doc_id, {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 AS picked FROM ids, remainders),
low AS (
  SELECT 0 AS level, tree, idx, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM numbered
  UNION ALL SELECT level + 1, tree, idx // {merkle.FAN}, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + {merkle.FAN - 1}) // {merkle.FAN}
  FROM low WHERE n > 1 GROUP BY level, tree, idx // {merkle.FAN}),
subroots AS (SELECT tree, level AS height, h FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, tree - 1 AS idx, h, count(*) OVER () AS n FROM subroots
  UNION ALL SELECT level + 1, idx // {merkle.FAN}, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + {merkle.FAN - 1}) // {merkle.FAN}
  FROM high WHERE n > 1 GROUP BY level, idx // {merkle.FAN}),
sides AS (
  SELECT 0 AS part, a.level, a.tree, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lefts,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rights
  FROM low a JOIN low b ON a.level = b.level AND a.tree = b.tree AND a.idx // {merkle.FAN} = b.idx // {merkle.FAN} WHERE a.n > 1 GROUP BY ALL
  UNION ALL
  SELECT 1, a.level, NULL, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), ''),
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '')
  FROM high a JOIN high b ON a.level = b.level AND a.idx // {merkle.FAN} = b.idx // {merkle.FAN} WHERE a.n > 1 GROUP BY ALL),
folds AS (
  SELECT row, n.tree, 0 AS step, idx, s.height, CASE WHEN p.picked THEN n.tampered ELSE n.leaf END AS h, '' AS proof
  FROM numbered n JOIN subroots s ON n.tree = s.tree LEFT JOIN picked p ON n.doc_id = p.doc_id
  UNION ALL
  SELECT f.row, f.tree, step + 1, CASE WHEN step + 1 = height THEN f.tree - 1 ELSE f.idx // {merkle.FAN} END, height,
         sha256(concat(s.lefts, f.h, s.rights)), concat(proof, s.lefts, s.rights)
  FROM (SELECT *, CASE WHEN step < height THEN 0 ELSE 1 END AS part, CASE WHEN step < height THEN step ELSE step - height END AS level,
               CASE WHEN step = height THEN tree - 1 ELSE idx END AS place FROM folds) f
  JOIN sides s ON s.part = f.part AND s.level = f.level AND (s.part = 1 OR s.tree = f.tree) AND s.idx = f.place),
ends AS (SELECT row, arg_max(h, step) AS folded_root, sha256(arg_max(proof, step)) AS proof_sha256 FROM folds GROUP BY row),
top AS (SELECT h AS root FROM high WHERE n = 1)
SELECT n.doc_id, n.leaf, s.h AS subroot, t.root, e.proof_sha256, e.folded_root, e.folded_root = t.root AS verified
FROM numbered n JOIN subroots s ON n.tree = s.tree JOIN ends e ON n.row = e.row CROSS JOIN top t"""


def _vector_codes() -> str:
    parts, entries, scale = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE
    gap = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    ctes = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"wide AS (SELECT greatest(1, CAST(ceil(max(len(v)) / {parts}.0) AS BIGINT)) AS d FROM kept)",
            f"""p AS MATERIALIZED (
  SELECT row, part, list_transform(range(part * d + 1, part * d + d + 1), lambda i: coalesce(v[i], 0)) AS v
  FROM kept, wide, range({parts}) t(part))""",
            f"b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, v FROM p WHERE row <= {entries})"]
    for i in range(vector_codes.ROUNDS + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (
  SELECT row, part, min(near).e AS entry, min(near).g AS gap, any_value(v) AS v
  FROM (SELECT p.row, p.part, p.v, {{'g': {gap}, 'e': b.entry}} AS near FROM p JOIN b{i} b ON p.part = b.part) GROUP BY row, part)""")
        if i == vector_codes.ROUNDS:
            break
        ctes.append(f"""b{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN (
    SELECT part, entry, list((s - (s % n + n) % n) // n ORDER BY place) AS v FROM (
      SELECT part, entry, place, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n
      FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY part, entry, place) GROUP BY part, entry) m
  ON b.part = m.part AND b.entry = m.entry)""")
    last = vector_codes.ROUNDS
    return "WITH " + ",\n".join(ctes) + f""",
coded AS (SELECT row, string_agg(lpad(printf('%x', entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(gap) AS BIGINT) AS error FROM a{last} GROUP BY row),
by_label AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM kept JOIN coded USING (row) GROUP BY label),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last})
SELECT k.vec_id, c.code, c.error, l.label_error, codebooks_sha256
FROM kept k JOIN coded c ON k.row = c.row JOIN by_label l ON k.label IS NOT DISTINCT FROM l.label CROSS JOIN books"""


VECTOR_CODES = _vector_codes()
