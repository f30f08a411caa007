"""SQL answers of the numbered queries, computed by other means than the operators.

The other queries have none: tokenizers, sketches, suffix arrays, tilings, automata and fits have no SQL form, so tests hold
them against brute force, exact round trips or held-out labels.
"""

from __future__ import annotations

# crc32 by its table, which follows from the polynomial; bytes come from the hexadecimal text.
_CRC = """
crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
sized AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table)
"""


def _draw(name: str, weight: int) -> str:
    return f"(-ln((('0x' || substr(md5(doc_id::VARCHAR || '/{name}'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / {weight}.0)"


def _smallest(children: list[tuple[str, int, str]]) -> str:
    """CASE that gives the value of the child with the smallest draw."""
    draws = [_draw(name, weight) for name, weight, _ in children]
    arms = " ".join(f"WHEN {d} = least({', '.join(draws)}) THEN {value}" for d, (_, _, value) in zip(draws, children, strict=True))
    return f"(CASE {arms} END)"


def _region(r: int) -> str:
    racks = []
    for k in (2 * r, 2 * r + 1):
        shards = _smallest([(f"shard/{s}", 1, str(s)) for s in (2 * k, 2 * k + 1)])
        racks.append((f"rack/r{r}/k{k}", 2, shards))
    return _smallest(racks)


_EIGHT = _smallest([("region/r0", 4, _region(0)), ("region/r1", 4, _region(1))])
_NINE = _smallest([("region/r0", 4, _region(0)), ("region/r1", 4, _region(1)), ("region/r+8", 1, "8")])

OP6 = f"""
WITH {_CRC},
placed AS (SELECT *, ({_EIGHT})::INTEGER AS shard, ({_NINE})::INTEGER AS grown_shard FROM sized)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM placed
"""

# The level of the caps follows in one step from the sources in order of size by weight; a source is read up to its
# rounded target, so no schedule is needed to know what is taken.
OP7 = r"""
WITH sized AS (SELECT doc_id, source, md5('mix/' || doc_id::VARCHAR) AS mark,
    length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight FROM sized GROUP BY source),
ranked AS (SELECT *, 2.0 * source_size / weight AS full_at,
    coalesce(sum(source_size) OVER w, 0) AS size_before, coalesce(sum(weight) OVER w, 0) AS weight_before,
    sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM per WINDOW w AS (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((1.5 * total - 2 * size_before)::DOUBLE / (weights - weight_before)) AS l FROM ranked
  WHERE (1.5 * total - 2 * size_before)::DOUBLE / (weights - weight_before) < full_at),
targets AS (SELECT source, source_size, least(2.0 * source_size, coalesce(l, 0) * weight)::DOUBLE AS target FROM ranked, level),
laid AS (SELECT s.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS quota,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY mark, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (least(greatest(quota - begin, 0), size) + least(greatest(quota - source_size - begin, 0), size))::BIGINT AS taken
FROM laid
"""

OP1 = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i AS s, md5(substr(h, 2 * i + 1, 200)) AS g FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS i FROM t)),
marked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS nth FROM windows),
spans AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM marked WHERE nth > 1),
runs AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b
  FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM spans) GROUP BY doc_id, run),
pieces AS (SELECT doc_id, run, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
kept AS (SELECT t.doc_id, length(any_value(h)) // 2 AS n_bytes, coalesce(sum(b - a), 0) AS n_removed, count(run) AS n_spans,
    coalesce(string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a), '') || substr(any_value(h), 2 * coalesce(max(b), 0) + 1) AS rest
  FROM t LEFT JOIN pieces p ON p.doc_id = t.doc_id GROUP BY t.doc_id)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(rest)) AS kept_sha256 FROM kept
"""

# All pairs that share a shingle, counted; then the smallest reachable id by repeated minima over the links.
OP3 = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(31) || w[i + 1] || chr(31) || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, chr(31))] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN ways l ON r.b = l.a),
root AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN root USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP13 = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
texts AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(x) AS text_sha256 FROM t JOIN texts USING (x)
"""

ANSWERS: dict[str, str] = {
    "op1_suffix_array": OP1, "op3_hamming_join": OP3, "op6_hash_tree": OP6, "op7_source_schedule": OP7, "op13_salted_dedup": OP13}
