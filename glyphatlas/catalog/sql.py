"""Shared pieces of the SQL answers. They compute from the base tables and never parse a derived text."""

from __future__ import annotations

from glyphatlas.vocab import ENUM_DOMAINS

ID = "'A' || lpad(doc_id::VARCHAR, greatest(6, length(doc_id::VARCHAR))::INTEGER, '0')"
FIRST = "split_part(text, chr(10), 1)"
REST = "CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END"

# One row per document with what its tagged text says.
TAGGED = f"""
d AS (
  SELECT *, {ID} AS id, {FIRST} AS first, {REST} AS rest, strpos(text, chr(10)) > 0 AS more,
    doc_id % 7 = 3 AS broken,
    list_transform(range(0, doc_id % 20 + 1), lambda i: CASE WHEN i = 2 AND doc_id % 11 = 0 THEN '99999999999999999999'
      WHEN i = 1 AND doc_id % 17 = 0 THEN 'x' ELSE (doc_id + i)::VARCHAR END) AS all_terms
  FROM documents
),
t AS (
  SELECT *, 'tagged/' || substr(id, 1, 4) || '/' || lower(id) || '.seq' AS path,
    CASE WHEN doc_id % 23 = 0 THEN [] ELSE all_terms END AS terms,
    CASE WHEN NOT broken AND doc_id % 13 <> 5 THEN make_timestamp(1990 + doc_id % 35, 1 + doc_id % 12, 1 + doc_id % 28,
      doc_id % 24, doc_id % 60, ((doc_id * 7) % 60)::DOUBLE) END AS edited,
    list_sort(list_distinct(list_concat(
      CASE WHEN doc_id % 5 = 1 THEN ['maple'] ELSE [] END,
      CASE WHEN doc_id % 5 IN (2, 3) THEN ['mathematica'] ELSE [] END,
      CASE WHEN doc_id % 5 >= 2 THEN ['pari'] ELSE [] END,
      CASE WHEN doc_id % 5 = 4 THEN ['python'] ELSE [] END,
      CASE WHEN doc_id % 4 = 1 THEN ['c'] ELSE [] END,
      CASE WHEN doc_id % 6 = 0 THEN ['other'] ELSE [] END))) AS langs
  FROM d
),
v AS (
  SELECT *, CASE WHEN len(terms) = 0 THEN 0 WHEN doc_id % 17 = 0 AND len(terms) >= 2 THEN 1
      WHEN doc_id % 11 = 0 AND len(terms) >= 3 THEN 2 ELSE least(len(terms), 15) END AS n_good,
    array_to_string(terms[1:15], ', ') || CASE WHEN len(terms) > 15 THEN ', …' ELSE '' END AS preview
  FROM t
)"""


def _some(test: str, *lines: str) -> str:
    return f"CASE WHEN {test} THEN [{', '.join(lines)}] ELSE [] END"


def _l(code: str, content: str) -> str:
    return f"{{'f': '{code}', 'c': {content}}}"


_BFILE = "'<a href=\"/' || id || '/b' || substr(id, 2) || '.txt\">terms</a>'"
_DATE = (
    "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][1 + doc_id % 12] || ' ' ||"
    " lpad((1 + doc_id % 28)::VARCHAR, 2, '0') || ' ' || (1990 + doc_id % 35)::VARCHAR || ' ' ||"
    " lpad((doc_id % 24)::VARCHAR, 2, '0') || ':' || lpad((doc_id % 60)::VARCHAR, 2, '0') || ':' ||"
    " CASE WHEN doc_id % 13 = 5 THEN '60' ELSE lpad(((doc_id * 7) % 60)::VARCHAR, 2, '0') END"
)
_PARTS = [
    _some("doc_id % 10 = 9", _l("H", _BFILE)),
    f"[{_l('I', f"CASE WHEN broken THEN 'M0003 ' WHEN doc_id % 3 = 0 THEN 'M0098 N0035 ' ELSE '' END || '#' || n_chars || ' ' || {_DATE}")}]",
    f"[{_l('N', "'   '")}, {_l('N', "'  ' || first || '  '")}, {_l('N', "'a later name'")}]",
    _some("len(terms) > 0", _l("S", "array_to_string(terms[1:3], ',') || ',,,'")),
    _some("len(terms) > 3", _l("T", "array_to_string(terms[4:100], ', ') || ','")),
    "CASE WHEN more THEN list_transform(string_split(rest, chr(10)), lambda x: {'f': 'C', 'c': x}) ELSE [] END",
    f"[{_l('F', "'a(n) = ' || doc_id || '*n'")}]",
    _some("doc_id % 2 = 1", _l("F", "' G.f.: x/(1-x)'")),
    f"[{_l('e', "'  ' || lang || ' sample'")}]",
    _some("doc_id % 5 = 0", _l("K", "' , ,'")),
    f"[{_l('K', "lang || ',' || source || ', ,nonn'")}, {_l('K', "'ignored'")}]",
    f"[{_l('O', "(doc_id % 3) || ',1'")}, {_l('A', "'_' || source || '_, Jan 01 2000'")}]",
    f"list_transform(range(0, doc_id % 4), lambda x: {_l('D', "'A reference'")})",
    f"list_transform(range(0, doc_id % 3), lambda x: {_l('H', "'A link'")})",
    _some("doc_id % 2 = 0", _l("H", _BFILE)),
    _some("doc_id % 2 = 1", _l("E", "'Extended'")),
    _some("doc_id % 5 = 1", _l("p", "'seq(n, n=1..9);'")),
    _some("doc_id % 5 IN (2, 3)", _l("t", "'Table[n, {n, 9}]'")),
    _some("doc_id % 5 >= 2", _l("o", "'(PARI) a(n) = n'")),
    _some("doc_id % 5 = 4", _l("o", "'(Python 3) print(n)'")),
    f"[{_l('o', "'(define (x y))'")}]",
    _some("doc_id % 4 = 1", _l("o", "' (C++) int a;'")),
    _some("doc_id % 6 = 0", _l("o", "'(Brainfuck) +'")),
    f"[{_l('Y', "'Cf. A000001.'")}]",
]


def _concat(parts: list[str]) -> str:
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


# The well-formed lines of every tagged text, in order.
TAGGED_LINES = f"{TAGGED},\nln AS (SELECT *, {_concat(_PARTS)} AS lines FROM v)"

RECORDS = f"""
r AS (
  SELECT doc_id, {ID} AS id, CASE WHEN doc_id % 97 = 13 THEN '' ELSE {FIRST} END AS name, text AS comments,
    {REST} AS formulas, lang || ' ' || source || ': ' || {FIRST} AS examples,
    list_filter([lang, source, CASE WHEN doc_id % 50 = 0 THEN 'core' END, CASE WHEN quality = 1 THEN 'nice' END,
      CASE WHEN toxic = 1 THEN 'dead' END, CASE WHEN doc_id % 3 = 0 THEN 'tabl' END,
      CASE WHEN doc_id % 4 = 1 THEN 'sign' END, CASE WHEN doc_id % 7 = 2 THEN 'mult' END, 'nonn',
      CASE WHEN doc_id % 2 = 1 THEN 'easy' END], lambda k: k IS NOT NULL) AS keywords,
    (doc_id % 3) || ',1' AS "offset",
    doc_id || ', ' || (doc_id + 1) || ', ' || (doc_id + 2) AS values_preview_str,
    doc_id % 40 AS n_terms_visible,
    CASE doc_id % 6 WHEN 0 THEN '_Ann ' || source || '_, Jan 01 2000' WHEN 1 THEN '_' || source || '_ and _Bob_'
      WHEN 2 THEN 'Jane ' || source || ' and John Roe' WHEN 3 THEN source || ' (mail(AT)example.org), Feb 02 1993'
      WHEN 5 THEN '' END AS author,
    CASE doc_id % 6 WHEN 0 THEN 'Ann ' || source WHEN 1 THEN source WHEN 2 THEN 'Jane ' || source WHEN 3 THEN source
      ELSE '' END AS author_name,
    n_chars AS edit_count,
    CASE WHEN doc_id % 25 <> 3 THEN 1990 + doc_id % 35 END AS edit_year,
    doc_id % 7 AS n_references, doc_id % 11 AS n_links, doc_id % 2 AS n_extensions, doc_id % 5 AS n_langs,
    quality, toxic, lang, source
  FROM documents LEFT JOIN labels USING (doc_id)
),
k AS (
  SELECT *, coalesce(toxic, 0) = 1 OR n_terms_visible < 8 OR name = '' AS out,
    doc_id % 50 = 0 AS is_core, doc_id % 50 = 0 OR coalesce(quality, 0) = 1 AS is_seed,
    ln(1 + edit_count) + ln(1 + length(comments)) + 0.5 * ln(1 + length(formulas)) + 0.5 * ln(1 + length(examples))
      + 0.5 * n_langs + 0.3 * ln(1 + n_references) AS score
  FROM r
)"""


def _pick(field: str, index: str) -> str:
    values = ", ".join(f"'{v}'" for v in ENUM_DOMAINS[field])
    return f"[{values}][({index}) % {len(ENUM_DOMAINS[field])} + 1]"


_MD = "doc_id * 7 + coalesce(quality, 0) * 3"
_ST = "doc_id * 5 + coalesce(toxic, 0)"
ANNOTATORS = f"""
ann AS (
  SELECT doc_id, {ID} AS id, {FIRST} AS name, doc_id::VARCHAR AS values_preview_str,
    {_pick('math_domain', _MD)} AS a_math_domain,
    {_pick('sequence_type', _ST)} AS a_sequence_type,
    CASE WHEN doc_id % 20 <> 7 THEN {_pick('growth_class', 'n_chars')} END AS a_growth_class,
    {_pick('origin_era', 'doc_id')} AS a_origin_era,
    CASE WHEN doc_id % 8 = 0 THEN NULL WHEN doc_id % 10 = 7 THEN 'chemistry_physics'
      ELSE {_pick('math_domain', f'{_MD} + (doc_id % 5 = 0)::INT')} END AS b_math_domain,
    {_pick('sequence_type', f'{_ST} + (doc_id % 4 = 1)::INT')} AS b_sequence_type,
    CASE WHEN doc_id % 9 <> 2 THEN {_pick('growth_class', 'n_chars')} END AS b_growth_class,
    {_pick('origin_era', 'doc_id + (doc_id % 6 = 0)::INT')} AS b_origin_era
  FROM documents LEFT JOIN labels USING (doc_id)
),
fields AS (
  SELECT 'math_domain' AS field, a_math_domain AS a, b_math_domain AS b, id FROM ann
  UNION ALL SELECT 'sequence_type', a_sequence_type, b_sequence_type, id FROM ann
  UNION ALL SELECT 'growth_class', a_growth_class, b_growth_class, id FROM ann
  UNION ALL SELECT 'origin_era', a_origin_era, b_origin_era, id FROM ann
)"""

XREF = """
found AS (
  SELECT 'A' || lpad(l_orderkey::VARCHAR, greatest(6, length(l_orderkey::VARCHAR))::INTEGER, '0') AS src, unnest([
      'A' || lpad(l_partkey::VARCHAR, greatest(6, length(l_partkey::VARCHAR))::INTEGER, '0') || CASE WHEN l_linenumber = 7 THEN '9' ELSE '' END,
      'A' || lpad(l_suppkey::VARCHAR, greatest(6, length(l_suppkey::VARCHAR))::INTEGER, '0')]) AS dst
  FROM lineitem WHERE l_linenumber <> 6
),
xe AS (SELECT * FROM found WHERE src <> dst),
e AS (SELECT DISTINCT least(src, dst) AS from_id, greatest(src, dst) AS to_id FROM xe)"""

SPLIT = """
placed AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || from_id || '-' || to_id), from_id || '-' || to_id) AS rn,
    count(*) OVER () AS total FROM {edges}
),
split AS (
  SELECT from_id, to_id, CASE WHEN rn <= greatest(1, round_even(0.1 * total, 0)) THEN 'holdout' ELSE 'train' END AS split FROM placed
)"""

VECTORS = "v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS emb, label FROM embeddings)"

VECTOR_EDGES = """
m AS (SELECT (count(*) * 11 // 10) AS m FROM embeddings),
ve AS (
  SELECT DISTINCT least(s, t) AS from_id, greatest(s, t) AS to_id
  FROM (SELECT (c_custkey * c_custkey) % (SELECT m FROM m) AS s,
          ((round(c_acctbal * 100)::BIGINT % (SELECT m FROM m)) + (SELECT m FROM m)) % (SELECT m FROM m) AS t FROM customer)
  WHERE s <> t
),
vs AS (SELECT * FROM ve WHERE from_id IN (SELECT id FROM v) AND to_id IN (SELECT id FROM v))"""

VECTOR_SPLIT = f"{VECTORS}, {VECTOR_EDGES}, {SPLIT.format(edges='vs')}"

# Training adjacency and the holdout pairs whose ends both keep a training edge.
TRAINED = f"""{VECTOR_SPLIT},
sym AS (
  SELECT from_id AS src, to_id AS dst FROM split WHERE split = 'train'
  UNION ALL SELECT to_id, from_id FROM split WHERE split = 'train'
),
adj AS (SELECT src, dst, 1.0 / count(*) OVER (PARTITION BY src) AS w FROM sym),
held AS (
  SELECT from_id, to_id FROM split WHERE split = 'holdout' AND from_id IN (SELECT src FROM sym) AND to_id IN (SELECT src FROM sym)
),
pairs AS (SELECT from_id AS src, to_id AS dst FROM held UNION ALL SELECT to_id, from_id FROM held),
q0 AS (
  SELECT id, generate_subscripts(emb, 1) AS dim, unnest(emb) / CASE WHEN n = 0 THEN 1 ELSE n END AS val
  FROM (SELECT *, sqrt(list_dot_product(emb, emb)) AS n FROM v)
)"""


def smooth(step: int, before: str, alphas: str = "0.8") -> str:
    """CTE q<step>: one smoothing round over (alpha, id, dim, val) rows."""
    return f"""
q{step} AS MATERIALIZED (
  SELECT b.alpha, b.id, b.dim, CASE WHEN p.val IS NULL THEN b.val ELSE (1 - b.alpha) * b.val + b.alpha * p.val END AS val
  FROM (SELECT alpha, id, dim, val FROM q0, (SELECT unnest([{alphas}])::DOUBLE AS alpha)) b
  LEFT JOIN (SELECT q.alpha, a.src AS id, q.dim, sum(a.w * q.val) AS val FROM adj a
             JOIN (SELECT * FROM {before}) q ON q.id = a.dst GROUP BY ALL) p
  ON p.alpha = b.alpha AND p.id = b.id AND p.dim = b.dim
)"""


def smoothing(n: int, alphas: str = "0.8") -> str:
    first = f"(SELECT alpha, id, dim, val FROM q0, (SELECT unnest([{alphas}])::DOUBLE AS alpha))"
    steps = [smooth(i, first if i == 1 else f"q{i - 1}", alphas) for i in range(1, n + 1)]
    return ",".join(steps)


MEMBERS = """
mem AS (
  SELECT id, unnest([label::VARCHAR, CASE WHEN id % 2 = 0 THEN 'even' ELSE 'odd' END]) AS class FROM v
)"""

LAYERS = """
ly AS (
  SELECT id, emb, layer, CASE WHEN id % 13 = 0 THEN -1 ELSE c END AS cluster_id
  FROM (SELECT id, emb, 0 AS layer, label // 3 AS c FROM v UNION ALL SELECT id, emb, 1, label FROM v)
)"""

WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda t: length(t) >= 3)"
