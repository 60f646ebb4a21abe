"""SQL fragments shared by the oracle queries (DuckDB dialect)."""

NORM_LEAD = r"^[\s.,;:，。；：、)\]】）]+"
NORM_TAIL = r"[\s.,;:，。；：、(\[【（]+$"
INVISIBLE = r"[\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}\x{feff}]"


def norm(x: str) -> str:
    cleaned = f"regexp_replace(regexp_replace({x}, '{INVISIBLE}', '', 'g'), '\\s+', ' ', 'g')"
    return f"regexp_replace(regexp_replace({cleaned}, '{NORM_LEAD}', ''), '{NORM_TAIL}', '')"


def reason(n: str) -> str:
    return (
        f"CASE WHEN {n} = '' THEN '标准化后为空' WHEN {n} = '无' THEN '显式噪声词' "
        f"WHEN regexp_full_match({n}, '[^\\p{{L}}\\p{{N}}]+') THEN '仅包含标点或噪声字符' END"
    )


def pieces(cell: str) -> str:
    return (
        f"list_filter(list_transform(string_split(coalesce({cell}, ''), '|'), "
        "lambda x: trim(x)), lambda x: x <> '')"
    )


NOISY_TERM = """CASE WHEN l_discount = 0.1 THEN CASE l_linenumber % 3 WHEN 0 THEN '无' WHEN 1 THEN '---' ELSE ')' END
       WHEN l_tax = 0.02 THEN '，' || p_name || '（' ELSE p_name END"""
NOISY_CODE = """CASE WHEN l_quantity = 50 THEN NULL
       WHEN l_returnflag = 'R' AND l_quantity < 5 THEN 'ERROR: No API results'
       WHEN l_tax = 0.08 THEN 'None' ELSE p_brand END"""


def records(term: str, code: str, drop_cells: bool) -> str:
    """CTEs ``numbered`` and ``records`` (record_id, uuid, admission_date, t1, c1, t2, c2)."""

    def cell(field: str, parity: int, lost: int) -> str:
        text = f"string_agg({field}, '|' ORDER BY k) FILTER (WHERE k % 2 = {parity})"
        return f"CASE WHEN record_id % {lost} <> 0 THEN {text} END" if drop_cells else text

    return f"""numbered AS (
  SELECT l_orderkey AS record_id,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS k,
         {term} AS term, {code} AS code, l_shipdate
  FROM lineitem JOIN part ON l_partkey = p_partkey),
records AS (
  SELECT record_id, 'u' || record_id AS uuid, strftime(min(l_shipdate), '%Y-%m-%d') AS admission_date,
         {cell('term', 0, 19)} AS t1, {cell('code', 0, 17)} AS c1,
         {cell('term', 1, 19)} AS t2, {cell('code', 1, 17)} AS c2
  FROM numbered GROUP BY record_id)"""


NOISY = records(NOISY_TERM, NOISY_CODE, True)
CLEAN = records("p_name", "p_brand", False)

# Cells with their lists, judged terms, and the pairs of the cells that can be paired.
PAIRS = f"""cells AS (
  SELECT * FROM (
    SELECT record_id, uuid, admission_date, 0 AS col_ord, 'diagnosis1' AS col,
           {pieces('t1')} AS terms, {pieces('c1')} AS codes FROM records
    UNION ALL
    SELECT record_id, uuid, admission_date, 1, 'diagnosis2', {pieces('t2')}, {pieces('c2')} FROM records)
  WHERE len(terms) > 0 OR len(codes) > 0),
spread AS (
  SELECT record_id, col_ord, unnest(terms) AS term, generate_subscripts(terms, 1) - 1 AS nr FROM cells),
normed AS (SELECT *, {norm('term')} AS norm FROM spread),
judged AS (SELECT *, {reason('norm')} AS reason FROM normed),
lists AS (
  SELECT record_id, col_ord,
         list(term ORDER BY nr) AS all_terms, list(norm ORDER BY nr) AS all_norms,
         list(coalesce(reason, '') ORDER BY nr) AS all_reasons,
         coalesce(list(term ORDER BY nr) FILTER (WHERE reason IS NULL), []) AS clean_terms,
         coalesce(list(norm ORDER BY nr) FILTER (WHERE reason IS NULL), []) AS clean_norms
  FROM judged GROUP BY record_id, col_ord),
shaped AS (
  SELECT c.*, l.all_norms, l.all_reasons, coalesce(l.clean_terms, []) AS clean_terms, l.clean_norms,
         CASE WHEN len(c.terms) = len(c.codes) THEN 'all'
              WHEN len(c.codes) > 0 AND len(coalesce(l.clean_terms, [])) = len(c.codes) THEN 'clean' END AS pairing
  FROM cells c LEFT JOIN lists l USING (record_id, col_ord)),
pairs AS (
  SELECT record_id, uuid, admission_date, col_ord, col, unnest(terms) AS term, unnest(all_norms) AS norm,
         nullif(unnest(all_reasons), '') AS reason, unnest(codes) AS code,
         generate_subscripts(codes, 1) - 1 AS pos
  FROM shaped WHERE pairing = 'all'
  UNION ALL
  SELECT record_id, uuid, admission_date, col_ord, col, unnest(clean_terms), unnest(clean_norms), NULL,
         unnest(codes), generate_subscripts(codes, 1) - 1
  FROM shaped WHERE pairing = 'clean'),
usable AS (
  SELECT * FROM pairs
  WHERE reason IS NULL AND NOT contains(code, 'ERROR') AND trim(code) <> '' AND lower(code) NOT IN ('none', 'nan'))"""

# The winning code and the usual spelling of each term.
MAJORITY = """code_counts AS (
  SELECT norm, code, count(*) AS n, min((record_id, col_ord, pos)) AS first FROM usable GROUP BY norm, code),
ranked_codes AS (
  SELECT *, row_number() OVER (PARTITION BY norm ORDER BY n DESC, first) AS rk,
         count(*) OVER (PARTITION BY norm) AS n_codes FROM code_counts),
spellings AS (
  SELECT norm, term, row_number() OVER (PARTITION BY norm ORDER BY count(*) DESC, min((record_id, col_ord, pos))) AS rk
  FROM usable GROUP BY norm, term)"""


# -- text ---------------------------------------------------------------------


def ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def joined_distinct(source: str, keys: str, item: str, order: str) -> str:
    """Distinct items of each key in order of first appearance, pipe-joined."""
    return (
        f"(SELECT {keys}, string_agg({item}, '|' ORDER BY first) AS terms FROM "
        f"(SELECT {keys}, {item}, min({order}) AS first FROM {source} GROUP BY {keys}, {item}) GROUP BY {keys})"
    )


BRACKETED = """bracketed AS (
  SELECT doc_id AS id, replace(replace(replace(replace(text, ' the ', ' (the '), ' of ', ' of) '),
                       ' de ', ' [de '), ' la ', ' la】 ') AS text
  FROM documents)"""


def depth_parts(source: str, separators: str) -> str:
    """CTEs ending in ``parts`` (id, pos, part): a running depth over single characters.

    The depth that never falls below zero is the running sum of the steps less the
    smallest such sum so far.
    """
    return f"""letters AS (
  SELECT id, generate_subscripts(cs, 1) AS i, unnest(cs) AS ch
  FROM (SELECT id, string_split(text, '') AS cs FROM {source} WHERE text <> '')),
steps AS (
  SELECT *, sum(CASE WHEN contains('(（[【{{', ch) THEN 1 WHEN contains(')）]】}}', ch) THEN -1 ELSE 0 END)
              OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING) AS s FROM letters),
depths AS (
  SELECT *, s - least(0, min(s) OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING)) AS depth FROM steps),
cuts AS (SELECT *, depth = 0 AND contains({separators}, ch) AS cut FROM depths),
numbered_cuts AS (
  SELECT *, sum(CASE WHEN cut THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING) AS g
  FROM cuts),
raw_parts AS (
  SELECT id, g, {ws("string_agg(ch, '' ORDER BY i)")} AS part FROM numbered_cuts WHERE NOT cut GROUP BY id, g),
parts AS (
  SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY g) - 1 AS INTEGER) AS pos, part
  FROM raw_parts WHERE part <> '')"""


TERM_SEPARATORS = "',，;；|、?？ ' || chr(10) || chr(13) || chr(9)"
DOCUMENT_SEPARATORS = "',;|?!' || chr(10) || chr(13) || chr(9)"
LINES = """doc_lines AS (
  SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"""


def non_disease(x: str) -> str:
    """The document pack's test for terms that are not kept."""
    t = ws(x)
    return (
        f"(lower({t}) IN ('', 'is', 'le', 'the', '%%%', '***')"
        f" OR regexp_full_match({t}, '\\p{{Lu}}\\p{{Ll}}+|(?:on|in) .*|.* ed')"
        f" OR (contains({t}, 'with') AND NOT regexp_full_match({t}, '.*with of.*|with .*')))"
    )


def no_marks(x: str) -> str:
    return f"regexp_replace(translate({x}, '?？', ''), '[（(]\\s*[）)]', '', 'g')"


def no_phrases(x: str) -> str:
    return ws(f"replace(replace({x}, ' that ', ''), 'rewh', '')")


def no_prefixes(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^\\p{{Nd}}+[.、]\\s*', ''), '^(?:The|Is)\\s*', '')"


EDGES = "' ，,;；|'"
