"""The same results in SQL, for DuckDB: ``name -> query``."""

from dxweave.plans import oracle_parts as S

ORACLES: dict[str, str] = {}

_INSPECT = f"WITH {S.NOISY},\n{S.PAIRS}"
_STATS = "stats AS (SELECT norm, code, count(*) AS n FROM usable GROUP BY norm, code)"

ORACLES["term_code_stats"] = f"""{_INSPECT}
SELECT norm AS normalized_term, code, count(*) AS frequency FROM usable GROUP BY norm, code
ORDER BY frequency DESC, normalized_term, code"""

ORACLES["reverse_map"] = f"""{_INSPECT}
SELECT code, norm AS term, count(*) AS n FROM usable GROUP BY code, norm ORDER BY code, n DESC, term"""

ORACLES["reverse_report"] = f"""{_INSPECT}, {_STATS}
SELECT code, CAST(('0x' || md5(norm)[1:2]) AS BIGINT) % 16 AS part,
       '{{' || string_agg('"' || norm || '":' || n, ',' ORDER BY n DESC, norm) || '}}' AS terms
FROM stats GROUP BY ALL"""

ORACLES["recommended_codes"] = f"""{_INSPECT}, {S.MAJORITY}
SELECT norm, code AS recommended_code, n AS recommended_code_frequency FROM ranked_codes WHERE rk = 1"""

_CONFLICTS = """SELECT CAST(NULL AS BIGINT) AS row_index, '' AS uuid, '' AS admission_date, 'ALL' AS "column",
       'TERM_MULTI_CODE' AS issue_type,
       'term=' || c.norm || ' 出现多编码；major=' || m.code || '(' || m.n || ') current=' || c.code || '(' || c.n || ')' AS detail,
       s.term AS term_value, c.norm AS normalized_term, c.code AS code_value,
       m.code AS recommended_code, m.n AS recommended_code_frequency
FROM ranked_codes c JOIN ranked_codes m ON m.norm = c.norm AND m.rk = 1
JOIN spellings s ON s.norm = c.norm AND s.rk = 1
WHERE c.rk > 1"""

ORACLES["multi_code_conflicts"] = f"{_INSPECT}, {S.MAJORITY}\n{_CONFLICTS}"

# Each usable pair makes its code a candidate with the count so far; the best candidate before a pair that asks wins.
_ASKED = """counted AS (
  SELECT *, NOT (contains(code, 'ERROR') OR trim(code) = '' OR lower(code) IN ('none', 'nan')) AS usable
  FROM pairs WHERE reason IS NULL),
so_far AS (
  SELECT *, count(*) OVER w AS n, first_value({'r': -record_id, 'c': -col_ord, 'p': -pos}) OVER w AS earliness
  FROM counted WINDOW w AS (PARTITION BY norm, code, usable ORDER BY record_id, col_ord, pos ROWS UNBOUNDED PRECEDING)),
topped AS (
  SELECT *, max(CASE WHEN usable THEN {'n': n, 'earliness': earliness, 'code': code} END) OVER (
    PARTITION BY norm ORDER BY record_id, col_ord, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
  FROM so_far),
asked AS (
  SELECT record_id, col_ord, pos, uuid, admission_date, col, term, norm, code,
         coalesce(top.code, '') AS recommended_code, coalesce(top.n, 0) AS recommended_code_frequency
  FROM topped WHERE NOT usable)"""

ORACLES["running_recommendation"] = f"""{_INSPECT}, {_ASKED}
SELECT record_id, col_ord, CAST(pos AS INTEGER) AS pos, uuid, admission_date, col AS "column", term, norm, code,
       recommended_code, recommended_code_frequency FROM asked"""

_CELL_FLAGS = """SELECT record_id AS row_index, uuid, admission_date, col AS "column", 'NOISE_TERM' AS issue_type,
       reason AS detail, term AS term_value, norm AS normalized_term, '' AS code_value,
       '' AS recommended_code, CAST(0 AS BIGINT) AS recommended_code_frequency
FROM judged JOIN cells USING (record_id, col_ord) WHERE reason IS NOT NULL AND len(terms) <> len(codes)
UNION ALL
SELECT record_id, uuid, admission_date, col, 'NOISE_TERM', reason, term, norm, code, '', 0
FROM pairs WHERE reason IS NOT NULL
UNION ALL
SELECT record_id, uuid, admission_date, col, 'MISSING_CODE', '有诊断但编码为空',
       array_to_string(clean_terms, '|'), NULL, '', NULL, NULL
FROM shaped WHERE len(codes) = 0 AND len(clean_terms) > 0
UNION ALL
SELECT record_id, uuid, admission_date, col, 'MISSING_TERM', '有编码但诊断为空', '', NULL,
       array_to_string(codes, '|'), NULL, NULL
FROM shaped WHERE len(terms) = 0
UNION ALL
SELECT record_id, uuid, admission_date, col, 'TERM_CODE_LENGTH_MISMATCH',
       'terms=' || len(clean_terms) || ', codes=' || len(codes),
       array_to_string(clean_terms, '|'), NULL, array_to_string(codes, '|'), NULL, NULL
FROM shaped WHERE len(terms) > 0 AND len(codes) > 0 AND pairing IS NULL"""

ORACLES["flags_cells"] = f"{_INSPECT}\n{_CELL_FLAGS}"

_CODE_FLAGS = """SELECT record_id AS row_index, uuid, admission_date, col AS "column",
       CASE WHEN contains(code, 'ERROR') THEN 'ERROR_CODE' ELSE 'EMPTY_OR_NONE_CODE' END AS issue_type,
       CASE WHEN contains(code, 'ERROR') THEN '编码结果包含 ERROR' ELSE '编码为空或None' END AS detail,
       term AS term_value, norm AS normalized_term, code AS code_value, recommended_code, recommended_code_frequency
FROM asked"""

_ALL_FLAGS = f"""{_INSPECT}, {S.MAJORITY}, {_ASKED},
all_flags AS (
{_CELL_FLAGS}
UNION ALL
{_CODE_FLAGS}
UNION ALL
{_CONFLICTS})"""

ORACLES["inspection_flags"] = f"{_ALL_FLAGS}\nSELECT * FROM all_flags"

ORACLES["inspection_summary"] = f"""{_ALL_FLAGS}
SELECT issue_type, count(*) AS n_flags FROM all_flags GROUP BY issue_type"""

_TEMPLATE = f"""{_INSPECT}, {S.MAJORITY}, {_ASKED},
candidates AS (
  SELECT norm AS term_keyword, code AS wrong_code, recommended_code AS correct_code,
         CASE WHEN contains(code, 'ERROR') THEN 'ERROR_CODE' ELSE 'EMPTY_OR_NONE_CODE' END AS note,
         0 AS phase, record_id AS o1, col_ord AS o2, pos AS o3 FROM asked
  UNION ALL
  SELECT c.norm, c.code, m.code, 'TERM_MULTI_CODE', 1, 0, 0, 0
  FROM ranked_codes c JOIN ranked_codes m ON m.norm = c.norm AND m.rk = 1 WHERE c.rk > 1),
chosen AS (
  SELECT *, row_number() OVER (PARTITION BY term_keyword, wrong_code ORDER BY phase, o1, o2, o3) AS rk
  FROM candidates),
template AS (
  SELECT 'Y' AS enabled, 'exact' AS term_match_mode, term_keyword, wrong_code, correct_code,
         'ALL' AS column_scope, note FROM chosen WHERE rk = 1)"""

ORACLES["fix_rule_template"] = f"{_TEMPLATE}\nSELECT * FROM template"

# -- text and cleaning --------------------------------------------------------

ORACLES["normalize_terms"] = f"""WITH {S.LINES},
n AS (SELECT doc_id, pos, CASE WHEN lower({S.ws('line')}) = 'nan' THEN '' ELSE {S.norm('line')} END AS norm FROM doc_lines)
SELECT doc_id, pos, norm, {S.reason('norm')} AS reason FROM n"""

ORACLES["depth_split"] = f"""WITH {S.BRACKETED}, {S.depth_parts('bracketed', S.TERM_SEPARATORS)}
SELECT id AS doc_id, pos, part FROM parts"""

def _is_digits(x: str) -> str:
    return f"regexp_full_match({x}, '\\p{{Nd}}+')"


_CONNECTORS = " and | und | et | y "
ORACLES["clean_terms"] = f"""WITH {S.BRACKETED}, {S.depth_parts('bracketed', S.DOCUMENT_SEPARATORS)},
heads AS (
  SELECT id, pos, trim({S.no_phrases(S.no_marks(S.no_prefixes('part')))}, {S.EDGES}) AS term FROM parts),
kept AS (SELECT * FROM heads WHERE term <> '' AND NOT {S.non_disease('term')}),
cut AS (
  SELECT *, list_filter(list_transform(
           regexp_split_to_array(replace(term, ' and the', chr(983040)), '{_CONNECTORS}'),
           lambda c: {S.ws("replace(c, chr(983040), ' and the')")}), lambda c: c <> '') AS chunks FROM kept),
chosen AS (
  SELECT id, pos, term, CASE WHEN regexp_matches(term, '{_CONNECTORS}') AND len(chunks) > 1 THEN
           list_filter(chunks, lambda c: c NOT IN ('', 'is', 'le', 'the', '%%%', '***') AND NOT {_is_digits('c')})
         ELSE [] END AS good FROM cut),
lists AS (SELECT id, pos, CASE WHEN len(good) > 0 THEN good ELSE [{S.ws('term')}] END AS pieces FROM chosen),
pieces AS (
  SELECT id, pos, generate_subscripts(pieces, 1) AS sub, unnest(pieces) AS piece FROM lists),
tails AS (
  SELECT id, pos * 100000 + sub AS at_, {S.no_phrases(S.ws(S.no_marks(f"trim(piece, {S.EDGES})")))} AS piece FROM pieces),
final AS (SELECT * FROM tails WHERE piece <> '' AND NOT {S.non_disease('piece')} AND NOT {_is_digits('piece')})
SELECT doc_id, terms FROM documents LEFT JOIN {S.joined_distinct('final', 'id', 'piece', 'at_')} f ON f.id = doc_id"""

ORACLES["legacy_plain"] = f"""WITH {S.BRACKETED}, {S.depth_parts('bracketed', S.DOCUMENT_SEPARATORS)},
heads AS (SELECT id, pos, trim({S.no_prefixes('part')}, {S.EDGES}) AS term FROM parts),
final AS (SELECT * FROM heads WHERE term <> '' AND NOT {S.non_disease('term')} AND NOT {_is_digits('term')})
SELECT doc_id, terms FROM documents LEFT JOIN {S.joined_distinct('final', 'id', 'term', 'pos')} f ON f.id = doc_id"""

# The derived cells hold none of the phrases, connectors or patterns of the full pack
# but the noise words, so splitting, trimming and the stop list decide.
ORACLES["clean_columns"] = f"""WITH {S.NOISY},
texts AS (
  SELECT record_id || '/1' AS id, CASE WHEN t1 NOT IN ('/', '无') THEN t1 END AS text FROM records
  UNION ALL SELECT record_id || '/2', CASE WHEN t2 NOT IN ('/', '无') THEN t2 END FROM records),
{S.depth_parts('texts', S.TERM_SEPARATORS)},
heads AS (SELECT id, pos, trim({S.no_marks('part')}, {S.EDGES}) AS term FROM parts),
final AS (SELECT * FROM heads WHERE term NOT IN ('', '无')),
terms AS {S.joined_distinct('final', 'id', 'term', 'pos')}
SELECT record_id, a.terms AS diagnosis1, b.terms AS diagnosis2
FROM records LEFT JOIN terms a ON a.id = record_id || '/1' LEFT JOIN terms b ON b.id = record_id || '/2'"""

ORACLES["connector_split"] = f"""WITH {S.LINES},
shielded AS (
  SELECT *, replace(replace(replace(line, 'other', chr(983040)), 'then', chr(983041)), 'land', chr(983042)) AS s
  FROM doc_lines),
cut AS (
  SELECT *, list_filter(list_transform(regexp_split_to_array(s, 'and|the|de|la|of'), lambda c:
    {S.ws("replace(replace(replace(c, chr(983040), 'other'), chr(983041), 'then'), chr(983042), 'land')")}),
    lambda c: c <> '') AS chunks FROM shielded),
good AS (SELECT *, list_filter(chunks, lambda c: c NOT IN ('', 'is', 'a') AND NOT {_is_digits('c')}) AS g FROM cut)
SELECT doc_id, pos, CASE WHEN regexp_matches(line, 'and|the|de|la|of') AND len(chunks) > 1 AND len(g) > 0
  THEN array_to_string(g, '|') ELSE {S.ws('line')} END AS chunks FROM good"""

ORACLES["marker_split"] = f"""WITH items AS (
  SELECT doc_id AS id, generate_subscripts(ps, 1) AS pos, unnest(ps) AS part
  FROM (SELECT doc_id, regexp_split_to_array(text, '[.,] ') AS ps FROM documents)),
trimmed AS (
  SELECT id, pos, {S.ws("regexp_replace(regexp_replace(regexp_replace(" + S.ws('part') + ", 'the ', ''), 'de ', ''), 'on ', '')")} AS item
  FROM items),
final AS (SELECT * FROM trimmed WHERE item NOT IN ('', 'is', 'le', 'der'))
SELECT doc_id, terms FROM documents LEFT JOIN {S.joined_distinct('final', 'id', 'item', 'pos')} f ON f.id = doc_id"""

_SIZE = r"(\p{Nd}+(?:\.\p{Nd}+)?x\p{Nd}+(?:\.\p{Nd}+)?cm)"
ORACLES["legacy_complications"] = rf"""WITH cells AS (
  SELECT p_partkey AS id, p_partkey || '. ' || p_name || p_size || '.5x' || p_size || 'cm、妊娠合并' || p_brand
         || '，' || p_partkey || '；' || p_type || '？。 妊娠合并' || p_type AS cell FROM part),
plain AS (
  SELECT id, regexp_replace(translate(regexp_replace(cell, '{_SIZE}|\p{{Nd}}+\.\s*', '\1', 'g'), '。?？', ''),
                            '{_SIZE}|\p{{Nd}}+[、.]', '\1', 'g') AS text FROM cells),
terms AS (
  SELECT id, generate_subscripts(ts, 1) AS pos, {S.ws('unnest(ts)')} AS term
  FROM (SELECT id, regexp_split_to_array(text, '[;；,，、]') AS ts FROM plain)),
words AS (
  SELECT id, pos * 1000 + generate_subscripts(ws, 1) AS at_, regexp_replace(unnest(ws), '^妊娠合并', '') AS word
  FROM (SELECT id, pos, regexp_split_to_array(term, '\s+') AS ws FROM terms WHERE term <> '' AND NOT {_is_digits('term')})),
final AS (SELECT * FROM words WHERE length(word) > 1 OR regexp_full_match(word, '\p{{L}}'))
SELECT p_partkey, terms FROM part LEFT JOIN {S.joined_distinct('final', 'id', 'word', 'at_')} f ON f.id = p_partkey"""

# What each kind of derived cell must come to, stated directly.
ORACLES["legacy_protected"] = """SELECT p_partkey, CASE p_partkey % 4
  WHEN 0 THEN '脐带绕颈' || p_size || '周|' || replace(p_name, ' ', '|')
  WHEN 1 THEN '孕' || p_size || '+3周(' || p_brand || ')|' || replace(p_name, ' ', '|') || '+' || p_type
  WHEN 2 THEN p_brand || '|' || p_type
  ELSE '孕2产1孕' || p_size || '+1周 左枕前|' || p_type END AS terms FROM part"""

ORACLES["strip_html"] = "SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS plain FROM pages"

ORACLES["extract_json"] = """WITH docs AS (
  SELECT p_partkey, CASE WHEN p_partkey % 5 IN (0, 1) THEN
           '{"match_found": true, "target_code": "' || p_brand || '", "n": ' || p_size || '}'
         WHEN p_partkey % 5 = 3 THEN '{"match_found": "true", "target_code": "' || p_brand || '"}' END AS document
  FROM part)
SELECT p_partkey, document,
       CASE WHEN json_type(document, '$.match_found') = 'BOOLEAN' THEN json_extract_string(document, '$.target_code') END AS code,
       coalesce(TRY_CAST(json_extract_string(document, '$.n') AS BIGINT), 0) AS n
FROM docs"""

# -- layout -------------------------------------------------------------------

ORACLES["row_ordinal"] = "SELECT row_number() OVER (ORDER BY event_id) - 1 AS ordinal, event_id FROM events"

ORACLES["record_terms"] = f"""WITH {S.NOISY}, {S.PAIRS}
SELECT record_id, col_ord, 'diagnosis' || (col_ord + 1) AS "column", CAST(nr AS INTEGER) AS pos, term FROM spread"""

_UNCODED = S.records("p_name || ' ' || p_brand", "''", False)
ORACLES["record_round_trip"] = f"""WITH {_UNCODED}
SELECT record_id, t1 AS diagnosis1, t2 AS diagnosis2 FROM records"""

# -- lookups and rules --------------------------------------------------------

ORACLES["rule_set_version"] = """SELECT p_type, substr(md5(count(*) || ':' || sum(CAST('0x' || substr(md5(
    p_partkey || '- Rule: If input implies ''' || p_name || ''', map to ''' || p_brand || ''''), 1, 15) AS BIGINT))), 1, 8) AS version
FROM part GROUP BY p_type"""

_BOOK = "book AS (SELECT p_partkey AS line, p_name AS term, p_brand AS code FROM part WHERE NOT starts_with(p_name, 'red'))"
ORACLES["dictionary_last_wins"] = f"""WITH {_BOOK}
SELECT line, term, code FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY line DESC) AS rk FROM book) WHERE rk = 1"""
ORACLES["rules_first_wins"] = f"""WITH {_BOOK}
SELECT line, term, code FROM (SELECT *, row_number() OVER (PARTITION BY term, code ORDER BY line) AS rk FROM book) WHERE rk = 1"""
ORACLES["dictionary_map"] = f"""WITH {_BOOK},
last AS (SELECT term, arg_max(code, line) AS code FROM book GROUP BY term)
SELECT l_orderkey AS record_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_name AS term,
       coalesce(code, 'ERROR: No mapping for ''' || p_name || '''') AS code
FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN last ON term = p_name"""

ORACLES["context_rules"] = """WITH base AS (
  SELECT o_orderkey AS id, o_orderpriority AS pri, c_mktsegment AS seg, n_name AS nat, n_nationkey AS nk,
         c_mktsegment || ' ' || n_name || 'Y' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS context
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
looked AS (
  SELECT id,
    CASE WHEN pri = '1-URGENT' AND contains(context, 'NATION_2') AND NOT contains(context, 'O') THEN 'A1'
         WHEN pri = '1-URGENT' AND contains(context, 'O') AND NOT contains(context, 'NATION_2') THEN 'B1|B2'
         WHEN pri < '3' THEN 'P' || pri ELSE 'ERROR: No mapping for ''' || pri || '''' END AS a,
    CASE WHEN seg IN ('BUILDING', 'AUTOMOBILE') AND (contains(context, 'ION_1') OR contains(context, 'YF')) THEN NULL
         ELSE 'C' || seg END AS b,
    CASE WHEN nk % 5 <> 0 THEN 'N' || nk ELSE 'ERROR: No mapping for ''' || nat || '''' END AS c
  FROM base)
SELECT id AS record_id, CASE WHEN id % 11 = 0 THEN '' ELSE concat_ws('|', a, b, c) END AS risk_codes FROM looked"""

# -- coding cascade -----------------------------------------------------------


def _sub_code(word: str) -> str:
    return (
        f"CASE WHEN {word} LIKE 'b%' THEN 'SV-' || {word} WHEN {word} LIKE 'g%' THEN 'ERROR: No API results' "
        f"WHEN {word} LIKE 'r%' THEN 'ERROR: timeout' WHEN k % 3 = 0 THEN 'S-' || {word} || '-' || k "
        "ELSE 'ERROR: Selection failed' END"
    )


_W1, _W2 = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
_TERM_CODES = f"""term_numbers AS (
  SELECT p_name || ' ' || p_brand AS term, p_name, min(p_partkey) AS k FROM part GROUP BY p_name, p_brand),
term_codes AS (
  SELECT term, CASE k % 7 WHEN 0 THEN 'K' || k WHEN 1 THEN 'R' || k WHEN 2 THEN 'V' || k
           WHEN 3 THEN {_sub_code(_W1)} || '|' || {_sub_code(_W2)} WHEN 5 THEN {_sub_code(_W2)}
           ELSE 'ERROR: Splitting/Translation failed: Invalid JSON format.' END AS code,
         CASE k % 7 WHEN 0 THEN 'cache' WHEN 1 THEN 'rule' WHEN 2 THEN 'verdict' WHEN 3 THEN 'search'
           WHEN 5 THEN 'search' ELSE 'error' END AS stage
  FROM term_numbers)"""

_CODED_RECORDS = f"""WITH {_TERM_CODES},
numbered AS (
  SELECT l_orderkey AS record_id, code,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS k
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN term_codes ON term = p_name || ' ' || p_brand)
SELECT record_id, string_agg(code, '|' ORDER BY k) FILTER (WHERE k % 2 = 0) AS "diagnosis1_ICD11_Code",
       string_agg(code, '|' ORDER BY k) FILTER (WHERE k % 2 = 1) AS "diagnosis2_ICD11_Code"
FROM numbered GROUP BY record_id"""
ORACLES["code_cascade"] = _CODED_RECORDS
ORACLES["incremental_coding"] = _CODED_RECORDS

_SEEN = "WHERE term IN (SELECT p_name || ' ' || p_brand FROM lineitem JOIN part ON l_partkey = p_partkey)"
ORACLES["coded_terms"] = f"WITH {_TERM_CODES} SELECT term, code, stage FROM term_codes {_SEEN}"
ORACLES["cache_additions"] = f"""WITH {_TERM_CODES}
SELECT term, code FROM term_codes {_SEEN} AND stage <> 'cache' AND NOT contains(code, 'ERROR:')"""

ORACLES["recorded_candidates"] = """WITH words AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part)
SELECT w AS sub_term, CAST(i AS INTEGER) AS rank, upper(w) || i AS code, w || ' ' || i AS title, '18' AS chapter
FROM words, range(1, 6) AS r(i) WHERE w NOT LIKE 'g%' AND w NOT LIKE 'r%' AND i <= length(w) + 2"""

_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"
ORACLES["candidate_topk"] = f"""WITH {S.LINES},
asked AS (SELECT DISTINCT line AS sub_term FROM doc_lines),
q AS (SELECT sub_term, unnest({_WORDS.format(x='sub_term')}) AS word FROM asked),
titles AS (SELECT 'B' || item_id AS code, {_WORDS.format(x='text')} AS words FROM benchmark),
e AS (SELECT code, len(words) AS n, unnest(words) AS word FROM titles),
scored AS (SELECT sub_term, code, n, count(*) AS score FROM q JOIN e USING (word) GROUP BY sub_term, code, n),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sub_term ORDER BY score DESC, n, code) AS rank FROM scored)
SELECT sub_term, code, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5"""

# -- resume -------------------------------------------------------------------

ORACLES["merge_resume"] = """SELECT o_orderkey AS record_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'later ' || o_orderpriority WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS "diagnosis1_ICD11_Code",
  CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 2 = 0 THEN o_orderstatus END AS "diagnosis2_ICD11_Code" FROM orders"""
ORACLES["resume_unfinished"] = """SELECT o_orderkey AS record_id, o_orderpriority FROM orders
WHERE o_orderkey % 2 <> 0 AND o_orderkey % 3 <> 0"""

# -- repair -------------------------------------------------------------------

_RULES = """rules AS (
  SELECT min(p_partkey) AS rule_no, 'exact' AS mode, p_name AS keyword, 'None' AS wrong_code, 'X-' || p_name AS correct_code,
         CASE WHEN min(p_partkey) % 3 = 0 THEN 'diagnosis1' ELSE 'ALL' END AS scope
  FROM part GROUP BY p_name HAVING min(p_partkey) % 4 <> 0
  UNION ALL
  SELECT 1000000 + min(p_partkey), 'contains',
         CASE min(p_partkey) % 3 WHEN 0 THEN 'anvil' WHEN 1 THEN 'blue' ELSE 'ri' END, p_brand, 'Y-' || p_brand, 'ALL'
  FROM part GROUP BY p_brand HAVING min(p_partkey) % 4 <> 0
  UNION ALL
  SELECT 2000000 + min(p_partkey), 'contains',
         CASE min(p_partkey) % 3 WHEN 0 THEN 'g' WHEN 1 THEN 'o' ELSE 'w' END, '', 'Z-' || p_type, 'ALL'
  FROM part GROUP BY p_type HAVING min(p_partkey) % 4 <> 0)"""
ORACLES["repair_rule_set"] = f"WITH {_RULES} SELECT rule_no, mode, keyword, wrong_code, correct_code, scope FROM rules"

_CHANGES = f"""{_INSPECT}, {_RULES},
slots AS (
  SELECT record_id, col_ord, col, pos, term, norm, code FROM pairs WHERE reason IS NULL
  UNION ALL
  SELECT record_id, col_ord, col, generate_subscripts(clean_terms, 1) - 1, unnest(clean_terms), unnest(clean_norms), ''
  FROM shaped WHERE len(codes) = 0 AND len(clean_terms) > 0),
hits AS (
  SELECT s.*, r.correct_code AS new_code, r.rule_no,
         row_number() OVER (PARTITION BY s.record_id, s.col_ord, s.pos ORDER BY r.mode DESC, r.rule_no) AS rk
  FROM slots s JOIN rules r
    ON (r.wrong_code = s.code OR (r.wrong_code = '' AND lower(s.code) IN ('', 'none', 'nan')))
   AND CASE r.mode WHEN 'exact' THEN r.keyword = s.norm ELSE contains(s.norm, r.keyword) END
   AND r.scope IN ('ALL', s.col)),
changes AS (SELECT * FROM hits WHERE rk = 1 AND code <> new_code)"""
ORACLES["apply_fix_rules"] = f"""{_CHANGES}
SELECT record_id, col_ord, col AS "column", CAST(pos AS INTEGER) AS pos, term, code AS old_code, new_code, rule_no,
       'RULE_UPDATED' AS status FROM changes"""
ORACLES["fix_summary"] = f"""{_CHANGES}
SELECT rule_no, 'RULE_UPDATED' AS status, count(*) AS modifications FROM changes GROUP BY rule_no"""
# Every slot of an aligned cell, noise included, so that untouched codes keep their place.
ORACLES["repaired_records"] = f"""{_CHANGES},
every_slot AS (
  SELECT record_id, col_ord, pos, code FROM pairs
  UNION ALL SELECT record_id, col_ord, pos, 'None' FROM slots WHERE code = ''),
rebuilt AS (
  SELECT e.record_id, e.col_ord, string_agg(coalesce(c.new_code, e.code), '|' ORDER BY e.pos) AS cell, count(c.new_code) AS n
  FROM every_slot e LEFT JOIN changes c USING (record_id, col_ord, pos) GROUP BY e.record_id, e.col_ord)
SELECT records.record_id, CASE WHEN a.n > 0 THEN a.cell ELSE c1 END AS "diagnosis1_ICD11_Code",
       CASE WHEN b.n > 0 THEN b.cell ELSE c2 END AS "diagnosis2_ICD11_Code"
FROM records LEFT JOIN rebuilt a ON a.record_id = records.record_id AND a.col_ord = 0
LEFT JOIN rebuilt b ON b.record_id = records.record_id AND b.col_ord = 1"""

ORACLES["noise_free_records"] = f"""{_INSPECT},
kept_pairs AS (
  SELECT record_id, col_ord, string_agg(code, '|' ORDER BY pos) FILTER (WHERE reason IS NULL) AS cell
  FROM pairs GROUP BY record_id, col_ord),
outcome AS (
  SELECT record_id, col_ord,
         CASE WHEN len(codes) = 0 OR pairing IS NOT NULL OR len(clean_terms) = len(codes)
              THEN nullif(array_to_string(clean_terms, '|'), '') ELSE nullif(array_to_string(terms, '|'), '') END AS t,
         CASE WHEN pairing = 'all' THEN k.cell ELSE nullif(array_to_string(codes, '|'), '') END AS c
  FROM shaped LEFT JOIN kept_pairs k USING (record_id, col_ord))
SELECT records.record_id, a.t AS diagnosis1, a.c AS "diagnosis1_ICD11_Code", b.t AS diagnosis2, b.c AS "diagnosis2_ICD11_Code"
FROM records LEFT JOIN outcome a ON a.record_id = records.record_id AND a.col_ord = 0
LEFT JOIN outcome b ON b.record_id = records.record_id AND b.col_ord = 1"""


ORACLES["global_replace_one"] = f"""WITH {S.CLEAN},
odd AS (SELECT record_id, c1, CASE WHEN record_id % 2 = 0 THEN ' ' || replace(coalesce(c2, ''), '|', ' | ') ELSE c2 END AS c2 FROM records),
pieces AS (
  SELECT *, list_transform(string_split(coalesce(c1, ''), '|'), lambda x: trim(x)) AS p1,
         list_transform(string_split(coalesce(c2, ''), '|'), lambda x: trim(x)) AS p2 FROM odd)
SELECT record_id,
       CASE WHEN list_contains(p1, 'Brand#21') THEN array_to_string(list_transform(p1, lambda x: CASE WHEN x = 'Brand#21' THEN 'Brand#2/X' ELSE x END), '|') ELSE nullif(c1, '') END AS "diagnosis1_ICD11_Code",
       CASE WHEN list_contains(p2, 'Brand#21') THEN array_to_string(list_transform(p2, lambda x: CASE WHEN x = 'Brand#21' THEN 'Brand#2/X' ELSE x END), '|') ELSE nullif(c2, '') END AS "diagnosis2_ICD11_Code"
FROM pieces"""
ORACLES["global_replace_table"] = f"""WITH {S.CLEAN},
last AS (SELECT p_brand AS old_code, p_brand || '-' || max(p_partkey) AS new_code FROM part WHERE suffix(p_brand, '2') GROUP BY p_brand),
spread AS (
  SELECT record_id, 0 AS col_ord, unnest(string_split(c1, '|')) AS x, unnest(range(1, len(string_split(c1, '|')) + 1)) AS i FROM records
  UNION ALL
  SELECT record_id, 1, unnest(string_split(c2, '|')), unnest(range(1, len(string_split(c2, '|')) + 1)) FROM records),
cells AS (
  SELECT record_id, col_ord, string_agg(coalesce(new_code, x), '|' ORDER BY i) AS cell
  FROM spread LEFT JOIN last ON old_code = x GROUP BY record_id, col_ord)
SELECT records.record_id, nullif(a.cell, '') AS "diagnosis1_ICD11_Code", nullif(b.cell, '') AS "diagnosis2_ICD11_Code"
FROM records LEFT JOIN cells a ON a.record_id = records.record_id AND a.col_ord = 0
LEFT JOIN cells b ON b.record_id = records.record_id AND b.col_ord = 1"""


def _sample(name: str, condition: str) -> str:
    return f"""SELECT record_id, uuid, admission_date, col AS "column", array_to_string(terms, '|') AS terms,
       array_to_string(codes, '|') AS codes, '{name}' AS asked FROM cells WHERE {condition}"""


_CODE_TEST = "list_contains(codes, 'Brand#12')"
_WORD_TEST = "len(list_filter(terms, lambda t: contains(t, 'anvil'))) > 0"
ORACLES["sample_query"] = "\nUNION ALL\n".join(
    [f"{_INSPECT}\n{_sample('code', _CODE_TEST)}", _sample("keyword", _WORD_TEST), _sample("both", f"{_CODE_TEST} AND {_WORD_TEST}")]
)

# -- statistics ---------------------------------------------------------------

_ITEMS = f"""WITH {S.NOISY},
codes AS (
  SELECT DISTINCT record_id, trim(unnest(string_split(concat_ws('|', c1, c2), '|'))) AS raw FROM records),
details AS (
  SELECT DISTINCT record_id,
         CASE WHEN raw = 'Brand#2' THEN CASE WHEN record_id % 5 <> 0 AND record_id % 3 = 0 THEN 'Brand#2 at zero' ELSE 'second brand' END
              ELSE raw END AS item
  FROM codes WHERE raw <> '' AND NOT contains(raw, 'ERROR')),
grouped AS (
  SELECT *, CASE WHEN starts_with(item, 'Brand#1') THEN 'G1'
                 WHEN starts_with(item, 'Brand#12') OR starts_with(item, 'Brand#2') THEN 'G2'
                 WHEN starts_with(item, 'Brand#3') OR starts_with(item, 'none of all') THEN 'G3' END AS label FROM details)"""


def _statistics(items: str) -> str:
    return f"""{_ITEMS}, items AS ({items})
SELECT item AS "ICD11_Code_Or_Group", count(*) AS "Total_Occurrences", count(DISTINCT record_id) AS "Patient_Count",
       printf('%.4f%%', count(DISTINCT record_id) / (SELECT count(*) FROM records) * 100) AS "Prevalence"
FROM items GROUP BY item"""


_DETAIL = "SELECT record_id, item FROM grouped"
_LABELS = "SELECT DISTINCT record_id, label AS item FROM grouped WHERE label IS NOT NULL"
ORACLES["code_prevalence"] = _statistics(_DETAIL)
ORACLES["code_prevalence_with_groups"] = _statistics(f"{_DETAIL} UNION {_LABELS}")
ORACLES["code_prevalence_ungrouped"] = _statistics(f"{_DETAIL} WHERE label IS NULL UNION {_LABELS}")
ORACLES["code_prevalence_groups_only"] = _statistics(_LABELS)

ORACLES["prefix_groups"] = """WITH rules AS (
  SELECT substr(p_brand, 1, 7) AS prefix, min(p_partkey) AS rank FROM part GROUP BY 1
  UNION ALL SELECT p_brand, max(p_partkey) FROM part WHERE length(p_brand) > 7 GROUP BY 1),
codes AS (SELECT DISTINCT p_brand AS code FROM part),
hits AS (SELECT code, 'group ' || prefix AS label, row_number() OVER (PARTITION BY code ORDER BY rank) AS rk
         FROM codes JOIN rules ON starts_with(code, prefix))
SELECT code, label FROM codes LEFT JOIN (SELECT * FROM hits WHERE rk = 1) h USING (code)"""

# -- usage and streams --------------------------------------------------------

_CALLS = """WITH calls AS (
  SELECT event_type AS label, event_id % 7 <> 0 AS used, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n,
         CAST(floor(value) AS BIGINT) AS done, event_id % 3 AS kind FROM events),
counted AS (
  SELECT *, CASE WHEN NOT used THEN NULL WHEN kind = 0 THEN n % 5 WHEN kind = 1 THEN n % 4 END AS cached FROM calls)"""
_COUNTERS = """count(*) AS calls, count(*) FILTER (WHERE used) AS calls_with_usage,
       count(cached) AS calls_with_cached_tokens_field, count(*) FILTER (WHERE cached > 0) AS calls_with_cache_hit,
       CAST(sum(CASE WHEN used THEN n ELSE 0 END) AS BIGINT) AS prompt_tokens,
       CAST(sum(CASE WHEN used THEN done ELSE 0 END) AS BIGINT) AS completion_tokens,
       CAST(sum(CASE WHEN used THEN n + done ELSE 0 END) AS BIGINT) AS total_tokens,
       CAST(sum(coalesce(cached, 0)) AS BIGINT) AS cached_tokens"""
ORACLES["usage_summary"] = f"""{_CALLS}
SELECT label, CAST(grouping(label) AS INTEGER) AS is_total, {_COUNTERS} FROM counted GROUP BY ROLLUP (label)"""
ORACLES["usage_stream"] = f"{_CALLS} SELECT label, {_COUNTERS} FROM counted GROUP BY label"

# -- files --------------------------------------------------------------------

ORACLES["csv_round_trip"] = """SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS row, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS part,
       CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN p_name || chr(10) || p_brand
            WHEN 2 THEN '"' || p_type || '", "' || p_name ELSE p_name END AS diagnosis1 FROM part"""
ORACLES["kept_output"] = ORACLES["csv_round_trip"]
_LAST_CODE = f"WITH {_BOOK}\nSELECT term, arg_max(code, line) AS code FROM book GROUP BY term"
ORACLES["dictionary_file"] = _LAST_CODE
ORACLES["rule_file"] = _LAST_CODE
ORACLES["term_log"] = f"""WITH {_BOOK}
SELECT term AS key, coalesce(arg_min(code, line) FILTER (WHERE line % 16 = 0), arg_min(code, line)) AS value FROM book GROUP BY term"""
ORACLES["archived_columns"] = f"""WITH i AS ({ORACLES["legacy_protected"]}),
c AS ({ORACLES["legacy_complications"]})
SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '社会因素' ELSE i.terms END AS indication, c.terms AS complication,
       CASE WHEN p_partkey % 3 = 2 THEN p_name END AS risk,
       CASE WHEN p_partkey % 7 <> 0 THEN i.terms END AS indication_alone,
       CASE p_partkey % 3 WHEN 1 THEN '无并发症' WHEN 2 THEN p_name END AS risk_alone
FROM part JOIN i USING (p_partkey) JOIN c USING (p_partkey)"""
ORACLES["risk_backfill"] = ORACLES["context_rules"].replace("CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END", "''")
ORACLES["searched_cascade"] = """WITH best AS (SELECT p_name, min('P' || p_partkey) AS code FROM part GROUP BY p_name)
SELECT DISTINCT p_name || ' ' || p_brand AS term, code, 'search' AS stage FROM part JOIN best USING (p_name)"""
# Once every pair of a term has the winning code of that term, no rule is left.
ORACLES["audit_loop"] = f"""{_INSPECT}, {S.MAJORITY},
fixed AS (
  SELECT record_id, col_ord, pos, CASE WHEN reason IS NULL THEN coalesce(r.code, p.code) ELSE p.code END AS code
  FROM pairs p LEFT JOIN ranked_codes r ON r.norm = p.norm AND r.rk = 1),
rebuilt AS (SELECT record_id, col_ord, string_agg(code, '|' ORDER BY pos) AS cell FROM fixed GROUP BY record_id, col_ord),
whole AS (
  SELECT r.record_id, coalesce(a.cell, r.c1) AS c1, coalesce(b.cell, r.c2) AS c2
  FROM records r LEFT JOIN rebuilt a ON a.record_id = r.record_id AND a.col_ord = 0
  LEFT JOIN rebuilt b ON b.record_id = r.record_id AND b.col_ord = 1)
SELECT record_id, nullif(c1, '') AS "diagnosis1_ICD11_Code", nullif(c2, '') AS "diagnosis2_ICD11_Code" FROM whole"""
