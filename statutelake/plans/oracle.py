"""DuckDB twins of the corpus tables, assembled into WITH clauses."""

from __future__ import annotations

from statutelake.plans.corpus import CHAPTER_BIT, LAY_WORDS, ORDER_STEP, PRC, STEMS, TOPICS, WORDS

NUM = "[一二三四五六七八九十百千零两]+"


def _numeral(n: int) -> str:
    digits = "零一二三四五六七八九"
    if n < 10:
        return digits[n]
    tens = ("" if n < 20 else digits[n // 10]) + "十"
    return tens + (digits[n % 10] if n % 10 else "")


def words(items: list[str]) -> str:
    return "[" + ",".join("'" + w.replace("'", "''") + "'" for w in items) + "]"


NUMERALS = words([_numeral(i) for i in range(1, 100)])


def num(expr: str) -> str:
    return f"({NUMERALS})[({expr})::INT]"


def pick(items: list[str], expr: str) -> str:
    return f"({words(items)})[({expr})::INT + 1]"


def short(expr: str) -> str:
    return (
        f"({pick(TOPICS, f'({expr}) % {len(TOPICS)}')} || translate(CAST(({expr}) AS VARCHAR), '0123456789', '{STEMS}') || '法')"
    )


_CH = "(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END)"
_SE = "(CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END)"
_PUB = "(DATE '1990-01-01' + CAST((CASE WHEN n % 7 = 0 THEN n * 3 ELSE p_partkey END) * 37 % 12000 AS INT))"
_ORG = "(CASE WHEN kind < 5 THEN '全国人民代表大会常务委员会' WHEN kind < 7 THEN '国务院' WHEN kind < 9 THEN '最高人民法院' ELSE '全国人民代表大会' END)"
_WORDN = len(WORDS)
_CITED = "(l_suppkey * 10 + l_linenumber % 5)"
_TARGET = num("(l_orderkey * 7 + l_suppkey) % 60 + 1")
_LABEL = f"(CASE WHEN l_linenumber = 7 AND l_quantity::INT = 1 THEN '' ELSE '第' || {num('l_orderkey % 60 + 1')} || '条' END)"

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (list(needs), sql)


def titlecase(expr: str) -> str:
    return f"list_aggregate(list_transform(string_split({expr}, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')"


cte("part_n", "SELECT *, p_partkey // 3 AS n, (p_partkey // 3) % 10 AS kind FROM part")
cte(
    "laws",
    f"""SELECT p_partkey AS id,
  CASE WHEN kind < 5 THEN '{PRC}' || {short('n')}
       WHEN kind < 7 THEN '{PRC}' || {short('n - 5')} || '实施条例'
       WHEN kind < 9 THEN '最高人民法院关于适用《{PRC}' || {short('n - 7')} || '》若干问题的解释'
       ELSE '{PRC}' || {short('n - 9')} || '修正案' END AS title,
  CASE WHEN p_partkey % 5 <> 0 THEN {titlecase("p_name || ' ' || p_type || ' law'")} END AS title_en,
  CASE WHEN kind < 5 THEN '法律' WHEN kind < 7 THEN '行政法规' WHEN kind < 9 THEN '司法解释' ELSE '修正案' END AS category,
  {pick(['民法商法','经济法','行政法','社会法','刑法','诉讼与非诉讼程序法','宪法相关法','民法典',''], 'p_size % 9')} AS legal_domain,
  strftime({_PUB}, '%Y-%m-%d') AS pub_date,
  CASE WHEN p_partkey % 11 = 0 THEN '' ELSE strftime({_PUB} + 30, '%Y-%m-%d') END AS effective_date,
  strftime({_PUB}, '%Y年%-m月%-d日') || {_ORG} || '公布　自' || strftime({_PUB} + 30, '%Y年%-m月%-d日') || '起施行' AS promulgation_info,
  {_ORG} AS issuing_org,
  CASE WHEN kind IN (7, 8) THEN '法释〔' || year({_PUB}) || '〕' || (p_partkey % 40) || '号' ELSE '' END AS doc_number,
  '为了规范' || p_name || '，根据《{PRC}' || {short('n * 7 // 10 * 10')} || '》，制定本法。' || p_brand || ' ' || p_type AS full_text,
  CASE WHEN (p_partkey % 3 = 2) <> (p_partkey % 50 = 7) THEN 1 ELSE 0 END AS is_current,
  CASE WHEN kind < 5 THEN {short('n')} ELSE '' END AS aliases,
  CASE WHEN p_partkey % 4 = 3 THEN 'gazette' ELSE 'flk' END AS source,
  CASE WHEN p_partkey % 13 = 0 THEN '法释〔2020〕16号（2021-01-01施行，第6项）' ELSE '' END AS repealed_by
FROM part_n""",
    "part_n",
)
cte(
    "articles",
    f"""SELECT l_partkey AS law_id, 'article' AS type, CAST(NULL AS INT) AS part_num, {_CH} AS chapter_num, {_SE} AS section_num,
  CAST(l_orderkey % 60 + 1 AS INT) AS article_num, nullif({_LABEL}, '') AS article_number,
  {_LABEL} || '　'
  || CASE WHEN l_linenumber % 2 = 1 THEN '依照《{PRC}' || {short(_CITED)} || '》第' || {_TARGET} || '条的规定，' ELSE '' END
  || CASE WHEN l_linenumber % 4 = 2 THEN '参照' || {short(_CITED)} || '第' || {_TARGET} || '条，' ELSE '' END
  || {pick(WORDS, f'l_suppkey % {_WORDN}')} || '的当事人应当在' || (l_quantity::INT) || '日内承担' || {pick(WORDS, f'(l_orderkey + l_linenumber) % {_WORDN}')} || '。'
  || CASE WHEN l_quantity::INT % 3 = 0 THEN '本法第' || {num('l_quantity')} || '条规定的情形除外。' ELSE '' END
  || CASE WHEN l_linenumber % 3 = 0 THEN chr(10) || '（一）申请人；' || chr(10) || '（二）被申请人。' ELSE '' END
  || CASE WHEN l_suppkey % 20 = 0 THEN '－PAGE  2－' WHEN l_suppkey % 20 = 1 THEN '自l月起，HYPERLINK "x" 适用GDP标准ABC。' ELSE '' END AS content,
  CASE WHEN l_linenumber % 5 <> 0 THEN 'Article ' || (l_orderkey % 60 + 1) || ' The party shall pay within ' || (l_quantity::INT)
   || ' days. If the amount exceeds the limit, the people court ' || CASE WHEN l_suppkey % 4 = 0 THEN 'will' ELSE 'may' END || ' decide the case.'
   || CASE WHEN l_suppkey % 25 = 3 THEN ' See 《X》第三条。' ELSE '' END END AS content_en,
  ({_CH} * 4 + {_SE}) * {CHAPTER_BIT} + (l_orderkey * 8 + l_linenumber) * {ORDER_STEP} + l_suppkey % {ORDER_STEP // 5} * 5 AS global_order
FROM lineitem""",
)
cte(
    "headings",
    f"""SELECT law_id, CASE WHEN se = 0 THEN 'chapter' ELSE 'section' END AS type, CAST(NULL AS INT) AS part_num, ch AS chapter_num,
  nullif(se, 0) AS section_num, CAST(NULL AS INT) AS article_num, CAST(NULL AS VARCHAR) AS article_number,
  CASE WHEN se = 0 THEN '第' || {num('ch')} || '章　' || {pick(['总则', '合同与责任', '附则'], 'ch - 1')}
       ELSE '第' || {num('se')} || '节　' || {pick(['一般规定', '特别规定'], 'se - 1')} END AS content,
  CASE WHEN law_id % 3 = 0 THEN CASE WHEN se = 0 THEN 'Chapter' ELSE 'Section' END END AS content_en,
  (ch * 4 + se) * {CHAPTER_BIT} AS global_order
FROM (SELECT DISTINCT l_partkey AS law_id, {_CH} AS ch, unnest([0, {_SE}]) AS se FROM lineitem)""",
)
cte(
    "law_lines",
    """SELECT law_id AS doc, global_order + pos - 1 AS line_no, trim(raw, ' 　') AS text FROM (
  SELECT law_id, global_order, unnest(string_split(content, chr(10))) AS raw, generate_subscripts(string_split(content, chr(10)), 1) AS pos FROM nodes)
 WHERE trim(raw, ' 　') <> ''""",
    "nodes",
)
cte("nodes", "SELECT * FROM articles UNION ALL SELECT * FROM headings", "articles", "headings")


def _case_cite(n: str, prefix: str, number: str) -> str:
    return f"'《{prefix}' || {short(n)} || '》第' || {num(number)} || '条'"


_SRC = "(CASE o_orderstatus WHEN 'F' THEN 'judgment' WHEN 'O' THEN 'guiding' ELSE 'court' END)"
_CW = pick(WORDS, f"o_custkey % {_WORDN}")
_C1 = "(o_custkey // 15 * 10 + o_orderkey % 5)"
_C2 = "(o_custkey // 15 * 10 + o_orderkey // 5 % 5)"
cte(
    "cases",
    f"""SELECT {_SRC} || '/' || o_orderkey AS doc_key, {_SRC} AS source,
  CASE WHEN o_orderkey % 6 = 0 THEN '指导性案例' || (o_orderkey % 300) || '号：' ELSE '' END || {_CW} || '纠纷案' AS title,
  strftime(o_orderdate, '%Y-%m-%d') AS pub_date, CAST(year(o_orderdate) AS INT) AS year,
  CASE WHEN o_orderkey % 10 < 3 THEN '要旨：' || {_CW} ELSE '' END AS ruling_gist,
  CASE WHEN o_orderkey % 10 = 1 THEN {_CW} || '、民事' ELSE '' END AS keywords,
  CASE WHEN o_orderkey % 3 = 0 THEN '【裁判要点】' || {_CW} || '应当依法认定。' || chr(10) || chr(10) ELSE '' END
  || CASE WHEN o_orderkey % 4 = 0 THEN '【关键词】民事/' || {_CW} || chr(10) ELSE '' END
  || '法院认为，根据' || {_case_cite(_C1, PRC, 'o_orderkey % 60 + 1')} || '、' || {_case_cite(_C2, '', 'o_orderkey * 3 % 60 + 1')}
  || '，并参照' || {_case_cite(_C1, PRC, 'o_orderkey % 60 + 1')} || '，判决如下：驳回' || {_CW} || '请求。' AS full_text,
  CASE WHEN o_orderkey % 7 < 5 THEN 'Case ' || o_orderkey END AS title_en,
  CASE WHEN o_orderkey % 7 < 4 THEN 'The court shall dismiss the claim.' END AS full_text_en
FROM orders""",
)
_Q1 = f"length(text) % {_WORDN}"
_Q2 = f"(length(text) + turn * 7 + 3) % {_WORDN}"
cte(
    "questions",
    f"""SELECT conv_id * 1000 + turn AS q_id,
  '请问' || {pick(LAY_WORDS, _Q1)} || '以后怎么要求' || {pick(WORDS, _Q2)}
  || CASE WHEN length(text) % 4 = 0 THEN '，金额' || length(text) || '元' ELSE '' END
  || CASE WHEN length(text) % 5 = 0 THEN '，2023年' || (length(text) % 12 + 1) || '月发生' ELSE '' END AS text,
  {pick(LAY_WORDS, _Q1)} AS lay_term, {pick(WORDS, _Q2)} AS legal_term
FROM conversations WHERE role = 'user'""",
)
cte(
    "question_terms",
    "SELECT q_id, 0 AS pos, lay_term AS term FROM questions UNION ALL SELECT q_id, 1, legal_term FROM questions",
    "questions",
)
cte(
    "doc_lines",
    """SELECT doc_id, lang, CAST(pos - 1 AS INT) AS pos, trim(raw, ' ') AS text FROM (
  SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
 WHERE trim(raw, ' ') <> ''""",
)


def sql(body: str, *needs: str) -> str:
    """``body`` behind a WITH clause of the corpus tables it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    head = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in ordered)
    joiner = ",\n" if body.lstrip().startswith(",") else "\n"
    return f"WITH {head}{joiner}{body.lstrip().lstrip(',')}"
