"""Text rules as column expressions.

Java's ``\\s`` and ``\\w`` are ASCII by default; ``(?U)`` makes them Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statutelake.functions.numerals import numeral_to_int, year_numeral_to_int

CJK = "\\u4e00-\\u9fff"
SUPREME, PROCURATORATE, POLICE = "最高人民法院", "最高人民检察院", "公安部"
# Issuers that sign together, joined by 、 instead of a blank.
JOINT_ISSUERS = [(SUPREME, PROCURATORATE), (PROCURATORATE, SUPREME), (PROCURATORATE, POLICE), (SUPREME, POLICE)]
# Chinese punctuation and its English form.
PUNCTUATION = "“”‘’，。；：！？（）【】《》　"
PUNCTUATION_EN = "\"\"'',.;:!?()[]\"\" "


def strip(text: Column) -> Column:
    """Trim with Unicode blanks, so that the full-width blank goes too."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalize_title(title: Column) -> Column:
    """H4: full-width blanks, joint issuers, gaps between ideographs."""
    out = F.replace(title, F.lit("　"), F.lit(" "))
    for first, second in JOINT_ISSUERS:
        out = F.regexp_replace(out, f"{first} +{second}", f"{first}、{second}")
    out = F.regexp_replace(out, f"({SUPREME}|{PROCURATORATE}|{POLICE}|国家安全部|司法部) +", "$1")
    out = F.regexp_replace(out, "([）》」』］]) +", "$1")
    out = F.regexp_replace(out, f"([{CJK}]) +(?=[{CJK}])", "$1")
    return F.trim(F.regexp_replace(out, " +", " "))


def title_key(title: Column) -> Column:
    """H5: comparison key without blanks."""
    return F.regexp_replace(title, r"[\s　]", "")


def clean_text(text: Column) -> Column:
    """H6: single line breaks, trimmed lines, single blanks."""
    out = F.regexp_replace(text, "\n{2,}", "\n")
    out = F.regexp_replace(out, r"(?U)[^\S\n]*\n[^\S\n]*", "\n")
    return strip(F.regexp_replace(out, "[ \t]{2,}", " "))


def clean_article(text: Column) -> Column:
    """H7: page fields, hyperlinks and the letter l read as 1."""
    out = F.regexp_replace(text, r"(?U)[-－]\s*PAGE\s+\d+\s*[-－]", "")
    out = F.regexp_replace(out, r"(?U)\bPAGE\s*\\\*\s*MERGEFORMAT\b|\bMERGEFORMAT\b|\bPAGE\b", "")
    out = F.regexp_replace(out, r'(?U)HYPERLINK\s*"[^"]*"\s*', "")
    out = F.regexp_replace(out, r"(?U)(?<!\w)l(?=[月年日万千百元％%个项条款位]|\d)", "1")
    out = F.regexp_replace(out, "(?<=[(（])l(?=[-－])", "1")
    return F.array_join(F.filter(F.split(out, "\r\n|[\n\r\u000b\u000c\u0085\u2028\u2029]"), lambda line: strip(line) != ""), "\n")


def stem_date(stem: Column) -> Column:
    """H8: date in a file stem such as name_20200528."""
    digits = F.regexp_extract(stem, r"_(\d{8})$", 1)
    return F.when(digits != "", F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)))


def stem_title(stem: Column) -> Column:
    """H8: title in a file stem."""
    out = F.trim(F.regexp_replace(F.regexp_replace(stem, r"_\d{8}$", ""), "[ \t]+", " "))
    for first, second in JOINT_ISSUERS:
        out = F.regexp_replace(out, f"{first} +{second}", f"{first}、{second}")
    return out


def english_punctuation(text: Column) -> Column:
    """H9: English signs; blanks are folded inside each line only."""
    out = F.translate(F.replace(text, F.lit("、"), F.lit(", ")), PUNCTUATION, PUNCTUATION_EN)
    lines = F.transform(F.split(out, "\n"), lambda line: strip(F.regexp_replace(line, r"(?U)\s+", " ")))
    return F.array_join(lines, "\n")


def break_lists(text: Column) -> Column:
    """List items onto their own lines."""
    out = F.regexp_replace(text, r"(?<=[;:.]) (\([0-9一二三四五六七八九十]+\))", "\n$1")
    out = F.regexp_replace(out, r"; or (\([0-9]+\))", "\n$1")
    return F.regexp_replace(out, "\n +", "\n")


def issue_year(issue: Column) -> Column:
    return F.regexp_extract(issue, r"(\d{4})年", 1).try_cast("int")


def issue_number(issue: Column) -> Column:
    return F.regexp_extract(issue, r"第?(\d+)期", 1).try_cast("int")


def file_name(title: Column, limit: int = 80) -> Column:
    """Title as a safe file name."""
    return F.substring(F.regexp_replace(F.trim(title), r'[\\/:*?"<>|\s]+', "_"), 1, limit)


def cjk_count(text: Column) -> Column:
    """Number of ideographs."""
    return F.length(F.regexp_replace(text, f"[^{CJK}]", ""))


def windows(text: Column, width: int, initials: list[str] | None = None) -> Column:
    """Up to ``width`` characters from every position, in one linear pass.

    ``substring`` would count from the start of the text at each position. With
    ``initials`` only positions that hold one of these characters count.
    """
    first = "." if initials is None else "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in initials) + "]"
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=({first}.{{0,{width - 1}}})){first}"), F.lit(1))


def ngrams(text: Column, n: int) -> Column:
    """Character n-grams, empty for shorter texts."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))


def keyword_list(text: Column) -> Column:
    """Delimited keywords to an array without blanks."""
    return F.filter(F.transform(F.split(text, "[、，,/;；\\s]+"), lambda x: F.trim(x)), lambda k: k != "")


def path_parts(path: Column) -> Column:
    """Directory parts of a slash path, blanks dropped."""
    return F.filter(F.split(path, "/"), lambda p: F.trim(p) != "")


def relative_prefix(group: Column, subgroup: Column) -> Column:
    """../ once per directory level of the source document."""
    depth = F.size(path_parts(F.concat_ws("/", group, subgroup)))
    return F.repeat(F.lit("../"), depth)


def repeal_number(mark: Column) -> Column:
    """Number of the repealing decision in front of the bracket."""
    return F.trim(F.regexp_extract(mark, "^([^（(]+)", 1))


def fix_labels(text: Column) -> Column:
    """One full-width blank behind an article label that starts a line,
    but not where the label is the object of an amendment verb."""
    numeral = "[零一二三四五六七八九十百千]+"
    verbs = "增加|删除|删去|修改|改为|废止|并入|调整为|未变|的规定|的内容"
    out = F.regexp_replace(text, f"(?m)^(第{numeral})(?U:\\s+)条", "$1条")
    return F.regexp_replace(out, f"(?m)^(第{numeral}条)(?!(?U:[　\\s])|{verbs})", "$1　")


def ruling_gist(text: Column, longest: int | None = None) -> Column:
    """Gist after one of three markers, bracketed or as a heading line;
    ``longest`` cuts it to so many characters."""
    found = []
    for marker in ["裁判要点", "裁判摘要", "裁判要旨"]:
        found.append(F.regexp_extract(text, f"(?s)【{marker}】(?U:\\s*)(.+?)(?=\\n\\n|\\n【|$)", 1))
        stop = "\\n\\n(?:基本案情|裁判结果|相关法条|关键词|一、|二、)"
        found.append(F.regexp_extract(text, f"(?s)(?:^|\\n){marker}(?U:\\s*)\\n(.+?)(?={stop}|$)", 1))
    first = F.coalesce(*[F.nullif(f, F.lit("")) for f in found], F.lit(""))
    return strip(first) if longest is None else F.substring(strip(first), 1, longest)


def marked_keywords(text: Column, longest: int | None = None) -> Column:
    """Keywords behind the marker, in three layouts; ``longest`` reads so
    many characters of them."""
    most = "" if longest is None else longest
    bracket = F.regexp_extract(text, rf"【关键词】(?U:\s*)(.{{2,{most}}}?)(?:\n|$)", 1)
    below = F.regexp_extract(text, rf"(?:^|\n)关键词(?U:\s*)\n[\s\n]*([^\n]{{2,{most}}})", 1)
    beside = F.regexp_extract(text, rf"(?:^|\n)关键词[　\s]+([^\n]{{2,{most}}})", 1)
    slashes = [F.replace(strip(k), F.lit("/"), F.lit("、")) for k in (below, beside)]
    picked = F.coalesce(F.nullif(strip(bracket), F.lit("")), *[F.nullif(k, F.lit("")) for k in slashes], F.lit(""))
    return picked if longest is None else F.substring(picked, 1, longest)


# Words looked for when a document names no keywords.
KEYWORDS = [
    "合同纠纷", "买卖合同", "借款合同", "租赁合同", "建设工程合同", "服务合同", "劳动合同", "承揽合同", "运输合同", "保险合同",
    "委托合同", "赠与合同", "民间借贷", "网络服务合同", "侵权责任", "人身损害赔偿", "交通事故", "医疗纠纷", "产品责任", "名誉权",
    "肖像权", "隐私权", "著作权", "专利权", "商标权", "不正当竞争", "物权", "房屋买卖", "土地使用权", "征收补偿", "业主权利",
    "抵押权", "质权", "婚姻", "离婚", "子女抚养", "监护权", "探望权", "遗产继承", "遗嘱", "股权转让", "股东权利", "公司解散",
    "破产", "票据", "保险理赔", "证券", "担保", "保证", "抵押", "质押", "正当防卫", "紧急避险", "故意伤害", "故意杀人", "盗窃",
    "诈骗", "贪污", "受贿", "行贿", "走私", "毒品", "强奸", "抢劫", "虐待", "组织卖淫", "行政诉讼", "行政许可", "行政处罚",
    "行政赔偿", "国家赔偿", "执行异议", "申请再审", "管辖权", "诉讼时效", "仲裁", "专利无效", "商标注册", "著作权侵权",
    "知识产权", "劳动争议", "工伤", "社会保险", "经济补偿",
]


def inferred_keywords(title: Column, gist: Column, text: Column, limit: int = 8, opening: int | None = None) -> Column:
    """Dictionary words in title, gist and text, then the dispute names in
    the title; ``opening`` looks at so many characters of the text only."""
    opening = F.concat_ws(" ", title, gist, text if opening is None else F.substring(text, 1, opening))
    known = F.filter(F.array(*[F.lit(k) for k in KEYWORDS]), lambda k: F.contains(opening, k))
    named = F.regexp_extract_all(title, F.lit("[一-龥]{2,10}(?:纠纷|争议|案件)"), F.lit(0))
    return F.array_join(F.slice(F.array_distinct(F.concat(known, named)), 1, limit), "、")


def case_number(title: Column) -> Column:
    """Number of a guiding case, or NULL."""
    return F.nullif(F.regexp_extract(title, r"(指导性案例\d+号)", 1), F.lit(""))


def merged_keywords(meta: Column, old: Column) -> Column:
    """Facet values first, then the old words, each once."""
    facets = F.flatten(F.map_values(meta))
    return F.array_join(F.array_distinct(F.concat(facets, keyword_list(F.coalesce(old, F.lit(""))))), "、")


def _iso(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))


def arabic_effective_date(text: Column) -> Column:
    """G9 step 1: Arabic date followed by 'enters into force'."""
    p = r"(\d{4})年(\d{1,2})月(\d{1,2})日起施行"
    return F.when(text.rlike(p), _iso(*[F.regexp_extract(text, p, i) for i in (1, 2, 3)]))


def numeral_effective_date(text: Column) -> Column:
    """G9 step 2: the same in Chinese numerals (H3)."""
    p = "([一二三四五六七八九〇○零]{4})年([一二三四五六七八九十]{1,3})月([一二三四五六七八九十]{1,3})日.*?施行"
    year, month, day = [F.regexp_extract(text, p, i) for i in (1, 2, 3)]
    return F.when(text.rlike(p), _iso(year_numeral_to_int(year), numeral_to_int(month), numeral_to_int(day)))


def since_publication_date(text: Column) -> Column:
    """G9 step 3: last date before 'from the day of publication'."""
    p = r"(\d{4}年\d{1,2}月\d{1,2}日[^。；\n]*?)自(?:发布|公布|批准|颁布)之日起施行"
    dates = F.regexp_extract_all(F.regexp_extract(text, p, 1), F.lit(r"\d{4}年\d{1,2}月\d{1,2}日"), F.lit(0))
    last = F.element_at(dates, -1)
    d = r"(\d{4})年(\d{1,2})月(\d{1,2})日"
    return F.when(F.size(dates) > 0, _iso(*[F.regexp_extract(last, d, i) for i in (1, 2, 3)]))
