"""Statute corpus derived from the driver tables.

Every table here is a projection of one driver table (headings add one
map-side combined aggregation), so the corpus grows with the input and costs
no shuffle of its own. The words below are only text to put into the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRC = "中华人民共和国"
TOPICS = [
    "合同", "公司", "专利", "商标", "保险", "税收", "银行", "证券", "劳动", "就业促进",
    "环境保护", "教育", "海商", "仲裁", "行政处罚", "刑事诉讼", "民事诉讼", "国家赔偿", "选举", "档案",
]
WORDS = [
    "违约责任", "合同解除", "损害赔偿", "劳动合同", "经济补偿", "工资拖欠", "工伤认定", "消费者权益",
    "名誉权", "隐私权", "故意伤害", "诉讼时效", "刑事责任", "行政处罚", "侵权责任", "财产保全",
    "遗产继承", "股东权利", "产品责任", "交通肇事", "担保", "抵押", "借款合同", "租赁合同",
    "知识产权", "监护权", "离婚", "仲裁", "破产", "社会保险",
]
# What a lay person calls the word of the same position.
LAY_WORDS = [
    "赖账", "退约", "赔钱", "雇佣协议", "遣散费", "欠薪", "上班受伤", "买到假货",
    "被造谣", "偷拍", "打人", "过期起诉", "坐牢", "罚款", "伤害别人", "冻结账户",
    "分遗产", "小股东", "次品", "撞人", "作保", "押房", "借钱", "租房",
    "盗版", "带孩子", "分手", "公断", "倒闭", "五险",
]
STEMS = "甲乙丙丁戊己庚辛壬癸"
CHAPTER_BIT = 400_000_000_000_000_000  # chapter and section part of global_order
ORDER_STEP = 100_000                   # room for the supplier and for the text lines of one article
SEGMENT = 8 * 4096 * ORDER_STEP        # reading-order span handled by one task group


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core for a small input that was read in few splits.

    Only the planned split count is looked at. An input with enough splits, as
    any large one has, is left alone and is never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _pick(words: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (index + 1).cast("int"))


_ONES = ["", "一", "二", "三", "四", "五", "六", "七", "八", "九"]
NUMERALS = [(["", "十"] + [d + "十" for d in _ONES[2:]])[i // 10] + _ONES[i % 10] for i in range(1, 100)]


def _numeral(n: Column) -> Column:
    """Numeral of 1..99 by lookup; the general form is functions.numerals."""
    return _pick(NUMERALS, n - 1)


def _stem(n: Column) -> Column:
    return F.translate(n.cast("string"), "0123456789", STEMS)


def short_title(n: Column) -> Column:
    return F.concat(_pick(TOPICS, n % len(TOPICS)), _stem(n), F.lit("法"))


def laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per law version: three consecutive part keys share a title."""
    k = F.col("p_partkey")
    base = (
        spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
        .withColumn("n", F.expr("p_partkey div 3"))
        .withColumn("kind", F.col("n") % 10)
    )
    n, kind = F.col("n"), F.col("kind")
    category = (
        F.when(kind < 5, "法律").when(kind < 7, "行政法规").when(kind < 9, "司法解释").otherwise("修正案")
    )
    title = (
        F.when(kind < 5, F.concat(F.lit(PRC), short_title(n)))
        .when(kind < 7, F.concat(F.lit(PRC), short_title(n - 5), F.lit("实施条例")))
        .when(kind < 9, F.concat(F.lit(f"最高人民法院关于适用《{PRC}"), short_title(n - 7), F.lit("》若干问题的解释")))
        .otherwise(F.concat(F.lit(PRC), short_title(n - 9), F.lit("修正案")))
    )
    offset = (F.when(n % 7 == 0, n * 3).otherwise(k) * 37 % 12000).cast("int")
    pub = F.date_add(F.to_date(F.lit("1990-01-01")), offset)
    org = F.when(kind < 5, "全国人民代表大会常务委员会").when(kind < 7, "国务院").when(kind < 9, "最高人民法院").otherwise("全国人民代表大会")
    return base.select(
        k.alias("id"),
        title.alias("title"),
        F.when(k % 5 != 0, F.initcap(F.concat_ws(" ", "p_name", "p_type", F.lit("law")))).alias("title_en"),
        F.concat(title, F.lit("_"), F.date_format(pub, "yyyyMMdd")).alias("filename"),
        category.alias("category"),
        _pick(
            ["民法商法", "经济法", "行政法", "社会法", "刑法", "诉讼与非诉讼程序法", "宪法相关法", "民法典", ""],
            F.col("p_size") % 9,
        ).alias("legal_domain"),
        F.date_format(pub, "yyyy-MM-dd").alias("pub_date"),
        F.when(k % 11 == 0, "").otherwise(F.date_format(F.date_add(pub, 30), "yyyy-MM-dd")).alias("effective_date"),
        F.concat(
            F.date_format(pub, "yyyy年M月d日"), org, F.lit("公布　自"),
            F.date_format(F.date_add(pub, 30), "yyyy年M月d日"), F.lit("起施行"),
        ).alias("promulgation_info"),
        org.alias("issuing_org"),
        F.when(kind.isin(7, 8), F.concat(F.lit("法释〔"), F.year(pub), F.lit("〕"), k % 40, F.lit("号")))
        .otherwise("").alias("doc_number"),
        F.concat(
            F.lit("为了规范"), F.col("p_name"), F.lit("，根据《"), F.lit(PRC), short_title(F.expr("n * 7 div 10 * 10")),
            F.lit("》，制定本法。"), F.col("p_brand"), F.lit(" "), F.col("p_type"),
        ).alias("full_text"),
        F.when((k % 3 == 2) != (k % 50 == 7), 1).otherwise(0).alias("is_current"),
        F.when(kind < 5, short_title(n)).otherwise("").alias("aliases"),
        F.when(k % 4 == 3, "gazette").otherwise("flk").alias("source"),
        F.when(k % 13 == 0, "法释〔2020〕16号（2021-01-01施行，第6项）").otherwise("").alias("repealed_by"),
    )


def _chapter() -> Column:
    return F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)


def _section() -> Column:
    return F.when(F.col("l_linestatus") == "F", 1).otherwise(2)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item; the reading order is a unique key inside a law."""
    order, line, supp, qty = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_quantity").cast("int")
    num = (order % 60 + 1).cast("int")
    label = F.when((line == 7) & (qty == 1), "").otherwise(F.concat(F.lit("第"), _numeral(num), F.lit("条")))
    cited, target = supp * 10 + line % 5, _numeral((order * 7 + supp) % 60 + 1)
    content = F.concat(
        label,
        F.lit("　"),
        F.when(line % 2 == 1, F.concat(F.lit(f"依照《{PRC}"), short_title(cited), F.lit("》第"), target, F.lit("条的规定，"))).otherwise(""),
        F.when(line % 4 == 2, F.concat(F.lit("参照"), short_title(cited), F.lit("第"), target, F.lit("条，"))).otherwise(""),
        _pick(WORDS, supp % len(WORDS)),
        F.lit("的当事人应当在"), qty, F.lit("日内承担"), _pick(WORDS, (order + line) % len(WORDS)), F.lit("。"),
        F.when(qty % 3 == 0, F.concat(F.lit("本法第"), _numeral(qty), F.lit("条规定的情形除外。"))).otherwise(""),
        F.when(line % 3 == 0, F.lit("\n（一）申请人；\n（二）被申请人。")).otherwise(""),
        F.when(supp % 20 == 0, F.lit("－PAGE  2－")).when(supp % 20 == 1, F.lit("自l月起，HYPERLINK \"x\" 适用GDP标准ABC。")).otherwise(""),
    )
    english = F.when(
        line % 5 != 0,
        F.concat(
            F.lit("Article "), num, F.lit(" The party shall pay within "), qty, F.lit(" days. If the amount exceeds the limit, the people court "),
            F.when(supp % 4 == 0, "will").otherwise("may"), F.lit(" decide the case."),
            F.when(supp % 25 == 3, F.lit(" See 《X》第三条。")).otherwise(""),
        ),
    )
    seq = (order * 8 + line) * ORDER_STEP + supp % (ORDER_STEP // 5) * 5
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    return spread(lines).select(
        F.col("l_partkey").alias("law_id"),
        F.lit("article").alias("type"),
        F.lit(None).cast("int").alias("part_num"),
        _chapter().alias("chapter_num"),
        _section().alias("section_num"),
        num.alias("article_num"),
        F.when(label != "", label).alias("article_number"),
        content.alias("content"),
        english.alias("content_en"),
        ((_chapter() * 4 + _section()) * F.lit(CHAPTER_BIT) + seq).alias("global_order"),
    )


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter and section nodes of the laws that have articles in them."""
    sections = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_partkey").alias("law_id"), _chapter().alias("chapter_num"), _section().alias("section_num"))
        .distinct()
    )
    both = sections.unionByName(
        sections.select("law_id", "chapter_num", F.lit(0).alias("section_num")).distinct()
    )
    is_chapter = F.col("section_num") == 0
    title = F.when(
        is_chapter,
        F.concat(F.lit("第"), _numeral(F.col("chapter_num")), F.lit("章　"), _pick(["总则", "合同与责任", "附则"], F.col("chapter_num") - 1)),
    ).otherwise(F.concat(F.lit("第"), _numeral(F.col("section_num")), F.lit("节　"), _pick(["一般规定", "特别规定"], F.greatest(F.col("section_num") - 1, F.lit(0)))))
    return both.select(
        "law_id",
        F.when(is_chapter, "chapter").otherwise("section").alias("type"),
        F.lit(None).cast("int").alias("part_num"),
        "chapter_num",
        F.when(~is_chapter, F.col("section_num")).alias("section_num"),
        F.lit(None).cast("int").alias("article_num"),
        F.lit(None).cast("string").alias("article_number"),
        title.alias("content"),
        F.when(F.col("law_id") % 3 == 0, F.when(is_chapter, "Chapter").otherwise("Section")).alias("content_en"),
        ((F.col("chapter_num") * 4 + F.col("section_num")) * F.lit(CHAPTER_BIT)).alias("global_order"),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).unionByName(headings(spark, sf_dir))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Court documents from orders; each cites two laws."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    source = F.when(F.col("o_orderstatus") == "F", "judgment").when(F.col("o_orderstatus") == "O", "guiding").otherwise("court")

    def cite(n: Column, prefix: str, number: Column) -> Column:
        return F.concat(F.lit(f"《{prefix}"), short_title(n), F.lit("》第"), _numeral(number), F.lit("条"))

    first = F.expr("o_custkey div 15") * 10 + key % 5
    second = F.expr("o_custkey div 15") * 10 + F.expr("o_orderkey div 5") % 5
    word = _pick(WORDS, cust % len(WORDS))
    text = F.concat(
        F.when(key % 3 == 0, F.concat(F.lit("【裁判要点】"), word, F.lit("应当依法认定。\n\n"))).otherwise(""),
        F.when(key % 4 == 0, F.concat(F.lit("【关键词】民事/"), word, F.lit("\n"))).otherwise(""),
        F.lit("法院认为，根据"), cite(first, PRC, key % 60 + 1), F.lit("、"), cite(second, "", key * 3 % 60 + 1),
        F.lit("，并参照"), cite(first, PRC, key % 60 + 1), F.lit("，判决如下：驳回"), word, F.lit("请求。"),
    )
    return table(spark, sf_dir, "orders").select(
        F.concat_ws("/", source, key).alias("doc_key"),
        source.alias("source"),
        F.concat(
            F.when(key % 6 == 0, F.concat(F.lit("指导性案例"), key % 300, F.lit("号："))).otherwise(""),
            word, F.lit("纠纷案"),
        ).alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("pub_date"),
        F.year("o_orderdate").alias("year"),
        F.when(key % 10 < 3, F.concat(F.lit("要旨："), word)).otherwise("").alias("ruling_gist"),
        F.when(key % 10 == 1, F.concat(word, F.lit("、民事"))).otherwise("").alias("keywords"),
        text.alias("full_text"),
        F.when(key % 7 < 5, F.concat(F.lit("Case "), key)).alias("title_en"),
        F.when(key % 7 < 4, F.lit("The court shall dismiss the claim.")).alias("full_text_en"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lay questions, one per user turn."""
    length, turn = F.length("text"), F.col("turn")
    first, second = length % len(WORDS), (length + turn * 7 + 3) % len(WORDS)
    return table(spark, sf_dir, "conversations").filter(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + turn).alias("q_id"),
        F.concat(
            F.lit("请问"), _pick(LAY_WORDS, first), F.lit("以后怎么要求"), _pick(WORDS, second),
            F.when(length % 4 == 0, F.concat(F.lit("，金额"), length, F.lit("元"))).otherwise(""),
            F.when(length % 5 == 0, F.concat(F.lit("，2023年"), length % 12 + 1, F.lit("月发生"))).otherwise(""),
        ).alias("text"),
        _pick(LAY_WORDS, first).alias("lay_term"),
        _pick(WORDS, second).alias("legal_term"),
    )


def question_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(q_id, pos, term): the two terms of each question."""
    return questions(spark, sf_dir).select(
        "q_id", F.posexplode(F.array("lay_term", "legal_term")).alias("pos", "term")
    )


def law_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The laws as text: (doc, line_no, text), trimmed and non-empty."""
    parts = F.split("content", "\n")
    rows = nodes(spark, sf_dir).select("law_id", "global_order", F.posexplode(parts).alias("pos", "raw"))
    return rows.select(
        F.col("law_id").alias("doc"),
        (F.col("global_order") + F.col("pos")).alias("line_no"),
        F.regexp_replace("raw", r"(?U)^\s+|\s+$", "").alias("text"),
    ).filter(F.col("text") != "")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed, non-empty, numbered lines of the documents."""
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
        .select("doc_id", "lang", "pos", F.trim("raw").alias("text"))
        .filter(F.col("text") != "")
    )
