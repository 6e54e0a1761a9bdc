"""Rule tables as plain data. Larger tables are passed by the caller."""

from __future__ import annotations

# Domain, keywords; the order breaks ties.
DOMAIN_RULES = [
    ("刑法", ["刑法", "刑事", "犯罪", "罪名", "量刑", "追诉", "减刑", "假释", "定罪", "逮捕", "起诉", "盗窃", "贪污", "挪用", "渎职", "走私", "毒品"]),
    ("诉讼与非诉讼程序法", ["诉讼", "仲裁", "调解", "证据", "执行", "管辖", "审判程序", "司法鉴定", "公证", "法律援助", "立案", "侦查", "批准逮捕", "法律监督"]),
    ("宪法相关法", ["人民代表大会", "选举", "国家机构", "立法", "国防", "军队", "武装", "国旗", "国徽", "国歌", "监察", "特别行政区", "自治", "外交", "勋章"]),
    ("社会法", ["劳动", "工会", "社会保险", "残疾人", "妇女", "未成年人", "老年人", "慈善", "消防", "安全生产", "职业病"]),
    ("民法商法", ["合同", "物权", "婚姻", "继承", "侵权", "知识产权", "专利", "商标", "著作权", "公司", "企业破产", "票据", "保险", "信托", "证券", "海商", "不动产登记", "外商投资"]),
    ("经济法", ["税", "财政", "预算", "审计", "会计", "金融", "银行", "价格", "反垄断", "反不正当竞争", "统计", "招标", "政府采购", "国有资产", "对外贸易", "海关", "外汇", "能源", "矿产", "农业", "渔业", "林业", "交通", "铁路", "公路", "港口", "电力", "煤炭", "石油"]),
    ("行政法", ["行政", "公务员", "警察", "出入境", "国家秘密", "档案", "网络安全", "数据安全", "个人信息", "密码", "广播", "出版", "土地管理", "城乡规划", "建设", "房地产", "道路交通", "枪支", "爆炸物", "危险品", "口岸", "教育", "医疗", "卫生", "药品", "食品安全", "文物", "文化", "体育", "传染病", "疫苗", "环境", "生态", "野生动物", "禁毒"]),
]
# A word in the title that adds to the score of its domain.
STRONG_SIGNALS = [
    ("刑事", "刑法", 10), ("刑法", "刑法", 10), ("犯罪", "刑法", 10), ("诉讼", "诉讼与非诉讼程序法", 15),
    ("仲裁", "诉讼与非诉讼程序法", 10), ("民事", "民法商法", 10),
]
# Domain when the title has no keyword, by category.
DOMAIN_DEFAULTS = {"行政法规": "行政法", "部门规章": "行政法", "司法解释": "诉讼与非诉讼程序法"}
# Menu group of a domain, and of a category without a domain.
DOMAIN_GROUPS = {
    "宪法相关法": "宪法与国家机构", "民法典": "民事与商事", "民法商法": "民事与商事", "刑法": "刑事", "行政法": "行政与公法",
    "经济法": "经济、税务与金融", "社会法": "劳动与社会保障", "诉讼与非诉讼程序法": "诉讼与司法程序",
}
CATEGORY_GROUPS = {
    "法律": "宪法与国家机构", "宪法": "宪法与国家机构", "修正案": "宪法与国家机构", "法律解释": "宪法与国家机构",
    "行政法规": "行政与公法", "司法解释": "诉讼与司法程序", "监察法规": "诉讼与司法程序",
}
GROUP_ORDER = ["宪法与国家机构", "民事与商事", "刑事", "行政与公法", "经济、税务与金融", "劳动与社会保障", "诉讼与司法程序", "其他"]
# Subgroup rules by group; the first match wins.
SUBGROUP_RULES = {
    "民事与商事": ([
        ("民法典", ["民法典"]), ("合同与债权", ["合同", "债权", "债务", "买卖", "租赁", "借款", "票据"]),
        ("公司与破产", ["公司", "企业破产", "清算", "个人独资", "合伙企业", "农民专业合作社"]),
        ("知识产权", ["知识产权", "专利", "商标", "著作权", "版权", "不正当竞争"]),
        ("担保与物权", ["担保", "物权", "抵押", "质押", "留置", "不动产登记"]),
        ("婚姻、家庭与继承", ["婚姻", "家庭", "继承", "收养", "监护", "人身安全保护"]), ("保险", ["保险"]),
        ("海事与运输", ["海商", "海事", "运输", "航运", "船舶", "港口"]), ("外商与涉外", ["外商投资", "中外合资", "涉外", "外资"]),
        ("证券与期货", ["证券", "期货", "基金", "股票", "上市", "期权"]),
    ], "综合与程序批复"),
    "经济、税务与金融": ([
        ("税收与财政", ["税", "财政", "预算", "审计", "会计", "国有资产"]),
        ("金融、证券与保险", ["金融", "银行", "证券", "保险", "信托", "外汇", "货币", "期货"]),
        ("贸易、竞争与市场", ["贸易", "竞争", "市场", "反垄断", "招标", "政府采购", "对外贸易", "海关"]),
        ("农业、资源与能源", ["农业", "渔业", "林业", "矿产", "能源", "石油", "煤炭", "电力", "土地"]),
    ], "其他经济法规"),
    "劳动与社会保障": ([
        ("劳动就业", ["劳动", "就业", "工资", "劳动合同", "劳动争议"]),
        ("社会保险与福利", ["社会保险", "工伤", "失业", "养老", "医疗保险", "社会保障"]),
        ("特殊群体保护", ["残疾人", "妇女", "未成年人", "老年人", "退役军人"]),
    ], "劳动就业"),
}
# Subgroups of criminal law; titles with one of the first words belong to the code itself.
CRIMINAL_CODE = "刑法及修正案"
CRIMINAL_CODE_WORDS = ["刑法修正案", "时间效力", "适用刑法", "适用修订刑法", "不再追诉", "罪名补充规定", "认真学习宣传贯彻", "罪名的补充规定"]
CRIMINAL_RULES = [
    ("侵犯财产", ["盗窃", "诈骗", "敲诈", "抢夺", "抢劫", "挪用", "强迫借贷", "拾得他人信用卡", "盗用", "赃物", "合同诈骗", "赃物估价", "职务侵占", "经济犯罪嫌疑"]),
    ("经济犯罪", ["非法经营", "非法集资", "非法放贷", "知识产权", "侵犯知识产权", "税收", "生产销售伪劣", "伪劣商品", "赌博", "洗钱", "伪造", "假币", "危害税收", "税收征管", "非法制造"]),
    ("贪污贿赂", ["受贿", "行贿", "贪污", "职务犯罪", "渎职", "渎职侵权", "私放在押人员", "挪用", "第二百二十九条"]),
    ("人身犯罪", ["非法行医", "袭警", "寻衅滋事", "性侵", "强奸", "猥亵", "嫖宿", "未成年人犯罪", "拐卖", "绑架", "故意伤害", "杀人", "人身", "虐待", "遗弃", "非法采供血液", "虐待被监管人", "强制隔离戒毒"]),
    ("毒品与走私", ["毒品", "走私", "毒鼠强", "制毒", "贩毒", "麻醉药品", "精神药品", "易制毒"]),
    ("妨害社会管理秩序", [
        "计算机犯罪", "网络犯罪", "信息网络", "淫秽", "诽谤", "开设赌场", "组织考试作弊", "黑社会", "恶势力", "虚假诉讼", "扰乱法庭", "破坏监管", "脱逃", "组织越狱",
        "妨害国", "出入境", "文物犯罪", "环境犯罪", "黑土地", "破坏公用电信", "枪支", "弹药", "爆炸物", "军用", "军职", "逃离部队", "非法制造", "买卖", "运输", "储存",
        "非法采供血液", "公务用枪", "假币", "拒不执行判决", "掩饰、隐瞒", "第三百一十三条",
    ]),
    ("刑罚执行", ["减刑", "假释", "暂予监外执行", "禁止令", "缓刑", "台湾地区服刑", "无期徒刑", "缓刑犯"]),
    ("证据规则", ["证据", "电子数据", "非法证据"]),
    ("刑事诉讼程序", ["管辖", "程序规定", "移送", "集团犯罪", "量刑程序", "涉嫌犯罪单位", "行政执法机关", "公安机关"]),
    ("审判监督", ["冤假错案", "申诉", "文化大革命"]),
    ("辩护与代理", ["辩护人", "在押犯罪嫌疑人"]),
    ("未成年人刑事程序", ["未成年人刑事案件"]),
]
# Subgroups of laws in administrative and public law.
ADMIN_LAW_RULES = [
    ("教育科技", ["教育", "教师", "学位", "学校", "高等教育", "学前教育", "职业教育", "义务教育", "家庭教育", "爱国主义教育", "公共图书馆", "科学技术普及", "科学技术进步"]),
    ("卫生医药", [
        "卫生", "医疗", "医药", "药品", "食品安全", "传染病", "精神卫生", "疫苗", "献血", "母婴保健", "医师", "基本医疗卫生", "突发公共卫生", "红十字会",
        "动物防疫", "进出境动植物检疫", "农产品质量安全", "生物安全",
    ]),
    ("生态环境", [
        "环境保护", "环境影响评价", "生态环境", "污染", "排污", "黑土地", "青藏高原", "长江保护", "黄河保护", "湿地保护", "海岛保护", "海洋环境", "水土保持",
        "野生动物", "森林法", "草原法", "水法", "国家公园", "核安全",
    ]),
    ("公安司法", [
        "治安管理", "警察", "枪支", "禁毒", "监狱", "社区矫正", "国家安全", "保密", "居民身份证", "户口登记", "出入境", "护照", "集会游行示威", "网络安全",
        "数据安全", "密码法", "人民防空", "出境入境管理", "突发事件应对", "保守国家秘密", "律师法", "人民警察",
    ]),
    ("社会民政", [
        "城市居民委员会", "村民委员会", "境外非政府组织", "归侨侨眷", "残疾人", "老年人", "未成年人", "体育法", "公共文化", "文物保护", "非物质文化遗产",
        "电影产业", "语言文字", "人口与计划生育", "无障碍环境",
    ]),
    ("信息通信", ["个人信息保护", "网络安全", "数据安全", "密码法"]),
    ("土地城建", ["土地管理", "城乡规划", "房地产", "城市房地产", "测绘法"]),
    ("自然资源", ["气象法", "海域使用", "档案法", "水下文物"]),
    ("劳动就业", ["矿山安全", "特种设备", "安全生产", "危险化学品"]),
    ("税务财政", ["行政处罚", "行政许可", "行政强制", "行政复议", "国家赔偿", "公务员"]),
]
# Subgroups of litigation and judicial procedure.
PROCEDURE_RULES = [
    ("民事诉讼", ["民事诉讼", "海事诉讼", "民事执行", "民事调解", "民事审判", "民事案件", "民事裁定", "民事诉讼证据"]),
    ("刑事诉讼", ["刑事诉讼", "死刑复核", "刑事再审", "刑事案件", "刑事裁定", "刑事诉讼证据", "刑事审判", "批捕", "逮捕", "羁押"]),
    ("行政诉讼", ["行政诉讼", "行政案件", "行政裁定", "行政赔偿", "国家赔偿", "行政执行", "行政诉讼证据", "行政复议"]),
    ("律师、仲裁与公证", ["律师", "公证", "仲裁法", "法律援助", "仲裁委员会", "人民调解"]),
    ("文书、送达与废止", ["送达", "文书", "废止", "司法协助", "法庭规则", "巡回法庭", "互联网法院", "国际商事法庭", "知识产权法庭"]),
]
SUBGROUP_RULES["诉讼与司法程序"] = (PROCEDURE_RULES, "文书、送达与废止")
# Basic laws (rank 2).
BASIC_LAWS = [
    "中华人民共和国宪法", "中华人民共和国刑法", "中华人民共和国民法典", "中华人民共和国刑事诉讼法", "中华人民共和国民事诉讼法",
    "中华人民共和国行政诉讼法", "中华人民共和国立法法", "中华人民共和国民族区域自治法", "中华人民共和国香港特别行政区基本法",
    "中华人民共和国澳门特别行政区基本法", "中华人民共和国国防法", "中华人民共和国兵役法",
]
# Subject areas of administrative regulations by title; the first match wins.
SUBJECT_RULES = [
    ("税务财政", [
        "税", "财政", "发票", "国库", "关税", "罚款", "票据管理", "结汇", "售汇", "付汇", "预算", "价格管理", "价格违法", "制止牟取暴利", "会计",
        "总会计师", "金银管理", "审计", "国家金库", "统计", "违反行政事业性收费",
    ]),
    ("海关进出口", [
        "海关", "进出口商品检验", "进出口货物", "货物进出口", "两用物项", "军品出口", "核出口", "技术进出口", "保障措施", "反倾销", "反补贴", "原产地",
        "出境入境边防", "外国人入境出境", "进口影片管理", "查检邮件", "进出境动植物检疫", "畜禽遗传资源进出境",
    ]),
    ("金融证券", [
        "金融机构", "银行", "证券", "基金", "保险", "外汇管理", "人民币管理", "货币", "存款", "股票", "期货", "征信", "融资担保", "资产管理",
        "非银行支付", "集资", "直销管理", "企业债券", "住房公积金", "储蓄", "外债", "国际收支", "票据管理实施", "金融违法",
    ]),
    ("交通运输", [
        "交通", "运输", "航运", "海运", "船舶", "海上航行", "航道", "河道管理", "铁路", "公路", "收费公路", "民用航空", "航空器", "通用航空",
        "机场管理", "快递", "无人驾驶航空", "飞行基本规则", "航标", "船员条例", "邮政", "邮轮", "打捞沉船", "保护海底电缆", "铺设海底电缆", "上海航运",
        "外商参与打捞",
    ]),
    ("生态环境", [
        "环境保护", "生态环境监测", "生态保护补偿", "污染", "排污", "碳排放", "消耗臭氧", "防治海洋工程", "防止拆船", "海洋倾废", "涉外海洋科学", "核安全",
        "核电厂", "民用核设施", "民用核安全", "核材料管制", "监控化学品", "病原微生物实验室", "放射性同位素", "放射性废物", "放射性物品运输", "危险废物",
        "建设项目环境保护", "规划环境影响评价", "易制毒化学品", "城镇排水与污水", "城市市容和环境卫生", "公共场所卫生",
    ]),
    ("自然资源", [
        "森林法实施", "森林采伐", "森林病虫", "草原", "矿产资源", "矿区", "石油地震", "水文条例", "黄河水量", "淮河流域", "长江河道", "长江三峡", "蓄滞洪",
        "退耕还林", "水库大坝", "水产资源", "野生动物", "野生植物", "濒危野生动植物", "植物新品种", "野生药材", "稀土", "海洋观测", "地下水管理", "地质资料",
        "节约用水条例", "抗旱条例", "南水北调", "太湖流域", "大中型水利水电", "农田水利", "古树名木", "古生物化石", "自然保护区条例", "密云水库", "人工影响天气",
        "探矿权", "采矿权", "取水许可", "地质灾害", "地震预报", "地震监测", "地震安全性评价",
    ]),
    ("土地城建", [
        "土地管理", "土地增值", "土地使用", "不动产登记", "城镇土地", "城乡", "建设工程", "村庄和集镇", "物业管理", "民用建筑节能", "长城保护", "测绘成果",
        "测量标志", "基础测绘", "城市供水", "城市绿化", "城市道路", "历史文化名城", "风景名胜区", "基本农田", "城市节约用水", "城市房地产", "住房租赁",
        "注册建筑师", "城市民族", "地名管理", "地图管理", "国家重点建设项目", "无障碍环境建设", "国有土地上房屋征收", "土地复垦", "土地调查", "城镇燃气",
        "城镇集体所有制企业",
    ]),
    ("教育科技", [
        "教育", "教学成果", "学校", "教师资格", "高等教育", "民办教育", "自学考试", "科学技术档案", "标准化法实施", "计量器具", "计量法实施", "专利法实施",
        "专利代理", "著作权法实施", "著作权集体管理", "实施国际著作权", "集成电路布图", "认证认可", "商用密码", "计算机软件保护", "地方志", "博物馆条例",
        "传统工艺美术", "文物保护法实施", "水下文物保护", "全国中小学", "幼儿园", "中外合作办学", "专业技术职务", "国家科学技术奖励", "档案法实施",
    ]),
    ("卫生医药", [
        "卫生检疫", "卫生监督", "医疗", "医药", "药品管理", "食品", "食盐", "血液制品", "艾滋病", "传染病防治", "血吸虫", "突发公共卫生", "动物疫情",
        "母婴保健", "戒毒条例", "麻醉药品", "精神药品", "放射性药品", "护士条例", "尘肺病", "乳品质量", "人体器官", "乡村医生", "化妆品", "实验动物",
        "兽药管理", "反兴奋剂", "人类遗传资源", "烟草专卖", "残疾预防", "中药品种保护",
    ]),
    ("劳动就业", [
        "劳动合同法实施", "劳动保障监察", "劳动就业服务", "工资总额", "职工带薪年休假", "工作时间", "女职工劳动保护", "人力资源市场", "事业单位人事", "保障农民工",
        "保障中小企业款项", "高级专家", "禁止使用童工", "使用有毒物品作业", "工人考核",
    ]),
    ("社会民政", [
        "社会保险", "社会救助", "社会团体登记", "民办非企业", "志愿服务", "残疾人就业", "残疾人教育", "残疾预防和残疾人康复", "残疾人专用品", "殡葬管理",
        "彩票管理", "烈士褒扬", "退役军人安置", "法律援助条例", "人民调解", "婚姻登记", "收养子女", "城市居民最低生活保障", "城市生活无着", "全民健身", "全民阅读",
        "公共文化体育", "娱乐场所", "营业性演出", "宗教事务", "民族乡行政", "民族区域自治", "城市民族工作", "红十字标志", "保安服务", "扫除文盲",
    ]),
    ("公安司法", [
        "人民警察使用", "治安管理", "治安保卫委员会", "拘留所条例", "看守所条例", "诉讼费用", "移送涉嫌犯罪", "专职守护押运", "枪支使用", "公安部对部分刀具",
        "集会游行示威", "行政复议法实施", "国家赔偿费用", "大型群众性活动安全", "反间谍法实施", "保守国家秘密", "公共安全视频", "计算机信息系统安全", "关键信息基础设施",
        "人民警察警衔", "公安机关组织", "公安机关督察", "企业事业单位内部治安", "仲裁委员会", "重新组建仲裁", "矿山安全法实施",
    ]),
    ("军事国防", [
        "军事设施保护", "民兵工作", "征兵工作", "武器装备研制", "武器装备科研", "武器装备质量", "重要军工设施", "军工关键设备", "国防专利", "国防计量",
        "军用标准化", "军人抚恤", "军服管理", "军队参加抢险", "解放军", "文职人员条例", "现役士兵服役", "退役军人", "民用运力国防", "军用饮食", "民兵武器装备",
        "武装警察部队", "军民合用机场", "现役军人和人民武装警察居民身份证", "消防救援衔",
    ]),
    ("工商市场", [
        "工商", "市场主体登记", "无证无照", "招标投标", "政府采购法实施", "政府投资条例", "特种设备安全", "工业产品生产许可", "质量管理条例", "缺陷汽车",
        "报废机动车", "公平竞争审查", "广告管理", "旅行社条例", "导游人员", "禁止向企业摊派", "控制对企业进行经济检查", "企业国有资产", "国有企业", "国有资产评估",
        "企业财务会计", "企业名称登记", "企业投资项目", "重大行政决策", "商业特许经营", "消费者权益保护法实施", "商标法实施", "企业信息公示", "优化营商环境",
        "禁止传销条例",
    ]),
    ("信息通信", [
        "电信条例", "计算机信息网络国际联网", "网络数据安全", "无线电管理", "无线电管制", "广播", "电影管理", "音像制品", "出版", "外国常驻新闻机构", "有线电视",
        "卫星地面接收", "印刷业管理", "印铸刻字", "未成年人网络保护", "通信线路", "互联网上网服务营业场所", "互联网信息服务管理", "信息网络传播权",
    ]),
    ("农业农村", [
        "农业", "农村", "粮食流通", "棉花质量", "农作物病虫害", "植物检疫条例", "畜禽规模", "农药", "种子", "农民承担费用", "中央储备粮", "渔业资源增殖",
        "渔业法实施", "森林和野生动物类型自然保护区", "饲料和饲料添加剂", "生猪屠宰", "乡村集体所有制企业",
    ]),
    ("安全应急", [
        "安全生产", "生产安全事故", "气象灾害", "气象设施", "气象探测", "森林草原防灭火", "民用爆炸物品", "烟花爆竹安全", "危险化学品安全", "汶川地震", "校车安全",
        "废弃电器电子", "核电厂核事故应急", "破坏性地震应急", "自然灾害救助", "防汛条例",
    ]),
    ("能源电力", ["电力供应与使用", "电力安全事故", "电力监管", "电力设施保护", "电网调度管理", "煤矿安全生产", "民用建筑节能条例", "公共机构节能", "稀土管理条例"]),
    ("行政法制", [
        "行政法规制定", "规章制定", "法规汇编", "法规规章备案", "政府信息公开", "政务数据共享", "政府督查", "政府参事", "机关事务管理", "机关团体建设",
        "行政区划管理", "行政区域界线", "行政区域边界", "行政执法监督", "行政执法机关移送", "行政事业性国有资产", "政务院关于", "国务院关于", "国务院实施",
        "国务院对确需", "国务院行政机构", "地方各级人民政府机构", "地方口岸管理", "国家机关工作人员", "关于国家机关", "对外使用国徽", "全国人口普查", "全国经济普查",
        "全国年节及纪念日", "地方志工作", "统计报表管理", "统计法实施", "国际收支统计", "事业单位登记", "国家行政机关及其工作人员在国内公务", "北京市新技术产业开发试验区",
    ]),
    ("涉外外资", [
        "外商投资法实施", "外资银行", "外资保险", "外资企业", "台湾同胞投资", "归侨侨眷", "外国企业常驻", "外国籍船舶", "外国常驻新闻机构", "外国律师事务所",
        "外国商会", "外国驻华外交", "对外合作开采", "国际海运条例", "国际货物运输代理", "对外劳务合作", "对外承包工程", "对外经济贸易部", "中国公民出国旅游",
        "中国公民往来台湾", "中国公民因私事往来香港", "外国人来华登山", "外国人在中华人民共和国收养", "领事保护", "缔结条约管理", "关于外国人在我国旅行", "居住证暂行",
        "反外国不当域外管辖", "境内外国人宗教", "世界博览会标志", "奥林匹克标志", "特殊标志管理", "考古涉外", "实施《中华人民共和国反外国制裁", "指导外商投资方向",
        "外商投资电信企业", "中国公民收养子女登记",
    ]),
]
# Taxonomy domains by words in title and text; a word that is listed twice counts twice.
TAXONOMY_RULES = [
    ("宪法与国家机构", ["宪法", "全国人民代表大会", "人民代表大会", "国务院组织法", "国家主席", "地方各级人民", "选举", "立法法", "戒严", "国旗", "国徽", "国歌"]),
    ("刑事法", ["刑法", "刑事诉讼", "监狱", "社区矫正", "禁毒", "反恐怖", "有组织犯罪", "刑事司法协助", "引渡", "刑法修正案"]),
    ("民事法", ["民法典", "合同", "侵权", "婚姻", "继承", "物权", "人格权", "民事诉讼", "仲裁", "调解", "公证", "律师", "法律援助", "法律援助"]),
    ("行政法", ["行政处罚", "行政复议", "行政强制", "行政许可", "行政诉讼", "国家赔偿", "政府信息公开", "治安管理", "突发事件"]),
    ("经济与商事法", [
        "公司法", "合伙企业", "破产", "证券", "期货", "银行", "保险", "信托", "票据", "拍卖", "招标投标", "政府采购", "反垄断", "反不正当竞争",
        "广告", "价格", "消费者权益", "电子商务", "电子签名", "外商投资", "对外贸易", "海关", "关税", "反倾销", "反补贴", "出口管制", "外汇",
        "资产评估",
    ]),
    ("税法与财政", [
        "税", "增值税", "个人所得税", "企业所得税", "关税法", "印花税", "契税", "耕地占用税", "资源税", "车船税", "车辆购置税", "预算", "国库",
        "烟叶税", "环境保护税", "城市维护建设税", "审计", "统计", "会计", "注册会计师",
    ]),
    ("劳动与社会保障", ["劳动法", "劳动合同", "劳动争议", "工会", "社会保险", "就业", "职业病", "安全生产", "矿山安全"]),
    ("民政与民族", ["民族区域自治", "村民委员会", "居民委员会", "归侨侨眷", "残疾人", "老年人", "未成年人", "妇女", "慈善", "红十字", "献血", "公益事业"]),
    ("教育、科技与文化", [
        "教育法", "义务教育", "高等教育", "职业教育", "民办教育", "学位", "学前教育", "教师", "家庭教育", "科学技术", "科技成果", "标准化", "计量",
        "档案", "文物", "非物质文化遗产", "著作权", "旅游", "体育", "电影", "公共文化", "公共图书馆", "广播电视", "爱国主义教育", "法治宣传",
    ]),
    ("知识产权", ["专利", "商标", "著作权", "知识产权", "植物新品种"]),
    ("环境与资源", [
        "环境保护", "大气污染", "水污染", "土壤污染", "噪声污染", "固体废物", "环境影响评价", "清洁生产", "循环经济", "节约能源", "可再生能源", "能源法",
        "水法", "水土保持", "防洪", "防沙", "草原", "森林", "湿地", "野生动物", "土地管理", "矿产资源", "渔业", "海洋", "海域", "海岛", "深海",
        "长江保护", "黄河保护", "黑土地", "青藏高原", "国家公园", "放射性污染", "核安全", "生物安全", "动物防疫", "畜牧", "种子", "农产品质量",
    ]),
    ("农业与农村", ["农业", "农村", "农民", "土地承包", "乡村振兴", "粮食安全", "农业技术", "农业机械", "农村集体经济", "农村土地"]),
    ("卫生与医药", ["食品安全", "药品", "疫苗", "医师", "基本医疗卫生", "传染病", "精神卫生", "母婴保健", "职业病", "国境卫生", "突发公共卫生", "中医药"]),
    ("交通与基础设施", [
        "道路交通", "铁路", "公路", "港口", "航道", "航运", "海上交通", "民用航空", "邮政", "建筑", "城乡规划", "城市房地产", "不动产", "土地增值",
        "石油天然气", "电力", "煤炭", "特种设备", "计量", "标准化",
    ]),
    ("信息与数据安全", ["网络安全", "数据安全", "个人信息保护", "密码", "电子签名", "无线电", "国家安全", "反间谍", "国家情报", "保守国家秘密"]),
    ("国防与军事", [
        "国防", "兵役", "军事", "武装警察", "国防动员", "国防交通", "国防教育", "退役军人", "军官", "预备役", "人民武装", "军人保险", "军人地位",
        "现役军官", "海警", "陆地国界", "领海", "领事", "外交",
    ]),
    ("港澳台与涉外", [
        "香港", "澳门", "台湾", "驻外", "领事特权", "外交特权", "国籍", "出境入境", "外国人", "对外关系", "缔结条约", "国际", "涉外", "外资",
        "海南自由贸易港",
    ]),
    ("诉讼程序与司法组织", [
        "人民法院", "人民检察院", "法官法", "检察官", "人民陪审员", "司法", "诉讼", "法律援助", "公益诉讼", "执行", "仲裁", "调解", "监察法", "监察官",
        "监察法规", "监察工作", "行政执法", "刑事诉讼规则", "民事诉讼监督", "行政诉讼监督",
    ]),
]
CATEGORY_EN = {"法律": "Law", "行政法规": "Administrative Regulation", "司法解释": "Judicial Interpretation", "修正案": "Amendment"}
# Order of the subgroups of a menu group, and of the subjects below administrative regulations.
SUBGROUP_ORDER = {
    "宪法与国家机构": ["宪法", "法律及决定", "行政法规", "司法解释"],
    "民事与商事": [
        "民法典", "合同与债权", "公司与破产", "知识产权", "担保与物权", "婚姻、家庭与继承", "保险", "海事与运输", "外商与涉外", "证券与期货", "综合与程序批复",
    ],
    "刑事": [
        "刑法及修正案", "侵犯财产", "经济犯罪", "贪污贿赂", "人身犯罪", "毒品与走私", "妨害社会管理秩序", "刑罚执行", "证据规则", "刑事诉讼程序", "审判监督",
        "辩护与代理", "未成年人刑事程序",
    ],
    "行政与公法": ["行政法律", "教育科技", "卫生医药", "生态环境", "公安司法", "社会民政", "土地城建", "自然资源", "劳动就业", "税务财政", "国家赔偿", "司法解释"],
    "经济、税务与金融": ["税收与财政", "金融、证券与保险", "贸易、竞争与市场", "农业、资源与能源", "其他经济法规"],
    "劳动与社会保障": ["劳动就业", "社会保险与福利", "特殊群体保护", "司法解释", "行政法规"],
    "诉讼与司法程序": ["民事诉讼", "刑事诉讼", "行政诉讼", "律师、仲裁与公证", "文书、送达与废止", "行政法规"],
}
SUBJECT_ORDER = [
    "税务财政", "海关进出口", "金融证券", "交通运输", "能源电力", "生态环境", "自然资源", "土地城建", "农业农村", "卫生医药",
    "劳动就业", "社会民政", "教育科技", "信息通信", "工商市场", "安全应急", "公安司法", "军事国防", "行政法制", "涉外外资",
]
# English names of codes, by kind.
ENGLISH_NAMES = {
    "category": {
        "宪法": "Constitution", "法律": "Law", "修正案": "Amendment", "决定": "Decision", "法律解释": "Legal Interpretation",
        "司法解释": "Judicial Interpretation", "行政法规": "Administrative Regulation", "监察法规": "Supervisory Regulation",
    },
    "domain": {
        "宪法相关法": "Constitutional Law", "民法典": "Civil Code", "民法商法": "Civil & Commercial Law", "刑法": "Criminal Law",
        "行政法": "Administrative Law", "经济法": "Economic Law", "社会法": "Social Law", "诉讼与非诉讼程序法": "Procedural Law",
    },
    "body": {
        "最高人民法院": "Supreme People's Court", "最高人民检察院": "Supreme People's Procuratorate", "国务院": "State Council",
        "全国人民代表大会常务委员会": "NPC Standing Committee", "全国人民代表大会": "National People's Congress",
        "国家监察委员会": "National Supervisory Commission",
    },
    "group": {
        "宪法与国家机构": "Constitution & State Institutions", "民事与商事": "Civil & Commercial", "刑事": "Criminal",
        "行政与公法": "Administrative & Public Law", "经济、税务与金融": "Economy, Taxation & Finance",
        "劳动与社会保障": "Labor & Social Security", "诉讼与司法程序": "Litigation & Judicial Procedure", "其他": "Other",
    },
    "subgroup": {
        "宪法": "Constitution", "法律及决定": "Laws & Decisions", "司法解释": "Judicial Interpretations", "民法典": "Civil Code",
        "合同与债权": "Contracts & Obligations", "公司与破产": "Companies & Bankruptcy", "知识产权": "Intellectual Property",
        "担保与物权": "Security & Property Rights", "婚姻、家庭与继承": "Marriage, Family & Inheritance", "保险": "Insurance",
        "海事与运输": "Maritime & Transport", "外商与涉外": "Foreign Investment & Foreign Affairs", "证券与期货": "Securities & Futures",
        "综合与程序批复": "General & Procedural Responses", "刑法及修正案": "Criminal Law & Amendments", "法律解释": "Judicial Interpretations",
        "侵犯财产": "Property Crimes", "经济犯罪": "Economic Crimes", "贪污贿赂": "Embezzlement & Bribery", "人身犯罪": "Crimes Against the Person",
        "毒品与走私": "Drugs & Smuggling", "妨害社会管理秩序": "Crimes Against Social Order", "刑罚执行": "Sentence Execution",
        "证据规则": "Evidence Rules", "刑事诉讼程序": "Criminal Procedure", "审判监督": "Trial Supervision",
        "辩护与代理": "Defense & Representation", "未成年人刑事程序": "Juvenile Criminal Procedure", "检察院": "Procuratorate",
        "行政法律": "Administrative Laws", "教育科技": "Education & Science", "卫生医药": "Health & Medicine", "生态环境": "Ecology & Environment",
        "公安司法": "Public Security & Justice", "社会民政": "Social & Civil Affairs", "土地城建": "Land & Urban Development",
        "自然资源": "Natural Resources", "劳动就业": "Labor & Employment", "税务财政": "Taxation & Finance", "国家赔偿": "State Compensation",
        "信息通信": "Information & Communications", "税收与财政": "Taxation & Public Finance", "金融、证券与保险": "Finance, Securities & Insurance",
        "贸易、竞争与市场": "Trade, Competition & Market", "农业、资源与能源": "Agriculture, Resources & Energy",
        "其他经济法规": "Other Economic Regulations", "社会保险与福利": "Social Insurance & Welfare", "特殊群体保护": "Protection of Special Groups",
        "行政法规": "Administrative Regulations", "民事诉讼": "Civil Litigation", "刑事诉讼": "Criminal Litigation",
        "行政诉讼": "Administrative Litigation", "律师、仲裁与公证": "Lawyers, Arbitration & Notarization", "文书、送达与废止": "Documents, Service & Repeals",
    },
    "subject": {
        "税务财政": "Taxation & Finance", "海关进出口": "Customs & Import-Export", "金融证券": "Banking & Securities", "交通运输": "Transportation",
        "能源电力": "Energy & Power", "生态环境": "Ecology & Environment", "自然资源": "Natural Resources", "土地城建": "Land & Urban Development",
        "农业农村": "Agriculture & Rural Affairs", "卫生医药": "Health & Medicine", "劳动就业": "Labor & Employment",
        "社会民政": "Social & Civil Affairs", "教育科技": "Education & Science", "信息通信": "Information & Communications",
        "工商市场": "Industry, Commerce & Market", "安全应急": "Safety & Emergency Response", "公安司法": "Public Security & Justice",
        "军事国防": "Military & National Defense", "行政法制": "Administrative Rule of Law", "涉外外资": "Foreign Affairs & Investment",
    },
}
