"""Word lists and tables that results depend on. They are data, in their natural order."""

# Topics and the words that assign them, first word in the list that occurs.
TOPIC_RULES: dict[str, list[str]] = {
    "宏观政策": ["宏观调控", "稳增长", "扩大内需", "经济工作会议"],
    "房地产市场": ["房地产市场", "楼市", "商品住房", "商品房市场"],
    "城市更新": ["城市更新"],
    "城中村改造": ["城中村"],
    "老旧小区改造": ["老旧小区"],
    "危旧房改造": ["危旧房"],
    "项目白名单": ["白名单"],
    "保交楼": ["保交楼"],
    "商品房收储": ["收储", "收购存量商品房"],
    "住房以旧换新": ["以旧换新"],
    "公积金": ["公积金"],
    "购房补贴": ["购房补贴", "房票"],
    "人才住房": ["人才"],
    "限购": ["限购"],
    "限售": ["限售"],
    "限贷": ["限贷", "首付"],
    "限价": ["限价"],
    "住房租赁": ["住房租赁", "保租房"],
    "住房保障": ["住房保障", "保障性住房", "保障房"],
    "保障性租赁住房": ["保障性租赁住房", "保租房"],
    "房企融资": ["房企融资", "房地产融资", "融资协调", "授信", "开发贷"],
    "房地产债务": ["房地产债务", "债务风险", "债券违约"],
    "REITs": ["REITs", "不动产投资信托"],
    "商业住房贷款": ["商业住房贷款", "个人住房贷款", "房贷利率"],
    "税费政策": ["契税", "房产税", "增值税", "税费优惠"],
    "落户政策": ["落户", "户籍"],
    "土地供应": ["土地供应", "供地"],
    "存量土地盘活": ["存量土地", "盘活"],
    "土地竞拍": ["土地竞拍", "土拍", "集中供地", "竞买保证金"],
    "预售资金监管": ["预售资金"],
    "二手房参考价": ["二手房参考价"],
    "住房品质": ["好房子", "住房品质", "绿色住宅"],
    "物业管理": ["物业管理", "物业服务"],
    "房企支持": ["房地产企业", "房企", "开发企业"],
}
OTHER_TOPIC = "其他"

# Directions by their words, the first that applies.
DIRECTION_RULES: list[tuple[str, list[str]]] = [
    ("loosening", ["取消限", "放宽", "降低首付", "下调", "提高额度", "优化调整"]),
    ("tightening", ["收紧", "上调首付", "暂停", "不得购买"]),
    ("supportive", ["支持", "补贴", "保障", "促进"]),
]

# Marks of a record's source.
INTERNAL_WORD, RUMOUR_WORD = "内部", "传闻"
OFFICIAL_URL_PARTS = ["gov.cn", "pbc.gov.cn", "mohurd.gov.cn", "nfra.gov.cn", "gjj."]
MEDIA_URL_PARTS = ["xinhuanet", "people.com.cn", "cnstock", "cls.cn"]

# Domains and who stands behind them.
OFFICIAL_DOMAINS: list[tuple[str, str, str]] = [
    ("gov.cn", "中国政府网", "central_government"),
    ("mohurd.gov.cn", "住房和城乡建设部", "housing"),
    ("pbc.gov.cn", "中国人民银行", "finance"),
    ("nfra.gov.cn", "国家金融监督管理总局", "finance"),
    ("cbirc.gov.cn", "原中国银保监会", "finance"),
    ("csrc.gov.cn", "中国证监会", "finance"),
    ("ndrc.gov.cn", "国家发展和改革委员会", "development_reform"),
    ("chinatax.gov.cn", "国家税务总局", "tax"),
]
MEDIA_DOMAINS = ["mp.weixin.qq.com", "baijiahao.baidu.com", "sohu.com", "qq.com", "163.com"]

# Provinces with their codes.
PROVINCES: list[tuple[str, str]] = [
    ("北京市", "11"), ("天津市", "12"), ("河北省", "13"), ("山西省", "14"), ("内蒙古自治区", "15"),
    ("辽宁省", "21"), ("吉林省", "22"), ("黑龙江省", "23"), ("上海市", "31"), ("江苏省", "32"),
    ("浙江省", "33"), ("安徽省", "34"), ("福建省", "35"), ("江西省", "36"), ("山东省", "37"),
    ("河南省", "41"), ("湖北省", "42"), ("湖南省", "43"), ("广东省", "44"), ("广西壮族自治区", "45"),
    ("海南省", "46"), ("重庆市", "50"), ("四川省", "51"), ("贵州省", "52"), ("云南省", "53"),
    ("西藏自治区", "54"), ("陕西省", "61"), ("甘肃省", "62"), ("青海省", "63"), ("宁夏回族自治区", "64"),
    ("新疆维吾尔自治区", "65"), ("香港特别行政区", "81"), ("澳门特别行政区", "82"),
]
MUNICIPALITIES = ["北京市", "天津市", "上海市", "重庆市"]
NATIONAL_WORDS = ["全国", "中央", "国家", "全国范围"]
PROVINCE_SUFFIXES = ["壮族自治区", "回族自治区", "维吾尔自治区", "自治区", "特别行政区", "省", "市"]
SPECIAL_PARENT_CITIES: list[tuple[str, str]] = [
    ("昆山市", "苏州市"), ("义乌市", "金华市"), ("慈溪市", "宁波市"), ("晋江市", "泉州市"), ("张家港市", "苏州市"), ("句容市", "镇江市"),
]

# Patterns of dates (by centuries, and whether a digit before the year is refused), numbers, document numbers
# and places.
DATE_PATTERNS: dict[tuple[str, bool], str] = {
    ("20|19", False): r"(20\d{2}|19\d{2})[-/.年](\d{1,2})[-/.月](\d{1,2})",
    ("20|19", True): r"(?<!\d)(20\d{2}|19\d{2})[-/.年](\d{1,2})[-/.月](\d{1,2})",
    ("20", False): r"(20\d{2})[-/.年](\d{1,2})[-/.月](\d{1,2})",
    ("20", True): r"(?<!\d)(20\d{2})[-/.年](\d{1,2})[-/.月](\d{1,2})",
}
CELL_ROW_PATTERN = r"(?:ROW:|[A-Z]+)(\d+)"
NUMBER_PATTERN = r"(?<!\d)(\d+(?:\.\d+)?)"
DOCUMENT_NUMBER_PATTERN = r"[一-鿿]{1,8}[〔\[（(]?20\d{2}[〕\]）)]?\d{1,5}号"
CITY_PATTERN = r"^(.{1,12}?(?:市|自治州|地区|盟))"
COUNTY_PATTERN = r"^(.{1,12}?(?:区|县|旗|市))"

# The sheet whose rows are matched to records.
MATCH_SHEET = "T4 2023年城市需求支持政策"

# Sheets of events, by the start of their name or by name.
WHITE_LIST_PREFIX, FINANCING_SHEET = "房地产项目白名单", "PSL专项贷款"
