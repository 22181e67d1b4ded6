"""Fixed values of the tags: code labels, URL patterns, cut-offs and band labels."""

from __future__ import annotations

# --- user attributes: stored code -> label, and the label of any other code ---
GENDER = {"1": "男", "2": "女"}
JOB = {"1": "学生", "2": "公务员", "3": "军人", "4": "警察", "5": "教师", "6": "白领"}
MARRIAGE = {"1": "未婚", "2": "已婚", "3": "离异"}
NATIONALITY = {"1": "中国大陆", "2": "中国香港", "3": "中国澳门", "4": "中国台湾"}
POLITICAL_FACE = {"1": "群众", "2": "党员", "3": "无党派人士"}
UNKNOWN = "未知"
OTHER = "其他"

# First year of a birth decade -> label.
BIRTH_DECADES = [
    (2020, "20后"),
    (2010, "10后"),
    (2000, "00后"),
    (1990, "90后"),
    (1980, "80后"),
    (1970, "70后"),
    (1960, "60后"),
    (1950, "50后"),
]

# First day (month * 100 + day) of a star sign -> label, from the latest to the earliest.
STAR_SIGNS = [
    (1222, "摩羯座"),
    (1123, "射手座"),
    (1024, "天蝎座"),
    (923, "天秤座"),
    (823, "处女座"),
    (723, "狮子座"),
    (622, "巨蟹座"),
    (521, "双子座"),
    (420, "金牛座"),
    (321, "白羊座"),
    (219, "双鱼座"),
    (120, "水瓶座"),
    (101, "摩羯座"),
]
LAST_STAR_SIGN = "双鱼座"

# --- page views: URL patterns by page type ---
LOGIN_PAGES = ("%login%",)
HOME_PAGES = ("%eshop.com/", "%m.eshop.com/?source=mobile")
LIST_PAGES = ("%/itemlist/%", "%/l/%")
PRODUCT_PAGES = ("%/item/%", "%/product/%")
ORDER_PAGES = ("%/order/%",)
CART_PAGES = ("%cart%", "%Cart%")
BROWSED_PRODUCT_PAGES = ("%/itemlist/%", "%/item/%", "%/product/%", "%/productSpecification/%")

BROWSE_BANDS = [(255, "经常"), (230, "较常"), (200, "偶尔")]
BROWSE_RARE = "很少"
LOGIN_BANDS = [(80, "经常"), (65, "一般"), (55, "较少")]
LOGIN_RARE = "极少"

# First and last hour of a period -> label.
HOUR_PERIODS = [
    (1, 7, "1-7"),
    (8, 12, "8-12"),
    (13, 17, "13-17"),
    (18, 21, "18-21"),
    (22, 24, "22-24"),
]

# Seconds that a gap must exceed -> label.
GAP_BANDS = [(300, "5分钟以上"), (60, "1-5分钟")]
GAP_SHORT = "1分钟内"

# Browser text pattern -> device, in the order of the tests.
DEVICES = [
    ("%Window%", "Window"),
    ("%Android%", "Android"),
    ("%Linux%", "Linux"),
    ("%iPhone%", "IOS"),
    ("%iPad%", "IOS"),
    ("%Mac%", "Mac"),
]

# Days since the newest login that must be exceeded -> label.
LOGIN_AGE_BANDS = [(14, "30天内"), (7, "14天内"), (1, "7天内")]
LOGIN_AGE_FRESH = "1天内"

# --- orders: status codes ---
FINISHED = "202"
CANCELLED = "203"
RETURNED = "0"
EXCHANGED = "1"
CONSULTED = "204"

# --- orders: cut-offs ---
ORDER_COUNT_BANDS = [(250, "高"), (200, "中")]
ORDER_COUNT_LOW = "低"
POWER_BANDS = [
    (500000, "超高"),
    (200000, "高"),
    (150000, "中上"),
    (100000, "中"),
    (50000, "中下"),
    (10000, "低"),
]
POWER_LOWEST = "很低"
ORDER_VALUE_BANDS = [(5000, "5000-9999"), (3000, "3000-4999"), (1000, "1000-2999")]
ORDER_VALUE_LOWEST = "1-999"
MAX_AMOUNT_BANDS = [
    (50000, "50000及以上"),
    (20000, "20000-49999"),
    (10000, "10000-19999"),
    (5000, "5000-9999"),
    (1, "1-4999"),
]
MAX_AMOUNT_NONE = "未消费"

# Days between orders -> label.
CYCLE_BANDS = [
    (180, "6月"),
    (150, "5月"),
    (120, "4月"),
    (90, "3月"),
    (60, "2月"),
    (30, "1月"),
    (14, "2周"),
    (7, "7日"),
    (5, "5日"),
    (3, "3日"),
    (2, "2日"),
]
CYCLE_SHORTEST = "1日"

RETURN_BANDS = [(0.02, "高"), (0.0002, "中")]
EXCHANGE_BANDS = [(0.01, "高"), (0.0001, "中")]
CONSULT_BANDS = [(0.02, "高"), (0.002, "中")]
RATE_LOW = "低"

PAYMENT_MODES = {
    "alipay": "支付宝",
    "wxpay": "微信",
    "balance": "余额",
    "ccb": "银行卡",
    "chinaecpay": "银行卡",
    "chinapay": "银行卡",
}
PAYMENT_OTHER = "其他方式"

# --- recency, frequency and money: closed ranges -> score ---
RECENCY_SCORES = [(1, 3, 5), (4, 6, 4), (7, 9, 3), (10, 15, 2), (16, None, 1)]
FREQUENCY_SCORES = [(200, None, 5), (150, 199, 4), (100, 149, 3), (50, 99, 2), (1, 49, 1)]
MONEY_SCORES = [
    (200000, None, 5),
    (100000, 199999, 4),
    (50000, 99999, 3),
    (10000, 49999, 2),
    (None, 9999, 1),
]

# --- preferences: brand code -> label, category name -> code ---
BRANDS = {297: "海尔", 298: "卡萨帝", 299: "统帅", 305: "MOOKA"}
CATEGORIES = {
    "电热水器": 1,
    "燃气灶": 2,
    "智能电视": 3,
    "微波炉": 4,
    "Haier/海尔冰箱": 5,
    "4K电视": 6,
    "烟灶套系": 7,
    "空气净化器": 8,
    "净水机": 9,
    "滤芯": 10,
    "电饭煲": 11,
    "料理机": 12,
    "吸尘器/除螨仪": 13,
    "电磁炉": 14,
    "前置过滤器": 15,
    "电水壶/热水瓶": 16,
    "LED电视": 17,
    "取暖电器": 18,
    "烤箱": 19,
    "嵌入式厨电": 20,
}
CATEGORY_OTHER = 0
