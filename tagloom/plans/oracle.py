"""The queries as plain SQL over the same sample tables, written independently.

Model fits have no SQL; their queries are missing here.
"""

from __future__ import annotations

# --- the shop tables over the sample tables ---

USERS = """
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
         CAST(DATE '1945-01-01' + CAST((c_custkey * 37) % 30000 AS INTEGER) AS VARCHAR) AS birthday,
         CAST(c_custkey % 3 AS VARCHAR) AS gender,
         CAST(c_custkey % 8 AS VARCHAR) AS job,
         CAST(c_custkey % 5 AS VARCHAR) AS marriage,
         CAST(c_custkey % 6 AS VARCHAR) AS nationality,
         CAST(c_custkey % 5 AS VARCHAR) AS "politicalFace",
         'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         '138' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0')
               || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS mobile,
         c_name AS username
  FROM customer)"""

LOGINS = """
logins AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, seen
  FROM customer
  LEFT JOIN (SELECT user_id, max(CAST(floor(epoch(ts)) AS BIGINT)) AS seen
             FROM events GROUP BY user_id) e ON e.user_id = c_custkey)"""

ORDERS = """
shop_orders AS (
  SELECT o_custkey AS member, o_custkey % 1000 AS uid, o_orderkey AS sn,
         o_totalprice AS amount,
         CASE WHEN o_orderstatus = 'F' THEN '202'
              WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN '0'
              WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 1 THEN '1'
              WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 2 THEN '204'
              WHEN o_orderstatus = 'P' THEN '201'
              WHEN o_orderkey % 2 = 0 THEN '203'
              ELSE '202' END AS status,
         CAST(epoch(o_orderdate) AS BIGINT) AS finished,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'alipay' WHEN '2-HIGH' THEN 'wxpay'
              WHEN '3-MEDIUM' THEN 'balance' WHEN '4-NOT SPECIFIED' THEN 'ccb'
              ELSE 'cod' END AS payment
  FROM orders)"""

GOODS = """
goods AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS sn,
         CAST(l_partkey AS VARCHAR) AS pid, l_partkey AS pnum,
         CASE l_linenumber % 3
              WHEN 0 THEN p_name || ', set of ' || CAST(l_linenumber AS VARCHAR)
              WHEN 1 THEN p_name
              ELSE p_name || ' plus' END AS name,
         CASE p_size % 22
              WHEN 1 THEN '电热水器' WHEN 2 THEN '燃气灶' WHEN 3 THEN '智能电视'
              WHEN 4 THEN '微波炉' WHEN 5 THEN 'Haier/海尔冰箱' WHEN 6 THEN '4K电视'
              WHEN 7 THEN '烟灶套系' WHEN 8 THEN '空气净化器' WHEN 9 THEN '净水机'
              WHEN 10 THEN '滤芯' WHEN 11 THEN '电饭煲' WHEN 12 THEN '料理机'
              WHEN 13 THEN '吸尘器/除螨仪' WHEN 14 THEN '电磁炉' WHEN 15 THEN '前置过滤器'
              WHEN 16 THEN '电水壶/热水瓶' WHEN 17 THEN 'LED电视' WHEN 18 THEN '取暖电器'
              WHEN 19 THEN '烤箱' WHEN 20 THEN '嵌入式厨电' ELSE p_type END AS type,
         CASE WHEN p_size % 22 BETWEEN 1 AND 20 THEN p_size % 22 ELSE 0 END AS type_code,
         CAST(split_part(p_brand, '#', 2) AS INTEGER) + 296 AS brand
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""

LOGS = """
logs AS (
  SELECT event_id AS id, user_id AS uid, date_trunc('second', ts) AS stamp,
         CASE event_type
              WHEN 'click' THEN '/product/' || k || '.html'
              WHEN 'view' THEN '/item/' || k || '.html'
              WHEN 'purchase' THEN '/order/' || CAST(event_id AS VARCHAR)
              WHEN 'signup' THEN '/login'
              ELSE 'http://www.eshop.com/' END AS loc_url,
         CASE event_id % 3 WHEN 0 THEN '/itemlist/' || k || '.html'
              WHEN 1 THEN 'http://www.eshop.com/' END AS ref_url,
         CASE event_id % 7
              WHEN 0 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64)'
              WHEN 1 THEN 'Mozilla/5.0 (Linux; Android 9)'
              WHEN 2 THEN 'Mozilla/5.0 (X11; Linux x86_64)'
              WHEN 3 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 13_0 like Mac OS X)'
              WHEN 4 THEN 'Mozilla/5.0 (iPad; CPU OS 13_0 like Mac OS X)'
              WHEN 5 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15)'
              ELSE 'unknown' END AS agent
  FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events) e)"""

PREFIXES = """
prefixes AS (
  SELECT '138' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS prefix, r_name AS province,
         CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE n_name END AS city
  FROM nation JOIN region ON r_regionkey = n_regionkey)"""

RATINGS = """
ratings AS (
  SELECT CAST(uid AS INTEGER) AS "userId", pid AS "productId", count(*) AS rating
  FROM (SELECT uid, TRY_CAST(split_part(split_part(loc_url, '/product/', 2), '.html', 1) AS INTEGER) AS pid
        FROM logs WHERE loc_url LIKE '%/product/%.html%') v
  WHERE pid IS NOT NULL GROUP BY uid, pid)"""


def _with(body: str, *tables: str) -> str:
    return "WITH" + ",".join(tables) + "\n" + body


def _cuts(value: str, pairs: list[tuple[float, str]], other: str, test: str = ">=") -> str:
    whens = " ".join(f"WHEN {value} {test} {cut} THEN '{label}'" for cut, label in pairs)
    return f"CASE {whens} ELSE '{other}' END"


def _wide(parts: dict[str, str]) -> str:
    """One row per id with one column per tag; `parts` maps tags to (id, tag) queries."""
    ids = " UNION ".join(f"SELECT id FROM ({sql}) q" for sql in parts.values())
    joins = " ".join(
        f'LEFT JOIN ({sql}) t{i} ON t{i}.id = k.id' for i, sql in enumerate(parts.values())
    )
    columns = ", ".join(f't{i}."{tag}"' for i, tag in enumerate(parts))
    return f"SELECT k.id, {columns} FROM ({ids}) k {joins}"


def _known(sql: str) -> str:
    """The rows of known users."""
    return f"SELECT * FROM ({sql}) q WHERE CAST(id AS BIGINT) IN (SELECT c_custkey FROM customer)"


SQL: dict[str, str] = {}

# --- sources ---

SQL["read_users"] = _with("SELECT * REPLACE (CAST(id AS BIGINT) AS id) FROM users", USERS)
SQL["read_orders"] = _with(
    """SELECT sn AS id, member AS "memberId", sn AS "orderSn", amount AS "orderAmount",
       status AS "orderStatus", finished AS "finishTime", payment AS "paymentCode"
FROM shop_orders""",
    ORDERS,
)
SQL["read_goods"] = _with(
    """SELECT id, sn AS "orderId", sn AS "cOrderSn", pnum AS "productId", name AS "productName",
       type AS "productType", brand AS "brandId" FROM goods""",
    GOODS,
)
SQL["read_logs"] = _with(
    """SELECT id, uid AS global_user_id, strftime(stamp, '%Y-%m-%d %H:%M:%S') AS log_time,
       loc_url, ref_url, agent AS user_agent FROM logs""",
    LOGS,
)
SQL["read_orders_unified"] = SQL["read_orders"]
SQL["read_renamed"] = "SELECT c_custkey AS id, c_mktsegment AS user_agent FROM customer"
SQL["preview_users"] = _with("SELECT CAST(id AS BIGINT) AS id, job FROM users ORDER BY 1 LIMIT 10", USERS)

# --- user attributes ---

_CODES = {
    "gender": "CASE gender WHEN '1' THEN '男' WHEN '2' THEN '女' ELSE '未知' END",
    "job": "CASE job WHEN '1' THEN '学生' WHEN '2' THEN '公务员' WHEN '3' THEN '军人' "
    "WHEN '4' THEN '警察' WHEN '5' THEN '教师' WHEN '6' THEN '白领' ELSE '未知' END",
    "marriage": "CASE marriage WHEN '1' THEN '未婚' WHEN '2' THEN '已婚' WHEN '3' THEN '离异' "
    "ELSE '未知' END",
    "nationality": "CASE nationality WHEN '1' THEN '中国大陆' WHEN '2' THEN '中国香港' "
    "WHEN '3' THEN '中国澳门' WHEN '4' THEN '中国台湾' ELSE '其他' END",
    "politicalFace": """CASE "politicalFace" WHEN '1' THEN '群众' WHEN '2' THEN '党员' """
    "WHEN '3' THEN '无党派人士' ELSE '其他' END",
    "age": """CASE WHEN birthday >= '2020-01-01' THEN '20后' WHEN birthday >= '2010-01-01' THEN '10后'
      WHEN birthday >= '2000-01-01' THEN '00后' WHEN birthday >= '1990-01-01' THEN '90后'
      WHEN birthday >= '1980-01-01' THEN '80后' WHEN birthday >= '1970-01-01' THEN '70后'
      WHEN birthday >= '1960-01-01' THEN '60后' WHEN birthday >= '1950-01-01' THEN '50后'
      ELSE '其他' END""",
    "constellation": """CASE
      WHEN substr(birthday, 6) BETWEEN '03-21' AND '04-19' THEN '白羊座'
      WHEN substr(birthday, 6) BETWEEN '04-20' AND '05-20' THEN '金牛座'
      WHEN substr(birthday, 6) BETWEEN '05-21' AND '06-21' THEN '双子座'
      WHEN substr(birthday, 6) BETWEEN '06-22' AND '07-22' THEN '巨蟹座'
      WHEN substr(birthday, 6) BETWEEN '07-23' AND '08-22' THEN '狮子座'
      WHEN substr(birthday, 6) BETWEEN '08-23' AND '09-22' THEN '处女座'
      WHEN substr(birthday, 6) BETWEEN '09-23' AND '10-23' THEN '天秤座'
      WHEN substr(birthday, 6) BETWEEN '10-24' AND '11-22' THEN '天蝎座'
      WHEN substr(birthday, 6) BETWEEN '11-23' AND '12-21' THEN '射手座'
      WHEN substr(birthday, 6) >= '12-22' OR substr(birthday, 6) <= '01-19' THEN '摩羯座'
      WHEN substr(birthday, 6) BETWEEN '01-20' AND '02-18' THEN '水瓶座'
      ELSE '双鱼座' END""",
    "email": "email",
    "mobile": "mobile",
    "username": "username",
}
for _tag, _expr in _CODES.items():
    SQL[f"attr_{_tag}"] = _with(f'SELECT id, {_expr} AS "{_tag}" FROM users', USERS)
SQL["attr_all"] = _with(
    "SELECT id, " + ", ".join(f'{e} AS "{t}"' for t, e in _CODES.items()) + " FROM users", USERS
)
for _tag, _part in (("nativePlace", "city"), ("nativeProvince", "province")):
    SQL[f"attr_{_tag}"] = _with(
        f"""SELECT u.id, CASE WHEN p.{_part} IS NULL OR p.{_part} = '' THEN '未知'
       ELSE p.{_part} END AS "{_tag}"
FROM users u LEFT JOIN prefixes p ON p.prefix = substr(u.mobile, 1, 7)""",
        USERS,
        PREFIXES,
    )

SQL["attr_region_longest"] = _with(
    """SELECT id, CASE WHEN city IS NULL OR city = '' THEN '未知' ELSE city END AS "nativePlace",
       coalesce(province, '未知') AS "nativeProvince"
FROM (SELECT u.id, p.city, p.province,
             row_number() OVER (PARTITION BY u.id ORDER BY length(p.prefix) DESC) AS r
      FROM users u LEFT JOIN mixed p
        ON CAST(u.id AS INTEGER) % 7 <> 0 AND starts_with(u.mobile, p.prefix)) x
WHERE r = 1""",
    USERS,
    PREFIXES,
    """
mixed AS (
  SELECT prefix, province, city FROM prefixes WHERE CAST(substr(prefix, 7, 1) AS INTEGER) % 2 = 0
  UNION ALL
  SELECT substr(prefix, 1, 6), min(province), min(nullif(city, '')) FROM prefixes GROUP BY 1
  UNION ALL
  SELECT substr(prefix, 1, 3), max(province), max(city) FROM prefixes GROUP BY 1)""",
)

# --- behaviour ---

_LOGIN = "(loc_url LIKE '%login%' OR loc_url LIKE '%eshop.com/' OR loc_url LIKE '%m.eshop.com/?source=mobile')"
_BROWSE = (
    f"({_LOGIN} OR loc_url LIKE '%/itemlist/%' OR loc_url LIKE '%/l/%' OR loc_url LIKE '%/item/%' "
    "OR loc_url LIKE '%/product/%' OR loc_url LIKE '%/order/%' OR loc_url LIKE '%cart%' "
    "OR loc_url LIKE '%Cart%')"
)


def _frequency(tag: str, hit: str, pairs, other: str) -> str:
    return _with(
        f"""SELECT CAST(uid AS VARCHAR) AS id, {_cuts('n', pairs, other)} AS "{tag}", n AS metric
FROM (SELECT uid, count(*) AS n FROM logs WHERE {hit} GROUP BY uid) c""",
        LOGS,
    )


SQL["browse_frequency"] = _frequency(
    "browseFrequency", _BROWSE, [(255, "经常"), (230, "较常"), (200, "偶尔")], "很少"
)
SQL["browse_frequency_scaled"] = _frequency(
    "browseFrequency", _BROWSE, [(73, "经常"), (66, "较常"), (60, "偶尔")], "很少"
)
SQL["login_frequency"] = _frequency(
    "loginFrequency", _LOGIN, [(80, "经常"), (65, "一般"), (55, "较少")], "极少"
)
SQL["login_frequency_scaled"] = _frequency(
    "loginFrequency", _LOGIN, [(31, "经常"), (27, "一般"), (23, "较少")], "极少"
)
SQL["order_page_frequency"] = _frequency(
    "orderPageFrequency", "loc_url LIKE '%/order/%'", [(15, "高"), (10, "中")], "低"
)
SQL["page_type_counts"] = SQL["page_type_counts_staged"] = _with(
    """SELECT uid AS id,
       count(*) FILTER (loc_url LIKE '%login%') AS login,
       count(*) FILTER (loc_url LIKE '%eshop.com/' OR loc_url LIKE '%m.eshop.com/?source=mobile') AS eshop,
       count(*) FILTER (loc_url LIKE '%/itemlist/%' OR loc_url LIKE '%/l/%') AS itemlist,
       count(*) FILTER (loc_url LIKE '%/item/%' OR loc_url LIKE '%/product/%') AS product,
       count(*) FILTER (loc_url LIKE '%/order/%') AS "order"
FROM logs GROUP BY uid""",
    LOGS,
)
SQL["browse_period"] = _with(
    """SELECT CAST(uid AS VARCHAR) AS id,
       CASE greatest(a, b, c, d, e) WHEN a THEN '1-7' WHEN b THEN '8-12' WHEN c THEN '13-17'
            WHEN d THEN '18-21' ELSE '22-24' END AS "browsePeriod",
       greatest(a, b, c, d, e) AS metric
FROM (SELECT uid,
             count(*) FILTER (hour(stamp) BETWEEN 1 AND 7) AS a,
             count(*) FILTER (hour(stamp) BETWEEN 8 AND 12) AS b,
             count(*) FILTER (hour(stamp) BETWEEN 13 AND 17) AS c,
             count(*) FILTER (hour(stamp) BETWEEN 18 AND 21) AS d,
             count(*) FILTER (hour(stamp) BETWEEN 22 AND 24) AS e
      FROM logs GROUP BY uid) h""",
    LOGS,
)


def _gap(pairs) -> str:
    return _with(
        f"""SELECT CAST(uid AS VARCHAR) AS id,
       {_cuts('gap', pairs, '1分钟内', '>')} AS "browseTime", gap AS metric
FROM (SELECT l.uid, CAST(epoch(m.stamp) - epoch(max(l.stamp)) AS BIGINT) AS gap
      FROM logs l JOIN (SELECT uid, max(stamp) AS stamp FROM logs GROUP BY uid) m ON m.uid = l.uid
      WHERE l.stamp < m.stamp AND CAST(l.stamp AS DATE) = CAST(m.stamp AS DATE)
      GROUP BY l.uid, m.stamp) g""",
        LOGS,
    )


SQL["browse_time"] = _gap([(300, "5分钟以上"), (60, "1-5分钟")])
SQL["browse_time_scaled"] = _gap([(21600, "5分钟以上"), (7200, "1-5分钟")])
SQL["device_type"] = _with(
    """SELECT CAST(uid AS VARCHAR) AS id, device AS "deviceType", n AS metric
FROM (SELECT uid, device, n, row_number() OVER (PARTITION BY uid ORDER BY n DESC, device) AS r
      FROM (SELECT uid, device, count(*) AS n
            FROM (SELECT uid, CASE WHEN agent LIKE '%Window%' THEN 'Window'
                              WHEN agent LIKE '%Android%' THEN 'Android'
                              WHEN agent LIKE '%Linux%' THEN 'Linux'
                              WHEN agent LIKE '%iPhone%' OR agent LIKE '%iPad%' THEN 'IOS'
                              WHEN agent LIKE '%Mac%' THEN 'Mac' END AS device
                  FROM logs) a
            WHERE device IS NOT NULL GROUP BY uid, device) c) x
WHERE r = 1""",
    LOGS,
)


def _urls(direction: str) -> str:
    return _with(
        f"""SELECT CAST(uid AS VARCHAR) AS id, loc_url AS "urlBrowse", n AS metric
FROM (SELECT uid, loc_url, n,
             row_number() OVER (PARTITION BY uid ORDER BY n {direction}, loc_url NULLS LAST) AS r
      FROM (SELECT uid, loc_url, count(loc_url) AS n FROM logs
            GROUP BY uid, loc_url) c) x
WHERE r = 1""",
        LOGS,
    )


SQL["url_browse"] = _urls("ASC")
SQL["url_browse_most"] = _urls("DESC")


def _logins(unit: int) -> str:
    return _with(
        f"""SELECT id, CASE WHEN age > 14 * {unit} THEN '30天内' WHEN age > 7 * {unit} THEN '14天内'
       WHEN age > {unit} THEN '7天内' ELSE '1天内' END AS "lastLogin", age AS metric
FROM (SELECT id, abs(seen - (SELECT max(seen) FROM logins)) AS age FROM logins) a""",
        LOGINS,
    )


SQL["last_login"] = _logins(86400)
SQL["last_login_scaled"] = _logins(3600)


def _last_product(column: str) -> str:
    return _with(
        f"""SELECT DISTINCT CAST(v.uid AS VARCHAR) AS id, v.pid AS "productId", n.name AS "productName"
FROM (SELECT uid, stamp, max(stamp) OVER (PARTITION BY uid) AS newest,
             split_part(list_extract(string_split({column}, '/'), -1), '.html', 1) AS pid
      FROM logs
      WHERE {column} LIKE '%/itemlist/%' OR {column} LIKE '%/item/%' OR {column} LIKE '%/product/%'
         OR {column} LIKE '%/productSpecification/%') v
JOIN (SELECT pid, split_part(name, ',', 1) AS name,
             row_number() OVER (PARTITION BY pid ORDER BY length(name) DESC, name) AS r
      FROM goods) n ON n.pid = v.pid AND n.r = 1
WHERE v.stamp = v.newest""",
        LOGS,
        GOODS,
    )


SQL["last_browsed_product"] = _last_product("loc_url")
SQL["last_browsed_product_referrer"] = _last_product("ref_url")
SQL["last_browsed_product_first"] = (
    f'SELECT id, min("productName") AS "productName" FROM ({SQL["last_browsed_product"]}) p GROUP BY id'
)


def _purchases(source: str) -> str:
    return _with(
        f"""SELECT CAST(uid AS VARCHAR) AS id, pid AS "productId", split_part(name, ',', 1) AS "purchaseName"
FROM (SELECT o.uid, g.pid, g.name,
             row_number() OVER (PARTITION BY o.uid, g.pid ORDER BY length(g.name) DESC, g.name) AS r
      FROM {source} o JOIN goods g ON g.sn = o.sn) x
WHERE r = 1""",
        ORDERS,
        GOODS,
    )


SQL["purchased_products"] = _purchases("shop_orders")
SQL["purchased_products_latest"] = _purchases(
    "(SELECT * FROM shop_orders s WHERE finished = "
    "(SELECT max(finished) FROM shop_orders t WHERE t.uid = s.uid))"
)
SQL["purchased_product_list"] = f"""
SELECT id, CAST(CAST("productId" AS BIGINT) // 100000 AS INTEGER) AS part, string_agg("purchaseName", ',' ORDER BY "purchaseName") AS "productPurchased"
FROM ({SQL["purchased_products"]}) p GROUP BY 1, 2"""
SQL["purchased_products_colocated"] = SQL["purchased_products"]
SQL["latest_orders"] = _with(
    """SELECT CAST(uid AS VARCHAR) AS id, CAST(sn AS VARCHAR) AS "orderSn", finished AS "finishTime"
FROM (SELECT uid, sn, finished, max(finished) OVER (PARTITION BY uid) AS newest
      FROM shop_orders) x
WHERE finished = newest""",
    ORDERS,
)

# --- consumption ---


def _order_tag(tag: str, measure: str, pairs, other: str, where: str = "TRUE", scale: int | None = None) -> str:
    value = "m + 1e-9" if measure.startswith("avg") else "m"
    metric = "m" if scale is None else f"round({value}, {scale})"
    return _with(
        f"""SELECT CAST(uid AS VARCHAR) AS id, {_cuts('m', pairs, other)} AS "{tag}", {metric} AS metric
FROM (SELECT uid, {measure} AS m FROM shop_orders WHERE {where} GROUP BY uid) x""",
        ORDERS,
    )


_DONE = "status = '202'"
_KEPT = "status <> '203'"
_CYCLE = "(max(finished) - min(finished)) / count(*)"


def _share(status: str) -> str:
    return f"count(*) FILTER (status = '{status}') / count(*)"


def _days(pairs):
    return [(days * 86400, label) for days, label in pairs]


SQL["purchase_frequency"] = _order_tag("purchaseFrequency", "count(*)", [(250, "高"), (200, "中")], "低")
SQL["purchase_frequency_scaled"] = _order_tag(
    "purchaseFrequency", "count(*)", [(20, "高"), (12, "中")], "低"
)
SQL["consumption_power"] = _order_tag(
    "consumptionPower",
    "sum(amount)",
    [(500000, "超高"), (200000, "高"), (150000, "中上"), (100000, "中"), (50000, "中下"), (10000, "低")],
    "很低",
    _DONE,
    2,
)
_POWER = [(4500000, "超高"), (3000000, "高"), (2200000, "中上"), (1600000, "中"), (1000000, "中下"),
          (500000, "低")]
SQL["consumption_power_scaled"] = _order_tag(
    "consumptionPower", "sum(amount)", _POWER, "很低", _DONE, 2
)
SQL["order_value"] = _order_tag(
    "monovalent",
    "avg(amount)",
    [(5000, "5000-9999"), (3000, "3000-4999"), (1000, "1000-2999")],
    "1-999",
    _DONE,
    4,
)
SQL["order_value_scaled"] = _order_tag(
    "monovalent",
    "avg(amount)",
    [(300000, "5000-9999"), (250000, "3000-4999"), (200000, "1000-2999")],
    "1-999",
    _DONE,
    4,
)
_WHOLE = "max(CAST(trunc(amount) AS INTEGER))"
SQL["max_amount"] = _order_tag(
    "maxAmount",
    _WHOLE,
    [(50000, "50000及以上"), (20000, "20000-49999"), (10000, "10000-19999"), (5000, "5000-9999"),
     (1, "1-4999")],
    "未消费",
    _DONE,
)
SQL["max_amount_scaled"] = _order_tag(
    "maxAmount",
    _WHOLE,
    [(480000, "50000及以上"), (450000, "20000-49999"), (400000, "10000-19999"), (300000, "5000-9999"),
     (1, "1-4999")],
    "未消费",
    _DONE,
)
SQL["consumption_cycle"] = _order_tag(
    "consumptionCycle",
    _CYCLE,
    _days([(180, "6月"), (150, "5月"), (120, "4月"), (90, "3月"), (60, "2月"), (30, "1月"), (14, "2周"),
           (7, "7日"), (5, "5日"), (3, "3日"), (2, "2日")]),
    "1日",
    _DONE,
    6,
)
SQL["consumption_cycle_scaled"] = _order_tag(
    "consumptionCycle",
    _CYCLE,
    _days([(500, "6月"), (400, "5月"), (350, "4月"), (300, "3月"), (270, "2月"), (240, "1月"),
           (210, "2周"), (180, "7日"), (150, "5日"), (120, "3日"), (60, "2日")]),
    "1日",
    _DONE,
    6,
)
for _name, _tag, _status, _cut, _scaled in (
    ("return_rate", "returnRate", "0", (0.02, 0.0002), (0.15, 0.05)),
    ("exchange_rate", "exchangeRate", "1", (0.01, 0.0001), (0.15, 0.05)),
    ("consultation_frequency", "consultationFrequency", "204", (0.02, 0.002), (0.2, 0.1)),
):
    for _suffix, (_high, _mid) in (("", _cut), ("_scaled", _scaled)):
        SQL[_name + _suffix] = _order_tag(
            _tag, _share(_status), [(_high, "高"), (_mid, "中")], "低", _KEPT, 6
        )
    SQL[f"mean_{_name}"] = f"""
SELECT count(m) AS n, round(sum(m), 6) AS total, round(avg(m), 6) AS mean
FROM ({_with(f"SELECT uid, {_share(_status)} AS m FROM shop_orders WHERE {_KEPT} GROUP BY uid", ORDERS)}) x"""
SQL["mean_orders"] = _with(
    """SELECT count(m) AS n, CAST(sum(m) AS BIGINT) AS total, round(avg(m), 6) AS mean
FROM (SELECT uid, count(*) AS m FROM shop_orders GROUP BY uid) x""",
    ORDERS,
)

_PAYMENT = """CASE payment WHEN 'alipay' THEN '支付宝' WHEN 'wxpay' THEN '微信' WHEN 'balance' THEN '余额'
       WHEN 'ccb' THEN '银行卡' WHEN 'chinaecpay' THEN '银行卡' WHEN 'chinapay' THEN '银行卡'
       ELSE '其他方式' END AS "paymentMode", n AS metric"""
SQL["payment_mode"] = _with(
    f"""SELECT CAST(uid AS VARCHAR) AS id, {_PAYMENT}
FROM (SELECT uid, payment, n, row_number() OVER (PARTITION BY uid ORDER BY n DESC, payment) AS r
      FROM (SELECT uid, payment, count(*) AS n FROM shop_orders
            GROUP BY uid, payment) c) x
WHERE r = 1""",
    ORDERS,
)
SQL["payment_mode_by_member"] = _with(
    f"""SELECT CAST(member AS VARCHAR) AS "memberId", CAST(member % 1000 AS VARCHAR) AS id, {_PAYMENT}
FROM (SELECT member, payment, n, row_number() OVER (PARTITION BY member ORDER BY n DESC, payment) AS r
      FROM (SELECT member, payment, count(*) AS n FROM shop_orders GROUP BY member, payment) c) x
WHERE r = 1""",
    ORDERS,
)

# --- tags that share a pass ---

_LOG_TAGS = {
    "browseFrequency": SQL["browse_frequency"],
    "loginFrequency": SQL["login_frequency"],
    "browsePeriod": SQL["browse_period"],
    "deviceType": SQL["device_type"],
}
_ORDER_TAGS = {
    "purchaseFrequency": SQL["purchase_frequency"],
    "consumptionPower": SQL["consumption_power"],
    "monovalent": SQL["order_value"],
    "maxAmount": SQL["max_amount"],
    "consumptionCycle": SQL["consumption_cycle"],
    "returnRate": SQL["return_rate"],
    "exchangeRate": SQL["exchange_rate"],
    "consultationFrequency": SQL["consultation_frequency"],
}
SQL["log_tags"] = _wide(_LOG_TAGS)
SQL["log_tags_known"] = _known(SQL["log_tags"])
SQL["order_tags"] = _wide(_ORDER_TAGS)
SQL["order_tags_known"] = _known(SQL["order_tags"])
SQL["last_login_known"] = _known(SQL["last_login"])

# --- ratings ---

SQL["product_id_from_url"] = _with(
    """SELECT id, part AS "productText", TRY_CAST(part AS INTEGER) AS "productId",
       split_part(list_extract(string_split(url, '/'), -1), '.html', 1) AS segment
FROM (SELECT id, url,
             CASE WHEN instr(url, '/product/') > 0 AND instr(url, '.html') > instr(url, '/product/')
                  THEN substr(url, instr(url, '/product/') + 9,
                              instr(url, '.html') - instr(url, '/product/') - 9) END AS part
      FROM (SELECT id, loc_url AS url FROM logs
            UNION ALL
            SELECT -page_id - 1, regexp_replace(url, '/(en|de|fr|es)/', '/product/', 'g') FROM pages) u) x""",
    LOGS,
)
SQL["product_ratings"] = _with('SELECT "userId", "productId", rating FROM ratings', LOGS, RATINGS)


def _item(item: str, name: str, by_line: bool = False, rows: bool = False) -> str:
    """The plain join; only without `by_line` and `rows` are goods made distinct."""
    tables = (LOGS, GOODS, RATINGS)
    if rows:
        join = "LEFT JOIN" if name == "brandId" else "JOIN"
        return _with(
            f"""SELECT r."userId", {item} AS "{name}", r.rating, count(*) AS copies
FROM goods g {join} ratings r ON r."productId" = g.pnum GROUP BY r."userId", {item}, r.rating""",
            *tables,
        )
    source = "goods" if by_line else f"(SELECT DISTINCT pnum, {item} AS item FROM goods)"
    column = item if by_line else "item"
    return _with(
        f"""SELECT r."userId", {column} AS "{name}", CAST(sum(r.rating) AS BIGINT) AS rating
FROM {source} g JOIN ratings r ON r."productId" = g.pnum GROUP BY r."userId", {column}""",
        *tables,
    )


SQL["brand_ratings"] = _item("brand", "brandId")
SQL["brand_ratings_by_line"] = _item("brand", "brandId", by_line=True)
SQL["brand_rating_rows"] = _item("brand", "brandId", rows=True)
SQL["category_ratings"] = _item("type_code", "productType")
SQL["category_ratings_by_line"] = _item("type_code", "productType", by_line=True)
SQL["category_rating_rows"] = _item("type_code", "productType", rows=True)
SQL["category_ratings_scaled"] = _item(
    "CASE type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'SMALL' THEN 3 ELSE 0 END",
    "productType",
)
SQL["split_ratings"] = _with(
    """SELECT "userId", "productId", rating,
       CASE WHEN CAST('0x' || substr(md5("userId" || ',' || "productId" || ',0'), 1, 8) AS BIGINT) % 1000
                 < 800 THEN 'train' ELSE 'test' END AS part
FROM ratings""",
    LOGS,
    RATINGS,
)


def _ranked(source: str, item: str, k: int) -> str:
    return f"""SELECT "userId", "{item}" AS item, r FROM (
  SELECT "userId", "{item}", row_number() OVER (PARTITION BY "userId" ORDER BY rating DESC, "{item}") AS r
  FROM ({SQL[source]}) s) t WHERE r <= {k}"""


def _list(source: str, item: str, k: int, name: str) -> str:
    return f"""SELECT CAST("userId" AS BIGINT) AS id, string_agg(CAST(item AS VARCHAR), ',' ORDER BY r) AS "{name}"
FROM ({_ranked(source, item, k)}) x GROUP BY "userId\""""


_BRAND = """CASE item WHEN 297 THEN '海尔' WHEN 298 THEN '卡萨帝' WHEN 299 THEN '统帅'
  WHEN 305 THEN 'MOOKA' ELSE '其他' END"""
_TYPE = """CASE item WHEN 1 THEN '电热水器' WHEN 2 THEN '燃气灶' WHEN 3 THEN '智能电视' WHEN 4 THEN '微波炉'
  WHEN 5 THEN 'Haier/海尔冰箱' WHEN 6 THEN '4K电视' WHEN 7 THEN '烟灶套系' WHEN 8 THEN '空气净化器'
  WHEN 9 THEN '净水机' WHEN 10 THEN '滤芯' WHEN 11 THEN '电饭煲' WHEN 12 THEN '料理机'
  WHEN 13 THEN '吸尘器/除螨仪' WHEN 14 THEN '电磁炉' WHEN 15 THEN '前置过滤器' WHEN 16 THEN '电水壶/热水瓶'
  WHEN 17 THEN 'LED电视' WHEN 18 THEN '取暖电器' WHEN 19 THEN '烤箱' WHEN 20 THEN '嵌入式厨电'
  ELSE '其他' END"""


def _slots(source: str, item: str, k: int, prefix: str, label: str | None) -> str:
    """One column per rank; an absent rank has the label of an unknown item."""
    if label is None:
        cells = [f'max(CASE WHEN r = {i + 1} THEN CAST(item AS VARCHAR) END) AS "{prefix}_{i}"'
                 for i in range(k)]
        user = 'CAST("userId" AS BIGINT)'
    else:
        cells = [f"""coalesce(max(CASE WHEN r = {i + 1} THEN {label} END), '其他') AS "{prefix}_{i}\""""
                 for i in range(k)]
        user = 'CAST("userId" AS VARCHAR)'
    return f"""SELECT {user} AS id, {', '.join(cells)}
FROM ({_ranked(source, item, k)}) x GROUP BY "userId\""""


SQL["brand_list"] = _list("brand_ratings", "brandId", 2, "favorBrands")
SQL["brand_slots"] = _slots("brand_ratings", "brandId", 2, "favorBrand", _BRAND)
SQL["brand_histogram"] = f"""SELECT "favorBrand", count(*) AS count
FROM ({_list("brand_ratings", "brandId", 1, "favorBrand")}) l GROUP BY "favorBrand\""""
SQL["type_slots"] = _slots("category_ratings", "productType", 10, "favorType", _TYPE)
SQL["type_slots_from_list"] = _slots("category_ratings", "productType", 10, "favorType", None)
SQL["product_list"] = f"""SELECT CAST(id AS VARCHAR) AS id, "favorProducts"
FROM ({_list("product_ratings", "productId", 10, "favorProducts")}) l"""
SQL["preferences"] = f"""SELECT * FROM ({SQL["brand_slots"]}) b
FULL JOIN ({SQL["type_slots"]}) t USING (id) FULL JOIN ({SQL["product_list"]}) p USING (id)"""

# --- recency, frequency and money ---

SQL["rfm"] = _with(
    """SELECT CAST(member AS VARCHAR) AS "memberId",
       CAST(date_diff('day', CAST(make_timestamp(max(finished) * 1000000) AS DATE),
                      DATE '2003-05-20' - 660) AS INTEGER) AS rencency,
       count(*) AS frequency, round(sum(amount), 2) AS "moneyTotal"
FROM shop_orders GROUP BY member""",
    ORDERS,
)
SQL["rfm_score"] = f"""
SELECT "memberId",
       CASE WHEN rencency BETWEEN 1 AND 3 THEN 5 WHEN rencency BETWEEN 4 AND 6 THEN 4
            WHEN rencency BETWEEN 7 AND 9 THEN 3 WHEN rencency BETWEEN 10 AND 15 THEN 2
            WHEN rencency >= 16 THEN 1 END AS rencency,
       CASE WHEN frequency >= 200 THEN 5 WHEN frequency >= 150 THEN 4 WHEN frequency >= 100 THEN 3
            WHEN frequency >= 50 THEN 2 WHEN frequency >= 1 THEN 1 END AS frequency,
       CASE WHEN "moneyTotal" >= 200000 THEN 5 WHEN "moneyTotal" BETWEEN 100000 AND 199999 THEN 4
            WHEN "moneyTotal" BETWEEN 50000 AND 99999 THEN 3
            WHEN "moneyTotal" BETWEEN 10000 AND 49999 THEN 2
            WHEN "moneyTotal" <= 9999 THEN 1 END AS "moneyTotal"
FROM ({SQL["rfm"]}) x"""
SQL["rfm_score_scaled"] = f"""
SELECT "memberId",
       CASE WHEN rencency BETWEEN 1 AND 60 THEN 5 WHEN rencency BETWEEN 61 AND 120 THEN 4
            WHEN rencency BETWEEN 121 AND 240 THEN 3 WHEN rencency BETWEEN 241 AND 480 THEN 2
            WHEN rencency >= 481 THEN 1 END AS rencency,
       CASE WHEN frequency >= 15 THEN 5 WHEN frequency >= 11 THEN 4 WHEN frequency >= 8 THEN 3
            WHEN frequency >= 5 THEN 2 WHEN frequency >= 1 THEN 1 END AS frequency,
       CASE WHEN "moneyTotal" >= 4000000 THEN 5 WHEN "moneyTotal" BETWEEN 3000000 AND 3999999 THEN 4
            WHEN "moneyTotal" BETWEEN 2000000 AND 2999999 THEN 3
            WHEN "moneyTotal" BETWEEN 1000000 AND 1999999 THEN 2
            WHEN "moneyTotal" <= 999999 THEN 1 END AS "moneyTotal"
FROM ({SQL["rfm"]}) x"""

SQL["rfm_segments_coverage"] = f"""
SELECT rencency, frequency, "moneyTotal", count(*) AS members, TRUE AS one_segment, TRUE AS known
FROM ({SQL["rfm_score_scaled"]}) s
WHERE rencency IS NOT NULL AND frequency IS NOT NULL AND "moneyTotal" IS NOT NULL GROUP BY 1, 2, 3"""

# --- models ---

SQL["als_coverage"] = f"""
SELECT DISTINCT "userId", (SELECT least(10, count(DISTINCT "productId")) FROM ({SQL["product_ratings"]}) i) AS items,
       TRUE AS distinct_items, TRUE AS in_order
FROM ({SQL["product_ratings"]}) r"""
SQL["als_stored"] = f"""
SELECT count(DISTINCT "userId") AS users, count(DISTINCT "productId") AS items, 10 AS rank
FROM ({SQL["product_ratings"]}) r"""
SQL["als_fold_in"] = f"""
SELECT DISTINCT "userId" AS id, 10 AS factors, TRUE AS finite
FROM ({SQL["product_ratings"]}) r
WHERE "productId" IN (SELECT "productId" FROM ({SQL["split_ratings"]}) t WHERE part = 'train')"""
SQL["als_rmse_coverage"] = f"""
WITH t AS ({SQL["split_ratings"]})
SELECT count(*) AS predictions, TRUE AS bounded FROM t
WHERE part = 'test' AND "userId" IN (SELECT "userId" FROM t WHERE part = 'train')
  AND "productId" IN (SELECT "productId" FROM t WHERE part = 'train')"""

# --- tags from stored days ---

SQL["order_tags_stored"] = SQL["order_tags"]
SQL["rfm_stored"] = SQL["rfm"]
SQL["log_tags_stored"] = SQL["log_tags"]
SQL["browse_time_stored"] = f'SELECT id, "browseTime" FROM ({SQL["browse_time"]}) b'
SQL["page_type_counts_by_day"] = f"SELECT * FROM ({SQL['page_type_counts']}) c WHERE id IS NOT NULL"

# --- learned bands ---

_METRICS = {
    "purchaseFrequency": "count(*)",
    "maxAmount": "max(CASE WHEN status = '202' THEN CAST(trunc(amount) AS INTEGER) END)",
    "consumptionCycle": "(max(CASE WHEN status = '202' THEN finished END) - min(CASE WHEN status = '202' THEN finished END))"
    " / nullif(count(*) FILTER (status = '202'), 0)",
}


def _learned(tag: str) -> str:
    """A label by how many values there are up to the edge, in the order of the values."""
    label = " ".join(
        f"""WHEN m >= (SELECT min(m) FROM ranked WHERE r >= greatest(1, ceil({share} * n))) THEN '{name}'"""
        for share, name in ((0.75, "高"), (0.5, "中"), (0.25, "低"))
    )
    return _with(
        f"""SELECT CAST(uid AS VARCHAR) AS id, CASE {label} ELSE '很低' END AS "{tag}" FROM ranked""",
        ORDERS,
        f"""
ranked AS (
  SELECT uid, m, row_number() OVER (ORDER BY m) AS r, count(*) OVER () AS n
  FROM (SELECT uid, {_METRICS[tag]} AS m FROM shop_orders GROUP BY uid) x WHERE m IS NOT NULL)""",
    )


SQL["learned_order_bands"] = _wide({tag: _learned(tag) for tag in _METRICS})

# --- the profile ---

_USER_TAGS = {
    **{tag: SQL[f"attr_{tag}"] for tag in _CODES},
    "nativePlace": SQL["attr_nativePlace"],
    "nativeProvince": SQL["attr_nativeProvince"],
}
_TAGS = {
    **_LOG_TAGS,
    "browseTime": SQL["browse_time"],
    "lastLogin": SQL["last_login"],
    "productName": SQL["last_browsed_product_first"],
    "purchaseName": f"""SELECT id, min("purchaseName") AS "purchaseName"
                        FROM ({SQL["purchased_products"]}) p GROUP BY id""",
    "urlBrowse": SQL["url_browse"],
    **_ORDER_TAGS,
    "paymentMode": SQL["payment_mode"],
}
SQL["profile"] = SQL["profile_staged"] = _wide({**_USER_TAGS, **_TAGS})
SQL["profile_known"] = _wide({**_USER_TAGS, **{tag: _known(sql) for tag, sql in _TAGS.items()}})
SQL["profile_with_preferences"] = f"""
SELECT * FROM ({SQL["profile"]}) p FULL JOIN ({SQL["preferences"]}) f USING (id)"""
_FINISHED_COUNT = _order_tag("purchaseFrequency", "count(*)", [(10, "高"), (6, "中")], "低", _DONE)
SQL["profile_upsert"] = f"""
SELECT coalesce(p.id, n.id) AS id, p.gender,
       CASE WHEN n.id IS NOT NULL THEN n."purchaseFrequency" ELSE p."purchaseFrequency" END
         AS "purchaseFrequency"
FROM ({_wide({"gender": SQL["attr_gender"], "purchaseFrequency": SQL["purchase_frequency_scaled"]})}) p
FULL JOIN ({_FINISHED_COUNT}) n ON n.id = p.id"""
SQL["profile_promote"] = _wide(
    {
        "gender": SQL["attr_gender"],
        "exchangeRate": SQL["exchange_rate_scaled"],
        "consultationFrequency": SQL["consultation_frequency_scaled"],
    }
)
_MANY = {"gender": SQL["attr_gender"], **_ORDER_TAGS, "paymentMode": SQL["payment_mode"]}
SQL["profile_promote_many"] = f"""
SELECT w.* REPLACE (coalesce(n."purchaseFrequency", w."purchaseFrequency") AS "purchaseFrequency")
FROM ({_wide(_MANY)}) w LEFT JOIN ({_FINISHED_COUNT}) n ON n.id = w.id"""
SQL["profile_by_range"] = f"SELECT * FROM ({SQL['attr_all']}) a WHERE id >= '2' AND id <= '5'"
