"""Cut-offs near the quartiles of the sample tables.

The sample tables never reach most of the fixed cut-offs. Every banded tag is
therefore also registered with these, so that each of its labels occurs.
"""

from __future__ import annotations

import datetime

BROWSE = [(73, "经常"), (66, "较常"), (60, "偶尔")]
LOGIN = [(31, "经常"), (27, "一般"), (23, "较少")]
GAP = [(21600, "5分钟以上"), (7200, "1-5分钟")]
LOGIN_AGE_UNIT = 3600
ORDER_COUNT = [(20, "高"), (12, "中")]
FINISHED_COUNT = [(10, "高"), (6, "中")]
POWER = [
    (4500000, "超高"),
    (3000000, "高"),
    (2200000, "中上"),
    (1600000, "中"),
    (1000000, "中下"),
    (500000, "低"),
]
ORDER_VALUE = [(300000, "5000-9999"), (250000, "3000-4999"), (200000, "1000-2999")]
MAX_AMOUNT = [
    (480000, "50000及以上"),
    (450000, "20000-49999"),
    (400000, "10000-19999"),
    (300000, "5000-9999"),
    (1, "1-4999"),
]
CYCLE = [
    (500, "6月"),
    (400, "5月"),
    (350, "4月"),
    (300, "3月"),
    (270, "2月"),
    (240, "1月"),
    (210, "2周"),
    (180, "7日"),
    (150, "5日"),
    (120, "3日"),
    (60, "2日"),
]
RETURN = [(0.15, "高"), (0.05, "中")]
EXCHANGE = [(0.15, "高"), (0.05, "中")]
CONSULT = [(0.2, "高"), (0.1, "中")]

# 660 days before this day lies at the end of the sample orders.
AS_OF = datetime.date(2003, 5, 20)
RECENCY = [(1, 60, 5), (61, 120, 4), (121, 240, 3), (241, 480, 2), (481, None, 1)]
FREQUENCY = [(15, None, 5), (11, 14, 4), (8, 10, 3), (5, 7, 2), (1, 4, 1)]
MONEY = [
    (4000000, None, 5),
    (3000000, 3999999, 4),
    (2000000, 2999999, 3),
    (1000000, 1999999, 2),
    (None, 999999, 1),
]
