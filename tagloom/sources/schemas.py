"""Schemas of the shop tables. Every source column is nullable text."""

from __future__ import annotations

from pyspark.sql import types as T

TAG_PREFIX = "up_"


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


USERS = _text(
    "id",
    "birthday",
    "gender",
    "job",
    "marriage",
    "nationality",
    "politicalFace",
    "email",
    "mobile",
    "username",
    "lastLoginTime",
)
LOGS = _text("id", "global_user_id", "log_time", "loc_url", "ref_url", "user_agent")
ORDERS = _text(
    "id", "memberId", "orderSn", "orderAmount", "orderStatus", "finishTime", "paymentCode"
)
GOODS = _text(
    "id", "orderId", "cOrderSn", "productId", "productName", "productType", "brandId"
)
PREFIXES = _text("prefix", "province", "city")

# The tag columns of the wide profile.
PROFILE_TAGS = (
    "gender",
    "job",
    "marriage",
    "nationality",
    "politicalFace",
    "age",
    "constellation",
    "email",
    "mobile",
    "username",
    "nativePlace",
    "nativeProvince",
    "browseFrequency",
    "browsePeriod",
    "browseTime",
    "deviceType",
    "lastLogin",
    "loginFrequency",
    "productName",
    "purchaseName",
    "urlBrowse",
    "paymentMode",
    "exchangeRate",
    "maxAmount",
    "monovalent",
    "consumptionCycle",
    "consultationFrequency",
    "purchaseFrequency",
    "consumptionPower",
    "returnRate",
    *(f"favorBrand_{i}" for i in range(2)),
    *(f"favorType_{i}" for i in range(10)),
    "favorProducts",
)
