"""One tag as a job: read the shop tables, compute the tag, stage it or put it in the profile.

    python -m tagloom.job consumptionPower --tables /shop --stage /shop/staged
    python -m tagloom.job consumptionPower --promote /shop/staged \\
        --profile /shop/profile/v1 --out /shop/profile/v2
    python -m tagloom.job gender --tables /shop --out /shop/profile/v1
    python -m tagloom.job profile --tables /shop --out /shop/profile/v1

    python -m tagloom.job favorTypeModel --tables /shop --model /shop/models
    python -m tagloom.job favorType --model /shop/models --out /shop/types
    python -m tagloom.job order_tags --tables /shop --stage-rows /shop/rows
    python -m tagloom.job many --promote-rows /shop/rows --tags maxAmount,returnRate \\
        --profile /shop/profile/v1 --out /shop/profile/v2

The tables are the folders users, orders, goods, logs and prefixes below --tables. A preference job with
--model takes the model that a model job wrote, fitted whenever that was; with --fold-in it gives lists to
the users of the present ratings, whether the model knows them or not.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.models import als, ratings, retrieval, rfm
from tagloom.plans.profile import build_profile, first_by_name
from tagloom.session import configure
from tagloom.sources import (
    checkpointed,
    load_goods,
    load_logs,
    load_orders,
    load_table,
    load_users,
    promote_tag,
    promote_tags,
    read_profile,
    read_staged_tag,
    shared_folder,
    stage_tag,
    stage_tags,
    upsert_tags,
    write_profile,
)
from tagloom.sources.schemas import PREFIXES
from tagloom.tags import attribute, behaviour, consumption
from tagloom.tags import dictionaries as d


#: Preference jobs: the item that is recommended, and how many of them.
PREFERENCES = {"favorBrand": ("brandId", 2), "favorType": ("productType", 10), "favorProducts": ("productId", 10)}
LABELS = {"favorBrand": als.favor_brands, "favorType": als.favor_types, "favorProducts": als.favor_products}


class Tables:
    """The shop tables below a folder; each is read when it is asked for."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None,
        known_only: bool = False,
        models: str | None = None,
        fold_in: bool = False,
    ):
        self.spark, self.folder = spark, (folder or "").rstrip("/")
        self.models, self.fold_in = models, fold_in
        self.known = self.users if known_only else None

    @property
    def users(self) -> DataFrame:
        return load_users(self.spark, f"{self.folder}/users")

    @property
    def orders(self) -> DataFrame:
        return load_orders(self.spark, f"{self.folder}/orders")

    @property
    def goods(self) -> DataFrame:
        return load_goods(self.spark, f"{self.folder}/goods")

    @property
    def logs(self) -> DataFrame:
        return load_logs(self.spark, f"{self.folder}/logs")

    @property
    def prefixes(self) -> DataFrame:
        return load_table(self.spark, f"{self.folder}/prefixes", schema=PREFIXES)

    def ratings(self, item: str) -> DataFrame:
        if item == "productId":
            return ratings.product_ratings(self.logs)
        by_item = {"brandId": ratings.brand_ratings, "productType": ratings.category_ratings}
        return by_item[item](self.goods, self.logs)

    def train(self, item: str, folder: str) -> str:
        """Fit a model of the ratings of `item` and write it below `folder`, in place of the one there."""
        path = f"{folder}/{item}"
        als.save_model(als.fit_als(self.ratings(item), item), path)
        return path

    def model(self, item: str) -> ALSModel:
        """The model below --model; without that a new one, fitted now."""
        if self.models:
            return als.load_model(f"{self.models}/{item}")
        return als.load_model(self.train(item, f"{shared_folder(self.spark)}/model-{uuid.uuid4().hex}"))

    def preference(self, tag: str) -> DataFrame:
        item, k = PREFERENCES[tag]
        model = self.model(item)
        if self.fold_in:
            return LABELS[tag](retrieval.recommend_folded(model, self.ratings(item), item, k))
        return LABELS[tag](retrieval.recommend_by_norm(model, item, k))

    def scores(self) -> DataFrame:
        return rfm.rfm_score(rfm.rfm(self.orders))

    def rmse(self) -> DataFrame:
        """The error of product ratings that a fit on the others predicts."""
        train, test = ratings.split_ratings(checkpointed(self.ratings("productId")), "productId")
        return als.als_rmse(als.fit_als(train, "productId", checkpoint=False), test)


Job = Callable[[Tables], DataFrame]

JOBS: dict[str, Job] = {
    **{tag: lambda t, tag=tag: attribute.coded_tag(t.users, tag) for tag in attribute.CODE_TAGS},
    **{tag: lambda t, tag=tag: attribute.passthrough(t.users, tag) for tag in attribute.COPIED_TAGS},
    "age": lambda t: attribute.age_band(t.users),
    "constellation": lambda t: attribute.constellation(t.users),
    "nativePlace": lambda t: attribute.mobile_region(t.users, t.prefixes, "city", "nativePlace"),
    "nativeProvince": lambda t: attribute.mobile_region(
        t.users, t.prefixes, "province", "nativeProvince"
    ),
    "browseFrequency": lambda t: behaviour.browse_frequency(t.logs, known=t.known),
    "loginFrequency": lambda t: behaviour.login_frequency(t.logs, known=t.known),
    "PageBrowse": lambda t: behaviour.page_type_counts(t.logs),
    "browsePeriod": lambda t: behaviour.browse_period(t.logs, known=t.known),
    "browseTime": lambda t: behaviour.browse_time(t.logs, known=t.known),
    "deviceType": lambda t: behaviour.device_type(t.logs, known=t.known),
    "lastLogin": lambda t: behaviour.last_login(t.users, known=t.known),
    "urlBrowse": lambda t: behaviour.url_browse(t.logs, known=t.known),
    "productName": lambda t: first_by_name(
        behaviour.last_browsed_product(t.logs, t.goods, known=t.known), "productName"
    ),
    "purchaseName": lambda t: first_by_name(
        behaviour.purchased_products(t.orders, t.goods, t.known), "purchaseName"
    ),
    "purchaseFrequency": lambda t: consumption.order_frequency(t.orders, known=t.known),
    "consumptionPower": lambda t: consumption.order_amount_band(t.orders, "sum", known=t.known),
    "monovalent": lambda t: consumption.order_amount_band(t.orders, "avg", known=t.known),
    "maxAmount": lambda t: consumption.order_amount_band(t.orders, "max", known=t.known),
    "consumptionCycle": lambda t: consumption.purchase_cycle(t.orders, known=t.known),
    "returnRate": lambda t: consumption.status_rate(t.orders, d.RETURNED, known=t.known),
    "exchangeRate": lambda t: consumption.status_rate(t.orders, d.EXCHANGED, known=t.known),
    "consultationFrequency": lambda t: consumption.status_rate(
        t.orders, d.CONSULTED, known=t.known
    ),
    "paymentMode": lambda t: consumption.payment_mode(t.orders, t.known),
    **{tag: lambda t, tag=tag: t.preference(tag) for tag in PREFERENCES},
    "order_tags": lambda t: consumption.order_tags(t.orders, t.known),
    "log_tags": lambda t: behaviour.log_tags(t.logs, t.known),
    "profile": lambda t: build_profile(
        t.users, t.orders, t.goods, t.logs, t.prefixes, known=t.known
    ),
    "fullProfile": lambda t: build_profile(
        t.users, t.orders, t.goods, t.logs, t.prefixes, [t.preference(p) for p in PREFERENCES], known=t.known
    ),
}

#: Jobs whose rows are not those of users: written with --out, never staged or promoted.
REPORTS: dict[str, Job] = {
    "rfm": lambda t: rfm.rfm(t.orders),
    "rfmScore": lambda t: t.scores(),
    "rfmSegments": lambda t: rfm.rfm_segments(t.scores()),
    "alsRmse": lambda t: t.rmse(),
}

#: Jobs that write a model below --model.
MODEL_JOBS = {f"{tag}Model": item for tag, (item, _) in PREFERENCES.items()}


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = Tables(spark, args.tables, args.known_users, args.model, args.fold_in)
    if args.tag in MODEL_JOBS:
        if not args.model:
            raise ValueError("a model job needs the --model folder that takes the model")
        tables.train(MODEL_JOBS[args.tag], args.model)
        return
    if args.tag in REPORTS:
        REPORTS[args.tag](tables).write.mode("errorifexists").parquet(args.out)
        return
    profile = None
    if args.profile or args.profile_table:
        profile = read_profile(spark, args.profile, table=args.profile_table)
    if args.promote or args.promote_rows:
        if profile is None:
            raise ValueError("a promotion needs the --profile or --profile-table that takes the tags")
        if args.promote:
            profile = promote_tag(spark, args.tag, args.promote, profile, tables.known)
        else:
            names = args.tags.split(",") if args.tags else [args.tag]
            profile = promote_tags(profile, spark.read.parquet(args.promote_rows), names, tables.known)
        write_profile(profile, args.out, table=args.out_table)
        return
    tag = JOBS[args.tag](tables)
    names = [c for c in tag.columns if c != "id"]
    if args.stage:
        stage_tag(tag, args.tag, args.stage)
        # What was staged is read again, not computed again.
        tag = read_staged_tag(spark, args.tag, args.stage)
    if args.stage_rows:
        stage_tags(tag, args.stage_rows, F.current_timestamp())
    if args.out:
        if profile is not None:
            tag = upsert_tags(profile, tag, names)
        write_profile(tag, args.out, table=args.out_table)


def parse(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Compute one tag of every customer.")
    parser.add_argument("tag", choices=sorted([*JOBS, *REPORTS, *MODEL_JOBS, "many"]))
    parser.add_argument("--tables", help="folder of the shop tables")
    parser.add_argument("--stage", help="folder that takes the tag as a staged table")
    parser.add_argument("--promote", help="folder whose staged table of the tag is taken")
    parser.add_argument("--stage-rows", help="folder to which the tags are appended as rows")
    parser.add_argument("--promote-rows", help="folder whose staged rows are taken, the newest of each tag")
    parser.add_argument("--tags", help="comma-joined tags that --promote-rows takes; none: the job's own")
    parser.add_argument("--profile", help="profile that takes the tag; none: a new one")
    parser.add_argument("--profile-table", help="the same by table name: it keeps its buckets")
    parser.add_argument("--out", help="new folder that takes the profile")
    parser.add_argument("--out-table", help="name of the new profile as a bucketed table, at --out")
    parser.add_argument("--model", help="folder of the preference models")
    parser.add_argument("--fold-in", action="store_true", help="lists for all users of the present ratings")
    parser.add_argument(
        "--known-users", action="store_true", help="keep only users of the users table"
    )
    return parser.parse_args(argv)


def main(argv=None) -> None:
    args = parse(argv)
    run(configure(SparkSession.builder.appName(f"tagloom-{args.tag}").getOrCreate()), args)


if __name__ == "__main__":
    main()
