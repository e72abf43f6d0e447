"""Windowed summary tables. Every function takes batch or streaming frames.

Rows that enter a summary are checked first, then reduced to what the summary counts, then summed per tumbling
window. Window sums combine before the shuffle, so the un-keyed ones are no bottleneck either.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times, values
from ..operators import enrich, facts, keywords, logs, skew, state, windows
from ..schemas import MONEY

SIZE = "5 seconds"
SHOP_SIZE = "10 seconds"
DELAY = "5 seconds"
SHOPS = 12


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)


def keyword_count(
    pages: DataFrame, size: str = SIZE, delay: str = DELAY, as_of: str | None = None, zone: str | None = None,
    tokenizer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """How often each word was searched per window."""
    found = keywords.searches(pages).withColumn("et", times.from_epoch(F.col("ts"), "ms"))
    words = keywords.explode(found.select("et", "item"), "item", tokenizer)
    counted = windows.tumble(
        words, "et", size, ["keyword"], [F.count(F.lit(1)).alias("keyword_count")], delay, as_of, zone
    )
    day = times.as_of_day(as_of, times.PARTITION)
    return counted.withColumn("cur_date", day).withColumnsRenamed({"stt": "window_start", "edt": "window_end"})


def traffic(
    pages: DataFrame, size: str = SIZE, delay: str = DELAY, as_of: str | None = None, zone: str | None = None
) -> DataFrame:
    """Visitors, sessions, views and time on page by version, channel, area and new-visitor flag.

    A visitor counts on the first view of the day, a session on its first view; both are found apart from the
    views, so a hot visitor only ever costs a per-task group limit. `pages` is read three times: in batch give a table
    rather than messages still to be parsed.
    """
    by = ["vc", "ch", "ar", "is_new"]
    views = windows.watermarked(logs.page_views(pages).select("mid", "sid", *by, "during_time", "et"), "et", delay)
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def counts(rows: DataFrame, uv: Column, sv: Column, pv: Column, dur: Column) -> DataFrame:
        return rows.select("et", *by, uv.alias("uv_ct"), sv.alias("sv_ct"), pv.alias("pv_ct"), dur.alias("dur_sum"))

    visitors = state.first_of_day(views.select("mid", "et", *by), ["mid"], "et", tuple(by), zone)
    sessions = state.first_ever(views.filter(values.filled(F.col("sid"))).select("sid", "et", *by), "sid", "et",
                                tuple(by))
    rows = (
        counts(views, none, none, one, F.coalesce("during_time", none))
        .unionByName(counts(visitors, one, none, none, none))
        .unionByName(counts(sessions, none, one, none, none))
    )
    measures = [_sum(name) for name in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")]
    return windows.tumble(rows, "et", size, by, measures, None, as_of, zone)


def home_detail(
    pages: DataFrame, size: str = SIZE, delay: str = DELAY, as_of: str | None = None, zone: str | None = None
) -> DataFrame:
    """Daily visitors of the home page and of product pages, counted independently."""
    views = logs.page_views(pages, ("home", "good_detail")).select("mid", "page_id", "et")
    firsts = state.first_of_day(windows.watermarked(views, "et", delay), ["mid", "page_id"], "et", (), zone)
    counted = [
        F.count(F.when(F.col("page_id") == page, 1)).alias(name)
        for page, name in (("home", "home_uv_ct"), ("good_detail", "good_detail_uv_ct"))
    ]
    return windows.tumble(firsts, "et", size, [], counted, None, as_of, zone)


def logins(
    pages: DataFrame, size: str = SIZE, delay: str = DELAY, as_of: str | None = None, zone: str | None = None,
    days: int = 7,
) -> DataFrame:
    """Users logging in for the first time of the day, and those back after more than `days` days."""
    entered = windows.watermarked(logs.logins(pages).select("uid", "et"), "et", delay)
    firsts = state.returning(entered, ["uid"], "et", (), days, zone)
    counted = [F.count(F.when(F.col("is_back"), 1)).alias("back_ct"), F.count(F.lit(1)).alias("uu_ct")]
    return windows.tumble(firsts, "et", size, [], counted, None, as_of, zone)


def registrations(
    users: DataFrame, size: str = SIZE, delay: str = DELAY, as_of: str | None = None, zone: str | None = None
) -> DataFrame:
    """New users per window by their `create_time`."""
    registered = facts.with_event_time(users, "create_time", zone).select("et")
    return windows.tumble(registered, "et", size, [], [F.count(F.lit(1)).alias("register_ct")], delay, as_of, zone)


def cart_users(
    carts: DataFrame, size: str = SIZE, delay: str = DELAY, as_of: str | None = None, zone: str | None = None
) -> DataFrame:
    """Users adding to the cart for the first time of the day."""
    rows = windows.watermarked(facts.require(carts, "user_id").select("user_id", "et"), "et", delay)
    firsts = state.first_of_day(rows, ["user_id"], "et", (), zone)
    return windows.tumble(firsts, "et", size, [], [F.count(F.lit(1)).alias("cart_add_uu_ct")], None, as_of, zone)


def _unique_and_new(rows: DataFrame, size: str, delay: str, as_of: str | None, zone: str | None, unique: str,
                    new: str) -> DataFrame:
    """Users by first record of the day, and users by first record ever."""
    users = windows.watermarked(facts.require(rows, "user_id").select("user_id", "et"), "et", delay)
    flags = state.daily_firsts(users, ["user_id"], "et", (), zone)
    measures = [F.count(F.lit(1)).alias(unique), F.count(F.when(F.col("prev_day").isNull(), 1)).alias(new)]
    return windows.tumble(flags, "et", size, [], measures, None, as_of, zone)


def payment_users(
    payments: DataFrame, size: str = SIZE, delay: str = DELAY, as_of: str | None = None, zone: str | None = None
) -> DataFrame:
    return _unique_and_new(payments, size, delay, as_of, zone,
                           "payment_suc_unique_user_count", "payment_suc_new_user_count")


def order_users(
    orders: DataFrame, size: str = SIZE, delay: str = DELAY, as_of: str | None = None, zone: str | None = None
) -> DataFrame:
    return _unique_and_new(orders, size, delay, as_of, zone, "order_unique_user_count", "order_new_user_count")


def _changes(details: DataFrame, rows: DataFrame, order: list[str], measures: list[str], heavy: skew.Heavy | None,
             ttl: str | None) -> DataFrame:
    """Measures of line versions as changes. Lines with very many versions are looked for in `details` itself.

    Copies of one version change nothing; those of heavy lines are dropped before the look-back.
    """
    heavy = skew.heavy_keys(details, ["id"]) if heavy is None else heavy
    if heavy:
        is_heavy = F.xxhash64("id").isin(list(heavy.parts))
        rows = rows.filter(~is_heavy).unionByName(rows.filter(is_heavy).dropDuplicates())
    return state.delta(rows, ["id"], order, measures, heavy, ttl)


SKU_AMOUNTS = ["original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount"]


def sku_orders(
    details: DataFrame, dims: dict[str, DataFrame], order: tuple[str, ...], size: str = SIZE, delay: str = DELAY,
    as_of: str | None = None, zone: str | None = None, heavy: skew.Heavy | None = None, ttl: str | None = None,
) -> DataFrame:
    """`sku_sums` with the names of each sku.

    A stream sees the dimensions as they are when it starts; for dimensions that change meanwhile, run `sku_sums` through
    `streaming.queries.with_live_tables` and `with_skus`.
    """
    return with_skus(sku_sums(details, order, size, delay, as_of, zone, heavy, ttl), dims)


def with_skus(summed: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return enrich.sku_hierarchy(summed, dims).select(
        "stt", "edt", "cur_date", "trademark_id", "trademark_name", "category1_id", "category1_name", "category2_id",
        "category2_name", "category3_id", "category3_name", "sku_id", "sku_name", "spu_id", "spu_name", *SKU_AMOUNTS,
    )


def sku_sums(
    details: DataFrame, order: tuple[str, ...], size: str = SIZE, delay: str = DELAY, as_of: str | None = None,
    zone: str | None = None, heavy: skew.Heavy | None = None, ttl: str | None = None,
) -> DataFrame:
    """Order amounts per sku from the order-detail version log, without names.

    `order` names the columns that tell the versions of a line apart in order of arrival, from "et" on: versions of one
    second need an arrival column (offset, batch) there, or the one of the larger amount counts as the later one.
    Each version of a line counts with its change.
    """
    amounts = {
        "original_amount": values.money(F.col("order_price")) * values.money(F.col("sku_num")),
        "activity_reduce_amount": values.money(F.col("split_activity_amount")),
        "coupon_reduce_amount": values.money(F.col("split_coupon_amount")),
        "order_amount": values.money(F.col("split_total_amount")),
    }
    extra = [name for name in order if name != "et"]
    rows = facts.require(details, "sku_id").select(
        "id", "sku_id", "sku_name", "et", *extra, *[amount.cast(MONEY).alias(n) for n, amount in amounts.items()]
    )
    rows = windows.watermarked(rows, "et", delay)
    changed = _changes(details, rows, [*order, "sku_id", *amounts], list(amounts), heavy, ttl)
    return windows.tumble(
        changed, "et", size, ["sku_id"],
        # The line name is kept from the first record of the window.
        [F.min_by("sku_name", F.struct("et", "id")).alias("sku_name"),
         *[F.sum(name).cast(MONEY).alias(name) for name in amounts]],
        None, as_of, zone,
    )


def province_orders(
    details: DataFrame, provinces: DataFrame, order: tuple[str, ...], size: str = SIZE, delay: str = DELAY,
    as_of: str | None = None, zone: str | None = None, heavy: skew.Heavy | None = None, ttl: str | None = None,
) -> DataFrame:
    """`province_sums` with the names of the provinces; in a stream those known when it starts, as in `sku_orders`."""
    return with_provinces(province_sums(details, order, size, delay, as_of, zone, heavy, ttl), provinces)


def with_provinces(summed: DataFrame, provinces: DataFrame) -> DataFrame:
    named = enrich.dim(summed, provinces, "province_id", {"province_name": "name"})
    return named.select("stt", "edt", "cur_date", "province_id", "province_name", "order_count",
                        F.col("order_amount").cast(MONEY).alias("order_amount"))


def province_sums(
    details: DataFrame, order: tuple[str, ...], size: str = SIZE, delay: str = DELAY, as_of: str | None = None,
    zone: str | None = None, heavy: skew.Heavy | None = None, ttl: str | None = None,
) -> DataFrame:
    """Orders and order amount per province from the order-detail version log; `order` as in `sku_sums`."""
    extra = [name for name in order if name != "et"]
    rows = facts.require(details, "province_id").select(
        "id", "province_id", "order_id", "et", *extra,
        values.money(F.col("split_total_amount")).alias("order_amount"),
    )
    rows = windows.watermarked(rows, "et", delay)
    changed = _changes(details, rows, [*order, "province_id", "order_amount"], ["order_amount"], heavy, ttl)
    return windows.tumble_distinct(
        changed, "et", size, ["province_id"], "order_id", "order_count", ("order_amount",), None, as_of, zone
    )


def refunds(
    refund_orders: DataFrame, dims: dict[str, DataFrame], size: str = SIZE, delay: str = DELAY,
    as_of: str | None = None, zone: str | None = None,
) -> DataFrame:
    """Refunded orders per trademark, category 3 and user.

    The grouping ids come from the sku dimension before aggregation; the names are added after it. A stream keeps less
    state with `refund_items`, and `refund_counts` on each of its micro-batches.
    """
    return refund_counts(refund_items(refund_orders, dims, size, delay), dims, as_of, zone)


_REFUND_KEYS = ["trademark_id", "category3_id", "user_id"]


def refund_items(refund_orders: DataFrame, dims: dict[str, DataFrame], size: str = SIZE, delay: str = DELAY) -> DataFrame:
    """One row per window, trademark, category 3, user and refunded order."""
    rows = facts.require(refund_orders).select("user_id", "sku_id", "order_id", "et")
    keyed = enrich.dim(rows, dims["dim_sku_info"], "sku_id", {"trademark_id": "tm_id", "category3_id": "category3_id"})
    return windows.distinct_items(keyed.drop("sku_id"), "et", size, _REFUND_KEYS, "order_id", (), delay)


def refund_counts(
    items: DataFrame, dims: dict[str, DataFrame], as_of: str | None = None, zone: str | None = None
) -> DataFrame:
    """`refunds` of its items."""
    counted = windows.count_items(items, _REFUND_KEYS, "order_id", "refund_count", (), as_of, zone)
    named = enrich.dim(counted, dims["dim_base_trademark"], "trademark_id", {"trademark_name": "tm_name"})
    parents = {n: n for n in ("category3_name", "category2_id", "category2_name", "category1_id", "category1_name")}
    named = enrich.dim(named, enrich.categories(dims), "category3_id", parents)
    return named.select(
        "stt", "edt", "cur_date", "trademark_id", "trademark_name", "category1_id", "category1_name", "category2_id",
        "category2_name", "category3_id", "category3_name", "user_id", "refund_count",
    )


def shop_amounts(
    details: DataFrame, shops: DataFrame, size: str = SHOP_SIZE, delay: str = DELAY, as_of: str | None = None,
    zone: str | None = None, shop: Column | None = None,
) -> DataFrame:
    """Order amount per shop. Lines carry no shop: a stable hash of the line id stands in unless `shop` is given."""
    shop = values.bucket(F.col("id"), SHOPS).cast("string") if shop is None else shop
    rows = facts.with_event_time(details, "create_time", zone).select(
        "et", shop.alias("shop_id"), values.money(F.col("split_total_amount")).alias("amount")
    )
    summed = windows.tumble(rows, "et", size, ["shop_id"], [F.sum("amount").cast(MONEY).alias("amount")], delay,
                            as_of, zone)
    named = enrich.dim(summed, shops, "shop_id", {"shop_name": "name"})
    return named.select("stt", "edt", "cur_date", "amount", "shop_id", "shop_name")
