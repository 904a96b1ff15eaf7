"""Rules and scorecard checks of the retail view, table by table."""

from dataclasses import replace

from pyspark.sql import functions as F

from truegrain.functions import predicates as P
from truegrain.functions.scalars import composite_key, day_text, gtin13_valid, pad_code
from truegrain.operators import joins as J
from truegrain.operators.aggregates import grid_completeness, identical_share, share
from truegrain.operators.documents import UNITS_BY_CATEGORY
from truegrain.plans.checks import Check, distinct_check
from truegrain.plans.rules import agrees, found_by, holds, refers, unique

# Legal units, phone shape, and values that stand for a missing one.
UNITS = ("count", "kg", "liter")
PHONE = "\\d{3}-555-\\d{4}"
NO_PHONE = ("999-9999999", "000-0000000")
NO_SHELF_LIFE = (0, 999, 9999)

CELL = ["date", "store_id", "product_id"]


def cell_id():
    return composite_key(day_text("date"), "store_id", "product_id")


def cheaper_packs(t):
    number = lambda c: F.col(c).try_cast("double").alias(c)
    packs = t["products"].select("id", "family", number("size"), number("unit_price"))
    return J.cheaper_although_bigger(packs, "family", "size", "unit_price")


def sold_beyond_stock(t):
    arrivals = t["deliveries"].filter(P.in_set("unit", UNITS)).select(
        F.col("delivery_date").alias("date"), "store_id", "product_id", F.col("quantity").alias("arrived"))
    return J.oversold(t["sales"], t["inventory"], arrivals, CELL[1:], "date", "quantity", "on_hand_system", "arrived")


def code_used_once(codes):
    """Of the products whose codes, as the table `codes` holds them, are equal, the first one is good."""
    return replace(unique("code used once", "reject", codes, ["gtin"], ["id"]), table="products")


def rulebook(period, codes="products"):
    return [
        # products
        holds("code has its check digit", "reject", "products", lambda: gtin13_valid(pad_code("gtin", 13))),
        holds("sold by a unit of its category", "reject", "products",
              lambda: P.conditional_set("category", "unit", UNITS_BY_CATEGORY, ("count",))),
        holds("value is not a stand-in", "repair", "products",
              lambda: ~P.placeholder(F.col("shelf_life_days").try_cast("bigint"), NO_SHELF_LIFE)),
        code_used_once(codes),
        refers("known supplier", "reject", "products", "supplier_id", "suppliers"),
        found_by("price grows with the pack", "flag", "products", cheaper_packs),
        # suppliers and stores
        holds("value is not a stand-in", "repair", "suppliers", lambda: ~P.placeholder("contact_phone", NO_PHONE)),
        agrees("city of the postal code", "flag", "stores", "zip_codes",
               lambda: pad_code("zip", 5) == F.col("other_zip"), "city = other_city", unknown_ok=False),
        # deliveries
        holds("day within the books", "reject", "deliveries", lambda: P.date_in_period("delivery_date", *period), "delivery_id"),
        unique("entered once", "flag", "deliveries",
               ["store_id", "product_id", "delivery_date", "quantity"], ["entered_at", "delivery_id"], "delivery_id"),
        agrees("name of the listed product", "flag", "deliveries", "catalog",
               "product_id = other_id", "product_name = other_name", "delivery_id"),
        # sales
        agrees("list price unless promoted", "flag", "sales", "catalog", "product_id = other_id",
               "promo OR abs(unit_price - other_unit_price) <= 0.005", cell_id),
        found_by("sold from stock", "flag", "sales", sold_beyond_stock, cell_id),
    ]


#: How each table comes in.
ORIGINS = {
    "products": "typed", "suppliers": "typed", "stores": "typed", "deliveries": "typed", "stock_counts": "counted",
    "sales": "recorded", "pos_events": "streamed", "weather": "bought", "oos_reports": "sent by customers",
}


def _joined(table, other, on, good):
    """Share of the rows with a match for which `good` holds; columns of the match are named other_*."""

    def frame(t):
        match = t[other].select(*[F.col(c).alias(f"other_{c}") for c in t[other].columns])
        return t[table].join(match, on()).agg(share(good()).alias("score"))

    return frame


def _report_cells(t):
    return t["oos_reports"].select(F.col("reported_at").cast("date").alias("date"), "store_id", "product_id")


def _true_reports(t):
    return _report_cells(t).join(t["truth"], CELL).agg(share(F.col("lost") > 0).alias("score"))


def _reported_losses(t):
    return J.coverage(t["truth"].filter(F.col("lost") > 0).select(*CELL), _report_cells(t), CELL)


def _counts_near_audit(t):
    return J.audit_accuracy(t["stock_counts"], t["stock_audit"].select(*CELL, "audited_qty"), CELL, "counted_qty", "audited_qty")


def _list_price(t):
    sold = {"catalog": t["catalog"], "sales": t["sales"].filter(~F.col("promo"))}
    return _joined("sales", "catalog", lambda: F.col("product_id") == F.col("other_id"),
                   lambda: F.abs(F.col("unit_price") - F.col("other_unit_price")) < 0.005)(sold)


def checkbook():
    legal = lambda: share(P.in_set("unit", UNITS))
    return [
        # products
        distinct_check("products", "one row an id", "id"),
        Check("products", "validity", "legal unit", legal),
        Check("products", "validity", "price above zero", lambda: share(P.parses_positive("unit_price"))),
        Check("products", "completeness", "named and sorted", lambda: share(P.present("name", "category"))),
        # suppliers and stores
        Check("suppliers", "validity", "phone number", lambda: share(P.full_match("contact_phone", PHONE))),
        Check("stores", "consistency", "city of the postal code", frame=_joined(
            "stores", "zip_codes", lambda: pad_code("zip", 5) == F.col("other_zip"), lambda: F.col("city") == F.col("other_city"))),
        # deliveries and counts
        Check("deliveries", "validity", "legal unit", legal),
        Check("deliveries", "timeliness", "typed within a day", lambda: share(P.within_interval("received_at", "entered_at", "24 HOURS"))),
        Check("deliveries", "uniqueness", "entered once", frame=lambda t: identical_share(
            t["deliveries"], ["store_id", "product_id", "supplier_id", "delivery_date", "quantity"])),
        Check("deliveries", "consistency", "name of the listed product", frame=_joined(
            "deliveries", "catalog", lambda: F.col("product_id") == F.col("other_id"), lambda: F.col("product_name") == F.col("other_name"))),
        Check("stock_counts", "accuracy", "near the audit", frame=_counts_near_audit),
        # sales and terminals
        distinct_check("sales", "one row a cell", *CELL),
        Check("sales", "completeness", "all stores on all days", frame=lambda t: grid_completeness(t["sales"], "date", "store_id")),
        Check("sales", "consistency", "list price unless promoted", frame=_list_price),
        distinct_check("pos_events", "one row an event", "event_id"),
        Check("pos_events", "validity", "happened before it came", lambda: share(P.before("event_time", "ingested_at", or_equal=True))),
        Check("pos_events", "timeliness", "came within a minute", lambda: share(
            P.within_interval("event_time", "ingested_at", "60 SECONDS", strict=True))),
        # from outside
        Check("weather", "validity", "possible temperature", lambda: share(P.in_range("temp_c", -40, 45))),
        Check("weather", "completeness", "all stations on all days", frame=lambda t: grid_completeness(t["weather"], "date", "station", "temp_c")),
        Check("oos_reports", "accuracy", "shelf was empty", frame=_true_reports),
        Check("oos_reports", "completeness", "empty shelf was reported", frame=_reported_losses),
    ]
