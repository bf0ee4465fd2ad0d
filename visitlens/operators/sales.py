"""Order economics per visit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.lookback import trailing_days
from visitlens.functions.orders import cancel_flag, order_cancelled, order_part
from visitlens.operators.joins import left_join_nullable_key

# profit-report columns carried into the mart, in the mart's order
PROFIT_COLUMNS = [
    "order_id", "order_status", "order_payment_status", "demand_revenue", "net_revenue",
    "return_revenue", "cancelled_revenue", "demand_quantity", "net_quantity",
    "return_quantity", "cancelled_quantity", "demand_profit", "net_profit",
    "shipping_charged", "tax_collected", "staff_owner_contact_id", "total_item_cost",
    "selling_price", "coupon_applied", "coupon_discount",
]
SALES_TAIL = ["cancel_orders", "is_order_cancelled"]


def visit_sales(visit_orders: DataFrame, profit_loss: DataFrame, as_of: dt.date,
                days: int, allow_missing: bool = False) -> DataFrame:
    """Orders in the window, each with its profit-report row (left join).

    The join key is the third dash part of the composite order id; ids without
    one have a NULL key and are spread over the tasks (see
    :func:`~visitlens.operators.joins.left_join_nullable_key`).
    """
    orders = (visit_orders.where(trailing_days("datetime_est", as_of, days))
              .select(F.col("datetime_est").alias("report_datetime"), "visit_id",
                      order_part("order_id", 3).alias("demand_order_id")))
    lacking = [c for c in PROFIT_COLUMNS if c not in profit_loss.columns]
    if lacking and not allow_missing:
        raise ValueError(f"profit report lacks columns: {lacking}")
    present = [c for c in PROFIT_COLUMNS if c in profit_loss.columns]
    pl = profit_loss.where(trailing_days("order_created_date", as_of, days))
    pl = pl.select(*[F.col(c).alias(f"p_{c}") for c in present],
                   cancel_flag("cancelled_order_id").alias("p_cancel_orders"),
                   order_cancelled("order_payment_status", "order_status")
                   .alias("p_is_order_cancelled"))
    joined = left_join_nullable_key(orders, pl, "demand_order_id", "p_order_id")
    return joined.select(
        "report_datetime", "visit_id", "demand_order_id",
        *[F.col(f"p_{c}").alias(c) for c in present + SALES_TAIL])
