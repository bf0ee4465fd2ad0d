"""Order fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens import config as C
from visitlens.functions.urls import _col


def order_part(order_id, n: int = 3) -> Column:
    """N-th dash-separated part of a composite order id, NULL when missing.

    ``try_element_at`` keeps this safe under ANSI mode, where ``element_at``
    raises on a short id.
    """
    return F.try_element_at(F.split(_col(order_id), "-"), F.lit(n))


def cancel_flag(cancelled_order_id) -> Column:
    """1 when a cancellation id is present (an empty string counts), else NULL."""
    return F.when(_col(cancelled_order_id).isNotNull(), F.lit(1))


def order_cancelled(payment_status, order_status) -> Column:
    """Tri-state cancellation from payment status x order status."""
    pay, st = _col(payment_status), _col(order_status)
    return (F.when(pay.isin(*C.PAID_STATUSES), F.lit(False))
            .when((pay == F.lit(C.AUTHORIZED_STATUS)) & st.isin(*C.CANCELLED_ORDER_STATUSES),
                  F.lit(True))
            .otherwise(F.lit(None).cast("boolean")))
