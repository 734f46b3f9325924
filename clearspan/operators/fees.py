"""Fee amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamped_fee(
    amount: Column,
    rate: Column,
    variable: Column,
    fixed: Column,
    minimum: Column,
    maximum: Column,
    variable_is_number: Column | None = None,
) -> Column:
    """Variable part of the converted amount plus the fixed part, held between min and cap.

    Without a variable part the fee is the fixed part. A variable part that is
    not a number gives no fee.
    """
    raw = variable * (amount * rate) + F.coalesce(fixed, F.lit(0.0))
    bounded = F.when(raw <= minimum, minimum).when(raw >= maximum, maximum).otherwise(raw)
    fee = F.when(variable.isNull(), fixed)
    if variable_is_number is not None:
        return F.when(~variable_is_number, F.lit(None).cast("double")).otherwise(fee.otherwise(bounded))
    return fee.otherwise(bounded)


def fee_rate(fee_currency: Column, currency: Column, rate: Column) -> Column:
    """Rate into the fee currency: 1 when the rule names none or the same one."""
    return F.when(fee_currency.isNull() | (fee_currency == currency), F.lit(1.0)).otherwise(rate)


def settlement_report_amount(amount: Column, use_local: Column, local_rate: Column, settlement_rate: Column) -> Column:
    """Amount in the local currency for domestic settlement, else in the settlement currency."""
    return amount * F.when(use_local, local_rate).otherwise(settlement_rate)
