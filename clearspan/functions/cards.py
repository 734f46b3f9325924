"""Card and transaction attributes as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------

#: Last characters of an authorization code that make it invalid.
INVALID_AUTH_TAIL = "x"
INVALID_AUTH_LAST_FIVE = ["     ", "00000", "0000 ", "0000n", "0000p", "0000y"]

#: Business transaction types.
UNKNOWN = 255
PURCHASE, QUASI_CASH, CREDIT, ORIGINAL_CREDIT, MANUAL_CASH, ATM_CASH = 1, 3, 19, 25, 21, 22
QUASI_CASH_MCC = [4829, 6051, 7995]
QUASI_CASH_CONDITIONS = ["7", "8"]
CASH_MCC_TYPES = {6010: MANUAL_CASH, 6011: ATM_CASH}

#: Business transaction cycle by first digit of the transaction code and usage code.
CYCLES = {
    "0": {1: 11, 2: 23, 9: 6},
    "1": {1: 1, 9: 4},
    "2": {1: 11, 2: 25, 9: 6},
    "3": {1: 1, 9: 4},
}

#: Online messages: processing code prefix, POS condition, merchant type, business type.
#: "any" POS condition excludes 13 and 51; "any" merchant excludes 4815, 6010, 6011.
ONLINE_TYPES = [
    ("00", "any", "any", 1),
    ("01", "any", 6010, 21),
    ("01", "any", 6011, 22),
    ("10", "any", "any", 30),
    ("11", "any", "any", 3),
    ("19", "any", "any", 115),
    ("20", "any", "any", 19),
    ("22", "13", "any", 20),
    ("26", "any", "any", 25),
    ("29", "any", "any", 200),
    ("30", "any", 6011, 247),
    ("40", "any", 6011, 250),
    ("50", "any", "any", 27),
]
ONLINE_POS_EXCLUDED = ["13", "51"]
ONLINE_MCC_EXCLUDED = [4815, 6010, 6011]
ONLINE_REQUESTS = {"0200": 0, "0220": 0, "0400": 1, "0420": 1}
POS_DECLINE, ATM_DECLINE = 236, 249
APPROVED = "00"

#: Clearing transaction code of an online record by group and reversal flag.
ONLINE_CODES = {
    ("PUR", 0): "05",
    ("CRD", 0): "06",
    ("CSH", 0): "07",
    ("PUR", 1): "25",
    ("CRD", 1): "26",
    ("CSH", 1): "27",
}

#: Transaction group by clearing transaction code, and by bitmap processing code.
GROUP_BY_CODE = {"05": "PUR", "25": "PUR", "06": "CRD", "26": "CRD", "07": "CSH", "27": "CSH"}
GROUP_BY_PROCESSING = {
    "00": "PUR",
    "09": "PUR",
    "18": "PUR",
    "20": "CRD",
    "01": "CSH",
    "12": "CSH",
    "17": "CSH",
    "28": "CSH",
    "50": "CSH",
}
FUNDING_CLASSES = {"C": "C", "H": "C", "R": "C", "D": "D", "P": "D"}
BUSINESS_MODES = {"IN": "issuing", "OUT": "acquiring"}
ONLINE_BUSINESS_MODES = {"I": "issuing", "A": "acquiring"}
INTERREGIONAL_CODE = "9"

# ----------------------------------------------------------------------------


def lookup(c: Column, table: dict, default: Column | None = None) -> Column:
    """Value of a small fixed table, ``default`` (null) for other keys."""
    out = None
    for key, value in table.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out if default is None else out.otherwise(default)


def authorization_validity(c: Column) -> Column:
    """``VALID`` or ``INVALID`` authorization code."""
    bad = (F.right(c, F.lit(1)) == INVALID_AUTH_TAIL) | F.right(c, F.lit(5)).isin(INVALID_AUTH_LAST_FIVE)
    return F.when(bad, "INVALID").otherwise("VALID")


def business_mode(file_type: Column) -> Column:
    """Issuing for incoming files, acquiring for outgoing ones, else as given."""
    return lookup(file_type, BUSINESS_MODES, file_type)


def in_bin_list(number: Column, csv_list: Column, digits: int) -> Column:
    """The first ``digits`` digits are one entry of a comma-separated list."""
    return F.coalesce(
        F.array_contains(F.split(csv_list, ","), F.left(number.cast("string"), F.lit(digits))), F.lit(False)
    )


def jurisdiction(
    issuer_country: Column,
    merchant_country: Column,
    issuer_region: Column,
    merchant_region: Column,
    own_counterparty: Column,
    side_known: Column | None = None,
) -> Column:
    """on-us, off-us, intraregional or interregional.

    ``own_counterparty`` says whether the other side belongs to the customer (own
    BIN list, or collection only). Without a known side a domestic transaction
    stays null.
    """
    domestic = F.when(own_counterparty, "on-us").otherwise("off-us")
    if side_known is not None:
        domestic = F.when(side_known, domestic)
    return (
        F.when(issuer_country == merchant_country, domestic)
        .when((issuer_country != merchant_country) & (issuer_region == merchant_region), "intraregional")
        .when((issuer_country != merchant_country) & (issuer_region != merchant_region), "interregional")
    )


def assigned_jurisdiction(scope: Column, region: Column, country: Column) -> Column:
    """Key under which the fee rules of a jurisdiction are filed."""
    return (
        F.when(scope == "intraregional", region.cast("string"))
        .when(scope == "interregional", INTERREGIONAL_CODE)
        .otherwise(country.cast("string"))
    )


def transaction_type(
    code: Column, file_type: Column, mcc: Column, usage: Column, qualifier: Column, condition: Column
) -> Column:
    """Business transaction type of a clearing record.

    The last digit of the code is the kind (5 purchase, 6 credit, 7 cash). For
    purchases the incoming side decides on the special condition, the outgoing
    side on the merchant category.
    """
    known = code.rlike("^[0-3][567]$")
    kind = F.right(code, F.lit(1))

    def quasi(value: Column, values: Sequence) -> Column:
        return F.when(value.isin(*values), QUASI_CASH).when(value.isNotNull(), PURCHASE).otherwise(UNKNOWN)

    purchase = F.when(file_type == "IN", quasi(condition, QUASI_CASH_CONDITIONS)).otherwise(
        quasi(mcc, QUASI_CASH_MCC)
    )
    credit = (
        F.when((usage == 1) & (qualifier == 2), ORIGINAL_CREDIT).when(usage == 1, CREDIT).otherwise(UNKNOWN)
    )
    typed = (
        F.when(known & (kind == "5"), purchase)
        .when(known & (kind == "6"), credit)
        .when(known & (kind == "7"), lookup(mcc, CASH_MCC_TYPES, F.lit(UNKNOWN)))
        .otherwise(UNKNOWN)
    )
    return F.when(file_type.isin(*BUSINESS_MODES), typed)


def transaction_cycle(code: Column, usage: Column) -> Column:
    """Business transaction cycle from the stage digit and the usage code."""
    out = None
    for stage, by_usage in CYCLES.items():
        hit = code.rlike(f"^{stage}[567]$")
        value = lookup(usage, by_usage, F.lit(UNKNOWN))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(UNKNOWN)


def reversal_flag(code: Column, usage: Column) -> Column:
    """1 for reversal codes (twenties) of a first presentment, else 0."""
    number = code.try_cast("int")
    return F.when(number.between(20, 29) & usage.isin(1, 9), 1).otherwise(0)


def online_transaction_type(
    request: Column, response: Column, processing: Column, pos_condition: Column, mcc: Column
) -> Column:
    """Business transaction type of an online (single message) record."""
    prefix = F.left(processing, F.lit(2))
    approved = None
    for code, pos, merchant, result in ONLINE_TYPES:
        pos_ok = ~pos_condition.isin(*ONLINE_POS_EXCLUDED) if pos == "any" else pos_condition == pos
        mcc_ok = ~mcc.isin(*ONLINE_MCC_EXCLUDED) if merchant == "any" else mcc == merchant
        hit = (prefix == code) & pos_ok & mcc_ok
        approved = F.when(hit, result) if approved is None else approved.when(hit, result)
    declined = F.when(mcc != 6011, POS_DECLINE).when(mcc == 6011, ATM_DECLINE)
    known = request.isin(*ONLINE_REQUESTS)
    return F.when(known & (response == APPROVED), approved).when(known & (response != APPROVED), declined)


def online_reversal_flag(request: Column, response: Column) -> Column:
    """0 for approved requests, 1 for approved reversals, null otherwise."""
    return F.when(response == APPROVED, lookup(request, ONLINE_REQUESTS))


def online_clearing_code(group: Column, reversal: Column) -> Column:
    """Clearing transaction code of an online record."""
    out = None
    for (name, flag), code in ONLINE_CODES.items():
        hit = (group == name) & (reversal == flag)
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out


def remote_flag(indicator: Column) -> Column:
    """0 when the mail/e-commerce indicator is a number below ten, 1 otherwise (blank counts as ten)."""
    value = F.when(F.trim(indicator) == "", F.lit("10")).otherwise(indicator).try_cast("int")
    return F.when(value < 10, 0).otherwise(1)


def presence_code(indicator: Column) -> Column:
    """CPR for a blank indicator, CNP for 1 to 9, UNK otherwise."""
    value = F.replace(indicator, F.lit(" "), F.lit("0")).try_cast("int")
    return F.when(indicator == " ", "CPR").when(value.between(1, 9), "CNP").otherwise("UNK")


def pos_presence_code(pos_entry: Column) -> Column:
    """CPR/CNP/UNK from the sixth POS character."""
    digit = F.substring(pos_entry, 6, 1)
    return F.when(digit == "1", "CPR").when(digit == "0", "CNP").otherwise("UNK")


def funding_class(c: Column) -> Column:
    """Credit-like and debit-like funding sources folded to ``C`` and ``D``."""
    return lookup(c, FUNDING_CLASSES)


def bitmap_reversal_flag(message_type: Column, indicator: Column) -> Column:
    """Scheme-fee reversal flag of a bitmap message."""
    marked = F.left(indicator, F.lit(1)) == "R"
    hit = ((message_type == "1240") & marked) | ((message_type == "1442") & ~marked)
    return F.when(hit, 1).otherwise(0)


def bitmap_is_reversal(message_type: Column, indicator: Column) -> Column:
    """Reversed presentment, or a chargeback that is not itself reversed."""
    given = F.coalesce(indicator, F.lit("")) != ""
    return F.coalesce(
        ((message_type == "1240") & given) | ((message_type == "1442") & ~given), F.lit(False)
    )
