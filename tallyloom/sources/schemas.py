"""Schemas of the relations the reports read.

Account numbers and ISBNs are strings because leading zeros matter. Money is a
decimal while it is being added up and becomes a double in report columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Stored facts of the distributor channel, as the ingest writes them.
STORED_SALES = _struct(
    **{
        "ISBN": _S,
        "TITLE": _S,
        "NAMECUST": _S,
        "IPS Sale": _S,
        "HQ Account Number": _S,
        "SL Account Number": _S,
        "NETUNITS": _L,
        "NETAMT": MONEY,
        "SL Class of Trade": _S,
        "YEAR": _I,
        "MONTH": _I,
    }
)

# Facts of both channels as the reports take them.
_SALES = {
    "ISBN": _S,
    "YEAR": _I,
    "MONTH": _I,
    "TITLE": _S,
    "NAMECUST": _S,
    "NETUNITS": _L,
    "NETAMT": MONEY,
    "SALES_CATEGORY": _S,
}
SALES = _struct(**_SALES)
SALES_A = _struct(HQ_NUMBER=_S, SL_NUMBER=_S, **_SALES)
SALES_S = _struct(ACCOUNT_ID=_S, **_SALES)

STORED_SALES_S = _struct(
    NEWBILLTO=_S, ISBN=_S, YEAR=_I, MONTH=_I, TITLE=_S, NAMECUST=_S, NETUNITS=_L, NETAMT=MONEY
)

BOOK_LEVEL_SALES = _struct(ISBN=_S, TITLE=_S, YEAR=_I, MONTH=_I, NETAMT=MONEY, NETQTY=_L)

PRODUCTS = _struct(
    ISBN=_S, TITLE=_S, PROD_TYPE=_S, PUB_DATE=_S, PUB_STATUS=_I, PROD_CLASS=_S, SEAS=_S,
    SUB_PUB=_S, RETAIL_PRICE=_D, WEBCAT1=_S, WEBCAT2=_S, WEBCAT2_DESCR=_S, WEBCAT3=_S,
    BISAC_CODE=_S, QTY_ON_HAND=_I, QTY_ON_ORDER=_D, WATCH=_S, CTNQTY=_I, MINRPTQTY=_I,
    GENERAL_COMMENTS=_S, INTERNAL_COMMENTS=_S, IWD=_S, EXPDATE=_S, SELLOFF=_S,
)

ALL_ACCOUNTS_12M = _struct(ITEMNO=_S, NETQTY=_L, NETSALES=_D)
TITLE_LOOKUP = _struct(Z_ID=_S, LONG_TITLE=_S)
CUSTOMER_LOCATION = _struct(NAMECUST=_S, NAMECITY=_S, CODESTTE=_S)

# Reference maps. All columns are strings; the first column ends the block.
CATEGORY_MAP_A = _struct(
    **{"SL Account Number": _S, "HQ Account Number": _S, "MASTER SALES CATEGORY": _S}
)
CATEGORY_MAP_S = _struct(**{"BILLTO": _S, "MASTER SALES CATEGORY": _S})
NAME_MAP = _struct(SOURCE_NAME=_S, TARGET_NAME=_S)


def targets_schema(target_year: int) -> T.StructType:
    """The target file: the year of the targets and the one before it."""
    years = {str(year): _D for year in (target_year - 1, target_year)}
    return _struct(**{"BILLTO": _S, "COMPANY": _S, **years, "MUL_RATIO": _D, "Dupe?": _S})


# Columns of the target file that nothing is computed from.
def targets_optional(target_year: int) -> tuple[str, ...]:
    return ("COMPANY", str(target_year - 1), "Dupe?")


# Raw files of the distributor.
RAW_SALES = _struct(
    **{
        "EAN": _S,
        "Title": _S,
        "Headquarter": _S,
        "Date": _S,
        "Net Sold Units": _D,
        "Net Invc": _D,
        "SL Class of Trade": _S,
        "IPS Sale": _S,
        "HQ Account Number": _S,
        "SL Account Number": _S,
        "SL ST": _S,
        "Free Units": _D,
        "Return Credit": _D,
        "Gross Invc": _D,
        "Return Units": _D,
        "Sold Units": _D,
        "DC": _S,
        "SL City": _S,
        "Shipping Location": _S,
        "Order Date": _S,
    }
)
RAW_BACKORDERS = _struct(**{"EAN": _S, "Title": _S, "Open Backorder": _I})
BACKORDERS_S = _struct(ITEMNO=_S, TITLE=_S, QTYREC=_I)
BACKORDER_REPORT = _struct(TITLE=_S, ISBN=_S, QTY=_L)
