"""Fixed values that must equal the source models for identical results.

Everything in the FIXED VALUES block is data, stated as it appears in the
source models: tag lists per metric, FX tags, float tags, annual forms, the
first fiscal year kept and the known bad fact dates.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------- FIXED VALUES
ANNUAL_FORMS = ("10-K", "20-F", "40-F")
ANNUAL_FROM = _dt.date(2014, 1, 1)
FX_FROM = _dt.date(2017, 1, 1)

BAD_DDATES = {  # raw text -> corrected text
    "29231231": "20231231",
    "21061130": "20161130",
    "21051130": "20151130",
    "21080430": "20180430",
}

ASSETS_TAGS = ("Assets",)
CASH_TAGS = ("Cash", "CashAndDueFromBanks", "CashAndCashEquivalents",
             "CashAndCashEquivalentsUnrestricted", "CashEquivalentsAtCarryingValue",
             "CashAndCashEquivalentsAtCarryingValue",
             "CashAndCashEquivalentsAtCarryingValueExcludingVariableInterestEntities")
DEBT_TAGS = ("LongTermDebt", "LongTermDebtFairValue", "LongTermDebtAndCapitalLeaseObligations",
             "DebtAndCapitalLeaseObligations", "DebtLongtermAndShorttermCombinedAmount",
             "SecuredDebt", "UnsecuredDebt", "OperatingLeaseLiabilityNoncurrent",
             "SubordinatedDebt", "ConvertibleDebt", "LongTermLineOfCredit", "OtherBorrowings",
             "NotesAndLoansReceivableNetNoncurrent",
             "LongTermDebtNoncurrent", "LongTermDebtCurrent")
FLOAT_TAGS = ("EntityPublicFloat", "FreeFloat", "PublicFloat", "PublicFloatValue",
              "ComputedFloat", "ComputedMarketFloat", "ComputedTreasuryFloat")
REVENUE_TAGS = ("Revenue", "Revenues", "RevenueFromContractsWithCustomers",
                "RevenueFromContractWithCustomerIncludingAssessedTax",
                "RevenueFromContractWithCustomerExcludingAssessedTax",
                "RevenuesNetOfInterestExpense", "RegulatedAndUnregulatedOperatingRevenue",
                "RegulatedOperatingRevenuePipelines", "SalesRevenueGoodsNet")
INCOME_TAGS = ("ProfitLoss", "NetIncomeLoss", "ComprehensiveIncome")

FX_CLOSING_TAGS = ("ClosingForeignExchangeRate", "ForeignCurrencyExchangeRateTranslation1")
FX_AVERAGE_TAGS = ("AverageForeignExchangeRate",)

FLOAT_SHARE_TAGS = ("EntityCommonStockSharesOutstanding", "CommonStockSharesOutstanding",
                    "SharesOutstanding", "WeightedAverageNumberOfDilutedSharesOutstanding",
                    "WeightedAverageNumberOfSharesOutstandingBasic")
FLOAT_PRICE_TAGS = ("SharePrice", "PerSharePrice", "MarketValuePerShare", "SaleOfStockPricePerShare",
                    "CashPricePerOrdinaryShare", "TreasurySharesValuePerShare",
                    "SharesOutstandingPricePerShare")
FLOAT_REPORTED_TAGS = ("EntityPublicFloat",
                       "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
                       "FreeFloat", "PublicFloat", "PublicFloatValue")
COMPUTED_FLOAT_TAG = "ComputedMarketFloat"
COMPUTED_SRCDIR = "computed"

CURRENCY_PAIR_PATTERN = r"([A-Z]{3}).*?([A-Z]{3})"
# ------------------------------------------------------------ END FIXED VALUES


@dataclass(frozen=True)
class MetricSpec:
    """One extracted metric.

    name      value column of the metric views (``assets`` ...)
    short     suffix of the converted table (``t_a`` ...)
    qtrs      0 = point in time, 4 = four quarters
    positive  keep only value > 0
    tags      tag list
    no_match  what conversion does with a unit that is not a currency pair:
              'drop' removes the row, 'null' keeps it with a NULL amount
    """

    name: str
    short: str
    qtrs: int
    positive: bool
    tags: tuple
    no_match: str

    @property
    def usd_col(self) -> str:
        return f"{self.name}_usd"


METRICS = {
    "assets": MetricSpec("assets", "a", 0, True, ASSETS_TAGS, "drop"),
    "cash": MetricSpec("cash", "c", 0, True, CASH_TAGS, "drop"),
    "debt": MetricSpec("debt", "d", 0, True, DEBT_TAGS, "null"),
    "float": MetricSpec("float", "f", 0, True, FLOAT_TAGS, "drop"),
    "revenue": MetricSpec("revenue", "r", 4, False, REVENUE_TAGS, "null"),
    "income": MetricSpec("income", "i", 4, False, INCOME_TAGS, "null"),
}


def all_fact_tags() -> tuple:
    """Every tag a downstream model reads; used to prune ``num`` before any shuffle."""
    out = []
    for spec in METRICS.values():
        out.extend(spec.tags)
    out.extend(FX_CLOSING_TAGS + FX_AVERAGE_TAGS + FLOAT_SHARE_TAGS + FLOAT_PRICE_TAGS
               + FLOAT_REPORTED_TAGS)
    return tuple(dict.fromkeys(out))
