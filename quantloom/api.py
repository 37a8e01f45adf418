"""One day's option chain and single spreads for interactive use; many trades at once go through ``operators.options``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import options


class OptionPrices:
    """The continuous chain of one date, underlying and expiry, and prices read from it.

    Give ``expiry`` (yymmdd) or ``dte``; without either the nearest expiry on or after the date is taken. An index root
    stands for its weekly root too.
    """

    def __init__(self, bars: DataFrame, date: dt.date, underlying: str, expiry: int | None = None, dte: int | None = None):
        day = options.filter_underlying(bars.filter(F.col("date") == F.lit(date)), underlying).withColumn("underlying", F.lit(underlying))
        if expiry is None:
            row = options.choose_expiry(day, dte or 0).first()
            if row is None:
                raise ValueError(f"no options of {underlying} on {date}")
            expiry = row.expiry
        self.date, self.underlying, self.expiry = date, underlying, expiry
        self.chain = options.continuous_chain(day.filter(F.col("expiry") == expiry))
        self._spark = bars.sparkSession

    def trade(self, trade_type: str, center: float, width: float, at: dt.datetime) -> DataFrame:
        """One trade of the chain, as the spread operators take it."""
        row = [(0, trade_type, float(center), float(width), self.date, self.underlying, int(self.expiry), at)]
        return self._spark.createDataFrame(row, "trade_id long, trade_type string, center double, width double, date date, underlying string, expiry int, entry_time timestamp_ntz")

    def leg_price(self, option_type: str, strike: float, at: dt.datetime) -> float | None:
        """OHLC4 of a contract at the nearest minute; None without the contract."""
        leg = self.trade("", 0.0, 0.0, at).withColumns({"type": F.lit(option_type), "strike": F.lit(float(strike))})
        return options.lookup_leg_prices(self.chain, leg).first().price

    def estimate_underlying(self, at: dt.datetime) -> float | None:
        """Where call and put prices cross at a minute; None if nothing can be said."""
        row = options.implied_underlying(self.chain.filter(F.col("window_start") == F.lit(at).cast("timestamp_ntz"))).first()
        return row and row.implied


class OptionSpread:
    """A spread of one of the six trade types on a chain."""

    def __init__(self, trade_type: str, center: float, width: float, prices: OptionPrices):
        if trade_type.replace("-", "_") not in options.LEGS:
            raise ValueError(f"invalid trade type: {trade_type}")
        self.trade_type, self.center, self.width, self.prices = trade_type, center, width, prices

    def legs(self, at: dt.datetime) -> DataFrame:
        return options.spread_legs(self.prices.trade(self.trade_type, self.center, self.width, at))

    def initial_credit(self, at: dt.datetime) -> float:
        """Sum of the legs' prices by position; an error if a leg has none."""
        row = options.spread_credit(self.prices.trade(self.trade_type, self.center, self.width, at), self.prices.chain).first()
        if row.n_missing:
            raise ValueError(f"{row.n_missing} legs have no price at {at}")
        return row.credit

    def expiration_payoff(self, at: dt.datetime, n: int = 200) -> DataFrame:
        """(i, s, payoff) over n underlying prices around the center, in order."""
        trade = self.prices.trade(self.trade_type, self.center, self.width, at)
        credit = options.spread_credit(trade, self.prices.chain)
        return options.spread_payoff(trade, credit, n).select("i", "s", "payoff").orderBy("i")
