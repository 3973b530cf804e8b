"""Column types of the tables. Numbers are double while computing and decimal in the tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _NTZ, _I, _B = T.StringType(), T.TimestampNTZType(), T.IntegerType(), T.BooleanType()
_P = T.DecimalType(15, 4)
_V = T.DecimalType(20, 8)
_G = T.DecimalType(12, 8)

TICKERS = _struct(
    ("symbol", _S), ("date", _NTZ), ("iv", _G), ("underlying_price", _P), ("time_to_maturity", _G), ("strike", _P), ("callput", _S),
    ("interest_rate", T.DecimalType(8, 6)), ("mark_price", _P), ("index_price", _P), ("volume", _V), ("quote_volume", _V), ("record_time", _S),
)
GREEKS = ("delta", "gamma", "theta", "vega", "rho")
DENSE = T.StructType([*TICKERS.fields, *(T.StructField(g, _G) for g in GREEKS), T.StructField("is_interpolated", _B), T.StructField("batch_id", _I)])
MINUTE = _struct(("symbol", _S), ("timestamp", _NTZ), ("open", _P), ("high", _P), ("low", _P), ("close", _P), ("volume", _V), ("source_price", _P), ("is_synthetic", _B))
CANDLES = _struct(("symbol", _S), ("timestamp", _NTZ), ("open", _P), ("high", _P), ("low", _P), ("close", _P), ("volume", _V), ("frequency", _S), ("source_candles", _I), ("batch_id", _I))
LEDGER = _struct(
    ("symbol", _S), ("status", _S), ("input_rows", T.LongType()), ("output_rows", T.LongType()), ("processing_time_seconds", T.DoubleType()),
    ("error_message", _S), ("batch_id", T.LongType()), ("started_at", _NTZ), ("completed_at", _NTZ),
)


@dataclass(frozen=True)
class Spec:
    """What a table demands of its rows."""

    schema: T.StructType
    not_null: tuple[str, ...]
    key: tuple[str, ...] = ()
    candle: bool = False  # high is highest, low is lowest, volume is not negative
    defaults: dict = field(default_factory=dict)


SPECS = {
    "tickers": Spec(TICKERS, ("symbol", "date")),
    "dense": Spec(DENSE, ("symbol", "date", "iv", "underlying_price", "time_to_maturity"), defaults={"is_interpolated": False}),
    "minute": Spec(MINUTE, ("symbol", "timestamp", "open", "high", "low", "close", "volume"), ("symbol", "timestamp"), True, {"is_synthetic": True}),
    "candles": Spec(CANDLES, ("symbol", "timestamp", "open", "high", "low", "close", "volume", "frequency"), ("symbol", "timestamp", "frequency"), True),
    "ledger": Spec(LEDGER, ("symbol",), ("symbol",)),
}
