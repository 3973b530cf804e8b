"""DuckDB SQL of the registered queries, built from common table expressions over the same tables."""

from __future__ import annotations

import re

from tickloom.functions.greeks import HART_BOTTOM, HART_SPLIT, HART_TAIL, HART_TOP


def _tickers(symbol: str = "event_type") -> str:
    return f"""tickers as (
  select symbol, date, value / 100 as iv, value + 100 as underlying_price,
         (7689600 - date_diff('second', timestamp '2024-01-01 00:00:00', date))::double / 31536000::double as time_to_maturity,
         (100 + 10 * (user_id % 20))::double as strike, case when event_id % 2 = 0 then 'c' else 'p' end as callput, 0.01::double as interest_rate,
         case when user_id % 7 <> 0 then value / 10 end as mark_price, value + 100 as index_price,
         volume, volume * (value / 100) * 100 as quote_volume, event_id::varchar as record_time, event_id, user_id
  from (select {symbol}::varchar as symbol, date_trunc('minute', ts)::timestamp as date, event_id, user_id, value,
               case when event_id % 11 <> 0 then json_extract_string(props, '$.k')::double end as volume
        from events
        qualify row_number() over (partition by {symbol}, date_trunc('minute', ts) order by event_id desc) = 1)),
crcs as (select symbol, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(8 * strlen(symbol)), lambda i: (('0x' || substr(hex(symbol), 1 + 2 * (i // 8)::bigint, 2))::bigint >> (i % 8)::bigint) & 1)),
         lambda s, b: xor(s >> 1, 3988292384 * (xor(s, b) & 1)))) as crc from (select distinct symbol from tickers))"""


def _dense(source: str = "tickers", min_points: int = 10, days: int | None = 30, order: str = "date") -> str:
    """days None: symbols of any span."""
    fill = ("strike", "callput", "interest_rate", "mark_price", "index_price", "volume", "quote_volume", "record_time")
    span = "" if days is None else f" and date_diff('second', min(date), max(date)) <= {days} * 86400"
    return f"""gates as (
  select symbol, count(*) as n, min(date) as t0, max(date) as t1 from {source} group by symbol
  having count(*) >= {min_points}{span}),
anchors as (
  select t.symbol, t.date, t.iv, t.underlying_price, t.time_to_maturity, t1,
         {", ".join(f"last_value({c} ignore nulls) over past as {c}" for c in fill)},
         date_diff('minute', t.date, lead(t.date) over w) as gap,
         lead(iv) over w as iv2, lead(underlying_price) over w as up2, lead(time_to_maturity) over w as tm2
  from {source} t join gates g on t.symbol = g.symbol
  where date_diff('microsecond', t0, t.date) % 60000000 = 0
  window w as (partition by t.symbol order by {order}), past as (partition by t.symbol order by {order} rows unbounded preceding)),
dense as (
  select symbol, date + to_minutes(k) as date,
         coalesce(iv + (iv2 - iv) / step * k, iv) as iv, coalesce(underlying_price + (up2 - underlying_price) / step * k, underlying_price) as underlying_price,
         coalesce(time_to_maturity + (tm2 - time_to_maturity) / step * k, time_to_maturity) as time_to_maturity,
         {", ".join(fill)}, k > 0 as is_interpolated
  from (select *, greatest(gap, 1)::double as step, unnest(range(0, case when gap is null then date_diff('second', date, t1) // 60 else greatest(gap, 1) - 1 end + 1)) as k from anchors))"""


_WORD = 4294967295


def _times(x: str, by: int) -> str:
    return f"((({x})::hugeint * {by}) & {_WORD})::bigint"


def _turned(x: str, n: int) -> str:
    return f"((({x} << {n}) & {_WORD}) | ({x} >> {32 - n}))"


def _taken(h: str, word: str) -> str:
    """Murmur3's state h after one more word of 32 bits."""
    key = _times(_turned(_times(word, 0xCC9E2D51), 15), 0x1B873593)
    return f"((({_turned(f'xor({h}, {key})', 13)}) * 5 + {0xE6546B64}) & {_WORD})"


def _ended(h: str, size: int) -> str:
    h = f"xor({h}, {size})"
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = _times(f"xor({h}, {h} >> {shift})", by)
    return f"xor({h}, {h} >> 16)"


def _hashed(h: str, value: str, out: str, source: str) -> str:
    """source with the column out: Spark's hash of a long, begun at h."""
    steps = f"select *, {_taken(h, f'({value} & {_WORD})')} as h1 from {source}"
    steps = f"select *, {_taken('h1', f'(({value} >> 32) & {_WORD})')} as h2 from ({steps})"
    return f"(select * exclude (h1, h2), {_ended('h2', 8)} as {out} from ({steps}))"


def _noised(source: str) -> str:
    """The rows of source, a select with symbol and timestamp, with their states as the draws begin: xs of the symbol and rs of the row; seed 42."""
    keys = f"(select s.*, crc, 42::bigint as ks, epoch(timestamp)::bigint as kt from ({source}) s left join crcs using (symbol))"
    for h, value, out in (("42::bigint", "ks", "x0"), ("x0", "crc", "xa"), ("xa", "kt", "r")):
        keys = _hashed(h, value, out, keys)
    begun = ", ".join(f"{_ended(_taken('42::bigint', h), 4)} as {out}" for h, out in (("xa", "xs"), ("r", "rs")))
    return f"(select * exclude (crc, ks, kt, x0, xa, r), {begun} from {keys})"


def _u(i: int, state: str = "rs") -> str:
    return f"({_ended(_taken(state, f'{i}::bigint'), 4)} / 4294967296::double)"


_VOLUME = f"round(greatest(case when v > 0 then v else -50::double * ln(1 - {_u(4)}) end, 0), 6)"
_POINTS = f"""points as materialized (
  select symbol, timestamp, b, v, {", ".join(f"{_u(i)} as u{i}" for i in (0, 1, 2, 3, 5))}, {_VOLUME} as volume
  from {_noised("select symbol, date as timestamp, coalesce(nullif(underlying_price, 0), nullif(mark_price, 0), index_price) as b, volume as v from dense")} where b > 0)"""
_SHAPES = {
    "basic": (
        "select *, b * 0.001::double as s from points",
        "select *, b + (-s / 3 + u0 * (s / 3 - -s / 3)) as o, b + (-s / 3 + u1 * (s / 3 - -s / 3)) as c from s0",
        "o", "greatest(o, c) + u2 * s / 2", "least(o, c) - u3 * s / 2", "c",
    ),
    "midpoint": (
        "select *, b * 0.001::double as s from points", "select * from s0",
        "b + (-s / 4 + u0 * (s / 4 - -s / 4))", "b + s / 2", "b - s / 2", "b + (-s / 4 + u1 * (s / 4 - -s / 4))",
    ),
    "simple": ("select *, b * 0.001::double as s from points", "select * from s0", "b", "b + s / 2", "b - s / 2", "b + (-s / 2 + u0 * (s / 2 - -s / 2))"),
}


def _minute(kind: str = "basic") -> str:
    s0, s1, o, h, low, c = _SHAPES[kind]
    return f"""{_POINTS}, s0 as ({s0}), s1 as ({s1}),
minute as (select symbol, timestamp, {_r(o, 4)} as open, {_r(h, 4)} as high, {_r(low, 4)} as low, {_r(c, 4)} as close, volume, b as source_price from s1)"""


def _candles(n: int, label: str, source: str = "minute", name: str = "candles") -> str:
    return f"""{name} as (
  select symbol, time_bucket(interval {n} minutes, timestamp, timestamp '1970-01-01') as timestamp, arg_min(open, timestamp) as open, max(high) as high, min(low) as low,
         arg_max(close, timestamp) as close, coalesce(sum(volume), 0) as volume, '{label}' as frequency, {n} as source_candles
  from {source} group by 1, 2 having count(*) >= {n})"""


def _r(x: str, n: int) -> str:
    """Rounds the decimal digits of a double half up, as Spark does; DuckDB alone rounds the binary value."""
    return f"round(({x})::varchar::decimal(38,24), {n})::double"


def _with(*parts: str) -> str:
    return "with " + ",\n".join(p for p in parts if p) + "\n"


T = _tickers()
U = _tickers("user_id")
D = _dense()
W = _dense(days=None)
M = _minute()
CANDLE_COLUMNS = "symbol, timestamp, round(open, 4) as open, round(high, 4) as high, round(low, 4) as low, round(close, 4) as close, round(volume, 6) as volume, frequency, source_candles"
MANY = """many as (select event_type as symbol, date_trunc('minute', ts)::timestamp as date, value / 100 as iv, value + 100 as underlying_price, value / 1000 as time_to_maturity, event_id as strike,
  'c' as callput, null as interest_rate, null as mark_price, null as index_price, null as volume, null as quote_volume, null as record_time from events)"""
HALF = """half as (select * from (select event_type as symbol, date_trunc('minute', ts)::timestamp + case when second(ts) >= 30 then interval 30 seconds else interval 0 seconds end as date,
  value / 100 as iv, value + 100 as underlying_price, value / 1000 as time_to_maturity, event_id as strike,
  'c' as callput, null as interest_rate, null as mark_price, null as index_price, null as volume, null as quote_volume, null as record_time from events)
  qualify row_number() over (partition by symbol, date order by strike desc) = 1)"""
BROKEN = """broken as (select symbol, date as timestamp, case when event_id % 97 <> 0 then underlying_price end as open, case when event_id % 89 = 0 then underlying_price - 2 else underlying_price + 1 end as high,
  case when event_id % 83 = 0 then underlying_price + 0.5::double else underlying_price - 1 end as low, underlying_price + 0.25::double as close,
  case when event_id % 79 = 0 then -1::double else coalesce(volume, 0) end as volume, underlying_price as source_price from tickers)"""
MENDED = """mended as (select symbol, timestamp, case when symbol = 'view' then coalesce(open, close) else open end as open, case when symbol = 'view' then greatest(open, high, low, close) else high end as high,
  case when symbol = 'view' then least(open, high, low, close) else low end as low, close, case when symbol = 'view' then abs(volume) else volume end as volume, source_price from broken)"""
WRONG = "coalesce(high < low or high < open or high < close or low > open or low > close, false)"
SIDES = """rows_ as (select event_type as symbol, date_trunc('minute', ts)::timestamp as date, value / 100 as iv, value + 100 as underlying_price, event_id from events),
old as (select * from rows_ where event_id % 2 = 0 qualify row_number() over (partition by symbol, date order by event_id desc) = 1),
new as (select * from rows_ where event_id % 2 = 1 qualify row_number() over (partition by symbol, date order by event_id desc) = 1)"""
OUTCOMES = """outcomes as (select symbol, case when n < 60 then 'skipped' when s % 7 = 0 then 'error' else 'success' end as status,
  case when n < 60 then 'too few rows' when s % 7 = 0 then 'failed' end as reason, n as input_rows, case when n >= 60 and s % 7 <> 0 then n * 100 else 0 end as output_rows, n / 8 as seconds, s
  from (select symbol, count(*) as n, symbol::int as s from tickers group by symbol))"""
LEDGER = """ledger as (
  select symbol, case when s % 5 = 0 then 'pending' when status = 'success' then 'completed' else status end as status, case when s % 5 <> 0 then input_rows end as input_rows,
         case when s % 5 <> 0 then output_rows end as output_rows, case when s % 5 <> 0 then seconds end as seconds, case when s % 5 <> 0 then reason end as error_message, 7 as batch_id from outcomes
  union all select 'old' || symbol, 'pending', null, null, null, null, 6 from outcomes)"""
SNAPSHOTS = """snapshots as (
  select 7 as batch_id, taken_at, count(*) filter (where s % 3 <= i) as done_symbols, count(*) filter (where s % 3 > i) as pending_symbols, sum(case when s % 3 <= i then output_rows else 0 end)::bigint as output_rows
  from outcomes, (values (0, timestamp '2024-02-01 00:00:00'), (1, timestamp '2024-02-01 00:10:00'), (2, timestamp '2024-02-01 00:30:00')) t(i, taken_at) group by taken_at),
steps as (select *, date_diff('second', lag(taken_at) over w, taken_at) as dt, output_rows - lag(output_rows) over w as dr, done_symbols - lag(done_symbols) over w as dd from snapshots window w as (partition by batch_id order by taken_at))"""
STATUS = """status as (select 'tickers' as "table", count(*) as n_rows, count(distinct symbol) as n_symbols from tickers union all select 'dense', count(*), count(distinct symbol) from dense
  union all select 'minute', count(*), count(distinct symbol) from minute union all select 'candles', count(*), count(distinct symbol) from candles)"""


#: Passes of the recursion over the closes before: each leaves under a third of the differences of the pass before.
TREND_PASSES = 24
_LAGS = ", ".join(f"lag(cl, {i}) over w as l{i}" for i in range(1, 6))
_TREND = "case when l2 is null then 0::double " + "".join(f"when l{n + 1} is null then (l1 - l{n}) / {n} " for n in range(2, 5)) + "else (l1 - l5) / 5 end"


def _trend() -> str:
    close = "floor((x + tr * 0.72::double) * 10000 + 0.5::double) / 10000"
    passes = [f"p0 as (select *, b + e as x, b + e as cl from (select *, sqrt(-2 * ln(1 - u0)) * cos(2 * pi() * u1) * 0.001::double * b as e from points))"]
    passes += [f"p{k} as (select * exclude (cl, l1, l2, l3, l4, l5, tr), {close} as cl, tr as trend from (select * {'' if k == 1 else 'exclude (trend)'}, {_TREND} as tr from (select *, {_LAGS} from p{k - 1} window w as (partition by symbol order by timestamp))))" for k in range(1, TREND_PASSES + 1)]
    return ",\n".join(passes)


def _walk() -> str:
    normal = lambda u, v: f"sqrt(-2 * ln(1 - {u})) * cos(2 * pi() * {v})"
    return f"""minutes as (select symbol, timestamp '2023-03-20 09:00:00' + to_minutes(id::int) as timestamp, id from (select distinct symbol from tickers), range(0, 1440) r(id)),
draws as (select *, {", ".join(f"{_u(i)} as u{i}" for i in range(7))}, {_u(8, "xs")} as s0, {_u(9, "xs")} as s1 from {_noised("select * from minutes")}),
steps as (select *, {_r(normal("u0", "u1") + " * 10", 2)} as step, {_r("25000::double + " + normal("s0", "s1") + " * 500", 2)} as first from draws),
closes as (select *, (sum(round(step * 100)::bigint) over (partition by symbol order by id) + round(first * 100)::bigint) / 100::double as close from steps),
candles as (select *, coalesce(lag(close) over (partition by symbol order by id), first) as open from closes)
select symbol, timestamp, open, {_r("greatest(open, close) + abs(" + normal("u2", "u4") + " * 3)", 2)} as high, {_r("least(open, close) - abs(" + normal("u3", "u5") + " * 3)", 2)} as low, close, {_r("-50::double * ln(1 - u6)", 4)} as volume from candles"""


def _upsert(update: str) -> str:
    pick = lambda c, take: f"case when n.event_id is null then o.{c} when o.event_id is null then n.{c} else {'n' if take else 'o'}.{c} end as {c}"
    cols = ", ".join(pick(c, update == "all" or c in update) for c in ("iv", "underlying_price", "event_id"))
    return _with(SIDES) + f"select symbol, date, {cols} from old o full join new n using (symbol, date)"


def _cdf(z: str) -> str:
    poly = lambda cs: f"({'(' * (len(cs) - 1)}{cs[0]!r}::double" + "".join(f" * x + {c!r}::double)" for c in cs[1:]) + ")"
    tail = "x + 0.65::double"
    for k in ("4", "3", "2", "1"):
        tail = f"x + {k}::double / ({tail})"
    e = f"exp(-{z} * {z} / 2)"
    body = f"case when x > 37 then 0::double when x < {HART_SPLIT!r} then {e} * {poly(HART_TOP)} / {poly(HART_BOTTOM)} else {e} / ({tail}) / {HART_TAIL!r}::double end"
    body = re.sub(r"\bx\b", f"abs({z})", body)
    return f"(case when {z} > 0 then 1 - ({body}) else ({body}) end)"


_R = "0.01::double"
GREEKS = f"""base as (select *, (ln(s / k) + ({_R} + v * v / 2) * t) / (v * sqrt(t)) as d1 from (select symbol, date, callput, case when ok then underlying_price end as s, case when ok then strike end as k,
  case when ok then time_to_maturity end as t, case when ok then iv end as v from (select *, underlying_price > 0 and strike > 0 and time_to_maturity > 0 and iv > 0 as ok from tickers))),
both_ as (select *, d1 - v * sqrt(t) as d2, -d1 as m1 from base), three as (select *, -d2 as m2 from both_),
cdf as (select *, {_cdf("d1")} as p1, {_cdf("m1")} as q1, {_cdf("d2")} as p2, {_cdf("m2")} as q2, exp(-d1 * d1 / 2) / sqrt(2 * pi()) as den, exp(-{_R} * t) as disc from three),
greeks as (select symbol, date, callput, case when callput = 'c' then p1 else -q1 end as delta, den / (s * v * sqrt(t)) as gamma,
  case when callput = 'c' then -(s * den * v) / (2 * sqrt(t)) - {_R} * k * disc * p2 else -(s * den * v) / (2 * sqrt(t)) + {_R} * k * disc * q2 end / 365 as theta, s * den * sqrt(t) / 100 as vega,
  case when callput = 'c' then k * t * disc * p2 / 100 else -(k * t * disc * q2 / 100) end as rho from cdf)"""
SPREAD = """f0 as (select *, b * 0.002::double * (0.5::double + u5 * 1::double) as s from points), f1 as (select *, -s / 3 + u1 * (s / 3 - -s / 3) as n from f0),
f2 as (select *, list(b * 1.15::double + n) over w as xs, list(b + n) over w as ys from f1 window w as (partition by symbol order by timestamp rows between 15 preceding and current row)),
f3 as (select *, list_reduce(list_prepend(round(ys[1], 4), xs[2:]), lambda a, x: round(x - a * 0.15::double, 4)) as cl from f2),
f4 as (select *, coalesce((b - lag(cl) over (partition by symbol order by timestamp)) * 0.3::double, 0) as bias from f3),
f5 as (select *, b + (-s / 3 + u0 * (s / 3 - -s / 3)) + bias * 0.2::double as o from f4),
f6 as (select *, greatest(o, cl) + u2 * s / 2 as h, least(o, cl) - u3 * s / 2 as l, (o + cl) / 2 as mid from f5)"""

ORACLES: dict[str, str] = {
    "densify_linear": _with(T, D) + f"select symbol, date, {_r('iv', 8)} as iv, {_r('underlying_price', 8)} as underlying_price, {_r('time_to_maturity', 8)} as time_to_maturity, is_interpolated from dense",
    "densify_ffill": _with(T, D) + "select symbol, date, round(strike, 6) as strike, callput, interest_rate, round(mark_price, 6) as mark_price, round(index_price, 6) as index_price, round(volume, 6) as volume, round(quote_volume, 6) as quote_volume, record_time from dense",
    "ffill_sparse": _with(T) + "select symbol, date, round(last_value(mark_price ignore nulls) over w, 6) as mark_price, round(last_value(volume ignore nulls) over w, 6) as volume from tickers window w as (partition by symbol order by date rows unbounded preceding)",
    "densify_gates": _with(U) + """select symbol, count(*) as rows, min(date) as first, max(date) as last,
  case when count(*) < 50 then 'too few rows' when date_diff('second', min(date), max(date)) > 29 * 86400 then 'span too long' when date_diff('minute', min(date), max(date)) + 1 > 100000 then 'grid too long' end as gate
  from tickers group by symbol""",
    "densify_duplicates": _with(MANY, _dense("many", days=None, order="date, strike")) + f"select symbol, date, {_r('iv', 8)} as iv, {_r('underlying_price', 8)} as underlying_price, strike, is_interpolated from dense",
    "densify_offgrid": _with(HALF, _dense("half", days=None)) + f"select symbol, date, {_r('iv', 8)} as iv, strike, is_interpolated from dense",
    "is_interpolated_split": _with(T, W) + "select symbol, count(*) as n_points, round(avg(iv), 6) as avg_iv, case when is_interpolated then 'interpolated' else 'original' end as kind from dense group by symbol, is_interpolated",
    "densify_outcomes": _with(U, _dense(min_points=50, days=29)) + """select symbol, case when reason is null then 'success' else 'skipped' end as status, reason, input_rows, output_rows from (
  select symbol, case when input_rows < 50 then 'too few rows' when span > 29 * 86400 then 'span too long' when coalesce(n, 0) = 0 then 'nothing after interpolation' end as reason, input_rows, coalesce(n, 0) as output_rows
  from (select symbol, count(*) as input_rows, date_diff('second', min(date), max(date)) as span from tickers group by symbol) left join (select symbol, count(*) as n from dense group by symbol) using (symbol))""",
    "scan_tickers": _with(T) + "select symbol, date, iv, underlying_price, time_to_maturity, strike, callput, interest_rate, mark_price, index_price, volume, quote_volume, record_time from tickers",
    "symbols_in_range": _with(U) + "select distinct symbol from tickers where date between timestamp '2024-01-05' and timestamp '2024-01-12'",
    "first_symbols": _with(U) + "select symbol, count(*) as n_rows from tickers where symbol in (select distinct symbol from tickers order by symbol limit 3) group by symbol",
    "all_symbols": _with(U) + "select distinct symbol from tickers",
    "restrict_list": _with(T) + "select symbol, count(*) as n_rows, round(sum(iv), 6) as sum_iv from tickers where symbol in ('click', 'view') group by symbol",
    "symbols_of_batch": _with(U) + "select distinct symbol from tickers where symbol::int % 3 = 1",
    "pending_symbols": _with(U) + "select symbol from tickers group by symbol having count(*) < 50 or date_diff('second', min(date), max(date)) > 29 * 86400",
    "symbols_in_both": _with(U) + "select distinct symbol from tickers where iv > 1.5 order by symbol limit 5",
    "compare_series": _with(T, D) + "select t.symbol, t.date, t.iv as raw_iv, round(d.iv, 8) as dense_iv, round(t.iv - d.iv, 8) as difference from tickers t join dense d on t.symbol = d.symbol and t.date = d.date and not d.is_interpolated",
    "latest_rows": _with(T) + "select symbol, max(event_id % 5)::int as batch_id, count(*) filter (where event_id % 5 = m) as n_rows from tickers join (select symbol, max(event_id % 5) as m from tickers group by symbol) using (symbol) group by symbol",
    "choose_price": _with(T) + """select symbol, case when avg((callput = 'c')::int) > 0.8 then 'underlying_price' when avg((mark_price is not null)::int) > 0.8 then 'mark_price' when avg((index_price is not null)::int) > 0.8 then 'index_price' else 'underlying_price' end as price_column
  from tickers group by symbol""",
    "bridge_basic": _with(T, W, M) + "select * from minute",
    "bridge_midpoint": _with(T, W, _minute("midpoint")) + "select * from minute",
    "bridge_simple": _with(T, W, _minute("simple")) + "select * from minute",
    "bridge_spread": _with(T, W, _POINTS, SPREAD) + """select symbol, timestamp, round(o, 4) as open, round(case when h - l < b * 0.0005::double then mid + b * 0.00025::double else h end, 4) as high,
  round(case when h - l < b * 0.0005::double then mid - b * 0.00025::double else l end, 4) as low, round(cl, 4) as close, volume, b as source_price from f6""",
    "bridge_trend": _with(T, D, _POINTS, _trend()) + f"""select symbol, timestamp, {_r("o", 4)} as open, {_r("greatest(o, cl) + abs(trend) * case when trend > 0 then 0.5::double else 0.2::double end", 4)} as high,
  {_r("least(o, cl) - abs(trend) * case when trend > 0 then 0.2::double else 0.5::double end", 4)} as low, cl as close, volume, b as source_price from (select *, b + trend * 0.6::double + e as o from p{TREND_PASSES})""",
    "volume_repair": _with(T) + f"select symbol, timestamp, {_VOLUME} as volume from {_noised('select symbol, date as timestamp, volume as v from tickers')}",
    "quality_gate": _with(T, BROKEN, MENDED) + """select symbol, reason is null as valid, reason from (select symbol, case when bool_or(high < low) then 'high below low' when bool_or(high < open or high < close) then 'high below open or close'
  when bool_or(low > open or low > close) then 'low above open or close' when bool_or((high - low) / source_price > 0.1) then 'spread too wide' when bool_or(least(open, high, low, close) <= 0) then 'price not above zero' end as reason
  from mended group by symbol)""",
    "required_columns": _with(T) + """select c as "column", 'missing columns: ' || c as message, (select count(*) from tickers) as n_rows
  from (values ('symbol'), ('timestamp'), ('open'), ('high'), ('low'), ('close'), ('volume')) v(c)""",
    "cleanup_candles": _with(T, BROKEN) + "select symbol, timestamp, round(open, 6) as open, round(close, 6) as close, round(volume, 6) as volume from broken where open is not null and symbol <> 'view'",
    "validate_candles": _with(T, BROKEN, MENDED) + f"""select symbol, reason is null as valid, reason, n_bad from (
  select symbol, case when count(*) filter (where {WRONG}) > 0 then 'wrong order of prices' when count(*) filter (where volume < 0) > 0 then 'negative volume' when count(*) filter (where open is null) > 0 then 'missing price' end as reason,
         count(*) filter (where {WRONG} or volume < 0 or open is null) as n_bad
  from mended group by symbol)""",
    "enforce_rejects": _with(T, BROKEN) + """select symbol, timestamp, reason from (select symbol, timestamp, case when open is null then 'open is null' when high < low then 'high below low' when high < open or high < close then 'high below open or close'
  when low > open or low > close then 'low above open or close' when volume < 0 then 'negative volume' end as reason from broken) where reason is not null""",
    "conform_columns": _with(T) + """select symbol, date as timestamp, null::decimal(15,4) as open, null::decimal(15,4) as high, null::decimal(15,4) as low, underlying_price::decimal(15,4) as close, volume::decimal(20,8) as volume,
  underlying_price::decimal(15,4) as source_price, true as is_synthetic from tickers""",
    "dedupe_last": _with(MANY) + "select symbol, date, round(iv, 6) as iv, strike from many qualify row_number() over (partition by symbol, date order by strike desc) = 1",
    "upsert_update": _upsert("all"),
    "upsert_ignore": _with(SIDES) + "select * from old union all select * from new anti join old using (symbol, date)",
    "upsert_partial_columns": _upsert("iv"),
    "resample_5min": _with(T, W, M, _candles(5, "5min")) + f"select {CANDLE_COLUMNS} from candles",
    "resample_15min": _with(T, W, M, _candles(15, "15min")) + f"select {CANDLE_COLUMNS} from candles",
    "resample_7min": _with(T, D, M, _candles(7, "7m")) + f"select {CANDLE_COLUMNS} from candles",
    "reconstruction_stats": _with(T, D, M, _candles(5, "5min")) + """select a.symbol, a.n as source_candles, coalesce(b.n, 0) as out_candles, round(a.n / nullif(b.n, 0), 6) as compression, a.m as source_minutes, b.m as out_minutes,
  round(b.m / nullif(a.m, 0), 6) as coverage, round(a.v, 2) as source_volume, round(b.v, 2) as out_volume, round(abs(1 - b.v / nullif(a.v, 0)), 6) as volume_drift
  from (select symbol, count(*) as n, date_diff('minute', min(timestamp), max(timestamp)) as m, sum(volume) as v from minute group by symbol) a
  left join (select symbol, count(*) as n, date_diff('minute', min(timestamp), max(timestamp)) as m, sum(volume) as v from candles group by symbol) b using (symbol)""",
    "candle_outcomes": _with(U, _candles(2, "2min", "(select symbol, date as timestamp, underlying_price as open, underlying_price as high, underlying_price as low, underlying_price as close, volume from tickers)", "out_")) + """select symbol,
  case when n < 2 then 'skipped' when m is null then 'error' else 'success' end as status, case when n < 2 then 'too few rows' when m is null then 'no complete group' end as reason, n as input_rows, coalesce(m, 0) as output_rows
  from (select symbol, count(*) as n from tickers group by symbol) left join (select symbol, count(*) as m from out_ group by symbol) using (symbol)""",
    "bridge_outcomes": _with(U) + """select symbol, case when bad then 'error' when m is null then 'skipped' else 'success' end as status, case when bad then 'spread too wide' when m is null then 'no base price' end as reason, n as input_rows, coalesce(m, 0) as output_rows
  from (select symbol, count(*) as n, count(*) filter (where iv < 4) as k, nullif(count(*) filter (where iv < 4), 0) as m, symbol::int % 11 = 0 and count(*) filter (where iv < 4) > 0 as bad from tickers group by symbol)""",
    "candle_breakdown": _with(T, W, M, _candles(5, "5min")) + "select symbol, count(*) as n_candles, min(timestamp) as first, max(timestamp) as last, round(sum(volume), 2) as total_volume from candles group by symbol",
    "candle_quality": _with(T, BROKEN) + """select count(*) as total, count(*) filter (where high >= low) as valid_high_low, count(*) filter (where high >= open and high >= close) as valid_high, count(*) filter (where low <= open and low <= close) as valid_low,
  count(*) filter (where volume >= 0) as valid_volume, round(avg(high - low), 4) as avg_spread, round(avg(volume), 2) as avg_volume from broken""",
    "candle_shape": _with(T, D, M) + "select symbol, timestamp, round(high - low, 4) as spread, round(abs(close - open), 4) as body, case when close >= open then 'green' else 'red' end as direction, round((high - low) / source_price, 8) as spread_share from minute",
    "head_per_symbol": _with(T, D, M) + "select symbol, timestamp, open, close from minute qualify row_number() over (partition by symbol order by timestamp) <= 100",
    "sample_comparison": _with(T, D, M, _candles(5, "5min"), "top_ as (select symbol from candles group by symbol order by count(*) desc, symbol limit 1)") + """
  (select symbol, timestamp, '1min' as frequency, open, high, low, close, round(volume, 4) as volume from minute where symbol in (from top_) order by timestamp limit 10)
  union all (select symbol, timestamp, frequency, round(open, 4), round(high, 4), round(low, 4), round(close, 4), round(volume, 4) from candles where symbol in (from top_) order by timestamp limit 2)""",
    "pipeline_status": _with(T, D, M, _candles(5, "5min"), STATUS) + "select * from status",
    "table_profile": _with(T, D, M, _candles(5, "5min")) + """select 'tickers' as "table", true as "exists", count(*) as n_rows, count(distinct symbol) as n_symbols, min(date) as first, max(date) as last from tickers
  union all select 'dense', true, count(*), count(distinct symbol), min(date), max(date) from dense union all select 'minute', true, count(*), count(distinct symbol), min(timestamp), max(timestamp) from minute
  union all select 'candles', true, count(*), count(distinct symbol), min(timestamp), max(timestamp) from candles union all select 'archive', false, 0, 0, null, null""",
    "symbol_breakdown_top10": _with(U) + "select symbol, count(*) as n_rows, min(date) as first, max(date) as last, date_diff('minute', min(date), max(date)) as minutes from tickers group by symbol order by n_rows desc, symbol limit 10",
    "symbol_profile": _with(U) + """select symbol, n_rows, first, last, n_dates, round(span, 4) as span_hours, factor, n_rows * factor as complexity, case when n_rows < 1000 then 'small' when n_rows < 10000 then 'medium' when n_rows < 50000 then 'large' else 'xlarge' end as size_class
  from (select *, greatest(1, floor(span * 60 / n_dates))::bigint as factor from (select symbol, count(*) as n_rows, min(date) as first, max(date) as last, count(distinct date) as n_dates, date_diff('second', min(date), max(date)) / 3600::double as span from tickers group by symbol))""",
    "most_populated": _with(U) + "select symbol from tickers group by symbol order by count(*) desc, symbol limit 1",
    "hourly_density": _with(T, W) + "select symbol, date_trunc('hour', date)::timestamp as hour, count(*) as n_points from dense group by 1, 2",
    "hourly_density_raw": _with(T) + "select symbol, date_trunc('hour', date)::timestamp as hour, count(*) as n_points from tickers group by 1, 2",
    "stage_ratios": _with(T, D, M, _candles(5, "5min"), STATUS) + """select a."table" as from_table, b."table" as to_table, round(b.n_rows / a.n_rows, 6) as ratio from status a join status b
  on (a."table", b."table") in (('tickers', 'dense'), ('dense', 'minute'), ('minute', 'candles'))""",
    "stage_progress": _with(U) + """select 'dense' as stage, done, total, round(done * 100.0::double / total, 2) as percent, ((total - done) * 0.5)::double as remaining_minutes
  from (select count(distinct symbol) filter (where iv > 1.5) as done, count(distinct symbol) as total from tickers)""",
    "volume_summary": _with(U) + "select count(*) as n_rows, count(distinct symbol) as n_symbols, count(*) // count(distinct symbol) as rows_per_symbol from tickers",
    "stage_totals": _with(U, OUTCOMES) + """select count(*) filter (where status = 'success') as n_success, count(*) filter (where status = 'error') as n_error, count(*) filter (where status = 'skipped') as n_skipped, sum(input_rows)::bigint as input_rows,
  sum(output_rows)::bigint as output_rows, round(count(*) filter (where status = 'success') * 100.0::double / count(*), 2) as success_rate from outcomes""",
    "open_batch": _with(U, OUTCOMES, LEDGER) + "select symbol, case when status = 'error' then 'pending' else status end as status, case when status = 'error' then 8 else batch_id end::bigint as batch_id, case when status <> 'error' then input_rows end as input_rows from ledger",
    "close_batch": _with(U, OUTCOMES, LEDGER) + "select symbol, status, input_rows, output_rows, error_message, batch_id::bigint as batch_id from ledger",
    "progress_summary": _with(U, OUTCOMES, LEDGER) + """select case when grouping(status) = 1 then 'total' else status end as status, count(*) as n_symbols, sum(input_rows)::bigint as input_rows, sum(output_rows)::bigint as output_rows, round(sum(seconds), 4) as total_seconds,
  round(avg(seconds), 4) as avg_seconds, round(count(*) * 100.0::double / (select count(*) from ledger where batch_id = 7), 2) as percent from ledger where batch_id = 7 group by rollup (status)""",
    "latest_batch": "select 7::bigint as batch_id from events limit 1",
    "resume_symbols": _with(U, OUTCOMES, LEDGER) + "select symbol from ledger where batch_id = 7 and status in ('pending', 'error')",
    "failed_symbols": _with(U, OUTCOMES, LEDGER) + "select symbol, error_message from ledger where batch_id = 7 and status = 'error'",
    "throughput": _with(U, OUTCOMES, SNAPSHOTS) + """select batch_id, taken_at, done_symbols, pending_symbols, output_rows, round(dr / nullif(dt, 0), 4) as rows_per_second, round(dd * 60.0::double / nullif(dt, 0), 4) as symbols_per_minute,
  round(pending_symbols / nullif(dd * 60.0::double / nullif(dt, 0), 0), 4) as minutes_left from steps""",
    "low_throughput_alert": _with(U, OUTCOMES, SNAPSHOTS) + "select batch_id, taken_at, case when round(dr / nullif(dt, 0), 4) < 2000 then 'low throughput' end as alert from steps",
    "greeks": _with(T, GREEKS) + f"select symbol, date, {_r('delta', 8)} as delta, {_r('gamma', 8)} as gamma, {_r('theta', 8)} as theta, {_r('vega', 8)} as vega, {_r('rho', 8)} as rho from greeks",
    "greeks_legacy_rho": _with(T, GREEKS) + f"select symbol, date, {_r("case when callput = 'p' then -rho else rho end", 8)} as rho from greeks",
    "run_pipeline_end": _with(T, D, M, _candles(5, "5min", "(select symbol, timestamp, open::decimal(15,4) as open, high::decimal(15,4) as high, low::decimal(15,4) as low, close::decimal(15,4) as close, volume::decimal(20,8) as volume from m2)").replace("candles as (", "d2 as (select symbol, date, round(underlying_price, 4) as underlying_price, round(mark_price, 4) as mark_price, round(index_price, 4) as index_price, volume from dense),\nm2 as (select * from minute),\ncandles as (")).replace("volume as v from dense", "volume as v from (select symbol, date, underlying_price::varchar::decimal(15,4)::double as underlying_price, mark_price::varchar::decimal(15,4)::double as mark_price, index_price::varchar::decimal(15,4)::double as index_price, volume from dense)") + "select symbol, timestamp, open, high, low, close, volume from candles",
    "run_pipeline_outcomes": _with(T, D, M, _candles(5, "5min")) + """, n as (select symbol, (select count(*) from tickers t where t.symbol = s.symbol) as a, (select count(*) from dense t where t.symbol = s.symbol) as b,
  (select count(*) from minute t where t.symbol = s.symbol) as c, (select count(*) from candles t where t.symbol = s.symbol) as d from (select distinct symbol from tickers) s)
  select symbol, 'success' as status, null::varchar as reason, a as input_rows, b as output_rows, 'interpolation' as stage from n union all select symbol, 'success', null, b, c, 'bridge' from n union all select symbol, 'success', null, c, d, 'candles' from n""".lstrip(),
    "progress_snapshot": _with(U, OUTCOMES, LEDGER) + """select case when grouping(status) = 1 then 'total' else status end as status, count(*) as n_symbols, sum(input_rows)::bigint as input_rows, sum(output_rows)::bigint as output_rows,
  round(count(*) * 100.0::double / (select count(*) from ledger where batch_id = 7), 2) as percent from ledger where batch_id = 7 group by rollup (status)""",
    "synthetic_walk": _with(U, _walk()),
    "stream_candles_5min": _with(T, D, M, _candles(5, "5min")) + f"select {CANDLE_COLUMNS} from candles",
    "stream_upsert": _with(MANY) + "select symbol, date, round(iv, 6) as iv, strike as event_id from many qualify row_number() over (partition by symbol, date order by strike desc) = 1",
    "init_tables": "select t as \"table\", true as created, count(distinct event_type) as waiting from events, (values ('tickers'), ('dense'), ('minute'), ('candles'), ('ledger')) v(t) group by t",
}
ORACLES["run_pipeline_resumed"] = ORACLES["run_pipeline_end"]
