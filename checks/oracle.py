"""DuckDB oracle SQL for the driver queries, written from the prose rules of the models.

The three sources are derived again from ``events`` in SQL, with binary values as lower-case hex
text. Everything is per-row facts: a transaction carries what its last bytes say, a transfer looks
its transaction up, and each figure of a (day, code) is a subquery of its own over those facts.
Constants are stated here on their own, not taken from the code under test.
"""

from __future__ import annotations

import datetime as dt

from checks import params as P

# The trailer's marker, the gas tokens and the rules of the derived sources.
MARKER = "80218021802180218021802180218021"
GAS_TOKENS = {
    "2f25deb3848c207fc8e0c34035b3ba7fc157602b": "ceba9300f2b948710d2653dd7b07f33a8b32118c",
    "0e2a3e05bc9a16f5292a6170456a710cb89c6f72": "48065fbbe25f71c9282ddf5e1cd6d6a887483d5e",
}
USDC_ADAPTER, USDT_ADAPTER = GAS_TOKENS
USDC, USDT = GAS_TOKENS.values()
NATIVE = "471ece3750da237f93b8e339c536989b8978a438"
ZERO = "0" * 40
SELECTOR, DIRECT, UNPRICED, UNUSED = "a9059cbb", "ab" * 20, "cd" * 20, "ef" * 20
CHAIN, OTHER_CHAIN = "celo", "other"
PRICED = [NATIVE, USDC, USDT, DIRECT, UNUSED]

TX_COLS = ["block_time", "block_date", "block_number", "value", "gas_limit", "gas_price", "gas_used",
           "max_fee_per_gas", "max_priority_fee_per_gas", "priority_fee_per_gas", "nonce", '"index"', "success",
           '"from"', '"to"', "block_hash", "hash", "type", "access_list", "chain_id", "fee_currency"]
TA_COLS = ["block_time", "block_date", "block_number", "hash", "value", "gas_limit", "gas_price", "gas_used",
           "max_fee_per_gas", "max_priority_fee_per_gas", "priority_fee_per_gas", "nonce", '"index"', "success",
           '"from"', '"to"', "block_hash", "type", "access_list", "chain_id", "fee_currency",
           "has_builder_code", "multi_code", "builder_code", "builder_code2"]
TR_COLS = ["unique_key", "blockchain", "block_month", "block_date", "block_time", "block_number", "tx_hash",
           "evt_index", "trace_address", "token_standard", "tx_from", "tx_to", "tx_index", '"from"', '"to"',
           "contract_address", "symbol", "amount_raw", "amount", "price_usd", "amount_usd", "_updated_at"]


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def ts(x: dt.datetime) -> str:
    return f"TIMESTAMP '{x.strftime('%Y-%m-%d %H:%M:%S')}'"


def source_ctes() -> str:
    m, p = MARKER, SELECTOR
    tok_rows = ", ".join(f"({o}, '{a}', '{CHAIN}')" for o, a in enumerate(PRICED))
    tok_rows += f", (100, '{NATIVE}', '{OTHER_CHAIN}')"
    return f"""
ev AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value FROM events
),
ev_code AS (
  SELECT *, event_id % 11 AS k,
    CASE WHEN event_id % 11 IN (0, 2, 3) THEN 'app' || CAST(user_id % 20 AS VARCHAR)
         WHEN event_id % 11 = 1 THEN 'minipay,app_' || CAST(user_id % 20 AS VARCHAR)
         WHEN event_id % 11 = 8 THEN ',tail' || CAST(user_id % 3 AS VARCHAR)
         WHEN event_id % 11 = 9 THEN 'a,b,c' END AS code
  FROM ev
),
ev_hex AS (
  SELECT *, lower(hex(code)) AS chex, lower(printf('%02x', strlen(code))) AS clen FROM ev_code
),
tx_src AS (
  SELECT
    ts AS block_time,
    CAST(ts AS DATE) AS block_date,
    event_id AS block_number,
    CAST(ROUND(value * 100) AS DECIMAL(38,0)) AS value,
    CAST(200000 AS BIGINT) AS gas_limit,
    CAST(25000000000 + (event_id % 7) * 1000000000 AS DECIMAL(38,0)) AS gas_price,
    CAST(21000 + event_id % 100000 AS BIGINT) AS gas_used,
    CAST(26000000000 + (event_id % 7) * 1000000000 AS DECIMAL(38,0)) AS max_fee_per_gas,
    CAST(1000000000 AS DECIMAL(38,0)) AS max_priority_fee_per_gas,
    CAST(1000000000 AS DECIMAL(38,0)) AS priority_fee_per_gas,
    event_id % 1000 AS nonce,
    event_id % 50 AS "index",
    event_type <> 'error' AS success,
    substr(sha256('user-' || CAST(user_id AS VARCHAR)), 1, 40) AS "from",
    substr(sha256('to-' || event_type), 1, 40) AS "to",
    sha256('block-' || CAST(event_id AS VARCHAR)) AS block_hash,
    sha256('tx-' || CAST(event_id AS VARCHAR)) AS hash,
    CASE WHEN event_id % 3 = 0 THEN 'legacy' ELSE 'eip1559' END AS type,
    CAST(NULL AS VARCHAR) AS access_list,
    CAST(42220 AS BIGINT) AS chain_id,
    CASE user_id % 6 WHEN 1 THEN '{ZERO}' WHEN 2 THEN '{USDC_ADAPTER}'
         WHEN 3 THEN '{USDT_ADAPTER}' WHEN 4 THEN '{DIRECT}' WHEN 5 THEN '{UNPRICED}' END
      AS fee_currency,
    CASE WHEN k IN (0, 1, 8, 9) THEN '{p}' || chex || clen || '00' || '{m}'
         WHEN k = 2 THEN '{p}' || chex || clen || '00' || 'ff' || '{m[2:]}'
         WHEN k = 3 THEN '{p}' || chex || clen || '01' || '{m}'
         WHEN k = 4 THEN '{p}' || '0000' || '{m}'
         WHEN k = 5 THEN '0000' || '{m}'
         WHEN k = 6 THEN '61ff00' || '{m}'
         WHEN k = 10 THEN '{p}' || repeat('00', 28) END AS data
  FROM ev_hex
),
tr_src AS (
  SELECT
    sha256('tr-' || CAST(event_id AS VARCHAR) || '-' || CAST(i AS VARCHAR)) AS unique_key,
    CASE WHEN i = 1 AND event_id % 5 = 0 THEN '{OTHER_CHAIN}' ELSE '{CHAIN}' END AS blockchain,
    CAST(date_trunc('month', ts) AS DATE) AS block_month,
    CAST(ts AS DATE) AS block_date,
    ts AS block_time,
    event_id AS block_number,
    sha256('tx-' || CAST(event_id AS VARCHAR)) AS tx_hash,
    CAST(i AS BIGINT) AS evt_index,
    CAST(NULL AS VARCHAR) AS trace_address,
    'erc20' AS token_standard,
    substr(sha256('user-' || CAST(user_id AS VARCHAR)), 1, 40) AS tx_from,
    substr(sha256('to-' || event_type), 1, 40) AS tx_to,
    event_id % 50 AS tx_index,
    substr(sha256('src-' || CAST(user_id AS VARCHAR) || '-' || CAST(i AS VARCHAR)), 1, 40) AS "from",
    substr(sha256('dst-' || CAST(event_id % 97 AS VARCHAR)), 1, 40) AS "to",
    CASE i WHEN 0 THEN '{USDC}' WHEN 1 THEN '{USDT}'
           ELSE '{NATIVE}' END AS contract_address,
    CASE i WHEN 0 THEN 'USDC' WHEN 1 THEN 'USDT' ELSE 'CELO' END AS symbol,
    CAST(ROUND(value * (i + 1) * 100) AS DECIMAL(38,0)) AS amount_raw,
    value * (i + 1) AS amount,
    CAST(1.0 AS DOUBLE) AS price_usd,
    CASE WHEN i = 2 THEN NULL ELSE ROUND(value * (i + 1), 2) END AS amount_usd,
    ts AS _updated_at
  FROM ev, (VALUES (0), (1), (2)) AS fan(i)
  WHERE i < event_id % 4
),
pr_days AS (SELECT DISTINCT CAST(ts AS DATE) AS pd FROM ev),
pr_tok(o, addr, chain) AS (VALUES {tok_rows}),
pr_side(delta, hr) AS (VALUES (-0.25, 0), (0.25, 12)),
pr_src AS (
  SELECT chain AS blockchain,
         CAST(pd AS TIMESTAMP) + to_hours(hr) AS "timestamp",
         addr AS contract_address,
         CAST(0.5 + 0.25 * day(pd) + o + delta AS DOUBLE) AS price
  FROM pr_days, pr_tok, pr_side
  WHERE NOT (addr = '{USDT}' AND day(pd) % 3 = 0)
)"""


# -- facts -------------------------------------------------------------------------------


def _seen(until: dt.datetime | None, run: dt.datetime | None, time: str = "block_time") -> str:
    """What had arrived by ``until`` and lies in the look-back of a run at ``run``."""
    out = f" AND {time} <= {ts(until)}" if until else ""
    if run:
        out += f" AND block_date + 1 >= {d(run.date())} AND block_time + INTERVAL 12 HOUR >= {ts(run)}"
    return out


def _above_floors() -> str:
    return f"block_date >= {d(P.FLOORS.date)} AND block_time >= {ts(P.FLOORS.time)}"


def calls(name: str = "calls", until=None, run=None) -> str:
    """Transactions with more than 18 bytes, and what their ends say (read leftwards from the last byte).

    ``said``: the comma-separated parts of the code, null without a valid trailer.
    """
    return f"""{name} AS (
  SELECT *, said IS NOT NULL AS has_builder_code, array_to_string(said, ',') AS multi_code,
         said[1] AS builder_code, CASE WHEN said[2] <> '' THEN said[2] END AS builder_code2
  FROM (
    SELECT *, CASE WHEN ending = '00{MARKER}' AND code_len > 0 AND strlen(calldata) >= 2 * code_len + 36
                   THEN string_split(decode(unhex(left(right(calldata, 2 * code_len + 36), 2 * code_len))), ',') END AS said
    FROM (
      SELECT * EXCLUDE (data), data AS calldata, CAST(strlen(data) / 2 AS INTEGER) AS calldata_len,
             right(data, 34) AS ending, CAST('0x' || left(right(data, 36), 2) AS BIGINT) AS code_len
      FROM tx_src WHERE strlen(data) >= 38 AND {_above_floors()}{_seen(until, run)})))"""


def moves(name: str = "moves", of: str = "calls", until=None, run=None, chain: str = CHAIN) -> str:
    """Transfers of a chain; ``a``: the attribution of their transaction, looked up row by row."""
    return f"""{name} AS (
  SELECT *, (SELECT any_value({{'f': c.has_builder_code, 'm': c.multi_code, 'one': c.builder_code, 'two': c.builder_code2}})
             FROM {of} c WHERE c.hash = s.tx_hash AND c.block_date >= {d(P.FLOORS.date)}{_seen(None, run).replace("block_", "c.block_")}) AS a
  FROM (SELECT * FROM tr_src WHERE blockchain = '{chain}' AND {_above_floors()}{_seen(until, run)}) s)"""


ATTRIBUTION = "coalesce(a.f, false) AS has_builder_code, a.m AS multi_code, a.one AS builder_code, a.two AS builder_code2"
#: The second code where there is one.
TX_CODE = "ifnull(builder_code2, builder_code)"
MOVE_CODE = "ifnull(nullif(a.two, ''), a.one)"


def paid(name: str = "paid", of: str = "calls") -> str:
    """Tagged transactions: day, code, fee in gas tokens and the token whose price counts."""
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in GAS_TOKENS.items())
    return f"""{name} AS (
  SELECT CAST(block_time AS DATE) AS day, {TX_CODE} AS code, hash, "from" AS sender,
         CAST(gas_used AS DOUBLE) * CAST(gas_price AS DOUBLE) / 1e18 AS fee,
         coalesce(MAP {{{pairs}}}[fee_currency], nullif(fee_currency, '{ZERO}'), '{NATIVE}') AS token
  FROM {of} WHERE has_builder_code)"""


def usd(token: str, day: str) -> str:
    """Mean price of a token on a day, null if it has none."""
    return (f"(SELECT avg(q.price) FROM pr_src q WHERE q.blockchain = '{CHAIN}' AND q.\"timestamp\" >= {ts(P.FLOORS.price_time)} "
            f"AND q.contract_address = {token} AND CAST(q.\"timestamp\" AS DATE) = {day})")


def daily(name: str = "days", tx: str = "paid", tr: str = "moves") -> str:
    """One row for each day and code with a tagged transaction; every figure by itself."""
    return f"""priced AS (SELECT *, fee * coalesce({usd('token', 'day')}, 0) AS usd FROM {tx}),
sent AS (SELECT CAST(block_time AS DATE) AS day, {MOVE_CODE} AS code, amount_usd, tx_hash FROM {tr} WHERE a.one IS NOT NULL),
{name} AS (
  SELECT k.day, k.code AS builder_code,
         coalesce((SELECT sum(x.amount_usd) FROM sent x WHERE x.day = k.day AND x.code = k.code), 0) AS volume_usd,
         (SELECT count(DISTINCT x.hash) FROM {tx} x WHERE x.day = k.day AND x.code = k.code) AS tx_count,
         (SELECT count(DISTINCT x.tx_hash) FROM sent x WHERE x.day = k.day AND x.code = k.code) AS token_transfers_tx,
         (SELECT count(DISTINCT x.sender) FROM {tx} x WHERE x.day = k.day AND x.code = k.code) AS unique_addresses,
         (SELECT sum(x.usd) FROM priced x WHERE x.day = k.day AND x.code = k.code) AS chain_fees_usd
  FROM (SELECT DISTINCT day, code FROM {tx}) k)"""


def with_models(*facts: str, body: str) -> str:
    return "WITH " + ",\n".join([source_ctes(), *facts]) + "\n" + body


def days_out(source: str = "days") -> str:
    return (f"SELECT day, builder_code, ROUND(volume_usd, {P.ROUND_USD}) AS volume_usd, tx_count, token_transfers_tx, "
            f"unique_addresses, ROUND(chain_fees_usd, {P.ROUND_FEE}) AS chain_fees_usd FROM {source}")


CALLS, MOVES, PAID, DAYS = calls(), moves(), paid(), daily()
TX_OUT = ", ".join(TA_COLS)
TR_ALL = ", ".join(TR_COLS)
TR_OUT = f"{TR_ALL}, {ATTRIBUTION}"

SQL: dict[str, str] = {
    "tx_select": with_models(CALLS, body=f"SELECT {', '.join(TX_COLS)}, calldata, calldata_len FROM calls"),
    "trailer_fields": with_models(CALLS, body=(
        "SELECT hash, calldata_len, right(ending, 32) AS tail_marker, left(ending, 2) AS schema_id, code_len FROM calls")),
    "trailer_decode": with_models(CALLS, body="SELECT hash, code_len, multi_code FROM calls"),
    "tx_attributed": with_models(CALLS, body=f"SELECT {TX_OUT} FROM calls"),
    "flag_counts": with_models(CALLS, body="SELECT has_builder_code, COUNT(*) AS n FROM calls GROUP BY ALL"),
    "model_counts": with_models(CALLS, MOVES, body=(
        "SELECT 'transactions_attributed' AS model, (SELECT COUNT(*) FROM calls) AS n "
        "UNION ALL SELECT 'transfers_attributed', (SELECT COUNT(*) FROM moves)")),
    "transfers_select": with_models(CALLS, MOVES, body=f"SELECT {TR_ALL} FROM moves"),
    "transfers_attributed": with_models(CALLS, MOVES, body=f"SELECT {TR_OUT} FROM moves"),
    "effective_code": with_models(CALLS, MOVES, body=(
        f"SELECT CAST(block_time AS DATE) AS day, tx_hash, {MOVE_CODE} AS builder_code, amount_usd FROM moves WHERE a.one IS NOT NULL")),
    "transfer_metrics": with_models(CALLS, MOVES, PAID, DAYS, body=(
        f"SELECT day, code AS builder_code, ROUND(SUM(amount_usd), {P.ROUND_USD}) AS volume_usd, "
        "COUNT(DISTINCT tx_hash) AS token_transfers_tx FROM sent GROUP BY ALL")),
    "tx_metrics": with_models(CALLS, PAID, body=(
        "SELECT day, code AS builder_code, COUNT(DISTINCT hash) AS tx_count, COUNT(DISTINCT sender) AS unique_addresses FROM paid GROUP BY ALL")),
    "tx_fees": with_models(CALLS, PAID, body=(
        "SELECT day, code AS builder_code, hash AS tx_hash, fee AS fee_token_amount, token AS price_address FROM paid")),
    "price_semi_join": with_models(CALLS, PAID, body=(
        f"SELECT blockchain, \"timestamp\", contract_address, price FROM pr_src WHERE blockchain = '{CHAIN}' "
        f"AND \"timestamp\" >= {ts(P.FLOORS.price_time)} AND EXISTS (SELECT 1 FROM paid WHERE token = contract_address)")),
    "token_prices": with_models(CALLS, PAID, body=(
        f"SELECT day, token AS contract_address, {usd('token', 'day')} AS price FROM ("
        f"SELECT DISTINCT CAST(\"timestamp\" AS DATE) AS day, contract_address AS token FROM pr_src WHERE blockchain = '{CHAIN}' "
        f"AND \"timestamp\" >= {ts(P.FLOORS.price_time)} AND contract_address IN (SELECT paid.token FROM paid))")),
    "fee_metrics": with_models(CALLS, MOVES, PAID, DAYS, body=(
        f"SELECT day, code AS builder_code, ROUND(SUM(usd), {P.ROUND_FEE}) AS chain_fees_usd FROM priced GROUP BY ALL")),
    "daily_metrics": with_models(CALLS, MOVES, PAID, DAYS, body=days_out()),
}

# -- runs that end in a whole table ----------------------------------------------------------

SQL["incremental_window"] = with_models(calls("calls", P.AS_OF_NEXT, P.AS_OF_NEXT), body=f"SELECT {TX_OUT} FROM calls")
for _name in ("upsert_delete_insert", "upsert_target_days", "upsert_key_lookup", "full_refresh", "full_refresh_switch", "stream_attributed", "stream_dedup", "stream_dedup_state", "stream_restart"):
    SQL[_name] = SQL["tx_attributed"]
for _name in ("upsert_merge", "transfers_attributed_tagged", "transfers_attributed_bucketed"):
    SQL[_name] = SQL["transfers_attributed"]
for _name in ("daily_recompute", "stream_daily", "daily_replace_days", "daily_partials"):
    SQL[_name] = SQL["daily_metrics"]

SQL["append_once"] = SQL["transfers_select"]
# A restated day is sent again, an emptied one is deleted.
SQL["export_changes"] = with_models(CALLS, body=(
    f"SELECT hash, block_date, CASE WHEN block_date = {d(P.EMPTIED_DAY)} THEN NULL WHEN block_date = {d(P.RESTATED_DAY)} THEN 2 * gas_used ELSE gas_used END AS gas_used, "
    f"CASE WHEN block_date = {d(P.EMPTIED_DAY)} THEN 'delete' WHEN block_date = {d(P.RESTATED_DAY)} THEN 'upsert' END AS op FROM calls"))
# Rows above the first run's instant came in restated batches only.
SQL["append_dedup"] = with_models(CALLS, MOVES, body=(
    f"SELECT {TR_ALL} FROM (SELECT * REPLACE (CASE WHEN late THEN _updated_at + INTERVAL 1 HOUR ELSE _updated_at END AS _updated_at, "
    f"CASE WHEN late THEN 2 * amount_usd ELSE amount_usd END AS amount_usd) FROM (SELECT *, block_time > {ts(P.AS_OF_FIRST)} AS late FROM moves))"))
# Old rows outside the predicate stay beside the ones that both later runs insert.
SQL["upsert_target_predicate"] = with_models(CALLS, body=(
    f"SELECT {TX_OUT} FROM calls, (VALUES (1), (2), (3)) AS copy(i) WHERE i = 1 OR (block_date + 1 >= {d(P.AS_OF_NEXT.date())} "
    f"AND block_time + INTERVAL 12 HOUR >= {ts(P.AS_OF_NEXT)} AND block_time < {ts(P.AS_OF_FIRST)})"))
# A day whose rows moved to the next day, and a day whose rows were restated.
SQL["upsert_changed_rows"] = with_models(CALLS, body=(
    f"SELECT {TX_OUT} FROM (SELECT * REPLACE (block_time + to_days(moved) AS block_time, CAST(block_date + moved AS DATE) AS block_date, "
    f"CASE WHEN restated THEN 2 * gas_used ELSE gas_used END AS gas_used) FROM (SELECT *, CASE WHEN block_date = {d(P.MOVED_DAY)} THEN 1 ELSE 0 END AS moved, "
    f"block_date = {d(P.RESTATED_DAY)} AS restated FROM calls))"))
SQL["compaction"] = with_models(CALLS, body=(
    "SELECT block_date, COUNT(*) AS n, CAST(SUM(block_number) AS BIGINT) AS numbers, COUNT(DISTINCT hash) AS hashes, "
    "true AS one_file, true AS settled FROM calls GROUP BY block_date"))
SQL["compaction_clustered"] = with_models(CALLS, body=(
    "SELECT block_date, COUNT(*) AS n, CAST(SUM(block_number) AS BIGINT) AS numbers, COUNT(DISTINCT hash) AS hashes, "
    f"true AS clustered, true AS settled, block_date = {d(dt.date(2024, 1, 12))} AS due_again FROM calls GROUP BY block_date"))
_LATE = f"""late AS (SELECT *, block_number % 11 = 0 AS twice FROM calls WHERE block_date >= {d(dt.date(2024, 1, 20))})"""
_RULE = "SELECT 'transactions_attributed' AS model, '{}' AS rule, '{}' AS column, CAST(({}) AS BIGINT) AS failing_rows"
SQL["dq_written"] = with_models(CALLS, _LATE, body=" UNION ALL ".join(
    [_RULE.format("rows", "*", "SELECT COUNT(*) + COUNT(*) FILTER (twice) FROM late"),
     # the repeated rows keep their sender
     _RULE.format("not_null", "from", 'SELECT COUNT(*) FILTER (block_number % 7 = 0) + COUNT(*) FILTER ("from" IS NULL AND block_number % 7 <> 0) '
                  '+ COUNT(*) FILTER ("from" IS NULL AND twice) FROM late')]
    + [_RULE.format("not_null", c, f"SELECT COUNT(*) FILTER ({c} IS NULL) + COUNT(*) FILTER ({c} IS NULL AND twice) FROM late")
       for c in ("block_time", "block_date", "block_number", "hash", "has_builder_code")]
    + [_RULE.format(rule, "hash", "SELECT COUNT(*) FROM (SELECT hash FROM late GROUP BY hash HAVING COUNT(*) + COUNT(*) FILTER (twice) > 1)")
       for rule in ("unique", "unique_combination_of_columns")]))
SQL["daily_replace_days"] = with_models(
    calls("every"), f"calls AS (SELECT * FROM every WHERE block_date <> {d(P.EMPTIED_DAY)})", MOVES, PAID, DAYS, body=days_out())
SQL["spot_check"] = with_models(CALLS, body=f"SELECT {P.SPOT_ROWS} AS n, COUNT(*) AS columns, true AS stored FROM (DESCRIBE SELECT {TX_OUT} FROM calls)")

_J0, _J1 = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
SQL["hash_date_inner_join"] = with_models(CALLS, MOVES, body=(
    "SELECT t.unique_key, t.tx_hash, t.block_date, c.has_builder_code, c.builder_code, t.amount_usd "
    f"FROM moves t, calls c WHERE c.hash = t.tx_hash AND c.block_date = t.block_date AND c.block_date BETWEEN {d(_J0)} AND {d(_J1)}"))
SQL["union_tagged"] = with_models(body=(
    f"SELECT blockchain AS chain_tag, unique_key, block_date, amount_usd FROM tr_src WHERE {_above_floors()}"))
SQL["surrogate_key"] = with_models(CALLS, MOVES, body=(
    "SELECT unique_key, sha256(concat_ws('-', coalesce(tx_hash, '_null_'), "
    "coalesce(CAST(evt_index AS VARCHAR), '_null_'), coalesce(a.two, '_null_'))) AS sk FROM moves"))
SQL["top_codes"] = with_models(CALLS, MOVES, PAID, DAYS, body=(
    f"SELECT builder_code, ROUND(v, {P.ROUND_USD}) AS volume_usd, t AS tx_count, ROUND(f, {P.ROUND_FEE}) AS chain_fees_usd FROM ("
    "SELECT builder_code, SUM(volume_usd) AS v, CAST(SUM(tx_count) AS BIGINT) AS t, SUM(chain_fees_usd) AS f FROM days GROUP BY ALL) "
    f"QUALIFY row_number() OVER (ORDER BY v DESC, builder_code) <= {P.TOP_K}"))

# -- quality ---------------------------------------------------------------------------------

MODELS = (CALLS, MOVES, PAID, DAYS,
          f"ta AS (SELECT {TX_OUT} FROM calls)", f"tra AS (SELECT {TR_OUT} FROM moves)")


def _nn(model: str, rel: str, cols: list[str]) -> list[str]:
    return [f"SELECT '{model}' AS model, 'not_null' AS rule, '{c.strip(chr(34))}' AS \"column\", "
            f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failing_rows FROM {rel}" for c in cols]


def _cnt(model: str, rule: str, column: str, query: str) -> str:
    return (f"SELECT '{model}' AS model, '{rule}' AS rule, '{column}' AS \"column\", "
            f"CAST(COUNT(*) AS BIGINT) AS failing_rows FROM ({query})")


SQL["dq_not_null"] = with_models(*MODELS, body=" UNION ALL ".join(
    _nn("transactions_attributed", "ta", ["block_time", "block_date", "block_number", "hash", '"from"',
                                          "has_builder_code"])
    + _nn("transfers_attributed", "tra", ["unique_key", "blockchain", "block_date", "block_time", "block_number",
                                          "tx_hash", "has_builder_code"])
    + _nn("buildercode_daily_metric", "days", ["day", "builder_code"])
    + _nn("transfers", "moves", ["amount_usd"])))
SQL["dq_unique"] = with_models(*MODELS, body=" UNION ALL ".join([
    _cnt("events", "unique", "event_id",
         "SELECT event_id FROM events WHERE event_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1"),
    _cnt("orders", "unique", "o_custkey",
         "SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1"),
    _cnt("transactions_attributed", "unique", "hash",
         "SELECT hash FROM ta WHERE hash IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1"),
    _cnt("transfers_attributed", "unique", "unique_key",
         "SELECT unique_key FROM tra WHERE unique_key IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1"),
]))
_UC = "unique_combination_of_columns"
SQL["dq_unique_combination"] = with_models(*MODELS, body=" UNION ALL ".join([
    _cnt("lineitem", _UC, "l_orderkey,l_linenumber",
         "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"),
    _cnt("transfers", _UC, "tx_hash,evt_index",
         "SELECT tx_hash, evt_index FROM tr_src GROUP BY 1, 2 HAVING COUNT(*) > 1"),
    _cnt("buildercode_daily_metric", _UC, "day,builder_code",
         "SELECT day, builder_code FROM days GROUP BY 1, 2 HAVING COUNT(*) > 1"),
]))
SQL["dq_accepted_values"] = with_models(*MODELS, body=" UNION ALL ".join([
    _cnt("orders", "accepted_values", "o_orderstatus:F,O,P",
         "SELECT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL "
         "AND o_orderstatus NOT IN ('F', 'O', 'P') GROUP BY 1"),
    _cnt("orders", "accepted_values", "o_orderstatus:F,O",
         "SELECT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL "
         "AND o_orderstatus NOT IN ('F', 'O') GROUP BY 1"),
    _cnt("transfers_attributed", "accepted_values", "blockchain:celo",
         "SELECT blockchain FROM tra WHERE blockchain IS NOT NULL AND blockchain NOT IN ('celo') GROUP BY 1"),
]))
SQL["dq_relationships"] = with_models(*MODELS, body=" UNION ALL ".join([
    _cnt("nation", "relationships", "n_regionkey->region.r_regionkey",
         "SELECT * FROM nation c WHERE n_regionkey IS NOT NULL AND NOT EXISTS "
         "(SELECT 1 FROM region p WHERE p.r_regionkey = c.n_regionkey)"),
    _cnt("transfers", "relationships", "tx_hash->transactions_attributed.hash",
         "SELECT * FROM moves c WHERE tx_hash IS NOT NULL AND NOT EXISTS "
         "(SELECT 1 FROM ta p WHERE p.hash = c.tx_hash)"),
]))
SQL["dq_invariants"] = with_models(*MODELS, body=" UNION ALL ".join([
    _cnt("transactions_attributed", "invariant", "flag_codes",
         "SELECT * FROM ta WHERE has_builder_code IS NULL OR has_builder_code <> (multi_code IS NOT NULL) "
         "OR (NOT has_builder_code AND (builder_code IS NOT NULL OR builder_code2 IS NOT NULL))"),
    _cnt("transfers_attributed", "invariant", "flag_codes_chain",
         f"SELECT * FROM tra WHERE has_builder_code IS NULL OR blockchain <> '{P.CHAIN}' "
         "OR (NOT has_builder_code AND (multi_code IS NOT NULL OR builder_code IS NOT NULL "
         "OR builder_code2 IS NOT NULL))"),
    _cnt("buildercode_daily_metric", "invariant", "counts_bounded",
         "SELECT * FROM days WHERE token_transfers_tx > tx_count OR unique_addresses > tx_count"),
    _cnt("buildercode_daily_metric", "custom", "non_negative_fees", "SELECT * FROM days WHERE chain_fees_usd < 0"),
]))

# -- export: a first run, an incremental one, and a re-sync of the second window after rows vanished ---

_S1, _E1 = P.EXPORT_START, P.EXPORT_END
_E2 = P.EXPORT_END + dt.timedelta(days=2)
_S2 = _E2 - dt.timedelta(days=1)
_E3 = _E2 + dt.timedelta(days=1)
_GONE = f"block_time >= {ts(_S2)} AND block_time < {ts(_S2 + dt.timedelta(hours=6))}"
_W1 = f"block_time >= {ts(_S1)} AND block_time < {ts(_E1)}"
_W2 = f"block_time >= {ts(_S2)} AND block_time < {ts(_E2)}"
_W3 = f"{_W2} AND NOT ({_GONE})"
SQL["export_window"] = with_models(CALLS, body=(
    f"SELECT hash, block_time, block_date, has_builder_code, builder_code FROM calls WHERE ({_W1}) OR ({_W2})"))


def _run_row(table: str, column: str, key: str, start, end, full: bool, rows: str, created) -> str:
    return (f"SELECT '{table}' AS source_table, '{column}' AS time_column, '{key}' AS unique_key_columns, "
            f"{ts(start) if start else 'CAST(NULL AS TIMESTAMP)'} AS time_start, {ts(end)} AS time_end, "
            f"{'true' if full else 'false'} AS full_refresh, (SELECT CAST(COUNT(*) AS BIGINT) FROM {rows}) AS rows_synced, {ts(created)} AS created_at")


_T = ("transactions_attributed", "block_time", "hash")
SQL["export_runs"] = with_models(CALLS, MOVES, PAID, DAYS, body=" UNION ALL ".join([
    _run_row(*_T, _S1, _E1, True, f"calls WHERE {_W1}", _E1), _run_row(*_T, _S2, _E2, False, f"calls WHERE {_W2}", _E2),
    _run_row(*_T, _S2, _E2, False, f"calls WHERE {_W3}", _E3),
    _run_row("buildercode_daily_metric", "day", "day,builder_code", None, _E2, True, f"days WHERE day < {ts(_E2)}", _E2)]))
SQL["export_log_latest"] = with_models(CALLS, body=_run_row(*_T, _S2, _E2, False, f"calls WHERE {_W3}", _E3))

SQL["view_spot_check"] = with_models(CALLS, MOVES, body=(
    "SELECT 'transactions' AS model, has_builder_code, COUNT(*) AS n FROM calls GROUP BY ALL "
    "UNION ALL SELECT 'transfers' AS model, coalesce(a.f, false) AS has_builder_code, COUNT(*) AS n FROM moves GROUP BY ALL"))
SQL["address_left_join"] = with_models(CALLS, (
    "users AS (SELECT substr(sha256('user-' || CAST(user_id AS VARCHAR)), 1, 40) AS address, "
    "MIN(ts) AS first_seen, COUNT(*) AS n_events FROM ev GROUP BY user_id)"), body=(
    'SELECT t.hash, t."from", t.block_time, t.builder_code, u.first_seen, u.n_events '
    'FROM calls t LEFT JOIN users u ON t."from" = u.address'))
