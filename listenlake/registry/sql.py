"""SQL fragments shared by the oracle queries."""

from __future__ import annotations


def _rounded(expr: str, digits: int) -> str:
    # half-up on the digits a double is printed with, as Spark rounds doubles
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def r2(expr: str) -> str:
    return _rounded(expr, 2)


def r3(expr: str) -> str:
    return _rounded(expr, 3)


def hash_steps(source: str, key: str, prefix: str = "h") -> str:
    """CTEs that end in ``<prefix>_out(key, hash)``: Spark's ``hash`` of a 64-bit integer.

    Murmur3, 32-bit, seed 42, over the low and the high word, with unsigned 64-bit arithmetic.
    """

    def rotl(x: str, bits: int) -> str:
        return f"(({x} * {2**bits}) % 4294967296 + {x} // {2 ** (32 - bits)})"

    def mixed(word: str) -> str:
        k = f"(({word} * 3432918353::UBIGINT) % 4294967296)"
        return f"(({rotl(k, 15)} * 461845907::UBIGINT) % 4294967296)"

    def step(h: str, k: str) -> str:
        x = f"xor({h}, {k})"
        return f"(({rotl(x, 13)} * 5 + 3864292196::UBIGINT) % 4294967296)"

    p = prefix
    return f"""{p}_0 AS (
  SELECT DISTINCT {key} AS key, ({key} & 4294967295)::UBIGINT AS low,
         (({key} >> 32) & 4294967295)::UBIGINT AS high FROM {source}),
{p}_1 AS (SELECT key, high, {mixed('low')} AS k1, {mixed('high')} AS k2 FROM {p}_0),
{p}_2 AS (SELECT key, k2, {step('42::UBIGINT', 'k1')} AS h FROM {p}_1),
{p}_3 AS (SELECT key, {step('h', 'k2')} AS h FROM {p}_2),
{p}_4 AS (SELECT key, xor(h, 8::UBIGINT) AS h FROM {p}_3),
{p}_5 AS (SELECT key, (xor(h, h // 65536) * 2246822507::UBIGINT) % 4294967296 AS h FROM {p}_4),
{p}_6 AS (SELECT key, (xor(h, h // 8192) * 3266489909::UBIGINT) % 4294967296 AS h FROM {p}_5),
{p}_7 AS (SELECT key, xor(h, h // 65536) AS h FROM {p}_6),
{p}_out AS (SELECT key, CAST(CASE WHEN h >= 2147483648 THEN h::BIGINT - 4294967296
                             ELSE h::BIGINT END AS INTEGER) AS hash FROM {p}_7)"""


def date_key(ts: str) -> str:
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS INTEGER)"


LINES = f"""lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS stream_id, o_custkey AS user_id,
         l_partkey AS track_id, {date_key('l_shipdate')} AS date_key,
         CAST(l_quantity AS INTEGER) - 1 AS listen_duration, l_returnflag AS device_type,
         l_shipdate AS stream_timestamp, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

NATIONS = """nations AS (
  SELECT n_nationkey, n_name AS country, r_name AS genre
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

STAR = f"""{LINES},
{NATIONS},
{hash_steps('supplier', 's_suppkey')},
users AS (
  SELECT c_custkey + 1 AS user_sk, c_custkey AS user_id, c_name AS user_name, country,
         c_mktsegment AS subscription_type
  FROM customer LEFT JOIN nations ON c_nationkey = n_nationkey),
artists AS (
  SELECT s_suppkey AS artist_id, hash AS artist_sk, s_name AS artist_name, genre, country
  FROM supplier LEFT JOIN nations ON s_nationkey = n_nationkey JOIN h_out ON key = s_suppkey),
tracks AS (
  SELECT p_partkey AS track_id, p_partkey AS track_sk, p_name AS track_name,
         p_brand AS album_name, p_partkey % (SELECT count(*) FROM supplier) AS artist_id,
         p_size AS duration_sec
  FROM part),
dates AS (
  SELECT DISTINCT {date_key('l_shipdate')} AS date_key, CAST(l_shipdate AS DATE) AS date,
         CAST(day(l_shipdate) AS INTEGER) AS day, CAST(month(l_shipdate) AS INTEGER) AS month,
         CAST(year(l_shipdate) AS INTEGER) AS year, dayname(l_shipdate) AS weekday
  FROM lineitem),
catalogue AS (
  SELECT tracks.track_id AS known_track, track_sk, track_name, album_name, duration_sec,
         0.2 * duration_sec AS meaningful_from, 0.5 * duration_sec AS completed_from,
         artists.artist_id, artist_sk, artist_name, genre, artists.country AS artist_country
  FROM tracks LEFT JOIN artists USING (artist_id)),
calendar AS (SELECT date_key AS known_day, * EXCLUDE (date_key) FROM dates),
base AS (
  SELECT stream_id, user_sk, track_sk, artist_sk, user_id, known_track AS track_id, artist_id,
         listen_duration, duration_sec,
         coalesce(listen_duration >= meaningful_from, false)::INTEGER AS is_meaningful_play,
         CASE WHEN nullif(listen_duration, 0) IS NULL THEN 'Abandoned'
              WHEN listen_duration < meaningful_from THEN 'Skipped'
              WHEN listen_duration < completed_from THEN 'partial'
              ELSE 'Completed' END AS play_category,
         user_name, country AS user_country, subscription_type, device_type, track_name, album_name,
         artist_name, genre, artist_country, known_day AS date_key, date, day, month, year, weekday
  FROM lines LEFT JOIN users USING (user_id)
       LEFT JOIN catalogue ON known_track = lines.track_id
       LEFT JOIN calendar ON known_day = lines.date_key)"""
