"""The same results as SQL text for DuckDB, by query name."""

from __future__ import annotations

_SONGPLAYS = r"""
        SELECT md5(event_id || '|' || user_id || '|' || (epoch_us(ts) // 1000) || '|0') AS songplay_id,
        epoch_ms(epoch_us(ts) // 1000) AS start_time,
        CAST(user_id AS VARCHAR) AS user_id,
        CASE WHEN value > 50 THEN 'paid' ELSE 'free' END AS level,
        song_id, played.p_brand AS artist_id, event_id AS session_id,
        CAST(extract(month FROM ts) AS INT) AS month
        FROM events
        JOIN part AS played ON user_id = played.p_partkey
        JOIN (
            SELECT p_name, p_brand, round(p_retailprice, 3) AS price,
            min(CAST(p_partkey AS VARCHAR)) AS song_id
            FROM part
            GROUP BY 1, 2, 3
        ) catalogue ON played.p_name = catalogue.p_name AND played.p_brand = catalogue.p_brand
        AND round(played.p_retailprice, 3) = price
        WHERE event_type = 'purchase'
    """

ORACLES: dict[str, str] = {
    "filter_project": r"""
        SELECT event_id, user_id, ts AS start_time, value
        FROM events
        WHERE event_type = 'purchase'
    """,
    "filter_not_null": r"""
        SELECT doc_id, lang
        FROM documents
        WHERE lang IS NOT NULL AND n_chars <> 0
    """,
    "dim_distinct": r"""
        SELECT DISTINCT user_id, event_type
        FROM events
        WHERE event_type IN ('purchase','view')
    """,
    "dim_key_dedupe": r"""
        SELECT p_name, p_brand, p_partkey
        FROM (
            SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn
            FROM part
        )
        WHERE rn = 1
    """,
    "dim_user_latest": r"""
        SELECT user_id, event_type, value
        FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM events
        )
        WHERE rn = 1
    """,
    "dim_user_first_seen": r"""
        SELECT user_id, event_type
        FROM (
            SELECT user_id, last(event_type) OVER (PARTITION BY user_id ORDER BY ts DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_type,
            row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn
            FROM events
        )
        WHERE rn = 1
    """,
    "dim_time": r"""
        SELECT start_time, CAST(extract(hour FROM start_time) AS INT) AS hour, CAST(extract(day FROM start_time) AS INT) AS day,
        CAST(extract(week FROM start_time) AS INT) AS week, CAST(extract(month FROM start_time) AS INT) AS month,
        CAST(extract(year FROM start_time) AS INT) AS year, CAST(extract(isodow FROM start_time) - 1 AS INT) AS weekday
        FROM (
            SELECT DISTINCT date_trunc('second', ts) AS start_time
            FROM events
        )
    """,
    "dim_time_sunday0": r"""
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(extract(dow FROM o_orderdate) AS INT) AS dayofweek
        FROM orders
    """,
    "epoch_ms_to_second": r"""
        SELECT event_id, epoch_us(ts) // 1000000 AS start_time
        FROM events
    """,
    "dim_date": r"""
        SELECT DISTINCT CAST(strftime(o_orderdate,'%Y%m%d') AS INT) AS d_datekey, CAST(extract(year FROM o_orderdate) AS INT) AS d_year,
        CAST(strftime(o_orderdate,'%Y%m') AS INT) AS d_yearmonthnum, strftime(o_orderdate,'%b%Y') AS d_yearmonth,
        CAST(extract(doy FROM o_orderdate) AS INT) AS d_daynuminyear
        FROM orders
    """,
    "fact_enrich_title": r"""
        SELECT e.l_orderkey, e.l_linenumber, s.p_partkey
        FROM (
            SELECT l_orderkey, l_linenumber, l_suppkey, p_name AS song, p_brand AS artist,
            p_retailprice AS length
            FROM lineitem
            JOIN part ON l_partkey = p_partkey
            WHERE l_returnflag = 'R'
        ) e
        JOIN (
            SELECT min(p_partkey) AS p_partkey, p_name
            FROM (
                SELECT p_partkey, p_name, p_brand, p_retailprice
                FROM part
                WHERE p_size <= 25
            )
            GROUP BY p_name
        ) s ON e.song = s.p_name
    """,
    "fact_enrich_title_artist": r"""
        SELECT e.l_orderkey, e.l_linenumber, s.p_partkey
        FROM (
            SELECT l_orderkey, l_linenumber, l_suppkey, p_name AS song, p_brand AS artist,
            p_retailprice AS length
            FROM lineitem
            JOIN part ON l_partkey = p_partkey
            WHERE l_returnflag = 'R'
        ) e
        JOIN (
            SELECT min(p_partkey) AS p_partkey, p_name, p_brand
            FROM part
            WHERE p_size <= 25
            GROUP BY p_name, p_brand
        ) s ON e.song = s.p_name AND e.artist = s.p_brand
    """,
    "fact_enrich_left": r"""
        SELECT md5(CAST(e.l_orderkey AS VARCHAR) || '|' || CAST(e.l_linenumber AS VARCHAR)) AS play_id,
        e.l_orderkey, s.p_partkey
        FROM (
            SELECT l_orderkey, l_linenumber, l_suppkey, p_name AS song, p_brand AS artist,
            p_retailprice AS length
            FROM lineitem
            JOIN part ON l_partkey = p_partkey
            WHERE l_returnflag = 'R'
        ) e
        LEFT JOIN (
            SELECT p_partkey, p_name, p_brand, p_retailprice
            FROM part
            WHERE p_size <= 25
        ) s ON e.song = s.p_name AND e.artist = s.p_brand AND e.length = s.p_retailprice
    """,
    "fact_enrich_one_match": r"""
        SELECT e.event_id, s.p_partkey
        FROM (
            SELECT event_id, 'Brand#' || CAST(user_id % 30 AS VARCHAR) AS brand
            FROM events
        ) e
        LEFT JOIN (
            SELECT p_brand, min(p_partkey) AS p_partkey
            FROM part
            GROUP BY p_brand
        ) s ON e.brand = s.p_brand
    """,
    "star_report": r"""
        SELECT p_name, s_name, concat(c_name, ' ', c_mktsegment) AS who
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN customer ON o_custkey = c_custkey
    """,
    "top_groups_with_ties": r"""
        WITH g AS (
            SELECT user_id, count(1) AS n
            FROM events
            GROUP BY user_id
        ) SELECT n AS num, CAST(user_id AS VARCHAR) AS member
        FROM g
        WHERE n IN (SELECT DISTINCT n FROM g ORDER BY n DESC LIMIT 10)
    """,
    "top_n_join": r"""
        SELECT s_name, p_name, l_extendedprice
        FROM lineitem
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN part ON l_partkey = p_partkey
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey
        LIMIT 10
    """,
    "monthly_revenue": r"""
        SELECT CAST(extract(year FROM o_orderdate) AS INT) AS y, CAST(extract(month FROM o_orderdate) AS INT) AS m,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM orders
        GROUP BY 1, 2
    """,
    "star_one_dim": r"""
        SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS revenue
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        WHERE extract(year FROM o_orderdate) = 1997 AND l_discount BETWEEN 0.01 AND 0.03 AND l_quantity < 24
    """,
    "star_two_dim": r"""
        SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS revenue, CAST(extract(year FROM o_orderdate) AS INT) AS d_year,
        p_brand
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE p_type = 'PROMO' AND r_name = 'AMERICA'
        GROUP BY 2, 3
    """,
    "star_drill": r"""
        SELECT cn.n_name AS c_nation, sn.n_name AS s_nation, CAST(extract(year FROM o_orderdate) AS INT) AS d_year,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS revenue
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation cn ON c_nationkey = cn.n_nationkey
        JOIN nation sn ON s_nationkey = sn.n_nationkey
        WHERE (cn.n_name = 'NATION_1' OR cn.n_name = 'NATION_5') AND (sn.n_name = 'NATION_1' OR sn.n_name = 'NATION_5') AND extract(year FROM o_orderdate) = 1997
        GROUP BY 1, 2, 3
        ORDER BY d_year ASC, revenue DESC
    """,
    "star_by_date": r"""
        SELECT o_orderdate, CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS revenue
        FROM lineitem
        JOIN part ON l_partkey = p_partkey
        JOIN orders ON l_orderkey = o_orderkey
        GROUP BY o_orderdate
        ORDER BY o_orderdate
    """,
    "fact_summary": r"""
        SELECT l_suppkey, max(l_quantity) AS max_l_quantity, min(l_quantity) AS min_l_quantity,
        round(avg(l_quantity), 6) AS average_l_quantity
        FROM lineitem
        GROUP BY l_suppkey
    """,
    "word_count": r"""
        SELECT word, count(*) AS "count"
        FROM (
            SELECT unnest(regexp_split_to_array(p_name, '\s+')) AS word
            FROM part
        )
        GROUP BY word
    """,
    "log_parse_hosts": r"""
        SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS n
        FROM pages
        GROUP BY 1
    """,
    "log_parse_typed_top": r"""
        SELECT page_id, CAST(regexp_extract(url, '/([0-9]+)([?#]|$)', 1) AS INT) AS num
        FROM pages
        WHERE regexp_matches(url, '/[0-9]+([?#]|$)')
        ORDER BY num DESC, page_id
        LIMIT 10
    """,
    "map_field": r"""
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k
        FROM events
    """,
    "struct_field": r"""
        SELECT conv_id, role
        FROM conversations
    """,
    "tag_filter_count": r"""
        SELECT word, count(*) AS n
        FROM (
            SELECT unnest(regexp_split_to_array(text, '\s+')) AS word
            FROM benchmark
        )
        WHERE regexp_matches(word, '^[A-Z][a-z]+$')
        GROUP BY word
    """,
    "prefix_code": r"""
        SELECT p_partkey, split_part(p_name, ' ', 1) AS outcode, 'United Kingdom' AS country
        FROM part
        WHERE p_name IS NOT NULL
    """,
    "row_sum": r"""
        SELECT p_partkey, p_retailprice + p_size AS total_consumption
        FROM part
    """,
    "upsert_update": r"""
        SELECT c_custkey, c_name,
        CASE WHEN c_acctbal >= 0 THEN 'UPDATED' ELSE c_mktsegment END AS c_mktsegment
        FROM customer
    """,
    "upsert_ignore": r"""
        SELECT c_custkey, CASE WHEN c_acctbal < 5000 THEN c_mktsegment ELSE 'NEW' END AS c_mktsegment
        FROM customer
    """,
    "delete_then_insert": r"""
        SELECT user_id, event_type
        FROM (
            SELECT user_id, event_type
            FROM events
            WHERE event_type = 'view' AND user_id NOT IN (
                SELECT user_id
                FROM events
                WHERE ts >= TIMESTAMP '2024-01-29'
            )
            UNION ALL SELECT DISTINCT user_id, event_type
            FROM events
            WHERE ts >= TIMESTAMP '2024-01-29' AND event_type = 'purchase'
        )
    """,
    "dq_checks": r"""
        SELECT 'orders has rows' AS test_name, CAST(count(1) AS BIGINT) AS actual, '>' AS op,
        CAST(0 AS BIGINT) AS expected, count(1) > 0 AS success
        FROM orders
        UNION ALL SELECT 'o_orderkey never null', count(1), '=', 0, count(1) = 0
        FROM orders
        WHERE o_orderkey IS NULL
    """,
    "log_parse_paths": r"""
        SELECT regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS endpoint, count(*) AS n
        FROM pages
        GROUP BY 1
    """,
    "fact_append": r"""
        SELECT event_id, user_id
        FROM events
        WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-20'
    """,
    "dq_constraints": r"""
        SELECT 'events.event_id unique' AS test_name, CAST(count(*) AS BIGINT) AS violations
        FROM (
            SELECT event_id
            FROM events
            GROUP BY 1
            HAVING count(*) > 1
        )
        UNION ALL SELECT 'lineitem (orderkey, linenumber) unique', count(*)
        FROM (
            SELECT 1
            FROM lineitem
            GROUP BY l_orderkey, l_linenumber
            HAVING count(*) > 1
        )
        UNION ALL SELECT 'orders.o_custkey in customer', count(*)
        FROM orders
        WHERE o_custkey NOT IN (
            SELECT c_custkey
            FROM customer
        )
    """,
    "top_group_positions": r"""
        SELECT CAST(position AS INT) AS position, user_id, num
        FROM (
            SELECT user_id, num, dense_rank() OVER (ORDER BY num DESC) AS position
            FROM (SELECT user_id, count(*) AS num FROM events GROUP BY user_id)
        )
        WHERE position <= 3
    """,
    "word_count_conversations": r"""
        SELECT word, count(*) AS "count"
        FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM conversations)
        GROUP BY word
    """,
    "json_with_schema": r"""
        SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props FROM events
    """,
    "json_inferred": r"""
        SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer
    """,
    "stage_by_mapping": r"""
        SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type FROM events
    """,
    "delimited_gzip_parts": r"""
        SELECT * FROM lineitem
    """,
    "delimited_with_header": r"""
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus, o_orderpriority FROM orders
    """,
    "parquet_partitioned": r"""
        SELECT o_orderkey, o_orderdate, CAST(extract(year FROM o_orderdate) AS INT) AS y,
        CAST(extract(month FROM o_orderdate) AS INT) AS m
        FROM orders
        WHERE extract(year FROM o_orderdate) = 1997
    """,
    "partitions_replaced": r"""
        SELECT o_orderkey,
        CASE WHEN o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-01-01'
        THEN 'CLOSED' ELSE o_orderstatus END AS o_orderstatus,
        CAST(extract(year FROM o_orderdate) AS INT) AS y,
        CAST(extract(month FROM o_orderdate) AS INT) AS m
        FROM orders
    """,
    "union_by_name": r"""
        SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'
        UNION ALL
        SELECT event_id, user_id, NULL FROM events WHERE event_type IS DISTINCT FROM 'purchase'
    """,
    "random_keys": r"""
        SELECT count(*) AS n, count(*) AS n_keys FROM events
    """,
    "log_parse_lines": r"""
        SELECT 'host' || user_id AS host, 'GET' AS method,
        '/' || event_type || '/' || event_id AS endpoint, 'HTTP/1.0' AS protocol,
        CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS response_code,
        CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS content_size_bytes,
        date_trunc('second', ts) AS logged_at
        FROM events
    """,
    "load_and_summarise": r"""
        SELECT l_partkey, max(l_quantity) AS max_l_quantity, min(l_quantity) AS min_l_quantity,
        round(avg(l_quantity), 6) AS average_l_quantity
        FROM lineitem
        GROUP BY l_partkey
    """,
    "dimension_reload": r"""
        SELECT c_custkey, c_mktsegment FROM customer
        UNION ALL
        SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
    "bucketed_star": r"""
        SELECT o_orderdate,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS revenue
        FROM lineitem
        JOIN part ON l_partkey = p_partkey
        JOIN orders ON l_orderkey = o_orderkey
        GROUP BY o_orderdate
    """,
    "lake_users": r"""
        SELECT CAST(user_id AS VARCHAR) AS user_id, 'First' || user_id AS first_name,
        'Last' || user_id AS last_name, CAST(NULL AS VARCHAR) AS gender,
        CASE WHEN value > 50 THEN 'paid' ELSE 'free' END AS level
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC
            ) AS rn
            FROM events
            JOIN part ON user_id = p_partkey
            WHERE event_type = 'purchase'
        )
        WHERE rn = 1
    """,
    "play_users": r"""
        SELECT CAST(user_id AS VARCHAR) AS user_id, 'First' || user_id AS first_name,
        'Last' || user_id AS last_name, CAST(NULL AS VARCHAR) AS gender,
        CASE WHEN value > 50 THEN 'paid' ELSE 'free' END AS level
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC
            ) AS rn
            FROM events
            JOIN part ON user_id = p_partkey
            WHERE event_type = 'purchase'
        )
        WHERE rn = 1
    """,
    "play_users_first": r"""
        SELECT CAST(user_id AS VARCHAR) AS user_id, 'First' || user_id AS first_name,
        'Last' || user_id AS last_name, CAST(NULL AS VARCHAR) AS gender,
        CASE WHEN value > 50 THEN 'paid' ELSE 'free' END AS level
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 ASC, event_id ASC
            ) AS rn
            FROM events
            JOIN part ON user_id = p_partkey
            WHERE event_type = 'purchase'
        )
        WHERE rn = 1
    """,
    "play_users_all": r"""
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, 'First' || user_id AS first_name,
        'Last' || user_id AS last_name, CAST(NULL AS VARCHAR) AS gender,
        CASE WHEN value > 50 THEN 'paid' ELSE 'free' END AS level
        FROM events
        JOIN part ON user_id = p_partkey
        WHERE event_type = 'purchase'
    """,
    "play_songs": r"""
        SELECT CAST(p_partkey AS VARCHAR) AS song_id, p_name AS title, p_brand AS artist_id,
        p_retailprice AS duration, p_size AS "year"
        FROM part
    """,
    "play_artists": r"""
        SELECT p_brand AS artist_id, p_brand AS name, p_type AS location,
        CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY p_brand ORDER BY p_size DESC, CAST(p_partkey AS VARCHAR) DESC
            ) AS rn
            FROM part
        )
        WHERE rn = 1
    """,
    "play_time": r"""
        SELECT start_time, CAST(extract(hour FROM start_time) AS INT) AS hour,
        CAST(extract(day FROM start_time) AS INT) AS day,
        CAST(extract(week FROM start_time) AS INT) AS week,
        CAST(extract(isodow FROM start_time) - 1 AS INT) AS weekday,
        CAST(extract(year FROM start_time) AS INT) AS year,
        CAST(extract(month FROM start_time) AS INT) AS month
        FROM (
            SELECT DISTINCT epoch_ms(epoch_us(ts) // 1000) AS start_time
            FROM events
            JOIN part ON user_id = p_partkey
            WHERE event_type = 'purchase'
        )
    """,
    "play_time_of_facts": r"""
        SELECT start_time, CAST(extract(hour FROM start_time) AS INT) AS hour,
        CAST(extract(day FROM start_time) AS INT) AS day,
        CAST(extract(week FROM start_time) AS INT) AS week,
        CAST(extract(isodow FROM start_time) - 1 AS INT) AS weekday,
        CAST(extract(year FROM start_time) AS INT) AS year,
        CAST(extract(month FROM start_time) AS INT) AS month
        FROM (
            SELECT DISTINCT epoch_ms(epoch_us(ts) // 1000) AS start_time
            FROM events
            JOIN part ON user_id = p_partkey
            WHERE event_type = 'purchase'
        )
    """,
    "play_facts_title": r"""
        SELECT event_id AS session_id, catalogue.song_id, catalogue.artist_id
        FROM events
        JOIN part AS played ON user_id = played.p_partkey
        JOIN (
            SELECT p_name, min(CAST(p_partkey AS VARCHAR)) AS song_id,
            arg_min(p_brand, CAST(p_partkey AS VARCHAR)) AS artist_id
            FROM part
            GROUP BY p_name
        ) catalogue USING (p_name)
        WHERE event_type = 'purchase'
    """,
    "play_facts_title_artist": r"""
        SELECT event_id AS session_id, catalogue.song_id, catalogue.artist_id
        FROM events
        JOIN part AS played ON user_id = played.p_partkey
        JOIN (
            SELECT p_name, p_brand, min(CAST(p_partkey AS VARCHAR)) AS song_id,
            arg_min(p_brand, CAST(p_partkey AS VARCHAR)) AS artist_id
            FROM part
            GROUP BY p_name, p_brand
        ) catalogue USING (p_name, p_brand)
        WHERE event_type = 'purchase'
    """,
    "who_heard_what": r"""
        SELECT song.p_name AS title, song.p_brand AS name,
        'First' || user_id || ' Last' || user_id AS full_name
        FROM events
        JOIN part AS song ON user_id = song.p_partkey
        WHERE event_type = 'purchase'
    """,
    "most_prolific_years": r"""
        WITH songs_per_year AS (
            SELECT CAST(p_size AS VARCHAR) AS "year", count(1) AS n
            FROM part
            WHERE p_size <> 0
            GROUP BY p_size
        )
        SELECT n AS num_of_songs, string_agg("year", ', ' ORDER BY "year") AS years
        FROM songs_per_year
        GROUP BY n
        ORDER BY n DESC
        LIMIT 3
    """,
    "longest_songs": r"""
        SELECT p_brand AS name, p_name AS title, p_retailprice AS duration
        FROM part
        ORDER BY p_retailprice DESC, CAST(p_partkey AS VARCHAR)
        LIMIT 10
    """,
    "calendar_month_revenue": r"""
        SELECT CAST(extract(month FROM o_orderdate) AS INT) AS m,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM orders
        GROUP BY 1
    """,
    "calendar_days": r"""
        SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS d_datekey, strftime(d, '%B %-d, %Y') AS d_date,
        strftime(d, '%A') AS d_dayofweek, strftime(d, '%B') AS d_month,
        CAST(extract(year FROM d) AS INT) AS d_year,
        CAST(strftime(d, '%Y%m') AS INT) AS d_yearmonthnum, strftime(d, '%b%Y') AS d_yearmonth,
        CAST(extract(dow FROM d) + 1 AS INT) AS d_daynuminweek,
        CAST(extract(day FROM d) AS INT) AS d_daynuminmonth,
        CAST(extract(doy FROM d) AS INT) AS d_daynuminyear,
        CAST(extract(month FROM d) AS INT) AS d_monthnuminyear,
        CAST(extract(week FROM d) AS INT) AS d_weeknuminyear,
        CASE WHEN extract(dow FROM d) = 6 THEN '1' ELSE '0' END AS d_lastdayinweekfl,
        CASE WHEN CAST(d AS DATE) = last_day(d) THEN '1' ELSE '0' END AS d_lastdayinmonthfl,
        CASE WHEN extract(isodow FROM d) < 6 THEN '1' ELSE '0' END AS d_weekdayfl
        FROM (
            SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
            FROM orders
        )
    """,
    "log_parse_map": r"""
        SELECT 'host' || user_id AS host, '/' || event_type || '/' || event_id AS endpoint,
        CASE WHEN event_type = 'error' THEN '-' ELSE CAST(user_id AS VARCHAR) END AS content_size
        FROM events
    """,
    "log_split_fields": r"""
        SELECT 'host' || user_id AS host,
        CASE WHEN event_type = 'error' THEN '-' ELSE CAST(user_id AS VARCHAR) END AS content_size
        FROM events
    """,
    "log_largest_responses": r"""
        SELECT '/' || event_type || '/' || event_id AS endpoint, user_id AS content_size_bytes
        FROM events
        WHERE event_type <> 'error'
        ORDER BY user_id DESC, endpoint
        LIMIT 10
    """,
    "play_facts": _SONGPLAYS,
    "stream_staging": r"""
        SELECT event_id, user_id, event_type
        FROM events
        WHERE event_type IS NOT NULL
    """,
    "scheduled_songplays": _SONGPLAYS,
    "stream_songplays": _SONGPLAYS,
}

# The same result by another way of joining.
for _name in ("fact_enrich_left", "fact_enrich_title", "delete_then_insert"):
    ORACLES[f"{_name}_spread"] = ORACLES[_name]
ORACLES["replicated_star"] = ORACLES["star_two_dim"]
ORACLES["monthly_revenue_in_sql"] = ORACLES["monthly_revenue"]
ORACLES["dq_rule_queries"] = f"""
    SELECT * REPLACE (CAST(actual AS DOUBLE) AS actual, CAST(expected AS DOUBLE) AS expected)
    FROM ({ORACLES["dq_checks"]})
"""
ORACLES |= {
    "dq_empty_rule": r"""
        SELECT 'nothing found' AS test_name, CAST(NULL AS DOUBLE) AS actual, '=' AS op,
        CAST(0 AS DOUBLE) AS expected, false AS success
        UNION ALL
        SELECT 'a fraction', 0.4, '<', 0.5, true
    """,
    "monthly_unit_price": r"""
        SELECT CAST(extract(year FROM l_shipdate) AS INT) AS y, CAST(extract(month FROM l_shipdate) AS INT) AS m,
        round(sum(l_extendedprice / l_quantity), 4) AS revenue
        FROM lineitem
        GROUP BY 1, 2
    """,
    "log_popular_hosts": r"""
        SELECT 'host' || user_id AS host, count(*) AS n FROM events GROUP BY 1
    """,
    "log_popular_content": r"""
        SELECT '/' || event_type || '/' || event_id AS endpoint, count(*) AS n FROM events GROUP BY 1
    """,
    "run_date_files": r"""
        SELECT event_id, event_type FROM events WHERE event_id % 14 = (2025 - extract(year FROM ts)) * 12 + 2 - extract(month FROM ts)
    """,
    "delimited_single_gzip": r"""
        SELECT * FROM part
    """,
    "gzip_text_lines": r"""
        SELECT split_part(p_name, ' ', 1) AS word, count(*) AS n FROM part GROUP BY 1
    """,
    "single_file_export": r"""
        SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2
    """,
    "local_lookup": r"""
        SELECT r_name AS region, count(*) AS n
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1
    """,
    "several_header_rows": r"""
        SELECT o_orderkey, o_orderstatus FROM orders
    """,
    "rejected_lines": r"""
        SELECT kind, event_id % 10 <> 3 AS fits, count(*) AS n
        FROM events, (VALUES ('json'), ('csv')) k(kind)
        GROUP BY 1, 2
    """,
    "numbered_orders": r"""
        SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS order_no, o_orderkey
        FROM orders
    """,
    "identity_over_loads": r"""
        SELECT row_number() OVER (ORDER BY CASE event_id % 3 WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 3 END, ts, event_id) AS play_no,
        event_id, user_id, ts
        FROM events
    """,
    "merged_parts": r"""
        SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
        FROM customer
    """,
    "running_first_seen": r"""
        SELECT event_id, first_value(event_type) OVER (PARTITION BY user_id, ts ORDER BY event_id) AS first_type
        FROM events
    """,
    "running_totals": r"""
        WITH paid AS (
            SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,6)) END AS paid
            FROM events
        ), counted AS (
            SELECT *, count(paid) OVER frame AS n_paid, sum(paid) OVER frame AS sum_paid, max(paid) OVER frame AS most_paid,
            max(CASE WHEN paid IS NOT NULL THEN ts END) OVER frame AS last_ts
            FROM paid
            WINDOW frame AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        ), latest AS (
            SELECT user_id, ts, arg_min(paid, event_id) AS last_paid
            FROM paid
            WHERE paid IS NOT NULL
            GROUP BY user_id, ts
        )
        SELECT event_id, n_paid, CAST(sum_paid AS DOUBLE) AS sum_paid, CAST(most_paid AS DOUBLE) AS most_paid, CAST(last_paid AS DOUBLE) AS last_paid
        FROM counted LEFT JOIN latest ON counted.user_id = latest.user_id AND last_ts = latest.ts
    """,
    "dim_date_seasons": r"""
        WITH rules(kind, name, first, last, low, high, priority) AS (VALUES
            ('season', 'Winter', NULL::DATE, NULL::DATE, 1201, 228, 1), ('season', 'Spring', NULL, NULL, 301, 531, 1),
            ('season', 'Summer', NULL, NULL, 601, 831, 1), ('season', 'Fall', NULL, NULL, 901, 1130, 1),
            ('season', 'Gifts', DATE '1996-01-01', NULL, 1115, 1231, 2),
            ('season', 'Clearance', DATE '1997-02-10', DATE '1997-03-20', NULL, NULL, 3),
            ('season', 'Jubilee', DATE '2001-06-01', NULL, NULL, NULL, 3),
            ('holiday', 'New Year', NULL, NULL, 101, 101, 1), ('holiday', 'Labour Day', NULL, NULL, 501, 501, 1),
            ('holiday', 'Founding', NULL, DATE '1997-12-31', 915, 915, 1),
            ('holiday', 'Opening', DATE '1998-04-02', DATE '1998-04-03', NULL, NULL, 1)
        ), days AS (
            SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
        ), held AS (
            SELECT d, kind, name, row_number() OVER (PARTITION BY d, kind ORDER BY priority DESC, name) AS rn
            FROM (SELECT d, CAST(extract(month FROM d) * 100 + extract(day FROM d) AS INT) AS mmdd FROM days)
            JOIN rules ON (first IS NULL OR d >= first) AND (last IS NULL OR d <= last) AND (
                low IS NULL OR (low <= high AND mmdd BETWEEN low AND high) OR (low > high AND (mmdd >= low OR mmdd <= high)))
        )
        SELECT CAST(strftime(days.d, '%Y%m%d') AS INT) AS d_datekey,
        monthname(days.d) || ' ' || extract(day FROM days.d) || ', ' || extract(year FROM days.d) AS d_date,
        dayname(days.d) AS d_dayofweek, monthname(days.d) AS d_month, CAST(extract(year FROM days.d) AS INT) AS d_year,
        CAST(extract(year FROM days.d) * 100 + extract(month FROM days.d) AS INT) AS d_yearmonthnum,
        strftime(days.d, '%b%Y') AS d_yearmonth, CAST(extract(dow FROM days.d) + 1 AS INT) AS d_daynuminweek,
        CAST(extract(day FROM days.d) AS INT) AS d_daynuminmonth, CAST(extract(doy FROM days.d) AS INT) AS d_daynuminyear,
        CAST(extract(month FROM days.d) AS INT) AS d_monthnuminyear, CAST(extract(week FROM days.d) AS INT) AS d_weeknuminyear,
        CASE WHEN extract(dow FROM days.d) = 6 THEN '1' ELSE '0' END AS d_lastdayinweekfl,
        CASE WHEN days.d = last_day(days.d) THEN '1' ELSE '0' END AS d_lastdayinmonthfl,
        CASE WHEN extract(isodow FROM days.d) < 6 THEN '1' ELSE '0' END AS d_weekdayfl,
        season.name AS d_sellingseason, CASE WHEN holiday.name IS NULL THEN '0' ELSE '1' END AS d_holidayfl
        FROM days
        LEFT JOIN held AS season ON season.d = days.d AND season.kind = 'season' AND season.rn = 1
        LEFT JOIN held AS holiday ON holiday.d = days.d AND holiday.kind = 'holiday' AND holiday.rn = 1
    """,
    "open_orders": r"""
        SELECT day, count(*) AS n_open
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
        JOIN (
            SELECT o_orderkey, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last
            FROM orders JOIN lineitem ON o_orderkey = l_orderkey
            GROUP BY o_orderkey
        ) ON day BETWEEN first AND last
        GROUP BY day
    """,
    "stage_by_paths": r"""
        SELECT event_id, CASE WHEN event_id % 3 < 2 THEN user_id END AS user_id, CASE WHEN event_id % 3 < 2 THEN event_type END AS event_type,
        CASE WHEN event_id % 3 < 2 THEN value END AS amount
        FROM events
        WHERE event_id % 50 <> 7
    """,
    "dq_during_load": r"""
        SELECT test_name, CAST(actual AS DOUBLE) AS actual, true AS success, (SELECT count(*) FROM orders) AS stored
        FROM (
            SELECT 'has rows' AS test_name, count(*) AS actual FROM orders
            UNION ALL SELECT 'o_orderkey never null', count(*) FILTER (o_orderkey IS NULL) FROM orders
            UNION ALL SELECT 'cheapest', min(o_totalprice) FROM orders
        )
    """,
    "functions_by_name": r"""
        SELECT 'host' || user_id AS host, '/' || event_type || '/' || event_id AS endpoint,
        CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS code,
        CASE WHEN event_type = 'error' THEN '-' ELSE CAST(user_id AS VARCHAR) END AS size,
        md5('host' || user_id || '||/' || event_type || '/' || event_id) AS key
        FROM events
    """,
    "stream_once": r"""
        SELECT event_id, user_id, event_type
        FROM events
    """,
    "curved_orders": r"""
        SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
        UNION ALL
        SELECT * FROM orders WHERE o_custkey BETWEEN 40 AND 90
    """,
}
