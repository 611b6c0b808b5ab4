"""The registered queries once more, as SQL over the same tables.

The SQL is written from the definition of each query, token by token and event
by event. It shares the list of event subtypes with the operators, no rule.
"""

from __future__ import annotations

from clickloom.schemas import EVENT_SUBTYPES

GAP = r"'[ \t\n\r\f]+'"

LINES = """
    SELECT doc_id, source, i - 1 AS line_no, string_split(text, chr(10))[i] AS line
    FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
"""

TOKENS = f"""
    SELECT doc_id, line_no, tok
    FROM (SELECT doc_id, line_no, unnest(regexp_split_to_array(line, {GAP})) AS tok
          FROM ({LINES}))
    WHERE tok <> ''
"""


def _strip(text: str) -> str:
    return (
        f"""regexp_replace(regexp_replace({text}, '^["_-]+', ''), """
        """'[.,;"!?_:-]+$', '')"""
    )


WORDS = f"""
    WITH token AS ({TOKENS}),
    plain AS (SELECT doc_id, line_no, {_strip("lower(tok)")} AS w FROM token),
    noted AS (
        SELECT doc_id, line_no, false AS note, CASE WHEN w LIKE '%]' AND length(w) >= 5
               THEN {_strip("left(w, length(w) - 5)")} ELSE w END AS w FROM plain
        UNION ALL
        SELECT doc_id, line_no, true, {_strip("right(w, 5)")} FROM plain
        WHERE w LIKE '%]' AND length(w) >= 5
    ),
    dashed AS (
        SELECT doc_id, line_no, CASE WHEN NOT note AND instr(w, '--') > 0
               THEN {_strip("left(w, instr(w, '--') - 1)")} ELSE w END AS w FROM noted
        UNION ALL
        SELECT doc_id, line_no, {_strip("substr(w, instr(w, '--') + 2)")} FROM noted
        WHERE NOT note AND instr(w, '--') > 0
    )
    SELECT doc_id, line_no, w AS word FROM dashed WHERE w <> ''
"""

PARAGRAPH_WORDS = f"""
    SELECT doc_id, line_no, word, count(*) AS occurrences
    FROM ({WORDS}) GROUP BY doc_id, line_no, word
"""

LENGTHS = f"""
    SELECT 'paragraph length' AS word, CAST(count(tok) AS BIGINT) AS occurrences
    FROM ({LINES}) l LEFT JOIN ({TOKENS}) t USING (doc_id, line_no)
    GROUP BY l.doc_id, l.line_no
"""

FULL_STATS = """
    SELECT word, document_count, total_count, min, max, sum_of_squares,
           total_count / document_count AS mean,
           sum_of_squares / document_count
             - (total_count / document_count) * (total_count / document_count) AS variance
    FROM (SELECT word, count(*) AS document_count,
                 CAST(sum(occurrences) AS BIGINT) AS total_count,
                 min(occurrences) AS min, max(occurrences) AS max,
                 CAST(sum(occurrences * occurrences) AS BIGINT) AS sum_of_squares
          FROM ({records}) GROUP BY word)
"""

VERSE_WORDS = rf"""
    SELECT DISTINCT word, source, doc_id, line_no
    FROM (SELECT l.source, t.doc_id, t.line_no,
                 regexp_replace(regexp_replace(lower(tok), '^[^A-Za-z]+', ''),
                                '[^A-Za-z]+$', '') AS word
          FROM ({TOKENS}) t JOIN (SELECT doc_id, source FROM documents) l USING (doc_id))
    WHERE word <> ''
"""


def _verse_index(size: int) -> str:
    return f"""
    WITH placed AS (
        SELECT *, (row_number() OVER (PARTITION BY word ORDER BY source, doc_id, line_no) - 1)
                    // {size} AS segment,
               count(*) OVER (PARTITION BY word) AS postings
        FROM ({VERSE_WORDS})
    )
    SELECT word, segment, postings,
           string_agg(source || ':' || doc_id || ':' || line_no, ', '
                      ORDER BY source, doc_id, line_no) AS verses
    FROM placed GROUP BY word, segment, postings
    """


HEADER_INDEX = rf"""
    WITH address AS (
        SELECT CASE role WHEN 'user' THEN 'From:' WHEN 'assistant' THEN 'To:' ELSE 'Cc:' END
                 || tok AS address, CAST(conv_id AS VARCHAR) AS id
        FROM (SELECT role, conv_id, unnest(regexp_split_to_array(text, {GAP})) AS tok
              FROM conversations)
        WHERE tok <> ''
    ),
    keyed AS (SELECT regexp_replace(address, ',$', '') AS key, id FROM address),
    placed AS (
        SELECT *, (row_number() OVER (PARTITION BY key ORDER BY id) - 1) // 100000 AS segment,
               count(*) OVER (PARTITION BY key) AS postings
        FROM keyed
    )
    SELECT key, segment, postings, string_agg(id, ',' ORDER BY id) AS message_ids
    FROM placed GROUP BY key, segment, postings
"""

_SUBTYPE_LIST = ", ".join(f"'{s}'" for s in EVENT_SUBTYPES)

CLICKS = f"""
    SELECT CAST(user_id AS VARCHAR) AS user_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
           CASE event_type WHEN 'view' THEN 'SHOW' WHEN 'click' THEN 'CLICK'
                WHEN 'purchase' THEN ['SUBMIT', 'EDIT', 'CHANGE'][k % 3 + 1]
                WHEN 'signup' THEN 'VISIT' ELSE 'DISPLAY' END AS event_type,
           [{_SUBTYPE_LIST}][k % 12 + 1] AS event_subtype,
           strftime(ts, '%Y-%m-%d') AS city,
           CAST(k AS VARCHAR) AS vin,
           ['New', 'Used', 'CPO', NULL][k % 4 + 1] AS condition,
           CAST(2000 + k % 20 AS VARCHAR) AS year,
           'make' || (k % 7) AS make,
           'model' || (k % 13) AS model,
           ['', 'S', 'SE'][k % 3 + 1] AS trim,
           ['Sedan', 'SUV', 'Coupe', 'Pickup', NULL][k % 5 + 1] AS body_style,
           ['Crew', 'Extended', 'Regular', NULL][k % 4 + 1] AS cab_style,
           value AS price,
           event_id % 1000 AS mileage,
           k % 2 = 0 AS free_carfax_report,
           ['', 'abs', 'abs:sunroof', 'abs:navigation:sunroof'][k % 4 + 1] AS features
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""

HISTOGRAM = f"""
    WITH c AS (
        SELECT *, CAST(vin AS INTEGER) AS k FROM ({CLICKS})
    )
    SELECT pair, count(*) AS count
    FROM (
        SELECT unnest([
            'event_type:' || lower(event_type) || ' ' || lower(replace(event_subtype, '_', ' ')),
            'city:' || city,
            'vehicle_condition:' || ['New', 'Used', 'CPO', 'Salvage'][k % 4 + 1],
            'year:' || year, 'make:' || make, 'model:' || model, 'trim:' || trim,
            'body_style:' || ['Sedan', 'SUV', 'Coupe', 'Pickup', 'Truck'][k % 5 + 1],
            'cab_style:' || ['Crew Cab', 'Extended Cab', 'Regular Cab', ''][k % 4 + 1],
            'free_carfax_report:' || CASE WHEN free_carfax_report THEN 't' ELSE 'f' END
        ]) AS pair FROM c
        UNION ALL
        SELECT 'feature:' || f FROM (SELECT unnest(string_split(features, ':')) AS f FROM c)
        WHERE f <> ''
    )
    GROUP BY pair
"""

DELIVERED = f"""
    SELECT * FROM ({CLICKS})
    UNION ALL
    SELECT * FROM ({CLICKS}) WHERE event_type IN ('SUBMIT', 'EDIT', 'CHANGE')
"""

_EVENT_TEXT = """
    concat_ws('|', event_time, coalesce(event_type, '-'), coalesce(event_subtype, '-'),
              coalesce(condition, '-'), coalesce(body_style, '-'), coalesce(cab_style, '-'),
              city, vin, year, make, model, trim, CAST(price AS VARCHAR),
              CAST(mileage AS VARCHAR), CAST(free_carfax_report AS VARCHAR), features)
"""


def _user_sessions(events: str, size: int = 10000) -> str:
    order = "event_time, event_type, event_subtype, mileage"
    return f"""
    WITH placed AS (
        SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY {order}) - 1) // {size}
                    AS segment,
               count(*) OVER (PARTITION BY user_id) AS session_events
        FROM ({events})
    )
    SELECT user_id, segment, session_events,
           string_agg({_EVENT_TEXT}, ' ; ' ORDER BY {order}) AS events
    FROM placed GROUP BY user_id, segment, session_events
    """


CITY_EVENTS = f"""
    SELECT DISTINCT user_id, city, event_time, lower(event_type) AS event_type,
           lower(replace(event_subtype, '_', ' ')) AS event_subtype, vin
    FROM ({DELIVERED})
"""

CITY_SESSIONS = f"""
    SELECT user_id, city, CAST(0 AS BIGINT) AS segment, count(*) AS session_events,
           string_agg('<' || event_type || ':' || event_subtype || ',' || event_time || '>', ', '
                      ORDER BY event_time, event_type, event_subtype, vin) AS events,
           bool_or(event_type IN ('show', 'display'))
             AND NOT bool_or(event_type = 'click')
             AND NOT bool_or(event_subtype = 'contact form') AS shower
    FROM ({CITY_EVENTS}) GROUP BY user_id, city
"""


def _draw() -> str:
    key = "concat_ws('|', '0', user_id, city)"
    return f"CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT)"


# The shares 0.10 and 0.02 of 2^32, rounded down.
TENTH = 429496729
FIFTIETH = 85899345

SHOWER_SAMPLE = f"""
    SELECT user_id, city, segment, session_events, events
    FROM ({CITY_SESSIONS}) WHERE NOT shower OR {_draw()} < {TENTH}
"""

# The bucket rule, character by character, on the ten ASCII characters of a date.
_HASH = " + ".join(
    f"ascii(substr(city, {i}, 1))::HUGEINT * {31 ** (10 - i)}" for i in range(1, 11)
)
CITY_PARTITIONS = f"""
    SELECT user_id, city, segment, session_events, events,
           CAST(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 6 AS INTEGER)
             AS city_bucket
    FROM (SELECT *, CAST(({_HASH}) % 4294967296 AS BIGINT) AS h FROM ({SHOWER_SAMPLE}))
"""

_COUNTS = ", ".join(f"count(*) FILTER (event_subtype = '{s}') AS {s}" for s in EVENT_SUBTYPES)

PROFILES = f"""
    SELECT user_id, city, count(*) AS session_events,
           CASE WHEN bool_or(event_type IN ('CHANGE', 'EDIT', 'SUBMIT')) THEN 'submitter'
                WHEN bool_or(event_type = 'CLICK') THEN 'clicker'
                WHEN bool_or(event_type IN ('SHOW', 'DISPLAY')) THEN 'shower'
                WHEN bool_or(event_type = 'VISIT') THEN 'visitor'
                ELSE 'other' END AS session_type
    FROM ({CLICKS}) GROUP BY user_id, city
"""

_KEPT = f"""
    CASE session_type WHEN 'clicker' THEN {_draw()} < {TENTH}
         WHEN 'shower' THEN {_draw()} < {FIFTIETH} ELSE true END
"""

_DENSE = f"""
    SELECT upper(p.session_type) AS session_type, s.event_subtype, count(e.vin) AS n
    FROM (SELECT * FROM ({PROFILES}) WHERE session_events <= 100 AND session_type <> 'other') p
    CROSS JOIN (SELECT unnest([{_SUBTYPE_LIST}]) AS event_subtype) s
    LEFT JOIN ({CLICKS}) e
      ON e.user_id = p.user_id AND e.city = p.city AND e.event_subtype = s.event_subtype
    GROUP BY p.user_id, p.city, p.session_type, s.event_subtype
"""


def _subtype_stats(dense: str) -> str:
    return f"""
    SELECT session_type, event_subtype, session_count, total_count, sum_of_squares,
           total_count / session_count AS mean,
           sum_of_squares / session_count
             - (total_count / session_count) * (total_count / session_count) AS variance
    FROM (SELECT session_type, event_subtype, count(*) AS session_count,
                 CAST(sum(n) AS BIGINT) AS total_count,
                 CAST(sum(n * n) AS BIGINT) AS sum_of_squares
          FROM ({dense}) GROUP BY session_type, event_subtype)
    """


VIN_USERS = f"""
    WITH users AS (
        SELECT vin, count(DISTINCT user_id) AS unique_users,
               count(DISTINCT CASE WHEN event_type = 'EDIT' AND event_subtype = 'CONTACT_FORM'
                                   THEN user_id END) AS edit_contact_form
        FROM ({CLICKS}) GROUP BY vin
    ),
    clicked AS (
        SELECT vin, event_subtype, count(DISTINCT user_id) AS n
        FROM ({CLICKS}) WHERE event_type = 'CLICK' GROUP BY vin, event_subtype
    ),
    texts AS (
        SELECT vin, string_agg(event_subtype || '=' || n, ',' ORDER BY event_subtype) AS clicks
        FROM clicked GROUP BY vin
    )
    SELECT vin, unique_users, edit_contact_form, coalesce(clicks, '') AS clicks
    FROM users LEFT JOIN texts USING (vin)
"""

VIN_IMPRESSIONS = f"""
    WITH shown AS (
        SELECT CAST(l_partkey % 100 AS VARCHAR) AS vin,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
                    AS BIGINT) AS marketplace_srps,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS BIGINT) END)
                    AS BIGINT) AS marketplace_vdps
        FROM lineitem GROUP BY 1
    )
    SELECT vin, unique_users, clicks, edit_contact_form,
           coalesce(marketplace_srps, 0) AS marketplace_srps,
           coalesce(marketplace_vdps, 0) AS marketplace_vdps
    FROM ({VIN_USERS}) LEFT JOIN shown USING (vin)
"""

VEHICLE_LINES = """
    SELECT CAST(l_orderkey AS VARCHAR) AS "userID",
           CASE l_returnflag WHEN 'A' THEN 'show' WHEN 'N' THEN 'click' ELSE 'edit' END || ' '
             || CASE l_linestatus WHEN 'F' THEN 'badges' ELSE 'contact form' END AS event,
           strftime(l_shipdate, '%Y-%m-%d') AS "timestamp",
           CAST(l_partkey AS VARCHAR) AS vin,
           l_linestatus AS condition,
           CAST(year(l_shipdate) AS VARCHAR) AS year,
           l_extendedprice, l_quantity,
           CAST(l_extendedprice AS VARCHAR) AS price,
           CAST(l_quantity AS VARCHAR) AS mileage
    FROM lineitem
"""


_VEHICLE_TEXT = '"userID", event, "timestamp", condition, year, price, mileage'


def _one_per_vin(nonzero: str, columns: str = _VEHICLE_TEXT) -> str:
    """The row of each vehicle whose text, vehicle and columns, has the smallest MD5."""
    text = ", ".join(f"coalesce({c.strip()}, '')" for c in ("vin", *columns.split(",")))
    return f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY vin ORDER BY md5(concat_ws('|', {text})), {columns}) AS place
        FROM ({VEHICLE_LINES}) WHERE {nonzero} <> 0)
    WHERE place = 1
    """


DISTINCT_VIN = f"""
    SELECT "userID", event, "timestamp", vin, condition, year, p_brand AS make,
           p_type AS model, price, mileage
    FROM ({_one_per_vin("l_extendedprice")})
    LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = vin
"""

ORACLE: dict[str, str] = {
    "word_count": f"SELECT tok AS word, count(*) AS count FROM ({TOKENS}) GROUP BY tok",
    "word_count_sorted": (
        f"SELECT tok AS word, count(*) AS count FROM ({TOKENS}) GROUP BY tok ORDER BY tok"
    ),
    "word_counters": f"""
        SELECT 'input_lines' AS counter, count(*) AS value FROM ({LINES})
        UNION ALL SELECT 'words_out', count(*) FROM ({TOKENS})
        UNION ALL SELECT 'groups_out', count(DISTINCT tok) FROM ({TOKENS})
    """,
    "paragraph_words": PARAGRAPH_WORDS,
    "word_stats": f"""
        SELECT word, document_count, mean, variance
        FROM ({FULL_STATS.format(records=PARAGRAPH_WORDS)})
    """,
    "word_stats_full": FULL_STATS.format(
        records=f"SELECT word, occurrences FROM ({PARAGRAPH_WORDS}) UNION ALL {LENGTHS}"
    ),
    "paragraph_length": FULL_STATS.format(records=LENGTHS),
    "verse_index": _verse_index(100000),
    "verse_index_segments": _verse_index(500),
    "header_index": HEADER_INDEX,
    "field_histogram": HISTOGRAM,
    "parsed_events": CLICKS,
    "events_union": f"""
        SELECT user_id, city, event_time AS event_timestamp,
               lower(event_type) || ' ' || lower(replace(event_subtype, '_', ' ')) AS event_type,
               vin
        FROM ({CLICKS})
        UNION ALL
        SELECT CAST(o_custkey AS VARCHAR), o_orderstatus,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), 'submit contact form',
               CAST(o_orderkey % 100 AS VARCHAR)
        FROM orders
    """,
    "user_sessions": _user_sessions(f"SELECT DISTINCT * FROM ({DELIVERED})"),
    "user_sessions_with_duplicates": _user_sessions(DELIVERED),
    "user_session_segments": _user_sessions(DELIVERED, 20),
    "large_session_filter": (
        f"SELECT * FROM ({_user_sessions(f'SELECT DISTINCT * FROM ({CLICKS})')}) "
        "WHERE session_events <= 60"
    ),
    "user_day_sessions": (
        f"SELECT user_id, city, segment, session_events, events FROM ({CITY_SESSIONS}) "
        "ORDER BY user_id, city, segment"
    ),
    "shower_sample": SHOWER_SAMPLE,
    "session_metrics": f"""
        SELECT CAST(sum(session_events) AS BIGINT) AS events_before,
               CAST(sum(session_events) FILTER (NOT shower OR kept) AS BIGINT) AS events_after,
               count(*) AS sessions,
               count(*) FILTER (shower) AS shower_sessions,
               count(*) FILTER (shower AND NOT kept) AS shower_dropped
        FROM (SELECT *, {_draw()} < {TENTH} AS kept FROM ({CITY_SESSIONS}))
    """,
    "city_partitions": CITY_PARTITIONS,
    "session_types": f"SELECT * FROM ({PROFILES}) WHERE session_events <= 100",
    "session_type_tally": f"""
        SELECT session_type, count(*) AS sessions
        FROM ({PROFILES}) WHERE session_events <= 100 GROUP BY session_type
    """,
    "session_sample": f"SELECT * FROM ({PROFILES}) WHERE session_events <= 100 AND {_KEPT}",
    "filter_counters": f"""
        SELECT count(*) AS sessions,
               count(*) FILTER (session_events > 100) AS large_discards,
               count(*) FILTER (session_events <= 100 AND session_type = 'clicker' AND NOT kept)
                 AS clicker_discards,
               count(*) FILTER (session_events <= 100 AND session_type = 'shower' AND NOT kept)
                 AS shower_discards
        FROM (SELECT *, {_KEPT} AS kept FROM ({PROFILES}))
    """,
    "subtype_stats": _subtype_stats(_DENSE),
    "subtype_stats_any": _subtype_stats(
        f"WITH d AS ({_DENSE}) SELECT * FROM d "
        "UNION ALL SELECT 'ANY' AS session_type, event_subtype, n FROM d"
    ),
    "vin_user_stats": VIN_USERS,
    "vin_impressions_join": VIN_IMPRESSIONS,
    "distinct_vin": DISTINCT_VIN,
    "price_by_make_model": f"""
        SELECT make, model,
               CAST(min(CAST(price AS DECIMAL(10, 0))) AS BIGINT) AS min_price,
               CAST(max(CAST(price AS DECIMAL(10, 0))) AS BIGINT) AS max_price,
               round(avg(CAST(CAST(price AS DECIMAL(10, 0)) AS DOUBLE)), 4) AS avg_price
        FROM (SELECT p_brand AS make, p_type AS model, price
              FROM ({_one_per_vin("l_extendedprice", "price")})
              LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = vin)
        GROUP BY make, model
    """,
    "mileage_by_year": f"""
        SELECT year,
               CAST(min(CAST(mileage AS DECIMAL(10, 0))) AS BIGINT) AS min_mileage,
               CAST(max(CAST(mileage AS DECIMAL(10, 0))) AS BIGINT) AS max_mileage,
               round(avg(CAST(CAST(mileage AS DECIMAL(10, 0)) AS DOUBLE)), 4) AS avg_mileage
        FROM ({_one_per_vin("l_quantity", "year, mileage")}) GROUP BY year
    """,
    "vin_event_counts": f"""
        SELECT vin, string_split(event, ' ')[1] AS event, count(*) AS events
        FROM ({VEHICLE_LINES}) GROUP BY vin, string_split(event, ' ')[1]
    """,
}
