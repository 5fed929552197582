"""The registered queries as plain SQL over the given tables.

Written against the tables themselves, not against payloads, so that they do
not share any step with the Spark code they check.
"""

from __future__ import annotations

# Keys looked for in text, and English stop words.
TEXT_KEYS = (
    r"auth_token|ct0|cookie|authorization|x-csrf-token|x-guest-token"
    r"|bearer|password|token|secret|api_key"
)
STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him
    his himself she her hers herself it its itself they them their theirs themselves
    what which who whom this that these those am is are was were be been being have
    has had having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when
    where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don should now
""".split()

TIME = "'%Y-%m-%d %H:%M:%S'"
INGEST = "'2024-02-01 00:00:00'"

_FAULT = """
    SELECT *, CASE WHEN source = 'src3' AND doc_id % 10 > 0 THEN 2 + doc_id % 3
                   ELSE doc_id % 14 END AS fault
    FROM documents
"""
_OUTCOME = """
    CASE fault WHEN 0 THEN 'parsed'
      WHEN 1 THEN 'dropped_no_result' WHEN 11 THEN 'dropped_no_result'
      WHEN 2 THEN 'dropped_tombstone'
      WHEN 3 THEN 'dropped_no_legacy' WHEN 4 THEN 'dropped_no_legacy'
      WHEN 5 THEN 'dropped_rt_unparseable'
      WHEN 6 THEN 'dropped_promoted' WHEN 7 THEN 'dropped_promoted'
      WHEN 8 THEN 'dropped_schema_fail' WHEN 12 THEN 'dropped_schema_fail'
      ELSE 'dropped_exception' END
"""


def _count_outcome(name: str) -> str:
    return f"count(*) FILTER (outcome = '{name}') AS {name}"


_STATS = ",\n".join(
    _count_outcome(f"dropped_{n}")
    for n in (
        "no_result",
        "no_legacy",
        "schema_fail",
        "tombstone",
        "exception",
        "rt_unparseable",
        "promoted",
    )
)


_ONE_FEED = "SELECT *, event_id // 40 // 50 AS run, (event_id // 40) % 50 AS page FROM events"
# Two feeds of a run: the even one is home, the odd one following.
_TWO_FEEDS = """
    SELECT *, event_id // 40 // 50 * 2 AS run, (event_id // 40) % 50 AS page FROM events
    UNION ALL
    SELECT *, event_id // 40 // 50 * 2 + 1, (event_id // 40) % 50 FROM events
    WHERE event_type IN ('click', 'purchase', 'signup')
"""


def _event_feed(count: int, pages: int, stop: bool = True, ev: str = _ONE_FEED, run: str = "run") -> str:
    """CTEs ``chain`` (kept pages) and ``feed`` (capped posts) over events."""
    return f"""
    ev AS ({ev}),
    pg AS (
      SELECT DISTINCT run, page, page * 7 + {run} * 3 AS mark,
        CASE WHEN page > 0 THEN 'c' || page END AS request
      FROM ev
    ),
    pg2 AS (
      SELECT run, page, request, mark % 37 = 29 AS bad,
        CASE WHEN mark % 37 = 29 THEN NULL WHEN mark % 29 = 23 THEN ''
             WHEN mark % 31 = 19 THEN 'c' || page ELSE 'c' || (page + 1) END AS nxt
      FROM pg
    ),
    fresh AS (
      SELECT run, page, count(*) AS fresh FROM (
        SELECT ev.run, user_id, min(ev.page) AS page FROM ev JOIN pg2 ON ev.run = pg2.run AND ev.page = pg2.page
        WHERE NOT bad AND user_id <> 0 GROUP BY ev.run, user_id) GROUP BY run, page
    ),
    filled AS (
      SELECT pg2.*, sum(coalesce(fresh, 0)) OVER (PARTITION BY pg2.run ORDER BY pg2.page) AS so_far
      FROM pg2 LEFT JOIN fresh ON pg2.run = fresh.run AND pg2.page = fresh.page
    ),
    pg3 AS (
      SELECT *, row_number() OVER w AS chain_no,
        max(CASE WHEN coalesce(nxt, '') = '' OR nxt = request OR {str(stop).lower()} AND so_far >= {count} THEN 1 ELSE 0 END)
          OVER (PARTITION BY run ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended
      FROM filled WINDOW w AS (PARTITION BY run ORDER BY page)
    ),
    chain AS (SELECT * FROM pg3 WHERE chain_no <= {pages} AND coalesce(ended, 0) = 0),
    kept AS (
      SELECT ev.*, row_number() OVER (PARTITION BY ev.run, user_id ORDER BY ev.page, event_id) AS seen
      FROM ev JOIN chain ON ev.run = chain.run AND ev.page = chain.page
      WHERE NOT chain.bad AND user_id <> 0
    ),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY run ORDER BY page, event_id) AS pos
      FROM kept WHERE seen = 1
    ),
    feed AS (SELECT * FROM ranked WHERE pos <= {count})
    """


_TOTALS = """
    first_run AS (
      SELECT user_id, min('run-' || run) AS first_run FROM feed
      WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id
    ),
    totals AS (
      SELECT run, count(*) AS fetched,
        count(*) FILTER (first_run = 'run-' || run) AS fresh
      FROM feed LEFT JOIN first_run USING (user_id) GROUP BY run
    ),
    counted AS (
      SELECT ev.run, count(*) AS raw
      FROM ev JOIN chain ON ev.run = chain.run AND ev.page = chain.page
      WHERE NOT chain.bad GROUP BY ev.run
    ),
    ends AS (
      SELECT run, bool_or(bad) AS failed,
        max_by(nxt, chain_no) FILTER (nxt <> '') AS resume
      FROM chain GROUP BY run
    ),
    ledger AS (
      SELECT r.run, coalesce(failed, false) AS failed, resume, raw,
        coalesce(fetched, 0) AS fetched, coalesce(fresh, 0) AS fresh
      FROM (SELECT DISTINCT run FROM ev) r
      LEFT JOIN ends USING (run) LEFT JOIN totals USING (run) LEFT JOIN counted USING (run)
    )
"""

_MERGE = f"""
    cur AS (
      SELECT doc_id + 1 AS id, doc_id AS author_id, source AS author_handle, lang AS author_name,
        1700000000 + doc_id AS created, text, 'old' AS reply_to_text, 'home' AS source_operation
      FROM documents
    ),
    batch AS (
      SELECT doc_id AS seq, doc_id + 138 AS id, doc_id AS author_id, source AS author_handle,
        CAST(NULL AS VARCHAR) AS author_name, 1700000000 + doc_id + 5000 AS created,
        'new ' || text AS text, CAST(NULL AS VARCHAR) AS reply_to_text,
        'following' AS source_operation
      FROM documents
      UNION ALL
      SELECT conv_id * 1000 + turn + 1000000000000, conv_id * 3 + 1, conv_id, role, role,
        1700000000 + turn, text, CASE WHEN turn % 2 = 0 THEN role END, 'op' || turn
      FROM conversations
    ),
    ordered AS (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS up,
        row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS down,
        count(*) OVER (PARTITION BY id) AS batch_rows
      FROM batch
    ),
    fst AS (SELECT * FROM ordered WHERE up = 1),
    lst AS (SELECT * FROM ordered WHERE down = 1),
    merged AS (
      SELECT coalesce(cur.id, lst.id) AS id,
        CASE WHEN lst.id IS NULL THEN cur.author_id ELSE lst.author_id END AS author_id,
        CASE WHEN lst.id IS NULL THEN cur.author_handle ELSE lst.author_handle END AS author_handle,
        CASE WHEN lst.id IS NULL THEN cur.author_name ELSE lst.author_name END AS author_name,
        strftime(make_timestamp(1000000 * coalesce(cur.created, fst.created)), {TIME}) AS created_at,
        CASE WHEN lst.id IS NULL THEN cur.text ELSE lst.text END AS text,
        CASE WHEN lst.id IS NULL THEN cur.reply_to_text ELSE lst.reply_to_text END AS reply_to_text,
        coalesce(cur.source_operation, fst.source_operation) AS source_operation,
        CASE WHEN lst.id IS NULL THEN '2024-01-01 00:00:00' ELSE {INGEST} END AS scraped_at,
        CASE WHEN lst.id IS NULL THEN 'unchanged' WHEN cur.id IS NULL THEN 'new'
             ELSE 'updated' END AS change_type,
        coalesce(lst.batch_rows, 0) AS batch_rows
      FROM cur FULL OUTER JOIN lst ON cur.id = lst.id LEFT JOIN fst ON fst.id = lst.id
    )
"""


def _mask(value: str) -> str:
    return (
        f"(CASE WHEN length({value}) <= 8 THEN repeat('*', length({value})) ELSE "
        f"left({value}, 4) || repeat('*', length({value}) - 8) || right({value}, 4) END)"
    )


def _redacted(text: str, scheme: str) -> str:
    hit = rf"(?i)({TEXT_KEYS})\s*[=:]\s*[\"'']?{scheme}(\S+)"
    gap = rf"(?i)(?:{TEXT_KEYS})\s*[=:]\s*[\"'']?{scheme}\S+"
    return f"""
      array_to_string(list_transform(
        range(1, len(string_split_regex({text}, '{gap}')) + 1),
        lambda i: string_split_regex({text}, '{gap}')[i] || CASE
          WHEN i <= len(regexp_extract_all({text}, '{hit}', 1))
          THEN regexp_extract_all({text}, '{hit}', 1)[i] || '='
            || {_mask(f"regexp_extract_all({text}, '{hit}', 2)[i]")}
          ELSE '' END), '')
    """


_SCHEME = r"(?:(?:bearer|basic|digest)\s+)?"
_WORDS = (
    r"list_distinct(string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}_]+'))"
)

# Endings and what takes their place, with a letter that must come
# before where one is needed, by the rules for English stems.
_ENDINGS_2 = """
    ational ate, tional tion, enci ence, anci ance, abli able, entli ent, izer ize, ization ize,
    ation ate, ator ate, alism al, aliti al, alli al, fulness ful, ousli ous, ousness ous,
    iveness ive, iviti ive, biliti ble, bli ble, l/ogi og, fulli ful, lessli less,
    [cdeghkmnrt]/li -
"""
_ENDINGS_3 = """
    ational ate, tional tion, alize al, icate ic, iciti ic, ical ic, ful -, ness -, 2/ative -
"""
_ENDINGS_4 = """
    al -, ance -, ence -, er -, ic -, able -, ible -, ant -, ement -, ment -, ent -, ism -, ate -,
    iti -, ous -, ive -, ize -, [st]/ion -
"""


def _ending_rules(rules: str, region: str) -> str:
    cases = []
    for rule in sorted(rules.replace("\n", " ").split(","), key=lambda r: -len(r.split()[0].split("/")[-1])):
        name, new = rule.split()
        before, _, end = name.rpartition("/")
        cut = f"left(w, length(w) - {len(end)})"
        allowed = f"length(w) - {len(end)} >= {'r2' if before == '2' else region}"
        if before not in ("", "2"):
            allowed += f" AND regexp_matches({cut}, '{before}$')"
        cases.append(f"WHEN w LIKE '%{end}' THEN CASE WHEN {allowed} THEN {cut} || '{new.strip('-')}' ELSE w END")
    return f"CASE {' '.join(cases)} ELSE w END"


_SHORT = "(^[aeiouy][^aeiouy]$)|([^aeiouy][aeiouy][^aeiouywxY]$)"


def _stems(words: str) -> str:
    """CTEs down to ``stems`` (term, stem) of the distinct terms that ``words`` selects."""
    return f"""
    s0 AS (SELECT DISTINCT term, regexp_replace(regexp_replace(term, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') AS w FROM ({words})),
    s1 AS (SELECT *, coalesce(nullif(length(regexp_extract(w, '^(?:gener|commun|arsen|.*?[aeiouy][^aeiouy])')), 0), length(w)) AS r1 FROM s0),
    s2 AS (SELECT *, coalesce(r1 + nullif(length(regexp_extract(w[r1 + 1:], '^.*?[aeiouy][^aeiouy]')), 0), length(w)) AS r2 FROM s1),
    s3 AS (SELECT * REPLACE (CASE WHEN w LIKE '%sses' THEN w[:-3]
      WHEN w LIKE '%ied' OR w LIKE '%ies' THEN CASE WHEN length(w) > 4 THEN w[:-3] ELSE w[:-2] END
      WHEN w LIKE '%us' OR w LIKE '%ss' THEN w
      WHEN regexp_matches(w, '[aeiouy].+s$') THEN w[:-2] ELSE w END AS w) FROM s2),
    s4 AS (SELECT *, CASE WHEN w IN ('inning', 'outing', 'canning', 'herring', 'earring', 'proceed', 'exceed', 'succeed')
      THEN w END AS fixed, regexp_extract(w, '(eedly|ingly|edly|eed|ing|ed)$') AS e FROM s3),
    s5 AS (SELECT *, left(w, length(w) - length(e)) AS c FROM s4),
    s6 AS (SELECT * REPLACE (CASE WHEN e = '' THEN w
      WHEN e IN ('eed', 'eedly') THEN CASE WHEN length(c) >= r1 THEN c || 'ee' ELSE w END
      WHEN NOT regexp_matches(c, '[aeiouy]') THEN w
      WHEN regexp_matches(c, '(at|bl|iz)$') THEN c || 'e'
      WHEN length(c) > 1 AND c[-1] = c[-2] AND c[-1] IN ('b', 'd', 'f', 'g', 'm', 'n', 'p', 'r', 't') THEN c[:-2]
      WHEN r1 >= length(c) AND regexp_matches(c, '{_SHORT}') THEN c || 'e' ELSE c END AS w) FROM s5),
    s7 AS (SELECT * REPLACE (regexp_replace(w, '^(.+[^aeiouy])[yY]$', '\\1i') AS w) FROM s6),
    s8 AS (SELECT * REPLACE ({_ending_rules(_ENDINGS_2, "r1")} AS w) FROM s7),
    s9 AS (SELECT * REPLACE ({_ending_rules(_ENDINGS_3, "r1")} AS w) FROM s8),
    s10 AS (SELECT * REPLACE ({_ending_rules(_ENDINGS_4, "r2")} AS w) FROM s9),
    s11 AS (SELECT * REPLACE (CASE
      WHEN w LIKE '%e' AND (length(w) > r2 OR length(w) > r1 AND NOT regexp_matches(w[:-2], '{_SHORT}')) THEN w[:-2]
      WHEN w LIKE '%ll' AND length(w) > r2 THEN w[:-2] ELSE w END AS w) FROM s10),
    stems AS (SELECT term, CASE WHEN length(term) <= 2 OR regexp_matches(term, '[\\p{{N}}_]') THEN term
      ELSE coalesce(MAP {{'skis': 'ski', 'skies': 'sky', 'dying': 'die', 'lying': 'lie', 'tying': 'tie', 'idly': 'idl',
        'gently': 'gentl', 'ugly': 'ugli', 'early': 'earli', 'only': 'onli', 'singly': 'singl', 'sky': 'sky',
        'news': 'news', 'howe': 'howe', 'atlas': 'atlas', 'cosmos': 'cosmos', 'bias': 'bias', 'andes': 'andes'}}[term],
        replace(coalesce(fixed, w), 'Y', 'y')) END AS stem FROM s11)
    """


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

_LEGACY = """
    legacy AS (
      SELECT CASE WHEN doc_id % 50 <> 7 THEN doc_id END AS id,
        CASE WHEN doc_id % 3 > 0 THEN doc_id ELSE 0 END AS author_id,
        CASE WHEN doc_id % 20 = 9 THEN repeat(source, 20) ELSE source END AS author_handle,
        CASE WHEN doc_id % 4 = 1 AND text <> '' THEN text
             WHEN doc_id % 2 = 0 THEN 'n:' || lang
             WHEN doc_id % 5 > 0 AND text <> '' THEN text
             WHEN doc_id % 4 = 1 THEN text END AS text
      FROM documents
    )
"""


def _checks(table: str) -> str:
    return f"""
      SELECT id, concat_ws(',',
        CASE WHEN id IS NULL THEN 'id_null' END,
        CASE WHEN text IS NULL THEN 'text_null' END,
        CASE WHEN length(author_handle) > 50 THEN 'author_handle_longer_than_50' END,
        CASE WHEN id IS NOT NULL AND count(*) OVER (PARTITION BY id) > 1 THEN 'id_repeated' END
      ) AS violations
      FROM {table}
    """


_PROFILE = """
    profile AS (
      SELECT c_custkey AS seq, c_custkey + 1 AS id,
        CASE WHEN c_custkey % 6 = 0 THEN 'asked' || c_custkey ELSE 'c' || c_custkey END AS screen_name,
        c_name AS name, c_mktsegment AS bio,
        CAST(c_custkey * 3 AS INTEGER) AS followers_count, c_nationkey AS following_count,
        0 AS tweets_count, c_custkey % 4 = 0 OR c_custkey % 5 = 0 AS verified
      FROM customer WHERE c_custkey % 9 <> 8
    )
"""

_THREADS = """
    SELECT a.conv_id * 1000 + a.turn + 1 AS id, {author}
      a.role AS author_handle, a.text,
      CASE WHEN a.turn > 0 THEN a.conv_id * 1000 + a.turn END AS reply_to_tweet_id,
      {handle} b.text AS reply_to_text
    FROM conversations a LEFT JOIN conversations b
      ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
"""

# Endings put behind words, so that every rule for stems is used.
_SUFFIXES = ", ".join(
    f"'{e}'"
    for e in (
        "s sses ied ies us eed eedly ed edly ing ingly y tional enci anci abli entli izer ization ational ator"
        " alism aliti alli fulness ousli ousness iveness iviti biliti bli logi fulli lessli li alize icate"
        " iciti ical ful ness ative al ance ence er able ible ant ement ment ent ism ate iti ous ive ize sion"
        " ll e ating hopping hoping"
    ).split()
)

ORACLES: dict[str, str] = {
    "thread_parse": _THREADS.format(
        author="a.conv_id + 1 AS author_id,", handle="b.role AS reply_to_author_handle,"
    ),
    "payload_status": """
      SELECT status, error_message, count(*) AS n FROM (
        SELECT CASE WHEN doc_id % 17 = 6 THEN 'rate_limited' WHEN doc_id % 19 = 7 THEN 'api_error'
            WHEN doc_id % 7 = 3 THEN 'invalid_json' WHEN doc_id % 11 = 4 THEN 'rate_limited'
            WHEN doc_id % 13 = 5 THEN 'api_error' ELSE 'ok' END AS status,
          CASE WHEN doc_id % 17 = 6 THEN 'HTTP status 429' WHEN doc_id % 19 = 7 THEN 'HTTP status 503'
            WHEN doc_id % 7 = 3 THEN 'invalid JSON' WHEN doc_id % 11 = 4 THEN 'slow down'
            WHEN doc_id % 13 = 5 THEN 'Unknown error' END AS error_message
        FROM documents) GROUP BY status, error_message
    """,
    "payload_lines": """
      SELECT status, CASE WHEN status <> 'ok' THEN 'invalid JSON' END AS error_message, count(*) AS n
      FROM (SELECT CASE WHEN doc_id % 7 = 3 OR doc_id % 10 = 9 THEN 'invalid_json' ELSE 'ok' END AS status FROM documents)
      GROUP BY status
    """,
    "timeline_paths": """
      SELECT doc_id AS run_id,
        CASE WHEN doc_id % 5 < 4 THEN 'c' || doc_id END AS next_cursor,
        CASE WHEN doc_id % 5 < 4 THEN doc_id + 1 END AS id,
        CASE WHEN doc_id % 5 < 4 THEN source END AS author_handle,
        CASE WHEN doc_id % 5 < 4 THEN 1 END AS entry_pos
      FROM documents
    """,
    "drop_reasons": f"""
      SELECT 'doc-' || doc_id AS run_id, {_OUTCOME} AS outcome,
        CASE WHEN fault = 0 THEN doc_id + 1 END AS id, CASE WHEN fault = 0 THEN text END AS text
      FROM ({_FAULT})
    """,
    "parse_stats_alert": f"""
      SELECT *, (raw - parsed) / raw * 100 AS drop_rate_percent,
        (raw - parsed) / raw * 100 > 80 AND raw > 5 AS alert
      FROM (
        SELECT source, count(*) AS raw, {_count_outcome("parsed")}, {_STATS}
        FROM (SELECT source, {_OUTCOME} AS outcome FROM ({_FAULT})) GROUP BY source)
    """,
    "retweet_quote": """
      SELECT a.doc_id AS run_id,
        CASE WHEN a.doc_id % 2 = 0 AND b.doc_id IS NOT NULL THEN a.doc_id + 2 ELSE a.doc_id + 1 END AS id,
        CASE WHEN a.doc_id % 2 = 0 AND b.doc_id IS NOT NULL THEN a.doc_id + 2 ELSE a.doc_id + 1 END AS author_id,
        CASE WHEN a.doc_id % 2 = 0 AND b.doc_id IS NOT NULL THEN b.source ELSE a.source END AS author_handle,
        CASE WHEN a.doc_id % 2 = 0 AND b.doc_id IS NOT NULL THEN b.text ELSE a.text END AS text,
        CASE WHEN b.doc_id IS NULL THEN NULL WHEN a.doc_id % 2 = 0 THEN a.doc_id + 1 ELSE a.doc_id + 2 END AS quoted_tweet_id,
        CASE WHEN a.doc_id % 2 = 0 AND b.doc_id IS NOT NULL THEN a.source ELSE b.source END AS quoted_author_handle,
        CASE WHEN a.doc_id % 2 = 0 AND b.doc_id IS NOT NULL THEN a.text ELSE b.text END AS quoted_text
      FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 1
    """,
    "media_best_variant": """
      WITH v AS (
        SELECT user_id % 50 AS user_id, event_id // 2048 AS part, event_id,
          event_type IN ('view', 'click', 'purchase') AS mp4,
          CASE WHEN event_type = 'view' THEN 0 ELSE CAST(floor(value / 50) AS BIGINT) END AS rate
        FROM events),
      best AS (
        SELECT user_id, part, first(event_id ORDER BY rate DESC, event_id) AS event_id
        FROM v WHERE mp4 GROUP BY user_id, part)
      SELECT part * 1000000 + user_id + 1 AS id,
        CASE WHEN user_id % 3 = 0 THEN 'animated_gif' ELSE 'video' END AS media_type,
        CASE WHEN event_id IS NULL THEN 'https://i.example/' || user_id || '.jpg'
             ELSE 'https://v.example/' || event_id || '.mp4' END AS media_url,
        640 AS width, 'https://i.example/p.jpg' AS photo_url,
        CAST(NULL AS INTEGER) AS photo_height, 2 AS n_media,
        'https://e.example/' || part AS links
      FROM (SELECT DISTINCT user_id, part FROM v) LEFT JOIN best USING (user_id, part)
    """,
    "safe_int": """
      SELECT l_orderkey, l_linenumber,
        CASE l_linenumber % 5 WHEN 2 THEN l_orderkey WHEN 4 THEN 0
          WHEN 3 THEN -CAST(trunc(l_extendedprice) AS BIGINT)
          ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS tolerant,
        CASE l_linenumber % 5 WHEN 2 THEN l_orderkey ELSE -1 END AS strict
      FROM lineitem
    """,
    "created_at_parse": f"""
      SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN {INGEST} ELSE
        strftime(o_orderdate + to_seconds(o_orderkey % 86400)
          - to_seconds(CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 19800 END), {TIME}) END AS created_at
      FROM orders
    """,
    "operation_aliases": """
      SELECT operation, feed_seq, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM (
        SELECT user_id, CAST(0 AS BIGINT) AS feed_seq,
          CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'home'
               WHEN event_type = 'signup' THEN 'following' ELSE event_type END AS operation
        FROM events
        UNION ALL
        SELECT user_id, 1, 'following' FROM events WHERE event_type = 'view')
      GROUP BY operation, feed_seq
    """,
    "feed_dedup_cap": f"""
      WITH {_event_feed(100, 7)}
      SELECT 'run-' || run AS run_id, pos AS feed_pos, user_id AS id, CAST(page AS INTEGER) AS page_no,
        event_type AS author_handle, 'event ' || event_id AS text,
        strftime(ts, {TIME}) AS created_at
      FROM feed
    """,
    "feed_uncapped": f"""
      WITH {_event_feed(10**12, 10**12, stop=False)}
      SELECT 'run-' || run AS run_id, pos AS feed_pos, user_id AS id, CAST(page AS INTEGER) AS page_no,
        event_type AS author_handle, 'event ' || event_id AS text,
        strftime(ts, {TIME}) AS created_at
      FROM feed
    """,
    "note_posts": """
      SELECT doc_id + 1 AS id, source AS author_handle,
        CASE doc_id % 4 WHEN 0 THEN source ELSE lang END AS author_name,
        CASE WHEN doc_id % 3 = 0 THEN text ELSE 'short of ' || source END AS text,
        CASE WHEN doc_id % 5 = 0 THEN 'search' ELSE 'home' END AS source_operation
      FROM documents
    """,
    "article_posts": """
      SELECT doc_id, CASE WHEN doc_id % 4 < 3 THEN source ELSE '' END AS title,
        CASE WHEN doc_id % 4 = 3 THEN '' WHEN text = '' THEN '1. first' ELSE
          '### ' || text || chr(10) || chr(10) || '1. first' || chr(10) || chr(10) || '2. ' || text END AS text
      FROM documents
    """,
    "page_chain": f"""
      WITH {_event_feed(500, 27, stop=False)}
      SELECT 'run-' || run AS run_id, CAST(page AS INTEGER) AS page_no,
        CASE WHEN bad THEN 'api_error' ELSE 'ok' END AS status,
        request AS request_cursor, nxt AS next_cursor
      FROM chain
    """,
    "upsert_merge": f"WITH {_MERGE} SELECT * FROM merged",
    "upsert_counts": f"""
      WITH {_MERGE}
      SELECT coalesce(author_name, 'none') AS author_name,
        count(*) FILTER (change_type = 'new') AS new_count,
        CAST(sum(batch_rows) AS BIGINT) - count(*) FILTER (change_type = 'new') AS updated_count
      FROM merged GROUP BY 1
    """,
    "run_ledger": f"""
      WITH {_event_feed(100, 7)}, {_TOTALS}
      SELECT 'run-' || run AS id, CASE WHEN failed THEN 'failed' ELSE 'completed' END AS status,
        'home' AS operation, fetched AS tweets_fetched, fresh AS tweets_new,
        fetched - fresh AS tweets_updated,
        CASE WHEN failed THEN 'over capacity' END AS error, resume AS cursor_resume,
        '100' AS asked, raw, raw AS parsed, {INGEST} AS completed_at
      FROM ledger
    """,
    "digest": f"""
      WITH {_event_feed(100, 7)}, {_TOTALS},
      part AS (
        SELECT run, 0 AS section, 0 AS pos, concat_ws(chr(10), '# Scrape Report', '',
          '| Field | Value |', '|-------|-------|',
          '| **Timestamp** | 2024-02-01T00:00:00+00:00 |', '| **Operation** | home |',
          '| **Status** | ' || CASE WHEN failed THEN 'failed' ELSE 'completed' END || ' |',
          '| **Tweets fetched** | ' || fetched || ' |', '| **New** | ' || fresh || ' |',
          '| **Updated** | ' || (fetched - fresh) || ' |',
          CASE WHEN failed THEN
            '| **Errors** | [{{"code":"SCRAPE_ERROR","message":"over capacity"}}] |' END, '') AS md
        FROM ledger
        UNION ALL
        SELECT run, 1, 0, '---' || chr(10) || chr(10) || '## New Tweets (' || fresh || ')' || chr(10)
        FROM ledger WHERE fresh > 0
        UNION ALL
        SELECT run, 2, 0, '---' || chr(10) || chr(10) || '## Updated Tweets (' || (fetched - fresh) || ')' || chr(10)
            || '_These tweets were already in the table._' || chr(10)
        FROM ledger WHERE fetched > fresh
        UNION ALL
        SELECT run, CASE WHEN first_run = 'run-' || run THEN 1 ELSE 2 END, pos,
          '### [' || pos || '] @' || event_type || ' (' || strftime(ts, '%Y-%m-%d %H:%M')
            || ' UTC)' || chr(10) || chr(10) || '> event ' || event_id || chr(10) || chr(10)
        FROM feed LEFT JOIN first_run USING (user_id))
      SELECT 'run-' || run AS run_id, 'home' AS operation, 'scrape_home_20240201_000000' AS name,
        section, pos AS feed_pos, md AS markdown
      FROM (
        SELECT * FROM part
        UNION ALL
        SELECT run, 3, 0, string_agg(md, chr(10) ORDER BY section, pos) FROM part GROUP BY run)
    """,
    "two_feeds": f"""
      WITH {_event_feed(10**12, 10**12, stop=False, ev=_TWO_FEEDS, run="(run // 2)")},
      first_feed AS (
        SELECT user_id, arg_min(run, row('run-' || (run // 2), run % 2)) AS first_feed FROM feed
        WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id
      ),
      totals AS (
        SELECT run, count(*) AS fetched, count(*) FILTER (first_feed = run) AS fresh
        FROM feed LEFT JOIN first_feed USING (user_id) GROUP BY run
      ),
      counted AS (
        SELECT ev.run, count(*) AS raw FROM ev JOIN chain ON ev.run = chain.run AND ev.page = chain.page
        WHERE NOT chain.bad GROUP BY ev.run
      ),
      ends AS (SELECT run, bool_or(bad) AS failed FROM chain GROUP BY run),
      asked AS (
        SELECT run, f, run * 2 + f AS feed FROM (SELECT DISTINCT run // 2 AS run FROM ev), (VALUES (0), (1), (2)) t(f)
      )
      SELECT 'run-' || a.run AS id, ['home', 'following', 'lists'][f + 1] AS operation,
        CASE WHEN f = 2 OR coalesce(failed, false) THEN 'failed' ELSE 'completed' END AS status,
        CASE WHEN f = 2 THEN 'UNKNOWN_OPERATION' WHEN failed THEN 'SCRAPE_ERROR' END AS error,
        CASE WHEN f < 2 THEN coalesce(fetched, 0) ELSE 0 END AS tweets_fetched,
        CASE WHEN f < 2 THEN coalesce(fresh, 0) ELSE 0 END AS tweets_new,
        CASE WHEN f < 2 THEN coalesce(fetched - fresh, 0) ELSE 0 END AS tweets_updated, raw
      FROM asked a
      LEFT JOIN totals t ON f < 2 AND t.run = a.feed
      LEFT JOIN counted c ON f < 2 AND c.run = a.feed LEFT JOIN ends e ON f < 2 AND e.run = a.feed
    """,
    "normalize_pages": r"""
      SELECT page_id, regexp_replace(regexp_replace(regexp_replace(
        replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
          html, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
          '&nbsp;', ' '), '&#39;', ''''), '—', '--'), '…', '...'), '&amp;', '&'),
        '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS clean
      FROM pages
    """,
    "normalize_noise": """
      SELECT doc_id, text || chr(10) || chr(10) || '"q" ''s''---... "x" <&lt; end https://t.co/one' AS text
      FROM documents
    """,
    "redact_documents": f"SELECT doc_id, {_redacted('text', '')} AS text FROM documents",
    "redact_strict": f"""
      SELECT doc_id, {_redacted("t", _SCHEME)} AS text
      FROM (SELECT doc_id, 'Authorization: Bearer ' || sha256(text) || ' | ' || text AS t FROM documents)
    """,
    "redact_collections": f"""
      SELECT c_custkey, {_mask("c_name")} AS token, c_mktsegment AS city, '***' AS ct0,
        {_mask("sha256(c_name)")} || ' ' || c_name || ' ' || left(sha256(c_name), 39) AS words
      FROM customer
    """,
    "secret_report": rf"""
      SELECT kind, finding, count(*) AS n FROM (
        SELECT 'key' AS kind, lower(unnest(regexp_extract_all(
          text, '(?i)({TEXT_KEYS})\s*[=:]\s*[\"'']?(\S+)', 1))) AS finding FROM documents
        UNION ALL
        SELECT 'token', 'token' FROM (
          SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents)
        WHERE regexp_full_match(word, '[A-Za-z0-9+/=_\-]{{40,}}'))
      GROUP BY kind, finding
    """,
    "article_markdown": """
      WITH b AS (
        SELECT conv_id, turn, text,
          ['header-one', 'ordered-list-item', 'ordered-list-item', 'atomic', 'ordered-list-item',
           'code-block', 'blockquote', 'unstyled', 'unordered-list-item', 'header-two', 'header-three']
          [(turn + conv_id) % 11 + 1] AS kind
        FROM conversations),
      shown AS (
        SELECT *, sum(CASE WHEN kind = 'ordered-list-item' THEN 0 ELSE 1 END)
          OVER (PARTITION BY conv_id ORDER BY turn) AS grp
        FROM b WHERE kind <> 'atomic' AND text <> ''),
      numbered AS (
        SELECT *, sum(CASE WHEN kind = 'ordered-list-item' THEN 1 ELSE 0 END)
          OVER (PARTITION BY conv_id, grp ORDER BY turn) AS num
        FROM shown),
      md AS (
        SELECT conv_id, string_agg(CASE kind
            WHEN 'header-one' THEN '# ' || text WHEN 'header-two' THEN '## ' || text
            WHEN 'header-three' THEN '### ' || text
            WHEN 'blockquote' THEN '> ' || text WHEN 'unordered-list-item' THEN '- ' || text
            WHEN 'ordered-list-item' THEN num || '. ' || text
            WHEN 'code-block' THEN '```' || chr(10) || text || chr(10) || '```'
            ELSE text END, chr(10) || chr(10) ORDER BY turn) AS markdown
        FROM numbered GROUP BY conv_id)
      SELECT conv_id, coalesce(markdown, '') AS markdown
      FROM (SELECT DISTINCT conv_id FROM b) LEFT JOIN md USING (conv_id)
    """,
    "conform_legacy": f"""
      WITH {_LEGACY}
      SELECT id, author_id, author_handle, text, CAST(NULL AS VARCHAR) AS reply_to_text,
        CAST(NULL AS BIGINT) AS quoted_tweet_id, 'home' AS source_operation
      FROM legacy
    """,
    "validate": f"""
      WITH {_LEGACY}, both_sides AS (
        SELECT * FROM legacy UNION ALL
        SELECT id + 900, author_id, author_handle, text FROM legacy)
      {_checks("both_sides")}
    """,
    "quarantine_counts": f"""
      WITH {_LEGACY}
      SELECT CASE WHEN violations = '' THEN 'valid' ELSE 'quarantine' END AS side, count(*) AS n
      FROM ({_checks("legacy")}) GROUP BY 1
    """,
    "profiles": f"""
      WITH {_PROFILE}
      SELECT id, screen_name, name, bio, followers_count, following_count, tweets_count, verified,
        CAST(NULL AS VARCHAR) AS drop_reason
      FROM profile
    """,
    "users_upsert": f"""
      WITH {_PROFILE}, cur AS (
        SELECT s_suppkey * 2 AS id, s_name AS screen_name, 'old' AS name,
          1700000000 + s_suppkey AS created FROM supplier)
      SELECT coalesce(p.id, cur.id) AS id, coalesce(p.screen_name, cur.screen_name) AS screen_name,
        coalesce(p.name, cur.name) AS name, p.bio,
        coalesce(p.followers_count, 7) AS followers_count, coalesce(p.verified, false) AS verified,
        CASE WHEN p.id IS NULL THEN '2024-01-01 00:00:00' ELSE {INGEST} END AS last_scraped_at,
        coalesce(strftime(make_timestamp(1000000 * created), {TIME}), {INGEST}) AS created_at
      FROM profile p FULL OUTER JOIN cur ON p.id = cur.id
    """,
    "read_unprocessed": f"""
      SELECT event_id AS id, event_type, strftime(ts, {TIME}) AS scraped_at
      FROM events WHERE ts > TIMESTAMP '2024-01-29 12:00:00' - INTERVAL 24 HOUR
      ORDER BY ts, event_id LIMIT 100
    """,
    "stored_table": f"""
      WITH last AS (
        SELECT *, CASE WHEN event_type IN ('purchase', 'error') THEN 2
          WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS v FROM events)
      SELECT event_id AS id, user_id AS author_id, strftime(ts, {TIME}) AS created_at,
        v || ' ' || event_type AS text, 'following' AS source_operation,
        ['2024-01-02 00:00:00', '2024-01-20 06:00:00', '2024-01-29 03:00:00'][v + 1] AS scraped_at,
        v = 2 AS recent
      FROM last
    """,
    "text_index_terms": f"""
      SELECT term, count(*) AS n, min(doc_id) AS first_id
      FROM (SELECT doc_id, unnest({_WORDS}) AS term FROM documents)
      WHERE term <> '' AND term NOT IN ({_STOP}) GROUP BY term
    """,
    "text_stems": f"""
      WITH words AS (
        SELECT unnest({_WORDS}) AS term FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark)
        UNION ALL SELECT 'a' || unnest({_WORDS}) || e FROM benchmark, unnest([{_SUFFIXES}]) t(e)
      ), {_stems(f"SELECT term FROM words WHERE term <> '' AND term NOT IN ({_STOP})")}
      SELECT term, stem FROM stems
    """,
    "text_search": f"""
      WITH words AS (SELECT doc_id, unnest({_WORDS}) AS term FROM documents),
      {_stems("SELECT term FROM words WHERE term <> ''")}
      SELECT doc_id AS id FROM words JOIN stems USING (term) WHERE stem IN ('edst', 'heed')
      GROUP BY doc_id HAVING count(DISTINCT stem) = 2
    """,
    "search_updates": f"""
      WITH newest AS (
        SELECT doc_id, CASE WHEN doc_id % 5 = 2 THEN 'Heeded by ' || source || ', relating heedings' ELSE text END AS text
        FROM documents
      ), words AS (SELECT doc_id, unnest({_WORDS}) AS term FROM newest),
      {_stems("SELECT term FROM words WHERE term <> ''")}
      SELECT doc_id AS id FROM words JOIN stems USING (term) WHERE stem = 'heed' GROUP BY doc_id
    """,
    "stream_ingest": f"""
      WITH {_event_feed(10**12, 10**12, stop=False, ev=_TWO_FEEDS, run="(run // 2)")},
      told AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY page // 25, 'run-' || (run // 2), run % 2, pos) AS nth,
          count(*) OVER (PARTITION BY user_id) AS times
        FROM feed
      ),
      totals AS (
        SELECT run, count(*) AS fetched, count(*) FILTER (nth = 1) AS fresh FROM told GROUP BY run
      ),
      ends AS (SELECT run, bool_or(bad) AS failed FROM chain GROUP BY run)
      SELECT 'post' AS kind, a.user_id::VARCHAR AS id, CASE a.run % 2 WHEN 0 THEN 'home' ELSE 'following' END AS operation,
        'event ' || b.event_id AS state, NULL::INTEGER AS fetched, NULL::INTEGER AS fresh, NULL::INTEGER AS known
      FROM told a JOIN told b ON a.user_id = b.user_id AND a.nth = 1 AND b.nth = b.times
      UNION ALL
      SELECT 'run', 'run-' || (run // 2), CASE run % 2 WHEN 0 THEN 'home' ELSE 'following' END,
        CASE WHEN failed THEN 'failed' ELSE 'completed' END,
        coalesce(fetched, 0)::INTEGER, coalesce(fresh, 0)::INTEGER, (coalesce(fetched, 0) - coalesce(fresh, 0))::INTEGER
      FROM (SELECT DISTINCT run FROM ev) LEFT JOIN totals USING (run) LEFT JOIN ends USING (run)
      UNION ALL
      SELECT 'open', 'run-' || (run // 2), CASE run % 2 WHEN 0 THEN 'home' ELSE 'following' END, 'running',
        count(DISTINCT page // 25)::INTEGER, NULL, NULL
      FROM ev GROUP BY run
      UNION ALL
      SELECT 'report', 'run-' || (run // 2), CASE run % 2 WHEN 0 THEN 'home' ELSE 'following' END, NULL,
        coalesce(fetched, 0)::INTEGER, NULL, NULL
      FROM (SELECT DISTINCT run FROM ev) LEFT JOIN totals USING (run)
    """,
    "stream_threads": _THREADS.format(author="", handle=""),
}
