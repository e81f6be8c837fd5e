"""DuckDB SQL for the registered queries, straight from the benchmark tables.

None of it goes through messages: it states the result, so a query that loses or changes a value between
building, parsing and storing its messages does not match.
"""

from __future__ import annotations

from tidecast.plans.feeds import ENVELOPE_SIZE, KEYWORDS, LEXICON, RESOLUTIONS, STOP_WORDS


# White space and word characters, spelled out for an engine whose own classes are ASCII.
SPACE = (r"\t\n\x0B\x0C\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WORD = r"\p{L}\p{N}_"
TOKEN = rf"([{WORD}\p{{M}}]+)"
CLEANING = [
    (rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+", ""), (rf"@[{WORD}]+", ""), (rf"#([{WORD}]+)", r"\1"),
    (rf"[{SPACE}]+", " "),
]


def listing(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def iso(ts: str) -> str:
    return f"regexp_replace(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '')"


def rnd(value: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    scaled = f"({value})::DOUBLE * {scale}"
    return f"(CASE WHEN abs({scaled}) < 4503599627370496::DOUBLE THEN floor({scaled} + 0.5::DOUBLE) / {scale} ELSE ({value})::DOUBLE END)"


def clean(text: str) -> str:
    out = f"lower({text})"
    for pattern, replacement in CLEANING:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    return f"trim({out})"


def kept(text: str) -> str:
    return f"list_filter(regexp_extract_all({text}, '{TOKEN}', 1), lambda w: w NOT IN ({listing(STOP_WORDS)}))"


def ratio2(value: str) -> str:
    return f"floor(({value}) + 0.5::DOUBLE) / 100.0::DOUBLE"


CTR = rnd("clicks::DOUBLE / nullif(impressions, 0) * 100.0::DOUBLE", 2)
PER_CONVERSION = rnd("CASE WHEN conversions > 0 THEN cost::DOUBLE / conversions ELSE 0 END", 2)

CTES = {
    "base": """
        SELECT o.o_orderdate::TIMESTAMP AS d, c.c_mktsegment AS typ, r.r_name AS region, o.o_orderpriority AS plat,
            sum(l.l_quantity::BIGINT) AS q, count(*) AS n, sum(round(l.l_extendedprice * 100)::BIGINT) AS cents
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation na ON c.c_nationkey = na.n_nationkey JOIN region r ON na.n_regionkey = r.r_regionkey
        GROUP BY 1, 2, 3, 4""",
    "viewership": f"SELECT d, {iso('d')} AS timestamp, sum(q)::INT AS total_viewers FROM base GROUP BY d",
    "regional": f"""
        SELECT d, {iso('d')} AS timestamp, region, sum(q)::INT AS viewers,
            (5.0::DOUBLE + (sum(q)::INT % 1000) / 100.0::DOUBLE)::FLOAT::DOUBLE AS engagement_rate
        FROM base GROUP BY d, region""",
    "platform": f"""
        SELECT d, {iso('d')} AS timestamp, plat AS platform, sum(q)::INT AS viewers,
            (0.1::DOUBLE + (sum(q)::INT % 490) / 100.0::DOUBLE)::FLOAT::DOUBLE AS buffer_rate,
            ([{listing(RESOLUTIONS)}])[(sum(q)::INT % 5) + 1] AS avg_resolution
        FROM base GROUP BY d, plat""",
    "ad_sums": """
        SELECT d, typ, sum(cents // 1000)::INT AS impressions, sum(q)::INT AS clicks,
            (sum(cents) / 100.0::DOUBLE)::FLOAT AS cost, sum(n)::INT AS conversions
        FROM base GROUP BY d, typ""",
    "ads": f"""
        SELECT d, {iso('d')} AS timestamp, typ AS type, impressions, clicks, ({CTR})::FLOAT::DOUBLE AS ctr,
            cost::DOUBLE AS cost, conversions, ({PER_CONVERSION})::FLOAT::DOUBLE AS cost_per_conversion
        FROM ad_sums""",
    "region_ads": f"""
        SELECT d, {iso('d')} AS timestamp, typ AS type, region, impressions, clicks, ({CTR})::FLOAT::DOUBLE AS ctr
        FROM (SELECT d, typ, region, sum(cents // 1000)::INT AS impressions, sum(q)::INT AS clicks
              FROM base GROUP BY d, typ, region)""",
    "campaigns": """
        SELECT typ AS campaign, sum(cents // 1000)::BIGINT AS impressions, sum(q)::BIGINT AS clicks,
            sum(cents) / 100.0::DOUBLE AS cost, sum(n)::BIGINT AS conversions, strftime(d, '%Y-%m-%d') AS date
        FROM base GROUP BY d, typ""",
    "totals": f"""
        SELECT type, {iso('max(d)')} AS event_ts, sum(impressions)::BIGINT AS impressions, sum(clicks)::BIGINT AS clicks,
            {rnd('avg(ctr)')} AS ctr, {rnd('sum(cost)')} AS cost, sum(conversions)::BIGINT AS conversions,
            {rnd('avg(cost_per_conversion)')} AS cost_per_conversion
        FROM ads GROUP BY type""",
    "homes": """
        SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_acctbal, r.r_name FROM customer c
        JOIN nation na ON c.c_nationkey = na.n_nationkey JOIN region r ON na.n_regionkey = r.r_regionkey""",
    "users": """
        SELECT c_custkey::VARCHAR AS id, c_name AS name, lower(replace(c_name, '#', '_')) AS username,
            r_name AS location, c_acctbal > 5000 AS verified FROM homes""",
    "posts": """
        SELECT d.doc_id, d.doc_id::VARCHAR AS id, e.ts AS created_ts, e.event_type,
            strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS created_at,
            CASE WHEN e.event_type <> 'error' THEN d.lang END AS lang,
            CASE WHEN e.event_type = 'error' THEN 'gone' || e.user_id ELSE e.user_id::VARCHAR END AS author_id,
            CASE WHEN e.event_type <> 'error' THEN (d.n_chars % 1000)::INT END AS like_count,
            CASE WHEN e.event_type <> 'error' THEN (d.n_chars % 97)::INT END AS retweet_count,
            'RT @user' || e.user_id || ' https://t.co/' || d.doc_id || ' #Été_' || e.event_type || ' ' || d.text AS text
        FROM documents d JOIN (
            SELECT doc_id AS event_id, coalesce(ts, TIMESTAMP '2024-01-01') AS ts, coalesce(user_id, 0) AS user_id, coalesce(event_type, 'none') AS event_type
            FROM documents LEFT JOIN events ON doc_id = event_id) e ON d.doc_id = e.event_id""",
    "tweets": f"""
        SELECT p.doc_id, p.id, p.text, p.created_ts, p.created_at, coalesce(p.lang, 'unknown') AS lang, p.like_count,
            p.retweet_count, coalesce(u.id, '') AS user_id, coalesce(u.name, '') AS user_name,
            coalesce(u.username, '') AS username, coalesce(u.location, '') AS location,
            coalesce(u.verified, false) AS verified, 'twitter' AS source,
            array_to_string(list_filter([{listing(KEYWORDS)}], lambda k: contains(lower(p.text), lower(k))), '|') AS keywords,
            p.author_id
        FROM posts p LEFT JOIN users u ON p.author_id = u.id""",
    "cleaned": f"SELECT id, created_ts, {clean('text')} AS cleaned FROM posts",
    "words": f"SELECT id, {kept('cleaned')} AS words FROM cleaned",
    "lexicon": "SELECT token, round(valence * 1e6)::BIGINT AS v FROM (VALUES "
               + ", ".join(f"('{w}', {v}::DOUBLE)" for w, v in LEXICON) + ") AS t(token, valence)",
    "word_list": f"""
        SELECT token, round(((length(token) % 9) - 4) / 2.0::DOUBLE * 1e6)::BIGINT AS v FROM (
            SELECT DISTINCT unnest(regexp_extract_all({clean('text')}, '{TOKEN}', 1)) AS token FROM benchmark)""",
    "classifier": """
        SELECT doc_id::VARCHAR AS id, CASE WHEN toxic = 0 THEN s ELSE 1.0::DOUBLE - s END AS h FROM (
            SELECT *, CASE WHEN quality = 1 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS s FROM labels)""",
}


def polarity(lexicon: str) -> str:
    return f"""
        SELECT id, n AS n_words,
            CASE WHEN n > 0 THEN {rnd('gain / total', 3)} ELSE 0 END AS pos,
            CASE WHEN n > 0 THEN {rnd('neutral / total', 3)} ELSE 0 END AS neu,
            CASE WHEN n > 0 THEN {rnd('loss / total', 3)} ELSE 0 END AS neg,
            CASE WHEN n > 0 THEN {rnd('s / sqrt(s * s + 15.0::DOUBLE)', 4)} ELSE 0 END AS compound
        FROM (SELECT *, gain + loss + neutral AS total FROM (
            SELECT w.id, len(any_value(w.words)) AS n,
                coalesce(sum(CASE WHEN v > 0 THEN v + 1000000 END), 0)::DOUBLE AS gain,
                coalesce(sum(CASE WHEN v < 0 THEN 1000000 - v END), 0)::DOUBLE AS loss,
                (count(CASE WHEN coalesce(v, 0) = 0 AND u.token IS NOT NULL THEN 1 END) * 1000000)::DOUBLE AS neutral,
                coalesce(sum(v), 0)::DOUBLE / 1e6 AS s
            FROM words w LEFT JOIN (SELECT id, unnest(words) AS token FROM words) u ON w.id = u.id
            LEFT JOIN {lexicon} x ON u.token = x.token GROUP BY w.id))"""


def blend(pos: str, neu: str, neg: str, compound: str, h: str) -> str:
    up, down, flat = f"{pos} * 0.7::DOUBLE + {h} * 0.3::DOUBLE", \
        f"{neg} * 0.7::DOUBLE + (1.0::DOUBLE - {h}) * 0.3::DOUBLE", f"{neu} * 0.7::DOUBLE"
    total = f"(({up}) + ({down}) + ({flat}))"
    use = f"{h} IS NOT NULL AND {pos} + {neu} + {neg} > 0"

    def part(name: str, mixed: str, plain: str) -> str:
        return f"""(CASE WHEN {use} THEN CASE WHEN {total} > 0 THEN ({mixed}) / {total} ELSE {mixed} END
            ELSE {plain} END)::FLOAT::DOUBLE AS {name}"""
    return ", ".join([part("positive", up, pos), part("neutral", flat, neu), part("negative", down, neg),
                      f"({compound})::FLOAT::DOUBLE AS compound"])


CTES["scores"] = polarity("lexicon")
CTES["list_scores"] = polarity("word_list")
CTES["sentiment"] = f"""
    SELECT s.id, {blend('s.pos', 's.neu', 's.neg', 's.compound', 'c.h')}
    FROM scores s LEFT JOIN classifier c ON s.id = c.id"""
CTES["windows"] = """
    SELECT time_bucket(INTERVAL 5 MINUTE, p.created_ts) AS ws, time_bucket(INTERVAL 5 MINUTE, p.created_ts)
        + INTERVAL 5 MINUTE AS we, avg(positive) AS p, avg(neutral) AS u, avg(negative) AS n, avg(compound) AS c
    FROM sentiment s JOIN posts p ON s.id = p.id GROUP BY ALL"""
CTES["closed"] = "SELECT * FROM windows WHERE we <= (SELECT max(created_ts) FROM posts) - INTERVAL 10 MINUTE"
CTES["state"] = """
    SELECT 'audience/' || r_name AS path, c_custkey::VARCHAR AS key,
        '{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS value_json, c_acctbal FROM homes"""

# Which other parts each part reads, in an order that defines before use.
ORDER = ["base", "viewership", "regional", "platform", "ad_sums", "ads", "region_ads", "campaigns", "totals", "homes",
         "users", "posts", "tweets", "cleaned", "words", "lexicon", "word_list", "classifier", "scores", "list_scores",
         "sentiment", "windows", "closed", "state"]


def with_ctes(sql: str, *names: str) -> str:
    needed, queue = set(), list(names)
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue += [o for o in ORDER if f" {o}" in CTES[name].replace("\n", " ") and o != name and _reads(name, o)]
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in ORDER if n in needed)
    return f"WITH {parts}\n{sql}"


def _reads(name: str, other: str) -> bool:
    import re
    return re.search(rf"(FROM|JOIN)\s+{other}\b", CTES[name]) is not None


REGIONAL = "timestamp, region, viewers, engagement_rate"
PLATFORM = "timestamp, platform, viewers, buffer_rate, avg_resolution"
ADS = "timestamp, type, impressions, clicks, ctr, cost, conversions, cost_per_conversion"
REGION_ADS = "timestamp, type, region, impressions, clicks, ctr"
TWEET = ("id, text, created_at, lang, like_count, retweet_count, user_id, user_name, username, location, verified, "
         "source, keywords")
WINDOW = (f"{iso('ws')} AS window_start, {iso('we')} AS window_end, {rnd('p')} AS avg_positive, {rnd('u')} AS avg_neutral, "
          f"{rnd('n')} AS avg_negative, {rnd('c')} AS avg_compound")
MEASURES = f"{rnd('p')} AS positive, {rnd('u')} AS neutral, {rnd('n')} AS negative, {rnd('c')} AS compound"


def spread(where: str = "") -> str:
    return f"""
        SELECT v.timestamp, v.total_viewers, x.part, x.name, x.viewers, x.rate, x.resolution FROM viewership v JOIN (
            SELECT d, 'region' AS part, region AS name, viewers, engagement_rate AS rate, '' AS resolution FROM regional
            UNION ALL SELECT d, 'platform', platform, viewers, buffer_rate, avg_resolution FROM platform) x ON v.d = x.d
        {where}"""


NEWEST = "WHERE v.d = (SELECT max(d) FROM viewership)"


def since(table: str, ts: str, hours: int) -> str:
    return f"WHERE {ts} >= (SELECT max({ts}) FROM {table}) - INTERVAL {hours} HOUR"


ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str, *ctes: str) -> None:
    ORACLE[name] = with_ctes(sql, *ctes) if ctes else sql


# Sources
oracle("source_replay", "SELECT timestamp, total_viewers FROM viewership", "viewership")
oracle("parse_tweets", f"SELECT {TWEET} FROM tweets", "tweets")
oracle("tweets_dedup", f"SELECT {TWEET} FROM tweets", "tweets")
oracle("parse_viewership", """
    SELECT v.timestamp, v.timestamp AS event_ts, v.total_viewers,
        (SELECT count(*) FROM regional r WHERE r.d = v.d)::INT AS n_regions,
        (SELECT count(*) FROM platform p WHERE p.d = v.d)::INT AS n_platforms FROM viewership v""",
       "viewership", "regional", "platform")
oracle("parse_ads", """
    SELECT timestamp, timestamp AS event_ts, count(DISTINCT type)::INT AS n_ads, count(*)::INT AS n_regions
    FROM region_ads GROUP BY timestamp""", "region_ads")
oracle("parse_rejects", "SELECT text AS value FROM documents UNION ALL SELECT props FROM events")
oracle("collection_find_many", f"""
    SELECT {TWEET} FROM tweets WHERE lang = 'en' AND location = 'ASIA' ORDER BY doc_id LIMIT 100""", "tweets")
oracle("collection_find_one", f"""
    SELECT {TWEET} FROM tweets WHERE lang = 'fr' AND verified ORDER BY doc_id LIMIT 1""", "tweets")
oracle("warehouse_sql", """
    SELECT region, count(*) AS messages, sum(viewers)::BIGINT AS viewers, max(viewers) AS peak
    FROM regional WHERE viewers >= 100 GROUP BY region""", "regional")
oracle("latest_state_get", "SELECT path, key, value_json FROM state WHERE path = 'audience/ASIA'", "state")
oracle("campaign_json_scan", "SELECT * FROM campaigns", "campaigns")
oracle("campaign_array_scan", "SELECT * FROM campaigns", "campaigns")

# Posts and ad metrics
oracle("tweets_recent_window", """
    SELECT id, created_at, text FROM posts
    WHERE created_ts >= (SELECT max(created_ts) FROM posts) - INTERVAL 15 MINUTE""", "posts")
oracle("tweets_keyword_filter", "SELECT id, text FROM posts WHERE "
       + " OR ".join(f"contains(lower(text), lower('{k}'))" for k in KEYWORDS), "posts")
oracle("tweets_capped", "SELECT id, created_at FROM posts ORDER BY created_ts DESC, id LIMIT 100", "posts")
oracle("tweets_join_users", """
    SELECT p.id, p.author_id, u.name AS user_name, u.username, u.location, u.verified
    FROM posts p LEFT JOIN users u ON p.author_id = u.id""", "posts", "users")
oracle("tweets_defaults", """
    SELECT id, lang, CASE WHEN like_count IS NULL THEN 0 ELSE 2 END AS n_metrics, user_id, user_name, location, verified,
        '' AS profile_image_url FROM tweets""", "tweets")
oracle("tweets_keyword_tags", """
    SELECT id, keywords, CASE WHEN keywords = '' THEN 0 ELSE len(string_split(keywords, '|')) END::INT AS n_keywords
    FROM tweets""", "tweets")
oracle("tweets_envelope_guard", f"""
    SELECT first(id ORDER BY doc_id) AS first_id, count(*)::INT AS n_posts,
        (2 * count(DISTINCT nullif(user_id, '')))::INT AS n_users
    FROM tweets GROUP BY doc_id // {ENVELOPE_SIZE} HAVING count(nullif(user_id, '')) > 0""", "tweets")
oracle("tweets_normalize", f"""
    SELECT {TWEET} FROM tweets t WHERE EXISTS (SELECT 1 FROM tweets o
        WHERE o.doc_id // {ENVELOPE_SIZE} = t.doc_id // {ENVELOPE_SIZE} AND o.user_id <> '')""", "tweets")
oracle("ad_metrics", f"""
    SELECT timestamp, type, {CTR} AS ctr, {PER_CONVERSION} AS cost_per_conversion FROM ads""", "ads")
oracle("regional_ad_metrics", f"SELECT timestamp, type, region, {CTR} AS ctr FROM region_ads", "region_ads")
oracle("campaign_metrics", f"""
    SELECT *, {CTR} AS ctr, {PER_CONVERSION} AS cost_per_conversion FROM campaigns""", "campaigns")

# Flatten; the streams and the stored tables hold the same rows
for name in ("regional_viewership", "regional_viewership_stream", "sink_regional"):
    oracle(name, f"SELECT {REGIONAL} FROM regional", "regional")
for name in ("platform_viewership", "sink_platform"):
    oracle(name, f"SELECT {PLATFORM} FROM platform", "platform")
for name in ("ads_flat", "sink_ads"):
    oracle(name, f"SELECT {ADS} FROM ads", "ads")
for name in ("regional_ads", "regional_ads_stream", "sink_regional_ads"):
    oracle(name, f"SELECT {REGION_ADS} FROM region_ads", "region_ads")

# Text and sentiment
oracle("text_clean", "SELECT id, cleaned FROM cleaned", "cleaned")
oracle("text_tokens_filtered", """
    SELECT id, len(words)::INT AS n_words, array_to_string(words, ' ') AS kept FROM words""", "words")
oracle("sentiment_empty_guard", """
    SELECT id, event_type, event_type IN ('error', 'view', 'click') AS all_zero FROM posts""", "posts")
oracle("lexicon_sentiment", "SELECT * FROM scores", "scores")
for name in ("lexicon_sentiment_joined", "lexicon_sentiment_inline"):
    oracle(name, "SELECT * FROM list_scores", "list_scores")
oracle("classifier_score", """
    SELECT p.id, length(p.cleaned)::INT AS n_chars, c.h FROM cleaned p LEFT JOIN classifier c ON p.id = c.id""",
       "cleaned", "classifier")
oracle("classifier_hook", f"""
    SELECT id, {rnd('sum(length(piece) * CASE WHEN e + n = 0 THEN 0.5 ELSE e / (e + n) END) / sum(length(piece))')} AS h
    FROM (SELECT id, piece, (length(piece) - length(replace(piece, 'e', '')))::DOUBLE AS e,
            (length(piece) - length(replace(piece, 'n', '')))::DOUBLE AS n
          FROM (SELECT id, substring(cleaned, g.at, 512) AS piece
                FROM cleaned, LATERAL (SELECT unnest(range(1, length(cleaned) + 1, 512)) AS at) g))
    GROUP BY id""", "cleaned")
oracle("sentiment_combine", f"""
    SELECT event_id, {rnd('positive')} AS positive, {rnd('neutral')} AS neutral, {rnd('negative')} AS negative,
        {rnd('compound')} AS compound
    FROM (SELECT event_id, {blend('pos', 'neu', 'neg', 'compound', 'h')}
          FROM (SELECT event_id, x AS pos, (1 - x) * 0.25::DOUBLE AS neg, (1 - x) * 0.75::DOUBLE AS neu,
                       x - 0.5::DOUBLE AS compound,
                       CASE event_type WHEN 'click' THEN 0.9::DOUBLE WHEN 'view' THEN 0.2::DOUBLE END AS h
                FROM (SELECT *, least(abs(value) / 100.0::DOUBLE, 1.0::DOUBLE) AS x FROM events)))""")
oracle("tweet_sentiment", "SELECT id, positive, neutral, negative, compound FROM sentiment", "sentiment")

# Windows
for name in ("sentiment_5min", "sentiment_5min_complete", "sentiment_5min_maintained"):
    oracle(name, f"SELECT {WINDOW} FROM windows", "windows")
for name in ("sentiment_5min_append", "sink_sentiment"):
    oracle(name, f"SELECT {WINDOW} FROM closed", "closed")
oracle("sentiment_late_drop", f"""
    SELECT {WINDOW} FROM (
        SELECT ws, we, avg(positive) AS p, avg(neutral) AS u, avg(negative) AS n, avg(compound) AS c
        FROM (SELECT *, max(CASE WHEN on_time THEN created_ts END) OVER () - INTERVAL 10 MINUTE AS mark,
                     max(created_ts) OVER () - INTERVAL 10 MINUTE AS last_mark
              FROM (SELECT s.*, p.created_ts, time_bucket(INTERVAL 5 MINUTE, p.created_ts) AS ws,
                        time_bucket(INTERVAL 5 MINUTE, p.created_ts) + INTERVAL 5 MINUTE AS we,
                        p.event_type <> 'error' AND p.created_ts < TIMESTAMP '2024-01-02 12:00:00' AS on_time
                    FROM sentiment s JOIN posts p ON s.id = p.id))
        WHERE (on_time OR we > mark) AND we <= last_mark
        GROUP BY ws, we)""", "sentiment", "posts")
oracle("fanout_counts", """
    SELECT 'posts' AS name, count(*) AS n FROM posts UNION ALL SELECT 'sentiment_windows', count(*) FROM closed
    UNION ALL SELECT 'viewership', count(*) FROM viewership UNION ALL SELECT 'regional_viewership', count(*) FROM regional
    UNION ALL SELECT 'platform_viewership', count(*) FROM platform
    UNION ALL SELECT 'ads', count(DISTINCT d) FROM ads UNION ALL SELECT 'ad_performance', count(*) FROM ads
    UNION ALL SELECT 'regional_ads', count(*) FROM region_ads""",
       "posts", "closed", "viewership", "regional", "platform", "ads", "region_ads")

# Aggregates and latest records
for name in ("ads_by_type", "ads_by_type_maintained"):
    oracle(name, "SELECT * FROM totals", "totals")
for name in ("latest_ads", "current_ads"):
    oracle(name, f"""
        SELECT (SELECT {iso('max(d)')} FROM ads) AS timestamp, type, impressions, clicks, ctr, cost, conversions,
            cost_per_conversion FROM totals""", "totals", "ads")
for name in ("latest_sentiment", "current_sentiment"):
    oracle(name, f"SELECT {iso('we')} AS timestamp, {MEASURES} FROM windows ORDER BY we DESC LIMIT 1", "windows")
for name in ("latest_viewership", "current_viewership"):
    oracle(name, spread(NEWEST), "viewership", "regional", "platform")
oracle("recent_tweets", """
    SELECT t.id, t.created_at, t.text, t.lang, s.positive, s.neutral, s.negative, s.compound
    FROM tweets t JOIN sentiment s ON t.id = s.id ORDER BY t.created_ts DESC, t.id LIMIT 10""", "tweets", "sentiment")

# Sinks
oracle("sink_tweets", """
    SELECT t.id, t.text, t.created_at, t.lang, t.source, s.positive, s.neutral, s.negative, s.compound
    FROM tweets t JOIN sentiment s ON t.id = s.id""", "tweets", "sentiment")
ORACLE["sink_tweets_once"] = ORACLE["sink_tweets"]


oracle("sink_viewership", spread(), "viewership", "regional", "platform")
oracle("sink_ads_raw", """
    SELECT a.timestamp, a.type, a.impressions, a.clicks, a.cost,
        (SELECT count(*) FROM region_ads r WHERE r.d = a.d AND r.type = a.type)::INT AS n_regions FROM ads a""",
       "ads", "region_ads")

# State
BLOCKED = "'{\"blocked\":true}'"
oracle("state_update", f"""
    SELECT path, key, CASE WHEN c_acctbal < 0 THEN {BLOCKED} ELSE value_json END AS value_json FROM state""", "state")
oracle("state_set", f"""
    SELECT path, key, CASE WHEN path = 'audience/ASIA' THEN {BLOCKED} ELSE value_json END AS value_json FROM state
    WHERE path <> 'audience/ASIA' OR c_acctbal < 0""", "state")
oracle("state_push", """
    SELECT 'orders/log' AS path, 7::BIGINT AS batch_id, strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n_keys,
        min(v) AS first_value, max(v) AS last_value
    FROM (SELECT *, '{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS v FROM orders)
    GROUP BY 1, 2, 3""")
oracle("state_delete", "SELECT path, key, value_json FROM state WHERE path <> 'audience/ASIA'", "state")

# Warehouse records and collections
oracle("store_viewership", """
    SELECT timestamp || '/' || region AS id, timestamp, NULL::VARCHAR AS match_id, viewers AS total_viewers, region,
        NULL::VARCHAR AS platform, NULL::DOUBLE AS avg_watch_time FROM regional""", "regional")
oracle("store_sentiment", f"""
    SELECT t.id, {iso('t.created_ts')} AS timestamp, NULL::VARCHAR AS match_id, t.source, t.text, s.compound, s.positive,
        s.neutral, s.negative, t.location AS region FROM tweets t JOIN sentiment s ON t.id = s.id""", "tweets", "sentiment")
oracle("store_ad_performance", """
    SELECT timestamp || '/' || type AS id, timestamp, NULL::VARCHAR AS match_id, NULL::VARCHAR AS ad_id, type, impressions,
        clicks, conversions, cost, ctr FROM ads""", "ads")
oracle("collection_insert", "SELECT id, 2::BIGINT AS n, 2::BIGINT AS n_keys, text FROM posts", "posts")
FIRST = "(SELECT min(doc_id) FROM tweets WHERE lang = 'de' AND verified)"
oracle("collection_update_one", f"""
    SELECT id, CASE WHEN doc_id = {FIRST} THEN 'at' ELSE lang END AS lang,
        CASE WHEN doc_id = {FIRST} THEN 'corrected' ELSE source END AS source FROM tweets""", "tweets")
oracle("collection_delete_one", f"""
    SELECT id, lang FROM tweets WHERE {FIRST} IS NULL OR doc_id <> {FIRST}""", "tweets")

# Read side
oracle("viewership_history", f"SELECT {REGIONAL} FROM regional {since('regional', 'd', 720)}", "regional")
oracle("sentiment_history", f"SELECT {iso('we')} AS timestamp, {MEASURES} FROM closed {since('closed', 'we', 720)}", "closed")
oracle("ads_history", f"SELECT {ADS} FROM ads {since('ads', 'd', 720)}", "ads")
EXPORT_VIEWERS = f"""SELECT 'viewership' AS section, timestamp, region, viewers, {rnd('engagement_rate')} AS engagement_rate
    FROM regional {since('regional', 'd', 24)}"""
EXPORT_SENTIMENT = f"SELECT 'sentiment' AS section, {iso('we')} AS timestamp, {MEASURES} FROM closed {since('closed', 'we', 24)}"
EXPORT_ADS = f"""SELECT 'ads' AS section, timestamp, type, impressions, clicks, {rnd('ctr')} AS ctr, {rnd('cost')} AS cost,
    conversions, {rnd('cost_per_conversion')} AS cost_per_conversion FROM ads {since('ads', 'd', 24)}"""
oracle("export_viewership", EXPORT_VIEWERS, "regional")
oracle("export_sentiment", EXPORT_SENTIMENT, "closed")
oracle("export_ads", EXPORT_ADS, "ads")
oracle("export_all", f"{EXPORT_VIEWERS} UNION ALL BY NAME {EXPORT_SENTIMENT} UNION ALL BY NAME {EXPORT_ADS}",
       "regional", "closed", "ads")

# Dashboard
oracle("card_total_viewers", "SELECT timestamp, total_viewers FROM viewership ORDER BY d DESC LIMIT 1", "viewership")
oracle("viewers_by_region", "SELECT region, sum(viewers)::BIGINT AS viewers FROM regional GROUP BY region", "regional")
oracle("viewers_over_time", "SELECT timestamp, total_viewers::BIGINT AS total_viewers FROM viewership", "viewership")
oracle("card_compound", f"SELECT {rnd('avg(c)')} AS compound FROM closed", "closed")
oracle("sentiment_trend", f"""
    SELECT {iso('we')} AS timestamp, {rnd('p')} AS positive, {rnd('u')} AS neutral, {rnd('n')} AS negative FROM closed""",
       "closed")
oracle("sentiment_by_region", f"""
    SELECT t.location AS region, {rnd('avg(s.positive)')} AS positive FROM tweets t JOIN sentiment s ON t.id = s.id
    GROUP BY 1""", "tweets", "sentiment")
oracle("card_ctr", f"""
    SELECT {rnd('avg(ctr)')} AS ctr, {rnd('sum(clicks)::DOUBLE / sum(impressions) * 100.0::DOUBLE')} AS weighted_ctr FROM ads""",
       "ads")
oracle("ad_performance_by_type", """
    SELECT type, sum(impressions)::BIGINT AS impressions, sum(clicks)::BIGINT AS clicks,
        sum(conversions)::BIGINT AS conversions FROM ads GROUP BY type""", "ads")
oracle("ad_cost_over_time", f"SELECT timestamp, {rnd('sum(cost)')} AS cost FROM ads GROUP BY timestamp", "ads")
