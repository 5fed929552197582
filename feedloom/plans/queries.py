"""The registered queries: every operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.scalars import safe_int, strict_int, wire_date
from feedloom.functions.stems import stem_words
from feedloom.operators.articles import articles_to_markdown, blocks_to_markdown
from feedloom.operators.digest import render_digest, whole_reports
from feedloom.operators.feed import ARRIVAL, FEED, assemble_feed, canonical_operation, chain_pages, resolve_operations
from feedloom.operators.flatten import flatten_timeline, page_summary
from feedloom.operators.ledger import close_runs, open_runs
from feedloom.operators.maintenance import conform_legacy, side_counts, validate_tweets
from feedloom.operators.merge import change_types, delta_tweets, merge_counts, merge_tweets, upsert_users
from feedloom.operators.normalize import normalize_table
from feedloom.operators.parse import parse_tweets
from feedloom.operators.profiles import parse_profiles
from feedloom.operators.reads import read_unprocessed
from feedloom.operators.redact import redact_table, secret_report
from feedloom.operators.search import STOP_WORDS, TextIndex, build_text_index, terms_of, words_of
from feedloom.operators.stats import parse_stats
from feedloom.plans import capture
from feedloom.plans.ingest import parse_pages, run_ledger_table, shared_dir, stored, stored_pages, tweet_table
from feedloom.schemas import TWEETS, USERS
from feedloom.session import configure
from feedloom.sources.payloads import ingest_payloads, read_payload_lines
from feedloom.streaming.ingest import CAPTURE, read_capture_stream, stream_ingest, stream_parse

INGEST_TS = "2024-02-01 00:00:00"
FEED_COUNT = 100
RUN_COUNT = 500

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _stamp_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# ── payloads, flattening, parsing ────────────────────────────────────────


def thread_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = capture.thread_pages(_table(spark, sf_dir, "conversations"))
    return parse_pages(pages, INGEST_TS).select(
        "id",
        "author_id",
        "author_handle",
        "text",
        "reply_to_tweet_id",
        "reply_to_author_handle",
        "reply_to_text",
    )


def payload_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    node = capture.post_node(doc + 1, doc, F.col("source"), F.col("text"))
    whole = capture.page(F.array(capture.single_entry(node)))
    value = (
        F.when(doc % 7 == 3, F.substring(whole, F.lit(1), F.length(whole) - 2))
        .when(doc % 11 == 4, F.lit('{"errors":[{"code":88,"message":"slow down"}],"data":{}}'))
        .when(doc % 13 == 5, F.lit('{"errors":[{"code":34}]}'))
        .otherwise(whole)
    )
    http = F.when(doc % 17 == 6, 429).when(doc % 19 == 7, 503)
    pages = docs.select(value.alias("value"), http.alias("http_status"))
    return ingest_payloads(pages).groupBy("status", "error_message").agg(F.count("*").alias("n"))


def timeline_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    node = capture.post_node(doc + 1, doc, F.col("source"), F.col("text"))
    # Two bottom cursors: the last one counts.
    entries = F.array(
        capture.cursor_entry(F.lit("early")),
        capture.single_entry(node),
        capture.cursor_entry(F.concat(F.lit("c"), doc)),
    )
    steps = capture.instructions(entries)
    empty_home = '{"data":{"home":{"home_timeline_urt":{"instructions":[]}},'
    beside = capture.SEARCH.replace('{"data":{', empty_home, 1)
    shapes = [capture.HOME, beside, capture.USER, capture.LIST]
    value = F.when(doc % 5 == 4, F.lit('{"data":{"home":null}}'))
    for number, shape in enumerate(shapes):
        value = value.when(doc % 5 == number, capture.template(shape, steps))
    captured = docs.select(
        doc.alias("run_id"), F.lit("home").alias("operation"), value.alias("value")
    )
    pages = stored(ingest_payloads(captured), f"{shared_dir(spark)}/bronze")
    cursors = page_summary(pages).select("run_id", "next_cursor")
    posts = parse_tweets(flatten_timeline(pages), INGEST_TS)
    return cursors.join(posts.select("run_id", "id", "author_handle", "entry_pos"), "run_id", "left")


def _fault() -> Column:
    """Fault number per document; one source fails nearly always."""
    return F.when((F.col("source") == "src3") & (F.col("doc_id") % 10 > 0), 2 + F.col("doc_id") % 3).otherwise(
        F.col("doc_id") % capture.FAULTS
    )


def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = capture.faulty_pages(_table(spark, sf_dir, "documents"), _fault())
    parsed = parse_pages(pages, INGEST_TS)
    return parsed.select("run_id", F.coalesce("drop_reason", F.lit("parsed")).alias("outcome"), "id", "text")


def parse_stats_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = capture.faulty_pages(_table(spark, sf_dir, "documents"), _fault())
    return parse_stats(parse_pages(pages, INGEST_TS), ["source"])


def retweet_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even documents repost the next one, which quotes them; odd ones quote it.

    A document without a next one is a plain post.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    following = docs.select(
        (F.col("doc_id") - 1).alias("doc_id"),
        F.col("source").alias("next_source"),
        F.col("text").alias("next_text"),
        F.lit(True).alias("has_next"),
    )
    pairs = docs.join(following, "doc_id", "left")
    doc = F.col("doc_id")
    own = capture.post_node(doc + 1, doc + 1, F.col("source"), F.col("text"))
    quote_own = capture.template(',"quoted_status_result":{"result":%s}', own)
    other = capture.post_node(
        doc + 2, doc + 2, F.col("next_source"), F.col("next_text"), outer=F.when(doc % 2 == 0, quote_own)
    )
    wrapped = F.when(
        doc % 3 == 0, capture.template('{"__typename":"TweetWithVisibilityResults","tweet":%s}', other)
    ).otherwise(other)
    plain = capture.post_node(doc + 1, doc + 1, F.col("source"), F.col("text"))
    node = F.when(F.col("has_next").isNull(), plain).when(
        doc % 2 == 0,
        capture.post_node(
            doc + 1,
            doc + 1,
            F.col("source"),
            F.concat(F.lit("RT "), F.col("source")),
            legacy=capture.template(',"retweeted_status_result":{"result":%s}', wrapped),
        ),
    ).otherwise(
        capture.post_node(
            doc + 1,
            doc + 1,
            F.col("source"),
            F.col("text"),
            outer=capture.template(',"quoted_status_result":{"result":%s}', wrapped),
        )
    )
    pages = pairs.select(
        doc.alias("run_id"), capture.page(F.array(capture.single_entry(node))).alias("value")
    )
    return parse_pages(pages, INGEST_TS).select(
        "run_id",
        "id",
        "author_id",
        "author_handle",
        "text",
        "quoted_tweet_id",
        "quoted_author_handle",
        "quoted_text",
    )


# So many events of the log are spread over so many videos.
MEDIA_PART = 2048
VIDEOS = 50


def media_best_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a stretch of the log are variants of its videos; many rates are equal."""
    events = _table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id") % VIDEOS)
    part = F.floor(F.col("event_id") / MEDIA_PART)
    rate = F.floor(F.col("value") / 50)
    variant = capture.template(
        '{"content_type":"%s"%s,"url":"https://v.example/%s.mp4"}',
        F.when(F.col("event_type").isin("view", "click", "purchase"), "video/mp4").otherwise("application/x-mpegURL"),
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(capture.member("bitrate", rate)),
        F.col("event_id"),
    )
    grouped = (
        events.select("user_id", part.alias("part"), F.struct("event_id", variant.alias("v")).alias("p"))
        .groupBy("user_id", "part")
        .agg(F.array_sort(F.collect_list("p")).alias("ps"))
    )
    kind = F.when(F.col("user_id") % 3 == 0, "animated_gif").otherwise("video")
    media = capture.template(
        ',"extended_entities":{"media":[{"type":"%s","media_url_https":"https://i.example/%s.jpg",'
        '"original_info":{"width":640,"height":360},"video_info":{"variants":[%s]}},'
        '{"type":"photo","media_url_https":"https://i.example/p.jpg"},{"type":"poll"}]},'
        '"entities":{"urls":[{"expanded_url":"https://e.example/%s"},{"expanded_url":""},{}]}',
        kind,
        F.col("user_id"),
        F.array_join(F.transform("ps", lambda p: p["v"]), ","),
        F.col("part"),
    )
    node = capture.post_node(
        F.col("part") * 1000000 + F.col("user_id") + 1, F.col("user_id"), F.lit("u"), F.lit("clip"), media
    )
    pages = grouped.select(capture.page(F.array(capture.single_entry(node))).alias("value"))
    first, second = F.get("media_urls", F.lit(0)), F.get("media_urls", F.lit(1))
    return parse_pages(pages, INGEST_TS).select(
        "id",
        first["type"].alias("media_type"),
        first["url"].alias("media_url"),
        first["width"].alias("width"),
        second["url"].alias("photo_url"),
        second["height"].alias("photo_height"),
        F.size("media_urls").alias("n_media"),
        F.array_join("urls", " ").alias("links"),
    )


def safe_int_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire numbers in several spellings to integers."""
    line = F.col("l_linenumber") % 5
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    text = (
        F.when(line == 0, F.format_number(price, 2))
        .when(line == 1, price.cast("string"))
        .when(line == 2, F.concat(F.lit(" +"), F.col("l_orderkey"), F.lit(" ")))
        .when(line == 3, F.concat(F.lit("-"), price.cast("string")))
        .otherwise(F.concat(F.col("l_returnflag"), F.col("l_orderkey")))
    )
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        safe_int(text).alias("tolerant"),
        strict_int(text, -1).alias("strict"),
    )


def created_at_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    moment = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=key % 86400)
    zone = F.when(key % 2 == 0, "+0000").otherwise("+0530")
    text = F.when(key % 5 == 4, F.col("o_orderpriority")).otherwise(
        F.concat(
            F.date_format(moment, "EEE MMM dd HH:mm:ss "), zone, F.date_format(moment, " yyyy")
        )
    )
    stamp = F.lit(INGEST_TS).cast("timestamp")
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(wire_date(text, stamp), "yyyy-MM-dd HH:mm:ss").alias("created_at")
    )


def operation_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"view": " Scheduled", "click": "for-you ", "purchase": "FORYOU", "signup": "following"}
    asked = F.col("event_type")
    for kind, name in names.items():
        asked = F.when(F.col("event_type") == kind, name).otherwise(asked)
    requests = _table(spark, sf_dir, "events").select("user_id", asked.alias("operation"))
    return (
        resolve_operations(requests)
        .groupBy("operation", F.col("feed_seq").cast("bigint").alias("feed_seq"))
        .agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))
    )


# ── feeds, merge, ledger, digest ─────────────────────────────────────────


# Events of the second feed of each run.
FOLLOWED = "event_type IN ('click', 'purchase', 'signup')"


def _two_feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as two feeds per run, under names a feed may be asked for; ids are shared."""
    events = _table(spark, sf_dir, "events")
    home = capture.event_pages(events, " For-You ")
    return home.unionByName(capture.event_pages(events.where(FOLLOWED), "Following"))


def _event_feed(
    spark: SparkSession, sf_dir: str, count: int | None, captured: DataFrame | None = None, texts: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages, parsed candidates and feeds; each step is stored, as several
    later steps read it.  Without ``texts`` feeds hold their keys only."""
    base = shared_dir(spark)
    if captured is None:
        captured = capture.event_pages(_table(spark, sf_dir, "events"))
    bronze, pages = stored_pages(captured, f"{base}/bronze")
    parsed = stored(parse_tweets(flatten_timeline(bronze), INGEST_TS), f"{base}/parsed")
    posts = parsed if texts else parsed.select(*FEED, *ARRIVAL, "id", "drop_reason")
    return pages, parsed, assemble_feed(posts, pages, count)


def feed_dedup_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed_rows(_event_feed(spark, sf_dir, FEED_COUNT)[2])


def feed_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every first-seen post of the chained pages, as the pipeline keeps them by default."""
    return _feed_rows(_event_feed(spark, sf_dir, None)[2])


def _feed_rows(feed: DataFrame) -> DataFrame:
    return feed.select(
        "run_id",
        F.col("feed_pos").cast("bigint").alias("feed_pos"),
        "id",
        "page_no",
        "author_handle",
        "text",
        _stamp_text("created_at"),
    )


def page_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = page_summary(ingest_payloads(capture.event_pages(_table(spark, sf_dir, "events"))))
    return chain_pages(pages, RUN_COUNT).select(
        "run_id", "page_no", "status", "request_cursor", "next_cursor"
    )


def _posts(table: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Any table in the posts layout; columns not given are empty."""
    return table.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TWEETS.fields],
        *[c.alias(n) for n, c in columns.items() if n == "seq"],
    )


def _shifted(seconds: Column) -> Column:
    return F.timestamp_seconds(F.lit(1700000000) + seconds)


def _merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Current: the documents.  Batch: documents moved on by 137 ids, then every
    conversation turn under its conversation's id, so that ids repeat."""
    docs = _table(spark, sf_dir, "documents")
    turns = _table(spark, sf_dir, "conversations")
    doc, conv, turn = F.col("doc_id"), F.col("conv_id"), F.col("turn")
    current = _posts(
        docs,
        {
            "id": doc + 1,
            "author_id": doc,
            "author_handle": F.col("source"),
            "author_name": F.col("lang"),
            "created_at": _shifted(doc),
            "text": F.col("text"),
            "reply_to_text": F.lit("old"),
            "source_operation": F.lit("home"),
            "scraped_at": F.lit("2024-01-01").cast("timestamp"),
        },
    )
    moved = _posts(
        docs,
        {
            "seq": doc,
            "id": doc + 138,
            "author_id": doc,
            "author_handle": F.col("source"),
            "created_at": _shifted(doc + 5000),
            "text": F.concat(F.lit("new "), F.col("text")),
            "source_operation": F.lit("following"),
        },
    )
    repeated = _posts(
        turns,
        {
            "seq": conv * 1000 + turn + 10**12,
            "id": conv * 3 + 1,
            "author_id": conv,
            "author_handle": F.col("role"),
            "author_name": F.col("role"),
            "created_at": _shifted(turn),
            "text": F.col("text"),
            "reply_to_text": F.when(turn % 2 == 0, F.col("role")),
            "source_operation": F.concat(F.lit("op"), turn),
        },
    )
    return current, moved.unionByName(repeated)


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, batch = _merge_inputs(spark, sf_dir)
    return merge_tweets(current, batch, INGEST_TS).select(
        "id",
        "author_id",
        "author_handle",
        "author_name",
        _stamp_text("created_at"),
        "text",
        "reply_to_text",
        "source_operation",
        _stamp_text("scraped_at"),
        "change_type",
        "batch_rows",
    )


def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, batch = _merge_inputs(spark, sf_dir)
    merged = merge_tweets(current, batch, INGEST_TS)
    lang = F.coalesce("author_name", F.lit("none")).alias("author_name")
    return merge_counts(merged.withColumn("author_name", lang), ["author_name"])


def _known_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))


def _closed_runs(
    spark: SparkSession, sf_dir: str, count: int, texts: bool
) -> tuple[DataFrame, DataFrame, DataFrame]:
    pages, parsed, feed = _event_feed(spark, sf_dir, count, texts=texts)
    feed = stored(feed, f"{shared_dir(spark)}/feed")
    changes = change_types(_known_users(spark, sf_dir), feed)
    opened = open_runs(pages.select("run_id", "operation").distinct(), INGEST_TS, {"count": str(count)})
    return close_runs(opened, pages, parsed, feed, changes, count, INGEST_TS), feed, changes


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _closed_runs(spark, sf_dir, FEED_COUNT, texts=False)[0]
    return runs.select(
        "id",
        "status",
        "operation",
        "tweets_fetched",
        "tweets_new",
        "tweets_updated",
        F.get("errors", F.lit(0))["message"].alias("error"),
        "cursor_resume",
        F.col("metadata")["count"].alias("asked"),
        F.col("parse_stats.raw").alias("raw"),
        F.col("parse_stats.parsed").alias("parsed"),
        _stamp_text("completed_at"),
    )


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of all runs: their parts, and each report as a whole."""
    runs, feed, changes = _closed_runs(spark, sf_dir, FEED_COUNT, texts=True)
    parts = stored(render_digest(feed, changes, runs), f"{shared_dir(spark)}/digest")
    return parts.unionByName(whole_reports(parts))


def two_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of runs asked for both feeds, which share ids; an unknown name is asked for too."""
    captured = _two_feed_pages(spark, sf_dir)
    captured = captured.withColumn("operation", canonical_operation(F.col("operation")))
    pages, parsed, feed = _event_feed(spark, sf_dir, None, captured, texts=False)
    feed = stored(feed, f"{shared_dir(spark)}/feed")
    changes = change_types(_known_users(spark, sf_dir), feed)
    runs = pages.select("run_id").distinct()
    asked = runs.withColumn("operation", F.explode(F.array(F.lit(" Both "), F.lit("lists"))))
    opened = open_runs(resolve_operations(asked), INGEST_TS, {"count": "all"})
    closed = close_runs(opened, pages, parsed, feed, changes, None, INGEST_TS)
    return closed.select(
        "id",
        "operation",
        "status",
        F.get("errors", F.lit(0))["code"].alias("error"),
        "tweets_fetched",
        "tweets_new",
        "tweets_updated",
        F.col("parse_stats.raw").alias("raw"),
    )


# ── text, redaction, articles ────────────────────────────────────────────


def normalize_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_table(_table(spark, sf_dir, "pages"), "html", "clean").select("page_id", "clean")


def normalize_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.concat(
        F.lit("​ \t"),
        F.col("text"),
        F.lit("\n\n\n\n“q” ‘s’—–… «­x» &lt;&amp;lt;\t\t end "),
        F.lit("https://t.co/one  https://t.co/Two \n"),
    )
    docs = _table(spark, sf_dir, "documents").select("doc_id", noisy.alias("text"))
    return normalize_table(docs, "text")


def redact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return redact_table(docs, ["text"], mode="plain")


def redact_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("Authorization: Bearer "), F.sha2("text", 256), F.lit(" | "), F.col("text"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return redact_table(docs, ["text"], mode="strict")


def redact_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = F.create_map(
        F.lit("Token"), F.col("c_name"), F.lit("city"), F.col("c_mktsegment"), F.lit("ct0"), F.lit("abc")
    )
    words = F.array(F.sha2("c_name", 256), F.col("c_name"), F.substring(F.sha2("c_name", 256), 1, 39))
    table = _table(spark, sf_dir, "customer").select("c_custkey", facts.alias("facts"), words.alias("words"))
    masked = redact_table(table, ["facts", "words"])
    return masked.select(
        "c_custkey",
        F.col("facts")["Token"].alias("token"),
        F.col("facts")["city"].alias("city"),
        F.col("facts")["ct0"].alias("ct0"),
        F.array_join("words", " ").alias("words"),
    )


def secret_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(_table(spark, sf_dir, "documents"), "text", mode="plain")


BLOCK_TYPES = (
    "header-one",
    "ordered-list-item",
    "ordered-list-item",
    "atomic",
    "ordered-list-item",
    "code-block",
    "blockquote",
    "unstyled",
    "unordered-list-item",
    "header-two",
    "header-three",
)


def article_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as articles: one block per turn."""
    turns = _table(spark, sf_dir, "conversations")
    kind = F.get(F.array(*map(F.lit, BLOCK_TYPES)), ((F.col("turn") + F.col("conv_id")) % len(BLOCK_TYPES)).cast("int"))
    blocks = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", kind.alias("type"), "text"))),
        lambda b: F.struct(b["type"].alias("type"), b["text"].alias("text")),
    )
    return (
        turns.groupBy("conv_id")
        .agg(blocks.alias("blocks"))
        .select("conv_id", blocks_to_markdown(F.col("blocks")).alias("markdown"))
    )


def article_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts that hold an article; every fourth holds none."""
    doc, text = F.col("doc_id"), capture.quoted(F.col("text"))
    article = capture.template(
        '{"article":{"article_results":{"result":{"title":%s,"content_state":{"blocks":['
        '{"type":"header-three","text":%s},{"type":"ordered-list-item","text":"first"},'
        '{"type":"atomic","text":"x"},{"type":"ordered-list-item","text":%s}]}}}}}',
        capture.quoted(F.col("source")),
        text,
        text,
    )
    node = F.when(doc % 4 == 3, F.lit('{"article":null}')).otherwise(article)
    posts = _table(spark, sf_dir, "documents").select("doc_id", F.try_parse_json(node).alias("v"))
    return articles_to_markdown(posts).select("doc_id", "title", "text")


def note_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with long-form notes, authors in the older place, and two feeds."""
    doc, source = F.col("doc_id"), F.col("source")
    names = [capture.quoted(source), capture.quoted(F.when(doc % 4 == 0, source).otherwise(F.col("lang")))]
    member = capture.template('"core":{"screen_name":%s,"name":%s}', *names)
    older = capture.template('"legacy":{"screen_name":%s,"name":%s}', *names)
    value = capture.template(
        '{"__typename":"Tweet","rest_id":"%s","core":{"user_results":{"result":{"rest_id":"9",%s}}},'
        '"legacy":{"full_text":%s}%s}',
        doc + 1,
        F.when(doc % 2 == 0, older).otherwise(member),
        capture.quoted(F.concat(F.lit("short of "), source)),
        F.when(
            doc % 3 == 0,
            capture.template(
                ',"note_tweet":{"note_tweet_results":{"result":{"text":%s}}}', capture.quoted(F.col("text"))
            ),
        ).otherwise(F.lit("")),
    )
    pages = _table(spark, sf_dir, "documents").select(
        F.when(doc % 5 == 0, "search").otherwise("home").alias("operation"),
        capture.page(F.array(capture.single_entry(value))).alias("value"),
    )
    return parse_pages(pages, INGEST_TS).select("id", "author_handle", "author_name", "text", "source_operation")


# ── maintenance, profiles, reads, search ─────────────────────────────────


def _legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    return _table(spark, sf_dir, "documents").select(
        F.when(doc % 50 != 7, doc).alias("id"),
        F.when(doc % 3 > 0, doc).alias("author_id"),
        F.when(doc % 20 == 9, F.repeat(F.col("source"), 20)).otherwise(F.col("source")).alias("author_handle"),
        F.when(doc % 4 == 0, F.lit("")).when(doc % 4 == 1, F.col("text")).alias("text"),
        F.when(doc % 5 > 0, F.col("text")).otherwise(F.lit("")).alias("text_raw"),
        F.when(doc % 2 == 0, F.concat(F.lit("n:"), F.col("lang"))).alias("text_normalized"),
        _shifted(doc).alias("created_at"),
        _shifted(doc).alias("scraped_at"),
        F.lit("home").alias("source_operation"),
        "lang",
        F.lit(0).alias("likes"),
    )


def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_legacy(_legacy(spark, sf_dir)).select(
        "id", "author_id", "author_handle", "text", "reply_to_text", "quoted_tweet_id", "source_operation"
    )


def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints on the old documents stored twice over by 900 ids."""
    old = conform_legacy(_legacy(spark, sf_dir))
    both = old.unionByName(old.withColumn("id", F.col("id") + 900))
    return validate_tweets(both).select("id", F.array_join("violations", ",").alias("violations"))


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side_counts(validate_tweets(conform_legacy(_legacy(spark, sf_dir))))


def _profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    value = capture.template(
        '{"data":{"user":{"result":{"rest_id":"%s"%s,"legacy":{%s"name":%s,"description":%s,'
        '"followers_count":%s,"friends_count":"%s","statuses_count":"1,%s","verified":%s}}}}}',
        key + 1,
        F.when(key % 4 == 0, F.lit(',"is_blue_verified":true')).otherwise(F.lit("")),
        F.when(key % 6 == 0, F.lit("")).otherwise(
            capture.template('"screen_name":%s,', capture.quoted(F.concat(F.lit("c"), key)))
        ),
        capture.quoted(F.col("c_name")),
        capture.quoted(F.col("c_mktsegment")),
        key * 3,
        F.col("c_nationkey"),
        key,
        F.when(key % 5 == 0, F.lit("true")).otherwise(F.lit("false")),
    )
    absent = F.lit('{"data":{"user":{}}}')
    return _table(spark, sf_dir, "customer").select(
        key.alias("seq"),
        F.concat(F.lit("asked"), key).alias("requested_name"),
        F.when(key % 9 == 8, absent).otherwise(value).alias("value"),
    )


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_profiles(ingest_payloads(_profile_pages(spark, sf_dir)))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir).select(
        "id",
        "screen_name",
        "name",
        "bio",
        "followers_count",
        "following_count",
        "tweets_count",
        "verified",
        "drop_reason",
    )


def users_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles merged into a users table made from the suppliers."""
    key = F.col("s_suppkey")
    columns = {
        "id": key * 2,
        "screen_name": F.col("s_name"),
        "name": F.lit("old"),
        "followers_count": F.lit(7),
        "verified": F.lit(False),
        "last_scraped_at": F.lit("2024-01-01").cast("timestamp"),
        "created_at": _shifted(key),
    }
    current = _table(spark, sf_dir, "supplier").select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in USERS.fields]
    )
    return upsert_users(current, _profiles(spark, sf_dir), INGEST_TS).select(
        "id",
        "screen_name",
        "name",
        "bio",
        "followers_count",
        "verified",
        _stamp_text("last_scraped_at"),
        _stamp_text("created_at"),
    )


def unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    posts = events.select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("scraped_at"), "event_type"
    )
    return read_unprocessed(posts, "2024-01-29 12:00:00").select(
        "id", "event_type", _stamp_text("scraped_at")
    )


# Batches of the stored table: the time each is stored, and the events it holds.
STORED_BATCHES = (
    ("2024-01-02 00:00:00", "true"),
    ("2024-01-20 06:00:00", "event_type IN ('view', 'purchase', 'click')"),
    ("2024-01-29 03:00:00", "event_type IN ('purchase', 'error')"),
)


def stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after three stored batches, and which posts its 24-hour read gives."""
    events = _table(spark, sf_dir, "events")
    table = tweet_table(spark, shared_dir(spark))
    for version, (stamp, chosen) in enumerate(STORED_BATCHES):
        columns = {
            "id": F.col("event_id"),
            "author_id": F.col("user_id"),
            "created_at": F.col("ts").cast("timestamp") + F.expr(f"INTERVAL {version} DAYS"),
            "text": F.concat_ws(" ", F.lit(version), "event_type"),
            "source_operation": F.lit("home" if version else "following"),
        }
        batch = events.where(chosen).select(
            *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TWEETS.fields]
        )
        table.commit(
            version, batch, lambda keys, new, stamp=stamp: delta_tweets(keys, new, stamp, F.col("text"))
        )
    since = F.lit("2024-01-29 12:00:00").cast("timestamp") - F.expr("INTERVAL 24 HOURS")
    recent = table.read(since).select("id", F.lit(True).alias("recent"))
    return table.read().join(recent, "id", "left").select(
        "id",
        "author_id",
        _stamp_text("created_at"),
        "text",
        "source_operation",
        _stamp_text("scraped_at"),
        F.coalesce("recent", F.lit(False)).alias("recent"),
    )


def _document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return build_text_index(docs.select(F.col("doc_id").alias("id"), "text"))


def text_index_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _document_index(spark, sf_dir)
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
    )


SEARCH_QUERY = "The edst, with HEEDING"


def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search of a stored index: words of the same stem count as the words asked for."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    index = TextIndex(spark, f"{shared_dir(spark)}/index")
    index.append(0, docs)
    return index.search(SEARCH_QUERY)


def search_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a second segment has new texts of every fifth post."""
    docs = _table(spark, sf_dir, "documents")
    index = TextIndex(spark, f"{shared_dir(spark)}/index")
    index.append(0, docs.select(F.col("doc_id").alias("id"), "text"))
    text = F.concat(F.lit("Heeded by "), F.col("source"), F.lit(", relating heedings"))
    index.append(1, docs.where("doc_id % 5 = 2").select(F.col("doc_id").alias("id"), text.alias("text")))
    return index.search("heeds")


# Endings put behind words of the benchmark, so that every rule is used.
SUFFIXES = (
    "s sses ied ies us eed eedly ed edly ing ingly y tional enci anci abli entli izer ization ational ator"
    " alism aliti alli fulness ousli ousness iveness iviti biliti bli logi fulli lessli li alize icate"
    " iciti ical ful ness ative al ance ence er able ible ant ement ment ent ism ate iti ous ive ize sion"
    " ll e ating hopping hoping"
).split()


def text_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stems of all distinct words of the documents and the benchmark, and of words with endings."""
    texts = _table(spark, sf_dir, "documents").select("text").union(_table(spark, sf_dir, "benchmark").select("text"))
    written = texts.select(F.explode(terms_of(F.col("text"))).alias("term"))
    base = _table(spark, sf_dir, "benchmark").select(F.explode(words_of(F.col("text"))).alias("w")).distinct()
    ended = F.transform(F.array(*map(F.lit, SUFFIXES)), lambda e: F.concat(F.lit("a"), F.col("w"), e))
    made = base.select(F.explode(F.array_except(ended, F.array(*map(F.lit, STOP_WORDS)))).alias("term"))
    return stem_words(written.union(made).distinct())


# ── streaming ────────────────────────────────────────────────────────────


def stream_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``thread_parse`` as a stream over files of captured pages."""
    base = shared_dir(spark)
    pages = capture.thread_pages(_table(spark, sf_dir, "conversations"))
    have = {c: F.col(c) for c in pages.columns} | {"captured_at": F.lit(INGEST_TS)}
    captured = pages.select(
        *[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CAPTURE.fields]
    )
    captured.write.json(f"{base}/in")
    parsed = stream_parse(read_capture_stream(spark, f"{base}/in"))
    query = (
        parsed.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        "id", "author_handle", "text", "reply_to_tweet_id", "reply_to_text"
    )


# Pages of a run that arrive together.
ARRIVING_PAGES = 25


def stream_ingest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds per run through the whole pipeline as a stream of arriving files.

    The pages of every run come in two batches.  The stored posts and the ledger are
    those of all pages at once; a run is opened once per batch, and the reports of
    both batches list each of its posts once.
    """
    base = shared_dir(spark)
    pages = _two_feed_pages(spark, sf_dir).withColumn("captured_at", F.lit(INGEST_TS))
    have = set(pages.columns)
    columns = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in CAPTURE.fields]
    pages = stored(pages.select(*columns), f"{base}/captured")
    for part in range(-(-capture.PAGES_PER_RUN // ARRIVING_PAGES)):
        arriving = pages.where(F.floor(F.col("page_no") / ARRIVING_PAGES) == part)
        arriving.write.mode("append").json(f"{base}/in")
        stream_ingest(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    posts = tweet_table(spark, f"{base}/out").read()
    none = F.lit(None).cast("int")
    posts = posts.select(
        F.lit("post").alias("kind"),
        F.col("id").cast("string").alias("id"),
        F.col("source_operation").alias("operation"),
        F.col("text").alias("state"),
        *[none.alias(c) for c in ("fetched", "fresh", "known")],
    )
    runs = run_ledger_table(spark, f"{base}/out").select(
        F.lit("run"), "id", "operation", "status", "tweets_fetched", "tweets_new", "tweets_updated"
    )
    opened = spark.read.parquet(f"{base}/out/runs_open").groupBy("id", "operation", "status")
    opened = opened.agg(F.count("*").cast("int").alias("n"))
    opened = opened.select(F.lit("open"), "id", "operation", "status", "n", none, none)
    lines = spark.read.text(f"{base}/out/digest").groupBy("run_id", "operation")
    reports = lines.agg(F.count_if(F.startswith("value", F.lit("### ["))).cast("int").alias("n"))
    reports = reports.select(F.lit("report"), "run_id", "operation", F.lit(None).cast("string"), "n", none, none)
    return posts.union(runs).union(opened).union(reports)


def payload_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads kept as lines of text, some cut short and some empty, by status."""
    docs = _table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    whole = capture.page(F.array(capture.single_entry(capture.post_node(doc + 1, doc, F.col("source"), F.col("text")))))
    line = F.when(doc % 7 == 3, F.substring(whole, F.lit(1), F.length(whole) - 2)).when(doc % 10 == 9, "").otherwise(whole)
    path = f"{shared_dir(spark)}/lines"
    docs.select(line.alias("value")).write.text(path)
    read = ingest_payloads(read_payload_lines(spark, path))
    return read.groupBy("status", "error_message").agg(F.count("*").alias("n"))


QUERIES: dict[str, Query] = {
    "thread_parse": thread_parse,
    "payload_status": payload_status,
    "payload_lines": payload_lines,
    "timeline_paths": timeline_paths,
    "drop_reasons": drop_reasons,
    "parse_stats_alert": parse_stats_alert,
    "retweet_quote": retweet_quote,
    "media_best_variant": media_best_variant,
    "safe_int": safe_int_prices,
    "created_at_parse": created_at_parse,
    "operation_aliases": operation_aliases,
    "feed_dedup_cap": feed_dedup_cap,
    "feed_uncapped": feed_uncapped,
    "page_chain": page_chain,
    "upsert_merge": upsert_merge,
    "upsert_counts": upsert_counts,
    "run_ledger": run_ledger,
    "digest": digest,
    "two_feeds": two_feeds,
    "normalize_pages": normalize_pages,
    "normalize_noise": normalize_noise,
    "redact_documents": redact_documents,
    "redact_strict": redact_strict,
    "redact_collections": redact_collections,
    "secret_report": secret_findings,
    "article_markdown": article_markdown,
    "article_posts": article_posts,
    "note_posts": note_posts,
    "conform_legacy": conform,
    "validate": validate,
    "quarantine_counts": quarantine_counts,
    "profiles": profiles,
    "users_upsert": users_upsert,
    "read_unprocessed": unprocessed,
    "stored_table": stored_table,
    "text_index_terms": text_index_terms,
    "text_stems": text_stems,
    "text_search": text_search,
    "search_updates": search_updates,
    "stream_threads": stream_threads,
    "stream_ingest": stream_ingest_runs,
}
