"""Payloads, records, filters and the key-respecting append."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark.catalog.registry import AS_OF, holds, joined, ntz, query
from leadspark.functions import text as X
from leadspark.functions.times import epoch_to_ts, iso_to_ts
from leadspark.operators import filters, joins, keyed, loading, matching
from leadspark.plans import cycles
from leadspark.session import shared_folder
from leadspark.sources import adapters as A, payloads, tables

_PAGE = 50


def _listing_payloads(spark, sf, bad_date=None):
    """Pages of fifty neighbouring documents as JSON listings; some posts have no date, if asked."""
    p = A.posts(spark, sf)
    n = F.col("id")
    post = F.struct(
        n.cast("string").alias("id"),
        F.concat(F.lit("s"), (n % 9).cast("string")).alias("subreddit"),
        F.when(n % 17 == 0, F.lit("[deleted]")).otherwise(F.col("author")).alias("author"),
        "title",
        F.when(n % 19 != 0, F.col("body")).alias("selftext"),
        F.concat(F.lit("/p/"), n.cast("string")).alias("permalink"),
        F.when(F.lit(True) if bad_date is None else ~bad_date, F.unix_timestamp(F.col("posted_at").cast("timestamp")).cast("double")).alias("created_utc"),
        F.col("engagement")["score"].alias("score"),
        (n % 13).alias("num_comments"),
        (n % 11 == 0).alias("over_18"),
        F.when(n % 2 == 0, n % 14 == 0).alias("stickied"),
    )
    pages = p.groupBy(F.floor(n / _PAGE).alias("page")).agg(F.sort_array(F.collect_list(F.struct(n.alias("n"), post.alias("post")))).alias("c"))
    children = F.transform("c", lambda c: F.struct(c["post"].alias("data")))
    body = F.to_json(F.struct(F.struct(children.alias("children")).alias("data")))
    return pages.select("page", F.lit("of the").alias("keyword"), body.alias("payload"))


@query("normalize_listing", "posts", """
select id // 50 page, 'reddit' platform, concat('t3_', id) external_id, concat('s', id % 9) subreddit, author, title,
  case when id % 19 = 0 then '' else body end body, concat('https://reddit.com/p/', id) url, posted_at,
  engagement_score score, id % 13 comments, 'of the' matched_keywords
from posts
where id % 11 <> 0 and id % 14 <> 0 and id % 17 <> 0 and posted_at >= {now} - interval '120' hour""")
def normalize_listing(spark, sf):
    out = payloads.normalize_listing(_listing_payloads(spark, sf), AS_OF, lookback_hours=120)
    return out.select(
        "page", "platform", "external_id", "subreddit", "author", "title", "body", "url", ntz("posted_at"),
        F.col("engagement")["score"].alias("score"), F.col("engagement")["comments"].alias("comments"), joined("matched_keywords"),
    )


def _search_payloads(spark, sf, bad_date=None):
    """Pages of fifty neighbouring documents as JSON search results; accounts repeat within a page."""
    p = A.posts(spark, sf)
    n = F.col("id")
    author = F.concat(F.lit("a"), (n % 7).cast("string"))
    tweet = F.struct(
        n.cast("string").alias("id"), author.alias("author_id"), F.col("body").alias("text"),
        F.when(F.lit(False) if bad_date is None else bad_date, F.concat(F.lit("day "), n.cast("string"))).otherwise(F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("created_at"), "lang",
        F.struct(F.when(n % 3 != 0, n % 31).alias("like_count"), (n % 5).alias("reply_count"), (n % 2).alias("retweet_count")).alias("public_metrics"),
        F.when(n % 6 == 0, F.array(F.struct(F.lit("retweeted").alias("type"), F.lit("1").alias("id")))).alias("referenced_tweets"),
    )
    user = F.struct(
        author.alias("id"), F.concat(F.lit("user"), n.cast("string")).alias("username"),
        F.when(n % 4 != 0, F.concat(F.lit("bio "), n.cast("string"))).alias("description"),
        F.when(n % 2 == 0, n % 4 == 0).alias("verified"),
        F.struct((n % 23).alias("followers_count"), (900 + n % 211).alias("following_count")).alias("public_metrics"),
    )
    row = F.struct(n.alias("n"), tweet.alias("tweet"), F.when(n % 7 != 6, user).alias("user"))
    pages = p.groupBy(F.floor(n / _PAGE).alias("page")).agg(F.sort_array(F.collect_list(row)).alias("c"))
    users = F.filter(F.transform("c", lambda c: c["user"]), lambda u: u.isNotNull())
    body = F.struct(F.transform("c", lambda c: c["tweet"]).alias("data"), F.struct(users.alias("users")).alias("includes"))
    return pages.select("page", F.lit("of the").alias("query"), F.to_json(body).alias("payload"))


_SEARCH_SQL = """
with u as (select id // 50 page, id % 7 a, max(id) uid from posts where id % 7 <> 6 group by 1, 2),
j as (select p.*, u.page, u.uid, u.uid % 23 followers, 900 + u.uid % 211 as "following"
  from posts p join u on p.id // 50 = u.page and p.id % 7 = u.a)
select page, 'twitter' platform, cast(id as varchar) external_id, concat('@user', uid) author, followers, "following",
  uid % 4 = 0 verified, case when uid % 4 = 0 then '' else concat('bio ', uid) end bio, '' title, body,
  concat('https://x.com/user', uid, '/status/', id) url, posted_at,
  case when id % 3 = 0 then 0 else id % 31 end likes, id % 5 replies, id % 2 retweets, 'of the' matched_keywords
from j where not (followers < 10 and "following" > 1000) and posted_at >= {now} - interval '120' hour"""


@query("normalize_search", "posts", "select * from (" + _SEARCH_SQL + ")")
def normalize_search(spark, sf):
    out = payloads.normalize_search(_search_payloads(spark, sf), AS_OF, lookback_hours=120)
    e = F.col("engagement")
    return out.select(
        "page", "platform", "external_id", "author", "author_meta.*", "title", "body", "url", ntz("posted_at"),
        e["likes"].alias("likes"), e["replies"].alias("replies"), e["retweets"].alias("retweets"), joined("matched_keywords"),
    )


_ALL_SEARCH_SQL = _SEARCH_SQL.split("\nfrom j where")[0] + "\nfrom j"


@query("search_records", "posts", "select * from (" + _ALL_SEARCH_SQL + ")")
def search_records(spark, sf):
    out = payloads.search_records(_search_payloads(spark, sf))
    e = F.col("engagement")
    return out.select(
        "page", "platform", "external_id", "author", "author_meta.*", "title", "body", "url", ntz("posted_at"),
        e["likes"].alias("likes"), e["replies"].alias("replies"), e["retweets"].alias("retweets"), joined("matched_keywords"),
    )


@query("drop_reposts", "posts", "select external_id from (" + _ALL_SEARCH_SQL + ") where cast(external_id as bigint) % 6 <> 0")
def drop_reposts(spark, sf):
    return filters.drop_reposts(payloads.search_records(_search_payloads(spark, sf))).select("external_id")


@query("bad_payloads", "posts", """
with p as (select id, id // 50 page from posts), pages as (select distinct page from p)
select 'listing' kind, page, 'unreadable_page' reason, cast(null as varchar) external_id, concat('{"data": ', page) detail from pages where page % 4 = 1
union all select 'listing', page, 'no_posts', null, concat('{"error": ', page, '}') from pages where page % 4 = 2
union all select 'listing', page, 'bad_date', cast(id as varchar), null from p where page % 4 in (0, 3) and id % 23 = 0
union all select 'search', page, 'unreadable_page', null, 'null' from pages where page % 3 = 1
union all select 'search', page, 'unknown_author', cast(id as varchar), concat('a', id % 7) from p where page % 3 <> 1 and id % 7 = 6
union all select 'search', page, 'bad_date', cast(id as varchar), concat('day ', id) from p where page % 3 <> 1 and id % 29 = 0""")
def bad_payloads(spark, sf):
    """Pages of which some are cut short, errors or null, with posts of unreadable dates or unknown authors."""
    page, text = F.col("page"), F.col("payload")
    listing = _listing_payloads(spark, sf, F.col("id") % 23 == 0)
    cut = F.when(page % 4 == 1, F.concat(F.lit('{"data": '), page.cast("string"))).when(page % 4 == 2, F.concat(F.lit('{"error": '), page.cast("string"), F.lit("}")))
    listing = listing.withColumn("payload", F.coalesce(cut, text))
    search = _search_payloads(spark, sf, F.col("id") % 29 == 0).withColumn("payload", F.when(page % 3 == 1, F.lit("null")).otherwise(text))
    columns = ["kind", "page", "reason", "external_id", "detail"]
    parts = [payloads.bad_listing(listing).withColumn("kind", F.lit("listing")), payloads.bad_search(search).withColumn("kind", F.lit("search"))]
    return parts[0].select(*columns).unionByName(parts[1].select(*columns))



def _accounts(spark, sf):
    """Two versions of an account per customer, the later one without the first's balance."""
    c = A.table(spark, sf, "customer")
    versions = F.explode(F.sequence(F.lit(1), F.lit(2))).alias("version")
    return c.select(F.col("c_custkey").alias("author_id"), "c_name", F.floor("c_acctbal").cast("bigint").alias("bal"), versions).select(
        "author_id", F.concat_ws("-", "c_name", F.col("version").cast("string")).alias("username"), "version",
        (F.col("bal") * F.col("version")).alias("followers"), (F.lit(3000) - F.col("bal")).alias("following"),
    )


@query("attach_users", "", """
select o_orderkey id, o_custkey author_id, concat(c_name, '-2') username, cast(floor(c_acctbal) as bigint) * 2 followers,
  3000 - cast(floor(c_acctbal) as bigint) as "following"
from orders join customer on o_custkey = c_custkey""")
def attach_users(spark, sf):
    tweets = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("author_id"))
    return joins.attach_users(tweets, _accounts(spark, sf), ["version"])


@query("drop_bot_like", "", """
select o_orderkey id from orders join customer on o_custkey = c_custkey
where not (cast(floor(c_acctbal) as bigint) * 2 < 10 and 3000 - cast(floor(c_acctbal) as bigint) > 1000)""")
def drop_bot_like(spark, sf):
    return filters.drop_bot_like(attach_users(spark, sf)).select("id")


@query("eligible_listing", "posts", "select id from posts where id % 11 <> 0 and id % 14 <> 0 and author <> 'u5'")
def eligible_listing(spark, sf):
    n = F.col("id")
    flagged = A.posts(spark, sf).withColumns(
        {
            "over_18": F.when(n % 3 != 1, n % 11 == 0).otherwise(F.when(n % 11 == 0, F.lit(True))),
            "stickied": n % 14 == 0,
            "author": F.when(F.col("author") == "u5", F.lit("[deleted]")).otherwise(F.col("author")),
        }
    )
    return filters.eligible_listing(flagged).select("id")


@query("within_lookback", "posts", "select id, posted_at from posts where posted_at >= {now} - interval '24' hour")
def within_lookback(spark, sf):
    return filters.within_lookback(A.posts(spark, sf), "posted_at", AS_OF).select("id", "posted_at")


@query("parse_records", "posts", """
select external_id, 'reddit' source, title, engagement_score score from posts where id % 7 not in (0, 1, 2)""")
def parse_records(spark, sf):
    return tables.parse_records(_lines(spark, sf))[0].select(
        "external_id", "source", "title", F.col("engagement")["score"].alias("score")
    )


@query("malformed_records", "posts", """
select case id % 7 when 0 then 'null' else concat('{"external_id":"', external_id) end line from posts where id % 7 in (0, 1)""")
def malformed_records(spark, sf):
    return tables.parse_records(_lines(spark, sf))[1]


def _lines(spark, sf):
    """Documents as JSON lines, some of them bare null, cut off, or blank."""
    n = F.col("id")
    record = F.to_json(F.struct(F.lit("reddit").alias("source"), "external_id", "title", "body", "engagement"))
    line = (
        F.when(n % 7 == 0, F.lit("null")).when(n % 7 == 1, F.concat(F.lit('{"external_id":"'), F.col("external_id")))
        .when(n % 7 == 2, F.lit("  ")).otherwise(record)
    )
    return A.posts(spark, sf).select(line.alias("value"))


@query("read_records", "posts", "select external_id, title, body from posts where id % 7 not in (0, 1, 2)")
def read_records(spark, sf):
    path = shared_folder(spark)
    _lines(spark, sf).write.text(path)
    return tables.read_records(spark, path)[0].select("external_id", "title", "body")


@query("read_table", "posts leads", "select cast(id as varchar) id, platform, external_id, score, status, scored_at from leads")
def read_table(spark, sf):
    base = shared_folder(spark)
    leads = A.leads(spark, sf).select(F.col("id").cast("string").alias("id"), "platform", "external_id", "score", "status", F.col("scored_at").cast("timestamp").alias("scored_at"))
    leads.write.parquet(f"{base}/leads")
    return tables.read_table(spark, base, "leads").select("id", "platform", "external_id", "score", "status", ntz("scored_at"))


@query("with_defaults", "posts", """
select id, case when id % 3 = 0 then '' else title end title, case when id % 4 = 0 then '' else body end body,
  case when id % 5 = 0 then 0 else 1 end n_engagement, 0 n_keywords from posts""")
def with_defaults(spark, sf):
    n = F.col("id")
    holed = A.posts(spark, sf).withColumns(
        {
            "title": F.when(n % 3 != 0, F.col("title")),
            "body": F.when(n % 4 != 0, F.col("body")),
            "engagement": F.when(n % 5 != 0, F.col("engagement")),
            "matched_keywords": F.lit(None).cast("array<string>"),
        }
    )
    return filters.with_defaults(holed).select(
        "id", "title", "body", F.size("engagement").alias("n_engagement"), F.size("matched_keywords").alias("n_keywords")
    )


_KEYS = ["l_orderkey", "l_linenumber"]
_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
_KEPT = [*_KEYS, "l_partkey", "l_suppkey", "l_shipdate"]


def _first_sql(source: str = "lineitem", direction: str = "") -> str:
    order = ", ".join(f"{c} {direction}" for c in _ORDER)
    return f"""select {', '.join(_KEPT)} from (select *, row_number() over (partition by {', '.join(_KEYS)}
  order by {order}) rn from {source}) q where rn = 1"""


@query("first_per_key", "", _first_sql())
def first_per_key(spark, sf):
    return keyed.first_per_key(A.arrivals(spark, sf), _KEYS, _ORDER).select(*_KEPT)


@query("last_per_key", "", _first_sql(direction="desc"))
def last_per_key(spark, sf):
    return keyed.last_per_key(A.arrivals(spark, sf), _KEYS, _ORDER).select(*_KEPT)


@query("append_new", "", f"""
select * from ({_first_sql()}) q where not exists (select 1 from lineitem s
  where s.l_shipdate < TIMESTAMP '1995-06-01 00:00:00' and s.l_orderkey = q.l_orderkey and s.l_linenumber = q.l_linenumber)""")
def append_new(spark, sf):
    rows = A.arrivals(spark, sf)
    existing = keyed.first_per_key(rows.filter("l_shipdate < timestamp_ntz '1995-06-01 00:00:00'"), _KEYS, _ORDER)
    return keyed.append_new(existing, rows, _KEYS, _ORDER).select(*_KEPT)


@query("cycle_stats", "", """
select count(*) attempted, (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) inserted from lineitem""")
def cycle_stats(spark, sf):
    rows = A.arrivals(spark, sf)
    return loading.cycle_stats(rows, keyed.append_new(rows.limit(0), rows, _KEYS, _ORDER))


@query("duplicate_keys", "", """
select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1""")
def duplicate_keys(spark, sf):
    return keyed.duplicate_keys(A.arrivals(spark, sf), _KEYS)


@query("cap_per_group", "", """
select l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate from (select *, row_number() over (partition by l_suppkey
  order by l_shipdate desc, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) rn from lineitem) q where rn <= 50""")
def cap_per_group(spark, sf):
    order = [F.col("l_shipdate").desc(), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    out = keyed.cap_per_group(A.arrivals(spark, sf), ["l_suppkey"], 80, order, cap=50)
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("cap_per_group_deep", "", """
select l_returnflag, l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_returnflag
  order by l_shipdate desc, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) rn from lineitem) q where rn <= 2000""")
def cap_per_group_deep(spark, sf):
    order = [F.col("l_shipdate").desc(), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    out = keyed.cap_per_group(A.arrivals(spark, sf), ["l_returnflag"], 2000, order, leading="l_shipdate")
    return out.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")


@query("orphans", "", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey not in (select o_orderkey from orders)")
def orphans(spark, sf):
    return keyed.orphans(A.arrivals(spark, sf), A.table(spark, sf, "orders"), "l_orderkey", "o_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query("orphan_customers", "", "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def orphan_customers(spark, sf):
    waiting = A.table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    return keyed.orphans(A.table(spark, sf, "customer"), waiting, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("union_posts", "posts drafts", """
select 'post' kind, external_id, author, body from posts
union all select 'draft', concat('d', id), null, body from drafts""")
def union_posts(spark, sf):
    p = A.posts(spark, sf).select(F.lit("post").alias("kind"), "external_id", "author", "body")
    d = A.drafts(spark, sf).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("external_id"), "body", F.lit("draft").alias("kind"))
    return keyed.union_posts(p, d)


_PHRASES = ["the and", "of the", "the is", "attion to", "to the"]


def _held_sql(phrases) -> str:
    cases = ", ".join(f"case when {holds(p)} then '{p}' end" for p in phrases)
    first = " ".join(f"when {holds(p)} then '{p}'" for p in phrases)
    return f"concat_ws(',', {cases}) matched_keywords, case {first} end first_match"


@query("match_phrases", "posts", f"select platform, external_id, {_held_sql(_PHRASES)} from posts")
def match_phrases(spark, sf):
    out = matching.match_phrases(A.posts(spark, sf), _PHRASES)
    return out.select("platform", "external_id", joined("matched_keywords"), "first_match")


def _repeated_keys(spark, sf):
    """Posts of which many share a key, and some have none."""
    n = F.col("id") % 50
    return A.posts(spark, sf).withColumns({"post": F.col("id"), "external_id": F.when(n > 4, n.cast("string"))})


def _phrase_rows(spark, phrases):
    return spark.createDataFrame([(p, i) for i, p in enumerate(phrases)], "phrase string, rank int")


@query("match_phrases_by_table", "posts", f"select id, {_held_sql(_PHRASES)} from posts")
def match_phrases_by_table(spark, sf):
    out = matching.match_phrases(_repeated_keys(spark, sf), _phrase_rows(spark, _PHRASES))
    return out.select("id", joined("matched_keywords"), "first_match")


@query("match_phrase_table", "", """
with words as (select distinct regexp_extract(p_name, '^[a-zA-Z]+') w from part),
terms as (select lower(w) as term from words where w <> '' union select 'the and' union select 'of the' union select 'attion to the'),
d as (select doc_id, lower(concat(substring(text, 1, 80), chr(10), text)) lowered from documents)
select doc_id id, term as phrase from (select * from d join terms on contains(lowered, term) offset 0)
where regexp_matches(lowered, concat('(^|[^\\p{L}])', term, '($|[^\\p{L}])'))""")
def match_phrase_table(spark, sf):
    word = F.regexp_extract("p_name", "^[a-zA-Z]+", 0)
    names = A.table(spark, sf, "part").select(F.lower(word).alias("phrase")).filter("phrase <> ''")
    more = A.table(spark, sf, "region").select(
        F.explode(F.array(F.lit("the and"), F.lit("of the"), F.lit("attion to the"))).alias("phrase")
    )
    phrases = names.unionByName(more).distinct().withColumn("rank", F.lit(0))
    return matching.phrase_hits(A.posts(spark, sf), phrases, ["id"]).select("id", "phrase")


@query("language_gate", "posts", """
select external_id, case when lang <> 'en' then 0 else engagement_score end score, case when lang <> 'en' then 'language' else '' end disqualifiers from posts""")
def language_gate(spark, sf):
    out = filters.language_gate(A.posts(spark, sf).withColumn("score", F.col("engagement")["score"]), "en")
    return out.select("external_id", "score", joined("disqualifiers"))


@query("disqualify", "posts", f"""
select external_id, case when {holds('of the')} or {holds('the is')} or {holds('to the')} then 0 else engagement_score end score,
  concat_ws(',', case when {holds('of the')} or {holds('the is')} then 'promotion' end, case when {holds('to the')} then 'job_ad' end) disqualifiers
from posts""")
def disqualify(spark, sf):
    scored = A.posts(spark, sf).withColumn("score", F.col("engagement")["score"])
    out = filters.disqualify(scored, {"promotion": ["of the", "the is"], "job_ad": ["to the"]})
    return out.select("external_id", "score", joined("disqualifiers"))


@query("drop_do_not_approach", "posts", """
select id, author from posts where author not in (select concat('u', s_suppkey) from supplier where s_acctbal < 0)""")
def drop_do_not_approach(spark, sf):
    blocked = A.table(spark, sf, "supplier").filter("s_acctbal < 0").select(F.concat(F.lit("u"), F.col("s_suppkey").cast("string")).alias("author"))
    return joins.drop_do_not_approach(A.posts(spark, sf), blocked).select("id", "author")


@query("seed_if_empty", "", "select n_name as name from nation where (select count(*) from region where r_regionkey > 100) = 0")
def seed_if_empty(spark, sf):
    existing = A.table(spark, sf, "region").filter("r_regionkey > 100")
    return loading.seed_if_empty(existing, A.table(spark, sf, "nation").select(F.col("n_name").alias("name")))


@query("seed_if_held", "", "select n_name as name from nation where (select count(*) from region) = 0")
def seed_if_held(spark, sf):
    return loading.seed_if_empty(A.table(spark, sf, "region"), A.table(spark, sf, "nation").select(F.col("n_name").alias("name")))


@query("log_events", "drafts", """
select 'warn' as level, 'drafter' source, 'REJECTED' code, rejection_reason message, concat('{"id":', id, ',"lead_id":', lead_id, '}') context,
  reviewed_at occurred_at from drafts where status = 'rejected'""")
def log_events(spark, sf):
    rejected = A.drafts(spark, sf).filter("status = 'rejected'")
    return loading.log_events(rejected, "warn", "drafter", "REJECTED", F.col("rejection_reason"), ["id", "lead_id"], F.col("reviewed_at"))


@query("session_row", "", """
select 'scrape_cycle' kind, {now} started_at, {now} + interval '5' minute ended_at, 'complete' status,
  concat('{"attempted":', count(*), ',"inserted":', (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)), '}') stats
from lineitem""")
def session_row(spark, sf):
    row = loading.session_row("scrape_cycle", AS_OF, "2024-01-31T00:05:00", cycle_stats(spark, sf))
    return row.select("kind", ntz("started_at"), ntz("ended_at"), "status", "stats")


@query("requeue_recent", "posts", """
select platform, external_id, 'requeued' as "event", {now} as "at" from posts where scraped_at > {now} - interval '24' hour""")
def requeue_recent(spark, sf):
    return loading.requeue_recent(A.posts(spark, sf), AS_OF)


@query("split_phrases", "", """
select s_suppkey id, concat('of the|', s_name) phrases, concat('of the,', s_name) rejoined from supplier""")
def split_phrases(spark, sf):
    text = F.concat(F.lit(" of the ,, "), F.col("s_name"), F.lit(" ,"))
    parts = X.split_phrases(text)
    return A.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.array_join(parts, "|").alias("phrases"), X.join_phrases(parts).alias("rejoined")
    )


@query("numbers_and_times", "", """
select event_id, coalesce(try_cast(nullif(regexp_extract(concat(event_id % 50, 'x'), '^[0-9]+'), '') as int), 7) n,
  case when event_id % 3 = 0 then 7 else cast(event_id % 50 as int) end defaulted, least(cast(event_id as bigint), 100) capped,
  date_trunc('second', ts) as_iso, date_trunc('second', ts) as_epoch
from events""")
def numbers_and_times(spark, sf):
    e = A.table(spark, sf, "events")
    n = (F.col("event_id") % 50).cast("string")
    odd = F.when(F.col("event_id") % 3 == 0, F.lit("none")).otherwise(n)
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return e.select(
        "event_id", X.int_or_default(F.concat(n, F.lit("x")), 7).alias("n"), X.int_or_default(odd, 7).alias("defaulted"),
        X.at_most(F.col("event_id"), 100).alias("capped"), iso_to_ts(iso).cast("timestamp_ntz").alias("as_iso"),
        epoch_to_ts(seconds).cast("timestamp_ntz").alias("as_epoch"),
    )


@query("collect_cycle", "posts", f"""
with l as (select 'reddit' platform, concat('t3_', id) external_id, author, title, case when id % 19 = 0 then '' else body end body, posted_at
  from posts where id % 11 <> 0 and id % 14 <> 0 and id % 17 <> 0 and posted_at >= {{now}} - interval '120' hour),
s as (select platform, external_id, author, title, body, posted_at from ({_SEARCH_SQL}))
select * from (select * from l union all select * from s)
where (platform, external_id) not in (select (platform, external_id) from posts where platform = 'reddit')""")
def collect_cycle(spark, sf):
    listing = payloads.normalize_listing(_listing_payloads(spark, sf), AS_OF, lookback_hours=120).drop("page")
    search = payloads.normalize_search(_search_payloads(spark, sf), AS_OF, lookback_hours=120).drop("page")
    existing = A.posts(spark, sf).filter("platform = 'reddit'")
    new = cycles.collect_cycle(existing, [listing, search], AS_OF).new_posts
    return new.select("platform", "external_id", "author", "title", "body", ntz("posted_at"))


@query("collect_cycle_phrases", "posts", """
with f as (select id, posted_at, title, author, case when id % 2 = 0 then 'to the' else 'a last one' end phrase, id // 50 page from posts
  where id % 11 <> 0 and id % 14 <> 0 and id % 17 <> 0 and posted_at >= {now} - interval '120' hour)
select concat('t3_', id) external_id, phrase matched_keywords, concat('src', page % 3) source_id, true same_raw, {now} scraped_at from f""")
def collect_cycle_phrases(spark, sf):
    """Each page is found by three phrases; the first in the order of reading counts, whatever the alphabet says."""
    pages = _listing_payloads(spark, sf)
    phrases = F.array(*[F.struct(F.lit(p).alias("keyword"), F.lit(r).alias("phrase_rank")) for r, p in enumerate(("to the", "a last one", "b"))])
    children = F.from_json("payload", "data struct<children: array<struct<data: string>>>")["data"]["children"]
    # The first phrase finds the even posts only.
    even = F.filter(children, lambda c: F.get_json_object(c["data"], "$.id").cast("long") % 2 == 0)
    found = pages.select("page", "payload", even.alias("even"), F.explode(phrases).alias("p")).select("page", "payload", "even", "p.*")
    some = F.concat(F.lit('{"data":{"children":['), F.array_join(F.transform("even", lambda c: F.concat(F.lit('{"data":'), c["data"], F.lit("}"))), ","), F.lit("]}}"))
    raw = found.select(
        F.concat(F.lit("src"), (F.col("page") % 3).cast("string")).alias("source_id"), "keyword", "phrase_rank",
        F.when(F.col("phrase_rank") == 0, some).otherwise(F.col("payload")).alias("payload"),
    )
    new = cycles.collect_cycle(A.posts(spark, sf).limit(0), [payloads.normalize_listing(raw, AS_OF, lookback_hours=120)], AS_OF).new_posts
    same = F.concat(F.lit("t3_"), F.get_json_object("raw", "$.id")) == F.col("external_id")
    return new.select("external_id", joined("matched_keywords"), "source_id", same.alias("same_raw"), ntz("scraped_at"))


@query("collect_cycle_events", "posts attempts", """
with n as (select count(*) n from posts where id % 11 <> 0 and id % 14 <> 0 and id % 17 <> 0 and posted_at >= {now} - interval '120' hour)
select 'info' as "level", 'SCRAPE_DONE' code, concat(n, ' new posts') message, concat('{"attempted":', n, ',"inserted":', n, '}') context, 'complete' run_status from n
union all select 'error', 'SCRAPE_FAILED', concat('source ', source_id), concat('{"source_id":', source_id, '}'), null from attempts where outcome = 'failed'""")
def collect_cycle_events(spark, sf):
    listing = payloads.normalize_listing(_listing_payloads(spark, sf), AS_OF, lookback_hours=120).drop("page")
    done = cycles.collect_cycle(A.posts(spark, sf).limit(0), [listing], AS_OF, A.attempts(spark, sf))
    run = done.run.select(F.col("stats").alias("context"), F.col("status").alias("run_status"))
    return done.events.select("level", "code", "message", "context").join(run, "context", "left")


@query("write_table", "posts leads", """
select id, platform, external_id, author, score, status, scored_at from (select cast(id as varchar) id, platform, external_id, author, score, status, scored_at from leads)
where scored_at >= {now} - interval '60' hour""")
def write_table(spark, sf):
    """Leads stored by day and read from a moment on."""
    base = shared_folder(spark)
    tables.write_table(A.leads(spark, sf), base, "leads")
    out = tables.read_table(spark, base, "leads", "2024-01-28T12:00:00")
    return out.select("id", "platform", "external_id", "author", "score", "status", ntz("scored_at"))
