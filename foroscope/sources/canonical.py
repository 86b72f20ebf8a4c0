"""Board tables of several software families brought to one canonical model."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Canonical column <- column of the exporting software.
ALIASES = {
    "mybb": {
        "user": {"userid": "uid", "joindate": "regdate", "lastactivity": "lastactive", "posts": "postnum"},
        "post": {"postid": "pid", "threadid": "tid", "forumid": "fid", "userid": "uid", "pagetext": "message"},
        "thread": {"threadid": "tid", "forumid": "fid", "userid": "uid", "title": "subject",
                   "replycount": "replies"},
        "pmtext": {"pmtextid": "pmid", "fromuserid": "fromid", "touserarray": "toid", "title": "subject"},
    },
    "ips": {
        "user": {"userid": "member_id", "username": "name", "joindate": "joined"},
        "post": {"postid": "pid", "threadid": "topic_id", "userid": "author_id", "username": "author_name",
                 "dateline": "post_date", "pagetext": "post"},
        "thread": {"threadid": "tid", "forumid": "forum_id", "dateline": "start_date", "userid": "starter_id",
                   "replycount": "posts"},
        "private_message": {"topic_id": "msg_topic_id", "dateline": "msg_date", "text": "msg_post",
                            "sender_id": "msg_author_id"},
        "message_topic": {"topic_id": "mt_id", "receiver_id": "mt_to_member_id"},
        "section": {"forumid": "id", "topic_count": "topics", "post_count": "posts"},
    },
    "flat": {
        "user": {"userid": "id", "username": "user", "joindate": "regdate", "lastactivity": "lastactive",
                 "posts": "postnum"},
    },
    "vbulletin": {},
}

# Canonical columns kept per table. Credentials and addresses are left out on purpose.
COLUMNS = {
    "user": {"userid": "string", "username": "string", "joindate": "time", "lastactivity": "time",
             "lastpost": "time", "posts": "bigint", "reputation": "bigint", "timezoneoffset": "bigint",
             "usertitle": "string"},
    "post": {"postid": "string", "threadid": "string", "forumid": "string", "userid": "string", "username": "string",
             "dateline": "time", "pagetext": "string"},
    "thread": {"threadid": "string", "forumid": "string", "userid": "string", "title": "string",
               "dateline": "time", "lastpost": "time", "replycount": "bigint", "views": "bigint"},
    "private_message": {"topic_id": "string", "sender_id": "string", "dateline": "time", "text": "string"},
    "message_topic": {"topic_id": "string", "receiver_id": "string"},
    "section": {"forumid": "string", "name": "string", "topic_count": "bigint", "post_count": "bigint"},
    "pmtext": {"pmtextid": "string", "fromuserid": "string", "title": "string", "message": "string",
               "touserarray": "string", "dateline": "time"},
}

# Accepted unix seconds, 2000-01-01 to 2030-01-01.
FIRST_SECOND, LAST_SECOND = 946684800, 1893456000


def unix_time(col, bounded: bool = True) -> Column:
    """Unix seconds text to UTC timestamp; anything unusable becomes NULL."""
    sec = F.expr(f"try_cast({col} as bigint)") if isinstance(col, str) else col.try_cast("bigint")
    ok = sec.between(FIRST_SECOND, LAST_SECOND) if bounded else sec > 0
    return F.when(ok, F.timestamp_seconds(sec))


def canonical(df: DataFrame, family: str, table: str, forum: str) -> DataFrame:
    """Rename, type and project one raw table; absent columns become typed NULLs.

    Rows held for moderation (``queued`` other than 0) are dropped, a display name wins over the login
    name, and ``forum`` records the source. ``section`` is the table of a board's own sub-forums.
    """
    if "queued" in df.columns:
        df = df.filter(F.col("queued").cast("string") == "0")
    if "members_display_name" in df.columns:
        df = df.withColumn("name", F.coalesce("members_display_name", *["name"] * ("name" in df.columns)))
    alias = ALIASES[family].get(table, {})
    out = [F.lit(forum).alias("forum")]
    for name, kind in COLUMNS[table].items():
        raw = alias[name] if alias.get(name) in df.columns else name
        target = "timestamp" if kind == "time" else kind
        if raw not in df.columns:
            out.append(F.lit(None).cast(target).alias(name))
        elif kind == "time":
            out.append(unix_time(raw, bounded=family == "ips").alias(name))
        else:
            out.append(F.expr(f"try_cast({raw} as {target})").alias(name))
    return df.select(*out)


def with_receiver(messages: DataFrame, topics: DataFrame) -> DataFrame:
    """Each private message with the receiver of its conversation (lowest id when a topic repeats)."""
    receivers = topics.groupBy("forum", "topic_id").agg(F.min("receiver_id").alias("receiver_id"))
    return messages.join(receivers, ["forum", "topic_id"], "left").select(
        "forum", "topic_id", "sender_id", "receiver_id", "dateline", "text")
