"""Hand-written raw files with the traps of real exports."""

import datetime as dt

from foroscope.sources import canonical as can
from foroscope.sources import combine, rawtext


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


DUMP = r"""-- server's dump
CREATE TABLE `vb_user` (
  `userid` int(10) NOT NULL,
  `username` varchar(100) DEFAULT '',
  `note` text,
  `hexed` blob,
  PRIMARY KEY (`userid`)
) ENGINE=MyISAM;
INSERT INTO `vb_user` VALUES (1,'O\'Neil (admin)','a;
b',0x616263),	(2,'x, y','line\nbreak \\ end',NULL),(3,'short');
INSERT INTO `vb_user` (`note`,`userid`) VALUES ('it''s; (ok)',4), ('long',5,'surplus');
CREATE TABLE `other` (
  `id` int
);
INSERT INTO `other` VALUES (7);
"""


def test_sql_dump(spark, tmp_path):
    rows = rawtext.read_sql_dump(spark, write(tmp_path / "d.sql", DUMP))
    got = {r.userid: (r.username, r.note, r.hexed)
           for r in rawtext.dump_table(rows, "user", ["userid", "username", "note", "hexed"]).collect()}
    assert got == {
        "1": ("O'Neil (admin)", "a;\nb", "abc"), "2": ("x, y", "line\nbreak \\ end", None), "3": ("short", None, None),
        "4": (None, "it's; (ok)", None), "5": (None, "long", None)}
    assert [r.id for r in rawtext.dump_table(rows, "other", ["id"]).collect()] == ["7"]


def test_dumps_keep_their_own_columns(spark, tmp_path):
    write(tmp_path / "first.sql", "/* it's a note */\nCREATE TABLE `post` (\n  `postid` int,\n  `username` text\n);\n"
                                  "INSERT INTO `post` VALUES (1,'ann');\nINSERT INTO `loose` VALUES (5,'x');\n")
    write(tmp_path / "second.sql", "# it's another\nCREATE TABLE `post` (\n  `username` text,\n  `postid` int\n);\n"
                                   "INSERT INTO `post` VALUES ('bob',2);\n")
    rows = rawtext.read_sql_dump(spark, str(tmp_path))
    got = rawtext.dump_table(rows, "post", ["postid", "username"], forum=True).collect()
    assert {tuple(r) for r in got} == {("first", "1", "ann"), ("second", "2", "bob")}
    loose = rawtext.dump_table(rows, "loose", ["column_1", "column_2"]).collect()
    assert [tuple(r) for r in loose] == [("5", "x")]


def test_statement_split_inside_string_over_many_blocks(spark, tmp_path):
    rows = "".join(f"INSERT INTO `t` VALUES ({i},'start;\nmiddle;\nend {i}');\n" for i in range(3000))
    path = write(tmp_path / "big.sql", "CREATE TABLE `t` (\n  `id` int,\n  `txt` text\n);\n" + rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = rawtext.dump_table(rawtext.read_sql_dump(spark, path), "t", ["id", "txt"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {int(r.id): r.txt for r in got} == {i: f"start;\nmiddle;\nend {i}" for i in range(3000)}


def test_concatenated_json(spark, tmp_path):
    text = ('{"ts":"2021-01-02T03:04:05","from":"ann@x.org","to":"bob@x.org","body":"a } {\\" b"}{"ts":"bad",'
            '"from":"cy","body":"ñandú"}\n{"ts":"2021-01-02T03:04:06.5","from":"ann@x.org","to":"bob"}')
    write(tmp_path / "room-1.json", text)
    got = rawtext.read_concatenated_json(spark, str(tmp_path), "src").orderBy("timestamp").collect()
    assert [(r.username, r.to_user, r.message, r.channel) for r in got] == [
        ("cy", "", "ñandú", "room-1"), ("ann", "bob", 'a } {" b', "room-1"), ("ann", "bob", "", "room-1")]
    assert got[0].timestamp is None and got[1].timestamp == dt.datetime(2021, 1, 2, 3, 4, 5)


def test_room_json(spark, tmp_path):
    write(tmp_path / "2022-02-17-general-chat.json", """{"messages": [
      {"ts": "2022-02-17T10:00:00.000Z", "rid": "R", "msg": "hi", "u": {"username": "ann"}},
      {"ts": "2022-02-17T10:01:00.000Z", "rid": "R", "t": "uj", "msg": "ann", "u": {"username": "ann"}},
      {"ts": "2022-02-17T10:02:00.000Z", "rid": "R", "msg": "no user"}]}""")
    write(tmp_path / "2022-02-18-broken.json", '{"messages": [{"ts": ')
    write(tmp_path / "plain.json", '{"other": 1}')
    got = rawtext.read_room_json(spark, str(tmp_path), "rooms").orderBy("timestamp").collect()
    assert [(r.username, r.message, r.channel) for r in got] == [
        ("ann", "hi", "general-chat"), ("", "no user", "general-chat")]


def test_kv_blocks(spark, tmp_path):
    text = """{
  timestamp: 2023-09-18 13:33:37,
  chat_id: !abc:host.example,
  sender_alias: @ann:host.example,
  message: line one
line two
}
{ timestamp: 2023-09-18 13:34:00,
  chat_id: !abc:host.example,
  message: no sender
}{
  timestamp: 2023-09-18 13:35:00,
  chat_id: !abc:host.example,
  sender_alias: bob,
  message: last}"""
    got = rawtext.read_kv_blocks(spark, write(tmp_path / "c.json", text), "kv").orderBy("timestamp").collect()
    assert [(r.username, r.channel, r.message) for r in got] == [
        ("ann", "abc", "line one\nline two"), ("bob", "abc", "last")]


def test_delimited_users(spark, tmp_path):
    text = 'ID:UserName:Mail:PostNum\n1:ann:a@x:5\n\n2:"b:ob"\n3:"c ""q""":x:7:extra\n'
    got = {r.id: (r.username, r.postnum) for r in rawtext.read_delimited(spark, write(tmp_path / "u.txt", text)).collect()}
    assert got == {"1": ("ann", "5"), "2": ("b:ob", None), "3": ('c "q"', "7")}
    for sep in "|\t;,":
        path = write(tmp_path / f"u{ord(sep)}.txt", f"id{sep}user\n1{sep}x\n")
        assert rawtext.read_delimited(spark, path).first().user == "x"


def test_unix_time_rules(spark):
    values = [None, "0", "-5", "abc", "946684799", "946684800", "1893456000", "1893456001"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    strict = [r.t is not None for r in df.select("i", can.unix_time("v").alias("t")).orderBy("i").collect()]
    loose = [r.t is not None for r in df.select("i", can.unix_time("v", bounded=False).alias("t")).orderBy("i").collect()]
    assert strict == [False, False, False, False, False, True, True, False]
    assert loose == [False, False, False, False, True, True, True, True]


def test_canonical_families_and_no_credentials(spark):
    raw = spark.createDataFrame([("9", "ann", "secret", "12", "1500000000", "x@y")],
                                "uid string, username string, password string, postnum string, regdate string, email string")
    row = can.canonical(raw, "mybb", "user", "board").first().asDict()
    assert row["userid"] == "9" and row["posts"] == 12 and row["joindate"] == dt.datetime(2017, 7, 14, 2, 40)
    assert row["forum"] == "board" and row["lastpost"] is None
    assert not {"password", "email", "salt", "ipaddress"} & set(row)


def test_cache_sinks_and_multi_file_read(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "cached.parquet")
    assert combine.materialize_once(spark, path, build).count() == 3
    assert combine.materialize_once(spark, path, build).count() == 3 and len(calls) == 1
    df = spark.createDataFrame([("1", "7"), ("2", "8")], "userid string, threadid string")
    for name in ("alpha", "beta"):
        df.toPandas().to_parquet(tmp_path / f"{name}.parquet")
    write(tmp_path / "._alpha.parquet", "junk")
    got = combine.read_sources(spark, str(tmp_path), ["alpha", "beta"])
    assert {r.userid for r in got.collect()} == {"alpha_1", "alpha_2", "beta_1", "beta_2"}
    assert combine.read_sources(spark, str(tmp_path), ["beta"]).count() == 2
    for fmt in ("csv", "json", "parquet"):
        combine.write_report(got, str(tmp_path / f"out_{fmt}"), fmt)
    assert spark.read.option("header", "true").csv(str(tmp_path / "out_csv")).count() == 4
    assert spark.read.json(str(tmp_path / "out_json")).count() == 4
    assert (tmp_path / "out_parquet" / "forum=alpha").exists()
