import json
import zipfile

import pytest
from pyspark.sql import functions as F

from galley.operators import vectors
from galley.plans import migration
from galley.sinks import files
from galley.sources import export, storage
from galley.streaming import content as streaming

LONG = "word " * 40
POSTS = f"""<?xml version="1.0" encoding="UTF-8"?>
<rss xmlns:content="c" xmlns:wp="w"><channel>
<wp:author><wp:author_login>ann.bee</wp:author_login><wp:author_email>a@x.test</wp:author_email><wp:author_display_name>ann.bee</wp:author_display_name><wp:author_first_name></wp:author_first_name><wp:author_last_name></wp:author_last_name></wp:author>
<wp:author><wp:author_login>ab</wp:author_login><wp:author_email></wp:author_email><wp:author_display_name>Ann Bee</wp:author_display_name><wp:author_first_name>Ann</wp:author_first_name><wp:author_last_name>Bee</wp:author_last_name></wp:author>
<wp:author><wp:author_login>cd</wp:author_login><wp:author_email></wp:author_email><wp:author_display_name>Cy Dee and Eve Fox</wp:author_display_name><wp:author_first_name></wp:author_first_name><wp:author_last_name></wp:author_last_name></wp:author>
<item><title>One &amp;amp; "x"</title><content:encoded><![CDATA[<img src="/wp-content/uploads/1/a.png">{LONG}]]></content:encoded><description></description><wp:post_name></wp:post_name><wp:comment_status>open</wp:comment_status><wp:post_modified_gmt>2020-01-01 00:00:00</wp:post_modified_gmt><wp:post_date_gmt>0000-00-00 00:00:00</wp:post_date_gmt>
<category domain="author" nicename="x"><![CDATA[Ann Bee]]></category><category domain="author" nicename="x"><![CDATA[Gus T.]]></category><category domain="post_tag" nicename="n"><![CDATA[news]]></category>
<wp:postmeta><wp:meta_key>_yoast_t</wp:meta_key><wp:meta_value>v</wp:meta_value></wp:postmeta></item>
<item><title>One x</title><content:encoded><![CDATA[{LONG}]]></content:encoded><wp:post_name>one-x</wp:post_name><category domain="author" nicename="x"><![CDATA[Nobody]]></category></item>
<item><title>short</title><content:encoded>s</content:encoded></item>
<item><content:encoded><![CDATA[{LONG}]]></content:encoded></item>
</channel></rss>"""


def _meta(**values):
    return "".join(f"<wp:postmeta><wp:meta_key>cap-{k}</wp:meta_key><wp:meta_value>{v}</wp:meta_value></wp:postmeta>" for k, v in values.items())


GUESTS = f"""<?xml version="1.0" encoding="UTF-8"?><rss xmlns:wp="w"><channel>
<item>{_meta(display_name="Gus Tee", user_login="gus t")}</item><item>{_meta(display_name="Ann Bee", user_login="ab")}</item></channel></rss>"""


def test_whole_migration(spark, tmp_path):
    archive = tmp_path / "export.zip"
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("posts.xml", POSTS)
        z.writestr("guests.xml", GUESTS)
    posts, guests = export.unzip(spark, str(archive), f"{tmp_path}/in")
    result = migration.migrate(*migration.read(spark, posts, guests))
    people = [tuple(r)[1:] for r in result.authors.orderBy("ord").collect()]
    assert people == [
        (3, "Cy Dee", "Cy", "Dee", None, "cy-dee"),
        (4, "Eve Fox", "Eve", "Fox", None, "eve-fox"),
        (0, "Ann Bee", "Ann", "Bee", "a@x.test", "ann-bee"),
        (5, "Gus Tee", "Gus", "Tee", None, "gus-t"),
    ]
    rows = result.articles.orderBy("id").collect()
    assert [(r.id, r.slug, r.author_ids, r.title) for r in rows] == [(0, "one-x", [0, 5], 'One & "x"'), (1, "one-x-1", [], "One x")]
    assert rows[0].metadata == {"_yoast_t": "v"} and rows[0].tags == ["news"] and rows[0].photo_url == "wp-content/uploads/1/a.png"
    assert rows[0].fixes == "backslashes stripped; paragraph tags restored" and rows[0].excerpt.startswith("word word")
    assert [r.name for r in result.logs["byline_unknown"].collect()] == ["nobody"]

    migration.write(result, f"{tmp_path}/out", "site.test")
    lines = (tmp_path / "out/sql/authors.sql").read_text().split("\n")
    assert lines[0].startswith("CREATE TABLE authors (id BIGINT PRIMARY KEY AUTO_INCREMENT, display_name VARCHAR(255)")
    assert "INSERT INTO authors (id, display_name, first_name, last_name, email, login) VALUES ('5', 'Gus Tee', 'Gus', 'Tee', NULL, 'gus-t');" in lines
    text = (tmp_path / "out/sql/articles.sql").read_text().split("\n")
    assert text[-1] == "" and len(text) == 4
    by_place = json.loads((tmp_path / "out/authors.json").read_text())
    assert list(by_place) == ["0", "1", "2", "3"] and by_place["3"]["login"] == "gus-t" and by_place["0"]["email"] is None
    assert [p.name for p in (tmp_path / "out/articles").glob("*.json")] == ["0.json"]
    assert [r["slug"] for r in json.loads((tmp_path / "out/articles/0.json").read_text()).values()] == ["one-x", "one-x-1"]
    state = migration.read_state(spark, f"{tmp_path}/out")
    assert list(state) == ["byline_unknown"]
    again = migration.migrate(*migration.read(spark, posts, guests), state=state)
    assert [(r.name, r.article_ids) for r in again.logs["byline_unknown"].collect()] == [("nobody", [1])]
    assert text[0].startswith("CREATE TABLE articles (`id` BIGINT") and "'https://site.test/wp-content/uploads/1/a.png'" in text[1]
    migration.write_embeddings(result, f"{tmp_path}/out", vectors.hashed_features(4))
    made = [r.value for r in spark.read.text(f"{tmp_path}/out/sql/article_embeddings.sql").collect()]
    assert any("VECTOR(4)" in x for x in made) and sum(x.startswith("INSERT INTO article_embeddings") for x in made) == 2


def test_stores(spark, tmp_path):
    path = f"{tmp_path}/cache"
    kind = "name string, author_id long, display_name string"
    assert export.stored(spark, path, kind).count() == 0
    export.store(spark.createDataFrame([("a", 1, "A")], kind), path)
    assert export.stored(spark, path, kind).first()["author_id"] == 1
    assert export.delete(spark, path) and not export.delete(spark, path)
    conflict = F.struct(F.col("x"))
    old = spark.createDataFrame([(0, "p"), (1, "q")], "ord long, x string").select("ord", conflict.alias("conflict"))
    new = spark.createDataFrame([(0, "q"), (1, "r")], "ord long, x string").select("ord", conflict.alias("conflict"))
    assert [r.conflict.x for r in export.merged_conflicts(old, new).orderBy("run", "ord").collect()] == ["p", "q", "r"]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a \\"b\\"', ["news"], "2024-01-01 00:00:00"), (2, "c​", ["x"], "2024-01-01 00:01:00")], "id long, text string, categories array<string>, t string").withColumn("t", F.to_timestamp("t"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    q = streaming.sanitised(stream()).writeStream.format("memory").queryName("sanitised").start()
    q.processAllAvailable()
    q.stop()
    assert {r.id: r.excerpt for r in spark.table("sanitised").collect()}[1] == 'a "b"'
    q = streaming.odd_character_counts(stream(), "t").writeStream.format("memory").queryName("odd").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert [(r.kind, r.n) for r in spark.table("odd").collect()] == [("zero-width character", 1)]
    spark.createDataFrame([(1, ["ann bee"])], "id long, names array<string>").write.parquet(f"{tmp_path}/names")
    known = spark.createDataFrame([(0, 7, "Ann Bee", None)], "ord long, id long, display_name string, login string")
    seen = []
    names = spark.readStream.schema("id long, names array<string>").parquet(f"{tmp_path}/names")
    q = streaming.match_batches(names, known, lambda df, n: seen.extend(df.collect()), f"{tmp_path}/state")
    q.processAllAvailable()
    q.stop()
    assert [(r.id, r.author_ids) for r in seen] == [(1, [7])]


def test_a_run_that_is_killed_leaves_the_state_before(spark, tmp_path, monkeypatch):
    folder, schema, store = f"{tmp_path}/state", "name string", export.store
    rows = lambda *x: spark.createDataFrame([(v,) for v in x], schema)
    read = lambda: {t: sorted(r.name for r in export.stored(spark, f"{export.current(spark, folder)}/{t}", schema).collect()) for t in ("a", "b")}
    assert export.current(spark, folder) is None and migration.read_state(spark, str(tmp_path)) == {}
    export.publish(spark, folder, {"a": rows("1"), "b": rows("1", "2")})
    first = export.current(spark, folder)

    def dies(df, path):
        if path.endswith("/b"):
            raise KeyboardInterrupt
        store(df, path)

    monkeypatch.setattr(export, "store", dies)
    with pytest.raises(KeyboardInterrupt):
        export.publish(spark, folder, {"a": rows("9"), "b": rows("9")})
    monkeypatch.setattr(export, "store", store)
    assert export.current(spark, folder) == first and read() == {"a": ["1"], "b": ["1", "2"]}
    monkeypatch.setattr(export, "replace", lambda *a: dies(None, "/b"))
    with pytest.raises(KeyboardInterrupt):  # all is written, but not named
        export.publish(spark, folder, {"a": rows("9"), "b": rows("9")})
    monkeypatch.undo()
    assert read() == {"a": ["1"], "b": ["1", "2"]}
    export.publish(spark, folder, {"a": export.stored(spark, f"{first}/a", schema).union(rows("3")), "b": rows()})
    assert read() == {"a": ["1", "3"], "b": []}
    export.publish(spark, folder, {"a": rows("4"), "b": rows("4")})
    left = [p.name for p in (tmp_path / "state").iterdir() if p.name.startswith("v-")]
    assert len(left) == 2 and read() == {"a": ["4"], "b": ["4"]}


def test_archives_of_several_members(spark, tmp_path):
    names = {"a.txt": b"", "in/b.txt": b"x" * 3_000_000, "in/deep/c.bin": bytes(range(256))}
    with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("in/", b"")
        z.writestr("../out.txt", b"not outside")
        for name, data in names.items():
            z.writestr(name, data)
    got = export.unzip(spark, f"{tmp_path}/x.zip", f"{tmp_path}/to")
    assert got == [f"{tmp_path}/to/{n}" for n in names]
    assert {str(p.relative_to(tmp_path / "to")): p.read_bytes() for p in (tmp_path / "to").rglob("*") if p.is_file()} == names
    assert not (tmp_path / "out.txt").exists()


def test_files_are_whole_or_not_there(tmp_path):
    uri = f"file://{tmp_path}/d/f.txt"

    def broken():
        yield b"half"
        raise OSError

    with pytest.raises(OSError):
        storage.put(uri, broken())
    assert not (tmp_path / "d/f.txt").exists()
    storage.put(uri, [b"one"])
    storage.put(uri, [b"t", b"wo"])
    assert (tmp_path / "d/f.txt").read_bytes() == b"two"


def test_files_of_lines_and_buckets(spark, tmp_path):
    lines = spark.range(5000).selectExpr("id ord", "concat('l', id) line").repartition(7)
    for _ in range(2):  # written over
        files.write_lines(lines, f"{tmp_path}/x.sql")
        assert (tmp_path / "x.sql").read_text() == "".join(f"l{i}\n" for i in range(5000))
    rows = spark.range(25).selectExpr("id * 3 k", "if(id % 2 = 0, 'a', null) entry", "'b' bucket").repartition(3)
    assert files.write_buckets(rows, "k", f"{tmp_path}/b", 10) == 3
    found = {p.name: json.loads(p.read_text()) for p in (tmp_path / "b").glob("*.json")}
    assert {n: len(x) for n, x in found.items()} == {"0.json": 10, "1.json": 10, "2.json": 5} and found["1.json"]["11"] == {"k": 33, "entry": None, "bucket": "b"}
    assert files.write_buckets(rows.limit(0), "k", f"{tmp_path}/b", 10) == 0 and list((tmp_path / "b").glob("*.json")) == []


def test_an_export_in_parts_is_read_whole(spark, tmp_path):
    """Each file is whole by itself, and no one of them has all elements."""
    n = 20_000
    items = spark.range(n).repartition(5).select("id", F.format_string("<item><title>t%d &amp; x</title></item>", "id").alias("line")).toDF("ord", "line")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one part
    try:
        for _ in range(2):  # written over
            files.write_parts(items, f"{tmp_path}/export", "<rss><channel>", "</channel></rss>")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(p for p in (tmp_path / "export").iterdir() if p.name.startswith("part-"))
    lines = [p.read_text().splitlines() for p in parts]
    assert len(parts) > 1 and all(x[0] == "<rss><channel>" and x[-1] == "</channel></rss>" for x in lines)
    assert [y for x in lines for y in x[1:-1]] == [f"<item><title>t{i} &amp; x</title></item>" for i in range(n)]
    got = export.articles(spark, f"{tmp_path}/export").select("title").collect()
    assert sorted(r.title for r in got) == sorted(f"t{i} & x" for i in range(n))
