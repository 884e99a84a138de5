import base64
import gzip
import hashlib

from atomweft.llm import url_rules, warc

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("a.b.example.com", "", "allow"), ("example.com", "/en/77/x", "block"), ("", "/x", "block"), ("COM", "/en/", "block")]
URLS = ["http://a.example.com/en/1?x=/en/7", "https://Example.COM/en/77", "http://example.com/en/77/x/y#f", "x://x.net/de/8", "x://q.example.net/de/80", None, "", "no-scheme/en/", "http://", "http://com/en/", "http://notexample.com/en/7", "http://a.b.example.com:80/en/", "http://a.b.example.com", "a://b://c/d", "http://x.com?/en/", "http://x.com/EN/", "http://example-x.com/en/1", "http://é.com/en/"] * 3


def brute(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), h.lower() + p, v) for h, p, v in RULES if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    return (host, path, *max(fits)[2:]) if fits else (host, path, None, "allow")


def test_rules(spark):
    rows = [(i if i % 7 else None, u) for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_rules.judge_urls(pages.selectExpr("*", "'x' as host", "'y' as rule", "1 as id", "2 as key"), rules).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, ((i, *brute(u)) for i, u in rows)))
    assert {r.verdict for r in url_rules.judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


def test_many_nested_rules_over_many_ranges(spark):
    hosts = [".".join(f"h{(i // 3**k) % 3}" for k in range(4)) + ".org" for i in range(81)]
    rules = [(".".join(h.split(".")[k:]), f"/p{k}", "block" if k % 2 else "allow") for h in hosts[:40] for k in range(4)]
    rules = sorted(set(rules))
    pages = [(i, f"http://{hosts[i % 81]}/p{i % 5}/x") for i in range(3000)]
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge_urls(spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    for i, u in pages:
        host, path = u[7:].split("/", 1)[0], "/" + u[7:].split("/", 1)[1]
        fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i] == (max(fits)[2:] if fits else (None, "allow"))


def test_round_trip(spark, tmp_path):
    html = ["<p>é</p>", "<p>é</p>", "", None, "x", "WARC/1.1\r\n\r\n\r\nContent-Length: 9\r\n\r\n", "y" * 3_000_000, "x", "x"]
    rows = [(10 - i, f"http://h/{i}\r\nX: y", h) for i, h in enumerate(html)] + [(None, None, "x"), (None, None, "only"), (2, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'z' as payload", "1 as keeper", "'d' as digest")
    warc.write_archives(pages, str(tmp_path / "w"))
    records = warc.read_archives(spark, str(tmp_path / "w"), with_payload=True)
    assert records.where("NOT coalesce(intact, true)").count() == 0
    got = warc.resolve(records.drop("payload")).collect()
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    want = []
    for p, _, h in rows:
        data = (h or "").encode()
        keeper = first.get(h or "")
        again = keeper is not None and p != keeper
        want.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", keeper if again else None))
    assert sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got))) == sorted(map(repr, want))
    texts = {r.page_id: r.payload for r in records.where("record_type = 'response'").collect()}
    assert texts[5] == html[5] and texts[4] == html[6]
    parts = [m for p in (tmp_path / "w").glob("part-*") for m in warc.members(p.read_bytes())]
    assert all(m.count(b"WARC-Type: ") == 1 and m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in parts) and len(parts) == len(rows)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("part-*"))
    assert raw == b"".join(parts)
    assert raw.count(b"WARC-Type: revisit") == sum(w[3] == "revisit" for w in want)
    warc.write_archives(pages.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0


def test_small_payloads_are_never_revisits(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id bigint, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), least_bytes=3)
    assert {r.page_id for r in warc.read_archives(spark, str(tmp_path / "w")).where("record_type = 'revisit'").collect()} == {4}


def test_large_payloads_and_files_of_others(spark, tmp_path):
    big = "".join(chr(97 + i * i % 23) for i in range(1000)) * 20_000  # over 16 MB, where a member does not end with a zero byte
    warc.write_archives(spark.createDataFrame([(1, "u", big), (2, "u", big), (3, "u", "x")], "page_id bigint, url string, html string"), str(tmp_path / "w"))
    got = {r.page_id: (r.record_type, r.payload_bytes, r.intact) for r in warc.resolve(warc.read_archives(spark, str(tmp_path / "w"))).collect()}
    assert got == {1: ("response", len(big), True), 2: ("revisit", len(big), None), 3: ("response", 1, True)}
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:a>\r\nContent-Length: 3\r\n\r\nx\r\n\r\n\r\n"
    page = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:b>\r\nContent-Length: 22\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc\r\n\r\n"
    (tmp_path / "o").mkdir()
    (tmp_path / "o" / "some.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(page) + gzip.compress(page + page))
    rows = warc.read_archives(spark, str(tmp_path / "o"), with_payload=True).collect()
    assert [(r.record_type, r.payload_bytes, r.intact, r.payload) for r in rows] == [("warcinfo", None, None, None)] + [("response", 3, None, "abc")] * 3


def test_rows_without_a_reference_are_not_joined(spark, monkeypatch):
    """With shuffled joins no task gets more than its share, though nine of ten rows refer to nothing; a revisit of what is not there has nulls."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(warc, "sized", lambda df: df)
    for key, value in {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        spark.conf.set(key, value)
    try:
        again = F.col("id") % 10 == 9
        records = spark.range(0, 4000, 1, 8).select(
            F.when(again, "revisit").otherwise("response").alias("record_type"), F.concat(F.lit("r"), "id").alias("record_id"), F.col("id").alias("page_id"),
            F.when(F.col("id") == 3999, "gone").when(again, F.concat(F.lit("r"), F.col("id") - 1)).alias("refers_to_id"), F.when(~again, F.col("id") * 2).alias("payload_bytes"),
        )
        got = warc.resolve(records).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tasks = [r.task for r in got]
    assert len(got) == 4000 and max(map(tasks.count, set(tasks))) <= 600
    want = {i: (i * 2, None) if i % 10 < 9 else (None, None) if i == 3999 else ((i - 1) * 2, i - 1) for i in range(4000)}
    assert {r.page_id: (r.payload_bytes, r.refers_to) for r in got} == want
