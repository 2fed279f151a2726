import re

import duckdb
import pytest

from visitlake.llm import urlrules as U
from visitlake.llm.queries import SQL, op5_token_indexed_rules

URLS = [None, "", "no-scheme.org/x", "http://A.Example.ORG/es/x", "http://example.org/es/x?q#f", "http://badexample.org/es/", "https://x.com/fr/1",
        "https://x.com/de", "https://x.com/de/", "http://example.org", "http://org/", "http://org?x=/", "x://y.example.org/en/123://z",
        "http://free-bets.example.net/en/5", "http://bets2.example.net/en/", "http://e.net/a/casino", "http://h.example.org/en/2",
        "http://x.example.org/EN/1", "ftp://user@com/fr/:80/", "http://" + "a" * 5000 + ".com/fr/" + "b/" * 5000, "http://üñ.org/ß",
        "http://e.net/casino\u212a", "http://e.net/casino\u0130x", "http://e.net/CASINO/", "http://e.net/\u212acasino", "http://CASINO\u0130.net/"]


def plain(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, pattern, tier, verdict in rules:
        if tier == 0:
            h, _, p = rule.partition("/")
            ok = ("." + host).endswith("." + h) and path.startswith("/" + p)
        else:
            ok = re.search(rf"(?<![A-Za-z0-9]){rule}(?![A-Za-z0-9])", host + path)
        if ok:
            fits.append((tier, -len(rule), rule, verdict))
    best = min(fits, default=(None, None, None, default))
    return host, path, best[2], best[0], best[3]


def test_against_every_rule_on_every_url(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(0, None, "x"), (5, URLS[5], "y"), (None, URLS[4], "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    rules = U.GIVEN + U.OWN
    got = U.judge(pages, U.rule_table(spark, rules)).collect()
    want = [(i, *plain(u, rules, "allow")) for i, u, _ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_patterns_and_their_tokens(spark):
    assert U.whole_tokens("||example.org/en/1") == ["en", "example", "org"]
    assert U.whole_tokens("^ads^") == ["ads"] and U.whole_tokens("ads") == [] and U.whole_tokens("/a*b/c/") == ["c"]
    rules = [("track", "/track*id/", 1, "block"), ("any", "zz", 2, "block"), ("seg", "^seg-x^", 1, "block")]
    pages = spark.createDataFrame([(1, "http://h/tracker/id/"), (2, "http://fizzz/"), (3, "http://h/seg-x"), (4, "http://h/seg-xy"),
                                   (5, "http://h/zz/track/id/")], "page_id long, url string")
    got = {r.page_id: r.rule for r in U.judge(pages, U.rule_table(spark, rules)).collect()}
    assert got == {1: "track", 2: "any", 3: "seg", 4: None, 5: "track"}


def test_letters_beyond_ascii_end_a_token_as_the_sql_says(spark):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    duck.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    want = duck.execute(SQL["op5_token_indexed_rules"]).fetchall()
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    judged = U.judge(pages, U.rule_table(spark, U.GIVEN + U.OWN))
    got = judged.select("page_id", "host", "path", U.F.when(judged.tier == 0, judged.rule), "verdict")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    blocked = {r.page_id for r in got.collect() if r.verdict == "block"}
    assert {URLS.index(u) for u in URLS if u and "\u212a" in u or u and "\u0130" in u} <= blocked


def test_filed_under_the_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://x.example.org/{'es' if i == 3 else 'en'}/") for i in range(9)], "page_id long, url string")
    index = U.filed(U.keyed(pages), U.rule_table(spark, [U.host_rule("example.org/es/", "block")])).first()
    assert index.token == "es"


def test_large_index_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(U, "BROADCAST_BYTES", 0)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = {r.page_id: r.rule for r in U.judge(pages, U.rule_table(spark, U.GIVEN)).collect()}
    assert got == {i: plain(u, U.GIVEN, "allow")[2] for i, u in enumerate(URLS)}


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(pages, U.rule_table(spark, U.GIVEN)).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert U.judge(one, U.rule_table(spark, []), "block").first().verdict == "block"


def test_query_is_native_and_matches_sql(spark, sf_dir):
    df = op5_token_indexed_rules(spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = duck.execute(SQL["op5_token_indexed_rules"]).fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("pattern", ["||a.b/c", "^x.y^", "a*b+c", "p^q", "(z)[1]$"])
def test_expression_is_read_alike_by_java(spark, pattern):
    keys = ["a.b/c", "aXb/c", "q.a.b/cd", "x.y", "1x.y", "ab+c", "azzb+c", "p-q", "pq", "(z)[1]$"]
    df = spark.createDataFrame([(k, U.to_regex(pattern)) for k in keys], "key string, regex string")
    got = {r.key: r.ok for r in df.selectExpr("key", "key RLIKE regex AS ok").collect()}
    assert got == {k: bool(re.search(U.to_regex(pattern).replace(r"\z", r"\Z"), k)) for k in keys}
