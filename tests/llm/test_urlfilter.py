import pytest
from pyspark.sql import functions as F

from agorascope.llm import queries, urlfilter as U

URLS = [
    None, "", "no scheme.org/x", "http://org", "http://org/", "HTTP://A.ORG/es/", "http://example.org/es/1", "http://sub.Example.org/es/", "http://example.org/es",
    "http://example.org/en/123?q=/es/", "http://notexample.org/en/1", "http://a.com/fr/?x", "http://a.com/de/#y", "http://a.com/fr", "http://a.net/de/", "x://y://z.org/a",
    "http://bad.example.net", "http://m.bad.example.net/p", "http://verybad.example.net/p", "http://../", "://", "http://user@a.org:80/x", "http://" + "a." * 3000 + "org/" + "p" * 5000,
]


def expected(url, allow, block, hosts):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for sign in "/?#":
        host = host.split(sign)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    within = lambda h: host == h or host.endswith("." + h)
    fits = [(len(r), r, v) for v, rules in (("allow", allow), ("block", block)) for r in rules if within(r.split("/")[0]) and path.startswith(r[r.find("/"):])]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if any(within(h) for h in hosts) else "allow"


def test_rules_and_hosts_by_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS * 2)], "page_id int, url string, host string, rule string")
    hosts = ["bad.example.net", "org", "nowhere.test"]
    found = U.judge_urls(pages, queries.ALLOW, queries.BLOCK, spark.createDataFrame([(h,) for h in hosts] * 2 + [(None,)], "key string"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert got == {i: expected(u, queries.ALLOW, queries.BLOCK, hosts) for i, u in enumerate(URLS * 2)}


@pytest.mark.parametrize("bits", [U.LITERAL_BITS, 2000])
def test_cascade_is_exact_over_its_universe(spark, bits):
    keys = [f"h{i}.example.org" for i in range(3000)]
    listed = {k for i, k in enumerate(keys) if i % 7 == 0}
    urls = U.with_host_and_path(spark.createDataFrame([("http://" + k + "/x",) for k in keys], "url string"))
    names = spark.createDataFrame([(k,) for k in sorted(listed) + ["else.where.net"]], "key string")
    if bits < U.LITERAL_BITS:  # several cascades, each asked for its share of the keys
        names = names.where(F.pmod(F.xxhash64("key"), F.lit(40)) == 0)
        listed &= {r.key for r in names.collect()}
    found = {r.host: r.m for r in U.listed_matches(urls, {"m": names}, bits).collect()}
    assert found == {k: [k] if k in listed else [] for k in keys}


def test_cascade_has_levels_for_false_positives(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where(F.crc32(F.col("key").cast("binary")) % 3 == 0)
    cascade = U.build_cascade(universe, listed)
    assert len(cascade.filters) > 2
    wrong = universe.where(cascade.contains(F.col("key")) != (F.crc32(F.col("key").cast("binary")) % 3 == 0))
    assert wrong.count() == 0


def test_empty_tables_and_lists(spark):
    pages = spark.createDataFrame([], "page_id int, url string")
    none = spark.createDataFrame([], "key string")
    assert U.judge_urls(pages, ["org/"], [], none).count() == 0
    some = spark.createDataFrame([(1, "http://a.org/")], "page_id int, url string")
    assert [tuple(r) for r in U.judge_urls(some, [], [], none).select("rule", "verdict").collect()] == [(None, "allow")]


def test_no_python_in_the_plan(spark):
    found = queries.QUERIES["op1_url_filter"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan


def test_columns_of_any_name_pass_through(spark):
    names = ["_best", "_allowed", "_blocked", "_hosts", "row", "key", "verdict", "a.b"]
    kinds = ", ".join(f"`{n}` string" for n in names)
    pages = spark.createDataFrame([(1, "http://a.org/x", *names)], f"page_id int, url string, {kinds}")
    got = U.judge_urls(pages, ["org/"], [], spark.createDataFrame([], "key string"))
    kept = [c for c in pages.columns if c != "verdict"]
    assert got.columns == [*kept, "host", "path", "rule", "verdict"]
    assert tuple(got.first()) == (1, "http://a.org/x", *(n for n in names if n != "verdict"), "a.org", "/x", "org/", "allow")
