from pyspark.sql import functions as F

from quarry.llm import queries as Q
from quarry.llm import url_filter as uf

RULES = Q.SITE_RULES + [uf.word_rule(w, "block") for w in uf.BLOCKED_HOST_WORDS]
URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?q#f", "http://example.net/EN/x", "http://xexample.net/en/1",
        "http://example.net/en", "http://example.com/de/1", "http://b.example.com/dex/", "http://b.example.org/fr/9",
        "http://org/fr/", "http://net", "http://net/", "http://spam-farm.example.org/en/", "http://spammer.example.org/",
        "http://x.org?u=http://example.net/en/", "http://example.com#/de/", "http://ÄX.net/", "a://b://c/d", "http://a.net:80/x",
        "http://" + "l." * 20000 + "net/", "http://exa\nmple.net/en/", "http://casino"]


def brute(url):
    host, path = uf.split_url(url)
    hits = [(r.rank, r.name, r.verdict) for r in Q.SITE_RULES
            if path.startswith("/" + r.name.partition("/")[2])
            and (host == r.name.partition("/")[0] or host.endswith("." + r.name.partition("/")[0]))]
    if hits:
        return host, path, max(hits)[1], max(hits)[2]
    words = set(host.replace("-", ".").split("."))
    return host, path, None, "block" if words & set(uf.BLOCKED_HOST_WORDS) else "allow"


def test_matches_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[4]), (4, URLS[4])], "page_id long, url string")
    pages = pages.withColumn("host", F.lit("clash")).withColumn("rule", F.lit(None).cast("string"))
    rows = uf.judge_urls(pages, RULES).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = URLS[4] if r.page_id is None else URLS[r.page_id]
        name = r.matched_rule if r.matched_rule in {x.name for x in Q.SITE_RULES} else None
        assert (r.host, r.path, name, r.verdict) == brute(url), url


def test_rarest_token_and_always_rules():
    index, always = uf.build_index(RULES, {"net": 9, "example": 5, "en": 2, "com": 4, "de": 4, "org": 3, "fr": 3})
    assert index["en"] == [1] and index["net"] == [0] and not always
    assert uf.build_index([uf.Rule("any", "block", ".*", (), 0)], {}) == ({}, [0])
    assert uf.candidates("a.example.net", "/en/", index, always) == [0, 1]


def test_few_expressions_run_and_empty_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert uf.judge_urls(pages, RULES).agg(F.max("n_tried")).first()[0] < 6
    assert uf.judge_urls(pages.limit(0), RULES).count() == 0
