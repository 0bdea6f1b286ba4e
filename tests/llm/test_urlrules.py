import random
import re

import duckdb
import pytest
from flowstrata.llm.urlrules import (PATTERN_RULES, PatternRule, judge_urls, literal_tokens, match_urls, oracle_sql, regex_of,
                                     rule_index)

ODD = [None, "", "://", "no scheme", "HTTP://WWW.Example.ORG/es/1", "http://example.org", "http://example.org/es/",
       "https://sub.example.org/en/12?x#y", "http://notexample.org/en/1", "http://a.com/fr/", "http://a.com/de/x",
       "http://x.net/?a=/de/", "http://spam.example.net", "http://a.b/spam", "javascript:alert(1)", "x://java.script/javascript:1",
       "http://pornhub.tube.net/x", "http://adult-education.net", "http://www.adult-x.net", "http://a.net/online/casino/",
       "http://a.net/online-casino", "http://a.net/wp-login.php?x", "http://É.net/é\nspam", "http://casino", "http://casinox.net"]


def brute(url):
    low = (url or "").lower()
    hit = [r for r in sorted(PATTERN_RULES, key=lambda r: r.action != "allow") if re.search(regex_of(r), low, re.DOTALL)]
    return hit[0].pattern if hit else None


def random_urls(n):
    rng = random.Random(9)
    words = ["spam", "farm", "casino", "x", "adult", "education", "free", "bets", "porn", "tube", "online", "wp", "login", "php"]
    return ["http" + "s" * rng.randint(0, 1) + "://" + "".join(rng.choice(words) + rng.choice(["-", ".", "/", "?", "#", "", "_"])
            for _ in range(rng.randint(1, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def pages(spark):
    urls = ODD + random_urls(400)
    return spark.createDataFrame([(i, u, "host", "t") for i, u in enumerate(urls + urls[:3])],
                                 "page_id long, url string, host string, token string")


def test_index_finds_what_all_rules_find(pages):
    for r in match_urls(pages, "hit").collect():
        assert r["hit"]["pattern"] == brute(r["url"])


def test_queries_agree_with_sql(pages):
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url").toPandas())
    cols = ("page_id", "host", "path", "rule", "verdict", "pattern")
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({oracle_sql()}) q").fetchall(), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in judge_urls(pages).collect()), key=str) == want


def test_contract_rules(pages):
    got = {r["url"]: r for r in judge_urls(pages).join(pages.select("page_id", "url"), "page_id").collect()}
    assert (got["HTTP://WWW.Example.ORG/es/1"]["host"], got["HTTP://WWW.Example.ORG/es/1"]["rule"]) == ("www.example.org", "example.org/es/")
    assert got["http://example.org"]["rule"] is None and got["http://notexample.org/en/1"]["rule"] == "org/"
    assert got["https://sub.example.org/en/12?x#y"]["verdict"] == "block"
    assert got["http://a.com/de/x"]["rule"] == "com/de/" and got["http://x.net/?a=/de/"]["rule"] is None
    assert got[None]["host"] == "" and got[None]["verdict"] == "allow"


def test_rarest_token():
    rules = [PatternRule("block", "host", "^big^small^"), PatternRule("block", "url", "part*of^"), PatternRule("block", "url", "*")]
    assert literal_tokens(rules[0]) == ["big", "small"] and literal_tokens(rules[1]) == []
    assert rule_index(rules, {"big": 100, "small": 2}) == {"small": [0], "": [1, 2]}


def test_empty(pages):
    assert judge_urls(pages.where("false")).count() == 0
    assert {r["pattern"] for r in judge_urls(pages, pattern_rules=()).collect()} == {None}


def test_null_ids_and_very_long_urls(spark):
    long_url = "http://a.net/" + "x/" * 200_000 + "online/casino/?q=" + "y" * 100_000
    rows = [(None, "http://pornhub.tube.net/x"), (None, None), (1, long_url), (1, long_url), (2, "http://" + "sub." * 50_000 + "example.org/es/1")]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(got) == 5 and sum(r["page_id"] is None for r in got) == 2
    assert {r["rule"] for r in got if r["page_id"] == 2} == {"example.org/es/"}
    assert {(len(r["path"]), r["pattern"]) for r in got if r["page_id"] == 1} == {(len(long_url.split("?")[0]) - len("http://a.net"), brute(long_url))}
