from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from streamlookup.functions.urls import _BLANKS, _FULL, invalid_urls, url_host, with_host
from streamlookup.sources.messages import message_rows

HOSTS = {
    "http://www.medium.com": "www.medium.com",
    "HTTP://WWW.Medium.com:8080/a": "WWW.Medium.com",
    "http://u:p@h.com/": "h.com",
    "http://a_b.com/x": "a_b.com",
    "http://[::1]:80/": "[::1]",
    "http://h.com?x=1": "h.com",
    "http://h.com#f": "h.com",
    "http://h.com/@a": "h.com",
    "  http://h.com \n": "h.com",
    "http://h.com:": "h.com",
    "http://a b.com/": "a b.com",
    "http://h.com ?x": "h.com ",
    "http://a@b@c/": "",
    "http://:80/": "",
    "http://@/x": "",
    "http:///x": "",
    "file:///x": "",
    "http:opaque": "",
    "mailto:a@b": "",
    "url:ftp://u@f.org:21?q": "f.org",
}
INVALID = ["not a url", "", None, "//h.com/x", "h.com", "ws://h.com/", "http://h.com:x/", "http://[::1", "http://[x]/"]
RFC_HOSTS = {"http://u:p@h.com/": "h.com", "http://[::1]:80/": "[::1]", "http://h.com?x=1": "h.com"}


def hosts(spark, urls, **options):
    rows = message_rows(spark, urls).select("url", url_host("url", **options).alias("host")).collect()
    return {r["url"]: r["host"] for r in rows}


def test_lenient_hosts(spark):
    assert hosts(spark, HOSTS) == HOSTS


def test_invalid_is_null_or_goes_to_dead_letters(spark):
    assert hosts(spark, INVALID, on_invalid="null") == dict.fromkeys(INVALID)
    mixed = message_rows(spark, [*HOSTS, *INVALID])
    assert {r["url"] for r in invalid_urls(mixed).collect()} == set(INVALID)
    assert {r["url"]: r["host"] for r in with_host(mixed).collect()} == HOSTS


@pytest.mark.parametrize("mode", ["lenient", "strict"])
@pytest.mark.parametrize("url", ["not a url", "", None])
def test_invalid_fails(spark, url, mode):
    with pytest.raises(Exception, match="invalid URL: " + ("NULL" if url is None else url)):
        hosts(spark, [url], mode=mode)


def test_strict_hosts(spark):
    assert hosts(spark, RFC_HOSTS, mode="strict") == RFC_HOSTS
    odd = ["http://a_b.com/x", " http://h.com", "http:///x"]
    assert hosts(spark, odd, mode="strict", on_invalid="null") == dict.fromkeys(odd)


def test_unknown_options(spark):
    with pytest.raises(ValueError):
        url_host("url", "other")
    with pytest.raises(ValueError):
        url_host("url", on_invalid="other")


def test_long_text_is_not_scanned_again_and_again(spark):
    text = "http://" + "a" * 200_000 + "@" * 3
    assert hosts(spark, [text]) == {text: ""}


def test_the_short_pattern_agrees_with_the_full_one(spark):
    parts = ["http", "HTTPS", "ftp", "file", "ws", "url:", ":", "://", "//", "/", "@", "a", "b.c", "[", "]", "::1"]
    parts += ["[::1]", "%e", "80", "?", "#", " ", "\t", "\n", "_", "é"]
    draw = random.Random(7)
    urls = {"".join(draw.choices(parts, k=draw.randint(1, 7))) for _ in range(20_000)}
    urls |= {"http://" + "".join(draw.choices(parts, k=draw.randint(1, 6))) for _ in range(20_000)}
    trimmed = F.btrim("url", F.lit(_BLANKS))
    full = F.when(trimmed.rlike(_FULL), F.regexp_extract(trimmed, _FULL, 1))
    both = message_rows(spark, urls).select("url", url_host("url", on_invalid="null").alias("host"), full.alias("full"))
    assert both.where(~F.col("host").eqNullSafe(F.col("full"))).collect() == []
    assert both.where("host != ''").count() > 1000 and both.where("host is null").count() > 1000
