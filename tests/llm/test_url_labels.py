"""Verdicts of url templates without labels of their own."""

from tradewind.llm import url_filters


def test_unlabelled_templates_follow_siblings_and_parents(spark):
    rules = (("block", "spam.net", "/ads/1"), ("block", "bad.net", "/a/"), ("allow", "good.net", "/a/"))
    urls = [f"http://spam.net/{kind}/{n}" for kind in ("ads", "win") for n in range(100, 200)]
    urls += [f"http://{host}/{kind}" for host in ("bad.net", "good.net") for kind in [f"a/{n}" for n in range(90)] + ["once/b/c/d/e/f"]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {urls[r["page_id"]]: (r["template"], r["verdict"]) for r in url_filters.judged(pages, rules).collect()}
    assert got["http://spam.net/win/150"] == ("/ads/*", "block")
    assert got["http://bad.net/once/b/c/d/e/f"] == ("/*/*/*/*/*/*", "block") and got["http://good.net/once/b/c/d/e/f"][1] == "allow"


def test_long_paths_take_few_rounds(spark, monkeypatch):
    """Paths of a thousand segments, alone, repeated, and sharing all but the last segment; rounds follow the forks."""
    long = "/".join(f"s{i}" for i in range(1000))
    urls = [f"http://a.net/{long}"] * 5 + [f"http://b.net/{long}/{n}" for n in range(4)] + ["http://c.net/" + "x/" * 999] + ["http://d.net/a/b"] * 3
    rounds, level = [], url_filters._level
    monkeypatch.setattr(url_filters, "_level", lambda paths: (rounds.append(1), level(paths))[1])
    rows = url_filters.judged(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    got = {urls[r["page_id"]]: r["template"] for r in rows}
    assert len(rows) == len(urls) and len(rounds) <= 2
    assert got[urls[0]] == "/" + long and got["http://d.net/a/b"] == "/a/b"
    assert got["http://c.net/" + "x/" * 999] == "/*" * 1000
    assert all(got[f"http://b.net/{long}/{n}"] == f"/{long}/*" for n in range(4))
