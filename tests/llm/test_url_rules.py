from itertools import combinations

import pytest

from privlink.llm import queries, url_rules

from .conftest import SF

RULES = queries.URL_RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return host.translate({c: c + 32 for c in range(65, 91)}), rest[:stop]


def explicit(host, path):
    fits = [(h, p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(((-len(h + p), h + p, v) for h, p, v in fits), default=(0, None, None))[1:]


def tokens(host, path):
    labels, segments = [x for x in host.split(".") if x], [x for x in path.split("/") if x]
    site = ["s:" + ".".join(labels[-2:])] if len(labels) > 1 else []
    return frozenset([*("h:" + x for x in labels), *site, *("p:" + x for x in segments)])


def brute(urls, default="allow", support=url_rules.MIN_SUPPORT, confidence=url_rules.MIN_CONFIDENCE):
    """Verdicts by counting every token combination of the labelled urls."""
    seen = [(u, *parts(u)) for u in urls]
    labelled = [(tokens(h, p), explicit(h, p)[1]) for _, h, p in seen if explicit(h, p)[1]]
    labelled = [x for x in labelled if x[0]]
    all_, with_ = {}, {}
    for t, v in labelled:
        for n in range(1, len(t) + 1):
            for c in combinations(sorted(t), n):
                all_[c] = all_.get(c, 0) + 1
                with_[c, v] = with_.get((c, v), 0) + 1
    least = -(-support * len(labelled) // 1)
    rules = [(c, v, n / all_[c], n / len(labelled)) for (c, v), n in with_.items() if n >= least and n / all_[c] >= confidence]
    kept = [r for r in rules if not any(set(o[0]) < set(r[0]) and o[1] == r[1] and o[2] >= r[2] for o in rules)]
    out = []
    for _, h, p in seen:
        rule, verdict = explicit(h, p)
        if rule is None:
            fired = [(r[2], r[3], len(r[0]), " ".join(r[0]), r[1]) for r in kept if set(r[0]) <= tokens(h, p)]
            verdict = max(fired)[4] if fired else default
        out.append((h, p, rule, verdict))
    return out


URLS = [
    "http://a.net/x", "HTTP://A.B.NET/", "https://www.example.net/en/1", "https://example.net/en", "http://x.example.com/de/5?q=1", "http://y.org/fr/9#f", "http://y.org/en/9", "http://net/", "http://net", "http://xnet/", "http://.net/a",
    "ftp://user:pw@host.net:80/en/", "no scheme", "://", "http:///path", "http://a.com?x=://b.net/", "http://a'b\\.com/en/1", "http://é.net/ü", None, "", "http://z.example.com/en/2", "http://z.example.com/de", "http://a.net/x\n://", "x://y://z.net/",
] + [f"http://w{i}.example.{t}/{p}/{i}" for i in range(30) for t, p in (("net", "en"), ("net", "de"), ("com", "de"), ("com", "fr"), ("org", "fr"), ("org", "de"))]


def got(frame):
    return sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in frame.collect())


def frame_of(spark, urls):
    return spark.createDataFrame([(k, u, "h", "p", "n") for k, u in enumerate(urls)], "page_id long, url string, host string, path string, n string")


def test_equals_brute_force(spark):
    urls = URLS + URLS[:3]  # repeated urls
    want = sorted((str(k), h, p, str(r), v) for k, (h, p, r, v) in enumerate(brute(urls)))
    assert got(url_rules.judge_urls(frame_of(spark, urls), RULES)) == want
    assert {v for *_, r, v in want if r == "None"} == {"allow", "block"}  # the mined rules have a say


@pytest.mark.parametrize("rules", [RULES, []])
def test_nothing_to_learn_from(spark, rules):
    urls = ["http://a.com/x", None]
    assert [x[3:] for x in got(url_rules.judge_urls(frame_of(spark, urls), rules, default="block"))] == [("None", "block")] * 2


def test_empty_table_and_repeated_ids(spark):
    assert url_rules.judge_urls(frame_of(spark, []), RULES).collect() == []
    twice = frame_of(spark, URLS[:2]).union(frame_of(spark, URLS[:2]))
    assert len(got(url_rules.judge_urls(twice, RULES))) == 4


def test_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    want = sorted((str(p.page_id), h, q, str(r), v) for p, (h, q, r, v) in zip(pages, brute([p.url for p in pages]), strict=True))
    assert got(queries.QUERIES["op9_url_rules"](spark, SF)) == want


def segments(k, n):
    return "/".join(f"s{k}x{i}" for i in range(n))


def test_deep_urls_and_long_hosts(spark):
    """A labelled url of 40 segments that a third of the labelled rows share, and a host of 100,000 labels."""
    deep = f"http://a.net/{segments(0, 40)}"
    urls = [deep] * 20 + [f"http://w{i}.example.net/en/{segments(0, 5)}" for i in range(20)] + [f"http://q.com/{segments(0, 3)}/x", f"http://q.com/{segments(0, 40)}", "http://" + "b." * 100_000 + "com/z", "http://" + "c." * 100_000 + "net/z"]
    rows = got(url_rules.judge_urls(frame_of(spark, urls), RULES))
    by_id = {int(r[0]): r for r in rows}
    assert len(rows) == len(urls) and by_id[0][3:] == ("net/", "block") and by_id[20][3:] == ("example.net/en/", "allow")
    assert by_id[len(urls) - 1][3:] == ("net/", "block") and by_id[len(urls) - 2][3] == "None"
    assert by_id[41][4] == "block"  # the deep url's own segments say so


def test_hot_url(spark):
    urls = spark.range(200_000).selectExpr("id AS page_id", "if(id % 3 = 0, 'http://hot.net/a/b/c', concat('http://h', id % 500, '.org/', if(id % 2 = 0, 'fr', 'en'), '/', id % 11)) AS url")
    rows = url_rules.judge_urls(urls, RULES).groupBy("verdict", "rule").count().collect()
    assert sum(r["count"] for r in rows) == 200_000 and {r["rule"] for r in rows} == {"net/", "org/fr/", None}


def test_copies_weigh_as_rows(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "COPIES", 4)
    urls = URLS + ["http://w1.example.net/de/1"] * 23 + ["http://w2.example.org/fr/2"] * 8
    want = sorted((str(k), h, p, str(r), v) for k, (h, p, r, v) in enumerate(brute(urls)))
    assert got(url_rules.judge_urls(frame_of(spark, urls), RULES)) == want


def test_tokens_of_the_same_rows_are_one_item(spark):
    kinds = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["d", "c"]), (4, ["d"])], "kind long, tokens array<string>")
    assert {r["token"]: r["item"] for r in url_rules.token_items(kinds).collect()} == {"a": "a", "b": "a", "c": "c", "d": "d"}


def test_no_python_worker(spark, monkeypatch):
    """Every table that the operator writes, and its result, come from native plans."""
    plans, write = [], url_rules.materialise
    monkeypatch.setattr(url_rules, "materialise", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, name))
    plans.append(url_rules.judge_urls(frame_of(spark, URLS), RULES)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and not any(word in p for p in plans for word in ("Python", "Arrow", "Pandas"))
