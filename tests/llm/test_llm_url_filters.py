from __future__ import annotations

import re

from hypothesis import given, settings, strategies as st

from plateflow.llm.url_filters import RULES, Automaton, Rule, judge


def expected(url, rules=RULES, otherwise="allow"):
    at = -1 if url is None else url.find("://")
    rest = "" if at < 0 else url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r.name), default=None)
    return host, path, best and best.name, best.verdict if best else otherwise


URLS = [
    None, "", "no scheme", "://", "http://", "http://net/", "http://net", "http://a.net/x", "http://NET/x", "http://anet/",
    "http://www.example.net/en/1?x=/en/", "http://example.net/EN/", "http://example.com/de/a#b", "http://x.org/fr/",
    "http://evil.com/x.net/", "http://evil.com/a.example.net/en/", "http://net?/", "http://net#/", "a://b://c.net/",
    "http://.net/", "http://\u00fc.NET/\u00e4", "http://org/fr/\n?x", "http://a.net" + "/y" * 20000, "http://" + "a." * 9000 + "net/",
]


def test_verdicts(spark):
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS)] * 2, "page_id long, url string, host string")
    got = judge(df.repartition(3)).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == expected(URLS[r.page_id]), URLS[r.page_id]
    assert judge(df.limit(0)).collect() == []


def test_ties_and_default(spark):
    rules = (Rule("allow", "a.b", "/c"), Rule("block", "b", "/c/d"), Rule("allow", "b", "/c/d"))
    df = spark.createDataFrame([(1, "http://a.b/c/d"), (2, "http://b/c/d/e"), (3, "http://c/")], "page_id int, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in judge(df, rules, otherwise="block").collect()}
    assert got == {i: expected(u, rules, "block")[2:] for i, u in ((1, "http://a.b/c/d"), (2, "http://b/c/d/e"), (3, "http://c/"))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab/*.", min_size=0, max_size=9), min_size=1, max_size=40), st.lists(st.text("ab/.", max_size=12), max_size=30))
def test_automaton_against_patterns(globs, urls):
    fits = Automaton(globs).fits([u.encode() for u in urls])
    for i, glob in enumerate(globs):
        before, slash, after = glob.partition("/")
        wanted = re.compile(re.escape(before).replace(r"\*", "[^/]*") + slash + re.escape(after).replace(r"\*", ".*"), re.DOTALL)
        assert [bool(wanted.fullmatch(u)) for u in urls] == fits[:, i].tolist(), glob
