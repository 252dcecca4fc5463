import random
import re

import pytest

from wattledger.llm import urls
from wattledger.llm.urls import ALLOW, BLOCK, Rule


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def brute(url, rules):
    host, path = split(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(str(r)), -len(r.host), str(r)), default=None)
    return host, path, str(best) if best else None, best.verdict if best else "allow"


URLS = [None, "", "no scheme", "http://", "http://a.com", "http://a.com/", "http://com/", "http://xcom/", "https://WWW.Example.COM/en/x?y#z",
        "http://example.com/en/", "http://m.example.com/en/1", "http://www.example.com/en/", "http://aexample.com/en/", "http://a.net/es/",
        "http://net/fr/q", "http://net/frx", "http://a.org/x.com/en/", "http://a.net?x=/es/", "x://y://z.com/", "http://é.net/es/é",
        "ftp://a.com#/", "http://a.com\n/x", "http://.com/", "http://a.b.c.d.example.com/en/" + "x" * 9000]


def test_contract_rules(spark):
    df = spark.createDataFrame([(i, u, "q") for i, u in enumerate(URLS)] + [(None, URLS[5], None), (5, URLS[5], "q")],
                               "page_id long, url string, verdict string")
    got = sorted(map(repr, (tuple(r) for r in urls.judge(df).collect())))
    assert got == sorted(repr((r["page_id"], *brute(r["url"], urls.RULES))) for r in df.collect())
    assert urls.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_many_rules_over_several_words(spark, seed):
    draw = random.Random(seed)
    rules = tuple({str(r): r for r in (Rule(".".join(draw.choices("ab", k=draw.randrange(1, 4))), "/" + "".join(draw.choices("ab/", k=draw.randrange(5))),
                                            draw.choice([ALLOW, BLOCK])) for _ in range(40))}.values())
    machine = urls.Automaton(rules)
    assert machine.words > 2
    given = ["http://" + "".join(draw.choices("ab.", k=draw.randrange(8))) + "/" + "".join(draw.choices("ab/", k=draw.randrange(9))) for _ in range(500)]
    found = machine.run([("".join(split(u))).encode() for u in given])
    for u, i in zip(given, found.tolist()):
        assert (str(machine.rules[i]) if i >= 0 else None) == brute(u, rules)[2]


def test_wildcards():
    machine = urls.Automaton((Rule("a*.com", "/*/x?", BLOCK),))
    for text, hit in (("abc.com/q/xy", True), ("a.com//xz-more", True), ("abc.com/q/x", False), ("b.com/q/xy", False),
                      ("a/b.com/q/xy", False), ("sub.a1.com/1/2/xx", True)):
        assert bool(machine.run([text.encode()])[0] == 0) is hit, text


def test_no_rules():
    assert urls.Automaton(()).run([b"a", b""]).tolist() == [-1, -1]
