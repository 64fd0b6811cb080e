"""URL rules and link propagation against plain Python."""

import random

import pytest

from conftest import SF01
from watchtide.llm import url_trust as U


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:cut]


def rule_of(host, path):
    fits = [(len(h) + len(p), h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def plain_rank(edges, seeds, damping=0.85, rounds=200):
    total = sum(seeds.values()) or 1.0
    start = {h: m / total for h, m in seeds.items()}
    out = {}
    for a, _, n in edges:
        out[a] = out.get(a, 0) + n
    score = dict(start)
    for _ in range(rounds):
        new = {h: (1 - damping) * m for h, m in start.items()}
        for a, b, n in edges:
            if a in score:
                new[b] = new.get(b, 0) + damping * score[a] * n / out[a]
        score = new
    return score


def plain(pages):
    """page -> (host, path, rule, verdict), with links given as lists of urls."""
    judged = [(i, *split(u), *rule_of(*split(u))) for i, u, _ in pages]
    edges, good, bad = {}, {}, {}
    for (_, host, _, _, verdict), (_, _, links) in zip(judged, pages):
        if host:
            seeds = {"allow": good, "block": bad}.get(verdict)
            if seeds is not None:
                seeds[host] = seeds.get(host, 0) + 1
        for link in links:
            dst = split(link)[0]
            if host and dst and dst != host:
                edges[host, dst] = edges.get((host, dst), 0) + 1
    trust = plain_rank([(a, b, n) for (a, b), n in edges.items()], good)
    distrust = plain_rank([(b, a, n) for (a, b), n in edges.items()], bad)
    return sorted((i, h, p, r, v or ("block" if distrust.get(h, 0) > trust.get(h, 0) else "allow")) for i, h, p, r, v in judged)


def result(spark, pages):
    html = lambda links: "<p>x</p>" + "".join(f'<A class="c" HREF="{u}">t</A> <a href="/local">l</a>' for u in links)
    df = spark.createDataFrame([(i, u, html(links), "clash") for i, u, links in pages], "page_id long, url string, html string, host string")
    return sorted(tuple(r)[:5] for r in U.op9_filter(df).collect())


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    rows = [(r.page_id, r.url, []) for r in pages.collect()]
    assert sorted(tuple(r)[:5] for r in U.op9_filter(pages).collect()) == plain(rows)


def test_random_link_graph(spark):
    rng = random.Random(2)
    hosts = ["www.example.com", "a.example.com", "b.com", "c.net", "d.net", "e.org", "f.org", "g.org", "h.info"]
    pages = [(i, f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'x'])}/{i}?q#f",
              [f"https://{rng.choice(hosts)}/p{rng.randrange(3)}" for _ in range(rng.randrange(5))]) for i in range(80)]
    want = plain(pages)
    assert result(spark, pages) == want and {v for *_, v in want} == {"allow", "block"}


def test_distrust_runs_against_the_links_and_trust_along(spark):
    pages = [(1, "http://bad.net/es/", []), (2, "http://farm.org/x", ["http://bad.net/q"]), (3, "http://good.com/", ["http://friend.org/"]),
             (4, "http://friend.org/a", []), (5, "http://linked.org/", [])]
    assert {r[0]: r[4] for r in result(spark, pages)} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


@pytest.mark.parametrize("url, host, path, rule", [
    ("HTTP://WWW.Example.COM/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/"), ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/"),
    ("https://example.com/En/", "example.com", "/En/", "com/"), ("http://notexample.com/en/", "notexample.com", "/en/", "com/"), ("http://a.com", "a.com", "", None),
    ("http://a.com?x=/en/", "a.com", "", None), ("x://net/es/1", "net", "/es/1", "net/es/"), ("http://a.com:80/", "a.com:80", "/", None), ("nothing", "", "", None),
    (None, "", "", None), ("http:///es/", "", "/es/", None), ("a://b.net/fr/://c.com/", "b.net", "/fr/://c.com/", "net/fr/"), ("http://ÀB.net/es/\nq", "Àb.net", "/es/\nq", "net/es/")])
def test_hosts_paths_and_rules(spark, url, host, path, rule):
    [r] = U.op9_filter(spark.createDataFrame([(1, url, None)], "page_id long, url string, html string")).collect()
    assert (r.host, r.path, r.rule) == (host, path, rule)


def test_distrust_reaches_a_long_chain_of_hosts(spark):
    """Thirty hosts, each linking to the next without naming a scheme; only the last is known to be bad."""
    chain = [f"h{i}.org" for i in range(30)]
    pages = [(i, f"http://{h}/", [f"//{n}/x"]) for i, (h, n) in enumerate(zip(chain, [*chain[1:], "bad.net"]))]
    pages += [(100, "http://bad.net/fr/", []), (101, "http://apart.org/", ["/local", "https:/no", "mailto:a@b.net"])]
    got = {r[0]: r[4] for r in result(spark, pages)}
    assert got == {i: "block" for i in range(30)} | {100: "block", 101: "allow"}


def test_empty_table(spark):
    assert U.op9_filter(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
