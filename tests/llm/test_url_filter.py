import math
import os
import random
import re

import pytest

from helixframe.llm import queries, url_filter


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    path = rest[cut:]
    stop = min((i for c in "?#" if (i := path.find(c)) >= 0), default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:stop]


def ruled(host, path):
    fits = [(h, p, v) for h, p, v in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def test_contract_on_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.page_id: r for r in queries.op8_url_filter(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()
    assert len(rows) == len(pages)
    for p in pages:
        r = rows[p.page_id]
        assert (r.host, r.path) == parts(p.url)
        rule = ruled(r.host, r.path)
        assert r.rule == (rule and rule[0] + rule[1]) and r.verdict in ("block", "allow")
        assert not rule or r.verdict == rule[2]


@pytest.mark.parametrize("urls", [[None, "", "no scheme", "http://", "://A.Com/en/7?x", "http://COM/en/#", "ftp://xcom/en/1", "http://a.example.com/en/71", "http://k.net?a/b", "http://k.net#a/b", "http://é.NET/de/8/a//b", "a://b://c/d", "http://x.org/" + "s/" * 3000] * 2, []])
def test_odd_urls(spark, urls):
    pages = spark.createDataFrame([(i, u, "v", "h") for i, u in enumerate(urls)], "page_id long, url string, verdict string, host string")
    rows = {r.page_id: r for r in url_filter.judge(pages, queries.RULES).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        assert (rows[i].host, rows[i].path) == parts(u)
        rule = ruled(*parts(u))
        assert rows[i].rule == (rule and rule[0] + rule[1])


def plain_tree(urls, rules):
    """The tree by recursion over the different paths of a host: {(host, path): (template, purity)}."""
    prior, out, hosts = url_filter.PRIOR, {}, {}
    for host, path in {parts(u) for u in urls}:
        if host:
            shapes = [re.sub("^[0-9a-f]{16,}$", "{x}", s) if re.fullmatch("[0-9a-f]{16,}", s) else re.sub("[0-9]+", "{n}", s) for s in path[1:].split("/")]
            hosts.setdefault(host, []).append((path, shapes, (ruled(host, path) or (0, 0, None))[2]))

    def drawn(ways, parent):
        says = [v for _, _, v in ways if v]
        return (says.count("block") + prior * parent) / (len(says) + prior) if says else parent

    def grow(host, ways, at, node, purity):
        if len({v for _, _, v in ways if v}) < 2 or all(len(s) <= at for _, s, _ in ways):
            for path, s, _ in ways:
                out[host, path] = (node + ("/{rest}" if at < len(s) else ""), purity)
            return
        for path, s, _ in [w for w in ways if len(w[1]) <= at]:
            out[host, path] = (node, purity)
        ways = [w for w in ways if len(w[1]) > at]
        common = os.path.commonprefix([s[at:] for _, s, _ in ways])
        node += "".join("/" + x for x in common)
        at += len(common)
        children = {}
        for w in ways:
            children.setdefault(w[1][at] if len(w[1]) > at else None, []).append(w)
        whole = [v for _, _, v in ways if v]
        share = whole.count("block") / len(whole)
        examined, groups = sum(any(v for _, _, v in c) for c in children.values()), {}
        for segment, c in children.items():
            says = [v for _, _, v in c if v]
            near = says and abs(says.count("block") / len(says) - share) <= url_filter.Z * math.sqrt(share * (1 - share) / len(says))
            name = "" if segment is None else "/{any}" if len(c) == 1 else "/{alike}" if near and examined > 1 else "/" + segment
            groups.setdefault(name, []).extend(c)
        for name, c in groups.items():
            grow(host, c, at + 1, node + name, drawn(c, purity))

    for host, ways in hosts.items():
        if any(v for _, _, v in ways):
            grow(host, ways, 0, "", drawn(ways, 0.5))
    return out


def check_against_plain_tree(spark, urls):
    want = plain_tree(urls, queries.RULES)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {r.page_id: r for r in url_filter.judge(pages, queries.RULES).collect()}
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        host, path = parts(url)
        template, purity = want.get((host, path), ("/{rest}", None))
        assert rows[i].template == template, (url, rows[i])
        assert (rows[i].purity is None) == (purity is None) and (purity is None or abs(rows[i].purity - purity) < 1e-12)
        rule = ruled(host, path)
        assert rows[i].verdict == (rule[2] if rule else "block" if purity is not None and purity >= url_filter.REJECT else "allow")
    return rows


def test_tree_against_recursion(spark):
    rnd = random.Random(8)
    urls = []
    for _ in range(1500):
        host = rnd.choice(["a.example.com", "b.example.com", "c.com", "d.example.net", "e.net", "f.org", "g.example.org", "plain.info"])
        deep = "/".join(rnd.choice(["x", "y", "z1", "page", str(rnd.randrange(99)), "deadbeef01234567"]) for _ in range(rnd.randrange(4)))
        urls.append(f"http://{host}/{rnd.choice(['en', 'de', 'es', 'fr', 'en/7', 'de/8', 'e', ''])}{rnd.choice(['/', ''])}{rnd.choice([str(rnd.randrange(900)), 'slug%d' % rnd.randrange(10**6), 'about'])}/{deep}")
    rows = check_against_plain_tree(spark, urls + urls[:50])
    assert {r.verdict for r in rows.values() if r.rule is None} == {"allow", "block"}
    assert max(r.template.count("/") for r in rows.values()) > 4


def test_deep_ways_with_one_branching(spark):
    stem = "http://k.example.com/en/" + "/".join(["s"] * 40)
    check_against_plain_tree(spark, [f"http://k.example.com/en/7/{i}" for i in range(5)] + [f"http://k.example.com/en/6/{i}" for i in range(5)] + [f"{stem}/{i}" for i in range(4)])


def test_unruled_urls_by_their_hosts_purity(spark):
    urls = [f"http://s.com/en/{i}" for i in range(40)] + ["http://s.com/fr/1", "http://other.com/fr/1"]
    urls += [f"http://t.net/de/{i}" for i in range(30)] + ["http://t.net/fr/1", "http://few.com/en/1", "http://few.com/fr/2"]
    rows = check_against_plain_tree(spark, urls)
    verdict = {u: rows[i].verdict for i, u in enumerate(urls) if rows[i].rule is None}
    assert verdict == {"http://s.com/fr/1": "block", "http://other.com/fr/1": "allow", "http://t.net/fr/1": "allow", "http://few.com/fr/2": "allow"}


def test_on_the_tables_both_verdicts_come_from_the_tree(spark):
    rows = queries.op8_url_filter(spark, "/root/testdata/sf0.01").filter("rule IS NULL AND host <> ''").collect()
    assert {r.verdict for r in rows} == {"allow", "block"}
