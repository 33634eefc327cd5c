"""URL rules and template tree against a brute-force version on small pages."""

import re
from collections import defaultdict

import pytest

from optlake.llm import urls as U

PAGES = "page_id long, url string, html string, host int, good int, template string"


def split(url):
    m = re.match(r"^.*?://([^/?#]*)([^?#]*)", url or "", re.S)
    if not m:
        return "", ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def rule_of(host, path):
    fits = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def judge(llm, scratch, pages, labels):
    df = llm.createDataFrame([(i, u, "<p>", 1, 1, "t") for i, u in pages], PAGES)
    lab = llm.createDataFrame(labels, "id long, good int")
    return U.judge_urls(df, lab, scratch).collect()


def test_rules_and_edges(llm, scratch):
    urls = [None, "", "no scheme", "http://", "HTTP://ORG/x", "http://a.ORG/", "http://borg/x", "http://a.org", "http://x.com/de/1?q#f",
            "http://com/fr/", "http://example.org/es/1", "http://w.example.org/en/12", "http://example.org/en/2", "http://É.Com/DE/",
            "x://y://z.com/de/", "http://h.net/" + "/".join(["s"] * 3000), "http://h.net/a\nb?c", "http://x.com/de/1?q#f"]
    got = judge(llm, scratch, list(enumerate(urls)) + [(None, "http://n.com/de/")], [(0, 1)])
    assert len(got) == len(urls) + 1
    for r in got:
        url = "http://n.com/de/" if r.page_id is None else urls[r.page_id]
        host, path = split(url)
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == (verdict or "allow")
    assert judge(llm, scratch, [], []) == []


def test_purity_blocks_bad_templates(llm, scratch):
    pages, labels = [], []
    for i in range(400):
        kind = i % 4
        path = [f"news/{i}.html", f"spam/{i}", f"user{i}/profile", f"tags/{i}"][kind]
        pages.append((i, f"https://h.example.net/{path}"))
        if i % 2 or kind in (1, 3):
            labels.append((i, 0 if kind == 1 else 1))
    got = {r.page_id: r for r in judge(llm, scratch, pages, labels)}
    for i, r in got.items():
        assert r.verdict == ("block" if i % 4 == 1 else "allow"), r
    assert len({r.template for i, r in got.items() if i % 4 == 2}) == 1  # user names became one wildcard
    assert got[1].template == "/spam/{n}"


@pytest.mark.parametrize("branches", [100, 10000])
def test_bad_branch_is_blocked_on_hosts_of_any_size(llm, scratch, branches):
    """Directories at a rate of 0.9, three labelled pages each as a rule, and one of 30 bad pages."""
    typed, rows = [], []
    for d in range(branches):
        typed += [("h.net", [f"dir{d}", "{n}"], 0 if (10 * d + k) % 9 == 0 else 1) for k in range(3)]
    rows = typed + [("h.net", ["bad", "{n}"], 0)] * 30
    got = {tuple(r.typed): r for r in U.learn_templates(llm.createDataFrame(rows, "host string, typed array<string>, good int"), scratch).collect()}
    assert (got["bad", "{n}"].template, got["bad", "{n}"].allow) == ("/bad/{n}", False)
    assert {(r.template, r.allow) for k, r in got.items() if k[0] != "bad"} == {("/*/{n}", True)}


def test_deep_paths_are_told_apart(llm, scratch):
    """Good and bad branches below the sixth segment, next to one path of 300 segments."""
    pages = [(i, f"http://h.net/a/b/c/d/e/f/{'spam' if i % 2 else 'news'}/{i}") for i in range(80)] + [(99, "http://h.net/" + "/".join(["s"] * 300))]
    got = {r.page_id: r for r in judge(llm, scratch, pages, [(i, 1 - i % 2) for i in range(60)])}
    assert all(got[i].verdict == ("block" if i % 2 else "allow") for i in range(80))
    assert got[61].template == "/a/b/c/d/e/f/spam/{n}" and got[99].template == "/" + "/".join(["s"] * 300)


def brute_purity(rows):
    """Purity of (host, template) from judged rows and their labels."""
    lab, good, hl, hg = (defaultdict(float) for _ in range(4))
    for host, t, g in rows:
        if g is not None:
            lab[host, t] += 1
            good[host, t] += g
            hl[host] += 1
            hg[host] += g
    base = (sum(hg.values()) + 1) / (sum(hl.values()) + 2)
    w = U.PRIOR_WEIGHT
    return {k: (good[k] + w * (hg[k[0]] + w * base) / (hl[k[0]] + w)) / (lab[k] + w) for k in {(h, t) for h, t, _ in rows}}


def test_query_against_brute_force(llm):
    from optlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_url_templates"](llm, sf).collect()
    pages = {r.page_id: r.url for r in llm.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    good = {r.id: r.good for r in U.page_labels(llm.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert len(got) == len(pages)
    purity = brute_purity([(r.host, r.template, good.get(r.page_id)) for r in got])
    for r in got:
        host, path = split(pages[r.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert abs(r.purity - purity[r.host, r.template]) < 1e-9
        assert r.verdict == (verdict or ("allow" if r.purity >= U.MIN_PURITY else "block"))


def test_label_join(llm):
    df = llm.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, None), (3, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in U.page_labels(df).collect()) == [(1, 0), (2, 1), (3, 0)]


def test_twin_on_deep_paths_and_odd_branches(llm, scratch, tmp_path):
    """The SQL twin and the operator on hosts with paths of up to eight segments and branches of other rates."""
    import random

    import duckdb

    from oracle_check import digest
    from optlake.llm.oracles import ORACLES
    from optlake.llm.queries import QUERIES

    r = random.Random(3)
    pages, labels = [], []
    for i in range(1500):
        segs = [r.choice(["a", "b", "news", "spam", str(r.randrange(99)), "deadbeef0123", f"x{r.randrange(300)}"]) for _ in range(r.randrange(9))]
        pages.append((i, f"http://h{r.randrange(3)}.net/" + "/".join(segs), "x"))
        if r.random() < 0.7:
            labels.append((i, 0 if "spam" in segs[:2] or r.random() < 0.1 else 1, 0))
    con = duckdb.connect()
    for name, rows, schema in (("pages", pages, "page_id long, url string, html string"), ("labels", labels, "doc_id long, quality int, toxic int")):
        llm.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    df = QUERIES["op5_url_templates"](llm, str(tmp_path))
    got = [tuple(x) for x in df.collect()]
    want = con.execute(ORACLES["op5_url_templates"])
    columns = [c[0] for c in want.description]
    assert digest(df.columns, got) == digest(columns, want.fetchall())
    assert len({x[df.columns.index("template")] for x in got}) > 50


def test_long_equal_paths_cost_no_rounds(llm, scratch):
    """Two urls of 300 equal segments and a last one of their own take no more rounds than two of two segments."""
    import time

    from pyspark.sql import functions as F

    def judged(depth):
        head = "/".join(f"d{k}" for k in range(depth))
        rows = [(i, f"http://deep.net/{head}/{'spam' if i % 2 else 'news'}/{i}") for i in range(60)]
        pages = llm.createDataFrame(rows, "page_id long, url string")
        labels = llm.createDataFrame([(i, 0 if i % 2 else 1) for i in range(60)], "id long, good int")
        t0 = time.time()
        got = {r.page_id: r.verdict for r in U.judge_urls(pages, labels, scratch).collect()}
        return got, time.time() - t0

    short, s = judged(2)
    deep, t = judged(300)
    assert deep == short and short[0] == "allow" and short[1] == "block"
    assert t < s + 60
    tree = llm.createDataFrame([("h", ["a"] * 300 + [x], 5) for x in "pq"], "host string, segs array<string>, lab long")
    assert U._next_branch(tree, 0) == 300 and U._next_branch(tree, 301) is None and U._next_fan(tree, 0) is None
    assert U._next_branch(tree.withColumn("lab", F.lit(0)), 0) is None
