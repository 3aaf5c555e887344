import random
import re
import time
from collections import defaultdict
from math import floor

from skyflow.llm import url_filter as uf


def test_rules_and_malformed_urls(spark):
    urls = {
        1: "http://Shop.Example.NET/en/1?x", 2: "https://example.net/de/", 3: "http://a.example.com/de/x#y", 4: "http://x.org/fr/1", 5: "http://org/fr/2",
        6: "http://net", 7: "http://net?q=/", 8: None, 9: "", 10: "no scheme/net/", 11: "x://y://net/", 12: "http://badexample.com/de/", 13: "http://planet/",
    }
    df = spark.createDataFrame([(i, u, "r") for i, u in urls.items()], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.filter_urls(df).collect()}
    assert got == {
        1: ("shop.example.net", "/en/1", "example.net/en/", "allow"), 2: ("example.net", "/de/", "net/", "block"), 3: ("a.example.com", "/de/x", "example.com/de/", "block"),
        4: ("x.org", "/fr/1", "org/fr/", "allow"), 5: ("org", "/fr/2", "org/fr/", "allow"), 6: ("net", "", None, "allow"), 7: ("net", "", None, "allow"), 8: ("", "", None, "allow"),
        9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("y:", "//net/", None, "allow"), 12: ("badexample.com", "/de/", None, "allow"), 13: ("planet", "/", None, "allow"),
    }
    assert uf.filter_urls(df.limit(0)).collect() == []


def test_templates_generalise_and_follow_purity(spark):
    rows = [f"http://spam.example/win/{k}" for k in range(40)] + [f"http://spam.example/blog/post-{'abcdefghijklmnop'[k]}" for k in range(16)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = uf.filter_urls(df, rules=[("block", f"spam.example/win/{k}") for k in (1, 2, 3)] + [("allow", f"spam.example/blog/post-{c}") for c in "abcdefgh"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.template, set()).add((r.rule is None, r.verdict))
    assert by["spam.example/win/*"] == {(True, "block"), (False, "block")}
    assert by["spam.example/blog/*"] == {(True, "allow"), (False, "allow")}


def test_branches_below_the_third_segment_are_told_apart(spark):
    rows = [f"http://h.example/a/b/c/{kind}/x/{k}" for kind in ("spam", "news") for k in range(40)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    rules = [("block", f"h.example/a/b/c/spam/x/{k}") for k in range(1, 10)] + [("allow", f"h.example/a/b/c/news/x/{k}") for k in range(1, 10)]
    got = {r.page_id: r for r in uf.filter_urls(df, rules=rules).collect()}
    assert {got[i].template for i in range(40)} == {"h.example/a/b/c/spam/x/*"} and {got[i].template for i in range(40, 80)} == {"h.example/a/b/c/news/x/*"}
    assert {got[i].verdict for i in range(40) if got[i].rule is None} <= {"block"} and {got[i].verdict for i in range(40, 80)} == {"allow"}
    assert got[0].rule is None


def test_similar_branches_merge_and_unlabelled_ones_follow_the_nearest_label(spark):
    rows, rules = [], []
    for name, verdict in (("cheap", "block"), ("deals", "block"), ("blog", "allow"), ("docs", "allow")):
        rows += [f"http://h.example/{name}/p/{k}" for k in range(30)]
        rules += [(verdict, f"h.example/{name}/p/{k}") for k in range(20, 30)]
    rows += ["http://h.example/other/q", "http://h.example/more", "http://bad.example/x/y/z/1", "http://bad.example/x/w/2"]
    rows += [f"http://bad.example/x/v/{k}" for k in range(20)]
    rules += [("block", f"bad.example/x/v/{k}") for k in range(20)]
    d = spark.createDataFrame([*enumerate(rows), (None, None), (3, rows[3]), (3, rows[3])], "page_id long, url string")
    got = uf.filter_urls(d, rules=rules).collect()
    of = {rows[r.page_id]: r for r in got if r.page_id is not None}
    assert len(got) == len(rows) + 3
    assert of["http://h.example/cheap/p/1"].template == of["http://h.example/deals/p/1"].template == "h.example/~1/p/*" and of["http://h.example/blog/p/1"].template == "h.example/~0/p/*"
    assert {of[f"http://h.example/{n}/p/1"].verdict for n in ("cheap", "deals")} == {"block"} and {of[f"http://h.example/{n}/p/1"].verdict for n in ("blog", "docs")} == {"allow"}
    assert of["http://h.example/other/q"].template.startswith("h.example/~/") and of["http://bad.example/x/y/z/1"].verdict == of["http://bad.example/x/w/2"].verdict == "block"


def by_levels(urls, rules):
    """(template, verdict, purity) of each URL by the definition, one level after the other."""
    rows = []
    for u in urls:
        host, _, path = u.partition("://")[2].partition("/")
        fit = max((r for r in rules if host == r[1].partition("/")[0] and ("/" + path).startswith("/" + r[1].partition("/")[2])), key=lambda r: len(r[1]), default=None)
        rows.append({"segs": [s for s in path.split("/") if s], "node": host, "prior": 0.0, "rule": fit and fit[0], "blocked": None if fit is None else int(fit[0] == "block")})
    for k in range(max(len(r["segs"]) for r in rows)):
        kids = defaultdict(list)
        for r in rows:
            if len(r["segs"]) > k:
                kids[r["node"], r["segs"][k]].append(r)
        homes = defaultdict(dict)
        for (node, seg), own in kids.items():
            homes[node][seg] = own
        for node, of in homes.items():
            count = {s: (len(v), sum(r["blocked"] is not None for r in v), sum(r["blocked"] or 0 for r in v)) for s, v in of.items()}
            pn, pl, pb = (sum(c[i] for c in count.values()) for i in range(3))
            bins = defaultdict(lambda: [0, 0, 0])
            numeral = {s: re.match(uf.NUMBER, s) is not None for s in of}
            at = {s: floor(uf.BINS * c[2] / c[1] + 0.5) for s, c in count.items() if c[1]}
            for s in at:
                if not numeral[s]:
                    bins[at[s]] = [x + y for x, y in zip(bins[at[s]], (count[s][1], count[s][2], 1))]
            branch, number, before = {}, 0, None
            for x in sorted(bins):
                if before is not None:
                    (l1, b1, _), (l0, b0, _) = bins[x], bins[before]
                    p = (b1 + b0) / (l1 + l0)
                    number += (b1 / l1 - b0 / l0) ** 2 > uf.CHI2 * p * (1 - p) * (1 / l1 + 1 / l0) + 1e-9
                branch[x], before = number, x
            size = defaultdict(int)
            for x, number in branch.items():
                size[number] += bins[x][2]
            for s, own in of.items():
                if numeral[s] or len(of) >= uf.VARIABLE_FROM and 2 * len(of) >= pn:
                    name = "*"
                elif count[s][1]:
                    name = s if size[branch[at[s]]] == 1 else f"~{branch[at[s]]}"
                else:
                    name = s if len(of) == 1 else "~"
                for r in own:
                    r["prior"] = (pb + uf.SMOOTHING * r["prior"]) / (pl + uf.SMOOTHING)
                    r["node"] = f"{node}/{name}"
    total = defaultdict(lambda: [0, 0])
    for r in rows:
        total[r["node"]][0] += r["blocked"] is not None
        total[r["node"]][1] += r["blocked"] or 0
    out = []
    for r in rows:
        labelled, blocked = total[r["node"]]
        purity = (blocked + uf.SMOOTHING * r["prior"]) / (labelled + uf.SMOOTHING)
        out.append((r["node"], r["rule"] or ("block" if purity >= uf.THRESHOLD else "allow"), round(purity, 6)))
    return out


def test_any_depth_is_as_level_by_level(spark):
    rng = random.Random(5)
    urls = []
    for _ in range(400):
        n = rng.choice((0, 1, 2, 3, 4, 6, 9))
        urls.append(f"http://h{rng.randrange(4)}.example/" + "/".join(rng.choice(("a", "b", "c", "7", "12.html", "*", f"x{rng.randrange(30)}")) for _ in range(n)))
    chain = "/".join(f"s{k}" if k % 3 else str(k) for k in range(30))
    urls += [f"http://deep.example/{chain}/{end}" for end in ("a/b", "a/c", "a", "d/e/f", "d/e/f", "")] + ["http://deep.example/s/t", *urls[:20]]
    rules = [("block", "h0.example/a"), ("allow", "h0.example/a/b"), ("block", "h1.example/"), ("allow", "h1.example/c"), ("block", "h2.example/x1"), ("block", f"deep.example/{chain}/a/b"), ("allow", f"deep.example/{chain}/d")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.template, r.verdict, r.purity) for r in uf.filter_urls(df, rules=rules).collect()}
    want = by_levels(urls, rules)
    assert len(got) == len(urls) and [got[i] for i in range(len(urls))] == want


def test_paths_of_a_thousand_segments(spark):
    long = "/".join(f"s{k}" for k in range(1000))
    urls = [f"http://h.example/{long}", f"http://h.example/{long}/x", "http://h.example/y", f"http://i.example/{long}", f"http://i.example/{long}"]
    begin = time.time()
    got = {r.page_id: r for r in uf.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules=[("block", "i.example/")]).collect()}
    assert time.time() - begin < 60
    assert got[1].template == f"h.example/~/{long.partition('/')[2]}/x" and got[0].template == got[1].template[:-2] and got[2].template == "h.example/~"
    assert got[3].template == f"i.example/{long}" and got[3].verdict == "block"
