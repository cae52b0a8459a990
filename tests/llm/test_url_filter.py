import random

import pytest

from homeshift.llm import url_filter as uf


def brute(urls, rules, default="allow"):
    out = []
    for i, u in urls:
        u = u or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
        host, path = rest[:end], rest[end:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = path[: min([path.index(c) for c in "?#" if c in path] + [len(path)])]
        fits = [(len(h + p), len(h), v == "block", h + p, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits) if fits else None
        out.append((i, host, path, best[3] if best else None, best[5] if best else default))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_rules_equal_brute_force(spark, seed):
    r = random.Random(seed)
    labels = ["com", "net", "a", "b", "ab", "x,y", "c"]
    rules = list({(".".join(r.choice(labels) for _ in range(r.randint(1, 4))), r.choice(["", "/", "/e", "/en/", "/en/x"])): r.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [(i, r.choice(["http://", "HTTPS://", "", "x://"]) + ".".join(r.choice(labels).upper() if r.random() < 0.1 else r.choice(labels) for _ in range(r.randint(1, 5))) + r.choice(["", "/", "/en/", "/en/x?q=/e", "/e#/en/", "?x", "#y"])) for i in range(800)]
    urls += [(900, None), (901, ""), (902, "http://"), (903, "://a.com/en/"), (None, "http://a.com/"), (904, "http://a.com/en/"), (904, "http://a.com/en/")]
    urls += [(1000 + i, f"http://hot.a.com/en/{i}") for i in range(400)]
    df = spark.createDataFrame([(i, u, "x", 3) for i, u in urls], "page_id long, url string, host string, depth int")
    got = uf.url_verdicts(df, uf.rule_table(spark, rules))
    assert sorted([tuple(x) for x in got.collect()], key=str) == brute(urls, rules)


def test_many_path_rules_on_one_host(spark):
    """Chains of nested paths and thousands of rules on one host that most urls have; parts hand their stacks on."""
    r = random.Random(3)
    paths = {"/" + "/".join(r.choice("abc") for _ in range(r.randint(1, 7))) + r.choice(["", "/"]) for _ in range(3000)}
    rules = [("hot.com", p, r.choice(["allow", "block"])) for p in sorted(paths)] + [("com", "/a", "block"), ("hot.com", "", "block"), ("HOT.com", "/a/b", "block"), (None, "/x", "block"), ("hot.com", "a", "block"), ("hot.com", None, "allow")]
    urls = [(i, "http://" + r.choice(["", "www.", "x.y."]) + "hot.com/" + "/".join(r.choice("abcd") for _ in range(r.randint(0, 9)))) for i in range(3000)]
    urls += [(5000 + i, "http://hot.com/a/b/c") for i in range(1500)]
    df = spark.createDataFrame(urls, "page_id long, url string").repartition(5)
    known = {}
    for h, p, v in rules:
        if h and (not p or p.startswith("/")):
            known[h.lower(), p or ""] = max(v, known.get((h.lower(), p or ""), ""))  # block wins
    got = sorted([tuple(x) for x in uf.url_verdicts(df, uf.rule_table(spark, rules)).collect()], key=str)
    by_path = {}
    for (h, p), v in known.items():
        by_path.setdefault(h, {})[p] = v
    want = []
    for i, u in urls:
        host, path = u[7:].split("/", 1)
        path, fits = "/" + path, []
        for h, own in by_path.items():
            if host == h or host.endswith("." + h):
                fits += [(len(h + path[:n]), len(h), h + path[:n], own[path[:n]]) for n in range(len(path) + 1) if path[:n] in own]
        best = max(fits) if fits else (0, 0, None, "allow")
        want.append((i, host, path, best[2], best[3]))
    assert got == sorted(want, key=str)
    plan = uf.url_verdicts(df, uf.rule_table(spark, rules))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_rules_and_no_urls(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(x) for x in uf.url_verdicts(df, none, default="block").collect()] == [(1, "a.com", "/", None, "block")]
    assert uf.url_verdicts(df.where("false"), uf.rule_table(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = uf.url_verdicts(df, uf.rule_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
