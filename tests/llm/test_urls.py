import time
from itertools import combinations, product

from pyspark.sql import functions as F

from urbanlens.llm import urls


def by_tokens(rules, items):
    """One rule per choice of a token for each item."""
    tokens = {}
    for r in items.collect():
        tokens.setdefault(r.item, []).append(r.token)
    return {(frozenset(choice), r.verdict): r.confidence for r in rules.collect() for choice in product(*(tokens[x] for x in r["items"]))}


def pruned(data):
    """Rules over all combinations of tokens, without those that a shorter rule inside makes redundant."""
    sets = {s for _, t in data for n in range(1, len(t) + 1) for s in map(frozenset, combinations(sorted(t), n))}
    rules = {}
    for s in sets:
        n = sum(s <= t for _, t in data)
        for v in ("allow", "block"):
            both = sum(s <= t and x == v for x, t in data)
            if both >= urls.MIN_SUPPORT * len(data) and both / n >= urls.MIN_CONFIDENCE:
                rules[s, v] = both / n
    inside = lambda s: (frozenset(p) for k in range(1, len(s)) for p in combinations(sorted(s), k))
    return {k: c for k, c in rules.items() if not any(rules.get((p, k[1]), -1) >= c for p in inside(k[0]))}


def labelled(spark, rows):
    parted = urls.with_parts(pages(spark, rows).drop("host", "verdict"))
    _, verdict = urls.listed(urls.RULES)
    return parted.withColumns({"label": verdict, "tokens": urls.tokens()}).where("label is not null").select("label", "tokens")


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "x", 1, "r") for i, u in enumerate(rows)], "page_id long, url string, host string, verdict int, signature string")


def test_parts_and_listed_rules(spark):
    rows = [
        None, "", "nourl", "http://EXAMPLE.net/", "https://a.example.net/en/x?y=http://b", "x://example.com/de/", "x://notexample.com/de/",
        "http://q.org/fr/#a?b", "http://org/fr/", "http://net/?x", "http://xnet/", "http://a.example.com/DE/", "http://É.ORG#x/y", "http://a.com/" + "z/" * 50_000,
    ]
    got = urls.judge(pages(spark, rows)).orderBy("page_id").select("host", "path", "rule", "verdict").collect()
    assert [tuple(r)[:3] for r in got[:-1]] == [
        ("", "", None), ("", "", None), ("", "", None), ("example.net", "/", "net/"), ("a.example.net", "/en/x", "example.net/en/"), ("example.com", "/de/", "example.com/de/"),
        ("notexample.com", "/de/", None), ("q.org", "/fr/", "org/fr/"), ("org", "/fr/", "org/fr/"), ("net", "/", "net/"), ("xnet", "/", None), ("a.example.com", "/DE/", None), ("É.org", "", None),
    ]
    assert [r.verdict for r in got[3:6]] == ["block", "allow", "block"] and got[-1].host == "a.com"
    assert {r.verdict for r in got} <= {"allow", "block"}


def test_mined_rules_equal_brute_force(spark):
    rows = [f"http://h{i % 3}.example.{'net' if i % 2 else 'com'}/{'en' if i % 5 else 'de'}/{i}" for i in range(200)]
    # words of both labels, some of which tell more together than alone
    rows += [f"http://h{i % 4}.org/{'fr/' if i % 7 % 3 else ''}a{i % 3}/b{i % 5}/c{i % 2}/shared/path" for i in range(300)]
    rows += [f"http://h{i % 4}.net/a{i % 3}/b{i % 4}/c{i % 2}/shared/path" for i in range(150)]
    marked = labelled(spark, rows)
    words = urls.vocabulary(marked)
    data = [(r.label, frozenset(r.tokens) & set(words)) for r in marked.collect()]
    want = pruned(data)
    items = urls.merged(marked, words)
    got = by_tokens(urls.mine(marked, words), items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert max(len(s) for s, _ in want) > 1 and items.count() > items.select("item").distinct().count()


def test_votes_equal_brute_force(spark):
    rows = [f"http://h{i % 4}.{'org/fr' if i % 3 else 'net'}/a{i % 3}/b{i % 5}/two/words" for i in range(300)]
    asked = [f"http://h{i % 5}.io/a{i % 4}/b{i % 6}/{'two' if i % 2 else 'x'}/{'words' if i % 3 else 'y'}" for i in range(60)]
    marked = labelled(spark, rows)
    words = urls.vocabulary(marked)
    data = [(r.label, frozenset(r.tokens) & set(words)) for r in marked.collect()]
    rules = pruned(data)
    support = {(s, v): sum(s <= t and x == v for x, t in data) / len(data) for s, v in rules}
    got = urls.judge(pages(spark, [*rows, *asked])).where("rule is null").orderBy("page_id").select("verdict", "page_id").collect()
    sets = [set(r.tokens) for r in urls.with_parts(pages(spark, asked).drop("host", "verdict")).withColumn("tokens", urls.tokens()).orderBy("page_id").collect()]
    votes = [round(sum((1 if v == "block" else -1) * c * support[s, v] for (s, v), c in rules.items() if s <= t), 9) for t in sets]
    assert [r.verdict for r in got] == ["block" if v > 0 else "allow" for v in votes]


def test_a_long_shared_path_ends_in_seconds(spark):
    path = "/".join(f"word{i}" for i in range(40))
    rows = [f"http://h{i % 7}.{'net' if i % 3 else 'org/fr'}/{path}/{i}" for i in range(300)] + [f"http://h{i % 7}.net/{i}" for i in range(100)]
    urls.judge(pages(spark, rows[:20])).count()  # start-up is not counted
    began = time.monotonic()
    got = urls.judge(pages(spark, [*rows, f"http://q.io/{path}", "http://q.io/word3"])).orderBy("page_id").collect()
    assert time.monotonic() - began < 60 and len(got) == 402
    marked = labelled(spark, rows)
    items = urls.merged(marked, urls.vocabulary(marked))
    assert items.where("item = 'path:word0'").count() == 40


def test_unlisted_urls_follow_the_votes_and_empty_tables(spark):
    listed = [f"http://ads.example.net/fr/{i}" for i in range(60)] + [f"http://blog.example.net/en/{i}" for i in range(60)]
    got = urls.judge(pages(spark, [*listed, "http://ads.else.io/fr/1", "http://blog.else.io/en/1", "ftp://q.io/z"])).where("rule is null").orderBy("page_id").collect()
    assert [r.verdict for r in got] == ["block", "allow", "allow"]
    assert urls.judge(pages(spark, listed).where("false")).count() == 0
    none = urls.judge(pages(spark, ["http://a.io/", None])).select(F.collect_set("verdict")).first()[0]
    assert none == ["allow"]


def test_rules_use_every_token_with_support(spark):
    # 40 words that tell one label each, all equally well, so 16 of them are no better than the rest
    listed = [f"http://h.example.{'net/en' if i % 2 else 'com/de'}/w{i}x/{j}" for i in range(40) for j in range(8)]
    parted = urls.with_parts(pages(spark, listed).drop("host", "verdict"))
    _, verdict = urls.listed(urls.RULES)
    marked = parted.withColumns({"label": verdict, "tokens": urls.tokens()}).where("label is not null").select("label", "tokens")
    words = urls.vocabulary(marked)
    data = [(r.label, frozenset(r.tokens)) for r in marked.collect()]
    assert len(data) == len(listed) and set(words) == {x for _, t in data for x in t if sum(x in u for _, u in data) >= urls.MIN_SUPPORT * len(data)}
    got = by_tokens(urls.mine(marked, words), urls.merged(marked, words))
    assert got.keys() == pruned(data).keys() and {(frozenset([f"path:w{i}x"]), "allow" if i % 2 else "block") for i in range(40)} <= got.keys()
    rows = urls.judge(pages(spark, [*listed, *[f"http://q.io/w{i}x" for i in range(40)]])).where("rule is null").orderBy("page_id").collect()
    assert [r.verdict for r in rows] == ["allow" if i % 2 else "block" for i in range(40)]
