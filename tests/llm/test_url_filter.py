import random

from quarry.llm.queries import URL_RULES
from quarry.llm.url_filter import Rule, UrlTrie, judge_urls


def brute(rules, host, path):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: r.rank, default=None)


def test_trie_equals_brute_force():
    rng = random.Random(3)
    labels, segments = ["a", "b", "ab", "org"], ["x", "y", "xy", ""]
    host = lambda: ".".join(rng.choices(labels, k=rng.randint(1, 3)))
    path = lambda: rng.choice(["", "/" + "/".join(rng.choices(segments, k=rng.randint(1, 3)))])
    rules = [Rule(rng.choice(["allow", "block"]), host(), path()) for _ in range(80)] + [Rule("block", "org", "x")]
    trie = UrlTrie(rules)
    for _ in range(3000):
        h, p = host(), path()
        want, got = brute(rules, h, p), trie.find(h, p)
        assert (want and want.rank) == (got and got.rank), (h, p)


def test_urls_and_edge_cases(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://WWW.Example.ORG/es/1?q"), (4, "http://example.org"),
            (5, "http://example.org/en/12#x"), (6, "http://x.com/de/"), (7, "http://x.com/fr/a"), (7, "http://x.com/fr/a"),
            (8, "http://notorg/es/"), (9, "x://a://b.org/c"), (None, "http://ÄB.org/\n/y")]
    df = spark.createDataFrame([(i, u, "r", "h") for i, u in rows], "page_id long, url string, rule string, host string")
    got = [tuple(r) for r in judge_urls(df, URL_RULES, keep=("page_id",)).collect()]
    assert got == [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "www.example.org", "/es/1", "example.org/es/", "block"),
        (4, "example.org", "", None, "allow"), (5, "example.org", "/en/12", "example.org/en/1", "block"),
        (6, "x.com", "/de/", "com/de/", "block"), (7, "x.com", "/fr/a", "com/fr/", "allow"),
        (7, "x.com", "/fr/a", "com/fr/", "allow"), (8, "notorg", "/es/", None, "allow"),
        (9, "a:", "//b.org/c", None, "allow"), (None, "Äb.org", "/\n/y", "org/", "allow")]
    assert judge_urls(df.limit(0), URL_RULES, keep=("page_id",)).count() == 0


def test_blocks_of_rules_agree_with_one_trie(spark):
    df = spark.createDataFrame([(i, f"http://s{i % 7}.example.org/{'en' if i % 2 else 'es'}/{i}") for i in range(50)],
                               "page_id long, url string")
    one = judge_urls(df, URL_RULES, keep=("page_id",)).collect()
    assert one == judge_urls(df, URL_RULES, keep=("page_id",), max_trie_chars=1).collect()
    assert len({r.verdict for r in one}) == 2
