import itertools
import math

from lodestar.llm.urlfilter import Lexicon, judge_urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:end], rest[end:]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/123", "http://x.com/fr/2?q=://", "http://y.com/de/#f", "http://org/", "http://org", "ftp://z.net/a/b#c?d",
        None, "", "no scheme", "://h.org/x", "http://notexample.org/es/", "http://q.net?x=/y", "http://É.COM/fr/", "http://h.com:80/fr/", "http://b.com/fr", "a://b://c.org/x"]


def test_parts_and_rules(spark):
    rows = [(i, u, None, "x") for i, u in enumerate(URLS)] + [(None, "http://a.org/b", "", "x"), (3, "http://y.com/de/#f", None, "x")]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        urls = [x[1] for x in rows if x[0] == r["page_id"]]
        assert (r["host"], r["path"]) == split_url(urls[0])
        rule, verdict = rule_of(r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] in ("allow", "block") and (verdict is None or r["verdict"] == verdict)


def test_bayes_on_segmented_hosts(spark):
    """Blocked urls share words that only show once the hosts are split."""
    good, bad = ["garden", "river", "museum", "music"], ["cheap", "pills", "casino", "bets"]
    title = "<title>garden river museum music cheap pills casino bets news the and</title>"
    rows, n = [], 0
    for a, b in itertools.permutations(good, 2):
        rows += [(n := n + 1, f"http://{a}{b}.com/fr/x", title)]
    for a, b in itertools.permutations(bad, 2):
        rows += [(n := n + 1, f"http://{a}{b}.com/de/x", title)]
    new = [("http://cheapcasino.net/", "block"), ("http://rivermuseum.net/", "allow"), ("http://betspills.net/", "block"), ("http://musicgarden.net/", "allow")]
    rows += [(1000 + i, u, title) for i, (u, _) in enumerate(new)]
    got = {r["page_id"]: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, (_, verdict) in enumerate(new):
        assert got[1000 + i]["verdict"] == verdict and got[1000 + i]["rule"] is None
    assert got[1000]["words"].split() == ["h:cheap", "h:casino", "h:net"]


def test_split_is_the_cheapest():
    lexicon = Lexicon({"a": 3, "ab": 5, "abc": 1, "bc": 9, "c": 2, "ca": 4})

    def cost(words):
        total, unknown = 0.0, False
        for w in words:
            if w in lexicon.cost:
                total, unknown = total + lexicon.cost[w], False
            else:
                total, unknown = total + (0 if unknown else lexicon.unknown) + 2.0 * len(w), True
        return total

    for run in map("".join, itertools.product("abcx", repeat=5)):
        best = min(cost([run[i:j] for i, j in zip((0, *c), (*c, 5))]) for n in range(5) for c in itertools.combinations(range(1, 5), n))
        assert math.isclose(cost(lexicon.split(run)), best), run


def test_empty(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_long_word_lists_are_whole(spark):
    """Rare words split hosts, however many other words there are; splits are those of one list of all words."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = ["zq" + "".join(w) for w in itertools.islice(itertools.product(letters, repeat=4), 60_000)]
    rows = [(i, "http://a.org/", f"<title>{' '.join(many[i * 1000:(i + 1) * 1000])}</title>") for i in range(60)]
    rows += [(100, "http://quartzlantern.net/", "<title>quartz lantern</title>"), (101, "http://x.com/de/oddquartz", "")]
    got = {r["page_id"]: r["words"] for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[100].split() == ["h:quartz", "h:lantern", "h:net"]
    counts = {w: 1 for w in [*many, "quartz", "lantern", "oddquartz", "de"]}
    assert got[101].split() == ["h:x", "h:com", "p:de", *(f"p:{w}" for w in Lexicon(counts).split("oddquartz"))]


def test_join_equals_one_list(spark):
    import random

    from lodestar.llm.urlfilter import segment
    r = random.Random(3)
    counts = {"".join(r.choice("abcé") for _ in range(r.randint(2, 5))): r.randint(1, 40) for _ in range(60)}
    runs = {"".join(r.choice("abcéx") for _ in range(r.randint(1, 40))) for _ in range(300)} | {"x" * 60, "ab" * 200}
    table = spark.createDataFrame(list(counts.items()), "w string, n long")
    got = {x["run"]: x["words"] for x in segment(spark.createDataFrame([(x,) for x in runs], "run string"), table).collect()}
    whole = Lexicon(counts)
    assert {x: got.get(x, [x]) for x in runs} == {x: whole.split(x) for x in runs}
