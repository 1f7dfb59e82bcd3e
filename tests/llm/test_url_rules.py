import random
import re

from tierlake.llm import url_rules as u


def plain(url, rules):
    """Brute force: every rule runs."""
    host, path = u.host_of(url)
    fits = [r for r in rules if r.site and (host == (h := r.name.partition("/")[0]) or host.endswith("." + h))
            and path.startswith("/" + r.name.partition("/")[2])]
    if fits and host:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    import re
    low = (host + path).lower()
    bad = host and any(re.search(r.pattern, low) for r in rules if not r.site)
    return host, path, None, "block" if bad else "allow"


URLS = ["http://A.Example.NET/en/x?q#f", "https://example.net/de/", "example.net/en/", None, "", "x://", "http://net/",
        "http://net", "http://x.org/fr/", "http://x.org/fr", "http://x.org/FR/", "http://example.com/de/1", "ftp://notexample.net/en/",
        "http://cheap-pills.example.org/", "http://a.org/casino-win", "http://a.org/xcasino-win", "http://a.org?casino-win",
        "http://user@net:80/", "http://x.net\n/en/", "http://ä.org/fr/é", "a://b://net/", "http://example.net/en/" + "a" * 50_000,
        "http://Adult-X.example.org/"]


def test_against_brute_force(spark):
    rules = u.SITE_RULES + u.PATTERN_RULES
    rows = spark.createDataFrame([(i, url, "h", "r") for i, url in enumerate(URLS)],
                                 "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in u.filter_urls(rows, rules).collect()}
    assert got == {i: plain(url, rules) for i, url in enumerate(URLS)}
    assert u.filter_urls(rows.limit(0), rules).count() == 0


def filed(rules, frequency):
    return u.RuleIndex([x for shard in u.shards_of(rules, frequency, 1 << 20) for x in shard])


def test_rarest_token_is_used():
    index = filed(u.SITE_RULES, {"net": 10, "example": 9, "en": 3, "com": 5, "de": 7, "org": 1, "fr": 2})
    assert {t: {r.name for r, _ in v} for t, v in index.by_token.items()} == {
        "net": {"net/"}, "en": {"example.net/en/"}, "com": {"example.com/de/"}, "org": {"org/fr/"}}


def test_rule_whose_last_token_goes_on():
    rule = u.site_rule("block", "example.org/pre")
    assert [r.name for r in filed([rule], {}).fitting("example.org", "/prefix")] == ["example.org/pre"]


def test_required_tokens():
    for pattern, want in ((r"pills", ()), (r"\bpills\b", ("pills",)), (r"-a[0-9]b-", ()), (r"(?:x|y)-foo-", ("foo",)), (r"(foo)/bar$", ("bar",)),
                          (r"-foo+-", ()), (r"-(?:foo-)?bar-", ("bar",)), (r"^ab.cd-ef/", ("ef",)), (r"-foo|-bar-", ()),
                          (r"[^a-z]foo/", ()), (r"[^0-9a-z]foo(?:[^0-9a-z]|\Z)", ("foo",)), (r"/foo(?=/)", ()), (r"(?:[-_]){2}foo\.", ("foo",))):
        assert u.required_tokens(pattern, True) == want, pattern
    assert u.required_tokens(r"[^0-9a-z]foo/", False) == ()      # a capital letter may stand before it
    assert [r.tokens for r in u.PATTERN_RULES] == [("cheap", "pills"), ("casino", "win"), ("spam", "farm"), ("free", "bets"),
                                                  ("ads", "track"), ("adult", "x")]


def many_rules(n, r):
    word = lambda: "".join(r.choice("abcde") for _ in range(r.choice([1, 2, 3])))      # noqa: E731
    forms = (lambda: u.word_rule(word(), word()), lambda: u.site_rule(r.choice(["block", "allow"]), f"{word()}.{word()}/{word()}"),
             lambda: u.Rule("p", rf"\b{word()}\b.*{word()}", "block"), lambda: u.Rule("p", rf"{word()}\d+[-_]{word()}$", "block"),
             lambda: u.Rule("p", rf"(?:{word()}|{word()})/(?:{word()}-)?{word()}/", "block"))
    return [r.choice(forms)() for _ in range(n)]


def test_many_rules_against_running_all_of_them(spark, monkeypatch):
    r = random.Random(8)
    rules = many_rules(50_000, r)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.choice([1, 2, 3, 4, 5, 6])))      # noqa: E731
    urls = [f"http://{word()}.{r.choice([word(), 'AB'])}/{word()}{r.choice(['/', '-', '1-', '_'])}{word()}" for _ in range(40)]
    compiled = [(x, re.compile(x.pattern, re.ASCII)) for x in rules]

    def all_of_them(url):
        host, path = u.host_of(url)
        fits = [x for x, p in compiled if p.search(host + path if x.site else (host + path).lower())]
        site = max((x for x in fits if x.site), key=lambda x: (len(x.name), x.name, x.verdict), default=None)
        if site:
            return host, path, site.name, site.verdict
        return host, path, None, "block" if fits else "allow"
    want = {i: all_of_them(url) for i, url in enumerate(urls)}
    assert len({v[2:] for v in want.values()}) >= 3
    rows = spark.createDataFrame(list(enumerate(urls)) + [(100, None)], "page_id long, url string")
    table = spark.createDataFrame([(x.name, x.pattern, x.verdict, x.site) for x in rules[:500]] + [("n", None, None, None)],
                                  "name string, pattern string, verdict string, site boolean")
    assert list(u.rules_from(table)) == rules[:500]
    for size in (u.RULES_BYTES, sum(len(x.pattern) + len(x.name) for x in rules) // 3):      # one shard, and four
        monkeypatch.setattr(u, "RULES_BYTES", size)
        got = {x["page_id"]: (x["host"], x["path"], x["rule"], x["verdict"]) for x in u.filter_urls(rows, rules).collect()}
        assert got.pop(100) == ("", "", None, "allow") and got == want


def test_repeated_rows_and_no_rules(spark):
    rows = spark.createDataFrame([(1, "http://x.net/")] * 3, "page_id long, url string")
    assert [x["rule"] for x in u.filter_urls(rows).collect()] == ["net/"] * 3
    assert [x["verdict"] for x in u.filter_urls(rows, ()).collect()] == ["allow"] * 3
