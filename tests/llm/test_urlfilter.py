import re

from clausewell.llm import queries, urlfilter
from clausewell.llm.queries import URL_RULES


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), v, h + p) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[2] if fit else None, max(fit)[1] if fit else None


URLS = ["http://EXAMPLE.com/en/1?x=1#y", "https://www.example.com/en/2", "http://a.net/es/", "http://a.net/de/1", "http://b.org?x", "http://b.org#f", "no scheme", None, "", "x://y://z/en/", "http://example.com", "http://notexample.com/en/1", "http://É.com/", "http://a.b.net/fr/x\ny", "http:///p", "http://example.com/EN/1"]


def test_rules_match_brute_force(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(0, URLS[0], "")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, host string")
    got = urlfilter.judge(df, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = brute(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or "allow")
    many = URL_RULES + [("block", f"h{i}.org", "/q/") for i in range(100)]
    assert sorted(map(str, urlfilter.judge(df, many).collect())) == sorted(map(str, got))
    assert urlfilter.judge(df.where("false"), URL_RULES).count() == 0


def test_blocks_reach_aliases_and_allows_win(spark):
    link = lambda h: f"<html><LINK data-x=1 rel='canonical' href=\"{h}\"></html>"
    pages = [
        (1, "http://x.org/a", link("http://example.com/en/9")),
        (2, "http://example.com/en/9", ""),
        (3, "http://y.org/b/", '<meta http-equiv="refresh" content="0; url=http://x.org/a">'),
        (4, "http://www.example.com/en/5", link("http://example.com/en/9")),
        (5, "http://z.org/c", link("/d")),
        (6, "http://z.org/d#top", ""),
        (7, "http://q.org/r", ""),
    ]
    redirects = spark.createDataFrame([("http://q.org/r", "http://y.org/b/"), (None, "http://y.org/b/")], "source_url string, target_url string")
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(df, URL_RULES, redirects).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block"}
    parts = {r["page_id"]: r["component"] for r in urlfilter.judge(df, URL_RULES, redirects).collect()}
    assert parts[5] == parts[6] and len({parts[i] for i in (1, 2, 3, 4, 7)}) == 1


def test_without_an_edge_nothing_spreads(spark):
    urls = ["http://x.net/es/", "http://x.net/es", "http://x.net/es?ref=a", "https://x.net/es/", "http://X.net/es/#top", "http://y.org/" + "p/" * 40_000]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id bigint, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(df, URL_RULES).collect()}
    assert got == {0: "block", 1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow"}


def test_a_block_spreads_over_urls_that_are_no_pages(spark):
    pages = [(1, "http://a.org/", "<link rel=canonical href='http://example.com/en/x'>"), (2, "http://b.org/", "<link rel=canonical href='//gone.org/1'>"), (3, "http://c.org/", "")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    redirects = spark.createDataFrame([("http://gone.org/1", "http://w.net/es/"), ("http://c.org/", None)], "source_url string, target_url string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(df, URL_RULES, redirects).collect()}
    assert got == {1: "block", 2: "block", 3: "allow"}


BAD = "http://example.com/en/bad"
#: Pages whose link a browser would (or wouldn't) follow to a blocked page.
LINKS = [
    ("http://l0.org/d/p", "<link rel=canonical href='../q'>", "http://l0.org/q"),
    ("http://l1.org/d/p", "<base href='http://example.com/en/'><link rel='canonical' href='bad'>", BAD),
    ("http://l2.org/", f"<!-- <link rel=canonical href='{BAD}'> -->", None),
    ("http://l3.org/", f"<meta http-equiv=refresh content='900; url={BAD}'>", None),
    ("http://l4.org/", f"<meta http-equiv=refresh content='0.5;URL={BAD}'>", BAD),
    ("http://l5.org:80/", f"<link href='{BAD}' rel='alternate Canonical'>", BAD),
    ("http://l6.org/", f"<script>x = \"<link rel=canonical href='{BAD}'>\"</script>", None),
    ("http://l7.org/", f"<link data-rel=canonical href='{BAD}'>", None),
    ("http://l8.org/", "<link rel=canonical href='mailto:x@example.com'>", None),
    ("http://l9.org/a/b", "<link rel=canonical href='?q=1'>", "http://l9.org/a/b?q=1"),
    ("http://l10.org/a/./b/../../c/..", f"<link rel=canonical href='{BAD}'>", BAD),
    ("http://l10.org", "", None),
    ("http://l12.org/", "<!-- open <link rel=canonical href='x'>", None),
    ("https://l13.org:443/a//../b/.", "<link rel=canonical href='//EXAMPLE.com:80/./en/../en/bad'>", "https://example.com:80/en/bad"),
    ("http://l14.org/x", "<link rel=canonical href='../../../y'>", "http://l14.org/y"),
    (None, f"<link rel=canonical href='{BAD}'>", None),
    ("http://l16.org/", "<base target=_top><base href='/z/'><link rel=canonical href='w'>", "http://l16.org/z/w"),
]


def test_links_are_read_as_browsers_do(spark):
    df = spark.createDataFrame([(i, u, h, "z") for i, (u, h, _) in enumerate(LINKS)], "page_id bigint, url string, html string, base string")
    got = {r["src"].split("/")[2].split(":")[0]: r["dst"] for r in urlfilter.alias_links(df).collect()}
    want = {u.split("/")[2].split(":")[0]: d for u, _, d in LINKS if d}
    assert got == want
    keys = {r["url"]: r["k"] for r in df.select("url", urlfilter.page_key(df["url"]).alias("k")).collect()}
    assert (keys["http://l5.org:80/"], keys["http://l10.org/a/./b/../../c/.."], keys["http://l10.org"], keys["https://l13.org:443/a//../b/."]) == ("http://l5.org/", "http://l10.org/", "http://l10.org/", "https://l13.org/a/b/")


def test_paths_lose_their_dots(spark):
    import random

    rng = random.Random(5)
    paths = ["/" + "/".join(rng.choice([".", "..", "a", "b..", "...", ".c", "d"]) for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    paths += ["/" + "p/" * 6_000 + "../" * 6_000 + "end", "/" + "./" * 50_000 + "x", "/" + "../" * 20_000]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for r in df.select("p", urlfilter.without_dots(df["p"]).alias("q")).collect():
        assert r["q"] == plain_path(r["p"])


def plain_path(path):
    out = []
    for part in path.split("/")[1:]:
        if part == "..":
            del out[-1:]
        elif part != ".":
            out.append(part)
    if path.rsplit("/", 1)[1] in (".", ".."):
        out.append("")
    return "/" + "/".join(out)


def test_queries_equal_their_sql(spark, tmp_path):
    import duckdb

    link = lambda h: f"<html><LINK data-x=1 rel='canonical' href=\"{h}\"></html>"
    body = "<p>" + "same " * 40
    pages = [(i, u, body if i % 3 else f"{i}") for i, u in enumerate(URLS)] + [(0, URLS[0], None)]
    pages += [(50, "http://x.org/a", link("http://example.com/en/9")), (51, "http://y.org/b/", '<meta http-equiv="refresh" content="0; url=/c?d&amp;e">'), (52, "http://y.org/c?d&e", link("../n")), (53, "http://x.org/q/r", link("s")), (54, "http://x.org/q/s", link("//w.net/fr/")), (55, "http://www.example.com/en/5", link("http://x.org/a"))]
    pages += [(100 + i, u, h) for i, (u, h, _) in enumerate(LINKS)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    base = duckdb.connect()
    base.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    for name in ("op8_warc", "op9_urlfilter"):
        got = queries.QUERIES[name](spark, str(tmp_path))
        columns = sorted(got.columns)
        want = base.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall()
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(*columns).collect())
