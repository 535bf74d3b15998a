import duckdb
import pytest

from viewtide.llm import urls


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, host string, verdict string")


def link(*hosts):
    return "".join(f'<a href="https://{h}/p">x</a>' for h in hosts)


ROWS = [
    (1, "http://A.example.ORG/es/1", None), (2, "https://example.org/en/17?x=/es/", link("good.net")),
    (3, "http://www.example.org/en/2", link("good.net", "GOOD.net", "www.example.org")), (4, "https://x.com/fr/a#b", ""),
    (5, "https://x.com/de/a", link("bad.net")), (6, "https://lure.net/a", link("x.com", "lure.net")),
    (7, "https://good.net/", "text <A HREF = '//friend.net/q'>"), (8, "http://friend.net", None), (9, "nothing", link("x.com")),
    (10, None, None), (11, "http://notorg/", None), (12, "http://x.org?a=/es/", None), (13, "a://b://c/d", None),
    (14, "https://com/de/z", None), (None, "https://bad.net/fr/", None)]


def test_host_path_and_longest_rule(spark):
    got = {r.page_id: (r.host, r.path, r.rule) for r in urls.judged(pages(spark, ROWS)).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/") and got[2] == ("example.org", "/en/17", "example.org/en/1")
    assert got[3] == ("www.example.org", "/en/2", "org/") and got[4] == ("x.com", "/fr/a", "com/fr/")
    assert got[9] == ("", "", None) and got[10] == ("", "", None) and got[11] == ("notorg", "/", None)
    assert got[12] == ("x.org", "", None) and got[13] == ("b:", "//c/d", None) and got[14] == ("com", "/de/z", "com/de/")


def test_links_decide_the_rest(spark):
    got = {r.page_id: r for r in urls.judged(pages(spark, ROWS)).collect()}
    assert got[6].verdict == "block" and got[6].distrust > 0      # links to a host with blocked pages
    assert got[7].verdict == "allow" and got[7].trust > 0         # linked from an allowed host
    assert got[8].trust > 0 and got[11].verdict == "allow" and got[11].trust == 0


def test_matches_sql(spark, tmp_path):
    spark.createDataFrame([r for r in ROWS if r[0] is not None], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/p")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/p/*.parquet'")
    want = con.execute(urls.ORACLE_SQL).fetchall()
    got = urls.judged(spark.read.parquet(f"{tmp_path}/p")).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def brute(seeds, links):
    rank = dict(seeds)
    for _ in range(urls.ROUNDS):
        flow = dict.fromkeys(rank, 0.0)
        for s, d in links:
            flow[d] += rank[s] / sum(1 for a, _ in links if a == s)
        rank = {h: 0.15 * seeds[h] + 0.85 * flow[h] for h in rank}
    return rank


def test_propagation_matches_brute_force(spark):
    links = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("d", "a"), ("e", "d")]
    seeds = {"a": 0.7, "b": 0.0, "c": 0.0, "d": 0.3, "e": 0.0}
    df = spark.createDataFrame([(h, s, s) for h, s in seeds.items()], "host string, st double, sb double")
    got = {r.host: r for r in urls.propagated(df, spark.createDataFrame(links, "src string, dst string")).collect()}
    trust, distrust = brute(seeds, links), brute(seeds, [(d, s) for s, d in links])
    for h in seeds:
        assert got[h].trust == pytest.approx(trust[h], abs=1e-12) and got[h].distrust == pytest.approx(distrust[h], abs=1e-12)


def test_repeats_and_empty(spark):
    assert urls.judged(pages(spark, ROWS[:2] * 3)).count() == 6
    assert urls.judged(pages(spark, [])).collect() == []


def test_unrelated_pages_do_not_round_a_verdict_away(spark):
    hops = [(1, "https://a.net/", link("b.net")), (2, "https://b.net/", link("c.net")), (3, "https://c.net/", link("bad.com")),
            (4, "https://bad.com/de/x", None)]
    fill = [(10 + k, f"https://f{k}.net/", link("b.net", "c.net", "bad.com")) for k in range(300)]
    far = [(1000 + k, f"https://far{k % 50}.com/de/{k}", None) for k in range(30_000)]
    for more in ([], far):
        got = {r.page_id: r for r in urls.judged(pages(spark, hops + fill + more)).where("page_id < 5").collect()}
        assert got[1].verdict == "block" and got[1].trust == 0
    assert 0 < got[1].distrust < 5e-13


def test_a_long_chain_is_followed_to_its_end(spark):
    rows = [(k, f"https://h{k}.net/", link(f"h{k + 1}.net")) for k in range(26)] + [(26, "https://h26.net/", link("bad.com")),
                                                                                  (27, "https://bad.com/de/x", None)]
    got = {r.page_id: r for r in urls.judged(pages(spark, rows)).collect()}
    assert {r.verdict for r in got.values()} == {"block"}
    assert got[0].distrust == pytest.approx(0.15 * 0.85 ** 27, rel=1e-9)


def test_ranks_that_still_move_are_an_error(spark):
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0)], "host string, st double, sb double")
    with pytest.raises(RuntimeError):
        urls.propagated(seeds, spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string"), rounds=3)
