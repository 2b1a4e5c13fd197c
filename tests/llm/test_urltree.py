import duckdb
import pytest

from cinelake.llm import urltree
from cinelake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"

CASES = {
    "http://A.Example.COM/Fr/x?q#f": ("a.example.com", "/Fr/x", None),
    "https://x.org": ("x.org", "", None),
    "https://x.org/": ("x.org", "/", "org/"),
    "https://notorg/": ("notorg", "/", None),
    "https://org/a": ("org", "/a", "org/"),
    "http://www.example.org/es/1": ("www.example.org", "/es/1", "example.org/es/"),
    "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1"),
    "http://badexample.org/en/12": ("badexample.org", "/en/12", "org/"),
    "ftp://É.com/de/://x": ("É.com", "/de/://x", "com/de/"),
    "http://x.com?/fr/": ("x.com", "", None),
    "no scheme /fr/": ("", "", None),
    "": ("", "", None),
    None: ("", "", None),
}


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(CASES)], "page_id long, url string")
    got = {r.page_id: r for r in urltree.ruled(df).collect()}
    for i, (host, path, rule) in enumerate(CASES.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)


def judged(spark, urls):
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, n string, host string")
    return {urls[r.page_id]: r for r in urltree.judge(df).collect()}


def test_variable_segments_become_wildcards_and_pure_templates_go(spark):
    urls = [f"http://shop.com/de/item{i}" for i in range(30)] + ["http://shop.com/fr/a"] * 2
    urls += [f"http://shop.com/en/{i}" for i in range(30)] + [f"http://calm.net/en/{i}" for i in range(3)]
    got = judged(spark, urls)
    assert got["http://shop.com/de/item3"].template == "/de/*/" and got["http://shop.com/de/item3"].verdict == "block"
    assert got["http://shop.com/fr/a"].verdict == "allow"
    assert got["http://shop.com/en/4"].template == "/en/*/" and got["http://shop.com/en/4"].rule is None
    assert got["http://calm.net/en/1"].verdict == "allow"


def test_judged_rows_of_odd_tables(spark):
    urls = list(CASES) + [None, "http://x.org/" + "a/" * 5000]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(None, "http://x.org/"), (1, urls[1])], "page_id long, url string")
    assert urltree.judge(df).count() == len(urls) + 2
    assert urltree.judge(df.limit(0)).count() == 0


def test_alike_branches_are_merged_and_others_stay(spark):
    rules = tuple((f"x.com/p/{b}/l", v) for b, v in (("b0", "allow"), ("b1", "block"), ("b2", "block"), ("c", "allow")))
    paths = [f"b{b}/l{i}" for b in (1, 2) for i in range(10)] + ["b0/l0", *(f"c/l{i}" for i in range(4))]
    paths += ["b0/u0", "b0/u1", "c/u0", "../q/u0"]  # without a rule; the last has no label at all
    df = spark.createDataFrame([(i, f"http://x.com/p/{p}".replace("/p/..", "")) for i, p in enumerate(paths)], "page_id long, url string")
    got = {paths[r.page_id]: r for r in urltree.judge(df, rules).collect()}
    assert {got[f"b{b}/l0"].template for b in range(3)} == {"/p/+/*"}
    # one allowed page does not tell b0 from its siblings: it is judged with them
    assert got["b0/u0"].rule is None and got["b0/u0"].verdict == "block" and got["b0/l0"].verdict == "allow"
    assert got["c/u0"].template.startswith("/p/c/") and got["c/u0"].verdict == "allow"
    assert got["../q/u0"].template == "/q/u0/"


@pytest.mark.parametrize(("branch", "node", "alike"), [((0, 1), (850, 1001), True), ((0, 30), (850, 1030), False), ((0, 0), (5, 9), True), ((5, 9), (5, 9), False), ((2, 2), (9, 9), True), ((0, 1), (200, 201), False)])
def test_the_test_of_siblings(spark, branch, node, alike):
    row = spark.createDataFrame([(*branch, *node)], "blocked long, labelled long, pb long, pl long")
    assert row.select(urltree._like_siblings()).first()[0] is alike


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_matches_oracle(spark, sf):
    cols = ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    got = sorted(tuple(r[c] for c in cols) for r in QUERIES["op8_urls"](spark, sf).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    want = sorted(con.sql(ORACLE_SQL["op8_urls"]).select(", ".join(cols)).fetchall())
    assert got == want
