"""op2: rules of tokens that met one label alone."""

import pytest

from tidesync.llm import url_filter


def test_op2_one_label_tokens_are_mined(spark):
    """Together with the rules of contested tokens they are what mining all tokens gives, less those without lift."""
    rows = ([(["h0:com", "p:en"], "block")] * 6 + [(["h0:com", "p:de"], "allow")] * 5 + [(["h0:com", "p:x"], "allow")] * 2
            + [(["h0:com", "p:x"], "block")] * 3 + [(["h0:net", "p:es"], "block")] * 4 + [(["h0:com", "rare"], "block")])
    df = spark.createDataFrame(rows, "tokens array<string>, label string")
    classes = url_filter.contested_classes(df, 0.1)
    some = url_filter.mine_rules(url_filter.in_classes(df, classes), 0.1, 0.5)
    one = url_filter.one_label_rules(df, 0.1)
    columns = ["antecedent", "label", "confidence", "support"]
    keyed = lambda d: {(tuple(r[0]), r[1]): pytest.approx((r[2], r[3])) for r in d.select(*columns).collect()}
    whole = {(tuple(r[0]), r[1]): (r[2], r[3]) for r in url_filter.mine_rules(df, 0.1, 0.5).select(*columns).collect()}
    assert {k[0] for k in keyed(one)} == {("p:en",), ("p:de",)}
    assert {**keyed(some), **keyed(one)} == {k: v for k, v in whole.items() if k[0] not in (("h0:net",), ("p:es",))}


def test_op2_one_label_tokens_judge(spark):
    """en is blocked on a host that also has allowed pages; es only where everything is blocked."""
    urls = [f"http://example.com/{d}/{i}" for d in ("en", "de") for i in range(40)] + [f"http://a.net/es/{i}" for i in range(20)]
    pages = [*enumerate(urls), (900, "http://c.org/en/q"), (901, "http://c.org/es/q"), (902, "http://c.org/de/q")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(
        spark.createDataFrame(pages, "page_id long, url string"), url_filter.CONTRACT_RULES).collect()}
    assert (got[900], got[901], got[902]) == ((None, "block"), (None, "allow"), (None, "allow"))
    assert got[0][1] == "block" and got[40][1] == "allow"


def test_op2_rules_take_few_tasks(spark):
    """Tables of rules and tokens do not grow with the input, so they take no task for each shuffle partition."""
    rows = [([f"h0:{h}", f"p:{d}", f"p:{i}"], "block" if d == "en" or i % 3 == 0 else "allow")
            for i in range(8) for h in ("com", "net") for d in ("en", "de", "es")]
    df = spark.createDataFrame(rows, "tokens array<string>, label string")
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        classes = url_filter.contested_classes(df, 0.1)
        mined = url_filter.mine_rules(url_filter.in_classes(df, classes), 0.1, 0.5)
        tables = [classes, mined, url_filter.with_members(mined, classes), url_filter.one_label_rules(df, 0.1)]
        parts = [t.rdd.getNumPartitions() for t in tables]
        n_rules = [t.count() for t in tables]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert all(n_rules) and max(parts) <= url_filter.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
