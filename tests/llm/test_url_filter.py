"""Rules against a plain reading of urls, and the model against what it learned and what it didn't."""

import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import queries, url_filter

URLS = [
    None, "", "no scheme", "http://", "http://Org/x", "https://a.ORG", "https://a.org/", "http://example.org/es/1", "http://sub.example.org/es",
    "http://example.org/en/12?x=/es/", "http://myexample.org/en/12", "ftp://x.com/fr/#a", "x://y://z/w", "http://com/de/", "http://a.com/de?q",
    "http://a.com:80/de/", "http://ü.com/de/É", "http://h?a/b", "http://h#a/b", "http://cheap-pills.example.net/en/5", "http://line\nbreak.org/\nx",
    "http://museum.example.net/en/5", "http://x.org/" + "a" * 100000,
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = []
    for rule, says in url_filter.RULES:
        name, begin = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + begin):
            fits.append((len(rule), rule, says))
    return host, path, max(fits)[1:] if fits else (None, None)


def test_rules(spark):
    model = url_filter.fit(url_filter.labelled_urls(spark))
    frame = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[5]), (1, URLS[7])], "page_id bigint, url string")
    frame = frame.withColumns({"host": F.lit("clash"), "score": F.lit(1), "rule": F.lit(2)})
    rows = url_filter.judge(frame, model).collect()
    assert len(rows) == len(URLS) + 2
    for row in rows:
        url = URLS[5] if row.page_id is None else URLS[7] if row.page_id == 1 and row.host else URLS[row.page_id]
        host, path, (rule, says) = plain(url)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (says or ("block" if row.score >= 0.5 else "allow"))
        assert abs(row.score - model.probability(host, path)) < 1e-12


def test_model_learns_and_generalises(spark):
    labelled = url_filter.labelled_urls(spark)
    model = url_filter.fit(labelled)
    host, path = url_filter.host_and_path(F.col("url"))
    rows = labelled.select(host.alias("host"), path.alias("path"), "label").collect()
    assert all((model.probability(r.host, r.path) >= 0.5) == bool(r.label) for r in rows)
    assert model.probability("shop.cheap-pills-online.net", "/en/1") > 0.5 > model.probability("citylibrary.example.net", "/en/1")


def test_without_labels_and_empty(spark):
    model = url_filter.fit(spark.createDataFrame([("http://x", None)], "url string, label int"))
    assert model.probability("spam", "/") < 0.5
    assert url_filter.judge(spark.createDataFrame([], "page_id bigint, url string"), model).collect() == []


def test_query(spark, tmp_path):
    spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").write.parquet(str(tmp_path / "pages.parquet"))
    rows = {r.page_id: r.verdict for r in queries.op3_url_filter(spark, str(tmp_path)).collect()}
    assert len(rows) == len(URLS) and rows[19] == "block" and rows[21] == "allow"


def test_names_are_not_taken_from_pages(spark):
    names = {*url_filter.BLOCKED_NAMES, *url_filter.ALLOWED_NAMES}
    host, _ = url_filter.host_and_path(F.col("url"))
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet", "/root/testdata/sf0.1/pages.parquet")
    labels = {label for row in pages.select(host.alias("host")).distinct().collect() for label in row.host.split(".")}
    assert labels and not names & labels


def test_offset_follows_names_held_out(spark):
    labelled = url_filter.labelled_urls(spark)
    host, path = url_filter.host_and_path(F.col("url"))
    rows = labelled.select("name", host.alias("host"), path.alias("path"), "label").orderBy("host", "path").collect()
    names = [r.name for r in rows]
    odds, label = url_filter.held_out([url_filter.ngrams(r.host, r.path) for r in rows], np.array([r.label for r in rows], float), names)
    assert len(odds) == len(rows)

    def missed(cut):
        return (odds[label == 0] >= cut).mean(), (odds[label == 1] < cut).mean()

    best = url_filter.threshold(odds, label)
    assert sum(missed(best)) <= min(sum(missed(cut)) for cut in np.linspace(-3, 3, 61)) + 1e-9
    clean, spam = missed(best)
    assert clean < 0.15 and spam < 0.5
    # what has been learned of one name is not used to judge it
    once = url_filter.held_out([url_filter.ngrams("a.com", "/")] * 2, np.array([1.0, 0.0]), ["a", "a"])
    assert len(once[0]) == 0
