"""Queries against their SQL on rows that the small tables do not have."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import TABLES, compare


def check(spark, sf_dir, tmp_path, name, **tables):
    for t in TABLES:
        if t in tables:
            spark.createDataFrame(tables[t][1], tables[t][0]).coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
        else:
            os.symlink(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    compare(spark, entry.queries()[name], entry.oracle_sql()[name], str(tmp_path))
    return entry.queries()[name](spark, str(tmp_path)).collect()


PAGES = "page_id long, url string, html string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_status_is_that_of_the_url(spark, sf_dir, tmp_path):
    rows = [(2, "https://x.org/en/1", "a"), (4, "https://x.org/en/1", "a"), (6, "https://x.org/en/2", "a"), (7, "https://x.org/en/2", "a"), (8, "https://x.org/fr/3", "a")]
    got = {r.person: r for r in check(spark, sf_dir, tmp_path, "a13_link_report", pages=(PAGES, rows))}
    assert got[2].en == "ok https://x.org/en/1" and got[7].en == "broken https://x.org/en/2" and got[8].none_works


def test_addresses_of_other_hosts_count(spark, sf_dir, tmp_path):
    html = ["at a.b@mail.ex", "a@m.example.c b@m.example.com <p>c@mail.example</p>", "mailto:d@Host.ORG data-cfemail='x'", "a@b.org@c.org x@sentry.io", "x at y dot com", None]
    got = check(spark, sf_dir, tmp_path, "a19_contact_counts", pages=(PAGES, [(i, "https://x.org/", h) for i, h in enumerate(html)]))
    assert {r.page_id: r.plain for r in got} == {0: 2, 1: 2, 2: 1, 3: 2, 4: 1, 5: None}


def test_offer_on_a_long_page_is_no_verdict(spark, sf_dir, tmp_path):
    rows = [(3, "https://x.org/a", "word " * 893), (14, "https://x.org/a", "word " * 894), (25, "https://x.org/a", "<script>" + "word " * 900 + "</script> w")]
    rows += [(i, "https://x.org/en/404/", "") for i in (33, 36, 42, 41)] + [(i, "https://x.org", "") for i in (5, 44)]
    got = check(spark, sf_dir, tmp_path, "l2_page_verdicts", pages=(PAGES, rows))
    assert {r.page_id: r.verdict for r in got} == {3: "parked", 14: "ok", 25: "parked", 33: "broken", 36: "broken", 42: "broken", 41: "parked", 5: "ok", 44: "ok"}


def test_halves_of_a_per_mille_go_up(spark, sf_dir, tmp_path):
    at, size = next((p, n) for n in range(16, 4000, 16) for p in range(2, n - 1) if 1000 * p % n * 2 == n and 1000 * (p / n) < 1000 * p / n)
    text = "a" * (at - 1) + " " + "b" * (size - at)
    got = check(spark, sf_dir, tmp_path, "w5_time_maps", conversations=("conv_id long, turn long, role string, text string", [(2, 0, "user", text)]))
    assert [r.per_mille for r in sorted(got, key=lambda r: r.idx)] == [0, (1000 * at + size // 2) // size]


@pytest.mark.parametrize("name", ["x13_titles", "x5_vocabulary"])
def test_phrases_are_no_patterns(spark, sf_dir, tmp_path, name):
    docs = [(1, "Er, and is it. er. and is", "en", "s", 1), (2, "Er- And is", "en", "s", 1)]
    check(spark, sf_dir, tmp_path, name, documents=(DOCS, docs), benchmark=("item_id long, text string", [(1, "Er. And is here")]))


def test_terms_in_a_row(spark, sf_dir, tmp_path):
    docs = [(1, "ai ai ai ai, Ai AI ai", "fr", "s", 1), (2, "les ai ai.ai", "fr", "s", 1)]
    check(spark, sf_dir, tmp_path, "x7_products", documents=(DOCS, docs))
