import hashlib
import random
import re

import pytest
from llm_helpers import LONG, ODD, documents
from pyspark.sql import functions as F

from marketgrain.llm import decontamination, licenses, url_filters

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower() if False else bytes(
        b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def contaminated_brute(rows, items, size=10):
    out = []
    for i, text in rows:
        own, hit, ids = words(text), set(), set()
        for item, passage in items:
            w = words(passage)
            windows = {tuple(w[s:s + size]) for s in range(max(len(w) - size + 1, 1))} if w else set()
            for window in windows:
                for s in range(len(own) - len(window) + 1):
                    if tuple(own[s:s + len(window)]) == window:
                        hit.update(range(s, s + len(window)))
                        ids.add("null" if item is None else str(item))
        out.append((str(i), len(own), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def passages():
    draw = random.Random(3)
    vocabulary = [f"v{k}" for k in range(30)] + ["the", "The", "über", "日本", "x1"]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(draw.choice((0, 1, 3, 9, 10, 11, 25))))) for k in range(25)]
    items += [(3, "again The same ID"), (None, "an item without id"), (40, None), (41, ""), (42, "the the the the")]
    rows = []
    for k in range(60):
        text = " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(40)))
        item = draw.choice(items)[1] or ""
        cut = item.split()[draw.randrange(3):]
        rows.append((100 + k, f"{text}, {'-'.join(cut)}! {text.upper()} {item}"))
    return rows, items


def report_rows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_decontamination_equals_brute_force(spark):
    rows, items = passages()
    rows = [*rows, *ODD]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = contaminated_brute(rows, items)
    assert report_rows(decontamination.report(documents(spark, rows), bench)) == expected
    # the same in many blocks of items
    assert report_rows(decontamination.report(documents(spark, rows), bench, block_words=100)) == expected


def test_decontamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontamination.report(documents(spark, ODD), none).collect())
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.report(documents(spark, []), items).count() == 0


def test_clean_keeps_columns(spark):
    docs = documents(spark, [(1, "x a b y"), (2, "b a"), (3, None), (4, LONG)])
    left = decontamination.clean(docs, spark.createDataFrame([(1, "A b")], "item_id long, text string"))
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4]
    assert left.where("doc_id = 4").first().text == LONG


@pytest.mark.parametrize(("url", "host", "path", "rule", "verdict"), [
    (None, "", "", None, "allow"), ("no scheme/en/", "", "", None, "allow"), ("http://", "", "", None, "allow"),
    ("http://EXAMPLE.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
    ("http://www.example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"), ("http://a.net/ES/1", "a.net", "/ES/1", None, "allow"),
    ("http://net/fr/", "net", "/fr/", "net/fr/", "block"), ("http://a.com", "a.com", "", None, "allow"),
    ("x://a.com?/en/", "a.com", "", None, "allow"), ("a://b://c.net/es/", "b:", "//c.net/es/", None, "allow"),
    ("http://a.com/\nb", "a.com", "/\nb", "com/", "allow"),
])
def test_rules(spark, url, host, path, rule, verdict):
    page = spark.createDataFrame([(1, url, None)], "page_id long, url string, html string")
    row = url_filters.judge(page).first()
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


def link(target):
    return f'<html><link href="{target}" REL=canonical></html>'


def test_blocks_reach_aliases_and_allow_goes_first(spark):
    pages = [
        (1, "http://a.org/1", link("http://b.org/2")), (2, "http://b.org/2", None),
        (3, "http://b.org/3", "<meta http-equiv='refresh' content='0; url=http://b.org/2'>"),
        (4, "http://x.net/es/4", link("http://a.org/1")),        # blocked, ties 1 to 4
        (5, "http://www.example.com/en/5", link("http://x.net/es/4")),  # allowed by its own rule
        (6, "http://c.org/6", link("/7")), (7, "http://c.org/7", link("//c.org/6")),  # no block among them
        (8, "http://d.org/8", link("http://hidden.net/fr/")),    # the blocked url is no page
        (9, "http://e.org/9", link("http://e.org/9")), (2, "http://b.org/2", "<p>canonical refresh</p>"),
        (10, None, link("http://hidden.net/fr/")),
    ]
    frame = spark.createDataFrame([(*p, "v", "h") for p in pages],
                                  "page_id long, url string, html string, verdict string, host string")
    found = {(r.page_id, r.verdict) for r in url_filters.judge(frame).collect()}
    assert found == {(1, "block"), (2, "block"), (3, "block"), (4, "block"), (5, "allow"), (6, "allow"), (7, "allow"),
                     (8, "block"), (9, "allow"), (10, "allow")}
    assert url_filters.judge(frame).count() == len(pages)
    assert url_filters.judge(frame.limit(0)).count() == 0


def refresh(target):
    return f'<META content="0; URL={target}" http-equiv="Refresh">'


@pytest.mark.parametrize(("target", "page", "expected"), [
    ("page.html", "http://a.org/x/y?q", "http://a.org/x/page.html"), ("../z", "http://a.org/x/y/w", "http://a.org/x/z"),
    ("?p=2", "http://a.org/x/y?q#f", "http://a.org/x/y?p=2"), ("?p=2", "http://a.org", "http://a.org/?p=2"),
    ("page", "http://a.org", "http://a.org/page"), ("HTTP://A.Org", "x://b/", "http://a.org/"),
    ("//B.org/x#y", "https://a.org/", "https://b.org/x"), ("/x/./y/../z", "http://a.org/1", "http://a.org/x/z"),
    ("../../..", "http://a.org/x/y", "http://a.org/"), ("..", "http://a.org/x/y/z", "http://a.org/x/"),
    ("#top", "http://a.org/x?q#f", "http://a.org/x?q"), ("mailto:me", "http://a.org/", None),
    ("http://a.org/P?Q=..", "http://a.org/", "http://a.org/P?Q=.."), ("a/b?c=/../d", "http://a.org/x", "http://a.org/a/b?c=/../d"),
])
def test_targets_are_resolved(spark, target, page, expected):
    row = spark.createDataFrame([(target, page)], "target string, page string").select(
        url_filters.normalised(url_filters.resolved(F.col("target"), F.col("page"))).alias("u")).first()
    assert row.u == expected


def test_blocks_reach_aliases_of_every_form(spark):
    blocked = "http://x.net/es/dir/page.html"
    pages = [
        (1, blocked, None, "block"),
        (2, "http://x.net/other/start", refresh("../es/dir/page.html"), "block"),
        (3, "http://b.org/3", link("HTTP://X.Net/es/dir/page.html#part"), "block"),
        (4, "http://c.org/4", link("http://c.org/4") + link("http://b.org/none") + link(blocked), "block"),  # the third tag
        (5, "http://d.org/5", refresh("http://d.org/6") + refresh(blocked), "block"), (6, "http://D.org/6#x", None, "block"),
        (7, "http://e.org", None, "block"), (8, "http://f.net/es/q", link("http://e.org/"), "block"),
        (9, "http://g.org/a/b?x", refresh("?p=2"), "block"), (10, "http://g.org/a/b?p=2", link("//x.net/es/dir/page.html"), "block"),
        (11, "http://h.org/a/b", refresh("page.html"), "allow"), (12, "http://h.org/a/page.html", None, "allow"),
        (13, "http://i.org/a", link("mailto:me") + link("/b"), "allow"),
    ]
    frame = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    found = {r.page_id: r for r in url_filters.judge(frame).collect()}
    assert {i: r.verdict for i, r in found.items()} == {p[0]: p[3] for p in pages}
    assert found[11].component == found[12].component == "http://h.org/a/b"


def license_brute(rows, templates):
    out = set()
    for i, text in rows:
        own = licenses.plain_shingles(text or "")
        for name, template in templates.items():
            wanted = set(licenses.plain_shingles(template))
            n = len(wanted)
            for at in range(0, len(own), n) if n else ():
                if 100 * len(set(own[at:at + 2 * n]) & wanted) >= 80 * n:
                    out.add((str(i), name, at))
    return sorted(out)


def test_license_windows_equal_brute_force(spark):
    draw = random.Random(5)
    rows = list(ODD)
    names = list(licenses.TEMPLATES)
    for k in range(60):
        filler = [draw.choice(["the", "licensed", "work", "any", "und", "Version", "é"]) for _ in range(draw.randrange(60))]
        notice = licenses.TEMPLATES[draw.choice(names)].split()
        if k % 3 == 1:
            notice[draw.randrange(len(notice))] = "changed"
        rows.append((200 + k, " ".join([*filler[:20], *notice, *filler[20:], *(notice if k % 5 == 0 else [])])))
    found = licenses.matches(documents(spark, rows))
    expected = license_brute(rows, licenses.TEMPLATES)
    assert len(expected) > 50
    assert sorted((str(r.doc_id), r.license, r.window) for r in found.collect()) == expected
    assert licenses.scan(documents(spark, [])).count() == 0
    assert licenses.matches(documents(spark, rows), {"none": " , "}).count() == 0


def test_bare_rights_notice_is_found_where_it_stands(spark):
    rows = [
        (1, "A text of more than five words.\n\n© 2020 Someone. All rights reserved."),
        (2, "all RIGHTS reserved"), (3, "All rights reserved, and again: all rights reserved!"),
        (4, "all rights are reserved"), (5, "all rights reservedly"), (6, "overall rights reserved by some of us"), (7, None),
        (8, "reserved rights all"), (9, "All rights reserved. No part of this may be reproduced"),
    ]
    found = {(r.doc_id, r.license, r.n_windows, r.first_window, r.containment) for r in licenses.scan(documents(spark, rows)).collect()}
    name = "proprietary-notice"
    assert {r for r in found if r[1] == name} == {(1, name, 1, 9, 1.0), (2, name, 1, 0, 1.0), (3, name, 2, 0, 1.0), (9, name, 1, 0, 1.0)}
    assert {(r[0], r[1]) for r in found if r[1] != name} == {(9, "proprietary")}
    own = licenses.matches(documents(spark, rows), {"short": "rights are"}).collect()
    assert [(r.doc_id, r.license, r.window) for r in own] == [(4, "short", 1)]


def test_anchors_are_necessary():
    known = [licenses.plain_shingles(t) for t in licenses.TEMPLATES.values()]
    words_ = licenses.anchors(known)
    for shingles in known:
        without = [s for s in shingles if not set(s.split()) & set(words_)]
        assert 100 * len(without) < licenses.PERCENT * len(shingles)


def test_templates_are_bounded(spark):
    with pytest.raises(ValueError, match="templates"):
        licenses.template_frame(spark, {"x": "word " * (licenses.MAX_TEMPLATE_WORDS + 1)})


def test_no_python_in_native_plans(spark):
    page = spark.createDataFrame([(1, "http://a.net/es/", None)], "page_id long, url string, html string")
    for df in (url_filters.judge(page), licenses.scan(documents(spark, ODD))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
    assert F is not None
