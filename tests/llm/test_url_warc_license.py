import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowsieve.llm import bloom_cascade as b
from rowsieve.llm import license_scan as lic
from rowsieve.llm import warc_index as w
from rowsieve.llm.common import scratch

URLS = [
    None, "", "no scheme", "://", "http://", "http://ORG", "http://a.org/x", "https://example.org/es/1",
    "https://EXAMPLE.org/en/12?q#f", "http://notexample.org/es/", "http://m.x.com/fr/1", "http://x.com/de/9",
    "http://x.com?/de/", "http://bad.host.net/p", "http://bad.host.net", "http://com/de/", "a://b://org/", "http://x.org/\n/y",
]
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def plain_verdict(url, blocked):
    host = path = ""
    if url and "://" in url:
        rest = url.partition("://")[2]
        end = min([i for i, c in enumerate(rest) if c in "/?#"], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([i for i, c in enumerate(rest) if c in "?#"], default=len(rest))]
    fits = []
    for rule, verdict in RULES.items():
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, *max(fits)[1:]
    return host, path, None, "block" if host in blocked else "allow"


def test_rules_and_list(spark):
    rows = [(i, u, "r", "v") for i, u in enumerate(URLS + URLS[:5])]
    pages = spark.createDataFrame(rows, "page_id int, url string, rule string, verdict string")
    blocked = spark.createDataFrame([("bad.host.net",), ("bad.host.net",), ("",)], "host string")
    found = {r["page_id"]: tuple(r)[2:] for r in b.judge(pages, RULES, blocked).collect()}
    assert found == {i: plain_verdict(u, {"bad.host.net", ""}) for i, u, *_ in rows}
    assert b.judge(pages.limit(0), RULES, blocked).count() == 0
    none = b.judge(pages, {}, blocked.limit(0)).collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}


@given(st.integers(0, 400), st.integers(0, 400), st.integers(0, 9))
@settings(max_examples=60, deadline=None)
def test_cascade_is_exact_over_its_universe(inside, outside, seed):
    r = np.random.default_rng(seed)
    a, c = (r.integers(0, 1 << 63, inside + outside).astype(np.uint64) for _ in range(2))
    listed = np.arange(inside + outside) < inside
    assert (b.ask_levels(b.make_levels(a, c, listed), a, c) == listed).all()


def test_shards_and_blocks(spark, monkeypatch):
    universe = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where(F.col("key") % 7 == 0)
    cascade = b.build(listed, universe, shard_keys=400)
    assert cascade.count() == 8
    monkeypatch.setattr(b, "MOST_BYTES", 1)
    rows = universe.withColumn("keys", F.array("key", F.lit("0")))
    found = b.ask(rows, cascade, F.col("keys"), "flags").collect()
    assert all(r["flags"] == [int(r["key"]) % 7 == 0, True] for r in found)


PAGES = [
    (1, "http://www.Example.com/a?b=1#c", "same"), (2, None, "same"), (3, "http://x.org", "same"), (None, "http://n.org/", "same"),
    (4, "http://x.org/é \n", "<p>é</p>\r\n\r\nWARC/1.1"), (5, "", None), (6, "http://x.org/", ""), (7, "http://x.org/big", "b" * 300_000),
    (8, "http://x.org/twice", "t"), (8, "http://x.org/twice", "t"), (None, "http://only.null/", "alone"), (None, "http://only.null/", "alone"),
]


def archive(spark, rows, **kw):
    folder = scratch(spark, "warc")
    pages = spark.createDataFrame([(*r, 0, "k") for r in rows], "page_id long, url string, html string, digest int, key string")
    w.write_archive(pages.repartition(3), folder, **kw)
    return folder


def test_archive_round_trip(spark):
    folder = archive(spark, PAGES, block_lines=2)
    found = w.read_archive(spark, folder).collect()
    assert len(found) == len(PAGES)
    expected = []
    for page_id, _, html in PAGES:
        body = html or ""
        top = max((p for p, _, h in PAGES if (h or "") == body and p is not None), default=None)
        other = top if page_id != top else None
        kept = body if other is None else None
        expected.append((page_id, "response" if other is None else "revisit", len(body.encode()), w.digest(body.encode()), other, kept))
    got = [(r["page_id"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"], r["payload"]) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    directory = sorted(w.read_directory(spark, folder).collect())
    assert len(directory) > 3 and sum(r["lines"] for r in directory) == len(PAGES)


def test_tasks_that_read_back_follow_the_bytes(spark, monkeypatch):
    folder = archive(spark, PAGES)
    assert w.read_archive(spark, folder).rdd.getNumPartitions() == 1
    monkeypatch.setattr(w, "LEAST_READ", 1)
    found = w.read_archive(spark, folder)
    assert found.rdd.getNumPartitions() > 2 and found.count() == len(PAGES)


def test_lookup_by_url(spark):
    folder = archive(spark, PAGES, block_lines=2)
    assert [x[1] for x in w.lookup(spark, folder, "http://www.example.com/a?b=1")] == [1]
    assert {x[1] for x in w.lookup(spark, folder, "http://X.org/")} == {3, 6}
    assert w.lookup(spark, folder, "http://absent.org/") == []
    [(_, page_id, kind, *place)] = w.lookup(spark, folder, "http://x.org/é \n")
    one = spark.createDataFrame([tuple(place)], "file string, offset long, length long")
    assert w.read_archive(spark, folder, one).first()["payload"] == PAGES[4][2] and (page_id, kind) == (4, "response")


def test_small_payloads_and_empty_tables(spark):
    folder = archive(spark, PAGES, least_bytes=2)
    kinds = {(r["page_id"], r["record_type"]) for r in w.read_archive(spark, folder).collect()}
    assert (5, "response") in kinds and (6, "response") in kinds and (1, "revisit") in kinds
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch(spark, "warc")
    w.write_archive(pages, folder)
    assert w.read_archive(spark, folder).count() == 0


def full(name):
    """A licence's text as it stands in files: a holder before it, lines broken."""
    broken = lic.TEXTS[name].split()
    return "Copyright (c) 2020 Somebody Else\n\n" + "\n".join(" ".join(broken[i : i + 12]) for i in range(0, len(broken), 12))


def licences(spark, rows, names=()):
    """``licence, licence_source`` by row, beside columns of the given names."""
    columns = "".join(f", `{n}` string" for n in names)
    files = spark.createDataFrame([(i, *r, *names) for i, r in enumerate(rows)], f"n int, path string, text string{columns}")
    found = lic.scan(files).collect()
    assert all(r[n] == n for r in found for n in names if n not in ("licence", "score"))
    return {r["n"]: (r["licence"], r["licence_source"]) for r in found}


def test_licences(spark):
    mit, gpl, all_rights = (lic.NOTICES[k] for k in ("MIT", "GPL-3.0", "proprietary"))
    filler = " ".join(f"unrelated{i}" for i in range(60))
    rows = [
        ("a/LICENSE", mit), ("a/x/y/1", filler), ("a/x/licence.txt", gpl), ("a/x/z", filler), ("a/own", f"{filler}\n{all_rights}\n{filler}"),
        ("b/none", filler), ("b/null", None), ("b/empty", ""), (None, mit), (None, filler), ("a/two", f"{mit}\n{gpl}"),
        ("top", filler), ("a/xx", filler), ("a/xx", filler), ("a/long", f"{filler} " * 500 + mit),
        ("c/one.py", mit), ("c/other.py", filler), ("d/LICENSED", mit), ("d/e", filler),
    ]
    found = licences(spark, rows, ("licence", "best", "_l", "_dir", "_hash", "row", "own", "dir", "from", "score", "unit"))
    assert found[0] == ("MIT", "header") and found[2] == ("GPL-3.0", "header")
    assert found[1] == ("GPL-3.0", "a/x") and found[3] == ("GPL-3.0", "a/x")
    assert found[4] == ("proprietary", "header")
    assert all(found[i] == (None, None) for i in (5, 6, 7, 9, 11))
    assert found[8] == ("MIT", "header") and found[10][1] == "header"
    assert found[12] == found[13] == ("MIT", "a") and found[14] == ("MIT", "a")
    # A header licenses its own file only.
    assert found[15] == ("MIT", "header") and found[16] == (None, None) and found[18] == (None, None)
    empty = spark.createDataFrame([], "path string, text string")
    assert lic.scan(empty).count() == 0


def test_full_licence_texts(spark):
    """Each is found by its text whatever the file's name, and licenses what lies below."""
    code = "\n".join(f"def part{i}(): return value{i}" for i in range(80))
    rows = [("z/code.py", code), ("z/MIT/start.txt", lic.TEXTS["MIT"][:250])]
    for name in sorted(lic.TEXTS):
        rows += [(f"{name}/about.txt", full(name)), (f"{name}/deep/er/code.py", code), (f"{name}/both", lic.NOTICES["GPL-3.0"] + "\n" + code)]
    rows += [("ISC/LICENSE", lic.NOTICES["MIT"]), ("BSD-3-Clause/deep/COPYING", full("MIT"))]
    found = licences(spark, rows)
    assert found[0] == found[1] == (None, None)
    for i, name in enumerate(sorted(lic.TEXTS)):
        assert found[2 + 3 * i] == (name, "text")
        # The nearest licence file; in one directory a full text goes before a named file.
        assert found[3 + 3 * i] == (("MIT", "BSD-3-Clause/deep") if name == "BSD-3-Clause" else (name, name))
        assert found[4 + 3 * i] == ("GPL-3.0", "header")


def test_scores_do_not_depend_on_the_size_of_the_table(spark):
    """The same shares of words give the same score in one table and one forty times larger."""
    r = random.Random(3)
    rows = [(f"d{i}/x", " ".join(f"w{r.randrange(80)}" for _ in range(30)) + "\n" + (lic.NOTICES["MIT"] + " w7" if i % 20 == 0 else "")) for i in range(200)]
    small = spark.createDataFrame(rows, "path string, text string")
    large = small.crossJoin(spark.range(40).withColumnRenamed("id", "copy"))
    best = [{x["score"] for x in lic.scan(t).where("licence = 'MIT'").select("score").distinct().collect()} for t in (small, large)]
    assert len(best[0]) == len(best[1]) == 1 and abs(max(best[0]) - max(best[1])) < 0.01 and min(best[0]) > 0.9


def test_cosines_against_plain_python(spark):
    r = random.Random(5)
    vocabulary = re.findall(lic._WORD, " ".join([*lic.TEXTS.values(), *lic.NOTICES.values()]).lower()) + [f"v{i}" for i in range(300)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 400))) for _ in range(60)] + [None, "", *map(full, lic.TEXTS)]
    bags = [Counter(re.findall(lic._WORD, (t or "").lower())) for t in texts]
    df = Counter(w for b in bags for w in b)
    weigh = lambda bag: {w: n * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in bag.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    templates = {n: weigh(Counter(re.findall(lic._WORD, t.lower()))) for n, t in lic.TEXTS.items()}
    want = {}
    for i, bag in enumerate(bags):
        if bag:
            v = weigh(bag)
            want[i] = max(sum(x * t.get(w, 0) for w, x in v.items()) / norm(v) / norm(t) for t in templates.values())
    units = spark.createDataFrame(list(enumerate(texts)), "unit long, text string")
    weights = lic.Weights(units)
    found = {x["unit"]: x["score"] for x in lic.cosines(units, weights, weights.templates(lic.TEXTS)).collect()}
    assert found.keys() == want.keys() and all(abs(found[i] - want[i]) < 1e-5 for i in want)


def test_licence_scan_runs_no_python(spark):
    files = spark.createDataFrame([("a/b", lic.NOTICES["MIT"])], "path string, text string")
    plan = lic.scan(files)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_anchors_lose_no_match():
    weights = lic.Templates({"t": {"a": 0.1, "b": 0.3, "c": 0.5, "d": 0.8}})
    anchors = set(weights.anchors(0.7))
    r = random.Random(1)
    for _ in range(200):
        held = {k for k in "abcd" if r.random() < 0.5}
        # The best cosine of a text that holds these words and no others.
        best = sum(weights.weights["t"][k] ** 2 for k in held) ** 0.5
        assert best < 0.7 or held & anchors
