"""Collection stopped and resumed, sitemaps, and loose dates."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lorekeeper.functions.dates import loose_date, published_date, published_year
from lorekeeper.operators.sitemaps import walk
from lorekeeper.streaming import collection as c


def passes(n=12, routes=3, seed=1):
    rng = random.Random(seed)
    return [[{"route_id": f"r{k}", "cursor": i, "processed": rng.randint(0, 20), "accepted": rng.choice([0, 0, 3, 7]), "context": 1, "duplicates": 0, "rejected": rng.randint(0, 3), "errors": rng.choice([0, 1]), "map_candidates": rng.choice([0, 8]), "exhausted": rng.random() < 0.3} for k in range(routes)] for i in range(n)]


def test_cursors_as_ranges():
    rng = random.Random(4)
    for _ in range(200):
        counted, seen = [], set()
        for x in rng.choices(range(12), k=30):
            assert c.with_cursor(counted, x) == (x not in seen)
            seen.add(x)
            assert [x for a, b in counted for x in range(a, b + 1)] == sorted(seen) and all(b + 1 < d for (_, b), (d, _) in zip(counted, counted[1:]))


def land(folder, files, first=0):
    folder.mkdir(exist_ok=True)
    for i, rows in enumerate(files, first):
        (folder / f"{i:04d}.json").write_text("\n".join(map(json.dumps, rows)))


def plainly(files):
    state = {}
    for r in (r for rows in files for r in rows):
        s = state.setdefault(r["route_id"], dict.fromkeys(c.TOTALS, 0) | {"cursor": -1, "productive": False, "exhausted": False, "blocked": False, "passes": 0})
        s["cursor"], s["passes"] = r["cursor"], s["passes"] + 1
        for k in c.TOTALS:
            s[k] += r[k]
        s["last_accepted"], s["latest_acceptance_rate"] = r["accepted"], r["accepted"] / r["processed"] if r["processed"] else 0.0
        if r["accepted"] >= 6 or r["map_candidates"] >= 6:
            s["productive"], s["exhausted"] = True, False
        if r["exhausted"] and not r["accepted"]:
            s["exhausted"] = True
        if r["errors"] and not r["processed"]:
            s["blocked"] = True
    return state


def states(spark, folder):
    return {r["route_id"]: {k: v for k, v in r.asDict().items() if k != "route_id"} for r in c.latest_states(spark, folder).collect()}


def test_stopped_and_resumed_is_one_run(spark, tmp_path):
    files = passes()
    again = files[6:8] + files[:5] + [files[2]] + files[5:6] + files[8:]  # out of order, and a pass that comes again
    land(tmp_path / "half", again[:6])
    stream = lambda name: c.result_stream(spark, str(tmp_path / name), 2)
    c.collect(stream("half"), str(tmp_path / "a"))
    land(tmp_path / "half", again[6:], 6)
    totals = c.collect(stream("half"), str(tmp_path / "a"))
    land(tmp_path / "whole", files)
    assert c.collect(stream("whole"), str(tmp_path / "b")) == totals
    assert states(spark, str(tmp_path / "a")) == states(spark, str(tmp_path / "b")) == plainly(files)
    assert c.collect(stream("half"), str(tmp_path / "a")) == totals  # nothing new


def test_stops_when_targets_are_met(spark, tmp_path):
    files = passes(30)
    land(tmp_path / "in", files)
    stream = lambda: c.result_stream(spark, str(tmp_path / "in"), 1)
    some = c.collect(stream(), str(tmp_path / "out"), {"accepted": 10})
    whole = {k: sum(r[k] for rows in files for r in rows) for k in c.TOTALS}
    assert 10 <= some["accepted"] < whole["accepted"]
    assert c.collect(stream(), str(tmp_path / "out")) == whole and states(spark, str(tmp_path / "out")) == plainly(files)


def queue_walk(files, root, limit):
    seen, queue, pages = [], [root], set()
    while queue and len(seen) < limit:
        url = queue.pop(0)
        if url in seen:
            continue
        seen.append(url)
        for loc in files.get(url, []):
            if not loc.startswith("http"):
                continue
            if loc.endswith(".xml") or "sitemap" in loc.split("://", 1)[1].partition("/")[2].split("?")[0].lower():
                queue.append(loc)
            else:
                pages.add(loc)
    return seen, pages


@pytest.mark.parametrize("limit", [0, 1, 4, 100])
def test_sitemaps_as_by_a_queue(spark, limit):
    rng = random.Random(limit)
    names = [f"https://h{k % 2}.org/m{k}.xml" for k in range(14)] + ["https://h0.org/SiteMap/list"]
    files = {n: [rng.choice([*names, "https://h0.org/missing.xml", "ftp://x/y.xml", "https://sitemap.org/page", f"https://h1.org/p{rng.randrange(30)}"]) for _ in range(rng.randint(0, 6))] for n in names}
    files[names[0]] = [names[0], names[3], names[1], names[3], "https://h1.org/p1", names[14]]
    xml = lambda locs: "<urlset>" + "".join(rng.choice([f"<url><loc> {x}\n</loc></url>", f"<loc><![CDATA[{x}]]></loc>"]) for x in locs) + "</urlset>"
    landed = spark.createDataFrame([(n, xml(locs)) for n, locs in files.items()], "url string, xml string")
    roots = [("a", names[0]), ("b", names[5]), ("c", "https://gone.org/sitemap.xml")]
    visited, pages = walk(landed, spark.createDataFrame(roots, "root string, url string"), limit)
    for root, url in roots:
        seen, found = queue_walk(files, url, limit)
        assert [r.url for r in visited.where(F.col("root") == root).orderBy("place").collect()] == seen
        assert {r.url for r in pages.where(F.col("root") == root).collect()} == found


DATES = {
    "12 March 1897": (1897, 1897, 3, 12, "day"), "c. 1974": (1974, 1974, None, None, "year"), "": None, "no date": None, "1897-03-12": (1897, 1897, 3, 12, "day"), "12/3/1897": (1897, 1897, 3, 12, "day"), "12.03.1897": (1897, 1897, 3, 12, "day"), "31/12/2001": (2001, 2001, 12, 31, "day"),
    "March 12, 1897": (1897, 1897, 3, 12, "day"), "March 12th 1897": (1897, 1897, 3, 12, "day"), "Mar. 12, 1897": (1897, 1897, 3, 12, "day"), "the 1st of May 1900": (1900, 1900, 5, 1, "day"), "Sept 3, 1900": (1900, 1900, 9, 3, "day"), "3rd September, 1900": (1900, 1900, 9, 3, "day"), "2 Jun 1888": (1888, 1888, 6, 2, "day"), "July 4, 2020 edition": (2020, 2020, 7, 4, "day"),
    "March 1897": (1897, 1897, 3, None, "month"), "1897-03": (1897, 1897, 3, None, "month"), "Dec, 1901": (1901, 1901, 12, None, "month"), "in May 1855": (1855, 1855, 5, None, "month"), "2001-12": (2001, 2001, 12, None, "month"),
    "1890-1895": (1890, 1895, None, None, "span"), "1890–1895": (1890, 1895, None, None, "span"), "1890 to 1895": (1890, 1895, None, None, "span"), "between 1890 and 1895": (1890, 1895, None, None, "span"), "from 1890 until 1901": (1890, 1901, None, None, "span"), "1890-95": (1890, 1895, None, None, "span"), "1899/1900": (1899, 1900, None, None, "span"), "1890/91": (1890, 1891, None, None, "span"), "1895-1890": (1895, 1895, None, None, "year"),
    "1890s": (1890, 1899, None, None, "decade"), "the 1890's": (1890, 1899, None, None, "decade"), "early 1890s": (1890, 1893, None, None, "decade"), "mid-1890s": (1894, 1896, None, None, "decade"), "late 1890s": (1897, 1899, None, None, "decade"), "2000s": (2000, 2009, None, None, "decade"), "19th century": (1801, 1900, None, None, "century"), "21st-century tales": (2001, 2100, None, None, "century"), "17th century": None,
    "1897": (1897, 1897, None, None, "year"), "Sydney, 1897.": (1897, 1897, None, None, "year"), "1699": None, "2100": None, "12345": None, "18971": None, "a1897b": (1897, 1897, None, None, "year"), "marched in 1897": (1897, 1897, None, None, "year"), "45/3/1897": (1897, 1897, None, None, "year"), "1897-13-01": (1897, 1897, None, None, "year"), "32 March 1897": (1897, 1897, 3, None, "month"), "decembrist 1825": (1825, 1825, None, None, "year"),
    "ca. 1890s": (1890, 1899, None, None, "decade"), "1897?": (1897, 1897, None, None, "year"), "about March 1897": (1897, 1897, 3, None, "month"),
}


def test_loose_dates(spark):
    df = spark.createDataFrame([(t,) for t in DATES] + [(None,)], "t string").select("t", loose_date(F.col("t")).alias("d"))
    got = {r.t: r.d for r in df.collect()}
    assert {t: d and tuple(d)[:5] for t, d in got.items() if t is not None} == DATES and got[None] is None and len(DATES) >= 53
    assert [t for t, d in got.items() if d and d.approximate] == ["c. 1974", "ca. 1890s", "1897?", "about March 1897"]


def test_date_parts(spark):
    items = [
        ({"issued": {"date-parts": [[1999, 3, 2]]}}, 1999, "1999-3-2"), ({"published-print": {"date-parts": [[1700]]}, "issued": {"date-parts": [[1850, 1]]}}, 1850, "1700"), ({"published-online": {"date-parts": []}, "created": {"date-parts": [["2001", None]]}}, 2001, "2001"),
        ({"published": {"date-parts": [[None]]}, "issued": {"date-parts": [["x"]]}}, None, "x"), ({}, None, None), ({"issued": None}, None, None), ({"published-print": {"date-parts": [[2026, 12]]}, "published-online": {"date-parts": [[1900]]}}, 2026, "2026-12"), ({"issued": {"date-parts": [[2027]]}}, None, "2027"),
    ]
    df = spark.createDataFrame([(json.dumps(x),) for x, _, _ in items], "j string").select(published_year(F.col("j")).alias("y"), published_date(F.col("j")).alias("d"))
    assert [tuple(r) for r in df.collect()] == [(y, d) for _, y, d in items]
