"""Url filter, licences, sharding, top-k search and the pipeline's edges."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import licenses, sharding, topk, url_filter
from tideline.llm.queries import URL_RULES

URLS = [
    (1, "http://A.Example.com/en/700?x=1"), (2, "https://example.com/en/6"), (3, "http://x.net/de/1#a"), (4, "http://b.example.net/de/88"),
    (5, "http://notexample.net/de/8"), (6, None), (7, ""), (8, "no scheme/en/"), (9, "http://"), (10, "ftp://h.org/es/?q"), (11, "http://h.org/es"),
    (12, "http://x.com?u=http://y.net/de/"), (13, "http://ÄB.com/en/"), (3, "http://x.net/de/1#a"), (None, "http://q.io/"), (14, "http://1.2.3.4/x\ny"),
]


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    stop = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:stop]


def brute_rule(host, path):
    best = None
    for rule, what in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[0]):
                best = (rule, what)
    return best or (None, None)


def test_hosts_paths_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS rule", "3 AS n", "4 AS bad")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = url_filter.judge(pages, none, URL_RULES).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = brute_host_path(r["url"])
        rule, what = brute_rule(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, what or "allow")
    assert url_filter.judge(pages.limit(0), none, URL_RULES).count() == 0


def brute_reputation(pairs):
    def add(key, items):
        out = defaultdict(lambda: [0.0, 0.0])
        for k, (n, y) in items:
            out[key(k)][0] += n
            out[key(k)][1] += y
        return out

    hosts = add(lambda h: h, ((h, (1, b)) for h, b in pairs))
    domain = lambda h: ".".join(h.split(".")[-2:])
    domains = add(domain, hosts.items())
    suffixes = add(lambda d: d.split(".")[-1], domains.items())

    def level(groups, prior):
        extra = sum((y - n * prior(g)) ** 2 - n * prior(g) * (1 - prior(g)) for g, (n, y) in groups.items())
        room = sum(n * prior(g) * (1 - prior(g)) * (n - 1) for g, (n, _) in groups.items())
        rho = max(extra / room, 1e-9) if room > 0 else 1.0
        m = min(max(1 / rho - 1, 1.0), 1000.0)
        return m, {g: (prior(g) * m + y) / (m + n) for g, (n, y) in groups.items()}

    n, y = sum(v[0] for v in suffixes.values()), sum(v[1] for v in suffixes.values())
    _, ps = level(suffixes, lambda _: (y + 1) / (n + 2))
    _, pd = level(domains, lambda d: ps[d.split(".")[-1]])
    m, ph = level(hosts, lambda h: pd[domain(h)])
    return {h: (ph[h], max(ph[h] - 1.645 * math.sqrt(ph[h] * (1 - ph[h]) / (m + hosts[h][0] + 1)), 0)) for h in hosts}


def test_long_and_hot_urls(spark):
    """Urls of megabytes, and a host that nearly all pages have, which is joined without moving its pages."""
    tail = "a/" * 1_000_000
    rows = [(k, "http://hot.com/x") for k in range(700)] + [(1000, f"http://b.example.net/de/8{tail}?{tail}"), (1001, "h" * 2_000_000 + "://x.net/de/1")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    outcomes = spark.createDataFrame([(k, 1) for k in range(0, 700, 2)] + [(1001, 0)], "page_id long, bad int")
    got = {r["page_id"]: r for r in url_filter.judge(pages, outcomes, URL_RULES).collect()}
    assert len(got) == len(rows) and {got[k]["verdict"] for k in range(700)} == {"block"}
    assert (got[1000]["path"], got[1000]["rule"]) == (f"/de/8{tail}", "example.net/de/8") and got[1001]["rule"] == "net/de/"


def test_reputation(spark):
    rng = np.random.default_rng(0)
    pairs = []
    for d in range(12):
        rate = rng.beta(0.5, 1.5)
        for h in range(5):
            own = min(max(rate + rng.normal() * 0.2, 0), 1)
            pairs += [(f"h{h}.d{d}.{'com' if d % 2 else 'net'}", int(rng.random() < own)) for _ in range(int(rng.integers(1, 40)))]
    pairs += [("spam.bad.com", 1)] * 300 + [("one.bad.com", 1)]
    want = brute_reputation(pairs)
    got = {r["host"]: r for r in url_filter.host_reputation(spark.createDataFrame(pairs, "host string, bad int")).collect()}
    assert set(got) == set(want)
    for h, (mean, low) in want.items():
        assert got[h]["posterior_mean"] == pytest.approx(mean) and got[h]["posterior_low"] == pytest.approx(low)
    pages = spark.createDataFrame([(k, f"http://{h}/p") for k, (h, _) in enumerate(pairs)], "page_id long, url string")
    outcomes = spark.createDataFrame([(k, b) for k, (_, b) in enumerate(pairs)], "page_id long, bad int")
    verdict = {r["host"]: r["verdict"] for r in url_filter.judge(pages, outcomes).collect()}
    assert verdict["spam.bad.com"] == "block"
    assert all(verdict[h] == ("block" if low > 0.5 else "allow") for h, (_, low) in want.items())


# ---------------------------------------------------------------- licences

LICENCE_TEXTS = {
    "Intro. Released under the MIT License.": (["MIT"], []),
    "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License.": (["Apache-2.0"], []),
    "Licensed under the Apache License, Version 2.0. Released under the MIT License": (["Apache-2.0", "MIT"], []),
    "This work is licensed under the GNU General Public License, version 3.": (["GPL-3.0-only"], []),
    "Licensed under CC BY-NC 4.0.": (["CC-BY-NC-4.0"], []),
    "This has a strange license of its own.": ([], ["UNKNOWN"]),
    "Nothing here.": ([], []),
    "": ([], []),
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": ([], ["BSDSource"]),
    "word " * 30000 + ". Released under the MIT license.": (["MIT"], []),
}


WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}


@pytest.mark.parametrize("mark", ["", "# ", "// ", " * ", ";; ", "-- "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_licences(spark, mark, end):
    """Texts as they are distributed: wrapped lines, in comments, with either line end, prose around them."""
    rows = [(name, end.join(mark + line for line in ["Some file.", "", *text.split("\n"), "", "More prose"])) for name, text in WRAPPED.items()]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    for name in WRAPPED:
        assert got[name]["licences"] == [name], (mark, got[name])
    assert got["GPL-3.0-or-later"]["unmatched_sentences"] == got["Apache-2.0"]["unmatched_sentences"] == []


def brute_rules(ids):
    """Rules in order; a match leaves a wall behind, so its neighbours stay apart."""
    seq, found = list(ids), []
    for licence, parts in licenses.RULES:
        at = 0
        while at + len(parts) <= len(seq):
            if tuple(seq[at : at + len(parts)]) == parts:
                seq[at : at + len(parts)] = [None]
                if licence not in found:
                    found.append(licence)
            at += 1
    return found, [x for x in seq if x is not None]


def test_rules_against_brute_force(spark):
    rng = np.random.default_rng(1)
    names = ["MITGrant", "MITNotice", "AsIs", "BSDRedist", "BSDSource", "BSDBinary", "ApacheRef", "ApacheNoUse", "UNKNOWN", "GPLFree", "GPLWithout", "GPLImplied"]
    rows = [["BSDRedist", "MITGrant", "MITNotice", "AsIs", "BSDSource", "BSDBinary"], [], ["MITGrant"] * 3]
    rows += [[names[i] for i in rng.integers(0, len(names), int(rng.integers(1, 12)))] for _ in range(300)]
    rows += [[n for k in rng.integers(0, len(licenses.RULES), 3) for n in licenses.RULES[k][1]] for _ in range(100)]
    df = spark.createDataFrame([(r,) for r in rows], "ids array<string>")
    licences, rest = licenses.match_rules(F.col("ids"), licenses.RULES)
    for r in df.select("ids", licences.alias("licences"), rest.alias("rest")).collect():
        assert (r["licences"], r["rest"]) == brute_rules(r["ids"]), r["ids"]
    assert brute_rules(rows[0]) == (["MIT"], ["BSDRedist", "BSDSource", "BSDBinary"])


def test_licences_agree_with_sql(spark, tmp_path):
    """Odd texts in both engines: wrapped, commented, cut, with marks and controls."""
    import duckdb

    from tideline.llm.queries import ORACLES, QUERIES

    rng = np.random.default_rng(2)
    lines = [x for t in WRAPPED.values() for x in t.split("\n")] + ["Released under the MIT License.", "see v. 3 license", "# x;", "\x01\x02 license \x0b", "é licensé", "", "a;\tb license:", "(1) mit license"]
    rows = [(k, "\n".join(lines[i] for i in rng.integers(0, len(lines), int(rng.integers(1, 25))))) for k in range(400)]
    rows += [(500 + k, t) for k, t in enumerate(WRAPPED.values())] + [(600, None), (601, ""), (602, "\n"), (None, "mit license"), (603, "mit license\r\nx")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = QUERIES["op7_license_scan"](spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(ORACLES["op7_license_scan"]).fetchall()))


def test_licences(spark):
    rows = [(k, t) for k, t in enumerate(LICENCE_TEXTS)] + [(99, None), (0, next(iter(LICENCE_TEXTS)))]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS licences")).collect()
    assert len(got) == len(rows)
    for r in got:
        licences, rest = LICENCE_TEXTS.get(r["text"], ([], []))
        assert (r["licences"], r["unmatched_sentences"]) == (licences, rest), r["text"]
    assert licenses.scan(spark.createDataFrame([], "text string")).count() == 0


# ---------------------------------------------------------------- sharding


def shard_all(spark, rows, shards, **kw):
    df = spark.createDataFrame(rows, "doc_id long, size long").selectExpr("*", "7 AS shard", "'a' AS slot")
    out = sharding.shard(df, F.col("size"), shards, **kw).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in out) == sorted((str(i), s) for i, s in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    sizes = [0] * shards
    for r in out:
        sizes[r["shard"]] += r["size"]
    return sizes


def test_shards_are_even(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(s)) for i, s in enumerate(rng.lognormal(7, 1.2, 6000) + 16)]
    sizes = shard_all(spark, rows, 8)
    mean = sum(sizes) / 8
    assert max(sizes) - min(sizes) <= 2 * (0.001 * mean + max(s for _, s in rows))
    again = shard_all(spark, rows, 8, range_rows=100)
    assert again == sizes or max(again) - min(again) <= 2 * (0.001 * mean + max(s for _, s in rows))


def brute_cuts(rows, shards, tolerance):
    """The number of rows left of each boundary, found by walking down the sorted rows a radix digit at a time."""
    total, out = sum(s for _, s in rows), []
    ordered = sorted((k % 2**64, s) for k, s in rows)
    for c in range(1, shards):
        target, low, width = c / shards * total, 0, 2**64
        while True:
            left = sum(s for k, s in ordered if k < low)
            step = max(1, width >> sharding.RADIX_BITS)
            inside = [(k, s) for k, s in ordered if low <= k < low + width]
            at = left
            for start in sorted({(k - low) // step * step + low for k, _ in inside}):
                held = sum(s for k, s in inside if start <= k < start + step)
                if target <= at + held:
                    break
                at += held
            if target - at <= tolerance and target - at <= at + held - target:
                out.append(sum(k < start for k, _ in ordered))
            elif at + held - target <= tolerance or step == 1:
                out.append(sum(k < (start if target - at <= at + held - target else start + step) for k, _ in ordered))
            else:
                low, width = start, step
                continue
            break
    return out


@pytest.mark.parametrize("seed", range(3))
def test_splitters_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    keys = rng.integers(-(2**63), 2**63, 500) if seed else rng.integers(0, 40, 500)
    rows = [(int(k), int(s)) for k, s in zip(keys, rng.lognormal(5, 1.5, 500) + 16)]
    df = spark.createDataFrame(rows, "doc_id long, size long")
    got = sharding.shard(df, F.col("size"), 7, key=F.col("doc_id")).collect()
    counts = [0] * 7
    for r in got:
        counts[r["shard"]] += 1
    want = [0, *brute_cuts(rows, 7, 0.001 * sum(s for _, s in rows) / 7), 500]
    assert counts == [b - a for a, b in zip(want, want[1:])]
    # Inside a shard, slots follow the unsigned key.
    for n in range(7):
        slots = sorted((r["slot"], r["doc_id"] % 2**64) for r in got if r["shard"] == n)
        assert [k for _, k in slots] == sorted(k for _, k in slots)


def test_rows_without_an_id_spread(spark):
    """A third of all rows without an id, a third with one id: what else they hold tells them apart."""
    rows = [(None, 100, f"t{k}") for k in range(400)] + [(7, 100, f"u{k}") for k in range(400)] + [(k, 100, "same") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, size long, text string")
    counts = [r["count"] for r in sharding.shard(df, F.col("size"), 4).groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 2


def test_op5_balance(spark):
    """The query over a whole table: sizes, checksums, slots and the law, by plain Python."""
    import zlib

    from tideline.llm.queries import QUERIES, SHARDS

    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op5_histogram_shards"](spark, sf).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {d: (len(t) + 16, zlib.crc32(t)) for d, t in texts.items()}
    load, slots = [0] * SHARDS, defaultdict(list)
    for r in rows:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    largest, mean = max(r["size"] for r in rows), sum(load) / SHARDS
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load) - mean <= largest + 0.002 * mean


@pytest.mark.parametrize(
    "rows",
    [[], [(1, 16)], [(1, 16), (2, 100_000), (3, 16)], [(5, 20)] * 50, [(None, 16), (None, 17), (1, 18)], [(i, 0) for i in range(9)]],
)
def test_shard_edges(spark, rows):
    shard_all(spark, rows, 4)


def test_skewed_keys(spark):
    """Keys that share nearly all leading bits still split evenly."""
    df = spark.createDataFrame([(i, 100) for i in range(2000)], "doc_id long, size long")
    out = sharding.shard(df, F.col("size"), 10, key=F.col("doc_id")).groupBy("shard").count().collect()
    assert [r["count"] for r in out] == [200] * 10


# ---------------------------------------------------------------- top-k


def brute_topk(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, vq in sorted({i: v for i, v in ok if i % every == 0}.items()):
        best = sorted((-sum(a * b for a, b in zip(vq, v)), i) for i, v in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("kw", [{}, {"pivots": 3, "block_queries": 2, "slice_rows": 7}])
def test_topk(spark, kw):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=3) + 3 * (i % 4))]) for i in range(120)]
    rows += [(200, None), (205, [1.0, None, 2.0]), (210, [float("nan"), 0.0, 0.0]), (215, [float("inf"), 0.0, 0.0]), (220, []), (225, [1.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(230, [0.0, 0.0, 0.0]), (231, [5.0, 5.0, 5.0]), (232, [5.0, 5.0, 5.0]), (233, [3e9, -2e9, 1e9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS block", "2 AS cell")
    got = topk.search(df, F.col("id") % 5 == 0, **kw).collect()
    assert sorted(map(tuple, got)) == brute_topk(rows, 5, 5)


def test_topk_refuses_what_does_not_fit(spark):
    rows = spark.createDataFrame([(0, [4e9, 1.0]), (1, [4e9, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk.search(rows, F.col("id") % 5 == 0).collect()


def test_topk_dimensions(spark):
    """Shorter vectors count as filled with zeros, empty ones too."""
    rows = [(0, [1.0, 2.0, 3.0]), (1, [5.0]), (2, []), (3, [-1.0, 1.0]), (5, [2.0]), (10, [])]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 5 == 0).collect()
    assert sorted(map(tuple, got)) == brute_topk(rows, 5, 5)
    none = spark.createDataFrame([(0, []), (1, [])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.search(none, F.col("id") % 5 == 0).collect()] == [(0, 1, 1, 0)]


def test_topk_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.search(spark.createDataFrame([], schema), F.col("id") % 5 == 0).count() == 0
    assert topk.search(spark.createDataFrame([(0, [1.0])], schema), F.col("id") % 5 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (7, [2.0])], schema)
    assert [tuple(r) for r in topk.search(two, F.col("id") % 5 == 0).collect()] == [(0, 1, 7, 256 * 512)]

