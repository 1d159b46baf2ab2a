"""Licences, url verdicts, classifier, decontamination and mixing."""

import math
import random
from collections import Counter
from fractions import Fraction

import brute
import numpy as np
import pyarrow as pa
import pytest
from odd_rows import frame

from tillhouse.llm import decontaminate, licences, ordinal, pfair, url_filter
from tillhouse.llm.queries import TARGETS

SF = "/root/testdata/sf0.01"


def bigrams(text):
    words = brute.plain_words(text)
    return list(zip(words, words[1:]))


def claims_of(text):
    """``dice, bigrams, first, words, template`` of the best passage from every word, for every template that has one there."""
    pairs, out = bigrams(text), []
    for t, (_, template, *must) in enumerate(licences.TEMPLATES):
        own, marks = bigrams(template), {p for phrase in (must[0] if must else ()) for p in bigrams(phrase)}
        if not marks <= set(pairs):
            continue
        for a in range(len(pairs)):
            if pairs[a] not in own:
                continue
            left, common, best = Counter(own), 0, (0.0, 0)
            for b in range(a, min(len(pairs), a + 2 * len(own))):
                if left[pairs[b]] > 0:
                    left[pairs[b]] -= 1
                    common += 1
                dice = 2 * common / (b - a + 1 + len(own))
                if dice > best[0] and pairs[b] in own and marks <= set(pairs[a : b + 1]):
                    best = (dice, b - a + 2)
            if best[0] >= licences.THRESHOLD:
                out.append((best[0], len(own), a, best[1], t))
    return out


def licences_by_hand(text):
    meet = lambda x, y: x[2] < y[2] + y[3] and y[2] < x[2] + x[3]

    def apart(claims):
        stay = []
        for x in sorted(claims, key=lambda x: (-x[0], -x[1], *x[2:])):
            if not any(meet(x, y) for y in stay):
                stay.append(x)
        return stay

    def inside(t, u):
        (a, x, *_), (b, y, *_) = licences.TEMPLATES[t], licences.TEMPLATES[u]
        own, other = Counter(bigrams(x)), Counter(bigrams(y))
        return a != b and sum((own & other).values()) >= 0.9 * own.total() and own.total() <= 0.9 * other.total()

    every = claims_of(text)
    used = {x[4] for x in every}
    claims = [x for t in used for x in apart([x for x in every if x[4] == t])]
    parts = {(t, u) for t in used for u in used if inside(t, u)}
    stay = apart([x for x in claims if not any((x[4], y[4]) in parts and meet(x, y) for y in claims)])
    best = {}
    for x in stay:
        name = licences.TEMPLATES[x[4]][0]
        best[name] = max(best.get(name, 0), x[0])
    return best


def found(spark, rows):
    return {r["doc_id"]: {x["licence"]: x["dice"] for x in r["licences"]} for r in licences.scan_licences(frame(spark, rows)).collect()}


def test_licences_match_brute_force(spark, awkward, nothing):
    rng = random.Random(3)
    rows = []
    for i, (_, text, *_) in enumerate(licences.TEMPLATES):
        words = text.split()
        if len(words) > 110 and i % 3:  # the longest are slow by hand
            continue
        noise = [rng.choice(["the", "of", "license", "under", "alpha", "this"]) for _ in range(12)]
        rows.append((i, " ".join(noise + words + noise)))
        rows.append((1000 + i, "\n".join(w if rng.random() > 0.06 else "changed" for w in words)))
        rows.append((2000 + i, " ".join(words[: len(words) // 2])))
        other = rng.choice(licences.TEMPLATES)[1].split()
        rows.append((3000 + i, " ".join((words[: rng.randrange(4, 60)] + other[-40:] + words[:40])[:110])))
    got = found(spark, rows)
    for i, text in rows:
        assert got[i] == pytest.approx(licences_by_hand(text)), (i, text)
    assert all(not r["licences"] for r in licences.scan_licences(awkward).collect())
    assert licences.licence_report(nothing).collect() == []


GNU = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software \
Foundation; either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be \
useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {0} for more details."
FULL = {n: max((t[1] for t in licences.TEMPLATES if t[0] == n), key=len) for n in ("0BSD", "BSD-2-Clause", "BSD-3-Clause", "ISC", "JSON", "MIT", "MIT-0")}
NAMED = [
    ("GPL-2.0", GNU.format("General Public License", "2")), ("GPL-3.0", GNU.format("General Public License", "3")),
    ("LGPL-2.1", GNU.format("Lesser General Public License", "2.1").replace("program", "library")),
    ("LGPL-3.0", GNU.format("Lesser General Public License", "3")), ("AGPL-3.0", GNU.format("Affero General Public License", "3")),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "this work is licensed under the GNU General Public License, Version 3!"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("GPL-2.0", "GNU General Public License v2.0"), ("LGPL-2.1", "GNU Lesser General Public License v2.1"), ("AGPL-3.0", "Licensed under the AGPLv3"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-2.5", "This work is licensed under a Creative Commons Attribution 2.5 Generic License."),
    ("CC-BY-SA-3.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"), ("CC-BY-SA-2.0", "licensed under CC BY-SA 2.0"), ("CC0-1.0", "Licensed under CC0 1.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"), ("MIT", "Released under the MIT License"),
    *FULL.items(),
    *[(name, text.replace("software", "program", 1)) for name, text in FULL.items()],  # a word of the first clause edited
]


def test_licences_have_their_own_names(spark):
    """Neighbours are told apart; texts of none of them have no name."""
    got = found(spark, [(i, f"Some words before it. {text} And some after it.") for i, (_, text) in enumerate(NAMED)])
    assert [(set(got[i]), text) for i, (_, text) in enumerate(NAMED)] == [({name}, text) for name, text in NAMED]
    other = [
        "Licensed under the Apache License, Version 1.1", "This work is licensed under the GNU General Public License, version 1",
        "This work is licensed under a Creative Commons Attribution 1.0 International License", "Licensed under the Eclipse Public License, Version 2.0",
        "Released under the Zlib License", "Licensed under CC BY-XX 4.0",
    ]
    assert found(spark, list(enumerate(other))) == {i: {} for i in range(len(other))}


def test_each_of_several_licences_is_found(spark):
    text = " ... ".join([FULL["BSD-3-Clause"], FULL["BSD-2-Clause"], NAMED[0][1], NAMED[1][1], FULL["MIT"]])
    assert set(found(spark, [(1, text)])[1]) == {"BSD-3-Clause", "BSD-2-Clause", "GPL-2.0", "GPL-3.0", "MIT"}


def test_url_rules_and_propagation(spark):
    link = lambda *hosts: "".join(f'<p><a class=x href="https://{h}/p">x</a>' for h in hosts)
    pages = [
        (1, "HTTP://WWW.Example.com/en/a?x", None), (2, "http://a.example.com/en/", ""), (3, "http://b.com/x", link("friend.org")), (4, "http://n.net/es/1", None),
        (5, "http://friend.org/p", link("far.org")), (6, "http://far.org", '<a href="/in">y</a>'), (7, "http://farm.org/", link("n.net", "n.net")),
        (8, "http://quiet.org?u#v", None), (9, None, None), (10, "no scheme", None), (10, "no scheme", None), (11, "ftp://example.com#/en/", None), (12, "http://N.NET/ES/1", None),
        (13, "http://n.net/fr/x", None), (14, "http://feeder.org/", link("farm.org")), (15, "http://xcom/en", None),
    ]
    docs = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    rows = url_filter.judge_pages(docs, ["com/", "www.example.com/en/"], ["example.com/en/", "net/es/", "net/fr/"])
    got = {(r["page_id"], r["host"], r["path"]): (r["rule"], r["verdict"]) for r in rows.collect()}
    assert rows.count() == len(pages)
    assert got[1, "www.example.com", "/en/a"] == ("www.example.com/en/", "allow")
    assert got[2, "a.example.com", "/en/"] == ("example.com/en/", "block")
    assert got[4, "n.net", "/es/1"] == ("net/es/", "block")
    assert got[12, "n.net", "/ES/1"][0] is None and got[12, "n.net", "/ES/1"][1] == "block"  # two thirds of the host are blocked
    assert got[5, "friend.org", "/p"] == (None, "allow") and got[6, "far.org", ""] == (None, "allow")
    assert got[7, "farm.org", "/"] == (None, "block")  # links to a blocked host
    assert got[8, "quiet.org", ""] == (None, "allow")
    assert got[9, "", ""] == got[10, "", ""] == (None, "allow")
    assert got[11, "example.com", ""][0] is None
    ranks = {r["host"]: r for r in rows.collect()}
    assert ranks["far.org"]["trust"] == pytest.approx(0.85 ** 2) and ranks["farm.org"]["distrust"] == pytest.approx(0.85 * 2 / 3)
    assert ranks["feeder.org"]["distrust"] == pytest.approx(0.85 ** 2 * 2 / 3)
    assert url_filter.judge_pages(docs.where("false"), ["com/"], ["net/"]).collect() == []
    assert url_filter.judge_pages(docs, [], []).where("verdict = 'block'").count() == 0


def test_propagation_goes_on_until_ranks_settle(spark):
    """Long chains and a ring, against the exact solution of the linear equations."""
    links = [(f"h{k}", f"h{k + 1}", 1) for k in range(45)] + [("r0", "r1", 2), ("r1", "r2", 1), ("r2", "r0", 1), ("r0", "h0", 1)]
    hosts = sorted({h for a, b, _ in links for h in (a, b)})
    trust, distrust = {"h0": 1.0, "r1": 0.5}, {"h45": 1.0, "r2": 0.25}
    seeds = spark.createDataFrame([(h, trust.get(h, 0.0), distrust.get(h, 0.0)) for h in hosts], "host string, trust double, distrust double")
    edges = spark.createDataFrame(links, "src string, dst string, links long")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.propagate(seeds, edges).collect()}
    place = {h: i for i, h in enumerate(hosts)}
    for side, seed, arcs in ((0, trust, links), (1, distrust, [(b, a, n) for a, b, n in links])):
        flow = np.zeros((len(hosts), len(hosts)))
        for a, b, n in arcs:
            flow[place[b], place[a]] = n / sum(m for x, _, m in arcs if x == a)
        exact = np.linalg.solve(np.eye(len(hosts)) - 0.85 * flow, [seed.get(h, 0.0) for h in hosts])
        assert max(abs(got.get(h, (0.0, 0.0))[side] - exact[place[h]]) for h in hosts) < 5e-6
    assert got["h40"][0] > 0 and got["h1"][1] > 0  # more than twenty links away
    assert url_filter.propagate(seeds.where("false"), edges).collect() == []


def test_classifier_on_held_out_documents(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rated = ordinal.ratings(labels)
    model = ordinal.train(docs, labels.where("doc_id % 3 <> 0"))
    held = ordinal.grade(docs, model).join(rated.where("doc_id % 3 = 0"), "doc_id").select("grade", "kept", "expected_grade", "p_good", "p_low_or_better").toPandas()
    assert held[held.grade == 2].kept.mean() > 0.98
    assert held[held.grade == 0].kept.mean() < 0.15 and held[held.grade == 1].kept.mean() < 0.2
    means = held.groupby("grade").expected_grade.mean()
    assert means[0] < means[1] < means[2] and (held.p_good <= held.p_low_or_better).all()


def test_classifier_on_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1, 0, "x"), (4, 0, 0, "x"), (5, 1, None, "x"), (6, None, 1, "x"), (7, None, 0, "x"), (None, 1, 0, "x"), (99, 1, 0, "x")], "doc_id long, quality int, toxic int, score string")
    assert {tuple(r) for r in ordinal.ratings(labels).collect()} == {(4, 1), (5, 2), (6, 0), (99, 2)}
    model = ordinal.train(awkward, labels)
    assert ordinal.grade(awkward, model).count() == awkward.count()
    assert ordinal.kept(awkward, model).columns == awkward.columns
    unknown = ordinal.train(awkward, labels.where("false"))
    assert ordinal.kept(awkward, unknown).count() == awkward.count()
    assert ordinal.grade(nothing, model).collect() == [] and ordinal.kept(nothing, model).collect() == []
    assert ordinal.train(nothing, labels).thresholds == [-np.inf, -np.inf]


def test_features_are_made_of_few_texts_at_once():
    texts = pa.array([f"Word{i} and, more! of it {i % 7} " * 4000 for i in range(100)] + [None, ""])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    runs = list(ordinal.parts(batch))
    assert len(runs) > 2 and all(run.num_rows == 1 or sum(map(len, run.column("text").drop_null().to_pylist())) <= 4 << 20 for run in runs)
    rows, places = ordinal.features(ordinal.whole(texts))
    together, start = [], 0
    for run in runs:
        r, p = ordinal.features(ordinal.whole(run.column("text")))
        together += zip((r + start).tolist(), p.tolist())
        start += run.num_rows
    assert together == list(zip(rows.tolist(), places.tolist()))


def test_gradient_of_the_ordinal_loss():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 400)
    rows = [np.unique(rng.integers(0, 6, 3) + 10 * grades[i]) for i in range(400)]
    model = ordinal.fit(np.cumsum([len(r) for r in rows]), np.concatenate(rows), grades, penalty=0.0)
    scores = np.array([model.weights[r].sum() for r in rows])
    assert model.thresholds[0] < model.thresholds[1]
    assert (np.searchsorted(model.thresholds, scores) == grades).mean() > 0.95


def leaks_by_force(docs, items, threshold):
    found = {}
    for doc, text in docs:
        w = brute.plain_words(text)
        for item, t in items:
            v = brute.plain_words(t)
            score = brute.local_score(w, v) if len(v) >= 3 and len(w) >= 3 else 0
            if score >= threshold:
                found[doc, item] = score
    return found


def test_leaks_match_brute_force(spark):
    rng = random.Random(9)
    items = [(i, " ".join(f"i{rng.randrange(60)}" for _ in range(rng.randrange(12, 30)))) for i in range(12)] + [(50, "too short"), (51, None), (None, "i1 i2 i3 i4")]
    docs = []
    for d in range(60):
        body = [f"i{rng.randrange(60)}" if rng.random() < 0.3 else f"d{rng.randrange(500)}" for _ in range(80)]
        if d % 2:
            copy = items[rng.randrange(12)][1].split()
            for _ in range(d % 5):
                k = rng.randrange(len(copy))
                copy[k:k + 1] = rng.choice([[], ["new"], [copy[k], "added"]])
            body[20:20] = [w.upper() + "," for w in copy]
        docs.append((d, " ".join(body)))
    want = leaks_by_force(docs, [(i, t) for i, t in items if i is not None and t is not None], 0.5)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.find_leaks(frame(spark, docs), bench).collect()}
    assert {k: v for k, v in want.items() if v >= 0.6} == pytest.approx({k: v for k, v in got.items() if v >= 0.6})
    assert set(got) <= set(want) and len(got) >= 25
    clean = decontaminate.without_leaks(frame(spark, docs), bench)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_edited_leaks_match_brute_force_at_the_threshold(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(120)}" for _ in range(rng.randrange(15, 40)))) for i in range(24)]
    docs = []
    for i, text in items:  # no item stands anywhere as it is: every k-th word is another, one too many, or missing
        k = 3 + i % 4
        edits = [lambda w: ["new"], lambda w: [w, "new"], lambda w: []][i % 3]
        words = [x for j, w in enumerate(text.split()) for x in (edits(w) if j % k == k - 1 else [w])]
        body = [f"w{rng.randrange(120)}" if rng.random() < 0.5 else "other" for _ in range(60)]
        docs.append((i, " ".join(body[:30] + words + body[30:])))
    spread = items[1][1].split()
    docs.append((100, " ".join(x for w in spread for x in (w, "new"))))  # no two words of the item together, score 0.5
    want = leaks_by_force(docs, items, 0.5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    copies = [(1000 * c + 1, docs[1][1]) for c in range(1, 2001)]  # as often as this, no word of the item is rare
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.find_leaks(frame(spark, docs + copies), bench).collect()}
    assert {k: v for k, v in got.items() if k[0] < 1000} == pytest.approx(want) and len(want) >= 24 and (100, 1) in want
    assert all((d, 1) in got for d, _ in copies)
    assert decontaminate.without_leaks(frame(spark, docs + copies), bench).count() == len(docs) - len({d for d, _ in want})


def test_parts_of_items_are_found(spark):
    """Heads, tails and middles of the given items, down to the threshold, as the only leak of their item."""
    import pyarrow as pa

    rows = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    items = decontaminate.Items.of(rows)
    frequency = np.ones(len(items.vocabulary), np.int64)
    seeds = items.seeds(frequency, 0.5)
    names = np.array(items.vocabulary.to_pylist(), object)
    filler = " ".join(f"filler{i}" for i in range(60))
    lost = tried = 0
    for share in (0.5, 0.55, 0.6, 0.65, 0.7):
        texts, whose = [], []
        for k, words in enumerate(items.words):
            n = max(1, math.ceil(share * len(words)))
            for lo in (0, len(words) - n, (len(words) - n) // 2):
                texts.append(f"{filler} {' '.join(names[words[lo:lo + n]])} {filler}")
                whose.append(k)
        found = {(h[0], h[1]) for h in items.hits(pa.array(texts), seeds, 0.5)}
        tried += len(texts)
        lost += sum((i, k) not in found for i, k in enumerate(whose) if len(items.words[k]) >= decontaminate.N)
    assert lost == 0 and tried >= 3000


def test_most_matched_counts_a_word_as_often_as_the_item_has_it(monkeypatch):
    rng = random.Random(3)
    for _ in range(300):
        own = np.array([rng.choice([0, 0, 1, 1, 2, 3]) for _ in range(8)] + [0])
        text = np.array([rng.choice([-1, *range(8)]) for _ in range(rng.randrange(1, 60))])
        span = rng.randrange(1, 25)
        monkeypatch.setattr(decontaminate, "WINDOWS", rng.choice([1, 3, 256]))
        windows = [text[a:a + min(span, len(text))] for a in range(len(text) - min(span, len(text)) + 1)]
        want = max(sum(min(int((w == k).sum()), int(own[k])) for k in range(8)) for w in windows)
        assert decontaminate.most_matched(text, own, span) == want


def test_random_edits_and_cuts_match_brute_force():
    """2,000 passages with words replaced, put in, left out and cut off at the ends; none that scores 0.5 is lost."""
    import pyarrow as pa

    rng = random.Random(12)
    rows = [(i, " ".join(f"w{rng.randrange(90)}" for _ in range(rng.randrange(4, 26)))) for i in range(20)]
    items = decontaminate.Items.of(rows)
    seeds = items.seeds(np.array([rng.randrange(1, 50) for _ in range(len(items.vocabulary))]), 0.5)
    hits = 0
    texts, whose = [], []
    for _ in range(2000):
        k = rng.randrange(len(rows))
        words = rows[k][1].split()
        a = rng.randrange(len(words) // 3 + 1)
        words = words[a:len(words) - rng.randrange(len(words) // 3 + 1)]
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[], ["new"], [words[at], "new"], [words[at], f"w{rng.randrange(90)}"]]) if len(words) > 1 else words[at:at + 1]
        body = [f"w{rng.randrange(90)}" if rng.random() < 0.2 else "other" for _ in range(12)]
        texts.append(" ".join(body[:6] + words + body[6:]))
        whose.append(k)
    found = {(h[0], h[1]): h[2] for h in items.hits(pa.array(texts), seeds, 0.5)}
    for i, (text, k) in enumerate(zip(texts, whose)):
        score = brute.local_score(text.split(), rows[k][1].split())
        if score >= 0.5:
            hits += 1
            assert found.get((i, k)) == pytest.approx(score)
        else:
            assert (i, k) not in found
    assert 800 < hits < 2000


def test_passages_across_cuts_are_found(monkeypatch):
    import pyarrow as pa

    rng = random.Random(5)
    items = decontaminate.Items.of([(i, " ".join(f"w{rng.randrange(40)}" for _ in range(12))) for i in range(6)])
    texts = pa.array([" ".join(f"w{rng.randrange(40)}" for _ in range(50)) + " " + " ".join(np.array(items.vocabulary)[items.words[i % 6]]) for i in range(30)])
    seeds = items.seeds(np.ones(len(items.vocabulary), np.int64), 0.4)
    whole = items.hits(texts, seeds, 0.4)
    monkeypatch.setattr(decontaminate, "PAIRS", 7)
    assert items.hits(texts, seeds, 0.4) == whole and len(whole) >= 30


def test_no_leak_of_the_given_tables_is_lost(spark):
    docs, bench = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.find_leaks(docs, bench).collect()}
    items = [decontaminate.Items.of([(r["item_id"], r["text"])]) for r in bench.collect()]
    import pyarrow as pa

    rows = docs.collect()
    want = {}
    for item in items:
        _, ids = decontaminate.word_ids(pa.array([" ".join(r["text"] for r in rows)]), item.vocabulary)
        counts, ids = decontaminate.word_ids(pa.array([r["text"] for r in rows]), item.vocabulary)
        for r, part in zip(rows, np.split(ids, np.cumsum(counts)[:-1])):
            score = decontaminate.align(part, item.words[0], 0)[0]
            if score >= 0.5:
                want[r["doc_id"], item.item_ids[0]] = score
    assert got == pytest.approx(want) and want


def test_leaks_of_awkward_rows(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    assert {(r["doc_id"], r["score"]) for r in decontaminate.find_leaks(awkward, bench).collect()} == {(5, 1.0), (6, 1.0)}
    assert decontaminate.find_leaks(nothing, bench).collect() == []
    assert decontaminate.find_leaks(awkward, bench.where("false")).collect() == []
    assert decontaminate.without_leaks(awkward, bench).count() == awkward.count() - 2
    assert decontaminate.without_leaks(awkward, bench).columns == awkward.columns
    assert [len(b.item_ids) for b in decontaminate.item_blocks(bench.union(bench), 5)] == [1, 1]


def test_mixture_matches_its_definition(spark, awkward, nothing):
    rng = random.Random(2)
    rows = [(i, "t", rng.choices(["a", "b", "c", "z", None], [60, 20, 10, 5, 5])[0]) for i in range(900)]
    weights = {"a": 3, "b": 2, "c": 1, "gone": 4}
    got = pfair.mix(frame(spark, rows).repartition(5), weights, 10).select("doc.doc_id", "doc.source", "stream", "block", "slot", "released", "due", "place").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(900))
    sizes = Counter(s if s in weights else None for _, _, s in rows)
    want = brute.mixture(sizes, weights, 10)
    want += [None] * -(-sizes[None] // 10)
    slots = {r["slot"]: r["stream"] for r in got}
    assert [slots[t] for t in range(len(want))] == want and len(slots) == len(want)
    assert all(r["released"] <= r["slot"] < r["due"] for r in got)
    first = [slots[t] for t in range(len(want))]
    ends = next(t for t in range(len(first)) if first[:t + 1].count("c") == -(-sizes["c"] // 10) or first[:t + 1].count("b") == -(-sizes["b"] // 10))
    for t in range(1, ends + 1):  # deviation of less than one block
        for s in "abc":
            assert abs(first[:t].count(s) - t * weights[s] / 6) < 1
    for s in ("a", "b", "c"):
        mine = sorted((r["slot"], r["place"], r["doc_id"]) for r in got if r["source"] == s)
        assert [m[2] for m in mine] == sorted(m[2] for m in mine)
    out = pfair.mixed(awkward, {"a": 1, "b": 1}, 2)
    assert out.columns == awkward.columns and Counter(map(tuple, out.collect())) == Counter(map(tuple, awkward.collect()))
    assert pfair.mixed(awkward, {}, 2).count() == awkward.count() and pfair.mixed(nothing, {"a": 1}).collect() == []
    assert pfair.whole_weights({"a": 0.5, "b": 0.25, "c": 0.25}) == {"a": 2, "b": 1, "c": 1}


@pytest.mark.parametrize("weights", [TARGETS, {"a": 0.3, "b": 0.0007, "c": 0.6993}, {"a": 1.0, "b": 1 / 3, "c": 0.00001}, {"a": 1, "b": 10**17 + 1, "c": 10**17}])
def test_slots_follow_the_weights_as_given(weights):
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    total = sum(exact.values())
    sizes = {s: max(1, int(12_000 * w / total)) for s, w in exact.items()}
    plan, after = pfair.phases(pfair.whole_weights(weights), sizes)
    assert after == sum(sizes.values())
    first, placed = plan[0], {s: 0 for s in weights}
    length = plan[1].start if len(plan) > 1 else after
    slot_of = {}
    for s, (lo, hi, w, at, released, due) in first.members.items():
        for k in range(lo, hi):
            t = first.start + k // w * first.period + at[k % w]
            assert slot_of.setdefault(t, s) == s
            assert first.start + k // w * first.period + released[k % w] == k * total // exact[s] <= t
            assert first.start + k // w * first.period + due[k % w] == -(-(k + 1) * total // exact[s]) > t
    assert sorted(slot_of) == list(range(length))
    for t in range(length):
        placed[slot_of[t]] += 1
        assert all(abs(placed[s] - (t + 1) * exact[s] / total) < 1 for s in weights)


def test_rounding_of_weights_is_bounded(monkeypatch):
    weights = {"a": 10**9 + 7, "b": 1, "c": 3 * 10**8, "d": 2}
    parts = pfair.rounded(weights, 1000)
    assert sum(parts.values()) == 1000 and min(parts.values()) == 1
    assert all(abs(p - 1000 * weights[s] / sum(weights.values())) < len(weights) for s, p in parts.items())
    monkeypatch.setattr(pfair, "SLOTS", 1000)
    plan, after = pfair.phases(weights, {"a": 9000, "b": 2, "c": 4000, "d": 5})
    assert after == 13007 and all(p.period <= 1000 for p in plan)
    assert sum(hi - lo for p in plan for lo, hi, *_ in p.members.values()) == after
