"""Document operators against brute force on small odd inputs."""

import hashlib
import itertools
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabkit.llm import licences, lines, mixing, nearcopies, packing, repeats
from tabkit.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "one"), (905, "two words"), (906, "É é x y"), (None, "no id here at all"), (907, "x " * 5000)]


def texts(seed, n=60):
    """Originals, exact copies, copies with changed words, and shared passages."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeXYZ") for _ in range(r.randint(1, 4)))
    out, passage = [], [word() for _ in range(16)]
    for i in range(n):
        if i and r.random() < 0.6:
            w = WORD.findall(out[r.randrange(len(out))])
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                if w:
                    w[r.randrange(len(w))] = word()
        else:
            w = [word() for _ in range(r.randint(1, 60))]
        if r.random() < 0.3:
            at = r.randint(0, len(w))
            w[at:at] = passage
        out.append(r.choice([" ", "\n", " \t"]).join(w))
    return list(enumerate(out))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "k", "v") for i, t in rows], "doc_id long, text string, kept string, component_id string").repartition(3)


def closure(nodes, edges):
    comp = {n: n for n in nodes}
    change = True
    while change:
        change = False
        for a, b in edges:
            low = min(comp[a], comp[b])
            if comp[a] != low or comp[b] != low:
                comp[a] = comp[b] = low
                change = True
    return comp


@pytest.mark.parametrize("seed,k,per_cent", [(1, 3, 85), (2, 3, 85), (3, 5, 80)])
def test_near_copies(spark, seed, k, per_cent):
    rows = texts(seed) + ODD
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    named = [i for i, _ in rows if i is not None]
    edges = [(a, b) for a, b in itertools.combinations(named, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= per_cent * len(sets[a] | sets[b])]
    comp = closure(named, edges)
    want = sorted([(i, len(sets[i]), comp[i], comp[i] == i) for i in named], key=str) + [(None, len(sets[None]), None, True)]
    got = nearcopies.near_copies(docs_of(spark, rows), k, per_cent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_near_copies_of_one_original_that_do_not_resemble_each_other(spark):
    """Most copies are too far from the bucket's centre; their links are found by the shingles they share outside it."""
    r = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(r.choice([1, 8, 12])):
            w[r.randrange(150)] = f"n{r.randrange(10**6)}"
        rows.append((2 * i, " ".join(w)))
        if i % 3 == 0:
            w[r.randrange(150)] = "again"
            rows.append((2 * i + 1, " ".join(w)))
    sets = {i: {tuple(t.split()[j : j + 3]) for j in range(148)} for i, t in rows}
    comp = closure(sets, [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])])
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(docs_of(spark, rows), 3, 85).collect()}
    assert got == comp and len(set(comp.values())) > 20


def test_near_copies_of_one_late_original(spark):
    """Each copy is linked to the original alone, which is not the first of any bucket."""
    r = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(400):
        w = list(base)
        for at in r.sample(range(2, 98), 2):
            w[at] = f"n{r.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    rows.append((999, " ".join(base)))
    sets = {i: {tuple(t.split()[j : j + 3]) for j in range(98)} for i, t in rows}
    comp = closure(sets, [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])])
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(docs_of(spark, rows), 3, 85).collect()}
    assert got == comp and set(comp.values()) == {0}


def test_parities_turn_away_no_linked_pair_and_most_others(spark):
    """Copies of one original with other words here and there: pairs under the limit must not become candidates."""
    r = random.Random(13)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        for at in r.sample(range(150), r.choice([1, 3, 9])):
            w[at] = f"n{r.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[j : j + 3]) for j in range(148)} for i, t in rows}
    sig = nearcopies.signatures(docs_of(spark, rows), 3).select(F.col("doc_id").alias("i"), F.col("n_shingles").alias("n"), *nearcopies.PARITY)
    a, b = (sig.select([F.col(c).alias(f"{s}_{c}") for c in sig.columns]) for s in "ab")
    got = {(x["a_i"], x["b_i"]) for x in a.join(b, F.col("a_i") < F.col("b_i")).where(nearcopies.may_link("a_", "b_", 85)).collect()}
    like = {(x, y): len(sets[x] & sets[y]) / len(sets[x] | sets[y]) for x, y in itertools.combinations(sets, 2)}
    assert {p for p, j in like.items() if j >= 0.85} <= got
    assert not [p for p in got if like[p] < 0.78] and min(like.values()) < 0.7


def test_near_copies_empty_and_repeated_ids(spark):
    assert nearcopies.near_copies(docs_of(spark, [])).count() == 0
    got = sorted(map(tuple, nearcopies.near_copies(docs_of(spark, [(4, "a b c"), (4, "a b c"), (2, "a b c"), (4, "z")])).collect()))
    assert got == [(2, 1, 2, True), (4, 1, 2, False), (4, 1, 2, False), (4, 1, 4, True)]


def test_densified_bins_agree_as_often_as_sets_do():
    r = np.random.default_rng(1)
    same = []
    for _ in range(200):
        a = np.unique(r.integers(0, 2**63, 40, dtype=np.uint64))
        b = np.unique(np.concatenate([a[:36], r.integers(0, 2**63, 4, dtype=np.uint64)]))
        rows = np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)])
        s = nearcopies.one_permutation(rows, np.concatenate([a, b]), 2)
        same.append((s[0] == s[1]).mean())
    assert abs(np.mean(same) - 36 / 44) < 0.02


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(999, x) for x in range(500, 560)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    comp = closure({x for e in edges for x in e}, edges)
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {x: comp[x] for e in edges if e[0] != e[1] for x in e}


def cut(rows, n=13):
    first, words = {}, [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        if i is None:
            continue
        for j in range(len(w) - n + 1):
            g = tuple(w[j : j + n])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for j in range(len(w) - n + 1):
                if first[tuple(w[j : j + n])] < i:
                    gone |= set(range(j, j + n))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cut_repeats(spark, monkeypatch, seed):
    monkeypatch.setattr(repeats, "PACK_BYTES", 700)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 1500)
    rows = texts(seed, 90) + ODD + [(5, "the same id again " * 9), (600, "q w e r t y u i o p a s d f " * 3)]
    got = repeats.cut_repeats(docs_of(spark, rows), with_text=True).collect()
    assert sorted(map(tuple, got), key=str) == cut(rows)


def test_cut_repeats_of_nothing(spark):
    assert repeats.cut_repeats(docs_of(spark, [])).count() == 0


def test_licences(spark):
    rows = [
        (1, "Released UNDER the MIT License. Cc by-nc; cc.by NC"),
        (2, "under the mit\tlicense under the mit license"),
        (3, "licensed under the apache license, version 2.0"),
        (4, "the mit license is under review"),
        (5, "This work is licensed under the GNU General Public License, version 3."),
        (6, "gnu general public license version"),
        (7, "under the"),
        (8, "mit license"),
        (9, None),
        (10, ""),
        (11, "under the mité license"),
        (12, "word " * 3000 + "cc by nc"),
        (None, "cc by nc"),
        (13, "All rights reserved"),
    ]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = {}
    for i, t in rows:
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(j, x.label) for x in licences.BASE for p in [x.text.split()] for j in range(len(w) - len(p) + 1) if w[j : j + len(p)] == p]
        want[i] = (len(w), len(at), min((a for a, _ in at), default=None), max((a for a, _ in at), default=None), ",".join(sorted({x for _, x in at})))
    got = licences.scan_licences(docs_of(spark, rows)).collect()
    assert {r["doc_id"]: tuple(r[1:6]) for r in got} == want
    extra = {r["doc_id"]: r["labels"] for r in got}
    assert extra[5] == "gpl-3" and extra[6] == "" and extra[13] == "proprietary" and extra[1] == "cc-by-nc,mit"
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "") for r in got)
    assert licences.scan_licences(docs_of(spark, [])).count() == 0


def naive_notices(rows, templates, least=0.6, slack=licences.SLACK):
    """Labels and score per row, template by template and word by word."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    texts = [word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in rows]
    idf = lambda x: np.log((1 + len(rows)) / (1 + sum(x in w for w in texts)))
    out = []
    for w in texts:
        labels, score = set(), 0.0
        for n, t in enumerate(templates):
            words, spots, after = t.text.split(), [], 0
            for k in (k.split() for k in t.keys):
                after = next(i for i in range(after, len(words)) if words[i : i + len(k)] == k)
                spots.append((k, after))
                after += len(k)
            starts = [[i for i in range(len(w)) if w[i : i + len(k)] == k] for k, _ in spots]
            keyed = {j for k, q in spots for j in range(q, q + len(k))}
            for s in starts[0]:
                last = s
                for m in range(1, len(spots)):
                    shift = spots[m][1] - spots[m - 1][1]
                    last = next((z for z in starts[m] if last is not None and abs(z - last - shift) <= slack), None)
                if last is None:
                    continue
                there = [j in keyed or words[j] in w[max(0, s + j - spots[0][1] - slack) : max(0, s + j - spots[0][1] + slack + 1)] for j in range(len(words))]
                total = sum(idf(x) for x in words)
                cover = min(1.0, sum(idf(x) for x, ok in zip(words, there) if ok) / total) if total > 0 else 1.0
                if n < len(licences.BASE) or cover >= least:
                    labels.add(t.label)
                    score = max(score, cover)
        out.append((",".join(sorted(labels)), round(score, 9)))
    return out


def test_licence_notices(spark):
    gpl = "you can redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {} of the License"
    texts = [
        gpl.format(3),
        gpl.format(2),
        gpl.format(9),
        "the Free Software Foundation likes version 3; the GNU General Public License as published",
        "GNU General Public License v3",
        "// SPDX-License-Identifier: MIT",
        "SPDX-License-Identifier: Apache-2.0",
        "SPDX License Identifier",
        "GNU General Public License, published by Free Software Foundation, any version 3",
        gpl.format(3) + " " + "x " * 50 + "all rights reserved, under the MIT license " * 3,
        "rights reserved all reserved rights",
        "public license general gnu",
        "é" * 5000,
        "",
        None,
    ]
    rng = np.random.default_rng(3)
    bag = sorted({x for t in licences.BASE + licences.NOTICES for x in t.text.split()})
    for _ in range(60):
        parts = [rng.choice([t.text for t in licences.BASE + licences.NOTICES]).split() for _ in range(rng.integers(1, 4))]
        words = [x for p in parts for x in p]
        for _ in range(rng.integers(0, 5)):
            k = int(rng.integers(0, len(words)))
            words[k : k + int(rng.integers(0, 2))] = [str(rng.choice(bag))]
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    rows.append(rows[0])
    got = licences.scan_licences(docs_of(spark, rows)).collect()
    want = naive_notices(rows, licences.BASE + licences.NOTICES)
    assert sorted((r["doc_id"], r["labels"], round(r["score"], 9)) for r in got) == sorted((i, a, b) for (i, _), (a, b) in zip(rows, want))
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert [labels[i] for i in range(8)] == ["gpl-3", "gpl-2", "", "", "gpl-3", "mit", "apache-2", ""]


def naive_pack(sizes, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(sizes, sources, clusters):
        fits = [(b[0] - n, i) for i, b in enumerate(bins) if b[0] >= n and s not in b[1] and (c is None or c not in b[2])]
        i = min(fits)[1] if fits else len(bins)
        if i == len(bins):
            bins.append([capacity, set(), set()])
        out.append((i, capacity - bins[i][0]))
        bins[i][0] -= n
        bins[i][1].add(s)
        bins[i][2].add(c)
    return [o[0] for o in out], [o[1] for o in out]


@pytest.mark.parametrize("seed", range(6))
def test_packing_is_best_fit(seed):
    r = random.Random(seed)
    n = 400
    sizes = sorted((r.choice([r.randint(1, 50), r.randint(1, 10), 7]) for _ in range(n)), reverse=True)
    sources = [r.choice("aaabcdefgh") for _ in range(n)]
    clusters = [r.choice([None, "x", "y", str(r.randint(0, 60))]) for _ in range(n)]
    assert packing.pack_shard(sizes, sources, clusters, 50) == naive_pack(sizes, sources, clusters, 50)


def test_packing_covers_every_word_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 20)
    rows = texts(4) + ODD + [(5, "twice " * 40), (5, "twice " * 40)]
    df = spark.createDataFrame([(i, t, None if (i or 0) % 7 == 0 else f"s{(i or 0) % 4}", "x") for i, t in rows], "doc_id long, text string, source string, bin string")
    got = packing.best_fit(df, mixing.n_words("text"), packing.same_text("text"), 64).collect()
    total = {}
    for g in got:
        assert 0 < g["size"] <= 64 and g["start"] + g["size"] <= 64
        total[g["doc_id"]] = total.get(g["doc_id"], 0) + g["size"]
    want = {}
    for i, t in rows:
        n = len(WORD.findall(t or ""))
        if n:
            want[i] = want.get(i, 0) + n
    assert total == want
    held = [(g["bin"], g["source"]) for g in got]
    assert len(held) == len(set(held))
    assert packing.best_fit(df.where("1 = 0"), mixing.n_words("text"), packing.same_text("text")).count() == 0


def fill(sizes, weights=(5, 2, 1), most=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > most * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in free}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    r = random.Random(1)
    rows = [(i, " ".join(["w"] * r.choice([1, 3, 9, 20, 200 if i % 50 == 0 else 5])), r.choice(["big"] * 9 + ["a", "b", "c", "é", "\U0001f600", None])) for i in range(700)]
    rows += [(900, None, "a"), (901, "", "empty"), (None, "x y", "b"), (3, "again", "b"), (3, "again", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = fill(sizes)
    back = {}
    for g in got:
        assert 0 <= g["taken"] <= 3 * g["size"] and g["taken"] == g["size"] * g["copies"]
        back.setdefault((g["source_size"], round(g["target"], 6)), []).append(g["taken"])
    assert sorted(back) == sorted({(sizes[s], round(want[s], 6)) for s in sizes})
    for s in sizes:
        if [sizes[x] for x in sizes].count(sizes[s]) == 1:
            assert abs(sum(back[(sizes[s], round(want[s], 6))]) - want[s]) <= max(5, 0.02 * want[s])
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert mixing.mix_sources(df.where("1 = 0")).count() == 0


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    size, p = rng.integers(1, 100, 500), np.full(500, 0.37)
    out = mixing.flight(size, p, rng)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - p.sum()) < 1e-6 and abs((out * size).sum() - (p * size).sum()) < 1e-3


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def simhash_blocks(line):
    """The SimHash blocks of a normalised line, word by word and bit by bit."""
    words, out = line.split(" "), []
    words = [w for w in words if len(w) >= lines.LONG_WORD] or words
    for part in range(lines.BLOCKS // 3):
        hashes = [xxhash.xxh64(w.encode(), seed=xxhash.xxh64(struct.pack("<i", part), seed=42).intdigest()).intdigest() for w in words]
        for block in range(3):
            bits = [sum(h >> (block * lines.BLOCK_BITS + j) & 1 for h in hashes) * 2 > len(words) for j in range(lines.BLOCK_BITS)]
            out.append(sum(b << j for j, b in enumerate(bits)))
    return out


def test_lines(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(2, 7)))
    pool = [[word() for _ in range(r.randint(14, 30))] for _ in range(30)]
    rows = []
    for i in range(60):
        out = []
        for _ in range(r.randint(1, 5)):
            w = list(r.choice(pool))
            if r.random() < 0.4:
                w[r.randrange(len(w))] = word()
            out.append(r.choice(["{}", "{}.", "  {}!", "{}"]).format(r.choice([" ", ", "]).join(w)).capitalize())
        if r.random() < 0.3:
            out.insert(1, r.choice(["", "---", "  "]))
        rows.append((i, "\n".join(out)))
    rows += [(900, None), (901, ""), (902, "***\n\n"), (None, rows[0][1]), (903, "lone"), (904, "Lone!")]
    norm = lambda s: " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", s.lower()))
    places = [((i, j), norm(s)) for i, t in rows if i is not None and t is not None for j, s in enumerate(t.split("\n")) if norm(s)]
    distinct = sorted({n for _, n in places})
    close = [(a, b) for a, b in itertools.combinations(distinct, 2) if abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b)) and distance(a, b) <= 0.2 * max(len(a), len(b))]
    blocks = {n: simhash_blocks(n) for n in distinct}
    edges = [(a, b) for a, b in close if any(x == y for x, y in zip(blocks[a], blocks[b])) and sum((x ^ y).bit_count() for x, y in zip(blocks[a], blocks[b])) <= lines.MOST_BITS]
    assert len(edges) > 0.2 * len(close)
    comp = closure(distinct, edges)
    first = {}
    for at, n in places:
        first[comp[n]] = min(first.get(comp[n], at), at)
    want = {}
    for i, t in rows:
        if t is None or i is None:
            want[i] = t
        else:
            want[i] = "\n".join(s for j, s in enumerate(t.split("\n")) if not norm(s) or first[comp[norm(s)]] == (i, j))
    df = spark.createDataFrame([(i, t, "q", 7) for i, t in rows], "doc_id long, text string, n_lines string, keep int").repartition(3)
    got = lines.dedup_lines(df).collect()
    assert len(got) == len(rows)
    wrong = [r["doc_id"] for r in got if r["text"] != want[r["doc_id"]]]
    assert not wrong
    assert all(r["n_lines"] - r["n_removed"] == (len(r["text"].split("\n")) if r["text"] or r["n_removed"] < r["n_lines"] else 0) for r in got if r["text"] is not None)
    assert lines.dedup_lines(df.where("1 = 0")).count() == 0


def test_lines_of_one_large_bucket(spark):
    """Lines with the same long word share their whole SimHash; each resembles one other line only."""
    r = random.Random(8)
    short = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    all_lines = []
    for _ in range(150):
        w = [short() for _ in range(5)]
        all_lines.append(" ".join(["heading", *w]))
        all_lines.append(" ".join(["heading", *w[:4], w[4][:3] + "z"]))
    r.shuffle(all_lines)
    close = [(a, b) for a, b in itertools.combinations(range(300), 2) if distance(all_lines[a], all_lines[b]) <= 0.2 * max(len(all_lines[a]), len(all_lines[b]))]
    comp = closure(range(300), close)
    assert len(set(comp.values())) == 150
    df = spark.createDataFrame(list(enumerate(all_lines)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["n_removed"] for x in lines.dedup_lines(df).collect()}
    assert got == {i: int(comp[i] != i) for i in range(300)}


def test_unlike_lines_that_share_a_block_leave_the_search_at_once(spark, monkeypatch):
    """Chance collisions of one 21-bit block: no row of them is stored for the rounds."""
    r = random.Random(9)
    rows = [(i, i, 0, 100, r.getrandbits(42) << 21 | 12345, r.getrandbits(63)) for i in range(60)]
    made = spark.createDataFrame(rows, "id long, doc long, line int, size int, s0 long, s1 long")
    stored, stage = [], lines.stage

    def counted(df):
        out = stage(df)
        if "key" in out.columns:
            stored.append(out.count())
        return out

    monkeypatch.setattr(lines, "stage", counted)
    assert lines.similar_lines(made, docs_of(spark, [(i, f"line {i}") for i in range(60)]), 0.8) is None
    assert sum(stored) == 0


def test_simhashes_of_short_and_long_lines(spark):
    """Majorities of lines with up to 3,000 words, with or without long words, and of rows that repeat an id, against plain counting."""
    r = random.Random(12)
    word = lambda low, high: "".join(r.choice("abcdefghijklm") for _ in range(r.randint(low, high)))
    texts = [" ".join(word(1, 4) if short else word(3, 8) for _ in range(n)) for n in (1, 2, 7, 126, 129, 509, 511, 512, 513, 600, 3000) for short in (True, False)]
    texts += [" ".join(["alone"] * n) for n in (511, 512, 1025)]
    rows = [(i, f"{t}\n{t.upper()}!") for i, t in enumerate(texts)] + [(3, texts[3])] * 600 + [(900, texts[5]), (5, "...\n\n"), (None, "none"), (901, None)]
    got = lines.simhashes(docs_of(spark, rows).repartition(3)).collect()
    want = {(i, 0): (len(t), *(simhash_blocks(t)[k] for k in range(lines.BLOCKS))) for i, t in enumerate(texts)}
    bits = lambda s: [s >> b * lines.BLOCK_BITS & (1 << lines.BLOCK_BITS) - 1 for b in range(3)]
    assert len(got) == len(want)
    assert {(x["doc"], x["line"]): (x["size"], *bits(x["s0"]), *bits(x["s1"])) for x in got} == want


def test_simhashes_shuffle_no_text(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(lines, "stage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    lines.simhashes(docs_of(spark, [(1, "one line\nanother line")]))
    assert "Exchange" in plans[0]
    assert not [x for x in plans[0].splitlines() if "Aggregate" in x and "norm" in x]


def test_edit_similarity_of_lines_with_changed_words(spark):
    """Words changed, put in, left out and swapped: the answer is that of the plain edit distance, and words are split once a line."""
    r = random.Random(13)
    word = lambda: "".join(r.choice("abcdeäß") for _ in range(r.randint(1, 9)))
    pairs = []
    for _ in range(400):
        x = [word() for _ in range(r.randint(1, 30))]
        y = list(x)
        for _ in range(r.randint(1, 6)):
            at = r.randrange(len(y) + 1)
            how = r.randrange(4)
            if how == 0:
                y[at : at + 1] = [word()]
            elif how == 1:
                y[at:at] = [word() for _ in range(r.randint(1, 3))]
            elif how == 2 and len(y) > 2:
                del y[at : at + 2]
            elif 0 < at < len(y):
                y[at - 1], y[at] = y[at], y[at - 1]
        if y and x != y:
            pairs.append((" ".join(x), " ".join(y)))
    want = [distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9 for a, b in pairs]
    assert 50 < sum(want) < len(want) - 50
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    near = lines._within("a", "b", 0.8)
    assert [x["near"] for x in df.select("i", near.alias("near")).orderBy("i").collect()] == want
    assert df.where(near)._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2
