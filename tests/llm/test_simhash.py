from __future__ import annotations

import collections
import random

import numpy as np
import xxhash

from headway.llm import common, queries, simhash


def roots(n, links):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, y in links:
        x, y = root(x), root(y)
        up[max(x, y)] = min(x, y)
    return [root(i) for i in range(n)]


def plain_fingerprint(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_query_against_all_pairs(spark, small, texts):
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    ids = list(prints)
    close = [
        (a, b) for a in range(len(ids)) for b in range(a) if bin(prints[ids[a]] ^ prints[ids[b]]).count("1") <= 2
    ]
    wanted = {i: (f"{prints[i]:016x}", ids[r]) for i, r in zip(ids, roots(len(ids), close))}
    got = queries.op5_simhash_near_dedup(spark, small).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == wanted


def test_links_in_one_crowded_block(spark):
    rng = random.Random(3)
    values = {0}
    while len(values) < 300:  # all in one block of low bits, chained by few bits
        base = rng.choice(sorted(values))
        values.add(base ^ (1 << rng.randrange(22, 64)) ^ (rng.random() < 0.5) * (1 << rng.randrange(22, 64)))
    values |= {rng.getrandbits(64) for _ in range(100)}
    fps = sorted(values)
    links = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 2]
    wanted = collections.Counter(roots(len(fps), links))
    frame = spark.createDataFrame([(int(v),) for v in simhash.signed(fps)], "fp long")
    common.prepare(spark)
    for tile in (8, 4096):
        found = common.components(simhash.near_fingerprints(frame, 2, tile)).collect()
        sizes = collections.Counter(r.root for r in found)
        assert sorted(sizes.values()) == sorted(n for n in wanted.values() if n > 1)


def test_forest_has_fewer_links_than_rows(spark):
    frame = spark.createDataFrame([(i,) for i in range(64)], "fp long")  # six low bits: thousands of pairs
    common.prepare(spark)
    assert simhash.near_fingerprints(frame, 2).count() <= 3 * 63


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame(chain + star + [(5, 5), (1, 0)], "a long, b long")
    got = {r.node: r.root for r in common.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert common.components(links.limit(0)).count() == 0


def test_kept_documents_against_brute_force(spark, small, texts):
    """The pipeline's stage: one document of each component of the operator, odd rows included."""
    rng = random.Random(5)
    rows = [(i, t, "a") for i, t in texts.items()]
    for i, text, _ in rows[:60]:
        words = (text or "").split()
        for k in range(3):
            changed = list(words)
            for _ in range(len(words) // rng.choice([60, 150, 400])):
                changed[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
            rows.append((10_000 + 3 * i + k, " ".join(changed), "b"))
    rows += [(50_000, rows[0][1].upper(), "c"), (rows[1][0], rows[1][1], "d"), (None, rows[2][1], "e")]
    rows += [(60_000, None, "f"), (60_001, "", "g"), (None, "a text of its own here", "h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row string").coalesce(1)
    kept = simhash.kept_documents(frame)
    assert kept.columns == ["doc_id", "text", "row"]
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    fps = np.array(prints, dtype=np.uint64)
    near = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None]) <= 2)
    best = {}
    for n, r in enumerate(roots(len(rows), [(a, b) for a, b in near.tolist() if a > b])):
        rank = (rows[n][0] is None, rows[n][0] or 0, n)
        best[r] = min(best.get(r, rank), rank)
    assert len(best) < len(rows)
    assert sorted(r.row + str(r.doc_id) for r in kept.collect()) == sorted(
        rows[n][2] + str(rows[n][0]) for *_, n in best.values()
    )
    assert simhash.kept_documents(frame.limit(0)).count() == 0


def test_population_counts_never_hide_a_link():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**16, 400, dtype=np.uint64)
    for side in (np.zeros(400, dtype=np.int32), rng.integers(0, 2, 400).astype(np.int32)):
        found = {tuple(sorted(p)) for i, j in simhash.near_rows(fp, side, 3) for p in zip(i.tolist(), j.tolist())}
        wanted = {
            (a, b)
            for a in range(400)
            for b in range(a + 1, 400)
            if bin(int(fp[a] ^ fp[b])).count("1") <= 3 and (not side.any() or side[a] != side[b])
        }
        assert found == wanted
