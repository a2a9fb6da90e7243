"""Jaccard join, components and repeated strings against brute force."""

import hashlib
import random

import numpy as np

from tests.llm.helpers import SF, components, edge_rows, frame, shingles, stored, words
from tillsight.llm import jaccard_join, registry, repeats
from tillsight.llm.components import connected_components
from tillsight.llm.shingles import shingle_sets, word_hashes


def texts_near_the_threshold(seed, n=160):
    """Chains of edited texts, exact copies, shared passages and short texts."""
    rng = random.Random(seed)
    rows, pool = [], [words(rng.choice([3, 6, 9, 14, 30, 60, 150, 400]), seed * 100 + i).split() for i in range(18)]
    passage = words(40, seed).split()
    for i in range(n):
        text = list(rng.choice(pool))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            text[rng.randrange(len(text))] = f"w{rng.randrange(99)}"
        if rng.random() < 0.2:
            text += passage
        if rng.random() < 0.3:
            pool[rng.randrange(len(pool))] = text
        sep = rng.choice([" ", "  ", "\n", "\t"])
        rows.append((rng.randrange(10_000), sep.join(text).swapcase() if rng.random() < 0.2 else sep.join(text)))
    seen = set()
    return [r for r in rows if not (r[0] in seen or seen.add(r[0]))]


def test_shingles_equal_their_definition():
    import pyarrow as pa

    rng = random.Random(9)
    texts = ["".join(rng.choice("ab \n\té\x0b\x0c  Z") for _ in range(rng.randrange(0, 40))) for _ in range(500)]
    sets, known = shingle_sets(pa.array(texts)), {}
    for t, s in zip(texts, sets, strict=True):
        want = shingles(t)
        assert len(s) == len(want)
        assert known.setdefault(want, tuple(s.tolist())) == tuple(s.tolist())
    assert len(set(known.values())) == len(known)
    assert len(word_hashes(pa.array(["", " "]))[0]) == 0


def test_probes_cover_every_linked_pair():
    """For random pairs within the bound, the values allocated always leave a meeting."""
    rng = np.random.default_rng(3)
    for _ in range(400):
        size = int(rng.choice([4, 5, 9, 20, 60, 300]))
        x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        grow = int(rng.integers(0, size // 4 + 1))
        swap = int(rng.integers(0, size // 8 + 1))
        y = np.concatenate((x[swap:], rng.integers(0, 1 << 63, grow + swap, dtype=np.uint64)))
        both = size - swap
        if not 100 * both >= 80 * (len(x) + len(y) - both):
            continue
        values, roles = jaccard_join.signatures(np.sort(x))
        held = jaccard_join.signatures(np.sort(y))
        held = set(held[0][held[1] != jaccard_join.NEIGHBOUR].tolist())
        costs = np.sort(rng.integers(1, 50, int((roles == jaccard_join.OWN).sum())))
        rest, value = jaccard_join.allocate(size, costs, int(rng.integers(1, 50)), int(rng.integers(1, 50)))
        own = values[roles == jaccard_join.OWN]
        probes = [*rng.permutation(own)[:rest].tolist()]
        probes += values[roles == jaccard_join.RELIEF].tolist() if value > 0 else []
        probes += values[roles == jaccard_join.NEIGHBOUR].tolist() if value > 1 else []
        assert held & set(probes)


def test_near_duplicates_equal_all_pairs(spark, tmp_dir):
    for seed in (1, 2):
        rows = texts_near_the_threshold(seed)
        got = jaccard_join.near_duplicates(stored(frame(spark, rows), f"{tmp_dir}/d{seed}")).collect()
        want = components(rows)
        assert {r.doc_id: r.component_id for r in got} == want
        assert all(r.n_shingles == len(shingles(dict(rows)[r.doc_id])) for r in got)


def test_large_group_of_near_copies(spark, tmp_dir):
    # more members than a small group: stars, and a second round for those far from the centre
    rng, base = random.Random(8), words(100, 5).split()
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join([*base[:60], *words(40, 500 + i).split()])) for i in range(40)]  # share a passage only
    got = jaccard_join.near_duplicates(stored(frame(spark, rows), f"{tmp_dir}/d")).collect()
    assert {r.doc_id: r.component_id for r in got} == components(rows)


def spoke(i, x, centre):
    """A star's row: sizes, overlap, whether they link, and the deviations of a member from the centre (node 0)."""
    both = len(x & centre)
    near = 5 * both >= 4 * len(x)
    return (i, 0, len(x), len(centre), both, 100 * both >= 80 * len(x | centre), sorted(x - centre),
            sorted(centre - x) if near else [])


def test_members_of_a_star_link_through_rare_and_hot_elements(spark):
    # the deviations from one centre: every pair of different components that links is a candidate, whatever the cells
    rng = random.Random(12)
    centre, common = set(range(40)), list(range(100, 112))
    nodes = {0: centre}
    for i in range(1, 160):
        own = set(rng.sample(common, rng.randrange(0, 7))) | {1000 + 10 * i + k for k in range(rng.randrange(0, 5))}
        nodes[i] = centre - set(rng.sample(range(12), rng.randrange(0, 10))) | own
    link = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    rows = [(*spoke(i, x, centre), 0 if link(x, centre) else i) for i, x in nodes.items() if i]
    spokes = spark.createDataFrame(rows, jaccard_join._VERIFIED + ", component long")
    want = {(i, j) for i in nodes for j in nodes if i > j > 0 and link(nodes[i], nodes[j])
            and not (link(nodes[i], centre) and link(nodes[j], centre))}
    loose = sum(not r[5] for r in rows)
    assert 30 < loose < 130 and len(want) > 30
    for cell in (3, 1 << 11):
        got = [tuple(r) for r in jaccard_join._within_stars(spokes, cell).collect()]
        assert len(set(got)) == len(got) and want <= set(got)


def test_near_duplicate_edges(spark, tmp_dir):
    rows = edge_rows()
    df = stored(frame(spark, rows), f"{tmp_dir}/d")
    got = jaccard_join.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = {d: c for d, c in components(rows).items()}
    # rows of one id count as one document
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)
    kept = jaccard_join.keep_first(df)
    assert kept.columns == df.columns
    # ... and as many where one row of a group is kept: each distinct (id, text) is decided on its own
    distinct = sorted({(d, t or "") for d, t in rows if d is not None},
                      key=lambda r: (r[0], hashlib.sha256(r[1].encode()).hexdigest()))
    first = components([(i, t) for i, (_, t) in enumerate(distinct)])
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect() if r.doc_id is not None), key=repr) == sorted(
        (r for i, r in enumerate(distinct) if first[i] == i), key=repr)
    assert kept.where("doc_id is null").count() == 2
    empty = stored(frame(spark, []), f"{tmp_dir}/e", 1)
    assert jaccard_join.near_duplicates(empty).count() == 0 == jaccard_join.keep_first(empty).count()


def test_op7_on_all_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in registry.op7_jaccard_join(spark, SF).collect()}
    assert got == {d: (len(shingles(dict(rows)[d])), c) for d, c in components(rows).items()}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(100, 160)] + [(i, 7) for i in range(20, 60)] + [(500, 501), (501, 500), (9, 9)]
    rng.shuffle(links)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(20, 60)]} | {500: 500, 501: 500}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- repeated strings


def without_repeats(rows):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def removed(df):
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(df).collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def test_string_classes_are_the_sorted_strings():
    rng = random.Random(1)
    for _ in range(60):
        letters = b"abc"[:rng.choice([1, 2, 3])]
        base = bytes(rng.choice(letters) for _ in range(rng.randrange(150, 600)))
        t = base + bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 300))) + base[:rng.randrange(100, 150)]
        at, new = repeats.string_classes(np.frombuffer(t, np.uint8), np.arange(len(t) - 99))
        found = [t[p:p + 100] for p in at]
        assert found == sorted(found)
        assert new.tolist() == [True] + [a != b for a, b in zip(found[:-1], found[1:], strict=True)]


def test_suffix_ranks_order_distinct_suffixes():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 4, 5, 30, 500):
        x = rng.integers(1, 4, n).astype(np.uint64)
        ranks = repeats.suffix_ranks(x, 1, n + 10)
        assert np.argsort(ranks, kind="stable").tolist() == sorted(range(n), key=lambda i: x[i:].tolist())


def test_removal_equals_brute_force(spark, tmp_dir):
    rng = random.Random(4)
    parts = ["alpha beta gamma delta ", "x" * 120, "é" * 70, "ab" * 60, words(30, 1), words(60, 2), words(25, 3)]
    rows = []
    for i in range(250):
        own = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 150))) for _ in range(3)]
        rows.append((i, "".join(rng.choice(parts) if rng.random() < 0.6 else rng.choice(own)
                                for _ in range(rng.randrange(0, 8)))))
    rows += [(400, None), (401, ""), (402, rows[3][1] * 3), (403, "a" * 300), (404, "a" * 250), (None, rows[5][1])]
    df = stored(frame(spark, rows), f"{tmp_dir}/d", 5)
    assert order(removed(df)) == order(without_repeats(rows))
    kept = repeats.remove_repeats(df).where("kept is not null").collect()
    assert kept and all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in kept)


def test_removal_edges(spark, tmp_dir):
    rows = [r for r in edge_rows() if r[0] != 1] + [(1, words(60, 2)), (1, words(60, 2)), (50, words(60, 2) + "!" * 100)]
    assert order(removed(stored(frame(spark, rows), f"{tmp_dir}/d"))) == order(without_repeats(rows))
    assert removed(stored(frame(spark, []), f"{tmp_dir}/e", 1)) == []


def test_long_text_is_cut_in_chunks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(repeats, "_CHUNK", 997)
    rows = [(i, words(900, i % 3) + words(400, i)) for i in range(6)]
    data = np.frombuffer(rows[0][1].encode(), np.uint8)
    values, _ = repeats.anchor_places(data, np.array([0, len(data)]))
    monkeypatch.setattr(repeats, "_CHUNK", 1 << 20)
    whole, _ = repeats.anchor_places(data, np.array([0, len(data)]))
    assert set(values.tolist()) == set(whole.tolist())


def test_op3_on_all_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
           for r in registry.op3_repeated_strings(spark, SF).collect()]
    assert order(got) == order(without_repeats(rows))


def family(seed, members=400, size=140):
    """Texts that share one long passage but little else, a third of them edits of one text, and pairs that link."""
    rng = random.Random(seed)
    passage = words(30, seed).split()
    centre = words(size, seed + 1).split()
    rows = []
    for i in range(members):
        if i % 3:
            text = words(rng.randrange(60, size), seed * 1000 + i).split()
        else:
            text = list(centre)
            for _ in range(rng.choice([1, 3, 6, 9])):
                text[rng.randrange(len(text))] = f"w{rng.randrange(9999)}"
        rows.append((2 * i, " ".join(text + passage)))
        if i % 5 == 0:  # a near copy of a loose member
            text[rng.randrange(len(text))] = "other"
            rows.append((2 * i + 1, " ".join(text + passage)))
    return rows


def test_a_large_family_makes_few_candidates(spark, tmp_dir, monkeypatch):
    """Members of a star that share only what all share with its centre are not compared."""
    rows, made = family(3), []

    def counted(df, name, keep=jaccard_join.materialize):
        out = keep(df, name)
        if name == "candidates":
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", counted)
    got = jaccard_join.near_duplicates(stored(frame(spark, rows), f"{tmp_dir}/d"))
    assert {r.doc_id: r.component_id for r in got.collect()} == components(rows)
    assert sum(made) <= 20 * len(rows)


def test_bounds_within_a_star(spark):
    """Random members around a centre, some far from it: every pair that links (one of them loose) is a candidate."""
    rng = random.Random(8)
    centre = set(range(100))
    sets = {0: centre}
    for i in range(1, 220):
        base = sets[rng.choice(list(sets))] if rng.random() < 0.7 else set(rng.sample(range(400), 90))
        gone = rng.choice([0, 3, 8, 15, 40])
        own = set(rng.sample(sorted(base), max(1, len(base) - gone)))
        sets[i] = own | {rng.randrange(100, 400) for _ in range(rng.choice([0, 2, 8, 15]))}

    def linked(x, y):
        return 100 * len(x & y) >= 80 * len(x | y)

    rows = [(*spoke(i, x, centre), i) for i, x in sets.items() if i]
    spokes = spark.createDataFrame(rows, jaccard_join._VERIFIED + ", component long")
    for cell in (2048, 7):
        found = {(r.a, r.b) for r in jaccard_join._within_stars(spokes, cell).collect()}
        want = {(i, j) for i in sets for j in sets if i > j > 0 and linked(sets[i], sets[j])
                and not (linked(sets[i], centre) and linked(sets[j], centre))}
        assert want and want <= found


def test_stars_of_one_family_move_to_one_centre(spark):
    rng = random.Random(5)
    sets = {}
    for family in range(4):
        base = [rng.randrange(1 << 60) for _ in range(60)]
        for k in range(15):
            some = set(base) - set(rng.sample(base, rng.randrange(12))) | {rng.randrange(1 << 60) for _ in range(rng.randrange(8))}
            sets[family * 15 + k] = some
    links = {(a, b) for a in sets for b in sets if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    stars = {}
    for _ in range(25):
        family = rng.randrange(4)
        some = rng.sample(range(family * 15, family * 15 + 15), 9) + rng.sample(sorted(sets), 2)
        stars.setdefault(some[0], set()).update(set(some[1:]) - {some[0]})
    stored = spark.createDataFrame([(n, np.array(sorted(e), np.uint64).tobytes()) for n, e in sets.items()],
                                   "node long, elements binary")
    rows = [(a, b) for b, members in stars.items() for a in members]
    got = {}
    for a, b in jaccard_join._fewer_stars(spark.createDataFrame(rows, "a long, b long"), stored).collect():
        assert a != b and a not in got.setdefault(b, set())
        got[b].add(a)
    together = [members | {b} for b, members in got.items()]
    for b, members in stars.items():
        assert any(members | {b} <= some for some in together)
        home = min((c for c in stars if c < b and b in stars[c] and (b, c) in links), default=b)
        assert members | {b} <= got[home] | {home}
    assert len(got) < len(stars) and sum(map(len, got.values())) < len(rows)
    assert not jaccard_join._fewer_stars(spark.createDataFrame([], "a long, b long"), stored).collect()


def test_keep_first_decides_by_id_and_text(spark, tmp_dir):
    a, b, c = words(60, 1), words(60, 2), words(60, 3)
    rows = [(1, a), (1, b), (2, a), (3, b + " tail"), (4, c), (4, c), (5, None), (5, ""), (None, a), (6, " ")]
    got = jaccard_join.keep_first(stored(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_dir}/a"))
    texts = [(r.doc_id, r.text or "") for r in got.collect()]
    assert sorted(texts, key=repr) == sorted([(1, a), (1, b), (4, c), (5, ""), (None, a), (6, " ")], key=repr)
    # unique ids, and column names that the operator could use itself
    rows = [(i, t, "x", "y", 1, i) for i, t in ((3, a), (2, a + " tail"), (7, b), (9, None))]
    df = spark.createDataFrame(rows, "doc_id long, text string, _first string, _sha string, _nth int, number long")
    got = jaccard_join.keep_first(stored(df, f"{tmp_dir}/b"))
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [2, 7, 9]
    doubled = stored(df.union(df), f"{tmp_dir}/c")
    assert sorted(map(repr, jaccard_join.keep_first(doubled).collect())) == sorted(map(repr, got.collect()))
    assert jaccard_join.keep_first(df.limit(0)).count() == 0
