"""Urls, near copies, passages, repeats, overlaps, language model: against brute force."""

import collections
import hashlib
import itertools
import math
import pathlib
import random
import re
import urllib.parse
import zlib

import numpy as np
import pytest
import xxhash
from llm.conftest import ODD

from visitry.llm import catalog, components, decontaminate, katz, passages, simhash, suffixes, urls


def words_of(rnd, n, pool=5000):
    return [f"w{rnd.randrange(pool)}" for _ in range(n)]


def test_cascade_is_exact():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 50, 5000):
        hashes = rnd.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        for share in (0, 0.01, 0.5, 1):
            listed = rnd.random(n) < share
            assert (urls.Cascade(urls.build_levels(hashes, listed)).has(hashes) == listed).all()


def test_cascade_raises_on_one_key_both_ways():
    key = np.ones((2, 2), dtype=np.uint64)
    with pytest.raises(ValueError):
        urls.build_levels(key, np.array([True, False]))


def test_urls_of_every_kind(spark, monkeypatch):
    rows = [None, "", "no scheme", "http://A.Example.NET/en/1?x", "http://example.net/de/", "http://example.com/de/x", "http://xexample.com/de/x",
            "http://a.org/fr/#f", "http://b.org/x", "HTTP://B.org/x?y", "http://net", "a://b://c/d", "http://b.org/é\n/z"]
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(rows)], "page_id long, url string, rule string, key string")
    listed = spark.createDataFrame([("b.org/x",), ("absent",), (None,), ("b.org/x",)], "key string")
    expect = [("", "", None, "allow")] * 3 + [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/de/", "net/", "block"), ("example.com", "/de/x", "example.com/de/", "block"),
        ("xexample.com", "/de/x", None, "allow"), ("a.org", "/fr/", "org/fr/", "allow"), ("b.org", "/x", None, "block"), ("b.org", "/x", None, "block"),
        ("net", "", None, "allow"), ("b:", "//c/d", None, "allow"), ("b.org", "/é\n/z", None, "allow"),
    ]
    for size, room in ((250_000, 64 << 20), (2, 1)):
        monkeypatch.setattr(urls, "SHARD_KEYS", size)
        monkeypatch.setattr(urls, "BROADCAST_BYTES", room)
        got = urls.judge_urls(pages, catalog.URL_RULES, listed).orderBy("page_id").collect()
        assert [tuple(r)[1:] for r in got] == [(h, p, r, v) for h, p, r, v in expect][: len(got)] and len(got) == len(rows)
    assert urls.judge_urls(pages.limit(0), catalog.URL_RULES, listed.limit(0)).collect() == []


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    name = {p: p for p in prints}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in itertools.combinations(name, 2):
        if (a ^ b).bit_count() <= 2:
            name[find(a)] = find(b)
    return {p: find(p) for p in name}


@pytest.mark.parametrize("crowded", [32, 1])
def test_simhash_components(make, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    monkeypatch.setattr(simhash, "AT_ONCE", 50)
    rnd = random.Random(6)
    base = words_of(rnd, 300)
    rows = [(100 + k, " ".join(w if rnd.random() > 0.004 else "new" for w in base)) for k in range(40)]
    rows += [(200 + k, " ".join(words_of(rnd, rnd.randint(1, 30)))) for k in range(20)] + [r for r in ODD if r[0] is not None]
    got = simhash.simhash_components(make(rows)).collect()
    prints = {t: plain_fingerprint(t) for _, t in rows}
    assert sorted((r["doc_id"], r["fingerprint"] % (1 << 64)) for r in got) == sorted((i, prints[t]) for i, t in rows)
    root = classes(set(prints.values()))
    least = {}
    for i, t in rows:
        least[root[prints[t]]] = min(i, least.get(root[prints[t]], i))
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: least[root[prints[t]]] for i, t in rows}
    kept = simhash.drop_near_duplicates(make(rows))
    assert "n_words" in kept.columns and {r["doc_id"] for r in kept.collect()} == set(least.values())


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(7, 7), (9, 8), (8, 9)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 100 for k in range(100, 161)}, 5: 5, **{k: 5 for k in range(200, 260)}, 8: 8, 9: 8}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_compact_windows_cover_each_stretch_once():
    rng = np.random.default_rng(7)
    for k in range(150):
        n, width = int(rng.integers(1, 50)), int(rng.integers(1, 12))
        values = rng.integers(1, 20 if k % 2 else 10**9, n).astype(np.uint64)
        values[rng.integers(0, n)] = 0 if n > 20 else 1
        found = passages.compact_windows(values, width)
        for i in range(n):
            for j in range(i + width - 1, n):
                inside = [w for w in found if w[0] <= i and j <= w[2] and i <= w[1] <= j]
                least = values[i : j + 1].min()
                assert len(inside) == (least > 0) and all(values[w[1]] == least for w in inside)


def test_repeated_passages(make):
    rnd = random.Random(8)
    passage, other = words_of(rnd, 60), words_of(rnd, 55)
    near = list(passage)
    near[30] = "changed"
    rows = [(100 + k, " ".join(words_of(rnd, 80) + passage + words_of(rnd, 40 + k))) for k in range(12)]
    rows += [(120, " ".join(near + words_of(rnd, 100))), (121, " ".join(other + words_of(rnd, 90) + other)), (122, " ".join(words_of(rnd, 200)))]
    rows += [(123, " ".join(passage[:40] + words_of(rnd, 100))), (130, rows[14][1]), (131, " ".join(words_of(rnd, 49))), (132, None)]
    found = passages.repeated_passages(make([*rows, *ODD])).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(i) for i, _ in [*rows, *ODD])
    by = {r["doc_id"]: r for r in found}
    for k in range(100, 112):
        assert by[k]["class_id"] == 100 and by[k]["n_links"] >= 1
        (start, end), = [tuple(map(int, s.split(":"))) for s in by[k]["spans"].split(",")]
        assert 70 <= start <= 80 and 140 <= end <= 150
    assert by[120]["class_id"] == 100 and by[120]["n_repeated"] >= 50
    assert by[121]["n_repeated"] >= 110 and by[121]["n_links"] == 0
    assert by[122]["n_repeated"] == 200 and by[130]["class_id"] == 122
    assert by[123]["n_repeated"] == 0 and by[131]["spans"] == "" and by[5]["n_repeated"] == 0
    assert passages.repeated_passages(make(rows).limit(0)).collect() == []


def linked_passages(rows, width=46):
    """Pairs of texts with a stretch of 46 shingles of which 41 or more are common, at up to five places off; by brute force."""
    hashes = passages.shingle_hashes([passages.lower_words(t) for _, t in rows])
    links = set()
    for x, y in itertools.permutations(range(len(rows)), 2):
        a, b = hashes[x], hashes[y]
        for shift in range(-len(b) + 1, len(a)):
            hit = np.zeros(len(a), dtype=bool)
            for s in range(shift - 5, shift + 6):
                low, high = max(0, s), min(len(a), len(b) + s)
                if low < high:
                    hit[low:high] |= a[low:high] == b[low - s : high - s]
            sums = np.cumsum(np.r_[0, hit])
            if (sums[width:] - sums[:-width] >= 41).any():
                links.add(frozenset((rows[x][0], rows[y][0])))
                break
    return links


@pytest.mark.parametrize(("pairs", "crowded"), [(3, None), (12, None), (12, 2), (1, None)])
def test_passages_under_a_key_whose_first_is_another(make, monkeypatch, pairs, crowded):
    """Texts around one frequent line, similar in pairs only: whichever is the first of the line's keys."""
    if crowded:
        monkeypatch.setattr(passages, "CROWDED", crowded)
    rnd = random.Random(21)
    line, rows = words_of(rnd, 33), []
    for k in range(pairs):
        own, behind = words_of(rnd, 9), words_of(rnd, 9)
        for j in range(2):
            rows.append((10 * k + j, " ".join(words_of(rnd, 15) + own + line + behind + words_of(rnd, 15))))
        rows.append((10 * k + 5, " ".join(words_of(rnd, 30) + line + words_of(rnd, 30))))
    links = linked_passages(rows)
    assert links == {frozenset((10 * k, 10 * k + 1)) for k in range(pairs)}
    by = {r["doc_id"]: r for r in passages.repeated_passages(make(rows)).collect()}
    for k in range(pairs):
        assert by[10 * k + 1]["class_id"] == by[10 * k]["class_id"] == 10 * k and by[10 * k + 5]["class_id"] == 10 * k + 5
        assert [by[10 * k + j]["n_links"] for j in (0, 1, 5)] == [1, 1, 0] and by[10 * k + 1]["n_repeated"] >= 50


def test_rare_meetings_are_compared_in_parts(make, monkeypatch):
    """What meets over rare shingles is made for a part of the texts at a time and leaves the disk once compared; the rows do not change."""
    rnd = random.Random(21)
    line, rows, stored = words_of(rnd, 33), [], collections.defaultdict(list)
    for k in range(12):
        own, behind = words_of(rnd, 9), words_of(rnd, 9)
        rows += [(10 * k + j, " ".join(words_of(rnd, 15) + own + line + behind + words_of(rnd, 15))) for j in range(3)]
    whole = sorted(map(tuple, passages.repeated_passages(make(rows)).collect()))
    written = passages.stored

    def noted(df, name):
        out = written(df, name)
        stored[name].append(pathlib.Path(urllib.parse.urlparse(out.inputFiles()[0]).path).parent)
        return out

    monkeypatch.setattr(passages, "stored", noted)
    monkeypatch.setattr(passages, "MEETINGS", 1000)
    assert sorted(map(tuple, passages.repeated_passages(make(rows)).collect())) == whole
    assert len(stored["met"]) > 2 and len({r[4] for r in whole}) == 12
    assert not any(folder.exists() for name in ("prepared", "keys", "links", "linked", "cores", "near", "met") for folder in stored[name])


def test_texts_are_hashed_once(make, monkeypatch):
    """One pass over the distinct texts gives all windows and shingles; copies make no key shared."""
    rnd, tables, plans, written = random.Random(5), {}, {}, passages.stored

    def noted(df, name, *rest):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return tables.setdefault(name, written(df, name, *rest))

    monkeypatch.setattr(passages, "stored", noted)
    rows = [(k, " ".join(words_of(rnd, 90))) for k in range(3)]
    found = {r["doc_id"]: r for r in passages.repeated_passages(make([*rows, *((10 + k, t) for k, t in rows)])).collect()}
    assert all(found[10 + k]["class_id"] == k and found[k]["n_repeated"] == 90 and found[k]["n_links"] == 0 for k in range(3))
    assert [name for name, plan in plans.items() if "MapInArrow" in plan and re.search(r"\btext#", plan)] == ["prepared"]
    assert tables["shared"].count() == 0


def test_runs_of_a_word_are_one_window(make, monkeypatch):
    """A run of one word has many centres of the same key; they meet another text's as one row, and its own in no join."""
    rnd, tables, written = random.Random(6), {}, passages.stored
    monkeypatch.setattr(passages, "stored", lambda df, name, *rest: tables.setdefault(name, written(df, name, *rest)))
    rows = [(k, " ".join(words_of(rnd, 30) + ["again"] * n + words_of(rnd, 30))) for k, n in enumerate((80, 95, 20))]
    line = words_of(rnd, 20)
    rows.append((7, " ".join(words_of(rnd, 20) + line * 9 + words_of(rnd, 20))))
    by = {r["doc_id"]: r for r in passages.repeated_passages(make(rows)).collect()}
    assert [by[k]["class_id"] for k in (0, 1, 2, 7)] == [0, 0, 2, 7] and [by[k]["n_links"] for k in (0, 1, 2, 7)] == [1, 1, 0, 0]
    assert by[0]["n_repeated"] >= 80 and by[1]["n_repeated"] >= 95 and by[2]["n_repeated"] == 0 and by[7]["n_repeated"] >= 160
    assert 2 <= tables["shared"].count() <= 3 * passages.HASHES


def test_passages_in_another_text_as_all_places_give_them(monkeypatch):
    rng = np.random.default_rng(11)
    for k in range(200):
        monkeypatch.setattr(passages, "CELLS", int(rng.integers(1, 60)))
        a, b = ((rng.integers(0, 6, rng.integers(1, 40)) * 2 + 1).astype(np.int32) for _ in range(2))
        low = rng.integers(-30, 30, k % 3 + 1)
        high = low + rng.integers(0, 30, len(low))
        shifts = {s for x, y in zip(low, high, strict=True) for s in range(x - 5, y + 6)}
        in_a, in_b = passages._hits(a, b, passages._between(low, high, 1 - len(b), len(a) - 1))
        assert in_a.tolist() == [any(0 <= i - s < len(b) and a[i] == b[i - s] for s in shifts) for i in range(len(a))]
        assert in_b.tolist() == [any(0 <= j + s < len(a) and b[j] == a[j + s] for s in shifts) for j in range(len(b))]


def test_rare_shingles_of_a_window():
    """On each side with room, the rarest of those near a centre; a run of one shingle has many centres."""
    rng, counts = np.random.default_rng(12), np.arange(1 << 12)[::-1].copy()
    near, most = passages.CORE + passages.SHIFT, passages.MISSED + passages.SHIFT + 1
    for wide in (0, 0, 3, 40):
        core = rng.permutation(1 << 10)[: 2 * near + wide + 1].astype(np.uint32) * np.uint32(2) + np.uint32(1)
        centre = int(rng.integers(0, near))
        core[centre : centre + wide + 1] = core[centre]
        left, right = centre - int(rng.integers(0, centre + 1)), centre + wide + int(rng.integers(0, near))
        expected = set()
        for c in range(centre, centre + wide + 1):
            for side, room, cut in ((0, right - c, core[c : c + near]), (1, c - left, core[max(0, c - near + 1) : c + 1])):
                if room >= passages.CORE - 1 - passages.SHIFT:
                    expected |= {2 * x + side for x in sorted(set(cut.tolist()), key=lambda x: (counts[x % len(counts)], x))[:most]}
        places = (np.array([v]) for v in (centre, wide, left, right))
        window, token = passages._rare([core], *places, counts)
        assert set(window.tolist()) <= {0} and sorted(token.tolist()) == sorted(expected)


def test_contexts_are_written_once(make, monkeypatch):
    """Only those that may repeat are written, and only one table has them."""
    rnd, tables, written = random.Random(3), {}, suffixes.stored
    monkeypatch.setattr(suffixes, "stored", lambda df, name, *rest: tables.setdefault(name, written(df, name, *rest)))
    common = " ".join(words_of(rnd, 80))
    rows = [(k, " ".join(words_of(rnd, 60)) + common + " ".join(words_of(rnd, 60))) for k in range(4)] + [(9, " ".join(words_of(rnd, 90)))]
    found = {r["doc_id"]: r["n_removed"] for r in suffixes.remove_repeats(make(rows)).collect()}
    assert all(found[k] >= len(common) for k in range(4)) and found[9] == 0
    assert [name for name, df in tables.items() if "context" in df.columns] == ["sized"]


def test_only_contexts_without_a_copy_are_sorted(make, monkeypatch):
    """With those they share an anchor with; texts are searched for anchors once."""
    rnd, tables, plans, written = random.Random(4), {}, {}, suffixes.stored

    def noted(df, name, *rest):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return tables.setdefault(name, written(df, name, *rest))

    monkeypatch.setattr(suffixes, "stored", noted)
    common, other = (" ".join(words_of(rnd, 120)) for _ in range(2))
    rows = [(k, " ".join(words_of(rnd, 60)) + common + " ".join(words_of(rnd, 60))) for k in range(3)]
    rows += [(10, other + " ".join(words_of(rnd, 60))), (11, " ".join(words_of(rnd, 60)) + other), (12, "a" * 500), (13, "a" * 300 + "b" * 150)]
    got = sorted((str(r[0]), *r[1:]) for r in map(tuple, suffixes.remove_repeats(make(rows)).collect()))
    assert got == plain_removal(rows)
    assert [name for name, plan in plans.items() if "MapInArrow" in plan and re.search(r"\btext#", plan)] == ["anchors", "candidates"]
    alone = {r["gram"] for r in tables["digests"].where("n = 1").collect()}
    sorted_ = {r["gram"] for r in tables["sized"].collect()}
    assert sorted_ and sorted_ <= alone and tables["digests"].where("n > 1").count() > 0


def plain_removal(rows, length=200):
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = collections.Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        mark = np.zeros(len(b), dtype=int)
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                mark[k : k + length] = 1
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        out.append((str(i), len(b), int(mark.sum()), int((np.diff(np.r_[0, mark]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_ranks():
    rng = np.random.default_rng(9)
    for k in range(200):
        text = rng.integers(1, 3 if k % 2 else 40, int(rng.integers(1, 70)))
        order = np.argsort(suffixes.suffix_ranks(text))
        assert [tuple(text[i:]) for i in order] == sorted(tuple(text[i:]) for i in range(len(text)))


@pytest.mark.parametrize("group", [1_000_000, 700])
def test_remove_repeats(make, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP_BYTES", group)
    rnd = random.Random(10)
    base = "".join(rnd.choice("abcdé ") for _ in range(1200))
    rows = [(0, base), (1, base[100:700] + "xyz" * 20), (2, "q" * 700), (3, "ab" * 300), (6, base), (6, base[:250]), (7, base[50:249] + "#"), (8, "q" * 200), *ODD]
    for k in range(15):
        x = list(base[:800])
        for _ in range(3):
            x[rnd.randrange(800)] = rnd.choice("XYZ")
        rows.append((20 + k, "".join(x)))
    got = sorted((str(r[0]), *r[1:]) for r in map(tuple, suffixes.remove_repeats(make(rows)).collect()))
    assert got == plain_removal(rows)
    assert suffixes.remove_repeats(make(rows).limit(0)).collect() == []


def test_masks_hit_every_overlap():
    for length in range(decontaminate.MIN_WORDS, decontaminate.WINDOW + 1):
        wrong = length - math.ceil(decontaminate.SIMILARITY * length - 1e-9)
        for changed in itertools.combinations(range(length), wrong):
            assert any(all(s + o not in changed for o in m) for m in decontaminate.MASKS for s in range(length - m[-1]))


@pytest.mark.parametrize(("piece", "bits"), [(4_096, 28), (2, 16)])
def test_overlaps(spark, make, monkeypatch, piece, bits):
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)
    monkeypatch.setattr(decontaminate, "PORTION", 200)
    rnd = random.Random(11)
    items = {k: words_of(rnd, n) for k, n in enumerate([40, 13, 25, 9, 8, 4, 40])}
    items[6] = items[0]
    text = lambda w: " ".join(x.upper() if k % 3 else x + "," for k, x in enumerate(w))
    changed = list(items[2])
    for k in range(0, 25, 7):
        changed[k] = "other"
    rows = [(1, text(words_of(rnd, 30) + items[0] + words_of(rnd, 20))), (2, text(items[1])), (3, text(words_of(rnd, 60) + changed)), (4, text(words_of(rnd, 300))),
            (5, text(items[3] + items[4])), (6, text(items[5])), (7, text(words_of(rnd, 5) + items[0][10:23])), (8, text(items[0][:12])), *[(50 + k, t) for k, (_, t) in enumerate(ODD)]]
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(90, None), (91, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_overlaps(make(rows), benchmark).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 2), (5, 3), (5, 4), (6, 5), (7, 0)}
    assert (got[1, 0]["first_word"], got[1, 0]["n_words"], got[1, 0]["n_equal"]) == (30, 40, 40)
    clean = decontaminate.drop_contaminated(make(rows), benchmark)
    assert clean.columns == make(rows).columns and {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows} - {1, 2, 3, 5, 6, 7}
    assert decontaminate.find_overlaps(make(rows), benchmark.limit(0)).collect() == []
    assert decontaminate.find_overlaps(make(rows).limit(0), benchmark).collect() == []


def plain_overlaps(rows, items):
    """Every window of every item at every place of every document."""
    least = {}
    for i, t in items:
        w = tuple(decontaminate.benchmark_words(t))
        if w:
            least[w] = min(i, least.get(w, i))
    found = set()
    for d, t in rows:
        words = decontaminate.benchmark_words(t)
        for w, i in least.items():
            n = min(13, len(w))
            need = n if len(w) < 8 else math.ceil(0.8 * n - 1e-9)
            if any(sum(x == y for x, y in zip(w[a : a + n], words[b : b + n], strict=True)) >= need for a in range(len(w) - n + 1) for b in range(len(words) - n + 1)):
                found.add((d, i))
    return found


@pytest.mark.parametrize("piece", [4_096, 1])
def test_overlaps_as_all_windows_give_them(spark, make, monkeypatch, piece):
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    rnd = random.Random(12)
    items = [(k, " ".join(f"v{rnd.randrange(300)}" for _ in range(n))) for k, n in enumerate([1, 2, 5, 7, 8, 9, 12, 13, 14, 20, 35, 60])]
    items += [(50, items[9][1].upper().replace(" ", ", ")), (51, items[3][1] + "."), (52, None), (53, "")]
    rows = []
    for d in range(100):
        words = [f"v{rnd.randrange(300)}" for _ in range(rnd.randrange(40))]
        source = rnd.choice(items[:12])[1].split()
        a = rnd.randrange(len(source))
        part = [w if rnd.random() > 0.15 else "other" for w in source[a // 3 :]]
        at = rnd.randrange(len(words) + 1)
        rows.append((d, " ".join(words[:at] + part + words[at:])))
    rows += [(170, items[3][1]), (171, "so " + items[3][1]), (172, None), (173, ""), (170, items[3][1])]
    got = [(r["doc_id"], r["item_id"]) for r in decontaminate.find_overlaps(make(rows), spark.createDataFrame(items, "item_id long, text string")).collect()]
    want = plain_overlaps(rows, items)
    assert set(got) == want and len(want) > 40 and got.count((170, 3)) == 2
    short = {0, 1, 2, 3}
    whole = {" ".join(decontaminate.benchmark_words(t)) for i, t in items if i in short}
    clean = decontaminate.drop_contaminated(make(rows), spark.createDataFrame(items, "item_id long, text string"))
    gone = {d for d, i in want if i not in short} | {d for d, t in rows if " ".join(decontaminate.benchmark_words(t)) in whole}
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - gone and 170 in gone and 171 not in gone


def plain_katz(rows):
    tokens = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in rows]
    train = [t for i, t in tokens if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    one = collections.Counter(w for t in train for w in t)
    two = collections.Counter(p for t in train for p in zip([b"\n", *t[:-1]], t, strict=True))
    n, types = sum(one.values()), len(one)

    def factors(counts):
        of = collections.Counter(counts.values())
        common = 6 * of[6] / of[1] if of[1] else 1.0
        out = {}
        for r in range(1, 6):
            x = ((r + 1) * of[r + 1] / (r * of[r]) - common) / (1 - common) if of[r] and common != 1 else 0
            out[r] = x if 0 < x < 1 else (r - 0.5) / r
        return out

    f1, f2 = factors(one), factors(two)
    alone = {w: f1.get(c, 1) * c / n for w, c in one.items()}
    unknown = 1 - sum(alone.values())
    behind = collections.defaultdict(list)
    for (h, w), c in two.items():
        behind[h].append((w, f2.get(c, 1) * c))
    whole = {h: one[h] + (one[h] - sum(m for _, m in x) < 1e-9 * one[h]) for h, x in behind.items()}
    weight = {h: (1 - sum(m for _, m in x) / whole[h]) / (1 - sum(alone[w] for w, _ in x)) for h, x in behind.items()}
    for h, x in behind.items():
        seen = {w for w, _ in x}
        total = sum(m for _, m in x) / whole[h] + weight[h] * (unknown + sum(p for w, p in alone.items() if w not in seen))
        assert abs(total - 1) < 1e-9
    out = []
    for i, t in tokens:
        score = base = 0
        for h, w in zip([b"\n", *t[:-1]], t, strict=True):
            base += math.log10((one[w] + 1) / (n + types + 1))
            c = two.get((h, w), 0)
            score += math.log10(f2.get(c, 1) * c / whole[h] if c else weight.get(h, 1) * alone.get(w, unknown))
        out.append((str(i), len(t), sum(one[w] > 0 for w in t), n, pytest.approx(base, rel=1e-9), pytest.approx(score, rel=1e-6)))
    return out


@pytest.mark.parametrize("block", [2_000_000, 40])
def test_katz_scores(make, monkeypatch, block):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", block)
    monkeypatch.setattr(katz, "PART_TOKENS", block)
    rnd = random.Random(12)
    rows = [(k, " ".join(f"W{min(rnd.randrange(40), rnd.randrange(40))}" for _ in range(rnd.randint(0, 40)))) for k in range(120)] + list(ODD)
    columns = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted(katz.katz_scores(make(rows)).select(columns).collect(), key=lambda r: (str(r[0]), r[1], r[4]))
    want = sorted(plain_katz(rows), key=lambda r: (r[0], r[1], r[4].expected))
    assert [(str(r[0]), *r[1:]) for r in got] == want
    assert katz.katz_scores(make(rows).limit(0)).collect() == []


def test_katz_without_training_texts(make):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (row,) = katz.katz_scores(make([(held, "a b")])).collect()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (True, 3, 0, 0, 0.0)
