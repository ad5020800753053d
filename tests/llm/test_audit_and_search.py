"""The filter audit and the searches against brute force, and their SQL."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from comparing import assert_same
from nightfolio.llm import filter_audit, pivot_search, treap_search
from nightfolio.llm import queries as llm
from nightfolio.llm.common import Leaders

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, hash string, bits int, part int"
LABELS = "doc_id long, quality int, toxic int, part string"


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_pivot_search", "op13_treap_search"])
def test_queries_match_their_sql(spark, name):
    assert_same(llm.QUERIES[name](spark, SF_DIR), llm.ORACLE_SQL[name], SF_DIR)


def audit_texts():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choice(words) for _ in range(250))
    texts = [None, "", " \t\x0b", "a b", "a b", "A$", long, long, long + " ", "x " * 300, "É" * 10]
    texts += ["A" * 3 + "b" * 97, "A" * 4 + "b" * 96, " ".join(words[:200]), " ".join(words[:100] * 2)]
    texts += [" ".join(words[:99] * 3)[:-1], "x y " * 150, " ".join(rng.choice(words) for _ in range(60_000))]
    texts += ["copied text"] * 40
    texts += [rng.choice(["a b", "A|b C", long, "copied text", "q" * 9]) for _ in range(60)]
    return texts


def audit_rows():
    rng = random.Random(4)
    rows = [(i, t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(audit_texts())]
    # Repeated rows, one id with two texts, and rows without an id.
    rows += [rows[3], rows[3], (4, "copied text", "en"), (None, "a b", "en"), (None, "copied text", "de")]
    rng.shuffle(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 80, 2)]
    return rows, labels + [(0, 1, 0), (None, 1, 1), (10_000, 1, 1)]


def brute_audit(rows, labels):
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, mark in labels if mark == 1 and i is not None}
    smallest = {}
    for i, text, _ in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    kinds = Counter()
    for i, text, lang in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        failed = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        failed += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text))
        failed += "D" * bool(re.search("[#$%&*|]", text))
        failed += "E" * (i is not None and i > smallest[text])
        kinds[lang or "", failed, i in good, i in toxic] += 1
    out = defaultdict(Counter)
    shapley = Counter()
    for (part, failed, is_good, is_toxic), n in kinds.items():
        for order in permutations("ABCDE"):
            for step, own in enumerate(order, 1):
                before = any(x in failed for x in order[: step - 1])
                row = out[part, "".join(order), step]
                row["kept"] += n * (own not in failed and not before)
                removed = n * (own in failed and not before)
                row["removed"] += removed
                row["redundant"] += n * (own in failed and before)
                row["unique_fails"] += n * (failed == own)
                row["good_lost"] += removed * is_good
                row["toxic_lost"] += removed * is_toxic
                shapley[part, own] += removed
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {
        (*key, *(row[n] for n in names), shapley[key[0], key[1][key[2] - 1]])
        for key, row in out.items()
    }


@pytest.mark.parametrize("limit", [filter_audit.BROADCAST_HASHES, 0])
def test_audit_against_brute_force(spark, limit):
    rows, labels = audit_rows()
    docs = spark.createDataFrame([(*r, "clash", 3, 4) for r in rows], DOCS).repartition(5)
    marked = spark.createDataFrame([(*r, "clash") for r in labels], LABELS)
    counts = filter_audit.combinations(docs, marked, limit)
    found = filter_audit.interactions(counts)
    assert found.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    ]
    found = [tuple(r) for r in found.collect()]
    assert len(found) == len(set(found)) == 3 * 600
    assert set(found) == brute_audit(rows, labels)


def test_audit_of_an_empty_table(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, pivot string, chunk int"


def search_rows(rng, count, width):
    centres = rng.normal(size=(6, width))
    rows = [(i, (centres[i % 6] * 2 + rng.normal(size=width) / 5).tolist()) for i in range(count)]
    rows += [(count + i, centres[0].tolist()) for i in range(count // 2)]  # one vector, many ids
    return rows


def odd_rows():
    return [
        (20_000, None), (20_020, []), (20_040, [1.0, None]), (20_060, [float("nan"), 1.0]),
        (20_080, [float("inf")]), (None, [1.0, 1.0]), (20_100, [0.5]), (20_120, [0.0] * 9),
        (-20, [3.0, -1.0]), (0, [2.0]), (0, [2.0]), (20, [-1.0, 4.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
    ]


def brute_search(rows, top, step):
    usable = []
    for i, values in rows:
        if i is not None and values and all(v is not None and math.isfinite(v) for v in values):
            usable.append((i, tuple(math.floor(64 * float(np.float32(v))) for v in values)))
    out = set()
    for i, own in {u for u in usable if u[0] % step == 0}:
        scored = [(-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(own, v)))), j) for j, v in usable if j != i]
        scored.sort()
        out |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:top])}
    return out


def found_search(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 1, "clash", 2) for i, v in rows], VECTORS)
    return [tuple(r) for r in pivot_search.search(frame.repartition(4), **options).collect()]


@pytest.mark.parametrize("chunk, pivot, group", [(1024, 4096, 64), (8, 40, 5), (1, 3, 1)])
def test_search_against_brute_force(spark, monkeypatch, chunk, pivot, group):
    monkeypatch.setattr(pivot_search, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(pivot_search, "PIVOT_ROWS", pivot)
    monkeypatch.setattr(pivot_search, "GROUP_LEAST", group)
    monkeypatch.setattr(pivot_search, "GROUPS", 1000)
    rows = search_rows(np.random.default_rng(1), 160, 9) + odd_rows()
    found = found_search(spark, rows, top=7, step=20)
    assert set(found) == brute_search(rows, 7, 20)
    # The repeated candidate 7 has a rank for each row, the repeated query 0 one result.
    assert len(found) == len(set(found))


def test_annuli_are_shared_when_there_are_many(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "CHUNK_ROWS", 4)
    monkeypatch.setattr(pivot_search, "PIVOT_ROWS", 40)
    monkeypatch.setattr(pivot_search, "ANNULI", 10)
    rows = search_rows(np.random.default_rng(2), 160, 9)
    assert set(found_search(spark, rows, top=5, step=10)) == brute_search(rows, 5, 10)


def test_search_with_huge_components_and_few_rows(spark):
    rows = [(0, [1e30, 2.0]), (1, [1e9, 1.0]), (2, [-1e30, 1.0]), (3, [1e18, 5.0]), (20, [3.0])]
    assert set(found_search(spark, rows)) == brute_search(rows, 20, 20)
    assert found_search(spark, []) == []
    assert found_search(spark, [(0, [1.0])]) == []


def test_bounds_hold_and_exclude():
    rng = np.random.default_rng(3)
    space = pivot_search.Space(5, 10_000)
    space.pivots = rng.integers(-500, 500, (4, 5)).astype(float)
    queries = rng.integers(-500, 500, (30, 5))
    excluded = 0
    for pivot in range(4):
        rows = (space.pivots[pivot] + rng.normal(size=(40, 5)) * 20).astype(int)
        away = space.distances(rows.astype(float), space.pivots[[pivot]])[:, 0]
        norm = np.linalg.norm(rows, axis=1).max()
        limit = pivot_search.bounds(space, queries, pivot, away.min(), away.max(), norm)[:, 0]
        best = (queries @ rows.T).max(axis=1)
        assert (best <= limit).all()
        excluded += (limit < np.median(best)).sum()
    assert excluded > 20


def test_leaders_keep_the_best_by_score_and_id():
    rng = np.random.default_rng(4)
    leaders, seen = Leaders(np.full(5, -(1 << 63)), 4), defaultdict(list)
    for _ in range(12):
        query = rng.integers(0, 5, 30)
        found, score = rng.integers(0, 200, 30), rng.integers(-5, 5, 30)
        good = score >= leaders.least[query]
        leaders.merge(query[good], found[good], score[good])
        for q, f, s in zip(query.tolist(), found.tolist(), score.tolist()):
            seen[q].append((-s, f))
    for q in range(5):
        own = leaders.query == q
        assert [(-s, f) for s, f in zip(leaders.score[own], leaders.found[own])] == sorted(seen[q])[:4]


def test_treap_holds_the_grid():
    rng = np.random.default_rng(5)
    grid = rng.integers(1, 100, (37, 90)) * (rng.random((37, 90)) < 0.1)
    rows, columns = np.nonzero(grid)
    tree = treap_search.Treap(rows, columns, grid[rows, columns])
    assert tree.height == 7 and tree.top[0] == grid.max()
    for row in range(37):
        for column in range(90):
            cell, low = np.array([0]), 0
            for level in range(tree.height):
                shift = tree.height - 1 - level
                which = np.array([2 * (row >> shift & 1) + (column >> shift & 1)])
                cell = tree.quarter(cell, which)
                if cell[0] < 0:
                    break
                r, c = row >> shift << shift, column >> shift << shift
                assert tree.top[cell[0]] == grid[r : r + (1 << shift), c : c + (1 << shift)].max()
            assert (grid[row, column] == 0) if cell[0] < 0 else tree.top[cell[0]] == grid[row, column]


def test_explore_opens_only_what_may_count():
    rng = np.random.default_rng(6)
    grid = rng.integers(1, 50, (20, 512)) * (rng.random((20, 512)) < 0.3)
    grid[:, 100] = 60
    rows, columns = np.nonzero(grid)
    tree = treap_search.Treap(rows, columns, grid[rows, columns])
    own = [np.array([1, 5, 7]), np.array([0]), np.array([19, 18, 17, 16, 3])]
    taken = []

    class Counting(Leaders):
        def merge(self, query, found, score):
            taken.extend(found.tolist())
            super().merge(query, found, score)

    leaders = Counting(np.zeros(3, np.int64), 3)
    treap_search.explore(tree, np.arange(512), np.arange(3), own, leaders, beam=2)
    for k, terms in enumerate(own):
        score = grid[terms].sum(axis=0)
        best = np.lexsort((np.arange(512), -score))[:3]
        assert leaders.found[leaders.query == k].tolist() == best.tolist()
        assert leaders.score[leaders.query == k].tolist() == score[best].tolist()
    assert len(taken) < 400  # of 1,536 scores


def search_texts():
    rng = random.Random(7)
    words = ["alpha", "Beta", "GAMMA", "ñandú", "Ñandú", "x", "7", "don", "t", "été", "日本", "e2e"]
    words += [f"w{i}" for i in range(40)]
    marks = [" ", ", ", "-", "\n", "\x0b", "'", "_", "{", "\x7f", "\x00"]
    texts = [None, "", " .,!", "alpha", "ALPHA", "x" * 9_000, "don't", "日本 日本", "alpha beta " * 40_000]
    for _ in range(150):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(1, 60)))
        texts.append(text)
    return texts + ["alpha gamma w1"] * 80


def brute_terms(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)


def brute_ranking(docs, items, top):
    counted = [(i, Counter(brute_terms(text))) for i, text in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, terms in {(i, tuple(sorted(set(brute_terms(t))))) for i, t in items if i is not None}:
        scored = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = 0
            for t in terms:
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        scored.sort()
        out += [(item, k + 1, None if no else i, -s) for k, (s, no, i) in enumerate(scored[:top])]
    return Counter(out)


@pytest.mark.parametrize("block, open_, top", [(1 << 17, 4096, 50), (40, 4096, 7), (200, 8, 3)])
def test_ranking_against_brute_force(spark, monkeypatch, block, open_, top):
    monkeypatch.setattr(treap_search, "OPEN_TERMS", open_)
    texts = search_texts()
    docs = list(enumerate(texts, -3)) + [(5, texts[5]), (None, "alpha gamma w1"), (None, "w1 w2 x")]
    rng = random.Random(8)
    items = [(i, rng.choice(texts[9:])) for i in range(12)]
    items += [(0, items[0][1]), (1, "alpha"), (50, None), (51, "!"), (52, "unseen"), (None, "alpha"), (53, "ÑANDÚ x 日本")]
    frame = spark.createDataFrame([(*r, 1, "c") for r in docs], "doc_id long, text string, n int, item_id string")
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    found = treap_search.search(frame.repartition(5), asked, top, block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == brute_ranking(docs, items, top)


def test_ranking_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "alpha")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    assert treap_search.search(docs.limit(0), items).count() == 0
    assert treap_search.search(docs, items.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in treap_search.search(docs, items).collect()] == [(1, 1, 1)]
