"""Near-duplicate operators against brute force."""

import random

import numpy as np
import pytest
from cases import ROWS, documents, ids

from topicflow.llm import jaccard, nearvectors
from topicflow.llm.graph import components, spanning


def _least(nodes, links):
    index = {n: k for k, n in enumerate(sorted(nodes))}
    a, b = (np.array([index[x[k]] for x in links], int) for k in (0, 1)) if links else (np.zeros(0, int), np.zeros(0, int))
    label, order = spanning(len(index), a, b), sorted(nodes)
    return {n: order[label[k]] for n, k in index.items()}


def test_components(spark):
    r = random.Random(9)
    chain = [(i, i + 1) for i in range(100, 160)]
    links = chain + [(r.randint(0, 90), r.randint(0, 90)) for _ in range(60)] + [(200, x) for x in range(201, 260)] + [(5, 5)]
    want = {n: c for n, c in _least({x for p in links for x in p}, links).items() if n != c}
    df = spark.createDataFrame(links, "a long, b long")
    assert {x.node: x.component for x in components(spark, df).collect()} == want
    assert components(spark, df.limit(0)).count() == 0


def _set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w)} - {()} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def _brute(rows):
    sets = [_set(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = _least(range(len(rows)), links)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    return sorted(((i, len(sets[k]), least.get(root[k])) for k, (i, _) in enumerate(rows)), key=str)


def _got(spark, df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_texts(spark, df).collect()), key=str)


def test_near_texts_edges(spark):
    assert _got(spark, documents(spark)) == _brute([r[:2] for r in ROWS])
    assert _got(spark, documents(spark).limit(0)) == []
    kept = jaccard.one_of_each(spark, documents(spark))
    assert kept.columns == documents(spark).columns
    assert ids(kept.collect()) == [None, None, 1, 3, 4, 5, 6, 7, 8, 10, 11]


def test_one_of_each_goes_by_row_where_an_id_stands_on_several_texts(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (2, a + " more"), (2, b), (3, b), (4, c), (4, c + " more"), (4, c.upper()), (4, c), (5, ""), (5, ""), (5, a), (6, "only this"), (None, a)]
    got = jaccard.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((x.doc_id, x.text) for x in got if x.doc_id != 4), key=str) == sorted([(1, a), (2, b), (5, ""), (5, ""), (6, "only this"), (None, a)], key=str)
    assert len([x for x in got if x.doc_id == 4]) == 1


@pytest.mark.parametrize("block,frequent", [(512, 1 << 16), (8, 4)])
def test_near_texts_equal_brute_force(spark, monkeypatch, block, frequent):
    """Families whose members link along chains, shared passages, common
    words; small blocks and orders of shingles give the same."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    r = random.Random(10)
    word = lambda: r.choice(["the", "of", "a"]) if r.random() < 0.3 else f"w{r.randint(0, 400)}"
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(6):
        base = [word() for _ in range(r.choice([8, 40, 90]))]
        for _ in range(25):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                k = r.randrange(len(w))
                w[k:k + 1] = r.choice([[], [word()], [word(), word()]])
            texts.append(" ".join(w))
            if r.random() < 0.3:
                base = w
    texts += [" ".join([word() for _ in range(r.randint(0, 12))] + passage) for _ in range(40)]
    texts += [" ".join(word() for _ in range(r.randint(0, 60))) for _ in range(60)]
    texts += r.sample(texts, 20)
    rows = list(enumerate(texts))
    r.shuffle(rows)
    assert _got(spark, spark.createDataFrame(rows, "doc_id long, text string")) == _brute(rows)


def test_one_of_each_with_clashing_columns(spark):
    text = "a b c d e f g h i j"
    names = ["_gone", "_again", "_class", "_wanted", "id", "row", "class", "gone", "again", "n_shingles", "component_id", "key", "run"]
    rows = [(k, t, *names) for k, t in [(1, text), (2, text), (3, "other words that stand alone here"), (3, text), (4, None), (None, text), (3, "other words that stand alone here")]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = jaccard.one_of_each(spark, docs)
    assert out.columns == docs.columns
    assert sorted([tuple(r) for r in out.collect()], key=str) == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)


def test_partners_in_several_runs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_PARTNERS", 3)
    monkeypatch.setattr(jaccard, "_PAIRS_IN_BATCH", 2)
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(base[:i] + ["x"] + base[i:])) for i in range(50)] + [(100 + i, " ".join(f"z{i}_{k}" for k in range(9))) for i in range(5)]
    assert _got(spark, spark.createDataFrame(rows, "doc_id long, text string")) == _brute(rows)


def test_bounds_are_upper_bounds():
    r = np.random.default_rng(1)
    for _ in range(200):
        u = r.integers(0, 1 << 62, 400).astype(np.uint64)
        a, b = (np.unique(r.choice(u, r.integers(1, 300))) for _ in range(2))
        bits = jaccard.folded([jaccard.bitmap(a), jaccard.bitmap(b)])
        bound = jaccard.most_overlap(bits[:1], bits[1:], np.array([len(a)]), np.array([len(b)]))[0, 0]
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


def _vectors():
    r = np.random.default_rng(2)
    rows = []
    for k in range(40):
        base = r.normal(size=16)
        rows += [list(map(float, base + r.normal(size=16) * 0.08)) for _ in range(1 + k % 12)]
    rows += [list(map(float, rows[0])) for _ in range(60)]
    return rows


@pytest.mark.parametrize("block", [1024, 16])
def test_near_vectors_recall_and_edges(spark, monkeypatch, block):
    monkeypatch.setattr(nearvectors, "BLOCK", block)
    rows = _vectors()
    n = len(rows)
    bad = [(n, None), (n + 1, [0.0] * 16), (n + 2, [float("nan")] * 16), (n + 3, [1.0] * 3), (n + 4, []), (n + 5, [None] + [1.0] * 15), (None, rows[0])]
    data = [(i, v, 1, "x") for i, v in enumerate(rows)] + [(i, v, 1, "x") for i, v in bad] + [(0, rows[0], 1, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, vector string")
    got = nearvectors.near_vectors(spark, df).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(str(d[0]) for d in data)
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = [(i, j) for i, j in np.argwhere(x @ x.T >= 0.95).tolist() if i < j]
    degree = np.bincount(np.array(links).ravel(), minlength=n)
    by = {r.vec_id: r for r in got}
    assert all(by[i].n_links <= degree[i] for i in range(n))
    assert sum(by[i].n_links for i in range(n)) >= 0.97 * degree.sum()
    want = _least(range(n), links)
    assert np.mean([by[i].component_id == want[i] for i in range(n)]) > 0.97
    assert all(by[i].kept == (by[i].component_id == i) for i in range(n))
    for i, _ in bad[:-1]:
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)
    assert (by[None].n_links, by[None].component_id, by[None].kept) == (0, None, False)
    assert nearvectors.near_vectors(spark, df.limit(0)).count() == 0
    assert nearvectors.near_vectors(spark, df.where(f"vec_id in ({n}, {n + 1})")).count() == 2


def test_vectors_of_each_length_have_their_index(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.1, 0.0]), (5, [3.0]), (6, [0.5]), (7, [-1.0]), (8, [0.0, 1.0])]
    rows += [(100 + i, [float(np.cos(i)), float(np.sin(i)), 1.0, 5.0]) for i in range(40)] + [(200 + i, [1.0] * 5) for i in range(3000)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in nearvectors.near_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert [got[i] for i in range(1, 9)] == [(1, 1, True), (1, 1, False), (1, 3, True), (1, 3, False), (1, 5, True), (1, 5, False), (0, 7, True), (0, 8, True)]
    assert all(got[200 + i] == (2999, 200, i == 0) for i in range(3000))
    assert {c for _, c, _ in (got[100 + i] for i in range(40))} == {100}


def test_shared_values_equal_brute_force():
    r = np.random.default_rng(3)
    for _ in range(50):
        left, right = ([r.choice(12, 4, replace=False) for _ in range(r.integers(1, 30))] for _ in range(2))
        i, j = nearvectors.sharing(np.array(left), np.array(right), 2)
        assert set(zip(i.tolist(), j.tolist())) == {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if len(set(x) & set(y)) >= 2}


def test_word_hashes():
    """One hash a word, equal for equal words only, wherever the text is cut."""
    text = "A b\x0bC\x0cd e F\t\n" * 3000 + "x" * 9000 + " y\x1cz é" + "q" * 5000 + " Q" + "q" * 4999
    words = jaccard.words_of(text)
    got = jaccard.word_hashes(text).tolist()
    assert len(got) == len(words) and len(set(got)) == len(set(words)) == len(set(zip(words, got)))
    assert jaccard.word_hashes(b" ".join(words)).tolist() == got
    assert not len(jaccard.word_hashes(None)) and not len(jaccard.word_hashes(" \n"))
    assert len(jaccard.shingles(jaccard.word_hashes(text))) == len({tuple(words[i:i + 5]) for i in range(len(words) - 4)})


def test_last_round_takes_only_classes_with_a_partner(spark, monkeypatch):
    """Texts that share a passage and no more are ruled out once; texts go to the pairs without being stored in between."""
    r, rows = random.Random(4), []
    for k in range(24):  # the longer text shares the rare shingles of the other two, which then need not meet in round 1
        base = [f"{k}x{r.random()}" for _ in range(100)]
        rows += [base, [*base[:-1], "other"], [*base, *(f"{k}y{r.random()}" for _ in range(100))]]
    passage = [f"p{k}" for k in range(12)]
    rows += [[*passage, *(f"{k}z{r.random()}" for _ in range(20))] for k in range(30)]
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)]
    tiles, names, plain = [], [], jaccard.staged

    def staged(spark, df, name, *folders):
        out = plain(spark, df, name, *folders)
        names.append(name)
        if name == "tiles":
            tiles.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "staged", staged)
    monkeypatch.setattr(jaccard, "FREQUENT", 0)  # so that the passage is in their prefixes
    assert _got(spark, spark.createDataFrame(rows, "doc_id long, text string")) == _brute(rows)
    assert len(tiles) == 2 and tiles[0] >= 30 and tiles[1] == 0
    assert "settled" in names and "texts" not in names
