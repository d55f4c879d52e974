"""ProbMinHash near-duplicates, components and embedding links, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from tablesync.llm.components import components
from tablesync.llm.near_dups import mass_bound, near_duplicates, prob_min_hash, probability_jaccard, without_near_duplicates
from tablesync.llm.vectors import link_vectors, spherical_kmeans

SF = "/root/testdata/sf0.001"


def plain_jaccard(x, y):
    return sum(1 / sum(max(x.get(j, 0) / x[e], y.get(j, 0) / y[e]) for j in x.keys() | y.keys()) for e in x.keys() & y.keys())


def classes_of(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_probability_jaccard():
    rnd = random.Random(4)
    for _ in range(200):
        x, y = ({k: rnd.choice([1, 1, 2, 5]) for k in rnd.sample(range(12), rnd.randint(1, 9))} for _ in range(2))
        sides = [(np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)], float)) for d in (x, y)]
        assert probability_jaccard(*sides[0], *sides[1]) == pytest.approx(plain_jaccard(x, y))


def test_mass_bound_is_above():
    rnd = random.Random(7)
    texts = [{k: rnd.choice([1, 1, 1, 3]) for k in rnd.sample(range(30), rnd.randint(5, 25))} for _ in range(40)]
    bags = [(np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)], float)) for d in texts]
    bound = mass_bound(bags[:15], bags[15:])
    for i in range(15):
        for j in range(25):
            assert bound[i, j] >= plain_jaccard(texts[i], texts[15 + j]) - 1e-6
    ones = [(c, np.ones(len(c))) for c, _ in bags]
    assert mass_bound(ones[:1], ones[1:2])[0, 0] == pytest.approx(plain_jaccard(dict.fromkeys(texts[0], 1), dict.fromkeys(texts[1], 1)), abs=1e-5)


def test_registers_agree_with_probability_jaccard():
    x, y = {k: 1 + k % 3 for k in range(1, 60)}, {k: 1 + (k + 1) % 4 for k in range(20, 80)}
    m = 20_000
    got = []
    for d in (x, y):
        code = np.array(sorted(d), np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        got.append(prob_min_hash(np.zeros(len(d), int), code, np.array([d[k] for k in sorted(d)], float), 1, m)[0])
    assert np.mean(got[0] == got[1]) == pytest.approx(plain_jaccard(x, y), abs=0.02)
    assert (got[0] != 0).all()


def test_components(spark):
    rnd = random.Random(6)
    chain = [(k, k + 1) for k in range(1000, 1040)] + [(7, k) for k in range(2000, 2300)]
    links = chain + [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == classes_of([x for x in links if x[0] != x[1]], nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("held", [7, 100])
def test_components_of_more_links_than_a_task_holds(spark, held):
    rnd = random.Random(held)
    links = [(k, k + 1) for k in range(1000, 1040)] + [(5000, k) for k in range(2000, 2200)] + [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(150)]
    rnd.shuffle(links)
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = components(spark.createDataFrame([*links, *links[:50], (None, 3)], "a long, b long").repartition(5), held=held).collect()
    assert len(got) == len(nodes)
    assert {r["node"]: r["component"] for r in got} == classes_of([x for x in links if x[0] != x[1]], nodes)


def test_few_links_take_few_jobs(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(3000)], "a long, b long").repartition(4)
    spark.sparkContext.setJobGroup("few-links", "")
    try:
        found = components(links)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few-links")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) <= 4
    assert found.where("component != 0").count() == 0 and found.count() == 3001


def corpus():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    docs = {}
    for i in range(60):
        docs[i] = [word() for _ in range(rnd.randint(40, 200))]
    for i in range(60, 100):  # near copies at several distances
        docs[i] = list(docs[rnd.randint(0, 20)])
        for _ in range(rnd.randint(0, 4)):
            docs[i][rnd.randrange(len(docs[i]))] = word()
    base = [word() for _ in range(120)]
    for i in range(100, 180):  # a large group, many pairs of which do not link directly
        docs[i] = list(base)
        for _ in range(rnd.randint(0, 3)):
            docs[i][rnd.randrange(120)] = word()
    return {i: " ".join(w) for i, w in docs.items()}


def test_near_duplicates_against_all_pairs(spark):
    texts = corpus()
    bags = {i: Counter(tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)) for i, t in texts.items()}
    links = [(a, b) for a in bags for b in bags if a < b and bags[a].keys() & bags[b].keys() and plain_jaccard(bags[a], bags[b]) >= 0.8]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs, small=4, salts=2).collect()}
    assert got == classes_of(links, texts)


def test_near_duplicates_edges(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " "), (4, "a b"), (5, "A  B"), (5, "A  B"), (6, "b a"), (None, "a b"), (7, long), (8, long + " end"), (9, "x"), (9, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 class_id", "2 kept", "3 key")
    got = sorted(((r["doc_id"] or 0, r["class_id"] or 0, r["kept"]) for r in near_duplicates(docs).collect()))
    want = [(0, 0, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (5, 4, False), (6, 6, True), (7, 7, True), (8, 7, False), (9, 9, True), (9, 9, True)]
    assert got == want
    left = sorted((r["doc_id"] or 0) for r in without_near_duplicates(docs).collect())
    assert left == [0, 1, 2, 3, 4, 6, 7, 9, 9]  # the two texts of id 9 are unlike: neither goes
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_text_goes_unless_one_like_it_stays(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    docs = spark.createDataFrame([(1, a), (1, b), (2, b), (2, b), (3, a + " end"), (None, a)], "doc_id long, text string").selectExpr("*", "7 _number")
    left = without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r["text"].removesuffix(" end") for r in left.where("doc_id is not null").collect()) == [a, b] and left.where("doc_id is null").count() == 1


def test_a_large_group_of_copies(spark):
    docs = spark.range(3000).selectExpr("id doc_id", "if(id % 2 = 0, 'one two three four five six', concat('w', id, ' a b c d e f g h')) text")
    out = near_duplicates(docs)
    assert out.where("doc_id % 2 = 0 and class_id != 0").count() == 0
    assert out.where("doc_id = 0").first()["kept"]


def brute_links(rows):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.95]
    return links


def check_vectors(spark, rows, **parameters):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 node", "2 component_id")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in link_vectors(df, **parameters).collect()}
    links = brute_links([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    n = Counter(x for link in links for x in link)
    classes = classes_of(links, [i for i, _ in rows if i is not None])
    assert {i: (n[i], c, i == c) for i, c in classes.items()} == {i: v for i, v in got.items() if i is not None}
    return got


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 16))
    rows = [*base, *(base[rng.integers(0, 30, 150)] + 0.08 * rng.normal(size=(150, 16))), *np.repeat(base[:1], 40, 0)]
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(len(rows)), rows)]
    check_vectors(spark, rows, cell_rows=20, block_rows=16, slack=1.0)
    check_vectors(spark, rows)


def test_vectors_near_cell_borders(spark):
    # few dimensions inside more: planted partners often lie in different cells
    rng = np.random.default_rng(5)
    flat = rng.normal(size=(1200, 4))
    near = flat[:400] / np.linalg.norm(flat[:400], axis=1, keepdims=True)
    side = rng.normal(size=near.shape)
    side -= (side * near).sum(1, keepdims=True) * near
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([flat, 0.955 * near + np.sqrt(1 - 0.955**2) * side]) @ np.linalg.qr(rng.normal(size=(16, 4)))[0].T
    check_vectors(spark, [(k, [float(c) for c in v]) for k, v in enumerate(x)], cell_rows=40)


def test_vector_edges(spark):
    v = [0.1, 0.2]
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, v), (8, [x * 1e30 for x in v]), (9, [0.1, 0.2, 0.0]), (10, [0.0, 1.0]), (11, [-0.0, 1.0]), (None, v)]
    got = check_vectors(spark, rows)
    assert got[None] == (0, None, True)
    same = spark.createDataFrame([(1, v), (1, v)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in link_vectors(same).collect()] == [(1, 1, 1, True)] * 2
    assert link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_recall_on_the_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = int(((x @ x.T) >= 0.95).sum()) - len(x)
    got = link_vectors(table, cell_rows=100).agg({"n_links": "sum"}).first()[0]
    assert want * 0.9 <= got <= want


def test_kmeans_centres_are_unit():
    x = np.random.default_rng(1).normal(size=(50, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.linalg.norm(spherical_kmeans(x, 7), axis=1) == pytest.approx(np.ones(7))


def test_vectors_in_double_precision(spark):
    rows = [(1, [1e300, 0.0]), (2, [1e300, 1e299]), (3, [1.0, 0.0]), (4, [1e-60, 0.0]), (5, [0.0, 1e-300]), (6, [0.0, float("inf")]), (7, [1.0, 1e-40])]
    out = link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("vec_id").collect()
    assert [(r["n_links"], r["component_id"]) for r in out] == [(4, 1)] * 4 + [(0, 5), (0, 6), (4, 1)]
