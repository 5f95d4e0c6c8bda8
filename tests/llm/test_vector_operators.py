import numpy as np
import pytest

from rowlens.llm import embeddings, hnsw
from rowlens.llm.graph import components

SCHEMA = "vec_id long, embedding array<float>, label int, id int, vector int, rep int"


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [x if x is None else float(x) for x in v], 0, 1, 2, 3) for i, v in vectors], SCHEMA)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(600, 16)).astype(np.float32)
    rows[100:160] = rows[0] + rng.normal(size=(60, 16)).astype(np.float32) * 0.25
    rows[300:310] = rows[5]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] + [1.0] * 15), (904, [float("inf")] * 16), (905, []), (None, rows[3])]
    return list(enumerate(rows)) + odd


def test_near_vectors_equal_brute_force(llm, vectors):
    good = [(i, np.asarray(v, np.float64)) for i, v in vectors[:600]]
    unit = np.array([v / np.linalg.norm(v) for _, v in good])
    linked = unit @ unit.T >= 0.95
    home = np.arange(600)
    for _ in range(600):
        new = np.array([home[row].min() for row in linked])
        if (new == home).all():
            break
        home = new
    found = {r.vec_id: r for r in embeddings.near_vectors(table(llm, vectors)).collect()}
    assert all(found[i].component_id == home[i] and found[i].kept == (home[i] == i) for i in range(600))
    assert all(found[i].n_links == linked[i].sum() - 1 + (i == 3) for i in range(600))  # the row with a null key equals row 3
    assert all(found[i].n_links == 0 and found[i].component_id == i for i in range(900, 906))


def test_neighbours(llm, vectors):
    df = table(llm, vectors)
    found = hnsw.neighbours(df, df.where("vec_id % 20 = 0"), k=20).collect()
    rows = np.array([v for _, v in vectors[:600]], np.float64)
    hits = 0
    for q in range(0, 600, 20):
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and q not in [r.vec_id for r in mine]
        scores = rows @ rows[q]
        scores[q] = -np.inf
        assert all(r.score == pytest.approx(scores[r.vec_id], rel=1e-12) for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & set(np.lexsort((np.arange(600), -scores))[:20]))
    assert hits >= 0.95 * 600


def test_few_or_no_vectors(llm):
    few = table(llm, [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0])])
    assert [(r.query_id, r.vec_id) for r in hnsw.neighbours(few, few.where("vec_id % 20 = 0")).orderBy("query_id").collect()] == [(0, 20), (20, 0)]
    none = table(llm, [])
    assert hnsw.neighbours(none, none).count() == 0 and embeddings.near_vectors(none).count() == 0


def test_rows_without_a_key_are_ends_of_links(llm):
    """A null key near row 0, one equal to row 1, two equal ones that alone would join rows 4 and 5, and one far from all."""
    turn = lambda degrees: [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]
    rows = [(0, turn(0)), (None, turn(0.5)), (1, turn(90)), (None, turn(90)), (4, turn(180)), (None, turn(190)), (None, turn(190)), (5, turn(205)), (None, turn(300))]
    found = embeddings.near_vectors(table(llm, rows)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found if r.vec_id is not None} == {
        0: (1, 0, True), 1: (1, 1, True), 4: (2, 4, True), 5: (2, 5, True)
    }
    assert sorted((r.n_links, r.component_id, r.kept) for r in found if r.vec_id is None) == [(0, None, True), (1, None, True), (1, None, True), (3, None, True), (3, None, True)]


def test_components_of_chains_and_stars(llm):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 3)]
    found = {r.id: r.component_id for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 160), 100)}


def test_blocks_meet_without_a_shuffle(llm, vectors, monkeypatch):
    """Pairs of blocks are never on disk, vectors are staged once as they were given, and two widths in one table, given as doubles, come out as by brute force."""
    plans, stage = {}, embeddings.stage
    monkeypatch.setattr(embeddings, "BLOCK", 40)
    monkeypatch.setattr(embeddings, "stage", lambda df, name: plans.update({name: (df._jdf.queryExecution().executedPlan().toString(), df.schema)}) or stage(df, name))
    rows = [(i, np.float64(v)[: 16 if i % 3 else 8] * 1.1) for i, v in vectors[:300]]
    df = llm.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
    unit = [v / np.linalg.norm(v) for _, v in rows]
    assert found == {i: sum(len(x) == len(y) and x @ y >= 0.95 for y in unit) - 1 for i, x in enumerate(unit)}
    tiles, _ = plans["found"]
    assert "CartesianProduct" in tiles and "Exchange" not in tiles
    assert [name for name, (_, schema) in plans.items() if "vector" in schema.fieldNames()] == ["classes"]
    embeddings.near_vectors(table(llm, vectors[:50])).count()
    assert plans["classes"][1]["vector"].dataType.simpleString() == "array<float>"
