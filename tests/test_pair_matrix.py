"""The matrix of all pairs of a cluster against brute force: no score and no pair of files is left out."""

import random

import numpy as np
import pyarrow as pa
import pytest

from dupelens.functions.labels import STATUS_TABLES
from dupelens.operators import candidates, pair_matrix
from dupelens.plans import fuzzy_detection as fuzzy
from dupelens.queries import check_sql, spark_queries
from tests.compare import compare
from tests.test_similarity import naive

UNIT = ("fingerprint", "source", "format")
FILES = "asset_id string, file_key string, format string, source string, duration double, fingerprint string, words array<bigint>"


def files(seed=8, n=70):
    """Copies, near copies and others in two clusters; files of one asset, a file that comes twice, contents that are missing."""
    rnd = random.Random(seed)
    base = [rnd.randrange(0, 40) for _ in range(30)]
    rows = []
    for i in range(n):
        words = base if i % 5 == 0 else [rnd.randrange(0, 40) for _ in range(rnd.randrange(1, 30))]
        if i % 5 == 1:
            words = base[:20] + [100 + i, 200 + i]
        if i % 5 == 2:
            words = [1000 + 50 * i + k for k in range(rnd.randrange(1, 30))]
        missing = i % 35 == 33
        duration = 100.0 + i % 4 + 50 * (i % 3 == 0)
        fingerprint = f"none{i}" if missing else str(words)
        rows.append((f"a{i // 2}", f"f{i}", "wav" if i % 2 else "mp3", "s1" if i % 7 else "s2", duration, fingerprint, None if missing else words))
    return rows + rows[3:6]


def all_pairs(rows, reach=120):
    pairs = {}
    for a in rows:
        for b in rows:
            one, other = (x[5:6] + x[3:4] + x[2:3] for x in (a, b))
            clusters = [100.0 if x[4] < 140 else 150.0 for x in (a, b)]
            if (one, a[:2]) < (other, b[:2]) and clusters[0] == clusters[1] and a[6] and b[6]:
                pairs[(clusters[0], *one, *other)] = 1.0 if a[5] == b[5] else naive(a[6], b[6], reach)
    return pairs


@pytest.mark.parametrize(("block", "reach"), [(1024, 120), (9, 4), (1, 120)])
def test_every_pair_of_a_cluster_is_scored(spark, monkeypatch, block, reach):
    monkeypatch.setattr(pair_matrix, "BLOCK_UNITS", block)
    rows = files()
    blocked = fuzzy.block(spark.createDataFrame(rows, FILES))
    found = pair_matrix.unit_pairs(blocked.records, blocked.classes, reach).collect()
    scores = {(r["cluster_start"], *(r[f"{c}_{n}"] for n in (1, 2) for c in UNIT)): r["similarity"] for r in found}
    expected = all_pairs(rows, reach)
    assert scores == expected and len(found) == len(expected)
    assert min(expected.values()) == 0 and sum(0 < s < 0.6 for s in expected.values()) > 100


@pytest.mark.parametrize("cells", [1, 3000, 1 << 18])
@pytest.mark.parametrize("between", [False, True])
def test_pairs_are_counted_in_pieces(monkeypatch, cells, between):
    rnd = random.Random(cells)
    words = [[rnd.choice([0, 1, rnd.randrange(9), rnd.getrandbits(40)]) for _ in range(rnd.randrange(1, 40))] for _ in range(23)]
    sides = (np.arange(0, 23, 2), np.arange(1, 23, 2)) if between else None
    monkeypatch.setattr(pair_matrix, "CELLS", cells)
    for piece in (1, 50, 1 << 20):
        monkeypatch.setattr(candidates, "PIECE", piece)
        one, other, score = pair_matrix._content_pairs(pa.array(words, pa.list_(pa.int64())), sides, 6)
        found = {(int(a), int(b)): s for a, b, s in zip(one, other, score)}
        assert len(found) == len(one)
        assert found == {
            (i, j): naive(words[i], words[j], 6) for i in range(23) for j in range(i + 1, 23) if not between or (i + j) % 2
        }


@pytest.mark.parametrize("most", [1, 10])
def test_rows_of_a_group_come_in_batches(monkeypatch, most):
    words = {"a": [1, 2], "b": [3], "c": [2, 2, 1]}
    units = [(f, s, "wav", s == "s1") for f in (*words, "missing") for s in ("s2", "s1", "s3")]
    columns = {"fingerprint": [*words, *(u[0] for u in units)], "words": pa.array([*words.values(), *[None] * 12], pa.list_(pa.int64()))}
    columns |= {name: [None] * 3 + [u[n] for u in units] for n, name in enumerate(("source", "format", "several"), 1)}
    columns |= {name: pa.array([0] * 15, pa.int32()) for name in ("low", "high", "own")}
    rows = pa.table(columns | {"cluster_start": [7.0] * 15})
    monkeypatch.setattr(pair_matrix, "ROWS", most)
    made = pair_matrix._group_pairs(rows, 120)
    found = [tuple(r[c] for c in ("fingerprint_1", "source_1", "fingerprint_2", "source_2", "similarity")) for r in made.to_pylist()]
    scores = {("a", "b"): 0.0, ("a", "c"): 0.5, ("b", "c"): 0.0}
    expected = [(f, s, g, t, score) for (f, g), score in scores.items() for s in ("s1", "s2", "s3") for t in ("s1", "s2", "s3")]
    expected += [(f, s, f, t, 1.0) for f in "abc" for s, t in (("s1", "s1"), ("s1", "s2"), ("s1", "s3"), ("s2", "s3"))]
    assert sorted(found) == sorted(expected)
    assert max(len(b) for b in made.to_batches()) <= max(9, most)


def test_the_query_lists_low_scores_and_formats_of_one_asset(spark, tmp_path):
    import duckdb

    common = [f"word{i}" for i in range(20)]
    shares = {1: 20, 2: 17, 3: 11, 4: 6, 5: 2, 6: 0, 10: 20}
    rows = [(i, " ".join(common[:n] + [f"own{i}x{k:02d}" for k in range(20 - n)]), "en", "s", 200 + i % 3) for i, n in shares.items()]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    frame = spark_queries()["all_pairs_matrix"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    problem, _ = compare("all_pairs_matrix", frame, con, check_sql()["all_pairs_matrix"])
    assert problem is None, problem
    found = frame.collect()
    # Files by content, source and format: the texts of 2 to 6 as two formats, that of 1 and 10 as wav and mp3 of 1 (odd), as wav of
    # 10 (even), and with another ending as mp3 of 5 and 10.
    units = {(t[1] + "#mp3" * (f == "mp3" and t[0] % 5 == 0), t[0] % 2, f) for t in rows for f in ("wav", "mp3")}
    assert len(found) == len(units) * (len(units) - 1) // 2
    assert {r["status"] for r in found} == {label for _, label in STATUS_TABLES["version"]}
    assert {r["similarity"] for r in found} >= {0.0, 0.1, 0.3, 0.55, 0.85, 1.0}
    same_asset = [r for r in found if r["fingerprint_1"] == r["fingerprint_2"] and r["same_version_diff_format"]]
    assert len(same_asset) == 5
