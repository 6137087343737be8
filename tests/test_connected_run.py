"""The connected detection run: known pairs, errors, counts, and runs that were stopped."""

import random

import pytest
from pyspark.sql import functions as F

from dupelens.operators import candidates
from dupelens.plans import fuzzy_detection as fuzzy
from dupelens.plans import resumable
from dupelens.runtime import fresh_path
from tests.test_similarity import naive

RECORDS = "asset_id string, file_key string, format string, source string, duration double, fingerprint string, words array<bigint>"


def records(seed=3, n=60, missing=True):
    """Files with few different contents, in three clusters; some contents are missing, in one copy or in all."""
    rnd = random.Random(seed)
    contents = [[rnd.randrange(0, 500) for _ in range(30)] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(contents[i % 6])
        if i % 4 == 0:
            words[rnd.randrange(30)] = 900 + i % 3
        name = str(words)
        if missing and i % 9 == 4:
            name, words = f"lost {i % 2}", None if i % 2 else []
        rows.append((f"a{i // 3}", f"f{i}", "wav" if i % 2 else "mp3", "s1" if i % 5 else "s2", 100.0 * (i % 3) + i % 2, name, words))
    if missing:
        rows.append(("extra", "unreadable copy", "wav", "s1", rows[1][4], rows[1][5], None))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, RECORDS).repartition(3)


def by_unit_pair(found):
    return {tuple(r[c] for c in fuzzy.UNIT_PAIR): (r["similarity"], r["file_pairs"]) for r in found.collect()}


def unit(row, start):
    return (row[5], row[3], row[2]), start


def brute(rows, threshold=0.6, known=()):
    """Similarity and file pairs per pair of units, and the comparisons that fail, file by file."""
    content = {}
    for row in rows:
        content[row[5]] = content.get(row[5]) or row[6]
    known = {frozenset(k) for k in known}
    found, failed = {}, 0
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            if int(a[4] // 100) != int(b[4] // 100) or a[0] == b[0]:
                continue
            if not content[a[5]] or not content[b[5]]:
                failed += 1
                continue
            score = naive(content[a[5]], content[b[5]], 120)
            if score < threshold or frozenset([a[:2], b[:2]]) in known:
                continue
            one, two = sorted([(a[5], a[3], a[2]), (b[5], b[3], b[2])])
            start = min(r[4] for r in rows if int(r[4] // 100) == int(a[4] // 100))
            key = (start, *one, *two)
            found[key] = (score, found.get(key, (0, 0))[1] + 1)
    return found, failed


def test_errors_come_out_of_the_scoring_pass(spark):
    rows = records()
    blocked = fuzzy.block(frame(spark, rows))
    assert "words" not in blocked.records.columns
    found = fuzzy.compare(blocked)
    expected, failed = brute(rows)
    assert by_unit_pair(found.pairs) == expected
    lost = {r[1] for r in rows if not r[6]} - {"unreadable copy"}
    errors = found.errors.collect()
    assert {r.file_key for r in errors} == lost
    for r in errors:
        row = next(x for x in rows if x[1] == r.file_key)
        assert r.comparisons == sum(int(x[4] // 100) == int(row[4] // 100) and x[0] != row[0] for x in rows)
    summary = fuzzy.run_summary(blocked, found).first()
    assert summary.errors == failed > 0
    assert summary.duplicates == sum(n for _, n in expected.values())
    assert found.counts["errors"] == blocked.classes.where("length = 0").count() > 0
    assert found.counts["scored"] >= found.counts["results"] > 0


def test_known_file_pairs_are_taken_off(spark):
    rows = records(missing=False)
    everything, _ = brute(rows)
    known = [(rows[i][:2], rows[j][:2]) for i in range(0, 60, 2) for j in range(1, 60, 5)]
    expected, _ = brute(rows, known=known)
    stored = [(*b, *a) if i % 2 else (*a, *b) for i, (a, b) in enumerate(known)] + [(*known[0][0], *known[0][1])] * 2
    stored += [("nobody", "x", "a1", "f3"), ("a1", "f3", None, None)]
    table = spark.createDataFrame(stored, "asset_id_1 string, file_key_1 string, asset_id_2 string, file_key_2 string")
    found = by_unit_pair(fuzzy.detect(fuzzy.block(frame(spark, rows)), known=table))
    assert found == expected
    assert 0 < sum(n for _, n in found.values()) < sum(n for _, n in everything.values())


def test_fully_known_pairs_are_never_scored(spark, monkeypatch):
    rows = records(missing=False)
    known = [(*a[:2], *b[:2]) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[5] != b[5] and (i % 3 or a[4] < 100)]
    table = spark.createDataFrame(known, "asset_id_1 string, file_key_1 string, asset_id_2 string, file_key_2 string")
    asked = []
    plain = candidates.score_pairs

    def watched(pairs, classes, *more):
        names = {r.class_id: (r.cluster_start, r.fingerprint) for r in classes.collect()}
        asked.extend((names[r.class_1], names[r.class_2]) for r in pairs.where("class_2 is not null").collect())
        return plain(pairs, classes, *more)

    monkeypatch.setattr(candidates, "score_pairs", watched)
    fuzzy.compare(fuzzy.block(frame(spark, rows)), known=table)
    open_pairs = {
        frozenset([a[5], b[5]]) for i, a in enumerate(rows) for b in rows[i + 1 :]
        if a[5] != b[5] and a[0] != b[0] and int(a[4] // 100) == int(b[4] // 100) and (*a[:2], *b[:2]) not in set(known)
    }
    assert {frozenset([a[1], b[1]]) for a, b in asked} <= open_pairs
    assert all(start != 0.0 for (start, _), _ in asked)


@pytest.mark.parametrize("mode", ["same-source", "cross-source"])
def test_pairs_of_another_mode_are_not_scored(spark, mode):
    blocked = fuzzy.block(frame(spark, records()))
    every, some = fuzzy.compare(blocked), fuzzy.compare(blocked, mode)
    assert some.counts["scored"] < every.counts["scored"]
    assert by_unit_pair(some.pairs) == by_unit_pair(fuzzy.in_mode(every.pairs, mode))


def test_interrupted_and_resumed_is_one_run(spark, monkeypatch):
    rows = records()
    blocked, path = fuzzy.block(frame(spark, rows)), fresh_path(spark, "run")
    expected, _ = brute(rows)
    assert resumable.run(blocked, path, batches=4, most_batches=1) is False
    done = {r.cluster_start for r in resumable.pairs(spark, path).collect()}
    left = {r.cluster_start for r in resumable.remaining(blocked, path).collect()}
    assert done and left and not done & left

    # The next batch is lost after its results were written, before the ledger names them.
    plain = fuzzy.compare

    def lost(*args):
        found = plain(*args)
        found.pairs.write.parquet(f"{path}/pairs/attempt=lost{len(args)}")
        raise RuntimeError("executor lost")

    monkeypatch.setattr(fuzzy, "compare", lost)
    with pytest.raises(RuntimeError):
        resumable.run(blocked, path, batches=4)
    monkeypatch.setattr(fuzzy, "compare", plain)

    scored = []
    monkeypatch.setattr(fuzzy, "compare", lambda b, *more: (scored.extend(r[0] for r in b.records.select("cluster_start").distinct().collect()), plain(b, *more))[1])
    # Blocked anew, as in another session.
    assert resumable.run(fuzzy.block(frame(spark, rows)), path, batches=4) is True
    assert set(scored) == left
    assert by_unit_pair(resumable.pairs(spark, path)) == expected
    assert resumable.pairs(spark, path).count() == len(expected)
    assert resumable.remaining(blocked, path).count() == 0
    assert {r.file_key for r in resumable.errors(spark, path).collect()} == {r[1] for r in rows if not r[6]} - {"unreadable copy"}


def test_no_resume_starts_anew_and_settings_are_not_mixed(spark):
    blocked, path = fuzzy.block(frame(spark, records(n=24))), fresh_path(spark, "run")
    assert resumable.run(blocked, path, batches=3, most_batches=1) is False
    with pytest.raises(ValueError):
        resumable.run(blocked, path, threshold=0.9, batches=3)
    other = fuzzy.block(frame(spark, records(n=30)))
    with pytest.raises(ValueError):
        resumable.run(other, path, batches=3)
    first = resumable.current_run(spark, path)[0]
    assert resumable.run(blocked, path, batches=3, most_batches=0, resume=False) is False
    assert resumable.current_run(spark, path)[0] != first
    clusters = blocked.records.select("cluster_start").distinct().count()
    assert resumable.remaining(blocked, path).count() == clusters > 1
    assert resumable.pairs(spark, path).count() == resumable.errors(spark, path).count() == 0


def test_run_over_nothing(spark):
    blocked = fuzzy.block(frame(spark, []))
    found = fuzzy.compare(blocked)
    assert found.pairs.count() == 0 and found.errors.count() == 0 and found.counts == {"scored": 0, "results": 0, "errors": 0}
    assert resumable.run(blocked, fresh_path(spark, "run")) is True
