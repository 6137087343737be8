"""Scoring and candidate search against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dupelens.functions import sequences
from dupelens.functions.sequences import _best_alignment
from dupelens.operators import candidates
from dupelens.plans import fuzzy_detection as fuzzy


def naive(a, b, reach):
    best = 0
    for shift in range(-reach, reach + 1):
        best = max(best, sum(1 for i, x in enumerate(a) if 0 <= i + shift < len(b) and b[i + shift] == x))
    return best / min(len(a), len(b))


def random_pairs(n=200, seed=3):
    rnd = random.Random(seed)
    for _ in range(n):
        a = [rnd.randrange(0, 6) for _ in range(rnd.randrange(1, 30))]
        b = [rnd.randrange(0, 6) for _ in range(rnd.randrange(1, 30))]
        yield a, b


@pytest.mark.parametrize("reach", [0, 3, 50])
def test_best_alignment_equals_brute_force(reach):
    for a, b in random_pairs():
        score = _best_alignment(np.array(a), np.array(b), reach)
        assert score == naive(a, b, reach)
        assert score == _best_alignment(np.array(b), np.array(a), reach)
        assert 0 <= score <= 1
        assert _best_alignment(np.array(a), np.array(a), reach) == 1.0


def test_long_sequences_are_scored_in_blocks(monkeypatch):
    monkeypatch.setattr(sequences, "_BLOCK", 64)
    for a, b in random_pairs(50):
        assert _best_alignment(np.array(a), np.array(b), 20) == naive(a, b, 20)


def test_missing_and_empty_sequences_have_no_score(spark):
    rows = spark.createDataFrame([([1], None), ([], [1]), ([1, 2], [1, 2])], "a array<bigint>, b array<bigint>")
    scores = [r[0] for r in rows.select(sequences.best_alignment()("a", "b")).collect()]
    assert scores == [None, None, 1.0]


def make_classes(spark, seed=11, n=120):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.6:
            words = list(rnd.choice(rows)[2])
            for _ in range(rnd.randrange(0, 8)):
                at = rnd.randrange(len(words))
                action = rnd.random()
                if action < 0.4:
                    words[at] = rnd.randrange(0, 60)
                elif action < 0.7 and len(words) > 2:
                    del words[at]
                else:
                    words.insert(at, 1)
        else:
            words = [min(rnd.randrange(0, 60), rnd.randrange(0, 60)) for _ in range(rnd.randrange(1, 25))]
        rows.append((float(i % 3), f"fp{i:03d}", words))
    return rows, spark.createDataFrame(rows, "cluster_start double, fingerprint string, words array<bigint>")


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.75, 1.0])
def test_candidate_search_misses_nothing(spark, threshold):
    rows, frame = make_classes(spark)
    classes = candidates.content_classes(frame)
    found = {
        (r["fingerprint_1"], r["fingerprint_2"]): r["similarity"]
        for r in candidates.similar_classes(classes, threshold, 10).collect()
    }
    expected = {}
    for i, (cluster, fp, words) in enumerate(rows):
        for other, fp2, words2 in rows[i + 1 :]:
            if other == cluster and (score := naive(words, words2, 10)) >= threshold:
                expected[(fp, fp2)] = score
    assert found == expected


def test_order_of_values_never_changes_the_result(spark):
    _, frame = make_classes(spark)
    classes = candidates.content_classes(frame)

    def scored(cost):
        pairs = candidates.candidate_pairs(classes, 0.6, cost=cost)
        hits = candidates.score_pairs(pairs, classes).where("similarity >= 0.6")
        return {(r["fingerprint_1"], r["fingerprint_2"]) for r in hits.collect()}

    assert scored(None) == scored(F.lit(1)) == scored(-F.col("n")) == scored(F.xxhash64("key"))


def flipped(value, rnd, most):
    for bit in rnd.sample(range(32), rnd.randrange(0, most + 1)):
        value ^= 1 << bit
    return value


def naive_bits(a, b, reach, bits):
    best = 0
    for shift in range(-reach, reach + 1):
        best = max(best, sum((x ^ b[i + shift]).bit_count() <= bits for i, x in enumerate(a) if 0 <= i + shift < len(b)))
    return best / min(len(a), len(b))


@pytest.mark.parametrize("bits", [1, 2, 5])
def test_bit_tolerant_score_equals_brute_force(monkeypatch, bits):
    monkeypatch.setattr(sequences, "_BLOCK", 64)
    rnd = random.Random(bits)
    for _ in range(100):
        a = [rnd.getrandbits(32) if rnd.random() < 0.7 else 0 for _ in range(rnd.randrange(1, 25))]
        b = [flipped(v, rnd, bits + 1) for v in a[rnd.randrange(len(a)) :]] + [rnd.getrandbits(32)] * rnd.randrange(3)
        if b:
            for reach in (0, 4, 40):
                score = _best_alignment(np.array(a), np.array(b), reach, bits)
                assert score == naive_bits(a, b, reach, bits) == _best_alignment(np.array(b), np.array(a), reach, bits)


def test_blocks_of_bits_cover_a_word():
    for bits in range(0, 32):
        blocks = candidates.bit_blocks(bits)
        assert len(blocks) == bits + 1 and sum(width for _, width in blocks) == 32
        assert [shift for shift, _ in blocks] == [sum(w for _, w in blocks[:i]) for i in range(bits + 1)]


@pytest.mark.parametrize(("bits", "threshold"), [(1, 0.5), (2, 0.75), (2, 0.3), (4, 0.6)])
def test_bit_tolerant_search_misses_nothing(spark, bits, threshold):
    rnd = random.Random(bits)
    rows = []
    for i in range(90):
        if rows and rnd.random() < 0.7:
            words = [flipped(v, rnd, bits + 1) for v in rnd.choice(rows)[2]]
            words = words[rnd.randrange(3) :] or words
        else:
            words = [rnd.choice([rnd.getrandbits(32), 0, 0xFFFFFFFF, 1 << 31]) for _ in range(rnd.randrange(1, 20))]
        rows.append((float(i % 2), f"fp{i:03d}", words))
    frame = spark.createDataFrame(rows, "cluster_start double, fingerprint string, words array<bigint>")
    found = {
        (r["fingerprint_1"], r["fingerprint_2"]): r["similarity"]
        for r in candidates.similar_classes(candidates.content_classes(frame), threshold, 6, max_bits=bits).collect()
    }
    expected = {}
    for i, (cluster, fp, words) in enumerate(rows):
        for other, fp2, words2 in rows[i + 1 :]:
            if other == cluster and (score := naive_bits(words, words2, 6, bits)) >= threshold:
                expected[(fp, fp2)] = score
    assert found == expected and len(expected) > 20


def test_bit_errors_are_bounded(spark):
    _, frame = make_classes(spark, n=5)
    with pytest.raises(ValueError):
        candidates.candidate_pairs(candidates.content_classes(frame), 0.5, max_bits=32)


def test_matches_must_lie_at_one_offset(spark):
    """The same values in another order: many common values, but few at any one offset."""
    rnd = random.Random(1)
    base = [rnd.randrange(10**6) for _ in range(60)]
    rows = [(0.0, "base", base), (0.0, "moved", [base[i] for i in rnd.sample(range(60), 60)]), (0.0, "near", base[2:50] + [7] * 10)]
    classes = candidates.content_classes(spark.createDataFrame(rows, "cluster_start double, fingerprint string, words array<bigint>"))
    names = {r["class_id"]: r["fingerprint"] for r in classes.collect()}
    pairs = [{names[r["class_1"]], names[r["class_2"]]} for r in candidates.candidate_pairs(classes, 0.5).collect()]
    assert pairs == [{"base", "near"}]


def test_repeated_values_meet_only_around_their_place(spark):
    """A value that fills two long sequences: matches grow with the length times the window, not with its square."""
    rows = [(0.0, name, [5] * 4000 + [own] * 400) for name, own in (("a", 1), ("b", 2))]
    classes = candidates.content_classes(spark.createDataFrame(rows, "cluster_start double, fingerprint string, words array<bigint>"))
    found = candidates.similar_classes(classes, 0.9, 3).collect()
    assert [r["similarity"] for r in found] == [4000 / 4400]


def test_threshold_must_be_positive(spark):
    _, frame = make_classes(spark, n=5)
    with pytest.raises(ValueError):
        candidates.candidate_pairs(candidates.content_classes(frame), 0.0)


def fuzzy_fixture(spark):
    """A third of all files has one content; the rest are near copies and others, with shared asset ids."""
    rnd = random.Random(5)
    base = [rnd.randrange(0, 1000) for _ in range(40)]
    rows = []
    for i in range(90):
        if i % 3 == 0:
            words = base
        elif i % 3 == 1:
            words = base[:]
            words[rnd.randrange(40)] = 2000 + i % 4
        else:
            words = [rnd.randrange(0, 1000) for _ in range(40)]
        rows.append((f"a{i // 2}", f"f{i}", "wav" if i % 2 else "mp3", "s1" if i % 5 else "s2", 100.0 + i % 4, str(words), words))
    return rows, spark.createDataFrame(
        rows, "asset_id string, file_key string, format string, source string, duration double, fingerprint string, words array<bigint>"
    )


@pytest.mark.parametrize("mode", fuzzy.MODES)
def test_file_pairs_are_counted_exactly(spark, mode):
    rows, frame = fuzzy_fixture(spark)
    found = fuzzy.detect(fuzzy.block(frame), mode, 0.6)
    total = found.agg(F.sum("file_pairs")).first()[0]
    expected = 0
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            if a[0] == b[0] or (mode == "cross-source") == (a[3] == b[3]) and mode != "all":
                continue
            expected += naive(a[6], b[6], 120) >= 0.6
    assert total == expected


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        fuzzy.in_mode(spark.range(1), "other")


def test_known_pairs_are_left_out_in_either_order(spark):
    found = spark.createDataFrame([("a", "b"), ("c", "d")], "fingerprint_1 string, fingerprint_2 string")
    known = spark.createDataFrame([("b", "a")], "fingerprint_1 string, fingerprint_2 string")
    assert [tuple(r) for r in fuzzy.not_known(found, known).collect()] == [("c", "d")]


def test_places_and_their_order_bound_the_search(spark):
    """Texts of one cluster with a common opening of 40 % and a rest of their own: no pair, and hardly a place that meets."""
    rnd = random.Random(9)
    opening = [rnd.randrange(10**6) for _ in range(40)]
    rows = [(0.0, f"t{i:03d}", opening + [10**7 + 100 * i + k for k in range(60)]) for i in range(150)]
    classes = candidates.content_classes(spark.createDataFrame(rows, "cluster_start double, fingerprint string, words array<bigint>"))
    assert candidates.candidate_pairs(classes, 0.75).count() == 0
    places = candidates._places(classes, 0.75, None)
    assert places.count() == 150 * (100 - 75 + 5)
    assert places.where(F.col("value") < 10**6).count() == 0


def test_only_asked_content_is_moved(spark):
    _, frame = make_classes(spark, n=200)
    classes = candidates.content_classes(frame)
    some = classes.where("fingerprint < 'fp010'").select("class_id")
    among = {r["fingerprint"] for r in candidates._among(classes, some).collect()}
    assert {f"fp{i:03d}" for i in range(10)} <= among and len(among) < 20


def test_full_matches_at_any_offset_end_the_scoring():
    rnd = random.Random(3)
    for _ in range(60):
        a = [rnd.randrange(6) for _ in range(rnd.randrange(1, 60))]
        b = [9] * rnd.randrange(40) + a[rnd.randrange(len(a)) :] + [8] * rnd.randrange(3)
        for reach in (0, 5, 12, 13, 50):
            assert _best_alignment(np.array(a), np.array(b), reach) == naive(a, b, reach) if b else True


@pytest.mark.parametrize("bits", [0, 2])
def test_blocks_of_a_cluster_meet_once(spark, monkeypatch, bits):
    """A cluster in many blocks gives each pair once, and the same pairs as in one group."""
    _, frame = make_classes(spark, n=90)
    classes = candidates.content_classes(frame)

    def found():
        pairs = candidates.candidate_pairs(classes, 0.6, 10, bits)
        return sorted(tuple(sorted(r)) for r in pairs.collect())

    whole = found()
    monkeypatch.setattr(candidates, "BLOCK_WORDS", 60)
    assert found() == whole and len(set(whole)) == len(whole) > 10


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_matches_are_counted_in_pieces(monkeypatch, bits):
    rnd = random.Random(bits)
    words = [[rnd.choice([rnd.getrandbits(32), 0, 1, 7]) for _ in range(rnd.randrange(1, 30))] for _ in range(25)]
    words += [[flipped(v, rnd, bits) for v in rnd.choice(words)] for _ in range(25)]
    rows = pa.table(
        {"low": [0] * 50, "high": [0] * 50, "own": [0] * 50, "class_id": range(50), "words": pa.array(words, pa.list_(pa.int64()))}
    )
    none = np.zeros(0, np.int64)
    for piece in (1, 13, 1 << 20):
        monkeypatch.setattr(candidates, "PIECE", piece)
        pairs = {(int(a), int(b)) for a, b in zip(*candidates._Group(rows, 0.5, 6, bits, none, none).pairs())}
        ids = candidates._Group(rows, 0.5, 6, bits, none, none).ids
        assert {tuple(sorted((ids[a], ids[b]))) for a, b in pairs} == {
            (i, j) for i in range(50) for j in range(i + 1, 50) if naive_bits(words[i], words[j], 6, bits) >= 0.5
        }


def test_a_common_passage_makes_no_candidates(spark):
    """Texts with one rare passage in common: each two match in more places than are asked for, and none qualifies."""
    rnd = random.Random(4)
    passage = [rnd.randrange(10**6) for _ in range(12)]
    rows = [(0.0, f"t{i:03d}", [10**7 + 100 * i + k for k in range(20)] + passage + [7] * 8) for i in range(60)]
    classes = candidates.content_classes(spark.createDataFrame(rows, "cluster_start double, fingerprint string, words array<bigint>"))
    assert candidates.candidate_pairs(classes, 0.6).count() == 0
    assert candidates.candidate_pairs(classes, 0.5).count() == 60 * 59 // 2


def test_sequences_are_made_of_one_copy(spark):
    rows = [("a", 100.0, "x", "one two"), ("b", 101.0, "x", None), ("c", 102.0, "y", "one three"), ("d", 103.0, "z", None)]
    frame = spark.createDataFrame(rows, "asset_id string, duration double, fingerprint string, content string").selectExpr(
        "*", "asset_id as file_key", "'wav' as format", "'s' as source"
    )
    blocked = fuzzy.block(frame, words=sequences.token_hashes("content"))
    made = {r["fingerprint"]: (r["length"], r["words"]) for r in blocked.classes.collect()}
    expected = {r[0]: r[1] for r in frame.select("content", sequences.token_hashes("content")).collect()}
    assert made == {"x": (2, expected["one two"]), "y": (2, expected["one three"]), "z": (0, None)}
    assert "content" not in blocked.records.columns
