"""Packing and mixing: round trips, bounds, targets."""

import math
import random
import zlib

import numpy as np
import pytest

from tablesync.llm.mixing import mix_sources, ranked_sources, repeated, water_fill
from tablesync.llm.packing import best_fit_decreasing, cut_pieces, lower_bound, pack_documents, pack_pieces
from tablesync.llm.tokens import column_ids

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_segmented_ids_equal_the_tokenizers(tokenizer):
    import pyarrow as pa
    from tokenizers import Tokenizer

    rnd = random.Random(3)
    parts = ["a", "é", "×", "…", " ", "  ", "\n", "\t", " ", "　", "'s", "'", "ll", "1", "²", ".", ",", "中", "\x1c", "\x85", "Ж", "<|endoftext|>", "_", "​", "😀", "\r\n", "I", "-"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(5000)] + [None, "", "word " * 1_000_00]
    plain = Tokenizer.from_file(tokenizer)
    for row, ids in column_ids(pa.array(texts), tokenizer):
        assert ids.tolist() == plain.encode(texts[row] or "", add_special_tokens=False).ids


def test_cut_pieces():
    assert cut_pieces(5, 4).tolist() == [0, 1]
    assert cut_pieces(8, 4).tolist() == [0, 4]
    assert cut_pieces(4, 4).tolist() == [0]
    assert cut_pieces(1, 4).tolist() == [0]


def test_bound_is_below_and_packing_above_the_optimum():
    rnd = random.Random(1)
    for _ in range(300):
        sizes = np.array([rnd.randint(1, 12) for _ in range(rnd.randint(1, 8))])
        bins, offset, used = best_fit_decreasing(sizes, 12)
        assert all(sorted((o, o + s) for o, s in zip(offset[bins == b], sizes[bins == b]))[-1][1] <= 12 for b in range(used))

        def optimum(left, rooms):
            if not left:
                return len(rooms)
            best = len(left) + len(rooms)
            for k in range(len(rooms)):
                if rooms[k] >= left[0]:
                    best = min(best, optimum(left[1:], rooms[:k] + [rooms[k] - left[0]] + rooms[k + 1 :]))
            return min(best, optimum(left[1:], rooms + [12 - left[0]]))

        best = optimum(sorted(sizes.tolist(), reverse=True), [])
        assert math.ceil(sizes.sum() / 12) <= lower_bound(sizes, 12) <= best <= used


def test_bound_sees_pairs_that_do_not_fit():
    assert lower_bound(np.array([7] * 5), 12) == 5
    assert lower_bound(np.array([], int), 12) == 0


def packed(rows):
    """Checks that pieces lie side by side from 0 and returns the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by)


def test_round_trip_of_the_documents(spark, tokenizer):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pack_documents(docs, tokenizer, per_part=60).collect()
    plain, total, pieces = Tokenizer.from_file(tokenizer), 0, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for d in docs.collect():
        ids = np.array(plain.encode(d["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        total += len(ids)
        mine = sorted(pieces.pop(d["doc_id"]), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert [r["length"] for r in mine[1:]] == [1024] * (len(mine) - 1)
        assert [r["ids_crc32"] for r in mine] == [zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in mine]
        assert mine[-1]["start"] + mine[-1]["length"] == len(ids)
    assert not pieces
    sizes = np.array([r["length"] for r in rows])
    assert lower_bound(sizes, 1024) <= packed(rows) <= best_fit_decreasing(sizes, 1024)[2] + 4  # many small groups here


def test_exchange_saves_bins(spark):
    rnd = random.Random(5)
    rows = [(i, 0, 0, rnd.choice([300, 341, 342, 400, 500, 524, 600]), i) for i in range(400)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    alone = packed(pack_pieces(pieces, per_part=20, rounds=1).collect())
    mixed = pack_pieces(pieces, per_part=20, rounds=3).collect()
    assert len(mixed) == 400 and packed(mixed) <= alone
    assert all(r["part_bound"] <= r["part_bins"] for r in mixed)


def test_packing_edges(spark, tokenizer):
    rows = [(1, None), (2, ""), (None, "x"), (3, "same"), (3, "same")]
    out = pack_documents(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 offset", "2 length"), tokenizer).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in out) == [(0, 2), (1, 1), (2, 1), (3, 2), (3, 2)] and packed(out) == 1
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), tokenizer).count() == 0


def fill(sizes, weights, budget=1.5, cap=2):
    """Water-filling source by source."""
    total, free, target = budget * sum(sizes), set(range(len(sizes))), {}
    while free:
        share = (total - sum(target.values())) / sum(weights[i] for i in free)
        over = [i for i in free if share * weights[i] > cap * sizes[i]]
        if not over:
            target |= {i: share * weights[i] for i in free}
            break
        for i in over:
            target[i] = cap * sizes[i]
            free.discard(i)
    return [target[i] for i in range(len(sizes))]


def test_water_filling_against_a_loop(spark):
    rnd = random.Random(2)
    for _ in range(4):
        sizes = [rnd.choice([0, 5, 50, 500, 5000]) for _ in range(9)]
        weights = [(5, 2, 1)[k % 3] for k in range(9)]
        rows = spark.createDataFrame([(str(k), s, w) for k, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight int")
        got = [r["target"] for r in water_fill(rows, 1.5, 2).orderBy("source").collect()]
        assert got == pytest.approx(fill(sizes, weights))


def test_ranks_over_several_ranges(spark):
    names = ["", "Z", "a", "é", "z", "￿", "𐀀", None] + [f"s{k:03}" for k in range(90)]
    sizes = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long")
    got = [r["source"] for r in ranked_sources(sizes, per_part=7).orderBy("rank").collect()]
    assert got == [*sorted((n for n in names if n is not None), key=lambda n: n.encode()), None]


def test_mix_nears_its_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mix_sources(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["reps"] * r["size"]
        by.setdefault(r["source"], []).append(r)
    largest = max(r["size"] for r in rows)
    for mine in by.values():
        assert sum(r["size"] for r in mine) == mine[0]["source_size"]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(0.05 * mine[0]["target"], largest / 2)
    again = {(r["doc_id"], r["taken"]) for r in mix_sources(docs.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}


def test_a_source_with_one_huge_document_nears_its_target(spark):
    rnd = random.Random(4)
    docs = [(k, "w " * n, "a") for k, n in enumerate([5184, *[rnd.randint(50, 700) for _ in range(49)]])]
    docs += [(100 + k, "w " * rnd.randint(100, 900), "b") for k in range(60)] + [(300 + k, "w " * rnd.randint(100, 2000), "c") for k in range(8)]
    rows = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 rank", "2 weight", "3 slot", "4 _mix_place")
    got = mix_sources(rows)
    assert set(got.columns) == {*rows.columns, "size", "source_size", "target", "reps", "taken"}
    for r in got.groupBy("source", "target").agg({"taken": "sum", "size": "max"}).collect():
        few = r["source"] == "c"  # eight documents cannot come as near
        assert abs(r["sum(taken)"] - r["target"]) <= (r["max(size)"] / 2 if few else 0.005 * r["target"])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_sources_near_their_targets(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    for r in mix_sources(docs).groupBy("source", "target").agg({"taken": "sum", "size": "min", "*": "count"}).collect():
        assert abs(r["sum(taken)"] - r["target"]) <= max(0.005 * r["target"], r["min(size)"], 8)


def test_mixing_edges(spark):
    rows = [(1, None, "a"), (2, "", None), (None, "one two", "b"), (3, "x y z", "b"), (3, "x y z", "b"), (4, "w", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "9 size", "8 rank", "7 taken")
    out = {(r["doc_id"], r["source"], r["size"]): r for r in mix_sources(docs).collect()}
    assert out[1, "a", 0]["target"] == 0 and out[2, None, 0]["taken"] == 0
    assert out[4, "", 1]["target"] == 2 and out[4, "", 1]["taken"] == 2
    assert repeated(mix_sources(docs)).where("doc_id = 4").count() == 2
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(empty).count() == 0


def test_a_source_of_many_rows_is_cut_into_slots(spark):
    docs = spark.range(20_000).selectExpr("id doc_id", "repeat('w ', cast(1 + id % 7 as int)) text", "if(id % 3 = 0, 'hot', concat('s', id % 5)) source")
    by = mix_sources(docs).groupBy("source", "target").agg({"taken": "sum"}).collect()
    assert all(abs(r["sum(taken)"] - r["target"]) <= 20 for r in by)
